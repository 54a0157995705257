"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}  # of local sessions without the setting, by application


def build_session(app: str = "haulyard", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ANSI stays on.

    On a cluster ``master`` comes from the submit command. The number of shuffle partitions is left
    to the deployment: adaptive execution merges small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: on a cluster a machine-local
    folder would be lost with its executor, so that is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="haulyard-")
    return _own_folders[application]


def application_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder, which ``release`` removes."""
    return f"{shared_folder(spark).rstrip('/')}/haulyard/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path in this application's part of the shared folder."""
    return f"{application_folder(spark)}/{uuid.uuid4().hex}"


def files_below(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of the file system; none if nothing is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [str(f.getPath().toString()) for f in found or []]


def materialise(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from its files.

    For frames that several jobs read: the files outlive executors, cut the lineage, and stay
    columnar, so each reader still scans only its own columns. All tables of an application lie in
    one folder named after it, which can be removed when the application has ended.
    """
    path = scratch_path(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Frames written inside leave no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Delete this application's tables in the shared folder. Frames that read them can no longer be used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
