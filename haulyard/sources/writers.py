"""Writers for the processed, analytics and report zones. Columns keep their types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 100_000


def stamped(df: DataFrame) -> DataFrame:
    """Add the processing time. Only sinks call this, so plans stay repeatable."""
    return df.withColumn("processed_at", F.current_timestamp())


def dated_parquet(df: DataFrame, folder: str, mode: str = "append", moment: str | None = None, tasks_a_day: int | None = None) -> None:
    """Snappy parquet under year=/month=/day= of the run (or of the timestamp column ``moment``).

    Run-dated rows go to one folder as they are, with no shuffle. Rows dated by a column are first
    gathered by day and a salt: a busy day spreads over tasks (by default as many as the session's shuffle
    partitions), and tasks do not each open every day.
    """
    out = df if "processed_at" in df.columns else stamped(df)
    at = F.col(moment) if moment else F.current_timestamp()
    out = out.withColumns({"year": F.year(at), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd")})
    if moment:
        salts = tasks_a_day or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartition("year", "month", "day", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    out.write.mode(mode).partitionBy("year", "month", "day").option("compression", "snappy").parquet(folder)


def chunked_parquet(df: DataFrame, folder: str, rows: int = CHUNK_ROWS, mode: str = "append") -> None:
    """Parquet files of at most ``rows`` rows, under year=/month= of the run."""
    now = F.current_timestamp()
    out = stamped(df).withColumns({"year": F.year(now), "month": F.date_format(now, "MM")})
    writer = out.write.mode(mode).partitionBy("year", "month").option("maxRecordsPerFile", rows)
    writer.option("compression", "snappy").parquet(folder)


def overwrite_parquet(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").parquet(folder)


def csv_extract(df: DataFrame, folder: str, single: bool = False) -> None:
    """CSV with header. ``single`` (one file) is for KPI-sized results."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(folder)


def json_document(df: DataFrame, folder: str) -> None:
    """A one-row nested report as one JSON document, with the time it was made."""
    body = df.withColumn("generated_at", F.current_timestamp())
    body.select(F.to_json(F.struct(*body.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(folder)
