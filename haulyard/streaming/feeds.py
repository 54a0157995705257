"""The batch functions on streams: ingest, features, dedup, windowed metrics, enrichment, sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from haulyard.functions.columns import rounded
from haulyard.plans import enrich, iot, weather
from haulyard.schemas import text_schema


def json_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New JSON files below ``folder`` as they land, values as text like the batch reader's."""
    reader = spark.readStream.schema(text_schema(schema)).option("multiLine", True).option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_batch).json(folder)


def parquet_stream(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """New parquet files in ``folder`` matching ``glob``; the schema is that of the files there now."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def iot_features(stream: DataFrame, medians: dict) -> DataFrame:
    """Stateless cleaning and features. ``medians`` come from the last batch run: a median needs the
    whole table, and rows must not wait for it."""
    tidy = iot.normalise(stream, "full", medians).where(iot.plausible())
    return iot.features(tidy)


def weather_features(stream: DataFrame, medians: dict) -> DataFrame:
    return weather.features(weather.normalise(stream, medians))


def first_bookings(stream: DataFrame, lateness: str = "1 day") -> DataFrame:
    """One row per booking id within the allowed lateness; state older than that is dropped."""
    return stream.withWatermark("booking_timestamp", lateness).dropDuplicatesWithinWatermark(["booking_id"])


def fleet_metrics(stream: DataFrame, period: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Per metric and period: average, sum, samples. Rows later than ``lateness`` are dropped.

    Partial sums are kept per task before the shuffle, so one busy metric is not one busy task.
    """
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", period).alias("w"), "metric")
        .agg(F.avg("value").alias("a"), F.sum("value").alias("s"), F.count("value").alias("samples"))
        .select(
            "metric",
            F.col("w.start").alias("period_start"),
            rounded("a", 6).alias("average"),
            rounded("s", 6).alias("total"),
            "samples",
        )
    )


def ending(spark: SparkSession, stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` (ts, metric, value) together with the end mark that ``end_stream`` may put into ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))


def end_stream(spark: SparkSession, stream: DataFrame, folder: str) -> None:
    """A row later than all others, without a metric: the next run closes every window before it.

    For feeds that have really ended: rows that come after it are late.
    """
    end = spark.sql("SELECT TIMESTAMP'9999-01-01 00:00:00' AS ts, CAST(NULL AS STRING) AS metric, CAST(NULL AS DOUBLE) AS value")
    end.select(*[F.col(f.name).cast(f.dataType) for f in stream.schema]).coalesce(1).write.mode("append").parquet(folder)


def enriched_iot(stream: DataFrame, summary: DataFrame) -> DataFrame:
    """Streamed readings with the static weather summary of their nearest city."""
    return enrich.enrich_iot(stream, summary)


def parquet_sink(
    stream: DataFrame, folder: str, checkpoint: str, partitions: Sequence[str] = (), once: bool = True
) -> StreamingQuery:
    """Append to parquet. ``once`` takes everything that has landed and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", folder).option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return (writer.trigger(availableNow=True) if once else writer).start()
