"""Streams driven to completion give what the batch functions give."""

import json

from pyspark.sql import functions as F

from haulyard import bindings as B
from haulyard.plans import iot
from haulyard.schemas import IOT, conform
from haulyard.streaming import feeds


def finish(spark, stream, tmp_path, partitions=()):
    feeds.parquet_sink(stream, f"{tmp_path}/rows", f"{tmp_path}/state", partitions).awaitTermination()
    return spark.read.parquet(f"{tmp_path}/rows")


def test_json_ingest_features_and_partitioned_sink(spark, data, tmp_path):
    rows = conform(B.iot(spark, data), IOT).toJSON().take(25)
    (tmp_path / "in").mkdir()
    for i, text in enumerate(rows):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(json.loads(text), indent=2))
    got = finish(spark, feeds.iot_features(feeds.json_stream(spark, f"{tmp_path}/in", IOT, 10), {}), tmp_path, ["vehicle_tier"])
    batch = iot.features(iot.normalise(spark.read.schema(IOT).option("multiLine", True).json(f"{tmp_path}/in"), "full", {}).where(iot.plausible()))
    assert got.count() == batch.count() > 10
    assert got.select(*batch.columns).exceptAll(batch).count() == 0


def test_dedup_within_watermark(spark, tmp_path):
    rows = [("b1", "2024-01-01 10:00:00"), ("b1", "2024-01-01 10:05:00"), ("b2", "2024-01-01 11:00:00")]
    frame = spark.createDataFrame(rows, "booking_id string, t string")
    frame.selectExpr("booking_id", "CAST(t AS TIMESTAMP) AS booking_timestamp").write.parquet(f"{tmp_path}/in")
    got = finish(spark, feeds.first_bookings(feeds.parquet_stream(spark, f"{tmp_path}/in", "*.parquet")), tmp_path)
    assert sorted(r["booking_id"] for r in got.collect()) == ["b1", "b2"]


def test_late_rows_are_dropped(spark, tmp_path):
    def land(name, times):
        frame = spark.createDataFrame([(t, 1.0) for t in times], "t string, value double")
        frame.selectExpr("CAST(t AS TIMESTAMP) AS ts", "'m' AS metric", "value").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = feeds.fleet_metrics(feeds.parquet_stream(spark, f"{tmp_path}/in", "*.parquet"))
        return finish(spark, stream, tmp_path)

    land("a", ["2024-01-01 00:01:00", "2024-01-01 00:02:00", "2024-01-01 01:00:00"])
    run()
    land("b", ["2024-01-01 00:03:00", "2024-01-01 03:00:00"])
    got = {str(r["period_start"]): r["samples"] for r in run().collect()}
    assert got == {"2024-01-01 00:00:00": 2, "2024-01-01 01:00:00": 1}


def test_stream_features_equal_batch(spark, data, tmp_path):
    stream = feeds.iot_features(B.iot_of(feeds.parquet_stream(spark, data, "events.parquet")), {})
    got = finish(spark, stream, tmp_path)
    batch = iot.features(iot.normalise(B.iot(spark, data), "full", {}).where(iot.plausible()))
    assert got.exceptAll(batch).count() == 0 and got.count() == batch.count()
    assert got.where(F.col("engine_health_score").isNull()).count() == 0
