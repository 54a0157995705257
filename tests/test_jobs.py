"""Runs over files: landing JSON and CSV to parquet, extracts, reports, manifest."""

import json

import pytest
from pyspark.sql import functions as F

from haulyard import bindings as B
from haulyard.plans import alarms, iot, jobs, quality
from haulyard.plans import bookings as booking_plan
from haulyard.schemas import BOOKING_DEFAULTS, BOOKINGS, IOT, WEATHER, conform, text_schema
from haulyard.sources import readers, writers


def write_json(df, folder, rows=40):
    folder.mkdir(parents=True)
    for i, text in enumerate(df.limit(rows).toJSON().collect()):
        (folder / f"{i:03d}.json").write_text(json.dumps(json.loads(text), indent=2))


@pytest.fixture(scope="module")
def zones(spark, data, tmp_path_factory):
    root = tmp_path_factory.mktemp("zones")
    write_json(conform(B.bookings(spark, data), BOOKINGS), root / "raw" / "booking-logs")
    write_json(conform(B.iot(spark, data), IOT), root / "raw" / "iot-sensor-data" / "2024" / "01")
    write_json(conform(B.weather(spark, data), WEATHER), root / "raw" / "weather-data")
    return root


def test_feeds_to_enriched_tables(spark, zones):
    raw, out = f"{zones}/raw", f"{zones}/processed"
    assert {r["status"] for r in jobs.bookings_etl(spark, f"{raw}/booking-logs", f"{out}/bookings").collect()} <= {"PASSED", "INFO", "WARNING"}
    jobs.iot_etl(spark, f"{raw}/iot-sensor-data", f"{out}/iot")
    jobs.weather_etl(spark, f"{raw}/weather-data", f"{out}/weather")
    stored = spark.read.parquet(f"{out}/iot")
    assert {"year", "month", "day", "processed_at"} <= set(stored.columns)
    jobs.enrichment(spark, f"{out}/iot", f"{out}/bookings", f"{out}/weather", f"{out}/analytics")
    enriched = spark.read.parquet(f"{out}/analytics/iot-enriched")
    assert enriched.count() == stored.count() and "combined_risk_score" in enriched.columns
    assert spark.read.parquet(f"{out}/analytics/bookings-enriched").where("origin_weather_w IS NULL").count() == 0


def test_unreadable_values_cost_the_value_only(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    good = {"booking_id": " bk1 ", "origin_city": "l&t city", "destination_city": "goa", "distance_km": "12.5", "freight_charge_inr": 5}
    bad = {"booking_id": "bk2", "origin_city": "pune", "destination_city": "goa", "distance_km": "abc", "freight_charge_inr": 7}
    (folder / "a.json").write_text(json.dumps(good))
    (folder / "b.json").write_text(json.dumps(bad))
    rows = booking_plan.clean(readers.raw_json(spark, str(folder), BOOKINGS)).orderBy("booking_id").collect()
    assert [(r["booking_id"], r["origin_city"], r["distance_km"]) for r in rows] == [("BK1", "L&T City", 12.5), ("BK2", "Pune", 12.5)]


def test_invalid_first_duplicate_removes_the_booking(spark):
    rows = [("b1", "2024-01-01", 0.0), ("b1", "2024-01-02", 9.0), ("b2", "2024-01-01", 3.0)]
    frame = conform(
        spark.createDataFrame(rows, "booking_id string, booking_timestamp string, distance_km double").withColumns(
            {"freight_charge_inr": F.lit(1.0), "origin_city": F.lit("a"), "destination_city": F.lit("b")}
        ),
        BOOKINGS,
    )
    assert [r["booking_id"] for r in booking_plan.clean(frame).collect()] == ["B2"]
    summary = booking_plan.run_summary(frame).first()
    assert (summary["rows_in"], summary["duplicates_removed"], summary["invalid_removed"], summary["rows_out"]) == (3, 1, 1, 1)


def test_latest_run_and_file(spark, tmp_path):
    for n in (1, 2):
        writers.dated_parquet(spark.range(n * 10), str(tmp_path / "t"))
    assert readers.latest_run(spark, str(tmp_path / "t")).count() == 20
    assert readers.latest_parquet(spark, str(tmp_path / "t")).count() > 0
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        readers.latest_parquet(spark, str(tmp_path / "none"))


def test_csv_chunks_in_order_and_capped(spark, tmp_path):
    for i in (3, 1, 2):
        (tmp_path / f"chunk_{i:03d}.csv").write_text(f"booking_id,distance_km\nb{i},{i}\n")
    schema = text_schema(BOOKINGS)
    chosen = readers.csv_chunks(spark, str(tmp_path), schema.__class__([schema["booking_id"], schema["distance_km"]]), 2)
    assert sorted(r["booking_id"] for r in chosen.collect()) == ["b1", "b2"]
    assert readers.csv_chunks(spark, str(tmp_path / "absent"), schema).count() == 0
    assert readers.parquet_chunks(spark, str(tmp_path / "absent"), BOOKINGS).count() == 0


def test_large_and_sql_runs(spark, data, tmp_path):
    B.typed_bookings(spark, data).select(*BOOKINGS.names).write.option("header", True).csv(f"{tmp_path}/b")
    conform(B.iot(spark, data), IOT).write.option("header", True).csv(f"{tmp_path}/i")
    shares = jobs.large_etl(spark, f"{tmp_path}/b", f"{tmp_path}/i", f"{tmp_path}/out")
    assert abs(sum(r["pct"] for r in shares.collect()) - 100) < 0.5
    assert spark.read.parquet(f"{tmp_path}/out/iot-large").count() == 1000
    kpi = jobs.sql_etl(spark, f"{tmp_path}/b", f"{tmp_path}/sql").first()
    assert kpi["total_orders"] == spark.sql("SELECT count(*) FROM bookings").first()[0] > 4000


def test_typed_csv_fallback_gets_defaults(spark, tmp_path):
    (tmp_path / "f.csv").write_text("booking_id,distance_km\nb1,bad\n")
    row = readers.typed_csv(spark, f"{tmp_path}/absent", BOOKINGS, f"{tmp_path}/f.csv", BOOKING_DEFAULTS).first()
    assert (row["distance_km"], row["origin_weather"], row["is_insured"], row["origin_has_severe"]) == (0.0, "Clear", True, 0)


def test_row_bounded_files(spark, tmp_path):
    writers.chunked_parquet(spark.range(0, 1050, 1, 1), str(tmp_path / "c"), rows=100)
    assert readers.file_listing(spark, str(tmp_path / "c"), "*.parquet").count() == 11
    assert readers.has_files(spark, str(tmp_path / "c"), ".parquet") and not readers.has_files(spark, str(tmp_path), ".csv")


def test_manifest(spark, zones):
    rows = readers.manifest(spark, f"{zones}/raw", ["booking-logs", "iot-sensor-data"])
    assert {r["data_source"]: r["count"] for r in rows.groupBy("data_source").count().collect()} == {"booking-logs": 40, "iot-sensor-data": 40}
    assert rows.where("file_size_bytes <= 0 OR status <> 'SUCCESS'").count() == 0
    jobs.ingestion_manifest(spark, f"{zones}/raw", f"{zones}/manifest")
    assert spark.read.option("header", True).csv(f"{zones}/manifest").count() == 120


def test_reports_round_trip(spark, data, tmp_path):
    readings = iot.features(iot.clean(B.iot(spark, data))).withColumn("hit", (F.col("speed_kmh") > 100).cast("int"))
    orders = booking_plan.features(booking_plan.clean(B.bookings(spark, data), "large", tie_break=B.BOOKING_ORDER), "large")
    metric = {r["metric"]: r["value"] for r in jobs.master_run(readings, orders, "hit", str(tmp_path)).collect()}
    report = readers.json_report(spark, f"{tmp_path}/report")
    row = report.select("delivery_kpis.total_orders", "fleet_kpis.total_vehicles", F.size("top_revenue_routes").alias("n"), "generated_at").first()
    assert row["total_orders"] == metric["TotalOrders"] and row["n"] == 10 and row["generated_at"]
    routes = report.select("top_revenue_routes.total_revenue").first()[0]
    assert routes == sorted(routes, reverse=True)


def test_dashboard_extracts(spark, data, tmp_path):
    from haulyard.plans import kpis

    readings = iot.features(iot.clean(B.iot(spark, data)))
    orders = booking_plan.features(booking_plan.clean(B.bookings(spark, data), "large", tie_break=B.BOOKING_ORDER), "large")
    jobs.dashboard_extracts(readings, orders, kpis.kpi_summary(kpis.fleet_kpis(readings)), str(tmp_path), ["event_id"])
    rows = {n: spark.read.option("header", True).csv(f"{tmp_path}/{n}").count() for n in
            ["fleet_performance", "delivery_analytics", "kpi_summary", "route_analysis", "tier_performance"]}
    assert rows["tier_performance"] == 3 and rows["kpi_summary"] == 4 and rows["delivery_analytics"] == 4599


def test_empty_tables_pass_checks_and_give_zero_rates(spark):
    empty = conform(spark.createDataFrame([], BOOKINGS), BOOKINGS)
    assert {r["status"] for r in quality.check_bookings(empty).collect()} == {"PASSED"}
    from haulyard.plans import kpis

    row = kpis.delivery_kpis(empty).first()
    assert (row["total_orders"], row["delay_rate_pct"]) == (0, 0.0)
    none = spark.createDataFrame([], "vehicle_tier string, hit int")
    assert {r["anomaly_rate_pct"] for r in kpis.tier_anomaly_rate(none, "hit").collect()} == {0.0}


def test_missing_periods_follow_the_rule(spark):
    rows = [("2024-01-01 00:00:10", 10.0), ("2024-01-01 00:10:10", 99.0), ("2024-01-01 00:16:00", 99.0)]
    metrics = spark.createDataFrame(rows, "t string, value double").selectExpr("CAST(t AS TIMESTAMP) AS ts", "'m' AS metric", "value")
    rules = [("gap bad", "m", ">", 50.0, "Average", 300, 1, "breaching"), ("gap fine", "m", ">", 50.0, "Sum", 300, 2, "notBreaching")]
    states = alarms.alarm_states(metrics, alarms.rules_frame(spark, rules)).orderBy("alarm", "period_start").collect()
    assert [r["state"] for r in states] == ["OK", "ALARM", "ALARM", "ALARM", "OK", "OK", "OK", "ALARM"]
    assert states[1]["value"] is None


def test_acceptance_fails_on_missing_measure(spark):
    measures = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "measure string, value double")
    got = quality.acceptance(measures, [("a", ">=", 5.0), ("b", ">", 5.0), ("c", ">", 1.0)])
    assert {r["measure"]: r["status"] for r in got.collect()} == {"a": "PASS", "b": "FAIL", "c": "FAIL"}
