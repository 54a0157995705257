"""End-to-end runs: read a zone, apply the plans, write the next zone.

Order of a full run: the three feeds, their enrichment, the large feeds, then models, anomalies,
dashboard extracts and reports. Text feeds are parsed once into a stored table, since cleaning reads
single columns of them several times; checks read the run that was just written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulyard.operators import encode
from haulyard.plans import alarms, anomaly, bookings, enrich, iot, kpis, models, quality, reports, weather
from haulyard.schemas import BOOKING_DEFAULTS, BOOKINGS, IOT, WEATHER, text_schema
from haulyard.session import materialise
from haulyard.sources import readers, writers


def bookings_etl(spark: SparkSession, raw: str, out: str) -> DataFrame:
    """JSON bookings to dated parquet; returns the check results."""
    landed = materialise(readers.raw_json(spark, raw, BOOKINGS))
    writers.dated_parquet(bookings.features(bookings.clean(landed)), out)
    return quality.check_bookings(readers.latest_run(spark, out))


def iot_etl(spark: SparkSession, raw: str, out: str) -> DataFrame:
    landed = materialise(readers.raw_json(spark, raw, IOT))
    writers.dated_parquet(iot.features(iot.clean(landed)), out)
    return quality.check_iot(readers.latest_run(spark, out))


def weather_etl(spark: SparkSession, raw: str, out: str) -> DataFrame:
    landed = materialise(readers.raw_json(spark, raw, WEATHER))
    writers.dated_parquet(weather.features(weather.clean(landed)), out)
    return quality.check_weather(readers.latest_run(spark, out))


def enrichment(spark: SparkSession, iot_folder: str, bookings_folder: str, weather_folder: str, out: str) -> None:
    """The newest run of each cleaned feed, joined with the weather."""
    wx = readers.latest_run(spark, weather_folder)
    readings = readers.latest_run(spark, iot_folder).drop("processed_at")
    orders = readers.latest_run(spark, bookings_folder).drop("processed_at")
    writers.dated_parquet(enrich.enrich_iot(readings, enrich.weather_by_city(wx)), f"{out}/iot-enriched")
    writers.dated_parquet(enrich.enrich_bookings(orders, enrich.weather_by_origin(wx)), f"{out}/bookings-enriched")


def large_etl(spark: SparkSession, bookings_raw: str, iot_raw: str, out: str, max_chunks: int | None = None) -> DataFrame:
    """CSV chunks of both large feeds to row-bounded parquet files; returns the status shares."""
    orders = materialise(readers.csv_chunks(spark, bookings_raw, text_schema(BOOKINGS), max_chunks))
    orders = bookings.features(bookings.clean(orders, "large"), "large")
    writers.chunked_parquet(orders, f"{out}/bookings-large")
    readings = materialise(readers.csv_chunks(spark, iot_raw, text_schema(IOT), max_chunks))
    writers.chunked_parquet(iot.features(iot.clean(readings, "large"), "large"), f"{out}/iot-large")
    return kpis.on_bookings(readers.parquet_chunks(spark, f"{out}/bookings-large"), kpis.STATUS_BREAKDOWN)


def sql_etl(spark: SparkSession, raw: str, out: str, fallback: str | None = None) -> DataFrame:
    """Typed CSV bookings to parquet and to the view ``bookings``; returns the booking KPIs."""
    rows = bookings.sql_profile(readers.typed_csv(spark, raw, BOOKINGS, fallback, BOOKING_DEFAULTS))
    writers.overwrite_parquet(rows, out)
    return kpis.booking_kpis(kpis.register_bookings(spark.read.parquet(out)))


def dashboard_extracts(iot_table: DataFrame, bookings_table: DataFrame, summary: DataFrame, out: str, iot_keys: Sequence[str]) -> None:
    """The five CSV extracts; ``summary`` is the long KPI table."""
    writers.csv_extract(kpis.fleet_extract(iot_table, list(iot_keys)), f"{out}/fleet_performance")
    writers.csv_extract(kpis.delivery_extract(bookings_table, ["booking_id"]), f"{out}/delivery_analytics")
    writers.csv_extract(summary, f"{out}/kpi_summary", single=True)
    writers.csv_extract(kpis.route_analysis(bookings_table), f"{out}/route_analysis")
    writers.csv_extract(kpis.tier_performance(iot_table), f"{out}/tier_performance", single=True)


def anomaly_run(iot_table: DataFrame, out: str, trees: int = anomaly.TREES) -> DataFrame:
    """Detect, store the flagged readings and the report; returns the stored readings."""
    writers.overwrite_parquet(anomaly.detect(iot_table, trees=trees), f"{out}/readings")
    found = iot_table.sparkSession.read.parquet(f"{out}/readings")
    writers.json_document(reports.anomaly_report(found), f"{out}/report")
    return found


def model_run(bookings_table: DataFrame, out: str, settings: models.Settings = models.Settings()) -> DataFrame:
    """Train, compare, keep the best model and the report; returns the results per model."""
    codes = materialise(encode.label_codes(models.delay_features(bookings_table, encode_categories=False), models.DELAY_CATEGORIES))
    trained = models.train(models.delay_features(bookings_table, codes=codes), ["booking_id"], settings)
    results = materialise(models.evaluate(trained, settings))
    models.save_best(trained, results, out, codes, settings.threshold)
    writers.json_document(reports.ml_report(results, settings.threshold), f"{out}/report")
    return results


def master_run(
    iot_table: DataFrame,
    bookings_table: DataFrame,
    anomaly_flag: str,
    out: str,
    results: DataFrame | None = None,
    forecasts: DataFrame | None = None,
) -> DataFrame:
    """Store the master report; returns the metric table measured on the same frames."""
    writers.json_document(reports.master_report(iot_table, bookings_table, anomaly_flag, results, forecasts), f"{out}/report")
    frames = [kpis.fleet_health(iot_table, anomaly_flag), kpis.fleet_kpis(iot_table), kpis.delivery_kpis(bookings_table)]
    if results is not None:
        frames.append(results.orderBy(F.desc("auc_pct"), "model").limit(1))
    return alarms.metric_table(*frames)


def ingestion_manifest(spark: SparkSession, raw: str, out: str, sources: list[str] | None = None) -> DataFrame:
    rows = readers.manifest(spark, raw, sources)
    writers.csv_extract(rows, out)
    return rows
