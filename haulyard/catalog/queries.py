"""The registered queries: (session, folder with the test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulyard import bindings as B
from haulyard.functions.columns import as_timestamp, clean_title, clean_upper, flag, night_shift, rounded, title_case
from haulyard.operators import encode, impute, metrics, sampling, scaling
from haulyard.operators.dedup import drop_repeats
from haulyard.plans import alarms, anomaly, bookings, enrich, iot, kpis, models, quality, reports, weather
from haulyard.session import materialise, scratch_path
from haulyard.sources import readers
from haulyard.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HELPERS = ["l_partkey", "l_suppkey", "s_nationkey"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame) -> DataFrame:
    """Without helper columns; instants as plain UTC timestamps."""
    out = df.drop(*[c for c in HELPERS if c in df.columns])
    instants = [f.name for f in out.schema if isinstance(f.dataType, T.TimestampType)]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants}) if instants else out


# ---- frames the queries start from -------------------------------------------------------


def clean_bookings(spark, folder):
    return bookings.clean(B.bookings(spark, folder), "full", tie_break=B.BOOKING_ORDER)


def featured_bookings(spark, folder):
    return bookings.features(clean_bookings(spark, folder), "full")


def large_frame(spark, folder):
    return bookings.features(bookings.clean(B.bookings(spark, folder), "large", tie_break=B.BOOKING_ORDER), "large")


def sql_frame(spark, folder):
    return bookings.sql_profile(B.typed_bookings(spark, folder), tie_break=B.BOOKING_ORDER)


def clean_iot(spark, folder):
    return iot.clean(B.iot(spark, folder))


def featured_iot(spark, folder):
    return iot.features(clean_iot(spark, folder))


def flagged_iot(spark, folder):
    """Readings with the plain speed flag standing in for the model's."""
    return featured_iot(spark, folder).withColumn("confirmed_anomaly", flag(F.col("speed_kmh") > 100))


def clean_weather(spark, folder):
    return weather.clean(B.weather(spark, folder))


def featured_weather(spark, folder):
    return weather.features(clean_weather(spark, folder))


def gappy_iot(spark, folder):
    """Readings with every seventh speed missing, every eleventh unreadable text, some NaN."""
    event = F.col("event_id")
    speed = F.when(event % 7 == 0, None).when(event % 11 == 0, "n/a").when(event % 13 == 0, "NaN")
    return B.iot(spark, folder).withColumns(
        {
            "speed_kmh": speed.otherwise(F.col("speed_kmh").cast("string")),
            "engine_rpm": F.when(event % 5 != 0, F.col("engine_rpm")),
        }
    )


# ---- cleaning ----------------------------------------------------------------------------


@query
def bookings_clean(spark, folder):
    return shown(clean_bookings(spark, folder))


@query
def bookings_dedup(spark, folder):
    kept = bookings.first_bookings(B.bookings(spark, folder), B.BOOKING_ORDER)
    return shown(kept)


@query
def iot_clean(spark, folder):
    return shown(clean_iot(spark, folder))


@query
def iot_dedup(spark, folder):
    """Every reading sent twice, one copy kept (the key column is dropped, so equal rows merge)."""
    once = B.iot(spark, folder).drop("event_id")
    return shown(drop_repeats(once.unionByName(once)))


@query
def weather_clean(spark, folder):
    return shown(clean_weather(spark, folder))


@query
def large_bookings(spark, folder):
    return shown(large_frame(spark, folder))


@query
def large_iot(spark, folder):
    return shown(iot.features(iot.clean(B.iot(spark, folder), "large"), "large"))


@query
def median_impute(spark, folder):
    filled = impute.fill_medians(gappy_iot(spark, folder), ["speed_kmh", "engine_rpm"])
    return filled.select("event_id", "speed_kmh", "engine_rpm")


@query
def tier_median_impute(spark, folder):
    filled = impute.fill_group_medians(gappy_iot(spark, folder), ["speed_kmh", "engine_rpm"], "vehicle_tier")
    return filled.select("event_id", "vehicle_tier", "speed_kmh", "engine_rpm")


@query
def text_normalize(spark, folder):
    part = B.table(spark, folder, "part")
    raw = F.concat(F.lit(" l&t "), F.lower("p_name"), F.lit("-"), F.lower("p_type"), F.lit(" "))
    return part.select(
        "p_partkey",
        clean_title(raw).alias("title_text"),
        clean_upper(raw).alias("upper_text"),
        title_case("p_brand").alias("brand_title"),
    )


@query
def parse_timestamps(spark, folder):
    """ISO text with offsets, with unreadable entries, read back to instants."""
    text = F.when(F.col("event_id") % 9 == 0, "not a time").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    )
    frame = B.table(spark, folder, "events").select("event_id", text.alias("text"))
    return shown(frame.withColumn("instant", as_timestamp(frame, "text")))


@query
def etl_run_summary(spark, folder):
    return bookings.run_summary(B.bookings(spark, folder), B.BOOKING_ORDER)


# ---- features ----------------------------------------------------------------------------


@query
def bookings_features(spark, folder):
    return shown(featured_bookings(spark, folder))


@query
def spark_etl_features(spark, folder):
    return shown(sql_frame(spark, folder))


@query
def iot_features(spark, folder):
    return shown(featured_iot(spark, folder))


@query
def weather_features(spark, folder):
    return shown(featured_weather(spark, folder))


@query
def ml_features(spark, folder):
    return models.delay_features(large_frame(spark, folder)).select("booking_id", *models.DELAY_FEATURES, "target")


@query
def night_shift_flag(spark, folder):
    hour = F.hour("timestamp")
    return B.iot(spark, folder).select("event_id", hour.alias("hour_of_day"), night_shift(hour).alias("is_night_shift"))


@query
def weather_risk_lookup(spark, folder):
    frame = B.weather(spark, folder)
    city = title_case("city")
    condition = F.when(F.col("event_id") % 17 == 0, "Hail").otherwise(F.col("weather_condition"))
    return frame.select(
        "event_id",
        weather.condition_risk(condition, city).alias("risk"),
        weather.is_severe_condition(condition).alias("has_severe"),
    )


@query
def road_condition(spark, folder):
    rain = F.col("rainfall_mm")
    return B.weather(spark, folder).select(
        "event_id",
        weather.road_condition(rain).alias("road_condition"),
        flag(rain > 50).alias("is_flood"),
        flag(F.col("weather_condition") == "Fog").alias("is_fog"),
    )


@query
def delay_rules(spark, folder):
    frame = bookings.first_bookings(B.bookings(spark, folder), B.BOOKING_ORDER)
    cargo = F.when(F.col("l_partkey") % 9 == 0, "Pharmaceuticals").when(F.col("l_partkey") % 9 == 1, "Perishables")
    rule = weather.delay_rule(
        F.col("origin_weather"),
        F.col("origin_delay_risk"),
        F.col("distance_km"),
        F.col("cargo_weight_kg"),
        F.col("priority"),
        cargo.otherwise("Textiles"),
    )
    return frame.select("booking_id", rule.alias("r")).select("booking_id", "r.rule", "r.share", "r.status")


@query
def tier_from_id(spark, folder):
    return B.iot(spark, folder).select("event_id", iot.tier_from_id(F.col("vehicle_id")).alias("tier"))


# ---- joins -------------------------------------------------------------------------------


def _rounded_doubles(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({c: rounded(c, 6) for c in names})


IOT_MEANS = ["avg_temp_C", "avg_humidity_pct", "avg_delay_risk", "avg_congestion", "avg_visibility_km", "combined_risk_score"]


@query
def weather_city_summary(spark, folder):
    return _rounded_doubles(enrich.weather_by_city(featured_weather(spark, folder)), IOT_MEANS)


@query
def weather_origin_summary(spark, folder):
    return _rounded_doubles(enrich.weather_by_origin(featured_weather(spark, folder)), enrich.FILLED_NUMBERS)


@query
def nearest_city(spark, folder):
    gaps = F.when(F.col("event_id") % 10 != 0, F.col("gps_latitude"))
    frame = B.iot(spark, folder).withColumn("gps_latitude", gaps)
    return enrich.with_nearest_city(frame).select("event_id", "nearest_city")


@query
def iot_enriched(spark, folder):
    joined = enrich.enrich_iot(featured_iot(spark, folder), enrich.weather_by_city(featured_weather(spark, folder)))
    return shown(_rounded_doubles(joined, IOT_MEANS))


@query
def bookings_enriched(spark, folder):
    # the feed is read for its medians and for its rows, the clean rows for origins and for the join: both are stored, so their joins run once
    feed = materialise(B.bookings(spark, folder))
    cleaned = bookings.features(bookings.clean(feed, "full", tie_break=B.BOOKING_ORDER), "full")
    frame = materialise(B.bridged_bookings(cleaned))
    joined = enrich.enrich_bookings(frame, enrich.weather_by_origin(featured_weather(spark, folder)))
    return shown(_rounded_doubles(joined, enrich.FILLED_NUMBERS))


@query
def route_distance(spark, folder):
    frame = B.bridged_bookings(bookings.first_bookings(B.bookings(spark, folder), B.BOOKING_ORDER))
    bridged = F.expr(B._city_of("c_nationkey"))
    nation = B.table(spark, folder, "nation").select(
        F.col("n_name").alias("destination_city"), F.col("n_nationkey").alias("c_nationkey")
    )
    named = frame.join(nation, "destination_city").withColumn("destination_city", bridged)
    return enrich.route_distance(named).select("booking_id", "origin_city", "destination_city", "route_km")


# ---- aggregates --------------------------------------------------------------------------


@query
def fleet_kpis(spark, folder):
    return kpis.fleet_kpis(featured_iot(spark, folder))


@query
def tier_breakdown(spark, folder):
    return kpis.tier_breakdown(featured_iot(spark, folder))


@query
def speed_distribution(spark, folder):
    return kpis.speed_distribution(featured_iot(spark, folder))


@query
def vehicle_summary(spark, folder):
    return kpis.vehicle_summary(featured_iot(spark, folder))


@query
def tier_performance(spark, folder):
    return kpis.tier_performance(featured_iot(spark, folder))


@query
def delivery_kpis(spark, folder):
    return kpis.delivery_kpis(large_frame(spark, folder))


@query
def top_routes(spark, folder):
    return kpis.top_routes(large_frame(spark, folder))


@query
def delay_by_cargo_top5(spark, folder):
    return kpis.delay_by_cargo_top(large_frame(spark, folder))


@query
def revenue_by_city(spark, folder):
    return kpis.revenue_by_city(large_frame(spark, folder))


@query
def route_analysis(spark, folder):
    return kpis.route_analysis(large_frame(spark, folder))


@query
def status_breakdown(spark, folder):
    return kpis.on_bookings(sql_frame(spark, folder), kpis.STATUS_BREAKDOWN)


@query
def city_revenue_top5(spark, folder):
    return kpis.on_bookings(sql_frame(spark, folder), kpis.CITY_REVENUE)


@query
def delay_by_priority(spark, folder):
    return kpis.on_bookings(sql_frame(spark, folder), kpis.DELAY_BY_PRIORITY)


@query
def delay_by_cargo(spark, folder):
    return kpis.on_bookings(sql_frame(spark, folder), kpis.DELAY_BY_CARGO)


@query
def booking_kpis(spark, folder):
    return kpis.booking_kpis(sql_frame(spark, folder))


@query
def class_balance(spark, folder):
    return kpis.class_balance(models.with_target(large_frame(spark, folder)))


@query
def anomalous_vehicles(spark, folder):
    return kpis.anomalous_vehicles(flagged_iot(spark, folder), "confirmed_anomaly")


@query
def tier_anomaly_rate(spark, folder):
    return kpis.tier_anomaly_rate(flagged_iot(spark, folder), "confirmed_anomaly")


@query
def sensor_compare(spark, folder):
    return kpis.sensor_compare(flagged_iot(spark, folder), "confirmed_anomaly")


@query
def fleet_health(spark, folder):
    return kpis.fleet_health(flagged_iot(spark, folder), "confirmed_anomaly")


def gappy_bookings(spark, folder):
    """Clean bookings in which the third item of an order has no freight and the fifth no distance."""
    line = F.element_at(F.split("booking_id", "-"), -1)
    return large_frame(spark, folder).withColumns(
        {
            "freight_charge_inr": F.when(line != "3", F.col("freight_charge_inr")),
            "distance_km": F.when(line != "5", F.col("distance_km")),
        }
    )


@query
def delivery_kpis_gaps(spark, folder):
    return kpis.delivery_kpis(gappy_bookings(spark, folder))


@query
def top_routes_gaps(spark, folder):
    return kpis.top_routes(gappy_bookings(spark, folder))


@query
def route_analysis_gaps(spark, folder):
    return kpis.route_analysis(gappy_bookings(spark, folder))


@query
def revenue_by_city_gaps(spark, folder):
    return kpis.revenue_by_city(gappy_bookings(spark, folder))


@query
def kpi_summary(spark, folder):
    flagged = flagged_iot(spark, folder)
    return kpis.kpi_summary(
        kpis.fleet_kpis(flagged),
        kpis.fleet_health(flagged, "confirmed_anomaly"),
        kpis.delivery_kpis(large_frame(spark, folder)),
    )


@query
def fleet_extract(spark, folder):
    return kpis.fleet_extract(featured_iot(spark, folder), ["event_id"])


@query
def delivery_extract(spark, folder):
    return kpis.delivery_extract(large_frame(spark, folder), ["booking_id"])


# ---- quality -----------------------------------------------------------------------------


@query
def dq_bookings(spark, folder):
    return quality.check_bookings(bookings.normalise(B.bookings(spark, folder)))


@query
def dq_iot(spark, folder):
    as_of = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return quality.check_iot(iot.normalise(B.iot(spark, folder)), as_of)


@query
def dq_weather(spark, folder):
    return quality.check_weather(featured_weather(spark, folder))


# ---- sampling, scaling, measures ---------------------------------------------------------


def target_frame(spark, folder):
    return models.with_target(large_frame(spark, folder)).select("booking_id", "target")


@query
def stratified_split(spark, folder):
    split = sampling.split_flag(target_frame(spark, folder), ["booking_id"], 0.2, models.SPLIT_SEED)
    return split.select("booking_id", "target", "is_test")


def _balanced(spark, folder, factor):
    split = sampling.split_flag(target_frame(spark, folder), ["booking_id"], 0.2, models.SPLIT_SEED)
    train = split.where(~F.col("is_test"))
    return sampling.undersample(train, "target", ["booking_id"], factor, models.BALANCE_SEED).select("booking_id", "target")


@query
def balanced_train(spark, folder):
    return _balanced(spark, folder, models.MAJORITY_FACTOR)


@query
def balanced_train_even(spark, folder):
    """One row of the larger class per row of the smaller, so that rows really are left out."""
    return _balanced(spark, folder, 1.0)


@query
def label_encode(spark, folder):
    frame = large_frame(spark, folder).select("booking_id", *models.DELAY_CATEGORIES)
    missing = F.when(F.length("booking_id") % 10 != 0, F.col("cargo_type"))
    frame = frame.withColumn("cargo_type", missing)
    return encode.label_encode(frame, models.DELAY_CATEGORIES)


SCALED = ["speed_kmh", "engine_rpm", "battery_voltage"]


@query
def standard_scale(spark, folder):
    frame = featured_iot(spark, folder).withColumn("constant", F.lit(3.0))
    scaled = scaling.scale(frame, [*SCALED, "constant"])
    return scaled.select("event_id", *[rounded(c, 6).alias(c) for c in [*SCALED, "constant"]])


@query
def tier_scale(spark, folder):
    scaled = scaling.scale_by_group(featured_iot(spark, folder), SCALED, "vehicle_tier")
    return scaled.select("event_id", "vehicle_tier", *[rounded(c, 6).alias(c) for c in SCALED])


def scored_frame(spark, folder):
    """A fixed score in place of a model's: the weight-distance product against the delay flag."""
    frame = models.delay_features(large_frame(spark, folder), encode_categories=False)
    return frame.select(
        "booking_id", "priority", "target", F.col("cargo_stress_index").alias("score"), F.col("distance_cargo_risk").alias("score_b")
    )


@query
def class_weights(spark, folder):
    return metrics.class_weights(target_frame(spark, folder), "target")


@query
def confusion_metrics(spark, folder):
    return metrics.confusion(scored_frame(spark, folder), "target", "score", 20.0, by=["priority"])


@query
def auc(spark, folder):
    areas = metrics.roc_auc(scored_frame(spark, folder), "target", "score", by=["priority"])
    return areas.select("priority", rounded("auc", 9).alias("auc"))


@query
def classification_report(spark, folder):
    counts = metrics.confusion(scored_frame(spark, folder), "target", "score", 20.0)
    return metrics.classification_report(counts)


@query
def model_select(spark, folder):
    scored = scored_frame(spark, folder)
    both = scored.select(
        F.explode(
            F.array(
                F.struct(F.lit("stress").alias("model"), F.col("score").alias("s")),
                F.struct(F.lit("risk x 40").alias("model"), (F.col("score_b") * 40).alias("s")),
            )
        ).alias("m"),
        "target",
    ).select("m.model", "m.s", "target")
    counts = metrics.confusion(both, "target", "s", 20.0, by=["model"])
    areas = metrics.roc_auc(both, "target", "s", by=["model"])
    joined = counts.join(areas, "model").withColumn("auc_pct", rounded(F.col("auc") * F.lit(1e2), 2)).drop("auc")
    return metrics.select_best(joined)


@query
def contamination_cut(spark, folder):
    """Fixed score in place of the forest's: readings below the tier's expected share are flagged."""
    frame = featured_iot(spark, folder).withColumn("score", F.col("engine_health_score") + F.col("speed_kmh") / 7)
    stored = materialise(frame.select("event_id", "vehicle_tier", "score"))  # the cut reads its rows several times
    return anomaly.flag_lowest(stored, "score", "vehicle_tier", "is_low").select("event_id", "vehicle_tier", "is_low")


# ---- alarms and metrics ------------------------------------------------------------------

# name, metric, operator, threshold, statistic, period seconds, periods, missing data
EVENT_RULES = [
    ("Click-Low", "click", "<", 20.0, "Average", 300, 2, "notBreaching"),
    ("View-High", "view", ">", 30.0, "Average", 300, 2, "notBreaching"),
    ("Error-Missing", "error", "<", 5.0, "Average", 300, 1, "breaching"),
    ("Signup-Low", "signup", "<", 18.0, "Average", 3600, 1, "notBreaching"),
    ("Purchase-Spike", "purchase", ">", 150.0, "Sum", 3600, 2, "notBreaching"),
]


@query
def metric_series(spark, folder):
    return shown(alarms.metric_series(B.metric_events(spark, folder)))


@query
def alarm_states(spark, folder):
    rules = alarms.rules_frame(spark, EVENT_RULES)
    return shown(alarms.alarm_states(B.metric_events(spark, folder), rules))


@query
def published_metrics(spark, folder):
    """The metric rows that need no model; ``metric_values`` has them all."""
    flagged = flagged_iot(spark, folder)
    large = large_frame(spark, folder)
    return alarms.metric_table(
        alarms.ingestion_rates(B.bookings(spark, folder), large),
        kpis.fleet_health(flagged, "confirmed_anomaly"),
        kpis.fleet_kpis(flagged),
        kpis.delivery_kpis(large),
    )


# ---- files -------------------------------------------------------------------------------


@query
def ingestion_manifest(spark, folder):
    return shown(readers.manifest(spark, folder))


# ---- models and anomalies ----------------------------------------------------------------


def training(spark, folder):
    """The one training that all model queries of a session share."""
    files = readers.file_listing(spark, folder, "*.parquet")
    return models.stored_training(files, lambda: models.delay_features(large_frame(spark, folder)), ["booking_id"], models.Settings())


@query
def delay_models(spark, folder):
    return training(spark, folder).results


@query
def feature_importance(spark, folder):
    return training(spark, folder).importances.orderBy(F.desc("importance"), "feature").limit(8)


@query
def ml_report(spark, folder):
    return reports.ml_report(training(spark, folder).results)


def detected(spark, folder):
    return anomaly.detect(materialise(featured_iot(spark, folder)))


@query
def iforest(spark, folder):
    columns = ["iso_forest_score", "iso_forest_anomaly", "confirmed_anomaly", "anomaly_severity"]
    return detected(spark, folder).select("event_id", "vehicle_id", "vehicle_tier", *columns)


@query
def iforest_rates(spark, folder):
    """Readings and flagged ones per tier: the flagged share is the tier's expected one."""
    found = detected(spark, folder).groupBy("vehicle_tier")
    return found.agg(F.count(F.lit(1)).alias("readings"), F.sum(F.col("confirmed_anomaly").cast("bigint")).alias("flagged"))


@query
def lof(spark, folder):
    """Outlier factor and flag of every reading."""
    flagged = anomaly.lof_flags(materialise(featured_iot(spark, folder)), ["event_id"])
    return flagged.select("tier", "event_id", rounded("lof", 4).alias("lof"), "lof_anomaly")


@query
def anomaly_report(spark, folder):
    return reports.anomaly_report(materialise(detected(spark, folder)))


@query
def master_report(spark, folder):
    readings = materialise(flagged_iot(spark, folder))
    orders = materialise(large_frame(spark, folder))
    forecasts = clean_weather(spark, folder)
    return reports.master_report(readings, orders, "confirmed_anomaly", training(spark, folder).results, forecasts)


def landed_counts(spark, folder):
    """Files in all and per feed: the tables each feed is derived from."""
    name = F.element_at(F.split("path", "/"), -1)
    files = readers.file_listing(spark, folder, "*.parquet").withColumn("name", name)
    return quality.landed_files(files, {feed: F.col("name").isin(tables) for feed, tables in B.FEED_TABLES.items()})


def full_kpis(spark, folder):
    """The frames of the KPI table with the model's, and the acceptance checks on them, on landed files and on outputs.

    One landed file per feed is wanted here, since the test tables are single files.
    """
    flagged, large = materialise(flagged_iot(spark, folder)), materialise(large_frame(spark, folder))
    outcome = training(spark, folder)
    frames = [kpis.fleet_kpis(flagged), kpis.fleet_health(flagged, "confirmed_anomaly"), kpis.delivery_kpis(large), outcome.best()]
    outputs = {"Readings": flagged, "Bookings": large, "Weather": clean_weather(spark, folder), "Model Results": outcome.results}
    measured = quality.measures(kpis.kpi_summary(*frames)).unionByName(landed_counts(spark, folder)).unionByName(quality.outputs_present(outputs))
    rules = [*quality.ACCEPTANCE_RULES, *quality.landing_rules(list(B.FEED_TABLES), 1.0), *quality.output_rules(list(outputs))]
    return frames, quality.acceptance(measured, rules)


@query
def kpi_table(spark, folder):
    """All rows of the KPI table; ``kpi_summary`` holds those that need no model."""
    frames, checks = full_kpis(spark, folder)
    return kpis.kpi_summary(*frames, checks.agg(F.count_if(F.col("status") == "PASS").alias("checks_passed")))


@query
def metric_values(spark, folder):
    """All rows of the metric table; ``published_metrics`` holds those that need no model, with bookings as the only feed.

    Records count as ingested or processed over all three feeds.
    """
    flagged, large = materialise(flagged_iot(spark, folder)), materialise(large_frame(spark, folder))
    readings, forecasts = B.iot(spark, folder), B.weather(spark, folder)
    rates = alarms.feed_rates(
        [(B.bookings(spark, folder), "booking_id", large), (readings, "vehicle_id", flagged), (forecasts, "city", clean_weather(spark, folder))]
    )
    frames = [kpis.fleet_health(flagged, "confirmed_anomaly"), kpis.fleet_kpis(flagged), kpis.delivery_kpis(large)]
    return alarms.metric_table(rates, *frames, training(spark, folder).best())


@query
def acceptance_checks(spark, folder):
    """Pass or fail of the acceptance rules on landed files, rates, model measures and outputs."""
    return full_kpis(spark, folder)[1]


# ---- streams driven to completion over the test tables -----------------------------------


def _finished(spark, stream: DataFrame) -> DataFrame:
    """Run the stream over all that has landed, into a table in the shared folder, and read that."""
    folder = scratch_path(spark)
    feeds.parquet_sink(stream, f"{folder}/rows", f"{folder}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query
def stream_fleet_metrics(spark, folder):
    """All that has landed, then the end mark, which brings out the windows still open."""
    path = scratch_path(spark)
    metric = feeds.ending(spark, B.metrics_of(feeds.parquet_stream(spark, folder, "events.parquet")), f"{path}/end")
    windows = feeds.fleet_metrics(metric)
    feeds.parquet_sink(windows, f"{path}/rows", f"{path}/state").awaitTermination()
    feeds.end_stream(spark, metric, f"{path}/end")
    feeds.parquet_sink(windows, f"{path}/rows", f"{path}/state").awaitTermination()
    return shown(spark.read.schema(windows.schema).parquet(f"{path}/rows"))


@query
def stream_weather_features(spark, folder):
    """Streamed weather with the medians of a batch snapshot."""
    batch = B.weather(spark, folder)
    medians = impute.fit_medians(batch, weather.numeric_columns(batch))
    stream = B.weather_of(feeds.parquet_stream(spark, folder, "events.parquet"))
    return shown(_finished(spark, feeds.weather_features(stream, medians)))


@query
def stream_iot_features(spark, folder):
    """Streamed features with the medians of a batch snapshot."""
    medians = impute.fit_medians(B.iot(spark, folder), iot.numeric_columns(B.iot(spark, folder), "full"))
    stream = B.iot_of(feeds.parquet_stream(spark, folder, "events.parquet"))
    return shown(_finished(spark, feeds.iot_features(stream, medians)))


@query
def stream_iot_enriched(spark, folder):
    summary = enrich.weather_by_city(featured_weather(spark, folder))
    medians = impute.fit_medians(B.iot(spark, folder), iot.numeric_columns(B.iot(spark, folder), "full"))
    stream = B.iot_of(feeds.parquet_stream(spark, folder, "events.parquet"))
    joined = feeds.enriched_iot(feeds.iot_features(stream, medians), summary)
    return shown(_rounded_doubles(_finished(spark, joined), IOT_MEANS))


@query
def stream_first_orders(spark, folder):
    """Order ids streamed as bookings and kept once (each line item repeats its order's id)."""
    items = feeds.parquet_stream(spark, folder, "lineitem.parquet")
    sent = items.select(
        F.concat(F.lit("BK"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("booking_id"),
        F.col("l_shipdate").cast("timestamp").alias("booking_timestamp"),
    )
    return _finished(spark, feeds.first_bookings(sent, "100000 days").select("booking_id"))
