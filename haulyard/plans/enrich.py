"""Weather attached to telemetry (by nearest city) and to bookings (by origin), and route lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.constants import CITIES, ROUTE_KM
from haulyard.functions.geo import nearest_city
from haulyard.operators.lookup import small_side

AVERAGED = [
    "temperature_C",
    "humidity_pct",
    "delay_risk_score",
    "traffic_congestion",
    "visibility_km",
    "combined_risk_score",
]


def _city_groups(weather: DataFrame) -> DataFrame:
    """Sums per (city, condition, advisory): a few rows per task, all in fixed-width buffers.

    The first value in time is a text, whose aggregate would need sorted input; as a grouping key
    with the least time per group it stays a hash aggregate.
    """
    sums = [f(c).alias(f"_{n}_{c}") for c in AVERAGED for n, f in (("sum", F.sum), ("n", F.count))]
    return (
        weather.where(F.col("city").isNotNull())
        .groupBy("city", "weather_condition", "travel_advisory")
        .agg(*sums, F.max("is_severe_weather").alias("_severe"), F.min("timestamp").alias("_from"))
    )


def _first(value: str) -> Column:
    """The earliest non-missing text; equal times go to the smaller text, undated rows come last."""
    dated = F.struct(F.col("_from").isNull().alias("late"), F.col("_from").alias("at"), F.col(value).alias("v"))
    return F.min(F.when(F.col(value).isNotNull(), dated))["v"]


def _mean(column: str) -> Column:
    return F.try_divide(F.sum(f"_sum_{column}"), F.sum(f"_n_{column}"))


def weather_by_city(weather: DataFrame) -> DataFrame:
    """Per city: six means, first condition and advisory, worst severe flag."""
    return (
        _city_groups(weather)
        .groupBy(F.col("city").alias("nearest_city"))
        .agg(
            _mean("temperature_C").alias("avg_temp_C"),
            _mean("humidity_pct").alias("avg_humidity_pct"),
            _mean("delay_risk_score").alias("avg_delay_risk"),
            _mean("traffic_congestion").alias("avg_congestion"),
            _first("weather_condition").alias("weather_condition"),
            _mean("visibility_km").alias("avg_visibility_km"),
            F.max("_severe").alias("has_severe_weather"),
            _first("travel_advisory").alias("travel_advisory"),
            _mean("combined_risk_score").alias("combined_risk_score"),
        )
    )


def weather_by_origin(weather: DataFrame) -> DataFrame:
    """The narrower summary joined to bookings."""
    return (
        _city_groups(weather)
        .groupBy(F.col("city").alias("origin_city"))
        .agg(
            _first("weather_condition").alias("origin_weather_w"),
            _mean("delay_risk_score").alias("origin_delay_risk_w"),
            _mean("visibility_km").alias("origin_visibility_km"),
            _mean("traffic_congestion").alias("origin_congestion"),
            F.max("_severe").alias("origin_has_severe_w"),
            _mean("combined_risk_score").alias("origin_combined_risk"),
        )
    )


def with_nearest_city(iot: DataFrame) -> DataFrame:
    return iot.withColumn("nearest_city", nearest_city(F.col("gps_latitude"), F.col("gps_longitude")))


def enrich_iot(iot: DataFrame, summary: DataFrame) -> DataFrame:
    """Telemetry with its nearest city's weather.

    The nearest city is one of the listed cities, so only their summary rows can match: at most
    that many rows are broadcast whatever the weather feed holds.
    """
    listed = summary.where(F.col("nearest_city").isin([name for name, _, _ in CITIES]))
    return with_nearest_city(iot).join(F.broadcast(listed), "nearest_city", "left")


FILLED_NUMBERS = ["origin_delay_risk_w", "origin_visibility_km", "origin_congestion", "origin_combined_risk"]


def enrich_bookings(bookings: DataFrame, summary: DataFrame) -> DataFrame:
    """Bookings with their origin's weather; gaps get the column median and 'Unknown'.

    The median over all joined bookings is the median over origins weighted by their booking
    counts, so it needs a count per origin and not the joined rows. The severe flag keeps its gaps.
    """
    side = small_side(summary)
    counts = bookings.groupBy("origin_city").agg(F.count(F.lit(1)).alias("_n"))
    weighted = counts.join(side, "origin_city").agg(
        *[F.percentile(c, 0.5, F.col("_n")).alias(c) for c in FILLED_NUMBERS]
    )
    medians = weighted.first().asDict()
    fills = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items() if m is not None}
    fills["origin_weather_w"] = F.coalesce("origin_weather_w", F.lit("Unknown"))
    return bookings.join(side, "origin_city", "left").withColumns(fills)


def route_distance(df: DataFrame, origin: str = "origin_city", destination: str = "destination_city") -> DataFrame:
    """Add ``route_km`` from the fixed route list, in either direction; NULL when not listed.

    Both directions are rows of one broadcast list (two per route), so the either-way match stays
    an equi-join.
    """
    both = [(a, b, float(km)) for a, b, km in ROUTE_KM] + [(b, a, float(km)) for a, b, km in ROUTE_KM]
    table = df.sparkSession.createDataFrame(both, f"{origin} string, {destination} string, route_km double")
    return df.join(F.broadcast(table), [origin, destination], "left")
