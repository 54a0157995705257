"""The three feeds, derived from the test tables (orders, line items, events and their dimensions).

Dirt is deliberate: lower case, padding, duplicates, missing and out-of-range values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulyard.constants import CITIES, CONDITION_RISK

BOOKING_ORDER = ["l_partkey", "l_suppkey"]
FEED_TABLES = {
    "Bookings": ["lineitem.parquet", "orders.parquet", "customer.parquet", "supplier.parquet", "part.parquet", "nation.parquet"],
    "IoT": ["events.parquet"],
    "Weather": ["events.parquet"],
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bookings(spark: SparkSession, folder: str) -> DataFrame:
    """One booking row per line item."""
    item, order, customer, supplier, part, nation = (
        table(spark, folder, n) for n in ("lineitem", "orders", "customer", "supplier", "part", "nation")
    )
    origin = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin_city"))
    target = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("destination_city"))
    # line items are shuffled for parts and orders only, while their rows are narrow; customers meet the fewer orders first
    owners = order.join(customer.select("c_custkey", "c_name", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        item.join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(owners, item.l_orderkey == order.o_orderkey)
        .join(origin, "s_nationkey")
        .join(target, "c_nationkey")
    )
    conditions = ", ".join(f"'{c}'" for c in CONDITION_RISK)
    risks = ", ".join(f"{r}D" for r in CONDITION_RISK.values())
    express = "o_orderpriority = '1-URGENT'"
    distance = "CAST(CASE WHEN s_nationkey = c_nationkey THEN 0 ELSE 100 + (s_nationkey * 37 + c_nationkey * 91) % 750 END AS DOUBLE)"
    return joined.selectExpr(
        "concat('bk', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), ' ') AS booking_id",
        "c_name AS customer_name",
        "origin_city",
        "destination_city",
        "concat(' ', p_type) AS cargo_type",
        "l_quantity * 240 AS cargo_weight_kg",
        "l_extendedprice * 5 AS cargo_value_inr",
        "concat('V-', lpad(CAST((l_suppkey * 7) % 50 + 1 AS STRING), 3, '0')) AS assigned_vehicle_id",
        "CAST(o_orderdate AS TIMESTAMP) AS booking_timestamp",
        "CAST(l_shipdate AS TIMESTAMP) AS estimated_delivery",
        """CASE WHEN l_returnflag = 'R' THEN 'delayed'
                WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'DELIVERED'
                WHEN l_returnflag = 'A' THEN 'IN_TRANSIT'
                WHEN l_linestatus = 'F' THEN 'BOOKED'
                WHEN o_orderstatus = 'P' THEN 'CANCELLED'
                ELSE 'DELIVERED' END AS delivery_status""",
        f"{distance} AS distance_km",
        f"""CASE WHEN s_nationkey = c_nationkey THEN 0D
                 ELSE CAST({distance} * (18 + l_partkey % 15) + CASE WHEN {express} THEN 5000 ELSE 0 END AS DOUBLE)
                 END AS freight_charge_inr""",
        f"CASE WHEN {express} THEN 'EXPRESS' ELSE 'NORMAL' END AS priority",
        "l_linenumber % 5 < 3 AS is_insured",
        f"element_at(array({conditions}), CAST(s_nationkey % 7 + 1 AS INT)) AS origin_weather",
        f"CASE WHEN l_linenumber <> 7 THEN element_at(array({risks}), CAST(s_nationkey % 7 + 1 AS INT)) END AS origin_delay_risk",
        "CAST(s_nationkey % 7 >= 4 AS INT) AS origin_has_severe",
        "l_partkey",
        "l_suppkey",
        "s_nationkey",
    )


def typed_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as a typed CSV would bring it: upper-case statuses, one with a space, tidy ids."""
    return bookings(spark, folder).withColumns(
        {
            "booking_id": F.upper(F.trim("booking_id")),
            "cargo_type": F.trim("cargo_type"),
            "delivery_status": F.replace(F.upper("delivery_status"), F.lit("IN_TRANSIT"), F.lit("IN TRANSIT")),
        }
    )


def _city_of(index: str) -> str:
    names = ", ".join(f"'{name}'" for name, _, _ in CITIES)
    return f"element_at(array({names}), CAST({index} % 8 + 1 AS INT))"


def bridged_bookings(df: DataFrame) -> DataFrame:
    """Origins renamed to the weather feed's cities; nations from 24 on stay unmatched."""
    return df.withColumn("origin_city", F.expr(f"CASE WHEN s_nationkey < 24 THEN {_city_of('s_nationkey')} ELSE origin_city END"))


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"


def iot(spark: SparkSession, folder: str) -> DataFrame:
    return iot_of(table(spark, folder, "events"))


def iot_of(events: DataFrame) -> DataFrame:
    """One reading per event (batch or stream); ``event_id`` stays as the unique key."""
    number = "((user_id * 7) % 50 + 1)"
    return events.selectExpr(
        "event_id",
        f"concat('v-', lpad(CAST({number} AS STRING), 3, '0')) AS vehicle_id",
        f"CASE WHEN {number} <= 17 THEN 'old' WHEN {number} <= 35 THEN 'mid' ELSE 'new' END AS vehicle_tier",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "15e0 + (event_id * 13 % 650) / 1e2 AS gps_latitude",
        "725e-1 + (event_id * 29 % 800) / 1e2 AS gps_longitude",
        "value AS speed_kmh",
        f"CAST({_K} AS DOUBLE) AS fuel_level_pct",
        f"CAST({_K} % 7 AS DOUBLE) AS fuel_consumed_L",
        f"60e0 + {_K} * 8e-1 AS engine_temp_C",
        "CAST(500 + (event_id * 37) % 4500 AS DOUBLE) AS engine_rpm",
        "115e-1 + (event_id % 34) / 1e1 AS battery_voltage",
        "28e0 + (event_id % 100) / 1e1 AS tyre_pressure_psi",
        "CAST(500 + (event_id * 53) % 9500 AS DOUBLE) AS cargo_weight_kg",
        "CASE WHEN event_type = 'error' THEN 'warn' WHEN event_type <> 'signup' THEN 'ok' END AS brake_status",
        "event_type = 'error' AS alert_flag",
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return weather_of(table(spark, folder, "events"))


def weather_of(events: DataFrame) -> DataFrame:
    """One weather reading per event (batch or stream)."""
    conditions = ", ".join(f"'{c}'" for c in CONDITION_RISK)
    risks = ", ".join(f"{r}D" for r in CONDITION_RISK.values())
    return events.selectExpr(
        "event_id",
        f"lower({_city_of('event_id')}) AS city",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        f"element_at(array({conditions}), {_K} % 7 + 1) AS weather_condition",
        f"element_at(array({risks}), {_K} % 7 + 1) AS delay_risk_score",
        f"CAST(15 + {_K} % 34 AS DOUBLE) AS temperature_C",
        f"CAST({_K} + 5 AS DOUBLE) AS humidity_pct",
        "value / 5 AS wind_speed_kmh",
        "value / 4 AS rainfall_mm",
        f"CAST({_K} % 31 AS DOUBLE) AS visibility_km",
        f"{_K} % 7 = 5 AS fog_alert",
        "value / 4 > 50 AS flood_alert",
        f"CAST(({_K} * 3) % 120 AS DOUBLE) AS traffic_congestion",
    )


def metric_events(spark: SparkSession, folder: str) -> DataFrame:
    """Long metric table (ts, metric, value): the event type is the metric."""
    return metrics_of(table(spark, folder, "events"))


def metrics_of(events: DataFrame) -> DataFrame:
    return events.selectExpr("CAST(ts AS TIMESTAMP) AS ts", "event_type AS metric", "value")
