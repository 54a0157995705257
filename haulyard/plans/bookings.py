"""Bookings: cleaning and features.

Three named profiles exist side by side because their rules differ:
``full`` (cleaned feed), ``large`` (bulk feed: no required-field or positive-value filters, ids kept
as they are) and ``sql`` (typed feed with constant fills, SQL rounding and its own value classes).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.constants import HEAVY_CARGO_KG, HIGH_VALUE_INR, LONG_HAUL_KM, VALUE_EDGES, VALUE_LABELS
from haulyard.functions.columns import as_timestamp, clean_title, clean_upper, cut, flag, half_up, has, number, rounded, share_pct
from haulyard.operators.dedup import keep_first
from haulyard.operators.impute import filled, fit_medians

NUMERIC = [
    "cargo_weight_kg",
    "cargo_value_inr",
    "distance_km",
    "freight_charge_inr",
    "origin_delay_risk",
    "origin_has_severe",
]
UPPER = ["delivery_status", "priority"]
TITLE = ["origin_city", "destination_city", "cargo_type"]
REQUIRED = ["booking_id", "origin_city", "destination_city"]


def numeric_columns(df: DataFrame, profile: str) -> list[str]:
    return has(df, NUMERIC if profile == "full" else NUMERIC[:-1])


def _identity(df: DataFrame) -> dict[str, Column]:
    """What deciding between duplicates needs: the tidy key and real instants."""
    instants = has(df, ["booking_timestamp", "estimated_delivery"])
    return {"booking_id": clean_upper("booking_id")} | {c: as_timestamp(df, c) for c in instants}


def _numbers(numeric: list[str], medians: dict) -> dict[str, Column]:
    return {c: filled(c, medians) for c in numeric}


def _texts(df: DataFrame) -> dict[str, Column]:
    return {c: clean_upper(c) for c in has(df, UPPER)} | {c: clean_title(c) for c in has(df, TITLE)}


def normalise(df: DataFrame, profile: str = "full", medians: dict | None = None) -> DataFrame:
    """Coerced, filled and tidied columns in one projection; no row is dropped here."""
    numeric = numeric_columns(df, profile)
    if medians is None:
        medians = fit_medians(df, numeric)
    identity = _identity(df) if profile == "full" else {}
    return df.withColumns(_numbers(numeric, medians) | _texts(df) | identity)


def first_bookings(df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per booking: the earliest, then by ``tie_break``, then by all other columns."""
    lead = has(df, ["booking_timestamp", "estimated_delivery", *tie_break])
    rest = [] if tie_break else [c for c in df.columns if c not in {*lead, "booking_id"}]
    return keep_first(df, ["booking_id"], [*lead, *rest])


def clean(df: DataFrame, profile: str = "full", medians: dict | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per booking, normalise, then (full profile) drop invalid rows.

    Medians are those of the whole feed, duplicates included. An invalid first duplicate removes its
    booking, so the validity filter comes last. Text is tidied after the duplicates are gone: the
    survivor depends on key and times only, and fewer rows pay for it.
    """
    numeric = numeric_columns(df, profile)
    if medians is None:
        medians = fit_medians(df, numeric)
    keyed = df.withColumns(_identity(df)) if profile == "full" else df
    kept = first_bookings(keyed, tie_break)
    if profile == "full":
        kept = kept.na.drop(subset=REQUIRED)
    kept = kept.withColumns(_numbers(numeric, medians))
    if profile == "full":
        kept = kept.where(_positive())
    return kept.withColumns(_texts(kept))


def _positive() -> Column:
    return (F.col("distance_km") > 0) & (F.col("freight_charge_inr") > 0)


def run_summary(df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Rows in, duplicates and invalid rows removed (counted apart), rows out, and their rates."""
    kept = first_bookings(df.withColumns(_identity(df)), tie_break)
    numeric = numeric_columns(df, "full")
    kept = kept.withColumns(_numbers(numeric, fit_medians(df, numeric)) | _texts(kept))
    present = [F.col(c).isNotNull() for c in REQUIRED]
    valid = reduce(and_, present, F.coalesce(_positive(), F.lit(False)))
    totals = kept.agg(
        F.count(F.lit(1)).alias("_kept"),
        F.count_if(~valid).alias("invalid_removed"),
        F.count_if(valid).alias("rows_out"),
        F.count_if(valid & (F.col("delivery_status") == "DELAYED")).alias("delayed_orders"),
        F.count_if(valid & (F.col("priority") == "EXPRESS")).alias("express_orders"),
    )
    rows_in = df.agg(F.count(F.lit(1))).scalar()
    return (
        totals.withColumn("rows_in", rows_in)
        .withColumn("duplicates_removed", F.col("rows_in") - F.col("_kept"))
        .withColumn("delayed_pct", share_pct(F.col("delayed_orders"), F.col("rows_out")))
        .drop("_kept")
    )


def _long_haul() -> Column:
    return F.col("distance_km") > LONG_HAUL_KM


def _heavy() -> Column:
    return F.col("cargo_weight_kg") > HEAVY_CARGO_KG


def _flags() -> dict[str, Column]:
    return {
        "is_delayed": flag(F.col("delivery_status") == "DELAYED"),
        "is_express": flag(F.col("priority") == "EXPRESS"),
        "is_long_haul": flag(_long_haul()),
        "is_heavy_cargo": flag(_heavy()),
    }


def _revenue_per_km() -> Column:
    distance = F.col("distance_km")
    return rounded(F.col("freight_charge_inr") / F.when(distance == 0, 1.0).otherwise(distance), 2)


def features(df: DataFrame, profile: str = "full") -> DataFrame:
    """Delay, priority, haul and cargo flags, revenue per km, value class, weather-distance risk."""
    columns = _flags() | {
        "revenue_per_km": _revenue_per_km(),
        "cargo_value_category": cut("cargo_value_inr", VALUE_EDGES, VALUE_LABELS),
        "weather_distance_risk": rounded(F.col("origin_delay_risk") * F.col("distance_km") / F.lit(1e2), 2),
    }
    if profile == "full":
        columns["booking_hour"] = F.hour("booking_timestamp")
        columns["booking_day"] = F.date_format("booking_timestamp", "EEEE")
    return df.withColumns(columns)


def cargo_flags() -> dict[str, Column]:
    return {
        "is_high_value": flag(F.col("cargo_value_inr") > HIGH_VALUE_INR),
        "heavy_long_haul": flag(_heavy() & _long_haul()),
    }


def interactions(round_to=rounded) -> dict[str, Column]:
    """Products of distance, weight and priority."""
    distance, weight = F.col("distance_km"), F.col("cargo_weight_kg")
    express = flag(F.col("priority") == "EXPRESS")
    return {
        "cargo_stress_index": round_to(weight * distance / F.lit(1e5), 2),
        "distance_cargo_risk": round_to(distance * weight / F.lit(1e6), 4),
        "express_risk_score": round_to(express * distance / F.lit(1e2), 2),
    }


def sql_profile(df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """The typed-feed variant: dedup, positive filters, constant fills, SQL rounding."""
    kept = first_bookings(df, tie_break).where(_positive() & F.col("cargo_weight_kg").isNotNull())
    filled_frame = kept.na.fill(0.0, has(df, NUMERIC[:-1])).na.fill(0, has(df, ["origin_has_severe"]))
    tidy = filled_frame.withColumn("delivery_status", F.regexp_replace("delivery_status", " ", ""))
    value = F.col("cargo_value_inr")
    return tidy.withColumns(
        _flags()
        | cargo_flags()
        | {"revenue_per_km": half_up(F.col("freight_charge_inr") / F.col("distance_km"), 2)}
        | interactions(half_up)
        | {
            "cargo_value_category": F.when(value <= 50000, "LOW").when(value <= HIGH_VALUE_INR, "MEDIUM").otherwise("HIGH")
        }
    )


def zero_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce to numbers, missing becomes 0."""
    return df.withColumns({c: F.coalesce(number(c), F.lit(0.0)) for c in has(df, columns)})
