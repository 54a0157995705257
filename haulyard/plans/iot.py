"""Vehicle telemetry: cleaning and features (profiles ``full`` and ``large``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.constants import (
    FUEL_EDGES,
    FUEL_LABELS,
    SPEED_EDGES,
    SPEED_LABELS,
    TIER_LAST_NUMBER,
    TIERS,
)
from haulyard.functions.columns import as_timestamp, clean_upper, clip, cut, flag, has, rounded, truthy
from haulyard.operators.dedup import drop_repeats
from haulyard.operators.impute import filled, fit_medians

NUMERIC = [
    "speed_kmh",
    "fuel_level_pct",
    "fuel_consumed_L",
    "engine_temp_C",
    "engine_rpm",
    "battery_voltage",
    "tyre_pressure_psi",
    "cargo_weight_kg",
    "route_distance_km",
    "hour_of_day",
    "is_night_shift",
]
FULL_ONLY = ["odometer_km", "gps_latitude", "gps_longitude"]


def numeric_columns(df: DataFrame, profile: str) -> list[str]:
    return has(df, NUMERIC + FULL_ONLY if profile == "full" else NUMERIC)


def normalise(df: DataFrame, profile: str = "full", medians: dict | None = None) -> DataFrame:
    numeric = numeric_columns(df, profile)
    if medians is None:
        medians = fit_medians(df, numeric)
    columns: dict[str, Column] = {c: filled(c, medians) for c in numeric}
    if profile == "full":
        columns |= {c: as_timestamp(df, c, strict=True) for c in has(df, ["timestamp"])}
        columns |= {c: clean_upper(c) for c in has(df, ["vehicle_id", "vehicle_tier"])}
        columns |= {c: F.coalesce(F.upper(c), F.lit("UNKNOWN")) for c in has(df, ["brake_status", "ignition_status"])}
    return df.withColumns(columns)


def plausible() -> Column:
    return (F.col("speed_kmh") >= 0) & F.col("fuel_level_pct").between(0, 100) & F.col("engine_temp_C").between(50, 135)


def clean(df: DataFrame, profile: str = "full", medians: dict | None = None) -> DataFrame:
    """Full profile: normalise, drop repeated rows, keep plausible readings. Large: normalise only.

    The plausibility test looks at one row alone, so it commutes with the removal of equal rows and
    runs first: fewer rows reach the shuffle.
    """
    tidy = normalise(df, profile, medians)
    return drop_repeats(tidy.where(plausible())) if profile == "full" else tidy


def engine_health() -> Column:
    """0-100 score falling with temperature and engine speed, rising with battery voltage."""
    score = (
        F.lit(1e2)
        - (F.col("engine_temp_C") - 70) / 60 * 35
        - (F.col("engine_rpm") - 700) / 4300 * 25
        + (F.col("battery_voltage") - F.lit(11.5)) / F.lit(3.3) * 10
    )
    return rounded(clip(score, 0, 100), 1)


def alert_severity() -> Column:
    """The strongest matching level."""
    temperature = F.col("engine_temp_C")
    critical = (temperature > 108) | (F.col("fuel_level_pct") < 15)
    warning = truthy("alert_flag") | (F.col("brake_status") == "WARN") | (temperature > 100)
    return F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("NONE")


def features(df: DataFrame, profile: str = "full") -> DataFrame:
    consumed = F.col("fuel_consumed_L")
    columns = {
        "fuel_efficiency_kmpl": rounded(F.col("speed_kmh") / F.when(consumed == 0, F.lit(0.1)).otherwise(consumed), 2),
        "engine_health_score": engine_health(),
        "speed_category": cut("speed_kmh", SPEED_EDGES, SPEED_LABELS),
        "fuel_status": cut("fuel_level_pct", FUEL_EDGES, FUEL_LABELS),
        "is_old_truck": flag(F.col("vehicle_tier") == "OLD") if "vehicle_tier" in df.columns else F.lit(0),
    }
    if profile == "full":
        columns["alert_severity"] = alert_severity()
    return df.withColumns(columns)


def tier_from_id(vehicle_id: Column) -> Column:
    """Tier by vehicle number; NULL without a number or beyond the last range."""
    digits = F.regexp_extract(vehicle_id, r"([0-9]+)", 1)
    value = digits.try_cast("int")
    first, second, last = TIER_LAST_NUMBER
    return (
        F.when(value.between(1, first), TIERS[0])
        .when(value.between(first + 1, second), TIERS[1])
        .when(value.between(second + 1, last), TIERS[2])
    )
