"""Weather and traffic: cleaning, features, and the deterministic lookups around conditions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.constants import (
    CONDITION_RISK,
    FOG_RISK_CITIES,
    FOG_RISK_EXTRA,
    RISK_EDGES,
    RISK_LABELS,
    SEVERE_CONDITIONS,
    UNKNOWN_CONDITION_RISK,
)
from haulyard.functions.columns import as_timestamp, clean_title, clean_upper, clip, cut, flag, has, rounded
from haulyard.operators.dedup import drop_repeats
from haulyard.operators.impute import filled, fit_medians

NUMERIC = [
    "temperature_C",
    "humidity_pct",
    "wind_speed_kmh",
    "rainfall_mm",
    "visibility_km",
    "delay_risk_score",
    "latitude",
    "longitude",
    "traffic_congestion",
    "usd_inr_rate",
]
LIMITS = {
    "humidity_pct": (0, 100),
    "delay_risk_score": (0, 100),
    "visibility_km": (0, 50),
    "traffic_congestion": (0, 100),
}


def numeric_columns(df: DataFrame) -> list[str]:
    return has(df, NUMERIC)


def normalise(df: DataFrame, medians: dict | None = None) -> DataFrame:
    numeric = numeric_columns(df)
    if medians is None:
        medians = fit_medians(df, numeric)
    columns: dict[str, Column] = {c: filled(c, medians) for c in numeric}
    columns |= {c: clip(columns[c], *limits) for c, limits in LIMITS.items() if c in columns}
    columns |= {c: clean_title(c) for c in has(df, ["city", "weather_condition", "road_condition"])}
    columns |= {c: clean_upper(c) for c in has(df, ["wind_direction"])}
    columns |= {c: as_timestamp(df, c) for c in has(df, ["timestamp"])}
    columns |= {c: F.col(c).try_cast("boolean") for c in has(df, ["fog_alert", "flood_alert"])}
    return df.withColumns(columns)


def clean(df: DataFrame, medians: dict | None = None) -> DataFrame:
    return drop_repeats(normalise(df, medians))


def travel_advisory(risk: Column) -> Column:
    return (
        F.when(risk >= 75, "DO NOT TRAVEL")
        .when(risk >= 50, "TRAVEL WITH CAUTION")
        .when(risk >= 20, "MINOR DELAYS EXPECTED")
        .otherwise("CLEAR TO TRAVEL")
    )


def heat_index() -> Column:
    humid = F.lit(0.33) * (F.col("humidity_pct") / 100) * F.lit(6.105)
    wind = F.lit(0.70) * (F.col("wind_speed_kmh") / F.lit(3.6))
    return rounded(F.col("temperature_C") + humid - wind - F.lit(4.0), 1)


def is_severe() -> Column:
    return flag(
        (F.col("rainfall_mm") > 30)
        | (F.col("wind_speed_kmh") > 50)
        | (F.col("visibility_km") < 2)
        | F.col("fog_alert")
        | F.col("flood_alert")
    )


def features(df: DataFrame) -> DataFrame:
    risk = F.col("delay_risk_score")
    return df.withColumns(
        {
            "weather_severity": cut(risk, RISK_EDGES, RISK_LABELS),
            "travel_advisory": travel_advisory(risk),
            "heat_index_C": heat_index(),
            "is_severe_weather": is_severe(),
            "combined_risk_score": rounded(risk * F.lit(0.6) + F.col("traffic_congestion") * F.lit(0.4), 1),
            "reading_hour": F.hour("timestamp"),
        }
    )


def condition_risk(condition: Column, city: Column) -> Column:
    """Nominal delay risk of a condition; fog counts more in two cities, at most 100."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(CONDITION_RISK.items())])
    base = F.coalesce(F.try_element_at(table, condition), F.lit(UNKNOWN_CONDITION_RISK))
    foggy = (condition == "Fog") & city.isin(FOG_RISK_CITIES)
    return F.when(foggy, F.least(base + FOG_RISK_EXTRA, F.lit(100))).otherwise(base)


def is_severe_condition(condition: Column) -> Column:
    return flag(condition.isin(SEVERE_CONDITIONS))


def road_condition(rain: Column) -> Column:
    return F.when(rain > 30, "Poor").when(rain > 10, "Moderate").otherwise("Good")


def delay_rule(weather: Column, risk: Column, distance: Column, weight: Column, priority: Column, cargo: Column) -> Column:
    """(rule, nominal share, outcome) of the last rule that matches a booking; 8 when none does."""

    def outcome(rule: int, share: float, status: str) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(share).alias("share"), F.lit(status).alias("status"))

    # Rule numbers, their conditions and nominal shares, strongest (last) first.
    return (
        F.when(cargo == "Pharmaceuticals", outcome(7, 0.75, "DELIVERED"))
        .when((distance < 200) & weather.isin("Clear", "Partly Cloudy"), outcome(6, 0.92, "DELIVERED"))
        .when((cargo == "Perishables") & (distance > 400), outcome(5, 0.70, "DELAYED"))
        .when((priority == "EXPRESS") & (weight > 9000), outcome(4, 0.80, "DELAYED"))
        .when((distance > 500) & (risk >= 40), outcome(3, 0.85, "DELAYED"))
        .when(weather == "Heavy Rain", outcome(2, 0.75, "DELAYED"))
        .when(weather.isin("Thunderstorm", "Fog"), outcome(1, 0.90, "DELAYED"))
        .otherwise(outcome(8, 0.45, "DELIVERED"))
    )
