"""Fills for missing values: column median, median per group, constants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.functions.columns import number
from haulyard.operators.quantiles import exact_quantiles, quantile_frame
from haulyard.session import materialise


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of every column that has missing values.

    The numbers are stored first, so ``df`` itself is read once however many passes the medians take.
    Missing values are counted next: columns without any need no median.
    """
    columns = list(columns)
    if not columns:
        return {}
    values = materialise(df.select(*[number(c).alias(c) for c in columns]))
    wanted = _with_gaps(values, columns)
    if not wanted:
        return {}
    return {c: q[0] for c, q in exact_quantiles(values, wanted, [0.5])[None].items()}


def _with_gaps(values: DataFrame, columns: Sequence[str]) -> list[str]:
    missing = values.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if missing[c]]


def filled(column: str, medians: dict[str, float | None]) -> Column:
    """The numeric column with missing values replaced by its fitted median."""
    value = number(column)
    median = medians.get(column)
    return value if median is None else F.coalesce(value, F.lit(float(median)))


def fill_medians(df: DataFrame, columns: Sequence[str], medians: dict | None = None) -> DataFrame:
    """Coerce the columns to numbers and fill gaps with their medians (fitted here unless given)."""
    if medians is None:
        medians = fit_medians(df, columns)
    return df.withColumns({c: filled(c, medians) for c in columns})


def fill_group_medians(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Fill gaps with the median of the row's group; rows without a group stay as they are."""
    columns = list(columns)
    values = df.withColumns({c: number(c) for c in columns})
    stored = materialise(values.select(by, *[c for c in columns if c != by])) if columns else values
    wanted = _with_gaps(stored, columns) if columns else []
    if not wanted:
        return values
    medians = quantile_frame(stored, wanted, [0.5], by)
    medians = medians.select(by, *[F.col(c)[0].alias(f"_median_{c}") for c in wanted])
    joined = values.join(medians, by, "left")
    kept = [F.coalesce(F.col(c), F.col(f"_median_{c}")).alias(c) if c in wanted else F.col(c) for c in df.columns]
    return joined.select(*kept)
