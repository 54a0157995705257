"""Exact quantiles of columns of any size, without holding a column's values in one place.

The built-in exact percentile keeps a map of all distinct values in one task. Here

1. a quantile sketch per group of tasks gives, for each wanted quantile, two values that surely
   enclose it;
2. while too many values lie between them, their counts in equal steps narrow the interval;
3. the few distinct values left are counted and the wanted ranks are read off.

Every step is one aggregation with partial sums, so it shuffles a few rows per task, and the driver
sees bounded results only. A column with few distinct values is done after step 1. Infinite values are
values like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 1000  # rank error of the sketch: 1/ACCURACY of the rows
MARGIN = 2 / ACCURACY
TINY_GROUP = 4 * ACCURACY  # below this many rows the enclosing values are min and max
TASK_GROUPS = 256
STEPS = 1024
MAX_LISTED = 50_000  # distinct values listed per (group, column, quantile)
MAX_GROUPS = 1_000
LISTED_GROUP = 20_000  # rows of a group that one aggregate may list


class Step(NamedTuple):
    """Values of one equal step of an interval; step -1 holds everything below the interval."""

    index: int
    n: int
    low: float
    high: float


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: str | None = None,
    wanted: Callable[[object], Sequence[int]] | None = None,
) -> dict | None:
    """{group: {column: [quantile per prob]}} with linear interpolation; NULLs are ignored.

    Without ``by`` the only group is None. Rows whose group is NULL are ignored. A column without
    values gives None entries. With more than MAX_GROUPS groups the answer is None: those are small
    groups for ``quantile_frame``. ``wanted`` names the places in ``probs`` that a group needs: no pass looks
    for the others, which are None.
    """
    columns = list(columns)
    source = df.where(F.col(by).isNotNull()) if by else df
    source = source.select(*([by] if by else []), *[F.col(c).cast("double").alias(c) for c in columns])
    sketches = _enclose(source, columns, probs, by)
    if sketches is None:
        return None

    result = {g: {c: [None] * len(probs) for c in columns} for g, _ in sketches}
    open_items, to_list = {}, {}
    for group, row in sketches:
        for ci, column in enumerate(columns):
            n = row[f"n_{ci}"]
            if not n:
                continue
            for pi in range(len(probs)) if wanted is None else sorted(set(wanted(group))):
                prob = probs[pi]
                low, high = row[f"low_{ci}_{pi}"], row[f"high_{ci}_{pi}"]
                if low == high:
                    result[group][column][pi] = low
                else:
                    target = to_list if n <= MAX_LISTED else open_items
                    target[(group, ci, pi)] = (low, high, (n - 1) * prob)
    while open_items or to_list:
        narrowed = _step_counts(source, columns, by, open_items) if open_items else {}
        for item, (low, high, rank) in list(open_items.items()):
            group, ci, pi = item
            lower, upper = _steps_of_ranks(narrowed[item], rank)
            if lower is not upper:
                # neighbouring ranks in different steps: the last value of one, the first of the other
                result[group][columns[ci]][pi] = _between(lower.high, upper.low, rank)
                del open_items[item]
            elif lower.low == lower.high:
                result[group][columns[ci]][pi] = lower.low
                del open_items[item]
            elif lower.n <= MAX_LISTED:
                to_list[item] = (lower.low, lower.high, rank)
                del open_items[item]
            else:
                open_items[item] = (lower.low, lower.high, rank)
        if to_list:
            listed = _value_counts(source, columns, by, to_list)
            for (group, ci, pi), (low, high, rank) in to_list.items():
                below, values = listed[(group, ci, pi)]
                result[group][columns[ci]][pi] = _interpolate(below, values, rank)
            to_list = {}
    return result


def _enclose(source: DataFrame, columns: list[str], probs: Sequence[float], by: str | None):
    """Per group the value counts and enclosing values; None when there are too many groups.

    Sketches are merged within groups of tasks and combined by min/max. That still encloses the
    quantile: in no group of tasks are more than the wanted share of rows below its own lower mark.
    """
    marks = [m for p in probs for m in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))]
    aggs = []
    for ci, c in enumerate(columns):
        aggs += [
            F.count(c).alias(f"n_{ci}"),
            F.min(c).alias(f"min_{ci}"),
            F.max(c).alias(f"max_{ci}"),
            F.percentile_approx(c, [float(m) for m in marks], ACCURACY).alias(f"marks_{ci}"),
        ]
    task_group = (F.spark_partition_id() % TASK_GROUPS).alias("_task_group")
    parts = source.groupBy(*([by] if by else []), task_group).agg(*aggs)

    joined = []
    for ci in range(len(columns)):
        tiny = F.col(f"n_{ci}") <= TINY_GROUP
        joined.append(F.sum(f"n_{ci}").alias(f"n_{ci}"))
        for pi, p in enumerate(probs):
            low_mark, high_mark = F.col(f"marks_{ci}")[2 * pi], F.col(f"marks_{ci}")[2 * pi + 1]
            low = F.when(tiny | F.lit(p <= MARGIN), F.col(f"min_{ci}")).otherwise(low_mark)
            high = F.when(tiny | F.lit(p >= 1 - MARGIN), F.col(f"max_{ci}")).otherwise(high_mark)
            joined += [F.min(low).alias(f"low_{ci}_{pi}"), F.max(high).alias(f"high_{ci}_{pi}")]
    if not by:
        return [(None, parts.agg(*joined).first())]
    rows = parts.groupBy(by).agg(*joined).limit(MAX_GROUPS + 1).collect()
    return None if len(rows) > MAX_GROUPS else [(r[by], r) for r in rows]


def quantile_frame(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str, wanted: Callable[[object], Sequence[int]] | None = None
) -> DataFrame:
    """The same quantiles as a join side (group, array per column), for any number of groups and rows in them.

    Groups of at most LISTED_GROUP rows are sorted inside one aggregate each. Larger ones, of which there
    can be no more than the rows divided by that, go through ``exact_quantiles``, MAX_GROUPS at a time.
    Both read the same ranks and interpolate alike. With ``wanted`` a group's other places may be null.
    """
    columns = list(columns)
    spark = df.sparkSession
    source = df.where(F.col(by).isNotNull()).select(F.col(by), *[F.col(c).cast("double").alias(c) for c in columns])
    sizes = source.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    large = [r[by] for r in sizes.where(F.col("_n") > LISTED_GROUP).select(by).toLocalIterator()]
    names = spark.createDataFrame([(g,) for g in large], df.select(by).schema)
    small = source.join(names, by, "left_anti") if large else source
    lists = small.groupBy(by).agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in columns])
    out = lists.select(by, *[_of_sorted(c, probs).alias(c) for c in columns])
    for at in range(0, len(large), MAX_GROUPS):
        block = large[at : at + MAX_GROUPS]
        found = exact_quantiles(source.where(F.col(by).isin(block)), columns, probs, by, wanted)
        schema = T.StructType([df.schema[by], *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in columns]])
        out = out.unionByName(spark.createDataFrame([(g, *[v[c] for c in columns]) for g, v in found.items()], schema))
    return out


def _of_sorted(values: str, probs: Sequence[float]) -> Column:
    """The quantiles of a sorted array, as ``_between`` reads them."""
    items = []
    for prob in probs:
        rank = (F.size(values) - 1) * F.lit(float(prob))
        low, high = (F.get(F.col(values), f(rank).cast("int")) for f in (F.floor, F.ceil))
        share = rank - F.floor(rank)
        items.append(F.when((low == high) | (share == 0), low).otherwise(low + (high - low) * share))
    return F.array(*items)


def _inside(source: DataFrame, columns: list[str], by: str | None, items: dict) -> DataFrame:
    """Rows (_item, _value, _low, _high) of the values up to each item's upper bound."""
    spark = source.sparkSession
    keys = list(items)
    bounds = [(k, g if g is None else str(g), ci, *map(float, items[(g, ci, pi)][:2])) for k, (g, ci, pi) in enumerate(keys)]
    bounds = spark.createDataFrame(bounds, "_item int, _group string, _column int, _low double, _high double")
    pairs = F.explode(F.array(*[F.struct(F.lit(ci).alias("c"), F.col(c).alias("v")) for ci, c in enumerate(columns)]))
    group = F.col(by).cast("string") if by else F.lit(None).cast("string")
    long = (
        source.select(group.alias("_g"), pairs.alias("_p"))
        .select("_g", F.col("_p.c").alias("_c"), F.col("_p.v").alias("_value"))
        .where(F.col("_value").isNotNull())
    )
    same = (F.col("_c") == F.col("_column")) & F.col("_g").eqNullSafe(F.col("_group"))
    # one row per wanted quantile: at most groups x columns x probs rows, counted above
    return long.join(F.broadcast(bounds), same).where(F.col("_value") <= F.col("_high"))


def _step_counts(source: DataFrame, columns: list[str], by: str | None, items: dict) -> dict:
    """Per item the steps that hold values, in order."""
    value, low, high = F.col("_value"), F.col("_low"), F.col("_high")
    position = (value - low) / (high - low) * F.lit(float(STEPS))
    # an interval with an infinite end is first cut into its infinite and its finite values
    endless = (low == F.lit(float("-inf"))) | (high == F.lit(float("inf")))
    ends = F.when(value == F.lit(float("-inf")), 0).when(value == F.lit(float("inf")), 2).otherwise(1)
    step = F.when(value < low, -1).when(endless, ends).otherwise(F.least(position.cast("int"), F.lit(STEPS - 1)))
    rows = (
        _inside(source, columns, by, items)
        .groupBy("_item", step.alias("_step"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("_value").alias("low"), F.max("_value").alias("high"))
        .collect()
    )
    keys = list(items)
    found = {k: [] for k in keys}
    for r in rows:
        found[keys[r["_item"]]].append(Step(r["_step"], r["n"], r["low"], r["high"]))
    return {k: sorted(v) for k, v in found.items()}


def _steps_of_ranks(steps: list[Step], rank: float) -> tuple[Step, Step]:
    """The steps holding the two ranks next to ``rank``. One step is strictly narrower than its interval."""
    wanted, found, seen = [math.floor(rank), math.ceil(rank)], [], 0
    for step in steps:
        begin, seen = seen, seen + step.n
        found += [step for r in wanted if begin <= r < seen and step.index >= 0]
    if len(found) != 2:
        raise AssertionError("quantile not enclosed")
    return found[0], found[1]


def _value_counts(source: DataFrame, columns: list[str], by: str | None, items: dict) -> dict:
    """Per item the rows below the interval and the sorted (value, count) pairs inside it."""
    value = F.when(F.col("_value") >= F.col("_low"), F.col("_value"))
    rows = (
        _inside(source, columns, by, items)
        .groupBy("_item", value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    keys = list(items)
    found = {k: [0, []] for k in keys}
    for r in rows:
        entry = found[keys[r["_item"]]]
        if r["value"] is None:
            entry[0] = r["n"]
        else:
            entry[1].append((r["value"], r["n"]))
    return {k: (below, sorted(values)) for k, (below, values) in found.items()}


def _interpolate(below: int, values: list, rank: float) -> float:
    first, second = math.floor(rank), math.ceil(rank)
    seen, low, high = below, None, None
    for value, n in values:
        begin, seen = seen, seen + n
        if begin <= first < seen:
            low = value
        if begin <= second < seen:
            high = value
    return _between(low, high, rank)


def _between(low: float, high: float, rank: float) -> float:
    """Linear between two neighbours; equal ones, infinite ones too, are their own answer."""
    share = rank - math.floor(rank)
    return low if low == high or not share else low + (high - low) * share
