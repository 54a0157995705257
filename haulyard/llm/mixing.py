"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share, by weight, of all words; targets stop at ``most`` times the source's
size and the excess goes to the others by weight. The ratio of target to size says how many copies of
each document are expected: the whole part are certain copies of every document, the fraction is the
inclusion probability p of one more. For that one, documents are ranked by random odds over inclusion
odds, u/(1-u) : p/(1-p), with u a hash of the document's key, and taken in that order until the words
still wanted are reached (the cut that comes nearest). Reruns agree on any number of machines.

The cut is found without sorting a source in one task: rank values fall into equal buckets, bucket
sizes are partial aggregates, and only the rows of the one bucket that holds the cut are ordered.

``emphasis`` names an optional positive column: expected copies are proportional to it within the
source (up to ``most``), which makes the probabilities unequal inside a source too.

Defined cases: a null text has size 0 and is taken 0 times its size; a source of size 0 has target 0.
The null source comes last. Rows with the same key and size are ranked
alike and are all in or all out. Null or non-positive emphasis counts as 1. An empty table gives an
empty result. Input columns with the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulyard.llm.frames import col, others
from haulyard.session import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 5
BUCKETS = 4096
RESULTS = ("size", "source_size", "target", "copies", "taken")
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) from the first 13 hexadecimal digits of a hash of the key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**13))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Sources reach their limit in the order of limit per weight: source k is at its limit when the
    words that the sources from k on still share by weight would give it more than that.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    named = sizes.select("source", "source_size", weight.cast("long").alias("w"), (F.col("source_size") * most).alias("limit"))
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - (F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit"))
    share = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = named.select("*", left.alias("left"), share.alias("share"))
    levels = levels.withColumn("full", F.col("limit") * F.col("share") <= F.col("left") * F.col("w"))
    # all sources that are not full share what the first of them finds left
    open_left = F.max(F.when(~F.col("full"), F.struct("share", "left"))).over(every)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        open_left["left"].cast("double") * F.col("w") / open_left["share"]
    )
    return levels.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST,
    seed: int = SEED, emphasis: str | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies x size).

    The text is kept when ``text`` is still among the columns wanted; pass a narrower frame with the
    column ``size`` already counted (and ``text=None``) to leave it out.
    """
    plain = others(docs, list(RESULTS))
    size = F.col("size").cast("long") if text is None else words(col(text))
    factor = F.when(col(emphasis) > 0, col(emphasis)).otherwise(1.0).cast("double") if emphasis else F.lit(1.0)
    name = F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("null"))
    sized = materialise(docs.select(*[col(c) for c in plain], size.alias("size"), name.alias("_source"), uniform(col(key), seed).alias("_u"), factor.alias("_e")))

    groups = materialise(sized.groupBy("_source").agg(F.first(col(source)).alias("source"), F.sum("size").alias("source_size"), F.sum(F.col("_e") * F.col("size")).alias("_pull")))
    named = groups.select(F.col("source").alias("_s"), "_source", "_pull")
    plan = targets(groups.select("source", "source_size"), weights, most).join(named, F.col("source").eqNullSafe(F.col("_s")))
    plan = materialise(plan.select("_source", "source_size", "target", "_pull"))

    even = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    uneven = F.when(F.col("_pull") > 0, F.least(F.lit(float(most)), F.col("target") * F.col("_e") / F.col("_pull"))).otherwise(0.0)
    rated = sized.join(plan, "_source").withColumn("_expected", even if emphasis is None else uneven)
    rated = rated.withColumn("_whole", F.floor("_expected"))
    p, u = F.col("_expected") - F.col("_whole"), F.col("_u")
    rated = rated.withColumn("_q", F.when(p > 0, (u / (1 - u)) / (p / (1 - p))))
    rated = rated.withColumn("_bucket", F.floor(F.col("_q") / (1 + F.col("_q")) * buckets))
    rated = rated.withColumn("_place", F.when(F.col("_q").isNotNull(), F.struct("_q", col(key).alias("k"), "size")))

    # words per bucket of the rank value; certain copies are counted against the target first
    parts = rated.groupBy("_source", "_bucket").agg(F.sum("size").alias("n"), F.sum(F.col("_whole") * F.col("size")).alias("sure"), F.first("target").alias("target"))
    every = Window.partitionBy("_source")
    parts = parts.withColumn("_wanted", F.col("target") - F.sum("sure").over(every)).where(F.col("_bucket").isNotNull())
    parts = parts.withColumn("_before", F.sum("n").over(every.orderBy("_bucket")) - F.col("n")).where(F.col("_before") < F.col("_wanted"))
    cut = parts.groupBy("_source").agg(F.max(F.struct("_bucket", "_before", "_wanted")).alias("c"))
    cut = materialise(cut.select("_source", F.col("c._bucket").alias("_cut"), "c._before", "c._wanted"))

    # in the bucket of the cut, a row is in when the middle of its words lies before the wanted number
    edge = rated.select("_source", "_bucket", "_place", "size").join(cut, "_source").where(F.col("_bucket") == F.col("_cut"))
    running = F.sum("size").over(every.orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    last = edge.withColumn("_middle", F.col("_before") + running - F.col("size") / 2).where(F.col("_middle") <= F.col("_wanted"))
    last = last.groupBy("_source").agg(F.max("_place").alias("_last"))
    cut = materialise(cut.select("_source", "_cut").join(last, "_source", "left"))

    placed = rated.join(cut, "_source", "left")
    more = (F.col("_bucket") < F.col("_cut")) | ((F.col("_bucket") == F.col("_cut")) & (F.col("_place") <= F.col("_last")))
    copies = F.col("_whole") + F.coalesce(more, F.lit(False)).cast("long")
    placed = placed.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return placed.select(*[col(c) for c in plain], *RESULTS)
