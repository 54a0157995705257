"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps.

Every step is one shuffle with partial aggregation and leaves at most as many edges as before. A node
with very many neighbours costs no single task more than its share: the minimum of its neighbours is a
partial aggregate, and the edges meet it in a join whose skewed keys adaptive execution splits. Each
round is written to the shared folder, so lost executors cost one round and the plan stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulyard.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a, b) with a > b.

    Large: every greater neighbour of a node is tied to the node's least neighbour (or itself).
    Small: a node and its lesser neighbours are tied to the least of them.
    """
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    tied = around.join(least, "u")
    if large:
        out = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b): the root is the least node that can be reached.

    Edges may repeat, stand in any direction or be loops; nodes without another node are left out.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    now = materialise(now)
    state = None
    while True:
        now = materialise(_star(_star(now, large=True), large=False))
        # settled when every edge ends in a node that is nobody's child and no node has two parents
        row = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (row.n, row.h) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (row.n, row.h)
