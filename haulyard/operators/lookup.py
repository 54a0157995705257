"""Small join sides: broadcast only what was counted and found small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_SIDE_ROWS = 10_000


def small_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """``df`` as a broadcast side when it has at most ``max_rows`` rows, else ``df`` unchanged.

    At most ``max_rows + 1`` rows ever reach the driver. A small result comes back as a local
    relation of known size, so the aggregate behind it is not computed again by the join. A larger
    one is left to an ordinary shuffle join, where adaptive execution splits skewed keys.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
