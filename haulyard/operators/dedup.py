"""Duplicate removal with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``; NULL keys are one group.

    Spark trims every task's rows to one per key before the shuffle (window group limit), so a key
    held by a third of all rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def drop_repeats(df: DataFrame) -> DataFrame:
    """Remove rows equal in every column (NULLs compare equal)."""
    return df.dropDuplicates()
