"""Helpers the operators share: clashing names, Arrow batches in bounded slices, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 8 << 20  # text handled at once by a Python worker; a single longer text is handled alone
COLLECTED_ROWS = 200_000  # most rows an operator broadcasts or takes to the driver,
COLLECTED_BYTES = 16 << 20  # and most bytes of text in them


def col(name: str) -> Column:
    """A column by its exact name, also with dots or blanks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` that do not clash with ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def slices(batch: pa.RecordBatch, texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows with at most ``limit`` bytes of text (or one row), with the texts as bytes or None."""
    values = texts.cast(pa.binary()).to_pylist()
    start = held = 0
    for i, value in enumerate(values):
        n = len(value) if value else 0
        if i > start and held + n > limit:
            yield batch.slice(start, i - start), values[start:i]
            start, held = i, 0
        held += n
    if start < len(values):
        yield batch.slice(start), values[start:]


def add_columns(
    df: DataFrame, text: str, added: str, compute: Callable[[list, pa.RecordBatch], dict], drop: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with the columns ``added`` (DDL), computed per slice of rows from the texts as bytes.

    ``compute`` gets the texts and the slice and gives the values per added column. An added column
    takes the place of an input column of the same name.
    """
    new = T.StructType.fromDDL(added)
    keep = [c for c in others(df, new.names) if c not in drop]
    schema = T.StructType([df.schema[c] for c in keep] + list(new))
    kinds = {f.name: to_arrow_type(f.dataType) for f in new}
    at, n_columns = df.columns.index(text), df.columns
    kept = [n_columns.index(c) for c in keep]
    names = keep + new.names

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, batch.column(at)):
                found = compute(texts, part)
                arrays = [part.column(i) for i in kept] + [pa.array(found[n], kinds[n]) for n in kinds]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded(side: DataFrame, name: str) -> DataFrame:
    """``side`` to be broadcast if it is counted, and measured in its text column ``name``, to be small; else as it is."""
    row = side.agg(F.count(F.lit(1)), F.sum(F.octet_length(name))).first()
    return F.broadcast(side) if row[0] <= COLLECTED_ROWS and (row[1] or 0) <= COLLECTED_BYTES else side
