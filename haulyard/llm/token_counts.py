"""Token counts of flat token files by a separator scan.

A flat token file is nothing but token ids of two bytes (little-endian), one document after another, each
followed by the end-of-document id: no index, no lengths. Files are cut into blocks of ``BLOCK`` tokens; in
each, numpy finds the separators in one vectorised search. A block knows neither how many documents nor
where the last one began before it: that comes from prefix scans (running sums and maxima) over the blocks'
small summaries. A document that spans any number of blocks is so put together without being read again.

``write_flat`` makes such files: texts are tokenised with a public byte-pair vocabulary and written by Spark's
text sink with the two bytes of the separator as line separator, so every task writes one flat file, and one of its rows' keys.

Defined cases: a null or empty text is a document of 0 tokens. Tokens after a file's last separator are an
unfinished document (``ended`` false). Empty files have no documents. An odd last byte is no token.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulyard.llm.frames import col, slices
from haulyard.session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EOD = 50256
WIDTH = 2
BLOCK = 1 << 20
NO_KEY = b"-"  # stands for a null key; other keys are written in base 64
# fixed value: the split pattern the vocabulary was made with
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(vocabulary: bytes, pattern: str = PATTERN):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_flat(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, eod: int = EOD) -> tuple[str, str]:
    """Flat token files of ``docs`` under ``path``, one per partition, and beside each a file of its rows' keys in the same order.

    One task writes both files of its partition from the same rows and Spark commits them together, so they belong
    together however the rows came to the task. Returns the folders of the token files and of the key files.
    """
    with open(vocabulary, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        encode = encoder(sent.value).encode_ordinary
        place = 0
        for batch in batches:
            for rows, texts in slices(batch, batch.column(1)):
                tokens = [np.array(encode(t.decode("utf-8", "replace")), "<u2").tobytes() if t else b"" for t in texts]
                keys = [base64.b64encode(k) if k is not None else NO_KEY for k in rows.column(0).cast(pa.binary()).to_pylist()]
                at = pa.array(range(place, place + len(texts)), pa.int64())
                place += len(texts)
                for kind, values in (("tokens", tokens), ("keys", keys)):
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(texts)), at, pa.array(values, pa.binary())], ["kind", "place", "value"])

    named = docs.select(col(key).cast("string").alias("key"), col(text).alias("text"))
    lines = named.mapInArrow(run, "kind string, place long, value binary").sortWithinPartitions("kind", "place")
    mark = eod.to_bytes(WIDTH, "little").decode("latin-1")
    out = lines.select("kind", F.col("value").cast("string").alias("value")).write.partitionBy("kind")
    out.option("lineSep", mark).option("encoding", "ISO-8859-1").text(path)
    return f"{path}/kind=tokens", f"{path}/kind=keys"


def keys_of(spark: SparkSession, path: str, eod: int = EOD) -> DataFrame:
    """(part, ordinal, key) of the key files under ``path``, the key as text."""
    files = spark.read.format("binaryFile").load(path).select(part_of(F.col("path")).alias("part"), "content")
    mark = eod.to_bytes(WIDTH, "little")

    def read(batches):
        for batch in batches:
            for part, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = content.split(mark)[:-1]
                for a in range(0, len(found), 50_000):
                    own = [None if k == NO_KEY else base64.b64decode(k).decode() for k in found[a : a + 50_000]]
                    n = len(own)
                    yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int64()), pa.array(range(a, a + n), pa.int64()), pa.array(own, pa.string())], ["part", "ordinal", "key"])

    return files.mapInArrow(read, "part long, ordinal long, key string")


def part_of(path):
    """The number of the task that wrote a file."""
    return F.regexp_extract(path, r"part-(\d+)-", 1).cast("long")


def blocks(spark: SparkSession, path: str, block: int = BLOCK, eod: int = EOD) -> DataFrame:
    """(file, block, n_tokens, ends): per block of a file the places of its separators, counted from the block's start."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("content") / (block * WIDTH)) - 1, F.lit(0)).cast("int"))
    cut = files.select("file", "content", F.explode(steps).alias("block"))
    cut = cut.select("file", "block", F.substring("content", F.col("block") * (block * WIDTH) + 1, F.lit(block * WIDTH)).alias("data"))

    def search(batches):
        for batch in batches:
            n_tokens, ends = [], []
            for data in batch.column(2).to_pylist():
                tokens = np.frombuffer(data, "<u2", len(data) // WIDTH)
                n_tokens.append(len(tokens))
                ends.append(np.flatnonzero(tokens == eod))
            arrays = [batch.column(0), batch.column(1), pa.array(n_tokens, pa.int64()), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "n_tokens", "ends"])

    return cut.mapInArrow(search, "file string, block int, n_tokens long, ends array<long>")


def documents(spark: SparkSession, path: str, block: int = BLOCK, eod: int = EOD) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended): every document in the flat files under ``path``, in the order of its file."""
    found = blocks(spark, path, block, eod)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # prefix scans over the blocks: tokens and separators so far, and where the open document began
    base = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    placed = found.select("file", "block", base.alias("base"), (base + F.col("n_tokens")).alias("stop"), F.transform("ends", lambda e: e + base).alias("ends"))
    placed = placed.withColumns({
        "ordinal": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
        "open": F.coalesce(F.max(F.array_max("ends") + 1).over(before), F.lit(0)),
        "last": F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))) == 1,
    })
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: e + 1))
    ended = F.zip_with(
        F.slice(starts, F.lit(1), F.size("ends")), "ends", lambda s, e: F.struct(s.alias("start"), (e - s).alias("n_tokens"), F.lit(True).alias("ended"))
    )
    tail = F.element_at(starts, -1)
    rest = F.when(
        F.col("last") & (tail < F.col("stop")),
        F.array(F.struct(tail.alias("start"), (F.col("stop") - tail).alias("n_tokens"), F.lit(False).alias("ended"))),
    ).otherwise(F.array().cast("array<struct<start:bigint,n_tokens:bigint,ended:boolean>>"))
    each = placed.select("file", "ordinal", F.posexplode(F.concat(ended, rest)).alias("k", "d"))
    return each.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "d.*")


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, **options) -> DataFrame:
    """(key, part, ordinal, start, n_tokens) per row of ``docs``, written to flat files and scanned.

    Documents find their keys in the key file that the same task wrote. A token file with more or fewer documents than keys raises an error.
    """
    spark = docs.sparkSession
    tokens, keys = write_flat(docs, scratch_path(spark), key, text, **options)
    if docs.limit(1).count() == 0:
        found, rows = spark.createDataFrame([], "part long, ordinal long, start long, n_tokens long, ended boolean"), spark.createDataFrame([], "part long, ordinal long, key string")
    else:
        found, rows = documents(spark, tokens, block).withColumn("part", part_of(F.col("file"))), keys_of(spark, keys)
    both = rows.withColumn("_row", F.lit(True)).join(found, ["part", "ordinal"], "full_outer")
    lost = F.raise_error(F.lit("a token file does not hold the rows of its partition")).cast("long")
    n_tokens = F.when(F.col("_row") & F.col("ended"), F.col("n_tokens")).otherwise(lost)
    return both.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "part", "ordinal", "start", n_tokens.alias("n_tokens"))
