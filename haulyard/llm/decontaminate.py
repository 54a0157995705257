"""Benchmark decontamination: documents and spans that repeat passages of an evaluation set.

Texts are lower-cased (A-Z) and cut into words: runs of ASCII letters, digits and all characters
beyond ASCII. The items' windows of ``window`` consecutive words (a shorter item is one window) form
a hash set that every task gets; tasks look up each window of a document there, by its whole
sequence of words, so a find is verified at once. A word inside any found window is hit.

The set is broadcast in parts of at most ``PART_BYTES`` of item text. Each part is one more step of
the same scan, chained behind the others: no shuffle, and memory that does not grow with the benchmark.

Defined cases: a text that is null, empty or without words has no words and no hits. An item without
words has no windows. Several items with one id count once; a missing id is the empty string.
Repeated documents each get their own row. Input columns with the names of results are replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulyard.llm.frames import add_columns, col

WINDOW = 13
PART_BYTES = 32 << 20
HIT_SHARE = 20  # a document is contaminated when at least one word in this many is hit

# every byte that is no part of a word becomes a blank; bytes from 0x80 on belong to characters beyond ASCII
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

FOUND = "n_words long, n_hit long, hit_words array<struct<start:long,end:long>>, items array<string>"


def words(data: bytes | None) -> list[bytes]:
    return data.translate(WORD_BYTES).split() if data else []


def windows_of(items: list[tuple[str, bytes]], window: int) -> tuple[dict, dict]:
    """The items' windows as (word numbers from 1 on, {length: {window as numbers: its items}})."""
    numbers: dict[bytes, int] = {}
    by_length: dict[int, dict[bytes, list[str]]] = {}
    for item, text in items:
        own = words(text)
        ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in own], np.int32)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            holders = by_length.setdefault(n, {}).setdefault(ids[i : i + n].tobytes(), [])
            if item not in holders:
                holders.append(item)
    return numbers, by_length


def found_in(texts: list[list[bytes]], numbers: dict, by_length: dict) -> list[tuple[list, set]]:
    """Per text, given as its words, the found windows as (start, end) and the ids of their items."""
    get = numbers.get
    # one sequence for all texts; the 0 after each keeps windows from reaching into the next
    ids = np.fromiter((x for own in texts for x in (*[get(w, 0) for w in own], 0)), np.int32)
    ends = np.cumsum([len(own) + 1 for own in texts])
    known = np.concatenate([[0], np.cumsum(ids > 0)])
    found = [([], set()) for _ in texts]
    for n, windows in by_length.items():
        if len(ids) < n:
            continue
        for i in np.flatnonzero(known[n:] - known[:-n] == n).tolist():
            holders = windows.get(ids[i : i + n].tobytes())
            if holders:
                k = int(np.searchsorted(ends, i, "right"))
                start = i - (int(ends[k - 1]) if k else 0)
                found[k][0].append((start, start + n))
                found[k][1].update(holders)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _step(df: DataFrame, text: str, windows, first: bool) -> DataFrame:
    def compute(texts, part):
        own = [words(t) for t in texts]
        found = found_in(own, *windows.value)
        before = [((), ())] * len(own)
        if not first:
            spans, items = (part.column(part.schema.names.index(n)).to_pylist() for n in ("hit_words", "items"))
            before = [([(s["start"], s["end"]) for s in a], b) for a, b in zip(spans, items)]
        spans = [merged([*a, *f]) for (a, _), (f, _) in zip(before, found)]
        return {
            "n_words": [len(w) for w in own],
            "n_hit": [sum(e - s for s, e in x) for x in spans],
            "hit_words": [[{"start": s, "end": e} for s, e in x] for x in spans],
            "items": [sorted({*b, *f}) for (_, b), (_, f) in zip(before, found)],
        }

    return add_columns(df, text, FOUND, compute)


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES
) -> DataFrame:
    """``docs`` with n_words, n_hit, the hit spans in words and the sorted ids of the items found."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(col(item_id).cast("string"), F.lit("")).alias("item"), col(item_text).cast("binary").alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    out = docs
    for k in range(parts):
        # at most about part_bytes of items reach the driver at a time
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k).collect()
        windows = spark.sparkContext.broadcast(windows_of([(r.item, bytes(r.text or b"")) for r in rows], window))
        out = _step(out, text, windows, first=k == 0)
    return out


def contaminated(hit_share: int = HIT_SHARE):
    """The rule on a scanned frame: enough of the words are hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * hit_share >= F.col("n_words"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones, in the columns of ``docs``."""
    marked = scan(docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(options.pop("text", "text")).alias("text")), benchmark, **options)
    return marked.where(~contaminated()).select("row.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words, and what stands between words of one span, cut out of the text."""
    own = docs.schema[text].dataType
    marked = scan(docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(text).alias("text")), benchmark, **options)

    def compute(texts, part):
        spans = part.column(part.schema.names.index("hit_words")).to_pylist()
        out = []
        for data, hit in zip(texts, spans):
            if hit:
                places = [m.span() for m in WORD.finditer(data)]
                pieces, at = [], 0
                for s in hit:
                    pieces.append(data[at : places[s["start"]][0]])
                    at = places[s["end"] - 1][1]
                data = b"".join([*pieces, data[at:]])
            out.append(data.decode("utf-8", "replace") if data is not None else None)
        return {"cut": out}

    cut = add_columns(marked, "text", "cut string", compute)
    return cut.select(*[F.col("cut").cast(own).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
