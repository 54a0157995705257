"""Spelling variants of words: every pair of words one edit apart, by a bit-sliced position index.

The index of a set of words of one length has, for each position and letter, one bit per word: set where the
word has that letter there. A query reads its letters one by one and keeps two sets of words as bits: those that agree so far
(zero errors) and those that agree but for one edit. Each letter costs a few word-parallel operations for
64 words at once. For a word one letter longer than the query the one-error set is matched one position
further on, and is fed from the zero-error set at every step, as the extra letter may stand anywhere.

Two words of ``2 * EDGE`` letters or more that are one edit apart share their first or their last ``EDGE`` letters, since
the edit lies behind the first or before the last of them. So the vocabulary is dealt into blocks by length and the letters at
one end; the words of a block are indexed, and queries are these words and those one letter shorter. A pair
found at both ends counts at the first only. Blocks beyond ``TILE`` words are cut into tiles of index and queries
by hash, so a task's memory is bounded and no pair is lost. Tasks give each word's count and best neighbour, never the pairs.

Defined cases: a null or empty text has no words, a null key reads as an empty one where a word's damage is drawn. Repeated
rows count again. Ties in a form go to the least word in code-point order. Without words there are no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulyard.llm.frames import bounded, col, slices
from haulyard.session import materialise

EDGE = 3
SHORTEST = 2 * EDGE
FEWEST = 5  # occurrences of a word
MARGIN = 5  # times as frequent a form must be
DAMAGE = 199  # one of so many words loses a letter
TILE = 32_768  # words indexed or asked at once
LUMP = 40_000  # rows of small blocks handled in one group
HELD_WORDS = 300_000  # words a task counts before it hands them on
CELLS = 1 << 18  # numbers of 64 bits in one set of a run of queries

RUN = re.compile(r"[a-zÀ-ÿ]{%d,}" % SHORTEST)


def words_of(text: bytes | None, key: str, damage: int | None = DAMAGE) -> Counter:
    """The words of a text after damage, with their counts."""
    out = Counter()
    # bytes.lower() changes A-Z only; a greedy run of the least length or more is always the whole run
    for run, n in Counter(RUN.findall((text or b"").lower().decode("utf-8", "replace"))).items():
        if damage:
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < SHORTEST:
                    continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", fewest: int = FEWEST, damage: int | None = DAMAGE) -> DataFrame:
    """(word, n) of the words with ``fewest`` occurrences or more in all texts."""

    def count(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for rows, texts in slices(batch, batch.column(1)):
                for name, value in zip(rows.column(0).to_pylist(), texts):
                    held.update(words_of(value, name, damage))
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    named = docs.select(F.coalesce(col(key).cast("string"), F.lit("")).alias("key"), col(text).alias("text"))
    return named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def letters(words: list[str], size: int) -> np.ndarray:
    """Code points, one row per word of ``size`` letters."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, size)


class PositionIndex:
    """Bits per (position, letter) over words of one length."""

    def __init__(self, words: list[str]):
        self.n, self.length = len(words), len(words[0])
        codes = letters(words, self.length)
        self.alphabet = np.unique(codes)
        self.width = -(-self.n // 64)
        # one row of bits per letter, the last one, of no word, for letters that no word has
        self.bits = np.zeros((self.length, len(self.alphabet) + 1, self.width), np.uint64)
        place = np.searchsorted(self.alphabet, codes)
        at = np.arange(self.n)
        one = np.uint64(1) << (at % 64).astype(np.uint64)
        for position in range(self.length):
            np.bitwise_or.at(self.bits[position], (place[:, position], at // 64), one)
        self.all = np.zeros(self.width, np.uint64)
        np.bitwise_or.at(self.all, at // 64, one)

    def one_edit(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) by number, for all pairs exactly one edit apart; queries are as long as the words, or one letter shorter."""
        size = len(queries[0])
        codes = letters(queries, size)
        place = np.searchsorted(self.alphabet, codes)
        known = place < len(self.alphabet)
        place = np.where(known & (self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == codes), place, len(self.alphabet))
        step = max(1, CELLS // self.width)
        asked, found = [], []
        for a in range(0, len(queries), step):
            own = place[a : a + step]
            zero = np.broadcast_to(self.all, (len(own), self.width))
            if size == self.length:
                one = np.zeros((len(own), self.width), np.uint64)
                for i in range(size):
                    here = self.bits[i][own[:, i]]
                    one = (one & here) | (zero & ~here)
                    zero = zero & here
            else:
                one = zero  # the extra letter comes first
                for i in range(size):
                    zero = zero & self.bits[i][own[:, i]]
                    one = (one & self.bits[i + 1][own[:, i]]) | zero
            q, w = np.nonzero(one)
            bits = np.unpackbits(one[q, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k, b = np.nonzero(bits)
            asked.append(q[k] + a)
            found.append(w[k] * 64 + b)
        return np.concatenate(asked), np.concatenate(found)


def near_in_block(words: list[str], n: np.ndarray, indexed: np.ndarray, asking: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) by place in ``words``: all pairs one edit apart in a block, each once.

    ``indexed`` and ``asking`` are the places of the words to index (all of the block's length) and to ask for. Pairs of equal length
    come once, by the greater asking; where the block is of last letters, pairs that share the first ones are left to that block.
    """
    index = PositionIndex([words[i] for i in indexed.tolist()])
    found = []
    for size in (index.length, index.length - 1):
        own = asking[np.fromiter((len(words[i]) == size for i in asking.tolist()), bool, len(asking))]
        if not len(own):
            continue
        q, w = index.one_edit([words[i] for i in own.tolist()])
        a, b = own[q], indexed[w]
        if size == index.length or last:
            keep = [(len(words[i]) != len(words[j]) or words[i] > words[j]) and not (last and words[i][:EDGE] == words[j][:EDGE]) for i, j in zip(a.tolist(), b.tolist())]
            a, b = a[keep], b[keep]
        found.append((a, b))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (indexed[:0], indexed[:0])


def near_counts(vocabulary: DataFrame, tile: int = TILE, lump: int = LUMP) -> DataFrame:
    """(word, n_near, best) for the words of (word, n) with a near word; ``best`` is the near (-n, word) that comes first."""
    longer = [F.struct(F.lit(last).alias("last"), edge.alias("edge"), (F.length("word") + more).cast("int").alias("length")) for more in (0, 1) for last, edge in ((False, F.substring("word", 1, EDGE)), (True, F.substring("word", -EDGE, EDGE)))]
    rows = vocabulary.select("word", "n", F.explode(F.array(*longer)).alias("block")).select("word", "n", "block.*")
    block = ["last", "edge", "length"]
    large = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile).withColumn("pieces", F.ceil(F.col("size") / tile).cast("int")).drop("size")
    sized = rows.join(bounded(materialise(large), "edge"), block, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int")
    every = F.sequence(F.lit(0), F.col("pieces") - 1)
    is_long = F.length("word") == F.col("length")
    # a small block's row is indexed and asks; in a cut block each piece of the index meets each piece of the queries
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), is_long.alias("indexed"), F.lit(True).alias("asks")))
    asks = F.transform(every, lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(False).alias("indexed"), F.lit(True).alias("asks")))
    held = F.transform(every, lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(True).alias("indexed"), F.lit(False).alias("asks")))
    cut = F.when(F.col("pieces") == 1, single).when(is_long, F.concat(asks, held)).otherwise(asks)
    dealt = sized.select("word", "n", *block, F.explode(cut).alias("tile")).select("word", "n", *block, "tile.*")
    lumps = vocabulary.count() * 2 * len(longer) // lump + 1
    work = dealt.withColumn("lump", F.pmod(F.xxhash64(*block, "i", "j"), F.lit(lumps)))

    def compare(group: pa.Table) -> pa.Table:
        frame = group.to_pandas()
        total = Counter()
        best: dict[str, tuple[int, str]] = {}
        for key, part in frame.groupby(["last", "edge", "length", "i", "j"], sort=False):
            if len(part) < 2 or not part.indexed.any():
                continue
            words, n = part.word.tolist(), part.n.to_numpy()
            a, b = near_in_block(words, n, np.flatnonzero(part.indexed), np.flatnonzero(part.asks), key[0])
            for x, y in zip([*a.tolist(), *b.tolist()], [*b.tolist(), *a.tolist()]):
                total[words[x]] += 1
                rival = (-int(n[y]), words[y])
                if words[x] not in best or rival < best[words[x]]:
                    best[words[x]] = rival
        names = list(total)
        first = pa.StructArray.from_arrays([pa.array([best[w][0] for w in names], pa.int64()), pa.array([best[w][1] for w in names], pa.string())], ["less", "word"])
        return pa.table({"word": pa.array(names, pa.string()), "n_near": pa.array([total[w] for w in names], pa.int64()), "best": first})

    found = work.groupBy("lump").applyInArrow(compare, "word string, n_near long, best struct<less:long,word:string>")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word of (word, form).

    Each round doubles the way followed. A form occurs ``MARGIN`` times as often as its word, so ways are short and end.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = materialise(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = then.drop("moved")
        if not then.where("moved").take(1):
            return now


def variants(vocabulary: DataFrame, margin: int = MARGIN, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n)."""
    stored = materialise(vocabulary)
    near = near_counts(stored, **options)
    form_n = -F.col("best.less")
    formed = F.coalesce(form_n >= margin * F.col("n"), F.lit(False))
    found = stored.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.word")).alias("form"), F.when(formed, form_n).alias("form_n")
    )
    found = materialise(found)
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
