"""Packing documents into sequences of a fixed number of tokens by best-two-fit.

Texts are tokenised with a public vocabulary, closed by an end id, and cut only if longer than a sequence. How
pieces share sequences depends on their lengths alone, and there are at most ``capacity`` different lengths. So
the counts per length (one number per length, whatever the size of the corpus) give the whole plan: a sequence
is filled greedily with the longest piece left that fits; then its smallest piece is taken out again if two
unpacked pieces fill the wider gap more tightly. The sequences that follow look the same as long as there are
pieces enough, so each step lays out as many equal sequences at once as the counts allow. That is what the method
gives sequence by sequence, in a number of steps bounded by the lengths, not by the pieces.

Every piece knows its number among the pieces of its length (its place in its task plus the pieces of the tasks
before), and looks up in the plan which sequence and place that number has. No piece is compared with another.

Defined cases: a null or empty text is the end id alone. Repeated rows are pieces of their own. A document of
exactly ``capacity`` tokens is one piece. Without rows there are no pieces. Columns of the input other than the
key and the text are not read; null keys stay null.
"""

from __future__ import annotations

import re
import zlib
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from haulyard.llm.frames import COLLECTED_ROWS, col, slices
from haulyard.session import materialise

CAPACITY = 2048
END = 0
CACHED_WORDS = 400_000  # words whose ids a task remembers,
CACHED_IDS = 4_000_000  # and most ids of them
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# the vocabulary always breaks between a letter or digit and one of these marks, so a blank may stand there
MARK = re.compile(rb"(?<=[a-z0-9])(?=[.,;:!?])")
# a word of lower-case letters only is one unit before merging: its normal form is itself
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in printable)
    return {b: 256 + i for i, b in enumerate(rest)}


class WordIds:
    """Token ids of texts, from a memory of the ids of words.

    The vocabulary drops white space and none of its patterns crosses it, so a text's ids are its words' ids, one
    after another. Words are split at ASCII blanks and before marks; only words not seen before go to the tokenizer, words of
    nothing but lower-case letters straight to its merges. Capitals A-Z are lowered before, as the vocabulary does itself, but
    for texts that may hold the name of a special token; those are left whole.
    """

    def __init__(self, vocabulary: bytes, end: int = END):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        self.merges = self.tokenizer.model
        self.letters = byte_letters()
        self.end = end
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.array([self.end], np.uint32)  # entry 0 is the end of a document
        self.starts = np.zeros(1, np.int64)
        self.sizes = np.ones(1, np.int64)

    def learn(self, words: set[bytes]) -> None:
        plain = [w for w in words if PLAIN.fullmatch(w)]
        other = list(words.difference(plain))
        found = [[t.id for t in self.merges.tokenize(w.decode() if w.isascii() else w.decode("latin-1").translate(self.letters))] for w in plain]
        found += [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in other], add_special_tokens=False)]
        first = len(self.known) + 1
        self.known.update(zip(plain + other, range(first, first + len(found))))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))])

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by the end id, and where each text's ids stop."""
        split = [(t if b"<|" in t else MARK.sub(b" ", t.lower())).split() if t else [] for t in texts]
        if len(self.known) > CACHED_WORDS or len(self.ids) > CACHED_IDS:
            self.clear()
        if new := set().union(*split).difference(self.known):
            self.learn(new)
        numbers: list[int] = []
        for words in split:
            numbers.extend(map(self.known.__getitem__, words))
            numbers.append(0)
        entries = np.array(numbers, np.int64)
        sizes = self.sizes[entries]
        stops = np.cumsum(sizes)
        flat = self.ids[np.repeat(self.starts[entries] - (stops - sizes), sizes) + np.arange(int(sizes.sum()))]
        return flat, stops[entries == 0]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY, end: int = END, ids: bool = True) -> DataFrame:
    """(key, piece, start, length, ids_crc32, [ids,] part, place): the pieces of every document.

    ``place`` numbers the pieces of one length within the task ``part`` that made them. Both only hold once the
    frame is stored, so callers write it before they read it twice. ``ids`` are little-endian 32-bit numbers.
    """
    with open(vocabulary or vocabulary_path(), "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[key].dataType
    added = "piece int, start long, length int, ids_crc32 long" + (", ids binary" if ids else "") + ", part long, place long"
    arrow = to_arrow_type(kind)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encode = WordIds(sent.value, end)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, texts in slices(batch, batch.column(1)):
                flat, stops = encode(texts)
                flat = flat.astype("<u4")
                starts = np.concatenate([[0], stops[:-1]])
                n = -(-(stops - starts) // capacity)
                row = np.repeat(np.arange(len(texts)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                first = starts[row] + piece * capacity
                last = np.minimum(first + capacity, stops[row])
                length = last - first
                # number the pieces of one length: by their order among equals here, after those seen before
                order = np.argsort(length, kind="stable")
                runs = length[order]
                place = np.empty(len(runs), np.int64)
                place[order] = np.arange(len(runs)) - np.searchsorted(runs, runs) + seen[runs]
                seen += np.bincount(length, minlength=capacity + 1)
                data = [flat[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]
                out = {
                    key: rows.column(0).take(pa.array(row)), "piece": pa.array(piece, pa.int32()), "start": pa.array(piece * capacity),
                    "length": pa.array(length, pa.int32()), "ids_crc32": pa.array([zlib.crc32(d) for d in data], pa.int64()),
                    **({"ids": pa.array(data, pa.binary())} if ids else {}), "part": pa.array([part] * len(row), pa.int64()), "place": pa.array(place),
                }
                yield pa.RecordBatch.from_arrays([out[key].cast(arrow), *list(out.values())[1:]], list(out))

    quoted = key.replace("`", "``")
    return docs.select(col(key), col(text)).mapInArrow(run, f"`{quoted}` {kind.simpleString()}, {added}")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many equal sequences, the lengths in one of them, longest first) that use up ``counts`` (pieces per length)."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        own: dict[int, int] = {}
        have = sum(1 << n for n in left)  # bit n: a piece of that length is left
        gap = capacity

        def take(n: int) -> None:
            nonlocal have
            own[n] = own.get(n, 0) + 1
            if own[n] == left[n]:
                have &= ~(1 << n)

        while fits := have & ((2 << gap) - 1):
            longest = fits.bit_length() - 1
            take(longest)
            gap -= longest
        least = min(own)
        if gap and sum(own.values()) > 1 and (pair := tightest_pair({n: c - own.get(n, 0) for n, c in left.items()}, gap + least, least + 1)):
            own[least] -= 1
            for n in pair:
                own[n] = own.get(n, 0) + 1
        own = {n: k for n, k in own.items() if k}
        times = min(left[n] // k for n, k in own.items())
        out.append((times, sorted((n for n, k in own.items() for _ in range(k)), reverse=True)))
        for n, k in own.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def tightest_pair(left: dict[int, int], gap: int, least: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the greatest sum from ``least`` to ``gap``; of equal sums the one with the longest piece."""
    lengths = np.array(sorted(n for n, c in left.items() if c > 0 and n < gap), np.int64)
    if not len(lengths):
        return None
    twice = np.array([left[n] > 1 for n in lengths.tolist()])
    at = np.searchsorted(lengths, gap - lengths, "right") - 1
    alone = (at == np.arange(len(lengths))) & ~twice
    at = np.where(alone, at - 1, at)
    sums = np.where(at >= 0, lengths + lengths[at], 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(lengths[best]), int(lengths[at[best]])) if sums[best] >= least else None


def layout(steps: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """The plan as a lookup: pieces of ``length`` from number ``first`` on lie in sequences ``base``, ``base + 1``, … (``times`` of them), from ``offset`` on."""
    rows, used, base = [], {}, 0
    for times, lengths in steps:
        offsets = dict(reversed(list(zip(lengths, accumulate(lengths, initial=0)))))
        for n, offset in offsets.items():
            rows.append((n, used.get(n, 0), base, times, offset))
            used[n] = used.get(n, 0) + lengths.count(n) * times
        base += times
    rows.sort()
    return dict(zip(("length", "first", "base", "times", "offset"), np.array(rows, np.int64).reshape(-1, 5).T))


def pack(stored: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``stored`` pieces (a table of ``pieces``) with ``sequence_id`` and ``offset``.

    Lengths per task are counted once. Their running sums over the tasks tell where a task's numbers begin; they
    are broadcast if few, else joined by task and length, a key that never has more rows than a task made.
    """
    per = materialise(stored.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    counts = {r.length: r.n for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row per length
    lookup = layout(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = per.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_begin"))
    begin = F.broadcast(begin) if per.count() <= COLLECTED_ROWS else begin
    ranked = stored.join(begin, ["length", "part"]).withColumn("_rank", F.col("_begin") + F.col("place"))
    names = [c for c in stored.columns if c not in ("part", "place")]
    ranked = ranked.select(*[col(c) for c in names], "_rank")
    at = names.index("length")

    def find(batches):
        wide = np.int64(1 << 44)  # more pieces than that of one length do not occur
        starts = lookup["length"] * wide + lookup["first"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (at, len(names)))
            i = np.searchsorted(starts, length * wide + rank, "right") - 1
            since, times = rank - lookup["first"][i], lookup["times"][i]
            sequence = lookup["base"][i] + since % times
            offset = lookup["offset"][i] + since // times * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ranked.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(find, schema)


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", ids: bool = True, capacity: int = CAPACITY, **options) -> DataFrame:
    """The pieces of ``docs`` with the sequence and place of each."""
    return pack(materialise(pieces(docs, key, text, capacity=capacity, ids=ids, **options)), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): each sequence's token ids, as little-endian 32-bit numbers, and the lengths of its pieces in order.

    A group holds at most one sequence's tokens.
    """
    own = F.sort_array(F.collect_list(F.struct("offset", "length", F.hex("ids").alias("ids"))))
    grouped = placed.groupBy("sequence_id").agg(own.alias("own"))
    return grouped.select("sequence_id", F.unhex(F.array_join("own.ids", "")).alias("ids"), F.col("own.length").alias("lengths"))
