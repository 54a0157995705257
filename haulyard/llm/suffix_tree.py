"""Language-model scores from a probabilistic suffix tree over words.

Tokens are the words of the lower-cased (A-Z) text and one end per text; the first word's context is the end
mark. The tree's root holds the exact counts of all tokens. A context of any number of tokens becomes a state when it
occurs at least ``LEAST_CONTEXT`` times in the training texts, its suffix (one token less) is a state or the root, and
its next-token distribution diverges from that of its suffix by at least ``DIVERGENCE`` nats per token. A state keeps the
successors seen at least ``LEAST_PAIR`` times; each is smoothed with the suffix's probability, and what is left is spread
over all other tokens in proportion to the suffix's distribution, so every state's probabilities sum to one. A token is
scored in the state of its longest context that the tree has.

The counts are fixed numbers, so the tree grows with the corpus, and levels are added until one has no state. The texts
stay in parts (at most ``PART_BYTES`` of text, or one text), encoded once: the different words as 64-bit hashes and the texts as
numbers into that list. Parts lie in a table in buckets by their number and are worked on where they lie: only questions and
answers are shuffled. Per level a part sends the 64-bit name of every different (context, successor) once, with its
own count, if the token was seen often enough after the context one shorter, in packed arrays by ranges of names; whoever holds a range adds the counts up and answers each part in the order it
asked, and marks for each name one part as its owner. So no name or successor is ever gathered by context, and frequent words
make no skew. Owners add the divergence's terms up per context; states are the contexts whose sums pass, sent to the parts that
have them. A context seen too rarely is known from the counts of the level before (its first tokens and its last), and no
longer context that contains it is asked for. Between levels a part keeps the tokens that may still go deeper, with their
scores, and of its texts only the stretches in which their longer contexts can lie.
A context is named by a 64-bit hash of its suffix's name and the word before.

Defined cases: a null or empty text is one end token. Rows are held out by their key's checksum; a null key
counts as the empty text. Without training tokens every c is 0. Repeated rows are each counted and scored.
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from haulyard.llm.frames import col, slices
from haulyard.session import scratch_path

LEAST_CONTEXT = 10
LEAST_PAIR = 2
DIVERGENCE = 0.02
SMOOTHING = 2.0  # tokens of the suffix's distribution added to a state's counts
FOLDS, HELD_OUT = 5, 1
PART_BYTES = 8 << 20
RANGE_TOKENS = 1 << 20  # tokens of the corpus that may still go deeper per range of names
BUCKET_TOKENS = 2 << 20  # such tokens per bucket of the table that parts lie in
END = xxh64_intdigest(b"\n")  # no word has a line end in it

CODES = "part long, n_tokens long, keys array<{key}>, about binary, words binary, tokens binary"


def held_out(key: object) -> bool:
    return zlib.crc32(("" if key is None else str(key)).encode()) % FOLDS == HELD_OUT


class Part:
    """Texts to be encoded: the different words and the texts as numbers into them; number 0 is the end mark."""

    def __init__(self):
        self.keys, self.held, self.texts, self.size = [], [], [], 0

    def add(self, key, data: bytes | None) -> None:
        self.texts.append(data or b"")
        self.keys.append(key)
        self.held.append(held_out(key))
        self.size += len(data or b"")

    def row(self, part: int) -> dict:
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(self.texts, pa.binary()).view(pa.string())))
        words = split.flatten()
        filled = pc.greater(pc.binary_length(words), 0)
        lengths = np.add.reduceat(np.append(filled.to_numpy(zero_copy_only=False), False), split.offsets.to_numpy()[:-1], dtype=np.int64)
        lengths = np.where(np.diff(split.offsets.to_numpy()) > 0, lengths, 0) + 1
        found = words.filter(filled).dictionary_encode()
        inside = np.ones(int(lengths.sum()), bool)
        inside[np.cumsum(lengths) - 1] = False
        tokens = np.zeros(len(inside), np.uint32)
        tokens[inside] = found.indices.to_numpy() + 1
        own = found.dictionary.cast(pa.binary()).to_pylist()
        counts = np.bincount(tokens[np.repeat(~np.array(self.held, bool), lengths)], minlength=len(own) + 1)
        hashes = np.fromiter(map(xxh64_intdigest, [b"\n", *own]), np.uint64, len(own) + 1).view(np.int64)
        return {
            "part": part, "n_tokens": len(tokens), "keys": self.keys, "about": packed(held=np.array(self.held, bool), lengths=lengths),
            "words": packed(words=hashes, counts=counts), "tokens": packed(tokens=tokens),
        }


def encode(docs: DataFrame, key: str, text: str, part_bytes: int) -> DataFrame:
    """One row per part of the corpus."""
    slim = docs.select(col(key).alias("key"), col(text).alias("text"))
    schema = CODES.format(key=slim.schema["key"].dataType.simpleString())
    arrow = pa.schema([("part", pa.int64()), ("n_tokens", pa.int64()), ("keys", pa.list_(_arrow(slim))), ("about", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary())])

    def run(batches):
        number, part = TaskContext.get().partitionId() << 32, Part()
        for batch in batches:
            for piece, texts in slices(batch, batch.column(1)):
                for k, data in zip(piece.column(0).to_pylist(), texts):
                    part.add(k, data)
                    if part.size >= part_bytes:
                        yield pa.RecordBatch.from_pylist([part.row(number)], arrow)
                        number, part = number + 1, Part()
        if part.keys:
            yield pa.RecordBatch.from_pylist([part.row(number)], arrow)

    return slim.mapInArrow(run, schema)


def _arrow(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["key"].dataType)


def longer(suffix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The names of the contexts that are ``word`` and then the context named ``suffix``."""
    x = suffix.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def packed(**arrays: np.ndarray) -> bytes:
    """Arrays as bytes: whole numbers in as few bytes as the largest needs, the first bytes of all first; hashes and most floats do not get smaller."""
    out = {}
    for k, a in arrays.items():
        small = np.min_scalar_type(a.max()) if a.dtype.kind in "iu" and len(a) and a.min() >= 0 else a.dtype
        if a.dtype.kind == "b" or small.itemsize < 8:
            planes = np.ascontiguousarray(a.astype(small, copy=False)).view(np.uint8).reshape(-1, small.itemsize).T.tobytes()
        elif a.dtype.kind == "f" and 5 * np.count_nonzero(a) < 4 * len(a):
            planes, small = a.tobytes(), None
        else:
            out[k] = a.dtype.str, None, -1, a.tobytes()
            continue
        out[k] = a.dtype.str, small and small.str, len(planes), pa.compress(planes, "zstd", asbytes=True)
    return pickle.dumps(out)


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    out = {}
    for k, (kind, small, size, z) in pickle.loads(data).items():
        raw = np.frombuffer(z if size < 0 else pa.decompress(z, size, "zstd"), np.uint8) if size else np.empty(0, np.uint8)
        if small:
            raw = np.ascontiguousarray(raw.reshape(np.dtype(small).itemsize, -1).T).reshape(-1)
        out[k] = raw.view(small or kind).astype(kind, copy=False)
    return out


ASKED = pa.schema([("range", pa.int32()), ("in_part", pa.int64()), ("names", pa.binary())])
QUESTION = "range int, in_part long, names binary"
STATE = "part long, n_active long, data binary"


def by_range(ranges: int, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of the names, and the order in which a part asks for them."""
    of = ((names >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.uint16 if ranges <= 1 << 16 else np.int32)
    return of, np.argsort(of, kind="stable")


def asked(part: int, ranges: int, names: np.ndarray, **values: np.ndarray) -> pa.Table:
    """A row per range of names: the names and what the part has for each."""
    of, order = by_range(ranges, names)
    names, of = names[order], of[order]
    values = {k: v[order] for k, v in values.items()}
    starts = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
    rows = [packed(names=names[a:b], **{k: v[a:b] for k, v in values.items()}) for a, b in zip(starts, np.append(starts[1:], len(of)))]
    return pa.table([pa.array(of[starts], pa.int32()), pa.array(np.full(len(starts), part, np.int64)), pa.array(rows, pa.binary())], ASKED)


class Range:
    """What all parts ask of one range of names, brought together in the order of the parts."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.sort_by("in_part")
        found = [unpacked(data) for data in self.rows["names"].to_pylist()]
        self.values = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
        names = self.values.pop("names")
        self.ends = np.cumsum([len(f["names"]) for f in found])
        self.order = np.argsort(names)
        ordered = names[self.order]
        self.first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        self.starts = np.flatnonzero(self.first)

    def sums(self, name: str) -> np.ndarray:
        return np.add.reduceat(self.values[name][self.order], self.starts)

    def spread(self, per_name: np.ndarray) -> np.ndarray:
        """A value per name, at all its places."""
        out = np.empty(len(self.order), per_name.dtype)
        out[self.order] = per_name[np.cumsum(self.first) - 1]
        return out

    def reply(self, n_all: int, n_seen: int, **values: np.ndarray) -> pa.Table:
        """The values back to each part; the totals of the range stand in its first row."""
        pieces = [packed(**{k: v[a:b] for k, v in values.items()}) for a, b in zip(np.append(0, self.ends), self.ends)]
        lead = np.arange(len(pieces)) == 0
        return pa.table({
            "in_part": self.rows["in_part"], "range": self.rows["range"], "data": pa.array(pieces, pa.binary()),
            "n_all": pa.array(np.where(lead, n_all, 0), pa.int64()), "n_seen": pa.array(np.where(lead, n_seen, 0), pa.int64()),
        })


def _add_up(rows: pa.Table) -> pa.Table:
    """Per asking part the counts of its names over all parts, and which names it owns: one part that has it."""
    asked = Range(rows)
    n, own = asked.sums("n"), np.zeros(len(asked.order), bool)
    own[asked.order[asked.starts]] = True
    return asked.reply(n.sum(), (n > 0).sum(), n=asked.spread(n), own=own)


def _decide(least_context: int, divergence: float):
    def run(rows: pa.Table) -> pa.Table:
        """Per asking part the counts of its states, 0 for other contexts, and the weight of what a state does not keep if the part wants it."""
        asked = Range(rows)
        total, kept, below, g = (asked.sums(k) for k in ("n", "kept", "below", "g"))
        with np.errstate(divide="ignore", invalid="ignore"):
            rest, other = (total - kept) / total, np.maximum(1 - below, 1e-12)
            gain = (g - kept * np.log(total)) / total + np.where(rest > 0, rest * np.log(rest / other), 0.0)
            weight = np.log10(np.maximum(1 - (kept + SMOOTHING * below) / (total + SMOOTHING), 1e-12) / other)
        state = (total >= least_context) & (kept > 0) & (gain >= divergence)
        return asked.reply(total.sum(), state.sum(), n=asked.spread(np.where(state, total, 0)), weight=np.where(asked.values["want"], asked.spread(weight), 0.0))

    return run


def answers(questions: DataFrame, reply=_add_up) -> DataFrame:
    return questions.groupBy("range").applyInArrow(reply, "in_part long, range int, data binary, n_all long, n_seen long")


def message(df: DataFrame, kind: str) -> DataFrame:
    """Answers addressed to parts."""
    return df.select("in_part", F.lit(kind).alias("kind"), "range", "data")


def ordered(code: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts codes up to ``most``, and the sorted codes."""
    bits = len(code).bit_length()
    if most.bit_length() + bits > 63:
        order = np.argsort(code)
        return order, code[order]
    both = (code << bits) | np.arange(len(code))
    both.sort()
    return both & ((1 << bits) - 1), both >> bits


def unigram(counts: np.ndarray, n_tokens: int, n_words: int) -> np.ndarray:
    return np.log10((counts + 0.5) / (n_tokens + 0.5 * (n_words + 1)))


def told(mail: pa.Table, kind: str, ranges: int, names: np.ndarray) -> dict[str, np.ndarray]:
    """The answers to a part's names."""
    mine = mail.filter(pa.array([k == kind for k in mail["kind"].to_pylist()], pa.bool_()))
    found, order, out = [unpacked(data) for data in mine.sort_by("range")["data"].to_pylist()], by_range(ranges, names)[1], {}
    for k in found[0] if found else ():
        each = np.concatenate([f[k] for f in found])
        out[k] = np.empty(len(order), each.dtype)
        out[k][order] = each
    return out


def started(part: pa.Table, mail: pa.Table, ranges: int, n_tokens: int, n_words: int, least_context: int, least_pair: int) -> Work:
    """A part before the first level, from its encoded texts and the counts of its words."""
    flat = {k: v for n in ("about", "words", "tokens") for k, v in unpacked(part[n][0].as_py()).items()}
    lengths, tokens = flat["lengths"], flat["tokens"]
    counts = told(mail, "words", ranges, flat["words"].view(np.uint64))["n"]
    starts = np.cumsum(lengths) - lengths
    before = np.zeros(len(tokens), np.uint32)
    before[1:] = tokens[:-1]
    before[starts] = 0
    score = unigram(counts, n_tokens, n_words)[tokens]
    small = (counts < least_context)[before]
    texts, at = np.arange(len(lengths)), np.flatnonzero(~small)
    return Work(part["part"][0].as_py(), 0, ranges, least_context, {
        "held": flat["held"], "base": np.add.reduceat(score, starts), "known": np.add.reduceat((counts > 0).astype(np.int64)[tokens], starts),
        "sums": np.bincount(np.repeat(texts, lengths)[small], score[small], len(lengths)),
        "words": flat["words"], "counts": counts, "totals": np.array([n_tokens, n_words]), "tokens": tokens, "lengths": lengths, "texts": texts, "offsets": np.zeros(len(lengths), np.int64),
        "small": small, "at": at, "seen": (counts >= min(least_pair, least_context))[tokens[at]], "score": None,
    })


class Work:
    """A part at one depth: the tokens that may still go deeper, with what the levels before say of them.

    Of the texts there are stretches: ``lengths`` tokens from place ``offsets`` of text ``texts`` each. ``small`` marks the tokens
    before which every context longer than the depth reached is known to be too rare, or cannot be had from the stretch.
    ``seen`` marks the tokens that are counted further: after the context one shorter they came often enough to be kept after a
    longer one, or to be in one.
    """

    def __init__(self, number: int, depth: int, ranges: int, least_context: int, has: dict[str, np.ndarray]):
        self.number, self.depth, self.ranges, self.least_context = number, depth, ranges, least_context
        vars(self).update(has)
        ends = np.cumsum(self.lengths)
        self.first = ends - self.lengths - self.offsets  # where the stretch's text begins, or would
        self.stretch = np.repeat(np.arange(len(ends), dtype=np.int32), self.lengths)[self.at]
        if self.score is None:
            self.score = unigram(self.counts, *self.totals.tolist())[self.tokens[self.at]]

    @classmethod
    def read(cls, number: int, data: bytes, depth: int, ranges: int, least_context: int) -> Work:
        has = unpacked(data)
        has["at"] = np.cumsum(has.pop("gaps").astype(np.int64))
        has["small"] = np.unpackbits(has["small"], count=len(has["tokens"])).astype(bool)
        has["seen"] = np.unpackbits(has["seen"], count=len(has["at"])).astype(bool)
        has["score"] = has.get("score")
        return cls(number, depth, ranges, least_context, has)

    def before(self, back: int) -> np.ndarray:
        """The token ``back`` places before each; the end mark, number 0, stands before a text."""
        token = self.tokens[np.maximum(self.at - back, 0)]
        token[self.at - self.first[self.stretch] < back] = 0
        return token

    def settle(self, score: np.ndarray, on: np.ndarray) -> None:
        """Tokens that are not ``on`` have their last score."""
        self.sums = self.sums + np.bincount(self.texts[self.stretch[~on]], score[~on], len(self.sums))
        self.at, self.score, self.stretch, self.seen = self.at[on], score[on], self.stretch[on], self.seen[on]

    def group(self) -> None:
        """Number the different contexts of this depth and their pairs with successors."""
        words, width = self.words, np.int64(len(self.words))
        own = self.before(1)
        if self.depth == 1:
            self.ctx, self.ctx_at = words, own
        else:
            name = words[own]
            for back in range(2, self.depth + 1):
                name = longer(name, words[self.before(back)])
            self.ctx, self.ctx_at = np.unique(name, return_inverse=True)
        asked = np.flatnonzero(self.seen)
        order, codes = ordered(self.ctx_at[asked] * width + self.tokens[self.at[asked]], len(self.ctx) * len(words))
        first = np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)]
        starts = np.flatnonzero(first)
        self.pair_at = np.empty(len(codes), np.int32)  # of the tokens counted
        self.pair_at[order] = np.cumsum(first) - 1
        self.pair_ctx, sym = codes[starts] // width, codes[starts] % width
        self.names = longer(self.ctx[self.pair_ctx], words[sym]).view(np.uint64)
        self.asked, self.one = asked, asked[order[starts]]  # a token of each pair

    def train(self) -> np.ndarray:
        return ~self.held[self.texts][self.stretch]

    def own_counts(self) -> np.ndarray:
        return np.bincount(self.pair_at[self.train()[self.asked]], minlength=len(self.names))

    def sums_of(self, mail: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Counts over all parts of each pair, and which pairs this part owns."""
        found = told(mail, "pairs", self.ranges, self.names)
        return (found["n"], found["own"]) if found else (np.empty(0, np.int64), np.empty(0, bool))

    def each(self, total: np.ndarray) -> np.ndarray:
        """The counts of pairs at the tokens; 0 where they are not counted, since they are too low."""
        n = np.zeros(len(self.at), np.int64)
        n[self.seen] = total[self.pair_at]
        return n

    def here(self) -> np.ndarray:
        """The contexts that stand before a token that may go deeper."""
        return np.flatnonzero(np.bincount(self.ctx_at, minlength=len(self.ctx)))

    def climb(self, mail: pa.Table, least_pair: int) -> None:
        """Score in the states of this depth and keep what may go on."""
        n = self.each(self.sums_of(mail)[0])
        here = self.here()
        found = told(mail, "states", self.ranges, self.ctx[here].view(np.uint64))
        count_of, weight_of = np.zeros(len(self.ctx), np.int64), np.zeros(len(self.ctx))
        count_of[here], weight_of[here] = found["n"], found["weight"]
        on = (count_of > 0)[self.ctx_at]
        total, weight = count_of[self.ctx_at[on]], weight_of[self.ctx_at[on]]
        score = self.score.copy()
        old = score[on]
        score[on] = np.where(n[on] >= least_pair, np.log10((n[on] + SMOOTHING * 10.0**old) / (total + SMOOTHING)), old + weight)
        rare = np.zeros(len(self.tokens), bool)
        rare[self.at[n < self.least_context]] = True
        self.small[1:] |= self.small[:-1] | rare[:-1]
        self.seen = n >= min(least_pair, self.least_context)
        reach = self.at - self.first[self.stretch] >= self.depth
        self.settle(score, on & reach & ~self.small[self.at])

    def state(self) -> bytes:
        """What the next levels need: of the texts, the tokens in which a context of a token that may go deeper can lie.

        Such a context reaches no further back than ``depth`` tokens before the last small token, or to the text's beginning.
        """
        starts = np.cumsum(self.lengths) - self.lengths
        stop = self.small.copy()
        stop[starts] = True
        run = (np.cumsum(stop) - 1)[self.at]
        last = np.flatnonzero(np.append(run[1:] != run[:-1], True)) if len(run) else run
        low = np.maximum(np.flatnonzero(stop)[run[last]] - self.depth, starts[self.stretch[last]])
        kept = np.cumsum(np.bincount(low, minlength=len(stop) + 1) - np.bincount(self.at[last] + 1, minlength=len(stop) + 1))[:-1] > 0
        # stretches begin where the token before is gone or is another stretch's
        begin = np.append(True, ~kept[:-1])[: len(kept)]
        begin[starts] = True
        begins = np.flatnonzero(kept & begin)
        old = np.searchsorted(starts, begins, "right") - 1
        place = np.cumsum(kept) - 1
        tokens = self.tokens[kept]
        used = np.bincount(tokens, minlength=len(self.words)) > 0
        used[0] = True
        of = {"score": self.score} if self.depth else {"counts": self.counts[used], "totals": self.totals}
        return packed(
            held=self.held, base=self.base, known=self.known, sums=self.sums, words=self.words[used], **of,
            tokens=(np.cumsum(used) - 1).astype(np.uint32)[tokens], lengths=np.diff(np.append(place[begins], len(tokens))),
            texts=self.texts[old], offsets=begins - self.first[old], small=np.packbits(self.small[kept]), seen=np.packbits(self.seen), gaps=np.diff(place[self.at], prepend=0).astype(np.uint32),
        )


def _row(work: Work) -> pa.Table:
    return pa.table({"part": pa.array([work.number], pa.int64()), "n_active": pa.array([len(work.at)], pa.int64()), "data": pa.array([work.state()], pa.binary())})


def _stored(df: DataFrame, buckets: int = 0) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, in buckets by part if asked for; the shuffle files of the job that wrote it are removed when it has ended."""
    spark, path, name = df.sparkSession, scratch_path(df.sparkSession), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        if buckets:
            df.write.option("compression", "uncompressed").bucketBy(buckets, "part").option("path", path).saveAsTable(table := f"haulyard_{uuid.uuid4().hex}", format="parquet")
        else:
            df.write.option("compression", "uncompressed").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
    if not buckets:
        return spark.read.schema(df.schema).parquet(path), path
    # the frame knows its files and buckets; the name is not needed any more
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return stored, path


def _dropped(spark: SparkSession, path: str) -> None:
    """Delete a table of this run that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES,
    least_context: int = LEAST_CONTEXT, least_pair: int = LEAST_PAIR, divergence: float = DIVERGENCE,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``."""
    spark = docs.sparkSession
    codes, texts = _stored(encode(docs, key, text, part_bytes))
    row = codes.agg(F.sum("n_tokens")).first()

    def ranges(n: int) -> int:
        return max(12, -(-n // RANGE_TOKENS))

    def buckets(n: int) -> int:
        return max(12, -(-n // BUCKET_TOKENS))

    n_ranges = ranges(row[0] or 0)

    def words(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                flat = unpacked(batch.column("words")[i].as_py())
                yield from asked(batch.column("part")[i].as_py(), n_ranges, flat["words"].view(np.uint64), n=flat["counts"]).to_batches()

    counted, path = _stored(answers(codes.select("part", "words").mapInArrow(words, QUESTION)))
    totals = counted.agg(F.sum("n_all"), F.sum("n_seen")).first()
    n_tokens, n_words = int(totals[0] or 0), int(totals[1] or 0)

    def start(part: pa.Table, mail: pa.Table) -> pa.Table:
        return _row(started(part, mail, n_ranges, n_tokens, n_words, least_context, least_pair))

    parts = codes.select("part", "about", "words", "tokens").groupBy("part")
    state, at = _stored(parts.cogroup(message(counted, "words").groupBy("in_part")).applyInArrow(start, STATE), buckets(row[0] or 0))
    keys, _ = _stored(codes.select("part", "keys", "about"))
    _dropped(spark, path)
    _dropped(spark, texts)

    def visit(mail: DataFrame, run, schema: str, depth: int, ranges: int) -> DataFrame:
        """``run`` once per part, where it lies, with the answers to it."""

        def one(part: pa.Table, found: pa.Table) -> pa.Table:
            return run(Work.read(part["part"][0].as_py(), part["data"][0].as_py(), depth, ranges, least_context), found)

        return state.groupBy("part").cogroup(mail.groupBy("in_part")).applyInArrow(one, schema)

    def pairs_of(depth: int, ranges: int) -> DataFrame:
        def question(batches):
            for batch in batches:
                for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    work = Work.read(number, data.as_py(), depth, ranges, least_context)
                    work.group()
                    yield from asked(number, ranges, work.names, n=work.own_counts()).to_batches()

        # parts without a token left ask nothing
        return answers(state.where("n_active > 0").select("part", "data").mapInArrow(question, QUESTION))

    def terms(work: Work, mail: pa.Table) -> pa.Table:
        """Per context this part's count, and over the pairs it owns the terms of the divergence."""
        if not len(work.at):
            return ASKED.empty_table()
        work.group()
        n, own = work.sums_of(mail)
        lacks = work.each(n) < least_pair  # scored by the weight of what a state does not keep
        use = own & (n >= least_pair)
        of, n, q = work.pair_ctx[use], n[use], 10.0 ** work.score[work.one[use]]
        size, here = len(work.ctx), work.here()
        total = np.bincount(work.ctx_at[work.train()], minlength=size)[here]
        kept, below, g = (np.bincount(of, w, size)[here] for w in (n, q, n * np.log(n / q)))
        want = np.bincount(work.ctx_at[lacks], minlength=size)[here] > 0
        return asked(work.number, work.ranges, work.ctx[here].view(np.uint64), n=total, kept=kept.astype(np.int64), below=below, g=g, want=want)

    def climbed(work: Work, mail: pa.Table) -> pa.Table:
        if len(work.at):
            work.group()
            work.climb(mail, least_pair)
        return _row(work)

    for depth in count(1):
        active = state.agg(F.sum("n_active")).first()[0]
        if not active:
            break
        n_ranges = ranges(active)
        pairs, one = _stored(pairs_of(depth, n_ranges))
        heard = message(pairs, "pairs")
        states, two = _stored(answers(visit(heard, terms, QUESTION, depth, n_ranges), _decide(least_context, divergence)))
        found = states.agg(F.sum("n_seen")).first()[0]
        if found:
            old = at
            state, at = _stored(visit(heard.unionByName(message(states, "states")), climbed, STATE, depth, n_ranges), buckets(active))
            _dropped(spark, old)
        _dropped(spark, one)
        _dropped(spark, two)
        if not found:
            break

    kind = docs.schema[key].dataType.simpleString()

    def scored(state: pa.Table, texts: pa.Table) -> pa.Table:
        work = Work.read(state["part"][0].as_py(), state["data"][0].as_py(), 0, 1, least_context)
        work.settle(work.score, np.zeros(len(work.at), bool))
        about = unpacked(texts["about"][0].as_py())
        return pa.table({
            key: texts["keys"].combine_chunks().flatten(),
            "held_out": about["held"],
            "n_tokens": about["lengths"],
            "n_known": work.known,
            "train_tokens": np.full(len(work.sums), n_tokens, np.int64),
            "base_score": work.base,
            "score": work.sums,
        })

    out = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return state.groupBy("part").cogroup(keys.groupBy("part")).applyInArrow(scored, out)
