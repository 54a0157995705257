"""Quality rules with risk-controlled thresholds.

Every text gets plain signals (symbols, repeated lines, repeated words, capitals). Each signal is
divided by a fixed reference value and the largest quotient is the document's score: how many times
over the usual limits it is. Labelled documents are the holdout: nothing else is fitted on them. Per
stratum (language) the cutoff moves down a fixed list of candidates as long as the exact binomial test
rejects "the cutoff throws out more than ``risk`` of the good documents"; the first failure ends the
walk. Testing in a fixed order needs no further correction within a stratum; across strata the error
level is divided by their number. So with probability 1 - ``error``, in every stratum at most ``risk``
of the good documents are rejected by score.

Defined cases: a null text has no words. A stratum without enough good labels gets no cutoff and keeps
whatever passes the base rules; the null stratum is one of its own. Labels for absent documents, null
labels and labels without a document are ignored. The test needs independent documents: a document counts once however
often it is labelled good, and equal texts of a stratum count once. Without labels nothing is rejected by score. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.llm.frames import COLLECTED_ROWS, add_columns, col
from haulyard.session import materialise

RISK = 0.02
ERROR = 0.05
MIN_WORDS = 50
REPEAT_PERCENT = 50
# reference values per signal: share of words with a symbol, of repeated lines, of repeated words, of capitals
LIMITS = {"symbols": 0.1, "repeated_lines": 0.3, "repeated_words": 0.2, "capitals": 0.2}
# candidates for the cutoff on the score, from lax to strict; fixed before any label is seen
CUTOFFS = (8.0, 6.0, 5.0, 4.0, 3.5, 3.0, 2.5, 2.25, 2.0, 1.75, 1.5, 1.25, 1.1, 1.0, 0.9, 0.8, 0.7, 0.6, 0.5)

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
SIGNALS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double"


def without(data: bytes, drop: bytes) -> int:
    return len(data.translate(None, drop))


def repeated_words(own: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur twice or more, the first one included."""
    if len(own) <= size:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own))
    if len(numbers) == len(own):
        return 0
    keys = ids
    for k in range(1, size):
        # numbering the shorter windows keeps every product below 2**63
        shorter = np.unique(keys, return_inverse=True)[1] if k > 1 else keys
        keys = shorter[: len(shorter) - 1] * len(numbers) + ids[k:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    cover = np.zeros(len(own), bool)
    for k in range(size):
        cover[k : k + len(keys)] |= twice
    return int(cover.sum())


def signals(data: bytes | None) -> tuple:
    data = data or b""
    own = data.split()  # splits at the six ASCII blanks only
    n = len(own)
    # continuation bytes do not start a code point
    chars = without(data, BLANKS + bytes(range(128, 192)))
    n_symbols = len(data) - without(data, SYMBOLS)
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(own)
    failed = n < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * n
    shares = {
        "symbols": n_symbols / max(n, 1),
        "repeated_lines": dup / max(len(lines), 1),
        "repeated_words": repeat / max(n, 1),
        "capitals": (len(data) - without(data, CAPITALS)) / max(chars, 1),
    }
    return n, chars, n_symbols, dup, repeat, failed, max(shares[k] / v for k, v in LIMITS.items())


def with_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the base rules, their verdict and the score."""
    names = [f.split()[0] for f in SIGNALS.split(", ")]

    def compute(texts, _):
        rows = [signals(t) for t in texts]
        return {n: [r[i] for r in rows] for i, n in enumerate(names)}

    return add_columns(docs, text, SIGNALS, compute)


def binomial_tail(rejected: int, n: int, risk: float) -> float:
    """P(at most ``rejected`` of ``n``) if each were rejected with probability ``risk``: the exact test's p-value."""
    if not n:
        return 1.0
    k = np.arange(rejected + 1, dtype=float)
    choose = np.concatenate([[0.0], np.cumsum(np.log((n - k[:-1]) / k[1:]))])
    return min(1.0, float(np.exp(choose + k * math.log(risk) + (n - k) * math.log1p(-risk)).sum()))


def copy_of(text: str = "text") -> Column:
    """A number that equal texts share."""
    return F.xxhash64(F.coalesce(col(text), F.lit("")))


def cutoffs(scored: DataFrame, labels: DataFrame, stratum: str, key: str = "doc_id", label: str = "quality", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The certified cutoff per stratum (stratum, n_good, n_rejected, cutoff); null where none is certified.

    Rows of ``scored`` with an equal ``copy`` (``copy_of``; without that column, an equal key) count once. One aggregate counts, for every candidate, the good documents above it; the tests then run on one
    row per stratum.
    """
    good = labels.where((col(label) == 1) & col(key).isNotNull()).select(col(key).alias("_key")).distinct()
    copy = col("copy") if "copy" in scored.columns else F.xxhash64(col(key))
    over = [F.sum((F.col("score") > c).cast("long")).alias(f"over_{i}") for i, c in enumerate(CUTOFFS)]
    held = scored.where(~F.col("base_failed")).select(col(key).alias("_key"), col(stratum).cast("string").alias("stratum"), "score", copy.alias("copy"))
    texts = held.join(good, "_key").groupBy("stratum", "copy").agg(F.min("score").alias("score"))
    counts = texts.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *over)
    counts = materialise(counts)
    level = error / max(1, counts.count())

    def walk(batches):
        for batch in batches:
            rows, out = batch.to_pylist(), []
            for r in rows:
                best = rejected = None
                for i, c in enumerate(CUTOFFS):
                    if binomial_tail(r[f"over_{i}"], r["n_good"], risk) > level:
                        break
                    best, rejected = c, r[f"over_{i}"]
                out.append({"stratum": r["stratum"], "n_good": r["n_good"], "n_rejected": rejected, "cutoff": best})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("stratum", pa.string()), ("n_good", pa.int64()), ("n_rejected", pa.int64()), ("cutoff", pa.float64())]))

    return materialise(counts.mapInArrow(walk, "stratum string, n_good long, n_rejected long, cutoff double"))


def judged(scored: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    """``scored`` with ``cutoff`` and the verdict ``kept``.

    The cutoffs are looked up in a literal map while there are at most ``COLLECTED_ROWS`` strata, which
    is counted first; beyond that they are joined, the strata of many rows spread over salted keys.
    """
    certified = limits.where(F.col("cutoff").isNotNull()).select("stratum", "cutoff")
    name = F.coalesce(F.concat(F.lit("="), col(stratum).cast("string")), F.lit("null"))
    certified = certified.select(F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit("null")).alias("_stratum"), F.col("cutoff").alias("_cutoff"))
    if certified.count() <= COLLECTED_ROWS:
        found = scored.withColumn("_stratum", name).join(F.broadcast(certified), "_stratum", "left")
    else:
        salts = 16
        spread = certified.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64(*[col(c) for c in scored.columns if scored.schema[c].dataType.typeName() == "long"]), F.lit(salts)).cast("int")
        found = scored.withColumns({"_stratum": name, "_salt": salt}).join(spread, ["_stratum", "_salt"], "left").drop("_salt")
    kept = ~F.col("base_failed") & ~(F.col("score") > F.coalesce(F.col("_cutoff"), F.lit(float("inf"))))
    rest = [col(c) for c in scored.columns if c.lower() not in ("cutoff", "kept")]
    return found.select(*rest, F.col("_cutoff").alias("cutoff"), kept.alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang", **options) -> DataFrame:
    """``docs`` without those the rules reject, in the columns of ``docs``."""
    slim = docs.select(*[col(c) for c in dict.fromkeys((key, text, stratum))])
    scored = materialise(with_signals(slim.withColumn("copy", copy_of(text)), text).drop(text))
    limits = cutoffs(scored, labels, stratum, key, **options)
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(text).alias("_text"), col(stratum).alias("_lang"))
    return judged(with_signals(packed, "_text"), limits, "_lang").where("kept").select("row.*")
