"""Sanitising personal data: patterns find protected entities, co-occurrence finds the terms that give them away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers, each the leftmost
non-overlapping matches of its pattern that pass its test. Their values are the protected entities.

A term (a lower-cased word) discloses an entity when seeing it all but names the entity. Over the whole
corpus, c(t, e) is the number of different texts in which t is one of the ``REACH`` whole words on either side of the word, or words, that e stands in, and n(t) the
number of different texts with t anywhere. The information t gives on e is log2(P(e|t) / P(e)), with P(e|t) = c(t, e) / n(t).
Terms with c >= ``SUPPORT``, P(e|t) >= ``CERTAIN`` and at least ``BITS`` bits are disclosing; all their occurrences become
spans of the kind "term". In the sanitised text, spans become ``[KIND]``; a disclosing term becomes ``[NUMBER]``
when it holds a digit, else ``[TERM]`` (generalised), or nothing (``remove_terms``).

Built-in functions only. Spans are found inside the row, without a shuffle; co-occurrence shuffles the words
around entities and, of all other words, only those that are candidates.

Defined cases: a null text has no spans and stays null. Repeated texts count once in the statistics and each
get their own row. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.llm.frames import bounded, col, others
from haulyard.session import materialise

REACH = 5
WINDOW = 400  # characters read first on each side of a span
SUPPORT = 3
CERTAIN = 0.8
BITS = 6.0
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Patterns as specified, written so that they need no backtracking: possessive loops, and a start only where
# no match could have begun one character earlier (or right after the last match, \G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# texts without this cannot match
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][\x20-][0-9]", "phone": r"\+[0-9]"}
KINDS = (*PATTERNS, "term")
SPAN = "struct<start:bigint,kind:int,end:bigint>"
RESULTS = ("n_email", "n_ip", "n_card", "n_phone", "n_term", "base_spans", "spans")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(number: Column) -> Column:
    """Every second digit from the right doubled, the digits' sum a multiple of ten."""
    places = F.sequence(F.lit(1), F.length(number))

    def value(i: Column) -> Column:
        digit = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(i % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        # leading zeros aside, a part has at most three digits
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(F.lit(False)))
    if kind == "card":
        number = _digits(match)
        return F.when(F.length(number).between(14, 19), _luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _found(text: Column, pattern: Column, kind: int, test) -> Column:
    """The spans of the matches that pass: lengths of gaps and matches, added up along the text."""
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)), matches,
        lambda g, m: F.struct(F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("long"), test(m).alias("ok")),
    )
    none = F.array().cast(f"array<{SPAN}>")
    begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["long"]).alias("end"))
        return F.struct((start + x["long"]).alias("at"), F.when(x["ok"], F.array_append(state["out"], span)).otherwise(state["out"]).alias("out"))

    return F.aggregate(steps, begin, step, lambda state: state["out"])


def base_spans(text: Column) -> Column:
    """All base spans, by start and then kind."""
    none = F.array().cast(f"array<{SPAN}>")
    kinds = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        found = _found(text, F.lit(pattern), i, lambda m, kind=kind: _passes(kind, m))
        kinds.append(F.when(F.contains(text, F.lit("@")) if kind == "email" else F.rlike(text, F.lit(NEEDS[kind])), found).otherwise(none))
    return F.coalesce(F.sort_array(F.concat(*kinds)), none)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_of(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _piece(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))


def _near(text: Column, start: Column, end: Column, reach: int, left: bool) -> Column:
    """The ``reach`` whole words nearest to a span in the text on one side of it; to the left, reversed.

    What touches the span belongs to its own word and is passed over. A short window is read first, and
    the whole side where that does not surely hold all the words.
    """
    side = F.reverse(_piece(text, start, end)) if left else _piece(text, start, end)
    window = _piece(text, F.greatest(end - WINDOW, start), end) if left else _piece(text, start, F.least(start + WINDOW, end))
    window = F.reverse(window) if left else window
    step = rf"[{BLANK}]++[^{BLANK}]++"
    enough = rf"^[^{BLANK}]*+(?:{step}){{{reach}}}[{BLANK}]"
    return F.regexp_extract(F.when(F.rlike(window, F.lit(enough)), window).otherwise(side), rf"^[^{BLANK}]*+((?:{step}){{0,{reach}}})", 1)


def disclosing_terms(docs: DataFrame, text: str, reach: int = REACH, support: int = SUPPORT, certain: float = CERTAIN, bits: float = BITS) -> DataFrame:
    """(term, bits): the terms that disclose an entity of the texts."""
    whole = col(text)
    mark = F.xxhash64(whole).alias("_mark")
    found = docs.select(whole.alias("_t"), mark, base_spans(whole).alias("base_spans"))
    spans = found.where(F.size("base_spans") > 0).select("_t", "_mark", F.explode("base_spans").alias("s"))

    before = F.reverse(_near(F.col("_t"), F.lit(0), F.col("s.start"), reach, left=True))
    after = _near(F.col("_t"), F.col("s.end"), F.length("_t").cast("long"), reach, left=False)
    entity = F.concat_ws(":", F.col("s.kind"), _piece(F.col("_t"), F.col("s.start"), F.col("s.end")))
    spans = materialise(spans.select("_mark", entity.alias("entity"), F.array_distinct(F.concat(_words(before), _words(after))).alias("terms")))
    near = spans.select("_mark", "entity", F.explode("terms").alias("term")).distinct()
    pairs = near.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= support)
    # entities seen in c texts: what P(e) is measured by
    held = spans.select("_mark", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = pairs.join(held, "entity")
    # a term stands in at least as many texts as it has texts near any entity, which rules out the common words here
    around = near.select("_mark", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_near"))
    pairs = pairs.join(around, "term").where(F.col("c") >= F.col("n_near") * certain)
    best = materialise(pairs.groupBy("term").agg(F.max(F.struct("c", (-F.col("n_entity")).alias("rare"))).alias("m")).select("term", "m.c", (-F.col("m.rare")).alias("n_entity")))
    if best.isEmpty():
        return best.select("term", F.lit(0.0).alias("bits"))
    # every text's different words; only candidates go on to be counted
    each = docs.select(mark, F.explode(F.array_distinct(_words(whole))).alias("term"))
    counted = each.join(bounded(best.select("term"), "term"), "term", "left_semi")
    totals = counted.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    n_texts = docs.agg(F.count_distinct(F.xxhash64(whole))).first()[0]
    rated = best.join(totals, "term").withColumn("share", F.col("c") / F.col("n"))
    rated = rated.withColumn("bits", F.log2(F.col("share") * n_texts / F.col("n_entity")))
    return materialise(rated.where((F.col("share") >= certain) & (F.col("bits") >= bits)).select("term", "bits"))


def with_spans(docs: DataFrame, text: str = "text", terms: DataFrame | None = None, **options) -> DataFrame:
    """``docs`` with base_spans, spans (the disclosing terms' too) and their counts by kind.

    The terms are looked up among each text's words: in a literal list while they are few (counted), by a
    join with the words of all texts beyond that.
    """
    found = docs.select(*[col(c) for c in others(docs, list(RESULTS))]).withColumn("base_spans", base_spans(col(text)))
    terms = disclosing_terms(docs, text, **options) if terms is None else terms
    none = F.array().cast(f"array<{SPAN}>")
    if terms.isEmpty():
        spans = F.col("base_spans")
        out = found.withColumn("spans", spans)
    else:
        words = docs.select(F.xxhash64(col(text)).alias("_m"), F.length(col(text)).alias("_l"), F.explode(F.array_distinct(_words(col(text)))).alias("term"))
        met = words.join(bounded(terms.select("term"), "term"), "term", "left_semi")
        quoted = F.concat(F.lit("\\Q"), F.replace(F.col("term"), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        own = materialise(met.groupBy("_m", "_l").agg(F.array_join(F.array_sort(F.collect_set(quoted)), "|").alias("_own")))
        pattern = F.concat(F.lit(rf"(?i)(?<![^{BLANK}])(?:"), F.col("_own"), F.lit(rf")(?![^{BLANK}])"))
        same = (F.xxhash64(col(text)) == F.col("_m")) & (F.length(col(text)) == F.col("_l"))
        extra = F.when(F.col("_own").isNotNull(), _found(col(text), pattern, KINDS.index("term"), lambda m: F.lit(True))).otherwise(none)
        out = found.join(bounded(own, "_own"), same, "left").withColumn("spans", F.sort_array(F.concat("base_spans", F.coalesce(extra, none)))).drop("_m", "_l", "_own")
    return out.withColumns({f"n_{k}": count_of(k) for k in KINDS})


def sanitised(text: Column, spans: Column, remove_terms: bool = False) -> Column:
    """The text with its spans replaced; overlapping spans become one, named after the first."""
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def join(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(last.isNull() | (s["start"] >= last["end"]), F.array_append(done, s)).otherwise(F.array_append(F.slice(done, F.lit(1), F.size(done) - 1), wider))

    apart = F.aggregate(F.sort_array(spans), none, join)
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(apart, lambda s: s["end"]))

    def piece(s: Column, i: Column) -> Column:
        gap = _piece(text, F.get(ends, i), s["start"])
        own = _piece(text, s["start"], s["end"])
        term = F.lit("") if remove_terms else F.when(F.rlike(own, F.lit("[0-9]")), F.lit("[NUMBER]")).otherwise(F.lit("[TERM]"))
        return F.concat(gap, F.when(s["kind"] == KINDS.index("term"), term).otherwise(F.get(tags, s["kind"])))

    rest = F.substring(text, (F.element_at(ends, -1) + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(apart, piece), ""), rest)).otherwise(text)


def sanitise(docs: DataFrame, text: str = "text", remove_terms: bool = False, **options) -> DataFrame:
    """``docs`` with the spans replaced in the text, and n_chars (where there is one) counted anew."""
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(text).alias("_text"))
    done = with_spans(packed, "_text", **options).withColumn("_new", sanitised(F.col("_text"), F.col("spans"), remove_terms))
    fresh = {text: F.col("_new").alias(text)}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("_new").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return done.select(*[fresh.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])
