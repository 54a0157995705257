"""License scans by diagonal voting, in DataFrame operations only.

Texts are lower-cased (A-Z) and cut into words of ASCII letters, digits and characters beyond ASCII.
All rolling k-grams of words of all texts are joined, by hash and words, to the positions of the same
k-grams in the templates. A match votes for its diagonal: position in the text minus position in the
template. Votes are counted per diagonal; diagonals at most ``SLACK`` words apart that lie side by side in the text are merged into
one place (words inserted or left out move the rest to a neighbouring diagonal). A place is verified by
the share of the template's k-grams that it holds: all of them, on one diagonal, for the phrases; at
least ``LEAST`` for the longer notices.

Defined cases: a null text has no words. Rows that repeat key and text are one for the votes and each get
the result. Overlapping places of one template on different diagonals each count. Result columns
replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulyard.llm.frames import col, others

GRAM = 3
LEAST = 0.6
SLACK = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# fixed values: the phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# fixed values: openings of well-known license notices and their labels
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "apache": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License",
    "cc-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-notice": "This work is licensed under CC BY 4.0",
}
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(tpl, label, base, grams, hash, a, b, c, at): a row per k-gram of every template; a fixed list."""
    rows = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for label, text in notices.items()]
    made = spark.createDataFrame(rows, "text string, label string, base boolean").select("label", "base", words(F.col("text")).alias("w"))
    made = made.withColumn("tpl", F.array_join("w", " ")).withColumn("k", F.least(F.lit(GRAM), F.size("w")))
    made = made.withColumn("grams", F.size("w") - F.col("k") + 1).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("grams") - 1)))
    a, b, c = (F.get(F.col("w"), F.col("at") + i) for i in range(3))
    made = made.select("tpl", "label", "base", "grams", "at", a.alias("a"), F.when(F.col("k") > 1, b).alias("b"), F.when(F.col("k") > 2, c).alias("c"))
    return made.withColumn("hash", F.xxhash64("a", "b", "c"))


def grams(own: Column) -> Column:
    """An entry (pos, a, b, c) per word, b and c being the words after it, and one at -1 so that every text stays."""
    steps = F.transform(own, lambda w, i: F.struct(i.alias("pos"), w.alias("a"), F.get(own, i + 1).alias("b"), F.get(own, i + 2).alias("c")))
    none = F.lit(None).cast("string")
    return F.concat(F.array(F.struct(F.lit(-1).alias("pos"), none.alias("a"), none.alias("b"), none.alias("c"))), steps)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(key, n_words, places, n_base, first_word, last_word, base_labels, labels, score) per row of ``docs``."""
    spark = docs.sparkSession
    tpl = templates(spark, phrases, notices)
    sizes = sorted({min(GRAM, len(t.split())) for t in [*phrases, *notices.values()]})
    slim = docs.select(col(key).alias("_key"), F.xxhash64(col(text)).alias("_text"), F.length(col(text)).alias("_len"), words(col(text)).alias("w"))
    row = ["_key", "_text", "_len"]
    # the words are counted before, so that no copy of them goes along with each of their k-grams
    slim = slim.withColumn("n_words", F.size("w").cast("long"))
    each = slim.select(*row, "n_words", F.explode(grams(F.col("w"))).alias("g")).select(*row, "n_words", "g.*")
    tries = F.array(*[F.xxhash64("a", F.col("b") if k > 1 else F.lit(None).cast("string"), F.col("c") if k > 2 else F.lit(None).cast("string")) for k in sizes])
    each = each.withColumn("try", F.explode(tries)) if len(sizes) > 1 else each.withColumn("try", tries[0])
    t = tpl.select("tpl", "label", "base", "grams", "at", "hash", F.col("a").alias("ta"), F.col("b").alias("tb"), F.col("c").alias("tc"))
    same = (
        (F.col("try") == F.col("hash")) & (F.col("pos") >= 0) & (F.col("a") == F.col("ta"))
        & (F.col("tb").isNull() | (F.col("b") == F.col("tb"))) & (F.col("tc").isNull() | (F.col("c") == F.col("tc")))
    )
    # the templates are a fixed list of some hundred rows
    met = each.join(F.broadcast(t), same, "left").where((F.col("pos") < 0) | F.col("tpl").isNotNull())
    votes = met.withColumn("diagonal", F.col("pos") - F.col("at")).groupBy(*row, "n_words", "tpl", "label", "base", "grams", "diagonal").agg(
        F.collect_set("at").alias("held"), F.min("pos").alias("start"), F.max("pos").alias("end")
    )
    # neighbouring diagonals, in the order of the text, are one place while they lie within a template's length of each other
    place = Window.partitionBy(*row, "tpl").orderBy("start", "diagonal")
    apart = (
        F.col("base") | (F.abs(F.col("diagonal") - F.lag("diagonal").over(place)) > SLACK) | (F.col("start") - F.lag("end").over(place) > SLACK + GRAM)
    )
    numbered = votes.withColumn("place", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(place))
    places = numbered.groupBy(*row, "n_words", "tpl", "label", "base", "place").agg(
        F.max("grams").alias("grams"), F.min("start").alias("start"), F.min("diagonal").alias("diagonal"), F.array_distinct(F.flatten(F.collect_list("held"))).alias("held")
    )
    share = F.when(F.col("tpl").isNotNull(), F.size("held") / F.col("grams"))
    places = places.withColumn("share", share).withColumn("found", F.when(F.col("base"), F.col("share") == 1).otherwise(F.col("share") >= LEAST))
    base, found = F.col("base") & F.col("found"), F.coalesce(F.col("found"), F.lit(False))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    result = places.groupBy(*row).agg(
        F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(found, F.col("label"))).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(found, F.struct("start", "label", "share")))).alias("places"),
    )
    return result


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the text, each row with its results; rows that repeat key and text included."""
    found = scan(docs, key, text, **options)
    rest = [c for c in others(docs, list(RESULTS)) if c not in (key, text)]
    if not rest:
        times = docs.groupBy(col(key).alias("_k"), F.xxhash64(col(text)).alias("_t"), F.length(col(text)).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
        same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_text") == F.col("_t")) & F.col("_len").eqNullSafe(F.col("_l"))
        many = found.join(times, same).withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
        return many.select(F.col("_key").alias(key), *RESULTS)
    rows = docs.select(col(key), *[col(c) for c in rest], F.xxhash64(col(text)).alias("_t"), F.length(col(text)).alias("_l"))
    same = rows[key].eqNullSafe(found["_key"]) & (F.col("_text") == F.col("_t")) & F.col("_len").eqNullSafe(F.col("_l"))
    return rows.join(found, same).select(rows[key], *[rows[c] for c in rest], *RESULTS)
