"""The registered queries of this package: each operator on its whole table, with the digests asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulyard.llm import chat, decontaminate, extraction, licenses, mixing, packing, pii, quality, simhash, spelling, suffix_tree, token_counts, trie
from haulyard.llm.frames import table
from haulyard.session import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def texts(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", *more)


@query
def op1_decontaminate(spark, folder):
    found = decontaminate.scan(texts(spark, folder), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"),
    )


@query
def op2_quality(spark, folder):
    scored = materialise(quality.with_signals(texts(spark, folder, "lang").withColumn("copy", quality.copy_of())).drop("text"))
    limits = quality.cutoffs(scored, table(spark, folder, "labels"), "lang")
    out = quality.judged(scored, limits, "lang")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score", "cutoff")


@query
def op3_token_counts(spark, folder):
    return token_counts.counted(texts(spark, folder))


@query
def op4_simhash(spark, folder):
    return simhash.classes(texts(spark, folder)).withColumn("fingerprint", simhash.hexadecimal())


@query
def op5_mixing(spark, folder):
    docs = texts(spark, folder, "source")
    sized = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    return mixing.mix(sized, text=None).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


@query
def op6_main_text(spark, folder):
    return extraction.main_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op7_chat(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    out = chat.format_structs(chat.conversations(rows.unionByName(extra)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op8_pii(spark, folder):
    found = pii.with_spans(texts(spark, folder))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_term",
        F.sha2(pii.listed(F.col("base_spans")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op9_suffix_tree(spark, folder):
    return suffix_tree.score(texts(spark, folder))


@query
def op10_licenses(spark, folder):
    found = licenses.scanned(texts(spark, folder))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op11_spelling(spark, folder):
    return spelling.variants(spelling.vocabulary(texts(spark, folder)))


@query
def op12_conversation_trie(spark, folder):
    own = trie.sequences(table(spark, folder, "conversations"))
    return trie.trie(trie.rebuilt(materialise(own))).drop("turn")


@query
def op13_packing(spark, folder):
    return packing.packed(texts(spark, folder), ids=False)
