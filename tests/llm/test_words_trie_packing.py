"""Spelling variants, the conversation trie and packing against plain versions."""

import functools
import random
import struct
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from haulyard.llm import packing, quality, simhash, spelling, token_counts, trie
from haulyard.llm.frames import table
from haulyard.llm.oracles import ORACLES
from haulyard.llm.queries import QUERIES
from tools.check import compare, connection

CLASHES = "doc_id long, text string, word string, n long, length int, piece string, sequence_id string"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# ---- spelling variants ----------------------------------------------------------------------


def planted_words(seed, n=260):
    """Words with many near ones: edits of each other, repeated letters, shared ends."""
    rng = random.Random(seed)
    letters = "abcdeéß÷"
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))) for _ in range(n // 4)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbaaa", "aaabbb"}
    while len(words) < n:
        w = rng.choice(sorted(words))
        i = rng.randrange(len(w) + 1)
        v = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :]])
        if 6 <= len(v) <= 14:
            words.add(v)
    return {w: rng.choice([5, 6, 24, 25, 26, 124, 125, 700]) for w in words}


@pytest.mark.parametrize("tile, lump", [(1, 50), (7, 1000), (32768, 40000)])
def test_variants_against_brute_force(spark, tile, lump):
    count = planted_words(tile)
    got = spelling.variants(frame(spark, list(count.items()), "word string, n long"), tile=tile, lump=lump).collect()
    assert len(got) == len(count)
    assert {tuple(r) for r in got} == brute.variants(count)


def test_index_holds_zero_and_one_error_sets():
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(7)) for _ in range(90)]
    index = spelling.PositionIndex(words)
    for size in (6, 7):
        queries = ["".join(rng.choice("abc") for _ in range(size)) for _ in range(40)]
        q, w = index.one_edit(queries)
        assert sorted(zip(q.tolist(), w.tolist())) == [(i, j) for i, x in enumerate(queries) for j, y in enumerate(words) if brute.one_edit(x, y)]


def test_vocabulary_counts_and_damage(spark, data):
    rng = random.Random(4)
    pool = ["Straße", "éclair", "ÉCLAIRS", "letters", "LETTERS", "naïveté", "short", "sixsix", "a×bcd÷e"]
    docs = [(i, " ".join(rng.choice(pool) + rng.choice(["", "!", "7", "-x"]) for _ in range(60))) for i in range(120)]
    docs += [(None, "nullkey nullkey " * 4), (7, None), (8, ""), (9, " \n 12 "), docs[3], docs[3], (200, "verylong" * 4000 + " letters")]
    for fewest, damage in ((5, 199), (1, 7)):
        got = spelling.vocabulary(frame(spark, docs), fewest=fewest, damage=damage)
        assert {r.word: r.n for r in got.collect()} == brute.damaged_words(docs, fewest, damage)


def test_registered_spelling_query_on_whole_table(spark, data):
    docs = [tuple(r) for r in table(spark, data, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op11_spelling"](spark, data)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute.variants(brute.damaged_words(docs))


def test_variants_of_nothing_and_with_clashing_columns(spark):
    empty = frame(spark, [], CLASHES)
    assert spelling.variants(spelling.vocabulary(empty)).collect() == []
    rows = [(i, "letters letterz " * 3, "w", 1, 1, "p", "s") for i in range(3)] + [(9, "letters " * 60, None, None, None, None, None)]
    got = {r.word: r for r in spelling.variants(spelling.vocabulary(frame(spark, rows, CLASHES), damage=None)).collect()}
    assert got["letterz"].form == got["letterz"].root == "letters" and got["letterz"].form_n == 69
    assert got["letters"].form is None and got["letters"].n_near == 1


# ---- conversation trie ----------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def trie_rows(spark, rows, shard_bytes, rebuild=True, schema=TURNS):
    own = trie.sequences(frame(spark, rows, schema))
    out = trie.trie(trie.rebuilt(own) if rebuild else own, shard_bytes)
    return sorted((*(-1 if v is None else v for v in tuple(r)[:7]), r.ends_sha256) for r in out.drop("turn").collect())


def some_conversations(seed, n=150):
    rng = random.Random(seed)
    said = ["", "hello", "ok", "é ß", "x" * 300, None]
    rows = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.choice([1, 2, 3, 9, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(said[: rng.choice([2, 6])])))
    return rows + [(1000 + i, 0, "user", "hello") for i in range(60)]


@pytest.mark.parametrize("shard_bytes", [150, 2000, 1 << 24])
def test_trie_against_brute_force(spark, shard_bytes):
    rows = some_conversations(shard_bytes)
    rows += [(2000, None, "user", "null turn"), (2000, 0, "user", "first"), (2001, 0, "user", "same"), (2001, 0, "user", "same"), (2002, 0, None, None), (None, 0, "user", "nobody")]
    assert trie_rows(spark, rows, shard_bytes) == brute.trie(rows)


def test_registered_trie_on_whole_table(spark, data):
    rows = [tuple(r) for r in table(spark, data, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_trie"](spark, data).collect()
    assert sorted((*(-1 if v is None else v for v in tuple(r)[:7]), r.ends_sha256) for r in got) == brute.trie(rows)


def test_deep_conversations_and_prefixes_that_end_at_a_shard_border(spark):
    deep = [(5 * c, t, "user", f"t{t}" if t < 700 else f"{c} {t}") for c in range(6) for t in range(700 + 3 * c)]
    short = [(5 * (10 + c), t, "user", f"t{t}") for c in range(12) for t in range(1 + c * 60)]
    rows = deep + short
    assert trie_rows(spark, rows, 20_000) == brute.trie(rows)


def test_trie_of_nothing_and_with_clashing_columns(spark):
    assert trie_rows(spark, [], 1000) == []
    rows = [(c, 0, "user", "hi", "k", "d", "e") for c in (5, 10, 15)]
    wide = TURNS + ", key string, depth string, ends_sha256 string"
    assert trie_rows(spark, rows, 1000, schema=wide) == brute.trie([r[:4] for r in rows])


def test_turns_can_be_read_from_the_dictionary(spark):
    rows = frame(spark, [(0, 0, "user", "a"), (0, 1, "assistant", "bc"), (5, 0, "user", None)], TURNS)
    named = trie.trie(trie.sequences(rows)).join(trie.dictionary(rows), "turn").select("depth", "role", "text").collect()
    assert sorted(map(tuple, named)) == [(1, "user", ""), (1, "user", "a"), (2, "assistant", "bc")]


def test_tree_stays_balanced():
    tree = trie.TernaryTree()
    for i in trie.median_order(1000):
        tree.insert([i])

    def height(node):
        return 1 + max(height(tree.low[node]), height(tree.high[node])) if node else 0

    assert sorted(trie.median_order(1000)) == list(range(1000)) and height(tree.equal[0]) == 10


# ---- packing --------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_two_fit_sequence_by_sequence(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 100])
    lengths = [rng.choice([rng.randrange(1, capacity + 1), rng.randrange(1, 1 + capacity // 3), capacity // 3 + 1]) for _ in range(rng.randrange(1, 120))]
    steps = packing.plan(Counter(lengths), capacity)
    assert [own for times, own in steps for _ in range(times)] == brute.best_two_fit(lengths, capacity)


def test_two_fit_uses_fewer_sequences_than_greedy():
    counts = {51: 4, 29: 4, 26: 4, 23: 4, 27: 2, 24: 2, 10: 3, 7: 3}
    steps = packing.plan(counts, 100)
    used = Counter(n for times, own in steps for n in own for _ in range(times))
    assert used == Counter(counts) and all(sum(own) <= 100 for _, own in steps)


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


def plain_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = [
    None, "", " \n\t ", "Hello, WORLD's end!", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "it's I'LL we've \x1c\x85\xa0 x y", "İstanbul ΟΔΟΣ ΣΑΣ é é ́x K Å",
    "日本語 テスト 12 345 ½ ²", "x" * 5000, "😀😀 a‍b", "don'tcan't''s 's", "\x00 nul\x00nul", "word " * 5000, "'" * 50 + "s",
]


def test_ids_by_words_equal_the_tokenizer(data, spark):
    texts = TEXTS + [r.text for r in table(spark, data, "documents").select("text").collect()]
    with open(packing.vocabulary_path(), "rb") as file:
        encode = packing.WordIds(file.read())
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        flat, stops = encode([t.encode() if t is not None else None for t in part])
        for text, ids in zip(part, np.split(flat, stops)):
            assert ids.tolist() == plain_ids(text), text


def check_packing(docs, rows, capacity=2048):
    want = Counter()
    for key, text in docs:
        ids = plain_ids(text)
        for p in range(-(-len(ids) // capacity)):
            own = ids[p * capacity : (p + 1) * capacity]
            want[key, p, p * capacity, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        stop = 0
        for offset, length in sorted(own):
            assert offset == stop
            stop += length
        assert stop <= capacity
    return places


def test_registered_packing_on_whole_table(spark, data):
    docs = [tuple(r) for r in table(spark, data, "documents").select("doc_id", "text").collect()]
    rows = QUERIES["op13_packing"](spark, data).collect()
    places = check_packing(docs, rows)
    total = sum(r.length for r in rows)
    assert len(places) <= 1.01 * total / 2048 + 1


def test_packing_of_odd_rows_in_many_tasks(spark):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no key"), (3, "Hello, WORLD's end!"), (3, "Hello, WORLD's end!")] + [(100 + i, "a b c " * (i % 40)) for i in range(500)]
    wide = frame(spark, [(*d, "w", 1, 2, "p", "s") for d in docs], CLASHES).repartition(7)
    placed = packing.packed(wide, capacity=64)
    places = check_packing(docs, placed.drop("ids").collect(), 64)
    out = packing.sequences(placed).collect()
    assert len(out) == len(places)
    texts = Counter(zlib.crc32(r.ids[4 * a : 4 * (a + n)]) for r in out for a, n in zip(np.cumsum([0, *r.lengths]).tolist(), r.lengths))
    assert texts == Counter(r.ids_crc32 for r in placed.collect())
    assert packing.packed(frame(spark, [], CLASHES)).collect() == []


# ---- registered queries with SQL, and repeated or shuffled rows -------------------------------


@pytest.fixture(scope="module")
def duck(data):
    return connection(data)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, duck, data, name):
    assert compare(spark, duck, name, data).startswith("ok")


@pytest.mark.parametrize("shuffled", ["groupBy", "dropDuplicates", "repartition", "join"])
def test_token_counts_of_shuffled_rows(spark, shuffled):
    docs = frame(spark, [(i, f"w{i} " * (1 + i % 50)) for i in range(1000)])
    made = {
        "groupBy": lambda: docs.groupBy("doc_id").agg(F.max("text").alias("text")),
        "dropDuplicates": lambda: docs.union(docs).dropDuplicates(["doc_id"]),
        "repartition": lambda: docs.repartition(6),
        "join": lambda: docs.join(docs.select("doc_id").where("doc_id % 2 = 0"), "doc_id"),
    }[shuffled]()
    encode = token_counts.encoder(open(token_counts.VOCABULARY, "rb").read()).encode_ordinary
    got = {r.doc_id: r.n_tokens for r in token_counts.counted(made, block=64).collect()}
    ids = range(0, 1000, 2 if shuffled == "join" else 1)
    assert got == {i: len(encode(f"w{i} " * (1 + i % 50))) for i in ids}


def test_keep_one_judges_rows_not_keys(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, c), (None, "no key " * 30), (None, "no key " * 30), (9, None), (8, "")]
    wide = frame(spark, [(*r, "s", "f") for r in rows], "doc_id long, text string, source string, fingerprint string").repartition(3)
    kept = simhash.keep_one(wide)
    assert kept.columns == wide.columns
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(got, key=repr) == sorted([(1, a), (5, b), (7, c), (None, "no key " * 30), (8, "")], key=repr)


def test_repeated_labels_and_copies_prove_nothing(spark):
    rows = [(i, "en", 0.0, False, i) for i in range(60)]
    schema = "doc_id long, lang string, score double, base_failed boolean, copy long"
    labels = frame(spark, [(i, 1) for i in range(60)] * 5, "doc_id long, quality int")
    assert quality.cutoffs(frame(spark, rows, schema), labels, "lang").first().cutoff is None
    copies = [(i, "en", 0.0, False, i % 60) for i in range(600)]
    labels = frame(spark, [(i, 1) for i in range(600)], "doc_id long, quality int")
    assert quality.cutoffs(frame(spark, copies, schema), labels, "lang").first().cutoff is None
    apart = frame(spark, [(*r[:4], r[0]) for r in copies], schema)
    assert quality.cutoffs(apart, labels, "lang").first().cutoff is not None
