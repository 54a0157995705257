"""SimHash classes, mixing, the suffix tree, token files and the pipeline against plain versions."""

import math
import random
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulyard.llm import mixing, quality, simhash, suffix_tree, token_counts
from haulyard.llm.components import components
from haulyard.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string, fingerprint string, size string, score double"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def prose(rng, n, words=40):
    return " ".join(f"w{min(rng.randrange(words), rng.randrange(words))}" for _ in range(n))


# ---- near copies ----------------------------------------------------------------------------


def test_fingerprints_against_brute_force():
    rng = random.Random(5)
    texts = [None, "", " \n ", "A b", "one two three four", "ONE  two\tthree four", "é Ü ß ñ é Ü", " x y z w v"]
    texts += [prose(rng, rng.randrange(1, 700)) for _ in range(30)] + ["a b c " * 3000]
    got = simhash.fingerprints([t.encode() if t is not None else None for t in texts])
    assert got.tolist() == [brute.simhash(t) for t in texts]


@pytest.mark.parametrize("tile", [4, 64, 8192])
def test_links_connect_exactly_what_is_near(spark, tile):
    rng = random.Random(6)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    prints = set(seeds)
    for s in seeds:
        for _ in range(8):
            for _ in range(rng.randrange(1, 7)):
                s ^= 1 << rng.randrange(64)
            prints.add(s)
    prints |= {(7 << 40) | x for x in range(200)}  # one dense block
    prints = sorted(prints)
    root = brute.near(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = components(simhash.links(frame(spark, [(p,) for p in signed], "fingerprint long"), tile=tile)).collect()
    of = {r.node: r.root for r in found}
    groups, want = defaultdict(set), defaultdict(set)
    for i, p in enumerate(signed):
        groups[of.get(p, p)].add(p)
        want[root[i]].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_links_of_a_dense_block_are_no_more_than_its_members():
    prints = np.array([x for x in range(1024)], np.uint64)
    links = simhash.joining_links(prints, None, 4)
    assert len(links) == 1023
    both = simhash.joining_links(prints[:500], prints[500:], 4)
    assert len(both) < 1024


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.node: r.root for r in components(frame(spark, edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[i] == 100 for i in range(101, 160)) and got[301] == 300 and 200 not in got
    assert components(frame(spark, [], "a long, b long")).count() == 0


def copies(rng):
    base = prose(rng, 400)
    rows = [(i, base) for i in range(20)] + [(50 + i, base + f" end{i}") for i in range(10)]
    rows += [(100 + i, prose(rng, 60, 5000)) for i in range(40)] + [(200, None), (201, ""), (202, "\n "), (None, base), (100, "again"), (300, "tiny"), (301, "TINY")]
    return rows


def test_classes_against_brute_force(spark):
    rows = copies(random.Random(7))
    docs = frame(spark, [(*r, "s", "clash", "clash", 1.0) for r in rows], SCHEMA)
    got = simhash.classes(docs).withColumn("fingerprint", simhash.hexadecimal()).collect()
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.near(prints)
    least = {r: min((k for (k, _), x in zip(rows, root) if x == r and k is not None), default=None) for r in set(root)}
    want = Counter((k, f"{p:016x}", least[r]) for (k, _), p, r in zip(rows, prints, root))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k for (k, _), r in zip(rows, root) if k is None or k == least[r])
    assert simhash.keep_one(docs.limit(0)).count() == 0


# ---- mixing ---------------------------------------------------------------------------------


def test_targets_against_plain_filling(spark):
    rng = random.Random(8)
    for _ in range(6):
        sizes = {s: int(10 ** rng.uniform(0, 6)) for s in rng.sample(["a", "B", "é", "ä", "z", "", "zz", None], rng.randrange(1, 8))}
        got = mixing.targets(frame(spark, list(sizes.items()), "source string, source_size long")).collect()
        want = brute.targets(sizes)
        for r in got:
            assert r.target == pytest.approx(want[r.source], rel=1e-12)
        assert sum(r.target for r in got) == pytest.approx(sum(sizes.values()))


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_mix_comes_near_its_targets(spark, buckets):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(0, 60)), rng.choice(["a", "a", "a", "a", "b", "c", None]), "clash", "clash", 1.0) for i in range(900)]
    rows += [(None, None, "a", "", "", 0.0), (5, "repeated id", "b", "", "", 0.0), (900, " ", "empty", "", "", 0.0)]
    docs = frame(spark, rows, SCHEMA)
    got = mixing.mix(docs, buckets=buckets).collect()
    again = mixing.mix(docs.repartition(5), buckets=buckets).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    by = defaultdict(lambda: [0, 0, 0])
    for r in got:
        assert r.taken == r.copies * r.size <= 3 * r.size and r.size == len(brute.BLANK_WORD.findall(r.text or ""))
        by[r.source][0] += r.taken
        by[r.source][1] = r.target
        by[r.source][2] += r.size
    want = brute.targets({s: x[2] for s, x in by.items()})
    for s, (taken, target, _) in by.items():
        assert target == pytest.approx(want[s]) and abs(taken - target) <= 60


def test_mix_in_the_order_of_random_odds(spark):
    docs = frame(spark, [(i, "one two three four", "a" if i < 400 else "b", "", "", 1.0) for i in range(800)], SCHEMA)
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    # all documents are alike, so the sample has a fixed size
    assert sum(r.copies for i, r in got.items() if i < 400) == round(got[0].target / 4)
    lean = mixing.mix(docs.withColumn("weight", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)), emphasis="weight").collect()
    even, odd = (sum(r.copies for r in lean if r.doc_id % 2 == k) for k in (0, 1))
    assert even > 1.5 * odd
    assert mixing.mix(docs.limit(0)).count() == 0


# ---- suffix tree ----------------------------------------------------------------------------


def scored(spark, rows, **options):
    return suffix_tree.score(frame(spark, rows), **options).collect()


def test_base_scores_against_brute_force(spark):
    rng = random.Random(10)
    rows = [(i, prose(rng, rng.randrange(0, 80))) for i in range(120)] + [(None, "a B é"), (500, None), (501, ""), (502, " \t"), (3, rng.choice("xyz") * 5), (3, "again")]
    want = defaultdict(list)
    for (key, _), values in zip(rows, brute.unigram(rows)):
        want[key].append(values)
    for part_bytes in (1 << 20, 300):
        got = scored(spark, rows, part_bytes=part_bytes)
        assert len(got) == len(rows)
        have = defaultdict(list)
        for r in got:
            have[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score))
            assert math.isfinite(r.score)
        for key, values in want.items():
            for a, b in zip(sorted(have[key]), sorted(values)):
                assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
    assert scored(spark, []) == []


def test_states_sum_to_one_and_help_on_held_out_texts(spark):
    rng = random.Random(11)
    follow = {f"v{i}": [f"v{rng.randrange(30)}" for _ in range(3)] for i in range(30)}

    def text():
        w = ["v0"]
        for _ in range(80):
            w.append(rng.choice(follow[w[-1]]))
        return " ".join(w)

    rows = [(i, text()) for i in range(300)]
    got = scored(spark, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)
    tree = plain_tree(rows)
    assert len(tree.levels) > 1 and len(tree.levels[0]) > 10 and len(tree.words) > 20
    assert all(r.score == pytest.approx(tree.score(tokens(dict(rows)[r.doc_id])), rel=1e-9) for r in got)
    for context in [c for level in tree.levels for c in level] + [("v0", "v0"), ("v1", "\n")]:
        known = sum(10 ** tree.log_p(context, w) for w in tree.words)
        assert known + 10 ** tree.log_p(context, "never seen") == pytest.approx(1.0, abs=1e-6)


def tokens(text):
    return [*brute.BLANK_WORD.findall(brute.lower(text)), "\n"]


def plain_tree(rows, **options):
    return brute.PlainTree([tokens(t) for k, t in rows if not suffix_tree.held_out(k)], **options)


@pytest.mark.parametrize("part_bytes", [1 << 20, 900])
def test_tree_scores_against_a_plain_tree(spark, part_bytes):
    rng = random.Random(14)
    block = " ".join(rng.choices("abcdefgh", k=40))
    # nested repeats at the beginning of texts, in their middle and across lengths, one hot word, copies, odd rows
    rows = [(i, rng.choice([block, block[: rng.randrange(80)], "a a " * rng.randrange(9), " ".join(rng.choices("aaaabcdxyz", k=rng.randrange(60)))])) for i in range(200)]
    rows += [(900 + i, f"q{i} b c " + "d " * i) for i in range(30)] + [(None, "a b"), (950, None), (950, ""), (951, "A B C"), (951, "a b c")]
    for options in ({}, {"least_context": 4, "least_pair": 3, "divergence": 0.1}):
        tree = plain_tree(rows, **options)
        want = sorted((str(k), round(tree.score(tokens(t)), 6)) for k, t in rows)
        assert sorted((str(r.doc_id), round(r.score, 6)) for r in scored(spark, rows, part_bytes=part_bytes, **options)) == want
        assert len(tree.levels) >= 2


def test_tree_grows_with_the_corpus_and_in_depth(spark):
    rng = random.Random(13)
    # a context seen ten times among more than half a million training tokens
    rows = [(i, " ".join(rng.choices([f"f{k}" for k in range(50)], k=400))) for i in range(1800)]
    keys = [i for i in range(2000, 2100) if not suffix_tree.held_out(i)][:10]
    odd = next(i for i in range(2100, 2200) if suffix_tree.held_out(i))
    rows += [(i, "rare next") for i in keys] + [(odd, "rare next")]
    r = {r.doc_id: r for r in scored(spark, rows)}[odd]
    assert r.train_tokens > 500_000 and r.score > r.base_score + 3

    # what follows "a a" is known only from the word before them
    held = [r for r in scored(spark, [(i, "a a a b " * 30) for i in range(100)]) if r.held_out]
    assert sum(r.score for r in held) > -0.05 * sum(r.n_tokens for r in held)


def test_parts_are_visited_where_they_lie(spark):
    rows = spark.range(40).selectExpr("id AS part", "id AS n_active", "cast(id AS string) AS text").selectExpr("part", "n_active", "cast(text AS binary) AS data")
    stored, _ = suffix_tree._stored(rows, 12)
    visited = stored.groupBy("part").cogroup(spark.range(50).groupBy("id")).applyInArrow(lambda part, mail: part, suffix_tree.STATE)
    assert visited._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(r.part for r in visited.collect()) == list(range(40))


def test_a_part_carries_on_only_what_contexts_can_lie_in():
    part = suffix_tree.Part()
    keys = (k for k in range(1000) if not suffix_tree.held_out(k))
    for text in [b"a b c d"] * 12 + [" ".join(f"u{i}" for i in range(500)).encode(), b"a b c once"]:
        part.add(next(keys), text)
    row = {k: [v] for k, v in part.row(0).items()}
    words = suffix_tree.unpacked(row["words"][0])
    questions = suffix_tree.asked(0, 12, words["words"].view(np.uint64), n=words["counts"])
    told = [suffix_tree._add_up(questions.slice(i, 1)) for i in range(questions.num_rows)]
    mail = pa.concat_tables(t.append_column("kind", pa.array(["words"])) for t in told)
    work = suffix_tree.started(pa.table(row), mail, 12, 574, 506, 10, 2)
    kept = suffix_tree.unpacked(work.state())
    assert row["n_tokens"] == [12 * 5 + 501 + 5] and len(kept["tokens"]) == 12 * 5 + 1 + 5 - 1
    assert work.sums[12] < 0 and work.sums[0] == 0
    back = suffix_tree.Work.read(0, work.state(), 1, 12, 10)
    back.group()
    # end a, a b, b c, c d, d end; neither "c once" nor what follows rare words
    assert len(back.names) == 5 and list(back.own_counts()) == [13, 13, 13, 12, 12]
    assert len(back.at) == 12 * 5 + 1 + 4


# ---- token files ----------------------------------------------------------------------------


def write_files(folder, *files):
    folder.mkdir()
    for i, tokens in enumerate(files):
        (folder / f"part-{i:05d}-x").write_bytes(np.array(tokens, "<u2").tobytes())


@pytest.mark.parametrize("block", [1, 2, 3, 5, 1000])
def test_separator_scan_across_blocks(spark, tmp_path, block):
    rng = random.Random(12)
    end = token_counts.EOD
    files = [[rng.choice([1, 2, 3, end]) for _ in range(n)] for n in (0, 1, 7, 60, 61)] + [[end] * 9, [4] * 40, [4] * 20 + [end]]
    write_files(tmp_path / "t", *files)
    got = defaultdict(list)
    for r in token_counts.documents(spark, str(tmp_path / "t"), block).orderBy("file", "ordinal").collect():
        got[int(r.file.split("part-")[1][:5])].append((r.ordinal, r.start, r.n_tokens, r.ended))
    for i, tokens in enumerate(files):
        want, start = [], 0
        for at, token in enumerate(tokens):
            if token == end:
                want.append((len(want), start, at - start, True))
                start = at + 1
        if start < len(tokens):
            want.append((len(want), start, len(tokens) - start, False))
        assert got[i] == want


def test_token_counts_against_the_tokenizer(spark, data):
    encode = token_counts.encoder(open(token_counts.VOCABULARY, "rb").read()).encode_ordinary
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = QUERIES["op3_token_counts"](spark, data).collect()
    assert len(got) == len(texts) and all(r.n_tokens == len(encode(texts[r.doc_id])) for r in got)
    odd = frame(spark, [(None, "x y"), (1, None), (2, ""), (2, ""), (3, "<|endoftext|> é")]).coalesce(1)
    got = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.counted(odd, block=2).collect())
    assert got == [(0, 2), (1, 0), (2, 0), (2, 0), (3, len(encode("<|endoftext|> é")))]
    assert token_counts.counted(odd.limit(0)).count() == 0


# ---- pipeline -------------------------------------------------------------------------------


def test_registered_fingerprints_and_scores(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.near(prints)
    least = {r: min(k for (k, _), x in zip(rows, root) if x == r) for r in set(root)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash"](spark, data).collect()}
    assert got == {k: (f"{p:016x}", least[r]) for (k, _), p, r in zip(rows, prints, root)}
    want = dict(zip((k for k, _ in rows), brute.unigram(rows)))
    for r in QUERIES["op9_suffix_tree"](spark, data).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9)


def test_pipeline_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    score = {k: quality.signals(r.text.encode()) for k, r in rows.items()}
    good = defaultdict(list)
    for k, label in labels.items():
        if label == 1 and k in rows and not score[k][5]:
            good[rows[k].lang].append(score[k][6])
    cut = {}
    for lang, values in good.items():
        cut[lang] = math.inf
        for c in quality.CUTOFFS:
            if brute.tail(sum(v > c for v in values), len(values), quality.RISK) > quality.ERROR / len(good):
                break
            cut[lang] = c
    kept = [k for k in sorted(rows) if not score[k][5] and score[k][6] <= cut.get(rows[k].lang, math.inf)]
    root = brute.near([brute.simhash(rows[k].text) for k in kept])
    kept = [k for i, k in enumerate(kept) if root[i] == i]
    kept = [k for k in kept if not brute.contamination(rows[k].text, items)[4]]

    now, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, data)
        assert now.columns == docs.columns
        now = corpus_pipeline.materialise(now)
        seen.append(now.count())
    assert sorted(r.doc_id for r in now.collect()) == kept and seen == sorted(seen, reverse=True)
    for r in now.collect():
        if not brute.personal(rows[r.doc_id].text) and "[TERM]" not in r.text and "[NUMBER]" not in r.text:
            assert r.text == rows[r.doc_id].text
        assert not brute.personal(r.text) and r.n_chars == len(r.text)
    out = corpus_pipeline.run(spark, data).collect()
    assert {r.doc_id for r in out} <= set(kept) and all(0 < r.copies <= 3 for r in out)
    total = sum(len(brute.BLANK_WORD.findall(r.text)) for r in now.collect())
    assert sum(r.taken for r in out) == pytest.approx(total, rel=0.1)


def test_pipeline_of_nothing(spark, tmp_path, data):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{data}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
