"""Decontamination, quality rules, PII, licenses, chat and HTML against plain versions and planted cases."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from haulyard.llm import chat, decontaminate, extraction, licenses, pii, quality
from haulyard.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, score double, spans string, n_words string"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def odd_rows(*texts):
    """Rows with missing ids and texts, repeated rows, and columns named like results."""
    rows = [(i, t, "en", 1.0, "x", "y") for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, texts[-1], None, None, None, None), (90, None, "en", None, None, None), (91, "", None, 0.0, "", ""), (92, " \n\t ", "de", 0.0, "", "")]


# ---- decontamination ------------------------------------------------------------------------

ITEMS = [(1, "a b c d e f g h i j k l m n o p"), (2, "Short item"), (3, ""), (4, None), (5, "Éa é-b c"), (10, "a b c d e f g h i j k l m"), (None, "no id here")]


def test_decontamination_against_brute_force(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice("abcdefghijklmnop") for _ in range(3000))
    texts = [
        "x A, b c d e f g h i j k l m y", "x a b c d e f g h i j k l m n o p q " * 3, "a b c d e f g h i j k l", "SHORT  item, short ITEM", "short x item",
        "éa É b c éa é b c", long + " no id here " + long, "no id here",
    ]
    docs = frame(spark, odd_rows(*texts), DOCS)
    items = frame(spark, [*ITEMS, (1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    for part_bytes in (1 << 20, 20):  # all at once, and in many parts
        got = decontaminate.scan(docs, items, part_bytes=part_bytes).select(
            "doc_id", "text", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), decontaminate.contaminated()
        ).collect()
        assert len(got) == docs.count()
        for r in got:
            assert tuple(r[2:]) == brute.contamination(r.text, ITEMS), r.text


def test_decontamination_of_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b")]), frame(spark, [], "item_id long, text string")
    assert decontaminate.scan(docs, items).collect()[0].n_hit == 0
    assert decontaminate.scan(docs.limit(0), frame(spark, ITEMS, "item_id long, text string")).count() == 0


def test_documents_and_spans_removed(spark):
    docs = frame(spark, [(1, "Short item, and then other words"), (2, "clean words only"), (3, None), (4, "x " * 100 + "a b c d e f g h i j k l m")])
    items = frame(spark, ITEMS, "item_id long, text string")
    assert {r.doc_id for r in decontaminate.drop_documents(docs, items).collect()} == {2, 3}
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, items).collect()}
    assert cut == {1: ", and then other words", 2: "clean words only", 3: None, 4: "x " * 100}


# ---- quality --------------------------------------------------------------------------------


def test_signals_against_brute_force(spark):
    rng = random.Random(2)
    texts = ["a b c a b c", "w " * 60, "| # $ < é\u00a0ü\u2028x", "l\nl\n \n \nl", "a\r\nb\x0bc\x0cd", "é " * 3, "a a a a", "x y z"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(200))) for _ in range(40)]
    got = quality.with_signals(frame(spark, odd_rows(*texts), DOCS)).collect()
    assert len(got) == len(texts) + 6
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.signals(r.text)


def test_binomial_tail():
    for k, n, p in [(0, 10, 0.02), (3, 200, 0.02), (5, 40, 0.3), (40, 40, 0.1), (0, 0, 0.1)]:
        assert quality.binomial_tail(k, n, p) == pytest.approx(brute.tail(k, n, p))


def test_cutoffs_walk_down_while_the_risk_is_proven(spark):
    # stratum a: good documents score 0 but for a few; b: too few labels; c: good documents score high
    rows = [(i, "a", i % 200 == 0 and 1.2 or 0.0, False) for i in range(2000)]
    rows += [(5000 + i, "b", 0.0, False) for i in range(20)] + [(6000 + i, "c", 9.0, False) for i in range(1000)]
    rows += [(7000 + i, None, 0.0, False) for i in range(1000)]
    scored = frame(spark, rows, "doc_id long, lang string, score double, base_failed boolean")
    labels = frame(spark, [(r[0], 1) for r in rows] + [(None, 1), (1, None), (99999, 1), (3, 0)], "doc_id long, quality int")
    got = {r.stratum: r for r in quality.cutoffs(scored, labels, "lang").collect()}
    level = quality.ERROR / 4
    passing = [c for c in quality.CUTOFFS if brute.tail(sum(r[2] > c for r in rows[:2000]), 2000, quality.RISK) <= level]
    assert got["a"].cutoff == min(passing) and got["a"].n_good == 2000
    assert got["b"].cutoff is None and got["c"].cutoff is None
    assert got[None].cutoff == min(quality.CUTOFFS)
    kept = quality.judged(scored, quality.cutoffs(scored, labels, "lang"), "lang")
    assert kept.where("kept").count() == sum(1 for r in rows if not (r[1] == "a" and r[2] > got["a"].cutoff))


def test_quality_filter_keeps_columns_and_clean_documents(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    docs = frame(spark, [(1, clean, "en", "s", "x"), (2, "word " * 80, "en", "s", "x"), (3, None, None, None, None)], "doc_id long, text string, lang string, source string, score string")
    labels = frame(spark, [], "doc_id long, quality int")
    got = quality.filter_documents(docs, labels)
    assert got.columns == docs.columns and [r.doc_id for r in got.collect()] == [1]
    assert quality.filter_documents(docs.limit(0), labels).count() == 0


# ---- personal data --------------------------------------------------------------------------

PERSONAL = [
    "a.b@c.com_d@e.org x@y z@q.r.s", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4 1.2.3", "4539 1488 0343 6467, 4539148803436467 4539-1488-0343-6468",
    "+1 (988) 555-2485 +1.2 ++49 30 1234567 +123456789012345678", "é ü@x.de 💥 10.0.0.1 💥 +44 20 7946 0958.", "9" * 3000, "1 " * 2000, "a" * 3000 + "@", "+1" + "(" * 3000,
]


def test_base_spans_against_brute_force(spark):
    rng = random.Random(3)
    texts = PERSONAL + ["".join(rng.choice("a1.@+ -()9") for _ in range(80)) for _ in range(150)]
    got = pii.with_spans(frame(spark, odd_rows(*texts), DOCS)).collect()
    assert len(got) == len(texts) + 6
    for r in got:
        assert [(s.start, s.kind, s.end) for s in r.base_spans] == brute.personal(r.text), r.text


def test_terms_that_name_an_entity_are_replaced(spark):
    rows = [(i, f"w{i} Zorgon writes from eve@x.org about the w{i + 1}") for i in range(6)]
    rows += [(100 + i, f"the plain text {i} about nothing writes from here") for i in range(800)]
    rows += [(1400, "a zorgon alone"), (1401, None), (1402, ""), (0, rows[0][1])]
    docs = frame(spark, rows).withColumn("n_chars", F.length("text"))
    assert {r.term for r in pii.disclosing_terms(docs, "text").collect()} == {"zorgon"}
    got = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert got[0].text == "w0 [TERM] writes from [EMAIL] about the w1" and got[0].n_chars == len(got[0].text)
    assert got[1400].text == "a [TERM] alone" and got[1401].text is None and got[1402].text == "" and got[150].text == docs.where("doc_id = 150").first().text
    assert pii.sanitise(docs).count() == len(rows) and pii.sanitise(docs, remove_terms=True).where("doc_id = 1400").first().text == "a  alone"
    assert pii.sanitise(docs.limit(0)).count() == 0


def test_terms_beside_an_entity_that_touches_other_characters(spark):
    around = ["Zorgon <eve@x.org> w{}", "v{} (eve@x.org), Zorgon", "email:eve@x.org Zorgon", "Zorgon " + "x{}" * 300 + " \"eve@x.org\".", "<eve@x.org> " + "é{}" * 300 + " Zorgon"]
    rows = [(i, text.replace("{}", str(i))) for i, text in enumerate(around)] + [(100 + i, f"plain text {i}") for i in range(800)]
    assert {r.term for r in pii.disclosing_terms(frame(spark, rows), "text", support=5).collect()} == {"zorgon"}


def test_overlapping_spans_become_one(spark):
    docs = frame(spark, [(1, "call 1.2.3.4@x.org now, 10.0.0.1")])
    assert pii.sanitise(docs).first().text == "call [EMAIL] now, [IP]"


# ---- licenses -------------------------------------------------------------------------------

LICENSED = [
    "Cc-by, then CC BY 4.0 and cc x by", "all Rights reserved all rights reserved. ALL RIGHTS, RESERVED", "the general public-license", "all rights",
    "This work is licensed under the GNU General Public License, version 3.", "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software",
    "w " * 3000 + "cc by", "cc cc by by cc by",
]


def test_license_places_against_brute_force(spark):
    docs = frame(spark, odd_rows(*LICENSED), DOCS)
    got = licenses.scanned(docs).collect()
    assert len(got) == docs.count() and "lang" in got[0].asDict()
    slim = licenses.scanned(docs.select("doc_id", "text")).drop("places")
    assert slim.count() == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        want = brute.licenses(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want, texts[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_notices_with_changes(spark):
    got = {r.doc_id: r for r in licenses.scanned(frame(spark, list(enumerate(LICENSED)))).collect()}
    assert "gpl-notice" in got[4].labels.split(",") and "mit" in got[5].labels.split(",")
    assert got[6].score == 1.0 and got[3].labels == ""
    assert licenses.scanned(frame(spark, [])).count() == 0


# ---- chat -----------------------------------------------------------------------------------

RECORDS = [
    ('{"prompt": "a<b>", "completion": "\\\\l c"}', "prompt_completion", [("user", "a<b>"), ("assistant", "\\l c")]),
    ('{"instruction": "i", "output": null, "id": 3}', "instruction", [("user", "i"), ("assistant", "")]),
    ('{"output": "o", "input": "k", "instruction": "i"}', "instruction_input", [("system", "i"), ("user", "k"), ("assistant", "o")]),
    ('{"messages": [{"role": "human", "content": "x"}, {"content": "</turn>\\n<turn user>", "role": "gpt"}]}', "messages", [("user", "x"), ("assistant", "</turn>\n<turn user>")]),
    ('{"id": "z", "conversations": [{"from": "gpt", "value": "y"}]}', "conversations", [("assistant", "y")]),
    ('{"data": {"dialog": [{"speaker": null, "text": "t"}]}}', "dialog", [("", "t")]),
    ('{"other": 1}', None, None), ("no json", None, None), (None, None, None), ("", None, None),
]


def test_layouts_by_fingerprint(spark):
    docs = frame(spark, [(i, r[0], "old") for i, r in enumerate(RECORDS)], "id long, record string, layout string")
    out = chat.format_records(docs).select("id", "layout", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    for r in out.collect():
        _, layout, turns = RECORDS[r.id]
        assert r.layout == layout and (r.turns and [tuple(t) for t in r.turns]) == turns
        if turns:
            assert r.loss == "".join(t for role, t in turns if role == "assistant")


def test_typed_and_json_fingerprints_agree(spark):
    for name, example, _ in chat.LAYOUTS:
        row = spark.sql(f"select '{example}' as record")
        typed = spark.read.json(spark.sparkContext.parallelize([example]))
        one = chat.format_records(row).first()
        two = chat.format_structs(typed.select(F.struct(*typed.columns).alias("record"))).first()
        assert one.layout == two.layout == name and one.fingerprint == two.fingerprint


def test_escapes_round_trip(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("\\<>lgb/tun\n") for _ in range(30)) for _ in range(300)]
    rows = frame(spark, [(i, 0, "a<\\>g", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    out = chat.format_structs(chat.conversations(rows)).select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()
    assert all([tuple(x) for x in r.t] == [("a<\\>g", texts[r.conv_id])] for r in out)


def test_conversations_against_brute_force(spark):
    odd = r"\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (2, 0, "assistant", odd), (None, 3, "system", "\\l<"), (3, 5, "assistant", "")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"<turn {i}>\n") for i in range(2000)]
    want = brute.conversations(rows)
    grouped = chat.format_structs(chat.conversations(frame(spark, rows, "conv_id long, turn long, role string, text string")))
    turns = F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    got = grouped.select("conv_id", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("l"))
    got = got.select("conv_id", F.size("t"), F.sha2(F.array_join(turns, ""), 256), F.length("l"), F.sha2("l", 256)).collect()
    assert {r.conv_id: tuple(r[1:]) for r in got} == want


# ---- pages ----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body class="no-sidebar">
<header>Top</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>gone</p> --><div class="ad">Buy</div>
<div class="wrap"><div class="post-%d"><h1>Head &amp; tail</h1><p><b>One   two.<br><p>Three&nbsp;four<p>&lt;five&gt; <a href="#">link</a></p>
<div class="share">Share</div><ul><li>item<li>other</ul><form><input>Name</form><div class="comments"><p>Reader says</p></div></div>
<aside>Side</aside></div><div id="cookie-notice">Cookies</div><footer>&copy; me</footer>"""
WANTED = "Head & tail\nOne two.\nThree four\n<five> link\nitem\nother"


def test_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE % i) for i in range(5)]
    rows += [(10, "http://h.example/x", "<main><p>Only here</main>"), (11, "http://h.example/y", None), (12, None, PAGE % 7), (13, "not a url", ""), (14, "http://t.example", "no tags &eacute; <b>at</b> all"), (0, "http://h.example/0", PAGE % 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n_chars", F.lit("clash"))
    got = {r.page_id: r for r in extraction.main_text(pages).collect()}
    for i in (0, 1, 4, 12):
        assert got[i].text == WANTED, got[i].text
    assert got[10].text == "Only here" and got[11].text == "" and got[13].text == "" and got[14].text == "no tags é at all"
    assert all(r.n_chars == len(r.text) for r in got.values()) and extraction.main_text(pages).count() == len(rows)
    assert extraction.main_text(pages.limit(0)).count() == 0


def test_hosts_vote_for_generalised_paths(spark):
    pages = spark.createDataFrame([(i, "http://h.example/a", PAGE % i) for i in range(12)], "page_id long, url string, html string")
    won = extraction.winners(pages).collect()
    assert [(r.host, r.path, r.votes) for r in won] == [("h.example", ">div.wrap>div.post-#", 12)]


def test_no_article_text_is_lost_outside_the_largest_container(spark):
    lead, body = "lead " * 30, "body " * 70
    split = f"<nav>Menu</nav><div class=wrap><article><div class=lead>{lead}</div><div class=body>{body}</div></article></div>"
    quote = f"<article><p>{lead}</p><blockquote>{body}</blockquote></article>"
    path = extraction.vote(split)[0]
    assert path == ">div.wrap>article"
    for source in (split, quote, quote.replace("blockquote", "figure"), quote.replace("<blockquote>", "<table><tr><td>").replace("</blockquote>", "</table>")):
        for host in (None, path, ">article", ">div.wrap>article>div.body", ">article>blockquote"):
            assert extraction.extract(source, host) == f"{lead.strip()}\n{body.strip()}"


def test_article_text_with_plain_words_in_attributes_stays():
    kept = [
        "<h2 id=discussion>Heading</h2>", "<h2 id='related-work'>Works</h2>", "<h3 id=side-effects>Effects</h3>", "<section class=discussion><p>We discuss</p></section>",
        "<p title='the hidden cost'>Cost</p>", "<p class='md:block hidden lg:flex'>Wide</p>", "<p data-id=ads>Data</p>", "<section id=notice>Note</section>",
    ]
    gone = [
        "<div class=related><a href=/a>Another story</a> <a href=/b>One more</a></div>", "<p hidden>H</p>", "<p aria-hidden='true'>A</p>", "<p style='color:red; display: none'>N</p>",
        "<div role=search>S</div>", "<div class=share>Share</div>", "<div id=cookie-notice>C</div>", "<ul id=comments><li>Reader</ul>",
    ]
    source = "<article><p>Text of it</p>" + "".join(a + b for a, b in zip(kept, gone)) + "</article><div class=banner>Welcome</div>"
    want = "Text of it\nHeading\nWorks\nEffects\nWe discuss\nCost\nWide\nData\nNote"
    assert extraction.extract(source, None) == want and extraction.vote(source)[0] == ">article"


def test_broken_pages_end(spark):
    for source in ("<", "<p", "<!--", "<script>", "<div class='", "</p></div>", "<div>" * 2000 + "x", '<a "' * 2000, "&" * 5000):
        extraction.extract(source, None)
    assert extraction.extract("<div>" * 2000 + "x", None) == "x"


def test_registered_pages_and_documents(spark, data):
    pages = QUERIES["op6_main_text"](spark, data).collect()
    assert pages and all(r.text and "Menu" not in r.text and "<p" not in r.text and r.n_chars == len(r.text) for r in pages)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in QUERIES["op8_pii"](spark, data).collect():
        base = brute.personal(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
    for r in QUERIES["op10_licenses"](spark, data).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(texts[r.doc_id])
    for r in QUERIES["op2_quality"](spark, data).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.signals(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
