"""HTML text, language, importance resampling, packing and the pipeline."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import html_text, importance, language, packing
from tests.llm.test_near_leaks import expected, leaked
from tests.llm.test_rules_lines_shards_urls import counts

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a href=/>Home</a></nav></header><div class="cookie-notice">We use cookies here to make it better.</div>
<div id="wrapper"><div class="content"><h1>Real title</h1><p>First   paragraph of the <a href=x>real</a> article &amp; so<br>on to win.
<div class="ad">Buy now this thing</div><p>Second &lt;b&gt; paragraph that also has&nbsp;many words, as articles do.</p>
<ul><li>Point one is here<li>Point two is here</ul><blockquote>Quoted words</blockquote><p>End.</p></div>
<aside><p>Side words here to read also</p></aside></div><section><h3>3 Comments</h3><p>I really liked it very much thank you.</p></section>
<form>Mail <input> <button>Go</button></form><footer>Foot</footer><script>var a="<p>x</p>"</script></body></html>"""
TEXT = (
    "Real title\n\nFirst paragraph of the real article & so on to win.\n\nSecond <b> paragraph that also has many words, as articles do."
    "\n\nPoint one is here\n\nPoint two is here\n\nQuoted words\n\nEnd."
)


def test_main_text():
    assert html_text.main_text(PAGE, {}) == TEXT
    marked = PAGE.replace('<div class="content">', "<article>").replace("</p></div>\n<aside>", "</p></article>\n<aside>")
    weights = html_text.weights_from(html_text.label_counts(marked))
    assert html_text.main_text(marked, weights) == TEXT
    assert html_text.main_text(PAGE, weights) == TEXT


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("<p>cut <b", "cut"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("<p>&am", "&am"),
        ("<script>never closed <p>x", ""), ("<!-- <p>no</p> --><p>yes</p>", "yes"), ("<p title='a > b'>c</p>", "c"), ("<p hidden>no</p><p>yes", "yes"),
        ("<p>x" + "<div>" * 3000 + "deep", "x"),
    ],
)
def test_odd_pages(source, text):
    found = html_text.main_text(source, {})
    assert found == text or (len(source or "") > 1000 and found in ("x", "deep"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/ap\"'= !-&;x\n", max_size=200))
def test_any_markup(source):
    found = html_text.main_text(source, {})
    assert found == "\n\n".join(" ".join(b.split()) for b in found.split("\n\n") if b.split())


LONG = ["The river rose by two metres in a single night and the lower town stood under water.",
        "Boats carried people from their roofs, and the school became a shelter for three hundred of them.",
        "Engineers had warned for years that the old dam needed work before the winter storms arrived."]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        (f"<body><div id=content><h1>Flood</h1>{paragraphs(LONG)}<h2>Discussion</h2>{paragraphs(LONG)}</div></body>", ["Flood", *LONG, "Discussion", *LONG]),
        (f"<article><div class=entry-content>{paragraphs(LONG)}<h3>Comments</h3><p>First!</p><p>Nice read.</p></div></article>", LONG),
        (f"<div class=wrap><div class=post>{paragraphs(LONG)}</div><h3>3 comments</h3><div><p>I was there too.</p></div></div>", LONG),
        (f"<article>{paragraphs(LONG[:1])}<section id=discussion>{paragraphs(LONG[1:])}</section></article>", LONG),
        (f"<article>{paragraphs(LONG[:1])}<div class=market-share>{paragraphs(LONG[1:])}</div></article>", LONG),
        (f"<article>{paragraphs(LONG)}<div class=share><a href=x>Post</a> <a href=y>Mail</a></div></article>", LONG),
        (f"<body><form action=x><input type=hidden>{paragraphs(LONG)}</form></body>", LONG),
        (f"<article><p>{LONG[0]} So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", [f"{LONG[0]} So x=2 holds."]),
    ],
)
def test_the_article_stays_whole(source, blocks):
    assert html_text.main_text(source, {}) == "\n\n".join(blocks)


def test_talk_headings():
    assert all(map(html_text.begins_talk, ["Comments", "3 comments", "Leave a Reply", "Post a comment", "No comments yet", "Reader comments (12)"]))
    assert not any(map(html_text.begins_talk, ["Discussion", "Comments on the ruling", "The reply of Rome", "Response times", "Flood", ""]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "<div>", "</div>", "<li>", "<a>", "</a>", "<b>", "word ", "two words ", "five words of plain text "]), max_size=14))
def test_scan_finds_the_best_range(parts):
    """The region's weight is that of the best of all ranges of items."""
    page = html_text.parse("".join(parts))
    out = html_text.excluded(page)
    sums = [html_text.score(item, {}) for item in page.items if not out[item[0] if len(item) == 4 else item[1]]]
    best = max((sum(sums[i:j]) for i in range(len(sums)) for j in range(i + 1, len(sums) + 1)), default=0)
    total, where = html_text.best_range(page, out, {})
    assert total == pytest.approx(max(best, 0))
    assert (where is None) == (best <= 0)


def test_long_and_deep_pages_take_time_in_proportion():
    import time

    def page(n):
        return "<div>word " * n + "<p>" + "text " * n + "</div>" * n + "</b>" * n + "<li>x" * n

    html_text.main_text(page(100), {})
    start = time.perf_counter()
    html_text.main_text(page(40_000), {})  # 1 MB
    assert time.perf_counter() - start < 30


def test_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").withColumn("text", F.lit("clash"))
    odd = spark.createDataFrame([(None, None, None, "x"), (7, "u", "", "x")], pages.schema)
    rows = html_text.extracted(pages.unionByName(odd)).collect()
    assert len(rows) == pages.count() + 2
    assert all(r.n_chars == len(r.text) for r in rows)
    assert sum(bool(r.text) for r in rows) == pages.count()
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_language(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    odd = [(100001, None, "en", "s", 0), (100002, "12 34 !?", None, "s", 0), (100003, "", "de", "s", 0), (None, "the and of", "en", "s", 0)]
    rows = language.identify(docs.unionByName(spark.createDataFrame(odd, docs.schema))).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(truth) + 4
    known = [r for r in rows if r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in known)
    held = [r for r in known if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert [(r.lang_pred, r.score) for r in rows if r.doc_id in (100001, 100002, 100003)] == [("und", 0.0)] * 3
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_more_languages_than_a_hundred(spark):
    """Each of 150 languages is learned, the rare ones too; repeated rows and clashing columns change nothing."""
    rng = np.random.default_rng(4)
    words = {f"l{i:03d}": ["".join(rng.choice(list("abcdefghijklmnoprstuvz"), 7)) for _ in range(40)] for i in range(150)}
    rows = [(i * 1000 + k, " ".join(rng.choice(words[name], 30)), name) for i, name in enumerate(words) for k in range(16 if i % 2 else 40)]
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string, lang string").withColumns({"__rows": F.lit("x"), "score": F.lit(9)})
    found = language.identify(docs).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held_out]
    assert len(found) == len(rows) + 20 and {r.lang_pred for r in held} == set(words)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98


def test_kernel_is_presence_overlap():
    letters = np.unpackbits(language.LETTERS).astype(bool)
    a, b = (set(language.spectrum(t, letters).tolist()) for t in ("the cat", "the cat! THE CAT"))
    assert a <= b and len(language.spectrum("12 ?", letters)) == 0
    grams = {" the cat "[i : i + n] for n in range(1, 5) for i in range(10 - n)}
    assert len(a) == len(grams)


def test_importance(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(None, None, "en", "s", 0), (-5, "", "en", "s", 0)], docs.schema)
    rows = importance.resampled(docs.unionByName(odd), labels).collect()
    known = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    share = sum(q == 1 and not t for q, t in known.values()) / len(known)
    assert len(rows) == docs.count() + 2
    assert sum(r.kept for r in rows) == int(np.ceil(share * len(rows)))
    kept = {kind: np.mean([r.kept for r in rows if r.doc_id in known and test(*known[r.doc_id])]) for kind, test in (
        ("good", lambda q, t: q == 1 and not t), ("junk", lambda q, t: q == 0), ("toxic", lambda q, t: t == 1))}
    assert kept["good"] > 0.93 and kept["junk"] < 0.03 and kept["toxic"] < kept["good"] - 0.3
    cut = min(r.gumbel_key for r in rows if r.kept)
    assert all(r.gumbel_key <= cut for r in rows if not r.kept)


def test_importance_without_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = importance.resampled(docs, labels, share=0.25).collect()
    assert sum(r.kept for r in rows) == 50 and {r.log_weight for r in rows} == {0.0}
    assert importance.resampled(docs.limit(0), labels).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path(packing.FILE))
    return found


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\t'sé<|endoftext|>1a", max_size=60))
def test_ids_are_those_of_the_file(text):
    own = test_ids_are_those_of_the_file
    if not hasattr(own, "pair"):
        whole = Tokenizer.from_file(public_tokenizers.path(packing.FILE))
        own.pair = packing.encoder(), whole
    for some in (text, f"{text}<|endoftext|>{text}"):
        assert own.pair[0](some) == own.pair[1].encode(some, add_special_tokens=False).ids


def test_other_tokenizer_file():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    assert packing.encoder(path)("Some  Words") == whole.encode("Some  Words", add_special_tokens=False).ids


def test_pack(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").limit(300).collect()}
    texts |= {10**6: None, 10**6 + 1: "", 10**6 + 2: "long " * 9000}
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, length int")
    rows = packing.pack(docs).collect()
    pieces = {i: sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start) for i in texts}
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert [x for r in pieces[i] for x in r.ids] == ids
        assert {r.doc_tokens for r in pieces[i]} == {len(ids)}
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids) for r in pieces[i])
        assert [r.start for r in pieces[i]] == list(np.cumsum([0] + [r.length for r in pieces[i]])[:-1])
    by_sequence = {}
    for r in sorted(rows, key=lambda r: r.offset):
        at = by_sequence.setdefault(r.sequence_id, 0)
        assert r.offset == at
        by_sequence[r.sequence_id] = at + r.length
    assert sorted(by_sequence) == list(range(len(by_sequence))) and max(by_sequence.values()) <= 1024
    assert sum(by_sequence.values()) > 0.97 * 1024 * len(by_sequence)
    whole = packing.sequences(packing.pack(docs)).collect()
    assert {len(r.ids) for r in whole} == {1024} and sorted(r.tokens for r in whole) == sorted(by_sequence.values())
    assert packing.pack(docs.limit(0)).count() == 0


def test_patterns_place_every_piece():
    rng = random.Random(1)
    for _ in range(20):
        histogram = {n: rng.randrange(1, 400) for n in rng.sample(range(1, 1025), rng.randrange(1, 300))}
        found = packing.patterns(dict(histogram))
        placed = Counter()
        for packs, pattern in found:
            assert sum(pattern) <= 1024
            for n in pattern:
                placed[n] += packs
        assert placed == histogram


def test_stages(spark):
    """Each stage against its definition, on its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("key", F.lit(1))
    extra = [(9001, None, None, None, None, 1), (9002, "", "en", "s", 0, 1), (None, "w " * 10, "en", "s", 20, 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.landed(stage(spark, docs, SMALL), f"test-{name}")
        kept[name] = ({r.doc_id: r.text for r in before.collect()}, docs)
        if name != "packing":
            assert docs.columns == before.columns
    before, after = kept["quality_rules"]
    ids = {r.doc_id for r in after.collect()}
    for i, text in before.items():
        n = counts(text)
        if n[0] < 50 or 100 * n[4] > 50 * n[0]:
            assert i not in ids
    labels = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    clean = {i for i, t in before.items() if i in labels and counts(t)[0] >= 50}
    assert clean <= ids
    before, after = kept["line_dedup"]
    assert {r.doc_id for r in after.collect()} == set(before) and all(r.n_chars == len(r.text) for r in after.collect())
    before, after = kept["near_dedup"]
    roots = expected(list(before.items()), corpus_pipeline.SIMILARITY)
    assert {r.doc_id for r in after.collect()} == {i for i, root in roots.items() if i == root}
    before, after = kept["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    ids = {r.doc_id for r in after.collect()}
    assert not {i for i, t in before.items() if any(x in t for x in items)} & ids
    gone = set(before) - ids
    assert all(any(leaked(before[i], x) >= 0.8 for x in items) for i in list(gone)[:3])
    before, after = kept["packing"]
    assert {r.doc_id for r in after.select("doc_id").collect()} == set(before)


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100
