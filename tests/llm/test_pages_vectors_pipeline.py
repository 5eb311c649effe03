"""Pages, vectors, the pipeline and the registered queries."""

import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
import corpus_pipeline
from factloom.llm import ann, html_main


# ------------------------------------------------------------------ 5: pages
def test_pages_give_their_article(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in html_main.extract_pages(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:p|h1)>", "\n\n", article)).split("\n\n")
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert got[r.page_id] == (want, len(want))


def _host(n, body):
    """Pages of a host without article elements: ``body`` gives the middle of page i."""
    return [(i, "https://plain.example/x", f"<html><body><div>Daily paper</div><p>All about us</p>{body(i)}"
             f"<div id=story>{''.join(f'<p>Story {i} says {j} of it.</p>' for j in range(3))}</div><b>Printed here</b></body></html>")
            for i in range(n)]


def _main_texts(spark, rows):
    found = html_main.templates(spark.createDataFrame(rows, "page_id long, host string, html string"))
    got = found.collect()
    assert len(got) == 1
    return set(got[0].template_text)


def _held(parts, template):
    """Those of the texts of ``parts`` (text, path of its element) that the template holds."""
    class At:
        def __init__(self, path):
            self.path = path
    return {t for t, path in parts if html_main.run_token(At(path), t) in template}


def test_places_on_every_longest_run():
    rng = random.Random(6)
    for _ in range(300):
        keys = [rng.randrange(9) for _ in range(rng.randrange(8))]
        runs = [c for n in range(len(keys) + 1) for c in itertools.combinations(range(len(keys)), n)
                if all(keys[a] < keys[b] for a, b in zip(c, c[1:]))]
        best = [set(c) for c in runs if len(c) == max(map(len, runs))]
        assert html_main.in_order(keys) == set.intersection(*best)


def test_template_keeps_order(spark):
    """Texts that are on every page, but not in one order, are no part of the template; the others stay one."""
    says = ["One of them.", "Two of them.", "Three of them."]
    orders = list(itertools.permutations(says))
    rows = _host(12, lambda i: "".join(f"<i>{x}</i>" for x in orders[i % 6]))
    fixed = [("Daily paper", "/html/body/div"), ("All about us", "/html/body/p"), ("Printed here", "/html/body/b")]
    template = _main_texts(spark, rows)
    assert _held(fixed, template) == {t for t, _ in fixed}
    assert _held([(s, "/html/body/i") for s in says], template) == set()


def test_template_classes_nest(spark):
    """Of two classes whose tokens alternate the larger stays; one that stands here and there is in no slot."""
    large, small = [f"L{j}" for j in range(4)], [f"S{j}" for j in range(3)]

    def crossing(i):
        a, b = (large if i else []), (small if i != 1 else [])
        return "".join(f"<i>{x}</i>" for x in ([y for p in itertools.zip_longest(a, b) for y in p if y]))

    template = _main_texts(spark, _host(20, crossing))
    assert _held([(x, "/html/body/i") for x in large + small], template) == set(large)

    apart = "".join(f"<i>{x}</i>" for x in small)
    rows = _host(20, lambda i: apart if 0 < i < 10 else "<u>menu</u>")
    rows = [(i, h, x if i < 10 else x.replace("<p>All", apart + "<p>All")) for i, h, x in rows]
    template = _main_texts(spark, rows)
    assert _held([(x, "/html/body/i") for x in small], template) == set()
    assert _held([("All about us", "/html/body/p")], template) == {"All about us"}


def test_facts_of_a_page():
    place = {(1, False): (7, 0), (2, True): (7, 1), (3, True): (7, 2), (4, True): (8, 0), (5, True): (8, 1), (6, True): (8, 2)}
    size = {7: 3, 8: 3}

    def facts(*tokens):
        return html_main.page_facts([next(k for k in place if k[0] == t) if t < 9 else (t, True) for t in tokens], place, size)

    slot, disorder, crossing = html_main.SLOT, html_main.DISORDER, html_main.CROSSING
    assert facts(1, 9, 4, 5, 6, 4, 5, 6, 2, 3) == {(slot, 7, 0, 0), (slot, 8, 7, 1)}
    assert facts(4, 5, 6, 1, 2, 4, 5, 6, 3) == {(slot, 7, 0, 0), (slot, 8, 0, 0), (slot, 8, 7, 2)}
    assert facts(1, 4, 2, 5, 3, 6) == {(slot, 7, 0, 0), (slot, 8, 7, 1), (crossing, 7, 8, 0)}
    assert facts(1, 2, 3, 1, 3, 2) == {(disorder, 7, 2, 1), (disorder, 7, 3, 1)}
    assert facts(9) == set()


PAGE = """<html><head><title>T</title></head><body><header class="site-header"><a href=/>Home</a></header>
<div id=cookie-notice>We use cookies</div><div class="content no-sidebar"><h1>Head &amp; line</h1>
<p>One  two<br>three &lt;b&gt; 5 < 6 <i>x</i>y<p>Second<ul><li>a<li>b</ul><aside>side</aside>
<div class="comments"><p>nice post</p></div><form><label>Mail</label></form><script>var a="</p>"</script>
<table><tr><td>c1<td>c2<tr><td>d1</table></div><!-- no --><footer>f</footer>"""


def test_page_rules():
    assert html_main.main_text(PAGE) == "Head & line\nOne two three <b> 5 < 6 xy\nSecond\na\nb\nc1 c2\nd1"
    assert html_main.main_text("<nav>x<article>menu teaser</article></nav><p>text") == "text"
    assert html_main.main_text('<div class="ad">never closed<article><p>in') == "in"
    assert html_main.main_text('<article>a<article class="comment">c</article>b</article>') == "a\nb"
    assert html_main.main_text("<p>caf&eacute;&nbsp;&#x2014;&#8212; &unknown; </p><script>x") == "café —— &unknown;"
    assert html_main.main_text("a < b <!-- c") == "a < b"
    assert html_main.main_text("<") == "<"


def test_template_text_and_main_element(spark):
    """Without article elements the skeleton and repeated text tell the template from the article."""
    rows = []
    for i in range(30):
        body = "".join(f"<p>Story {i} part {j} with its own words {i * 31 + j}</p>" for j in range(6))
        rows.append((i, f"https://news.example.org/{i}", f"<html><body><div id=top>Daily paper</div><div id=left><p>All about us</p>"
                     f"<p>Item {i}</p></div><div id=story><p>Copyright reserved</p>{body}</div><div id=end>Printed here</div></body></html>"))
    out = html_main.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in out:
        i = r.page_id
        assert r.text == "\n".join(f"Story {i} part {j} with its own words {i * 31 + j}" for j in range(6))


def test_copies_of_an_article_are_no_template(spark):
    body = "".join(f"<p>Paragraph {j} of the story</p>" for j in range(6))
    own = [(i, "all.example.org", body) for i in range(12)] + [(i, "most.example.org", body) for i in range(100, 118)]
    own += [(i, "most.example.org", f"<p>Another story, number {i}</p>") for i in range(118, 120)]
    rows = [(i, f"https://{host}/{i}", f"<html><body><article>{text}</article></body></html>") for i, host, text in own]
    out = html_main.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    copied = "\n".join(f"Paragraph {j} of the story" for j in range(6))
    assert {r.page_id: r.text for r in out} == {i: f"Another story, number {i}" if i in (118, 119) else copied for i, _, _ in own}


def test_article_text_is_kept_whole(spark):
    article = "".join(f"<p>Paragraph {i} of the one article of this host.</p>" for i in range(6))
    rows = [(i, f"http://same.example/{i}", f"<html><body><nav>Home</nav><article>{article}<p>viewed {i} times</p></article></body></html>")
            for i in range(12)]
    got = html_main.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    whole = [f"Paragraph {i} of the one article of this host." for i in range(6)]
    assert {r.page_id: r.text.split("\n") for r in got} == {i: [*whole, f"viewed {i} times"] for i in range(12)}
    named = ('<article><div class="related-work">One.</div><p class="notice-of-award">Two.</p><section class="comments-on-theory">Three.'
             '</section><div class="related-posts">x</div><div class="comment-list">y</div><p class="advert">z</p></article>')
    assert html_main.main_text(named) == "One.\nTwo.\nThree."
    teaser = f'<body><article>Read this too.</article><div id="story">{article}</div></body>'
    assert html_main.main_text(teaser).split("\n") == whole


def test_pages_odd_rows(spark):
    schema = "page_id long, url string, html string, host string, token string, text string"
    rows = [(1, None, None, "h", "t", "x"), (None, "u", "<p>a", None, None, None), (2, "http://x/", "", "h", "t", "x"),
            (3, "http://x/", "<p>a b", "h", "t", "x"), (3, "http://x/", "<p>a b", "h", "t", "x"), (4, "//", "<p>" + "long " * 100_000, "h", None, "x")]
    out = html_main.extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.n_chars for r in out) == [0, 0, 1, 3, 3, 499_999]
    assert html_main.extract_pages(spark.createDataFrame([], schema)).count() == 0


# ------------------------------------------------------------------ 8: vectors
def brute_nearest(ids, x, query, k):
    scores = (x * x[list(ids).index(query)]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


def test_index_recall_and_exact_order(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pdf = df.toPandas()
    ids, x = pdf.vec_id.to_numpy(), np.array(pdf.embedding.tolist(), dtype=float)
    got: dict = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        want = brute_nearest(ids, x, q, 20)
        hits += len({v for v, _ in want} & {v for v, _ in found})
        assert len(found) == 20 and found == sorted(found, key=lambda t: (-t[1], t[0]))
    assert hits / (20 * len(got)) >= 0.95


def test_index_odd_rows(spark):
    nan = float("nan")
    rows = [(20, [1.0, 0.0], "a"), (1, [1.0, 0.0], "b"), (2, [1.0, 0.0], "c"), (3, [9.0, 0.0], "d"), (4, [0.0, 0.0], "e"), (5, None, "f"),
            (6, [1.0, None], "g"), (7, [nan, 1.0], "h"), (8, [float("inf"), 1.0], "i"), (None, [1.0, 1.0], "j"), (9, [1.0, 2.0, 3.0], "k"),
            (10, [-1.0, 0.5], "l"), (10, [-1.0, 0.5], "l"), (40, [0.0, 0.0], "m"), (60, None, None)]
    schema = "vec_id long, embedding array<double>, vector string"
    out = ann.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in out] == [(20, 1, 3, 9.0), (20, 2, 1, 1.0), (20, 3, 2, 1.0), (20, 4, 10, -1.0)]
    assert ann.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0


def test_index_many_equal_vectors(spark):
    """A common vector does not push others out, and its ties go to the smallest ids."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 16))
    x[500:2500] = x[500]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    ids = np.arange(len(x))
    hits = n = 0
    out: dict = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, block_rows=700).collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    for q in list(range(0, 500, 20)) + [500, 1000]:
        want = {v for v, _ in brute_nearest(ids, x, q, 20)}
        hits, n = hits + len(want & set(out[q])), n + 20
        if q >= 500:
            assert set(out[q]) == want
    assert hits / n >= 0.9


# ------------------------------------------------------------------ pipeline and registration
@pytest.fixture(scope="module")
def odd_dir(spark, odd, tmp_path_factory):
    """A folder of odd tables."""
    at = tmp_path_factory.mktemp("odd")
    odd.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (5, 1, 1), (6, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    passage = " ".join(f"p{i}" for i in range(60))
    spark.createDataFrame([(1, passage), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_pipeline_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        left.append(docs.count())
    assert 200 > left[0] == left[1] > left[2] > left[3] > 0
    ids = {r.doc_id for r in docs.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in rows} == ids
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect()} == {
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows}


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty, odd_dir):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, odd_dir)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, odd_dir).count() >= (docs.count() > 0)


def test_all_are_registered():
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dups", "decontamination", "packing"]


def test_schema_of_contract_columns(spark, sf):
    want = {"op3_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                                 "base_labels": "string", "labels": "string", "score": "double"},
            "op5_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
            "op8_permutation_index": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
            "op10_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}}
    for name, columns in want.items():
        assert columns.items() <= dict(entry.queries()[name](spark, sf).dtypes).items()
