import pandas as pd
from pyspark.sql import functions as F

from factloom.operators import enrich as E
from factloom.operators.merge import keep_first, merge_master, top_k_per_group
from factloom.operators.pages import follow_report_links, followed_text, listing_cards

KEY = ["url", "title"]
COLS = ["url", "title", "score"]


def rows(spark, data):
    return spark.createDataFrame(data, "url string, title string, score int, ingest_seq bigint")


def as_set(df):
    return sorted(tuple(r) for r in df.select(*COLS, "priority").collect())


def test_new_rows_win_and_merge_is_idempotent(spark):
    master = rows(spark, [("u1", "a", 1, 1), ("u2", "b", 1, 2), ("u3", None, 1, 3)])
    new = rows(spark, [("u1", "a", 9, 1), ("u3", None, 9, 2), ("u4", "d", 9, 3), ("u4", "d", 7, 4)])
    once = merge_master(new, master, KEY, COLS)
    assert as_set(once) == [("u1", "a", 9, 0), ("u2", "b", 1, 1), ("u3", None, 9, 0), ("u4", "d", 9, 0)]
    again_master = once.select(*COLS, "ingest_seq")
    twice = merge_master(new, again_master, KEY, COLS)
    assert as_set(twice) == as_set(once)


def test_keep_first_hot_key(spark):
    df = spark.range(0, 5000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"))
    out = keep_first(df.unionByName(spark.createDataFrame([("cold", 3)], "k string, seq long")), ["k"], ["seq"])
    assert sorted((r.k, r.seq) for r in out.collect()) == [("cold", 3), ("hot", 0)]


def test_top_k_uses_window_group_limit(spark):
    df = spark.range(0, 100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, ["g"], [F.col("v").desc()], 2)
    assert sorted((r.g, r.v) for r in out.collect()) == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_requests_resume_and_pure_responder(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "alpha beta"), (3, None)], "doc_id long, content string")
    req = E.build_requests(docs, "doc_id", "content", "summaries", "Summarise:\n{text}", max_words=2)
    assert req.count() == 2
    assert sorted(r.prompt for r in req.collect())[0].endswith("alpha beta")

    def responder(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: None if "alpha" in p else "1. a project")

    first = E.run_responder(E.pending(req, None), responder, retries=2)
    got = {r.doc_id: (r.ok, r.attempts) for r in first.collect()}
    assert got == {"1": (True, 1), "2": (False, 2)}
    stored = first.filter("ok")
    assert E.pending(req, stored).count() == 1          # only the failed one is asked again
    assert E.accepted(first).count() == 1
    attached = E.attach_responses(docs, stored, req, "doc_id")
    assert {r.doc_id: r.performed for r in attached.collect()} == {1: True, 2: False, 3: False}
    assert E.all_performed(attached) is False


def test_follow_report_links_chain_and_cycle(spark):
    link = '<a href="{}">Click here to read the full report.</a>'
    body = '<section class="post entry">{}</section>'
    pages = spark.createDataFrame([
        ("http://s/a", body.format(link.format("/b"))), ("http://s/b", body.format(link.format("c"))), ("http://s/c", body.format("end")),
        ("http://s/b", body.format(link.format("c"))), ("http://s/z", body.format(link.format("/x"))),
        ("http://s/x", body.format(link.format("/y"))), ("http://s/y", body.format(link.format("/x"))),
        ("http://s/o", body.format("short") + link.format("/a")), ("http://s/away", body.format(link.format("http://t/none"))),
        ("http://s/none", "<p>other</p>")], "url string, html string")
    long_chain = spark.createDataFrame([(f"http://l/{i}", body.format(link.format(i + 1) if i < 20 else "end")) for i in range(21)],
                                       "url string, html string")
    out = {r.start_url: (r.final_url, r.hops) for r in follow_report_links(pages.unionByName(long_chain)).collect()}
    assert out["http://s/a"] == ("http://s/c", 2)
    assert out["http://s/x"] == out["http://s/y"] == out["http://s/z"] == (None, None)     # a cycle, and a way into it
    assert out["http://s/c"] == ("http://s/c", 0)
    assert out["http://s/o"] == ("http://s/o", 0)       # the link stands outside the section
    assert out["http://s/away"] == ("http://t/none", 1)
    assert out["http://l/0"] == ("http://l/20", 20) and out["http://l/13"] == ("http://l/20", 7)
    text = {r.start_url: r.body for r in followed_text(pages, compat_not_found=True).collect()}
    assert text["http://s/c"] == "end" and text["http://s/away"] is None and text["http://s/x"] is None
    assert text["http://s/o"] == "short" and len(text) == 9 and text["http://s/none"] == "Not found"


def test_listing_cards_skip_incomplete(spark):
    html = ('<article><a rel="bookmark" href="/n/1" title="One">x</a>'
            '<abbr class="date time published updated" title="2024-05-01T10:00:00+03:00">d</abbr></article>'
            '<article><a rel="bookmark" href="/n/2" title="Two">x</a></article>')
    pages = spark.createDataFrame([("https://site.example/list/1", html)], "url string, html string")
    out = listing_cards(pages).collect()
    assert len(out) == 1 and out[0].link == "https://site.example/n/1" and out[0].title == "One"
    assert str(out[0].published_utc) == "2024-05-01 07:00:00"


def test_balanced_rank_equals_window_rank_on_a_hot_group(spark):
    from pyspark.sql import Window

    from factloom.operators.merge import rank_within
    df = spark.range(0, 3000).select(F.when(F.col("id") % 10 < 7, F.lit(1)).otherwise(F.col("id") % 5).alias("g"),
                                     ((F.col("id") * 7919) % 1000).alias("v"), F.col("id"))
    order = [F.col("v").desc(), F.col("id")]
    a = sorted(tuple(r) for r in df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order))).collect())
    b = sorted(tuple(r) for r in rank_within(df, "g", order, partitions=6).collect())
    assert a == b


def test_site_articles_follow_links_in_window(spark):
    from factloom.plans.composites import site_articles
    card = ('<article><a rel="bookmark" href="{}" title="{}">x</a>'
            '<abbr class="date time published updated" title="{}">d</abbr></article>')
    listing = (card.format("/a/1", "One", "2024-05-02T10:00:00+03:00")
               + card.format("/a/2", "Two", "2024-04-01T10:00:00+03:00")
               + card.format("/a/3", "Three", "2024-05-03T09:00:00+00:00"))
    listings = spark.createDataFrame([("https://s.example/list", listing)], "url string, html string")
    pages = spark.createDataFrame([
        ("https://s.example/a/1", '<section class="entry">Short. <a href="/r/1">Click here to read the full report.</a></section>'),
        ("https://s.example/r/1", '<section class="entry"><p>Full report text</p></section>'),
        ("https://s.example/a/3", "<div>no entry section</div>")], "url string, html string")
    start = F.lit("2024-05-01 00:00:00").cast("timestamp")
    end = F.lit("2024-05-31 00:00:00").cast("timestamp")
    got = {r.title: r.content for r in site_articles(listings, pages, start, end).collect()}
    assert got == {"One": "Full report text", "Three": None}
    got = {r.title: r.content for r in site_articles(listings, pages, start, end, compat_not_found=True).collect()}
    assert got == {"One": "Full report text", "Three": "Not found"}


def test_checked_broadcast_switches_on_rows_and_bytes(spark):
    from factloom.operators.joins import checked_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).withColumnRenamed("id", "k")
        dim = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.lit("x" * 100))

        def plan(d):
            return facts.join(d, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(checked_broadcast(dim))
        assert "BroadcastHashJoin" not in plan(checked_broadcast(dim, max_rows=5))
        assert "BroadcastHashJoin" not in plan(checked_broadcast(dim, max_bytes=500))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checked_broadcast_beyond_its_bounds_is_not_broadcast_by_an_estimate(spark):
    from factloom.operators.joins import checked_broadcast
    facts = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.lit("x" * 100))
    joined = facts.join(checked_broadcast(dim, max_rows=5), "k")     # Spark estimates both sides as small
    assert joined.count() == 10
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_rows_without_url_are_spread_over_the_tasks(spark):
    from factloom.operators.pages import replace_with_full_text
    pages = spark.createDataFrame([("https://a.example", "<p>page</p>"), ("\u0000x", "<p>odd</p>")], "url string, html string")
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, "https://a.example").alias("url"),
                                   F.concat(F.lit("text "), F.col("id").cast("string")).alias("content"), F.lit("yes").alias("content_check"))
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "-1")
        spark.conf.set(names[1], "false")
        out = replace_with_full_text(rows, pages).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert {r.doc_id: r.content for r in out} == {i: "page" if i == 7 else f"text {i}" for i in range(400)}
    tasks = [r.task for r in out]
    assert max(tasks.count(t) for t in set(tasks)) < 200


def test_usd_by_model_and_relevance(spark):
    rows = spark.createDataFrame([(1, "2 billion dinars", "about Iraq"), (2, "n/a", "weather")],
                                 "id long, amount_text string, content string")

    def money(prompts):
        return prompts.map(lambda p: ' "$1540000" ' if "billion" in p else "0")

    def judge(prompts):
        return prompts.map(lambda p: "Yes, Iraq" if "Iraq" in p.rsplit("\n", 1)[1] else "no")

    out, asked = E.usd_by_model(rows, money, "id")
    assert {r.id: r.usd for r in out.collect()} == {1: 1540000.0, 2: 0.0}
    _, again = E.usd_by_model(rows, money, "id", responses=asked)
    assert again.count() == 0
    rel, _ = E.relevance(rows, judge, "id")
    assert [r.id for r in rel.collect()] == [1]
    full = spark.createDataFrame([(1, "", "c1"), (2, "full", "c2")], "id long, full_content string, content string")
    assert [r[0] for r in full.select(E.prefer_full_text(full)).orderBy("id").collect()] == ["c1", "full"]


def test_read_html_files(spark):
    import tempfile
    from factloom.sources.pages import read_html_files
    root = tempfile.mkdtemp(prefix="factloom-html-")
    for name, body in [("a.html", "<p>A</p>"), ("b.html", "<p>B</p>")]:
        with open(f"{root}/{name}", "w") as f:
            f.write(body)
    got = {r.url: r.html for r in read_html_files(spark, f"{root}/*.html", base_url="https://s.example/").collect()}
    assert got == {"https://s.example/a.html": "<p>A</p>", "https://s.example/b.html": "<p>B</p>"}


def test_merge_paths_agree(spark):
    master = rows(spark, [(f"u{i}", "a", 1, i) for i in range(50)])
    new = rows(spark, [("u3", "a", 9, 100), ("u70", "b", 9, 101), ("u3", "a", 8, 99)])
    a = as_set(merge_master(new, master, KEY, COLS, split_untouched=True))
    b = as_set(merge_master(new, master, KEY, COLS, split_untouched=False))
    assert a == b and ("u3", "a", 8, 0) in a and len(a) == 51


def test_responder_is_called_once_per_request(spark):
    import tempfile
    calls = tempfile.mkdtemp(prefix="factloom-calls-")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, content string")
    req = E.build_requests(docs, "doc_id", "content", "summaries", "{text}")

    def counting(prompts):
        import os
        import uuid
        for _ in range(len(prompts)):
            open(os.path.join(calls, uuid.uuid4().hex), "w").close()
        return prompts.map(lambda p: "1. x")

    r = E.run_responder(req, counting)
    for _ in range(3):
        E.accepted(r).count()
        E.attach_responses(docs, r, req, "doc_id").count()
    import os
    assert len(os.listdir(calls)) == 6


def test_answers_belong_to_prompts_and_failures_are_asked_again(spark):
    """Day 2: a new document with an answered prompt gets the answer; a failed prompt is retried; the
    latest answer wins; one bad prompt does not cost its batch."""
    day1 = spark.createDataFrame([(1, "five"), (2, "bad"), (3, "six")], "doc_id long, content string")

    def model(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("no")
        return prompts.map(lambda p: "1. " + p.split("\n", 1)[1])

    def build(df):
        return E.build_requests(df, "doc_id", "content", "summaries", "{text}")

    old = E.run_responder(E.pending(build(day1), None), model, answered_at=F.lit("2024-01-01").cast("timestamp"))
    assert {r.doc_id: (r.ok, r.raw) for r in old.collect()} == {"1": (True, "1. five"), "2": (False, None), "3": (True, "1. six")}
    day2 = spark.createDataFrame([(2, "bad"), (4, "five"), (5, "seven"), (6, None)], "doc_id long, content string")
    req = build(day2)
    todo = E.pending(req, old)
    assert sorted(r.doc_id for r in todo.collect()) == ["2", "5"]
    new = E.run_responder(todo, lambda prompts: prompts.map(lambda p: "1. again"), answered_at=F.lit("2024-01-02").cast("timestamp"))
    got = {r.doc_id: r.summaries for r in E.attach_responses(day2, old.unionByName(new), req, "doc_id").collect()}
    assert got == {2: "1. again", 4: "1. five", 5: "1. again", 6: None}
    newer = old.filter("doc_id = '1'").withColumn("raw", F.lit("0. latest")).withColumn("answered_at", F.lit("2024-01-03").cast("timestamp"))
    got = {r.doc_id: r.summaries for r in E.attach_responses(day1, old.unionByName(newer), build(day1), "doc_id").collect()}
    assert got[1] == "0. latest" and got[3] == "1. six"


def test_summaries_in_one_call(spark):
    rows = spark.createDataFrame([(1, "build a port", "full text of a port"), (2, "nothing", ""), (3, None, None)],
                                 "doc_id long, content string, full_content string")

    def model(prompts):
        def answer(p):
            stage, text = p.split("\n", 1)
            if stage == "fields":
                return "{'Location of project': 'Basra'}"
            return "1. a port" if text.endswith("full text of a port") else "none"
        return prompts.map(answer)

    out, new = E.summaries(rows, model, "doc_id")
    assert {r.doc_id: (r.summaries, r.performed) for r in out.collect()} == {
        1: ("{'Location of project': 'Basra'}", True), 2: (None, False), 3: (None, False)}
    asked: list = []
    again, more = E.summaries(rows, lambda p: asked.append(1), "doc_id", responses=new)
    assert more.count() == 0 and {r.doc_id: r.performed for r in again.collect()} == {1: True, 2: False, 3: False}


def test_listing_attributes_keep_apostrophes_and_decode(spark):
    html = ("<article><a rel='bookmark' title=\"Iraq's new port &amp; more\" href='/n?a=1&amp;b=2'>x</a>"
            '<abbr title="2024-05-01T10:00:00+03:00" class="date time published updated">d</abbr></article>')
    pages = spark.createDataFrame([("https://site.example/list/1", html)], "url string, html string")
    row = listing_cards(pages).first()
    assert row.title == "Iraq's new port & more" and row.link == "https://site.example/n?a=1&b=2"


def test_nested_elements_and_character_references(spark):
    from factloom.functions.html import element_text, unescape
    html = '<section class="a entry b">one<section>two</section>three</section><section>four</section>'
    rows = spark.createDataFrame([(html,), ("<section class='entry'>open end",), ("<section class='entryx'>x</section>",), (None,)], "h string")
    assert [r[0] for r in rows.select(element_text("h", "section", "entry")).collect()] == ["onetwothree", "open end", None, None]
    refs = spark.createDataFrame([("caf&eacute; &#8212;&#x1F600; &amp;lt; &nope; & &#0; a&b;",)], "t string")
    assert refs.select(unescape("t")).first()[0] == "café —\U0001f600 &lt; &nope; & \ufffd a&b;"


def test_identical_prompts_are_asked_once(spark):
    import os
    import tempfile
    calls = tempfile.mkdtemp(prefix="factloom-dup-")
    docs = spark.createDataFrame([(1, "same text"), (2, "same text"), (3, "other")], "doc_id long, content string")
    req = E.build_requests(docs, "doc_id", "content", "summaries", "{text}")

    def counting(prompts):
        import uuid
        for _ in range(len(prompts)):
            open(os.path.join(calls, uuid.uuid4().hex), "w").close()
        return prompts.map(lambda p: "1. " + p.split("\n", 1)[1])

    r = E.run_responder(req, counting)
    assert sorted((x.doc_id, x.raw) for x in r.collect()) == [("1", "1. same text"), ("2", "1. same text"),
                                                             ("3", "1. other")]
    assert len(os.listdir(calls)) == 2
