"""Registered queries: stored answers on the second day, relevance, social load, score, the finish step with
its export form, and the small source and text operators (C8-C13, E2, J6, J7, O1, O4, P4, P5, P10-P12, P14,
A5, A9, A12, R2, R5, S6, S8, S10, U1, D7, T8)."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_start
from ..functions.text import double_to_single_quotes
from ..operators import enrich as E
from ..operators.answers import ask_stored
from ..operators.grids import day_ranges, page_offsets
from ..operators.merge import distinct_rows, merge_master, rank_within
from ..operators.report import with_counts
from ..sources.feeds import drop_sentinel_rows, empty_articles, union_articles
from ..sources.master import read_ordered
from ..sources.sinks import export_columns, snapshot_stage
from ..sources.tables import master_from_export
from ..session import checkpoint_dir, cut_lineage
from .composites import score, social_articles
from .daily import MASTER_TYPES, daily_merge
from .q_merge import COLUMNS, KEY, _rows, _sql_rows
from .registry import WS_SQL, register, table

_TRIMMED = f"""(SELECT doc_id, CASE WHEN len(w) > 12000 THEN array_to_string(w[1:12000], ' ') ELSE text END AS prompt, w
  FROM (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{WS_SQL}+'), lambda x: x <> '') AS w FROM documents))"""


# ------------------------------------------------------------------ P12, J6, J7, A9
def _second_day_model(prompts: pd.Series) -> pd.Series:
    """A pure stand-in for the model; it cannot answer texts with an exclamation mark."""
    return prompts.map(lambda p: None if "!" in p else "new")


@register("responses_second_day", f"""
WITH t AS {_TRIMMED},
good AS (SELECT DISTINCT prompt FROM t WHERE doc_id % 2 = 0 AND doc_id % 10 <> 0)
SELECT t.doc_id, CASE WHEN good.prompt IS NOT NULL THEN 'old' WHEN contains(t.prompt, '!') THEN NULL ELSE 'new' END AS answer,
       good.prompt IS NOT NULL OR NOT contains(t.prompt, '!') AS performed
FROM t LEFT JOIN good USING (prompt)""")
def responses_second_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 + J7 + J6: half of the documents were asked yesterday, some of them in vain. Answered prompts are
    not asked again, failed ones are, and an answer reaches every document with its prompt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    req = E.build_requests(docs, "doc_id", "content", "summaries", "{text}")
    doc = F.col("doc_id").cast("bigint")
    failed = doc % 10 == 0
    old = req.filter(doc % 2 == 0).select("request_id", "doc_id", "stage", F.when(~failed, F.lit("old")).alias("raw"),
                                          (~failed).alias("ok"), F.lit(1).alias("attempts"),
                                          F.lit("2024-01-01").cast("timestamp").alias("answered_at"))
    new = E.run_responder(E.pending(req, old), _second_day_model)
    out = E.attach_responses(docs, old.unionByName(new), req, "doc_id", out_col="answer")
    return out.select("doc_id", "answer", "performed")


# ------------------------------------------------------------------ E2, P8
def _yes_model(prompts: pd.Series) -> pd.Series:
    """A pure stand-in for the model: yes when the text has the word "and"."""
    return prompts.map(lambda p: "Yes, it does." if "and" in p.split("\n", 2)[2].lower().split() else "No.")


@register("relevance", f"""
WITH t AS {_TRIMMED}
SELECT doc_id, 'Yes, it does.' AS content_check FROM t WHERE list_contains(list_transform(w[1:12000], lambda x: lower(x)), 'and')""")
def relevance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 + P8: ask whether each document is relevant, keep those answered yes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    out, _ = E.relevance(docs, _yes_model, "doc_id")
    return out.select("doc_id", "content_check")


# ------------------------------------------------------------------ C13: S2, R2, R5, P4, O4
@register("social_load", """
WITH m AS (SELECT doc_id, lang AS topic, DATE '2024-01-01' + CAST(doc_id % 40 AS INTEGER) AS day,
                  CASE WHEN doc_id % 9 = 0 THEN NULL ELSE text END AS content FROM documents),
r AS (SELECT unnest(range(DATE '2024-01-05', DATE '2024-02-01', INTERVAL 1 DAY)) AS range_start)
SELECT topic, strftime(range_start, '%Y-%m-%d') AS range_start, CAST(doc_id % 500 * 100 AS INTEGER) AS page_offset,
       'https://social.example/' || CAST(doc_id AS VARCHAR) AS url, strftime(day, '%Y-%m-%d') AS published, md5(content) AS content_md5,
       row_number() OVER (PARTITION BY topic ORDER BY day, doc_id) AS position
FROM m JOIN r ON day = CAST(range_start AS DATE) WHERE content IS NOT NULL""")
def social_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses of a topic x day x page grid (R2, R5), parsed (S2), without empty mentions (P4),
    by date (O4, with an explicit position)."""
    d = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 40).cast("int"))
    item = F.struct(F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("content"), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
                    F.format_string("t%012d", F.col("doc_id")).alias("title"), F.concat(F.lit("https://social.example/"), F.col("doc_id").cast("string")).alias("url"))
    stored = d.select(F.col("lang").alias("topic"), day.alias("range_start"), (F.col("doc_id") % 500 * 100).cast("int").alias("page_offset"),
                      F.to_json(F.struct(F.array(item).alias("data")), {"ignoreNullFields": "false"}).alias("response"))
    start, end = F.lit("2024-01-05").cast("date"), F.lit("2024-01-31").cast("date")
    topics = d.select(F.col("lang").alias("topic")).distinct()
    grid = (topics.select("topic", F.explode(day_ranges(start, end)).alias("w")).select("topic", F.col("w.win_start").cast("date").alias("range_start"))
            .select("topic", "range_start", F.explode(page_offsets()).alias("page_offset")))
    out = social_articles(grid, stored)
    ranked = rank_within(out, "topic", [F.col("published"), F.col("title")], name="position")
    return ranked.select("topic", F.date_format("range_start", "yyyy-MM-dd").alias("range_start"), "page_offset", "url",
                         F.date_format("published", "yyyy-MM-dd").alias("published"), F.md5("content").alias("content_md5"), "position")


# ------------------------------------------------------------------ C8: T11, D3, D4, O1
@register("score_rows", """
WITH p AS (SELECT p_partkey, p_name AS location, CASE WHEN p_partkey % 3 = 0 THEN 'Not specified' ELSE p_brand END AS what_built,
                  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS category_text,
                  strftime(DATE '2020-03-01' + CAST(p_partkey % 1500 AS INTEGER), '%Y-%m-%d') AS published FROM part),
s AS (SELECT *, CAST(1 + (CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END) + (CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END) AS INTEGER) AS sort_score,
             CAST(left(published, 4) AS INTEGER) AS year FROM p)
SELECT p_partkey, sort_score, year, row_number() OVER (ORDER BY year DESC, sort_score DESC, p_partkey) AS position FROM s""")
def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness score, date and year of each row, and its place in the order by year and score."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    rows = p.select("p_partkey", F.col("p_name").alias("location"), F.when(key % 3 == 0, F.lit("Not specified")).otherwise(F.col("p_brand")).alias("what_built"),
                    F.when(key % 4 != 0, F.col("p_type")).alias("category_text"),
                    F.date_format(F.date_add(F.lit("2020-03-01").cast("date"), (key % 1500).cast("int")), "yyyy-MM-dd").alias("published"))
    out = score(rows, tie_cols=("p_partkey",))
    return out.select("p_partkey", "sort_score", "year", "position")


# ------------------------------------------------------------------ C9: U3, A5, A6, O1, P14, S6
_KEYS = ", ".join(KEY)
_FINISH_SQL = f"""
WITH m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY ingest_seq) AS k FROM ({_sql_rows('master')})) WHERE k = 1),
b AS (SELECT * EXCLUDE k, 1 AS priority FROM m UNION ALL SELECT *, 0 FROM ({_sql_rows('new')})),
r AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY priority, ingest_seq) AS rn FROM b),
w AS (SELECT *, CAST(left(published, 4) AS INTEGER) AS year FROM r WHERE rn = 1)
SELECT ingest_seq, title, published, url, performed, CAST(sort_score AS INTEGER) AS sort_score, year, 'Unknown' AS lat_text,
       row_number() OVER (ORDER BY year DESC, sort_score DESC, url, ingest_seq) AS position FROM w"""


def _finished(spark: SparkSession, sf_dir: str, split: bool) -> DataFrame:
    new = _rows(spark, sf_dir, "new")
    # yesterday's master holds one row per key, as every merge writes it
    rows = _rows(spark, sf_dir, "master")
    master = merge_master(rows, rows.limit(0), KEY, COLUMNS).drop("priority")
    merged = merge_master(distinct_rows(new), master, KEY, COLUMNS, split_untouched=split, master_keys_unique=True)
    full = merged.select("ingest_seq", *[(F.col(c) if c in COLUMNS else F.year("published") if c == "year" else F.lit(None)).cast(t).alias(c)
                                         for c, t in MASTER_TYPES.items()])
    order = [F.col("year").desc_nulls_last(), F.col("sort_score").desc_nulls_last(), F.col("url"), F.col("ingest_seq")]
    ranked = rank_within(full.withColumn("_all", F.lit(1)), "_all", order, name="position")
    # through the export form (all text, its own names) and back to types
    text = export_columns(ranked, keep=("ingest_seq", "position"))
    back = master_from_export(text, keep=("ingest_seq", "position", "Matched Lat"))
    return back.select("ingest_seq", "title", F.date_format("published", "yyyy-MM-dd").alias("published"), "url", "performed",
                       "sort_score", "year", F.col("Matched Lat").alias("lat_text"), "position")


@register("finish_master", _FINISH_SQL)
def finish_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """today's rows over the master in one shuffle (U3, A5, A6), the order as an explicit position (O1), the
    export form (P14) and back (S6)."""
    return _finished(spark, sf_dir, split=False)


@register("finish_master_split", _FINISH_SQL)
def finish_master_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the path that leaves master rows with other keys where they are."""
    return _finished(spark, sf_dir, split=True)


@register("daily_merge", f"""
WITH f AS ({_FINISH_SQL})
SELECT ingest_seq, title, published, url, performed, sort_score, year, position, sort_score = 6 AS is_new FROM f""")
def daily_merge_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 + S9 + O1: two days of the daily finish over a master in key buckets, read back with its position."""
    base = f"{checkpoint_dir(spark)}/master-{uuid.uuid4().hex}"
    for day, side in (("2024-02-01", "master"), ("2024-02-02", "new")):
        facts = _rows(spark, sf_dir, side)
        daily_merge(facts.withColumn("year", F.year("published")), base, day, buckets=16)
    return read_ordered(spark, base).select(
        "ingest_seq", "title", F.date_format("published", "yyyy-MM-dd").alias("published"), "url", "performed", "sort_score", "year",
        "position", (F.col("sort_score") == 6).alias("is_new"))


# ------------------------------------------------------------------ E1 in chunks
def _numbered_model(reply: str):
    """A pure stand-in for the model whose replies name the run."""
    return lambda prompts: prompts.map(lambda p: reply)


@register("responses_resumed", f"""
WITH t AS {_TRIMMED},
p AS (SELECT prompt, ('0x' || substr(sha256('summaries' || chr(10) || prompt), 1, 8))::BIGINT % 1000 AS slot FROM (SELECT DISTINCT prompt FROM t)),
n AS (SELECT least(1000, (count(*) + 299) // 300) AS chunks FROM p)
SELECT t.doc_id, CASE WHEN slot * chunks // 1000 < 2 THEN 'first run' ELSE 'second run' END AS answer
FROM t JOIN p USING (prompt), n""")
def responses_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ends after two chunks, and a second run that asks what the store does not know."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    req = E.build_requests(docs, "doc_id", "content", "summaries", "{text}")
    store = f"{checkpoint_dir(spark)}/answers-{uuid.uuid4().hex}"
    ask_stored(req, _numbered_model("first run"), store, chunk_rows=300, stop_after=2)
    answers = ask_stored(req, _numbered_model("second run"), store, chunk_rows=300_000)
    out = E.attach_responses(docs, answers, req, "doc_id", out_col="answer")
    return out.select("doc_id", "answer")


# ------------------------------------------------------------------ C10, A9
def _summary_model(prompts: pd.Series) -> pd.Series:
    """A pure stand-in for the model: texts with the word "and" have a project; its list becomes one dict."""
    def reply(p):
        stage, _, text = p.split("\n", 2)
        if stage == "fields":
            return "[{'Location of project': 'Basra'}]"
        return "1. a bridge" if "and" in text.lower().split() else "none"
    return prompts.map(reply)


@register("document_summaries", f"""
WITH t AS {_TRIMMED},
s AS (SELECT doc_id, list_contains(list_transform(w[1:12000], lambda x: lower(x)), 'and') AS performed FROM t)
SELECT doc_id, CASE WHEN performed THEN '[{{''Location of project'': ''Basra''}}]' END AS summaries, performed,
       (SELECT bool_and(performed) FROM s) AS all_performed FROM s""")
def document_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 + E1 + A9: two-stage summaries of every document, answers kept in a store as they arrive."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    out, _ = E.summaries(docs, _summary_model, "doc_id", store=f"{checkpoint_dir(spark)}/answers-{uuid.uuid4().hex}")
    out = cut_lineage(out.select("doc_id", "summaries", "performed"))
    return out.withColumn("all_performed", F.lit(E.all_performed(out)))


# ------------------------------------------------------------------ small operators
@register("source_union", """
WITH a AS (SELECT doc_id, 'news' AS source, 'https://n.example/' || CAST(doc_id AS VARCHAR) AS url, lang AS title,
                  replace(text, '"', '''') AS content FROM documents WHERE doc_id % 4 <> 1
           UNION ALL SELECT doc_id, 'social', 'https://s.example/' || CAST(doc_id AS VARCHAR), NULL, text FROM documents WHERE doc_id % 4 = 1)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, url, coalesce(title, 'Unknown') AS title, md5(content) AS content_md5,
       CAST(epoch(TIMESTAMP '2024-02-03 00:00:00') AS BIGINT) AS start_epoch FROM a""")
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + P11 + S10 + P5 + P10 + A5 + T8 + D7 + S8 + A12: sources with different columns, an empty source, sentinel
    and repeated rows become one article table, staged, counted, with nulls filled."""
    d = table(spark, sf_dir, "documents")
    news = d.filter("doc_id % 4 <> 1").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit("news").alias("source"),
                                             F.concat(F.lit("https://n.example/"), F.col("doc_id").cast("string")).alias("url"),
                                             F.col("lang").alias("title"), double_to_single_quotes(F.col("text")).alias("content"))
    social = d.filter("doc_id % 4 = 1").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit("social").alias("source"),
                                              F.concat(F.lit("https://s.example/"), F.col("doc_id").cast("string")).alias("url"),
                                              F.col("text").alias("content"))
    # a source that came back with nothing but the word "none" in each column, and one that came twice
    nothing = drop_sentinel_rows(d.filter("doc_id % 50 = 0").select(*[F.lit("none").alias(c) for c in news.columns]))
    rows = distinct_rows(union_articles(news, social, empty_articles(spark), nothing, social))
    rows, _ = with_counts(rows, "source_union")
    rows = snapshot_stage(rows, f"{checkpoint_dir(spark)}/stages", f"source_union-{uuid.uuid4().hex}")
    return rows.select("doc_id", "source", "url", F.coalesce("title", F.lit("Unknown")).alias("title"), F.md5("content").alias("content_md5"),
                       F.unix_timestamp(parse_start(F.lit("2024-02-03"))).alias("start_epoch"))
