"""Registered queries: master merge, dedupe, sort, rank, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import dedupe_within_group, merge_master, rank_within, top_k_per_group
from .registry import register, table

KEY = ["title", "published", "content", "url", "performed", "summaries", "location", "what_built",
       "funder", "amount_text", "category_text", "expected_completion", "additional"]
COLUMNS = KEY + ["sort_score"]


def _rows(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """The documents as master-table rows; the master copy differs in
    ``performed`` for every fourth document and in its score."""
    d = table(spark, sf_dir, "documents")
    performed = F.lit(True) if side == "new" else (F.col("doc_id") % 4 != 0)
    return d.select(
        F.col("lang").alias("title"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")),
                      "yyyy-MM-dd").alias("published"),
        F.col("text").alias("content"),
        F.concat(F.lit("https://news.example/"), F.col("lang"), F.lit("/"), F.col("n_chars").cast("string")).alias("url"),
        performed.alias("performed"),
        F.lit(None).cast("string").alias("summaries"),
        F.col("source").alias("location"),
        F.lit("bridge").alias("what_built"),
        F.lit(None).cast("string").alias("funder"),
        F.lit(None).cast("string").alias("amount_text"),
        F.lit("Utility").alias("category_text"),
        F.lit("2025").alias("expected_completion"),
        F.lit(None).cast("string").alias("additional"),
        F.lit(6 if side == "new" else 3).alias("sort_score"),
        F.col("doc_id").alias("ingest_seq"))


def _sql_rows(side: str) -> str:
    performed = "true" if side == "new" else "doc_id % 4 <> 0"
    return f"""SELECT lang AS title,
  strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS published,
  text AS content, 'https://news.example/' || lang || '/' || CAST(n_chars AS VARCHAR) AS url,
  {performed} AS performed, CAST(NULL AS VARCHAR) AS summaries, source AS location, 'bridge' AS what_built,
  CAST(NULL AS VARCHAR) AS funder, CAST(NULL AS VARCHAR) AS amount_text, 'Utility' AS category_text,
  '2025' AS expected_completion, CAST(NULL AS VARCHAR) AS additional,
  {6 if side == 'new' else 3} AS sort_score, doc_id AS ingest_seq FROM documents"""


@register("master_merge", f"""
WITH b AS (SELECT *, 0 AS priority FROM ({_sql_rows('new')}) UNION ALL SELECT *, 1 FROM ({_sql_rows('master')})),
r AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(KEY)} ORDER BY priority, ingest_seq) AS rn FROM b)
SELECT ingest_seq, CAST(priority AS INTEGER) AS priority, performed, CAST(sort_score AS INTEGER) AS sort_score, url
FROM r WHERE rn = 1""")
def master_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U3 + A5 + A6 + O1: new batch over the master table, keep-first by key."""
    merged = merge_master(_rows(spark, sf_dir, "new"), _rows(spark, sf_dir, "master"), KEY, COLUMNS)
    return (merged.select("ingest_seq", "priority", "performed", F.col("sort_score").cast("int").alias("sort_score"), "url")
            .orderBy(F.col("sort_score").desc_nulls_last(), "url", "ingest_seq"))


@register("dedupe_titles", """
WITH t AS (SELECT source, lang, split_part(text, '.', 1) AS title, doc_id FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source, lang, title ORDER BY doc_id) AS rn FROM t)
SELECT source, lang, title, doc_id FROM r WHERE rn = 1""")
def dedupe_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: within each (source, lang) result, one row per title (first by id)."""
    t = table(spark, sf_dir, "documents").select(
        "source", "lang", F.split_part(F.col("text"), F.lit("."), F.lit(1)).alias("title"), "doc_id")
    return dedupe_within_group(t, ["source", "lang"], "title", "doc_id")


@register("rank_in_year", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rank
FROM orders""")
def rank_in_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: rank within year by value (explicit tie-break); a hot year is split over tasks."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    return rank_within(o, "year", [F.col("o_totalprice").desc(), F.col("o_orderkey")]).drop("o_totalprice")


@register("top_orders_per_customer", """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank FROM orders)
WHERE rank <= 3""")
def top_orders_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: newest 3 per group (the ``maxrecords`` + date-desc rule)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return top_k_per_group(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 3).drop("o_orderdate")
