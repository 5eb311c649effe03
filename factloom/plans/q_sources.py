"""Registered queries: scans of reference tables in their original CSV form, stored pages, the body or ``Not found``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pages import article_body
from ..session import checkpoint_dir
from ..sources.pages import read_pages
from ..sources.tables import read_gazetteer, read_label_report, read_topics
from .q_pages import _sql_strip
from .registry import register, table


def _as_csv(df: DataFrame) -> str:
    """``df`` as CSV files with a header in the shared folder; several files, so their order has to come from a column."""
    path = f"{checkpoint_dir(df.sparkSession)}/reference-{uuid.uuid4().hex}"
    df.repartition(3, df.columns[0]).write.option("header", "true").option("escape", '"').csv(path)
    return path


@register("gazetteer_scan", """
SELECT 'IQ' || CAST(n_nationkey AS VARCHAR) AS loc_id, 'nation "' || n_name || '", the' AS town_en, r_name AS admin2_en, CAST(NULL AS VARCHAR) AS town_ar,
       CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey + 0.5::DOUBLE END AS lat, 'nation' AS loc_type, CAST(n_nationkey AS BIGINT) AS ord
FROM nation JOIN region ON r_regionkey = n_regionkey""")
def gazetteer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a gazetteer under its original headers in any order, with quotes and commas in names, a column missing and a bad number."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    rows = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("unused"), F.when(key % 4 != 0, (key + 0.5).cast("string")).otherwise(F.lit("n/a")).alias("Lat"),
        F.concat(F.lit('nation "'), F.col("n_name"), F.lit('", the')).alias("Town EN"), F.col("r_name").alias("Admin 2 EN"),
        F.concat(F.lit("IQ"), key.cast("string")).alias("ID"), F.lit("nation").alias("Location Type"), key.alias("row"))
    got = read_gazetteer(spark, _as_csv(rows), order_col="row")
    return got.select("loc_id", "town_en", "admin2_en", "town_ar", "lat", "loc_type", "ord")


@register("topic_scan", """
SELECT replace(p_type, ' ', ' OR ') AS keywords, p_name AS label, p_brand AS topic_type, CAST(p_partkey AS BIGINT) AS ord FROM part""")
def topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic list (keywords joined by OR, label, type) in its original CSV form."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row"), F.col("p_name").alias("English"),
                                            F.replace("p_type", F.lit(" "), F.lit(" OR ")).alias("ARABIC String"), F.col("p_brand").alias("Type"))
    return read_topics(spark, _as_csv(p), order_col="row").select("keywords", "label", "topic_type", "ord")


@register("label_scan", """
SELECT p_type || chr(10) || '"' || p_name || '"' AS text, '[''' || p_brand || ''', ''x'']' AS label_0,
       CASE WHEN p_partkey % 2 = 0 THEN p_type END AS label_1, CAST(p_partkey AS BIGINT) AS ord FROM part""")
def label_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label report whose texts hold line breaks and quotes."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.col("p_partkey").alias("row"), F.concat("p_type", F.lit('\n"'), "p_name", F.lit('"')).alias("text"),
                    F.concat(F.lit("['"), "p_brand", F.lit("', 'x']")).alias("label_0"),
                    F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).alias("label_1"))
    return read_label_report(spark, _as_csv(rows), order_col="row").select("text", "label_0", "label_1", "ord")


@register("page_scan", "SELECT url, md5(html) AS html_md5 FROM pages")
def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages."""
    return read_pages(spark, f"{sf_dir}/pages.parquet").select("url", F.md5("html").alias("html_md5"))


_HEADING = "regexp_extract(html, '<h1>(.*?)</h1>', 1)"


@register("body_or_not_found", f"""
SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 3 = 0 THEN 'Not found' ELSE 'Page ' || CAST(page_id AS VARCHAR) || ': A' || {_sql_strip(_HEADING)} END AS body
FROM pages""")
def body_or_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: the text of ``section.entry``, ``Not found`` without one, null for a page that is not stored."""
    key = F.col("page_id")
    section = F.concat(F.lit('<section class="post entry">Page '), key.cast("string"), F.lit(": &#0000065;<b>"),
                       F.regexp_extract("html", "<h1>(.*?)</h1>", 1), F.lit("</b></section>"))
    html = F.when(key % 5 != 0, F.concat(F.when(key % 3 != 0, section).otherwise(F.lit("")), F.col("html")))
    rows = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return article_body(rows, compat_not_found=True).select("page_id", "body")
