"""Article feeds: JSON responses of a news API and a social API.

Nothing is fetched here; the responses are files (or a column of stored
response text) that Spark reads in parallel with a declared schema, never
by inference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import seendate_to_date

ARTICLE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()), T.StructField("published", T.DateType()),
])

NEWS_ITEM = T.StructType([T.StructField("url", T.StringType()), T.StructField("title", T.StringType()),
                          T.StructField("seendate", T.StringType()), T.StructField("content", T.StringType())])
NEWS_RESPONSE = T.StructType([T.StructField("articles", T.ArrayType(NEWS_ITEM))])

MENTION_ITEM = T.StructType([T.StructField("content", T.StringType()), T.StructField("date", T.StringType()),
                             T.StructField("title", T.StringType()), T.StructField("url", T.StringType())])
MENTION_RESPONSE = T.StructType([T.StructField("data", T.ArrayType(MENTION_ITEM))])


def article_id(source: Column, url: Column, title: Column) -> Column:
    """Stable article id: SHA-256 over the JSON of (source, url, title).

    JSON keeps nulls and field boundaries apart (a plain concat would not).
    """
    return F.sha2(F.to_json(F.struct(source.alias("source"), url.alias("url"), title.alias("title")),
                            {"ignoreNullFields": "false"}), 256)


def _articles(items: DataFrame, source: str, date_col: Column) -> DataFrame:
    src = F.lit(source)
    return items.select(article_id(src, F.col("url"), F.col("title")).alias("doc_id"), src.alias("source"),
                        "url", "title", "content", date_col.alias("published"))


def news_from_responses(responses: DataFrame, text_col: str = "response", source: str = "news") -> DataFrame:
    """S1 on stored response text: missing key or bad JSON -> no rows (P4 not applied)."""
    parsed = responses.select(F.from_json(F.col(text_col), NEWS_RESPONSE).alias("r"))
    items = parsed.select(F.explode(F.col("r.articles")).alias("a")).select("a.*")
    return _articles(items, source, seendate_to_date(F.col("seendate")))


def read_news(spark: SparkSession, path: str, source: str = "news") -> DataFrame:
    """S1 on files: one JSON response per line (or file with ``multiLine``)."""
    raw = spark.read.schema(NEWS_RESPONSE).option("mode", "PERMISSIVE").json(path)
    items = raw.select(F.explode("articles").alias("a")).select("a.*")
    return _articles(items, source, seendate_to_date(F.col("seendate")))


def mentions_from_responses(responses: DataFrame, text_col: str = "response", source: str = "social") -> DataFrame:
    """S2 on stored response text: accumulate every ``data`` array into rows."""
    parsed = responses.select(F.from_json(F.col(text_col), MENTION_RESPONSE).alias("r"))
    items = parsed.select(F.inline(F.col("r.data")))
    return _articles(items, source, F.to_date(F.try_to_timestamp(F.col("date"))))


def read_mentions(spark: SparkSession, path: str, source: str = "social") -> DataFrame:
    """S2 on files."""
    raw = spark.read.schema(MENTION_RESPONSE).option("mode", "PERMISSIVE").json(path)
    items = raw.select(F.inline("data"))
    return _articles(items, source, F.to_date(F.try_to_timestamp(F.col("date"))))


def empty_articles(spark: SparkSession) -> DataFrame:
    """An empty source is an empty DataFrame with the article schema (no sentinel row)."""
    return spark.createDataFrame([], ARTICLE_SCHEMA)


def drop_sentinel_rows(df: DataFrame, sentinel: str = "none") -> DataFrame:
    """P5: drop rows where every column equals the sentinel text."""
    cond = None
    for c in df.columns:
        e = F.col(c).cast("string").eqNullSafe(F.lit(sentinel))
        cond = e if cond is None else (cond & e)
    return df if cond is None else df.filter(~cond)


def union_articles(*dfs: DataFrame) -> DataFrame:
    """U1 + P11: union sources with differing columns onto the article schema."""
    out = None
    for d in dfs:
        d = d.select(*[(F.col(f.name) if f.name in d.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in ARTICLE_SCHEMA.fields])
        out = d if out is None else out.unionByName(d)
    return out
