"""Query registry shared by the catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD = r"[\p{L}\p{N}_]+"
# White space as the text functions define it, for the SQL side.
WS_SQL = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"
NOT_WORD_OR_SPACE_SQL = r"[^\p{L}\p{N}_\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as an article table (content = text)."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.col("text").alias("content"))


def sql_ustrip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS_SQL}+|{WS_SQL}+$', '', 'g')"
