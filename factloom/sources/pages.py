"""Stored web pages (S7): a ``(url, html)`` table from Parquet or raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages stored as Parquet with ``url`` and ``html`` columns."""
    return spark.read.parquet(path).select("url", "html")


def read_html_files(spark: SparkSession, path: str, base_url: str | None = None) -> DataFrame:
    """One HTML file per page (``wholetext``); the URL is the file path,
    or ``base_url`` + file name when given."""
    df = spark.read.text(path, wholetext=True).select(F.col("value").alias("html"),
                                                      F.input_file_name().alias("file"))
    url = F.col("file") if base_url is None else F.concat(F.lit(base_url.rstrip("/") + "/"),
                                                          F.regexp_extract("file", r"([^/]+)$", 1))
    return df.select(url.alias("url"), "html")
