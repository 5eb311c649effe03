"""Dimension tables and the master table (S3-S6): columns by name, declared types, no inference.

Spreadsheets are not a Spark source; these read CSV (with the original
column names in the header) or Parquet and map the names to ours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import MASTER_COLUMNS, MASTER_EXPORT_COLUMNS

# Original column names of each input -> ours.
GAZETTEER_NAMES = {
    "ID": "loc_id", "Town EN": "town_en", "Town AR": "town_ar", "Admin 3 EN": "admin3_en",
    "Admin 3 AR": "admin3_ar", "Admin 2 EN": "admin2_en", "Admin 2 AR": "admin2_ar",
    "Location Type": "loc_type", "Lat": "lat", "Lon": "lon",
}
TOPIC_NAMES = {"ARABIC String": "keywords", "English": "label", "Type": "topic_type"}
LABEL_NAMES = {"text": "text", "label_0": "label_0", "label_1": "label_1"}

_DOUBLE_COLS = {"lat", "lon"}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file as text columns named by its own header, quotes doubled inside quoted values.

    Multi-line values make a file one task; convert large inputs to Parquet once.
    """
    return (spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
            .option("inferSchema", "false").csv(path))


def by_name(df: DataFrame, names: dict, order_col: str | None = None) -> DataFrame:
    """The named columns of ``df`` (wherever they stand; missing ones are null) under our names and types,
    plus ``ord``: the order of the rows for last-wins rules.

    ``order_col`` names a column that holds the order; without one it is the
    position in the input, which is only known for a single file.
    """
    have = set(df.columns)
    cols = [(F.col(f"`{src}`") if src in have else F.lit(None)).try_cast("double" if dst in _DOUBLE_COLS else "string").alias(dst)
            for src, dst in names.items()]
    order = F.col(f"`{order_col}`").try_cast("bigint") if order_col else F.monotonically_increasing_id()
    return df.select(*cols, order.alias("ord"))


def _read(spark: SparkSession, path: str, names: dict, fmt: str, order_col: str | None) -> DataFrame:
    df = read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    if order_col is None and fmt == "csv" and len(df.inputFiles()) > 1:
        raise ValueError("several files have no common row order; name an order column")
    return by_name(df, names, order_col)


def read_gazetteer(spark: SparkSession, path: str, fmt: str = "csv", order_col: str | None = None) -> DataFrame:
    """S3: place names; ``loc_id`` kept as text (ids may be codes)."""
    return _read(spark, path, GAZETTEER_NAMES, fmt, order_col)


def read_topics(spark: SparkSession, path: str, fmt: str = "csv", order_col: str | None = None) -> DataFrame:
    """Topic list (``'a OR b'`` keywords, English label, type)."""
    return _read(spark, path, TOPIC_NAMES, fmt, order_col)


def read_label_report(spark: SparkSession, path: str, fmt: str = "csv", order_col: str | None = None) -> DataFrame:
    """Category text -> up to two labels."""
    return _read(spark, path, LABEL_NAMES, fmt, order_col)


def master_from_export(df: DataFrame, keep=()) -> DataFrame:
    """A master table in the 29-column export form -> typed internal columns.
    Columns in ``keep`` go along unchanged."""
    typed = {"performed": "boolean", "lat": "double", "lon": "double", "sort_score": "int",
             "year": "int", "usd": "double", "published": "date"}
    cols = [F.col(f"`{c}`") for c in keep]
    for exp, ours in zip(MASTER_EXPORT_COLUMNS, MASTER_COLUMNS):
        c = F.nullif(F.col(f"`{exp}`"), F.lit("Unknown")) if ours in ("lat", "lon") else F.col(f"`{exp}`")
        if ours == "performed":
            c = F.when(F.lower(c).isin("1", "true", "1.0"), True).when(F.lower(c).isin("0", "false", "0.0"), False)
        elif ours in typed:
            c = c.try_cast(typed[ours]) if ours != "published" else F.try_to_date(c, "yyyy-MM-dd")
        cols.append(c.alias(ours))
    return df.select(*cols)


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read yesterday's master table exported as CSV (all text)."""
    return master_from_export(read_csv(spark, path))
