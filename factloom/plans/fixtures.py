"""Small fixed dimension tables used by the registered queries.

The fact side of every registered query is a driver table (documents,
pages, part, orders, ...); these inline tables play the gazetteer, topic
list and label report, which the reference reads from spreadsheets. Each is
available both as a Spark DataFrame and as a SQL ``VALUES`` list so the
DuckDB oracle reads the very same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GAZETTEER_SCHEMA = ("loc_id bigint, loc_type string, lat double, lon double, town_en string, "
                    "town_ar string, admin3_en string, admin3_ar string, admin2_en string, admin2_ar string")

# Names are common words of the English documents, so matching has work to
# do at every scale. Bigrams never end with a word that starts a bigram.
GAZETTEER_ROWS = [
    (1, "town", 33.3, 44.4, "The", None, None, None, "Iraq Central", None),
    (2, "district", 36.2, 43.9, "Of the", None, "On the", None, None, None),
    (3, "town", 30.5, 47.8, "And", None, None, None, None, None),
    (4, "village", 32.0, 44.3, "With", None, None, None, "Are", None),
    (5, "town", 35.5, 44.0, "Is", "إس", None, None, None, None),
    (6, "town", 31.0, 46.0, "And", None, None, None, None, None),
    (7, "subdistrict", 34.0, 43.0, "Is-It", None, None, None, None, None),
    (None, "town", 0.0, 0.0, "For", None, None, None, None, None),
]

TOPIC_SCHEMA = "ord int, keywords string, label string, topic_type string"
TOPIC_ROWS = [
    (1, "that OR this", "Project", "Type A"),
    (2, "with OR by the", "Build", "Type B"),
    (3, "the OR of", "Other", "Type C"),
    (4, "be", "Construction", "Type A"),
]

LABEL_SCHEMA = "ord int, text string, label_0 string, label_1 string"


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def values_sql(rows, schema: str) -> str:
    """``(VALUES ...) AS t(cols)`` with explicit casts, for DuckDB."""
    cols = [c.strip().split(" ") for c in schema.split(",")]
    sql_types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    body = ",\n".join("(" + ", ".join(f"CAST({_sql_value(v)} AS {sql_types[t]})"
                                       for v, (_, t) in zip(r, cols)) + ")" for r in rows)
    names = ", ".join(c for c, _ in cols)
    return f"(VALUES {body}) AS t({names})"


def frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def gazetteer(spark: SparkSession) -> DataFrame:
    return frame(spark, GAZETTEER_ROWS, GAZETTEER_SCHEMA)


def topics(spark: SparkSession) -> DataFrame:
    return frame(spark, TOPIC_ROWS, TOPIC_SCHEMA)
