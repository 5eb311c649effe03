"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.joins import checked_broadcast
from factloom.session import checkpoint_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query, and its DuckDB oracle where SQL can express one."""
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows and bytes of one Arrow batch: rows are whole texts, of which the default of 10,000 rows and 64 MB is held
# in several copies at once by the JVM and the worker.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": (10_000, 1_000),
               "spark.sql.execution.arrow.maxBytesPerBatch": (64 << 20, 8 << 20)}


@contextmanager
def bounded_batches(spark: SparkSession):
    """Holds Arrow batches small inside the block; sizes that the session names itself stay."""
    def size(x):
        return int(str(x).removesuffix("b"))

    changed = {}
    for name, (default, small) in ARROW_BATCH.items():
        before = spark.conf.get(name, str(default))
        if size(before) == default:
            changed[name] = before
            spark.conf.set(name, str(small))
    try:
        yield
    finally:
        for name, before in changed.items():
            spark.conf.set(name, before)


def staged(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Compressed and columnar, so a stage that is read several times costs little disk and later reads
    fetch only their columns; an executor lost afterwards takes nothing with it.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    with bounded_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, text): null texts become empty.

    ``key`` identifies a row by its id and text, so rows with a null id, and rows that repeat an id with
    another text, keep decisions of their own; rows that repeat both share one.
    """
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    return df.select(row_key(df, id_col, text_col).alias("key"), df[id_col].alias("doc_id"), text.alias("text"))


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> F.Column:
    """The ``key`` of ``texts`` as a column of ``df``."""
    return F.xxhash64(F.coalesce(df[id_col].cast("string"), F.lit("\u0000")),
                      F.coalesce(df[text_col].cast("string"), F.lit("")))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def only(docs: DataFrame, keys: DataFrame, kept: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose row key is in ``keys`` (column key), or is not.

    The keys are broadcast if they are proven small, so that texts stay in place; else both sides are shuffled.
    """
    name = fresh(docs, "_key")
    keyed = docs.withColumn(name, row_key(docs, id_col, text_col))
    wanted = checked_broadcast(staged(keys.select(F.col("key").alias(name)).distinct(), "keys"))
    return keyed.join(wanted, name, "left_semi" if kept else "left_anti").select(*docs.columns)
