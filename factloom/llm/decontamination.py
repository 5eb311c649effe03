"""Operator 1: benchmark decontamination by size-partitioned MinHash containment search.

Short items are searched inside documents of any length. Documents are partitioned by the power of two
that holds their number of distinct five-word shingles; a document of class c is sketched by the smallest
shingle hash in each of ``BINS`` * 2**c equal parts of the hash range (one-permutation MinHash, with as
many coordinates as the size class needs, so that a long document does not drown an item). An item is
sketched once for every class, and shares a coordinate with a document if they have the same smallest
shingle there. Every document that shares one is a candidate; candidates are verified by exact
containment of the item's shingles.

Only DataFrame functions are used. With BINS = 4 a shingle that is present is the smallest of its bin with
a probability of at least 0.88, so an item of ten shingles that is contained to 0.8 is missed with a
probability under 1e-7.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.joins import checked_broadcast

from .common import only, register, staged, table, texts

WIDTH = 5
THRESHOLD = 0.8
BINS = 4
MAX_CLASS = 32


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _over_shingles(ws: str, of) -> Column:
    """``of`` the five words of each shingle; null for fewer than five words."""
    at = F.sequence(F.lit(0), F.size(ws) - WIDTH)
    return F.when(F.size(ws) >= WIDTH, F.transform(at, lambda i: of([F.get(F.col(ws), i + j) for j in range(WIDTH)])))


def shingle_hashes(ws: str) -> Column:
    return F.array_distinct(_over_shingles(ws, lambda w: F.xxhash64(*w)))


def shingle_texts(ws: str) -> Column:
    return F.array_distinct(_over_shingles(ws, lambda w: F.concat_ws(" ", *w)))


def size_class(hashes: str) -> Column:
    return F.ceil(F.log2(F.size(hashes).cast("double"))).cast("int")


def sketch(ordered: str, klass: Column) -> Column:
    """Smallest hash of each bin, of sorted hashes: bins are ranges, so it is the first of its bin."""
    bits = klass + (BINS.bit_length() - 1)

    def bin_of(h):
        # a shift by a column, as the number of bins depends on the row
        return F.call_function("shiftright", h, (F.lit(64) - bits).cast("int"))

    return F.filter(F.col(ordered), lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(F.col(ordered), i - 1))))


def _coordinates(df: DataFrame, id_col: str) -> DataFrame:
    """(id, coordinate): the sketch of each row, one row per coordinate, with the class in the low bits."""
    return (df.withColumn("_sorted", F.array_sort("hashes"))
            .select(id_col, "class", F.explode(sketch("_sorted", F.col("class"))).alias("h"))
            .select(id_col, F.col("h").bitwiseAND(F.lit(~63)).bitwiseOR(F.col("class").cast("long")).alias("coordinate")))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, key, item_id, n_shared, n_item, containment): documents that hold at least ``threshold`` of
    an item's distinct shingles.

    One row per document and item; rows that repeat id and text give one. Null texts are empty. Documents
    and items of fewer than five words have no shingle and are never reported. Null ids are reported as
    null; items that share an id are told apart by their text. Extra columns are ignored.
    """
    src = texts(docs, id_col, text_col)
    wanted = staged(texts(items, item_id, item_text).select(F.col("key").alias("item_key"), F.col("doc_id").alias("item_id"),
                                                            words(F.col("text")).alias("ws")).dropDuplicates(["item_key"])
                    .withColumn("hashes", shingle_hashes("ws")).withColumn("shingles", shingle_texts("ws"))
                    .drop("ws"), "items").where("hashes IS NOT NULL")
    classes = F.explode(F.sequence(F.lit(0), F.lit(MAX_CLASS))).alias("class")
    item_sketch = checked_broadcast(_coordinates(wanted.select("item_key", "hashes", classes), "item_key"))
    # no filter on these columns: it would move below them and compute them twice
    sketched = (src.select("key", words(F.col("text")).alias("ws")).select("key", shingle_hashes("ws").alias("hashes"))
                .withColumn("class", size_class("hashes")))
    candidates = staged(_coordinates(sketched, "key").join(item_sketch, "coordinate").select("key", "item_key").distinct(),
                        "candidates")
    asked = candidates.groupBy("key").agg(F.collect_set("item_key").alias("asked"))
    found = (src.join(checked_broadcast(asked), "key")
             .select("key", "doc_id", "asked", words(F.col("text")).alias("ws"))
             .select("key", "doc_id", "asked", shingle_texts("ws").alias("held"))
             .select("key", "doc_id", "held", F.explode("asked").alias("item_key"))
             .join(checked_broadcast(wanted.select("item_key", "item_id", "shingles")), "item_key")
             .select("doc_id", "key", "item_id", "item_key", F.size(F.array_intersect("held", "shingles")).cast("long").alias("n_shared"),
                     F.size("shingles").cast("long").alias("n_item")))
    return (found.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= threshold)
            .distinct().drop("item_key"))


ORACLE = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM d),
it AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM i),
n AS (SELECT item_id, count(*) AS n_item FROM it GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN it USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE n_shared / n_item >= 0.8"""


@register("op1_decontamination", ORACLE)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go; the others keep all their columns."""
    return only(docs, contained_items(docs, table(spark, sf_dir, "benchmark")), kept=False)
