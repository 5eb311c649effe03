"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component. ``edges`` has columns a and b (long).

    Large stars link every larger neighbour of a node to its smallest one, small stars every smaller
    neighbour; the two alternate until no edge changes, after about log n rounds. Neighbour lists are
    never gathered: each round is two aggregations and joins on the node.
    """
    def fingerprint(e):
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    # kept as (a, b) with a < b
    cur = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    last = fingerprint(cur)
    while last[0]:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").where("m <> b")
                 .select(F.col("m").alias("a"), "b").distinct())
        # every edge leads from the smaller to the larger end; b's smaller neighbours meet at the least
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        linked = large.join(least, "b")
        small = (linked.where("a <> m").select(F.col("m").alias("x"), F.col("a").alias("y"))
                 .unionByName(least.select(F.col("m").alias("x"), F.col("b").alias("y"))))
        cur = staged(small.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                     .where("a <> b").distinct(), "edges")
        now = fingerprint(cur)
        if now == last:
            break
        last = now
    members = cur.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return members.unionByName(cur.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
