"""Operator 8: nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a fixed set of pivots, nearest first. Each block of
vectors keeps one inverted file per pivot: the position of that pivot in the order of each vector. A query
walks the files of its own pivots in its order and adds up the differences of positions (Spearman's
footrule); the vectors of smallest distance are reranked by the exact inner product.

Inner products grow with a vector's norm as well as with its direction, so vectors get one more component,
sqrt(M^2 - |x|^2) with M the largest norm, and queries a zero there: then the order by angle is the order
by inner product, also for vectors that are not of unit length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import register, staged, table

# Pivots (a bounded sample of the vectors), how many of them each vector posts, vectors of a block, the
# share of a block that is reranked, and at least how many vectors for each neighbour asked for. On 50,000
# vectors of 64 dimensions without clear clusters, whose 20 nearest have cosines around 0.35, all 128
# pivots and 8 % give a recall of 0.99; fewer posted pivots lose it quickly (64 of 128: 0.82), as far pivots
# tell as much as near ones there.
PIVOTS = 128
POSTED = 128
BLOCK_ROWS = 8192
RERANK_SHARE = 0.08
RERANK_EACH = 40
K = 20


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector): one row per id, without vectors that take no part."""
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        ~bad & F.exists("vector", lambda x: x != 0))
    return v.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _positions(vectors: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """Position of each pivot in each vector's order; ``posted`` for pivots beyond the posted ones."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :posted]
    out = np.full((len(vectors), len(pivots)), posted, dtype=np.int16)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.int16)[None, :].repeat(len(vectors), 0), axis=1)
    return out


class Block:
    """Inverted files of one block. Equal vectors are posted once, with the smallest of their ids: no more
    than k + 1 of them can be among the k nearest of a query that is one of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, top: float, k: int, share: float, posted: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        _, first, group = np.unique(vectors.view(f"V{vectors.itemsize * vectors.shape[1]}").ravel(), return_index=True, return_inverse=True)
        by_group = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group))
        self.members = [ids[by_group[a:min(b, a + k + 1)]] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        self.vectors, self.k, self.pivots, self.posted = vectors[first], k, pivots, posted
        norms = (self.vectors ** 2).sum(axis=1)
        raised = np.hstack([self.vectors, np.sqrt(np.maximum(top * top - norms, 0))[:, None]])
        self.files = np.ascontiguousarray(_positions(raised, pivots, posted).T)
        self.n_rerank = min(len(first), max(RERANK_EACH * k, int(np.ceil(share * len(first)))))

    def search(self, ids: np.ndarray, queries: np.ndarray):
        """For each query (ids, scores) of its nearest in this block."""
        seen = _positions(np.hstack([queries, np.zeros((len(queries), 1))]), self.pivots, self.posted)
        step = np.empty(len(self.vectors), dtype=np.int16)
        for query, vector, order in zip(ids, queries, seen):
            footrule = np.zeros(len(self.vectors), dtype=np.int32 if self.posted * len(self.pivots) > 32000 else np.int16)
            for pivot in np.flatnonzero(order < self.posted):
                np.subtract(self.files[pivot], order[pivot], out=step)
                np.abs(step, out=step)
                footrule += step
            near = np.argpartition(footrule, self.n_rerank - 1)[:self.n_rerank]
            # products of equal vectors have to be equal in any block, so sums run in one fixed order
            scores = (self.vectors[near] * vector).sum(axis=1)
            best = near[np.argsort(-scores, kind="stable")][:self.k + 1]
            least = (self.vectors[best] * vector).sum(axis=1).min()
            tied = near[scores >= least]
            value = np.concatenate([np.full(len(self.members[g]), s) for g, s in zip(tied, scores[scores >= least])])
            who = np.concatenate([self.members[g] for g in tied])
            value, who = value[who != query], who[who != query]
            pick = np.lexsort((who, -value))[:self.k]
            yield query, who[pick], value[pick]


def search(vectors: DataFrame, query_ids: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           n_pivots: int = PIVOTS, posted: int = POSTED, block_rows: int = BLOCK_ROWS,
           share: float = RERANK_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row that ``query_ids`` (a condition
    on vec_id) selects, by largest inner product, ties to the smaller id.

    Null ids and vectors that are null, all zero or hold null or non-finite components take no part, nor
    do vectors of another length than most. Rows that share an id count once, with the smallest vector.
    An empty table gives no rows, and queries have fewer than ``k`` rows if there are fewer candidates.
    Every query meets every block: the work is queries times vectors, in blocks.
    """
    spark = vectors.sparkSession
    rows = staged(usable(vectors, id_col, vector_col), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    schema = "query_id long, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == sizes["dim"])
    norm2 = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    top = float(np.sqrt(rows.agg(F.max(norm2)).first()[0])) * (1 + 1e-12)
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(4 * n_pivots).toArrow()
    pivots = np.unique(np.array(sample.column("vector").to_pylist()), axis=0)
    pivots = pivots[np.random.default_rng(5).permutation(len(pivots))[:n_pivots]]
    pivots = np.hstack([pivots, np.sqrt(np.maximum(top * top - (pivots ** 2).sum(axis=1), 0))[:, None]])
    posted = min(posted, len(pivots))
    n_blocks = max(1, -(-sizes["n"] // block_rows))
    indexed = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block"),
                          F.lit(False).alias("is_query"), "vec_id", "vector")
    asked = rows.where(query_ids).select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
                                         F.lit(True).alias("is_query"), "vec_id", "vector")

    def run(batches):
        current, parts, block = None, [], None

        def matrix(b):
            return (b.column("vec_id").to_numpy(),
                    b.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))

        for b in batches:
            kinds = b.column("block").to_numpy() * 2 + np.asarray(b.column("is_query").to_pylist(), dtype=int)
            cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                number, is_query = divmod(int(kinds[lo]), 2)
                if number != current:
                    current, parts, block = number, [], None
                part = matrix(b.slice(lo, hi - lo))
                if not is_query:
                    parts.append(part)
                    continue
                if block is None:
                    if not parts:
                        continue
                    block = Block(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), pivots, top, k, share, posted)
                for at in range(0, hi - lo, 256):
                    found = list(block.search(part[0][at:at + 256], part[1][at:at + 256]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([np.full(len(w), q) for q, w, _ in found]), pa.int64()),
                         pa.array(np.concatenate([w for _, w, _ in found]), pa.int64()),
                         pa.array(np.concatenate([s for _, _, s in found]), pa.float64())], names=["query_id", "vec_id", "score"])

    n_parts = min(n_blocks, 4000)
    near = (indexed.unionByName(asked).repartitionByRange(n_parts, "block").sortWithinPartitions("block", "is_query", "vec_id")
            .mapInArrow(run, schema))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@register("op8_permutation_index")
def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
