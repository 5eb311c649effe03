"""Operator 12: hard negatives by segment summaries.

A vector is cut into segments, into 1, 4 and 16 of them, and each segment's mean and deviation are stored.
Within a segment the product of two vectors is the product of their means (times the length) plus the product
of what is left, which is at most the product of the deviations, and at least minus that. The sum over the
segments bounds the score from both sides, the tighter the more segments. A search drops rows by the coarsest
bounds first, refines them with finer segments, and scores only what is left.

The same bounds are taken for blocks of vectors: a block keeps the range of its means and its largest
deviations, and an anchor visits only the blocks that may hold a score it is looking for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import register, staged, table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# The least share of a positive's score, in percent.
LEAST = 80
# Segments at each level, and the level that summarises blocks.
LEVELS = (1, 4, 16)
BLOCK_LEVEL = 1
# Vectors of a block; blocks, which are summarised in one broadcast table of 12 numbers each; cells that similar
# vectors share, found by the nearest of as many sampled vectors.
BLOCK_ROWS = 8192
MOST_BLOCKS = 200_000
CELLS = 256
TOGETHER = 256

BLOCK = ["dim", "cell", "salt"]
ROW = "vec_id long, label long, vector array<long>, summary array<double>, dim int, cell int"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector, dim) with whole-number components, one row per id; see ``hard_negatives`` for who takes part."""
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("long").alias("label"),
                       vectors[vector_col].cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(~bad)
    v = v.withColumn("vector", F.transform("vector", lambda x: F.floor(x * float(scale))))
    one = v.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return one.select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("dim"))


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Per vector, for each level, the means and then the deviations of its segments, both times the root of the
    segment's length, so that plain products of them add up to parts of the score."""
    n, dim = vectors.shape
    out = []
    for level in LEVELS:
        cuts = np.linspace(0, dim, min(level, max(1, dim)) + 1).astype(int)
        parts = [vectors[:, a:b] for a, b in zip(cuts, cuts[1:])]
        root = np.sqrt([max(1, p.shape[1]) for p in parts])
        means = np.stack([p.sum(axis=1) / max(1, p.shape[1]) for p in parts], axis=1)
        left = np.stack([np.sqrt(((p - m[:, None]) ** 2).sum(axis=1)) for p, m in zip(parts, means.T)], axis=1)
        out += [means * root, left]
    return np.hstack(out) if n else np.zeros((0, sum(2 * min(x, max(1, dim)) for x in LEVELS)))


def level_columns(dim: int, level: int) -> tuple[slice, slice]:
    """Where the means and the deviations of a level are in a summary."""
    sizes = [min(x, max(1, dim)) for x in LEVELS]
    start = 2 * sum(sizes[:level])
    return slice(start, start + sizes[level]), slice(start + sizes[level], start + 2 * sizes[level])


def matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows: doubles are exact up to 2^53, 64-bit integers beyond."""
    most = np.abs(x).max(initial=0.0) * np.abs(y).max(initial=0.0) * max(1, x.shape[1])
    if most < 2.0 ** 53:
        return np.rint(x @ y.T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def within(block: dict, anchors: dict, same_label: bool) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the block, scores of rows x anchors), with the smallest integer where a row is not wanted by an
    anchor: another label than asked for, the anchor itself, or a score outside of ``low`` to ``high``.

    Rows whose bounds rule them out for all the anchors are dropped at each level before the next is looked at.
    """
    rows = np.arange(len(block["ids"]))
    wanted = (block["labels"][:, None] == anchors["labels"][None, :]) == same_label
    wanted &= block["ids"][:, None] != anchors["ids"][None, :]
    dim = block["vectors"].shape[1]
    # room for the rounding of means and deviations, far above it and far below a score of one
    size = np.sqrt((block["vectors"] ** 2).sum(axis=1).max(initial=0.0) * (anchors["vectors"] ** 2).sum(axis=1).max(initial=0.0))
    room = 1e-6 + 1e-9 * size
    for level in range(len(LEVELS)):
        some = wanted.any(axis=1)
        rows, wanted = rows[some], wanted[some]
        m, d = level_columns(dim, level)
        means = block["summary"][rows][:, m] @ anchors["summary"][:, m].T
        spread = block["summary"][rows][:, d] @ anchors["summary"][:, d].T
        wanted &= (means + spread + room >= anchors["low"]) & (means - spread - room <= anchors["high"])
    some = wanted.any(axis=1)
    rows, wanted = rows[some], wanted[some]
    scores = exact_products(block["vectors"][rows], anchors["vectors"])
    wanted &= (scores >= anchors["low"]) & (scores <= anchors["high"])
    return rows, np.where(wanted, scores, np.iinfo(np.int64).min)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def positives_in(block: dict, anchors: dict, k: int):
    """(anchor, row, score) of the ``k`` best rows of the same label."""
    rows, scores = within(block, anchors, True)
    for j, anchor in enumerate(anchors["ids"].tolist()):
        at = np.flatnonzero(scores[:, j] > np.iinfo(np.int64).min)
        pick = at[best(block["ids"][rows[at]], scores[at, j], k)]
        yield from zip([anchor] * len(pick), block["ids"][rows[pick]].tolist(), scores[pick, j].tolist())


def negatives_in(block: dict, anchors: dict, k: int, least: int):
    """(anchor, positive, positive score, row, score) of the ``k`` best rows of other labels for each positive."""
    rows, scores = within(block, anchors, False)
    for j, anchor in enumerate(anchors["ids"].tolist()):
        at = np.flatnonzero(scores[:, j] > np.iinfo(np.int64).min)
        at = at[np.lexsort((block["ids"][rows[at]], -scores[at, j]))]
        falling = -scores[at, j]
        for positive in anchors["positives"][j]:
            p, s = positive["vec_id"], positive["score"]
            start = int(np.searchsorted(falling, -s))
            for i in at[start:start + k].tolist():
                score = int(scores[i, j])
                if 100 * score < least * s:
                    break
                yield anchor, p, s, int(block["ids"][rows[i]]), score


def _read(b: pa.RecordBatch) -> dict:
    n = b.num_rows
    return {"ids": b.column("vec_id").to_numpy(), "labels": b.column("label").to_numpy(),
            "vectors": matrix(b.column("vector"), n), "summary": matrix(b.column("summary"), n),
            "low": b.column("low").to_numpy(zero_copy_only=False), "high": b.column("high").to_numpy(zero_copy_only=False),
            "positives": b.column("positives").to_pylist()}


def _joined(parts: list[dict]) -> dict:
    return {k: np.concatenate([p[k] for p in parts]) for k in ("ids", "labels", "vectors", "summary")}


def _visits(found, schema: str):
    """A function over batches sorted by block, rows before anchors: ``found`` for each block and some anchors."""
    types = [pa.int64()] * len(schema.split(","))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        current, parts, block = None, [], None
        for b in batches:
            keys = np.stack([b.column(c).to_numpy().astype(np.int64) for c in BLOCK]
                            + [np.asarray(b.column("asks").to_pylist(), dtype=np.int64)], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                *key, asks = keys[lo].tolist()
                if key != current:
                    current, parts, block = key, [], None
                if not asks:
                    parts.append(_read(b.slice(lo, hi - lo)))
                    continue
                if not parts:
                    continue
                if block is None:
                    block = _joined(parts)
                for at in range(lo, hi, TOGETHER):
                    rows = list(found(block, _read(b.slice(at, min(TOGETHER, hi - at)))))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*rows)), types)], names=names)
    return run


def indexed(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` of ``usable`` with their summaries and blocks (dim, cell, salt).

    A cell holds the vectors nearest to one of at most ``CELLS`` sampled vectors of the commonest length, the
    others a cell by length. A cell of more than ``block_rows`` vectors, such as a great many copies of one, is
    dealt over several blocks. With more than ``MOST_BLOCKS`` times ``block_rows`` vectors blocks get larger.
    """
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    total = rows.count()
    block_rows = max(block_rows, -(-total // MOST_BLOCKS))
    n_cells = max(1, min(CELLS, total // block_rows))
    dim = sizes["dim"] if sizes else 0
    sample = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", F.lit(12)), "vec_id").limit(n_cells).toArrow()
    pivots = np.unique(matrix(sample.column("vector").combine_chunks(), sample.num_rows), axis=0) if sample.num_rows else np.zeros((1, dim))
    halves = (pivots ** 2).sum(axis=1) / 2

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                x = matrix(part.column("vector"), part.num_rows)
                # the nearest pivot is the one of largest product less half its square
                cell = np.argmax(x @ pivots.T - halves, axis=1) if d == dim else np.zeros(len(x), dtype=int)
                summary = summaries(x)
                ends = np.arange(0, summary.size + 1, summary.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), part.column("vector"),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(summary.ravel())),
                     part.column("dim"), pa.array(cell.astype(np.int32))],
                    names=["vec_id", "label", "vector", "summary", "dim", "cell"])

    summed = staged(rows.mapInArrow(run, ROW), "negatives-index")
    counts = summed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("salts"))
    # a row per cell, and there are at most CELLS of them and one per other length
    return summed.join(F.broadcast(counts), ["dim", "cell"]).withColumn(
        "salt", F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int")).drop("salts")


def block_table(index: DataFrame) -> pa.Table:
    """One row per block: the least and largest means and the largest deviations of its segments."""
    cols = []
    for s in range(LEVELS[BLOCK_LEVEL]):
        # short vectors have as many segments as components
        segments = F.least(F.lit(LEVELS[BLOCK_LEVEL]), F.greatest(F.col("dim"), F.lit(1)))
        mean = F.when(segments > s, F.get("summary", F.lit(2 + s))).otherwise(0.0)
        left = F.when(segments > s, F.get("summary", 2 + segments + s)).otherwise(0.0)
        cols += [F.min(mean).alias(f"least{s}"), F.max(mean).alias(f"most{s}"), F.max(left).alias(f"left{s}")]
    return index.groupBy(*BLOCK).agg(*cols).toArrow()


def routed(anchors: DataFrame, blocks: pa.Table) -> DataFrame:
    """A row of ``anchors`` for each block that may hold a score between its ``low`` and ``high``, except the block
    it comes from where ``away``."""
    keys = np.stack([blocks.column(c).to_numpy().astype(np.int64) for c in BLOCK], axis=1)
    segments = LEVELS[BLOCK_LEVEL]
    least, most, left = (np.stack([blocks.column(f"{name}{s}").to_numpy() for s in range(segments)], axis=1)
                         for name in ("least", "most", "left"))

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            homes = np.stack([b.column(c).to_numpy().astype(np.int64) for c in BLOCK], axis=1)
            away = np.asarray(b.column("away").to_pylist(), dtype=bool)
            low, high = b.column("low").to_numpy(zero_copy_only=False), b.column("high").to_numpy(zero_copy_only=False)
            rows, to = [], []
            for i, (d, summary) in enumerate(zip(dims.tolist(), b.column("summary"))):
                near = np.flatnonzero(keys[:, 0] == d)
                s = np.asarray(summary.values)
                m, v = level_columns(d, BLOCK_LEVEL)
                n = m.stop - m.start
                a, r = s[m] * least[near][:, :n], s[m] * most[near][:, :n]
                spread = (s[v] * left[near][:, :n]).sum(axis=1)
                up, down = np.maximum(a, r).sum(axis=1) + spread, np.minimum(a, r).sum(axis=1) - spread
                room = 1e-6 + 1e-9 * (np.abs(a).sum(axis=1) + np.abs(r).sum(axis=1) + spread)
                fits = (up + room >= low[i]) & (down - room <= high[i])
                if away[i]:
                    fits &= (keys[near] != homes[i]).any(axis=1)
                at = near[fits]
                rows += [i] * len(at)
                to += at.tolist()
                while len(rows) >= 1000 or (rows and i == b.num_rows - 1):
                    yield give(b, rows[:1000], to[:1000])
                    rows, to = rows[1000:], to[1000:]

    def give(b, rows, to):
        out = b.take(pa.array(rows))
        for c, name in enumerate(BLOCK):
            out = out.set_column(out.schema.get_field_index(name), name, pa.array(keys[to, c].astype(np.int32)))
        return out

    return anchors.mapInArrow(run, anchors.schema)


def visited(index: DataFrame, asked: DataFrame, found, schema: str) -> DataFrame:
    """What ``found`` gives for each block of ``index`` and the rows of ``asked`` that were routed to it."""
    columns = [*BLOCK, "asks", "vec_id", "label", "vector", "summary", "low", "high", "positives"]
    rows = index.withColumns({"asks": F.lit(False), "low": F.lit(0.0), "high": F.lit(0.0),
                              "positives": F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>")})
    both = rows.select(*columns).unionByName(asked.withColumn("asks", F.lit(True)).select(*columns))
    return both.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "asks", "vec_id").mapInArrow(_visits(found, schema), schema)


def hard_negatives(vectors: DataFrame, anchor_ids: F.Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that ``anchor_ids`` (a condition on vec_id) selects. A score is the exact inner product of
    the components times 256, rounded down. An anchor's positives are its ``positives`` best other rows of its
    label; a positive's negatives the ``negatives`` best rows of other labels whose score is at most the positive's
    and at least ``least`` percent of it. Ties go to the smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; zero and empty
    vectors do. Vectors are only compared with vectors of their own length. Rows that share an id count once, with the
    smallest label, then vector. Positives of negative score have no negatives. An empty table gives no rows. Other
    columns are not looked at. Components so large that a score does not fit a 64-bit integer are an error.

    Nothing is dropped by chance: bounds hold for every pair. Where vectors are spread so evenly that bounds rule
    nothing out, every anchor is scored against every row.
    """
    rows = staged(usable(vectors, id_col, vector_col, label_col), "negatives-rows")
    most = rows.agg(F.max(F.col("dim") * F.pow(F.array_max(F.transform("vector", lambda x: F.abs(x))).cast("double"), F.lit(2)))).first()[0]
    if most and most >= 2.0 ** 62:
        raise ValueError("scores of these vectors do not fit 64-bit integers")
    index = indexed(rows, block_rows)
    blocks = block_table(index)
    asked = index.where(anchor_ids).withColumns({
        "low": F.lit(float("-inf")), "high": F.lit(float("inf")), "away": F.lit(True),
        "positives": F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>")})
    # the home block first: its scores say what other blocks have to reach
    schema = "anchor_id long, vec_id long, score long"
    home = staged(visited(index, asked, lambda b, a: positives_in(b, a, positives), schema), "negatives-home")
    floors = home.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.when(F.count(F.lit(1)) >= positives, F.min("score").cast("double")).alias("floor"))
    away = asked.join(floors, "vec_id", "left").withColumn("low", F.coalesce("floor", "low")).select(asked.columns)
    far = visited(index, routed(away, blocks), lambda b, a: positives_in(b, a, positives), schema)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = staged(home.unionByName(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives), "negatives-positives")
    # 0.8 of a negative score is more than the score: no row fits
    lists = chosen.where("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("vec_id", "score")).alias("positives"), F.min("score").alias("least"), F.max("score").alias("most"))
    seeking = asked.drop("positives").join(lists, "vec_id").withColumns({
        "low": F.col("least") * (least / 100.0) - 1.0, "high": F.col("most").cast("double"), "away": F.lit(False)}).select(asked.columns)
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    near = visited(index, routed(seeking, blocks), lambda b, a: negatives_in(b, a, negatives, least), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """The contract's labels: every seventh id gets the next label."""
    label = F.col(label_col).cast("long")
    return vectors.withColumn(label_col, F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label))


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM v a JOIN v b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id
WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""


@register("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)
