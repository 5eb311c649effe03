"""Operator 2: near-duplicate classes with DartMinHash signatures.

A text is a weighted set of five-word shingles. Darts are thrown at the plane of weight and rank of each
element: unit cells hold a Poisson(1) number of darts that depend on the element and the cell alone, and
a dart counts if its weight lies under the element's weight. Each dart belongs to one of k coordinates;
the dart of smallest rank is the coordinate's value, and two texts agree in a coordinate with a
probability equal to their weighted Jaccard similarity. Ranks are only looked at up to a bound that
yields about k ln k + 2k darts, so a signature costs time in proportion to the text plus k log k.

Signatures are cut into bands; texts that share a band are candidates. In each bucket every text is
compared with the one that has most copies, and verified pairs make classes. Members of buckets that still hold
several classes go on: while that finds many similar pairs, another member of each bucket meets all
members of other classes; then the pairs that are left are found by an exact join on their rarest
shingles, which texts that share a frequent passage and little else do not have in common. Two texts
of one class need no comparison, so no pair that shares a band is lost, and no group is expanded into
pairs.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.joins import checked_broadcast

from .common import fresh, only, register, row_key, staged, table, texts
from .components import components
from .shingles import mix, shingles

BANDS, ROWS = 30, 5
THRESHOLD = 0.8
# Further members of the buckets meet the others while at least this share of the comparisons finds a similar
# pair, and at most so often; all pairs that are then left are searched by their rarest shingles.
WORTHWHILE = 0.1
MAX_TURNS = 8
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
_UNIT = 1.0 / (1 << 53)


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * _UNIT


def dart_minhash(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The dart (as a 64-bit hash) of smallest rank in each of ``k`` coordinates.

    ``elements`` are distinct 64-bit hashes, ``weights`` positive and best of the order of 1 or more:
    work grows with their sum plus k log k.
    """
    total = float(weights.sum())
    bound = (k * math.log(k) + 2 * k) / total
    layers = np.ceil(weights).astype(np.int64)
    base = np.repeat(elements, layers)
    layer = np.arange(len(base)) - np.repeat(np.cumsum(layers) - layers, layers)
    limit = np.repeat(weights, layers)
    base = mix(base + layer.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    best = np.full(k, np.inf)
    value = np.zeros(k, dtype=np.uint64)
    low = 0
    while True:
        # cells of the ranks that were not looked at yet
        high = math.ceil(bound)
        ranks = np.arange(low, high, dtype=np.uint64)
        if len(ranks):
            cell = mix((base[:, None] ^ (ranks * np.uint64(0xC6BC279692B5C323))[None, :]).ravel())
            n = np.searchsorted(_POISSON, _uniform(cell), side="right")
            dart = np.repeat(cell, n)
            nth = np.arange(len(dart)) - np.repeat(np.cumsum(n) - n, n)
            where = np.repeat(np.arange(len(cell)), n)
            dart = mix(dart + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x2545F4914F6CDD1D))
            weight = layer[where // len(ranks)] + _uniform(mix(dart ^ np.uint64(0x5851F42D4C957F2D)))
            rank = low + where % len(ranks) + _uniform(mix(dart ^ np.uint64(0x14057B7EF767814F)))
            keep = weight < limit[where // len(ranks)]
            dart, rank = dart[keep], rank[keep]
            slot = (mix(dart ^ np.uint64(0x27BB2EE687B0B0FD)) % np.uint64(k)).astype(np.int64)
            order = np.argsort(-rank, kind="stable")
            slot, rank, dart = slot[order], rank[order], dart[order]
            # of several writes to a coordinate the last one stays, which has the smallest rank
            nearest, which = np.full(k, np.inf), np.zeros(k, dtype=np.uint64)
            nearest[slot], which[slot] = rank, dart
            better = nearest < best
            best, value = np.where(better, nearest, best), np.where(better, which, value)
            low = high
        if np.isfinite(best).all() and best.max() <= high:
            return value
        bound *= 2


def weighted_set(raw: bytes, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights: their counts, or 1 each."""
    s, n = np.unique(shingles(raw), return_counts=True)
    return s, n.astype(np.float64) if counted else np.ones(len(s))


def elements_of(weighted: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A weighted set as a plain one, sorted: an item of count c becomes c elements. The Jaccard similarity
    of such sets is the weighted one."""
    items, counts = weighted[0], weighted[1].astype(np.int64)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    items = np.repeat(items, counts)
    return np.sort(np.where(nth > 0, mix(items + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)), items))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct elements."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    whole = len(a) + len(b) - both
    return both / whole if whole else 0.0


def _bands(bands: int, rows: int, counted: bool):
    salt = mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                keys, out = [], []
                for key, raw in zip(part.column("tkey").to_pylist(), part.column("raw")):
                    s, w = weighted_set(raw.as_py(), counted)
                    if len(s):
                        h = salt.copy()
                        for row in dart_minhash(s, w, bands * rows).reshape(bands, rows).T:
                            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + row)
                        keys.append(np.full(bands, key, dtype=np.int64))
                        out.append(h.view(np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(out))],
                                                     names=["tkey", "band"])
    return run


def _sets(counted: bool):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                got = [elements_of(weighted_set(r.as_py(), counted)).view(np.int64) for r in part.column("raw")]
                offsets = np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("tkey"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got)))],
                    names=["tkey", "elements"])
    return run


def _similarities(batches):
    for b in batches:
        left, right = (b.column(c) for c in ("left", "right"))
        sim = [jaccard(left[i].values.to_numpy(), right[i].values.to_numpy()) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sim, pa.float64())], names=["a", "b", "sim"])


def parity_bits(elements: str) -> F.Column:
    """512 bits as 8 longs: each element flips one. Sets differ in at least as many elements as bits."""
    def word(w):
        mine = F.filter(elements, lambda e: F.shiftright(e, 6).bitwiseAND(F.lit(7)) == w)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda a, e: a.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(F.lit(63)).cast("int"))))

    return F.array(*[word(w) for w in range(8)])


def sharing_rare(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of texts of different roots that can be similar enough. ``sets`` has (tkey, root, elements).

    Of n elements, two sets of similarity t share at least one of their n - ceil(t n) + 1 rarest, by one order
    of all elements (how many texts hold them), their sizes differ by no more than t, enough elements come
    after the first one they share, and their parity bits differ in no more places than they may differ in
    elements. No such pair is lost.
    """
    rows = sets.select("tkey", "root", F.size("elements").alias("size"), F.explode("elements").alias("e"))
    held = rows.groupBy("e").agg(F.count(F.lit(1)).alias("texts"))
    ranked = rows.join(held, "e").groupBy("tkey", "root", "size").agg(
        F.array_sort(F.collect_list(F.struct("texts", "e"))).alias("by_texts"))
    first = F.slice("by_texts", F.lit(1), (F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1).cast("int"))
    firsts = staged(ranked.select("tkey", "root", "size", F.posexplode(first).alias("at", "x")).where("x.texts > 1")
                    .select("tkey", "root", "size", "at", "x.e"), "rare-shingles")
    # a shingle of one root only gives no pair; elsewhere the root with most texts is never met with itself
    most_texts = (firsts.groupBy("e", "root").agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("e").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
                  .where("roots > 1").select("e", "main"))
    bits = checked_broadcast(staged(sets.select("tkey", parity_bits("elements").alias("bits")), "parity-bits"))
    prefix = staged(firsts.join(most_texts, "e").withColumn("is_main", F.col("root") == F.col("main")).drop("main")
                    .join(bits, "tkey"), "rare-apart")
    # of two sets that are similar enough, the smaller one shares one of its first n - ceil(2t / (1 + t) n) + 1
    short = F.col("size") - F.ceil(F.col("size") * (2 * threshold / (1 + threshold)) - 1e-9) + 1
    near = prefix.where(F.col("at") < short)
    x, y = F.col("x.size"), F.col("y.size")
    smaller = (x < y) | ((x == y) & (F.col("x.tkey") < F.col("y.tkey")))
    # at the first shingle that two sets share, all others they share come later in both
    most = F.least(x - F.col("x.at"), y - F.col("y.at"))
    apart = reduce(add, [F.bit_count(F.get("x.bits", F.lit(i)).bitwiseXOR(F.get("y.bits", F.lit(i)))) for i in range(8)])
    like = ((F.col("x.e") == F.col("y.e")) & smaller & (F.col("x.root") != F.col("y.root")) & (x >= threshold * y - 1e-9)
            & (most >= threshold / (1 + threshold) * (x + y) - 1e-9)
            & (apart <= (1 - threshold) / (1 + threshold) * (x + y) + 1e-9))

    def met(left, right):
        return left.alias("x").join(right.alias("y"), like).select(
            F.least("x.tkey", "y.tkey").alias("a"), F.greatest("x.tkey", "y.tkey").alias("b"))

    return met(near.where("not is_main"), prefix).unionByName(met(near.where("is_main"), prefix.where("not is_main")))


def near_dup_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                     bands: int = BANDS, rows: int = ROWS, counted: bool = False) -> DataFrame:
    """(doc_id, key, class_id, class_size, kept): one row per input row.

    Rows with one text share a class, and so do texts whose shingle similarity is ``threshold`` or more,
    directly or through others. Shingles count once each, or as often as they occur with ``counted``.
    ``class_id`` is the smallest doc_id of the class (null if all are null), ``kept`` marks one row: that
    of the smallest doc_id, nulls last, then the smallest key; rows that repeat id and text are both
    marked or not. A null text is empty; texts without words are only like equal texts. At similarity
    0.8 a pair shares no band with probability (1 - 0.8**5)**30, under 1 in 100,000.
    """
    base = texts(docs, id_col, text_col).select("key", F.col("doc_id").cast("long").alias("doc_id"),
                                                 F.xxhash64("text").alias("tkey"), F.col("text").cast("binary").alias("raw"))
    banded = staged(base.select("tkey", "raw").mapInArrow(_bands(bands, rows, counted), "tkey long, band long"), "bands")
    # copies of a text fall together here, before anything is shuffled
    buckets = banded.groupBy("band").agg(F.min("tkey").alias("x"), F.max("tkey").alias("y")).where("x <> y").select("band")
    within = banded.join(buckets, "band").distinct()
    # the text that all others of a bucket meet is the one with most copies: an original is like all its variants
    copies = base.groupBy("tkey").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    within = staged(within.join(checked_broadcast(copies), "tkey", "left").select("band", "tkey", F.coalesce("copies", F.lit(1)).alias("copies")), "buckets")
    low = within.groupBy("band").agg(F.max_by("tkey", F.struct("copies", "tkey")).alias("low"))
    members = staged(within.select("band", "tkey").join(low, "band"), "members")
    star = members.where("tkey <> low").select(F.least("low", "tkey").alias("a"), F.greatest("low", "tkey").alias("b")).distinct()
    involved = checked_broadcast(members.select("tkey").distinct())
    sets = staged(base.select("tkey", "raw").join(involved, "tkey", "left_semi")
                  .mapInArrow(_sets(counted), "tkey long, elements array<long>").dropDuplicates(["tkey"]), "shingle-sets")

    def compared(pairs):
        left = sets.select(F.col("tkey").alias("a"), F.col("elements").alias("left"))
        right = sets.select(F.col("tkey").alias("b"), F.col("elements").alias("right"))
        return staged(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
                      .mapInArrow(_similarities, "a long, b long, sim double"), "similarities")

    first = compared(star)
    roots = components(first.where(F.col("sim") >= threshold).select("a", "b"))
    placed = members.join(roots, members["tkey"] == roots["node"], "left").select(
        "band", "low", "tkey", F.coalesce("root", "tkey").alias("root"))
    tested = first.select("a", "b")
    last = False
    for turn in range(MAX_TURNS + 1):
        placed = staged(placed, "placed")
        split = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("band")
        apart = placed.join(split, "band", "left_semi")
        if apart.isEmpty():
            break
        if last or turn == MAX_TURNS:
            last = True
            pairs = sharing_rare(sets.join(apart.select("tkey", "root").distinct(), "tkey"), threshold)
        else:
            # another member of each bucket, picked by a hash, against all members of other classes
            draw = F.xxhash64("tkey", F.lit(turn))
            picked = apart.groupBy("band").agg(F.min_by("tkey", draw).alias("pick"), F.min_by("root", draw).alias("root2"))
            pairs = (apart.join(picked, "band").where(F.col("root") != F.col("root2"))
                     .select(F.least("tkey", "pick").alias("a"), F.greatest("tkey", "pick").alias("b")))
        found = compared(pairs.distinct().join(tested, ["a", "b"], "left_anti"))
        tested = tested.unionByName(found.select("a", "b"))
        # classes that turned out to belong together
        of = placed.select("tkey", "root").distinct()
        merged = components(found.where(F.col("sim") >= threshold)
                            .join(of.select(F.col("tkey").alias("a"), F.col("root").alias("ra")), "a")
                            .join(of.select(F.col("tkey").alias("b"), F.col("root").alias("rb")), "b")
                            .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        placed = placed.join(merged, placed["root"] == merged["node"], "left").select(
            "band", "low", "tkey", F.coalesce(merged["root"], placed["root"]).alias("root"))
        if last:
            break
        got = found.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("sim") >= threshold).cast("long")).alias("ok")).first()
        last = (got["ok"] or 0) < WORTHWHILE * got["n"] or not got["n"]
    roots = placed.select(F.col("tkey").alias("node"), "root").distinct()
    ids = staged(base.select("key", "doc_id", "tkey"), "ids")
    named = ids.join(roots, ids["tkey"] == roots["node"], "left").select(
        "key", "doc_id", F.coalesce("root", "tkey").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("null_last"), "doc_id", "key")
    heads = named.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                                      F.min(order).alias("head"))
    return named.join(heads, "root").select(
        "doc_id", "key", "class_id", "class_size", (F.col("key") == F.col("head")["key"]).alias("kept"))


@register("op2_near_dups")
def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup_classes(table(spark, sf_dir, "documents")).drop("key")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class stays, with all its columns."""
    rows = staged(near_dup_classes(docs), "near-dup-classes")
    stays = only(docs, rows.where("not kept"), kept=False)
    # rows that repeat id and text were kept together; one of them stays, and only they are shuffled
    repeated = rows.where("kept").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    name = fresh(docs, "_key")
    again = only(stays, repeated, kept=True)
    once = again.withColumn(name, row_key(again)).dropDuplicates([name]).select(*docs.columns)
    return only(stays, repeated, kept=False).unionByName(once)
