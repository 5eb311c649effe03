"""Dedupe, merge with the master table, sort, rank and top-k.

Keep-first is made explicit: every row carries ``priority`` (new rows 0,
master rows 1) and an ``ingest_seq``; the kept row of a key is the one with
the smallest ``(priority, ingest_seq)``. The dedupe is an aggregation on a
hash of the key columns with ``min_by``, so Spark combines map-side before
the shuffle: a key held by millions of copies is reduced inside each task
first and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import DEDUPE_KEY, MASTER_COLUMNS
from .joins import checked_broadcast, is_small


def key_hash(cols) -> F.Column:
    """SHA-256 over the JSON of the key columns (nulls and types kept apart)."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}), 256)


def keep_first(df: DataFrame, key_cols, order_cols, hashed_key: str | None = None) -> DataFrame:
    """One row per key, the first by ``order_cols``; map-side combined.

    ``hashed_key`` names a column that already holds ``key_hash(key_cols)``.
    """
    cols = df.columns
    keyed = df.withColumn("_k", F.col(hashed_key)) if hashed_key else df.withColumn("_k", key_hash(key_cols))
    packed = (keyed
              .groupBy("_k")
              .agg(F.min_by(F.struct(*cols), F.struct(*[F.col(c) for c in order_cols])).alias("_r")))
    return packed.select("_r.*")


def distinct_rows(df: DataFrame) -> DataFrame:
    """A5: full-row distinct (nulls equal); partial aggregation before the shuffle."""
    return df.distinct()


def dedupe_within_group(df: DataFrame, group_cols, dedupe_col: str, order_col: str) -> DataFrame:
    """A4: within each group keep the first row per ``dedupe_col`` value."""
    return keep_first(df, list(group_cols) + [dedupe_col], [order_col])


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Union tables whose columns differ (missing columns become null)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of a plan (file sizes for scans; no job
    runs), or None where the session does not expose it (Spark Connect)."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # noqa: BLE001
        return None
    return int(v) if isinstance(v, int) else int(v.toString())


def merge_master(new: DataFrame, master: DataFrame, key_cols=DEDUPE_KEY,
                 columns=MASTER_COLUMNS, seq_col: str = "ingest_seq",
                 split_untouched: bool | None = None, master_keys_unique: bool = False) -> DataFrame:
    """U3 + A5 + A6: new rows, then master rows; one row per identity key.

    Both inputs carry ``columns`` and ``seq_col``. New rows win over master
    rows; within one side the smaller ``seq_col`` wins. The result has
    ``columns`` plus ``priority`` (0 = from the new batch).

    When the master's keys are already unique (``master_keys_unique``; true
    for any master written by this merge), only keys present in the new
    batch can change. Then, if the batch is much smaller than the master
    (optimizer estimates) and its key hashes are proven small, they are
    broadcast: master rows with other keys pass through untouched (no
    shuffle of the master), and only the batch plus the master rows sharing
    its keys go through the keep-first aggregation. Otherwise everything
    goes through it in one shuffle. ``split_untouched`` forces the choice.
    """
    n = new.select(*columns, seq_col).withColumn("priority", F.lit(0)).withColumn("_h", key_hash(key_cols))
    m = master.select(*columns, seq_col).withColumn("priority", F.lit(1)).withColumn("_h", key_hash(key_cols))
    out = columns + ["priority", seq_col]
    order = ["priority", seq_col]
    if split_untouched is None:
        new_b, master_b = estimated_bytes(new), estimated_bytes(master)
        split_untouched = (master_keys_unique and new_b is not None and master_b is not None
                           and new_b * 10 <= master_b)
    keys_b = None
    if split_untouched:
        keys = n.select("_h").distinct()
        keys_b = F.broadcast(keys) if is_small(keys) else None
    if keys_b is None:          # one shuffle of everything
        return keep_first(n.unionByName(m), key_cols, order, hashed_key="_h").select(*out)
    touched = m.join(keys_b, "_h", "left_semi")
    untouched = m.join(keys_b, "_h", "left_anti")
    merged = keep_first(n.unionByName(touched), key_cols, order, hashed_key="_h")
    return merged.select(*out).unionByName(untouched.select(*out))


def order_columns(df: DataFrame, year_col: str = "year", score_col: str = "sort_score", tie_cols=("url", "ingest_seq")) -> list:
    """O1: year desc, score desc, nulls last, then explicit tie-breakers, as far as ``df`` has them."""
    falling = [F.col(c).desc_nulls_last() for c in (year_col, score_col) if c in df.columns]
    return falling + [F.col(c).asc_nulls_last() for c in tie_cols if c in df.columns]


def master_order(df: DataFrame, year_col: str = "year", score_col: str = "sort_score",
                 tie_cols=("url", "ordinal")) -> DataFrame:
    """O1: the rows sorted by ``order_columns``; a distributed range sort (no single-partition step)."""
    return df.orderBy(*order_columns(df, year_col, score_col, tie_cols))


def top_k_per_group(df: DataFrame, group_cols, order_cols, k: int, name: str = "rank") -> DataFrame:
    """O3: first ``k`` rows of each group; Spark plans a WindowGroupLimit,
    which keeps only ``k`` rows per group inside each task before the
    window's shuffle completes, so a huge group costs ``k`` rows, not all."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def rank_within(df: DataFrame, group_col: str, order_cols, name: str = "rank",
                         partitions: int | None = None, keep=None) -> DataFrame:
    """O2: 1-based rank inside each group; a group that holds a large share of
    the rows is spread over many tasks.

    1. range-partitioned sort on ``(group, order...)`` (the order columns
       must make rows distinct, so the range boundaries can split a hot
       group), written once to the shared checkpoint folder so every later
       step sees the same partitioning;
    2. per ``(partition, group)``: row count and first position - a table
       of at most partitions x groups rows;
    3. offsets = running count of the same group in earlier partitions
       (a window over that table), joined back (broadcast when proven small);
    4. rank = offset + position inside the partition.
    """
    from ..session import cut_lineage

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group_col)] + list(order_cols)
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    if keep is not None:        # columns that go on; the others are only sorted by
        ordered = ordered.select(group_col, *keep)
    ordered = cut_lineage(ordered.withColumn("_part", F.spark_partition_id())
                          .withColumn("_pos", F.monotonically_increasing_id()))
    blocks = ordered.groupBy("_part", group_col).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.partitionBy(group_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # partitions x groups rows: broadcast when a count proves it small; else a
    # shuffle join on (partition, group), which still spreads a hot group
    ranked = ordered.join(checked_broadcast(offsets.select("_part", group_col, "_offset", "_first")),
                          ["_part", group_col])
    rank = (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("bigint")
    return ranked.withColumn(name, rank).drop("_part", "_pos", "_offset", "_first")
