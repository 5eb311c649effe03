"""Sinks: stage snapshots, the master table and its CSV export.

The master table is never overwritten in place: each run writes a new
snapshot partition and only then adds a one-row pointer file that names it;
the pointer with the highest run number is the current one. Nothing is
overwritten, so a reader (including this run's own merge input) always finds
a complete master, and yesterday's snapshot stays as the dated copy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import MASTER_COLUMNS, MASTER_EXPORT_COLUMNS


def snapshot_stage(df: DataFrame, stage_dir: str | None, name: str) -> DataFrame:
    """Write a stage to Parquet and continue from the written copy (off when ``stage_dir`` is None)."""
    if not stage_dir:
        return df
    path = f"{stage_dir.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_master(df: DataFrame, base: str, snapshot_date: str, partitions: int | None = None,
                 keys_unique: bool = False) -> str:
    """Write ``df`` as a new whole snapshot, then point ``current`` at it.

    The snapshot key is the date plus a run id, so a second run on the
    same day writes beside the first instead of over it. ``keys_unique``
    records in the pointer that the snapshot holds one row per identity key
    (set by the merge, which guarantees it). Returns the key. A master that
    only changes in part is better kept in buckets (``sources/master.py``).
    """
    key = f"{snapshot_date}_{uuid.uuid4().hex[:8]}"
    out = df.withColumn("snapshot", F.lit(key))
    if partitions:
        out = out.repartition(partitions)
    out.write.mode("append").partitionBy("snapshot").parquet(f"{base.rstrip('/')}/snapshots")
    publish(df.sparkSession, base, key, snapshot_date, keys_unique)
    return key


def publish(spark: SparkSession, base: str, key: str, snapshot_date: str, keys_unique: bool, buckets: int | None = None) -> None:
    """Adds the pointer row that makes ``key`` the current snapshot."""
    row = current_pointer(spark, base, check=False)
    run = (row["run"] if row else 0) + 1
    (spark.createDataFrame([(run, key, snapshot_date, keys_unique, buckets)], POINTER_SCHEMA)
     .coalesce(1).write.mode("append").json(f"{base.rstrip('/')}/current"))


# buckets: null for a whole snapshot, else the number of key buckets of the master
POINTER_SCHEMA = "run bigint, snapshot string, snapshot_date string, keys_unique boolean, buckets int"


def read_if_there(spark: SparkSession, read):
    """The DataFrame that ``read`` gives, or None if its path does not exist; other errors are raised."""
    from pyspark.errors import AnalysisException
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_pointer(spark: SparkSession, base: str, check: bool = True):
    """The pointer row with the highest run number, None for a base that holds no master.

    Only a base without a pointer and without snapshots is empty. Snapshots
    without a pointer, or a pointer that cannot be read, are errors: a merge
    that took them for an empty master would publish today's rows alone.
    """
    root = base.rstrip("/")
    pointers = read_if_there(spark, lambda: spark.read.schema(POINTER_SCHEMA).option("mode", "FAILFAST").json(f"{root}/current"))
    row = None
    if pointers is not None:
        row = pointers.orderBy(F.desc("run"), F.desc("snapshot_date"), F.desc("snapshot")).first()
    if row is not None:
        if row["run"] is None or row["snapshot"] is None:
            raise ValueError(f"the pointer of the master under {root} is broken")
        return row
    # a manifest is written just before the pointer; versions without one are what a run left that died before
    folders = ("snapshots", "manifests/*") if check else ()
    if any(read_if_there(spark, lambda f=f: spark.read.text(f"{root}/{f}")) is not None for f in folders):
        raise ValueError(f"the master under {root} has snapshots but no pointer to the current one")
    return None


def current_keys_unique(spark: SparkSession, base: str) -> bool:
    """Whether the current snapshot was written with one row per identity key."""
    row = current_pointer(spark, base)
    return bool(row and row["keys_unique"])


def current_snapshot(spark: SparkSession, base: str) -> str | None:
    """Key of the current snapshot, or None for a base without a master."""
    row = current_pointer(spark, base)
    return row["snapshot"] if row else None


def read_master(spark: SparkSession, base: str, empty_schema=None) -> DataFrame | None:
    """The current master snapshot, in whole or in buckets; files of other snapshots are not read."""
    row = current_pointer(spark, base)
    if row is None:
        return None if empty_schema is None else spark.createDataFrame([], empty_schema)
    if row["buckets"]:
        from .master import read_snapshot
        rows = read_snapshot(spark, base, row["snapshot"])
        return spark.createDataFrame([], empty_schema) if rows is None and empty_schema is not None else rows
    return spark.read.parquet(f"{base.rstrip('/')}/snapshots").filter(F.col("snapshot") == row["snapshot"]).drop("snapshot")


def export_columns(df: DataFrame, keep=()) -> DataFrame:
    """The 29 columns under their export names, as text; missing coordinates read ``Unknown``.
    Columns in ``keep`` go along unchanged."""
    cols = [F.col(c) for c in keep]
    for ours, exp in zip(MASTER_COLUMNS, MASTER_EXPORT_COLUMNS):
        c = F.col(ours) if ours in df.columns else F.lit(None)
        if ours in ("lat", "lon"):
            c = F.coalesce(c.cast("string"), F.lit("Unknown"))
        elif ours == "published":
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.cast("string").alias(exp))
    return df.select(*cols)


def write_csv_export(df: DataFrame, path: str) -> None:
    """CSV export with a header (one folder of part files)."""
    export_columns(df).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
