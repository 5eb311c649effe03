"""The master table in key buckets.

Rows live in buckets of the hash of their identity key. A merge reads and rewrites only the buckets that hold a
key of the new batch; the others are carried over by name. What a snapshot consists of is written in its manifest, so
every snapshot that was ever published can still be read, and nothing is overwritten:

    <base>/versions/version=<key>/bucket=<n>/   the rows of the buckets that run <key> rewrote
    <base>/manifests/<key>/                     (bucket, version): which run's files hold each bucket
    <base>/orders/<key>/                        (position, key_hash): the order of the snapshot, when it was asked for
    <base>/current/                             pointer rows; the highest run is the current snapshot

A bucket of at most a few hundred MB is one task's work; ``buckets`` is chosen when the master is created and stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DEDUPE_KEY, MASTER_COLUMNS
from ..operators.joins import checked_broadcast
from ..operators.merge import keep_first, key_hash, order_columns, rank_within
from ..session import checkpoint_dir
from .sinks import current_pointer, export_columns, publish, read_if_there

BUCKETS = 256
MOST_BUCKETS = 1 << 16
MANIFEST_SCHEMA = "bucket int, version string"


def bucket_of(hashed: Column, buckets: int) -> Column:
    """The bucket of a key: the first eight hexadecimal digits of its hash, as a number, dealt over ``buckets``."""
    return F.pmod(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, base: str, key: str) -> dict[int, str]:
    """Bucket -> version of a snapshot: at most ``MOST_BUCKETS`` entries. A snapshot without its manifest is an error."""
    rows = spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(f"{base.rstrip('/')}/manifests/{key}").collect()
    return {r["bucket"]: r["version"] for r in rows}


def read_buckets(spark: SparkSession, base: str, key: str, only: set[int] | None = None) -> DataFrame | None:
    """The rows of snapshot ``key`` with their key_hash, from all its buckets or from those in ``only``: the files of
    other buckets are not part of the plan. None when there is no such bucket."""
    root = f"{base.rstrip('/')}/versions"
    paths = [f"{root}/version={v}/bucket={b}" for b, v in sorted(manifest(spark, base, key).items()) if only is None or b in only]
    return spark.read.parquet(*paths) if paths else None


def merge_into_master(new: DataFrame, base: str, snapshot_date: str, key_cols=DEDUPE_KEY, columns=MASTER_COLUMNS,
                      seq_cols=("ingest_seq",), buckets: int = BUCKETS) -> str:
    """U3 + A5 + A6 over a bucketed master: new rows win over the master's, within the batch the smallest ``seq_cols``;
    one row per key. Writes the touched buckets, the manifest and the pointer, in this order, and returns the key.

    The batch is written to the shared folder once (it is read for its buckets and for its rows) and reduced to one
    row per key before it meets the master, with copies dropped in each task first, so a key that a third of the batch
    shares is one row by then. Only touched buckets are read, shuffled by bucket and written. A master in the older
    layout (whole snapshots) is taken over by touching every bucket once. A run that dies before the pointer is written
    leaves the current snapshot as it was; running it again writes the same rows under another key. (Only where the very
    first run dies between manifest and pointer, the folder has to be cleared by hand: it cannot be told from a lost pointer.)
    """
    spark = new.sparkSession
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"between 1 and {MOST_BUCKETS} buckets")
    pointer = current_pointer(spark, base)
    old = pointer and pointer["snapshot"]
    bucketed = bool(pointer and pointer["buckets"])
    buckets = pointer["buckets"] if bucketed else buckets
    stored = [*columns, *seq_cols]
    batch = keep_first(new.select(*stored).withColumn("key_hash", key_hash(key_cols)), key_cols, list(seq_cols), hashed_key="key_hash")
    path = f"{checkpoint_dir(spark)}/batch-{uuid.uuid4().hex}"
    batch.withColumn("_bucket", bucket_of(F.col("key_hash"), buckets)).write.parquet(path)
    batch = spark.read.parquet(path)
    touched = {r["_bucket"] for r in batch.select("_bucket").distinct().collect()}
    carried: dict[int, str] = manifest(spark, base, old) if bucketed else {}
    master = read_buckets(spark, base, old, touched) if bucketed else read_plain(spark, base, old, key_cols)
    both = batch.withColumn("_old", F.lit(0))
    if master is not None:
        rows = master.select(*stored, "key_hash").withColumn("_bucket", bucket_of(F.col("key_hash"), buckets))
        both = both.unionByName(rows.withColumn("_old", F.lit(1)))
    # one shuffle, by bucket; the choice per key and the files of a bucket need no other
    names = [*stored, "key_hash"]
    kept = (both.repartition("_bucket").groupBy("_bucket", "key_hash")
            .agg(F.min_by(F.struct(*names), F.struct("_old", *seq_cols)).alias("_row")).select("_row.*", F.col("_bucket").alias("bucket")))
    if not bucketed and master is not None:
        touched = set(range(buckets))
    version = f"{snapshot_date}_{uuid.uuid4().hex[:8]}"
    root = base.rstrip("/")
    kept.write.partitionBy("bucket").parquet(f"{root}/versions/version={version}")
    if not bucketed and master is not None:
        touched = {r["bucket"] for r in spark.read.parquet(f"{root}/versions/version={version}").select("bucket").distinct().collect()}
    entries = sorted({**carried, **{b: version for b in touched}}.items())
    spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1).write.json(f"{root}/manifests/{version}")
    publish(spark, base, version, snapshot_date, keys_unique=True, buckets=buckets)
    return version


def read_plain(spark: SparkSession, base: str, key: str | None, key_cols) -> DataFrame | None:
    """A snapshot of the older layout, with the hash of its keys."""
    if key is None:
        return None
    rows = spark.read.parquet(f"{base.rstrip('/')}/snapshots").filter(F.col("snapshot") == key).drop("snapshot")
    return rows.withColumn("key_hash", key_hash(key_cols))


def read_snapshot(spark: SparkSession, base: str, key: str | None = None) -> DataFrame | None:
    """A snapshot of a bucketed master (default: the current one) as written, without its key hashes."""
    if key is None:
        pointer = current_pointer(spark, base)
        key = pointer and pointer["snapshot"]
    rows = key and read_buckets(spark, base, key)
    return rows.drop("key_hash", "bucket") if rows is not None else None


def order_of(spark: SparkSession, base: str, key: str, order=None) -> DataFrame:
    """O1: ``(position, key_hash)`` of a snapshot, positions from 1 without gaps; kept beside it from the first time on.

    The rows are ranked by their order columns alone (texts are not read): one range-partitioned sort, positions from
    the sizes of the ranges before. ``order`` is a list of columns that tell any two rows apart; default: year and
    score, both falling, then URL and sequence number.
    """
    path = f"{base.rstrip('/')}/orders/{key}"
    schema = "position bigint, key_hash string"
    done = read_if_there(spark, lambda: spark.read.schema(schema).parquet(path))
    if done is None:
        rows = read_buckets(spark, base, key)
        order = [*(order or order_columns(rows)), F.col("key_hash")]
        ranked = rank_within(rows.withColumn("_all", F.lit(1)), "_all", order, name="position", keep=["key_hash"])
        ranked.select("position", "key_hash").write.parquet(path)
        done = spark.read.schema(schema).parquet(path)
    return done


def read_ordered(spark: SparkSession, base: str, key: str | None = None, order=None) -> DataFrame | None:
    """A snapshot with its ``position``; the order of rows in files or partitions says nothing."""
    if key is None:
        pointer = current_pointer(spark, base)
        key = pointer and pointer["snapshot"]
    rows = key and read_buckets(spark, base, key)
    if rows is None:
        return None
    return rows.drop("bucket").join(checked_broadcast(order_of(spark, base, key, order)), "key_hash").drop("key_hash")


def export_ordered(spark: SparkSession, base: str, path: str, key: str | None = None, partitions: int | None = None) -> None:
    """The CSV export in the master's order: rows are range-partitioned and sorted by position and written from there,
    so the part files, read in the order of their names, give the rows in order, however many files there are."""
    rows = read_ordered(spark, base, key)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = export_columns(rows, keep=("position",)).repartitionByRange(n, "position").sortWithinPartitions("position").drop("position")
    text.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
