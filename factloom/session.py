"""Spark session helpers.

The library never creates data on the driver; these helpers only set
configuration that matters at scale (AQE, skew handling, UTC, Arrow) and
find the shared checkpoint folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpointed stages are removed from the shared folder once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(total_cores: int, text_heavy: bool = True) -> dict:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB).

    * shuffle partitions start high (3 x cores) and AQE coalesces them to
      ~256 MB each, so a stage never holds more than that per task;
    * scans split files into 256 MB pieces;
    * text-heavy tables (documents up to tens of thousands of words) are
      read in small columnar batches: the default 4096 rows of a long text
      column can be hundreds of MB in one task;
    * skew join splitting and the broadcast bound of ``operators.joins``
      stay on; the per-document summaries are checkpointed to
      ``spark.checkpoint.dir``, which must be a shared folder.
    """
    conf = dict(DEFAULT_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    })
    if text_heavy:
        conf["spark.sql.parquet.columnarReaderBatchSize"] = "256"
    return conf


def get_session(app: str = "factloom", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("WARN")
    except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
        pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3) folder and
    is used as is. Only a local master may run without one: it gets a fresh
    temporary folder. On a cluster each executor would write to its own disk,
    so a missing setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="factloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: like ``cut_lineage``, but compressed, and later
    reads fetch only the columns they need."""
    path = f"{checkpoint_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
