"""Incremental ingestion with Structured Streaming.

The reference is a daily batch; its incremental parts are "skip rows
already answered" and "merge today's rows into the master table". Here new
article files arriving in a folder are read as a stream; each micro-batch
is gated by the dictionaries and merged into the master article table with
the keep-first rule, then published as a new snapshot. The dictionary
match needs joins, windows and aggregations over the batch, so it runs in
``foreachBatch`` (batch semantics per epoch). The merge is idempotent, so a
re-run epoch after a failure writes the same result again.

Each epoch publishes a new snapshot of the master table (the dated-copy
rule), of which only the key buckets that the batch touches are written
(``sources.master``); the others are carried over by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.composites import label_and_gate
from ..sources.master import BUCKETS, merge_into_master

STREAM_ARTICLE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()), T.StructField("published", T.DateType()),
])


def merge_batch(batch: DataFrame, epoch_id: int, gazetteer: DataFrame, topics: DataFrame,
                master_base: str, snapshot_date: str, buckets: int = BUCKETS) -> None:
    """Gate one micro-batch and merge it into the master article table, bucket by bucket."""
    gated = label_and_gate(batch, gazetteer, topics, materialize=False)
    new = gated.select(*[f.name for f in STREAM_ARTICLE_SCHEMA.fields], "loc_id", "matched_term", "topic_terms")
    # within a batch the copy with the smallest content hash stays, whatever order the rows came in
    tie = F.xxhash64(*[f.name for f in STREAM_ARTICLE_SCHEMA.fields])
    new = new.withColumns({"epoch": F.lit(epoch_id).cast("long"), "tie": tie})
    columns = [c for c in new.columns if c not in ("epoch", "tie")]
    merge_into_master(new, master_base, snapshot_date, ["doc_id"], columns, ("epoch", "tie"), buckets)


def start_incremental_merge(spark: SparkSession, source_path: str, gazetteer: DataFrame, topics: DataFrame,
                            master_base: str, checkpoint_location: str, snapshot_date: str,
                            fmt: str = "parquet", available_now: bool = True, max_files_per_trigger: int = 1000):
    """Start the stream: new files under ``source_path`` -> gate -> merge -> snapshot.

    ``checkpoint_location`` must be a shared folder (it holds the stream's
    offsets, so a restarted driver resumes where it stopped).
    """
    stream = (spark.readStream.schema(STREAM_ARTICLE_SCHEMA).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(source_path))
    writer = (stream.writeStream
              .foreachBatch(lambda df, eid: merge_batch(df, eid, gazetteer, topics, master_base, snapshot_date))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


RESPONSE_ROW_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("content", T.StringType()),
    T.StructField("published", T.DateType()), T.StructField("summaries", T.StringType()),
])


def project_rows(responses: DataFrame, label_report: DataFrame | None = None) -> DataFrame:
    """Row-level part of the facts flow, valid on a streaming DataFrame:
    parse each stored response into projects, evidence flags, labels (a
    stream-static join with the label map), completeness score, year, USD."""
    from ..functions.constants import SCORE_FIELDS
    from ..functions.labels import category_by_rules, completeness_score
    from ..functions.money import usd_or_zero
    from ..operators.labels import label_map, match_labels
    from ..operators.nested import evidence_columns, explode_projects, presence_flags

    rows = explode_projects(responses, "summaries", responses.columns)
    rows = evidence_columns(presence_flags(rows))
    if label_report is not None:
        rows = match_labels(rows, label_map(label_report))
    else:
        rows = rows.withColumns({"category_0": category_by_rules(F.col("category_text")),
                                 "category_1": F.lit(None).cast("string")})
    return rows.withColumns({"sort_score": completeness_score(*SCORE_FIELDS), "year": F.year("published"),
                             "usd": usd_or_zero(F.col("amount_text"))})


def start_project_stream(spark: SparkSession, responses_path: str, out_path: str, checkpoint_location: str,
                         label_report: DataFrame | None = None, fmt: str = "parquet",
                         available_now: bool = True):
    """Stream stored responses (files) into project rows, appended to ``out_path``."""
    stream = spark.readStream.schema(RESPONSE_ROW_SCHEMA).format(fmt).load(responses_path)
    writer = (project_rows(stream, label_report).writeStream.format("parquet").outputMode("append")
              .option("path", out_path).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
