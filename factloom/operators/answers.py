"""Answers that are kept as they arrive.

Requests are asked in chunks. Each chunk's answers are written to a folder of their own under the store, and Spark
commits that folder when the chunk is done, so whatever stops a run later costs at most the chunk it was in: the
next run leaves out every prompt that already has a good answer in the store, wherever the earlier run stopped.

Layout of a store: ``<base>/answers/chunk=<time>-<number>-<id>/part-*.parquet``. Chunks are only ever added.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.sinks import read_if_there

ANSWER_SCHEMA = "request_id string, stage string, raw string, ok boolean, attempts int, answered_at timestamp"
# Prompts of a chunk, and chunks of a run: with more prompts than their product, chunks get larger.
CHUNK_ROWS = 20_000
MOST_CHUNKS = 1_000


def read_answers(spark: SparkSession, base: str) -> DataFrame:
    """Every answer in a store, of every chunk that was committed; empty if there is no store yet."""
    got = read_if_there(spark, lambda: spark.read.schema(ANSWER_SCHEMA).parquet(f"{base.rstrip('/')}/answers/*"))
    return spark.createDataFrame([], ANSWER_SCHEMA) if got is None else got


def distinct_prompts(requests: DataFrame) -> DataFrame:
    """``(request_id, stage, prompt)``: one row per prompt.

    The id is a hash of the prompt, so any of its rows will do; copies are dropped in each task before the one shuffle.
    """
    return requests.select("request_id", "stage", "prompt").dropDuplicates(["request_id"])


def unanswered(requests: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Requests without a good answer yet; a request that failed before is asked again."""
    if answers is None:
        return requests
    return requests.join(answers.filter("ok").select("request_id").distinct(), "request_id", "left_anti")


def slot_of(request_id: Column) -> Column:
    """The place of a prompt among ``MOST_CHUNKS``: the first eight hexadecimal digits of its id, as a number, dealt over them."""
    return F.pmod(F.conv(F.substring(request_id, 1, 8), 16, 10).cast("long"), F.lit(MOST_CHUNKS)).cast("int")


def ask_stored(requests: DataFrame, responder: Callable[[pd.Series], pd.Series], base: str, chunk_rows: int = CHUNK_ROWS,
               retries: int = 3, answered_at: Column | None = None, stop_after: int | None = None) -> DataFrame:
    """Asks what the store does not know yet, chunk by chunk, and returns all answers of the store.

    The prompts to ask are written once to the shared folder, ordered by slot, so that a chunk (a range of slots, one
    job) reads its own files only; it appends one committed folder of answers. ``stop_after`` ends the run after so
    many chunks (a call budget); what is left is asked by the next run. A responder that raises ``ResponderStopped``
    ends the run at once, and the chunks before stay. Prompts that fail alone are stored as failed and asked again by
    the next run.
    """
    from .enrich import reply_batches
    spark = requests.sparkSession
    staged = f"{checkpoint_dir(spark)}/prompts-{uuid.uuid4().hex}"
    todo = distinct_prompts(unanswered(requests, read_answers(spark, base)))
    (todo.withColumn("slot", slot_of(F.col("request_id"))).repartitionByRange("slot").sortWithinPartitions("slot")
     .write.parquet(staged))
    prompts = spark.read.schema("request_id string, stage string, prompt string, slot int").parquet(staged)
    chunks = min(MOST_CHUNKS, -(-prompts.count() // chunk_rows))
    started = int(time.time())
    for c in range(chunks if stop_after is None else min(chunks, stop_after)):
        low, high = -(-c * MOST_CHUNKS // chunks), -(-(c + 1) * MOST_CHUNKS // chunks)
        part = prompts.where((F.col("slot") >= low) & (F.col("slot") < high)).drop("slot")
        reply_batches(part, responder, retries, answered_at).write.parquet(
            f"{base.rstrip('/')}/answers/chunk={started:012d}-{c:05d}-{uuid.uuid4().hex[:8]}")
    return read_answers(spark, base)
