"""The daily finish-and-merge run, as one call.

facts (one row per project) -> 29 master columns -> merged into the key
buckets they touch with the keep-first rule -> published as a new snapshot
(+ optional CSV export, in order, under the original column names).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import DEDUPE_KEY, MASTER_COLUMNS
from ..sources.master import BUCKETS, export_ordered, merge_into_master

MASTER_TYPES = {
    "title": T.StringType(), "published": T.DateType(), "content": T.StringType(), "url": T.StringType(),
    "performed": T.BooleanType(), "summaries": T.StringType(), "location": T.StringType(),
    "what_built": T.StringType(), "funder": T.StringType(), "amount_text": T.StringType(),
    "category_text": T.StringType(), "expected_completion": T.StringType(), "additional": T.StringType(),
    "lat": T.DoubleType(), "lon": T.DoubleType(), "town_en": T.StringType(), "town_ar": T.StringType(),
    "admin3_en": T.StringType(), "admin3_ar": T.StringType(), "admin2_en": T.StringType(),
    "admin2_ar": T.StringType(), "loc_id": T.StringType(), "matched_term": T.StringType(),
    "loc_type": T.StringType(), "sort_score": T.IntegerType(), "year": T.IntegerType(),
    "category_0": T.StringType(), "category_1": T.StringType(), "usd": T.DoubleType(),
}
MASTER_SCHEMA = T.StructType([T.StructField(c, MASTER_TYPES[c]) for c in MASTER_COLUMNS]
                             + [T.StructField("ingest_seq", T.LongType())])


def to_master_rows(facts: DataFrame, seq_cols=("doc_id", "ordinal")) -> DataFrame:
    """The 29 typed master columns plus an ``ingest_seq``: the facts' own, else a hash of the project identity
    (stable, never a generated row number)."""
    cols = [(F.col(c) if c in facts.columns else F.lit(None)).cast(MASTER_TYPES[c]).alias(c) for c in MASTER_COLUMNS]
    seq = F.col("ingest_seq") if "ingest_seq" in facts.columns else F.xxhash64(*[F.col(c) for c in seq_cols if c in facts.columns])
    return facts.select(*cols, seq.cast("long").alias("ingest_seq"))


def daily_merge(facts: DataFrame, master_base: str, snapshot_date: str, csv_path: str | None = None,
                buckets: int = BUCKETS) -> str:
    """Merge today's facts into the master table; returns the new snapshot key.

    New rows win, one row per 13-column identity; only the key buckets that
    today's rows touch are read and written (``sources.master``). The order
    (year desc, score desc, then URL) is a position of its own, kept beside
    the snapshot (``read_ordered``); the CSV export is written in it.
    """
    key = merge_into_master(to_master_rows(facts), master_base, snapshot_date, DEDUPE_KEY, MASTER_COLUMNS, buckets=buckets)
    if csv_path:
        export_ordered(facts.sparkSession, master_base, csv_path, key)
    return key
