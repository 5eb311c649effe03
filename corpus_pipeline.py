"""A corpus pipeline of five stages: reject, thin out, deduplicate, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage's result to the shared folder and reads it back, so that a lost
executor costs a stage at most and no stage is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm.common import staged, table
from factloom.llm.decontamination import decontamination_stage
from factloom.llm.line_dedup import line_dedup_stage
from factloom.llm.near_dups import near_dup_stage
from factloom.llm.packing import packing_stage
from factloom.llm.quality import quality_stage

STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dups", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Learned scores, signatures and tokenisation are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
