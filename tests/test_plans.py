"""Plan checks: no cartesian products, pruned scans, one shuffle on the document side."""

import re

import pytest

import __spark_entry__ as entry
from factloom.plans import fixtures as fx
from factloom.plans.composites import document_matches
from factloom.plans.registry import articles

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_product(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dictionary_match_scans_once_and_shuffles_documents_once(spark):
    df = document_matches(articles(spark, SF), fx.gazetteer(spark), fx.topics(spark))
    plan = plan_of(df)
    assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)) == {"struct<doc_id:bigint,text:string>"}
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id", plan)) == 1
    assert "BroadcastHashJoin" in plan


def test_flagship_attach_reads_only_kept_columns(spark):
    plan = plan_of(entry.entry(spark))
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)) == {"struct<doc_id:bigint,lang:string>"}
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
