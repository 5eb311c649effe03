"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import SPARK_TO_DUCK, TABLES, normalise  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = df.toPandas()
    rel = con.sql(entry.oracle_sql()[name])
    want = rel.df()
    assert sorted(got.columns) == sorted(want.columns)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields} == duck_types
    assert len(got) == len(want)
    assert normalise(got) == normalise(want)


def test_every_query_runs_and_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
    for name, fn in entry.queries().items():
        assert fn(spark, SF).schema is not None, name
