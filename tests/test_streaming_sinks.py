import datetime
import tempfile

import pytest
from pyspark.sql import functions as F

from factloom.plans import fixtures as fx
from factloom.sources.feeds import ARTICLE_SCHEMA, drop_sentinel_rows, empty_articles, union_articles
from factloom.sources.master import read_snapshot
from factloom.sources.sinks import current_snapshot, export_columns, read_master, write_master
from factloom.streaming.incremental import STREAM_ARTICLE_SCHEMA, start_incremental_merge


def articles(spark, rows):
    d = datetime.date(2024, 1, 1)
    return spark.createDataFrame([(str(i), "news", f"u{i}", f"t{i}", text, d) for i, text in rows], STREAM_ARTICLE_SCHEMA)


def test_stream_gates_and_merges_idempotently(spark):
    root = tempfile.mkdtemp(prefix="factloom-stream-")
    src, master, ckpt = f"{root}/in", f"{root}/master", f"{root}/ckpt"
    articles(spark, [(1, "this is the plan"), (2, "nothing to see")]).write.parquet(f"{src}/a")
    gaz, topics = fx.gazetteer(spark), fx.topics(spark)
    q = start_incremental_merge(spark, f"{src}/*", gaz, topics, master, ckpt, "2024-01-02")
    q.awaitTermination()
    first = {r.doc_id for r in read_master(spark, master).collect()}
    assert first == {"1"}
    key1 = current_snapshot(spark, master)
    articles(spark, [(1, "this is changed"), (3, "that one")]).write.parquet(f"{src}/b")
    q = start_incremental_merge(spark, f"{src}/*", gaz, topics, master, ckpt, "2024-01-03")
    q.awaitTermination()
    rows = {r.doc_id: r.content for r in read_master(spark, master).collect()}
    assert rows == {"1": "this is changed", "3": "that one"}
    assert current_snapshot(spark, master) != key1
    # the first snapshot is still there, untouched
    assert [(r.doc_id, r.content) for r in read_snapshot(spark, master, key1).collect()] == [("1", "this is the plan")]


def test_master_snapshots_never_overwrite(spark):
    base = tempfile.mkdtemp(prefix="factloom-master-")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    k1 = write_master(df, base, "2024-01-01")
    k2 = write_master(read_master(spark, base).withColumn("v", F.lit("b")), base, "2024-01-01")
    assert k1 != k2 and [r.v for r in read_master(spark, base).collect()] == ["b"]


def test_broken_master_pointers_raise(spark):
    """Only a base without pointer and snapshots is empty; a lost or broken pointer is an error."""
    import pathlib
    import shutil

    base = tempfile.mkdtemp(prefix="factloom-master-")
    assert read_master(spark, base) is None and current_snapshot(spark, f"{base}/none") is None
    write_master(spark.createDataFrame([(1, "a")], "id int, v string"), base, "2024-01-01")
    lost = tempfile.mkdtemp(prefix="factloom-lost-")
    shutil.copytree(f"{base}/snapshots", f"{lost}/snapshots")
    with pytest.raises(ValueError, match="no pointer"):
        read_master(spark, lost)
    for part in pathlib.Path(f"{base}/current").glob("part-*"):
        part.write_text("{not json\n")
    for crc in pathlib.Path(f"{base}/current").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception):
        read_master(spark, base)


def test_sources_helpers(spark):
    e = empty_articles(spark)
    assert e.count() == 0 and e.schema == ARTICLE_SCHEMA
    df = spark.createDataFrame([("none", "none"), ("x", "none")], "a string, b string")
    assert drop_sentinel_rows(df).count() == 1
    u = union_articles(spark.createDataFrame([("u", "t")], "url string, title string"), e)
    assert u.columns == [f.name for f in ARTICLE_SCHEMA.fields] and u.count() == 1


def test_export_names_and_unknown(spark):
    df = spark.createDataFrame([("T", None, 2.5)], "title string, lat double, lon double")
    row = export_columns(df).first().asDict()
    assert len(row) == 29 and row["Matched Lat"] == "Unknown" and row["Matched Lon"] == "2.5" and row["title"] == "T"


def test_project_stream_appends_parsed_rows(spark):
    from factloom.streaming.incremental import RESPONSE_ROW_SCHEMA, start_project_stream
    root = tempfile.mkdtemp(prefix="factloom-pstream-")
    d = datetime.date(2024, 5, 1)
    resp = ("[{'Location of project': 'Basra', 'What is being built': 'port', "
            "'Category of project that is being constructed': 'Commercial', 'Amount of money being spent': '$2 million'}, "
            "{'Location of project': 'Mosul', 'What is being built': 'school', 'Amount of money being spent': 'n/a'}]")
    spark.createDataFrame([("1", "u1", "t", "A port in Basra", d, resp)], RESPONSE_ROW_SCHEMA) \
        .write.parquet(f"{root}/in/a")
    labels = spark.createDataFrame([(1, "Commercial", "['Commercial Construction']", None)],
                                   "ord int, text string, label_0 string, label_1 string")
    q = start_project_stream(spark, f"{root}/in/*", f"{root}/out", f"{root}/ckpt", labels)
    q.awaitTermination()
    got = sorted((r.location, r.category_0, r.usd, r.sort_score, r.location_match)
                 for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("Basra", "Commercial Construction", 2e6, 4, True), ("Mosul", None, 0.0, 2, False)]
