"""The bucketed master (S9, A6, U3, O1) and answers kept by chunk."""

import datetime
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from factloom.operators import enrich as E
from factloom.operators.answers import ask_stored, read_answers
from factloom.plans.daily import daily_merge
from factloom.sources import master as M
from factloom.sources.sinks import current_pointer, read_master, write_master

SCHEMA = "title string, url string, v string, year int, sort_score int, ingest_seq long"
COLS = ["title", "url", "v", "year", "sort_score"]


def rows(spark, items):
    return spark.createDataFrame([(f"t{i}", f"u{i}", v, 2020 + i % 3, i % 5, i) for i, v in items], SCHEMA)


def put(df, base, day, **kw):
    return M.merge_into_master(df, base, day, ["title"], COLS, buckets=8, **kw)


def test_merge_rewrites_touched_buckets_only(spark):
    base = tempfile.mkdtemp(prefix="factloom-master-")
    k1 = put(rows(spark, [(i, "old") for i in range(200)]), base, "2024-01-01")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/versions/**/*.parquet", recursive=True)}
    k2 = put(rows(spark, [(7, "new"), (500, "new")]), base, "2024-01-02")
    m1, m2 = M.manifest(spark, base, k1), M.manifest(spark, base, k2)
    touched = {b for b, v in m2.items() if v == k2}
    assert 1 <= len(touched) <= 2 and {b for b in m1 if m1[b] != m2[b]} <= touched
    # what the merge read: no file of another bucket is in its plan
    files = M.read_buckets(spark, base, k1, touched).inputFiles()
    assert files and all(any(f"/bucket={b}/" in f for b in touched) for f in files)
    got = {r.title: r.v for r in read_master(spark, base).collect()}
    assert len(got) == 201 and got["t7"] == got["t500"] == "new" and got["t8"] == "old"
    # the old snapshot and its files are intact
    assert {r.v for r in M.read_snapshot(spark, base, k1).collect()} == {"old"} and M.read_snapshot(spark, base, k1).count() == 200
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())


def test_merge_keeps_first_and_repeats_to_the_same_rows(spark):
    base = tempfile.mkdtemp(prefix="factloom-master-")
    hot = spark.range(3000).select(F.lit("same").alias("title"), F.lit("u").alias("url"), F.col("id").cast("string").alias("v"),
                                   F.lit(2024).alias("year"), F.lit(1).alias("sort_score"), (F.col("id") + 5).alias("ingest_seq"))
    batch = hot.unionByName(rows(spark, [(i, "x") for i in range(20)]))
    put(batch, base, "2024-01-01")
    one = sorted(map(tuple, read_master(spark, base).collect()), key=str)
    put(batch, base, "2024-01-01")
    assert sorted(map(tuple, read_master(spark, base).collect()), key=str) == one
    assert [r.v for r in read_master(spark, base).filter("title = 'same'").collect()] == ["0"] and len(one) == 21
    empty = put(batch.limit(0), base, "2024-01-02")
    assert current_pointer(spark, base)["snapshot"] == empty and read_master(spark, base).count() == 21


def test_whole_snapshot_is_taken_over(spark):
    base = tempfile.mkdtemp(prefix="factloom-master-")
    write_master(rows(spark, [(i, "old") for i in range(50)]), base, "2024-01-01")
    put(rows(spark, [(3, "new"), (60, "new")]), base, "2024-01-02")
    got = {r.title: r.v for r in read_master(spark, base).collect()}
    assert len(got) == 51 and got["t3"] == "new" and got["t4"] == "old" and current_pointer(spark, base)["buckets"] == 8


def test_lost_pointer_of_buckets_raises(spark):
    import shutil
    base, lost = tempfile.mkdtemp(prefix="factloom-master-"), tempfile.mkdtemp(prefix="factloom-lost-")
    put(rows(spark, [(1, "a")]), base, "2024-01-01")
    shutil.copytree(f"{base}/manifests", f"{lost}/manifests")
    with pytest.raises(ValueError, match="no pointer"):
        put(rows(spark, [(2, "b")]), lost, "2024-01-02")


def test_order_survives_many_files(spark):
    base, out = tempfile.mkdtemp(prefix="factloom-master-"), tempfile.mkdtemp(prefix="factloom-csv-")
    facts = spark.range(300).select(F.concat(F.lit("t"), "id").alias("title"), F.concat(F.lit("u"), F.col("id") % 7).alias("url"),
                                    F.lit(datetime.date(2024, 1, 1)).alias("published"), (2020 + F.col("id") % 4).cast("int").alias("year"),
                                    F.when(F.col("id") % 11 != 0, (F.col("id") % 5).cast("int")).alias("sort_score"), F.col("id").alias("ingest_seq"))
    key = daily_merge(facts, base, "2024-01-01", buckets=16)
    M.export_ordered(spark, base, f"{out}/csv", partitions=6)
    want = sorted(range(300), key=lambda i: (-(2020 + i % 4), i % 11 == 0, -(i % 5) if i % 11 else 0, f"u{i % 7}", i))
    ordered = M.read_ordered(spark, base).collect()
    assert sorted(r.position for r in ordered) == list(range(1, 301))
    assert [r.title for r in sorted(ordered, key=lambda r: r.position)] == [f"t{i}" for i in want]
    files = sorted(glob.glob(f"{out}/csv/part-*.csv"))
    lines = [line.split(",")[0] for f in files for line in open(f).read().splitlines()[1:]]
    assert len(files) >= 4 and lines == [f"t{i}" for i in want]
    assert os.path.isdir(f"{base}/orders/{key}")


# ------------------------------------------------------------------ E1
def requests(spark, n=90, copies=3):
    docs = spark.createDataFrame([(i, f"text {i % (n // copies)}") for i in range(n)], "doc_id long, content string")
    return docs, E.build_requests(docs, "doc_id", "content", "s", "{text}")


def counting(folder, stop_after=None):
    """A responder that logs each prompt it is given, and gives up after so many."""
    def responder(prompts):
        import os
        import uuid
        for p in prompts:
            if stop_after is not None and len(os.listdir(folder)) >= stop_after:
                raise E.ResponderStopped("quota")
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(p)
        return prompts.map(lambda p: "1. " + p)
    return responder


def asked(folder):
    return sorted(open(f"{folder}/{f}").read() for f in os.listdir(folder))


def test_killed_run_goes_on_where_it_stopped(spark):
    store, first, second = (tempfile.mkdtemp(prefix="factloom-answers-") for _ in range(3))
    docs, req = requests(spark)                     # 30 prompts for 90 rows
    with pytest.raises(Exception):
        ask_stored(req, counting(first, stop_after=17), store, chunk_rows=5)
    kept = {r.request_id for r in read_answers(spark, store).collect()}
    assert len(asked(first)) == 17 and 0 < len(kept) <= 17
    answers = ask_stored(req, counting(second), store, chunk_rows=5)
    # nothing that was kept is asked again, and what was lost is at most the chunk that died
    assert len(asked(second)) == 30 - len(kept) and len(set(asked(first)) & set(asked(second))) == 17 - len(kept) <= 10
    out = E.attach_responses(docs, answers, req, "doc_id", out_col="answer").collect()
    assert len(out) == 90 and all(r.performed and r.answer.endswith(f"text {r.doc_id % 30}") for r in out)
    third = tempfile.mkdtemp(prefix="factloom-answers-")
    assert ask_stored(req, counting(third), store).count() == 30 and asked(third) == []


def test_failed_prompts_are_stored_and_asked_again(spark):
    store = tempfile.mkdtemp(prefix="factloom-answers-")
    _, req = requests(spark, 12, 2)
    ask_stored(req, lambda ps: ps.map(lambda p: None if p.endswith("3") else "1"), store, retries=2)
    rows = read_answers(spark, store).collect()
    assert sorted((r.ok, r.attempts) for r in rows) == [(False, 2)] + [(True, 1)] * 5
    ask_stored(req, lambda ps: ps.map(lambda p: "1"), store)
    assert read_answers(spark, store).filter("ok").count() == 6


def test_summaries_with_a_store_ask_once(spark):
    store, folder = tempfile.mkdtemp(prefix="factloom-answers-"), tempfile.mkdtemp(prefix="factloom-answers-")
    docs = spark.createDataFrame([(1, "a road"), (2, "a road"), (3, "a port"), (4, None)], "doc_id long, content string")
    for _ in range(2):
        out, _ = E.summaries(docs, counting(folder), "doc_id", store=store)
        got = {r.doc_id: r.performed for r in out.collect()}
    assert got == {1: True, 2: True, 3: True, 4: False} and len(asked(folder)) == 4


def test_latest_answer_of_two_requests_wins(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, content string")
    req = spark.createDataFrame([("a", "1"), ("b", "1")], "request_id string, doc_id string")
    t = datetime.datetime
    resp = spark.createDataFrame([("a", "zzz", True, t(2024, 1, 1)), ("b", "aaa", True, t(2024, 1, 2))],
                                 "request_id string, raw string, ok boolean, answered_at timestamp")
    assert E.attach_responses(docs, resp, req, "doc_id", out_col="answer").first()["answer"] == "aaa"
