import os
import tempfile

import pytest
from pyspark.sql import functions as F

from factloom.operators.dictmatch import place_dictionary, topic_dictionary
from factloom.operators.report import with_counts
from factloom.sources.tables import read_gazetteer, read_label_report, read_master_csv, read_topics
from factloom.sources.sinks import write_csv_export


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_readers_map_original_names(spark):
    root = tempfile.mkdtemp(prefix="factloom-csv-")
    write(f"{root}/gaz.csv", "ID,Town EN,Town AR,Admin 3 EN,Admin 3 AR,Admin 2 EN,Admin 2 AR,Location Type,Lat,Lon\n"
                             "IQ1,Basra,البصرة,,,,,city,30.5,47.8\n,Ghost,,,,,,town,,\n")
    write(f"{root}/topics.csv", "ARABIC String,English,Type\nمشروع OR project,Project,A\n")
    write(f"{root}/labels.csv", "text,label_0,label_1\nCommercial,['Commercial Construction'],\n")
    g = read_gazetteer(spark, f"{root}/gaz.csv")
    assert {r.term for r in place_dictionary(g).collect()} == {"Basra", "البصرة"}
    assert g.filter(F.col("loc_id") == "IQ1").first().lat == 30.5
    t = topic_dictionary(read_topics(spark, f"{root}/topics.csv"))
    assert sorted(r.term for r in t.collect()) == ["project", "مشروع"]
    assert read_label_report(spark, f"{root}/labels.csv").first().label_0 == "['Commercial Construction']"


def test_csv_readers_go_by_header_and_read_doubled_quotes(spark):
    root = tempfile.mkdtemp(prefix="factloom-csv2-")
    write(f"{root}/gaz.csv", 'Lat,Town EN,Extra,ID\n30.5,"Al ""Basra"", old",x,IQ1\nbad,"two\nlines",y,IQ2\n')
    rows = {r.loc_id: r for r in read_gazetteer(spark, f"{root}/gaz.csv").collect()}
    assert (rows["IQ1"].town_en, rows["IQ1"].lat, rows["IQ1"].town_ar) == ('Al "Basra", old', 30.5, None)
    assert (rows["IQ2"].town_en, rows["IQ2"].lat) == ("two\nlines", None)
    write(f"{root}/t/a.csv", "ARABIC String,English,row\nx,Second,2\n") if os.makedirs(f"{root}/t") is None else None
    write(f"{root}/t/b.csv", "ARABIC String,English,row\nx,First,1\n")
    with pytest.raises(ValueError, match="order column"):
        read_topics(spark, f"{root}/t")
    assert {r.label: r.ord for r in read_topics(spark, f"{root}/t", order_col="row").collect()} == {"Second": 2, "First": 1}


def test_master_csv_round_trip(spark):
    root = tempfile.mkdtemp(prefix="factloom-mcsv-")
    df = spark.createDataFrame([("T", True, None, 2.5, 4, 1.5e9)],
                               "title string, performed boolean, lat double, lon double, sort_score int, usd double")
    write_csv_export(df, f"{root}/out")
    back = read_master_csv(spark, f"{root}/out").first()
    assert (back.title, back.performed, back.lat, back.lon, back.sort_score, back.usd) == ("T", True, None, 2.5, 4, 1.5e9)


def test_observed_counts(spark):
    df = spark.range(10).select((F.col("id") % 2 == 0).alias("even"))
    out, obs = with_counts(df, "stage1", ["even"])
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "even_true": 5}


def test_snapshot_stage_and_file_news_reader(spark):
    import json
    from factloom.sources.feeds import read_news
    from factloom.sources.sinks import snapshot_stage
    root = tempfile.mkdtemp(prefix="factloom-s8-")
    df = spark.range(3).withColumnRenamed("id", "k")
    assert snapshot_stage(df, None, "x") is df
    back = snapshot_stage(df, f"{root}/stages", "step1")
    assert sorted(r.k for r in back.collect()) == [0, 1, 2]
    lines = [json.dumps({"articles": [{"url": "u1", "title": "A", "seendate": "20240105T101500Z"}]}),
             json.dumps({"results": []}), "not json"]
    with open(f"{root}/news.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    arts = read_news(spark, f"{root}/news.json").collect()
    assert [(a.url, a.title, str(a.published)) for a in arts] == [("u1", "A", "2024-01-05")]


def test_cluster_conf():
    from factloom.session import cluster_conf
    c = cluster_conf(3000)
    assert c["spark.sql.shuffle.partitions"] == "9000" and c["spark.sql.adaptive.enabled"] == "true"
    assert c["spark.sql.parquet.columnarReaderBatchSize"] == "256"
    assert "spark.sql.parquet.columnarReaderBatchSize" not in cluster_conf(10, text_heavy=False)


def test_small_public_helpers(spark):
    from factloom.operators import dictmatch as dm
    from factloom.operators.joins import lookup_join, size_of
    from factloom.operators.merge import distinct_rows, union_sources
    from factloom.sources.pages import read_pages
    hits = spark.createDataFrame([(1, "place", "7", "Basra", 0, 1), (1, "place", "8", "Kut", 2, 3),
                                  (1, "place", "8", "Al Kut", 5, 7), (1, "topic", "Build", "build", 9, 10)],
                                 "doc_id long, dict string, key string, term string, start int, end int")
    w = dm.summarize(dm.per_term(hits)).first()
    assert (w.matched_key, w.matched_term, w.matched_hits, w.topic_terms) == ("8", "Kut", 2, "Build")
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert distinct_rows(df).count() == 2
    u = union_sources(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("y",)], "b string"))
    assert sorted(u.columns) == ["a", "b"] and u.count() == 2
    dim = spark.createDataFrame([(1, "one")], "a int, name string")
    assert lookup_join(df, dim, "a").filter("name = 'one'").count() == 2
    n, size = size_of(spark.range(100))
    assert n == 100 and size > 100
    root = tempfile.mkdtemp(prefix="factloom-pages-")
    spark.createDataFrame([("u", "<p>x</p>", 1)], "url string, html string, extra int").write.parquet(f"{root}/p")
    assert read_pages(spark, f"{root}/p").columns == ["url", "html"]
