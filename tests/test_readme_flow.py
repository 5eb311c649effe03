"""The daily run shown in the README, on small local files."""

import json
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from factloom.operators import enrich as E
from factloom.plans.composites import label_and_gate, news_articles, project_facts
from factloom.plans.daily import daily_merge
from factloom.sources import feeds, tables
from factloom.sources.sinks import read_master


def test_readme_daily_run(spark):
    root = tempfile.mkdtemp(prefix="factloom-readme-")
    with open(f"{root}/places.csv", "w", encoding="utf-8") as f:
        f.write("ID,Town EN,Town AR,Admin 3 EN,Admin 3 AR,Admin 2 EN,Admin 2 AR,Location Type,Lat,Lon\n"
                "1,Basra,,,,,,city,30.5,47.8\n2,Mosul,,,,,,city,36.3,43.1\n")
    with open(f"{root}/topics.csv", "w", encoding="utf-8") as f:
        f.write("ARABIC String,English,Type\nbuild OR built,Build,A\n")
    with open(f"{root}/labels.csv", "w", encoding="utf-8") as f:
        f.write("text,label_0,label_1\nCommercial,['Commercial Construction'],\n")
    item = {"url": "https://n.example/1", "title": "Port", "seendate": "20240501T080000Z",
            "content": "They will build a port in Basra."}
    spark.createDataFrame([("q", "2024-05-01", json.dumps({"articles": [item]}))],
                          "query string, win_start string, response string").write.parquet(f"{root}/responses")
    with open(f"{root}/social.json", "w", encoding="utf-8") as f:
        f.write(json.dumps({"data": [{"content": "A school was built in Mosul.", "date": "2024-05-01T09:00:00",
                                      "title": "School", "url": "https://s.example/1"}]}) + "\n")
    spark.createDataFrame([("https://n.example/1", "<article><p>They will build a port in Basra.</p></article>")],
                          "url string, html string").write.parquet(f"{root}/pages")

    gaz = tables.read_gazetteer(spark, f"{root}/places.csv")
    topics = tables.read_topics(spark, f"{root}/topics.csv")
    labels = tables.read_label_report(spark, f"{root}/labels.csv")
    pages = spark.read.parquet(f"{root}/pages")
    raw = spark.read.parquet(f"{root}/responses")
    articles = feeds.union_articles(news_articles(raw, pages), feeds.read_mentions(spark, f"{root}/social.json"))
    gated = label_and_gate(articles, gaz, topics)
    assert gated.count() == 2

    def my_model(prompts: pd.Series) -> pd.Series:
        def answer(p):
            stage, body = p.split("\n", 1)
            town = "Basra" if "Basra" in body else "Mosul"
            if stage == "summaries":
                return f"1. a project in {town}"
            return "[{'Location of project': '" + town + "', 'What is being built': 'port', " \
                   "'Category of project that is being constructed': 'Commercial', " \
                   "'Amount of money being spent': '$2 million'}]"
        return prompts.map(answer)

    old = spark.createDataFrame([], E.RESPONSE_SCHEMA)
    r1 = E.run_responder(E.pending(E.build_requests(gated, "doc_id", "content", "summaries", E.SUMMARY_TEMPLATE),
                                   old), my_model)
    asked = E.build_requests(E.accepted(r1), "doc_id", "raw", "fields", E.FIELDS_TEMPLATE)
    r2 = E.run_responder(E.pending(asked, old), my_model)
    r1.unionByName(r2).write.mode("append").parquet(f"{root}/answers")
    facts = project_facts(E.attach_responses(gated, old.unionByName(r2), asked, "doc_id"), gaz, labels)
    got = sorted((r.location, r.loc_id, r.category_0, r.usd) for r in facts.collect())
    assert got == [("Basra", "1", "Commercial Construction", 2e6), ("Mosul", "2", "Commercial Construction", 2e6)]
    daily_merge(facts, f"{root}/master", "2024-05-01", csv_path=f"{root}/export")
    assert read_master(spark, f"{root}/master").count() == 2
    assert spark.read.option("header", "true").csv(f"{root}/export").filter(F.col("Town EN") == "Basra").count() == 1
