"""Hand-made golden set through every stage: gate -> requests -> pure
responder (two stages) -> project facts -> daily merge into the master."""

import datetime
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from factloom.operators import enrich as E
from factloom.plans.composites import label_and_gate, project_facts
from factloom.plans.daily import MASTER_SCHEMA, daily_merge
from factloom.sources.sinks import read_master, write_master

D = datetime.date(2024, 5, 1)

ARTICLES = [
    (1, "The ministry will build a new hospital in Basra and a school in Mosul."),
    (2, "Weather was mild and markets were calm."),
    (3, "Work to build Al's bridge near Al-Hillah has begun."),
    (4, "Three projects: a road in Najaf, a dam at the Key district and a park."),
    (5, "A water plant will be built in البصرة soon."),
    (6, "They plan to build a tower in Atlantis."),
]

FIELDS = ["Location of project", "What is being built", "Who is funding the project",
          "Amount of money being spent", "Category of project that is being constructed",
          "Expected completion date", "Additional"]


def d(*values):
    parts = []
    for k, v in zip(FIELDS, values):
        if v is None:
            continue
        parts.append(f"'{k}': " + (f'"{v}"' if "'" in v else f"'{v}'"))
    return "{" + ", ".join(parts) + "}"


RESPONSES = {
    1: "[" + d("Basra", "new hospital", "Ministry", "$1.5 billion", "Commercial", "2025", "x") + ", "
       + d("Mosul", "school", "Ministry", "$20 million", "Residential", "2026", "y") + "]",
    3: "[" + d("Al-Hillah", "Al's bridge", "City", "$3 million", "Unknown", "2027", "z") + "]",
    4: "[" + d("Najaf", "road", "State", "$5 million", "Utility", "2025", "a") + ", "
       + d("Basra", "dam", None, "$7 million", "Industrial", "2028", "b") + ", "
       + d("Key district", "park", "Town", "n/a", "Landscaping", "2029", "c") + "]",
    5: "[" + d("البصرة", "water plant", "Fund", "$2 million", "water works", "2025", "d") + "]",
    6: "[" + d("Atlantis", "tower", "Private", "$9 million", "Commercial", "2030", "e") + "]",
}

GAZ = [  # loc_id, type, lat, lon, town_en, town_ar, admin3_en, admin3_ar, admin2_en, admin2_ar
    (1, "city", 30.5, 47.8, "Basra", "البصرة", None, None, None, None),
    (2, "city", 36.3, 43.1, "Mosul", None, None, None, None, None),
    (None, "city", 36.2, 44.0, "Erbil", None, None, None, None, None),
    (4, "city", 32.5, 44.4, "Al-Hillah", None, None, None, None, None),
    (5, "town", 31.0, 46.0, "Nasiriyah", None, None, None, None, None),
    (6, "district", 36.4, 43.2, "Nineveh", None, None, None, "Mosul", None),
    (7, "market", 33.3, 44.3, "Key", None, None, None, None, None),
    (8, "city", 32.0, 44.3, "Najaf", None, None, None, None, None),
]
GAZ_SCHEMA = ("loc_id bigint, loc_type string, lat double, lon double, town_en string, town_ar string, "
              "admin3_en string, admin3_ar string, admin2_en string, admin2_ar string")
TOPICS = [(1, "build OR built", "Build", "T"), (2, "projects", "Project", "T"), (3, "weather", "Other", "T")]
LABELS = [(1, "Commercial", "['Commercial Construction']", None),
          (2, "Residential", None, "['Residential Construction']"),
          (3, "Unknown", None, None),
          (4, "Utility", "Utility Construction", None),
          (5, "Industrial", "['Industrial Construction']", "['Utility Construction']")]


def test_golden_pipeline(spark):
    def responder(prompts: pd.Series) -> pd.Series:
        def answer(p):
            stage, text = p.split("\n", 1)
            if stage == "summaries":
                for doc_id, body in ARTICLES:
                    if body == text and doc_id in RESPONSES:
                        return f"1. [{doc_id}] projects"
                return "No project found."
            doc_id = int(text.split("[", 1)[1].split("]", 1)[0])
            return RESPONSES[doc_id]
        return prompts.map(answer)

    arts = spark.createDataFrame([(i, "news", f"https://n.example/{i}", f"T{i}", t, D) for i, t in ARTICLES],
                                 "doc_id long, source string, url string, title string, content string, published date")
    gaz = spark.createDataFrame(GAZ, GAZ_SCHEMA)
    topics = spark.createDataFrame(TOPICS, "ord int, keywords string, label string, topic_type string")
    gated = label_and_gate(arts, gaz, topics)
    assert sorted(r.doc_id for r in gated.collect()) == [1, 3, 4, 5, 6]      # article 2 has no topic word

    # stage 1: summaries; stage 2: fields, only for accepted summaries
    req1 = E.build_requests(gated, "doc_id", "content", "summaries", "{text}")
    r1 = E.run_responder(E.pending(req1, None), responder)
    ok1 = E.accepted(r1)
    assert ok1.count() == 5
    req2 = E.build_requests(ok1.select("doc_id", "raw"), "doc_id", "raw", "fields", "{text}")
    r2 = E.run_responder(E.pending(req2, None), responder)
    assert E.pending(req2, r2).count() == 0                                  # a second run asks nothing
    with_summaries = E.attach_responses(gated.select("doc_id", "source", "url", "title", "content", "published"),
                                        r2, req2, "doc_id")
    assert E.all_performed(with_summaries)

    labels = spark.createDataFrame(LABELS, "ord int, text string, label_0 string, label_1 string")
    facts = project_facts(with_summaries, gaz, labels)
    got = {(r.doc_id, r.ordinal): r for r in facts.collect()}
    assert sorted(got) == [(1, 0), (1, 1), (3, 0), (4, 0), (4, 1), (5, 0)]   # Key district, Atlantis dropped

    a = got[(1, 0)]
    assert (a.loc_id, a.matched_term, a.category_0, a.category_1, a.usd, a.sort_score) == \
        (1, "Basra", "Commercial Construction", None, 1.5e9, 6)
    assert a.location_match and a.what_built_match
    b = got[(1, 1)]
    assert (b.loc_id, b.matched_term, b.category_0, b.usd) == (6, "Mosul", "Residential Construction", 2e7)
    c = got[(3, 0)]
    assert (c.what_built, c.loc_id, c.matched_term, c.category_0, c.category_1) == \
        ("Al's bridge", 4, "Al Hillah", None, None)
    e = got[(4, 1)]
    assert (e.funder, e.loc_id, e.category_0, e.category_1, e.sort_score) == \
        (None, 1, "Industrial Construction", "Utility Construction", 5)
    f = got[(4, 0)]
    assert (f.loc_id, f.category_0) == (8, "Utility Construction")
    g = got[(5, 0)]
    assert (g.loc_id, g.matched_term, g.category_0) == (1, "البصرة", "Utility Construction")

    # daily merge over a master holding 3 rows, one with the same identity as a new row
    base = tempfile.mkdtemp(prefix="factloom-golden-")
    new_a = facts.filter((F.col("doc_id") == 1) & (F.col("ordinal") == 0)).first()
    old = [
        ("Old", D, "old text", "https://o/1", True, None, "Kirkuk", "bridge", None, None, None, None, None,
         35.5, 44.4, "Kirkuk", None, None, None, None, None, "9", "Kirkuk", "city", 3, 2023, None, None, 0.0, 11),
        ("Old2", D, "old text 2", "https://o/2", True, None, "Basra", "port", None, None, None, None, None,
         30.5, 47.8, "Basra", None, None, None, None, None, "1", "Basra", "city", 2, 2022, None, None, 0.0, 12),
        (new_a.title, new_a.published, new_a.content, new_a.url, new_a.performed, new_a.summaries,
         new_a.location, new_a.what_built, new_a.funder, new_a.amount_text, new_a.category_text,
         new_a.expected_completion, new_a.additional, 0.0, 0.0, None, None, None, None, None, None, "1",
         "Basra", "city", 1, 2024, None, None, 1.0, 13),
    ]
    write_master(spark.createDataFrame(old, MASTER_SCHEMA), base, "2024-04-30")
    daily_merge(facts, base, "2024-05-01")
    m = read_master(spark, base)
    assert m.count() == 6 + 2
    kept = m.filter(F.col("url") == new_a.url).filter(F.col("location") == "Basra").collect()
    assert len(kept) == 1 and kept[0].sort_score == 6 and kept[0].usd == 1.5e9   # the new row won
    # merging the same facts again changes nothing
    daily_merge(facts, base, "2024-05-02")
    assert read_master(spark, base).count() == 8


def test_usd_sources(spark):
    arts = spark.createDataFrame(
        [(1, "u", "T", "Build in Basra", D, "[{'Location of project': 'Basra', "
          "'Amount of money being spent': 'two billion Iraqi dinars'}]", "$1540000")],
        "doc_id long, url string, title string, content string, published date, summaries string, usd_reply string")
    gaz = spark.createDataFrame(GAZ, GAZ_SCHEMA)
    assert project_facts(arts, gaz).first().usd == 0.0                       # M1 cannot read words
    assert project_facts(arts, gaz, usd_from="spans").first().usd == 2e9 * 0.00077
    assert project_facts(arts, gaz, usd_from="usd_reply").first().usd == 1540000.0
