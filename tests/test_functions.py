import pytest
from pyspark.sql import functions as F

from factloom.functions import dates as D
from factloom.functions import evidence as ev
from factloom.functions import extract as X
from factloom.functions import html as H
from factloom.functions import labels as L
from factloom.functions import money as M
from factloom.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value,want", [
    ("Héllo, Wörld! 42_x", "héllo wörld 42_x"), ("a-b\tc", "ab\tc"), (None, None)])
def test_normalize(spark, value, want):
    assert one(spark, T.normalize, value) == want


@pytest.mark.parametrize("value,want", [
    ("['Utility Construction']", "Utility Construction"), ("Plain", "Plain"), ("x 'a' 'b'", "a")])
def test_clean_label(spark, value, want):
    assert one(spark, T.clean_label, value) == want


def test_trim_to_words(spark):
    assert one(spark, lambda c: T.trim_to_words(c, 3), " a  b c d ") == "a b c"
    assert one(spark, lambda c: T.trim_to_words(c, 3), "a  b c") == "a  b c"


@pytest.mark.parametrize("value,want", [
    ("$1.5 billion", 1.5e9), ("$2,500 million", 2.5e9), ('"$300"', 300.0), ("3 trillion", 3e12),
    ("about 5 Billion", None), ("n/a", None), (None, None)])
def test_amount_to_usd(spark, value, want):
    assert one(spark, M.amount_to_usd, value) == want


AMOUNTS = [
    ("5% of 2 million dollars", 100000.0),
    ("two billion Iraqi dinars", 2e9 * 0.00077),
    ("1,500,000 GBP", 1.5e6 * 1.25),
    ("he said 5", 5.0),
    ("EUR 3M and USD 1M", 3e6 * 1.07),
    ("no numbers", None), (None, None), ("", None),
    ("ten million USD", 1e7),
    ("1.125 million USD", 1.125e6),
    ("7.5% of 2,000 million and 3 k EUR", 1.5e8 * 1.07),
    ("GBP 5 then 6 ID", 6.25),
    ("v2.5 x3 in 2024 for 10 dinars", 2024 * 0.00077),
    ("٥ million USD", 5e6),
]


def test_usd_from_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(AMOUNTS)], "i int, t string")
    got = {x.i: x.u for x in df.select("i", M.usd_from_text(F.col("t")).alias("u")).collect()}
    assert [got[i] for i in range(len(AMOUNTS))] == [want if want is None else pytest.approx(want) for _, want in AMOUNTS]


def test_money_spans_have_positions(spark):
    got = one(spark, M.money_spans, "paid 5% of 2 million USD, two billion dinars")
    assert [(s["pos"], s["amount"], s["code"]) for s in got] == [
        (5, 100000.0, None), (21, None, "USD"), (26, 2e9, None), (38, None, "IQD")]


@pytest.mark.parametrize("value,want", [
    ("3/7/24", "2024-03-07"), ("12/31/99", "1999-12-31"), ("2024-02-01 10:00:00", "2024-02-01"),
    ("2024-02-01T10:00:00+00:00", "2024-02-01"), ("13/45/24", None), ("junk", None)])
def test_format_day(spark, value, want):
    assert one(spark, D.format_day, value) == want


def test_iso_offset(spark):
    v = "2024-03-01T10:00:00+03:00"
    assert str(one(spark, D.iso_offset_wall_time, v)) == "2024-03-01 10:00:00"
    assert str(one(spark, D.iso_offset_instant, v)) == "2024-03-01 07:00:00"
    assert str(one(spark, D.seendate_to_date, "20240105T101500Z")) == "2024-01-05"


@pytest.mark.parametrize("value,want", [
    ("Commercial and residential towers", "Residential Construction"),
    ("Solar farm", "Utility Construction"), ("heavy civil works", "Infrastructure and Heavy Civil Construction"),
    ("MULTI-sectoral", "Multi-Sectoral"), ("nothing", None), (None, None)])
def test_category_rules_in_order(spark, value, want):
    assert one(spark, L.category_by_rules, value) == want


def test_completeness_score(spark):
    df = spark.createDataFrame([(" N/A ", "bridge", None, "unclear", "Not specified in the text", "2025")],
                               "a string, b string, c string, d string, e string, f string")
    assert df.select(L.completeness_score("a", "b", "c", "d", "e", "f")).first()[0] == 2


def test_field_values_and_apostrophes(spark):
    s = "[{'Location of project': 'Basra', 'What is being built': \"Al's bridge\"}, {'location': 'Erbil'}]"
    assert one(spark, lambda c: X.field_values(c, ["Location of project", "Location"]), s) == ["Basra", "Erbil"]
    assert one(spark, lambda c: X.field_values(c, ["What is being built"]), s) == []
    projects = one(spark, X.parse_projects, s)
    assert projects[0]["what_built"] == "Al's bridge" and projects[0]["location"] == "Basra"
    assert projects[1]["location"] is None  # key names are exact in the parsed route


def test_parse_projects_none_and_fallback(spark):
    p = one(spark, X.parse_projects, "{'Location': 'Mosul', 'Additional': None, 'Expected completion date': 2026}")
    assert p[0]["location"] == "Mosul" and p[0]["additional"] is None and p[0]["expected_completion"] == "2026"
    text = "Project: School\nLocation of project - Najaf\nLocation of project - Karbala\nWhat is being built - x: school"
    p = one(spark, X.parse_projects, text)
    assert p[0]["location"] == "Karbala" and p[0]["what_built"] == "school"


def test_paragraphs_unclosed_and_script(spark):
    html = '<script>var t="</p>";</script><p><b>Title<br><p>One &amp; two</p><div><p>Three</div><p>Four'
    assert one(spark, H.paragraphs_text, html) == "Title One & two Three Four"


@pytest.mark.parametrize("base,rel,want", [
    ("http://h.example/a/b?x=1#f", "/p", "http://h.example/p"),
    ("http://h.example/a/b?x=1#f", "c", "http://h.example/a/c"),
    ("http://h.example/a/b", "../c/./d", "http://h.example/c/d"),
    ("http://h.example/a/b?x=1#f", "?y=2", "http://h.example/a/b?y=2"),
    ("http://h.example/a/b?x=1#f", "#g", "http://h.example/a/b?x=1#g"),
    ("https://h.example/a", "//cdn.example/z", "https://cdn.example/z"),
    ("https://h.example/a", "http://o.example/", "http://o.example/")])
def test_absolute_url(spark, base, rel, want):
    df = spark.createDataFrame([(base, rel)], "b string, r string")
    assert df.select(H.absolute_url(F.col("b"), F.col("r"))).first()[0] == want


def test_element_text(spark):
    html = '<div><section class="post entry big"><p>Body <a href="/r">x</a></p></section></div>'
    assert one(spark, lambda c: H.element_text(c, "section", "entry"), html) == "Body x"
    assert one(spark, lambda c: H.element_text(c, "section", "other"), html) is None


def test_evidence(spark):
    text = "New bridge in Basra, Iraqi officials said; the school NEAR the river"
    df = spark.createDataFrame([(text, "Basra, the Iraq", "new bridge"), (text, "Mosul, Basra", "dam NEAR/3 river"),
                                (text, None, None)], "t string, loc string, what string")
    r = df.select(ev.location_evidence(F.col("t"), F.col("loc")).alias("l"),
                  ev.location_evidence(F.col("t"), F.col("loc"), compat=True).alias("c"),
                  ev.object_evidence(F.col("t"), F.col("what")).alias("o")).collect()
    # words: Basra, the, Iraq ("Iraq" matches "Iraqi" as a prefix)
    assert (r[0].l.found, r[0].l.n_terms, r[0].l.match) == (3, 3, True)
    # compat: the literal "Iraq.*" is searched and the ratio uses the 2 comma parts
    assert (r[0].c.found, r[0].c.n_terms) == (2, 2)
    assert r[0].o.match and r[1].o.match is False and r[1].l.ratio == 0.5
    assert r[2].l.match is False and r[2].o.match is False


def test_near_pattern(spark):
    df = spark.createDataFrame([("build the new school now", "build NEAR/2 school"),
                                ("build a b c d school", "build NEAR/2 school")], "t string, s string")
    got = [r[0] for r in df.select(F.regexp_like(F.col("t"), ev.near_regex(F.col("s")))).collect()]
    assert got == [True, False]


def test_zip_and_dict_routes_agree_when_all_fields_are_filled(spark):
    from factloom.operators.nested import explode_projects, extract_fields, zip_explode
    fields = ["location", "what_built", "funder", "amount_text", "category_text", "expected_completion", "additional"]
    keys = ["Location of project", "What is being built", "Who is funding the project", "Amount of money being spent",
            "Category of project that is being constructed", "Expected completion date", "Additional"]
    resp = "[" + ", ".join("{" + ", ".join(f"'{k}': '{k[:3]}{i}'" for k in keys) + "}" for i in range(3)) + "]"
    df = spark.createDataFrame([(1, resp), (2, None)], "id int, s string")
    a = zip_explode(extract_fields(df, "s"), fields, ["id"]).collect()
    b = explode_projects(df, "s", ["id"]).collect()
    assert sorted(tuple(r) for r in a) == sorted(tuple(r) for r in b) and len(a) == 3


def test_date_keys_and_start(spark):
    df = spark.createDataFrame([("2024-03-07",)], "v string").select(D.parse_start(F.col("v")).alias("t"))
    row = df.select(D.format_key(F.col("t"), "yyyyMMddHHmmss").alias("a"), D.format_key(F.col("t"), "MMddyy").alias("b"),
                    D.parse_start(F.lit("not a date")).alias("c")).first()
    assert (row.a, row.b, row.c) == ("20240307000000", "030724", None)


def test_grid_with_fixed_queries(spark):
    from factloom.operators.grids import fixed_queries, query_grid
    terms = spark.createDataFrame([("dam",), ("dam",), ("road",)], "term string")
    g = query_grid(terms, F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date"), 2, fixed_queries(spark))
    assert g.count() == (2 * 4 + 32) * 2
    assert g.filter(F.col("query") == "dam NEAR Iraq").count() == 2


def test_nested_blocks(spark):
    s = "x {'a': {'b': 'c'}} y {'d': 'e'}"
    assert one(spark, X.dict_blocks, s) == ["{'b': 'c'}", "{'a': {'b': 'c'}}", "{'d': 'e'}"]
    assert one(spark, X.dict_blocks, "} {a {b} c} { {d {e} f}") == ["{b}", "{a {b} c}", "{e}", "{d {e} f}"]
    assert one(spark, X.dict_blocks, "none") == [] and one(spark, X.dict_blocks, None) == []


def test_projects_with_nested_dicts_and_escapes(spark):
    text = "{'Location of project': 'Basra\\xa0city', 'Additional': {'note': 'x'}, 'What is being built': None}"
    got = one(spark, X.parse_projects, text)
    assert [(p["location"], p["what_built"]) for p in got] == [("Basra\xa0city", None)]
    got = one(spark, X.parse_projects, "{'Location of project': 'said: None, then', 'What is being built': 'a \\'b\\''}")
    assert [(p["location"], p["what_built"]) for p in got] == [("said: None, then", "a 'b'")]


def test_near_by_position_agrees_with_the_pattern(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for _ in range(300):
        text = " ".join(rnd.choice(["a", "b", "c", "d", "E,", "f"]) for _ in range(rnd.randint(0, 14)))
        terms = [rnd.choice(["a", "B", "c", "e"]) for _ in range(rnd.randint(2, 4))]
        rows.append((text, terms[0] + "".join(f" NEAR/{rnd.choice(['', '0 ', '1 ', '3 '])}{t}" for t in terms[1:])))
    rows += [(None, "a NEAR/1 b"), ("a b", None), ("a b", "a-x NEAR/1 b"), ("a b", "a b"), ("a b", "a NEAR/b c")]
    df = spark.createDataFrame(rows, "t string, s string")
    got = df.select(F.coalesce(F.regexp_like("t", ev.near_regex(F.col("s"))), F.lit(False)).alias("want"), ev.near_evidence(F.col("t"), F.col("s")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got] and 20 < sum(r.got for r in got) < 250


def test_near_of_repeated_words_is_linear(spark):
    import time
    df = spark.createDataFrame([("a b " * 20_000 + "c",)], "t string")
    t0 = time.perf_counter()
    spec = F.lit("a NEAR/9 b NEAR/9 a NEAR/9 b NEAR/9 a NEAR/0 c")
    assert df.select(ev.near_evidence(F.col("t"), spec)).first()[0] is False and time.perf_counter() - t0 < 20


def test_nearest_currency_among_many(spark):
    import random
    rnd = random.Random(5)
    rates = {"USD": 1.0, "EUR": 1.07, "GBP": 1.25}
    rows = []
    for _ in range(200):
        parts = [rnd.choice(["USD", "EUR", "GBP", str(rnd.randint(1, 10 ** rnd.randint(1, 6))), "word", "of"]) for _ in range(rnd.randint(0, 12))]
        at, amounts, mentions = 0, [], []
        for x in parts:
            if x.isdigit():
                amounts.append((at, float(x)))
            elif x in rates:
                mentions.append((at, x))
            at += len(x) + 1
        usd = [v * rates[min(mentions, key=lambda m: (abs(m[0] - p), m[0]))[1]] if mentions else v for p, v in amounts]
        rows.append((" ".join(parts), usd))
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(M.amounts_in_usd(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [pytest.approx(u) for _, u in rows]


LITERALS = [
    ("[{'Location of project': 'a } b', 'Additional': 'x'}]", [("a } b", "x")]),
    ("Here's it: {'Location of project': 'a {', 'Additional': \"it's } {\"} and {'Location of project': 'It's'}, {'Location of project': 'c'}",
     [("a {", "it's } {"), ("c", None)]),
    ("{'Location of project': ['A', 'B', 3], 'Additional': ('x',)}", [("A, B, 3", "x")]),
    ("{'Location of project': 'A' \"B\" 'C', 'Additional': []}", [("ABC", "")]),
    ("{'Location of project': 'A', 'Additional': {'n': {'m': 'q'}, 'k': [1, None]}}", [("A", '{"n":{"m":"q"},"k":[1,null]}')]),
    ("{'x': {'Location of project': 'in', 'Additional': 'y'}, 'Location of project': 'out'}", [("in", "y"), ("out", None)]),
    ("{'Location of project': '[TBD]', 'Additional': \"say \\\"hi\\\" 'now'\"}", [("[TBD]", "say \"hi\" 'now'")]),
    ("{{'Location of project': 'A'}", [("A", None)]),
    ("{'Location of project': 'caf\\xe9 None', 'Additional': True,}", [("café None", "true")]),
    ("{'Location of project': '" + "z" * 50_000 + "', 'Additional': 'a\\\\'}", [("z" * 50_000, "a\\")]),
]


def test_literal_values(spark):
    from factloom.functions.extract import parsed_dicts
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(LITERALS)], "i int, r string")
    got = {x.i: [(p["location"], p["additional"]) for p in x.p] for x in df.select("i", parsed_dicts(F.col("r")).alias("p")).collect()}
    assert [got[i] for i in range(len(LITERALS))] == [want for _, want in LITERALS]
