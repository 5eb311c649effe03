"""Registered queries: text, dates, money, labels, score, evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import evidence as ev
from ..functions.constants import CATEGORY_RULES, FILLER_WORDS, MAX_REQUEST_WORDS, STOP_WORDS
from ..functions.labels import completeness_score
from ..functions.money import amount_to_usd, usd_or_zero
from ..functions.text import normalize, term_present, tokens, word_count
from ..operators.enrich import request_text
from ..operators.labels import label_map, match_labels
from . import fixtures as fx
from .registry import NOT_WORD_OR_SPACE_SQL, WS_SQL, register, sql_ustrip, table


def _sql_norm(expr: str) -> str:
    return f"lower(regexp_replace({expr}, '{NOT_WORD_OR_SPACE_SQL}', '', 'g'))"


# ------------------------------------------------------------------ T1
@register("normalize_text", f"""
SELECT doc_id, md5({_sql_norm('text')}) AS norm_md5, CAST(length({_sql_norm('text')}) AS BIGINT) AS norm_len
FROM documents""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = normalize(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(n).alias("norm_md5"), F.length(n).cast("bigint").alias("norm_len"))


# ------------------------------------------------------------------ T2
@register("term_presence", f"""
WITH nb AS (SELECT count(*) AS n FROM benchmark)
SELECT d.doc_id, b.item_id,
       coalesce(contains({_sql_norm('d.text')}, {_sql_norm('b.text')}), false) AS bench_present,
       coalesce(contains({_sql_norm('d.text')}, {_sql_norm("split_part(d.text, '.', 1)")}), false) AS lead_present
FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT n FROM nb)""")
def term_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bench = table(spark, sf_dir, "benchmark")
    nb = bench.count()
    d = docs.withColumn("item_id", F.col("doc_id") % F.lit(nb))
    j = d.join(bench.withColumnRenamed("text", "btext"), "item_id")
    norm = normalize(F.col("text"))
    return j.select("doc_id", "item_id",
                    term_present(F.col("btext"), norm).alias("bench_present"),
                    term_present(F.split_part(F.col("text"), F.lit("."), F.lit(1)), norm).alias("lead_present"))


# ------------------------------------------------------------------ D1-D7
_SPOIL11 = "o_orderkey % 11 = 0"


@register("date_forms", f"""
SELECT o_orderkey,
  CAST(CAST(try_strptime(CASE WHEN {_SPOIL11} THEN strftime(o_orderdate, '%Y%m%dT%H%M%SZ') || 'x'
                              ELSE strftime(o_orderdate, '%Y%m%dT%H%M%SZ') END, '%Y%m%dT%H%M%SZ') AS DATE) AS VARCHAR) AS seen_day,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS wall_time,
  strftime(CASE o_orderkey % 3 WHEN 0 THEN o_orderdate - INTERVAL 3 HOUR
                               WHEN 1 THEN o_orderdate + INTERVAL 5 HOUR ELSE o_orderdate END,
           '%Y-%m-%d %H:%M:%S') AS utc_time,
  CASE WHEN {_SPOIL11} THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS mdy_day,
  strftime(o_orderdate, '%Y-%m-%d') AS iso_day,
  CAST(year(o_orderdate) AS INTEGER) AS year,
  strftime(o_orderdate, '%m%d%y') AS day_key
FROM orders""")
def date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    spoil = (F.col("o_orderkey") % 11) == 0
    seen = F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'")
    seen = F.when(spoil, F.concat(seen, F.lit("x"))).otherwise(seen)
    offset = (F.when(F.col("o_orderkey") % 3 == 0, F.lit("+03:00"))
              .when(F.col("o_orderkey") % 3 == 1, F.lit("-05:00")).otherwise(F.lit("Z")))
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), offset)
    mdy = F.when(spoil, F.lit("garbage")).otherwise(F.date_format("o_orderdate", "M/d/yy"))
    return o.select(
        "o_orderkey",
        D.seendate_to_date(seen).cast("string").alias("seen_day"),
        F.date_format(D.iso_offset_wall_time(iso), "yyyy-MM-dd HH:mm:ss").alias("wall_time"),
        F.date_format(D.iso_offset_instant(iso), "yyyy-MM-dd HH:mm:ss").alias("utc_time"),
        D.format_day(mdy).alias("mdy_day"),
        D.format_day(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("iso_day"),
        D.year_of(D.lenient_timestamp(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
                                               F.lit("+00:00")))).alias("year"),
        D.format_key(F.col("o_orderdate"), "MMddyy").alias("day_key"))


# ------------------------------------------------------------------ M1
_AMOUNT_SQL = """CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE
  '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) ||
  CASE o_orderkey % 4 WHEN 0 THEN ' million' WHEN 1 THEN ' billion' WHEN 2 THEN '' ELSE ' trillion' END END"""


@register("usd_amounts", f"""
WITH a AS (SELECT o_orderkey, {_AMOUNT_SQL} AS amount_text FROM orders),
b AS (SELECT o_orderkey, amount_text, replace(replace(replace(amount_text, '$', ''), ',', ''), '"', '') AS v FROM a)
SELECT o_orderkey, amount_text,
  TRY_CAST({sql_ustrip("CASE WHEN contains(v, 'billion') THEN replace(v, 'billion', '') WHEN contains(v, 'million') THEN replace(v, 'million', '') WHEN contains(v, 'trillion') THEN replace(v, 'trillion', '') ELSE v END")} AS DOUBLE)
  * CASE WHEN contains(v, 'billion') THEN 1e9 WHEN contains(v, 'million') THEN 1e6 WHEN contains(v, 'trillion') THEN 1e12 ELSE 1.0 END AS usd,
  coalesce(TRY_CAST({sql_ustrip("CASE WHEN contains(v, 'billion') THEN replace(v, 'billion', '') WHEN contains(v, 'million') THEN replace(v, 'million', '') WHEN contains(v, 'trillion') THEN replace(v, 'trillion', '') ELSE v END")} AS DOUBLE)
  * CASE WHEN contains(v, 'billion') THEN 1e9 WHEN contains(v, 'million') THEN 1e6 WHEN contains(v, 'trillion') THEN 1e12 ELSE 1.0 END, 0.0) AS usd_export
FROM b""")
def usd_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    suffix = (F.when(F.col("o_orderkey") % 4 == 0, F.lit(" million"))
              .when(F.col("o_orderkey") % 4 == 1, F.lit(" billion"))
              .when(F.col("o_orderkey") % 4 == 2, F.lit("")).otherwise(F.lit(" trillion")))
    text = F.when(F.col("o_orderkey") % 13 == 0, F.lit("n/a")).otherwise(
        F.concat(F.lit("$"), F.floor("o_totalprice").cast("bigint").cast("string"), suffix))
    a = o.select("o_orderkey", text.alias("amount_text"))
    return a.select("o_orderkey", "amount_text", amount_to_usd(F.col("amount_text")).alias("usd"),
                    usd_or_zero(F.col("amount_text")).alias("usd_export"))


# ------------------------------------------------------------------ T11
_SCORE_FIELDS_SQL = {
    "location": "CASE c_custkey % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN ' Unknown ' ELSE c_name END",
    "what_built": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Not specified in the text' ELSE c_mktsegment END",
    "funder": "CASE c_custkey % 3 WHEN 0 THEN 'nan' ELSE 'Ministry ' || CAST(c_nationkey AS VARCHAR) END",
    "amount_text": "CASE c_custkey % 4 WHEN 0 THEN 'NONE' ELSE '$' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END",
    "category_text": "CASE WHEN c_custkey % 6 = 0 THEN 'unclear' ELSE c_mktsegment END",
    "expected_completion": "CASE c_custkey % 2 WHEN 0 THEN '2025' ELSE 'The article does not specify' END",
}
_FILLERS_SQL = ", ".join("'" + w.lower().strip().replace("'", "''") + "'" for w in FILLER_WORDS)


def _sql_given(col: str) -> str:
    return f"CASE WHEN {col} IS NOT NULL AND lower({sql_ustrip(col)}) NOT IN ({_FILLERS_SQL}) THEN 1 ELSE 0 END"


@register("completeness_score", f"""
WITH f AS (SELECT c_custkey, {", ".join(f"{v} AS {k}" for k, v in _SCORE_FIELDS_SQL.items())} FROM customer)
SELECT c_custkey, CAST({" + ".join(_sql_given(k) for k in _SCORE_FIELDS_SQL)} AS INTEGER) AS sort_score FROM f""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    f = c.select(
        "c_custkey",
        F.when(k % 7 == 0, "n/a").when(k % 7 == 1, " Unknown ").otherwise(F.col("c_name")).alias("location"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, "Not specified in the text")
        .otherwise(F.col("c_mktsegment")).alias("what_built"),
        F.when(k % 3 == 0, "nan").otherwise(F.concat(F.lit("Ministry "), F.col("c_nationkey").cast("string"))).alias("funder"),
        F.when(k % 4 == 0, "NONE").otherwise(F.concat(F.lit("$"), F.floor("c_acctbal").cast("bigint").cast("string"))).alias("amount_text"),
        F.when(k % 6 == 0, "unclear").otherwise(F.col("c_mktsegment")).alias("category_text"),
        F.when(k % 2 == 0, "2025").otherwise("The article does not specify").alias("expected_completion"))
    return f.select("c_custkey", completeness_score(*_SCORE_FIELDS_SQL.keys()).alias("sort_score"))


# ------------------------------------------------------------------ T9, T10, J4, J5
LABEL_ROWS = [
    (1, "STANDARD", "['Residential Construction']", None),
    (2, "PROMO", None, "['Commercial Construction']"),
    (3, "LARGE", "Industrial Construction", "['Utility Construction']"),
    (4, "SMALL", None, None),
    (5, "STANDARD", "['Specialized Construction']", "x 'Landscape Construction' y"),
]
_CATEGORY_TEXT_SQL = """CASE p_partkey % 8
  WHEN 0 THEN p_type WHEN 1 THEN p_name || ' water plant' WHEN 2 THEN 'Heavy civil ' || p_name
  WHEN 3 THEN p_name || ' crop silo' WHEN 4 THEN 'n/a' WHEN 5 THEN 'Multi-sectoral ' || p_name
  WHEN 6 THEN 'Commercial and residential ' || p_name ELSE NULL END"""


def _sql_clean(col: str) -> str:
    return f"CASE WHEN contains({col}, '''') THEN split_part({col}, '''', 2) ELSE {col} END"


def _sql_rules(col: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({col}, '(?i){p}') THEN '{label}'" for p, label in CATEGORY_RULES)
    return f"CASE {whens} END"


@register("category_labels", f"""
WITH lm AS (
  SELECT text AS map_text, {_sql_clean('label_0')} AS l0, {_sql_clean('label_1')} AS l1 FROM (
    SELECT *, row_number() OVER (PARTITION BY text ORDER BY ord DESC) AS rn
    FROM {fx.values_sql(LABEL_ROWS, fx.LABEL_SCHEMA)} WHERE text IS NOT NULL) WHERE rn = 1),
p AS (SELECT p_partkey, {_CATEGORY_TEXT_SQL} AS category_text FROM part)
SELECT p.p_partkey, p.category_text,
  CASE WHEN lm.map_text IS NOT NULL THEN coalesce(lm.l0, lm.l1) ELSE {_sql_rules('p.category_text')} END AS category_0,
  CASE WHEN lm.map_text IS NOT NULL AND lm.l0 IS NOT NULL THEN lm.l1 END AS category_1
FROM p LEFT JOIN lm ON p.category_text = lm.map_text""")
def category_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 8
    name = F.col("p_name")
    text = (F.when(k == 0, F.col("p_type")).when(k == 1, F.concat(name, F.lit(" water plant")))
            .when(k == 2, F.concat(F.lit("Heavy civil "), name)).when(k == 3, F.concat(name, F.lit(" crop silo")))
            .when(k == 4, F.lit("n/a")).when(k == 5, F.concat(F.lit("Multi-sectoral "), name))
            .when(k == 6, F.concat(F.lit("Commercial and residential "), name)))
    rows = p.select("p_partkey", text.alias("category_text"))
    mapping = label_map(fx.frame(spark, LABEL_ROWS, fx.LABEL_SCHEMA))
    return match_labels(rows, mapping).select("p_partkey", "category_text", "category_0", "category_1")


# ------------------------------------------------------------------ T12, T13
@register("request_texts", f"""
WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array({sql_ustrip('text')}, '{WS_SQL}+'), lambda x: x <> '') AS words
           FROM documents)
SELECT doc_id,
  CAST(len(words) AS INTEGER) AS n_words,
  md5('summaries' || chr(10) || CASE WHEN len(words) > {MAX_REQUEST_WORDS}
       THEN array_to_string(words[1:{MAX_REQUEST_WORDS}], ' ') ELSE text END) AS request_md5
FROM w""")
def request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    req = request_text(F.col("text"), stage="summaries", template="{text}")
    return d.select("doc_id", word_count(F.col("text")).alias("n_words"), F.md5(req).alias("request_md5"))


# ------------------------------------------------------------------ T3-T6, A8
_STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"
_W, _NW = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"


def _sql_has_word(text: str, term: str, prefix: bool = False) -> str:
    tail = f"{_W}*" if prefix else ""
    return (f"regexp_matches({text}, '(?i)(^|{_NW})' || '\\Q' || replace({term}, '\\E', '\\E\\\\E\\Q') || "
            f"'\\E{tail}({_NW}|$)')")


_EVIDENCE_INPUT_SQL = """
  SELECT d.doc_id, d.text,
    CASE WHEN d.doc_id % 2 = 0
         THEN split_part(b.text, ' ', 1) || ', the ' || split_part(b.text, ' ', 3) || ', Iraq'
         ELSE split_part(b.text, ' ', 2) || ' ' || split_part(d.text, ' ', 2) END AS location,
    CASE WHEN d.doc_id % 3 = 0
         THEN regexp_extract(d.text, '^[^ ]+') || ' NEAR/5 ' || split_part(d.text, ' ', 4)
         ELSE split_part(b.text, ' ', 1) || ' ' || split_part(b.text, ' ', 2) || ' ' || split_part(d.text, ' ', 3) END AS what_built
  FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark)"""


def _sql_location_evidence() -> str:
    parts = (f"CASE WHEN contains(location, ',') THEN list_transform(string_split(location, ','), lambda x: {sql_ustrip('x')}) "
             f"WHEN {sql_ustrip('location')} = '' THEN [] ELSE regexp_split_to_array({sql_ustrip('location')}, '{WS_SQL}+') END")
    return f"""
e1 AS (SELECT *, {parts} AS parts FROM inp),
e2 AS (SELECT *, list_filter(regexp_split_to_array(array_to_string(list_filter(parts, lambda x: NOT list_contains({_STOP_SQL}, lower(x))), ' '), '{WS_SQL}+'), lambda x: x <> '') AS words FROM e1),
e3 AS (SELECT *, len(list_filter(words, lambda w: CASE WHEN contains(w, 'Iraq') THEN {_sql_has_word('text', "'Iraq'", True)} ELSE {_sql_has_word('text', 'w')} END)) AS loc_found FROM e2)"""


def _sql_near(spec: str) -> str:
    first = sql_ustrip(f"split_part({spec}, 'NEAR/', 1)")
    rest = sql_ustrip(f"split_part({spec}, 'NEAR/', 2)")
    dist = f"coalesce(TRY_CAST(regexp_extract({rest}, '^(\\d+)', 1) AS INTEGER), 10)"
    term = sql_ustrip(f"regexp_replace({rest}, '^\\d+', '')")
    q = lambda x: f"'\\Q' || replace({x}, '\\E', '\\E\\\\E\\Q') || '\\E'"
    return (f"CASE WHEN contains({spec}, 'NEAR/') THEN '(?i)(^|{_NW})' || {q(first)} || '(?:{_NW}+{_W}+){{0,' || "
            f"CAST({dist} AS VARCHAR) || '}}?{_NW}+' || {q(term)} || '({_NW}|$)' "
            f"ELSE '(?i)(^|{_NW})' || {q(first)} || '({_NW}|$)' END")


@register("evidence_checks", f"""
WITH inp AS ({_EVIDENCE_INPUT_SQL}),
{_sql_location_evidence()},
o1 AS (SELECT *, list_filter(regexp_split_to_array({sql_ustrip('what_built')}, '{WS_SQL}+'), lambda x: x <> '') AS owords FROM e3),
o2 AS (SELECT *, len(list_filter(owords, lambda w: {_sql_has_word('text', 'w')})) AS obj_found,
              coalesce(regexp_matches(text, {_sql_near('what_built')}), false) AS phrase FROM o1)
SELECT doc_id, location, what_built,
  CAST(loc_found AS INTEGER) AS location_found,
  CASE WHEN len(words) > 0 THEN loc_found / len(words) ELSE 0.0 END AS location_ratio,
  coalesce(len(words) > 0 AND loc_found / len(words) >= 0.5, false) AS location_match,
  CASE WHEN len(owords) > 0 THEN obj_found / len(owords) ELSE 0.0 END AS what_built_ratio,
  (phrase OR (len(owords) > 0 AND obj_found / len(owords) >= 0.5)) AS what_built_match
FROM o2""")
def evidence_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = _evidence_input(spark, sf_dir)
    loc = ev.location_evidence(F.col("text"), F.col("location"), toks=F.col("toks"))
    obj = ev.object_evidence(F.col("text"), F.col("what_built"), toks=F.col("toks"))
    return inp.select("doc_id", "location", "what_built",
                      loc["found"].alias("location_found"), loc["ratio"].alias("location_ratio"),
                      loc["match"].alias("location_match"), obj["ratio"].alias("what_built_ratio"),
                      obj["match"].alias("what_built_match"))


def _evidence_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a location and an object taken from their own and from benchmark words."""
    d = table(spark, sf_dir, "documents")
    bench = table(spark, sf_dir, "benchmark")
    nb = bench.count()
    j = d.withColumn("item_id", F.col("doc_id") % F.lit(nb)).join(bench.withColumnRenamed("text", "btext"), "item_id")

    def sp(c, i):
        return F.split_part(F.col(c), F.lit(" "), F.lit(i))

    location = F.when(F.col("doc_id") % 2 == 0,
                      F.concat(sp("btext", 1), F.lit(", the "), sp("btext", 3), F.lit(", Iraq"))
                      ).otherwise(F.concat(sp("btext", 2), F.lit(" "), sp("text", 2)))
    what = F.when(F.col("doc_id") % 3 == 0,
                  F.concat(F.regexp_extract("text", r"^[^ ]+", 0), F.lit(" NEAR/5 "), sp("text", 4))
                  ).otherwise(F.concat(sp("btext", 1), F.lit(" "), sp("btext", 2), F.lit(" "), sp("text", 3)))
    return j.select("doc_id", "text", location.alias("location"), what.alias("what_built"),
                    tokens(F.col("text")).alias("toks"))
