"""Registered queries: context rule, geocoding, money spans, link chains,
grids, feeds, model responses and relevance (T7, J3, M2-M5, H6, H8, R1-R6,
S1, S2, E1, E2, P8, P12, P13, J6)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import amounts_in_usd
from ..operators import enrich as E
from ..operators.grids import month_ranges, month_starts, query_grid, window_starts
from ..operators.pages import followed_text, replace_with_full_text
from ..sources.feeds import mentions_from_responses, news_from_responses
from . import fixtures as fx
from .catalog import _sql_hits, _sql_place_dictionary, _sql_winner
from .composites import geocode
from .q_pages import _PARAS_SQL, _sql_strip
from .registry import register, table

# ------------------------------------------------------------------ T7
KEY_GAZ = [(1, "market", 33.0, 44.0, "Key", None, None, None, None, None),
           (2, "town", 31.0, 45.0, "Basin", None, None, None, None, None)]


# "Key" and a word after it stand inside the whole text, before its word number doc_id % words.
_KEY_TEXT_SQL = """SELECT doc_id, array_to_string(list_concat(list_concat(w[1:p], ['Key', CASE WHEN doc_id % 2 = 0 THEN 'iraq' ELSE 'basin' END]), w[p + 1:]), ' ') AS txt
           FROM (SELECT doc_id, string_split(text, ' ') AS w, doc_id % len(string_split(text, ' ')) AS p FROM documents)"""


def _key_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.split("text", " ")
    at = (F.col("doc_id") % F.size("w")).cast("int")
    added = F.array(F.lit("Key"), F.when(F.col("doc_id") % 2 == 0, F.lit("iraq")).otherwise(F.lit("basin")))
    return (table(spark, sf_dir, "documents").select("doc_id", w.alias("w"))
            .select("doc_id", F.array_join(F.concat(F.slice("w", 1, at), added, F.slice(F.col("w"), at + 1, 1 << 30)), " ").alias("txt")))


@register("special_term_context", f"""
WITH c AS ({_KEY_TEXT_SQL}),
gaz AS (SELECT * FROM {fx.values_sql(KEY_GAZ, fx.GAZETTEER_SCHEMA)}),
{_sql_hits("SELECT doc_id, txt FROM c", {"place": _sql_place_dictionary("gaz")})},
ks AS (SELECT doc_id, length(regexp_extract(txt, '(?is)^(.*?(?:^|[^\\p{{L}}\\p{{N}}_]))key(?:[^\\p{{L}}\\p{{N}}_]|$)', 1)) AS s,
              length(txt) AS len, txt FROM c),
bad AS (SELECT doc_id FROM ks
        WHERE NOT contains(lower(substr(txt, greatest(s - 15, 0) + 1, least(s + 3 + 15, len) - greatest(s - 15, 0))), 'iraq')),
hits2 AS (SELECT * FROM hits WHERE NOT (term = 'Key' AND doc_id IN (SELECT doc_id FROM bad))),
pk AS (SELECT doc_id, key, count(*) AS n, min(pos) AS first FROM hits2 GROUP BY doc_id, key),
pw AS (SELECT doc_id, key, n, first, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first ASC) AS rn FROM pk),
win AS (SELECT w.doc_id, w.key, h.term FROM pw w JOIN hits2 h ON h.doc_id = w.doc_id AND h.pos = w.first WHERE w.rn = 1)
SELECT c.doc_id, c.txt, CAST(win.key AS BIGINT) AS loc_id, win.term AS matched_term
FROM c LEFT JOIN win ON win.doc_id = c.doc_id""")
def special_term_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7: "Key" counts only with "iraq" within 15 characters of its first hit."""
    rows = _key_texts(spark, sf_dir)
    g = fx.frame(spark, KEY_GAZ, fx.GAZETTEER_SCHEMA)
    return geocode(rows, g, id_col="doc_id", text_col="txt").select("doc_id", "txt", "loc_id", "matched_term")


# ------------------------------------------------------------------ J1 + A1 + A11 + J3 on names from the tables
_NATION_GAZ_SQL = """(SELECT CAST(n.n_nationkey AS BIGINT) AS loc_id, 'nation' AS loc_type,
   CAST(n.n_nationkey * 1.5 AS DOUBLE) AS lat, CAST(n.n_regionkey * 2.0 AS DOUBLE) AS lon, n.n_name AS town_en,
   CAST(NULL AS VARCHAR) AS town_ar,
   CAST(NULL AS VARCHAR) AS admin3_en, CAST(NULL AS VARCHAR) AS admin3_ar, r.r_name AS admin2_en,
   CAST(NULL AS VARCHAR) AS admin2_ar
 FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey)"""
_CUST_LOC_SQL = """(SELECT c.c_custkey AS doc_id, CASE c.c_custkey % 3
     WHEN 0 THEN 'Site near ' || n.n_name || ' in ' || r.r_name
     WHEN 1 THEN r.r_name || ' and ' || n.n_name ELSE 'Unknown place' END AS txt
   FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey)"""


@register("geocode_customers", f"""
WITH gaz AS {_NATION_GAZ_SQL},
c AS {_CUST_LOC_SQL},
{_sql_hits("SELECT doc_id, txt FROM c", {"place": _sql_place_dictionary("gaz")})},
{_sql_winner()}
SELECT c.doc_id AS c_custkey, c.txt AS location, CAST(win.key AS BIGINT) AS loc_id, win.term AS matched_term,
       g.lat, g.lon, g.town_en, g.admin2_en
FROM c LEFT JOIN win ON win.doc_id = c.doc_id LEFT JOIN gaz g ON g.loc_id = CAST(win.key AS BIGINT)""")
def geocode_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocode composed location texts with a gazetteer built from ``nation``/``region``.

    A region name belongs to five nations, so the last one wins (A11); a
    text naming a nation and its region is a tie won by the first seen.
    """
    n, r, c = (table(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    gaz = nr.select(F.col("n_nationkey").cast("bigint").alias("loc_id"), F.lit("nation").alias("loc_type"),
                    (F.col("n_nationkey") * 1.5).alias("lat"), (F.col("n_regionkey") * 2.0).alias("lon"),
                    F.col("n_name").alias("town_en"), F.lit(None).cast("string").alias("town_ar"),
                    F.lit(None).cast("string").alias("admin3_en"), F.lit(None).cast("string").alias("admin3_ar"),
                    F.col("r_name").alias("admin2_en"), F.lit(None).cast("string").alias("admin2_ar"))
    k = F.col("c_custkey") % 3
    txt = (F.when(k == 0, F.concat(F.lit("Site near "), F.col("n_name"), F.lit(" in "), F.col("r_name")))
           .when(k == 1, F.concat(F.col("r_name"), F.lit(" and "), F.col("n_name"))).otherwise(F.lit("Unknown place")))
    rows = c.join(nr, c.c_nationkey == nr.n_nationkey).select("c_custkey", txt.alias("location"))
    out = geocode(rows, gaz, id_col="c_custkey", text_col="location")
    return out.select("c_custkey", "location", "loc_id", "matched_term", "lat", "lon", "town_en", "admin2_en")


# ------------------------------------------------------------------ M2-M5, J9, A7
_RATE_SQL = "CASE {0} WHEN 'EUR' THEN 1.07 WHEN 'GBP' THEN 1.25 WHEN 'dinars' THEN 0.00077 ELSE 1.0 END"

# Texts with several amounts and mentions: pieces in order, each with its value (null: no amount) and currency (null: no
# mention). Which mention is nearest is worked out from the places of the pieces.
_MONEY_CASES_SQL = f"""
SELECT o_orderkey, CASE o_orderkey % 6
  WHEN 0 THEN [{{'t': 'EUR', 'v': NULL, 'c': 'EUR'}}, {{'t': ' ', 'v': NULL, 'c': NULL}}, {{'t': p, 'v': p::DOUBLE, 'c': NULL}}, {{'t': ' ', 'v': NULL, 'c': NULL}},
               {{'t': 'GBP', 'v': NULL, 'c': 'GBP'}}, {{'t': ' then ', 'v': NULL, 'c': NULL}}, {{'t': 'two million', 'v': 2e6, 'c': NULL}},
               {{'t': ' Iraqi ', 'v': NULL, 'c': NULL}}, {{'t': 'dinars', 'v': NULL, 'c': 'dinars'}}]
  WHEN 1 THEN [{{'t': p, 'v': p::DOUBLE, 'c': NULL}}, {{'t': ' ', 'v': NULL, 'c': NULL}}, {{'t': 'USD', 'v': NULL, 'c': 'USD'}}, {{'t': ', then ', 'v': NULL, 'c': NULL}},
               {{'t': '5% of ' || p || ' million', 'v': p::DOUBLE * 1e6 * 5 / 100, 'c': NULL}}, {{'t': ' ', 'v': NULL, 'c': NULL}}, {{'t': 'dinars', 'v': NULL, 'c': 'dinars'}}]
  WHEN 2 THEN [{{'t': 'GBP', 'v': NULL, 'c': 'GBP'}}, {{'t': repeat(' and', CAST(o_orderkey % 9 AS INTEGER)) || ' ', 'v': NULL, 'c': NULL}}, {{'t': p, 'v': p::DOUBLE, 'c': NULL}},
               {{'t': repeat(' or', CAST(o_orderkey % 7 AS INTEGER)) || ' ', 'v': NULL, 'c': NULL}}, {{'t': 'dinars', 'v': NULL, 'c': 'dinars'}}]
  WHEN 3 THEN [{{'t': 'about ', 'v': NULL, 'c': NULL}}, {{'t': p || 'k', 'v': p::DOUBLE * 1e3, 'c': NULL}}, {{'t': ' or ', 'v': NULL, 'c': NULL}}, {{'t': '3 billion', 'v': 3e9, 'c': NULL}}]
  WHEN 4 THEN [{{'t': 'EUR', 'v': NULL, 'c': 'EUR'}}, {{'t': ' at ', 'v': NULL, 'c': NULL}}, {{'t': '12345', 'v': 12345::DOUBLE, 'c': NULL}}, {{'t': ' ', 'v': NULL, 'c': NULL}},
               {{'t': 'GBP', 'v': NULL, 'c': 'GBP'}}, {{'t': ' ', 'v': NULL, 'c': NULL}}, {{'t': '700', 'v': 700::DOUBLE, 'c': NULL}}]
  ELSE [{{'t': 'no sum in ', 'v': NULL, 'c': NULL}}, {{'t': 'EUR', 'v': NULL, 'c': 'EUR'}}] END AS s
FROM (SELECT *, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS p FROM orders)"""


@register("usd_from_text", f"""
WITH o AS ({_MONEY_CASES_SQL}),
x AS (SELECT o_orderkey, unnest(s) AS piece, unnest(range(len(s))) AS i FROM o),
y AS (SELECT o_orderkey, i, piece.t AS t, piece.v AS v, piece.c AS c,
             sum(length(piece.t)) OVER (PARTITION BY o_orderkey ORDER BY i) - length(piece.t) AS pos FROM x),
n AS (SELECT a.o_orderkey, a.i, a.v, m.c, row_number() OVER (PARTITION BY a.o_orderkey, a.i ORDER BY abs(a.pos - m.pos), m.pos) AS k
      FROM y a LEFT JOIN y m ON m.o_orderkey = a.o_orderkey AND m.c IS NOT NULL WHERE a.v IS NOT NULL),
u AS (SELECT o_orderkey, max(v * {_RATE_SQL.format('c')}) AS usd, count(*) AS n_amounts FROM n WHERE k = 1 GROUP BY o_orderkey)
SELECT y.o_orderkey, string_agg(t, '' ORDER BY i) AS amount_text, any_value(u.usd) AS usd, CAST(coalesce(any_value(u.n_amounts), 0) AS INTEGER) AS n_amounts
FROM y LEFT JOIN u ON u.o_orderkey = y.o_orderkey GROUP BY y.o_orderkey""")
def usd_from_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2-M5 + J9 + A7: the largest of several amounts, each converted by its nearest currency (ties: the earlier one)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 6
    price = F.floor("o_totalprice").cast("bigint").cast("string")
    gap = (lambda word, n: F.concat(F.repeat(F.lit(word), (F.col("o_orderkey") % n).cast("int")), F.lit(" ")))
    text = (F.when(k == 0, F.concat(F.lit("EUR "), price, F.lit(" GBP then two million Iraqi dinars")))
            .when(k == 1, F.concat(price, F.lit(" USD, then 5% of "), price, F.lit(" million dinars")))
            .when(k == 2, F.concat(F.lit("GBP"), gap(" and", 9), price, gap(" or", 7), F.lit("dinars")))
            .when(k == 3, F.concat(F.lit("about "), price, F.lit("k or 3 billion")))
            .when(k == 4, F.lit("EUR at 12345 GBP 700"))
            .otherwise(F.lit("no sum in EUR")))
    a = o.select("o_orderkey", text.alias("amount_text"))
    return (a.select("o_orderkey", "amount_text", amounts_in_usd(F.col("amount_text")).alias("each"))
            .select("o_orderkey", "amount_text", F.array_max("each").alias("usd"), F.size("each").alias("n_amounts")))


# ------------------------------------------------------------------ H6, J10
# Chains of twelve pages: 0 -> 1 -> ... -> 10; in every fifth chain page 10 leads back to page 4; page 11 has
# the link outside its section. The section, with the page's own heading, is put into the stored HTML.
_LINKED_SQL = """page_id % 12 < 10 OR (page_id % 12 = 10 AND (page_id // 12) % 5 = 0)"""
_NEXT_SQL = "CASE WHEN page_id % 12 = 10 THEN page_id - 6 ELSE page_id + 1 END"
_CHAIN_SQL = f"""(SELECT page_id, 'https://site.example/p/' || CAST(page_id AS VARCHAR) AS url,
   'Part ' || CAST(page_id AS VARCHAR) || {_sql_strip("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}
     || CASE WHEN {_LINKED_SQL} THEN 'Click here to read the full report.' ELSE '' END AS body,
   CASE WHEN {_LINKED_SQL} THEN 'https://site.example/p/' || CAST({_NEXT_SQL} AS VARCHAR) END AS nxt FROM pages)"""
_WALK_SQL = """
  UNION ALL
  SELECT w.start_url, pg.nxt, list_append(w.seen, pg.nxt), w.hops + 1, list_contains(w.seen, pg.nxt)
  FROM walk w JOIN pg ON pg.url = w.final_url WHERE pg.nxt IS NOT NULL AND NOT w.round),
fin AS (SELECT start_url, arg_max(final_url, hops) AS final_url, max(hops) AS hops, bool_or(round) AS round FROM walk GROUP BY start_url)"""


def _chain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = F.col("page_id")
    anchor = F.concat(F.lit("<a href='"), F.when(pid % 12 == 10, F.concat(F.lit("/p/"), (pid - 6).cast("string")))
                      .otherwise((pid + 1).cast("string")), F.lit("'>Click here to read the full report.</a>"))
    linked = (pid % 12 < 10) | ((pid % 12 == 10) & (F.floor(pid / 12) % 5 == 0))
    heading = F.regexp_extract("html", "<h1>(.*?)</h1>", 1)
    section = F.concat(F.lit('<section class="post entry"><section>Part '), pid.cast("string"), F.lit("</section><p>"), heading,
                       F.lit("</p>"), F.when(linked, anchor).otherwise(F.lit("")), F.lit("</section>"),
                       F.when(pid % 12 == 11, anchor).otherwise(F.lit("")))
    p = table(spark, sf_dir, "pages")
    rows = p.select("page_id", F.concat(F.lit("https://site.example/p/"), pid.cast("string")).alias("url"),
                    F.concat(section, F.col("html")).alias("html"))
    # some pages are stored twice
    return rows.unionByName(rows.filter(pid % 7 == 0)).drop("page_id")


@register("report_chains", f"""
WITH RECURSIVE pg AS {_CHAIN_SQL},
walk(start_url, final_url, seen, hops, round) AS (
  SELECT url, url, [url], 0, false FROM pg{_WALK_SQL}
SELECT w.start_url, CASE WHEN NOT w.round THEN w.final_url END AS final_url,
       CASE WHEN NOT w.round THEN CAST(w.hops AS BIGINT) END AS hops, CASE WHEN NOT w.round THEN pg.body END AS body
FROM fin w LEFT JOIN pg ON pg.url = w.final_url""")
def report_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6 + H1: follow "full report" links inside the section (relative and absolute) between stored pages,
    through chains of any length; chains that run in a cycle have no text."""
    return followed_text(_chain_pages(spark, sf_dir)).select("start_url", "final_url", "hops", "body")


# ------------------------------------------------------------------ R1-R5
@register("order_windows", """
SELECT o_orderkey, 'two_day' AS kind, CAST(i AS INTEGER) AS seq,
       strftime(CAST(o_orderdate AS DATE) + CAST(2 * i AS INTEGER), '%Y-%m-%d') AS range_start,
       strftime(CAST(o_orderdate AS DATE) + CAST(2 * i + 2 AS INTEGER), '%Y-%m-%d') AS range_end
FROM (SELECT *, unnest(range(4)) AS i FROM orders)
UNION ALL
SELECT o_orderkey, 'month', CAST(i AS INTEGER),
       strftime(greatest(date_trunc('month', CAST(o_orderdate AS DATE)) + to_months(CAST(i AS INTEGER)), CAST(o_orderdate AS DATE)), '%Y-%m-%d'),
       strftime(least(date_trunc('month', CAST(o_orderdate AS DATE)) + to_months(CAST(i + 1 AS INTEGER)), CAST(o_orderdate AS DATE) + 70), '%Y-%m-%d')
FROM (SELECT *, unnest(range(4)) AS i FROM orders)
WHERE date_trunc('month', CAST(o_orderdate AS DATE)) + to_months(CAST(i AS INTEGER)) < CAST(o_orderdate AS DATE) + 70
UNION ALL
SELECT o_orderkey, 'month_start', CAST(i AS INTEGER),
       strftime(CASE WHEN i = 0 THEN CAST(o_orderdate AS DATE)
                     ELSE date_trunc('month', CAST(o_orderdate AS DATE)) + to_months(CAST(i AS INTEGER)) END, '%Y-%m-%d'),
       CAST(NULL AS VARCHAR)
FROM (SELECT *, unnest(range(5)) AS i FROM orders)
WHERE i = 0 OR date_trunc('month', CAST(o_orderdate AS DATE)) + to_months(CAST(i - 1 AS INTEGER)) < CAST(o_orderdate AS DATE) + 70""")
def order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 (2-day windows over 7 days), R3 (month ranges over 70 days), R4 (month starts) per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    end7 = F.date_add("d", 7)
    end70 = F.date_add("d", 70)
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd")
    two = o.select("o_orderkey", F.posexplode(window_starts(F.col("d"), end7, 2)).alias("seq", "w")).select(
        "o_orderkey", F.lit("two_day").alias("kind"), "seq", fmt("w.win_start").alias("range_start"),
        fmt("w.win_end").alias("range_end"))
    mon = o.select("o_orderkey", F.posexplode(month_ranges(F.col("d"), end70)).alias("seq", "w")).select(
        "o_orderkey", F.lit("month").alias("kind"), "seq", fmt("w.range_start").alias("range_start"),
        fmt("w.range_end").alias("range_end"))
    starts = o.select("o_orderkey", F.posexplode(month_starts(F.col("d"), end70)).alias("seq", "s")).select(
        "o_orderkey", F.lit("month_start").alias("kind"), "seq", fmt("s").alias("range_start"),
        F.lit(None).cast("string").alias("range_end"))
    return two.unionByName(mon).unionByName(starts)


@register("query_grid", """
WITH t AS (SELECT DISTINCT p_name AS term FROM part),
q AS (SELECT unnest(['Iraq NEAR ' || term, term || ' NEAR Iraq', 'Iraq AND ' || term, term || ' AND Iraq']) AS query FROM t
      UNION ALL SELECT r_name FROM region)
SELECT query, strftime(DATE '2024-01-01' + CAST(2 * i AS INTEGER), '%Y-%m-%d') AS win_start,
       strftime(DATE '2024-01-01' + CAST(2 * i + 2 AS INTEGER), '%Y-%m-%d') AS win_end
FROM q, (SELECT unnest(range(4)) AS i)""")
def query_grid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct terms (the names of all parts) x 4 templates, plus region names as
    fixed queries, x 2-day windows."""
    terms = table(spark, sf_dir, "part").select(F.col("p_name").alias("term"))
    fixed = table(spark, sf_dir, "region").select("r_name")
    g = query_grid(terms, F.lit("2024-01-01").cast("date"), F.lit("2024-01-07").cast("date"), 2, fixed)
    return g.select("query", F.date_format("win_start", "yyyy-MM-dd").alias("win_start"),
                    F.date_format("win_end", "yyyy-MM-dd").alias("win_end"))


# ------------------------------------------------------------------ S1, S2
_TITLE = r"^[\p{L}\p{N}_ ]*"


@register("news_feed", f"""
WITH a AS (SELECT doc_id, 'https://news.example/' || CAST(doc_id AS VARCHAR) AS url,
                  regexp_extract(text, '{_TITLE}') AS title, text AS content,
                  strftime(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER), '%Y-%m-%d') AS published
           FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0)
SELECT sha256(to_json({{'source': 'news', 'url': url, 'title': title}})) AS doc_id, url, title, md5(content) AS content_md5,
       published FROM a""")
def news_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored news-API responses -> articles; a response without ``articles``
    (every 5th) or with broken JSON (every 7th) gives no rows."""
    d = table(spark, sf_dir, "documents")
    item = F.struct(F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
                    F.regexp_extract("text", _TITLE, 0).alias("title"),
                    F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")),
                                  "yyyyMMdd'T'HHmmss'Z'").alias("seendate"),
                    F.col("text").alias("content"))
    good = F.to_json(F.struct(F.array(item).alias("articles")))
    resp = (F.when(F.col("doc_id") % 5 == 0, F.to_json(F.struct(F.array(item).alias("results"))))
            .when(F.col("doc_id") % 7 == 0, F.substring(good, 1, 20)).otherwise(good))
    arts = news_from_responses(d.select(resp.alias("response")))
    return arts.select("doc_id", "url", "title", F.md5("content").alias("content_md5"),
                       F.date_format("published", "yyyy-MM-dd").alias("published"))


@register("social_mentions", f"""
SELECT sha256(to_json({{'source': 'social', 'url': 'https://social.example/' || CAST(c.conv_id AS VARCHAR) || '/' || CAST(c.turn AS VARCHAR),
                        'title': c.role}})) AS doc_id,
       c.conv_id, md5(c.text) AS content_md5, strftime(DATE '2024-03-01' + CAST(c.turn AS INTEGER), '%Y-%m-%d') AS published
FROM conversations c""")
def social_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored social-API responses (a ``data`` array per response) -> articles."""
    c = table(spark, sf_dir, "conversations")
    item = F.struct(F.col("text").alias("content"),
                    F.date_format(F.date_add(F.lit("2024-03-01").cast("date"), F.col("turn").cast("int")),
                                  "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
                    F.col("role").alias("title"),
                    F.concat(F.lit("https://social.example/"), F.col("conv_id").cast("string"), F.lit("/"),
                             F.col("turn").cast("string")).alias("url"))
    responses = c.select(F.to_json(F.struct(F.array(item).alias("data"))).alias("response"))
    m = mentions_from_responses(responses)
    conv = F.split_part(F.col("url"), F.lit("/"), F.lit(4)).cast("bigint")
    return m.select("doc_id", conv.alias("conv_id"), F.md5("content").alias("content_md5"),
                    F.date_format("published", "yyyy-MM-dd").alias("published"))


# ------------------------------------------------------------------ E1, P12, P13, J6, A9
def _demo_responder(prompts: pd.Series) -> pd.Series:
    """A pure stand-in for the model: a numbered list when the text has "the"."""
    def answer(p: str) -> str:
        words = p.split("\n", 1)[1].split()
        return ("1. " + " ".join(words[:3])) if "the" in (w.lower() for w in words) else "No project."
    return prompts.map(answer)


@register("model_responses", """
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x{85}\\p{Z}]+'), lambda x: x <> '') AS w,
                  text FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       CASE WHEN list_contains(list_transform(w[1:12000], lambda x: lower(x)), 'the')
            THEN '1. ' || array_to_string(w[1:3], ' ') ELSE 'No project.' END AS raw,
       list_contains(list_transform(w[1:12000], lambda x: lower(x)), 'the') AS accepted
FROM t""")
def model_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + P12 + P13: requests -> pure responder in ``mapInPandas`` -> responses; accepted = numbered list."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    req = E.build_requests(d, "doc_id", "content", "summaries", "{text}")
    resp = E.run_responder(E.pending(req, None), _demo_responder)
    return resp.select("doc_id", "raw", (F.col("ok") & F.col("raw").startswith("1")).alias("accepted"))


# ------------------------------------------------------------------ E2, P8, H8
@register("relevant_full_text", f"""
WITH d AS (SELECT d.doc_id, d.text, p.html, p.url,
                  CASE WHEN contains(' ' || lower(d.text) || ' ', ' and ') THEN 'Yes, Iraq' ELSE 'no' END AS content_check
           FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id),
f AS (SELECT *, array_to_string({_PARAS_SQL}, ' ') AS full_content FROM d)
SELECT doc_id, md5(CASE WHEN full_content IS NOT NULL AND full_content <> '' THEN full_content ELSE text END) AS content_md5
FROM f WHERE content_check ILIKE '%yes%'""")
def relevant_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 + P8 + H8: keep rows whose relevance answer says yes; take the stored page's paragraphs as content."""
    d = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages")
    check = F.when(F.contains(F.concat(F.lit(" "), F.lower("text"), F.lit(" ")), F.lit(" and ")),
                   F.lit("Yes, Iraq")).otherwise(F.lit("no"))
    rows = (d.join(pages.select("page_id", "url"), d.doc_id == pages.page_id, "left")
            .select("doc_id", F.col("text").alias("content"), "url", check.alias("content_check")))
    rel = rows.filter(E.is_relevant("content_check"))
    out = replace_with_full_text(rel, pages, url_col="url")
    return out.select("doc_id", F.md5("content").alias("content_md5"))



# ------------------------------------------------------------------ end to end: facts
TOWN_GAZ = [(1, "town", 36.3, 43.1, "Town0", None, None, None, "North", None),
            (2, "district", 33.3, 44.4, "Town1", None, "Town-One", None, "Centre", None),
            (3, "town", 30.5, 47.8, "Town2", None, None, None, "South", None)]


def _facts_sql() -> str:
    from .q_nested import _sql_response
    from .q_text import LABEL_ROWS, _sql_clean, _sql_given, _sql_has_word, _sql_norm, _sql_rules
    from .registry import WS_SQL, sql_ustrip
    loc_words = f"list_filter(regexp_split_to_array({sql_ustrip('location')}, '{WS_SQL}+'), lambda x: x <> '')"
    obj_words = f"list_filter(regexp_split_to_array({sql_ustrip('what_built')}, '{WS_SQL}+'), lambda x: x <> '')"
    return f"""
WITH p AS (SELECT p_partkey AS doc_id, p_partkey % 4 AS k, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS sz,
                  {_sql_response(True)} AS summaries,
                  'Work in Town' || CAST(p_partkey % 3 AS VARCHAR) || ' on a ' || p_name || ' for ' || p_brand AS content,
                  strftime(DATE '2024-01-01' + CAST(p_partkey % 28 AS INTEGER), '%Y-%m-%d') AS published
           FROM part),
proj AS (
  SELECT doc_id, CAST(i AS INTEGER) AS ordinal, p_name AS title, published, content, summaries,
    'https://parts.example/' || CAST(doc_id AS VARCHAR) AS url,
    'Town' || CAST(i AS VARCHAR) || ' ' || sz AS location,
    CASE WHEN doc_id % 6 = 0 THEN 'Al''s ' || p_name || ' ' || CAST(i AS VARCHAR)
         ELSE p_name || ' ' || CAST(i AS VARCHAR) END AS what_built,
    CASE WHEN doc_id % 5 = 0 AND i = 1 THEN NULL ELSE p_brand || '/' || CAST(i AS VARCHAR) END AS funder,
    '$' || sz || ' million' AS amount_text, p_type AS category_text, '202' || CAST(i AS VARCHAR) AS expected_completion,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'note ' || CAST(i AS VARCHAR) END AS additional, sz
  FROM (SELECT *, unnest(range(k)) AS i FROM p WHERE k > 0)),
gaz AS (SELECT * FROM {fx.values_sql(TOWN_GAZ, fx.GAZETTEER_SCHEMA)}),
lm AS (
  SELECT text AS map_text, {_sql_clean('label_0')} AS l0, {_sql_clean('label_1')} AS l1 FROM (
    SELECT *, row_number() OVER (PARTITION BY text ORDER BY ord DESC) AS rn
    FROM {fx.values_sql(LABEL_ROWS, fx.LABEL_SCHEMA)} WHERE text IS NOT NULL) WHERE rn = 1),
ev AS (SELECT *, {loc_words} AS lw, {obj_words} AS ow FROM proj),
ev2 AS (SELECT *, len(list_filter(lw, lambda w: {_sql_has_word('content', 'w')})) AS lf,
                  len(list_filter(ow, lambda w: {_sql_has_word('content', 'w')})) AS of,
                  regexp_matches(content, '(?i)(^|[^\\p{{L}}\\p{{N}}_])\\Q' || what_built || '\\E([^\\p{{L}}\\p{{N}}_]|$)') AS phrase
        FROM ev)
SELECT e.doc_id, e.ordinal, e.title, e.published, e.url, md5(e.content) AS content_md5, md5(e.summaries) AS summaries_md5,
  e.location, e.what_built, e.funder, e.amount_text, e.category_text, e.expected_completion, e.additional,
  coalesce(contains({_sql_norm('e.content')}, {_sql_norm('e.location')}), false) AS location_terms_present,
  (len(e.lw) > 0 AND e.lf / len(e.lw) >= 0.5) AS location_match,
  (e.phrase OR (len(e.ow) > 0 AND e.of / len(e.ow) >= 0.5)) AS what_built_match,
  g.loc_id, 'Town' || CAST(e.ordinal AS VARCHAR) AS matched_term, g.loc_type, g.lat, g.lon, g.town_en, g.admin2_en,
  CAST({" + ".join(_sql_given(c) for c in ["location", "what_built", "funder", "amount_text", "category_text", "expected_completion"])} AS INTEGER) AS sort_score,
  CAST(year(CAST(e.published AS DATE)) AS INTEGER) AS year,
  CASE WHEN lm.map_text IS NOT NULL THEN coalesce(lm.l0, lm.l1) ELSE {_sql_rules('e.category_text')} END AS category_0,
  CASE WHEN lm.map_text IS NOT NULL AND lm.l0 IS NOT NULL THEN lm.l1 END AS category_1,
  CAST(e.sz AS DOUBLE) * 1e6 AS usd
FROM ev2 e JOIN gaz g ON g.loc_id = e.ordinal + 1 LEFT JOIN lm ON lm.map_text = e.category_text"""


@register("project_facts", _facts_sql())
def project_facts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: stored responses -> projects -> evidence -> geocode -> labels -> score -> USD."""
    from .composites import project_facts
    from .q_nested import _response_column
    from .q_text import LABEL_ROWS
    p = table(spark, sf_dir, "part")
    arts = p.select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("title"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 28).cast("int")).alias("published"),
        F.concat(F.lit("Work in Town"), (F.col("p_partkey") % 3).cast("string"), F.lit(" on a "), F.col("p_name"),
                 F.lit(" for "), F.col("p_brand")).alias("content"),
        F.concat(F.lit("https://parts.example/"), F.col("p_partkey").cast("string")).alias("url"),
        _response_column(True).alias("summaries"))
    facts = project_facts(arts, fx.frame(spark, TOWN_GAZ, fx.GAZETTEER_SCHEMA),
                          fx.frame(spark, LABEL_ROWS, fx.LABEL_SCHEMA))
    return facts.select(
        "doc_id", "ordinal", "title", F.date_format("published", "yyyy-MM-dd").alias("published"), "url",
        F.md5("content").alias("content_md5"), F.md5("summaries").alias("summaries_md5"),
        "location", "what_built", "funder", "amount_text", "category_text", "expected_completion", "additional",
        "location_terms_present", "location_match", "what_built_match",
        "loc_id", "matched_term", "loc_type", "lat", "lon", "town_en", "admin2_en",
        "sort_score", "year", "category_0", "category_1", "usd")


# ------------------------------------------------------------------ compat forms of Q1, Q5, Q6
@register("special_term_context_compat", f"""
WITH c AS ({_KEY_TEXT_SQL}),
gaz AS (SELECT * FROM {fx.values_sql(KEY_GAZ, fx.GAZETTEER_SCHEMA)}),
{_sql_hits("SELECT doc_id, txt FROM c", {"place": _sql_place_dictionary("gaz")})},
hits2 AS (SELECT * FROM hits WHERE term <> 'Key'),
pk AS (SELECT doc_id, key, count(*) AS n, min(pos) AS first FROM hits2 GROUP BY doc_id, key),
pw AS (SELECT doc_id, key, n, first, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first ASC) AS rn FROM pk),
win AS (SELECT w.doc_id, w.key, h.term FROM pw w JOIN hits2 h ON h.doc_id = w.doc_id AND h.pos = w.first WHERE w.rn = 1)
SELECT c.doc_id, CAST(win.key AS BIGINT) AS loc_id, win.term AS matched_term
FROM c LEFT JOIN win ON win.doc_id = c.doc_id""")
def special_term_context_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 with ``compat=True`` (Q1): the original test never finds its upper-case
    context word in lower-cased text, so every "Key" hit is dropped."""
    rows = _key_texts(spark, sf_dir)
    g = fx.frame(spark, KEY_GAZ, fx.GAZETTEER_SCHEMA)
    return geocode(rows, g, id_col="doc_id", text_col="txt", compat=True).select("doc_id", "loc_id", "matched_term")


def _evidence_compat_sql() -> str:
    from .q_text import _EVIDENCE_INPUT_SQL, _STOP_SQL, _sql_has_word
    from .registry import WS_SQL, sql_ustrip
    parts = (f"CASE WHEN contains(location, ',') THEN list_transform(string_split(location, ','), lambda x: {sql_ustrip('x')}) "
             f"WHEN {sql_ustrip('location')} = '' THEN [] ELSE regexp_split_to_array({sql_ustrip('location')}, '{WS_SQL}+') END")
    return f"""
WITH inp AS ({_EVIDENCE_INPUT_SQL}),
e1 AS (SELECT *, {parts} AS parts FROM inp),
e2 AS (SELECT *, list_filter(regexp_split_to_array(array_to_string(list_filter(parts, lambda x: NOT list_contains({_STOP_SQL}, lower(x))), ' '), '{WS_SQL}+'), lambda x: x <> '') AS words FROM e1),
e3 AS (SELECT *, len(list_filter(words, lambda w: CASE WHEN contains(w, 'Iraq') THEN {_sql_has_word('text', "'Iraq.*'")} ELSE {_sql_has_word('text', 'w')} END)) AS loc_found FROM e2)
SELECT doc_id, CAST(loc_found AS INTEGER) AS location_found, CAST(len(parts) AS INTEGER) AS n_terms,
  CASE WHEN len(parts) > 0 THEN loc_found / len(parts) ELSE 0.0 END AS location_ratio,
  coalesce(len(parts) > 0 AND loc_found / len(parts) >= 0.5, false) AS location_match
FROM e3"""


@register("evidence_checks_compat", _evidence_compat_sql())
def evidence_checks_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with ``compat=True`` (Q5, Q6): ratio over comma parts (may exceed 1),
    and a word holding "Iraq" is searched as the literal text ``Iraq.*``."""
    from ..functions import evidence as ev
    from .q_text import _evidence_input
    j = _evidence_input(spark, sf_dir)
    loc = ev.location_evidence(F.col("text"), F.col("location"), compat=True, toks=F.col("toks"))
    return j.select("doc_id", loc["found"].alias("location_found"), loc["n_terms"].alias("n_terms"),
                    loc["ratio"].alias("location_ratio"), loc["match"].alias("location_match"))


# ------------------------------------------------------------------ news load composite
_NEWS_INPUT_SQL = """
SELECT d.doc_id, d.lang || ' NEAR ' || d.source AS query, strftime(DATE '2024-01-01' + CAST(2 * (d.doc_id // 400) AS INTEGER), '%Y-%m-%d') AS win_start,
       p.url, split_part(d.text, '.', 1) AS title, d.text AS feed_text,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((d.doc_id * 7) % 1000 AS BIGINT)), '%Y%m%dT%H%M%SZ') AS seendate,
       p.html
FROM documents d JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages)"""


def _news_sql() -> str:
    from .q_pages import _NOISE, _PARAS_SQL, _sql_strip
    art = f"regexp_replace(html, '{_NOISE}', ' ', 'g')"
    main = (f"coalesce(CASE WHEN regexp_matches({art}, '(?is)<article\\b[^>]*>.*?</article\\s*>') THEN "
            f"{_sql_strip(f'regexp_extract({art}, ' + chr(39) + '(?is)<article\\b[^>]*>(.*?)</article\\s*>' + chr(39) + ', 1)')} END, "
            f"nullif(array_to_string({_PARAS_SQL}, ' '), ''))")
    return f"""
WITH i AS ({_NEWS_INPUT_SQL}),
top AS (SELECT *, row_number() OVER (PARTITION BY query, win_start ORDER BY seendate DESC, url, title) AS rk FROM i),
t250 AS (SELECT * FROM top WHERE rk <= 250),
ft AS (SELECT *, row_number() OVER (PARTITION BY query, win_start, title ORDER BY rk) AS tk FROM t250)
SELECT query, win_start, url, title, strftime(CAST(strptime(seendate, '%Y%m%dT%H%M%SZ') AS DATE), '%Y-%m-%d') AS published,
       md5(coalesce(nullif({main}, ''), feed_text)) AS content_md5
FROM ft WHERE tk = 1"""


@register("news_articles", _news_sql())
def news_articles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News load (S1, O3, A4, D1, H7, P15, U2): one stored response per document, a query per
    language and source and windows of two days, newest 250 per (query, window), one article per title,
    page text as content; a title is the text up to its first full stop."""
    from .composites import news_articles
    d = table(spark, sf_dir, "documents")
    p = table(spark, sf_dir, "pages")
    npages = p.count()
    j = d.withColumn("page_id", F.col("doc_id") % F.lit(npages)).join(p.select("page_id", "url"), "page_id")
    seendate = F.date_format(F.expr("TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, "
                                    "CAST((doc_id * 7) % 1000 AS INT), 0)"), "yyyyMMdd'T'HHmmss'Z'")
    item = F.struct(F.col("url"), F.split_part(F.col("text"), F.lit("."), F.lit(1)).alias("title"),
                    seendate.alias("seendate"), F.col("text").alias("content"))
    window = F.expr("date_add(DATE '2024-01-01', CAST(2 * (doc_id div 400) AS INT))")
    responses = j.select(F.concat(F.col("lang"), F.lit(" NEAR "), F.col("source")).alias("query"),
                         F.date_format(window, "yyyy-MM-dd").alias("win_start"),
                         F.to_json(F.struct(F.array(item).alias("articles"))).alias("response"))
    arts = news_articles(responses, p)
    return arts.select("query", "win_start", "url", "title", F.date_format("published", "yyyy-MM-dd").alias("published"),
                       F.md5("content").alias("content_md5"))


# ------------------------------------------------------------------ site load composite
def _site_sql() -> str:
    return f"""
WITH RECURSIVE pg AS {_CHAIN_SQL},
cards AS (
  SELECT d.doc_id, 'https://site.example/p/' || CAST(d.doc_id % (SELECT count(*) FROM pages) AS VARCHAR) AS link,
         nullif(replace(split_part(d.text, '.', 1), '"', '') || ' it''s', '') AS title,
         TIMESTAMP '2024-01-01 08:30:00' + to_hours(CAST(d.doc_id * 7919 % 2000 AS BIGINT)) AS wall,
         TIMESTAMP '2024-01-01 08:30:00' + to_hours(CAST(d.doc_id * 7919 % 2000 AS BIGINT))
           + CASE WHEN d.doc_id % 2 = 0 THEN to_hours(-3) ELSE to_hours(5) END AS utc
  FROM documents d WHERE d.doc_id % 3 <> 0),
inwin AS (SELECT * FROM cards WHERE utc BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-02-15 00:00:00'),
walk(start_url, final_url, seen, hops, round) AS (
  SELECT DISTINCT link, link, [link], 0, false FROM inwin{_WALK_SQL}
SELECT c.link AS url, c.title, strftime(c.wall, '%Y-%m-%d %H:%M:%S') AS published, CASE WHEN NOT fin.round THEN pg.body END AS content
FROM inwin c JOIN fin ON fin.start_url = c.link LEFT JOIN pg ON pg.url = fin.final_url"""


@register("site_articles", _site_sql())
def site_articles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site load (H4, H5, D2, P9, P16, H6, H1): listing cards composed from the documents link
    into the stored pages, which hold chains of links; cards in the window follow them."""
    from .composites import site_articles
    d = table(spark, sf_dir, "documents")
    npages = table(spark, sf_dir, "pages").count()
    title = F.concat(F.replace(F.split_part(F.col("text"), F.lit("."), F.lit(1)), F.lit('"'), F.lit("")), F.lit(" it's"))
    ts = F.expr("TIMESTAMP '2024-01-01 08:30:00' + make_interval(0, 0, 0, 0, CAST(doc_id * 7919 % 2000 AS INT), 0, 0)")
    date = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.col("doc_id") % 2 == 0, F.lit("+03:00")).otherwise(F.lit("-05:00")))
    abbr = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit('<abbr class="date time published updated" title="'), date, F.lit('">d</abbr>')))
    html = F.concat(F.lit('<article class="post"><h2><a rel="bookmark" href="/p/'),
                    (F.col("doc_id") % F.lit(npages)).cast("string"), F.lit('" title="'), title,
                    F.lit('">x</a></h2>'), abbr, F.lit("</article>"))
    listings = d.select(F.concat(F.lit("https://site.example/list/"), F.col("lang")).alias("url"), html.alias("html"))
    start = F.lit("2024-01-02 00:00:00").cast("timestamp")
    end = F.lit("2024-02-15 00:00:00").cast("timestamp")
    arts = site_articles(listings, _chain_pages(spark, sf_dir), start, end)
    return arts.select("url", "title", F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"),
                       "content")


# ------------------------------------------------------------------ USD by model
def _usd_responder(prompts: pd.Series) -> pd.Series:
    """A pure stand-in for the model: the first number of the amount, times 1000, quoted."""
    import re

    def answer(p: str) -> str:
        m = re.search(r"\d+", p.rsplit("\n", 1)[-1])
        return f' "${int(m.group(0)) * 1000}" ' if m else "0"
    return prompts.map(answer)


@register("usd_by_model", """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 0.0
                        ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) * 1000 AS DOUBLE) END AS usd
FROM orders""")
def usd_by_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """USD by model (T13, E1, J6, T14, M1): one request per amount text, a pure
    responder, its quoted dollar reply read with M1 (no number -> 0)."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 13 == 0, F.lit("not disclosed")).otherwise(
        F.concat(F.lit("about "), F.floor("o_totalprice").cast("bigint").cast("string"), F.lit(" thousand dollars")))
    rows = o.select("o_orderkey", text.alias("amount_text"))
    out, _ = E.usd_by_model(rows, _usd_responder, "o_orderkey")
    return out.select("o_orderkey", "usd")
