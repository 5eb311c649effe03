"""Registered queries over the driver tables, each with a DuckDB oracle.

Every query reads whole driver tables (``documents``, ``pages``, ``part``,
``orders``, ...) - no id subsets, no caps - and returns a DataFrame whose
column names and types equal those of its oracle SQL. Inputs the driver
tables lack (model responses, money text, listing cards) are composed from
their columns with the same ``concat``/``CASE`` in both dialects.

This module holds the dictionary-match queries; the other areas live in the
``q_*`` modules, which register into the same tables on import.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import dictmatch as dm
from ..session import staged
from . import fixtures as fx
from .composites import label_and_gate
from .registry import ORACLES, QUERIES, WORD, articles, register, table  # noqa: F401

# ------------------------------------------------------------ SQL building blocks
def _sql_place_dictionary(gaz: str) -> str:
    cols = ["town_en", "town_ar", "admin3_en", "admin3_ar", "admin2_en", "admin2_ar"]
    names = "\n  UNION ALL ".join(
        f"SELECT loc_id, {i} AS col_idx, {c} AS name FROM {gaz} WHERE loc_id IS NOT NULL AND {c} IS NOT NULL"
        for i, c in enumerate(cols))
    return f"""
  (SELECT key, term, term_norm, n_tokens FROM (
     SELECT key, term, term_norm, n_tokens,
            row_number() OVER (PARTITION BY term_norm ORDER BY loc_id DESC, col_idx DESC, variant DESC) AS rn
     FROM (SELECT loc_id, col_idx, variant, CAST(loc_id AS VARCHAR) AS key, term,
                  array_to_string(regexp_extract_all(lower(term), '{WORD}'), ' ') AS term_norm,
                  len(regexp_extract_all(lower(term), '{WORD}')) AS n_tokens
           FROM (SELECT loc_id, col_idx, name AS term, 0 AS variant FROM ({names}) n
                 UNION ALL
                 SELECT loc_id, col_idx, replace(name, '-', ' '), 1 FROM ({names}) n WHERE contains(name, '-'))))
   WHERE rn = 1 AND n_tokens > 0)"""


def _sql_topic_dictionary(topics: str) -> str:
    return f"""
  (SELECT key, term, term_norm, n_tokens FROM (
     SELECT key, term, term_norm, n_tokens,
            row_number() OVER (PARTITION BY term_norm ORDER BY ord DESC, i DESC) AS rn
     FROM (SELECT ord, i, label AS key, term,
                  array_to_string(regexp_extract_all(lower(term), '{WORD}'), ' ') AS term_norm,
                  len(regexp_extract_all(lower(term), '{WORD}')) AS n_tokens
           FROM (SELECT ord, label, unnest(string_split(keywords, ' OR ')) AS term,
                        unnest(range(len(string_split(keywords, ' OR ')))) AS i
                 FROM {topics} WHERE keywords IS NOT NULL)))
   WHERE rn = 1 AND n_tokens > 0)"""


def _sql_hits(text_source: str, dicts: dict[str, str]) -> str:
    """Leftmost-longest hits for dictionaries of 1- and 2-token terms whose
    bigrams never chain (true for the fixtures): a bigram always wins; a
    unigram is a hit unless a bigram starts at it or just before it."""
    cand = "\n  UNION ALL ".join(
        f"SELECT '{name}' AS dict, k.doc_id, k.pos, d.n_tokens AS n, d.key, d.term FROM tk k JOIN {d} d "
        f"ON (d.n_tokens = 1 AND k.tok = d.term_norm) OR (d.n_tokens = 2 AND k.tok || ' ' || k.nxt = d.term_norm)"
        for name, d in dicts.items())
    return f"""
toks AS (
  SELECT doc_id, unnest(t) AS tok, unnest(range(len(t))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(txt), '{WORD}') AS t FROM ({text_source}) s WHERE txt IS NOT NULL)),
tk AS (SELECT doc_id, pos, tok, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM toks),
cand AS ({cand}),
hits AS (
  SELECT c.* FROM cand c
  WHERE c.n = 2 OR NOT EXISTS (
    SELECT 1 FROM cand b WHERE b.dict = c.dict AND b.doc_id = c.doc_id AND b.n = 2
      AND (b.pos = c.pos OR b.pos = c.pos - 1)))"""


def _sql_winner(hits_dict: str = "place") -> str:
    return f"""
pk AS (SELECT doc_id, key, count(*) AS n, min(pos) AS first FROM hits WHERE dict = '{hits_dict}' GROUP BY doc_id, key),
pw AS (SELECT doc_id, key, n, first, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first ASC) AS rn FROM pk),
win AS (SELECT w.doc_id, w.key, h.term, w.n FROM pw w
        JOIN hits h ON h.dict = '{hits_dict}' AND h.doc_id = w.doc_id AND h.pos = w.first WHERE w.rn = 1)"""


GAZ_SQL = fx.values_sql(fx.GAZETTEER_ROWS, fx.GAZETTEER_SCHEMA)
TOPIC_SQL = fx.values_sql(fx.TOPIC_ROWS, fx.TOPIC_SCHEMA)
GATE_SQL = "['Project', 'Construction', 'Reconstruction', 'Build']"


# ------------------------------------------------------------ flagship
GATE_DOCUMENTS_SQL = f"""
WITH gaz AS (SELECT * FROM {GAZ_SQL}),
topics AS (SELECT * FROM {TOPIC_SQL}),
{_sql_hits("SELECT doc_id, text AS txt FROM documents",
           {"place": _sql_place_dictionary("gaz"), "topic": _sql_topic_dictionary("topics")})},
{_sql_winner()},
lab AS (SELECT doc_id, string_agg(key, ', ' ORDER BY pos) AS topic_terms FROM hits WHERE dict = 'topic' GROUP BY doc_id)
SELECT lab.doc_id, d.lang, CAST(win.key AS BIGINT) AS loc_id, win.term AS matched_term,
       g.loc_type, g.lat, g.lon, g.town_en, lab.topic_terms
FROM lab
JOIN documents d ON d.doc_id = lab.doc_id
LEFT JOIN win ON win.doc_id = lab.doc_id
LEFT JOIN gaz g ON g.loc_id = CAST(win.key AS BIGINT)
WHERE list_has_any(string_split(lab.topic_terms, ', '), {GATE_SQL})
"""


@register("gate_documents", GATE_DOCUMENTS_SQL)
def gate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: dictionary match + winner + gazetteer attributes + topic gate."""
    out = label_and_gate(articles(spark, sf_dir), fx.gazetteer(spark), fx.topics(spark))
    return out.select("doc_id", "lang", "loc_id", "matched_term", "loc_type", "lat", "lon",
                      "town_en", "topic_terms")


# ------------------------------------------------------------ J1 with character spans
@register("match_spans", f"""
WITH gaz AS (SELECT * FROM {GAZ_SQL}),
topics AS (SELECT * FROM {TOPIC_SQL}),
{_sql_hits("SELECT doc_id, text AS txt FROM documents",
           {"place": _sql_place_dictionary("gaz"), "topic": _sql_topic_dictionary("topics")})},
pieces AS (SELECT doc_id, unnest(w) AS tok, unnest(g[1:len(w)]) AS gap, unnest(range(len(w))) AS pos
           FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w, regexp_split_to_array(text, '{WORD}') AS g FROM documents)),
ends AS (SELECT doc_id, pos, length(tok) AS n, sum(length(gap) + length(tok)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM pieces)
SELECT h.doc_id, h.dict, h.key, h.term, CAST(h.pos AS INTEGER) AS start, CAST(h.pos + h.n AS INTEGER) AS "end",
       CAST(a.upto - a.n AS INTEGER) AS from_char, CAST(b.upto AS INTEGER) AS to_char,
       substr(d.text, CAST(a.upto - a.n AS BIGINT) + 1, CAST(b.upto - a.upto + a.n AS BIGINT)) AS spelling
FROM hits h JOIN documents d ON d.doc_id = h.doc_id
JOIN ends a ON a.doc_id = h.doc_id AND a.pos = h.pos JOIN ends b ON b.doc_id = h.doc_id AND b.pos = h.pos + h.n - 1""")
def match_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit of both dictionaries with its characters and the spelling found there."""
    docs = articles(spark, sf_dir).select("doc_id", "content")
    dictionary = dm.place_dictionary(fx.gazetteer(spark)).unionByName(dm.topic_dictionary(fx.topics(spark)))
    hits = staged(dm.match_terms(docs, dictionary, spans=True), "match-spans")
    return dm.with_spelling(hits, docs)


from . import q_text, q_nested, q_merge, q_pages, q_more, q_flows, q_sources  # noqa: E402,F401  (register on import)
