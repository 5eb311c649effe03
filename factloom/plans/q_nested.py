"""Registered queries: model-response extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import PROJECT_FIELDS
from ..operators.nested import explode_projects, extract_fields, zip_explode
from .registry import register, table

FIELDS = [name for name, _ in PROJECT_FIELDS]


# p_partkey % 7, the value as written in the response, and as read
_LITERALS = [(1, "'see }} here {i}'", "see } here {i}"), (2, "{{'Note': 'x{i}', 'n': [1, 2]}}", '{{"Note":"x{i}","n":[1,2]}}'),
             (3, "['a {i}', 'b', 3]", "a {i}, b, 3"), (4, "('c' ' {i}', None)", "c {i}, None"), (5, "'two ' \"words' {i}\"", "two words' {i}")]


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def _response_column(quirks: bool, literals: bool = False) -> F.Column:
    """Compose a stored response per ``part`` row: ``p_partkey % 4`` dicts.

    Dict 1 lacks the funder when ``p_partkey % 5 = 0``; dict 0 uses the
    alternative key ``Location`` when ``p_partkey % 6 = 1``. With
    ``quirks``: a value with an apostrophe (double-quoted, as Python prints
    it) when ``p_partkey % 6 = 0``, a bare ``None`` when ``p_partkey % 7 =
    0``, and a ``key - value`` text instead of dicts when there are none.
    With ``literals`` the last value may hold a brace, be a dict, a list or a
    tuple, or be written as two strings.
    """
    k = F.col("p_partkey") % 4
    pk = F.col("p_partkey")
    dicts = []
    for i in range(3):
        loc_key = F.when((pk % 6 == 1) & F.lit(i == 0), F.lit("Location")).otherwise(F.lit("Location of project"))
        what = F.concat(F.lit("'What is being built': '"), F.col("p_name"), F.lit(f" {i}'"))
        if quirks:
            what = F.when(pk % 6 == 0, F.concat(F.lit("'What is being built': \"Al's "), F.col("p_name"),
                                                F.lit(f' {i}"'))).otherwise(what)
        additional = F.lit(f"'Additional': 'note {i}'")
        if quirks:
            additional = F.when(pk % 7 == 0, F.lit("'Additional': None")).otherwise(additional)
        if literals:
            for rest, written, _ in _LITERALS:
                additional = F.when(pk % 7 == rest, F.lit(f"'Additional': {written.format(i=i)}")).otherwise(additional)
        parts = [
            F.concat(F.lit("'"), loc_key, F.lit(f"': 'Town{i} "), _s("p_size"), F.lit("'")),
            what,
            F.when((pk % 5 == 0) & F.lit(i == 1), F.lit(None).cast("string")).otherwise(
                F.concat(F.lit("'Who is funding the project': '"), F.col("p_brand"), F.lit(f"/{i}'"))),
            F.concat(F.lit("'Amount of money being spent': '$"), _s("p_size"), F.lit(" million'")),
            F.concat(F.lit("'Category of project that is being constructed': '"), F.col("p_type"), F.lit("'")),
            F.lit(f"'Expected completion date': '202{i}'"),
            additional,
        ]
        dicts.append(F.when(k > i, F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))))
    resp = F.concat(F.lit("["), F.concat_ws(", ", *dicts), F.lit("]"))
    if quirks:
        lines = F.concat(F.lit("Project: P"), _s("p_partkey"), F.lit("\nLocation of project - Town "),
                         _s("p_size"), F.lit("\nWhat is being built - bridge: new"))
        resp = F.when(k == 0, lines).otherwise(resp)
    return resp


def _sql_response(quirks: bool) -> str:
    dicts = []
    for i in range(3):
        loc_key = f"CASE WHEN p_partkey % 6 = 1 AND {i} = 0 THEN 'Location' ELSE 'Location of project' END"
        what = f"'''What is being built'': ''' || p_name || ' {i}'''"
        if quirks:
            what = f"CASE WHEN p_partkey % 6 = 0 THEN '''What is being built'': \"Al''s ' || p_name || ' {i}\"' ELSE {what} END"
        additional = f"'''Additional'': ''note {i}'''"
        if quirks:
            additional = f"CASE WHEN p_partkey % 7 = 0 THEN '''Additional'': None' ELSE {additional} END"
        parts = [
            f"'''' || {loc_key} || ''': ''Town{i} ' || CAST(p_size AS VARCHAR) || ''''",
            what,
            f"CASE WHEN p_partkey % 5 = 0 AND {i} = 1 THEN NULL ELSE '''Who is funding the project'': ''' || p_brand || '/{i}''' END",
            "'''Amount of money being spent'': ''$' || CAST(p_size AS VARCHAR) || ' million'''",
            "'''Category of project that is being constructed'': ''' || p_type || ''''",
            f"'''Expected completion date'': ''202{i}'''",
            additional,
        ]
        dicts.append(f"CASE WHEN p_partkey % 4 > {i} THEN '{{' || concat_ws(', ', {', '.join(parts)}) || '}}' END")
    return "'[' || concat_ws(', ', " + ", ".join(dicts) + ") || ']'"


# ------------------------------------------------------------------ L1-L3
_ZIP_SQL = """
WITH p AS (SELECT p_partkey, p_partkey % 4 AS k, p_partkey % 6 = 1 AS alt, p_partkey % 5 = 0 AS miss,
                  p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS sz FROM part),
l AS (SELECT p_partkey,
  list_concat(
    list_filter([CASE WHEN k > 0 AND NOT alt THEN 'Town0 ' || sz END,
                 CASE WHEN k > 1 THEN 'Town1 ' || sz END, CASE WHEN k > 2 THEN 'Town2 ' || sz END], lambda x: x IS NOT NULL),
    CASE WHEN alt AND k > 0 THEN ['Town0 ' || sz] ELSE [] END) AS location,
  list_filter([CASE WHEN k > 0 THEN p_name || ' 0' END, CASE WHEN k > 1 THEN p_name || ' 1' END,
               CASE WHEN k > 2 THEN p_name || ' 2' END], lambda x: x IS NOT NULL) AS what_built,
  list_filter([CASE WHEN k > 0 THEN p_brand || '/0' END, CASE WHEN k > 1 AND NOT miss THEN p_brand || '/1' END,
               CASE WHEN k > 2 THEN p_brand || '/2' END], lambda x: x IS NOT NULL) AS funder,
  list_filter([CASE WHEN k > 0 THEN '$' || sz || ' million' END, CASE WHEN k > 1 THEN '$' || sz || ' million' END,
               CASE WHEN k > 2 THEN '$' || sz || ' million' END], lambda x: x IS NOT NULL) AS amount_text,
  list_filter([CASE WHEN k > 0 THEN p_type END, CASE WHEN k > 1 THEN p_type END,
               CASE WHEN k > 2 THEN p_type END], lambda x: x IS NOT NULL) AS category_text,
  list_filter([CASE WHEN k > 0 THEN '2020' END, CASE WHEN k > 1 THEN '2021' END,
               CASE WHEN k > 2 THEN '2022' END], lambda x: x IS NOT NULL) AS expected_completion,
  list_filter([CASE WHEN k > 0 THEN 'note 0' END, CASE WHEN k > 1 THEN 'note 1' END,
               CASE WHEN k > 2 THEN 'note 2' END], lambda x: x IS NOT NULL) AS additional
  FROM p),
z AS (SELECT *, greatest(len(location), len(what_built), len(funder), len(amount_text), len(category_text),
                         len(expected_completion), len(additional)) AS n FROM l)
SELECT p_partkey, CAST(i AS INTEGER) AS ordinal,
  location[i + 1] AS location, what_built[i + 1] AS what_built, funder[i + 1] AS funder,
  amount_text[i + 1] AS amount_text, category_text[i + 1] AS category_text,
  expected_completion[i + 1] AS expected_completion, additional[i + 1] AS additional
FROM (SELECT *, unnest(range(n)) AS i FROM z WHERE n > 0)"""


@register("zip_explode", _ZIP_SQL)
def zip_explode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + L2 + L3: regex-collected field lists zipped by position."""
    p = table(spark, sf_dir, "part").select("p_partkey", _response_column(False).alias("summaries"))
    return zip_explode(extract_fields(p, "summaries"), FIELDS, ["p_partkey"])


# ------------------------------------------------------------------ L4-L6
def _literal_sql(read: str) -> str:
    return "replace('" + read.replace("'", "''").replace("{{", "{").replace("}}", "}").replace("{i}", "@") + "', '@', CAST(i AS VARCHAR))"


_LITERALS_SQL = "\n       ".join(f"WHEN {rest} THEN {_literal_sql(read)}" for rest, _, read in _LITERALS)
_PARSE_SQL = f"""
WITH p AS (SELECT p_partkey, p_partkey % 4 AS k, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS sz FROM part)
SELECT p_partkey, CAST(i AS INTEGER) AS ordinal,
  'Town' || CAST(i AS VARCHAR) || ' ' || sz AS location,
  CASE WHEN p_partkey % 6 = 0 THEN 'Al''s ' || p_name || ' ' || CAST(i AS VARCHAR)
       ELSE p_name || ' ' || CAST(i AS VARCHAR) END AS what_built,
  CASE WHEN p_partkey % 5 = 0 AND i = 1 THEN NULL ELSE p_brand || '/' || CAST(i AS VARCHAR) END AS funder,
  '$' || sz || ' million' AS amount_text,
  p_type AS category_text,
  '202' || CAST(i AS VARCHAR) AS expected_completion,
  CASE p_partkey % 7 WHEN 0 THEN NULL
       {_LITERALS_SQL} ELSE 'note ' || CAST(i AS VARCHAR) END AS additional
FROM (SELECT *, unnest(range(k)) AS i FROM p WHERE k > 0)
UNION ALL
SELECT p_partkey, 0, 'Town ' || sz, 'new', NULL, NULL, NULL, NULL, NULL FROM p WHERE k = 0"""


@register("parse_projects", _PARSE_SQL)
def parse_projects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + L5 + L6: each dict parsed as one project, with braces in quotes, dicts, lists and tuples as values; text fallback."""
    p = table(spark, sf_dir, "part").select("p_partkey", _response_column(True, True).alias("summaries"))
    return explode_projects(p, "summaries", ["p_partkey"])
