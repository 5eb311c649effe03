"""Registered queries: page text, links and listing cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import absolute_url, paragraphs_text
from ..operators.pages import listing_cards, main_text
from .registry import register, table

# The character references that occur in the stored pages, for the SQL side (``&amp;`` last, so that each is decoded once).
_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
_NOISE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"


def _sql_unescape(expr: str) -> str:
    for ent, ch in _REFERENCES:
        expr = f"replace({expr}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return expr


def _sql_strip(expr: str) -> str:
    return _sql_unescape(f"regexp_replace({expr}, '<[^>]+>', '', 'g')")


_PARAS_SQL = f"""
list_transform(
  list_slice(string_split(
    regexp_replace(regexp_replace(regexp_replace(html, '{_NOISE}', ' ', 'g'), '(?i)<p(\\s[^>]*)?>', chr(1), 'g'),
                   '(?i)</p\\s*>|</article\\s*>|</section\\s*>|</div\\s*>|</body\\s*>', chr(2), 'g'),
    chr(1)), 2, 2147483647),
  lambda s: {_sql_strip("split_part(s, chr(2), 1)")})"""


@register("paragraph_text", f"""
SELECT page_id, CAST(len(paras) AS INTEGER) AS n_paragraphs, md5(array_to_string(paras, ' ')) AS text_md5,
       CAST(length(array_to_string(paras, ' ')) AS BIGINT) AS text_len
FROM (SELECT page_id, {_PARAS_SQL} AS paras FROM pages)""")
def paragraph_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: all ``<p>`` texts joined by a space (scripts, styles, comments cut first)."""
    p = table(spark, sf_dir, "pages")
    clean = F.regexp_replace(F.col("html"), _NOISE, " ")
    n = F.size(F.slice(F.split(F.regexp_replace(clean, r"(?i)<p(\s[^>]*)?>", "\u0001"), "\u0001"), 2, 1 << 30))
    t = paragraphs_text(F.col("html"))
    return p.select("page_id", n.alias("n_paragraphs"), F.md5(t).alias("text_md5"),
                    F.length(t).cast("bigint").alias("text_len"))


@register("article_text", f"""
SELECT page_id,
  md5(coalesce(
    CASE WHEN regexp_matches(regexp_replace(html, '{_NOISE}', ' ', 'g'), '(?is)<article\\b[^>]*>.*?</article\\s*>')
         THEN {_sql_strip(f"regexp_extract(regexp_replace(html, '{_NOISE}', ' ', 'g'), '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)")} END,
    nullif(array_to_string({_PARAS_SQL}, ' '), ''))) AS main_md5
FROM pages""")
def article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7 (+H1): first ``article`` / ``main`` / ``section.entry`` text, else paragraphs."""
    return main_text(table(spark, sf_dir, "pages")).select("page_id", F.md5("main_text").alias("main_md5"))


_HREF = r"""<a\s[^>]*href="([^"]*)\""""


@register("page_links", """
WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM pages),
v AS (SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN href WHEN 1 THEN '?q=' || substr(href, 2)
              WHEN 2 THEN '#' || substr(href, 2) WHEN 3 THEN '//cdn.example.org' || href
              ELSE 'https://abs.example.org' || href END AS rel FROM l),
b AS (SELECT *, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin,
             regexp_replace(url, '#.*$', '') AS no_frag FROM v)
SELECT page_id, rel,
  CASE WHEN regexp_matches(rel, '^https?://') THEN rel
       WHEN starts_with(rel, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || rel
       WHEN starts_with(rel, '/') THEN origin || rel
       WHEN starts_with(rel, '?') THEN regexp_replace(no_frag, '\\?.*$', '') || rel
       WHEN starts_with(rel, '#') THEN no_frag || rel END AS link
FROM b""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: every link of every page resolved against the page URL (5 link forms)."""
    p = table(spark, sf_dir, "pages")
    l = p.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(_HREF), 1)).alias("href"))
    k = F.col("page_id") % 5
    rest = F.substring("href", 2, 1 << 30)
    rel = (F.when(k == 0, F.col("href")).when(k == 1, F.concat(F.lit("?q="), rest))
           .when(k == 2, F.concat(F.lit("#"), rest)).when(k == 3, F.concat(F.lit("//cdn.example.org"), F.col("href")))
           .otherwise(F.concat(F.lit("https://abs.example.org"), F.col("href"))))
    v = l.select("page_id", "url", rel.alias("rel"))
    return v.select("page_id", "rel", absolute_url(F.col("url"), F.col("rel")).alias("link"))


_CARD_SQL_INPUT = """
SELECT doc_id, 'https://site.example/list/' || lang AS listing_url,
  '<article class="post"><h2><a rel="bookmark" href="/news/' || CAST(doc_id AS VARCHAR) || '" title="' ||
  replace(split_part(text, '.', 1), '"', '') || '">x</a></h2>' ||
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE '<abbr class="date time published updated" title="' ||
       strftime(TIMESTAMP '2024-01-01 08:30:00' + to_hours(CAST(doc_id AS BIGINT)), '%Y-%m-%dT%H:%M:%S') ||
       CASE WHEN doc_id % 2 = 0 THEN '+03:00' ELSE '-05:00' END || '">d</abbr>' END || '</article>' AS html
FROM documents"""


@register("listing_cards", f"""
WITH c AS ({_CARD_SQL_INPUT})
SELECT listing_url, 'https://site.example/news/' || CAST(doc_id AS VARCHAR) AS link,
  nullif(replace(split_part(text, '.', 1), '"', ''), '') AS title,
  strftime(TIMESTAMP '2024-01-01 08:30:00' + to_hours(CAST(doc_id AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS published_wall,
  strftime(TIMESTAMP '2024-01-01 08:30:00' + to_hours(CAST(doc_id AS BIGINT))
           + CASE WHEN doc_id % 2 = 0 THEN to_hours(-3) ELSE to_hours(5) END, '%Y-%m-%d %H:%M:%S') AS published_utc
FROM c JOIN documents USING (doc_id)
WHERE doc_id % 3 <> 0
  AND TIMESTAMP '2024-01-01 08:30:00' + to_hours(CAST(doc_id AS BIGINT))
      + CASE WHEN doc_id % 2 = 0 THEN to_hours(-3) ELSE to_hours(5) END >= TIMESTAMP '2024-01-02 00:00:00'""")
def listing_cards_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4 + H5 + D2 + P9 + P16 on listing pages composed from the documents.

    A card without its date (every third) is skipped; cards dated before
    the start are dropped.
    """
    d = table(spark, sf_dir, "documents")
    title = F.replace(F.split_part(F.col("text"), F.lit("."), F.lit(1)), F.lit('"'), F.lit(""))
    ts = F.expr("TIMESTAMP '2024-01-01 08:30:00' + make_interval(0, 0, 0, 0, CAST(doc_id AS INT), 0, 0)")
    date = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.col("doc_id") % 2 == 0, F.lit("+03:00")).otherwise(F.lit("-05:00")))
    abbr = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit('<abbr class="date time published updated" title="'), date, F.lit('">d</abbr>')))
    html = F.concat(F.lit('<article class="post"><h2><a rel="bookmark" href="/news/'), F.col("doc_id").cast("string"),
                    F.lit('" title="'), title, F.lit('">x</a></h2>'), abbr, F.lit("</article>"))
    pages = d.select(F.concat(F.lit("https://site.example/list/"), F.col("lang")).alias("url"), html.alias("html"))
    cards = listing_cards(pages)
    cards = cards.filter(F.col("published_utc") >= F.lit("2024-01-02 00:00:00").cast("timestamp"))
    return cards.select("listing_url", "link", "title",
                        F.date_format("published_wall", "yyyy-MM-dd HH:mm:ss").alias("published_wall"),
                        F.date_format("published_utc", "yyyy-MM-dd HH:mm:ss").alias("published_utc"))
