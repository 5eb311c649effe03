"""Page extraction over a stored ``pages(url, html)`` table (H1-H8).

Nothing is fetched: the crawl is re-aimed as scans of stored pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.html import (
    absolute_url, attribute, drop_noise, element_html, element_text, first_element_text, paragraphs_text,
)
from ..session import cut_lineage
from .joins import exploded

MAIN_SELECTORS = [("article", None), ("main", None), ("section", "entry")]
FULL_REPORT_TEXT = "Click here to read the full report."


def listing_cards(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """H4 + H5 + D2 + P16: one row per ``<article>`` card with a bookmark link and a date.

    Output ``(listing_url, link, title, published_wall, published_utc)``;
    cards missing either the link or the date are skipped.
    """
    found = F.regexp_extract_all(drop_noise(F.col(html_col)), F.lit(r"(?is)<article\b.*?</article\s*>"), 0)
    cards = exploded(pages, [F.col(url_col).alias("listing_url")], found, "_n", "card")
    # rel and class are lists of words: the words looked for may stand among others
    a_tag = F.regexp_extract("card", r"""(?is)(<a\s(?:[^>]*[\s"'])?rel\s*=\s*(?:"(?:[^">]*\s)?bookmark(?:\s[^">]*)?"|'(?:[^'>]*\s)?bookmark(?:\s[^'>]*)?'|bookmark(?=[\s>]))[^>]*>)""", 1)
    abbr = F.regexp_extract("card", r"""(?is)(<abbr\s(?=[^>]*\bclass\s*=\s*["'][^"'>]*\bpublished\b)(?=[^>]*\bclass\s*=\s*["'][^"'>]*\bdate\b)[^>]*>)""", 1)
    href, title, when = attribute(a_tag, "href"), attribute(a_tag, "title"), attribute(abbr, "title")
    out = cards.select("listing_url", F.nullif(href, F.lit("")).alias("href"),
                       F.nullif(title, F.lit("")).alias("title"), F.nullif(when, F.lit("")).alias("date_text"))
    out = out.dropna(how="any", subset=["href", "date_text"])
    return out.select("listing_url", absolute_url(F.col("listing_url"), F.col("href")).alias("link"), "title",
                      D.iso_offset_wall_time(F.col("date_text")).alias("published_wall"),
                      D.iso_offset_instant(F.col("date_text")).alias("published_utc"))


def in_window(cards: DataFrame, start, end, col: str = "published_utc") -> DataFrame:
    """Cards dated within [start, end]."""
    return cards.filter(F.col(col).between(start, end))


def article_body(pages: DataFrame, html_col: str = "html", tag: str = "section", css_class: str | None = "entry",
                 compat_not_found: bool = False) -> DataFrame:
    """H1 + H2: text of the first ``tag.class`` element; missing -> null
    (``compat_not_found=True``: the text ``Not found``). A page that is not
    stored (null HTML) gives null either way."""
    body = element_text(F.col(html_col), tag, css_class)
    if compat_not_found:
        body = F.coalesce(body, F.when(F.col(html_col).isNotNull(), F.lit("Not found")))
    return pages.withColumn("body", body)


def main_text(pages: DataFrame, html_col: str = "html", selectors=MAIN_SELECTORS) -> DataFrame:
    """H7: main article text by selector list, else all paragraphs, else null."""
    t = first_element_text(F.col(html_col), selectors)
    p = F.nullif(paragraphs_text(F.col(html_col)), F.lit(""))
    return pages.withColumn("main_text", F.coalesce(t, p))


def report_link(html_col: str = "html", link_text: str = FULL_REPORT_TEXT, tag: str = "section",
                css_class: str | None = "entry") -> F.Column:
    """href of the anchor, inside the body element, whose text is the "full report" sentence, else null."""
    pat = r"(?is)(<a\s[^>]*>)\s*" + link_text.replace(".", r"\.") + r"\s*</a>"
    return F.nullif(attribute(F.regexp_extract(element_html(F.col(html_col), tag, css_class), pat, 1), "href"), F.lit(""))


def one_per_url(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(url, html)``, one row per URL: of several stored copies the one with the smallest content hash."""
    pick = F.min_by(F.col(html_col), F.xxhash64(html_col))
    return pages.filter(F.col(url_col).isNotNull()).groupBy(F.col(url_col).alias("url")).agg(pick.alias("html"))


def follow_report_links(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                        starts: DataFrame | None = None) -> DataFrame:
    """H6 + J10: follow "full report" links through the stored pages, however long the chain.

    The links of the stored pages form a table ``url -> next``. Pointer
    doubling: each round replaces every pointer by its target's pointer, so
    ``r`` rounds follow ``2**r`` links; it ends when no pointer moves, after
    log2 of the longest chain. A chain that comes back to one of its own
    URLs has no text: its pointers never reach an end, and after as many
    links as there are pages they are known to run in a cycle and become
    null. ``starts`` (one column of URLs) limits the output to those start
    pages; by default every stored page starts one. Output ``(start_url,
    final_url, hops)``; ``final_url`` is null for a cycle (``hops`` too) and
    is not a stored page where a link leads outside the table. Each round is
    checkpointed to the shared folder.
    """
    found = pages.select(F.col(url_col).alias("u"), report_link(html_col).alias("rel"))
    # a URL that is stored twice keeps one link; the HTML is parsed once, for all rounds
    links = cut_lineage(found.groupBy("u").agg(F.min("rel").alias("rel")).filter("u IS NOT NULL AND rel IS NOT NULL"))
    links = links.select("u", absolute_url(F.col("u"), F.col("rel")).alias("nxt"))
    state = cut_lineage(links.select("u", F.col("nxt").alias("to"), F.lit(1).cast("bigint").alias("hops")))
    n_links, reach = state.count(), 1
    while reach <= n_links:
        ahead = state.select(F.col("u").alias("to"), F.col("to").alias("further"), F.col("hops").alias("more"))
        moved = state.join(ahead, "to", "left")
        if moved.filter("further IS NOT NULL").isEmpty():
            break
        state = cut_lineage(moved.select("u", F.coalesce("further", "to").alias("to"),
                                         (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops")))
        reach *= 2
    # whatever still points at a page with a link has gone round
    ends = state.join(links.select(F.col("u").alias("to"), F.lit(True).alias("cycle")).distinct(), "to", "left")
    first = (pages.select(F.col(url_col).alias("start_url")) if starts is None
             else starts.select(F.col(starts.columns[0]).alias("start_url"))).filter("start_url IS NOT NULL").distinct()
    out = first.join(ends.withColumnRenamed("u", "start_url"), "start_url", "left")
    cycle = F.coalesce("cycle", F.lit(False))
    return out.select("start_url", F.when(~cycle, F.coalesce("to", "start_url")).alias("final_url"),
                      F.when(~cycle, F.coalesce("hops", F.lit(0))).cast("bigint").alias("hops"))


def followed_text(pages: DataFrame, tag: str = "section", css_class: str | None = "entry",
                  compat_not_found: bool = False, starts: DataFrame | None = None) -> DataFrame:
    """H1 + H2 + H6: the body text reached by following "full report" links.

    ``(start_url, final_url, hops, body)``; ``body`` is null for a cycle and
    when the last link points to a page that is not stored; a stored page
    without such an element gives null (``compat_not_found=True``: the text
    ``Not found``).
    """
    chains = follow_report_links(pages, starts=starts)
    # join the pages reached first, then extract: only those pages are parsed
    wanted = chains.filter("final_url IS NOT NULL").select(F.col("final_url").alias("url")).distinct()
    stored = one_per_url(pages.join(wanted, "url", "left_semi")).withColumnRenamed("url", "final_url")
    reached = chains.join(stored, "final_url", "left").select("start_url", "final_url", "hops", "html")
    return article_body(reached, tag=tag, css_class=css_class, compat_not_found=compat_not_found).drop("html")


def replace_with_full_text(df: DataFrame, pages: DataFrame, url_col: str = "url",
                           check_col: str = "content_check", text_col: str = "content") -> DataFrame:
    """H8: relevant rows take the paragraph text of their stored page when it is not empty.

    Pages are joined first and parsed after, so only the pages of these rows are parsed.
    """
    stored = one_per_url(pages).select(F.col("url").alias("_u"), F.col("html").alias("_html"))
    # rows without a URL have no page: they meet none whatever their key is, so theirs spreads them over all tasks
    lone = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind]).cast("string"))
    keyed = df.withColumn("_key", F.coalesce(F.col(url_col), lone))
    j = (keyed.join(stored, keyed["_key"] == stored["_u"], "left").drop("_u", "_key")
         .withColumn("_html", F.when(F.col(url_col).isNotNull(), F.col("_html")))
         .withColumn("full_content", paragraphs_text(F.col("_html"))).drop("_html"))
    relevant = F.coalesce(F.lower(F.col(check_col)).contains("yes"), F.lit(False))
    use = relevant & F.coalesce(F.col("full_content") != "", F.lit(False))
    return j.withColumn(text_col, F.when(use, F.col("full_content")).otherwise(F.col(text_col)))
