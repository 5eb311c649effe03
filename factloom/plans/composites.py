"""Composite operators: the multi-step flows as one call each.

* ``document_matches`` - per document: winning place with attributes and
  topic labels (dictionary match, context rule, winner, gazetteer join);
* ``label_and_gate`` - news / social / file pre-filter (the above + gate);
* ``geocode`` - the same machinery on an extracted location text;
* ``project_facts`` - parse projects, evidence, geocode, labels, score, USD;
* ``news_articles`` / ``site_articles`` - the two source loaders;
* the daily merge lives in ``plans.daily``, the merge rule in ``operators.merge``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import GATE_LABELS, SPECIAL_TERMS
from ..operators import dictmatch as dm
from ..operators.joins import checked_broadcast
from ..session import cut_lineage

LOCATION_COLUMNS = ["loc_id", "matched_term", "loc_type", "lat", "lon", "town_en", "town_ar",
                    "admin3_en", "admin3_ar", "admin2_en", "admin2_ar"]


def document_matches(articles: DataFrame, gazetteer: DataFrame, topics: DataFrame | None,
                     id_col: str = "doc_id", text_col: str = "content",
                     special_terms=SPECIAL_TERMS, compat: bool = False,
                     gazetteer_id: str = "loc_id", topic_keywords: str = "keywords") -> DataFrame:
    """Per document: winning place (with attributes) and topic labels.

    Returns one row per document that has any hit:
    ``doc_id, loc_id, matched_term, loc_type, lat, lon, <6 names>, topic_terms``.
    The documents are scanned once for matching (and once more, only for
    documents holding a special term, by the context rule).
    """
    places = dm.place_dictionary(gazetteer, id_col=gazetteer_id, special_terms=special_terms)
    dictionary = places
    if topics is not None:
        dictionary = places.unionByName(dm.topic_dictionary(topics, keywords_col=topic_keywords))
    dictionary, info = dm.index_terms(dictionary, articles, text_col, special_terms=special_terms)
    hits = dm.match_entries(articles, dictionary, id_col=id_col, text_col=text_col, info=info)
    terms = dm.per_term(hits, dm.entry_names(dictionary, info))
    if info.has_special:
        terms = dm.suppress_ambiguous(cut_lineage(terms), articles, id_col=id_col, text_col=text_col,
                                      special_terms=special_terms, compat=compat)
    summary = dm.summarize(terms)
    if topics is None:
        summary = summary.filter(F.col("matched_key").isNotNull())
    out = dm.attach_locations(summary, gazetteer, id_col=gazetteer_id)
    cols = ["doc_id", F.col(gazetteer_id).alias("loc_id"), "matched_term",
            *[c for c in LOCATION_COLUMNS if c not in ("loc_id", "matched_term")]]
    return out.select(*cols, "topic_terms") if topics is not None else out.select(*cols)


def label_and_gate(articles: DataFrame, gazetteer: DataFrame, topics: DataFrame,
                   id_col: str = "doc_id", text_col: str = "content",
                   gate_labels=GATE_LABELS, special_terms=SPECIAL_TERMS, compat: bool = False,
                   materialize: bool = True) -> DataFrame:
    """News / social / file pre-filter: keep articles whose topic labels pass the gate.

    Output: the article columns plus the location columns and ``topic_terms``.
    The per-document summary is small next to the articles (only gated
    documents); it is checkpointed to the shared folder, counted, and
    broadcast back onto the articles only when under the bound, so the
    article table is not shuffled.
    """
    arts = articles.filter(F.col(text_col).isNotNull())           # P4
    summary = document_matches(arts, gazetteer, topics, id_col, text_col, special_terms, compat)
    gated = summary.filter(dm.passes_gate(F.col("topic_terms"), gate_labels))
    gated = gated.withColumnRenamed("doc_id", id_col)
    if materialize:
        gated = cut_lineage(gated)
        gated = checked_broadcast(gated)
    # gated ids all have text, so the join needs no second look at the text
    # column: the scan reads only the columns the caller keeps
    return articles.join(gated, id_col, "inner")


def geocode(rows: DataFrame, gazetteer: DataFrame, id_col: str, text_col: str = "location",
            special_terms=SPECIAL_TERMS, compat: bool = False, keep: str = "all",
            materialize: bool = True) -> DataFrame:
    """Geocode a location text column by the gazetteer.

    ``keep='matched'`` keeps only rows with a match (the reference's filter).
    Location columns already on ``rows`` (e.g. the article-level match of
    the pre-filter) are replaced by this match.
    """
    rows = rows.drop(*[c for c in LOCATION_COLUMNS if c in rows.columns])
    m = document_matches(rows, gazetteer, None, id_col=id_col, text_col=text_col,
                         special_terms=special_terms, compat=compat)
    m = m.withColumnRenamed("doc_id", id_col)
    if materialize:
        # one row per matched input row: checkpointed, measured, broadcast when small
        m = checked_broadcast(cut_lineage(m))
    how = "inner" if keep == "matched" else "left"
    return rows.join(m, id_col, how)


def project_facts(articles: DataFrame, gazetteer: DataFrame, label_report: DataFrame | None = None,
                  id_col: str = "doc_id", text_col: str = "content", response_col: str = "summaries",
                  parse: str = "dicts", compat: bool = False, keep: str = "matched",
                  materialize: bool = True, usd_from: str = "amount_text") -> DataFrame:
    """Stored responses -> one geocoded, labelled, scored row per project.

    ``parse='dicts'`` reads each dict as one project (L4-L6); ``'zip'``
    collects each field by regex and zips by position (L1-L3, the original
    rule). Then: presence flags (T2) and evidence (T6) against ``text_col``,
    geocoding of the location (keep only matched rows by default, P7),
    labels (J5, or rules only without a report), completeness score (T11),
    year (D4) and USD (null -> 0): ``usd_from='amount_text'`` reads the
    amount text with M1, a column name (e.g. ``usd_reply`` from
    ``enrich.usd_by_model``) reads that column with M1, and ``'spans'``
    takes the largest converted amount in the amount text (M2-M5).
    """
    from ..functions.constants import SCORE_FIELDS
    from ..functions.labels import category_by_rules, completeness_score
    from ..functions.money import usd_from_text, usd_or_zero
    from ..operators.labels import label_map, match_labels
    from ..operators.nested import project_arrays, projects_with_evidence

    rows = projects_with_evidence(project_arrays(articles, response_col, parse), id_col, text_col, compat)
    rows = rows.withColumn("project_id", F.sha2(F.to_json(F.struct(F.col(id_col), F.col("ordinal"))), 256))
    if materialize:
        # the project table is a stage without texts: parsed once, read by the geocoder and the output
        rows = cut_lineage(rows)
    rows = geocode(rows, gazetteer, id_col="project_id", text_col="location", compat=compat, keep=keep, materialize=materialize)
    if label_report is not None:
        rows = match_labels(rows, label_map(label_report), "category_text")
    else:
        rows = rows.withColumns({"category_0": category_by_rules(F.col("category_text")),
                                 "category_1": F.lit(None).cast("string")})
    # the article columns are joined last; the articles stay where they are if the projects are proven small
    if materialize:
        rows = checked_broadcast(cut_lineage(rows))
    kept = [c for c in articles.columns if c == id_col or c not in rows.columns]
    rows = articles.select(*kept).join(rows, id_col)
    return rows.withColumns({
        "sort_score": completeness_score(*SCORE_FIELDS),
        "year": F.year("published"),
        "usd": (F.coalesce(usd_from_text(F.col("amount_text")), F.lit(0.0)) if usd_from == "spans"
                else usd_or_zero(F.col(usd_from))),
    })


def news_articles(responses: DataFrame, pages: DataFrame | None = None, max_records: int = 250,
                  response_col: str = "response", source: str = "news") -> DataFrame:
    """News load: stored API responses per (query, window) -> articles.

    S1 parse; O3 newest ``max_records`` per (query, window) (a
    ``WindowGroupLimit`` plan); A4 one article per title inside each
    result, the newest kept; D1 date; H7 main text of the stored page with
    the same URL (P15: a non-empty page text replaces the feed text).
    ``responses`` holds ``query``, ``win_start`` and ``response``.
    """
    from ..functions.dates import seendate_to_date
    from ..operators.merge import top_k_per_group
    from ..operators.pages import main_text, one_per_url
    from ..sources.feeds import NEWS_RESPONSE, article_id

    items = (responses.select("query", "win_start", F.from_json(F.col(response_col), NEWS_RESPONSE).alias("r"))
             .select("query", "win_start", F.explode("r.articles").alias("a"))
             .select("query", "win_start", "a.*"))
    newest = [F.col("seendate").desc(), F.col("url"), F.col("title")]
    top = top_k_per_group(items, ["query", "win_start"], newest, max_records, name="_rank")
    first_title = top_k_per_group(top, ["query", "win_start", "title"], [F.col("_rank")], 1, name="_t")
    arts = first_title.select(
        article_id(F.lit(source), F.col("url"), F.col("title")).alias("doc_id"), F.lit(source).alias("source"),
        "query", "win_start", "url", "title", "content", seendate_to_date(F.col("seendate")).alias("published"))
    if pages is None:
        return arts
    # join the stored pages first, then extract: only the pages of these articles are parsed
    stored = one_per_url(pages).select(F.col("url").alias("_u"), "html")
    j = main_text(arts.join(stored, arts["url"] == stored["_u"], "left").drop("_u"))
    return (j.withColumn("content", F.coalesce(F.nullif(F.col("main_text"), F.lit("")), F.col("content")))
            .drop("main_text", "html"))


def site_articles(listings: DataFrame, pages: DataFrame, start, end,
                  compat_not_found: bool = False) -> DataFrame:
    """Site load: listing pages -> cards in the date window -> article text.

    H4 cards (link, title, date; incomplete cards skipped), D2/P9 window on
    the UTC instant, then H6 + H1: the ``section.entry`` text of the page
    reached by following "full report" links from the card's link (null when
    the page is not stored or the links run in a cycle; a stored page without
    the section gives null, or ``Not found`` with ``compat_not_found``). Output
    columns follow the article table (``published`` is the wall-clock
    time of the listing, its offset dropped).
    """
    from ..operators.pages import followed_text, in_window, listing_cards
    from ..sources.feeds import article_id

    cards = in_window(listing_cards(listings), start, end)
    text = followed_text(pages, compat_not_found=compat_not_found, starts=cards.select("link")).select(
        F.col("start_url").alias("link"), F.col("body").alias("content"))
    j = cards.join(text, "link", "left")
    return j.select(article_id(F.lit("site"), F.col("link"), F.col("title")).alias("doc_id"),
                    F.lit("site").alias("source"), F.col("link").alias("url"), "title", "content",
                    F.col("published_wall").alias("published"))


def social_articles(grid: DataFrame, responses: DataFrame, response_col: str = "response", source: str = "social") -> DataFrame:
    """C13, social load: stored responses of a request grid -> articles.

    ``grid`` holds the requests (topic, range_start, page_offset; see
    ``grids.day_ranges`` and ``page_offsets``), ``responses`` the same keys
    and the stored text. S2 parse, P4 mentions without content dropped; the
    keys stay on the rows. Order by date (O4) with ``orderBy`` or
    ``merge.rank_within`` on the columns.
    """
    from ..sources.feeds import MENTION_RESPONSE, article_id

    keys = ["topic", "range_start", "page_offset"]
    asked = responses.join(grid.select(*keys).distinct(), keys, "left_semi")
    items = (asked.select(*keys, F.from_json(F.col(response_col), MENTION_RESPONSE).alias("r"))
             .select(*keys, F.inline("r.data")).filter("content IS NOT NULL"))
    src = F.lit(source)
    return items.select(*keys, article_id(src, F.col("url"), F.col("title")).alias("doc_id"), src.alias("source"), "url", "title", "content",
                        F.to_date(F.try_to_timestamp(F.col("date"))).alias("published"))


def score(rows: DataFrame, date_col: str = "published", tie_cols=("url", "ordinal")) -> DataFrame:
    """Completeness score (T11) over the fields that ``rows`` has, the date read leniently (D3), its year
    (D4), and ``position``: the place in the order by year, then score, both falling, nulls last (O1)."""
    from ..functions.constants import SCORE_FIELDS
    from ..functions.dates import lenient_timestamp
    from ..functions.labels import completeness_score
    from ..operators.merge import rank_within

    fields = [c for c in SCORE_FIELDS if c in rows.columns]
    out = rows.withColumn(date_col, lenient_timestamp(F.col(date_col).cast("string"))).withColumns(
        {"sort_score": completeness_score(*fields), "year": F.year(date_col)})
    ties = [F.col(c).asc_nulls_last() for c in tie_cols if c in rows.columns]
    order = [F.col("year").desc_nulls_last(), F.col("sort_score").desc_nulls_last(), *ties]
    return rank_within(out.withColumn("_all", F.lit(1)), "_all", order, name="position").drop("_all")
