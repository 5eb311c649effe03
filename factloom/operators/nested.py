"""Response fields -> one row per project (L2, L3, L5) and evidence columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import evidence as ev
from ..functions.constants import PROJECT_FIELDS
from ..functions.extract import field_values, parsed_dicts, with_fallback
from ..functions.text import normalize, term_present, tokens
from .joins import exploded


def extract_fields(df: DataFrame, response_col: str = "summaries", fields=PROJECT_FIELDS) -> DataFrame:
    """L2: one ``array<string>`` column per field (L1 on each alternative list)."""
    return df.withColumns({name: field_values(F.col(response_col), alts) for name, alts in fields})


def zip_explode(df: DataFrame, list_cols, retain_cols) -> DataFrame:
    """L3: zip the field arrays by position (short ones padded with null).

    One row per position, with ``ordinal`` (0-based); a row whose arrays are
    all empty yields no rows. Narrow: no shuffle.
    """
    safe = [F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c) for c in list_cols]
    z = F.arrays_zip(*safe)
    return (exploded(df, retain_cols, z, "ordinal", "_z")
            .select(*retain_cols, "ordinal", *[F.col(f"_z.{c}").alias(c) for c in list_cols]))


def explode_projects(df: DataFrame, response_col: str, retain_cols) -> DataFrame:
    """L4 + L5 (+ L6): parse each dict of the response as its own project.

    Unlike ``zip_explode`` a field missing in one project stays null in
    that project (no shift), and values holding apostrophes are kept.
    """
    keep = [c for c in retain_cols if c != response_col]
    parsed = df.select(*keep, F.col(response_col), parsed_dicts(F.col(response_col)).alias("_d"))
    full = parsed.select(*keep, F.col(response_col), with_fallback(F.col(response_col), F.col("_d")).alias("_all"))
    out = exploded(full, [*keep, response_col], F.col("_all"), "ordinal", "_p")
    return out.select(*retain_cols, "ordinal", "_p.*")


def project_arrays(df: DataFrame, response_col: str = "summaries", parse: str = "dicts") -> DataFrame:
    """Adds ``_projects``: the projects of each response as an array of structs (the field names of L2),
    read dict by dict (L4-L6) or, with ``parse="zip"``, field by field and zipped by position (L1-L3)."""
    names = [n for n, _ in PROJECT_FIELDS]
    if parse == "zip":
        lists = extract_fields(df.select(*df.columns), response_col)
        return lists.withColumn("_projects", F.arrays_zip(*[F.col(n) for n in names])).drop(*names)
    parsed = df.withColumn("_dicts", parsed_dicts(F.col(response_col)))
    return parsed.withColumn("_projects", with_fallback(F.col(response_col), F.col("_dicts"))).drop("_dicts")


def projects_with_evidence(df: DataFrame, id_col: str, text_col: str = "content", compat: bool = False) -> DataFrame:
    """(id, ordinal, project fields, presence flags (T2), evidence (T6)): one thin row per project.

    The text of an article is normalised and cut into words once, and all of its projects are tested
    against that before they become rows; no row carries the text.
    """
    names = [n for n, _ in PROJECT_FIELDS]
    once = df.select(id_col, text_col, "_projects", normalize(F.col(text_col)).alias("_norm"), tokens(F.col(text_col)).alias("_toks"))

    def tested(p):
        loc = ev.location_evidence(F.col(text_col), p["location"], compat=compat, toks=F.col("_toks"))
        obj = ev.object_evidence(F.col(text_col), p["what_built"], toks=F.col("_toks"))
        return F.struct(*[p[n].alias(n) for n in names],
                        term_present(p["location"], F.col("_norm")).alias("location_terms_present"),
                        term_present(p["what_built"], F.col("_norm")).alias("what_built_terms_present"),
                        loc.alias("_loc"), obj.alias("_obj"))

    rows = exploded(once, [id_col], F.transform("_projects", tested), "ordinal", "_p").select(id_col, "ordinal", "_p.*")
    return rows.select(id_col, "ordinal", *names, "location_terms_present", "what_built_terms_present",
                       F.col("_loc.match").alias("location_match"), F.col("_loc.ratio").alias("location_ratio"),
                       F.col("_obj.match").alias("what_built_match"), F.col("_obj.ratio").alias("what_built_ratio"))


def presence_flags(df: DataFrame, text_col: str = "content",
                   location_col: str = "location", what_col: str = "what_built",
                   norm_col: str | None = None) -> DataFrame:
    """Normalised location / object text is a substring of the normalised article.

    ``norm_col`` names a column already holding ``normalize(text)``.
    """
    norm = F.col(norm_col) if norm_col else normalize(F.col(text_col))
    return df.withColumns({
        "location_terms_present": term_present(F.col(location_col), norm),
        "what_built_terms_present": term_present(F.col(what_col), norm),
    })


def evidence_columns(df: DataFrame, text_col: str = "content", location_col: str = "location",
                     what_col: str = "what_built", compat: bool = False,
                     toks_col: str | None = None) -> DataFrame:
    """Location and object evidence, as match flags and ratios (4 columns).

    ``toks_col`` names a column already holding ``tokens(text)``.
    """
    df = df.withColumn("_toks", F.col(toks_col) if toks_col else tokens(F.col(text_col)))
    loc = ev.location_evidence(F.col(text_col), F.col(location_col), compat=compat, toks=F.col("_toks"))
    obj = ev.object_evidence(F.col(text_col), F.col(what_col), toks=F.col("_toks"))
    return (df.withColumn("_loc", loc).withColumn("_obj", obj)
            .withColumns({"location_match": F.col("_loc.match"),
                          "location_ratio": F.col("_loc.ratio"),
                          "what_built_match": F.col("_obj.match"),
                          "what_built_ratio": F.col("_obj.ratio")})
            .drop("_loc", "_obj", "_toks"))
