"""Dictionary matching of documents against term lists.

Semantics (one rule for every dictionary):

* text and terms are split into word tokens (letters, numbers, ``_``) and
  lower-cased; a term matches a run of whole tokens;
* scanning left to right, at each token the longest term starting there is
  taken and the scan resumes after it (leftmost-longest, no overlaps);
* a term added twice keeps its last payload (``ord`` order).

Physical plan (``match_entries``): every term is indexed by its rarest token (``index_terms``), so "the green
zone" is looked up by "zone" and the many names that begin with "al" by what follows. One narrow pass per document
gives a row per token with the few tokens before and after it that a term can need, which is probed against the
index by a broadcast hash join (broadcast only when the dictionary is proven small) and verified to both sides. Only
real candidates survive, as integers (document, position, end, entry id, and character offsets where they are asked
for); they are shuffled once by ``doc_id`` and every later step (overlap islands, greedy fold, per-term / per-key /
per-document aggregation) reuses that partitioning. Names are joined back after aggregation. The token array itself
is never carried on exploded rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import (CONTEXT_WORD, GATE_LABELS, GAZETTEER_NAME_COLUMNS,
                                   PROXIMITY_CHARS, SPECIAL_TERMS, WORD_RE)
from ..functions.text import bind, lower_in_place, running_total, split_at, tokens
from .joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, checked_broadcast, exploded, is_small, row_bytes

DICT_COLUMNS = ["dict", "key", "term", "term_norm", "n_tokens", "first_token", "entry"]


# ------------------------------------------------------------ dictionaries
def _finish_dictionary(terms: DataFrame, dict_name: str) -> DataFrame:
    """Normalise terms, drop empty ones, keep the last payload per term."""
    toks = tokens(F.col("term"))
    df = (terms.withColumn("_toks", toks)
          .withColumn("term_norm", F.array_join("_toks", " "))
          .withColumn("n_tokens", F.size("_toks"))
          .withColumn("first_token", F.element_at("_toks", 1))
          .filter(F.col("n_tokens") > 0))
    w = Window.partitionBy("term_norm").orderBy(F.col("ord").desc())
    return (df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select(F.lit(dict_name).alias("dict"), F.col("key").cast("string").alias("key"),
                    "term", "term_norm", F.col("n_tokens").cast("int").alias("n_tokens"),
                    "first_token", F.xxhash64(F.lit(dict_name), "term_norm").alias("entry")))


def place_dictionary(gazetteer: DataFrame, id_col: str = "loc_id",
                     name_cols=GAZETTEER_NAME_COLUMNS, order_col: str | None = None,
                     special_terms=SPECIAL_TERMS, dict_name: str = "place") -> DataFrame:
    """L8 + L9 + A11: gazetteer rows -> (key, term) entries.

    Names are unpivoted (nulls skipped); a name with ``-`` also adds its
    variant with spaces, which is the reported term. Special terms are
    added before the other names of their row. ``order_col`` fixes the row
    order for the last-wins rule (default: ``id_col``).
    """
    order_col = order_col or id_col
    g = gazetteer.filter(F.col(id_col).isNotNull())
    stack = F.explode(F.array(*[
        F.struct(F.lit(i).alias("col_idx"), F.col(c).cast("string").alias("name"))
        for i, c in enumerate(name_cols)]))
    names = (g.select(F.col(id_col).alias("key"), F.col(order_col).alias("_row"), stack.alias("n"))
             .select("key", "_row", "n.col_idx", "n.name").filter(F.col("name").isNotNull()))
    is_special = F.col("name").isin(list(special_terms)) if special_terms else F.lit(False)
    variants = F.explode(F.array(
        F.struct(F.col("name").alias("term"), F.lit(0).alias("variant")),
        F.when(F.contains("name", F.lit("-")),
               F.struct(F.replace("name", F.lit("-"), F.lit(" ")).alias("term"), F.lit(1).alias("variant")))))
    entries = (names.select("key", "_row", "col_idx", is_special.alias("_special"), variants.alias("v"))
               .filter(F.col("v").isNotNull())
               .select("key", "v.term",
                       F.struct("_row", F.when(F.col("_special"), 0).otherwise(1), "col_idx",
                                F.col("v.variant")).alias("ord")))
    return _finish_dictionary(entries, dict_name)


def topic_dictionary(topics: DataFrame, keywords_col: str = "keywords", label_col: str = "label",
                     type_col: str = "topic_type", order_col: str = "ord",
                     dict_name: str = "topic") -> DataFrame:
    """L7 + A11: topic rows (``'a OR b'``, label, type) -> entries.

    The key is the label (the English equivalent); the type is kept in the
    term payload as ``type``. Which text column feeds the keywords is the
    caller's choice (pass the column name).
    """
    entries = (topics.filter(F.col(keywords_col).isNotNull())
               .select(F.col(label_col).alias("key"), F.col(order_col).alias("_row"),
                       F.posexplode(F.split(F.col(keywords_col), " OR ")).alias("_i", "term"))
               .select("key", "term", F.struct("_row", "_i").alias("ord")))
    return _finish_dictionary(entries, dict_name)


# ------------------------------------------------------------------ J1 index
# Texts, and characters of each, that are looked at to tell common tokens from rare ones. They decide which token
# a term is looked up by, never what is found.
SAMPLE_TEXTS = 200
SAMPLE_CHARS = 20_000


@dataclass
class DictionaryInfo:
    rows: int
    max_tokens: int
    broadcast: bool
    has_special: bool = False
    # tokens before and after the looked-up one that a term can need
    before: int = 0
    after: int = 0


def sample_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(token, seen): how often tokens occur in a few texts of ``docs`` (those that Spark reads first)."""
    rows = docs.select(F.substring(F.col(text_col), 1, SAMPLE_CHARS).alias("text")).limit(SAMPLE_TEXTS).collect()
    some = docs.sparkSession.createDataFrame([(r["text"],) for r in rows], "text string")
    return some.select(F.explode(tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("seen"))


def index_terms(dictionary: DataFrame, docs: DataFrame | None = None, text_col: str = "content",
                max_rows: int = MAX_BROADCAST_ROWS, special_terms=SPECIAL_TERMS,
                dict_name: str = "place") -> tuple[DataFrame, DictionaryInfo]:
    """The dictionary with the token each term is looked up by (``probe``, its place ``probe_at``, all ``toks``), and its facts.

    The probe is the term's rarest token: the one seen least in a few texts of ``docs`` (when given), then the one that
    the fewest terms share, then the first. ``max_rows`` decides about broadcasting and nothing else. Dictionaries of
    one-token terms need neither counts nor a stored index.
    """
    special = (F.col("dict") == dict_name) & F.col("term").isin(list(special_terms or ["\u0000"]))
    per_entry = dictionary.groupBy("entry").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_tokens").alias("k"), F.sum(row_bytes(dictionary)).alias("b"),
        F.max(F.when(special, 1).otherwise(0)).alias("sp"))
    row = per_entry.agg(F.sum("n").alias("n"), F.max("k").alias("k"), F.sum("b").alias("b"), F.max("sp").alias("sp"),
                        F.max("n").alias("same_id")).first()
    n, k = int(row["n"] or 0), int(row["k"] or 1)
    if (row["same_id"] or 1) > 1:
        raise ValueError("two dictionary terms share an entry id (64-bit hash collision); rename one term")
    info = DictionaryInfo(n, k, n <= max_rows and (row["b"] or 0) <= MAX_BROADCAST_BYTES, bool(row["sp"]))
    if k == 1:
        return dictionary.withColumns({"probe": F.col("first_token"), "probe_at": F.lit(0), "toks": F.array("first_token")}), info
    from ..session import cut_lineage
    each = dictionary.select("entry", F.posexplode(F.split("term_norm", " ")).alias("at", "token"))
    shared = each.groupBy("token").agg(F.count(F.lit(1)).alias("shared"))
    costs = each.join(shared, "token")
    seen = F.lit(0)
    if docs is not None:
        costs = costs.join(sample_counts(docs, text_col), "token", "left")
        seen = F.coalesce(F.col("seen"), F.lit(0))
    probe = costs.groupBy("entry").agg(F.min(F.struct(seen.alias("seen"), F.col("shared"), F.col("at"), F.col("token"))).alias("p"))
    indexed = cut_lineage(dictionary.join(probe, "entry").select(
        *dictionary.columns, F.col("p.token").alias("probe"), F.col("p.at").alias("probe_at"), F.split("term_norm", " ").alias("toks")))
    sides = indexed.agg(F.max("probe_at").alias("before"), F.max(F.col("n_tokens") - 1 - F.col("probe_at")).alias("after")).first()
    info.before, info.after = int(sides["before"] or 0), int(sides["after"] or 0)
    return indexed, info


# ------------------------------------------------------------------ J1 match
def token_spans(text: F.Column) -> F.Column:
    """Tokens with their character offsets in the text: array of (tok, at, to), end exclusive; the tokens of ``tokens``."""
    def spans(words, gaps):
        # the end of a token: all gaps and tokens up to it
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(words)), words, lambda g, w: F.length(g) + F.length(w))
        return F.zip_with(words, running_total(steps), lambda w, to: F.struct(w.alias("tok"), (to - F.length(w)).alias("at"), to.alias("to")))
    return bind(lower_in_place(text), lambda low: bind(F.regexp_extract_all(low, F.lit(WORD_RE), 0),
                                                       lambda words: spans(words, split_at(low, WORD_RE))))


def probed(docs: DataFrame, index: DataFrame, id_col: str, text_col: str, info: DictionaryInfo, spans: bool = False) -> DataFrame:
    """Every occurrence of a term's probe token, with the tokens around it (``around``) and the term's own, unverified."""
    text = F.col(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), (token_spans(text) if spans else tokens(text)).alias("_t"))
    kind = "struct<tok:string,at:int,to:int>" if spans else "string"

    def shifted(j):
        if j >= 0:
            return F.slice(F.col("_t"), j + 1, 1 << 30)
        return F.concat(F.array_repeat(F.lit(None).cast(kind), -j), F.col("_t"))

    places = range(-info.before, info.after + 1)
    rows = exploded(base, ["doc_id"], F.arrays_zip(*[shifted(j).alias(f"t{j + info.before}") for j in places]), "pos", "z")
    here = F.col(f"z.t{info.before}")
    around = [F.col(f"z.t{j + info.before}") for j in places]
    rows = rows.select("doc_id", "pos", (here["tok"] if spans else here).alias("_here"), F.array(*around).alias("around")) \
        .filter(F.col("_here").isNotNull())
    d = index.select("dict", "entry", "n_tokens", "probe", "probe_at", "toks")
    d = F.broadcast(d) if info.broadcast else d
    return rows.join(d, rows["_here"] == d["probe"]).drop("_here")


def _candidates(docs: DataFrame, index: DataFrame, id_col: str, text_col: str, info: DictionaryInfo, spans: bool) -> DataFrame:
    rows = probed(docs, index, id_col, text_col, info, spans)
    mine = F.slice("around", F.lit(info.before + 1) - F.col("probe_at"), F.col("n_tokens"))
    same = (F.transform(mine, lambda x: x["tok"]) if spans else mine) == F.col("toks")
    offsets = [F.get(mine, F.lit(0))["at"].alias("from_char"), F.element_at(mine, -1)["to"].alias("to_char")] if spans else []
    start = F.col("pos") - F.col("probe_at")
    return rows.filter(same).select("doc_id", "dict", start.alias("pos"), (start + F.col("n_tokens")).alias("end"), "entry", *offsets)


def match_entries(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id", text_col: str = "content",
                  info: DictionaryInfo | None = None, spans: bool = False) -> DataFrame:
    """J1 core: ``(doc_id, dict, entry, start, end)`` - leftmost-longest,
    non-overlapping hits per document and dictionary, as dictionary entry
    ids (only integers travel through the shuffle, the window and the fold);
    with ``spans`` also ``from_char`` and ``to_char``, the hit's characters
    in the text (from 0, end exclusive). ``dictionary`` and ``info`` are
    those of ``index_terms``; without ``info`` they are made here.

    Candidates sorted by ``(start, end desc)`` are cut into islands: a new
    island starts where no earlier candidate reaches. Inside an island a
    greedy fold keeps a candidate when it starts at or after the end of the
    last kept one; the first candidate at a position is the longest, so
    shorter ones there are skipped by the same rule. Islands keep the fold
    short even for documents with very many hits.
    """
    if info is None:
        dictionary, info = index_terms(dictionary, docs, text_col)
    cand = _candidates(docs, dictionary, id_col, text_col, info, spans)
    # one shuffle by document; the window and the grouping below reuse it
    cand = cand.repartition("doc_id")
    w = Window.partitionBy("doc_id", "dict").orderBy(F.col("pos"), F.col("end").desc())
    prev_end = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    isl = (cand.withColumn("_new", F.when(prev_end.isNull() | (F.col("pos") >= prev_end), 1).otherwise(0))
           .withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    offsets = ["from_char", "to_char"] if spans else []
    groups = (isl.groupBy("doc_id", "dict", "island")
              .agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), (-F.col("end")).alias("neg_end"),
                                                        "entry", *offsets))).alias("c")))
    kind = "pos:int,neg_end:int,entry:bigint" + "".join(f",{c}:int" for c in offsets)
    init = F.struct(F.lit(-1).alias("last"), F.array().cast(f"array<struct<{kind}>>").alias("kept"))
    kept = F.aggregate(
        "c", init,
        lambda acc, x: F.when(x["pos"] >= acc["last"],
                              F.struct((-x["neg_end"]).alias("last"),
                                       F.array_append(acc["kept"], x).alias("kept"))).otherwise(acc),
        lambda acc: acc["kept"])
    return (groups.select("doc_id", "dict", F.explode(kept).alias("h"))
            .select("doc_id", "dict", "h.entry", F.col("h.pos").alias("start"), (-F.col("h.neg_end")).alias("end"),
                    *[F.col(f"h.{c}").alias(c) for c in offsets]))


def entry_names(dictionary: DataFrame, info: DictionaryInfo) -> DataFrame:
    """``(dict, entry, key, term)`` of a dictionary, broadcast when it is small."""
    d = dictionary.select("dict", "entry", "key", "term")
    return F.broadcast(d) if info.broadcast else d


def match_terms(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id", text_col: str = "content",
                info: DictionaryInfo | None = None, spans: bool = False) -> DataFrame:
    """Leftmost-longest, non-overlapping hits per document and dictionary.

    Returns ``(doc_id, dict, key, term, start, end)``; start/end are token
    ordinals (end exclusive); with ``spans`` also ``from_char`` and
    ``to_char``. See ``match_entries``.
    """
    if info is None:
        dictionary, info = index_terms(dictionary, docs, text_col)
    hits = match_entries(docs, dictionary, id_col, text_col, info, spans)
    return (hits.join(entry_names(dictionary, info), ["dict", "entry"])
            .select("doc_id", "dict", "key", "term", "start", "end", *(["from_char", "to_char"] if spans else [])))


def with_spelling(hits: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "content", name: str = "spelling") -> DataFrame:
    """Hits with ``from_char`` and ``to_char`` as the text spells them (``Al-Hillah`` where the term reads ``Al Hillah``).

    Texts are not shuffled while the hits are small enough to be broadcast (pass a stored table: they are measured)."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    found = text.join(checked_broadcast(hits), "doc_id")
    return found.withColumn(name, F.substring("_text", F.col("from_char") + 1, F.col("to_char") - F.col("from_char"))).select(*hits.columns, name)


# ------------------------------------------------------------------ T7
def _char_span(text: F.Column, start: F.Column, end: F.Column):
    """Character offsets (0-based, end exclusive) of tokens ``start..end-1`` of one hit, without offsets of all tokens:
    the text before a token is so many gaps and so many tokens, each cut from a text that holds only those."""
    mark = "\u0001"
    low = F.replace(lower_in_place(text), F.lit(mark), F.lit("\u0002"))
    gaps, words = F.regexp_replace(low, WORD_RE, mark), F.array_join(F.regexp_extract_all(low, F.lit(WORD_RE), 0), mark)

    def first(text, n):
        return F.call_function("substring_index", text, F.lit(mark), n)

    def spans(gaps, words):
        def offset(i):
            before = F.length(first(gaps, i + 1)) - i
            return before + F.when(i > 0, F.length(first(words, i)) - (i - 1)).otherwise(0)

        last = first(first(words, end), F.lit(-1))
        return F.struct(offset(start).alias("at"), (offset(end - 1) + F.length(last)).alias("to"))

    return bind(gaps, lambda g: bind(words, lambda w: spans(g, w)))


def per_term(hits: DataFrame, names: DataFrame | None = None, topic_dict: str = "topic") -> DataFrame:
    """Hits folded to one row per (document, dictionary, key, term).

    ``n`` hits, ``first`` = (start, end) of the first one, with its characters
    where the hits have them, and for topic terms every start (their labels are listed in text order). Partial
    aggregation runs before any shuffle; the input is already partitioned
    by document, so no new exchange is planned. ``hits`` may carry entry
    ids instead of names (``match_entries``): they are aggregated first and
    named afterwards through ``names`` (``entry_names``).
    """
    key = ["doc_id", "dict", "entry"] if names is not None else ["doc_id", "dict", "key", "term"]
    agg = (hits.groupBy(*key)
           .agg(F.count(F.lit(1)).alias("n"),
                F.min(F.struct("start", "end", *[c for c in ("from_char", "to_char") if c in hits.columns])).alias("first"),
                F.collect_list(F.when(F.col("dict") == topic_dict, F.col("start"))).alias("starts")))
    if names is None:
        return agg
    return agg.join(names, ["dict", "entry"]).select("doc_id", "dict", "key", "term", "n", "first", "starts")


def suppress_ambiguous(terms: DataFrame, docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "content", special_terms=SPECIAL_TERMS,
                       context: str = CONTEXT_WORD, window: int = PROXIMITY_CHARS,
                       dict_name: str = "place", compat: bool = False) -> DataFrame:
    """T7 on ``per_term`` rows: drop a special term unless its first hit has context.

    The first hit of each special term in a document is checked: the text
    from ``window`` characters before it to ``window`` after it must hold
    the context word (case-insensitive). If not, every hit of that term in
    the document goes. ``compat=True`` keeps the original test, which
    compares an upper-case word to lower-cased text and so always removes
    them, without a look at the text. Only documents with a special hit are
    joined to their text (a small, counted, broadcast set); the characters
    of the first hit come from the hits when they carry them (``spans``),
    else from the text. ``terms`` should be materialised as it is read twice.
    """
    if compat and context != context.lower():
        return terms.filter(~((F.col("dict") == dict_name) & F.col("term").isin(list(special_terms))))
    sp = terms.filter((F.col("dict") == dict_name) & F.col("term").isin(list(special_terms)))
    first = sp.select("doc_id", "term", F.col("first").alias("s"))
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    small = is_small(first)               # the drop list below is a subset: same decision
    j = text.join(F.broadcast(first) if small else first.hint("merge"), "doc_id")
    if "from_char" not in terms.schema["first"].dataType.names:
        j = j.withColumn("s", _char_span(F.col("_text"), F.col("s.start"), F.col("s.end"))).withColumn(
            "s", F.struct(F.col("s.at").alias("from_char"), F.col("s.to").alias("to_char")))
    c0, c1 = F.col("s.from_char"), F.col("s.to_char")
    lo = F.greatest(c0 - window, F.lit(0))
    hi = F.least(c1 + window, F.length("_text"))
    around = F.lower(F.substring("_text", lo + 1, hi - lo))
    needle = F.lit(context) if compat else F.lit(context.lower())
    drop = j.filter(~F.contains(around, needle)).select("doc_id", "term", F.lit(dict_name).alias("dict"))
    return terms.join(F.broadcast(drop) if small else drop.hint("merge"), ["doc_id", "dict", "term"], "left_anti")


def summarize(terms: DataFrame, place_dict: str = "place", topic_dict: str = "topic",
              sep: str = ", ") -> DataFrame:
    """A1 + A2 + J2 in one aggregation chain over ``per_term`` rows.

    Per document: the place key with most hits (ties: first seen) and the
    term of its first hit; and the topic labels of all topic hits in text
    order joined by ``sep`` (null when there are none).
    """
    is_place = F.col("dict") == place_dict
    is_topic = F.col("dict") == topic_dict
    per_key = (terms.groupBy("doc_id", "dict", "key")
               .agg(F.sum("n").alias("n"), F.min("first.start").alias("first"),
                    F.min_by("term", F.col("first.start")).alias("term"),
                    F.flatten(F.collect_list("starts")).alias("starts")))
    per_doc = per_key.groupBy("doc_id").agg(
        F.max_by(F.when(is_place, F.struct("key", "term", "n")),
                 F.when(is_place, F.struct("n", -F.col("first")))).alias("w"),
        F.flatten(F.collect_list(F.when(is_topic, F.transform(
            "starts", lambda x: F.struct(x.alias("start"), F.col("key").alias("key")))))).alias("th"))
    topic_terms = F.when(F.size("th") > 0,
                         F.array_join(F.transform(F.array_sort("th"), lambda x: x["key"]), sep))
    return per_doc.select("doc_id", F.col("w.key").alias("matched_key"), F.col("w.term").alias("matched_term"),
                          F.col("w.n").alias("matched_hits"), topic_terms.alias("topic_terms"))


# ------------------------------------------------------------------ P6, J3
def passes_gate(topic_terms, labels=GATE_LABELS, sep: str = ", ") -> F.Column:
    """Some element of the joined label text equals a gate label."""
    gate = F.array(*[F.lit(x) for x in labels])
    return F.coalesce(F.exists(F.split(topic_terms, sep), lambda x: F.array_contains(gate, x)), F.lit(False))


def attach_locations(winners: DataFrame, gazetteer: DataFrame, id_col: str = "loc_id") -> DataFrame:
    """Gazetteer attributes of the winning key (broadcast when small)."""
    g = gazetteer.withColumn("matched_key", F.col(id_col).cast("string"))
    return winners.join(checked_broadcast(g), "matched_key", "left")
