"""Evidence checks: is an extracted value really in the article?

Word-bounded, case-insensitive matching with explicit word classes
(letters, numbers, underscore), so the rule is the same for every script.
Plain words are looked up in the row's token array (no regex compiled per
row), and NEAR patterns of plain words by the places of their words in it;
terms with other characters and phrases use a regex.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import CONTEXT_WORD
from .text import WS_RUN, bind, drop_stop_words, quote_regex, tokens, ustrip

W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"
LEFT = rf"(?<!{W})"
RIGHT = rf"(?!{W})"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_bind = bind


def _finish(b) -> Column:
    ratio = F.when(b["n_terms"] > 0, b["found"] / b["n_terms"]).otherwise(F.lit(0.0))
    return F.struct(b["found"].alias("found"), b["n_terms"].alias("n_terms"), ratio.alias("ratio"),
                    (F.coalesce(b["n_terms"] > 0, F.lit(False)) & (ratio >= 0.5)).alias("match"))


def word_regex(term, prefix: bool = False) -> Column:
    """Case-insensitive regex for ``term`` as a whole word (or word prefix)."""
    tail = F.lit(rf"{W}*{RIGHT}" if prefix else RIGHT)
    return F.concat(F.lit(f"(?iu){LEFT}"), quote_regex(term), tail)


def has_word(text, term, prefix: bool = False) -> Column:
    return F.regexp_like(_c(text), word_regex(term, prefix))


def has_word_fast(text, toks, term, prefix: bool = False) -> Column:
    """``has_word`` that looks a plain word up in the row's token array.

    ``toks`` is ``tokens(text)`` computed once per row. A term made only of
    word characters occurs as a whole word exactly when some token equals
    it (case-insensitively); other terms fall back to the regex.
    """
    t = _c(term)
    lt = F.lower(t)
    lookup = (F.exists(toks, lambda x: x.startswith(lt)) if prefix else F.array_contains(toks, lt))
    return F.when(t.rlike(r"^[\p{L}\p{N}_]+$"), lookup).otherwise(has_word(text, t, prefix))


def location_terms(location) -> Column:
    """Comma parts (trimmed) when the text has a comma, else its words."""
    loc = _c(location)
    by_comma = F.transform(F.split(loc, ","), ustrip)
    by_space = F.split(ustrip(loc), WS_RUN)
    terms = F.when(F.contains(loc, F.lit(",")), by_comma).otherwise(
        F.when(ustrip(loc) == "", F.array().cast("array<string>")).otherwise(by_space))
    return F.coalesce(terms, F.array().cast("array<string>"))


def location_evidence(text, location, compat: bool = False, toks=None) -> Column:
    """T3 + A8: struct(found, n_terms, ratio, match) for a location string.

    Terms are the comma parts (else words) with stop words removed, then
    split into words; each word is searched as a whole word. A word holding
    the context word (``Iraq``) matches any word starting with it.
    Default: ratio = found / words checked. ``compat=True``: the ratio is
    found / number of comma parts before stop-word removal (may exceed 1),
    and the context-word rule looks for the literal text ``Iraq.*``.
    """
    toks = tokens(text) if toks is None else _c(toks)
    parts = location_terms(location)
    kept = drop_stop_words(parts)
    words = F.filter(F.split(F.array_join(kept, " "), WS_RUN), lambda w: w != "")
    ctx = F.lit(CONTEXT_WORD)
    if compat:
        def hit(w):
            return F.when(F.contains(w, ctx), has_word(text, F.lit("Iraq.*"))).otherwise(has_word_fast(text, toks, w))
        denom = F.size(parts)
    else:
        def hit(w):
            return F.when(F.contains(w, ctx), has_word_fast(text, toks, ctx, prefix=True)).otherwise(
                has_word_fast(text, toks, w))
        denom = F.size(words)
    found = F.size(F.filter(words, lambda w: F.coalesce(hit(w), F.lit(False))))
    base = F.struct(found.cast("int").alias("found"), denom.cast("int").alias("n_terms"))
    return _bind(base, _finish)


def near_regex(spec, default_distance: int = 10) -> Column:
    """T5: ``a NEAR/n b`` -> regex: ``a``, at most ``n`` words, then ``b``.

    A spec without ``NEAR/`` is a plain phrase. Missing ``n`` -> default.
    """
    parts = F.split(_c(spec), "NEAR/")
    first = ustrip(F.element_at(parts, 1))
    rest = F.slice(parts, 2, 1 << 30)

    def step(p):
        p = ustrip(p)
        dist = F.coalesce(F.regexp_extract(p, r"^(\d+)", 1).try_cast("int"), F.lit(default_distance))
        term = ustrip(F.regexp_replace(p, r"^\d+", ""))
        return F.concat(F.lit(f"(?:{NW}+{W}+){{0,"), dist.cast("string"), F.lit(f"}}?{NW}+{LEFT}"),
                        quote_regex(term), F.lit(RIGHT))

    return F.concat(F.lit(f"(?iu){LEFT}"), quote_regex(first), F.lit(RIGHT),
                    F.array_join(F.transform(rest, step), ""))


def near_terms(spec, default_distance: int = 10) -> Column:
    """T5: the terms of ``a NEAR/n b NEAR/m c`` in lower case, each with the words that may stand before it."""
    def term(part, i):
        part = ustrip(part)
        words = F.coalesce(F.regexp_extract(part, r"^(\d+)", 1).try_cast("int"), F.lit(default_distance))
        return F.struct(F.lower(F.when(i == 0, part).otherwise(ustrip(F.regexp_replace(part, r"^\d+", "")))).alias("term"), words.alias("words"))

    return F.transform(F.split(_c(spec), "NEAR/"), term)


def near_by_position(toks, terms) -> Column:
    """Whether the terms (plain words) stand in this order, each at most its ``words`` words after the one before.

    One pass over the places of the words asked for. For each term the last place is kept to which the pattern
    holds up to it: the last is the best for what follows, so the work grows with the places, however often words repeat.
    """
    def walk(places, wanted):
        none = F.transform(wanted, lambda t: F.lit(None).cast("int"))

        def step(held, x):
            return F.transform(wanted, lambda t, k: F.when(
                (t["term"] == x["tok"]) & ((k == 0) | F.coalesce(x["at"] - F.get(held, k - 1) <= t["words"] + 1, F.lit(False))),
                x["at"]).otherwise(F.get(held, k)))

        return F.aggregate(places, none, step, lambda held: F.element_at(held, -1).isNotNull())

    def located(wanted):
        words = F.transform(wanted, lambda t: t["term"])
        places = F.filter(F.transform(toks, lambda x, i: F.struct(x.alias("tok"), i.alias("at"))), lambda x: F.array_contains(words, x["tok"]))
        return F.when(F.forall(words, lambda w: F.array_contains(toks, w)), walk(places, wanted)).otherwise(F.lit(False))

    return bind(terms, located)


def near_evidence(text, spec, toks=None) -> Column:
    """T5: whether a phrase or NEAR pattern occurs in a text; false where the text or the pattern is null.

    Patterns of plain words are decided by positions; a term that is no plain word, and a phrase, by ``near_regex``.
    """
    toks = tokens(text) if toks is None else _c(toks)
    plain = rf"^\s*{W}+\s*(?:NEAR/\s*(?:[0-9]+\s+|(?![0-9])){W}+\s*)*$"
    by_regex = F.regexp_like(_c(text), near_regex(spec))
    return F.coalesce(F.when(_c(spec).rlike(plain), near_by_position(toks, near_terms(spec))).otherwise(by_regex), F.lit(False))


def object_evidence(text, what, toks=None) -> Column:
    """T4 + A8: struct(found, n_terms, ratio, match) for "what is being built".

    Match when the phrase (or NEAR pattern) occurs, or at least half of its
    words occur as whole words.
    """
    toks = tokens(text) if toks is None else _c(toks)
    w = _c(what)
    words = F.coalesce(F.filter(F.split(ustrip(w), WS_RUN), lambda x: x != ""), F.array().cast("array<string>"))
    found = F.size(F.filter(words, lambda x: has_word_fast(text, toks, x)))
    base = F.struct(found.cast("int").alias("found"), F.size(words).cast("int").alias("n_terms"),
                    w.isNull().alias("missing"))
    # looked for only when its first word occurs at all (a phrase's regex scans the whole text)
    first = ustrip(F.element_at(F.split(w, "NEAR/"), 1))
    phrase = F.when(has_word_fast(text, toks, first), near_evidence(text, w, toks)).otherwise(F.lit(False))

    def finish(b):
        r = _finish(b)
        return F.struct(r["found"].alias("found"), r["n_terms"].alias("n_terms"), r["ratio"].alias("ratio"),
                        F.when(b["missing"], F.lit(False)).otherwise(r["match"] | phrase).alias("match"))
    return _bind(base, finish)
