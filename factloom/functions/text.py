"""Column functions on text (normalise, presence, trim, labels).

Every function here is ``Column -> Column`` and built from Spark built-ins
only, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import STOP_WORDS, WORD_RE

# White space as Python's ``str.isspace`` defines it, written without ``\s``
# so the same class means the same thing in Java regex and in RE2.
WS = r"\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}"
WS_RUN = f"[{WS}]+"
# Anything that is neither a word character nor white space.
NOT_WORD_OR_SPACE = rf"[^\p{{L}}\p{{N}}_{WS}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_array(words) -> Column:
    """A constant array of texts, as one expression: a call per word costs more than many queries."""
    return F.expr(f"array({', '.join(map(_sql_text, words))})")


def literal_map(pairs: dict[str, str]) -> Column:
    """A constant map of texts, as one expression."""
    return F.expr(f"map({', '.join(_sql_text(x) for kv in pairs.items() for x in kv)})")


def normalize(text) -> Column:
    """Drop everything but word characters and white space, lower-case."""
    return F.lower(F.regexp_replace(_c(text), NOT_WORD_OR_SPACE, ""))


def term_present(term, text_norm) -> Column:
    """Normalised term is a substring of already-normalised text.

    ``text_norm`` should be ``normalize(content)`` computed once per row and
    reused for every field; null on either side gives false.
    """
    return F.coalesce(F.contains(text_norm, normalize(term)), F.lit(False))


def ustrip(text) -> Column:
    """Strip leading and trailing white space (all Unicode spaces)."""
    return F.regexp_replace(_c(text), f"^{WS_RUN}|{WS_RUN}$", "")


def double_to_single_quotes(text) -> Column:
    """Replace every double quote by a single quote."""
    return F.translate(_c(text), '"', "'")


def clean_label(text) -> Column:
    """The text between the first pair of single quotes, else the text."""
    t = _c(text)
    return F.when(F.instr(t, "'") > 0, F.split_part(t, F.lit("'"), F.lit(2))).otherwise(t)


def word_count(text) -> Column:
    """Number of white-space separated words (0 for empty / blank)."""
    s = ustrip(text)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, WS_RUN)))


def bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn``: a lambda argument is
    computed once, while a sub-expression written twice is computed twice."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def split_at(text, pattern: str) -> Column:
    """The text between the matches of a pattern, in order, one more than there are matches.

    ``split`` compiles its pattern for every row, which costs more than the row where the pattern is long; a replacement
    compiles it once. A control character marks the matches; the same character in the text is taken for its neighbour.
    """
    return F.split(F.regexp_replace(F.replace(_c(text), F.lit("\u0001"), F.lit("\u0002")), pattern, "\u0001"), "\u0001")


def running_total(numbers: Column, part: int = 16, levels: int = 4) -> Column:
    """Running totals of an array of integers.

    A fold that appends to an array copies it each time, so it runs over parts of ``part`` numbers, and the totals of
    the parts are added up in the same way, ``levels`` times: the work grows with the length, not with its square.
    """
    none = F.array().cast("array<int>")

    def totals(xs):
        start = F.struct(F.lit(0).alias("sum"), none.alias("all"))
        return F.aggregate(xs, start, lambda acc, x: bind(acc["sum"] + x, lambda sum_: F.struct(
            sum_.alias("sum"), F.array_append(acc["all"], sum_).alias("all"))), lambda acc: acc["all"])

    def joined(parts):
        before = F.concat(F.array(F.lit(0)), running_total(F.transform(parts, lambda xs: F.element_at(xs, -1)), part, levels - 1))
        return F.flatten(F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda xs, base: F.transform(xs, lambda x: x + base)))

    def cut(xs):
        starts = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / part).cast("int"))
        parted = bind(F.transform(starts, lambda c: totals(F.slice(xs, c * part + 1, part))), joined) if levels > 1 else totals(xs)
        return F.when(F.size(xs) <= part, totals(xs)).otherwise(parted)

    # a lambda argument is computed once; an expression used inside a lambda once per element
    return bind(numbers, cut)


def trim_to_words(text, max_words: int) -> Column:
    """Keep the first ``max_words`` words, only when the text is longer.

    Shorter texts are returned unchanged (spacing kept); longer ones are
    re-joined with single spaces. The text is split once.
    """
    t = _c(text)
    return bind(F.split(ustrip(t), WS_RUN),
                lambda words: F.when(F.size(words) > max_words,
                                     F.array_join(F.slice(words, 1, max_words), " ")).otherwise(t))


def lower_in_place(text) -> Column:
    """Lower case, character for character: the capital dotted I, the one letter that would become two, becomes i."""
    return F.lower(F.replace(_c(text), F.lit("\u0130"), F.lit("i")))


def tokens(text) -> Column:
    """Lower-cased word tokens of a text (the unit of dictionary matching)."""
    return F.regexp_extract_all(lower_in_place(text), F.lit(WORD_RE), 0)


def drop_stop_words(words) -> Column:
    """Remove English stop words (compared in lower case)."""
    stop = literal_array(STOP_WORDS)
    return F.filter(_c(words), lambda w: ~F.array_contains(stop, F.lower(w)))


def quote_regex(text) -> Column:
    """Quote a column value for use inside a Java regex (\\Q..\\E, safe for \\E)."""
    return F.concat(F.lit(r"\Q"), F.replace(_c(text), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
