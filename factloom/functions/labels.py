"""Category labels and completeness score as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import CATEGORY_RULES, FILLER_WORDS
from .text import ustrip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_by_rules(text, rules=CATEGORY_RULES) -> Column:
    """Label of the first rule whose pattern occurs in the text.

    Rules are tried in list order, case-insensitively, anywhere in the text;
    null text or no rule -> null. One chained CASE, evaluated JVM-side.
    """
    t = _c(text)
    expr = None
    for pattern, label in rules:
        cond = t.rlike(f"(?iu){pattern}")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def is_given(value) -> Column:
    """True when a field holds a real value (not null, not a filler phrase)."""
    fillers = sorted({w.lower().strip() for w in FILLER_WORDS})
    v = F.lower(ustrip(_c(value).cast("string")))
    return _c(value).isNotNull() & ~v.isin(fillers)


def completeness_score(*cols) -> Column:
    """Number of the given columns that hold a real value (0..len(cols))."""
    parts = [F.when(is_given(c), F.lit(1)).otherwise(F.lit(0)) for c in cols]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("int")
