"""Money text to numbers.

Everything is a Column expression. Spark's regex functions return no match
positions, which the nearest currency mention (J9) needs; they follow from
the lengths of the matches and of the text between them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import CURRENCY_WORDS, NUMBER_WORDS, UNIT_SCALE, USD_RATES
from .text import bind, running_total, split_at, ustrip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_to_usd(text) -> Column:
    """M1: ``$1.5 billion`` style text -> double; unparsable -> null.

    ``$``, ``,`` and ``"`` are dropped; the first of billion / million /
    trillion found (in that order) scales the number and is removed.
    """
    v = F.translate(_c(text), '$,"', "")
    scale = (F.when(F.contains(v, F.lit("billion")), F.lit(1e9))
             .when(F.contains(v, F.lit("million")), F.lit(1e6))
             .when(F.contains(v, F.lit("trillion")), F.lit(1e12))
             .otherwise(F.lit(1.0)))
    num = (F.when(F.contains(v, F.lit("billion")), F.replace(v, F.lit("billion"), F.lit("")))
           .when(F.contains(v, F.lit("million")), F.replace(v, F.lit("million"), F.lit("")))
           .when(F.contains(v, F.lit("trillion")), F.replace(v, F.lit("trillion"), F.lit("")))
           .otherwise(v))
    return ustrip(num).try_cast("double") * scale


def usd_or_zero(text) -> Column:
    """M1 as exported: null -> 0."""
    return F.coalesce(amount_to_usd(text), F.lit(0.0))


# --------------------------------------------------------------- span reader
_NUM = r"(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?"
_UNIT_WORDS = "thousand|million|billion|trillion"
_PERCENT = rf"(?<![\w.])({_NUM})%\s*of\s*({_NUM})(?:\s*({_UNIT_WORDS})\b)?"
_WORDNUM = rf"\b({'|'.join(NUMBER_WORDS)})\s*({_UNIT_WORDS})\b"
_CURRENCY = r"(?<!\w)(" + "|".join(re.escape(w) for w, _ in CURRENCY_WORDS) + r")(?!\w)"
_PLAIN = rf"(?<![\w.])({_NUM})(?:\s*({_UNIT_WORDS}|[kmbt])\b)?"
_FLAGS = "(?iuU)"
# Everything that counts, tried in this order at each place, so that a percent phrase is read as a whole.
_ANY = _FLAGS + "|".join((_PERCENT, _WORDNUM, _CURRENCY, _PLAIN))


def _lookup(pairs, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs for x in kv]), key)


def _scale(unit: Column) -> Column:
    return F.coalesce(_lookup([(w, float(s)) for w, s in UNIT_SCALE], F.lower(unit)), F.lit(1.0))


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def _amount(token: Column) -> Column:
    """Value of an amount phrase in its own currency. The phrase is known to be one of the three forms, so its parts
    are what its first number or word leaves over."""
    low = F.lower(token)
    number = F.regexp_extract(low, f"^{_NUM}", 0)

    def plain(n):
        rest = F.ltrim(F.substring(low, F.length(n) + 1, 1 << 30))
        return F.when(rest.startswith("%"), bind(F.regexp_extract(rest, f"{_NUM}", 0), lambda base: _number(base) * _scale(F.regexp_extract(
            rest, "([a-z]*)$", 1)) * _number(n) / 100)).otherwise(_number(n) * _scale(F.regexp_replace(rest, "(?U)^\\s+", "")))

    word = F.regexp_extract(low, f"^({'|'.join(NUMBER_WORDS)})", 1)
    worded = _lookup([(w, float(i + 1)) for i, w in enumerate(NUMBER_WORDS)], word) * _scale(F.regexp_extract(low, f"({_UNIT_WORDS})$", 1))
    return bind(number, lambda n: F.when(n != "", plain(n)).otherwise(worded))


def _digits(text) -> Column:
    return F.translate(_c(text), "٠١٢٣٤٥٦٧٨٩", "0123456789")


def money_spans(text) -> Column:
    """M2-M4: ``array<struct<pos, amount, code>>`` of the amounts (``code`` null) and currency mentions
    (``amount`` null) of a text, in text order, with their character positions.

    Percent phrases (``5% of 2 million``), number words (``two million``) and
    numbers with an optional unit, with any number of decimals. Positions are
    running totals of the lengths of the matches and of the text between them.
    """
    codes = [(w.lower(), code) for w, code in CURRENCY_WORDS]

    def spans(tokens, between):
        ends = running_total(F.zip_with(F.slice(between, F.lit(1), F.size(tokens)), tokens, lambda g, t: F.length(g) + F.length(t)))
        return F.zip_with(tokens, ends, lambda t, end: bind(_lookup(codes, F.lower(t)), lambda code: F.struct(
            (end - F.length(t)).alias("pos"), F.when(code.isNull(), _amount(t)).alias("amount"), code.alias("code"))))

    return bind(_digits(text), lambda t: bind(F.regexp_extract_all(t, F.lit(_ANY), 0), lambda tokens: F.when(
        F.size(tokens) > 0, spans(tokens, split_at(t, _ANY))).otherwise(F.array().cast("array<struct<pos:int,amount:double,code:string>>"))))


def amounts_in_usd(text) -> Column:
    """M5 + J9: every amount of a text in USD, in text order.

    An amount is in the currency whose mention starts nearest to it (the first
    of two equally near), USD without any mention. Amounts and mentions stand
    in text order, so the running number of mentions says which mention is the
    last before an amount and which is the next after it; no other can be
    nearer, and the work grows with the number of both, not with their product.
    Where a text has one mention or none, no positions are needed.
    """
    codes = [(w.lower(), code) for w, code in CURRENCY_WORDS]
    rates = [(code, float(rate)) for code, rate in USD_RATES.items()]

    def swept(spans):
        mentions = F.filter(spans, lambda x: x["code"].isNotNull())
        passed = running_total(F.transform(spans, lambda x: F.when(x["code"].isNotNull(), 1).otherwise(0)))
        placed = F.filter(F.zip_with(spans, passed, lambda x, n: F.struct(x["pos"].alias("pos"), x["amount"].alias("amount"), n.alias("n"))),
                          lambda x: x["amount"].isNotNull())

        def usd(x, known):
            before, after = F.get(known, x["n"] - 1), F.get(known, x["n"])
            later = before.isNull() | (after["pos"] - x["pos"] < x["pos"] - before["pos"])
            code = F.when(after.isNotNull() & later, after["code"]).otherwise(before["code"])
            return x["amount"] * F.coalesce(_lookup(rates, code), F.lit(1.0))

        return bind(mentions, lambda known: F.transform(placed, lambda x: usd(x, known)))

    def code_of(token):
        return _lookup(codes, F.lower(token))

    def read(tokens):
        one = F.filter(F.transform(tokens, code_of), lambda c: c.isNotNull())

        def alike(known):
            rate = F.coalesce(_lookup(rates, F.get(known, 0)), F.lit(1.0))
            return bind(rate, lambda r: F.transform(F.filter(tokens, lambda t: code_of(t).isNull()), lambda t: _amount(t) * r))

        return bind(one, lambda known: F.when(F.size(known) > 1, bind(money_spans(text), swept)).otherwise(alike(known)))

    return bind(F.regexp_extract_all(_digits(text), F.lit(_ANY), 0), read)


def usd_from_text(text) -> Column:
    """M5 + J9 + A7: largest money amount in free text, in USD (null if none)."""
    return F.array_max(amounts_in_usd(text))
