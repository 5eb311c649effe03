"""Semi-structured extraction from stored model responses.

Responses are text holding one or more Python-literal dicts. Everything
here is a built-in Column expression: regex extraction, a literal-to-JSON
rewrite and ``from_json``; nothing is evaluated as code. Most responses hold
flat dicts, which one regex cuts out; where braces nest or stand inside
quotes, a pattern of the literal grammar reads the dicts, and only what it
leaves over goes through a fold over braces.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import PROJECT_FIELDS
from .text import WS, bind, literal_array, split_at

PROJECT_STRUCT = T.StructType([T.StructField(name, T.StringType()) for name, _ in PROJECT_FIELDS])


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_values(text, names) -> Column:
    """L1: all values of ``'Name': '...'`` (case-insensitive), alternatives in order.

    Values holding an apostrophe are not read (the pattern stops at ``'``);
    null text gives an empty array.
    """
    parts = [F.regexp_extract_all(_c(text), F.lit(rf"(?iu)'{re.escape(n)}':[{WS}]*'([^']+)'"), 1)
             for n in names]
    arr = parts[0] if len(parts) == 1 else F.concat(*parts)
    return F.coalesce(arr, F.array().cast("array<string>"))


def _closed_blocks(text) -> Column:
    """``array<struct<block, inner>>``: every balanced ``{...}`` block, in the order it closes, and whether
    it lies in another block.

    The text is cut at its braces; a fold over the pieces keeps the texts of the open blocks. A brace
    without a partner is ignored.
    """
    piece_type = "array<struct<b:string,p:string>>"
    none = F.array().cast("array<struct<block:string,inner:boolean>>")
    state = F.struct(F.array().cast("array<string>").alias("open"), none.alias("out"))

    def step(acc, x):
        depth, top = F.size(acc["open"]), F.element_at(acc["open"], -1)
        opened = F.struct(F.array_append(acc["open"], F.concat(F.lit("{"), x["p"])).alias("open"), acc["out"].alias("out"))
        # the closed text goes on in the block around it
        around = F.array_append(F.slice(acc["open"], 1, F.greatest(depth - 2, F.lit(0))),
                                F.concat(F.get(acc["open"], depth - 2), top, F.lit("}"), x["p"]))
        closed = F.struct(
            F.when(depth > 1, around).otherwise(F.array().cast("array<string>")).alias("open"),
            F.array_append(acc["out"], F.struct(F.concat(top, F.lit("}")).alias("block"), (depth > 1).alias("inner"))).alias("out"))
        return F.when(x["b"] == "{", opened).when(depth > 0, closed).otherwise(acc)

    t = _c(text)
    cut = F.arrays_zip(F.regexp_extract_all(t, F.lit(r"[{}]"), 0).alias("b"), F.slice(F.split(t, r"[{}]"), 2, 1 << 30).alias("p"))
    return F.coalesce(F.aggregate(cut.cast(piece_type), state, step, lambda acc: acc["out"]), none)


def dict_blocks(text) -> Column:
    """L4: every balanced ``{...}`` block, in the order it closes (inner before outer)."""
    return F.transform(_closed_blocks(text), lambda b: b["block"])


# A quoted string of a literal; the loops never give back, so a long value costs no stack.
_STRING = r"""(?:'[^'\\\n]*+(?:\\[\s\S][^'\\\n]*+)*+'|"[^"\\\n]*+(?:\\[\s\S][^"\\\n]*+)*+")"""
_SCALAR = rf"(?:{_STRING}(?:\s*+{_STRING})*+|[-+]?[0-9][0-9.eE+_-]*+|None|True|False|null|true|false)"


def _listed(item: str) -> str:
    return rf"(?:{item}\s*+(?:,\s*+{item}\s*+)*+,?+\s*+)?+"


def _value_pattern(depth: int) -> str:
    """A value of the literal grammar that holds lists, tuples and dicts up to ``depth`` deep."""
    if depth == 0:
        return _SCALAR
    inner = _value_pattern(depth - 1)
    return rf"(?:{_SCALAR}|[\[(]\s*+{_listed(inner)}[\])]|{_dict_pattern(depth - 1)})"


def _dict_pattern(depth: int) -> str:
    return rf"\{{\s*+{_listed(rf'{_STRING}' + r'\s*+:\s*+' + _value_pattern(depth))}\}}"


# Dicts that hold dicts that hold dicts; deeper ones are found by their braces.
DEPTH = 2


def literal_blocks(text) -> Column:
    """``array<struct<block, inner>>`` like ``_closed_blocks``, by the grammar of literals: braces inside quotes belong to
    their string, and a dict inside another comes before it. What is no literal is cut by its braces alone."""
    def inside(block, depth):
        if depth < 0:
            return F.array().cast("array<struct<block:string,inner:boolean>>")
        found = F.regexp_extract_all(F.substring(block, 2, 1 << 30), F.lit(_dict_pattern(depth)), 0)
        return F.flatten(F.transform(found, lambda b: F.concat(inside(b, depth - 1), F.array(F.struct(b.alias("block"), F.lit(True).alias("inner"))))))

    def with_gap(gap, top):
        rest = F.when(gap.rlike("[{}]"), _closed_blocks(gap)).otherwise(F.array().cast("array<struct<block:string,inner:boolean>>"))
        mine = F.concat(inside(top, DEPTH - 1), F.array(F.struct(top.alias("block"), F.lit(False).alias("inner"))))
        return F.when(top.isNull(), rest).otherwise(F.concat(rest, mine))

    whole = _dict_pattern(DEPTH)
    t = _c(text)
    return F.flatten(F.zip_with(split_at(t, whole), F.regexp_extract_all(t, F.lit(whole), 0), with_gap))


# Marks a list, so that it can be told from text that begins with a bracket.
_LIST_MARK = "\\u0002"


def simple_to_json(block) -> Column:
    """Rewrite a dict of plain values to JSON text (quotes stay for Jackson).

    Bare ``None``/``True``/``False`` after a quoted key become
    ``null``/``true``/``false``; ``\\xNN`` escapes become ``\\u00NN``.
    """
    def worded(b):
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            b = F.regexp_replace(b, rf"({_STRING}\s*+:\s*+){word}(?=\s*[,}}])", f"$1{json_word}")
        return b

    words = F.when(_c(block).rlike("None|True|False"), worded(_c(block))).otherwise(_c(block))
    return bind(words, lambda b: F.when(F.contains(b, F.lit(r"\x")), F.regexp_replace(
        b, r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")).otherwise(b))


def literal_to_json(block) -> Column:
    """Rewrite a Python-literal dict to JSON text, piece by piece: quoted strings, and what stands between them.

    Strings get double quotes (``\\xNN`` escapes become ``\\u00NN``), neighbouring strings become one. Between strings
    ``None``/``True``/``False`` become ``null``/``true``/``false``, tuples become lists, and a list gets a mark as its first element.
    """
    def string(x):
        body = F.substring(x, F.lit(2), F.length(x) - 2)
        body = F.regexp_replace(body, r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
        return F.when(x.startswith("'"), F.regexp_replace(body, r'(?<!\\)((?:\\\\)*+)"', r'$1\\"')).otherwise(body)

    def between(x):
        x = F.regexp_replace(x, r",\s*([\])}])", "$1")
        x = F.regexp_replace(x, r"[\[(]", '["' + _LIST_MARK.replace("\\", "\\\\") + '",')
        x = F.regexp_replace(F.replace(x, F.lit(")"), F.lit("]")), r",\]", "]")
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            x = F.replace(x, F.lit(word), F.lit(json_word))
        return x

    def quoted(x):
        return x.startswith("'") | x.startswith('"')

    def piece(all_, x, i):
        before, after = F.coalesce(quoted(F.get(all_, i - 1)), F.lit(False)), F.coalesce(quoted(F.get(all_, i + 1)), F.lit(False))
        text = F.concat(F.when(before, F.lit("")).otherwise(F.lit('"')), string(x), F.when(after, F.lit("")).otherwise(F.lit('"')))
        return F.when(quoted(x), text).otherwise(between(x))

    pieces = F.filter(F.regexp_extract_all(_c(block), F.lit(_STRING + r"|[^'\"]++|['\"]"), 0), lambda x: ~x.rlike(r"^\s*$"))
    return bind(pieces, lambda all_: F.array_join(F.transform(all_, lambda x, i: piece(all_, x, i)), ""))


def parse_literal_dict(block) -> Column:
    """One dict block -> ``map<string,string>`` (null when it does not parse). The values of a list or tuple are
    joined by ``, ``; a dict as a value stays as JSON text.

    Most dicts hold plain values, which Jackson reads nearly as they stand; others, and what it does not read, are
    rewritten piece by piece.
    """
    kind = T.MapType(T.StringType(), T.StringType())
    head = '["' + _LIST_MARK + '"'

    def value(v):
        items = F.slice(F.from_json(v, "array<string>", {"mode": "PERMISSIVE"}), 2, 1 << 30)
        listed = F.array_join(F.transform(items, lambda x: F.coalesce(x, F.lit("None"))), ", ")
        return F.when(v.startswith(head), listed).otherwise(F.replace(F.replace(v, F.lit(head + ","), F.lit("[")), F.lit(head), F.lit("[")))

    def rewritten(b):
        parsed = F.from_json(literal_to_json(b), kind, {"allowBackslashEscapingAnyCharacter": "true", "mode": "PERMISSIVE"})
        return F.transform_values(parsed, lambda k, v: F.when(F.contains(v, F.lit(head)), value(v)).otherwise(v))

    def read(b):
        plain = F.from_json(simple_to_json(b), kind, {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true", "mode": "PERMISSIVE"})
        return bind(F.when(~b.rlike(r":\s*[\[(]"), plain), lambda m: F.when(m.isNull(), rewritten(b)).otherwise(m))

    return bind(_c(block), read)


def map_to_project(m) -> Column:
    """Parsed dict -> project struct; alternative key names in order."""
    m = _c(m)
    fields = []
    for name, alts in PROJECT_FIELDS:
        vals = [F.element_at(m, F.lit(a)) for a in alts]
        fields.append((vals[0] if len(vals) == 1 else F.coalesce(*vals)).alias(name))
    return F.struct(*fields)


def text_to_map(text) -> Column:
    """Lines ``key - value`` (value after ``:`` if any) -> map; last key wins.

    A line holding ``Project:`` gives the key ``Project``.
    """
    lines = F.transform(F.split(F.regexp_replace(_c(text), r"^\s+|\s+$", ""), "\n"),
                        lambda ln: F.regexp_replace(ln, r"^\s+|\s+$", ""))

    def entry(ln):
        dash_key = F.regexp_replace(F.split_part(ln, F.lit("-"), F.lit(1)), r"^\s+|\s+$", "")
        rest = F.regexp_replace(F.regexp_replace(ln, r"^[^-]*-", ""), r"^\s+|\s+$", "")
        value = F.when(F.contains(rest, F.lit(":")),
                       F.regexp_replace(F.split_part(rest, F.lit(":"), F.lit(2)), r"^\s+|\s+$", "")
                       ).otherwise(rest)
        project = F.regexp_replace(F.split_part(ln, F.lit(":"), F.lit(2)), r"^\s+|\s+$", "")
        return (F.when(F.contains(ln, F.lit("Project:")), F.struct(F.lit("Project").alias("k"), project.alias("v")))
                .when(F.contains(ln, F.lit("-")), F.struct(dash_key.alias("k"), value.alias("v"))))

    def last(entries):
        # the last entry of each key stays (a later line overwrites an earlier one)
        keys = F.transform(entries, lambda e: e["k"])
        return bind(keys, lambda ks: F.map_from_entries(F.filter(
            entries, lambda e, i: ~F.array_contains(F.slice(ks, i + 2, 1 << 30), e["k"]))))

    return bind(lines, lambda all_: bind(F.filter(F.transform(all_, entry), lambda e: e.isNotNull()), last))


def parsed_dicts(response) -> Column:
    """L4 + L5: every dict block that parses, as a project struct, in the order the blocks close.

    A dict inside another one that has none of the project fields is no project.
    """
    names = literal_array([a for _, alts in PROJECT_FIELDS for a in alts])

    def blocks(r):
        flat = F.regexp_extract_all(r, F.lit(r"\{[^{}]*+\}"), 0)
        braces = F.length(r) - F.length(F.translate(r, "{}", ""))
        # literals that account for every brace: nothing nests, nothing is quoted
        return bind(flat, lambda found: F.when(
            (braces == 2 * F.size(found)) & F.forall(found, lambda b: b.rlike(rf"\A{_dict_pattern(1)}\z")),
            F.transform(found, lambda b: F.struct(b.alias("block"), F.lit(False).alias("inner")))).otherwise(literal_blocks(r)))

    maps = F.transform(bind(_c(response), blocks), lambda b: F.struct(parse_literal_dict(b["block"]).alias("m"), b["inner"].alias("inner")))
    kept = F.filter(maps, lambda x: x["m"].isNotNull() & (~x["inner"] | F.arrays_overlap(F.map_keys(x["m"]), names)))
    return F.transform(kept, lambda x: map_to_project(x["m"]))


def with_fallback(response, projects) -> Column:
    """L6 fallback: when no dict parsed, the ``key - value`` lines are one project."""
    r = _c(response)
    none = F.array().cast(T.ArrayType(PROJECT_STRUCT))
    lines = F.transform(F.array(text_to_map(r)), map_to_project)
    # lambda arguments are computed once, whatever projections Spark folds into one
    return F.when(r.isNull(), none).otherwise(bind(projects, lambda p: F.when(F.size(p) > 0, p).otherwise(lines)))


def parse_projects(response) -> Column:
    """L4+L5(+L6 fallback): response text -> ``array<struct<7 fields>>``.

    Every dict block that parses gives one project, in text order; when no
    block parses, the ``key - value`` lines are read as one project.
    (``operators.nested.explode_projects`` computes the parsed array once
    in its own projection before applying the fallback.)
    """
    return with_fallback(response, parsed_dicts(response))
