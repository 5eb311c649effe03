"""HTML text extraction as Column expressions (H1-H3, H5).

Regex-based, not a DOM: tags are removed, character references are decoded,
and element bounds follow the rules stated on each function.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, literal_map

# ---------------------------------------------------------------- fixed values
# Closing tags that end an unclosed paragraph.
PARAGRAPH_ENDS = ["p", "article", "section", "div", "body"]

NOISE_RE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
TAG_RE = r"<[^>]+>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code_point(number: Column) -> Column:
    """The character with a code point, U+FFFD for numbers that are none."""
    def char(n):
        bad = n.isNull() | (n <= 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(n).cast("int")), 8, "0")), "UTF-32")

    return bind(number, char)


def unescape(text) -> Column:
    """Decode character references, each once: ``&name;`` of HTML 4 (and ``&apos;``),
    ``&#n;`` and ``&#xh;``. Anything else stays as written."""
    named = {**{k: chr(v) for k, v in name2codepoint.items()}, "apos": "'"}
    table = literal_map(dict(sorted(named.items())))

    def decoded(piece, i):
        name = F.regexp_extract(piece, r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", 1)
        return F.when(i == 0, piece).otherwise(bind(name, lambda n: spelled(piece, n)))

    def number(name):
        # leading zeros say nothing; more digits than a code point has are no code point
        return bind(F.regexp_replace(name, "^#[xX]?0*", ""), lambda digits: F.when(
            name.rlike("^#[xX]"), F.when(F.length(digits) <= 6, F.conv(F.concat(F.lit("0"), digits), 16, 10).try_cast("bigint"))).otherwise(
            F.when(F.length(digits) <= 7, F.concat(F.lit("0"), digits).try_cast("bigint"))))

    def spelled(piece, name):
        char = F.when(name.startswith("#"), _code_point(number(name))).when(name != "", F.try_element_at(table, name))
        rest = F.substring(piece, F.length(name) + 2, 1 << 30)
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    return bind(_c(text), lambda t: F.when(F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), decoded), "")).otherwise(t))


def drop_noise(html) -> Column:
    """Remove script, style and comment blocks (their text is never content)."""
    return F.regexp_replace(_c(html), NOISE_RE, " ")


def strip_tags(fragment) -> Column:
    """Text of an HTML fragment: tags removed, entities decoded."""
    return unescape(F.regexp_replace(_c(fragment), TAG_RE, ""))


def paragraphs_text(html) -> Column:
    """H3: text of every ``<p>``, each once, joined by one space.

    A paragraph runs from its ``<p>`` to the first ``</p>``, the next ``<p>``
    or the close of an enclosing block, whichever comes first.
    """
    clean = drop_noise(html)
    ends = "|".join(f"</{t}\\s*>" for t in PARAGRAPH_ENDS)
    marked = F.regexp_replace(F.regexp_replace(clean, r"(?i)<p(\s[^>]*)?>", "\u0001"),
                              f"(?i){ends}", "\u0002")
    pieces = F.slice(F.split(marked, "\u0001"), 2, 1 << 30)
    texts = F.transform(pieces, lambda s: strip_tags(F.split_part(s, F.lit("\u0002"), F.lit(1))))
    return F.array_join(texts, " ")


def attribute(tag, name: str) -> Column:
    """Value of an attribute in the text of a tag, up to the same kind of quote, its
    character references decoded; null without the attribute."""
    pattern = rf"(?is)[\s\"']{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"

    def read(t):
        return F.when(t.rlike(pattern), unescape(F.concat(*(F.regexp_extract(t, pattern, i) for i in (1, 2, 3)))))

    return bind(_c(tag), read)


def element_html(html, tag: str, css_class: str | None = None) -> Column:
    """Markup inside the first ``<tag class="... css_class ...">``, else null.

    Elements of the same name may nest: the element ends at its own close
    tag, or with the page if there is none.
    """
    cls = "" if css_class is None else (
        rf"""(?=[^>]*\sclass\s*=\s*(?:"(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"|'(?:[^']*\s)?{css_class}(?:\s[^']*)?'|{css_class}[\s>]))""")
    opening = rf"(?is)<{tag}(?=[\s>]){cls}[^>]*>"
    own = rf"(?is)</?{tag}(?=[\s>])[^>]*>"

    def walk(acc, t):
        """Depth, and how many tags of this name were passed, up to the close tag that ends the element."""
        step = F.when(t.startswith("</"), -1).otherwise(1)
        return F.when(acc["depth"] == 0, acc).otherwise(
            F.struct((acc["depth"] + step).alias("depth"), (acc["n"] + 1).alias("n")))

    def inner(rest):
        tags = F.regexp_extract_all(rest, F.lit(own), 0)
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
        before_end = F.aggregate(tags, start, walk, lambda acc: acc["n"] - F.when(acc["depth"] == 0, 1).otherwise(0))
        parts = F.arrays_zip(tags.alias("t"), F.slice(F.split(rest, own), 2, 1 << 30).alias("p"))
        return F.concat(F.regexp_replace(rest, own + r".*\z", ""), F.array_join(
            F.transform(F.slice(parts, 1, before_end), lambda z: F.concat(z["t"], z["p"])), ""))

    def found(clean):
        return F.when(clean.rlike(opening), bind(F.regexp_extract(clean, opening + r"(.*)\z", 1), inner))

    return bind(drop_noise(html), found)


def element_text(html, tag: str, css_class: str | None = None) -> Column:
    """H1: text of the first ``<tag class="... css_class ...">`` element, else null."""
    return strip_tags(element_html(html, tag, css_class))


def first_element_text(html, selectors) -> Column:
    """H7: text of the first selector (``(tag, class)``) present, else null."""
    return F.coalesce(*[element_text(html, t, c) for t, c in selectors])


def absolute_url(base, rel) -> Column:
    """H5: resolve a link against the page URL.

    Handles absolute links, ``//host/p``, ``/p``, ``?q``, ``#f`` and relative
    paths (``./`` and ``../`` segments are resolved).
    """
    b, r = _c(base), _c(rel)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(b, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path = F.regexp_extract(no_query, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/.*)?$", 1)
    base_dir = F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), r"[^/]*$", "")
    joined = F.concat(base_dir, r)
    segs = F.split(F.regexp_replace(joined, r"[?#].*$", ""), "/")
    tail = F.regexp_extract(joined, r"([?#].*)$", 1)

    def fold(acc, s):
        return (F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
                .when(s == ".", acc).otherwise(F.array_append(acc, s)))

    resolved = F.aggregate(F.slice(segs, 2, 1 << 30), F.array().cast("array<string>"), fold)
    last = F.element_at(segs, -1)
    trailing = F.when((last == "..") | (last == "."), F.lit("/")).otherwise(F.lit(""))
    rel_path = F.concat(F.lit("/"), F.array_join(resolved, "/"), trailing, tail)
    return (F.when(r.rlike(r"^https?://"), r)
            .when(r.startswith("//"), F.concat(scheme, F.lit(":"), r))
            .when(r.startswith("/"), F.concat(origin, r))
            .when(r.startswith("?"), F.concat(no_query, r))
            .when(r.startswith("#"), F.concat(no_frag, r))
            .when(r == "", no_frag)
            .otherwise(F.concat(origin, rel_path)))
