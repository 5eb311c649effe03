"""Operator 5: main text of web pages by deducing the template of each host.

Tokens of a page are its tags, told apart by their path, and its text runs. Tokens of one host with the
same occurrence vector (how often they occur on each of its pages) are an equivalence class; the vector is
compared by an order-free fingerprint, so classes come out of two aggregations and no host is gathered in
a task. Classes that are large and frequent enough are checked on every page: their tokens have to follow each
other in one order, round by round, and each round of a class has to lie between two neighbouring tokens of
another class (a slot) or outside of it, in the same slot everywhere. Tokens out of order are taken from
their class, and of two classes that cross, the smaller is no part of the template. What is left is the template; its
tags that occur once on every page are its skeleton. What is inside article or main elements is kept whole,
unless they hold too little of the page; else text that belongs to the template is not content, and what the
skeleton element with most of the text holds is kept.
Roles that are named by the page itself (navigation, footers, adverts, comments and so on) are left out.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.joins import checked_broadcast

from .common import register, staged, table

# A class is part of a template if it has so many tokens, and text is part of it if it stands on so many
# pages of the host and on this share of them.
MIN_TOKENS = 3
MIN_PAGES = 10
MIN_SHARE = 0.8
# A skeleton element is the article's if it holds this share of the text.
MAIN_SHARE = 0.6
# Article and main elements with less of the text than this are teasers.
TEASER_SHARE = 0.25

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes iframe noscript template svg math".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody tfoot thead tr ul""".split())
# Elements whose text is no article text, wherever they stand.
LEFT_OUT = frozenset("""head script style textarea title xmp noframes iframe noscript template svg math nav aside footer
form button select option input label menu dialog object embed canvas audio video map""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# Words of class and id names that name something else than the article.
NAMED = re.compile(r"""(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banners?
|cookies?|consent|gdpr|notices?|popups?|modal|overlay|newsletter|subscribe|subscription|signup|login|sidebars?|side
|menus?|navs?|navbar|navigation|breadcrumbs?|pagination|pager|footers?|comments?|commentlist|respond|replies|reply
|disqus|share|sharing|social|related|recommended|widgets?|toolbar|masthead|skip)(?:$|[\s_-])""", re.VERBOSE | re.IGNORECASE)
SITE_HEADER = re.compile(r"(?:^|[\s_-])(?:header|site-header|page-header|topbar)(?:$|[\s_-])", re.IGNORECASE)
# Words that may stand beside those in the name of a part inside an article, so that names of its subjects
# (related-work, notice-of-award) are not taken for such parts.
PARTS = frozenset("""area bar block body bottom box button buttons col container content form group heading icon icons
inner item items left link links list media outer panel posts right row section text thread title top wrap wrapper""".split())
# Class names that only say whether a page has such a part.
_LAYOUT = ("no-", "has-", "with-", "without-", "is-", "hide-", "layout-", "page-", "single-")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</[^>]*(?:>|\Z)", re.DOTALL)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# A start tag of the key ends open elements of these names, back to the nearest of the second set.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select", "datalist"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
            "body": ({"head"}, {"html"})}


def names_other_part(name: str, in_article: bool) -> bool:
    """Whether a class or id name is that of something else than the article."""
    if name.lower().startswith(_LAYOUT) or not NAMED.search(name):
        return False
    return not in_article or all(w.lower() in PARTS or w.isdigit() or NAMED.fullmatch(w) for w in re.split("[_-]+", name) if w)


class Element:
    """An open element: name, path with class and id, and what it means for the text in it."""

    __slots__ = ("name", "path", "out", "main", "number")

    def __init__(self, name: str, attrs: dict[str, str], parent, number: int):
        named = f"{attrs.get('class', '')} {attrs.get('id', '')}".strip()
        self.name, self.number = name, number
        self.path = f"{parent.path if parent else ''}/{name}" + (f"[{named.lower()}]" if named else "")
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", ""))
        by_name = name in LEFT_OUT or attrs.get("role", "").lower() in ROLES or bool(hidden)
        reader_text = name not in ("html", "body") and any(names_other_part(x, bool(parent and parent.main)) for x in named.split())
        own_main = name in ("article", "main") or attrs.get("role", "").lower() in ("main", "article")
        if own_main and not by_name and not reader_text and not (parent and parent.out == "always"):
            # an article inside an element that is left out for its class only, which may never have ended
            self.out, self.main = "", True
        else:
            self.main = bool(parent and parent.main)
            site_header = not self.main and (name == "header" or bool(SITE_HEADER.search(named)))
            own = "always" if by_name or (own_main and reader_text) else "named" if reader_text or site_header else ""
            inherited = parent.out if parent else ""
            self.out = "always" if "always" in (own, inherited) else own or inherited


def parse(page: str):
    """(tags, runs): tags are (path, element number) in page order; runs are (block number, text, the
    innermost element, numbers of the open elements, number of tags before it), the text with its character
    references decoded."""
    stack: list[Element] = []
    tags: list[tuple[str, int]] = []
    runs: list[tuple] = []
    block, at, size, number = 0, 0, len(page), 0

    def text(lo, hi):
        if hi > lo:
            s = html.unescape(page[lo:hi])
            if s:
                runs.append((block, s, stack[-1] if stack else None, tuple(e.number for e in stack), number))

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text(at, size)
            break
        m = _MARKUP.match(page, lt)
        if m is None:
            # a stray sign is text
            text(at, lt + 1)
            at = lt + 1
            continue
        text(at, lt)
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCK:
            block += 1
        if m["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
            if depth is not None:
                del stack[depth:]
            continue
        if name == "br" or name in ("td", "th"):
            runs.append((block, " ", stack[-1] if stack else None, (), number))
        if name in BLOCK and any(e.name == "p" for e in stack):
            # a block ends an open paragraph, unless something that holds blocks was opened inside it
            p = max(i for i, e in enumerate(stack) if e.name == "p")
            if not any(e.name in ("object", "button", "td", "th", "caption") for e in stack[p:]):
                del stack[p:]
        if name in _IMPLIED:
            ends, limits = _IMPLIED[name]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in limits:
                    break
                if stack[i].name in ends:
                    del stack[i:]
        attrs = {}
        if m["attrs"].strip(" /\n\t"):
            for k, a, b, c in _ATTR.findall(m["attrs"]):
                attrs.setdefault(k.lower(), html.unescape(a or b or c))
        number += 1
        element = Element(name, attrs, stack[-1] if stack else None, number)
        tags.append((element.path, number))
        if name in VOID or m["attrs"].endswith("/") and name in ("svg", "math"):
            continue
        stack.append(element)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            stack.pop()
            at = end.end() if end else size
    return tags, runs


def _hash(s: str) -> int:
    digest = hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def run_token(element: Element | None, text: str) -> int:
    return _hash(f"{element.path if element else ''}\x00{text}")


def page_tokens(page: str) -> list[tuple[int, bool]]:
    """(token, whether it is text) of a page in page order."""
    tags, runs = parse(page)
    hashes: dict[str, int] = {}
    out, at = [], 0

    def tags_until(number):
        nonlocal at
        while at < len(tags) and tags[at][1] <= number:
            path = tags[at][0]
            if path not in hashes:
                hashes[path] = _hash(path)
            out.append((hashes[path], False))
            at += 1

    for _, text, element, _, number in runs:
        words = " ".join(text.split())
        if words:
            tags_until(number)
            out.append((run_token(element, words), True))
    tags_until(len(tags))
    return out


def _tokens(batches):
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            hosts, pages, tokens, is_text, counts, first = [], [], [], [], [], []
            for host, page, body in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html"))):
                seen: dict[tuple[int, bool], list[int]] = {(0, False): [1, 0]}
                for n, k in enumerate(page_tokens(body)):
                    if k in seen:
                        seen[k][0] += 1
                    else:
                        seen[k] = [1, n]
                for (token, kind), (n, place) in seen.items():
                    hosts.append(host)
                    pages.append(page)
                    tokens.append(token)
                    is_text.append(kind)
                    counts.append(n)
                    first.append(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(is_text, pa.bool_()), pa.array(counts, pa.int64()), pa.array(first, pa.int64())],
                names=["host", "page", "token", "is_text", "n", "at"])


def in_order(keys: list[int]) -> set[int]:
    """Places of ``keys`` that belong to every longest increasing run, of neighbours or not: where two keys have
    changed places, neither does."""
    def longest(values):
        tails: list[int] = []
        for v in values:
            at = bisect_left(tails, v)
            tails[at:at + 1] = [v]
            yield at

    ends = list(longest(keys))
    starts = list(longest([-k for k in reversed(keys)]))[::-1]
    most = max(ends, default=0)
    on_one: dict[int, list[int]] = {}
    for n, (a, z) in enumerate(zip(ends, starts)):
        if a + z == most:
            on_one.setdefault(a, []).append(n)
    return {places[0] for places in on_one.values() if len(places) == 1}


# What a page says of the classes on it: a class stands in a slot of a class (0: of none), a token is out of the
# order of its class, two classes cross.
SLOT, DISORDER, CROSSING = range(3)


def page_facts(tokens: list[tuple[int, bool]], place: dict[tuple[int, bool], tuple[int, int]],
               size: dict[int, int]) -> set[tuple[int, int, int, int]]:
    """(kind, class, class or token, slot or 0) of a page with these tokens.

    ``place`` has the class of a token and its number in the class, ``size`` the tokens of a class. The tokens of a
    class occur equally often on a page: round by round, they have to follow each other by their numbers.
    """
    rounds: dict[tuple[int, bool], int] = {}
    sequence, of_class = [], {}
    for k in tokens:
        if k in place:
            c, number = place[k]
            rounds[k] = rounds.get(k, -1) + 1
            of_class.setdefault(c, ([], []))
            of_class[c][0].append(rounds[k] * size[c] + number)
            of_class[c][1].append(k)
            sequence.append(c)
    facts = set()
    for c, (keys, own) in of_class.items():
        if any(a >= b for a, b in zip(keys, keys[1:])):
            kept = in_order(keys)
            # a token's kind is part of it
            facts.update((DISORDER, c, k[0], int(k[1])) for n, k in enumerate(own) if n not in kept)
    if facts:
        return facts
    # rounds that have begun and not ended, outermost first: class, tokens so far
    open_rounds: list[list[int]] = []
    for c in sequence:
        n = next((i for i in range(len(open_rounds) - 1, -1, -1) if open_rounds[i][0] == c), None)
        if n is None:
            parent = open_rounds[-1] if open_rounds else (0, 0)
            facts.add((SLOT, c, parent[0], parent[1]))
            open_rounds.append([c, 1])
            n = len(open_rounds) - 1
        else:
            facts.update((CROSSING, *sorted((c, x)), 0) for x, _ in open_rounds[n + 1:])
            open_rounds[n][1] += 1
        if open_rounds[n][1] >= size[c]:
            del open_rounds[n]
    return facts


def _facts(batches):
    known: dict[str, tuple[dict, dict]] = {}
    for b in batches:
        found, of_host = [], b.column("members")
        for n, (host, page, body) in enumerate(zip(*(b.column(c).to_pylist() for c in ("host", "page", "html")))):
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                place, size = {}, {}
                # in the order of the page that has the class and the smallest hash
                for m in of_host[n].as_py():
                    size[m["class"]] = size.get(m["class"], 0) + 1
                    place[m["token"], m["is_text"]] = m["class"], size[m["class"]] - 1
                known[host] = place, size
            found.extend((host, *x, page if x[0] == SLOT else 0) for x in page_facts(page_tokens(body), *known[host]))
        if found:
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string())] + [pa.array(c, pa.int64()) for c in columns[1:]],
                                             names=["host", "kind", "a", "b", "c", "page"])


def host_of(url) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _valid(pages: DataFrame, members: DataFrame) -> DataFrame:
    """The ``members`` (host, class, token, is_text, at, n_pages, once) of classes that are in order and nested.

    ``pages`` has (host, page, html). Hosts of which something was taken away are looked at again: their tokens
    that are out of order go first, then classes that cross a larger one, then those that stand in no slot
    on the share of the pages that is asked of a template.
    """
    by_class = ["host", "class"]
    valid = None
    while True:
        layout = members.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", "token", "is_text", "class"))).alias("members"))
        facts = staged(pages.join(checked_broadcast(staged(layout, "layout")), "host")
                       .mapInArrow(_facts, "host string, kind long, a long, b long, c long, page long")
                       .groupBy("host", "kind", "a", "b", "c").agg(F.count_distinct("page").alias("on")), "class-facts")
        wrong = facts.where(f"kind <> {SLOT}").groupBy("host").agg(F.min("kind").alias("worst"))
        # classes stand in a slot of their own, as tokens in different slots have different roles
        nested = (members.join(wrong, "host", "left_anti")
                  .join(facts.where(f"kind = {SLOT}").groupBy("host", F.col("a").alias("class")).agg(F.max("on").alias("on")), by_class)
                  .where(F.col("on") >= MIN_SHARE * F.col("n_pages")).drop("on"))
        valid = nested if valid is None else valid.unionByName(nested)
        if wrong.isEmpty():
            return valid
        again = members.join(wrong, "host")
        stray = facts.where(f"kind = {DISORDER}").select("host", F.col("a").alias("class"), F.col("b").alias("token"),
                                                         F.col("c").cast("boolean").alias("is_text"))
        # the larger of two classes, and of equal ones the one with the larger name
        sizes = members.groupBy(*by_class).agg(F.count(F.lit(1)).alias("n"))
        pairs = facts.where(f"kind = {CROSSING}").select("host", "a", "b")
        sized = (pairs.join(sizes.select("host", F.col("class").alias("a"), F.struct("n", "class").alias("size_a")), ["host", "a"])
                 .join(sizes.select("host", F.col("class").alias("b"), F.struct("n", "class").alias("size_b")), ["host", "b"])
                 .select("host", F.least("size_a", "size_b")["class"].alias("class"), F.greatest("size_a", "size_b")["class"].alias("over")))
        beaten = sized.select("host", F.col("class").alias("over")).distinct()
        crossing = sized.join(beaten, ["host", "over"], "left_anti").select(*by_class).distinct()
        left = (again.where(f"worst = {DISORDER}").join(stray, ["host", "class", "token", "is_text"], "left_anti")
                .unionByName(again.where(f"worst = {CROSSING}").join(crossing, by_class, "left_anti"))).drop("worst")
        members = staged(left.join(left.groupBy(*by_class).agg(F.count(F.lit(1)).alias("n")).where(f"n >= {MIN_TOKENS}").drop("n"), by_class),
                         "class-members")


def templates(pages: DataFrame) -> DataFrame:
    """(host, template_text, skeleton): tokens of text that the template holds, and of tags that occur once
    on every page. ``pages`` has (host, html). Equal pages of a host count as one, else an article with many
    copies would be taken for the template."""
    hashed = pages.withColumn("page", F.xxhash64("html"))
    tokens = (hashed.dropDuplicates(["host", "page"])
              .mapInArrow(_tokens, "host string, page long, token long, is_text boolean, n long, at long"))
    # all tokens of a class are on the same pages, so that their places are those on one page
    vectors = tokens.groupBy("host", "token", "is_text").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("on_pages"), F.sum("n").alias("total"),
        F.min_by("at", "page").alias("at"))
    vectors = staged(vectors.where(f"on_pages >= {MIN_PAGES} or token = 0"), "token-vectors")
    n_pages = vectors.where("token = 0").select("host", F.col("on_pages").alias("n_pages"))
    classes = (vectors.where("token <> 0").groupBy("host", "vector", "on_pages", "total").agg(F.count(F.lit(1)).alias("n_tokens"))
               .where(f"n_tokens >= {MIN_TOKENS}"))
    # a token on this share of the pages is found on each page about as often: a template is as long as a page
    frequent = (vectors.where("token <> 0").join(classes, ["host", "vector", "on_pages", "total"])
                .join(n_pages, "host").where(F.col("on_pages") >= MIN_SHARE * F.col("n_pages")))
    once = ~F.col("is_text") & (F.col("on_pages") == F.col("n_pages")) & (F.col("total") == F.col("n_pages"))
    members = staged(frequent.select("host", F.xxhash64("vector", "on_pages", "total").alias("class"), "token", "is_text", "at",
                                     "n_pages", once.alias("once")), "class-members")
    return _valid(hashed, members).groupBy("host").agg(
        F.collect_set(F.when(F.col("is_text"), F.col("token"))).alias("template_text"),
        F.collect_set(F.when(F.col("once"), F.col("token"))).alias("skeleton"))


def main_text(page: str, template_text=frozenset(), skeleton=frozenset()) -> str:
    """Blocks of the article joined by \\n.

    Text inside article and main elements is never taken for template text. If these hold less than
    ``TEASER_SHARE`` of the text that is neither the template's nor left out, they are teasers, and the
    article is in the innermost element (of the skeleton, if the host has one) that holds most of the text.
    """
    tags, runs = parse(page)
    kept = []
    for block, text, element, inside, _ in runs:
        main, out = (element.main, element.out) if element else (False, "")
        of_template = not main and template_text and text.strip() and run_token(element, " ".join(text.split())) in template_text
        if not out and not of_template:
            kept.append((block, text, element, inside))
    in_main = [r for r in kept if r[2] is not None and r[2].main]
    total = sum(len(t.strip()) for _, t, _, _ in kept)
    if in_main and sum(len(t.strip()) for _, t, _, _ in in_main) >= max(1, TEASER_SHARE * total):
        kept = in_main
    elif skeleton or in_main:
        # the innermost element of the skeleton that holds most of the text
        sizes: dict[int, int] = {}
        for _, text, _, inside in kept:
            for n in inside:
                sizes[n] = sizes.get(n, 0) + len(text.strip())
        holders = [n for path, n in tags if sizes.get(n, 0) >= MAIN_SHARE * total and (not skeleton or _hash(path) in skeleton)]
        if holders:
            kept = [r for r in kept if holders[-1] in r[3]]
    blocks: dict[int, list[str]] = {}
    for block, text, _, _ in kept:
        blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def _extract(batches):
    sets: dict[str, tuple[frozenset, frozenset]] = {}
    for b in batches:
        for at in range(0, b.num_rows, 200):
            part = b.slice(at, 200)
            out = []
            text, tags = part.column("template_text"), part.column("skeleton")
            for n, (host, body) in enumerate(zip(*(part.column(c).to_pylist() for c in ("host", "html")))):
                if host not in sets:
                    if len(sets) > 1000:
                        sets.clear()
                    sets[host] = (frozenset(text[n].as_py() or ()), frozenset(tags[n].as_py() or ()))
                out.append(main_text(body, *sets[host]))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string()),
                                              pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): one row per input row.

    Null or empty pages give an empty text; pages without a usable url form a host of their own; repeated
    rows are pages of their own and extra columns are ignored. A host with fewer than ``MIN_PAGES`` different pages
    has no template, and its pages are read by their own elements alone. Character references are
    decoded, white space (as in str.split) inside a block becomes one space, and blocks are joined by \\n.
    """
    slim = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html")).withColumn("host", host_of(F.col("url")))
    found = templates(slim.select("host", "html"))
    found = checked_broadcast(staged(found, "templates"))
    return slim.join(found, "host", "left").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


@register("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
