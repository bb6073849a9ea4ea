"""Main text of web pages by markup and nearest-URL page differencing.

A page becomes text lines, one per block, without what markup itself declares to be no article (menus, page headers,
footers, sidebars, forms, adverts, comments, scripts, styles). Pages of a host are ordered by URL path, and each is
paired with the nearer of its two neighbours (edit distance of the paths, the one before on a tie). The lines of a pair
are aligned by longest common subsequence; lines that both share are template text and go. Lines inside a declared
article are never template text: pages of one host may quote the same passage. If a page declares an article, its lines
are the main text; otherwise all lines that differencing leaves are.

Scale: the order within a host comes from a range partitioning by host, path and key, with neighbours across partition
borders looked up in a table of one row per partition; a host of any size is cut into ranges. Only line hashes meet for
the alignment; the pages themselves move once, to meet their neighbour's hashes.

Parsing is linear in the length of a page, however broken it is.

Edge cases: names of classes and ids count as whole tokens and never make html, body, main, article or what holds the main
element chrome. A self-closed tag ends where it closes. Null or empty html gives the empty text. Null or odd URLs have
empty host and path and pair with each other. Pages without a neighbour keep all lines. Repeated rows (same id, URL and
html) count as one page for pairing and get equal texts. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Set

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import materialise

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<""",
    re.S,
)
_TEXT = re.compile("[^<]++|<")
# place of a tag that names chrome, and those around it
_Named = tuple
# a whole attribute, so that nothing inside a value is taken for a name; an unclosed quote runs to the end
_ATTRIBUTE = re.compile(
    r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s"'>]++)))?""", re.S
)
_CLOSED_BY = {t: re.compile(rf"</{t}\b[^>]*+>", re.I) for t in ("script", "style", "textarea", "title", "noscript",
                                                               "iframe", "template", "svg", "xmp")}
_OPENED_BY = {t: re.compile(rf"<{t}\b", re.I) for t in _CLOSED_BY}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
CHROME = frozenset("nav footer aside form button select dialog menu head object canvas audio video map".split())
ARTICLE = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# a class or id names chrome if each of its parts does or says where or in what form, as in site-footer or ad-slot-2;
# other parts turn the meaning (has-sidebar, menu-open, social-science)
_CHROME_PART = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|sidebar|nav|navbar|navigation|menu|"
    r"breadcrumbs?|comments?|disqus|share|sharing|social|related|recommend\w*|newsletter|subscribe|popup|modal|overlay|"
    r"pagination|pager|footer|toolbar|widget",
    re.I,
)
_PLAIN_PART = re.compile(
    r"site|page|global|main|primary|secondary|top|bottom|left|right|sticky|fixed|mobile|desktop|post|entry|article|posts|"
    r"articles|stories|reading|box|bar|wrap|wrapper|container|inner|outer|area|section|block|panel|slot|unit|zone|list|"
    r"items?|links?|buttons?|icons?|tools?|header|heading|title|label|body|text|message|group|form|signup|\d*",
    re.I,
)
_WHOLE_NAME = frozenset(("side-bar", "skip-link"))
UNNAMED = frozenset(("html", "body", "main", "article"))


def _attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


# names judged before; a plain dict, which travels to workers with the functions
_JUDGED: dict[str, bool] = {}


def _names_chrome(name: str) -> bool:
    known = _JUDGED.get(name)
    if known is None:
        parts = re.split("[-_]+", name)
        known = name.lower() in _WHOLE_NAME or (
            any(map(_CHROME_PART.fullmatch, parts))
            and all(_CHROME_PART.fullmatch(p) or _PLAIN_PART.fullmatch(p) for p in parts)
        )
        if len(_JUDGED) >= 1 << 14:
            _JUDGED.clear()
        _JUDGED[name] = known
    return known


def _declared_chrome(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether the element itself says that it is no article text."""
    if tag in CHROME or (tag == "header" and not in_article) or "hidden" in attributes:
        return True
    return attributes.get("role", "").lower() in ROLES or attributes.get("aria-hidden", "").lower() == "true"


def _named_chrome(tag: str, attributes: dict[str, str]) -> bool:
    """Whether its names say so."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}" if tag not in UNNAMED else ""
    return any(map(_names_chrome, names.split()))


def page_lines(page: str | None) -> list[tuple[str, bool]]:
    """Text lines of a page in order, each with whether it lies in a declared article.

    What holds the main element is no chrome, whatever its names are, and what holds an article is none unless the page
    declares its article elsewhere. Such an article may as well be a list of comments: its lines stay as undeclared ones.
    """
    mains: set[int] = set()
    articles: set[int] = set()
    lines = _lines(page or "", frozenset(), frozenset(), mains, articles)
    if mains:
        lines = _lines(page, mains, frozenset(), set(), articles)
    if articles and not any(inside for _, inside in lines):
        lines = _lines(page, mains, articles, set(), set())
    return lines


def _lines(
    page: str, mains: Set[int], articles: Set[int], hold_main: set[int], hold_article: set[int]
) -> list[tuple[str, bool]]:
    """``mains``, ``articles``: places of tags whose names do not count. The other two collect such places."""
    lines: list[tuple[str, bool]] = []
    held: list[str] = []
    # tag, chrome, article, chrome by more than names, the named tags around, whether one is in ``articles``
    stack: list[tuple[str, bool, bool, bool, _Named | None, bool]] = []
    top = ("", False, False, False, None, False)
    chrome = article = sure = doubtful = False
    # place of the innermost named tag, and the named tags around it
    named: _Named | None = None
    # what keeps broken pages linear: open elements by tag and those that are not inline, the next end of a raw element, the
    # last place where a tag can end
    opened: dict[str, int] = {}
    solid: list[int] = []
    ends: dict[str, re.Match | None] = {}
    last_end = page.rfind(">")

    def close_block():
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                lines.append((text, article))

    def pop_to(k: int):
        nonlocal chrome, article, sure, named, doubtful
        for entry in stack[k:]:
            opened[entry[0]] -= 1
        del stack[k:]
        while solid and solid[-1] >= k:
            solid.pop()
        _, chrome, article, sure, named, doubtful = stack[-1] if stack else top

    def raw_end(tag: str, at: int) -> re.Match | None:
        if tag not in ends or (ends[tag] and ends[tag].start() < at):
            ends[tag] = _CLOSED_BY[tag].search(page, at)
        return ends[tag]

    def collect(hold: set[int]):
        chain = named
        while chain and chain[0] not in hold:  # those around it are held as well
            hold.add(chain[0])
            chain = chain[1]

    at = 0
    while at < len(page):
        if at > last_end and not page.startswith("<!--", at):
            m = _TEXT.match(page, at)
            place, at = at, m.end()
            if not chrome:
                held.append(entities.unescape(m[0]))
            continue
        m = _TOKEN.match(page, at)
        place, at = at, m.end()
        tag = m[2] or m[5]
        if tag is None:
            text = m[0]
            if not chrome and (text == "<" or text[0] != "<"):
                held.append(entities.unescape(text))
            continue
        tag, closing, rest = tag.lower(), bool(m[1] or m[4]), (m[3] or m[6] or "")
        if tag == "br":
            held.append(" ")
            continue
        if tag not in INLINE and not chrome:
            close_block()
        if closing:
            if opened.get(tag):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
            continue
        if tag in _CLOSED_BY:
            end = raw_end(tag, at)
            if rest.endswith("/"):
                # it ends here, unless its own closing tag follows before another one opens
                if tag == "svg" or not end or _OPENED_BY[tag].search(page, at, end.start()):
                    continue
            at = end.end() if end else len(page)
            continue
        if tag in VOID or rest.endswith("/"):
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            # an open element of the same kind ends here, unless a container stands in between
            for k in reversed(solid) if opened.get(tag) else ():
                if stack[k][0] == tag:
                    pop_to(k)
                    break
                if stack[k][0] not in ("p", "dt", "dd", "td", "th"):
                    break
        elif tag not in INLINE and solid and stack[solid[-1]][0] == "p":
            pop_to(solid[-1])  # blocks end an open paragraph
        attributes = _attributes(rest) if rest else {}
        main = tag == "main" or attributes.get("role", "").lower() == "main"
        sure = sure or _declared_chrome(tag, attributes, article)
        if not sure and named and (main or tag == "article"):
            collect(hold_main if main else hold_article)
        if not sure and not main and _named_chrome(tag, attributes):
            if place in articles:
                doubtful = True
            elif place not in mains:
                named = (place, named)
        chrome = sure or named is not None
        article = article or main or (tag == "article" and not doubtful)
        if tag not in INLINE:
            solid.append(len(stack))
        stack.append((tag, chrome, article, sure, named, doubtful))
        opened[tag] = opened.get(tag, 0) + 1
    close_block()
    return lines


def line_hashes(lines: list[tuple[str, bool]]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t) for t, _ in lines), np.uint64, len(lines)).view(np.int64)


BLOCK_BITS = 1 << 28


def _lcs_rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Bit-parallel LCS: after each element of ``a`` the bits of ``b`` where the length does not grow."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``; memory is bounded by halving long inputs."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    own, other = set(a), set(b)
    rest_a = [i for i in range(head, len(a) - tail) if a[i] in other]
    rest_b = [x for x in b[head : len(b) - tail] if x in own]
    middle = [rest_a[i] for i in _lcs([a[i] for i in rest_a], rest_b)]
    return [*range(head), *middle, *range(len(a) - tail, len(a))]


def _lcs(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > BLOCK_BITS and len(a) > 1:
        half = len(a) // 2
        *_, fore = _lcs_rows(a[:half], b)
        *_, back = _lcs_rows(a[half:][::-1], b[::-1])
        grows = lambda v: np.concatenate(([0], np.cumsum([not v >> j & 1 for j in range(len(b))])))
        cut = int(np.argmax(grows(fore) + grows(back)[::-1]))
        return _lcs(a[:half], b[:cut]) + [half + i for i in _lcs(a[half:], b[cut:])]
    rows = list(_lcs_rows(a, b))
    out, i, j = [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:  # b[j] adds nothing here
            j -= 1
        elif i and not rows[i - 1] >> j & 1:  # nor does a[i]
            i -= 1
        else:
            out.append(i)
            i, j = i - 1, j - 1
    return out[::-1]


def main_text(lines: list[tuple[str, bool]], neighbour: list[int] | None) -> str:
    """Lines that stay after differencing with the neighbour's line hashes."""
    template = set(shared_lines(line_hashes(lines).tolist(), neighbour)) if neighbour else set()
    kept = [(t, inside) for i, (t, inside) in enumerate(lines) if inside or i not in template]
    declared = any(inside for _, inside in lines)
    return "\n".join(t for t, inside in kept if inside or not declared)


def neighbours(keys: DataFrame) -> DataFrame:
    """``k1``, ``k2`` and the nearest page of the host in path order, ``n1``, ``n2``; pages alone in a host are left out.

    ``keys``: distinct ``host``, ``path``, ``k1``, ``k2``.
    """
    order = ["host", "path", "k1", "k2"]
    ranged = keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = materialise(ranged, "url_order")
    inside = W.partitionBy("range").orderBy(*order)
    page = F.struct(*order)
    # one row per range
    ends = ranged.groupBy("range").agg(F.min(page).alias("low"), F.max(page).alias("high"))
    along = W.orderBy("range")
    ends = ends.select("range", F.lag("high").over(along).alias("from_left"), F.lead("low").over(along).alias("from_right"))
    rows = ranged.select("*", F.lag(page).over(inside).alias("l"), F.lead(page).over(inside).alias("r"))
    rows = rows.join(F.broadcast(ends), "range").select(
        *order, F.coalesce("l", "from_left").alias("l"), F.coalesce("r", "from_right").alias("r")
    )
    far = lambda side: F.when(
        F.col(f"{side}.host") == F.col("host"), F.levenshtein(F.col("path"), F.col(f"{side}.path"))
    )
    rows = rows.select("k1", "k2", "l", "r", far("l").alias("dl"), far("r").alias("dr"))
    best = F.when(F.col("dr").isNull() | (F.col("dl") <= F.col("dr")), F.col("l")).otherwise(F.col("r"))
    found = rows.filter("dl is not null or dr is not null").withColumn("best", best)
    return found.select("k1", "k2", F.col("best.k1").alias("n1"), F.col("best.k2").alias("n2"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    url = F.coalesce(F.col("url"), F.lit(""))
    keys = [F.xxhash64(F.lit("page"), "page_id", "url").alias("k1"), F.xxhash64(F.lit("html"), "html").alias("k2")]

    @F.pandas_udf("array<long>")
    def hashes(column: pd.Series) -> pd.Series:
        return pd.Series([line_hashes(page_lines(page)) for page in column], dtype=object)

    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][^:/?#]*://([^/?#]*)", 1)).alias("host")
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][^:/?#]*://[^/?#]*)?([^?#]*)", 1).alias("path")
    narrow = materialise(pages.select(*keys, host, path, hashes("html").alias("lines")), "page_lines")
    pairs = neighbours(narrow.select("host", "path", "k1", "k2").distinct())
    other = narrow.groupBy("k1", "k2").agg(F.first("lines").alias("other"))
    other = other.select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), "other")
    paired = materialise(pairs.join(other, ["n1", "n2"]).select("k1", "k2", "other"), "neighbour_lines")

    @F.pandas_udf("string")
    def text(column: pd.Series, lines: pd.Series) -> pd.Series:
        return pd.Series(
            [main_text(page_lines(p), None if o is None else list(map(int, o))) for p, o in zip(column, lines)], dtype=object
        )

    body = pages.select("page_id", "url", "html", *keys).join(paired, ["k1", "k2"], "left")
    return body.select("page_id", "url", text("html", "other").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
