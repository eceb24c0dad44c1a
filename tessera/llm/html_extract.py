"""Main text of web pages by nearest-URL page differencing.

Pages lie in order of host and URL path, so that a page's nearest page by path
stands right before or after it.  A page and its nearest one are aligned line by
line by longest common subsequence; the lines they share are the site's
template and deleted.  A line is the text of one block element.

Differencing alone takes away what an article repeats of its neighbour and
leaves a menu or an advert that no neighbour has.  So the markup decides where
it speaks: lines in an ``article`` or ``main`` element are text even if shared,
lines in elements that say by name, class, id or role that they are a menu,
header, footer, sidebar, notice, advert, form, script, style or reader comment
are not, even if no neighbour has them.  Of all other lines, on every page, those
go that the nearest page shares.  If a neighbour shares all of a page's lines
outside articles it is a copy, and no template.

Order needs no task that sees a whole host: rows go into ranges of (host, path),
and each range gets copies of the pages just outside it.  There are as many ranges
as the bytes of the table ask for; pages of one URL are split among them too.

Defined cases: null html is empty and gives an empty text; a null or odd URL
counts as host and path ''; unclosed elements end with what holds them, and a tag that
the end of the page cuts off is dropped; a host with one page is judged by
markup alone; repeated rows are pages of their own; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ranges, with_neighbours

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|</?[a-zA-Z][^>]*\Z""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

#: Elements whose content is no markup, or none of the page's text.
RAW = frozenset("script style template noscript iframe object svg canvas math head title textarea select option audio video".split())
#: Elements that are never part of an article's text.
ASIDE = RAW | frozenset("nav aside footer form button dialog menu".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Words in a class, id or role that mark what isn't the article.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs "
    "footer comment comments commentlist disqus discussion replies respond share sharing social related recommended widget toolbar "
    "pagination pager login search complementary contentinfo".split()
)
#: Hints that count only outside an article, which may have a header of its own.
OUTER = frozenset("header masthead topbar".split())

TEXT, REST, OUT = 0, 1, 2


def attributes(rest: str) -> dict[str, str]:
    """The attributes of a tag by name, of equal names the first."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def _hints(given: dict[str, str]) -> set[str]:
    return {w for name in ("class", "id", "role") for w in re.split(r"[^a-z0-9]+", given.get(name, "").lower())}


def _hidden(given: dict[str, str]) -> bool:
    return "hidden" in given or given.get("aria-hidden", "").lower() == "true" or bool(_UNSEEN.search(given.get("style", "")))


def lines_of(html: str) -> list[tuple[str, int]]:
    """The blocks of a page with their kind: TEXT in an article, OUT where the markup says it is none, else REST.

    What stands in a marked element inside a line is left out of the line.
    """
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, out, main
    at, size = 0, len(html)

    def kind() -> int:
        if any(o and (tag in BLOCK or tag in RAW) for tag, o, _ in stack):
            return OUT
        return TEXT if any(m for _, _, m in stack) else REST

    def say(text: str) -> None:
        if not any(o and tag not in BLOCK and tag not in RAW for tag, o, _ in stack):
            held.append(text)

    def end_block() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                out.append((text, kind()))
            held.clear()

    def close(tag: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return

    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            say(html[at:])
            break
        if m.start() > at:
            say(html[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag, closing, rest = tag.lower(), m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
        block = tag in BLOCK
        if tag == "br":
            say(" ")
            continue
        if block or tag in RAW:
            end_block()
        if closing:
            close(tag)
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            if tag in ("head", "svg", "math", "object", "noscript", "template", "select", "audio", "video", "canvas"):
                if not (rest.endswith("/") and tag in ("svg", "math")):  # only foreign elements close themselves
                    stack.append((tag, True, False))
                continue
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if block:
            if tag == "body":
                close("head")
            # A block ends the paragraph that it stands in, and an item the one before it.
            ends = {"p", tag} if tag in ("li", "dt", "dd", "tr", "td", "th", "p") else {"p"}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                    break
                if stack[i][0] in BLOCK:
                    break
        main = tag in MAIN
        given = attributes(rest) if rest and tag not in ("html", "body") else {}
        inside = main or any(x for _, _, x in stack)
        names = set() if main else _hints(given)
        marked = tag in ASIDE or bool(names & HINTS) or (not inside and (tag == "header" or bool(names & OUTER)))
        stack.append((tag, marked or _hidden(given), main))
    end_block()
    return out


def common_lines(a: list[str], b: list[str]) -> tuple[set[int], set[int]]:
    """The places in ``a`` and in ``b`` of a longest common subsequence, by Hunt and Szymanski."""
    where: dict[str, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    ends: list[int] = []  # the least last place in b of a common subsequence of each length
    last: list[tuple] = []  # and the chain it belongs to
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(ends, j)
            link = (i, j, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(link)
            else:
                ends[k], last[k] = j, link
    left, right = set(), set()
    node = last[-1] if last else None
    while node:
        left.add(node[0])
        right.add(node[1])
        node = node[2]
    return left, right


def main_text(lines: list[tuple[str, int]], shared: set[int]) -> str:
    """The lines that are text, given the places of those that the nearest page shares."""
    rest = [i for i, (_, k) in enumerate(lines) if k == REST]
    own = {i for i in rest if i not in shared}
    if rest and not own:  # the nearest page is a copy
        own = set(rest) if not any(k == TEXT for _, k in lines) else own
    return "\n\n".join(x for i, (x, k) in enumerate(lines) if k == TEXT or i in own)


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    place = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)"
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(id_col).alias("page"),
        F.col(url_col).alias("url"),
        F.lower(F.regexp_extract(url, place, 1)).alias("host"),
        F.regexp_extract(url, place, 2).alias("path"),
        F.xxhash64(F.col(id_col), url, html).alias("tie"),
        html.alias("html"),
    )
    rows = with_neighbours(rows, ["host", "path", "tie"], ranges(pages, 4 << 20))
    fields = f"page {kind}, url string, text string, n_chars long"

    def run(table):
        table = table.sort_by("_row")
        host, path, side, html = (table[c].to_pylist() for c in ("host", "path", "_side", "html"))
        n = len(host)
        nearest: list[int | None] = []
        for i in range(n):
            near = [j for j in (i - 1, i + 1) if 0 <= j < n and host[j] == host[i] and host[i]]
            nearest.append(max(near, key=lambda j: (_alike(path[i], path[j]), -j)) if near else None)
        lines = [lines_of(x) for x in html]
        texts = []
        for i in range(n):
            shared: set[int] = set()
            if side[i] == 0 and nearest[i] is not None:
                shared, _ = common_lines([x for x, _ in lines[i]], [x for x, _ in lines[nearest[i]]])
            texts.append(main_text(lines[i], shared) if side[i] == 0 else None)
        own = pa.array([s == 0 for s in side], pa.bool_())
        out = pa.table([table["page"], table["url"], pa.array(texts, pa.string()), pa.array([len(t or "") for t in texts], pa.int64())], names=["page", "url", "text", "n_chars"])
        return out.filter(own)

    got = rows.groupBy("_bucket").applyInArrow(run, fields)
    return got.withColumnRenamed("page", id_col).withColumnRenamed("url", url_col)
