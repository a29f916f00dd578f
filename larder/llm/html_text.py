"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines, one per block element.  Menus, headers, footers,
sidebars, notices, adverts, forms and reader comments (known by their elements,
roles and class names) are clutter and are left out first.  A line weighs the
characters of text that it adds, none for links.  Weights are summed over
windows of ``WINDOW`` lines.  The text surges where a window's sum rises above
``THRESHOLD`` and dives where the sum of a whole window falls to zero; every
line between the two points is main text, also one that weighs nothing.  Where
a page marks its article the mark decides and no window does: every line there
is main text, none outside it.

A page marks its article by an article element, an element named as its body,
or the main element, in falling rank.  The highest rank counts whose regions,
with those of higher rank, hold no less text than the regions below it.  An
article ends the clutter around it that is known by a class name or id alone;
such articles count if they hold more text than all other marked regions.

Character references are decoded, white space within a block becomes one
space, blocks are joined by an empty line in page order.  A null or empty page
and a page without a surge have an empty text.  Repeated rows are extracted
each for itself; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

#: Lines of a window, and the characters that a window must exceed where no article is marked.
WINDOW, THRESHOLD = 3, 60

#: Elements that start and end a line.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody
    td tfoot th thead tr ul""".split()
)
#: Elements without content, and elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements, roles and words of class names or ids that are not main text.
CLUTTER = frozenset(
    """nav aside footer form head button select option optgroup label noscript template svg canvas object audio video dialog
    menu math""".split()
) | (RAW - {"xmp"})
CLUTTER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CLUTTER_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising advertorial adsense sponsor sponsored promo promotion banner sidebar
    nav navbar navigation menu topbar toolbar footer masthead cookie cookies consent gdpr notice notices alert comment comments
    disqus respond replies related recommended share sharing social newsletter subscribe subscription breadcrumb breadcrumbs
    popup popover modal overlay widget widgets login signup search pagination pager copyright paywall""".split()
)
#: Ids and class names of the element that holds the article.
BODIES = frozenset("articlebody article-body article-content post-content post-body entry-content story-body main-content".split())
#: Elements that end an open paragraph, list item or cell of their own kind.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("ul ol dl table article section main body div".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Line:
    """One block: its text, the characters of it in links, and where it stands."""

    text: str
    linked: int
    clutter: bool
    article: int  # 3 in an article, 2 in an element named as its body, 1 in the main element, else 0
    doubtful: bool = False  # in an article that stands in clutter known by a name alone


def _kind(tag: str, more: str, inside: int) -> tuple[bool, bool, int]:
    """Whether an element is clutter, whether it is so by a name alone, and the rank of the article that it opens (0: none)."""
    rank = {"article": 3, "main": 1}.get(tag, 0)
    clutter, named = tag in CLUTTER or tag == "header" and not inside, False
    if "=" in more or "hidden" in more:
        given = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(more.rstrip(">"))}
        role = given.get("role", "").lower()
        names = f"{given.get('class', '')} {given.get('id', '')}".lower().split()
        words = {w for name in names for w in re.split(r"[^a-z0-9]+", name)}
        rank = max(rank, {"article": 3, "main": 1}.get(role, 0))
        if given.get("itemprop", "").lower() == "articlebody" or not BODIES.isdisjoint(names):
            rank = max(rank, 2)
        hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(given.get("style", ""))
        clutter = clutter or role in CLUTTER_ROLES or bool(hidden)
        if tag not in ("html", "body") and not rank:
            named = not CLUTTER_WORDS.isdisjoint(words) or "header" in words and not inside
        elif tag == "article":
            clutter = clutter or not words.isdisjoint({"comment", "comments", "related", "ad", "advert", "sponsored", "promo"})
    return clutter, named, rank


def lines_of(page: str) -> list[Line]:
    """The lines of a page, with what is known of their place."""
    out: list[Line] = []
    # element, clutter, clutter by name, article rank, doubtful; all also of what is around it
    stack: list[tuple[str, bool, bool, int, bool]] = []
    text: list[str] = []
    linked = links = at = 0

    def clutter() -> bool:
        return bool(stack) and (stack[-1][1] or stack[-1][2])

    def add(part: str) -> None:
        nonlocal linked
        if part and not clutter():
            part = html.unescape(part)
            text.append(part)
            if links:
                linked += len("".join(part.split()))

    def end_line() -> None:
        nonlocal linked
        line = " ".join("".join(text).split())
        if line or clutter():
            out.append(Line(line, linked, clutter(), *(stack[-1][3:] if stack else (0, False))))
        text.clear()
        linked = 0

    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        add(page[at : token.start()])
        at = token.end()
        if token["data"]:
            add(html.escape(token["data"], quote=False))
        if not token["tag"]:
            continue
        tag = token["tag"].lower()
        if token["end"]:
            if tag in BLOCKS:
                end_line()
            if any(tag == x[0] for x in stack):
                while True:
                    name = stack.pop()[0]
                    links -= name == "a"
                    if name == tag:
                        break
            continue
        if tag == "br":
            text.append(" ")
        if tag in BLOCKS:
            end_line()
            for k in range(len(stack) - 1, -1, -1):
                name = stack[k][0]
                if name in CLOSES.get(tag, ()) or name == "p":
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    if name != "p":
                        break
                elif name in SCOPES:
                    break
        if tag in VOID:
            continue
        _, hard, soft, inside, doubtful = stack[-1] if stack else ("", False, False, 0, False)
        own, named, rank = _kind(tag, token["more"], inside)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if not (own or named or hard or soft):
                add(html.escape(page[at : close.start() if close else len(page)], quote=False))
            at = close.end() if close else len(page)
            continue
        if token["more"].endswith("/>") and tag in ("svg", "path", "use"):
            continue
        links += tag == "a"
        # an article ends the clutter around it that is known by a name alone
        opened = soft and rank > 0
        stack.append((tag, hard or own, named or soft and not opened, max(inside, rank), doubtful or opened))
    end_line()
    return out


def between_surge_and_dive(weights: list[int], threshold: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Ranges of lines from a window above the threshold to the next window of weight zero."""
    sums = [0, *accumulate(weights)]
    n = len(weights)
    total = [sums[min(i + window, n)] - sums[i] for i in range(n)]
    out, i = [], 0
    while i < n:
        if total[i] <= threshold:
            i += 1
            continue
        # what leads up to the surge without a gap belongs to it
        begin = i
        while begin > (out[-1][1] if out else 0) and weights[begin - 1]:
            begin -= 1
        end = i
        while end < n and (total[end] or end + window > n):
            end += 1
        out.append((begin, end))
        i = end
    return out


def _marked(lines: list[Line]) -> tuple[bool, int]:
    """Whether articles in clutter known by a name count, and the lowest rank that does (0: no article is marked)."""
    sizes = {(d, rank): 0 for d in (False, True) for rank in range(4)}
    for line in lines:
        if not line.clutter:
            sizes[line.doubtful, line.article] += len(line.text)
    doubtful = sum(sizes[True, rank] for rank in (1, 2, 3)) > sum(sizes[False, rank] for rank in (1, 2, 3))
    size = [0, *(sizes[False, rank] + doubtful * sizes[True, rank] for rank in (1, 2, 3))]
    ranks = (rank for rank in (3, 2, 1) if size[rank] and sum(size[rank:]) >= sum(size[:rank]))
    return doubtful, next(ranks, 0)


def main_text(page: str | None, window: int = WINDOW, threshold: int = THRESHOLD) -> str:
    """The main text of one page."""
    lines = lines_of(page or "")
    doubtful, marked = _marked(lines)
    for line in lines:
        line.clutter = line.clutter or line.doubtful and not doubtful
    lines = [line for line in lines if line.text and not line.clutter and line.article >= marked]
    if not marked:
        weights = [max(0, len("".join(line.text.split())) - line.linked) for line in lines]
        lines = [line for a, b in between_surge_and_dive(weights, threshold, window) for line in lines[a:b]]
    return "\n\n".join(line.text for line in lines)


def extract(pages: DataFrame, window: int = WINDOW, threshold: int = THRESHOLD) -> DataFrame:
    """One row per page (``page_id``, ``url``, ``html``): ``page_id``, ``url``, ``text`` and ``n_chars``."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), window, threshold) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
