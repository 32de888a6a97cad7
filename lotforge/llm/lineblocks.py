"""Main text of web pages by line-block distribution.

Markup is stripped so that every block element leaves one line; an element that cannot hold the
article (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments) leaves
empty lines, as many as a window is long. Text lengths are then summed over sliding windows of
`REACH` lines: where a sum rises from zero the text surges, where it falls back to zero it dives,
and the lines in between are one stretch. If the page marks its article (article, main, or the
itemprop articleBody), the stretches inside it are the text. Otherwise lines that are mostly links
weigh nothing, and stretches whose letters stand in the same container, the block around their
paragraphs, are one article: all lines of the container with the most letters are the text, however
short, linked or far apart by excluded blocks. A container that is the page itself lends only its own
paragraphs. Stretches elsewhere belong to the text if they reach a fair share of the densest one.

References are decoded after the markup is gone, white space in a line becomes one space, lines
are trimmed and joined by LF; nothing else is changed and no length is capped. Broken pages are
read to their end: what is never closed ends with its parent. A null or empty page gives the empty
text. Repeated rows give equal results, an empty table an empty one, other columns are ignored.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

REACH = 3
#: Share of the densest stretch's letters that one outside the article's container needs on a page
#: without a marked article; all but this share of a stretch's letters stand in its container.
FAIR = 0.1

#: Elements by their role in HTML (fixed values).
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset(
    "head title nav footer aside form script style noscript template iframe svg math button select option "
    "textarea input dialog menu object canvas audio video map noembed noframes fieldset".split()
)
ARTICLE = frozenset(("article", "main"))
#: Blocks that are text of the block around them, and those that hold one paragraph each.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup li ul ol dl dt dd blockquote pre figure figcaption table caption thead tbody tfoot tr address".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dt dd figcaption caption".split())
PAGE = frozenset(("", "html", "body"))
#: Roles and names that say what an element is not.
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NAMES = re.compile(
    r"(?:^|[-_\s])(?:nav|navbar|navigation|menu|breadcrumbs?|masthead|topbar|site-?header|page-?header|header|"
    r"site-?footer|footer|side-?bar|aside|cookies?|consent|gdpr|notices?|notification|alert|banner|"
    r"ads?|adverts?|advertisement|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?s?|"
    r"comments?|comment-?list|disqus|reply|replies|respond|reactions?|shar(?:e|ing)|social|newsletter|subscribe|"
    r"subscription|signup|sign-?up|login|related|recommended|popular|trending|pager|pagination|"
    r"popup|pop-?up|modal|overlay|widget|skip-?link|legal|copyright|tags?|toolbar|search)(?:$|[-_\s]|\d)",
    re.I,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: A start tag of these closes an open one of the same kind.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(text)}


def _excluded(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in NEVER:
        return True
    if tag == "header" and not in_article:
        return True
    if not attributes.strip() or tag in ("html", "body"):
        return False
    found = _attributes(attributes)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return True
    if tag in ARTICLE and not in_article:
        return False
    if found.get("role", "").lower() in ROLES:
        return True
    return any(NAMES.search(found.get(k, "")) for k in ("class", "id"))


class Blocks:
    """The block elements of a page in the order of their start tags; 0 stands for the page."""

    def __init__(self) -> None:
        self.tags, self.parents, self.last, self.leaf = [""], [0], [0], [True]

    def open(self, tag: str, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.last.append(len(self.last))
        self.leaf.append(True)
        self.leaf[parent] = False
        return len(self.tags) - 1

    def container(self, block: int) -> int:
        """The block itself, or the one around it if it holds a paragraph or a part of a text."""
        if self.leaf[block] and self.tags[block] not in PAGE:
            block = self.parents[block]
        while self.tags[block] in PARTS:
            block = self.parents[block]
        return block

    def innermost(self, weights: Iterator[tuple[int, int]]) -> int:
        """The innermost block with all but a FAIR share of the weights given by block."""
        sums: dict[int, int] = {}
        for block, weight in weights:
            sums[block] = sums.get(block, 0) + weight
        least = (1 - FAIR) * sum(sums.values())
        heap = [-block for block in sums]
        heapq.heapify(heap)
        while True:  # inner blocks have greater numbers, so a sum is complete when its turn comes
            block = -heapq.heappop(heap)
            if block == 0 or sums[block] >= least:
                return block
            parent = self.parents[block]
            if parent not in sums:
                sums[parent] = 0
                heapq.heappush(heap, -parent)
            sums[parent] += sums[block]

    def holds(self, container: int, block: int) -> bool:
        if self.tags[container] in PAGE:
            return self.container(block) == container
        return container <= block <= self.last[container]


class Lines:
    """Lines of a page as they are stripped: (text, letters outside links, inside the article, block)."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, bool, int]] = []
        self.held: list[str] = []
        self.linked = 0

    def text(self, raw: str, in_link: bool) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.held.append(text)
        if in_link:
            self.linked += len("".join(text.split()))

    def end(self, in_article: bool, block: int) -> None:
        if self.held:
            line = " ".join("".join(self.held).split())
            if line:
                self.lines.append((line, len(line.replace(" ", "")) - self.linked, in_article, block))
            self.held, self.linked = [], 0

    def gap(self) -> None:
        self.lines.extend([("", 0, False, 0)] * REACH)


def strip(page: str) -> tuple[list[tuple[str, int, bool, int]], bool, Blocks]:
    """(lines, whether the page marks an article, blocks)."""
    out, marked, blocks = Lines(), False, Blocks()
    stack: list[tuple[str, bool, bool, int]] = []  # open block elements: tag, excluded, article, number
    excluded = article = links = at = 0

    def close(upto: int) -> None:
        nonlocal excluded, article
        while len(stack) > upto:
            _, out_of, is_article, block = stack.pop()
            blocks.last[block] = len(blocks.last) - 1
            excluded -= out_of
            article -= is_article

    def inner() -> int:
        return stack[-1][3] if stack else 0

    while at < len(page):
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text and not excluded:
            out.text(text, links > 0)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag == "a" and not excluded:
            links = 0 if found[1] else 1
        if found[1]:  # an end tag
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag not in INLINE and not excluded:
                out.end(article > 0, inner())
            if place is not None:
                close(place)
            continue
        if tag == "br":
            if not excluded:
                out.text(" ", False)
            continue
        out_of = _excluded(tag, found[3], article > 0)
        if tag in INLINE and not out_of:
            continue
        if not excluded:
            if tag not in INLINE:
                out.end(article > 0, inner())
            if out_of and tag not in VOID and tag not in RAW and tag not in INLINE:
                out.gap()
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or found[3].rstrip().endswith("/") and tag in ("svg", "math", "path"):
            continue
        kin = _SIBLINGS.get(tag)
        if kin and stack and stack[-1][0] in kin:
            close(len(stack) - 1)
        if tag == "p" or tag not in INLINE:
            while stack and stack[-1][0] == "p":
                close(len(stack) - 1)
        is_article = not out_of and not excluded and (tag in ARTICLE or "articleBody" in found[3])
        marked |= is_article
        block = inner() if excluded or tag in INLINE else blocks.open(tag, inner())
        stack.append((tag, out_of, is_article, block))
        excluded += out_of
        article += is_article
    if not excluded:
        out.end(article > 0, inner())
    close(0)
    return out.lines, marked, blocks


def stretches(weights: list[int]) -> Iterator[tuple[int, int]]:
    """Line ranges between a surge (a window sum leaves zero) and the next dive (it is zero)."""
    n, start = len(weights), None
    window = sum(weights[:REACH])
    for i in range(n):
        if window > 0 and start is None:
            start = i
        if window == 0 and start is not None:
            yield start, i
            start = None
        window += (weights[i + REACH] if i + REACH < n else 0) - weights[i]
    if start is not None:
        yield start, n


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines, marked, blocks = strip(page)
    if marked:
        weights = [len(text) if inside else 0 for text, _, inside, _ in lines]
        taken = {i for a, b in stretches(weights) for i in range(a, b) if weights[i]}
        return "\n".join(lines[i][0] for i in sorted(taken))
    weights = [max(0, plain) if 2 * plain >= len(text.replace(" ", "")) else 0 for text, plain, _, _ in lines]
    found = list(stretches(weights))
    if not found:
        return ""
    sums = [sum(weights[a:b]) for a, b in found]
    held: dict[int, int] = {}
    for (a, b), total in zip(found, sums):
        container = blocks.container(blocks.innermost((lines[i][3], weights[i]) for i in range(a, b) if weights[i]))
        held[container] = held.get(container, 0) + total
    article = max(held, key=lambda c: (held[c], -c))
    whole = blocks.tags[article] not in PAGE
    counts = [bool(text) and (weight > 0 or blocks.tags[block] in PARAGRAPHS) for (text, _, _, block), weight in zip(lines, weights)]
    taken = {i for (a, b), total in zip(found, sums) if total >= FAIR * max(sums) for i in range(a, b) if counts[i]}
    taken |= {i for i, (text, _, _, block) in enumerate(lines) if text and (whole or counts[i]) and blocks.holds(article, block)}
    return "\n".join(lines[i][0] for i in sorted(taken))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts = [main_text(page) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`. One map pass, no shuffle."""
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
