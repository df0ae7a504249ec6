"""Main text of web pages by the distribution of text over their lines.

Markup is stripped to lines, one for each block of the page; what its elements name as menus, notices, forms and
the like becomes an empty line. Lengths of text outside links are summed over windows of lines. Text begins where the sum
surges and ends where it dives to nothing. The element that holds all longer lines of the largest such
stretch is the place of the main text: an article or main element around it, or one with most of the stretch, is taken
whole; in any other element what lies between its surge and dive points is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import map_texts

#: Lines of a window, and the characters outside links at which its sum counts as a surge.
WINDOW, SURGE = 3, 86
#: A line with a third of that is a longer line.
LONG = SURGE // WINDOW

_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<[!?][^<>]*>"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:"[^"]*"|'[^']*'|[^'"<>])*+)>"""
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^<>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BREAK = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")

# Element names and the names that pages give to what is not their main text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
UNSEEN = frozenset(
    "audio button canvas datalist dialog embed iframe label math noscript object option script select style svg template textarea title video".split())
ASIDE = frozenset("aside dialog fieldset footer form header menu nav".split())
CLOSED_BY_NEXT = frozenset("dd dt li tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDERS = frozenset("article main".split())
NAMES = frozenset(
    "ad ads adsense adsbygoogle advert advertisement adverts alert banner breadcrumb breadcrumbs byline colophon comment comments consent "
    "contentinfo cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification overlay pager pagination popup promo promoted promotion recommended related replies reply respond search "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget complementary".split())
SPOKEN = frozenset("comment comments disqus replies reply respond".split())
NEGATED = ("has-", "no-", "with-", "without-", "is-", "js-")


def _names(attributes: str) -> set[str]:
    """Names of an element's class, id and role, as far as they mark something beside the main text; hidden elements are ``hidden``."""
    found: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            for word in value.split():
                if not word.lower().startswith(NEGATED):
                    found |= {x.lower() for x in _BREAK.split(word) if x} & NAMES
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and "display:none" in value.lower().replace(" ", ""):
            found.add("hidden")
    return found


@dataclass
class Page:
    """Elements in the order of their start (parent, name, whether set aside) and lines (element, text, characters outside links)."""

    parents: list[int] = field(default_factory=lambda: [0])
    kinds: list[str] = field(default_factory=lambda: [""])
    aside: list[bool] = field(default_factory=lambda: [False])
    lines: list[tuple[int, str, int]] = field(default_factory=list)


def parse(html: str) -> Page:
    """Elements and lines of a page, in time proportional to its length."""
    page = Page()
    stack, open_ = [0], Counter()
    text: list[str] = []
    plain = breaks = 0
    in_link = False
    by_name: set[int] = set()
    endless: set[str] = set()  # no end of these follows
    held = False

    def flush() -> None:
        nonlocal plain, breaks
        line = " ".join("".join(text).split())
        if line:
            page.lines.append((stack[-1], line, min(plain, len(line))))
        text.clear()
        plain = breaks = 0

    def pop() -> None:
        open_[page.kinds[stack.pop()]] -= 1

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        piece = html[at:m.start() if m else end]
        if piece:
            words = unescape(piece)
            text.append(words)
            bare = len("".join(words.split())) and len(" ".join(words.split()))
            plain += 0 if in_link else bare
            breaks = 0 if bare else breaks
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing, attributes = m["end"] or m["end2"], m["attributes"] or m["attributes2"] or ""
        if name in UNSEEN:
            if not closing and not attributes.endswith("/"):
                close = None if name in endless else re.compile(rf"</{name}\b[^<>]*>?", re.I).search(html, at)
                at = close.end() if close else (end if name in ("script", "style") else at)
                if not close:
                    endless.add(name)
        elif name == "a":
            in_link = not closing
        elif name == "br":
            breaks += 1
            if breaks > 1:
                flush()
            else:
                text.append(" ")
        elif name in ("td", "th"):
            text.append(" ")
        elif name == "hr":
            flush()
        elif name in BLOCKS:
            flush()
            if closing:
                if open_[name] > 0:
                    while page.kinds[stack[-1]] != name:
                        pop()
                    pop()
                    in_link = False
                continue
            if page.kinds[stack[-1]] == "p":
                pop()
            if name in CLOSED_BY_NEXT and page.kinds[stack[-1]] == name:
                pop()
            marks = set() if name in ("html", "body") else _names(attributes)
            if name in HOLDERS:
                marks &= SPOKEN | {"hidden"}
                if not marks and not held:  # what an element around the article is called says nothing about the article
                    held = True
                    for k in stack:
                        if k in by_name:
                            page.aside[k] = False
            inside = name == "header" and open_["article"] + open_["main"] > 0
            number = len(page.parents)
            page.parents.append(stack[-1])
            page.kinds.append(name)
            page.aside.append(bool(marks - {"header"} if inside else marks) or name in ASIDE and not inside)
            if marks and not marks & (SPOKEN | {"hidden"}) and name not in ASIDE:
                by_name.add(number)
            stack.append(number)
            open_[name] += 1
    flush()
    return page


def stretches(weights: list[int]) -> list[tuple[int, int]]:
    """From each surge point up to, not including, its dive point.

    The surge threshold is ``SURGE``, or half of the greatest sum on pages that have less text.
    """
    sums = [sum(weights[i:i + WINDOW]) for i in range(len(weights))]
    least = min(SURGE, max(sums, default=0) / 2)
    out, begin = [], None
    for i, total in enumerate(sums):
        if begin is None:
            if weights[i] > 0 and total >= least:
                begin = i
        elif total == 0:
            out.append((begin, i))
            begin = None
    return out + ([(begin, len(weights))] if begin is not None else [])


def main_lines(page: Page) -> list[str]:
    """The lines of the main text."""
    n = len(page.parents)
    aside = page.aside[:]
    holder = [0] * n  # the innermost article or main element, 0 if there is none
    header = [kind == "header" for kind in page.kinds]
    for k in range(1, n):
        header[k] = header[k] or header[page.parents[k]]
        aside[k] = aside[k] or aside[page.parents[k]]
        holder[k] = k if page.kinds[k] in HOLDERS else holder[page.parents[k]]
    aside = [a or h and kind not in HEADINGS for a, h, kind in zip(aside, header, page.kinds)]  # headers of articles have their headings
    weights = [0 if aside[e] else w for e, _, w in page.lines]
    if not any(weights):  # an article may be one link
        weights = [0 if aside[e] or not holder[e] else len(t) for e, t, _ in page.lines]
    found = stretches(weights)
    if not found:
        return []
    totals = [sum(weights[a:b]) for a, b in found]
    a, b = found[totals.index(max(totals))]
    longest = max(weights[a:b])
    counts, sums = [0] * n, [0] * n
    for k in range(a, b):
        element = page.lines[k][0]
        sums[element] += weights[k]
        counts[element] += weights[k] >= min(LONG, longest)
    for k in range(n - 1, 0, -1):
        counts[page.parents[k]] += counts[k]
        sums[page.parents[k]] += sums[k]
    place = max(k for k in range(n) if counts[k] == counts[0])
    whole = holder[place] or max((k for k in range(n) if page.kinds[k] in HOLDERS and 2 * sums[k] > sums[0]), default=0)
    place = whole or place
    if page.kinds[place] in HEADINGS or page.kinds[place] in ("p", "li", "tr"):  # one line decides nothing about its neighbours
        place = page.parents[place]
    inside = [k == place for k in range(n)]
    for k in range(1, n):
        inside[k] = inside[k] or inside[page.parents[k]]
    chosen = range(len(weights)) if whole else [k for a, b in found for k in range(a, b)]
    return [page.lines[k][1] for k in chosen if inside[page.lines[k][0]] and not aside[page.lines[k][0]]]


def extract(html: str | None) -> str:
    """The main text of a page, its blocks joined by two line breaks; empty if there is none."""
    return "\n\n".join(main_lines(parse(html))) if html else ""


def extract_table(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row.

    Missing and empty pages, and pages without main text, have an empty text. Repeated rows are read each, rows without
    page_id or url are kept, an empty table gives none; other columns are not looked at. Pages are read
    whole, one at a time, in batches of 100.
    """

    def work(htmls: Iterable[str | None]):
        for html in htmls:
            text = extract(html)
            yield text, len(text)

    chosen = pages.select("page_id", "url", F.col("html").alias("text"))
    return map_texts(chosen, "main string, n_chars long", work, keep=("page_id", "url"), rows=100).select(
        "page_id", "url", F.col("main").alias("text"), "n_chars")
