"""The main text of a page by its line-block distribution."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Generator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import map_rows

#: A tag whose quoted values may hold ``>``, or markup that is no element; comments are found apart.
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>|<[!?/][^>]*+>""")
#: A tag that ends at the next ``>``.
SHORT_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements whose content is not text of the page, up to the end tag as raw text.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp", "noembed", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements inside a line; they start no line of their own.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "td", "th",
    "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder",
    "munderover", "mmultiscripts", "mprescripts", "mstyle", "mpadded", "mphantom", "menclose", "merror", "mtable", "mtr", "mtd", "maction",
}
DROPPED = {"nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "object", "canvas", "audio", "video", "input", "fieldset"}
#: Of these, the ones that may stand around a whole page.
WRAPPERS = {"form", "fieldset"}
#: Names in class, id or role that mark what is not the article.
BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog", "disqus", "footer", "gdpr", "login", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notices", "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended",
    "related", "replies", "reply", "respond", "responses", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "widget", "widgets",
}
HEADER = {"header", "masthead", "topbar"}
#: Names that mark what readers wrote, often longer than the article.
READERS = {"comment", "comments", "disqus", "replies", "reply", "respond", "responses"}
#: Characters outside links from which dropped text can be the page's own.
LEAST = 80
#: Class or id names that mark the article where there is no element for it.
CONTENT = {
    "content", "main", "main-content", "article", "article-body", "article-content", "post", "post-content", "post-body", "entry",
    "entry-content", "story", "story-body", "page-content",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Start tags that end an open element of the same family.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
SENTENCE_ENDS = ".!?:;\u2026\u3002\uff01\uff1f\"')\u201d\u00bb"
HOLDERS = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot"}


def tags_of(page: str) -> Generator[tuple[int, int, re.Match | None], int | None, None]:
    """Start, end and match of each piece of markup, None for a comment; ``send`` a place to go on from there.

    Each character is looked at a bounded number of times: nothing behind the last ``>`` is a
    tag, and once a quoted value has no end before it, tags end at the next ``>``.
    """
    last, at, tag = page.rfind(">") + 1, 0, TAG
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end, m = page.find("-->", start + 4) + 3, None
            end = len(page) if end < 3 else end
        elif start >= last:
            at = start + 1
            continue
        else:
            m = tag.match(page, start, last)
            if m is None and page[start + 1 : start + 2].isascii() and page[start + 1 : start + 2].isalpha():
                tag = SHORT_TAG
                m = tag.match(page, start, last)
            if m is None:
                at = start + 1
                continue
            end = m.end()
        at = max(end, (yield start, end, m) or 0)


class Line(NamedTuple):
    text: str
    linked: int  # characters of links
    scope: int  # 3 in an article, 2 in main, 1 in a content element, else 0
    heading: bool


class Drop(NamedTuple):
    """An element that is left out unless it turns out to hold the page's text."""

    outer: int  # the drop around it, or 0
    key: str  # what the rule saw; equal for elements that are left out for the same reason
    soft: bool  # a form, or a name that only has a boilerplate part
    named: bool
    header: bool  # headings of an article stay


class Held(NamedTuple):
    """A main, article or content element that no name of its own calls boilerplate."""

    outer: int  # the one around it, or 0
    drop: int  # the innermost drop around it, or 0
    scope: int


class Piece(NamedTuple):
    text: str
    linked: bool
    drop: int
    held: int
    heading: bool  # in a heading of an article


def _marks(tag: str, attributes: str, inside: int) -> tuple[tuple | None, int, bool]:
    """Why an element is left out (as the last four of Drop), the scope it opens, and whether a name calls it boilerplate."""
    boiler, header, named, hidden, whole, found = tag in DROPPED, tag == "header", False, False, False, set()
    scope = 3 if tag == "article" else 2 if tag == "main" else 0
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id", "role"):
                for label in value.split():
                    parts = {p.lower() for p in NAME_PARTS.findall(label)}
                    if label.lower() in CONTENT:
                        scope = max(scope, 1)
                    elif name == "role" and label.lower() in ("main", "article"):
                        scope = max(scope, 2 if label.lower() == "main" else 3)
                    elif not parts & {"has", "no", "with", "without"}:
                        whole |= label.lower() in BOILERPLATE
                        found |= parts & (BOILERPLATE | HEADER)
                        named |= bool(parts & BOILERPLATE)
                        header |= bool(parts & HEADER)
            elif name == "itemprop" and value.lower() == "articlebody":
                scope = 3
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                hidden = True
    # "share-enabled" on the element of the content says nothing; "comment" does.
    by_name = whole or named and not scope
    if tag in ("html", "body") or tag in ("main", "article") and inside < 2 or not (boiler or hidden or by_name or header):
        return None, scope, whole or named
    soft = not (hidden or whole or found & READERS or tag == "header" or boiler and tag not in WRAPPERS)
    key = " ".join([tag] * boiler + sorted(found))
    return (key, soft, not (boiler or hidden or tag == "header"), not (boiler or hidden or by_name)), scope, whole or named


def lines_of(page: str) -> list[Line]:
    """The page without markup, a line for each block; what is marked as boilerplate leaves a blank line.

    A mark says nothing where it would take the page's own text: an element with a main,
    article or content element that has more text than all such elements outside, and
    elements of one kind that together have more text than what is left. Where nothing would
    be left, names count for nothing, then forms and what holds an article are read too.
    """
    found: list[tuple[list[Piece], int, bool]] = []  # pieces of a line, its scope, whether it is a heading
    drops, held = [Drop(0, "", False, False, False)], [Held(0, 0, 0)]
    bottom = ("", 0, 0, 0, False, False)
    stack: list[tuple[str, int, int, int, bool, bool]] = []  # tag, drop, held, scope, in a link, in a heading
    state = bottom
    pieces: list[Piece] = []
    at = 0

    def text(piece: str) -> None:
        if piece:
            _, drop, inside, scope, link, heading = state
            pieces.append(Piece(piece, link, drop, inside, bool(scope and heading)))

    def flush() -> None:
        nonlocal pieces
        if pieces:
            found.append((pieces, state[3], state[5]))
            pieces = []

    places: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of a tag

    def leave(tags: set[str], stop: set[str] = frozenset()) -> None:
        """Close the innermost open element of ``tags`` and all in it; none of ``stop`` is left for it."""
        nonlocal state
        i = max((places[t][-1] for t in tags if places.get(t)), default=-1)
        if i < 0 or any(places[t][-1] > i for t in stop if places.get(t)):
            return
        if not INLINE.issuperset(x[0] for x in stack[i:]):
            flush()
        for x in stack[i:]:
            places[x[0]].pop()
        del stack[i:]
        state = stack[-1] if stack else bottom

    last, markup, skip = page.rfind(">") + 1, tags_of(page), None
    while True:
        try:
            start, end, m = markup.send(skip)
        except StopIteration:
            break
        skip = None
        text(page[at:start])
        at = end
        if m is None:
            continue
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in RAW and not m[1]:
            if not m[3].endswith("/"):
                close = re.compile(rf"</{tag}(?![a-z0-9:-])[^>]*+>", re.I).search(page, at, max(last, at))
                at = skip = close.end() if close else len(page)
            continue
        if tag == "br" or tag in ("td", "th", "mtd"):
            text(" ")
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        if tag == "head":  # holds only raw and void elements: any other, and text, ends it
            flush()
            continue
        if m[1]:
            if tag not in INLINE:
                flush()
            leave({tag}, set() if tag not in INLINE and tag != "p" else {"article", "section", "div", "main", "td", "body"})
            continue
        if tag not in INLINE:
            flush()
            leave({"p"}, {"article", "section", "div", "main", "td", "li", "body", *DROPPED})
            if tag in ENDS:
                leave(ENDS[tag], HOLDERS)
            if tag in HEADINGS:
                leave(HEADINGS, {"article", "section", "div", "main", "header", "body"})
        elif tag == "a":
            leave({"a"}, {"article", "section", "div", "main", "li", "body"})
        elif not m[3]:
            continue  # inline markup without attributes says nothing about its text
        if m[3].endswith("/") and tag not in INLINE and not m[3].rstrip("/").strip():
            continue
        _, drop, inside, scope, link, heading = state
        why, opened, doubtful = _marks(tag, m[3], scope)
        if why and not why[3] and tag in INLINE:
            pieces.append(Piece(" ", False, drop, inside, False))
        if why:
            drops.append(Drop(drop, *why))
            drop = len(drops) - 1
        elif opened and not doubtful:
            held.append(Held(inside, drop, opened))
            inside = len(held) - 1
        state = (tag, drop, inside, max(scope, opened), link or tag == "a", heading or tag in HEADINGS)
        places[tag].append(len(stack))
        stack.append(state)
    text(page[at:])
    flush()
    return _undropped(found, drops, held)


def _undropped(found: list[tuple[list[Piece], int, bool]], drops: list[Drop], held: list[Held]) -> list[Line]:
    """The lines after it is settled which of ``drops`` are left out."""
    lifted = {0}

    def chains(inner: set[int]) -> set[int]:
        """These drops and all around them."""
        out: set[int] = set()
        for drop in inner:
            while drop and drop not in out:
                out.add(drop)
                drop = drops[drop].outer
        return out

    def resolved() -> list[Line]:
        out, but_header = [False], [False]
        for i, d in enumerate(drops[1:], 1):
            out.append(out[d.outer] or i not in lifted)
            but_header.append(but_header[d.outer] or i not in lifted and not d.header)
        lines: list[Line] = []
        for pieces, scope, heading in found:
            kept = [p for p in pieces if not (but_header if p.heading else out)[p.drop]]
            joined = " ".join(html.unescape("".join(p.text for p in kept)).split())
            if joined:
                lines.append(Line(joined, len(" ".join(html.unescape("".join(p.text for p in kept if p.linked)).split())), scope, heading))
            elif any(not p.text.isspace() for p in pieces if (but_header if p.heading else out)[p.drop]):
                lines.append(Line("", 0, 0, False))
        return lines

    def own(lines: list[Line], scope: int) -> int:
        return sum(len(x.text) - x.linked for x in lines if x.scope >= scope)

    lines = resolved()
    if len(drops) == 1:
        return lines

    # An element with the largest article, if that has more text than all like it outside.
    sizes = [0] * len(held)
    for pieces, _, _ in found:
        for p in pieces:
            if p.drop == held[p.held].drop:
                sizes[p.held] += len(" ".join(p.text.split()))
    for i in range(len(held) - 1, 0, -1):
        if held[i].drop == held[held[i].outer].drop:
            sizes[held[i].outer] += sizes[i]
    around = [i for i in range(1, len(held)) if held[i].drop and sizes[i]]
    if around:
        best = max(around, key=lambda i: sizes[i])
        over = chains({held[best].drop})
        if sizes[best] > own(lines, held[best].scope if all(drops[d].soft for d in over) else 0):
            keys, alike = {drops[d].key for d in over if drops[d].soft}, [True]
            for d in drops[1:]:
                alike.append(alike[d.outer] and d.key in keys)
            lifted |= over | chains({held[i].drop for i in around if alike[held[i].drop]})
            lines = resolved()

    # Elements of one kind with more text than is left.
    while True:
        scope, groups, over = _scope(lines), {}, [frozenset()]
        for i, d in enumerate(drops[1:], 1):  # the kinds that leave each out; None if one of them stays in any case
            around_it = over[d.outer]
            over.append(around_it if around_it is None or i in lifted else None if not d.soft else around_it if d.key in around_it else around_it | {d.key})
        for pieces, at, _ in found:
            for p in pieces:
                if at >= scope and not p.linked and (keys := over[p.drop]):
                    groups[keys] = groups.get(keys, 0) + len(" ".join(p.text.split()))
        total = {k: sum(n for x, n in groups.items() if x <= k) for k in groups}
        most = max(total, key=lambda k: total[k], default=None)
        if most is None or total[most] < LEAST or total[most] <= own(lines, scope):
            break
        lifted.update(i for i, d in enumerate(drops) if d.soft and d.key in most)
        lines = resolved()

    if main_lines(lines):
        return lines
    for more in (
        {i for i, d in enumerate(drops) if d.named},
        {i for i, d in enumerate(drops) if d.soft or d.header} | chains({held[i].drop for i in around}),
    ):
        lifted |= more
        if main_lines(again := resolved()):
            return again
    return lines


def _scope(lines: list[Line]) -> int:
    """The least scope of the article's lines, 0 where the page marks none."""
    by_scope = {s: sum(len(x.text) for x in lines if x.scope >= s) for s in (1, 2, 3)}
    return next((s for s in (3, 2, 1) if by_scope[s] and by_scope[s] >= 0.3 * by_scope[1]), 0)


def _chrome(line: Line, surge: int) -> bool:
    """Whether a line looks like a label: short, no heading, and without a mark that ends a sentence."""
    return not line.heading and len(line.text) < surge and line.text[-1] not in SENTENCE_ENDS


def main_lines(lines: list[Line], window: int = 3, surge: int = 80) -> list[Line]:
    """The lines between the surge and dive points of the line-block distribution.

    A line weighs its characters outside links. Where the page marks its article, lines
    outside weigh nothing and any weight is a surge, so short paragraphs at its ends stay;
    else the sum of ``window`` lines must reach ``surge`` (or half of the page's largest sum,
    if that is less). A span ends where a line begins ``window`` lines without weight. Short
    lines that are no sentences go where a heading follows them at a span's start.
    """
    scope = _scope(lines)
    if scope:
        weights = [len(x.text) if x.scope >= scope else 0 for x in lines]
    else:
        weights = [max(0, len(x.text) - x.linked) if 2 * x.linked < len(x.text) else 0 for x in lines]
    blocks = [sum(weights[i : i + window]) for i in range(len(weights))]
    if not any(blocks):
        return []
    least = 1 if scope else min(surge, max(blocks) / 2)
    kept: list[Line] = []
    i = 0
    while i < len(lines):
        if blocks[i] < least:
            i += 1
            continue
        end = i
        while end < len(lines) and blocks[end] > 0:
            end += 1
        span = range(i, end)
        inside = [k for k in span if weights[k]]
        if not scope:
            opening = next((n for n, k in enumerate(inside) if not _chrome(lines[k], surge)), 0)
            inside = inside[opening:] if inside and lines[inside[opening]].heading else inside
        if inside:
            kept += [lines[k] for k in range(inside[0], inside[-1] + 1) if lines[k].text and (weights[k] or not scope)]
        i = end
    return kept


def main_text(page: str | None) -> str:
    return "\n\n".join(x.text for x in main_lines(lines_of(page))) if page else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page; a page without main text has an empty text.

    A null or empty html gives an empty text; equal rows give equal rows; broken markup is
    read as far as it goes. Other columns of ``pages`` are not read.
    """
    schema = T.StructType([
        T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])

    def rows(part: list[tuple]) -> list[tuple]:
        return [(page_id, url, t := main_text(page), len(t)) for page_id, url, page in part]

    return map_rows(pages, ["page_id", "url", "html"], rows, schema)
