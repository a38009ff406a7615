"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element. A line's weight is its length, less what stands in
links (closed ``a`` elements with ``href``), and nothing if that is most of it; what the markup itself names as surroundings (navigation, header, footer, aside, forms, scripts,
and elements whose class, id or role says advert, menu, comments and the like) has no weight. A name
that says only what goes with the element (``with-sidebar``, ``comments-open``) or what it writes about
(``legal-news``) doesn't count, nor does any name of an element that holds every ``article`` and ``main``
of the page or, unless a class or id is that word alone, most of its text. Readers' comments are surroundings at
any length and in any element, an ``article`` of their own included; the ``header`` of an ``article`` is its
headline and stays, as do formulas. If the page has an ``article`` or ``main`` element, all lines in it but the surroundings are the text, links
too. Elsewhere weights are summed over a
sliding window of lines: a surge is where the weights rise from nothing, a dive where they fall to
nothing, and the stretch between is strong if a window in it reaches the threshold; on a page without
such a window the heaviest stretch is. All lines from the first strong surge to the last strong dive are
kept but the surroundings. The span reaches on to the outermost lines with weight, and headings before
it, that stand in the same element as one of its long lines.

The page is read once, from front to back. A tag without an end, because a quote in it is never closed, ends at
the next ``>``, and from there on quotes are not looked at; without a ``>`` what is left is text.

Inside a line, character references are decoded and white space becomes one blank; lines are joined by
an empty line. Defined cases: a null or empty page, and a page without text, give an empty text;
unclosed elements end with their parents; nothing is dropped for its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
THRESHOLD = 86

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe svg select xmp annotation annotation-xml".split())
#: Fixed names of MathML: a formula is part of its line.
MATH = frozenset(
    "math mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup"
    " msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics".split()
)
AWAY = frozenset("nav header footer aside form button menu dialog head object audio video canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp"
    " small span strike strong sub sup time tt u var wbr img noscript".split()
) | MATH
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSES_P = frozenset(("p", "li", "dd", "dt", "td", "th", "tr", "option"))
NAMED = re.compile(
    r"ads?|adverts?|advertisement|sponsor(?:ed)?|promo(?:tion)?|banner|menu|nav(?:bar|igation)?|sidebar"
    r"|footer|header|masthead|cookies?|consent|notices?|popup|modal|overlay|newsletter|subscribe|signup|comments?|replies"
    r"|disqus|respond|share|sharing|social|related|recommended|breadcrumbs?|pagination|pager|widget|toolbar|login"
    r"|copyright|legal|search|contentinfo|complementary|alert"
)
#: Beside these a word of ``NAMED`` says what the element goes with, not what it is.
BEFORE = frozenset("with has have no not non without hide show".split())
AFTER = frozenset("open opened closed enabled disabled on off active visible true false".split())
OF_TEXT = frozenset("article post entry story content".split())
#: Words that are subjects as well, unless they stand alone or with parts of a page.
SUBJECTS = frozenset("social legal search share sharing alert consent notice notices copyright promotion respond".split())
PARTS = frozenset(
    "links link icons icon media buttons button bar box form list block section wrapper wrap container area panel info"
    " text site page main top bottom left right inner outer row item items tools us this".split()
)
#: Words that name what readers add; with these beside them alone, an ``article`` is one as well.
COMMENTS = re.compile(r"comments?|commentlist|replies|reply|disqus|respond|responses")
OF_COMMENTS = PARTS | frozenset("thread body content entry node user byuser depth even odd alt parent child single".split())
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
OPEN = re.compile(r"<(?:!--|[!?]|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*))")
REST = re.compile(r"""((?:"[^"]*"|'[^']*'|[^>"'])*+)>""")


@dataclass(slots=True)
class Line:
    parts: list[str] = field(default_factory=list)
    links: list[tuple[list[bool], int]] = field(default_factory=list)  # whether the link is closed, length

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


@dataclass(slots=True)
class Named:
    """An element that its name makes surroundings, unless it turns out to wrap the text."""

    alone: bool  # a class, id or role is nothing but the word
    comments: bool = False  # which never wrap it
    parent: Named | None = None
    containers: int = 0
    weight: int = 0
    wraps: bool = False  # it and all around it


def tags(page: str) -> Iterator[tuple[str, str, bool, str, int]]:
    """(text before, name in small letters, whether it closes, attributes, end) of every tag; "" for other markup.

    The last one has the text behind all tags. Who skips markup sends the place to go on from.
    """
    at, size, last = 0, len(page), page.rfind(">")
    trusted = True  # quotes
    while found := OPEN.search(page, at):
        start = found.start()
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = size if end < 0 else end + 3
            name, close, rest = "", False, ""
        elif start > last:
            comment = page.find("<!--", start)
            yield page[at : comment if comment >= 0 else size], "", False, "", size
            return
        else:
            name, close = (found["name"] or "").lower(), bool(found["close"])
            body = REST.match(page, found.end()) if trusted and name else None
            if name and body is None:
                trusted = False
            end = body.end() if body else page.find(">", start) + 1
            rest = page[found.end() : end - 1] if name else ""
        skipped = yield page[at:start], name, close, rest, end
        at = end if skipped is None else skipped
    yield page[at:], "", False, "", size


def _names_surroundings(value: str) -> bool:
    for token in value.split():
        parts = [part for part in re.split("[_-]+", token) if part]
        last_after = max((k for k, part in enumerate(parts) if part in AFTER), default=-1)
        others = all(part in PARTS or NAMED.fullmatch(part) for part in parts)
        for k, part in enumerate(parts):
            if part in BEFORE:
                break
            if not NAMED.fullmatch(part) or k < last_after:
                continue
            if part == "header" and k and parts[k - 1] in OF_TEXT:
                continue
            if part not in SUBJECTS or others:
                return True
    return False


def _names_comments(value: str) -> bool:
    """Whether a class or id says that the element holds readers' comments, and nothing besides."""
    for token in value.split():
        parts = [part for part in re.split("[_-]+", token) if part]
        if any(map(COMMENTS.fullmatch, parts)) and all(
            part in OF_COMMENTS or part.isdigit() or COMMENTS.fullmatch(part) for part in parts
        ):
            return True
    return False


def _surrounds(name: str, rest: str, inside: bool, in_article: bool) -> bool | Named:
    """Whether an element is surroundings for sure, or by its name."""
    if name == "noscript":
        return not inside
    if name in AWAY and not (name == "header" and in_article):
        return True
    if not rest.strip() or name in ("html", "body"):
        return False
    named = None
    for key, *values in ATTRIBUTE.findall(rest):
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and "true" in values:
            return name not in MAIN
        value = "".join(values).strip().lower()
        if key not in ("class", "id", "role"):
            continue
        if key != "role" and _names_comments(value):
            return Named(True, comments=True)
        if name not in MAIN and _names_surroundings(value):
            named = named or Named(False)
            named.alone |= NAMED.fullmatch(value) is not None
    return named or False


@dataclass(slots=True)
class Open:
    """An open element, with what follows from those around it."""

    name: str
    away: bool
    inside: bool  # an article or main
    article: bool
    named: Named | None
    block: tuple[int, int]  # numbers of its block element and of the one around that
    base: int  # place of the nearest element that is no inline one, itself included


OUTSIDE = Open("", False, False, False, None, (0, 0), -1)


def lines_of(page: str) -> list[tuple[str, int, bool, tuple[int, int, bool]]]:
    """(text, weight, inside an article, place) of every line; a line of surroundings is ("", 0, False, place).

    A place is the numbers of the line's block element and of the one around it, and whether it is a heading.
    Every step costs the same however deep elements lie, but for those that it closes.
    """
    lines: list[tuple[Line, str, Open]] = []
    places: list[tuple[int, int, bool]] = []
    opened = 0
    stack: list[Open] = []
    count: dict[str, int] = {}  # open elements by name
    names: list[Named] = []
    containers = 0
    line = Line()
    links: list[list[bool]] = []  # of the open a elements: closed, or empty without a target
    targets: list[list[bool] | None] = []  # the innermost link with a target, for each of them

    def flush() -> None:
        nonlocal line
        text = line.text()
        if text:
            top = stack[-1] if stack else OUTSIDE
            lines.append((line, text, top))
            places.append((*top.block, any(e.name in HEADINGS for e in stack[-3:])))
        line = Line()

    def say(text: str) -> None:
        line.parts.append(text)
        if targets and targets[-1] and text.strip():
            line.links.append((targets[-1], len(" ".join(html.unescape(text).split()))))

    def pop_to(k: int) -> None:
        while len(stack) > k:
            top, under = stack[-1], stack[-2] if len(stack) > 1 else OUTSIDE
            if top.name == "a":
                links.pop(), targets.pop()
            elif top.name not in INLINE or (top.away, top.named) != (under.away, under.named):
                flush()
            count[top.name] -= 1
            stack.pop()

    reader = tags(page)
    found = next(reader, None)
    while found:
        before, name, close, rest, end = found
        resume = None
        if before:
            say(before)
        top = stack[-1] if stack else OUTSIDE
        if not name:
            pass
        elif close:
            if count.get(name):
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name)
                if name == "a" and links[-1]:
                    links[-1][0] = True
                pop_to(k)
            elif name not in INLINE:
                flush()
        elif name == "br":
            say(" ")
        elif name in RAW:
            closing = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, end)
            resume = closing.end() if closing else len(page)
        elif name in VOID:
            if name not in INLINE:
                flush()
        else:
            if name not in INLINE:
                k = top.base
                if k >= 0 and (stack[k].name == "p" or stack[k].name == name and name in CLOSES_P):
                    pop_to(k)
                flush()
                top = stack[-1] if stack else OUTSIDE
            begins = not top.away and _surrounds(name, rest, top.inside, top.article)
            if begins and name in INLINE:
                flush()
            if not (rest.endswith("/") and name not in INLINE):
                named = top.named
                if isinstance(begins, Named):
                    begins.parent, named = named, begins
                    names.append(begins)
                elif name in MAIN and not top.away and not (named and named.comments):
                    containers += 1
                    if named:
                        named.containers += 1
                opened += 1
                own = name in MAIN and not isinstance(begins, Named)
                stack.append(
                    Open(
                        name,
                        top.away or begins is True,
                        top.inside or own,
                        top.article or own and name == "article",
                        named,
                        top.block if name in INLINE else (opened, top.block[0]),
                        top.base if name in INLINE else len(stack),
                    )
                )
                count[name] = count.get(name, 0) + 1
                if name == "a":
                    target = any(key.lower() == "href" for key, *_ in ATTRIBUTE.findall(rest))
                    links.append([False] if target else [])
                    targets.append(links[-1] or (targets[-1] if targets else None))
        try:
            found = next(reader) if resume is None else reader.send(resume)
        except StopIteration:
            found = None
    pop_to(0)
    flush()
    weights = [0 if e.away else weight_of(line, text) for line, text, e in lines]
    for (*_, e), weight in zip(lines, weights):
        if e.named:
            e.named.weight += weight
    for element in reversed(names):  # an element stands before those in it
        if element.parent:
            element.parent.weight += element.weight
            element.parent.containers += element.containers
    total = sum(weights)
    for element in names:
        holds = 0 < containers == element.containers or not element.alone and element.weight * 2 > total
        element.wraps = holds and not element.comments and (element.parent is None or element.parent.wraps)
    kept = [not e.away and (e.named is None or e.named.wraps) for *_, e in lines]
    return [
        (text, weight, e.inside, place) if keep else ("", 0, False, place)
        for (_, text, e), weight, keep, place in zip(lines, weights, kept, places)
    ]


def weight_of(line: Line, text: str) -> int:
    linked = sum(n for closed, n in line.links if closed[0])
    return 0 if linked * 2 > len(text) else max(0, len(text) - linked)


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    contained = [text for text, _, inside, _ in lines if inside]
    if any(inside and weight for _, weight, inside, _ in lines):
        return "\n\n".join(contained)  # the container says where the text is
    weights = [weight for _, weight, _, _ in lines]
    sums = [sum(weights[max(0, k - WINDOW // 2) : k + WINDOW // 2 + 1]) for k in range(len(weights))]
    stretches, surge = [], None
    for k, weight in enumerate([*weights, 0]):
        if weight and surge is None:
            surge = k
        elif not weight and surge is not None:
            stretches.append((max(sums[surge:k]), surge, k))
            surge = None
    if not stretches:
        return "\n\n".join(contained)
    strong = [s for s in stretches if s[0] >= THRESHOLD] or [max(stretches, key=lambda s: s[0])]
    long = [k for _, a, b in strong for k in range(a, b) if weights[k] * WINDOW >= min(s[0] for s in strong)]
    first, last = strong[0][1], strong[-1][2]
    around = {number for k in long or range(first, last) for number in lines[k][3][:2]}
    reach = [
        k
        for k, (text, weight, _, (block, parent, heading)) in enumerate(lines)
        if (weight or heading and text and k < first) and (block in around or parent in around)
    ]
    first, last = min([first, *reach]), max([last, *(k + 1 for k in reach)])
    return "\n\n".join(text for k, (text, _, inside, _) in enumerate(lines) if text and (inside or first <= k < last))


def extract_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p if isinstance(p, str) else None) for p in pages], dtype=object)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return pages.select("page_id", "url", F.pandas_udf(extract_batches, "string")("html").alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
