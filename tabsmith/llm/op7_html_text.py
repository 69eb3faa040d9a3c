"""HTML extraction: two-pass block rules.

A page is cut into blocks at block-level tags and line breaks of its markup;
each block carries its text, the characters inside links, its share of stop words
and what it stands in. The first pass decides blocks: parts that are no article by
their element or name (menus, headers, footers, sidebars, notices, adverts, forms,
comments), and blocks dense in links outside an article element, are dropped; long blocks
with stop words, or that read as prose in any language (mostly letters, in sentences),
long preformatted blocks, and long blocks of an article element, are kept. Short blocks
without links, and all short ones of an article element, stay open. The second pass gives each open block the label of its nearest decided
neighbours: the common one if both agree, else the nearer one's. Blocks dropped for
their place are no neighbours, nor are blocks outside the article element that a
block stands in; open blocks without a neighbour are kept.

Names are whole: a class or role, or all of an id or aria-label, of listed words only
(``cookie-notice``, not ``has-comments``). They drop neither a main or article element
nor an element (or a form) that holds one; an article inside an article is where comments stand in
HTML, so there names count.

Cases: NULL is the empty page; broken markup never fails (an unclosed element ends
with its parent, an unclosed head at the first element or text of the body, and only
an unclosed script, style, textarea or iframe runs to the end of the page, as in a
browser; a lone ``<``, and a tag that no ``>`` ends before the next ``<``, is text); very
long pages are read whole, in time linear in the page; a page without kept blocks gives ''; rows
that repeat an id each get their row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
the of and to in is was for that it on as with by this from at are be or an he his which but not have had they you
der die das und ist nicht ein eine mit auf den dem des von zu sich im für auch als werden
le la les des du de et un une dans pour est que qui sur par au pas plus avec ce il elle
el los las del y en una por con para se su al lo como más pero sus no es
""".split())

#: Elements whose text is never part of an article.
DROPPED = frozenset("nav footer aside menu dialog button select option label fieldset noscript".split())
#: Elements without markup inside: up to their closing tag or the end of the page.
RAW = "script|style|textarea|iframe"
#: Other elements whose text is not read; those that `/>` closes.
UNREAD = frozenset("noscript template svg object head".split())
CLOSED = frozenset("svg object".split())
BLOCKS = frozenset("""
address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table
tbody td tfoot th thead title tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a browser closes by itself when the next one opens; they hold no label here.
LOOSE = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
#: Elements that may stand in a head.
HEAD = frozenset("base basefont bgsound link meta noframes noscript object script style template title".split())
#: Inline elements whose end also ends what is left open in them, as the end of a loose one does.
INLINE = LOOSE | frozenset("a b big code em font i s small strike strong sub sup tt u".split())
#: Start tags that end an open svg.
OUT = BLOCKS - {"title"} | INLINE - {"a", "font"} | frozenset("embed img meta nobr ruby span var".split())
ARTICLE = frozenset("article main".split())
#: The words that class, id and role names of what is no article consist of.
NAMED = frozenset("""
ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar navigation menu
breadcrumb breadcrumbs sidebar side aside footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices
alert popup modal overlay comment comments disqus reply replies share sharing social related recommended newsletter subscribe
signup login search pagination pager widget widgets contentinfo complementary form
""".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>"
    r"|<[!?/][^<>]*+>", re.S | re.I)
_ENDS = re.compile("</(noscript|template|svg|object)(?![a-z0-9:-])", re.I)
_ATTR = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[-_\s\d]+")
_WORDS = re.compile(r"\w+")
#: Marks that end a sentence, in several scripts.
_SENTENCES = re.compile("[.!?\u2026\u3002\uff01\uff1f\u0964\u06d4\u061f]")

LONG, LINKS, STOPS = 70, 0.33, 0.2
#: Prose in any language: share of letters and spaces, and most characters a sentence takes.
LETTERS, SENTENCE = 0.8, 400


class Block:
    __slots__ = ("text", "linked", "place", "dropped", "article", "label")

    def __init__(self, text: str, linked: int, place: Element):
        self.text, self.linked, self.place, self.article = text, linked, place, place.article
        self.dropped, self.label = False, None


class Element:
    """An element: whether it is dropped for its place (or one around it for anything),
    whether for its name, the number of the article element around, whether an article
    may be no comment in it (``story``) and whether it holds one, whether its text is not
    read, and the inline elements open around the unread."""
    __slots__ = ("name", "parent", "dropped", "named", "article", "story", "holds", "unread", "around")

    def __init__(self, name: str, parent: Element | None, dropped: bool = False, named: bool = False):
        self.name, self.parent, self.dropped, self.named, self.holds = name, parent, dropped, named, False
        self.article, self.story, self.unread, self.around = \
            (parent.article, parent.story and name != "article", parent.unread, parent.around) if parent else (0, True, False, {})


def _hidden(attrs: str) -> bool:
    """Whether the element is not shown."""
    for name, *values in _ATTR.findall(attrs):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or \
                name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _named(attrs: str) -> bool:
    """Whether class, id, role or aria-label say that the element is no article."""
    for name, *values in _ATTR.findall(attrs):
        value, name = "".join(values).lower(), name.lower()
        for token in value.split() if name in ("class", "role") else [value] if name in ("id", "aria-label") else ():
            parts = set(_PARTS.split(token)) - {""}
            if parts and parts <= NAMED:
                return True
    return False


def _apart(attrs: str) -> bool:
    return bool(attrs) and (_hidden(attrs) or _named(attrs))


def blocks(page: str) -> list[Block]:
    """The page's non-empty blocks in order; linear in the page."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    made = [Element("", None)]           # every element, parents first
    stack = made[:]
    inline: Counter = Counter()
    ends: dict[str, int] | None = None   # the last closing tag of each unread element
    links = articles = at = 0
    in_head = False

    def put(*args) -> Element:
        made.append(Element(*args))
        stack.append(made[-1])
        return made[-1]

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, min(linked, len(text)), stack[-1]))
        parts.clear()
        linked = 0

    def leave_head() -> None:
        nonlocal in_head
        while stack.pop().name != "head":
            pass
        in_head = False

    def take(text: str) -> None:
        nonlocal linked
        if stack[-1].name == "head" and text.strip():
            leave_head()
        if stack[-1].unread:
            return
        parts.append(text)
        if links:
            linked += len(html.unescape(text).strip())

    for m in _TAG.finditer(page):
        if m.start() > at:
            take(page[at:m.start()])
        at = m.end()
        if m["raw"]:
            flush()
            continue
        name = (m["name"] or "").lower()
        if not name:
            continue
        if in_head and not m["close"] and name not in HEAD:
            if ends is None:
                ends = {e[1].lower(): e.start() for e in _ENDS.finditer(page)}
            inner = stack[-1].name
            if name == "body" or inner == "head" or (name in BLOCKS if inner == "title" else ends.get(inner, -1) < at):
                leave_head()
        while stack[-1].name == "svg" and (name == "p" if m["close"] else name in OUT):
            stack.pop()
        if m["close"] and stack[-1].unread and 0 < inline[name] <= stack[-1].around.get(name, 0):
            # the end of an element around what is not read
            while stack[-1].unread:
                stack.pop()
        if name in INLINE:
            inline[name] = max(0, inline[name] + (-1 if m["close"] else 1))
        if name in BLOCKS:
            if name == "br":
                parts.append("\n")
            else:
                flush()
        top = stack[-1]
        if m["close"]:
            if name == "a":
                links = links if top.unread else 0
            elif name not in LOOSE and any(e.name == name for e in stack):
                while stack.pop().name != name:
                    pass
                in_head = in_head and any(e.name == "head" for e in stack)
        elif name == "a":
            links = links if top.unread else 1
        elif name in UNREAD or top.unread and name == "foreignobject":
            if not (name in CLOSED and m["attrs"].endswith("/")):
                flush()
                if not put(name, top).unread:
                    stack[-1].unread, stack[-1].around = True, {} if name == "head" else dict(inline)
                in_head = in_head or name == "head"
        elif name not in VOID and name not in LOOSE and (name in BLOCKS or name == "span"):
            page_part = name in ("html", "body")
            # dropped for its place, or for its name (a form too) unless it holds an article
            at_place = name in DROPPED or name == "header" and not top.article or not page_part and _hidden(m["attrs"])
            whole = name == "main" or name == "article" and top.story
            e = put(name, top, at_place, not page_part and not whole and (name == "form" or _named(m["attrs"])))
            if name in ARTICLE and not e.article:
                articles += 1
                e.article = articles
            while whole and not top.unread and e is not None and not e.holds:
                e.holds, e = True, e.parent
        elif name in LOOSE and _apart(m["attrs"]):
            # a paragraph or list item of its own name: dropped up to its end
            put(name, top, _hidden(m["attrs"]), _named(m["attrs"]))
        if name in LOOSE and stack[-1].name in LOOSE and (m["close"] or not _apart(m["attrs"])):
            flush()
            stack.pop()
    take(page[at:])
    flush()
    for e in made[1:]:
        e.dropped = e.dropped or e.named and not e.holds or e.parent.dropped
    for b in out:
        b.dropped = b.place.dropped
    return out


def _prose(text: str) -> bool:
    """Whether a long block reads as prose, whatever its language."""
    letters = sum(c.isalpha() or c.isspace() for c in text)
    return letters >= LETTERS * len(text) and len(text) <= SENTENCE * len(_SENTENCES.findall(text))


def decide(found: list[Block]) -> None:
    """First pass: True (kept), False (dropped) or None (open)."""
    for b in found:
        words = _WORDS.findall(b.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
        if b.dropped or b.linked > LINKS * len(b.text) and not b.article:
            b.label = False
        elif len(b.text) >= LONG and (b.article or stops >= STOPS or b.place.name == "pre" or _prose(b.text)):
            b.label = True
        elif b.linked and not b.article:
            b.label = False
        elif len(b.text) >= LONG and not b.article:
            b.label = False


def inherit(found: list[Block]) -> None:
    """Second pass: open blocks take the label of their nearest decided neighbours, found
    by one sweep from the left and one from the right."""
    first = [b.label for b in found]
    sides: list[list] = [[] for _ in found]
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        article, inside, any_ = None, None, None
        for i in order:
            b = found[i]
            if b.article != article:
                article, inside = b.article, None
            if first[i] is None:
                near = inside if b.article else any_
                if near is not None:
                    sides[i].append((abs(near - i), first[near]))
            elif not b.dropped:
                # what is dropped for its place says nothing about the text around it
                inside = any_ = i
    for b, label, near in zip(found, first, sides):
        if label is None:
            b.label = min(near, key=lambda s: (s[0], not s[1]))[1] if near else True


def main_text(page: str | None) -> str:
    """The article's blocks, each with single spaces, joined by one space."""
    found = blocks(page or "")
    decide(found)
    inherit(found)
    return " ".join(b.text for b in found if b.label)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    types = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(p) for p in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    return pages.select("page_id", "url", "html").mapInPandas(
        run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
