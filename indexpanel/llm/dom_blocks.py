"""Leaf blocks of a page's DOM: runs of text between block-level tags, with their ancestors, and their features."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br".split())
MATH = frozenset("math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
                 "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics annotation "
                 "annotation-xml".split())
INLINE |= MATH
SILENT = frozenset("script style template head title svg textarea select object iframe canvas".split())
RAW = frozenset("script style textarea title iframe".split())
CODE = frozenset(["script", "style"])
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSES = {"p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                         "hr main menu nav ol p pre section table ul".split()),
          "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
          "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

# Words of a class that say what the element has or is filed under, so that the word after them is no part of the page.
MODIFIERS = frozenset("has with no without hide show tag category cat topic filed layout theme template type format".split())
NAMED = frozenset("class id role itemprop aria-label".split())

# Every quantifier is possessive: a character is looked at a fixed number of times, whatever the page holds.
S = r"[ \t\n\f\r]"
NAME = r"=[^ \t\n\f\r/>=]*+|[^ \t\n\f\r/>=]++"
VALUE = r"""\"[^\"]*+\"|'[^']*+'|[^ \t\n\f\r>]++"""
TAG = re.compile(rf"<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:(?:{S}|/)*+(?:{NAME})(?:{S}*+={S}*+(?:{VALUE}))?+)*+(?:{S}|/)*+)>")
ATTRIBUTE = re.compile(rf"({NAME})(?:{S}*+={S}*+({VALUE}))?+|/")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(eq=False)
class Element:
    """An open element, the nearest block-level one around it, and those of its features that none around it has."""

    tag: str
    parent: Element | None = None
    features: tuple[str, ...] = ()
    fresh: tuple[str, ...] = ()
    label: str | None = None


@dataclass
class Block:
    parent: Element | None
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _names(value: str) -> set[str]:
    """The words of a class or id; one after a modifier (`has-sidebar`, `tag-ads`) is marked as no name of the element."""
    out = set()
    for token in html.unescape(value).split():
        modified = False
        for word in (t.lower() for t in TOKEN.findall(token)):
            out.add(f"of-{word}" if modified else word)
            modified = modified or word in MODIFIERS
    return out


def _element(tag: str, attributes: str) -> Element:
    features, label = (_known if len(attributes) <= 200 else _described)(tag, attributes)
    return Element(tag, features=features, label=label)


def _described(tag: str, attributes: str) -> tuple[tuple[str, ...], str | None]:
    """The features of an element, and its data-label."""
    names, label = set(), None
    for m in ATTRIBUTE.finditer(attributes):
        name, value = (m[1] or "").lower(), m[2] or ""
        if len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]:
            value = value[1:-1]
        if name in NAMED:
            names.update(_names(value))
        elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "").lower()) or (
                name == "aria-hidden" and value == "true"):
            names.add("hidden")
        elif name == "data-label":
            label = value
    found = {f"in={tag}"}
    for name in names if tag not in ("html", "body") else names & {"hidden"}:  # a body's class tells of the whole page
        found.add(f"name={name.rstrip('s')}")
        if len(name) > 4 and not name.startswith("of-"):
            found.add(f"stem={name[:4]}")
    return tuple(sorted(found)), label


_known = lru_cache(maxsize=4096)(_described)  # tags recur; long ones are not kept


class _Stack:
    """The open elements; every operation takes time by what it adds or removes, not by the depth."""

    def __init__(self) -> None:
        self.elements: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.seen: Counter[str] = Counter()
        self.silent = self.links = 0

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.elements))
        if e.tag not in INLINE:
            e.parent = self.block()
            e.fresh = tuple(f for f in e.features if not self.seen[f])
            self.seen.update(e.features)
            self.blocks.append(len(self.elements))
        self.silent += e.tag in SILENT
        self.links += e.tag == "a"
        self.elements.append(e)

    def pop(self) -> None:
        e = self.elements.pop()
        self.places[e.tag].pop()
        if e.tag not in INLINE:
            self.seen.subtract(e.features)
            self.blocks.pop()
        self.silent -= e.tag in SILENT
        self.links -= e.tag == "a"

    def cut(self, at: int) -> None:
        while len(self.elements) > at:
            self.pop()

    def block(self) -> Element | None:
        return self.elements[self.blocks[-1]] if self.blocks else None

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def end(self, tag: str) -> None:
        """Closes the last open element of this tag; an inline end tag closes nothing beyond its block."""
        at = self.last(tag)
        if at >= 0 and (tag not in INLINE or not self.blocks or at > self.blocks[-1]):
            self.cut(at)

    def end_head(self) -> None:
        """Closes an open head if nothing but noscript is open in it."""
        at = self.last("head")
        if at >= 0 and all(e.tag == "noscript" for e in self.elements[at + 1:at + 3]) and len(self.elements) <= at + 3:
            self.cut(at)

    def make_room(self, tag: str) -> None:
        """Closes what the start tag of a block-level element closes by the rules of HTML."""
        if any(tag in CLOSES.get(e.tag, ()) for e in self.elements[-8:]):
            while self.elements and self.elements[-1].tag in INLINE and any(tag in CLOSES.get(e.tag, ()) for e in self.elements[-8:]):
                self.pop()
        while self.elements and tag in CLOSES.get(self.elements[-1].tag, ()):
            self.pop()


class _Ends:
    """The next end tag of an element, found in one pass over the page for each kind of element."""

    def __init__(self, page: str) -> None:
        self.page, self.next = page, {}

    def after(self, tag: str, at: int) -> int:
        """Its place, or -1."""
        known = self.next.get(tag, 0)
        if 0 <= known < at or tag not in self.next:
            m = re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.IGNORECASE).search(self.page, at)
            known = self.next[tag] = m.start() if m else -1
        return known


def _declaration(page: str, at: int) -> tuple[int, str]:
    """Where a comment, declaration or CDATA section that starts at `at` ends, and the text it holds."""
    if page.startswith("<!--", at):
        if page.startswith((">", "->"), at + 4):
            return page.index(">", at) + 1, ""
        end = page.find("-->", at + 4)
        return (end + 3 if end >= 0 else len(page)), ""
    if page.startswith("<![CDATA[", at):
        end = page.find("]]>", at)
        return (end + 3, page[at + 9:end]) if end >= 0 else (len(page), page[at + 9:])
    end = page.find(">", at)
    return (end + 1 if end >= 0 else len(page)), ""


def _pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """The page as ("text", decoded text, ""), ("start", tag, attributes) and ("end", tag, "").

    An attribute's value ends at its quote; one whose quote never ends, at the first blank or `>`. A tag that the page
    breaks off is no text. Scripts and styles end at their end tag or with the page. Text areas, titles and frames are raw
    up to their end tag; without one, only their start tag goes, and so does that of any other silent element without an
    end, as it would take the rest of the page with it."""
    ends, at, held = _Ends(page), 0, 0
    while at < len(page):
        mark = page.find("<", at)
        after = page[mark + 1:mark + 3] if mark >= 0 else ""
        if mark >= 0 and not (after[:1] in ("!", "?") or after[:1].isascii() and after[:1].isalpha() or after[:1] == "/" and len(after) > 1):
            at = mark + 1
            continue
        if text := page[held:mark if mark >= 0 else len(page)]:
            yield "text", html.unescape(text), ""
        if mark < 0:
            return
        if after[0] in "!?" or after[0] == "/" and not (after[1].isascii() and after[1].isalpha()):
            at, text = _declaration(page, mark)
            if text:
                yield "text", text, ""
            held = at
            continue
        m = TAG.match(page, mark)
        if m is None:
            return
        at = held = m.end()
        tag = m[2].lower()
        if m[1]:
            yield "end", tag, ""
        elif tag not in SILENT or tag == "head":
            yield "start", tag, m[3]
        elif m[3].endswith("/") and tag not in RAW:
            continue
        else:
            end = ends.after(tag, at)
            if end < 0 and tag in CODE:
                return
            if tag in RAW:
                at = held = max(end, at)
            elif end >= 0:
                yield "start", tag, m[3]


def blocks_of(page: str | None) -> list[Block]:
    """Blocks with text in page order; comments, scripts, styles and the head give none. A head without an end tag ends
    at the first text or start tag that isn't head content. Takes time by the length of the page, whatever it holds."""
    out: list[Block] = []
    stack = _Stack()
    now: Block | None = None
    for kind, value, attributes in _pieces(page or ""):
        if kind == "text":
            blank = value.isspace()
            if stack.silent and not blank:
                stack.end_head()
            if not stack.silent and (now is not None or not blank):
                if now is None:
                    now = Block(stack.block())
                    out.append(now)
                now.parts.append(value)
                if stack.links:
                    now.linked += len(value.strip())
            continue
        tag = value
        if tag == "br":
            if now is not None:
                now.parts.append(" ")
            continue
        if tag not in INLINE:
            now = None
        if kind == "end":
            stack.end(tag)
            continue
        if stack.silent and tag not in IN_HEAD:
            stack.end_head()
        if tag not in INLINE:
            stack.make_room(tag)
        if tag == "body":
            stack.cut(1 if stack.elements and stack.elements[0].tag == "html" else 0)
        if tag not in VOID and not (attributes.endswith("/") and tag in MATH):
            stack.push(_element(tag, attributes))
    return [b for b in out if b.text]


def _bucket(n: float, steps: tuple[float, ...]) -> int:
    return sum(n >= s for s in steps)


def own_features(block: Block, place: float) -> list[str]:
    """Names of the features of a block's text and parent; place is its position in the page from 0 to 1."""
    text = block.text
    words = text.split()
    density = block.linked / max(1, len(text))
    parent = block.parent.tag if block.parent else "none"
    return ["bias", f"parent={parent}", f"words={_bucket(len(words), (2, 4, 8, 15, 30, 60))}",
            f"links={_bucket(density, (0.01, 0.2, 0.5, 0.9))}", f"place={_bucket(place, (0.1, 0.3, 0.7, 0.9))}",
            f"stop={text[-1] in '.!?…:”»'}", f"sign={'©' in text[:40]}",
            f"parent={parent},words={_bucket(len(words), (4, 15))}"]


def features(block: Block, place: float) -> list[str]:
    """Names of all features that hold of a block, each once."""
    out = own_features(block, place)
    e = block.parent
    while e is not None:
        out += e.fresh
        e = e.parent
    return out


def label_of(block: Block) -> int:
    """The innermost data-label around the block."""
    e = block.parent
    while e is not None and e.label is None:
        e = e.parent
    return int(e.label) if e is not None else 0


def scores(blocks: list[Block], weights: dict[str, float]) -> list[float]:
    """Per block the sum of its features' weights; that of the ancestors is taken once per element."""
    above: dict[Element | None, float] = {None: 0.0}
    out = []
    for i, b in enumerate(blocks):
        path, e = [], b.parent
        while e not in above:
            path.append(e)
            e = e.parent
        total = above[e]
        for e in reversed(path):
            total += sum(weights.get(f, 0.0) for f in e.fresh)
            above[e] = total
        out.append(total + sum(weights.get(f, 0.0) for f in own_features(b, i / max(1, len(blocks) - 1))))
    return out
