"""One HTML page as elements, subtree hashes and blocks of text: a helper of ``html_extract``."""

from __future__ import annotations

import html
import re
from collections.abc import Collection
from dataclasses import dataclass, field

import xxhash

# Names of the HTML standard and words that sites use in class and id.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Opening the first closes an open one of the second.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("thead", "tbody", "tr", "td", "th"),
    "option": ("option",),
    "optgroup": ("option", "optgroup"),
    "body": ("head",),
}
# Such a search for an element to close does not look beyond these.
SCOPES = frozenset("table ul ol dl menu select article section div body html".split())
NEVER = frozenset(
    "head script style title template noscript iframe object embed canvas svg math audio video "
    "textarea select option button input datalist noembed noframes map".split()
)
BOILERPLATE = frozenset("nav header footer aside form dialog menu".split())
BOILERPLATE_WORDS = frozenset(
    "nav navbar navigation menu sidebar footer header masthead ad ads advert adverts advertisement "
    "advertising banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login promo promotion sponsor sponsored social share "
    "sharing breadcrumb breadcrumbs comment comments disqus respond reply replies related "
    "recommended widget widgets toolbar pagination pager skip".split()
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar".split()
)
ARTICLE_WORDS = frozenset("article articlebody post entry story content main".split())
KEPT = frozenset("html body main article".split())
# Parts of a heading, list or table: they recur on many pages without being a template.
PARTS = frozenset(
    "h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption figcaption legend option "
    "summary".split()
)
# A block inside an article is a template by itself from so many letters on, at the end of the
# article from so many.
LONG_LETTERS = 40
LAST_LETTERS = 8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    parent: int
    dropped: bool = False  # by what it is
    named: bool = False  # dropped only if no article is in it
    main: bool = False  # holds the main text by its tag or role
    maybe: bool = False  # may hold it by its class
    holds: bool = False  # an article is in it
    hash: int = 0
    letters: int = 0
    linked: int = 0
    links: int = 0
    parts: list[str] = field(default_factory=list)


class Page:
    """Elements in page order, and pieces of text with their element and block."""

    def __init__(self, source: str) -> None:
        self.elements: list[Element] = [Element("", -1)]
        self.pieces: list[tuple[int, int, str]] = []
        self._open = [0]
        self._block = 0
        self._read(source)
        while self._open:
            self._close()
        for place, element in enumerate(self.elements):
            if element.main:
                up = place
                while up >= 0 and not self.elements[up].holds:
                    self.elements[up].holds = True
                    up = self.elements[up].parent

    def _read(self, source: str) -> None:
        at = 0
        while True:
            found = _TOKEN.search(source, at)
            self._text(source[at : found.start() if found else len(source)])
            if not found:
                return
            at = found.end()
            if found["cdata"] is not None:
                self._text(found["cdata"], raw=True)
            elif found["tag"]:
                tag = found["tag"].lower()
                if found["close"]:
                    self._end(tag)
                else:
                    self._start(tag, found["attrs"] or "")
                    if tag in RAW:
                        end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
                        at = end.start() if end else len(source)

    def _text(self, text: str, raw: bool = False) -> None:
        if not text:
            return
        if not raw and "&" in text:
            text = html.unescape(text)
        owner = self._open[-1]
        self.pieces.append((owner, self._block, text))
        plain = " ".join(text.split())
        if plain:
            element = self.elements[owner]
            element.parts.append(plain)
            element.letters += len(plain)
            if any(self.elements[place].tag == "a" for place in self._open[-3:]):
                element.linked += len(plain)

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.pieces.append((self._open[-1], self._block, " "))
            return
        if tag in BLOCKS:
            self._close_first(("p",), SCOPES - {"div", "section", "article"})
            self._block += 1
        if tag in CLOSES:
            self._close_first(CLOSES[tag], SCOPES - {"div", "section", "article"})
        if tag in VOID:
            return
        element = Element(tag, self._open[-1])
        if attrs.strip():
            self._judge(element, attrs)
        if tag in NEVER:
            element.dropped = True
        elif tag in BOILERPLATE and not (tag == "header" and self._in_article()):
            element.named = True
        if tag in ("main", "article") and not element.named:
            element.main = True
        element.links = tag == "a"
        self.elements.append(element)
        self._open.append(len(self.elements) - 1)
        if attrs.rstrip().endswith("/") and tag in ("svg", "math", "path"):
            self._close()

    def _in_article(self) -> bool:
        return any(self.elements[place].main for place in self._open)

    def _judge(self, element: Element, attrs: str) -> None:
        words: set[str] = set()
        whole: set[str] = set()
        for match in _ATTRIBUTE.finditer(attrs):
            name = match[1].lower()
            value = next((v for v in match.groups()[1:] if v is not None), "")
            if name in ("class", "id"):
                words.update(word.lower() for word in _WORDS.findall(value))
                whole.update(value.lower().split())
            elif name == "role":
                role = value.strip().lower()
                element.named |= role in BOILERPLATE_ROLES
                element.main |= role == "main"
            elif name == "itemprop":
                element.main |= value.strip().lower() == "articlebody"
            elif (
                name == "hidden"
                or (name == "aria-hidden" and value.lower() == "true")
                or (name == "style" and _HIDDEN.search(value))
            ):
                element.dropped |= element.tag not in ("html", "body")
        if element.tag not in ("html", "body", "main"):
            # An article may have comments, and say so in a part of a name.
            names = whole if element.tag == "article" else words
            element.named |= bool(names & BOILERPLATE_WORDS)
        element.maybe = bool(words & ARTICLE_WORDS) and not element.named

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._block += 1
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.elements[self._open[depth]].tag
            if name == tag:
                while len(self._open) > depth:
                    self._close()
                return
            # A closing inline tag does not end the blocks in between.
            if tag not in BLOCKS and name in BLOCKS:
                return

    def _close_first(self, tags: Collection[str], scopes: Collection[str]) -> None:
        """Close an open element of these tags, unless a scope is open inside it."""
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.elements[self._open[depth]].tag
            if name in tags:
                while len(self._open) > depth:
                    self._close()
                return
            if name in scopes:
                return

    def _close(self) -> None:
        element = self.elements[self._open.pop()]
        text = f"{element.tag}\x00" + "\x01".join(element.parts)
        element.hash = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
        element.parts = []
        if element.parent >= 0:
            above = self.elements[element.parent]
            above.parts.append(f"\x02{element.hash}")
            above.letters += element.letters
            above.linked += element.letters if element.tag == "a" else element.linked
            above.links += element.links

    def judged(self) -> tuple[list[bool], list[bool]]:
        """Per element: is it left out by what it is, and is it in the main part?"""
        out: list[bool] = []
        for element in self.elements:
            above = element.parent >= 0 and out[element.parent]
            out.append(above or element.dropped or (element.named and not element.holds))
        for wanted in ("main", "maybe"):
            inside: list[bool] = []
            letters = 0
            for place, element in enumerate(self.elements):
                above = element.parent >= 0 and inside[element.parent]
                here = getattr(element, wanted) and not out[place]
                inside.append(above or here)
                letters += element.letters if here and not above else 0
            if wanted == "main" and any(inside):
                # An article inside of a main part is the narrower choice.
                articles = [
                    element.tag == "article" and not out[place]
                    for place, element in enumerate(self.elements)
                ]
                if any(articles):
                    inside = []
                    for place, element in enumerate(self.elements):
                        above = element.parent >= 0 and inside[element.parent]
                        inside.append(above or articles[place])
                return out, inside
            if wanted == "maybe" and letters * 2 >= self.elements[0].letters > 0:
                return out, inside
        return out, [False] * len(self.elements)

    def _last(self, out: list[bool], inside: list[bool]) -> set[int]:
        """The elements that the main part ends with, one in the other."""
        found: set[int] = set()
        for owner, _, piece in reversed(self.pieces):
            if inside[owner] and not out[owner] and piece.strip():
                while owner >= 0:
                    found.add(owner)
                    owner = self.elements[owner].parent
                break
        return found

    def separable(self, out: list[bool], inside: list[bool]) -> list[bool]:
        """Per element: may it be deleted as a template by itself?

        Headings, list items, cells and inline elements may not, unless they are links outside of
        the main part; a block in the main part has to be long, or the last and no paragraph.
        """
        last = self._last(out, inside)
        found = []
        for place, element in enumerate(self.elements):
            block = element.tag in BLOCKS or "-" in element.tag
            if element.holds or not element.letters or element.tag in KEPT:
                found.append(False)
            elif not block or element.tag in PARTS:
                found.append(not inside[place] and element.linked > 0.7 * element.letters)
            elif inside[place]:
                ends = place in last and element.tag != "p" and element.letters >= LAST_LETTERS
                found.append(ends or element.letters >= LONG_LETTERS)
            else:
                found.append(True)
        return found

    def subtrees(self) -> tuple[int, list[int], list[int]]:
        """A hash of the page's main text, and hashes of subtrees in and outside the main part."""
        out, inside = self.judged()
        separable = self.separable(out, inside)
        within, without = set(), set()
        for place, element in enumerate(self.elements):
            if not out[place] and separable[place]:
                (within if inside[place] else without).add(element.hash)
        text = self.text((), ())
        return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63), [
            *within
        ], [*without]

    def text(self, within: Collection[int], without: Collection[int]) -> str:
        """The main text, less the recurring subtrees inside and outside the main part."""
        out, inside = self.judged()
        anywhere = not any(inside)
        separable = self.separable(out, inside) if within or without else []
        gone: list[bool] = []
        for place, element in enumerate(self.elements):
            above = element.parent >= 0 and gone[element.parent]
            templates = within if inside[place] else without
            recurring = bool(templates) and element.hash in templates and separable[place]
            # Outside an article, a list of links is a menu.
            menu = (
                anywhere
                and element.links >= 3
                and element.tag in BLOCKS
                and element.tag not in KEPT
                and element.linked > 0.7 * element.letters
            )
            gone.append(above or out[place] or recurring or menu)
        blocks: dict[int, list[str]] = {}
        for owner, block, piece in self.pieces:
            if not gone[owner] and (anywhere or inside[owner]):
                blocks.setdefault(block, []).append(piece)
        texts = (" ".join("".join(block).split()) for block in blocks.values())
        return "\n\n".join(text for text in texts if text)
