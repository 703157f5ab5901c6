"""Elements of one HTML page and selectors over them: the small per-row helper of ``pages``.

A page becomes a list of elements in document order. The texts of the page are one list too, and
an element knows which stretch of it lies inside, so its text needs no tree walk. Character
references are decoded, names of tags and attributes are lower case, attribute values may be
quoted in any way or not at all. End tags that HTML lets a page omit are implied.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(("script", "style", "template"))
#: An element of the key ends open elements of the value, up to the nearest ``_HOLD``.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_ENDS |= dict.fromkeys("p div ul ol dl table section article aside header footer nav main h1 h2 h3 h4 h5 h6 blockquote pre form figure hr".split(), {"p"})
_HOLD = frozenset("ul ol dl table select button td th section article div".split())


class Element(NamedTuple):
    tag: str
    attrs: dict[str, str]
    parent: int
    first: int  # stretch of the page's texts
    last: int


class Page(HTMLParser):
    """``elements`` and ``texts`` of a page; a null page is empty."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self.texts: list[str] = []
        self.open: list[int] = []
        self.feed(html or "")
        self.close()
        while self.open:
            self._end()

    def _end(self) -> None:
        at = self.open.pop()
        self.elements[at] = self.elements[at]._replace(last=len(self.texts))

    def handle_starttag(self, tag, attrs):
        ended = _ENDS.get(tag, ())
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.elements[self.open[depth]].tag
            if name in ended:
                while len(self.open) > depth:
                    self._end()
            elif name in _HOLD:
                break
        found: dict[str, str] = {}
        for k, v in attrs:
            found.setdefault(k, v or "")
        n = len(self.texts)
        self.elements.append(Element(tag, found, self.open[-1] if self.open else -1, n, n))
        if tag not in VOID:
            self.open.append(len(self.elements) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if any(self.elements[i].tag == tag for i in self.open):
            while self.elements[self.open[-1]].tag != tag:
                self._end()
            self._end()

    def handle_data(self, data):
        if not (self.open and self.elements[self.open[-1]].tag in HIDDEN):
            self.texts.append(data)

    def text(self, e: Element, separator: str = "") -> str:
        """The texts inside ``e``, each without white space at its ends, empty ones left out."""
        return separator.join(t for x in self.texts[e.first:e.last] if (t := x.strip()))

    def select(self, selector: Selector) -> list[Element]:
        """Elements that match, in document order."""
        return [e for e in self.elements if selector.matches(self, e)]

    def inside(self, e: Element, outer: Element) -> bool:
        while e.parent >= 0:
            e = self.elements[e.parent]
            if e is outer:
                return True
        return False


_STEP = re.compile(r"\s*(>)?\s*([\w-]+|\*)?((?:[.#][\w-]+|\[[^\]]*\])*)")
_PART = re.compile(r"([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\]\s]*)))?\s*\]")


class _Step(NamedTuple):
    child: bool
    tag: str | None
    tests: tuple[tuple[str, str, str | None], ...]

    def matches(self, e: Element) -> bool:
        if self.tag and e.tag != self.tag:
            return False
        for kind, name, value in self.tests:
            got = e.attrs.get(name)
            if got is None or (kind == "word" and value not in got.split()) or (kind == "is" and value is not None and got != value):
                return False
        return True


class Selector:
    """Tag, ``#id``, ``.class``, ``[attribute]`` and ``[attribute=value]`` in any combination,
    descendants (blank), children (``>``) and alternatives (``,``). Anything else is an error."""

    def __init__(self, text: str):
        self.groups = [self._steps(g.strip()) for g in re.split(r",(?![^\[]*\])", text)]

    @staticmethod
    def _steps(text: str) -> list[_Step]:
        steps, at = [], 0
        while at < len(text):
            m = _STEP.match(text, at)
            if not m or not (m.group(2) or m.group(3)):
                raise ValueError(f"not a selector: {text!r}")
            tests = []
            for p in _PART.finditer(m.group(3)):
                if p.group(1):
                    tests.append(("word", "class", p.group(2)) if p.group(1) == "." else ("is", "id", p.group(2)))
                else:
                    tests.append(("is", p.group(3).lower(), next((v for v in p.groups()[3:] if v is not None), None)))
            tag = m.group(2)
            steps.append(_Step(bool(m.group(1)), None if tag in (None, "*") else tag.lower(), tuple(tests)))
            at = m.end()
        if not steps or steps[0].child:
            raise ValueError(f"not a selector: {text!r}")
        return steps

    def matches(self, page: Page, e: Element) -> bool:
        return any(self._group(page, e, g, len(g) - 1) for g in self.groups)

    def _group(self, page: Page, e: Element, steps: list[_Step], k: int) -> bool:
        if not steps[k].matches(e):
            return False
        if k == 0:
            return True
        while e.parent >= 0:
            e = page.elements[e.parent]
            if self._group(page, e, steps, k - 1):
                return True
            if steps[k].child:
                break
        return False
