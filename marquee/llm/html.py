"""A small tolerant reader of HTML: block elements with their texts, in page order.

It keeps what a site style tree needs: nested elements, the label of each (tag and class) and the
text of each block. Inline elements don't part a text. End tags close the nearest open element of
their name inside the innermost table cell, and are ignored if there is none. Scripts, styles,
comments and embedded objects are skipped with their content.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

#: Fixed values of HTML.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
SKIPPED = {"noscript", "template", "svg", "math", "object", "select", "canvas", "audio", "video"}
VOID = {"area", "base", "col", "embed", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt",
    "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A new element of the first kind ends an open one of the second; the search stops at the third.
IMPLIED = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
CELLS = {"table", "td", "th"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW | SKIPPED}


class Element:
    """A block element; ``blocks`` are its own texts as (place in the page, text), ``titled`` tells of an h1 or main in it."""

    __slots__ = ("tag", "label", "names", "parent", "children", "blocks", "titled")

    def __init__(self, tag: str, label: str, names: frozenset, parent: Element | None):
        self.tag, self.label, self.names, self.parent = tag, label, names, parent
        self.children: list[Element] = []
        self.blocks: list[tuple[int, str]] = []
        self.titled = False

    def walk(self, into: Callable[[Element], bool] = lambda e: True) -> Iterator[Element]:
        """This element and those below it, as far as ``into`` agrees."""
        todo = [self]
        while todo:
            e = todo.pop()
            if into(e):
                yield e
                todo.extend(reversed(e.children))


def _described(tag: str, rest: str) -> tuple[str, frozenset]:
    """The label, in which numbers in names are made alike, and the tokens of class, id and role, their words parted by hyphens.

    "hidden" tells of the attribute or style, or of a class of that name beside none that depends on the screen."""
    if "=" not in rest and "hidden" not in rest:
        return tag, frozenset()
    label, names = tag, set()
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), unescape(value.strip("\"'"))
        if key == "hidden" or key == "style":
            if key == "hidden" or re.search(r"display\s*:\s*none", value, re.I):
                names.add("hidden")
        else:
            for token in value.split():
                words = "-".join(_NAME.findall(token)).lower()
                if ":" not in token and not (words == "hidden" and ":" in value):
                    names.add(words)
            if key != "id":
                label += "." + ".".join(sorted(re.sub(r"\d+", "N", value).split()))
    return label, frozenset(names)


class _Reader:
    def __init__(self, dropped: Callable[[frozenset], bool]):
        self.root = self.here = Element("html", "html", frozenset(), None)
        self.dropped, self.text, self.place = dropped, [], 0
        self.skip: list | None = None  # tag of a dropped inline element, and how often it is open

    def flush(self) -> None:
        if self.text:
            block = " ".join(unescape("".join(self.text)).split())
            self.text.clear()
            if block:
                self.here.blocks.append((self.place, block))
                self.place += 1

    def data(self, text: str) -> None:
        if self.skip is None:
            self.text.append(text)

    def climb(self, wanted: set, stops: set) -> Element | None:
        e = self.here
        while e is not self.root and e.tag not in wanted and e.tag not in stops:
            e = e.parent
        return e if e is not self.root and e.tag in wanted else None

    def end(self, tag: str) -> None:
        if tag in INLINE:
            if self.skip and self.skip[0] == tag:
                self.skip[1] -= 1
                if not self.skip[1]:
                    self.skip = None
            return
        found = self.climb({tag}, CELLS - {tag} | ({"ul", "ol"} if tag == "li" else set()))
        if found is None:
            if tag == "p":
                self.flush()
            return
        self.skip = None
        self.flush()
        self.here = found.parent

    def start(self, tag: str, rest: str) -> None:
        if tag in INLINE:
            if self.skip:
                self.skip[1] += self.skip[0] == tag
            elif self.dropped(_described(tag, rest)[1]):
                self.skip = [tag, 1]
            return
        self.skip = None
        self.flush()
        if tag in ("html", "head", "body"):
            return
        if self.here.tag == "p" or (self.here.tag in HEADINGS and tag in HEADINGS):
            self.here = self.here.parent
        if tag in IMPLIED:
            found = self.climb(*IMPLIED[tag])
            if found is not None:
                self.here = found.parent
        child = Element(tag, *_described(tag, rest), self.here)
        self.here.children.append(child)
        self.here = child
        if tag in ("h1", "main"):
            e = child.parent
            while e is not None and not e.titled:
                e.titled, e = True, e.parent


def parse(html: str, dropped: Callable[[frozenset], bool] = lambda names: False) -> Element:
    """The root of the page. Text in inline elements whose names are ``dropped`` is left out."""
    reader, at, size = _Reader(dropped), 0, len(html)
    while at < size:
        match = _TAG.search(html, at)
        if match is None:
            reader.data(html[at:])
            break
        if match.start() > at:
            reader.data(html[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            reader.end(tag)
        elif tag in RAW or tag in SKIPPED:
            end = None if match[3].endswith("/>") and tag in ("svg", "math") else _ENDS[tag].search(html, at)
            if end:
                at = end.end()
            elif tag in RAW and tag != "iframe":
                at = size
        elif tag in ("br", "hr"):
            reader.data("\n")
        elif tag not in VOID:
            reader.start(tag, match[3])
    reader.flush()
    return reader.root
