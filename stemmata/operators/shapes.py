"""Subtrees of a document that are equal in all that is asked of them, as one: documents repeat a few of them many times."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from xml.parsers import expat

from ..sources.corpus import XML
from ..sources.encodings import readable

#: Shapes that are kept from document to document.
KEPT = 50_000


def grown(xml: str | bytes) -> ET.Element | None:
    """The elements of a document; None if it is broken."""
    try:
        return ET.XML(readable(xml))
    except (ET.ParseError, ValueError, LookupError):
        # That parser refuses entities that stand in no declaration it reads; what is no document at all this one tells.
        builder, parser = ET.TreeBuilder(), expat.ParserCreate(namespace_separator="}")
    braced = lambda name: "{" + name if "}" in name else name
    parser.StartElementHandler = lambda tag, attrs: builder.start(braced(tag), {braced(k): v for k, v in attrs.items()})
    parser.EndElementHandler = lambda tag: builder.end(braced(tag))
    try:
        parser.Parse(readable(xml), True)
    except (expat.ExpatError, ValueError, LookupError):
        return None
    return builder.close()


def written(keys: tuple[str, ...]) -> tuple[str, ...]:
    """The names of attributes as the tree has them."""
    return tuple(f"{{{XML}}}{k[4:]}" if k.startswith("xml:") else k for k in keys)


class Shapes:
    """Numbers for subtrees: those with the same tag, values of these attributes and subtrees below, in order, have one. What stands below has the lower number."""

    def __init__(self, keys: tuple[str, ...]) -> None:
        self.written = written(keys)
        self.made: list[tuple[tuple, tuple[int, ...]]] = []
        self.numbers: dict[tuple, int] = {}

    def of(self, root: ET.Element) -> int:
        keys, made, numbers = self.written, self.made, self.numbers
        #: Of the elements after the one at hand, those whose parent is yet to come; the first of them last.
        stack: list[int] = []
        for e in reversed(list(root.iter())):
            if n := len(e):
                shape = (e.tag, *map(e.get, keys)), tuple(stack[: -n - 1 : -1])
                del stack[-n:]
            else:
                shape = (e.tag, *map(e.get, keys)), ()
            at = numbers.get(shape)
            if at is None:
                at = numbers[shape] = len(made)
                made.append(shape)
            stack.append(at)
        return stack[0]
