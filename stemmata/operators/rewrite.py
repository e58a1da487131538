"""Tree rewriting: named steps on one parsed document, fused into one pass over the table.

A document is parsed once, every step changes the tree, and it is written out once; an error becomes a value.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from xml.dom import minidom
from xml.dom.minidom import Document, Element, Node

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LANGUAGES
from ..runtime import bounded
from ..sources.corpus import TEI
from ..sources.encodings import readable
from ..vocabulary import FAMILY_DEFAULT, HIERARCHY, LINE, NAMES, Names


class RewriteError(ValueError):
    """A document that a step can't be applied to."""


@dataclass
class Context:
    """What the steps are told about a document."""

    cts_base: str = ""
    target: str = ""
    cert: str = ""
    schema: str = ""
    names: Names = NAMES


def elements(doc: Document, name: str) -> list[Element]:
    """The TEI elements of a name, in document order."""
    return list(doc.getElementsByTagNameNS(TEI, name))


def children(node: Node, name: str | None = None) -> list[Element]:
    return [c for c in node.childNodes if c.nodeType == Node.ELEMENT_NODE and c.namespaceURI == TEI and name in (None, c.localName)]


def make(like: Element, name: str, **attributes: str) -> Element:
    """A TEI element with the prefix that its surroundings use."""
    new = like.ownerDocument.createElementNS(TEI, f"{like.prefix}:{name}" if like.prefix else name)
    for k, v in attributes.items():
        new.setAttribute(k, v)
    return new


def renamed(element: Element, name: str) -> Element:
    new = make(element, name)
    for k, v in list(element.attributes.items()):
        new.setAttribute(k, v)
    while element.firstChild:
        new.appendChild(element.firstChild)
    element.parentNode.replaceChild(new, element)
    return new


def unwrap(element: Element) -> None:
    while element.firstChild:
        element.parentNode.insertBefore(element.firstChild, element)
    element.parentNode.removeChild(element)


def drop(node: Node) -> None:
    node.parentNode.removeChild(node)


def text_of(node: Node) -> str:
    return "".join(text_of(c) if c.nodeType == Node.ELEMENT_NODE else c.data for c in node.childNodes if c.nodeType in (Node.ELEMENT_NODE, Node.TEXT_NODE, Node.CDATA_SECTION_NODE))


# ---- the steps of normalization


def normalize_divs(doc: Document, _: Context) -> None:
    """Edition and translation wrappers go, text parts become divs of their unit, and every xml:base goes."""
    for div in elements(doc, "div"):
        if div.getAttribute("type") in ("edition", "translation"):
            unwrap(div)
        elif div.getAttribute("type") == "textpart" and div.hasAttribute("subtype"):
            div.setAttribute("type", div.getAttribute("subtype").lower())
            div.removeAttribute("subtype")
    for element in doc.getElementsByTagName("*"):
        if element.hasAttribute("xml:base"):
            element.removeAttribute("xml:base")


def set_urn(doc: Document, context: Context) -> None:
    """The URN goes on every body and, as the one CTS number, at the end of the publication statement."""
    if not context.cts_base:
        raise RewriteError("no CTS URN can be computed and none was given")
    for body in elements(doc, "body"):
        body.setAttribute("xml:base", context.cts_base)
    for statement in elements(doc, "publicationStmt"):
        for old in children(statement, "idno"):
            if old.getAttribute("type") == "CTS":
                drop(old)
        number = make(statement, "idno", type="CTS")
        number.appendChild(doc.createTextNode(context.cts_base))
        statement.appendChild(number)


#: Where the match expression of a level isn't the one its unit gives.
MATCHES = {
    "drama-line": ".//l",
    "prose-epistle": ".//div[@type='textpart'][@subtype='epistle' or @subtype='letter']",
    "prose-fragment": ".//div[@type='textpart'][@subtype='fragment']",
    "prose-paragraph": ".//div[@type='textpart'][@subtype='paragraph']",
}


def genre_of(doc: Document, names: Names) -> str:
    for profile in elements(doc, "profileDesc"):
        for group in children(profile, "textClass"):
            for ref in children(group, "catRef"):
                if ref.getAttribute("scheme") == names.scheme and ref.hasAttribute("target"):
                    return re.sub("^#", "", ref.getAttribute("target"))
    return ""


def declare_structure(doc: Document, context: Context) -> None:
    """A fresh citation declaration for the genre replaces the old one."""
    places = elements(doc, "encodingDesc")
    if not places:
        return
    genre = genre_of(doc, context.names)
    if not genre:
        raise RewriteError("no genre catRef in profileDesc")
    subclass = FAMILY_DEFAULT.get(genre, genre)
    if subclass not in HIERARCHY:
        raise RewriteError(f"unrecognized genre category: {genre!r}")
    for place in places:
        for old in children(place, "refsDecl"):
            if old.getAttribute("n") == "CTS":
                drop(old)
        declaration = make(place, "refsDecl", n="CTS")
        declaration.setAttribute("xml:id", "CTS")
        level = declaration.appendChild(make(place, "citeStructure", match="/TEI/text/body", use="@xml:base"))
        for i, unit in enumerate(HIERARCHY[subclass]):
            match = MATCHES.get(subclass) or ("l" if unit == LINE else f"div[@type='{unit}']")
            level = level.appendChild(make(place, "citeStructure", unit=unit, delim=":" if i == 0 else ".", match=match, use="@n"))
        place.appendChild(declaration)


def fix_verse(doc: Document, _: Context) -> None:
    """Meter annotations become a met value; placeholders go, and win where a line has both."""
    for line in elements(doc, "l"):
        if line.getAttribute("met") in ("u", "U"):
            line.removeAttribute("met")
        elif line.getAttribute("ana") in ("#met-dact", "#met-hexameter"):
            line.removeAttribute("ana")
            line.setAttribute("met", "dactylic-hexameter")


def set_schema(doc: Document, context: Context) -> None:
    """The first schema instruction is pointed at the schema, later ones go; where there is none, none is made."""
    schema = " ".join(context.schema.replace("'", "").split())
    seen = False
    for node in list(_instructions(doc)):
        if seen:
            drop(node)
        else:
            node.data = f'href="{context.names.schema_base}{schema}.rng" schematypens="http://relaxng.org/ns/structure/1.0"'
        seen = True


def _instructions(node: Node) -> Iterator[Node]:
    for c in node.childNodes:
        if c.nodeType == Node.PROCESSING_INSTRUCTION_NODE and c.target == "xml-model":
            yield c
        elif c.nodeType == Node.ELEMENT_NODE:
            yield from _instructions(c)


def set_genre(doc: Document, context: Context) -> None:
    """One text class with the target, in front of all else in the profile; every other text class goes."""
    for profile in elements(doc, "profileDesc"):
        for old in children(profile, "textClass"):
            drop(old)
        if context.target:
            ref = make(profile, "catRef", scheme=context.names.scheme, target=f"#{context.target}")
            if context.cert:
                ref.setAttribute("cert", context.cert)
                ref.setAttribute("resp", context.names.resp)
            group = make(profile, "textClass")
            group.appendChild(ref)
            profile.insertBefore(group, profile.firstChild)


def set_catalogue_genre(doc: Document, context: Context) -> None:
    """In a work's catalogue entry: its genre elements go, and a new one with its confidence comes last."""
    root = doc.documentElement
    for old in [c for c in root.childNodes if c.nodeType == Node.ELEMENT_NODE and c.namespaceURI == root.namespaceURI and c.localName == "genre"]:
        drop(old)
    new = doc.createElementNS(root.namespaceURI, f"{root.prefix}:genre" if root.prefix else "genre")
    new.setAttribute("confidence", context.cert)
    new.appendChild(doc.createTextNode(context.target))
    root.appendChild(new)


# ---- from the older edition of the encoding rules


def _camel(text: str) -> str:
    first, *rest = text.split() or [""]
    return first.lower() + "".join(w[:1].upper() + w[1:].lower() for w in rest)


def upgrade(doc: Document, _: Context) -> None:
    """Elements and attributes of the older encoding become their successors."""
    for name, attribute in (("teiHeader", "type"), ("refsDecl", "doctype")):
        for e in elements(doc, name):
            if e.hasAttribute(attribute):
                e.removeAttribute(attribute)
    for e in list(doc.getElementsByTagName("*")):
        if e.hasAttribute("targOrder"):
            e.removeAttribute("targOrder")
        if e.hasAttribute("id"):
            value = e.getAttribute("id")
            if e.namespaceURI == TEI and e.localName == "language":
                e.removeAttribute("id")
                e.setAttribute("ident", LANGUAGES.get(value, value))
            elif not e.hasAttribute("xml:id"):
                e.removeAttribute("id")
                e.setAttribute("xml:id", value)
        if e.hasAttribute("lang"):
            value = e.getAttribute("lang")
            e.removeAttribute("lang")
            e.setAttribute("xml:lang", LANGUAGES.get(value, value))
        if e.hasAttribute("anchored"):
            value = e.getAttribute("anchored")
            e.setAttribute("anchored", {"yes": "true", "no": "false"}.get(value, value))
        for k in ("type", "unit"):
            if " " in e.getAttribute(k):
                e.setAttribute(k, _camel(e.getAttribute(k)))
        if e.namespaceURI == TEI and e.localName in ("entry", "entryFree") and e.hasAttribute("key"):
            value = e.getAttribute("key")
            e.removeAttribute("key")
            e.setAttribute("n", value)
    for name in ("div0", "div1", "div2"):
        for e in elements(doc, name):
            renamed(e, "div")
    for e in elements(doc, "state"):
        if e.parentNode.nodeType == Node.ELEMENT_NODE and e.parentNode.localName == "refsDecl":
            new = make(e, "refState")
            for k in ("unit", "n"):
                if e.hasAttribute(k):
                    new.setAttribute(k, e.getAttribute(k))
            e.parentNode.replaceChild(new, e)
    for e in elements(doc, "trans"):
        unwrap(e)
    for e in elements(doc, "tr"):
        kind = e.getAttribute("type") or "translation"
        renamed(e, "seg").setAttribute("type", kind)
    for entry in elements(doc, "biblStruct"):
        numbers = children(entry, "idno")
        if numbers:
            _merge_numbers(entry, numbers)
    for change in elements(doc, "change"):
        if change.parentNode.localName == "revisionDesc":
            _flatten_change(change)


def _merge_numbers(entry: Element, numbers: list[Element]) -> None:
    """A record's numbers go into each monograph, in front of its imprint."""
    others = [c for c in children(entry) if c.localName not in ("monogr", "idno")]
    monographs = children(entry, "monogr")
    while entry.firstChild:
        entry.removeChild(entry.firstChild)
    for m in monographs:
        parts = children(m)
        while m.firstChild:
            m.removeChild(m.firstChild)
        for part in [*[p for p in parts if p.localName != "imprint"], *[n.cloneNode(True) for n in numbers], *[p for p in parts if p.localName == "imprint"]]:
            m.appendChild(part)
        entry.appendChild(m)
    for c in others:
        entry.appendChild(c)


def _flatten_change(change: Element) -> None:
    """A change keeps its dates and names, and its items become paragraphs."""
    dates = children(change, "date")
    names = [n for s in children(change, "respStmt") for n in children(s, "name")]
    items = children(change, "item")
    while change.firstChild:
        change.removeChild(change.firstChild)
    for part in [*dates, *names]:
        change.appendChild(part)
    for item in items:
        p = change.appendChild(make(change, "p"))
        while item.firstChild:
            p.appendChild(item.firstChild)


Step = Callable[[Document, Context], None]
STEPS: dict[str, Step] = {f.__name__: f for f in (normalize_divs, set_urn, declare_structure, fix_verse, set_schema, set_genre, set_catalogue_genre, upgrade)}
PIPELINES = {
    "prose": ("normalize_divs", "set_urn", "declare_structure", "set_schema"),
    "verse": ("normalize_divs", "set_urn", "declare_structure", "fix_verse", "set_schema"),
    "drama": ("normalize_divs", "set_urn", "declare_structure", "set_schema"),
}


def rewrite(xml: str | bytes, steps: tuple[str, ...], context: Context) -> str:
    """One document through the steps."""
    doc = minidom.parseString(readable(xml))
    reduce(lambda _, step: STEPS[step](doc, context), steps, None)
    prolog = '<?xml version="1.0" encoding="UTF-8"?>'
    return prolog + "".join("\n" + c.toxml() for c in doc.childNodes)


def rewritten(docs: DataFrame, steps: tuple[str, ...] | None = None, names: Names = NAMES) -> DataFrame:
    """path, xml and error of documents (path, xml, and where a step asks: family, cts_base, target, cert).

    Without steps, each document takes those of its family."""
    bounded(docs.sparkSession)
    have = set(docs.columns)
    given = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in ("family", "cts_base", "target", "cert")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, errors = [], []
            for _, xml, family, base, target, cert in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    todo = steps or PIPELINES.get(family)
                    if todo is None:
                        raise RewriteError(f"no pipeline for family {family!r}")
                    out.append(rewrite(xml or "", todo, Context(base, target, cert, names.schema_prefix + family, names)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - a document that can't be rewritten is a result, not a failure
                    out.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(errors, pa.string())], names=["path", "xml", "error"])

    return docs.select("path", "xml", *given).mapInArrow(run, "path string, xml string, error string")
