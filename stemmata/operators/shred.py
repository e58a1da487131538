"""One pass over each document: XML to a table of nodes that all further queries share.

Each node has its place in preorder (node_id) and that of its last descendant (end_id), so containment is an
interval test; what the hot queries ask of ancestors (citation units, text parts, names) stands on the node itself.
A document that isn't well formed, or isn't in the encoding that it declares, gives one node of kind `error`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, chain
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import bounded
from ..sources.corpus import TEI, XML
from ..sources.encodings import readable
from ..vocabulary import WRAPPERS

SCHEMA = (
    "path string, node_id int, end_id int, parent_id int, depth int, kind string, ns string, name string, attrs map<string,string>, text string, has_child_node boolean, "
    "in_body boolean, in_text boolean, unit string, anc_units array<string>, anc_textparts int, anc_names array<string>, holds array<string>, location string, doc_base string, content string, before array<int>, among array<int>"
)
_TYPES = dict(c.split(" ", 1) for c in SCHEMA.split(", "))
_ARROW = {
    "path": pa.string(), "node_id": pa.int32(), "end_id": pa.int32(), "parent_id": pa.int32(), "depth": pa.int32(), "kind": pa.string(), "ns": pa.string(), "name": pa.string(),
    "attrs": pa.map_(pa.string(), pa.string()), "text": pa.string(), "has_child_node": pa.bool_(), "in_body": pa.bool_(), "in_text": pa.bool_(), "unit": pa.string(),
    "anc_units": pa.list_(pa.string()), "anc_textparts": pa.int32(), "anc_names": pa.list_(pa.string()), "holds": pa.list_(pa.string()), "location": pa.string(), "doc_base": pa.string(), "content": pa.string(),
    "before": pa.list_(pa.int32()), "among": pa.list_(pa.int32()),
}


#: What the operators read of a node; shred() makes no other columns than those asked for.
SIGNATURE = ("kind", "ns", "name", "in_body", "unit", "anc_units")
AUDIT = ("node_id", "end_id", "parent_id", "depth", "kind", "ns", "name", "attrs", "text", "in_body", "in_text", "unit", "anc_textparts", "anc_names", "doc_base")
CHECKS = ("kind", "ns", "name", "attrs", "text", "has_child_node", "holds", "location")
ROOTS = ("depth", "kind", "ns", "name", "text")
#: Elements that list what stands in them, two levels down, for child tests.
HOLDERS = ("profileDesc", "publicationStmt", "encodingDesc")


def unit_of(attrs: dict[str, str]) -> str | None:
    """The citation unit of a div: a text part's subtype, else its type unless that is a mere wrapper."""
    kind = attrs.get("type", "")
    if kind == "textpart":
        return attrs.get("subtype", "").lower() or None
    return kind.lower() if kind and kind not in WRAPPERS else None


class _Tree:
    """The handlers of one parse; names and keys are split once, and an element without attributes shares one empty map."""

    def __init__(self, contents: tuple[str, ...] = ()) -> None:
        self.contents = contents
        self.nodes: list[dict] = []
        self.stack: list[dict] = []
        self.known: dict[str, tuple[str, str]] = {}
        self.keys: dict[str, str] = {}
        self.none: dict[str, str] = {}

    def add(self, kind: str, ns: str, name: str, attrs: dict[str, str], text: str | None) -> dict:
        place = len(self.nodes) + 1
        if self.stack:
            parent = self.stack[-1]
            parent["has_child_node"] = True
            up, depth = parent["node_id"], parent["depth"] + 1
        else:
            up, depth = None, 0
        node = {
            "node_id": place, "end_id": place, "parent_id": up, "depth": depth, "kind": kind, "ns": ns, "name": name,
            "attrs": attrs, "text": text, "has_child_node": False, "holds": None, "location": None, "content": "" if name in self.contents else None,
        }
        self.nodes.append(node)
        return node

    def start(self, tag: str, raw: list[str]) -> None:
        known = self.known.get(tag)
        if known is None:
            ns, _, name = tag.rpartition("}")
            known = self.known[tag] = ns, name
        attrs = self.none
        if raw:
            attrs = {}
            for i in range(0, len(raw), 2):
                k = raw[i]
                key = self.keys.get(k)
                if key is None:
                    uri, _, local = k.rpartition("}")
                    key = self.keys[k] = f"xml:{local}" if uri == XML else f"{{{uri}}}{local}" if uri else local
                attrs[key] = raw[i + 1]
        self.stack.append(self.add("element", *known, attrs, None))

    def end(self, _tag: str) -> None:
        self.stack.pop()["end_id"] = len(self.nodes)

    def chars(self, data: str) -> None:
        if self.stack:
            top = self.stack[-1]
            if top["node_id"] == len(self.nodes):
                top["text"] = (top["text"] or "") + data
            top["has_child_node"] = True
            for n in self.stack if self.contents else ():
                if n["content"] is not None:
                    n["content"] += data


def _locate(nodes: list[dict], chosen: list[dict]) -> None:
    """Gives the chosen nodes their places (`/TEI[1]/text[1]`): numbers among siblings of a name, and the location of what stands above, once."""
    seen: dict[tuple[int | None, str], int] = {}
    for n in nodes:
        key = n["parent_id"], n["name"]
        n["place"] = seen[key] = seen.get(key, 0) + 1
    for n in chosen:
        way, at = [], n
        while at is not None and at["location"] is None:
            way.append(at)
            at = nodes[at["parent_id"] - 1] if at["parent_id"] else None
        location = at["location"] if at is not None else ""
        for x in reversed(way):
            location = x["location"] = f"{location}/{x['name']}[{x['place']}]"


def _holds(nodes: list[dict], holders: tuple[str, ...]) -> None:
    """Gives each holder its children and their children, as paths with at most one attribute test a step (`refsDecl[@n='CTS']/citeStructure`)."""
    found = set()
    for n in nodes:
        if n["name"] in holders and n["kind"] == "element" and n["ns"] == TEI:
            n["holds"] = []
            found.add(n["node_id"])
    tests = lambda n: [f"{n['name']}[@{k}{x}]" for k, v in n["attrs"].items() for x in ("", f"='{v}'")]
    for n in nodes:
        up = nodes[n["parent_id"] - 1] if n["parent_id"] else None
        if up is None or not (up["node_id"] in found or up["parent_id"] in found) or n["kind"] != "element" or n["ns"] != TEI:
            continue
        if up["holds"] is not None:
            up["holds"] += [n["name"], *tests(n)]
        above = nodes[up["parent_id"] - 1] if up["parent_id"] else None
        if above is not None and above["holds"] is not None:
            above["holds"] += [f"{up['name']}/{x}" for x in (n["name"], *tests(n))] + [f"{x}/{y}" for x in tests(up) for y in (n["name"], *tests(n))]
    for n in nodes:
        if n["holds"]:
            n["holds"] = list(dict.fromkeys(n["holds"]))


def _error(text: str) -> dict:
    return {"node_id": 0, "end_id": 0, "parent_id": None, "depth": 0, "kind": "error", "ns": "", "name": "", "attrs": {}, "text": text, "has_child_node": False, "in_body": False, "in_text": False, "unit": None, "anc_units": [], "anc_textparts": 0, "anc_names": [], "holds": None, "location": "", "doc_base": None, "content": None, "before": None, "among": None}


#: What a node tells only once all nodes of its document are made; nodes that none of it is asked of are kept alone.
_WHOLE = frozenset(("in_body", "unit", "anc_units", "holds", "location", "content"))


def _beside(nodes: list[dict], names: tuple[str, ...]) -> None:
    """Gives nodes the counts of elements of each name before them and among all children of their parent; the root is nobody's child."""
    number = {name: i for i, name in enumerate(names)}
    none = [0] * len(names)
    seen: dict[int, list[int]] = {}
    for n in nodes:
        kids = seen.setdefault(n["parent_id"], none.copy()) if n["parent_id"] else none
        n["before"], n["among"] = kids.copy(), kids
        if n["parent_id"] and n["name"] in number and n["kind"] == "element" and n["ns"] == TEI:
            kids[number[n["name"]]] += 1


class Once(dict):
    """What a function says of a key, asked once."""

    def __init__(self, of: Callable) -> None:
        super().__init__()
        self.of = of

    def __missing__(self, key: str):
        found = self[key] = self.of(key)
        return found


def _keeping(parser, only: frozenset[str], wanted: frozenset[str], beside: tuple[str, ...]) -> tuple[list[dict], Callable[[], None]]:
    """Sets handlers that keep the root and the nodes of these names, and of others only what is wanted of nodes above and beside the kept ones.

    Returns the list that nodes come into, and what completes them when all is read."""
    nodes: list[dict] = []
    number = {name: i for i, name in enumerate(beside)}
    zero = [0] * len(beside)
    #: Whether nodes tell what they hold and stand in, their numbers, and what stands above them: names, or text and parts.
    linked, numbered = bool(wanted & {"end_id", "parent_id", "depth", "text", "has_child_node"}), "node_id" in wanted
    named, above = "anc_names" in wanted, bool(wanted & {"in_text", "anc_textparts"})
    attrs_asked, base_asked = "attrs" in wanted, "doc_base" in wanted
    more = linked or numbered or named or above or base_asked
    #: Of the open elements: their numbers, themselves where they are kept, counts of their children by name; what stands above their children.
    ids: list[int] = []
    opened: list[dict | None] = []
    kids: list[list[int]] = [zero]
    names: list[str] = []
    parts, in_text = [0], [False]
    count, base, root = 0, None, True

    def split(tag: str) -> tuple[str, str, bool, bool, int | None]:
        ns, _, name = tag.rpartition("}")
        return ns, name, name in only, ns == TEI, number.get(name) if ns == TEI else None

    def key(raw: str) -> str:
        uri, _, local = raw.rpartition("}")
        return f"xml:{local}" if uri == XML else f"{{{uri}}}{local}" if uri else local

    known, keys = Once(split), Once(key)

    def attributes(raw: list[str]) -> dict[str, str]:
        return {keys[k]: v for k, v in zip(raw[::2], raw[1::2])}

    def keep(kind: str, ns: str, name: str, attrs: dict[str, str], text: str | None) -> dict:
        node = {"kind": kind, "ns": ns, "name": name, "attrs": attrs}
        if numbered or linked:
            node["node_id"] = count
        if linked:
            node |= {"end_id": count, "parent_id": ids[-1] if ids else None, "depth": len(ids), "text": text, "has_child_node": False}
        if named:
            node["anc_names"] = names.copy()
        if above:
            node["in_text"], node["anc_textparts"] = in_text[-1], parts[-1]
        if beside:
            # The parent's counts are whole when all is read.
            node["before"], node["among"] = kids[-1].copy(), kids[-1]
        nodes.append(node)
        return node

    def start(tag: str, raw: list[str]) -> None:
        nonlocal root
        ns, name, asked, _, place = known[tag]
        if asked or root:
            keep("element", ns, name, attributes(raw) if raw and attrs_asked else {}, None)
        if beside:
            if place is not None and not root:
                kids[-1][place] += 1
            kids.append(zero.copy())
        root = False

    def end(_tag: str) -> None:
        kids.pop()

    def start_more(tag: str, raw: list[str]) -> None:
        nonlocal count, base
        _, name, asked, tei, _ = known[tag]
        count += 1
        if ids and opened[-1] is not None:
            opened[-1]["has_child_node"] = True
        kept = asked or root
        start(tag, raw)
        if named:
            names.append(name)
        if above:
            part = tei and name == "div" and (nodes[-1]["attrs"] if kept and attrs_asked else attributes(raw)).get("type") == "textpart"
            in_text.append(in_text[-1] or (tei and name == "text"))
            parts.append(parts[-1] + part)
        if base_asked and base is None and tei and name == "body":
            base = attributes(raw).get("xml:base")
        if linked:
            opened.append(nodes[-1] if kept else None)
            ids.append(count)

    def end_more(_tag: str) -> None:
        if linked:
            ids.pop()
            node = opened.pop()
            if node is not None:
                node["end_id"] = count
        if beside:
            kids.pop()
        if named:
            names.pop()
        if above:
            in_text.pop()
            parts.pop()

    def chars(data: str) -> None:
        if opened and (node := opened[-1]) is not None:
            if node["node_id"] == count:
                node["text"] = (node["text"] or "") + data
            node["has_child_node"] = True

    def other(kind: str, name: str, data: str) -> None:
        nonlocal count
        count += 1
        if opened and opened[-1] is not None:
            opened[-1]["has_child_node"] = True
        if name in only:
            keep(kind, "", name, {}, data)

    def complete() -> None:
        for n in nodes if base_asked else ():
            n["doc_base"] = base or ""

    parser.StartElementHandler = start_more if more else start
    if more or beside:
        parser.EndElementHandler = end_more if more else end
    if wanted & {"text", "has_child_node"}:
        parser.CharacterDataHandler = chars
    parser.ProcessingInstructionHandler = lambda target, data: other("pi", target, data)
    parser.CommentHandler = lambda data: other("comment", "", data)
    return nodes, complete


def parse(xml: str | bytes, wanted: frozenset[str] = frozenset(_ARROW), holders: tuple[str, ...] = HOLDERS, contents: tuple[str, ...] = (), only: frozenset[str] | None = None, beside: tuple[str, ...] = ()) -> list[dict]:
    """The nodes of one document in preorder, or `only` its root element and those of these names; what isn't wanted and takes time is left out. Bytes are read in the encoding that they declare."""
    parser = expat.ParserCreate(namespace_separator="}")
    parser.ordered_attributes = True
    parser.buffer_text = True
    if only is not None and not wanted & _WHOLE:
        kept, complete = _keeping(parser, only, wanted, beside)
        try:
            parser.Parse(readable(xml), True)
        except (expat.ExpatError, ValueError, LookupError) as e:
            return [_error(str(e))]
        complete()
        return kept
    tree = _Tree(contents)
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = tree.start, tree.end, tree.chars
    parser.ProcessingInstructionHandler = lambda target, data: tree.add("pi", "", target, {}, data)
    parser.CommentHandler = lambda data: tree.add("comment", "", "", {}, data)
    try:
        parser.Parse(readable(xml), True)
    except (expat.ExpatError, ValueError, LookupError) as e:
        return [_error(str(e))]
    nodes = tree.nodes
    root = next(n for n in nodes if n["kind"] == "element")
    chosen = nodes if only is None else [n for n in nodes if n["name"] in only or n is root]
    if "holds" in wanted:
        _holds(nodes, holders)
    if "location" in wanted:
        _locate(nodes, chosen)
    if beside:
        _beside(nodes, beside)
    if "doc_base" in wanted:
        base = next((n["attrs"]["xml:base"] for n in nodes if n["name"] == "body" and n["kind"] == "element" and n["ns"] == TEI and "xml:base" in n["attrs"]), "")
        for n in chosen:
            n["doc_base"] = base
    if not wanted & {"in_body", "in_text", "unit", "anc_units", "anc_textparts", "anc_names"}:
        return chosen
    named = "anc_names" in wanted
    tei = lambda n: n["kind"] == "element" and n["ns"] == TEI
    body = next((n for n in nodes if n["name"] == "body" and tei(n)), None) or next((n for n in nodes if n["name"] == "text" and tei(n)), root)
    first, last = body["node_id"], body["end_id"]
    #: By the number of a node that has others below it: whether they are in the text, the units, text parts and names above them.
    below: dict[int | None, tuple[bool, list[str], int, list[str]]] = {None: (False, [], 0, [])}
    asked = None if only is None else {n["node_id"] for n in chosen}
    for n in nodes:
        here = n["node_id"]
        if n["end_id"] == here and asked is not None and here not in asked:
            continue
        in_text, units, parts, names = below[n["parent_id"]]
        inside = first < here <= last
        div = n["name"] == "div" and tei(n)
        unit = unit_of(n["attrs"]) if div and inside else None
        n["in_body"], n["unit"], n["in_text"], n["anc_units"], n["anc_textparts"], n["anc_names"] = inside, unit, in_text, units, parts, names
        if n["end_id"] > here:
            below[here] = (
                in_text or (n["name"] == "text" and tei(n)), [*units, unit] if unit else units, parts + (div and n["attrs"].get("type") == "textpart"), [*names, n["name"]] if named else names,
            )
    return chosen


def _lists(found: list[list | None], kind: pa.DataType) -> pa.Array:
    """An array of lists, from all their values in a row; none gives an empty one."""
    found = [x or () for x in found]
    return pa.ListArray.from_arrays(pa.array(accumulate(map(len, found), initial=0), pa.int32()), pa.array(chain.from_iterable(found), kind))


def _maps(found: list[dict[str, str]]) -> pa.Array:
    """An array of maps, from all keys and all values in a row."""
    offsets = pa.array(accumulate(map(len, found), initial=0), pa.int32())
    return pa.MapArray.from_arrays(offsets, pa.array(chain.from_iterable(found), pa.string()), pa.array(chain.from_iterable(x.values() for x in found), pa.string()))


def shred(docs: DataFrame, columns: tuple[str, ...] = (), holders: tuple[str, ...] = HOLDERS, contents: tuple[str, ...] = (), only: frozenset[str] | None = None, once: bool = False, beside: tuple[str, ...] = (), under: frozenset[str] | None = None, keys: tuple[str, ...] | None = None) -> DataFrame:
    """The nodes of all documents (path, xml: a string, or the bytes of a file), with the columns asked for (path always; none named: all); holders are the elements whose children are written down, contents those whose whole text is.

    only: the names of the nodes that the reader asks for; others are not made, but each document's root element and an error always are. once: nodes that are equal in every column but their number stand once for each document, the first of them.
    beside: names of elements; for each, `before` counts the siblings before a node, and `among` all children of its parent, itself too (of the root: none).
    under: the names of the nodes that are asked what they stand in; `anc_names` of others are empty. keys: the attributes that are asked for; `attrs` has no others."""
    bounded(docs.sparkSession)
    names = [c for c in _ARROW if c == "path" or ((not columns or c in columns) and c not in ("before", "among")) or (beside and c in ("before", "among"))]
    wanted = frozenset(names)
    own = [c for c in names if c not in ("path", "node_id", "attrs")]
    lists = [c for c in own if pa.types.is_list(_ARROW[c])]
    plain = [c for c in own if c not in lists]

    def distinct(nodes: list[dict]) -> list[dict]:
        seen: dict[tuple, dict] = {}
        for n in nodes:
            key = [n[c] for c in plain] + [tuple(n[c] or ()) for c in lists]
            if "attrs" in wanted and n["attrs"]:
                key.append(frozenset(n["attrs"].items()))
            seen.setdefault(tuple(key), n)
        return list(seen.values())

    def narrowed(nodes: list[dict]) -> None:
        """Takes away what isn't asked of these nodes."""
        for n in nodes:
            if under is not None and "anc_names" in wanted and n["name"] not in under:
                n["anc_names"] = ()
            if keys is not None and n["attrs"]:
                n["attrs"] = {k: v for k in keys if (v := n["attrs"].get(k)) is not None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = lambda: {k: [] for k in names}
        array = lambda k, c: _maps(c) if k == "attrs" else _lists(c, _ARROW[k].value_type) if k in ("before", "among", "anc_names") else pa.array(c, _ARROW[k])
        made = lambda columns: pa.RecordBatch.from_arrays([array(k, c) for k, c in columns.items()], names=names)
        for batch in batches:
            columns = empty()
            for path, xml in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes = parse(xml or "", wanted, holders, contents, only, beside)
                if under is not None or keys is not None:
                    narrowed(nodes)
                if once:
                    nodes = distinct(nodes)
                for k, c in columns.items():
                    c += [path] * len(nodes) if k == "path" else [n[k] for n in nodes]
                if len(columns["path"]) > 20_000:
                    yield made(columns)
                    columns = empty()
            if columns["path"]:
                yield made(columns)

    return docs.select("path", "xml").mapInArrow(run, ", ".join(f"{c} {_TYPES[c]}" for c in names))


def tei(nodes: DataFrame, *names: str) -> DataFrame:
    """The TEI elements of these names."""
    return nodes.where((F.col("kind") == "element") & (F.col("ns") == TEI) & F.col("name").isin(*names))


#: For lateral use in SQL: register with spark.udtf.register("shred", ShredUDTF).
def shred_udtf():
    from pyspark.sql.functions import udtf

    @udtf(returnType="node_id int, end_id int, parent_id int, depth int, kind string, ns string, name string, location string")
    class ShredUDTF:
        def eval(self, xml: str):
            for n in parse(xml or ""):
                yield tuple(n[k] for k in ("node_id", "end_id", "parent_id", "depth", "kind", "ns", "name", "location"))

    return ShredUDTF
