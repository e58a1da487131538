"""Schematron files read as checks: an XPath subset compiled to Columns over the node table.

Contexts: an element name or processing-instruction(), with predicates, alternatives by `|`. Tests: and, or, not(), comparisons (with
sequences of literals too, and with numbers), attributes, `.` of a processing instruction, node(), paths, count(), contains, starts-with,
substring-after, normalize-space, string-length, number, concat, variables of sch:let; in a context also position() and last() among the
siblings of its name. Paths: steps by `/` and `//` along child, descendant, ancestor and parent (`..`), with predicates that ask for
attributes; a path by itself along preceding-sibling and following-sibling; `//` from the root. Child paths of one or two steps with one
attribute test each are answered by the shredder; what else is counted along an axis is a probe (see axes). In a pattern the
first rule whose context fits a node counts. Included files, extended abstract rules, abstract patterns, phases and diagnostics are
resolved before. Anything else raises ValueError with the expression: no rule is left out in silence.
"""

from __future__ import annotations

import copy
import os
import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, or_empty
from ..runtime import staged
from ..sources.corpus import TEI, XML
from .axes import SIBLINGS, Probe, Step, names_beside, probed
from .schematron import ASSERT, REPORT, Check, asked, count_checks, run_checks
from .shred import shred
from .tally import tally

SCH = "http://purl.oclc.org/dsdl/schematron"
_TOKEN = re.compile(r"""\s*(?:(?P<string>"[^"]*"|'[^']*')|(?P<number>\d+(?:\.\d+)?)(?![\w.-])|(?P<name>[$@]?[\w.-]*[^\W\d][\w.-]*(?::[\w.-]+)?)|(?P<mark>!=|<=|>=|//|::|\.\.|[()\[\],=<>|/.*]))""")
_COMPARE = {"=": Column.__eq__, "!=": Column.__ne__, "<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}
_AXES = ("child", "descendant", "ancestor", "parent", *SIBLINGS)


@dataclass(frozen=True)
class Schema:
    """The checks of a file, the elements whose children they ask for (for shred's holders), and what is to be counted along axes first."""

    checks: list[Check]
    holders: tuple[str, ...]
    probes: tuple[Probe, ...] = ()
    #: The columns of a node that its expressions name, besides its kind and name.
    reads: tuple[str, ...] = ()
    #: The attributes that they name.
    keys: tuple[str, ...] = ()
    #: Whether some context is one of processing instructions.
    instructions: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        """What the checks read of a node, and what their findings and probes need."""
        place = () if self.told else ("node_id", "end_id", "parent_id")
        return ("kind", "ns", "name", *self.reads, "location", *place)

    @property
    def beside(self) -> tuple[str, ...]:
        """The names of siblings that the shredder is to count."""
        return names_beside(self.probes)

    @property
    def told(self) -> bool:
        """Whether the shredder answers all probes."""
        return all(p.told for p in self.probes)

    @property
    def above(self) -> tuple[Probe, ...]:
        """What the tally is to count above elements."""
        return tuple(p for p in self.probes if p.above)

    @property
    def tallied(self) -> bool:
        """Whether elements can be counted where documents are parsed: nothing is asked of them but attributes, siblings and, by names and attributes, what stands above."""
        return all(p.told or p.above for p in self.probes) and self.counted is not None and not self.instructions and set(self.reads) <= {"attrs"}

    @property
    def counted(self) -> frozenset[str] | None:
        """The names of the elements that the tally is to count; None: of any name."""
        own = asked(self.checks)
        return None if own is None else own | {p.steps[-1].name for p in self.probes if p.told}

    @property
    def asked(self) -> frozenset[str] | None:
        """The names of the nodes that contexts and steps ask for; None: nodes of any name."""
        own, steps = asked(self.checks), [s.name for p in self.probes for s in (p.steps[-1:] if p.beside else p.steps)]
        return None if own is None or None in steps else own | frozenset(steps)


@dataclass
class _Value:
    """What an expression gives: a truth, a number, nodes (null: none) or strings."""

    kind: str
    columns: list[Column]

    def truth(self) -> Column:
        if self.kind == "bool":
            return self.columns[0]
        if self.kind == "number":
            return F.coalesce(self.columns[0] != 0, F.lit(False))
        return reduce(Column.__or__, [c.isNotNull() if self.kind == "node" else F.coalesce(c != "", F.lit(False)) for c in self.columns])

    def text(self, source: str) -> Column:
        if self.kind == "bool" or len(self.columns) != 1:
            raise ValueError(f"a string is wanted in {source!r}")
        if self.kind == "number":
            n = self.columns[0].cast("double")
            return or_empty(F.when(n == F.floor(n), n.cast("long").cast("string")).otherwise(n.cast("string")))
        return or_empty(self.columns[0])

    def numbers(self) -> list[Column]:
        return [c if self.kind == "number" else c.try_cast("double") for c in self.columns]


@dataclass
class _Scope:
    """What an expression may refer to: prefixes, variables, and the context's own name (None: a processing instruction)."""

    prefixes: dict[str, str]
    variables: dict[str, str]
    element: str | None = None
    holders: set[str] = field(default_factory=set)
    #: None inside a step's predicate, which can't ask for paths.
    probes: dict[str, Probe] | None = field(default_factory=dict)
    in_context: bool = False
    #: The columns of a node that are named.
    reads: set[str] = field(default_factory=set)
    #: The attributes that are named.
    keys: set[str] = field(default_factory=set)
    #: The name of the context's nodes; None if any will do.
    node: str | None = None


class _Parser:
    def __init__(self, source: str, scope: _Scope) -> None:
        self.source, self.scope, self.at = source, scope, 0
        self.tokens: list[tuple[str, str]] = []
        place = 0
        while place < len(source.rstrip()):
            m = _TOKEN.match(source, place)
            if not m:
                raise self.wrong()
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            place = m.end()

    def wrong(self) -> ValueError:
        return ValueError(f"not supported: {self.source!r}")

    def peek(self, ahead: int = 0) -> str:
        return self.tokens[self.at + ahead][1] if self.at + ahead < len(self.tokens) else ""

    def take(self, wanted: str | None = None) -> str:
        found = self.peek()
        if not found or (wanted is not None and found != wanted):
            raise self.wrong()
        self.at += 1
        return found

    def ended(self) -> bool:
        return self.at == len(self.tokens)

    def whole(self) -> _Value:
        found = self.either()
        if not self.ended():
            raise self.wrong()
        return found

    def chain(self, word: str, part, join) -> _Value:
        found = part()
        while self.peek() == word:
            self.take()
            found = _Value("bool", [join(found.truth(), part().truth())])
        return found

    def either(self) -> _Value:
        return self.chain("or", self.both, Column.__or__)

    def both(self) -> _Value:
        return self.chain("and", self.compared, Column.__and__)

    def compared(self) -> _Value:
        left = self.operand()
        if self.peek() not in _COMPARE:
            return left
        mark = self.take()
        right = self.operand()
        if "bool" in (left.kind, right.kind):
            raise self.wrong()
        sides = (left, right)
        a, b = (x.numbers() for x in sides) if mark not in ("=", "!=") or "number" in (left.kind, right.kind) else (x.columns for x in sides)
        # A general comparison: some pair fits.
        return _Value("bool", [reduce(Column.__or__, [F.coalesce(_COMPARE[mark](x, y), F.lit(False)) for x in a for y in b])])

    def read(self, column: str) -> Column:
        self.scope.reads.add(column)
        return F.col(column)

    def local(self, name: str) -> str:
        """The local name of an element in the text's namespace."""
        prefix, _, name = name.rpartition(":")
        if self.scope.prefixes.get(prefix) != TEI:
            raise self.wrong()
        return name

    def operand(self) -> _Value:
        kind = self.tokens[self.at][0] if not self.ended() else ""
        word = self.take()
        if kind == "string":
            return _Value("string", [F.lit(word[1:-1])])
        if kind == "number":
            return _Value("number", [F.lit(float(word))])
        if word == "(":
            found = [self.either()]
            while self.peek() == ",":
                self.take()
                found.append(self.either())
            self.take(")")
            if len(found) == 1:
                return found[0]
            if any(v.kind == "bool" for v in found):
                raise self.wrong()
            return _Value("string", [c for v in found for c in v.columns])
        if word == "." and self.peek() != "//":
            if self.scope.element is not None:
                raise self.wrong()
            return _Value("node", [self.read("text")])
        if word.startswith("@"):
            if self.scope.element is None:
                raise self.wrong()
            self.scope.keys.add(word[1:])
            return _Value("node", [self.read("attrs")[word[1:]]])
        if word.startswith("$"):
            if word[1:] not in self.scope.variables:
                raise self.wrong()
            inner = {k: v for k, v in self.scope.variables.items() if k != word[1:]}
            return _Parser(self.scope.variables[word[1:]], replace(self.scope, variables=inner)).whole()
        if kind == "name" and self.peek() == "(":
            return self.call(word)
        self.at -= 1
        return self.path()

    def call(self, name: str) -> _Value:
        self.take("(")
        if name == "count":
            steps, whole, _ = self.steps()
            self.take(")")
            return _Value("number", [self.probe(steps, whole)])
        given = []
        while self.peek() != ")":
            if given:
                self.take(",")
            given.append(self.either())
        self.take(")")
        text = lambda k: given[k].text(self.source)
        match name, len(given):
            case "true" | "false", 0:
                return _Value("bool", [F.lit(name == "true")])
            case "not", 1:
                return _Value("bool", [~given[0].truth()])
            case "node", 0:
                return _Value("bool", [self.read("has_child_node")])
            case "contains", 2:
                return _Value("bool", [F.contains(text(0), text(1))])
            case "starts-with", 2:
                return _Value("bool", [F.startswith(text(0), text(1))])
            case "substring-after", 2:
                at = F.instr(text(0), text(1))
                return _Value("string", [F.when(at > 0, F.substr(text(0), at + F.length(text(1)))).otherwise("")])
            case "normalize-space", 1:
                return _Value("string", [collapse(text(0))])
            case "string-length", 1:
                return _Value("number", [F.length(text(0)).cast("double")])
            case "number", 1:
                return _Value("number", given[0].numbers()[:1])
            case "concat", n if n >= 2:
                return _Value("string", [F.concat(*map(text, range(n)))])
            case "position" | "last", 0 if self.scope.in_context and self.scope.element:
                named = self.named(self.scope.element)
                place = self.probe([Step("preceding-sibling", named, self.scope.element, self.scope.element, True)], False) + 1
                return _Value("number", [place if name == "position" else place + self.probe([Step("following-sibling", named, self.scope.element, self.scope.element, True)], False)])
        raise self.wrong()

    def path(self) -> _Value:
        """Whether there is a node at the end of the path. Children and grandchildren the shredder has written down."""
        steps, whole, plain = self.steps()
        if plain is not None:
            self.scope.holders.add(self.scope.element)
            return _Value("bool", [F.coalesce(F.array_contains(self.read("holds"), plain), F.lit(False))])
        return _Value("bool", [self.probe(steps, whole) > 0])

    def named(self, name: str) -> Column:
        found = F.col("kind") == "element"
        return found if name == "*" else found & (F.col("ns") == TEI) & (F.col("name") == name)

    def steps(self) -> tuple[list[Step], bool, str | None]:
        """The steps, whether they go from the root, and what the shredder calls the path, if it knows it."""
        if self.scope.element is None or self.scope.probes is None:
            raise self.wrong()
        whole, descend = self.peek() == "//", False
        if self.peek() in (".", "//"):
            descend = True
            if self.take() == ".":
                self.take("//")
        found, plain = [], []
        while True:
            step, simple = self.step("descendant" if descend else "child")
            found.append(step)
            plain.append(simple)
            if self.peek() not in ("/", "//"):
                break
            descend = self.take() == "//"
        if (whole or any(x.axis in SIBLINGS for x in found)) and len(found) > 1:
            raise self.wrong()
        known = len(found) <= 2 and all(x.axis == "child" for x in found) and None not in plain
        return found, whole, "/".join(plain) if known else None

    def step(self, axis: str) -> tuple[Step, str | None]:
        """A step, and what the shredder calls it where it has one attribute test at most."""
        first = self.at
        word = self.take()
        if word == "..":
            return Step("parent", F.col("kind") == "element", "..", asks=()), None
        if self.peek() == "::":
            self.take()
            if word not in _AXES or axis == "descendant":
                raise self.wrong()
            axis, word = word, self.take()
        if word != "*" and self.tokens[self.at - 1][0] != "name":
            raise self.wrong()
        name = word if word == "*" else self.local(word)
        test, plain, asks = self.named(name), [name], []
        while self.peek() == "[":
            self.take()
            begin = self.at
            inner = _Parser.__new__(_Parser)
            inner.__dict__.update(self.__dict__, scope=replace(self.scope, element=name, probes=None, in_context=False))
            test &= F.coalesce(inner.either().truth(), F.lit(False))
            self.at = inner.at
            asked = self.tokens[begin : self.at]
            simple = asked[0][1].startswith("@") and (len(asked) == 1 or (len(asked) == 3 and asked[1][1] == "=" and asked[2][0] == "string"))
            asks.append((asked[0][1][1:], asked[2][1][1:-1] if len(asked) == 3 else None) if simple else None)
            plain.append(f"[{asked[0][1]}{f"='{asked[2][1][1:-1]}'" if len(asked) == 3 else ''}]" if simple else None)
            self.take("]")
        known = name != "*" and len(plain) <= 2 and None not in plain
        return Step(axis, test, "".join(t for _, t in self.tokens[first : self.at]), name if name != "*" else None, name != "*" and len(plain) == 1, None if None in asks else tuple(asks)), "".join(plain) if known else None

    def probe(self, steps: list[Step], whole: bool) -> Column:
        """How many nodes are at the end of the path: a column that probed() adds."""
        if self.scope.probes is None or self.scope.element is None:
            raise self.wrong()
        key = f"{self.scope.element}{' //' if whole else ' '}{'/'.join(f'{x.axis}::{x.source}' for x in steps)}"
        if key not in self.scope.probes:
            self.scope.probes[key] = Probe(f"probe_{len(self.scope.probes)}", self.named(self.scope.element), tuple(steps), whole, self.scope.element)
        return F.col(self.scope.probes[key].name)

    def contexts(self) -> list[tuple[Column, str | None, str | None]]:
        """What a context says of a node, for each alternative, the element's name and the node's."""
        out = [self.context()]
        while self.peek() == "|":
            self.take()
            out.append(self.context())
        if not self.ended():
            raise self.wrong()
        return out

    def context(self) -> tuple[Column, str | None, str | None]:
        if self.peek() == "//":
            self.take()
        name, element, self.scope.node = self.take(), None, None
        if name == "processing-instruction":
            self.take("(")
            found = F.col("kind") == "pi"
            if self.peek() != ")":
                self.scope.node = self.take().strip("\"'")
                found &= F.col("name") == self.scope.node
            self.take(")")
        else:
            prefix, _, element = name.rpartition(":")
            if not re.fullmatch(r"[^\W\d][\w.-]*", element) or (prefix and prefix not in self.scope.prefixes):
                raise self.wrong()
            found = (F.col("kind") == "element") & (F.col("ns") == self.scope.prefixes.get(prefix, "")) & (F.col("name") == element)
        self.scope.element, self.scope.in_context = element, True
        self.scope.node = element or self.scope.node
        while self.peek() == "[":
            self.take()
            found &= F.coalesce(self.either().truth(), F.lit(False))
            self.take("]")
        self.scope.in_context = False
        return found, element, self.scope.node


def _lets(at: ET.Element) -> dict[str, str]:
    return {x.get("name", ""): x.get("value", "") for x in at.findall(f"{{{SCH}}}let")}


def _message(at: ET.Element, scope: _Scope) -> Column:
    parts = [F.lit(at.text or "")]
    for x in at:
        if x.tag == f"{{{SCH}}}value-of":
            parts.append(_Parser(x.get("select", ""), scope).whole().text(x.get("select", "")))
        elif x.tag == f"{{{SCH}}}name":
            parts.append(F.col("name"))
        else:
            parts.append(F.lit("".join(x.itertext())))
        parts.append(F.lit(x.tail or ""))
    return F.concat(*parts)


def _included(at: ET.Element, folder: str | None) -> None:
    """Puts in place what include elements, and extends with a reference, name."""
    for i, x in reversed(list(enumerate(at))):
        href = x.get("href")
        if href is not None and x.tag in (f"{{{SCH}}}include", f"{{{SCH}}}extends"):
            if folder is None or "#" in href:
                raise ValueError(f"not supported: {href!r} included in a schema that isn't a file, or by part")
            found = ET.parse(os.path.join(folder, href)).getroot()
            at.remove(x)
            for k, new in enumerate([found] if x.tag == f"{{{SCH}}}include" else list(found)):
                at.insert(i + k, new)
    for x in at:
        _included(x, folder)


def _patterns(root: ET.Element, phase: str | None) -> list[ET.Element]:
    """The patterns that are active in the phase, with abstract ones and abstract rules filled in."""
    given = root.findall(f"{{{SCH}}}pattern")
    abstract = {p.get("id"): p for p in given if p.get("abstract") == "true"}
    phase = root.get("defaultPhase", "#ALL") if phase in (None, "#DEFAULT") else phase
    if phase != "#ALL":
        chosen = next((p for p in root.findall(f"{{{SCH}}}phase") if p.get("id") == phase), None)
        if chosen is None:
            raise ValueError(f"no phase {phase}")
        active = {x.get("pattern") for x in chosen.findall(f"{{{SCH}}}active")}
        given = [p for p in given if p.get("id") in active]
    out = []
    for p in given:
        if p.get("abstract") == "true":
            continue
        if p.get("is-a"):
            if p.get("is-a") not in abstract:
                raise ValueError(f"no abstract pattern {p.get('is-a')}")
            values = {x.get("name", ""): x.get("value", "") for x in p.findall(f"{{{SCH}}}param")}
            filled = copy.deepcopy(abstract[p.get("is-a")])
            for x in filled.iter():
                for k in ("context", "test", "select", "value", "path"):
                    if x.get(k) is not None:
                        x.set(k, re.sub(r"\$([\w.-]+)", lambda m: values.get(m[1], m[0]), x.get(k)))
            filled.attrib = {k: v for k, v in {**filled.attrib, "id": p.get("id") or p.get("is-a")}.items() if k != "abstract"}
            p = filled
        out.append(p)
    rules = {r.get("id"): r for r in root.iter(f"{{{SCH}}}rule") if r.get("abstract") == "true"}

    def inherited(rule: ET.Element, seen: tuple[str, ...] = ()) -> list[ET.Element]:
        parts = []
        for x in rule:
            name = x.get("rule") if x.tag == f"{{{SCH}}}extends" else None
            if name is None:
                parts.append(x)
            elif name not in rules or name in seen:
                raise ValueError(f"no abstract rule {name}, or one that extends itself")
            else:
                parts += inherited(rules[name], (*seen, name))
        return parts

    for p in out:
        for r in list(p.findall(f"{{{SCH}}}rule")):
            if r.get("abstract") == "true":
                p.remove(r)
            else:
                r[:] = inherited(r)
    return out


def read_schema(source: str, phase: str | None = None) -> Schema:
    """The checks of a Schematron file (a path, or its text) in a phase: one by name, #ALL, or the schema's default."""
    folder = None
    if not source.lstrip().startswith("<"):
        folder = os.path.dirname(os.path.abspath(source))
        with open(source, encoding="utf-8") as f:
            source = f.read()
    root = ET.fromstring(source)
    if root.tag != f"{{{SCH}}}schema":
        raise ValueError("the root is no sch:schema")
    _included(root, folder)
    prefixes = {x.get("prefix", ""): x.get("uri", "") for x in root.findall(f"{{{SCH}}}ns")} | {"xml": XML}
    more = {x.get("id"): x for x in root.iter(f"{{{SCH}}}diagnostic")}
    checks: list[Check] = []
    holders: set[str] = set()
    reads: set[str] = set()
    keys: set[str] = set()
    instructions = False
    probes: dict[str, Probe] = {}
    names: dict[str, int] = {}
    for pattern in _patterns(root, phase):
        earlier: list[Column] = []
        for rule in pattern.findall(f"{{{SCH}}}rule"):
            scope = _Scope(prefixes, _lets(root) | _lets(pattern) | _lets(rule), None, holders, probes, reads=reads, keys=keys)
            matches = []
            for here, element, node in _Parser(rule.get("context", ""), scope).contexts():
                scope.element = element
                instructions |= element is None
                fits = reduce(lambda a, b: a & ~b, earlier, here)
                for at in rule:
                    kind = {f"{{{SCH}}}assert": ASSERT, f"{{{SCH}}}report": REPORT}.get(at.tag)
                    if kind is None:
                        continue
                    test = at.get("test", "")
                    said = [_message(x, scope) for x in (at, *[more[d] for d in at.get("diagnostics", "").split()])]
                    matches.append((at, Check("", kind, at.get("role", ""), fits, F.coalesce(_Parser(test, scope).whole().truth(), F.lit(False)), F.concat_ws(" ", *said), test, node)))
                earlier = [*earlier, here]
            ids: dict[int, str] = {}
            for at, check in matches:
                if id(at) not in ids:
                    base = at.get("id") or pattern.get("id") or "pattern"
                    names[base] = names.get(base, 0) + 1
                    ids[id(at)] = base if names[base] == 1 else f"{base}-{names[base]}"
                checks.append(replace(check, check_id=ids[id(at)]))
    return Schema(checks, tuple(sorted(holders)), tuple(probes.values()), tuple(sorted(reads)), tuple(sorted(keys)), instructions)


def check_documents(docs: DataFrame, schema: Schema, located: bool = True) -> DataFrame:
    """The findings of a schema in documents (path, xml); with their locations, unless nobody asks for them."""
    columns = tuple(c for c in schema.columns if located or c != "location")
    nodes = shred(docs, columns, schema.holders, only=schema.asked, beside=schema.beside)
    # Other probes than the shredder's read the nodes several times.
    nodes = nodes if schema.told else staged(nodes, "nodes")
    return run_checks(probed(nodes, schema.probes, schema.beside), schema.checks)


def count_findings(docs: DataFrame, schema: Schema, by: Column | None = None) -> DataFrame:
    """by (the path, or what is said of it), check_id, findings: how many findings of each check there are in documents (path, xml); checks without any are left out.

    Where nothing but attributes, siblings and what stands above is asked of elements, equal ones of a document are one row with their number, and neither messages nor places are made."""
    by = F.col("path") if by is None else by
    if not schema.tallied:
        return check_documents(docs, schema, located=False).groupBy(by, "check_id").agg(F.count("*").alias("findings"))
    nodes = probed(tally(docs, schema.counted, schema.keys, schema.beside, schema.above), schema.probes, schema.beside, schema.above)
    return count_checks(nodes, schema.checks, by)
