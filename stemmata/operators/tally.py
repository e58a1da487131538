"""Elements counted where documents are parsed, for readers that ask how many there are: those of a document that are equal in all that is asked of them make one row."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame

from ..runtime import bounded
from ..sources.corpus import TEI
from ..sources.encodings import readable
from .axes import Probe
from .shapes import KEPT, Shapes, grown, written
from .shred import Once, parse

SCHEMA = "path string, kind string, ns string, name string, attrs map<string,string>, before array<int>, among array<int>, above array<int>, times long"
_ASKED = frozenset(("kind", "ns", "name", "attrs"))


class _Kinds:
    """Numbers for the nodes that are told apart: kind, namespace, name, values of the attributes, and counts of siblings before and of all under the parent.

    Most parents have the same children as many others: what stands under them is worked out once for each sequence of children."""

    def __init__(self, only: frozenset[str], keys: tuple[str, ...], beside: tuple[str, ...]) -> None:
        self.only, self.keys, self.beside = only, keys, beside
        self.written = written(keys)
        self.place = {f"{{{TEI}}}{name}": i for i, name in enumerate(beside)}
        self.numbers: dict[tuple, int] = defaultdict(lambda: len(self.numbers))
        self.under = Once(self.children)
        self.tags = Once(lambda tag: tag in self.place or tag.rpartition("}")[2] in only)

    def number(self, child: tuple, before: tuple[int, ...], among: tuple[int, ...], above: tuple[int, ...] = ()) -> int:
        ns, _, name = child[0].rpartition("}")
        return self.numbers["element", ns[1:], name, child[1:], before, among, above]

    def children(self, family: tuple[tuple, ...]) -> list[int]:
        """The numbers of the children that are asked for."""
        counts, seen = [0] * len(self.beside), []
        for child in family:
            seen.append(tuple(counts))
            if (at := self.place.get(child[0])) is not None:
                counts[at] += 1
        return [self.number(c, b, tuple(counts)) for c, b in zip(family, seen) if c[0].rpartition("}")[2] in self.only]

    def count(self, xml: str | bytes) -> dict[int, int]:
        """How many of each there are in a document; its root is always among them."""
        try:
            root = ET.XML(readable(xml))
        except (ET.ParseError, ValueError, LookupError):
            # This parser refuses entities that stand in no declaration it reads; what is no document at all the other one tells.
            nodes = parse(xml, _ASKED, only=self.only, beside=self.beside)
            return Counter(self.numbers[n["kind"], n["ns"], n["name"], tuple(map(n["attrs"].get, self.keys)), tuple(n.get("before") or ()), tuple(n.get("among") or ()), ()] for n in nodes if n["kind"] in ("element", "error"))
        tags, written = self.tags, self.written
        families = Counter([tuple([(c.tag, *map(c.get, written)) for c in up if tags[c.tag]]) for up in filter(len, root.iter())])
        none = (0,) * len(self.beside)
        found = {self.number((root.tag, *map(root.get, written)), none, none): 1}
        for family, times in families.items():
            for k in self.under[family]:
                found[k] = found.get(k, 0) + times
        return found

    def columns(self) -> list[pa.Array]:
        """kind, ns, name, attrs, before, among and above by number."""

        def lists(at: int) -> pa.Array:
            found = [x[at] for x in self.numbers]
            return pa.ListArray.from_arrays(pa.array(accumulate(map(len, found), initial=0), pa.int32()), pa.array(chain.from_iterable(found), pa.int32()))

        attrs = [[(k, v) for k, v in zip(self.keys, x[3]) if v is not None] for x in self.numbers]
        return [*(pa.array([x[i] for x in self.numbers], pa.string()) for i in range(3)), pa.array(attrs, pa.map_(pa.string(), pa.string())), lists(4), lists(5), lists(6)]


#: A step as it is asked of an element: its axis, the tag (None: any), and attributes by their place with their value (None: any).
_Asked = tuple[str, str | None, tuple[tuple[int, str | None], ...]]


class _Standing(_Kinds):
    """These numbers where counts of what stands above are told apart too. Subtrees that are equal and stand under equal elements are worked out once."""

    def __init__(self, only: frozenset[str], keys: tuple[str, ...], beside: tuple[str, ...], above: tuple[tuple[str | None, tuple[_Asked, ...]], ...]) -> None:
        super().__init__(only, keys, beside)
        self.shapes, self.above = Shapes(keys), [steps for _, steps in above]
        #: By tag the places of what is asked of its elements.
        self.contexts: dict[str, list[int]] = defaultdict(list)
        for i, (of, _) in enumerate(above):
            self.contexts[f"{{{TEI}}}{of}"].append(i)
        #: What stands above: the next higher (-1: nothing), the element, how many from it up fit each last step.
        self.chains: list[tuple[int, tuple, tuple[int, ...]]] = []
        self.chain = Once(self.linked)
        self.counts = Once(self.counted)
        self.below = Once(self.family)

    @staticmethod
    def fits(step: _Asked, element: tuple) -> bool:
        _, tag, attrs = step
        return tag in (None, element[0]) and all(element[k + 1] is not None if value is None else element[k + 1] == value for k, value in attrs)

    def linked(self, key: tuple[int, tuple]) -> int:
        up, element = key
        before = self.chains[up][2] if up >= 0 else (0,) * len(self.above)
        self.chains.append((up, element, tuple(n + self.fits(steps[-1], element) for n, steps in zip(before, self.above))))
        return len(self.chains) - 1

    def counted(self, key: tuple[str, int]) -> tuple[int, ...]:
        """What is asked of an element of this tag that stands under the end of this chain; of others nothing."""
        tag, end = key
        asked = self.contexts.get(tag, ())
        return tuple(self.one(i, end) if i in asked else 0 for i in range(len(self.above)))

    def one(self, i: int, end: int) -> int:
        *first, last = self.above[i]
        for step in first:
            if end < 0 or not self.fits(step, self.chains[end][1]):
                return 0
            end = self.chains[end][0]
        if end < 0:
            return 0
        return self.chains[end][2][i] if last[0] == "ancestor" else int(self.fits(last, self.chains[end][1]))

    def family(self, key: tuple[int, int]) -> tuple[list[tuple[int, int]], list[tuple[tuple[int, int], int]]]:
        """Of the children of a shape at the end of a chain: the numbers of those that are asked for, and those that have children, as shapes and chains; both with how many there are."""
        shape, end = key
        kids = [(k, *self.shapes.made[k]) for k in self.shapes.made[shape][1]]
        counts, seen = [0] * len(self.beside), []
        for _, child, _ in kids:
            seen.append(tuple(counts))
            if (at := self.place.get(child[0])) is not None:
                counts[at] += 1
        found = Counter(self.number(c, b, tuple(counts), self.counts[c[0], end]) for (_, c, _), b in zip(kids, seen) if c[0].rpartition("}")[2] in self.only)
        return list(found.items()), list(Counter((k, self.chain[end, c]) for k, c, below in kids if below).items())

    def count(self, xml: str | bytes) -> dict[int, int]:
        root = grown(xml)
        if root is None:
            return {self.numbers["error", "", "", (None,) * len(self.keys), (), (), ()]: 1}
        if len(self.shapes.made) + len(self.chains) > KEPT:
            for of in (self.shapes.made, self.shapes.numbers, self.chains, self.chain, self.counts, self.below):
                of.clear()
        top = self.shapes.of(root)
        element, none = self.shapes.made[top][0], (0,) * len(self.beside)
        found = {self.number(element, none, none, self.counts[element[0], -1]): 1}
        # From above: a shape comes when all that stand higher, which have greater numbers, have said how often it stands.
        ahead, waiting = {top: {self.chain[-1, element]: 1}}, [-top]
        while waiting:
            shape = -heappop(waiting)
            for end, times in ahead.pop(shape).items():
                numbers, further = self.below[shape, end]
                for k, n in numbers:
                    found[k] = found.get(k, 0) + n * times
                for (kid, chain), n in further:
                    if kid not in ahead:
                        ahead[kid] = {}
                        heappush(waiting, -kid)
                    ahead[kid][chain] = ahead[kid].get(chain, 0) + n * times
        return found


def tally(docs: DataFrame, only: frozenset[str], keys: tuple[str, ...] = (), beside: tuple[str, ...] = (), above: tuple[Probe, ...] = ()) -> DataFrame:
    """The elements of these names, and each document's root, as `shred` gives them with those attributes and with `before` and `among`; but of equal ones in a document only one, with their number in `times`. An error is a node of its kind.

    above: paths to what stands above, of which `above` has the counts (0 for elements that aren't their context). The attributes that their steps ask for are among the keys."""
    bounded(docs.sparkSession)
    steps = lambda p: tuple((s.axis, s.name and f"{{{TEI}}}{s.name}", tuple((keys.index(k), v) for k, v in s.asks)) for s in p.steps)
    higher = tuple((p.of, steps(p)) for p in above)
    names = [c.split(" ", 1)[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, texts = batch.column(0), batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                kinds, which, numbers, times = _Standing(only, keys, beside, higher) if higher else _Kinds(only, keys, beside), [], [], []
                while first < len(texts) and len(numbers) <= 20_000:
                    found = kinds.count(texts[first] or "")
                    which += [first] * len(found)
                    numbers += found
                    times += found.values()
                    first += 1
                at = pa.array(numbers, pa.int32())
                yield pa.RecordBatch.from_arrays([paths.take(pa.array(which, pa.int32())), *(c.take(at) for c in kinds.columns()), pa.array(times, pa.int64())], names=names)

    return docs.select("path", "xml").mapInArrow(run, SCHEMA)


PAIRS = "path string, outer_label string, inner_label string, pairs long, outers long"


class _Pairs:
    """What stands in what, by labels: of each shape how many elements of each label are in it, and the pairs that they make."""

    def __init__(self, outer: frozenset[str], inner: frozenset[str], keys: tuple[str, ...], label: Callable[[str, dict[str, str]], str]) -> None:
        self.outer, self.inner, self.keys, self.label = outer, inner, keys, label
        self.shapes = Shapes(keys)
        self.sums: list[tuple[dict[str, int], dict[tuple[str, str], tuple[int, int]]]] = []
        self.labels = Once(self.labelled)

    def labelled(self, element: tuple) -> tuple[str | None, str | None]:
        """The labels as what holds others and as what is held; None if it isn't asked for."""
        name = element[0].rpartition("}")[2]
        if name not in self.outer and name not in self.inner:
            return None, None
        label = self.label(name, {k: v for k, v in zip(self.keys, element[1:]) if v is not None})
        return label if name in self.outer else None, label if name in self.inner else None

    def summed(self, element: tuple, kids: tuple[int, ...]) -> tuple[dict, dict]:
        held: dict[str, int] = {}
        pairs: dict[tuple[str, str], tuple[int, int]] = {}
        for kid, times in Counter(kids).items():
            inside, among = self.sums[kid]
            for label, n in inside.items():
                held[label] = held.get(label, 0) + n * times
            for both, (n, outers) in among.items():
                before = pairs.get(both, (0, 0))
                pairs[both] = before[0] + n * times, before[1] + outers * times
        outer, inner = self.labels[element]
        if outer is not None:
            for label, n in held.items():
                before = pairs.get((outer, label), (0, 0))
                pairs[outer, label] = before[0] + n, before[1] + 1
        if inner is not None:
            held[inner] = held.get(inner, 0) + 1
        return held, pairs

    def count(self, xml: str | bytes) -> dict[tuple[str, str], tuple[int, int]]:
        root = grown(xml)
        if root is None:
            return {}
        if len(self.sums) > KEPT:
            for of in (self.shapes.made, self.shapes.numbers, self.sums, self.labels):
                of.clear()
        top = self.shapes.of(root)
        for shape in self.shapes.made[len(self.sums) :]:
            self.sums.append(self.summed(*shape))
        return self.sums[top][1]


def nested(docs: DataFrame, outer: frozenset[str], inner: frozenset[str], keys: tuple[str, ...], label: Callable[[str, dict[str, str]], str]) -> DataFrame:
    """path, outer_label, inner_label, pairs and outers: in each document (path, xml) how many elements named in `inner` stand in those named in `outer`, at any depth, by their labels, and in how many; nothing of a broken one.

    label: what an element is called, by its local name and these attributes. Counted where a document is parsed, each subtree once that stands there several times: no pairs are made."""
    bounded(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Pairs(outer, inner, keys, label)
        for batch in batches:
            paths, which, rows = batch.column(0), [], []

            def made() -> pa.RecordBatch:
                columns = zip(*rows) if rows else [()] * 4
                return pa.RecordBatch.from_arrays([paths.take(pa.array(which, pa.int32())), *(pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64())))], names=[c.split(" ", 1)[0] for c in PAIRS.split(", ")])

            for k, xml in enumerate(batch.column(1).to_pylist()):
                found = counts.count(xml or "")
                which += [k] * len(found)
                rows += [(*both, *n) for both, n in found.items()]
                if len(rows) > 20_000:
                    yield made()
                    which, rows = [], []
            yield made()

    return docs.select("path", "xml").mapInArrow(run, PAIRS)
