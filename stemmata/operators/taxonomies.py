"""Taxonomies as relations: categories of any depth, from documents where they are parsed or from a table of edges by doubling."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_empty
from ..runtime import bounded, staged
from ..sources.corpus import TEI, XML
from ..sources.encodings import readable
from ..vocabulary import FAMILY_DEFAULT

_ROWS = "target string, kind string, family string, default_subclass string, description string"
#: Faults that an error names.
SHOWN = 10


_CATEGORY = {"node_id": pa.int32(), "target": pa.string(), "depth": pa.int64(), "family": pa.string(), "is_leaf": pa.bool_(), "description": pa.string()}
_FAMILY = {"family": pa.string(), "deepest": pa.int64(), "leaves": pa.int64(), "depths": pa.int64(), "description": pa.string()}
_NAMES = {pa.string(): "string", pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean"}


def read(xml: str | bytes, taxonomy_id: str) -> list[list]:
    """node_id, target, depth, family, is_leaf and description of the categories in a document's taxonomies of this id, in its order; none of a broken one."""
    category, taxonomy, description, ident = f"{TEI}}}category", f"{TEI}}}taxonomy", f"{TEI}}}catDesc", f"{XML}}}id"
    rows: list[list] = []
    #: Of the open elements: a category's row, True for a taxonomy of this id, the pieces of a description.
    above: list = [None]
    #: Descriptions that are open and are some category's first; the family that is open, and its row.
    said: list[list[str]] = []
    count, within, depth, top = 0, 0, 0, None

    def start(tag: str, attrs: dict[str, str]) -> None:
        nonlocal count, within, depth, top
        count += 1
        here = None
        if tag == category:
            up, target = above[-1], attrs.get(ident, "")
            depth += 1
            here = [count, target, depth, target if top is None else top[1], True, None]
            if type(up) is list:
                up[4] = False
            if within:
                rows.append(here)
                if up is True and top is None:
                    top = here
        elif tag == description:
            up = above[-1]
            if type(up) is list and up[5] is None:
                here = up[5] = _Pieces()
                said.append(here)
        elif tag == taxonomy and attrs.get(ident, "") == taxonomy_id:
            here = True
            within += 1
        above.append(here)

    def end(_tag: str) -> None:
        nonlocal within, depth, top
        here = above.pop()
        if here is None:
            return
        if here is True:
            within -= 1
        elif type(here) is _Pieces:
            said.pop()
        else:
            depth -= 1
            if here is top:
                top = None

    def chars(data: str) -> None:
        for pieces in said:
            pieces.append(data)

    def other(*_: str) -> None:
        nonlocal count
        count += 1

    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars
    parser.ProcessingInstructionHandler = parser.CommentHandler = other
    try:
        parser.Parse(readable(xml), True)
    except (expat.ExpatError, ValueError, LookupError):
        return []
    for row in rows:
        # White space of any kind, as in functions.text.
        row[5] = " ".join("".join(row[5] or ()).split())
    return rows


class _Pieces(list):
    """The text of a description, as it comes."""


def _by_document(docs: DataFrame, columns: dict[str, pa.DataType], of: Callable[[str | bytes], Iterable[list]]) -> DataFrame:
    """path and the rows that are made of each document (path, xml)."""
    bounded(docs.sparkSession)
    names = ["path", *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, rows, which = batch.column(0), [], []

            def made() -> pa.RecordBatch:
                values = zip(*rows) if rows else [()] * len(columns)
                return pa.RecordBatch.from_arrays([paths.take(pa.array(which, pa.int32())), *(pa.array(v, kind) for v, kind in zip(values, columns.values()))], names=names)

            for k, xml in enumerate(batch.column(1).to_pylist()):
                found = of(xml or "")
                rows += found
                which += [k] * len(found)
                if len(rows) > 20_000:
                    yield made()
                    rows, which = [], []
            yield made()

    return docs.select("path", "xml").mapInArrow(run, ", ".join(["path string", *(f"{c} {_NAMES[kind]}" for c, kind in columns.items())]))


def categories(docs: DataFrame, taxonomy_id: str) -> DataFrame:
    """path, node_id, target, depth (1 at the top), family (the id at the top), is_leaf and description of every category in the taxonomies of this id, in documents (path, xml)."""
    return _by_document(docs, _CATEGORY, lambda xml: read(xml, taxonomy_id))


def families(docs: DataFrame, taxonomy_id: str) -> DataFrame:
    """path, family, deepest, leaves, depths and description of every family in those taxonomies that has categories below a top: the greatest of their depths, how many leaves there are, the depths in sum,
    and of the leaves' descriptions the last in order. Added up where a document is parsed, so no category moves."""

    def added(xml: str | bytes) -> list[list]:
        found: dict[str, list] = {}
        for _, _, depth, family, leaf, description in read(xml, taxonomy_id):
            if depth > 1:
                row = found.setdefault(family, [family, 0, 0, 0, None])
                row[1] = max(row[1], depth)
                row[3] += depth
                if leaf:
                    row[2] += 1
                    row[4] = description if row[4] is None else max(row[4], description)
        return list(found.values())

    return _by_document(docs, _FAMILY, added)


def _refused(faults: DataFrame, what: str, column: Column) -> None:
    found = sorted(r[0] for r in faults.select(column.cast("string")).distinct().limit(SHOWN).collect())
    if found:
        raise ValueError(f"{what}: {', '.join(found)}")


def checked(found: DataFrame, defaults: dict[str, str] = FAMILY_DEFAULT) -> DataFrame:
    """target, kind (family or subclass), family, default_subclass and description, from the categories of one taxonomy: families are the tops that have a default, subclasses their leaves.

    A family's default that is no leaf of it, and an id that stands twice, are errors."""
    spark = found.sparkSession
    families = spark.createDataFrame(sorted(defaults.items()), "family string, default_subclass string")
    known = staged(found.join(F.broadcast(families), "family"), "known")
    leaves = known.where("is_leaf and depth > 1")
    _refused(known.where("is_leaf or depth = 1").groupBy("target").count().where("count > 1"), "categories that stand twice", F.col("target"))
    missing = families.join(leaves.select("family", F.col("target").alias("default_subclass")), ["family", "default_subclass"], "left_anti")
    _refused(missing, "defaults that are not in the taxonomy", F.concat_ws(" of ", "default_subclass", "family"))
    top = families.select(F.col("family").alias("target"), F.lit("family").alias("kind"), "family", "default_subclass", F.lit("").alias("description"))
    return top.unionByName(leaves.select("target", F.lit("subclass").alias("kind"), "family", "default_subclass", "description"))


def closure(edges: DataFrame) -> DataFrame:
    """id, root and depth (0 at a root) of a forest given as (id, parent; null: a root): every round knows ancestors twice as far up.

    A parent that is no id, an id with two parents, and a cycle are errors."""
    state = staged(edges.select("id", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")), "edges")
    _refused(state.groupBy("id").count().where("count > 1"), "ids that stand twice", F.col("id"))
    _refused(state.where("up is not null").join(state.select(F.col("id").alias("up")), "up", "left_anti"), "parents that are no id", F.col("up"))
    state = staged(state.withColumn("root", F.when(F.col("up").isNull(), F.col("id"))), "closure")
    n, reach = state.count(), 1
    while True:
        below = state.where("root is null")
        if below.isEmpty():
            return state.select("id", "root", "depth")
        if reach > n:
            # Further than any path can be.
            _refused(below, "a cycle above", F.col("id"))
        above = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("root").alias("found"))
        further = below.select("id", "up", "depth").join(above, "up").select("id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("found").alias("root"))
        state = staged(state.where("root is not null").unionByName(further), "closure")
        reach *= 2


def of_edges(edges: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """The same rows as checked(), from edges (id, parent, description)."""
    found = staged(closure(edges), "closure")
    parents = edges.where("parent is not null").select(F.col("parent").alias("id"), F.lit(True).alias("has_children")).distinct()
    rows = found.join(edges.select("id", or_empty(F.col("description")).alias("description")), "id").join(parents, "id", "left")
    return checked(rows.select(F.col("id").alias("target"), F.col("root").alias("family"), (F.col("depth") + 1).alias("depth"), F.col("has_children").isNull().alias("is_leaf"), "description"), defaults)
