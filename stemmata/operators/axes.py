"""Counts of the nodes that a path leads to, for every node of a context: what checks ask beyond a node and its children.

Each step is a join of its own kind: child and parent by parent_id, descendant and ancestor by intervals, siblings by running counts.
Siblings that are asked for by name alone the shredder has counted, where it is told their names: no node moves for them.
Nodes that several ways lead to count once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import contained_counts, container_counts, containment, sibling_counts

SIBLINGS = ("preceding-sibling", "following-sibling")


@dataclass(frozen=True)
class Step:
    """An axis and what a node on it must be; the source tells steps apart."""

    axis: str
    test: Column
    source: str
    #: The name of what stands at its end; None: of any name.
    name: str | None = None
    #: Whether the name is all that the test asks.
    bare: bool = False
    #: What else it asks, where that is only that attributes are there (None) or have values; None: something else.
    asks: tuple[tuple[str, str | None], ...] | None = None


@dataclass(frozen=True)
class Probe:
    """A column to be added: how many nodes a path leads to from each node that fits the context; from the root if `whole`."""

    name: str
    context: Column
    steps: tuple[Step, ...]
    whole: bool = False
    #: The name of the context's elements.
    of: str | None = None

    @property
    def above(self) -> bool:
        """Whether it is answered by the elements above the context, told by names and attributes: parents, and at the end a parent or ancestors."""
        *first, last = self.steps
        return not self.whole and self.of is not None and all(s.axis == "parent" for s in first) and last.axis in ("parent", "ancestor") and all(s.asks is not None for s in self.steps)

    @property
    def beside(self) -> bool:
        """Whether it is answered among the children of the context's parent, without that parent."""
        return not self.whole and (self.steps[0].axis in SIBLINGS or (len(self.steps) == 2 and self.steps[0].source == ".." and self.steps[1].axis == "child"))

    @property
    def told(self) -> bool:
        """Whether the shredder can count it: siblings by name alone."""
        return self.beside and self.steps[-1].bare


def names_beside(probes: tuple[Probe, ...]) -> tuple[str, ...]:
    """For shred's `beside`: the names of siblings that it is to count."""
    return tuple(sorted({p.steps[-1].name for p in probes if p.told}))


_HERE = ["path", "node_id", "end_id", "parent_id"]


def _taken(here: DataFrame, nodes: DataFrame, step: Step) -> DataFrame:
    """The nodes that the step leads to, each with the context it comes from."""
    there = nodes.where(step.test).select(*_HERE)
    if step.axis == "descendant":
        return containment(here.select("path", "node_id", "end_id", "context"), there).select("path", "outer.context", "inner.*")
    if step.axis == "ancestor":
        return containment(there, here.select("path", "node_id", "context")).select("path", "inner.context", "outer.*")
    if step.axis == "child":
        return here.select("path", "context", F.col("node_id").alias("parent_id")).join(there.hint("merge"), ["path", "parent_id"])
    return here.select("path", "context", F.col("parent_id").alias("node_id")).join(there.hint("merge"), ["path", "node_id"])


def _counted(nodes: DataFrame, probe: Probe) -> DataFrame:
    """path, node_id, probe and n of the contexts with some node at the end of the path."""
    here = nodes.where(probe.context).select(*_HERE, F.col("node_id").alias("context"))
    *before, last = probe.steps
    there = nodes.where(last.test)
    # Along children alone, nodes are met once and none stands in another.
    once = all(step.axis == "child" for step in before)
    if probe.whole:
        found = here.join(there.groupBy("path").agg(F.count("*").alias("n")).hint("merge"), "path")
    else:
        for step in before:
            here = _taken(here, nodes, step).select("context", *_HERE)
            here = here if step.axis == "child" else here.distinct()
        if last.axis == "child":
            # Counted by parent first, so that a node of very many children moves as one row.
            counts = there.groupBy("path", F.col("parent_id").alias("node_id")).agg(F.count("*").alias("n"))
        elif last.axis == "descendant" and once:
            counts = contained_counts(here, there)
        elif last.axis == "ancestor" and not before:
            counts = container_counts(there, here)
        else:
            counts = None
        if counts is None:
            found = _taken(here, nodes, last).select("path", "context", "node_id").distinct().groupBy("path", "context").agg(F.count("*").alias("n"))
        elif not before:
            found = counts.withColumn("context", F.col("node_id"))
            if last.axis == "child":
                found = here.select("path", "context").join(found.hint("merge"), ["path", "context"])
        else:
            found = here.join(counts.hint("merge"), ["path", "node_id"]).groupBy("path", "context").agg(F.sum("n").alias("n"))
    return found.select("path", F.col("context").alias("node_id"), F.lit(probe.name).alias("probe"), "n")


def _fitting(nodes: DataFrame, any_of: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The nodes for which one holds, and the others."""
    fits = F.coalesce(reduce(Column.__or__, any_of), F.lit(False))
    return nodes.where(fits), nodes.where(~fits)


def _told(nodes: DataFrame, probes: list[Probe], names: tuple[str, ...], above: tuple[str, ...]) -> DataFrame:
    """Adds the probes that the shredder or the tally has counted, by the places of their names."""

    def count(p: Probe) -> Column:
        if p.name in above:
            return F.coalesce(F.get("above", F.lit(above.index(p.name))), F.lit(0)).cast("long")
        before, among = (F.get(side, F.lit(names.index(p.steps[-1].name))).cast("long") for side in ("before", "among"))
        if p.steps[0].axis not in SIBLINGS:
            return among
        own = F.coalesce(p.steps[-1].test, F.lit(False)).cast("long")
        # The root is not among its siblings.
        return before if p.steps[0].axis == "preceding-sibling" else F.greatest(among - before - own, F.lit(0))

    kept = [F.col(c) for c in nodes.columns if c not in ("before", "among", "above")]
    return nodes.select(*kept, *[F.when(F.coalesce(p.context, F.lit(False)), count(p)).otherwise(0).alias(p.name) for p in probes])


def probed(nodes: DataFrame, probes: tuple[Probe, ...], names: tuple[str, ...] = (), above: tuple[Probe, ...] = ()) -> DataFrame:
    """The nodes with a column for each probe (0 where there is nothing, or the node is no context); only nodes that are asked about are moved.
    names: what the shredder was told to count beside nodes; without them, the nodes have no such counts and all is counted here. above: the probes whose counts the tally was told to give, in its `above`.

    Joins are by merging: staged files are a small part of their rows' size in memory, so Spark would send millions of rows to the driver to broadcast them."""
    higher = tuple(p.name for p in above)
    told = [p for p in probes if p.name in higher or (p.told and p.steps[-1].name in names)]
    nodes = _told(nodes, told, names, higher) if names or higher else nodes
    known = {p.name for p in told}
    joined, beside = [p for p in probes if not p.beside and p.name not in known], [p for p in probes if p.beside and p.name not in known]
    none = lambda df, of: df.select("*", *[F.lit(0).cast("long").alias(p.name) for p in of])
    out = nodes
    if joined:
        found = reduce(DataFrame.unionByName, [_counted(nodes, p) for p in joined])
        wide = found.groupBy("path", "node_id").agg(*[F.max(F.when(F.col("probe") == p.name, F.col("n"))).alias(p.name) for p in joined])
        here, rest = _fitting(nodes, [p.context for p in joined])
        out = here.join(wide.hint("merge"), ["path", "node_id"], "left").na.fill(0, [p.name for p in joined]).unionByName(none(rest, joined))
    if beside:
        kept = out.columns
        here, rest = _fitting(out, [c for p in beside for c in (p.context, p.steps[-1].test)])
        # One count for each test, though several probes ask for it; a variable may differ from rule to rule.
        key = {p.name: p.name if "$" in p.steps[-1].source else p.steps[-1].source for p in beside}
        tests = {key[p.name]: (f"{p.name}_of", p.steps[-1].test) for p in beside}
        here = sibling_counts(here, dict(tests.values()))

        def count(p: Probe) -> Column:
            before, after = (F.col(f"{tests[key[p.name]][0]}_{side}") for side in ("before", "after"))
            if p.steps[0].axis in SIBLINGS:
                return before if p.steps[0].axis == "preceding-sibling" else after
            return F.when(F.col("parent_id").isNotNull(), before + after + F.coalesce(p.steps[-1].test, F.lit(False)).cast("long")).otherwise(0)

        here = here.select(*kept, *[F.when(F.coalesce(p.context, F.lit(False)), count(p)).otherwise(0).alias(p.name) for p in beside])
        out = here.unionByName(none(rest, beside))
    return out
