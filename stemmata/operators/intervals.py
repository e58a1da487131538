"""Joins and counts over the intervals of a node table: what contains what, and what stands before and after among siblings.

A node contains those numbered after it up to its end_id. A containing interval is cut into aligned segments of 1, SPREAD, SPREAD^2, ...
numbers, fewer than 2 * SPREAD of each size, each standing in the fewest; a contained node belongs to one segment of each size. The equality join of both meets
each pair once and meets nothing else, so the work follows the result: no siblings are compared. Segments end at SPREAD^LEVELS numbers,
so no key has more nodes than that, and a document of any size is dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD, LEVELS = 16, 3
#: Siblings of one block of a running count.
RUN = 4096


def _numbers(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<bigint>"))


def _at(level: int, numbers: Column) -> Column:
    return F.transform(numbers, lambda n: F.struct(F.lit(level).alias("level"), n.alias("number")))


def segments(first: Column, last: Column) -> Column:
    """The aligned segments (level, number) that together are first..last, an array."""
    first, last = first.cast("long"), last.cast("long")
    lo = [F.ceil(first / SPREAD**k) for k in range(LEVELS + 1)]
    hi = [F.floor((last + 1) / SPREAD**k) - 1 for k in range(LEVELS + 1)]
    out = []
    for k in range(LEVELS + 1):
        if k == LEVELS:
            numbers = _numbers(lo[k], hi[k])
        else:
            # What the next greater segments leave over at both ends.
            inner = lo[k + 1] <= hi[k + 1]
            numbers = F.when(inner, F.concat(_numbers(lo[k], lo[k + 1] * SPREAD - 1), _numbers((hi[k + 1] + 1) * SPREAD, hi[k]))).otherwise(_numbers(lo[k], hi[k]))
        out.append(_at(k, numbers))
    return F.concat(*out)


def _levels() -> Column:
    """The segments that a node is in, one of each size."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("node_id") / SPREAD**k).alias("number")) for k in range(LEVELS + 1)])


def containment(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """path, outer and inner (structs of the columns of both) for every node of `inner` that a node of `outer` contains, whatever the two sets.

    outer has path, node_id and end_id, inner has path and node_id; both may have more. A node doesn't contain itself."""
    pack = lambda df, name: F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "path"]).alias(name)
    a = outer.select("path", pack(outer, "outer"), F.explode(segments(F.col("node_id") + 1, F.col("end_id"))).alias("s")).select("path", "outer", "s.level", "s.number")
    b = inner.select("path", pack(inner, "inner"), F.explode(_levels()).alias("s")).select("path", "inner", "s.level", "s.number")
    # By merging: a file's size says little of its rows' in memory, and these must not meet in the driver.
    return a.join(b.hint("merge"), ["path", "level", "number"]).select("path", "outer", "inner")


def contained_counts(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """path, node_id and n of each node of `outer` that contains some of `inner`: counted by segment first, so no pairs are made."""
    a = outer.select("path", "node_id", F.explode(segments(F.col("node_id") + 1, F.col("end_id"))).alias("s")).select("path", "node_id", "s.level", "s.number")
    b = inner.select("path", F.explode(_levels()).alias("s")).groupBy("path", "s.level", "s.number").agg(F.count("*").alias("n"))
    return a.join(b.hint("merge"), ["path", "level", "number"]).groupBy("path", "node_id").agg(F.sum("n").alias("n"))


def container_counts(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """path, node_id and n of each node of `inner` that some of `outer` contain: counted by segment first, too."""
    a = outer.select("path", F.explode(segments(F.col("node_id") + 1, F.col("end_id"))).alias("s")).groupBy("path", "s.level", "s.number").agg(F.count("*").alias("n"))
    b = inner.select("path", "node_id", F.explode(_levels()).alias("s")).select("path", "node_id", "s.level", "s.number")
    return b.join(a.hint("merge"), ["path", "level", "number"]).groupBy("path", "node_id").agg(F.sum("n").alias("n"))


def innermost(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """path, node_id of each contained node, and the struct of the innermost node of `outer` around it."""
    found = containment(outer, inner)
    return found.groupBy("path", F.col("inner.node_id").alias("node_id")).agg(F.max_by("outer", "outer.node_id").alias("outer"))


def sibling_counts(nodes: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Adds, for each test, how many of the siblings before (<name>_before) and after (<name>_after) a node pass it.

    Counted in blocks of node numbers, with what the blocks before hold: a parent of any number of children is dealt out."""
    parent = ["path", "__parent"]
    rows = nodes.withColumns({f"__{k}": F.coalesce(t, F.lit(False)).cast("long") for k, t in tests.items()} | {"__block": F.floor(F.col("node_id") / RUN), "__parent": F.coalesce("parent_id", F.lit(-1))})
    blocks = rows.groupBy(*parent, "__block").agg(*[F.sum(f"__{k}").alias(f"__sum_{k}") for k in tests])
    whole = Window.partitionBy(*parent)
    earlier = whole.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(
        *parent, "__block", *[F.coalesce(F.sum(f"__sum_{k}").over(earlier), F.lit(0)).alias(f"__carry_{k}") for k in tests], *[F.sum(f"__sum_{k}").over(whole).alias(f"__all_{k}") for k in tests]
    )
    # The join has the window's keys, so the nodes move once for both.
    within = Window.partitionBy(*parent, "__block").orderBy("node_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"__run_{k}": F.coalesce(F.sum(f"__{k}").over(within), F.lit(0)) for k in tests})
    both = rows.join(carry.hint("merge"), [*parent, "__block"])
    before = {k: F.col(f"__run_{k}") + F.col(f"__carry_{k}") for k in tests}
    made = {f"{k}_before": b for k, b in before.items()} | {f"{k}_after": F.col(f"__all_{k}") - before[k] - F.col(f"__{k}") for k in tests}
    return both.select(*[F.col(f"`{c}`") for c in nodes.columns], *[c.alias(k) for k, c in made.items()])
