"""Connected components of a links table: in one task while the links are few, else by alternating large-star and small-star steps.

Defined cases: links may repeat, stand in both directions or join a node to itself; a link with a null end joins nothing;
an empty table gives no rows; nodes without links have none; columns other than a and b are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


#: Links up to which one task joins them (some MB); more are never brought together.
FEW = 100_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least labels spread along the links of one task until nothing changes, each round also through the labels themselves."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not parts:
        return
    a, b = (np.concatenate(c) for c in zip(*parts))
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        low = np.minimum(label[a], label[b])
        for side in (a, b):
            np.minimum.at(least, side, low)
            np.minimum.at(least, label[side], low)
        least = least[least]
        if (least == label).all():
            break
        label = least
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's greater (large) or smaller (small) neighbours are linked to its least neighbour instead."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    out = joined.where("b > a").select("b", "m") if large else joined.select("b", "m").union(joined.select("a", "m"))
    return out.toDF("a", "b").where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of every node in links(a, b); the links are never collected."""
    edges = staged(links.select("a", "b").where("a != b").distinct(), "edges")
    if edges.count() <= FEW:
        return edges.coalesce(1).mapInArrow(_joined, "node long, component long")
    last = None
    while True:
        edges = staged(_star(_star(edges, True), False), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == last:
            # Every node now has one link, to its component's least node, which has none itself.
            return edges.union(edges.select(F.col("b").alias("a"), "b").distinct()).toDF("node", "component")
        last = now
