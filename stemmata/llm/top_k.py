"""Exact top-k inner products by MaxScore over signed postings.

A term is a dimension with a sign. A shard's posting list of a term holds the vectors whose component has that sign, with its
size as the weight, and the list's greatest weight bounds what the term can add to any score: what a query gets from components
of the other sign only lowers a score. For each query the terms are ordered by bound; the longest run of small terms whose bounds
together stay below the score to beat is non-essential. A vector in no essential list can't be among the best. Essential lists are
traversed and their products summed; the others are probed from the greatest bound down, and only while a vector with all that is
left could still compete; what remains is scored in full. Shards share what a task has found so far; their best are merged by query.

Queries come in blocks of bounded bytes, each broadcast in turn, whatever their number; every vector is read for each block. A
shard is a bounded number of vectors of one partition.

Defined cases: a vector that is null, or holds a null or a component that isn't finite, takes no part, nor does one without a vec_id;
shorter vectors are filled up with zeros, an empty one is all zeros; ties go to the smaller vec_id; rows with the query's own
vec_id are no candidates; repeated rows are candidates each by itself, while a query that repeats is asked once (of different vectors
under one id the least); extra columns are not looked at; an empty table gives no rows. Scores are exact in a long; those beyond
one count as the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, scratch, staged, table, trimmed

#: Vectors of one shard, and components of one block of queries (8 bytes each).
SHARD_ROWS, BLOCK_COMPONENTS = 16_384, 1 << 20
#: The first vectors of a task, scored in full so that there is something to beat.
SEED_ROWS = 256
#: Sums of products up to here are exact in double precision.
EXACT = float(1 << 53)
#: Products of scale and component end here.
FINITE = 1e300
NONE = np.iinfo(np.int64).min


class Best:
    """The k best (score, vec_id) of each query so far, best first; places not taken hold NONE."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = np.full((queries, k), NONE, np.int64)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max, np.int64)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        use = (score > self.score[q, -1]) | ((score == self.score[q, -1]) & (ids < self.ids[q, -1]))
        score, ids = np.concatenate([self.score[q], score[use]]), np.concatenate([self.ids[q], ids[use]])
        first = np.lexsort((ids, ~score))[: self.k]
        self.score[q], self.ids[q] = score[first], ids[first]


class Shard:
    """Vectors by row, and for each dimension and sign the rows that have it, with the greatest weight."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.columns = np.ascontiguousarray(vectors.T)
        self.lists = {}
        self.bounds = np.zeros((2, vectors.shape[1]))
        for i, c in enumerate(self.columns):
            for side, sign in enumerate((1, -1)):
                rows = np.flatnonzero(c * sign > 0)
                self.lists[side, i] = rows, c[rows] * sign
                self.bounds[side, i] = (c * sign).max(initial=0)

    def search(self, q: int, query_id: int, query: np.ndarray, best: Best) -> None:
        """Brings the shard's best for the query into what is best so far."""
        to_beat = best.score[q, -1]
        side = np.where(query > 0, 0, 1)
        bounds = np.abs(query) * self.bounds[side, np.arange(len(query))]
        order = np.argsort(bounds, kind="stable")
        sums = np.cumsum(bounds[order])
        if not to_beat > 0:
            # Vectors in no list at all may do.
            left = np.flatnonzero(self.ids != query_id)
        else:
            small = int(np.searchsorted(sums, to_beat, "left"))  # the terms whose bounds together stay below
            total, met = np.zeros(len(self.ids)), np.zeros(len(self.ids), bool)
            for i in order[small:][::-1]:
                rows, weights = self.lists[side[i], i]
                total[rows] += abs(query[i]) * weights
                met[rows] = True
            rest = sums[small - 1] if small else 0.0
            left = np.flatnonzero(met & (total + rest >= to_beat) & (self.ids != query_id))
            for i in order[:small][::-1]:
                if len(left) <= best.k:
                    break
                rest -= bounds[i]
                total[left] += np.maximum(query[i] * self.columns[i][left], 0)
                left = left[total[left] + rest >= to_beat]
        if len(left):
            best.add(q, (self.vectors[left] @ query).astype(np.int64), self.ids[left])


def exactly(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """The same with whole numbers of any size, for components that double precision can't multiply exactly."""
    rows = [list(map(int, v)) for v in vectors]
    for q, query in enumerate(queries):
        wanted = list(map(int, query))
        use = np.flatnonzero(ids != query_ids[q])
        best.add(q, np.array([max(NONE + 1, min(-(NONE + 1), sum(a * b for a, b in zip(wanted, rows[i])))) for i in use.tolist()], np.int64), ids[use])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    finite = F.forall("vector", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) != float("inf")), F.lit(False)))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))


def _matrix(at: np.ndarray, flat: np.ndarray, width: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x) from their lengths and all components, filled up with zeros; components that no query has go."""
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -FINITE, FINITE)
    if (at == width).all():
        return flat.reshape(len(at), width)
    out = np.zeros((len(at), width))
    row = np.repeat(np.arange(len(at)), at)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(at) - at, at)
    out[row[col < width], col[col < width]] = flat[col < width]
    return out


def _read(batch: pa.RecordBatch, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    vectors = batch.column(1)
    return batch.column(0).to_numpy(), _matrix(np.diff(vectors.offsets.to_numpy()), vectors.flatten().to_numpy(zero_copy_only=False), width, scale)


def _shards(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the rows, SEED_ROWS first and then in shards."""
    held, rows, size = [], 0, SEED_ROWS
    for batch in batches:
        held.append(_read(batch, width, scale))
        rows += len(batch)
        if rows >= size:
            yield np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])
            held, rows, size = [], 0, SHARD_ROWS
    if held:
        yield np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])


def _searching(shared, k: int, scale: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted = shared.value
        best = Best(len(ids), k)
        most = np.abs(wanted).max(initial=0) * max(1, width)
        for own, vectors in _shards(batches, width, scale):
            if most * np.abs(vectors).max(initial=0) >= EXACT:
                exactly(own, vectors, ids, wanted, best)
                continue
            shard = Shard(own, vectors)
            for q in range(len(ids)):
                shard.search(q, ids[q], wanted[q], best)
        for lo in range(0, len(ids), 1000):
            there = best.score[lo : lo + 1000] != NONE
            columns = np.repeat(ids[lo : lo + 1000], k)[there.ravel()], best.ids[lo : lo + 1000][there], best.score[lo : lo + 1000][there]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def _blocks(asked: DataFrame, size: int) -> Iterator[list]:
    """The queries, so many at a time: no more of them are on the driver at once than one block and one partition's part."""
    block = []
    for r in asked.toLocalIterator():
        block.append(r)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score: for each row of (vec_id, embedding) that is a query, the k others with the greatest inner product."""
    spark = vectors.sparkSession
    arrow_batches(spark)
    rows = usable(vectors)
    asked = staged(rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    width = asked.agg(F.max(F.size("vector"))).first()[0]
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kept, parts = scratch(spark, "best"), []
    for block in _blocks(asked, max(1, BLOCK_COMPONENTS // max(1, width or 0))):
        ids, lengths = np.array([r["vec_id"] for r in block], np.int64), np.array([len(r["vector"]) for r in block])
        wanted = _matrix(lengths, np.array([x for r in block for x in r["vector"]], np.float64), width, scale)
        shared = spark.sparkContext.broadcast((ids, wanted))
        found = rows.mapInArrow(trimmed(_searching(shared, k, scale, width)), "query_id long, vec_id long, score long")
        parts.append(f"{kept}/{len(parts)}")
        # A block's queries are answered for good, so its best are written and its broadcast goes.
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").write.parquet(parts[-1])
        shared.destroy()
    out = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(out).parquet(*parts) if parts else spark.createDataFrame([], out)


def op11_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
