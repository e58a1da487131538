"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z only) and cut into words of ASCII letters, digits and any non-ASCII bytes.
A pattern is a window of 13 consecutive words of a benchmark item, or all words of a shorter item.
Words of the benchmark have numbers, and patterns of one length form one search table in flat arrays: by the hash of
a two-word block a shift of one byte says how many positions can be skipped; where it is 0, the bucket of that hash
names the patterns that end in such a block, and comparing word by word confirms. A word that the benchmark lacks
skips every position that it could be part of.

Defined cases: a null or wordless text has no words and is clean; an item without words has no window;
equal windows of several items credit each of them; other columns of either table are ignored. Each row of
documents is judged by itself, whatever the size of the benchmark: doc_id may be null or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, carried, once, slices, staged, text_bytes, trimmed

WINDOW = 13
#: Bytes of tables that one pass keeps in a worker's memory; more patterns are searched in further blocks.
PATTERN_BYTES = 128 << 20
#: Bytes of tables for each byte of benchmark text, at most.
TABLE_BYTES = 32

_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
#: A multiplier that spreads the first word of a block; below 2^31, so that products stay in 64 bits.
_SPREAD = 0x5BD1E995


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Table:
    """The distinct patterns of one length: shifts and buckets by block hash, the patterns' words, and the items of each."""

    def __init__(self, patterns: np.ndarray, item_of: np.ndarray) -> None:
        length = patterns.shape[1]
        row = np.ascontiguousarray(patterns).view(np.dtype((np.void, 4 * length))).ravel()
        _, first, of = np.unique(row, return_index=True, return_inverse=True)
        self.length, self.patterns = length, patterns[first].astype(np.int32)
        pairs = np.unique(of * np.int64(int(item_of.max()) + 1) + item_of)
        of, self.items = np.divmod(pairs, np.int64(int(item_of.max()) + 1))
        self.items = self.items.astype(np.int32)
        self.first_item = np.searchsorted(of, np.arange(len(first) + 1)).astype(np.int32)
        size = max(256, 4 * len(first), min(2 * len(first) * length, 1 << 16))
        self.mask = (1 << size.bit_length()) - 1
        shift = np.full(self.mask + 1, self.far, np.uint8)
        ends = range(self.block, length + 1)
        for end in ends:
            h = self.hashed(self.patterns[:, end - self.block : end])
            np.minimum.at(shift, h, min(255, length - end))
        self.shift = shift.tobytes()
        self.by_hash = np.argsort(h, kind="stable").astype(np.int32)
        self.bucket = np.searchsorted(h[self.by_hash], np.arange(self.mask + 2)).astype(np.int32)

    @property
    def block(self) -> int:
        return min(2, self.length)

    @property
    def far(self) -> int:
        return min(255, self.length - self.block + 1)

    def hashed(self, blocks: np.ndarray) -> np.ndarray:
        last = blocks[:, -1].astype(np.int64)
        return (blocks[:, 0].astype(np.int64) * _SPREAD + last if self.block == 2 else last) & self.mask


class Patterns:
    """What a pass searches for, in arrays that are cheap to send: the benchmark's words and a table for each length."""

    def __init__(self, items: list[tuple[int, bytes]], width: int = WINDOW) -> None:
        number: dict[bytes, int] = {}
        put = number.setdefault
        found: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        self.item_ids = np.array([i for i, _ in items], np.int64)
        for k, (_, text) in enumerate(items):
            ids = np.array([put(w, len(number)) for w in words(text)], np.int32)
            if len(ids):
                here = np.lib.stride_tricks.sliding_window_view(ids, min(width, len(ids)))
                rows, of = found.setdefault(here.shape[1], ([], []))
                rows.append(here)
                of.append(np.full(len(here), k, np.int64))
        self.words = b" ".join(number)
        self.tables = [Table(np.concatenate(rows), np.concatenate(of)) for _, (rows, of) in sorted(found.items())]


class Search:
    """Wu-Manber search over word sequences."""

    def __init__(self, patterns: Patterns) -> None:
        self.number = {w: i for i, w in enumerate(patterns.words.split())}
        self.patterns = patterns

    def hits(self, text: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, word after the last, items) of each occurrence."""
        get, n = self.number.get, len(text)
        for t in self.patterns.tables:
            length, block, shift, mask = t.length, t.block, t.shift, t.mask
            end = length
            while end <= n:
                last = get(text[end - 1])
                if last is None:
                    end += length
                    continue
                h = last
                if block == 2:
                    before = get(text[end - 2])
                    if before is None:
                        end += length - 1
                        continue
                    h += before * _SPREAD
                h &= mask
                if shift[h]:
                    end += shift[h]
                    continue
                here = [get(w, -1) for w in text[end - length : end]]
                for k in t.by_hash[t.bucket[h] : t.bucket[h + 1]].tolist():
                    if t.patterns[k].tolist() == here:
                        yield end - length, end, self.patterns.item_ids[t.items[t.first_item[k] : t.first_item[k + 1]]].tolist()
                        break  # patterns are distinct
                end += 1


def _search(shared) -> Search:
    """One for each Python worker and block."""
    return once("search", shared, lambda: Search(shared.value))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of at most about limit bytes of text; the driver holds one block at a time."""
    block: list[tuple[int, bytes]] = []
    size = 0
    for item, text in benchmark.select(F.col("item_id").cast("long"), F.encode("text", "utf-8")).where("text is not null").toLocalIterator():
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((item, bytes(text)))
        size += len(text)
    yield block


def _numbered(documents: DataFrame, name: str) -> DataFrame:
    """The documents with a number of each row as __row, written once so that it stays the same in every later read."""
    return staged(documents.withColumn("__row", F.monotonically_increasing_id()), name)


def find(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """doc_id, n_words, starts and ends (of the maximal hit runs, in words) and items (ids of the items found) of every document."""
    blocks = _blocks(benchmark, pattern_bytes // TABLE_BYTES)
    first, second = next(blocks), next(blocks, None)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if second is None:
        return _searched(docs, [first], width)
    docs = _numbered(docs, "documents")
    found = _searched(docs.select(F.col("__row").alias("doc_id"), "text"), chain([first, second], blocks), width).withColumnRenamed("doc_id", "__row")
    return found.join(docs.select("__row", "doc_id"), "__row").select("doc_id", "n_words", "starts", "ends", "items")


def _searched(docs: DataFrame, blocks: Iterable[list[tuple[int, bytes]]], width: int) -> DataFrame:
    """find() for docs of doc_id and text; with more than one block, doc_id has to be unique and not null."""
    spark = docs.sparkSession
    arrow_batches(spark)
    schema = "doc_id long, n_words long, starts array<int>, ends array<int>, items array<long>"
    parts = []
    for block in blocks:
        shared = spark.sparkContext.broadcast(Patterns(block, width))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = _search(shared)
            for batch in batches:
                for part, texts in slices(batch, text_bytes(batch.column(1))):
                    rows = []
                    for text in texts:
                        w = words(text)
                        spans, items = [], set()
                        for start, end, found in search.hits(w):
                            spans.append((start, end))
                            items.update(found)
                        spans = _merged(spans)
                        rows.append((len(w), [a for a, _ in spans], [b for _, b in spans], sorted(items)))
                    n, starts, ends, items = zip(*rows) if rows else ((), (), (), ())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(n, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))],
                        names=["doc_id", "n_words", "starts", "ends", "items"],
                    )

        parts.append(docs.mapInArrow(trimmed(run, "search"), schema))
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # Runs found by different blocks may overlap: sort them and start a new run where one begins after all earlier ones end.
    spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    both = every.groupBy("doc_id").agg(F.first("n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    runs = F.expr(
        "aggregate(spans, cast(array() as array<struct<starts: int, ends: int>>), (a, x) -> case when size(a) > 0 and x.starts <= element_at(a, -1).ends "
        "then concat(slice(a, 1, size(a) - 1), array(named_struct('starts', element_at(a, -1).starts, 'ends', greatest(element_at(a, -1).ends, x.ends)))) "
        "else concat(a, array(named_struct('starts', x.starts, 'ends', x.ends))) end)"
    )
    return both.withColumn("runs", runs).select("doc_id", "n_words", F.col("runs.starts").alias("starts"), F.col("runs.ends").alias("ends"), "items")


def judged(found: DataFrame) -> DataFrame:
    """Adds n_hit and the verdict: contaminated from one hit word in twenty on."""
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op10_wu_manber(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = judged(find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with all their columns: the verdict is made in the scan that reads them."""
    spark = documents.sparkSession
    arrow_batches(spark)
    blocks = _blocks(benchmark, PATTERN_BYTES // TABLE_BYTES)
    first, second = next(blocks), next(blocks, None)
    documents, back = carried(documents, "doc_id", "text")
    if second is not None:
        rows = _numbered(documents, "documents")
        docs = rows.select(F.col("__row").alias("doc_id"), F.col("text").cast("string").alias("text"))
        bad = judged(_searched(docs, chain([first, second], blocks), WINDOW)).where("contaminated").select(F.col("doc_id").alias("__row"))
        return rows.join(bad, "__row", "left_anti").select(*back)
    shared = spark.sparkContext.broadcast(Patterns(first))
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _search(shared)
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(at))):
                keep = []
                for text in texts:
                    w = words(text)
                    n_hit = sum(b - a for a, b in _merged([(a, b) for a, b, _ in search.hits(w)]))
                    keep.append(not (n_hit and 20 * n_hit >= len(w)))
                yield part.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(trimmed(run, "search"), documents.schema).select(*back)


def brute_force(docs: list[tuple[int, str | None]], bench: list[tuple[int, str | None]]) -> list[tuple]:
    """The contract, word by word; for tests."""
    import re

    def cut(s):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))

    items = {i: cut(t) for i, t in bench}
    out = []
    for doc, text in docs:
        w, hit, got = cut(text), set(), []
        for item, x in items.items():
            size = min(WINDOW, len(x))
            pats = {tuple(x[i : i + size]) for i in range(len(x) - size + 1)} if x else set()
            places = [i for i in range(len(w) - size + 1) if x and tuple(w[i : i + size]) in pats]
            hit |= {j for i in places for j in range(i, i + size)}
            got += [str(item)] if places else []
        out.append((doc, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out

