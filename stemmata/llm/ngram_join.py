"""Similarity self-join on word shingles: n-gram Jaccard with several global token orders.

A set is the distinct five-word shingles of a text (A-Z lower-cased, words between ASCII white space), the
whole word sequence if it has fewer words, or nothing. For a Jaccard of 0.8 two sets of sizes x and y must
share a token among the first x - ceil(0.8 x) + 1 and y - ceil(0.8 y) + 1 tokens under every global order
of tokens, and so many of them that what lies behind the prefixes could make up the rest. The first order puts
rare tokens first and yields the candidates with the number of prefix tokens they share; two others, by hashes,
must agree before the sets are compared. Tokens are 64-bit hashes of shingles.

Equal sets form one class and are compared once. Runs of documents under one prefix token are compared in
full if short; a long run, as many near copies of one text make, first only to its least document. Documents
that are then outside a run's main component are searched for against all others, so no link that could join
two components is missed.

Defined cases: null, empty and wordless texts have empty sets, are linked with nothing and stand alone;
repeated rows each give a row; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, carried, slices, staged, table, text_bytes, trimmed
from .components import components

WORDS = 5
PERCENT = 80
#: A token in so many documents of one slice of text is counted; others are in few documents anyway.
COUNTED = 2
#: Counted tokens whose frequency the first order knows; the rest pass for rare, which only makes runs longer.
KNOWN = 1_000_000
SHORT_RUN = 32
#: Ids up to which a needed-documents list is broadcast; beyond, it is joined by key.
BROADCAST_IDS = 200_000
ENTRIES_PER_BUCKET = 150_000
#: Parts into which the documents of one class are dealt when they are joined with it.
SALTS = 16
#: Keys in one block of queries against the documents with long runs.
QUERY_KEYS = 1_000_000

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_ENTRY = np.dtype([("key", "<u8"), ("doc", "<i8"), ("n", "<i4")])


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers, another one for each seed."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def shingle_sets(texts: list[bytes], width: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct tokens of each text."""
    split = [t.translate(_LOWER).split() for t in texts]
    seen: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    for ws in split:
        for w in set(ws):
            if w not in seen:
                seen[w] = digest(w)
    sizes = [len(ws) for ws in split]
    flat = np.fromiter((seen[w] for ws in split for w in ws), np.uint64, sum(sizes))
    rolled = np.zeros(max(0, len(flat) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            rolled = rolled * np.uint64(0x9FB21C651E98DF25) + flat[k : k + len(rolled)]
    rolled = mixed(rolled, 1)
    out, at = [], 0
    for n in sizes:
        if n >= width:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            out.append(np.array([xxhash.xxh64_intdigest(flat[at : at + n].tobytes(), seed=n)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def prefix(keys: np.ndarray) -> np.ndarray:
    """The keys that come first, as many as a prefix has."""
    p = prefix_size(len(keys))
    return np.partition(keys, p - 1)[:p] if p < len(keys) else keys


def _first_order(tokens: np.ndarray, known: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Keys that sort rare tokens first, and tokens of about the same frequency by a hash."""
    keys = mixed(tokens, 2) >> np.uint64(6)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        hit = known[at] == tokens
        keys[hit] |= frequency[at[hit]] << np.uint64(58)
    return keys


def _docs(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def profile(documents: DataFrame) -> DataFrame:
    """By kind: documents with set size and set key (0), tokens counted in a slice (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(1))):
                sets = shingle_sets(texts)
                keys = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8") for s in sets]).reshape(-1, 2)
                first = np.unique(keys, axis=0, return_index=True)[1]
                token, count = np.unique(np.concatenate([sets[i] for i in first]) if len(first) else np.zeros(0, np.uint64), return_counts=True)
                token, count = token[count >= COUNTED], count[count >= COUNTED]
                m, k = len(sets), len(token)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([0, 1], [m, k]).astype(np.int8)),
                        pa.concat_arrays([part.column(0), pa.nulls(k, pa.int64())]),
                        pa.array(np.concatenate([[len(s) for s in sets], count]).astype(np.int64)),
                        pa.array(np.concatenate([keys[:, 0], token.view(np.int64)])),
                        pa.array(np.concatenate([keys[:, 1], np.zeros(k, np.int64)])),
                    ],
                    names=["kind", "doc_id", "n", "k1", "k2"],
                )

    return _docs(documents).mapInArrow(trimmed(run), "kind byte, doc_id long, n long, k1 long, k2 long")


def frequencies(profiled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent counted tokens, sorted, and the magnitude of each one's frequency: KNOWN at most."""
    rows = profiled.where("kind = 1").groupBy("k1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "k1").limit(KNOWN)
    found = rows.toArrow()
    token = found.column("k1").to_numpy().view(np.uint64)
    size = np.clip(np.ceil(np.log2(np.maximum(found.column("n").to_numpy().astype(np.float64), 2)) * 2), 1, 63).astype(np.uint64)
    order = np.argsort(token)
    return token[order], size[order]


def entries(documents: DataFrame, known: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """(bucket, entries): prefix tokens under the first order, packed; of equal sets in one slice, the first's."""
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(1))):
                docs, seen, found = part.column(0).to_pylist(), set(), []
                for doc, tokens in zip(docs, shingle_sets(texts)):
                    if not len(tokens) or doc is None or (digest := xxhash.xxh3_128_digest(tokens.tobytes())) in seen:
                        continue
                    seen.add(digest)
                    keys = prefix(_first_order(tokens, *shared.value))
                    rows = np.empty(len(keys), _ENTRY)
                    rows["key"], rows["doc"], rows["n"] = keys, doc, len(tokens)
                    found.append(rows)
                if not found:
                    continue
                rows = np.concatenate(found)
                bucket = (mixed(rows["key"], 3) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                rows, bucket = rows[order], bucket[order]
                have, at = np.unique(bucket, return_index=True)
                ends = [*at[1:].tolist(), len(rows)]
                yield pa.RecordBatch.from_arrays([pa.array(have), pa.array([rows[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary())], names=["bucket", "entries"])

    return _docs(documents).mapInArrow(trimmed(run), "bucket long, entries binary")


def _fits(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n_a, n_b).astype(np.int64) >= PERCENT * np.maximum(n_a, n_b)


def _pairs(rows: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of documents (a < b) of fitting sizes, and how often each occurs."""
    if not left:
        none = np.zeros(0, np.int64)
        return none, none, none
    a, b = np.concatenate(left), np.concatenate(right)
    ok = _fits(rows["n"][a], rows["n"][b]) & (rows["doc"][a] != rows["doc"][b])
    docs, place = np.unique(rows["doc"], return_inverse=True)
    code, count = np.unique(place[a[ok]].astype(np.int64) << 32 | place[b[ok]], return_counts=True)
    return docs[code >> 32], docs[code & 0xFFFFFFFF], count


PAIR, LONG, STAR = 0, 1, 2


def run_pairs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From the runs of equal keys, (kind, a, b, n): pairs of short runs with the keys they share, entries (key, document, set size) of long runs, and pairs of a long run's least document with the others."""
    rows = rows[np.lexsort((rows["doc"], rows["key"]))]
    edge = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
    length = np.diff(np.append(edge, len(rows)))
    short, star, long = ([], []), ([], []), [np.zeros(0, np.int64)]
    for size in np.unique(length[length > 1]).tolist():
        at = edge[length == size][:, None] + np.arange(size)
        if size <= SHORT_RUN:
            i, j, to = *np.triu_indices(size, 1), short
        else:
            i, j, to = np.zeros(size - 1, np.int64), np.arange(1, size), star
            long.append(at.ravel())
        to[0].append(at[:, i].ravel())
        to[1].append(at[:, j].ravel())
    far = rows[np.concatenate(long)]
    a, b, n = _pairs(rows, *short)
    c, d, m = _pairs(rows, *star)
    return np.repeat([PAIR, LONG, STAR], [len(a), len(far), len(c)]).astype(np.int8), np.concatenate([a, far["key"].view(np.int64), c]), np.concatenate([b, far["doc"], d]), np.concatenate([n, far["n"], m * 0]).astype(np.int64)


def candidates(packed_entries: DataFrame, partitions: int) -> DataFrame:
    """The rows of run_pairs over all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for batch in batches for x in batch.column(1).to_pylist()]
        if not blobs:
            return
        columns = run_pairs(np.frombuffer(b"".join(blobs), _ENTRY))
        for lo in range(0, len(columns[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 50_000]) for c in columns], names=["kind", "a", "b", "n"])

    return packed_entries.repartition(partitions, "bucket").mapInArrow(trimmed(run), "kind byte, a long, b long, n long")


def enough(shared: Column) -> Column:
    """Whether sets of n_a and n_b tokens that share this many prefix tokens can reach the threshold: the smaller last prefix key bounds what else they share."""
    rest = lambda n: F.ceil(F.col(n) * PERCENT / 100) - 1
    return (100 + PERCENT) * (shared + F.greatest(rest("n_a"), rest("n_b"))) >= PERCENT * (F.col("n_a") + F.col("n_b"))


def only(documents: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The documents whose doc_id is (left_semi) or isn't (left_anti) in ids; a short list is broadcast, a long one joined."""
    ids = staged(ids.select(F.col(ids.columns[0]).alias("doc_id")).distinct(), "ids")
    return documents.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how).select(*documents.columns)


def linked(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the pairs, those whose sets share prefix tokens under both further orders and then reach the threshold."""
    spark = documents.sparkSession
    pairs = pairs.select("a", "b")
    needed = pairs.select("a").union(pairs.select("b"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(1))):
                found = shingle_sets(texts)
                columns = [[s.tobytes() for s in found], *[[np.sort(prefix(mixed(s, k))).tobytes() if len(s) else b"" for s in found] for k in (4, 5)]]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.binary()) for c in columns]], names=["doc_id", "tokens", "second", "third"])

    one = staged(only(_docs(documents), needed).mapInArrow(trimmed(sets), "doc_id long, tokens binary, second binary, third binary"), "sets")
    side = lambda s: one.select(F.col("doc_id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("tokens", "second", "third")])
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_tokens", "a_second", "a_third", "b_tokens", "b_second", "b_third")

    def shared(x: bytes, y: bytes) -> int:
        both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
        both.sort(kind="stable")
        return int((both[1:] == both[:-1]).sum())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, *rest = (batch.column(k) for k in range(8))
            keep = []
            for at, as_, a3, bt, bs, b3 in zip(*(c.to_pylist() for c in rest)):
                if not (shared(as_, bs) and shared(a3, b3)):
                    keep.append(False)
                    continue
                n = shared(at, bt)
                keep.append(100 * n >= PERCENT * ((len(at) + len(bt)) // 8 - n))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    arrow_batches(spark)
    return staged(both.mapInArrow(trimmed(verify), "a long, b long"), "links")


def _by_class(pairs: DataFrame, class_of: DataFrame) -> DataFrame:
    """The pairs between class representatives with their set sizes, each once, and the sum of n."""
    for side in ("a", "b"):
        pairs = pairs.join(class_of.select(F.col("doc_id").alias(side), F.col("rep").alias(f"rep_{side}"), F.col("n_shingles").alias(f"n_{side}")), side)
    keys = [F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"), F.greatest("n_a", "n_b").alias("n_a"), F.least("n_a", "n_b").alias("n_b")]
    return pairs.where("rep_a != rep_b").groupBy(*keys).agg(F.sum("n").alias("n"))


def _index(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Of documents with their keys: the keys, sorted, where each one's documents begin, those documents, and their id, size, component and `short`."""
    lists = rows.column("keys").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    doc = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
    order = np.argsort(lists.values.to_numpy(), kind="stable")
    keys, at = np.unique(lists.values.to_numpy()[order], return_index=True)
    return keys, np.append(at, len(order)), doc[order], *(rows.column(c).to_numpy() for c in ("rep", "n", "component", "short"))


def _far(n: np.ndarray) -> np.ndarray:
    return -(-n * PERCENT // 100) - 1


def unconnected(runs: DataFrame, class_of: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """From the long runs, pairs of representatives that no links connect so far and that share enough keys, and how many keys of long runs (m) they share.

    In a run, one of two documents of different components is outside the run's most frequent one. Those outsiders are
    the queries, in blocks of bounded size, against the keys of all documents with long runs; keys shared in short
    runs were counted before, and the most that either document has there (`short`) is allowed for."""
    rows = runs.join(class_of, runs["b"] == class_of["doc_id"]).select(F.col("a").alias("key"), "rep", "n").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    rows = staged(rows.select("key", "rep", "n", F.coalesce("component", "rep").alias("component")).distinct(), "run-rows")
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("m"))
    usual = sizes.groupBy("key").agg(F.max(F.struct("m", "component")).alias("x"), F.count("*").alias("kinds")).where("kinds > 1").select("key", F.col("x.component").alias("usual"))
    outside = rows.join(usual, "key").where("component != usual").select("rep").distinct()
    most = pairs.select("a", "n").union(pairs.select("b", "n")).toDF("rep", "n").groupBy("rep").agg(F.max("n").alias("short"))
    docs = rows.groupBy("rep", "n", "component").agg(F.collect_list("key").alias("keys")).join(most, "rep", "left").select("rep", "n", "component", F.coalesce("short", F.lit(0)).alias("short"), "keys")
    docs = staged(docs, "run-documents")
    queries = staged(docs.join(outside, "rep", "left_semi"), "outsiders")
    blocks = -(-(queries.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]) // QUERY_KEYS)
    parts = [queries.select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(0).cast("long").alias("m")).where("false")]
    for block in range(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(_index(queries.where(F.pmod(F.xxhash64("rep"), F.lit(blocks)) == block).toArrow()))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            keys, at, doc, rep, n, component, short = shared.value
            for batch in batches:
                out = [[], [], []]
                lists = batch.column(4)
                flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
                for y, ny, cy, sy, lo, hi in zip(*(batch.column(k).to_pylist() for k in range(4)), ends, ends[1:]):
                    mine = flat[lo:hi]
                    k = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
                    k = k[keys[k] == mine]
                    if not len(k):
                        continue
                    count = np.bincount(np.concatenate([doc[at[i] : at[i + 1]] for i in k.tolist()]), minlength=len(rep))
                    u = np.flatnonzero(count)
                    u = u[(component[u] != cy) & _fits(n[u], np.full(len(u), ny))]
                    rest = np.maximum(_far(n[u]), _far(np.full(len(u), ny))) + count[u] + np.minimum(short[u], sy)
                    u = u[(100 + PERCENT) * rest >= PERCENT * (n[u] + ny)]
                    out[0].append(np.minimum(rep[u], y))
                    out[1].append(np.maximum(rep[u], y))
                    out[2].append(count[u])
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["a", "b", "m"])

        parts.append(docs.mapInArrow(trimmed(probe), "a long, b long, m long"))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every.groupBy("a", "b").agg(F.max("m").alias("m"))


def _with_class(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """docs (doc_id, n_shingles, k1, k2) with the least document of their equal sets as rep.

    A class may hold a third of all documents: many classes are joined by key and a salt, each once for every salt."""
    if classes.count() <= BROADCAST_IDS:
        both = docs.join(F.broadcast(classes), ["k1", "k2"], "left")
    else:
        each = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(each, ["k1", "k2", "salt"], "left")
    rep = F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id"))
    return both.select("doc_id", "n_shingles", rep.alias("rep"))


def joined(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class_id (least document with an equal set) and component_id of every document."""
    spark = documents.sparkSession
    arrow_batches(spark)
    profiled = staged(profile(documents), "profile")
    docs = profiled.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "k1", "k2")
    some = docs.where("n_shingles > 0")
    # Only classes of several documents have to be looked up; all others stand for themselves.
    classes = staged(some.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")).where("members > 1").drop("members"), "equal-sets")
    docs = staged(_with_class(docs, classes), "classes")
    class_of = docs.where("n_shingles > 0").select("doc_id", "rep", "n_shingles")

    total = docs.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("*")).first()
    expected = total[0] // 5 + total[1]
    partitions = max(spark.sparkContext.defaultParallelism, -(-expected // (4 * ENTRIES_PER_BUCKET)))
    found = staged(candidates(entries(documents, frequencies(profiled), 4 * partitions), partitions), "candidates")
    class_of = class_of.distinct()
    pairs = staged(_by_class(found.where(F.col("kind") != LONG).select("a", "b", "n"), class_of), "pairs")
    long = staged(found.where(F.col("kind") == LONG).select("a", "b", "n"), "long-runs")
    if long.isEmpty():
        links = linked(documents, pairs.where(enough(F.col("n"))))
    else:
        # Pairs of long runs weren't counted: each document's entries there are the most that could be missing.
        at_most = staged(long.join(class_of, long["b"] == class_of["doc_id"]).select("rep", "a").distinct().groupBy("rep").agg(F.count("*").alias("more")), "long-counts")
        both = pairs
        for side in ("a", "b"):
            both = both.join(at_most.select(F.col("rep").alias(side), F.col("more").alias(f"more_{side}")), side, "left")
        missing = F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0)))
        first = staged(both.where(enough(F.col("n") + missing)).select("a", "b"), "first-pairs")
        links = linked(documents, first)
        more = unconnected(long, class_of, components(links), pairs)
        size = lambda s: class_of.where("doc_id = rep").select(F.col("rep").alias(s), F.col("n_shingles").alias(f"n_{s}"))
        more = more.join(pairs.select("a", "b", "n"), ["a", "b"], "left").join(size("a"), "a").join(size("b"), "b")
        more = more.where(enough(F.col("m") + F.coalesce("n", F.lit(0)))).join(first, ["a", "b"], "left_anti")
        links = links.union(linked(documents, staged(more.select("a", "b"), "more-pairs")))
    comps = components(links).select(F.col("node").alias("rep"), "component")
    out = docs.join(comps, "rep", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("class_id"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def op8_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents without those that a document with a smaller id is linked to, directly or through others."""
    out = staged(joined(documents), "components")
    rows, back = carried(documents, "doc_id")
    return only(rows, out.where("component_id != doc_id"), "left_anti").select(*back)


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id to (set size, component), comparing every pair; for tests."""
    import re

    sets = {}
    for doc, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(w[i : i + WORDS]) for i in range(max(1, len(w) - WORDS + 1))} if w else set()
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            n = len(sets[i] & sets[j])
            if n and 100 * n >= PERCENT * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}
