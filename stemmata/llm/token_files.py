"""Token ids in Arrow stream files of equal-length sequences.

The ids of all documents, in ascending doc_id order and each with an end id, form one stream of tokens.
Each range of documents is a shard: one Arrow IPC stream file whose record batches hold `tokens`
(fixed-size list of uint16, or uint32 for larger vocabularies) and `mask` (fixed-size list of bool: false
behind the shard's last token), uncompressed, so that a memory map gives sequence i without reading what lies
before it: its tokens as a view of the map, its mask unpacked from bits. A second stream file beside it holds doc_id, start and length in the shard.

Files are written by the tasks straight to the shared folder under a name of their own for each attempt;
the manifest lists those of the attempts that ended, so a lost executor or a repeated task leaves nothing wrong.

Defined cases: null and empty texts have only the end id; rows with equal doc_id keep an order by text;
an empty table has no shard. Shards hold about `shard_bytes` of text, whatever the size of the table.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import PIECE, codec, vocab_file
from .common import arrow_batches, qualified, scratch, slices, text_bytes, trimmed

LENGTH = 2048
BATCH = 256
MANIFEST = "shard int, first_doc long, file string, index_file string, n_tokens long, n_docs long"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Writer:
    def __init__(self, folder: str, name: str, kind: pa.DataType, length: int) -> None:
        self.fs, base = _open(folder)
        self.fs.create_dir(base, recursive=True)
        self.paths = f"{folder}/{name}.arrows", f"{folder}/{name}.index.arrows"
        self.length, self.kind, self.left, self.total, self.docs = length, kind, np.zeros(0, kind.to_pandas_dtype()), 0, 0
        self.schema = pa.schema([("tokens", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
        self.out = self.fs.open_output_stream(f"{base}/{name}.arrows")
        self.index_out = self.fs.open_output_stream(f"{base}/{name}.index.arrows")
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.index = pa.ipc.new_stream(self.index_out, self.index_schema)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, at: np.ndarray) -> None:
        """ids of several documents, the first of which begin at `at` (with the end as the last entry)."""
        sizes = np.diff(at)
        starts = self.total + at[:-1]
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(sizes)], schema=self.index_schema))
        flat = np.concatenate([self.left, ids.astype(self.left.dtype)])
        self.total += len(ids)
        self.docs += len(sizes)
        whole = len(flat) // self.length * self.length
        self._put(flat[:whole], whole)
        self.left = flat[whole:]

    def _put(self, flat: np.ndarray, used: int) -> None:
        mask = np.arange(len(flat)) < used
        for lo in range(0, len(flat), BATCH * self.length):
            hi = min(len(flat), lo + BATCH * self.length)
            rows = [pa.FixedSizeListArray.from_arrays(pa.array(flat[lo:hi], self.kind), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask[lo:hi]), self.length)]
            self.stream.write_batch(pa.RecordBatch.from_arrays(rows, schema=self.schema))

    def close(self) -> None:
        if len(self.left):
            flat = np.zeros(self.length, self.left.dtype)
            flat[: len(self.left)] = self.left
            self._put(flat, len(self.left))
        for x in (self.stream, self.index, self.out, self.index_out):
            x.close()


def write(documents: DataFrame, vocab: str, folder: str, end_id: int = 2, length: int = LENGTH, shard_bytes: int = 64 << 20) -> list[tuple]:
    """Encodes and writes all documents; returns the manifest in shard order: one small row for each shard."""
    spark = documents.sparkSession
    arrow_batches(spark)
    folder = qualified(spark, folder)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = max(1, -(-((size[0] or 0) + 8 * size[1]) // shard_bytes), min(spark.sparkContext.defaultParallelism, size[1]))
    docs = docs.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    wide = len(codec(vocab).pieces) > 1 << 16 or end_id >= 1 << 16
    kind = pa.uint32() if wide else pa.uint16()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, writer, first = TaskContext.get().partitionId(), None, None
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(1)), PIECE):
                if not part.num_rows:
                    continue
                if writer is None:
                    writer, first = _Writer(folder, f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}", kind, length), part.column(0)[0].as_py()
                ids, at = codec(vocab).encode(texts)
                writer.add(part.column(0), np.insert(ids, at[1:], end_id), at + np.arange(len(at)))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "first_doc": first, "file": writer.paths[0], "index_file": writer.paths[1], "n_tokens": writer.total, "n_docs": writer.docs}], schema=pa.schema([("shard", pa.int32()), ("first_doc", pa.int64()), ("file", pa.string()), ("index_file", pa.string()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]))

    return sorted(tuple(r) for r in docs.mapInArrow(trimmed(run, "codec"), MANIFEST).collect())


class Shard:
    """Random access to one written shard. Tokens are views of the memory map where the file system has one; masks are stored as bits, so one is a copy of its own sequence's."""

    def __init__(self, file: str, index_file: str) -> None:
        self.batches = self._read(file)
        self.rows = np.cumsum([0, *[b.num_rows for b in self.batches]])
        self.index = self._read(index_file)
        self.length = self.batches[0].schema.field("tokens").type.list_size if self.batches else 0

    @staticmethod
    def _read(path: str) -> list[pa.RecordBatch]:
        from pyarrow import fs

        where, base = _open(path)
        source = pa.memory_map(base) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(base)
        return list(pa.ipc.open_stream(source))

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and mask of sequence i."""
        b = int(np.searchsorted(self.rows, i, "right")) - 1
        at = (i - int(self.rows[b])) * self.length
        tokens, mask = (self.batches[b].column(k).values for k in ("tokens", "mask"))
        return tokens.slice(at, self.length).to_numpy(), mask.slice(at, self.length).to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """n tokens of the shard's stream from start on."""
        parts = []
        while n > 0:
            b = int(np.searchsorted(self.rows * self.length, start, "right")) - 1
            at = start - int(self.rows[b]) * self.length
            take = min(n, self.batches[b].num_rows * self.length - at)
            parts.append(self.batches[b].column("tokens").values.slice(at, take).to_numpy())
            start, n = start + take, n - take
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def read(spark: SparkSession, manifest: list[tuple]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    base, rows = 0, []
    for shard, _, file, index_file, n_tokens, _ in manifest:
        rows.append((file, index_file, base))
        base += n_tokens
    files = spark.createDataFrame(rows, "file string, index_file string, base long").repartition(max(1, len(rows)), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["file"], row["index_file"])
                for part in shard.index:
                    starts, sizes = part.column("start").to_numpy(), part.column("length").to_numpy()
                    sums = [zlib.crc32(shard.tokens(a, n).astype("<u4")) for a, n in zip(starts.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(starts + row["base"]), pa.array(sizes), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(trimmed(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return read(spark, write(table(spark, sf_dir, "documents"), vocab_file(), scratch(spark, "tokens")))
