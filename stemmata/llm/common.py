"""Shared helpers: reading tables, staging intermediate results in the shared folder, Arrow plumbing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import bounded as arrow_batches
from ..runtime import qualified, scratch, shared_dir, staged

__all__ = ["ASCII_SPACE", "arrow_batches", "carried", "once", "packed", "qualified", "scratch", "shared_dir", "slices", "staged", "table", "text_bytes", "trimmed", "utf8"]

#: Code points 9-13 and 32, as every operator's word rule takes them.
ASCII_SPACE = b"\t\n\x0b\x0c\r "


#: Under this name operators carry the columns that they don't read.
REST = "__rest"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: dict[str, tuple[Hashable, Any]] = {}


def once(kind: str, key: Hashable, make: Callable[[], Any]) -> Any:
    """What a worker makes once and keeps for its later tasks, one of each kind."""
    if kind not in _made or _made[kind][0] != key:
        _made.pop(kind, None)
        _made[kind] = key, make()
    return _made[kind][1]


def forget(but: str = "") -> None:
    """Drops what a worker keeps of other kinds: it serves one operator after another, and their tables would add up."""
    for kind in [k for k in _made if k != but]:
        del _made[kind]


def trimmed(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function, after which a worker gives back the memory it no longer uses, but for what it keeps of one kind: workers live on between tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keeps)
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batch: pa.RecordBatch, texts: list[bytes], limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in pieces of about limit bytes of text."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size + len(t) > limit and i > lo:
            yield batch.slice(lo, i - lo), texts[lo:i]
            lo, size = i, 0
        size += len(t)
    yield batch.slice(lo), texts[lo:]


def packed(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """All texts in one buffer, and where each begins (with the end as the last entry)."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=at[1:])
    return b"".join(texts), at


def carried(documents: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """The columns named, with all others in one struct, so that no name of theirs can clash with an operator's own; and the Columns that give all of them back in order."""
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    others = [c for c in documents.columns if c not in used]
    rest = F.struct(F.lit(0).alias("none"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(others)])
    back = [F.col(c) if c in used else F.col(REST)[f"c{others.index(c)}"].alias(c) for c in documents.columns]
    return documents.select(*[c for c in documents.columns if c in used], rest.alias(REST)), back


def utf8(column: str) -> Column:
    return F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "utf-8")
