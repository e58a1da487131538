"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A merge can only join bytes that stand side by side inside some vocabulary token. A byte pair that occurs
in no token is therefore a certain cut: no token of any encoding spans it. The tokenizer's own word rule
must not change at the cut either. It reads from left to right and looks ahead only behind white space and
behind an apostrophe, so a cut between two characters is safe
* in front of white space: a new piece starts there or, inside a run of white space, a piece is divided at a pair that never merges;
* otherwise, unless the first is white space or an apostrophe, or the second an apostrophe behind anything but an ASCII letter
  or digit: either both are of one class, and the run is divided at a pair that never merges, or a new piece starts there.
Each fragment between such cuts is encoded on its own, and the ids are concatenated; a worker remembers fragments
it has met within a bound of bytes. Decoding concatenates the bytes of the ids and reads them as UTF-8.

Defined cases: a null text counts as empty and has no ids; the text of a special token becomes that token,
as in the library; bytes that aren't UTF-8 after decoding become U+FFFD; other columns pass through.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_SPACE, arrow_batches, once, packed, slices, text_bytes, trimmed

#: Bytes of memory that the fragments which a worker remembers may take; then it starts anew.
CACHE = 48 << 20
#: What an entry takes beside its bytes, about.
ENTRY = 200
#: Bytes of text cut into fragments at once: their list takes some 25 times that.
PIECE = 1 << 20
#: Last bytes of white space outside ASCII (fixed by Unicode: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).
WHITE_ENDS = [0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]
#: Fixed value: the word rule of byte-level tokenizers.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for bytes: themselves where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def safe_pairs() -> np.ndarray:
    """By byte pair (first << 8 | second): whether the word rule allows a cut there, whatever stands around it."""
    space = np.zeros(256, bool)
    space[list(ASCII_SPACE)] = True
    first = ~space
    first[[*WHITE_ENDS, ord("'")]] = False
    # Not inside a character; the separators 1C to 1F are white space to some word rules.
    first[0x1C:0x20] = False
    second = np.ones(256, bool)
    second[0x80:0xC0] = False
    safe = first[:, None] & second
    word = np.zeros(256, bool)
    word[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    safe[~word, ord("'")] = False
    safe[:, space] = True
    return safe.ravel()


class Fragments(dict):
    """Packed ids by fragment; one that is missing is encoded."""

    def __init__(self, encode) -> None:
        self.encode, self.size = encode, 0

    def __missing__(self, fragment: bytes) -> bytes:
        ids = self.encode(fragment)
        self[fragment] = ids
        self.size += len(fragment) + len(ids) + ENTRY
        return ids


class Codec:
    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        added = {x["id"]: x["content"].encode() for x in spec.get("added_tokens") or ()}
        vocab = spec["model"]["vocab"]
        self.pieces: list[bytes] = [b""] * (1 + max([*vocab.values(), *added]))
        inside = np.zeros(1 << 16, bool)
        for token, i in vocab.items():
            if i not in added:
                self.pieces[i] = piece = bytes(letters[c] for c in token)
                for a, b in zip(piece, piece[1:]):
                    inside[a << 8 | b] = True
        for i, piece in added.items():
            self.pieces[i] = piece
        self.added = list(added.values())
        for piece in self.added:
            for a, b in zip(piece, piece[1:]):
                inside[a << 8 | b] = True
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        #: Certain cuts; none at all for a tokenizer whose word rule or normaliser isn't the one argued about above.
        self.cuts = ~inside & safe_pairs()
        if not plain:
            self.cuts[:] = False
        self.plain = plain
        self.known = Fragments(self._packed)

    @cached_property
    def tokenizer(self):
        """The library's; only fragments with a special token need it, and vocabularies of other kinds."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    @cached_property
    def merger(self):
        """An encoder by rank, or None; decoding needs neither."""
        if not self.plain:
            return None
        with open(self.path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        return self._merger(model["merges"], model["vocab"])

    def _merger(self, merges: list, vocab: dict[str, int]):
        """An encoder by rank, where ids are given in the order of the merges; it gives the library's ids in less time."""
        import tiktoken

        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        order = [vocab[a + b] for a, b in pairs]
        singles = [vocab.get(c, 1 << 30) for c in byte_letters()]
        special = {i for i in range(len(self.pieces)) if self.pieces[i] in self.added}
        if order != sorted(set(order)) or max(singles) > order[0] or len(order) + 256 + len(special) != len(self.pieces):
            return None
        ranks = {x: i for i, x in enumerate(self.pieces) if i not in special}
        return tiktoken.Encoding("own", pat_str=WORD_RULE, mergeable_ranks=ranks, special_tokens={})

    def fragments(self, texts: list[bytes]) -> tuple[list[bytes], list[int]]:
        """The fragments of all texts, and where each text's fragments begin (with the end as the last entry)."""
        data, at = packed(texts)
        n = len(data)
        if not n:
            return [], [0] * (len(texts) + 1)
        raw = np.frombuffer(data, np.uint8)
        edge = np.ones(n + 1, bool)
        edge[1:-1] = self.cuts[raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:]]
        edge[at] = True
        starts = np.flatnonzero(edge)
        bounds = starts.tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])], np.searchsorted(starts, at).tolist()

    def _packed(self, fragment: bytes) -> bytes:
        text = fragment.decode()
        if self.merger is None or any(x in fragment for x in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.merger.encode_ordinary(text)).tobytes()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin (with the end as the last entry)."""
        fragments, first = self.fragments(texts)
        if self.known.size > CACHE:
            self.known = Fragments(self._packed)
        ids = list(map(self.known.__getitem__, fragments))
        upto = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)), out=upto[1:])
        return np.frombuffer(b"".join(ids), np.uint32), upto[first] // 4

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """One for each Python worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return once("codec", path, lambda: Codec(path))


def _encoding(vocab: str, names: list[str]):
    """Batches whose last column is a text become batches with its ids in place of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(batch.num_columns - 1)), PIECE):
                flat, at = codec(vocab).encode(texts)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.view(np.int32)))], names=names)

    return run


def _decoding(vocab: str, at: int, text: str):
    """Batches get the text of the ids in column at as a last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [codec(vocab).decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return run


def _to_encode(df: DataFrame, text: str, ids: str, keep: list[str] | None) -> tuple[DataFrame, T.StructType]:
    """The columns kept with the text as the last one, and the schema with ids in its place."""
    arrow_batches(df.sparkSession)
    keep = [c for c in (df.columns if keep is None else keep) if c != ids]
    df = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("__text"))
    return df, T.StructType([*df.drop("__text").schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])


def encode(df: DataFrame, vocab: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """df's columns (or those named in keep) and the token ids of each text; a column of that name gives way."""
    rows, schema = _to_encode(df, text, ids, keep)
    return rows.mapInArrow(trimmed(_encoding(vocab, schema.names), "codec"), schema)


def decode(df: DataFrame, vocab: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df's columns and the text that each row's ids stand for; a column of that name gives way."""
    df = df.drop(text)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])
    return df.mapInArrow(trimmed(_decoding(vocab, df.columns.index(ids), text), "codec"), schema)


def round_trip(df: DataFrame, vocab: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """decode(encode(df)) in one pass: one worker for each task holds the vocabulary, not two."""
    keep = [c for c in (df.columns if keep is None else keep) if c != decoded]
    rows, schema = _to_encode(df, text, ids, keep)
    names, last = schema.names, len(schema) - 1
    both = lambda batches: _decoding(vocab, last, decoded)(_encoding(vocab, names)(batches))
    return rows.mapInArrow(trimmed(both, "codec"), T.StructType([*schema.fields, T.StructField(decoded, T.StringType())]))


def digests(df: DataFrame) -> DataFrame:
    """n_tokens and the digests of ids and decoded text."""
    return (
        df.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256))
        .withColumn("decoded_sha256", F.sha2(F.encode("decoded", "utf-8"), 256))
        .drop("ids", "decoded")
    )


def vocab_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    return digests(round_trip(docs, vocab_file(), keep=["doc_id"]))
