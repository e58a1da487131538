"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of 100 bytes that covers it also starts earlier: in a document with a smaller id, or
earlier in the same document. Matches stay inside documents and are judged on the input.

1. Prefilter. Of the 85 16-grams in each window of 100 bytes the one with the least hash is its anchor, so equal
   windows have equal anchors at equal offsets. Windows in a row with the same anchor form a segment. A window also
   holds the 42 bytes in front of its anchor or the 42 behind it; a segment that shares its anchor with both of
   these in no other can't hold a repeated window and is left out. Nothing else is decided by anchors.
2. Strings. Segments that are left and equal throughout are one string with several places (inside one batch of texts
   they are compared byte by byte, across batches by 128 bits of hash). The text of each string is fetched once and
   sent to the bucket of its anchor, where strings are dealt out to shards of bounded size.
3. Each shard's transform is made by sorting its suffixes; it keeps two letters in front of each suffix instead of one.
4. The transforms of a bucket are merged by refining an interleave: at first all rows of one shard stand in front of
   all rows of the next; each pass reads the transforms' letters in the order of the interleave and deals the rows
   out by them, stably, going on to the row that the LF step of its own shard names. After pass t, rows stand in the order
   of their first 2 t letters, and borders of blocks are where common prefixes end. No suffixes of the union are sorted.
   Rows alone in a block can't meet another any more and leave; blocks that still stand after 100 letters are the
   repeated intervals. Of all places of an interval's strings the first stays and all others repeat.
5. The places are grouped by document, and the covered bytes removed.

Defined cases: null and empty texts have no bytes; texts under 100 bytes lose nothing; rows with equal doc_id
are documents of their own, in the order of their texts; a row with a null doc_id has no place in the order of ids, so
it loses nothing and isn't an earlier occurrence for others; empty tables give no rows; extra columns pass through.
Texts are UTF-8, in which the byte FF doesn't occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, carried, packed, slices, staged, table, text_bytes, trimmed
from .ngram_join import BROADCAST_IDS, mixed

#: Fixed by the rule of removal; a multiple of 4.
WIDTH = 100
GRAM = 16
WINDOW = WIDTH - GRAM + 1
#: Bytes on one side of an anchor that any window with it holds on this side or the other.
SIDE = 42
ENTRIES_PER_BUCKET = 400_000
#: Bytes of text for which a segment is expected; only to size the buckets.
STRIDE = 40
#: Buckets for each partition of merges: one bucket is merged at a time.
MERGES = 8
#: Letters of a shard.
SHARD = 1 << 18
#: Strings under one anchor from which on they are dealt out by the anchor's offset, in so many offsets each.
HOT_STRINGS = 20_000
HOT_STEP = 5
#: The order of documents: doc_id, or a number where ids repeat; then REPEATED is there too.
ROW, REPEATED = "__row", "__repeated"
#: What deduplicated() adds.
RESULTS = {"__n_bytes": "long", "__n_removed": "long", "__starts": "array<int>", "__ends": "array<int>", "__kept": "binary"}

_SEGMENT = np.dtype([("key", "<u8"), ("body", "<u8"), ("doc", "<i8"), ("at", "<i4"), ("left", "<u4"), ("right", "<u4"), ("n", "u1"), ("rel", "u1")])
_STRING = np.dtype([("doc", "<i8"), ("at", "<i4"), ("n", "<i4")])
_LATER = np.dtype([("key", "<u8"), ("of_doc", "<i8"), ("of_at", "<i4"), ("doc", "<i8"), ("at", "<i4")])
#: Letters one up, as 0 ends strings; FF, which isn't in UTF-8, becomes 0 too.
_SHIFTED = bytes((c + 1) % 256 for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTER = mixed(np.arange(1, 257, dtype=np.uint64), 9)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done, factor = 1, np.uint64(base)
    with np.errstate(over="ignore"):
        while done < n:
            take = min(done, n - done)
            out[done : done + take] = out[:take] * factor
            done += take
            factor = factor * factor
    return out


def segments(data: bytes, at: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The segments of texts packed in data, which begin at `at`."""
    n = len(data)
    sizes = np.diff(at)
    if n < WIDTH or not (sizes >= WIDTH).any():
        return np.zeros(0, _SEGMENT)
    raw = np.frombuffer(data, np.uint8)
    letters = _LETTER[raw]
    gram = letters
    with np.errstate(over="ignore"):
        for step, base in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F), (4, 0xE7037ED1A0B428DB), (8, 0x8EBC6AF09C88C6E3)):
            gram = gram[:-step] * np.uint64(base) + gram[step:]
        gram = mixed(gram, 6)
        # The leftmost of the least hashes by their upper half: that choice doesn't depend on what else is in data.
        place = np.uint64((1 << 31) - 1)
        least = gram & ~place | np.arange(len(gram), dtype=np.uint64)
        width = 1
        while width * 2 <= WINDOW:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = WINDOW - width
        least = np.minimum(least[: len(least) - rest], least[rest:])
        # Window starts inside one document.
        inner = np.repeat(sizes >= WIDTH, sizes)
        ends = np.repeat(at[1:], sizes)
        last = inner & (np.arange(n) + WIDTH <= ends)
        starts = np.flatnonzero(last)
        anchor = (least[starts] & place).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        begin, anchor = starts[first], anchor[first]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * _powers(_BASE, n), dtype=np.uint64)])
        back = _powers(_INVERSE, n)
        body = (total[begin + count + WIDTH - 1] - total[begin]) * back[begin]
        doc = np.searchsorted(at, begin, "right") - 1
        out = np.empty(len(begin), _SEGMENT)
        out["key"], out["doc"], out["at"], out["n"], out["rel"] = gram[anchor], docs[doc], begin - at[doc], count, anchor - begin
        out["body"] = mixed(body + out["rel"] * np.uint64(0x632BE59BD9B4E019) + count.astype(np.uint64), 7)
        # The sides that some window of the segment holds whole.
        for side, lo, has in (("left", anchor - SIDE, out["rel"] >= SIDE), ("right", anchor + GRAM, out["rel"].astype(np.int64) - count < SIDE - 1)):
            out[side] = 0
            out[side][has] = _side(total, back, lo[has], 11)
    return out


def _side(total: np.ndarray, back: np.ndarray, lo: np.ndarray, seed: int) -> np.ndarray:
    """A hash of 32 bits, never 0, of the SIDE letters from lo on."""
    with np.errstate(over="ignore"):
        return (mixed((total[lo + SIDE] - total[lo]) * back[lo], seed) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _same(a: np.ndarray, *names: str) -> np.ndarray:
    """Which rows of a sorted array equal the one before in the given fields."""
    out = np.zeros(len(a), bool)
    out[1:] = np.logical_and.reduce([a[c][1:] == a[c][:-1] for c in names])
    return out


def _ordered(rows: np.ndarray) -> np.ndarray:
    """Segments by string and place; repeated rows of one document count once."""
    rows = rows[np.lexsort((rows["at"], rows["doc"], rows["body"], rows["key"]))]
    return rows[~_same(rows, "key", "body", "doc", "at")]


def _shared(key: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which rows have a side (not 0) that another row with their key has too."""
    order = np.lexsort((side, key))
    k, s = key[order], side[order]
    equal = (k[1:] == k[:-1]) & (s[1:] == s[:-1]) & (s[1:] > 0)
    out = np.zeros(len(key), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


def pieces(rows: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment, the runs of windows whose anchors stand at offsets of one multiple of `step`, keyed by that; the row each is of.

    Equal windows have their anchor at the same offset, so they stay together."""
    low, high = (rows["rel"].astype(np.int64) - rows["n"] + 1) // step, rows["rel"].astype(np.int64) // step
    count = high - low + 1
    of = np.repeat(np.arange(len(rows)), count)
    part = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + low[of]
    out = rows[of]
    rel = out["rel"].astype(np.int64)
    begin = np.maximum(0, rel - (step * part + step - 1))
    end = np.minimum(out["n"].astype(np.int64) - 1, rel - step * part)
    with np.errstate(over="ignore"):
        out["key"] = mixed(out["key"] + part.astype(np.uint64) * np.uint64(_BASE), 5)
    out["at"], out["n"], out["rel"] = out["at"] + begin, end - begin + 1, rel - begin
    return out, of


def settle(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strings, whether each has several places, later places): segments that may hold a repeated window.

    Equal segments are one string, known by its first place; later places name it by that."""
    rows = _ordered(rows)
    again = _same(rows, "key", "body")
    first = np.flatnonzero(~again)
    of = np.cumsum(~again) - 1
    strings = rows[first]
    several = np.bincount(of, minlength=len(first)) > 1
    wanted = several | _shared(strings["key"], strings["left"]) | _shared(strings["key"], strings["right"])
    late = np.flatnonzero(again)
    later = np.empty(len(late), _LATER)
    source = strings[of[late]]
    later["key"], later["of_doc"], later["of_at"], later["doc"], later["at"] = source["key"], source["doc"], source["at"], rows["doc"][late], rows["at"][late]
    # Strings under one very frequent anchor are dealt out by the anchor's offset in their windows.
    wanted_rows = strings[wanted]
    several = several[wanted]
    same = _same(wanted_rows, "key")
    group = np.cumsum(~same) - 1
    hot = np.bincount(group, minlength=1)[group] > HOT_STRINGS if len(group) else same
    if hot.any():
        hot_keys = np.unique(wanted_rows["key"][hot])
        parts, of_part = pieces(wanted_rows[hot], HOT_STEP)
        is_hot = np.isin(later["key"], hot_keys)
        moved = _shifted(later[is_hot], wanted_rows[hot], parts, of_part)
        several = np.concatenate([several[~hot], several[hot][of_part]])
        wanted_rows = np.concatenate([wanted_rows[~hot], parts])
        later = np.concatenate([later[~is_hot], moved])
    return wanted_rows, several, later


def _shifted(later: np.ndarray, whole: np.ndarray, parts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Later places of whole strings as places of their pieces."""
    number = _index(whole["doc"], whole["at"], later["of_doc"], later["of_at"])
    count = np.bincount(of, minlength=len(whole))
    first = np.cumsum(count) - count
    each = np.repeat(np.arange(len(later)), count[number])
    part = np.arange(len(each)) - np.repeat(np.cumsum(count[number]) - count[number], count[number]) + first[number[each]]
    out = later[each]
    shift = parts["at"][part] - whole["at"][of[part]]
    out["key"], out["of_at"], out["at"] = parts["key"][part], out["of_at"] + shift, out["at"] + shift
    return out


def _index(doc: np.ndarray, at: np.ndarray, want_doc: np.ndarray, want_at: np.ndarray) -> np.ndarray:
    """Where (doc, at) holds each wanted pair; all of them occur."""
    both = np.empty(len(doc) + len(want_doc), [("doc", "<i8"), ("at", "<i8")])
    both["doc"], both["at"] = np.concatenate([doc, want_doc]), np.concatenate([at, want_at])
    order = np.lexsort((np.arange(len(both)) >= len(doc), both["at"], both["doc"]))
    of = np.maximum.accumulate(np.where(order < len(doc), np.arange(len(both)), 0))
    out = np.empty(len(both), np.int64)
    out[order] = order[of]
    return out[len(doc) :]


def _runs(place: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the runs of consecutive places inside one group; sorted by (of, place), without repeats."""
    new = np.ones(len(place), bool)
    new[1:] = (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1)
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, len(place)))


_FOUND = "kind byte, bucket long, blob binary, doc long, at int, n int"
REPEAT, SEGMENTS, STRINGS, LATER = 0, 1, 2, 3


def _batch(kind: int, **columns) -> pa.RecordBatch:
    """Rows of _FOUND; what isn't given is null."""
    types = {"bucket": pa.int64(), "blob": pa.binary(), "doc": pa.int64(), "at": pa.int32(), "n": pa.int32()}
    size = len(next(iter(columns.values())))
    arrays = [pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in types.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int8)), *arrays], names=["kind", *types])


def _blobs(rows: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    have, at = np.unique(bucket, return_index=True)
    return have, [rows[a:b].tobytes() for a, b in zip(at.tolist(), [*at[1:].tolist(), len(rows)])]


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(key, 3) % np.uint64(buckets)).astype(np.int64)


def _docs(documents: DataFrame) -> DataFrame:
    return documents.select(F.col(ROW).cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where("doc is not null")


def _known_here(rows: np.ndarray, texts: dict[int, bytes]) -> np.ndarray:
    """Which rows, ordered, are byte for byte the same segment as an earlier one of the batch."""
    out = _same(rows, "key", "body")
    late = np.flatnonzero(out)
    first = np.maximum.accumulate(np.where(out, 0, np.arange(len(rows))))[late]
    for k, x, y in zip(late.tolist(), rows[first].tolist(), rows[late].tolist()):
        # Fields: key, body, doc, at, left, right, n, rel.
        out[k] = texts[x[2]][x[3] : x[3] + x[6] + WIDTH - 1] == texts[y[2]][y[3] : y[3] + y[6] + WIDTH - 1]
    return out


def scanned(documents: DataFrame, buckets: int) -> DataFrame:
    """Of each batch of texts, the segments by bucket; those that equal another one of the batch are known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, whole = batch.column(0).to_numpy(), text_bytes(batch.column(1))
            # Small pieces, as hashing takes some hundred bytes of memory for each byte of text.
            found = [segments(*packed(texts), part.column(0).to_numpy()) for part, texts in slices(batch, whole, 1 << 20) if part.num_rows]
            if not found:
                continue
            rows = _ordered(np.concatenate(found))
            later = _known_here(rows, dict(zip(docs.tolist(), whole)))
            again, rows = rows[later], rows[~later]
            if len(again):
                yield _batch(REPEAT, bucket=_bucket(again["doc"].view(np.uint64), buckets), doc=again["doc"], at=again["at"], n=again["n"].astype(np.int32))
            if len(rows):
                have, blobs = _blobs(rows, _bucket(rows["key"], buckets))
                yield _batch(SEGMENTS, bucket=have, blob=blobs)

    return _docs(documents).mapInArrow(trimmed(run), _FOUND)


def settled(scan: DataFrame, partitions: int, buckets: int) -> DataFrame:
    """The strings to merge (doc, at, n, and 256 more in n for those with several places), their later places, and what the scan knew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            if (kind == REPEAT).any():
                yield batch.filter(pa.array(kind == REPEAT))
            blobs += batch.filter(pa.array(kind == SEGMENTS)).column(2).to_pylist()
        if not blobs:
            return
        rows = np.frombuffer(b"".join(blobs), _SEGMENT)
        blobs = []
        strings, several, later = settle(rows)
        del rows
        bucket = _bucket(strings["key"], buckets)
        for lo in range(0, len(strings), 50_000):
            p = strings[lo : lo + 50_000]
            yield _batch(STRINGS, bucket=bucket[lo : lo + 50_000], doc=p["doc"], at=p["at"], n=p["n"].astype(np.int32) + 256 * several[lo : lo + 50_000])
        for lo in range(0, len(later), 200_000):
            p = later[lo : lo + 200_000]
            have, out = _blobs(p, _bucket(p["key"], buckets))
            yield _batch(LATER, bucket=have, blob=out)

    return scan.repartition(partitions, "bucket").mapInArrow(trimmed(run), _FOUND)


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The Burrows-Wheeler transform of a shard, with two letters before each suffix, and the place of each suffix.

    Letters are bytes + 1; 0 ends each string, the ends in the order given. Suffixes are sorted by 5 letters, then by
    twice as many each time, and only those still tied are looked at again. Rows of at most 2^21 letters."""
    letters = np.frombuffer(b"\x00".join([s.translate(_SHIFTED) for s in strings]) + b"\x00", np.uint8)
    n = len(letters)
    bits = np.uint64(n.bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    ends = np.flatnonzero(letters == 0)
    left = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(n) + 1
    value = letters.astype(np.uint64)
    for k in range(1, 5):
        behind = np.zeros(n, np.uint64)
        behind[:-k] = letters[k:]
        behind[left <= k] = 0
        value = value << np.uint64(8) | behind
    # A sort of numbers that carry their place is much faster than one that returns an order.
    if int(bits) <= 24:
        row = np.sort(value << bits | np.arange(n, dtype=np.uint64))
        order, value = (row & mask).astype(np.int64), row >> bits
    else:
        order = np.argsort(value, kind="stable")
        value = value[order]
    rank = np.empty(n, np.int64)
    slots, depth = np.arange(n), 5
    starts = np.concatenate([[True], value[1:] != value[:-1]])
    while True:
        # The rank of a suffix is the place where its tied group begins.
        group = slots[np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))]
        rank[order[slots]] = group
        tied = ~starts
        tied[:-1] |= ~starts[1:]
        slots, group = slots[tied], group[tied]
        if not len(slots) or depth >= int(left[order[slots]].max()):
            break
        here = order[slots]
        far = left[here] > depth
        behind = np.zeros(len(here), np.uint64)
        behind[far] = rank[here[far] + depth] + 1
        key = group.astype(np.uint64) << bits | behind
        turn = np.sort(key << bits | here.astype(np.uint64)) if 3 * int(bits) <= 64 else None
        if turn is None:
            by = np.lexsort((here, key))
            order[slots], key = here[by], key[by]
        else:
            order[slots], key = (turn & mask).astype(np.int64), turn >> bits
        starts = np.concatenate([[True], key[1:] != key[:-1]])
        depth *= 2
    before = np.concatenate([letters[-2:], letters]).astype(np.uint16)
    return (before[:n] << np.uint16(8) | before[1 : n + 1])[order], order.astype(np.int32)


def steps(codes: np.ndarray) -> np.ndarray:
    """The LF step of each row of a transform: the row whose suffix begins with this row's letters, by counting them."""
    out = np.empty(len(codes), np.int32)
    out[np.argsort(codes, kind="stable")] = np.arange(len(codes), dtype=np.int32)
    return out


def merged(shards: list[tuple[np.ndarray, np.ndarray]], lengths: np.ndarray, several: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The repeated intervals of the shards' union: string and offset of windows, interval by interval, and the interval of each.

    lengths and several go by string, through all shards. A window of a string that has several places is an interval by itself."""
    base = np.cumsum([0, *[len(c) for c, _ in shards]])
    codes = np.concatenate([c for c, _ in shards])
    step = np.concatenate([steps(c) + np.int32(b) for (c, _), b in zip(shards, base)])
    place = np.concatenate([p.astype(np.int64) + b for (_, p), b in zip(shards, base)])
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    string = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
    # The interleave: rows of one shard after the other; of those, only suffixes behind a whole window matter.
    row = np.flatnonzero(place - begin[string[place]] >= width).astype(np.int32)
    block = np.zeros(len(row), np.int64)
    alone: list[np.ndarray] = []
    for depth in range(2, width + 1, 2):
        symbol = codes[row]
        turn = np.argsort(symbol, kind="stable")
        symbol, block = symbol[turn], block[turn]
        row = step[row[turn]]
        border = np.ones(len(row) + 1, bool)
        border[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        single = border[1:] & border[:-1]
        block = np.cumsum(border[:-1])
        if single.any():
            out = place[row[single]]
            alone.append(out[several[string[out]]] - (width - depth))
            row, block = row[~single], block[~single]
        if not len(row):
            break
    start = np.concatenate([place[row], *alone])
    interval = np.concatenate([block, np.arange(len(start) - len(block)) + (int(block[-1]) + 1 if len(block) else 0)])
    which = string[start].astype(np.int64)
    return which, start - begin[which], interval


def repeated(strings: np.ndarray, texts: list[bytes], later: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first window, number of windows) of all that starts earlier too, of one bucket's strings and their later places."""
    none = np.zeros(0, np.int64)
    if not len(strings):
        return none, none, none
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    count = max(1, -(-int((lengths + 1).sum()) // SHARD))
    # Dealt out one by one, so that strings that came together meet in the merge.
    deal = np.concatenate([np.arange(k, len(texts), count) for k in range(count)])
    shards = [transform([texts[i] for i in range(k, len(texts), count)]) for k in range(min(count, len(texts)))]
    strings, lengths = strings[deal], lengths[deal]
    which, offset, interval = merged(shards, lengths, strings["n"] > 255)
    del shards
    doc, at = strings["doc"][which], strings["at"][which] + offset
    turn = np.lexsort((at, doc, interval))
    turn = turn[1:][interval[turn[1:]] == interval[turn[:-1]]]
    doc, at = doc[turn], at[turn]
    turn = np.lexsort((at, doc))
    doc, at = doc[turn], at[turn]
    start, size = _runs(at, doc)
    out = [(doc[start], at[start], size)]
    if len(later):
        turn = np.lexsort((offset, which))
        which, offset = which[turn], offset[turn]
        start, size = _runs(offset, which)
        first, count = np.searchsorted(which[start], np.arange(len(strings))), np.bincount(which[start], minlength=len(strings))
        number = _index(strings["doc"], strings["at"], later["of_doc"], later["of_at"])
        each = np.repeat(np.arange(len(later)), count[number])
        run = np.arange(len(each)) - np.repeat(np.cumsum(count[number]) - count[number], count[number]) + first[number[each]]
        out.append((later["doc"][each], later["at"][each] + offset[start[run]], size[run]))
    return tuple(np.concatenate([x[k] for x in out]).astype(np.int64) for k in range(3))


_TO_MERGE = "bucket long, rows binary, text binary"


def strings_of(documents: DataFrame, strings: DataFrame) -> DataFrame:
    """(bucket, strings, their bytes): of each batch of texts, the strings that go to each bucket."""
    wanted = strings.groupBy("doc").agg(F.collect_list(F.struct("bucket", "at", "n")).alias("wanted"))
    ids = staged(wanted, "wanted")
    docs = _docs(documents)
    if ids.count() <= BROADCAST_IDS:
        docs = docs.join(F.broadcast(ids.select("doc")), "doc", "left_semi")
    both = docs.dropDuplicates(["doc"]) if REPEATED in documents.columns else docs
    both = both.join(ids, "doc").select("doc", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(1))):
                if not part.num_rows:
                    continue
                column = part.column(2)
                count = np.diff(column.offsets.to_numpy())
                fields = column.flatten().flatten()
                bucket, at, n = (x.to_numpy() for x in fields)
                rows = np.empty(len(bucket), _STRING)
                of = np.repeat(np.arange(part.num_rows), count)
                rows["doc"], rows["at"], rows["n"] = part.column(0).to_numpy()[of], at, n
                order = np.argsort(bucket, kind="stable")
                have, first = np.unique(bucket[order], return_index=True)
                blobs, bodies = [], []
                size = (n & 255) + (WIDTH - 1)
                for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
                    pick = order[a:b]
                    blobs.append(rows[pick].tobytes())
                    bodies.append(b"".join([texts[d][x : x + s] for d, x, s in zip(of[pick].tolist(), at[pick].tolist(), size[pick].tolist())]))
                yield pa.RecordBatch.from_arrays([pa.array(have, pa.int64()), pa.array(blobs, pa.binary()), pa.array(bodies, pa.binary())], names=["bucket", "rows", "text"])

    return both.mapInArrow(trimmed(run), _TO_MERGE)


def repeats(to_merge: DataFrame, partitions: int) -> DataFrame:
    """From the merged shards of each bucket, the places (doc, at, n) of windows that start earlier too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, tuple[list[bytes], list[bytes], list[bytes]]] = {}
        for batch in batches:
            for bucket, rows, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                strings, bodies, later = by_bucket.setdefault(bucket, ([], [], []))
                if text is None:
                    later.append(rows)
                else:
                    strings.append(rows)
                    bodies.append(text)
        while by_bucket:
            strings, bodies, later = by_bucket.popitem()[1]
            rows, body = np.frombuffer(b"".join(strings), _STRING), b"".join(bodies)
            ends = np.cumsum((rows["n"] & 255).astype(np.int64) + WIDTH - 1)
            texts = [body[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
            del body, strings, bodies
            doc, at, n = repeated(rows, texts, np.frombuffer(b"".join(later), _LATER))
            for lo in range(0, len(doc), 50_000):
                part = slice(lo, lo + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(doc[part]), pa.array(at[part], pa.int32()), pa.array(n[part], pa.int32())], names=["doc", "at", "n"])

    return to_merge.repartition(partitions, "bucket").mapInArrow(trimmed(run), "doc long, at int, n int")


def cut(text: bytes, places: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without what windows starting at the places (first, number) cover, and the removed spans."""
    spans: list[list[int]] = []
    for at, n in sorted(places):
        if spans and at <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], at + n - 1 + WIDTH)
        else:
            spans.append([at, at + n - 1 + WIDTH])
    kept, last = [], 0
    for a, b in spans:
        kept.append(text[last:a])
        last = b
    return b"".join([*kept, text[last:]]), [(a, b) for a, b in spans]


def characters(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans and without the characters that a border of a span halves."""
    kept, last = [], 0
    for a, b in spans:
        while last < a < len(text) and text[a] & 0xC0 == 0x80:
            a -= 1
        kept.append(text[last:a])
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b += 1
        last = b
    return b"".join([*kept, text[last:]])


def _numbered(documents: DataFrame, repeated_ids: bool) -> DataFrame:
    """The documents with their place in the order as ROW: doc_id, or where ids repeat a number by doc_id and text (equal rows: the same)."""
    key = F.col("doc_id").cast("long")
    if not repeated_ids:
        return documents.withColumn(ROW, key)
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    rows = documents.withColumn(REPEATED, digest).withColumn("__id", key).repartitionByRange("__id", REPEATED).sortWithinPartitions("__id", REPEATED)
    rows = staged(rows.withColumn("__n", F.monotonically_increasing_id()), "documents")
    first = rows.where("__id is not null").groupBy("__id", REPEATED).agg(F.min("__n").alias(ROW))
    return rows.join(first, ["__id", REPEATED], "left").drop("__id", "__n")


def deduplicated(documents: DataFrame, whole_characters: bool = False) -> DataFrame:
    """All columns of the documents, with __n_bytes, __n_removed, __starts and __ends of the removed spans, and the __kept bytes (or characters); columns that have these names give way."""
    rows, back = carried(documents.drop(*RESULTS), "doc_id", "text")
    return _marked(rows, whole_characters).select(*back, *RESULTS)


def _marked(documents: DataFrame, whole_characters: bool = False) -> DataFrame:
    """The same for documents whose other columns are carried in one."""
    spark = documents.sparkSession
    arrow_batches(spark)
    by_id = documents.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    total, most = by_id.agg(F.coalesce(F.sum("size"), F.lit(0)), F.max(F.when(F.col("id").isNotNull(), F.col("n")))).first()
    docs = _numbered(documents, (most or 0) > 1)
    partitions = max(spark.sparkContext.defaultParallelism, -(-total // (STRIDE * ENTRIES_PER_BUCKET)))
    found = staged(settled(scanned(docs, MERGES * partitions), partitions, MERGES * partitions), "segments")
    strings = strings_of(docs, found.where(F.col("kind") == STRINGS).select("bucket", "doc", "at", "n"))
    later = found.where(F.col("kind") == LATER).select("bucket", F.col("blob").alias("rows"), F.lit(None).cast("binary").alias("text"))
    more = repeats(strings.unionAll(later), partitions)
    places = found.where(F.col("kind") == REPEAT).select("doc", "at", "n").union(more)
    places = staged(places.groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("__places")), "places")

    own = documents.columns
    docs = docs.select(*own, ROW)
    none = docs.withColumn("__places", F.lit(None).cast(places.schema["__places"].dataType))
    if places.count() <= BROADCAST_IDS:
        # Only documents that lose something are moved; the rest stay where they were read.
        ids = F.broadcast(places.select("doc"))
        some = docs.join(ids, F.col(ROW) == ids["doc"], "left_semi").join(places, F.col(ROW) == places["doc"])
        both = some.select(*own, "__places").unionAll(none.join(ids, F.col(ROW) == ids["doc"], "left_anti").select(*own, "__places"))
    else:
        both = docs.join(places, F.col(ROW) == places["doc"], "left").select(*own, "__places")
    at = own.index("text")
    full = spark.createDataFrame([], ", ".join(f"{c} {kind}" for c, kind in RESULTS.items())).schema
    out = type(full)([*documents.schema.fields, *full.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(at))):
                done = [cut(t, [(p["at"], p["n"]) for p in places or ()]) for t, places in zip(texts, part.column(len(own)).to_pylist())]
                size = np.array([len(t) for t in texts], np.int64)
                left = np.array([len(k) for k, _ in done], np.int64)
                if whole_characters:
                    done = [(characters(t, spans), spans) for t, (_, spans) in zip(texts, done)]
                columns = [pa.array(size), pa.array(size - left), *[pa.array([[s[k] for s in spans] for _, spans in done], pa.list_(pa.int32())) for k in (0, 1)], pa.array([k for k, _ in done], pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=out.names)

    return both.mapInArrow(trimmed(run), out)


def op5_bwt_dedup(spark, sf_dir: str) -> DataFrame:
    out = _marked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"), F.size("__starts").cast("long").alias("n_spans"), F.sha2("__kept", 256).alias("kept_sha256"))


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents with repeated strings cut out of their texts; those that lose all their bytes go."""
    rows, back = carried(documents, "doc_id", "text", "n_chars")
    # A cut can fall inside a character; what is left of it goes too.
    out = _marked(rows, whole_characters=True)
    text = F.when(F.col("__n_removed") == 0, F.col("text")).otherwise(F.make_valid_utf8(F.col("__kept").cast("string")))
    out = out.where("__n_removed = 0 or __n_removed < __n_bytes").withColumn("text", text)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("__n_removed") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(documents.schema["n_chars"].dataType))
    return out.select(*back)


def brute_force(rows: list[tuple[int, bytes]]) -> dict[int, tuple[int, int, int, str]]:
    """doc_id to (bytes, removed, spans, digest of the rest), window by window; for tests."""
    import hashlib

    seen: set[bytes] = set()
    out = {}
    for doc, text in sorted(rows):
        hit = [False] * len(text)
        for i in range(len(text) - WIDTH + 1):
            w = text[i : i + WIDTH]
            if w in seen:
                hit[i : i + WIDTH] = [True] * WIDTH
            seen.add(w)
        kept = bytes(c for c, h in zip(text, hit) if not h)
        out[doc] = (len(text), sum(hit), sum(1 for i, h in enumerate(hit) if h and not (i and hit[i - 1])), hashlib.sha256(kept).hexdigest())
    return out
