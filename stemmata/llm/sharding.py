"""Sharding by sampled splitters, with DataFrame functions only.

Records are ordered by the hash of their text, so equal texts stand together. A size-weighted sample of
that key gives quantile boundaries, which cut the records into many more ranges than shards. Ranges that a
large group of equal texts makes overfull are subdivided by a hash of doc_id. Exact sizes of all ranges then
place every record on the line of cumulated bytes; shard k holds the k-th of equally long parts of that
line, so no shard is off its share by more than a record, or a group that is kept whole.

Groups of equal texts stay in one shard unless they exceed 1/KEEP of a shard's bytes.

Defined cases: a null text has no bytes and the checksum of the empty text; an empty table gives no rows;
equal rows get slots one after the other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table, utf8

SHARDS = 24
RANGES_PER_SHARD = 32
#: Beyond this many records, there are more ranges, so that one range fits in one task.
ROWS_PER_RANGE = 1_000_000
OVERSAMPLE = 8
KEEP = 50


def measured(documents: DataFrame) -> DataFrame:
    text = utf8("text")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.col("doc_id").cast("string"), F.lit("place")).alias("u"),
    )


def boundaries(rows: DataFrame, ranges: int, total: int) -> list[int]:
    """Quantiles of the key over a sample in which a record has a chance in proportion to its size; about ranges * OVERSAMPLE keys."""
    draws = ranges * OVERSAMPLE
    chance = F.col("size").cast("double") * draws / F.lit(float(total))
    drawn = F.pmod(F.xxhash64("u", "h", F.lit(7)), F.lit(1 << 53)) / float(1 << 53) < chance
    sample = sorted((r[0], max(1.0, r[1])) for r in rows.where(drawn).select("h", chance).collect())
    weight, step, upto, found = sum(w for _, w in sample), 0, 0.0, []
    for h, w in sample:
        upto += w
        if upto * ranges >= weight * (step + 1):
            step = int(upto * ranges / weight)
            found.append(h)
    return sorted(set(found))


def ranged(rows: DataFrame, bounds: list[int], bits: int) -> DataFrame:
    """Adds `range`, the number of boundaries at or below the key: looked up among the few in the key's slice of the hash space."""
    spark = rows.sparkSession
    slices: dict[int, list[int]] = {}
    for b in bounds:
        slices.setdefault(b >> (64 - bits), []).append(b)
    below, look = 0, []
    for s in range(-(1 << (bits - 1)), 1 << (bits - 1)):
        look.append((s, below, slices.get(s, [])))
        below += len(slices.get(s, []))
    # 2^bits rows, about two for each range.
    look_up = F.broadcast(spark.createDataFrame(look, "slice long, below int, cuts array<long>"))
    inside = F.size(F.filter("cuts", lambda c: c <= F.col("h")))
    return rows.withColumn("slice", F.shiftright("h", 64 - bits)).join(look_up, "slice").withColumn("range", F.col("below") + inside).drop("slice", "below", "cuts")


def sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document, under the law `bytes`."""
    spark = documents.sparkSession
    rows = staged(measured(documents), "sized")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    empty = rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    if not n:
        return empty.where("false")
    ranges = max(shards * RANGES_PER_SHARD, -(-n // ROWS_PER_RANGE))
    share, share_rows = total / ranges, max(1, n / ranges)
    rows = ranged(rows, boundaries(rows, ranges, total), max(4, (2 * ranges - 1).bit_length()))

    # Groups that alone overfill a range; at most 2 * ranges of them reach half a share of bytes or of rows.
    groups = rows.groupBy("h").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where((F.col("bytes") > share) & (F.col("n") > 1) | (F.col("n") > 2 * share_rows))
    parts = F.ceil(F.greatest(F.col("bytes") / F.lit(share), F.col("n") / F.lit(share_rows)))
    heavy = F.broadcast(groups.select("h", parts.cast("int").alias("parts")))
    place = F.pmod(F.xxhash64("u", F.lit(11)), F.lit(1 << 31)).cast("double") / float(1 << 31)
    cell = rows.join(heavy, "h", "left").withColumn("part", F.coalesce(F.floor(place * F.col("parts")).cast("int"), F.lit(-1)))
    cell = cell.withColumn("group", F.when(F.col("part") >= 0, F.col("h")).otherwise(F.lit(0))).drop("parts")

    # The cells in order, with what lies before each: a few for each range, whatever the number of records.
    keys = ["range", "group", "part"]
    stats = sorted(cell.groupBy(*keys).agg(F.sum("size"), F.count("*")).collect(), key=lambda r: (r[0], r[2] >= 0, r[1], r[2]))
    before, ahead, place_of = 0, 0, []
    for k, r in enumerate(stats):
        place_of.append((r[0], r[1], r[2], k, before, ahead))
        before, ahead = before + r[3], ahead + r[4]
    cells = F.broadcast(spark.createDataFrame(place_of, "range int, group long, part int, cell int, bytes_before long, rows_before long"))
    cell = cell.join(cells, keys)

    in_cell = Window.partitionBy("cell").orderBy("h", "u", "doc_id", "size", "text_crc32")
    of_text = Window.partitionBy("cell", "h")
    upto = F.col("bytes_before") + F.sum("size").over(in_cell.rowsBetween(Window.unboundedPreceding, 0))
    placed = cell.withColumn("upto", upto).withColumn("rank", F.col("rows_before") + F.row_number().over(in_cell) - 1)
    placed = placed.withColumn("group_bytes", F.sum("size").over(of_text)).withColumn("group_end", F.max("upto").over(of_text))
    whole = (F.col("part") < 0) & (F.col("group_bytes") * KEEP * shards <= total)
    middle = F.when(whole, F.col("group_end") - F.col("group_bytes") / 2).otherwise(F.col("upto") - F.col("size") / 2)
    shard = F.least(F.floor(middle * shards / F.lit(float(total))), F.lit(shards - 1)).cast("int")
    placed = staged(placed.select("doc_id", "size", "text_crc32", "rank", shard.alias("shard")), "placed")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("first")))
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    out = sharded(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
