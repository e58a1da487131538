"""The prefix trie of conversations, made of mergeable partial tries.

Turns are sorted over all partitions by (conv_id, turn, role, text), so a conversation of any length is dealt out, and each turn
is from then on two hashes and a number of words. A node is known by its depth and an exclusive-or of 2 x 64 bits over its turns,
each hashed with its position: the running one of a rebuilt conversation gives all its nodes. Partial tries hold the nodes of a
block of conversation numbers: members, least member, and the members that end there. Merges keyed by the nodes' hashes put blocks
together, FAN_IN at a time, adding up members; lists of ends stay in pieces of one block each and are hashed in a stream.

A node's least member m and its depth name it: the nodes of one m are a chain, whose top hangs on an earlier conversation's node.
So the rollup is made in two steps: totals of whole chains by doubling (a round for each power of two of the height of the tree of
chains), then suffix sums along each chain, in blocks.

Defined cases: null role or text counts as empty; a null turn comes first; turns of one number go by role, then text; rows of a null
conv_id take no part; repeated rows are turns of their own; a conversation that keeps no turn is a member of the root alone; extra columns
are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, staged, table, trimmed

#: Conversation numbers of one partial trie, and how many tries one merge puts together, as powers of two.
BLOCK_BITS, FAN_IN_BITS = 12, 6
#: Positions of one block of a running sum, as a power of two.
RUN_BITS = 12
#: Rows of one key from which it is looked up apart: the greater of this number and a ten-thousandth of all rows, so there are 10,000 such keys at most.
HOT_ROWS, HOT_SHARE = 100_000, 10_000
WORD = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "key1", "key2"]


def looked_up(rows: DataFrame, one_each: DataFrame, on: list[str]) -> DataFrame:
    """rows with the columns of a table of one row for each key, null where it has none. Keys of very many rows meet a broadcast."""
    counts = rows.groupBy(*on).agg(F.count("*").alias("__n"))
    total = rows.count()
    hot = counts.where(F.col("__n") > max(HOT_ROWS, total // HOT_SHARE)).drop("__n")
    if hot.isEmpty():
        return rows.join(one_each, on, "left")
    hot = F.broadcast(staged(hot, "hot"))
    apart = rows.join(hot, on, "left_semi").join(F.broadcast(one_each.join(hot, on, "left_semi")), on, "left")
    return rows.join(hot, on, "left_anti").join(one_each, on, "left").unionByName(apart)


def running(rows: DataFrame, key: str, place: str, sums: dict[str, Column], function, reverse: bool = False) -> DataFrame:
    """Adds running aggregates by key in the order of place: in blocks of places, with what the blocks before come to."""
    block = F.shiftright(place, RUN_BITS)
    rows = rows.withColumn("__block", block)
    order = (lambda c: F.desc(c)) if reverse else F.col
    within = Window.partitionBy(key, "__block").orderBy(order(place)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(order("__block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(key, "__block").agg(*[function(c).alias(f"__{k}") for k, c in sums.items()])
    carry = totals.select(key, "__block", *[F.coalesce(function(f"__{k}").over(before), F.lit(0)).alias(f"__before_{k}") for k in sums])
    both = rows.withColumns({k: function(c).over(within) for k, c in sums.items()}).join(carry, [key, "__block"])
    add = Column.bitwiseXOR if function is F.bit_xor else Column.__add__
    return both.withColumns({k: add(F.col(k), F.col(f"__before_{k}")) for k in sums}).drop("__block", *[f"__before_{k}" for k in sums])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, id, h1, h2 and words of each turn; ids rise with the turns' order, in which a part is one stretch."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role"), text("text"))
    # Long texts of equal turns needn't be sampled whole; rows alike in all are still told apart.
    rows = rows.withColumns({"__head": F.left("text", F.lit(200)), "__row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange("conv_id", "turn", "role", "__head", "__row").sortWithinPartitions("conv_id", "turn", "role", "text")
    hashed = rows.select("conv_id", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    return staged(hashed.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33)), "turns")


def rebuilt(turns: DataFrame, group: int, most: int) -> DataFrame:
    """conv_id, position (0: before the first turn), h1, h2, words and whether it is the last of every turn of the rebuilt conversations."""
    parts = turns.groupBy("conv_id", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "parts")
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("length"))
    convs = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "taken": F.crc32(F.col("conv_id").cast("string")) % (most + 1)})
    convs = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length")), "base", "left")
    convs = convs.withColumn("head", F.least("taken", F.coalesce("base_length", F.lit(0))))
    convs = staged(convs.withColumn("last", F.col("head") + F.greatest(F.col("length") - F.col("taken"), F.lit(0))), "conversations")

    parts = parts.join(convs.select("conv_id", "taken", "head", "last"), "conv_id")
    ranked = turns.join(parts, ["conv_id", "part"]).withColumn("rank", F.col("id") - F.col("first") + F.col("before") + 1)
    own = ranked.where("rank > taken").select("conv_id", (F.col("head") + F.col("rank") - F.col("taken")).alias("position"), "h1", "h2", "words", "last")
    heads = ranked.where((F.col("rank") <= most) & (F.col("conv_id") % group == 0)).select(F.col("conv_id").alias("base"), F.col("rank").alias("position"), "h1", "h2", "words")
    borrowed = convs.where("head > 0").join(heads, "base").where("position <= head").select("conv_id", "position", "h1", "h2", "words", "last")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("position"), zero.alias("h1"), zero.alias("h2"), zero.alias("words"), "last")
    rows = own.unionByName(borrowed).unionByName(roots)
    return rows.select("conv_id", "position", "h1", "h2", "words", (F.col("position") == F.col("last")).alias("ends"))


def partial_tries(rows: DataFrame) -> DataFrame:
    """The nodes of each block of conversations, with their members' number, the least of them, and a list of those that end there."""
    at = lambda seed, h: F.when(F.col("position") > 0, F.xxhash64(F.lit(seed), "position", h)).otherwise(F.lit(0))
    keyed = running(rows.withColumns({"g1": at(3, "h1"), "g2": at(4, "h2")}), "conv_id", "position", {"key1": F.col("g1"), "key2": F.col("g2")}, F.bit_xor)
    keyed = keyed.withColumns({"up1": F.col("key1").bitwiseXOR(F.col("g1")), "up2": F.col("key2").bitwiseXOR(F.col("g2")), "depth": F.col("position"), "block": F.shiftright("conv_id", BLOCK_BITS)})
    return keyed.groupBy("block", *_NODE).agg(
        F.count("*").alias("n"), F.min(F.struct("conv_id", "ends")).alias("least"), F.max("words").alias("words"), F.max("up1").alias("up1"), F.max("up2").alias("up2"),
        F.sort_array(F.collect_list(F.when(F.col("ends"), F.col("conv_id")))).alias("ended"),
    )


def merged(tries: DataFrame) -> DataFrame:
    """One trie of the partial ones: rounds of hash-keyed merges, each of FAN_IN neighbours."""
    lo, hi = tries.agg(F.min("block"), F.max("block")).first()
    nodes, width = tries.drop("ended").withColumn("block", F.col("block") - (lo or 0)), (hi or 0) - (lo or 0)
    while True:
        width >>= FAN_IN_BITS
        nodes = nodes.groupBy(F.shiftright("block", FAN_IN_BITS).alias("block"), *_NODE).agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.max("words").alias("words"), F.max("up1").alias("up1"), F.max("up2").alias("up2")
        )
        if not width:
            return nodes.drop("block")


def end_digests(tries: DataFrame) -> DataFrame:
    """The digest of the ends of each node that has some: of one piece at once, of several in a stream over the sorted pieces, which holds one of them."""
    arrow_batches(tries.sparkSession)
    pieces = tries.where(F.size("ended") > 0).select(*_NODE, "block", F.array_join(F.col("ended").cast("array<string>"), ",").alias("ids"))
    by_node = pieces.groupBy(*_NODE).agg(F.count("*").alias("n"), F.max("ids").alias("ids"))
    several = by_node.where("n > 1").select(*_NODE)
    sorted_pieces = pieces.join(several, _NODE, "left_semi").repartition(*_NODE).sortWithinPartitions(*_NODE, "block").select(*_NODE, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        made = lambda: pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in now], pa.array([digest.hexdigest()])], names=[*_NODE, "ends_sha256"])
        for batch in batches:
            for *node, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    yield made()
                now, digest = node, hashlib.sha256(ids.encode())
        if now is not None:
            yield made()

    streamed = sorted_pieces.mapInArrow(trimmed(run), "depth long, key1 long, key2 long, ends_sha256 string")
    return by_node.where("n = 1").select(*_NODE, F.sha2("ids", 256).alias("ends_sha256")).unionByName(streamed)


def chain_totals(chains: DataFrame) -> DataFrame:
    """m and its whole subtree's leaves and saved, of chains (m, up, leaves, saved): each round adds what hangs twice as far below."""
    state = chains
    while True:
        state = staged(state, "chains")
        below = state.where("up is not null")
        if below.isEmpty():
            return state.select("m", "leaves", "saved")
        gained = below.groupBy(F.col("up").alias("m")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = looked_up(state.select("m", "up"), state.where("up is not null").select(F.col("m").alias("up"), F.col("up").alias("next")), ["up"])
        state = state.drop("up").join(gained, "m", "left").join(further.select("m", F.col("next").alias("up")), "m").select(
            "m", "up", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")
        )


def prefix_trie(conversations: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """The nodes of the trie of all conversations, each with up to `most` first turns taken from the first of its group of numbers."""
    tries = staged(partial_tries(rebuilt(numbered_turns(conversations), group, most)), "tries")
    nodes = merged(tries).join(end_digests(tries), _NODE, "left")
    own = F.col("words") * (F.col("n") - 1)
    nodes = nodes.select(*_NODE, "up1", "up2", "n", F.col("least.conv_id").alias("m"), (~F.col("least.ends")).alias("goes_on"), own.alias("own"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    nodes = staged(nodes, "nodes")

    # The top of each chain, and the node it hangs on.
    tops = nodes.groupBy("m").agg(F.min("depth").alias("top"), F.min_by("up1", "depth").alias("key1"), F.min_by("up2", "depth").alias("key2"))
    tops = staged(tops.withColumn("depth", F.col("top") - 1), "tops")
    tops = staged(looked_up(tops, nodes.select(*_NODE, F.col("m").alias("up")), _NODE).select("m", "top", "up", "depth"), "hung")
    hung = tops.where("up is not null")
    children = hung.groupBy(F.col("up").alias("m"), "depth").agg(F.count("*").alias("hanging"))
    nodes = nodes.join(children, ["m", "depth"], "left").withColumn("n_children", F.col("goes_on").cast("long") + F.coalesce("hanging", F.lit(0)))
    nodes = staged(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).drop("hanging", "up1", "up2"), "children")

    sums = nodes.groupBy("m").agg(F.sum("leaf").alias("leaves"), F.sum("own").alias("saved"))
    totals = chain_totals(sums.join(tops.select("m", "up"), "m"))
    below = hung.join(totals, "m").groupBy(F.col("up").alias("m"), "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    nodes = nodes.join(below, ["m", "depth"], "left").join(tops.select("m", F.col("top").alias("depth"), "up", F.lit(True).alias("is_top")), ["m", "depth"], "left")
    value = lambda own, more: F.col(own) + F.coalesce(more, F.lit(0))
    rolled = running(nodes, "m", "depth", {"n_leaves": value("leaf", "leaves"), "saved_tokens": value("own", "saved")}, F.sum, reverse=True)
    parent = F.when(F.col("is_top"), F.col("up")).otherwise(F.col("m"))
    return rolled.select(F.col("m").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
