"""Top-k search, fill-in-the-middle and the prefix trie against brute force and edge cases; their queries against SQL are in test_llm."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stemmata.llm import fill_in_middle, prefix_trie, top_k

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# ---- 11


def searched(rows, k=10):
    use = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in use:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    whole = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    out = []
    for q, v in asked.items():
        best = sorted((-whole(sum(a * b for a, b in zip(v, w))), i) for i, w in use if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def search(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"score": F.lit("mine"), "a.b": F.lit(1)}).repartition(parts)
    return sorted(tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 100 == 0, **kw).collect())


def test_search_odd_vectors(spark):
    r = random.Random(4)
    odd = [None, [], [1.0], [None, 1.0], [float("nan"), 1.0], [float("inf")], [-float("inf"), 0.0]]
    rows = [(r.choice([None, *range(0, 500, 7), 100, 200, 200]), r.choice([*odd, *[[r.choice([-1.0, 0.0, 0.5, 0.25, -0.0004]) for _ in range(r.randint(1, 5))] for _ in range(40)]])) for _ in range(500)]
    assert search(spark, rows) == searched(rows)
    assert search(spark, []) == []
    assert search(spark, [(100, [1.0])]) == []  # no other row
    assert search(spark, [(0, [0.0]), (1, [1.0]), (2, [-1.0])]) == [(0, 1, 1, 0), (0, 2, 2, 0)]  # fewer than k, all in no list


def test_search_large_components(spark):
    rows = [(i, [float(x), 1.0]) for i, x in ((0, 3e7), (1, 3e7), (2, 1e30), (3, 2e30), (4, -1e30), (100, 3e38))]
    assert search(spark, rows, k=4) == searched(rows, 4)


def test_search_in_shards_and_blocks(spark, monkeypatch):
    """Small shards and blocks; a third of the rows are one vector."""
    monkeypatch.setattr(top_k, "BLOCK_COMPONENTS", 60)
    g = np.random.default_rng(5)
    rows = [(i, ([0.3] * 12 if i % 3 == 0 else (g.normal(size=12) / 4).tolist())) for i in range(1200)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert search(spark, rows) == searched(rows)


def test_search_skips_without_loss():
    """Shards that a better one went before: most vectors are not scored in full, none of the best is lost."""
    g = np.random.default_rng(6)
    vectors = np.floor(g.normal(size=(3000, 16)) * 300)
    query = vectors[7]
    best = top_k.Best(1, 5)
    full = []
    for lo in range(0, 3000, 500):
        shard = top_k.Shard(np.arange(lo, lo + 500), vectors[lo : lo + 500])
        inner = type("Counted", (), {"__getitem__": lambda _, left, v=shard.vectors: full.append(len(left)) or v[left]})()
        shard.vectors = inner
        shard.search(0, 7, query, best)
    scores = vectors @ query
    want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if i != 7))[:5]
    assert [(-s, i) for s, i in zip(best.score[0].tolist(), best.ids[0].tolist())] == want
    assert sum(full[1:]) < 500


# ---- 12


def cut(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 80 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    r = random.Random(8)
    parts = [" ", "\n", "\t\x0b", "a", "bc", "é日", "🙂", "<P>", "<", "S>", " ", "\x85"]
    rows = [(i, "".join(r.choices(parts, [9, 3, 1, 9, 9, 3, 3, 0.1, 1, 1, 1, 1], k=r.randint(0, 40)))) for i in range(300)]
    rows += [(None, "a b c d"), (None, None), (401, None), (402, ""), (403, " \n"), (404, "x"), *[(405, "one two three")] * 40, (405, "another text of one id"), *[(i, "w " * 60_000) for i in range(410, 414)]]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int").repartition(3)
    df = df.withColumns({"n": F.lit("clash"), "first": F.lit("mine"), "__hash": F.lit("own"), "a.b": F.lit(1)})
    got = fill_in_middle.fill_in_middle(df)
    assert got.columns == ["doc_id", "text", "row", "first", "__hash", "a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = {x["row"]: x for x in got.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()}
    assert len(found) == len(rows)
    for k, (i, t) in enumerate(rows):
        x = found[k]
        assert (x["n"], x["form"], x["prefix_chars"], x["middle_chars"], x["output"]) == cut(i, t)
        assert (x["doc_id"], x["text"], x["back"], x["first"], x["__hash"], x["a.b"]) == (i, t, t or "", "mine", "own", 1)
    assert {x["form"] for x in found.values()} == {"plain", "spm", "psm"}
    assert fill_in_middle.fill_in_middle(df.limit(0)).count() == 0


def test_units_stay_where_their_text_is(spark, sf_dir):
    """Units are neither joined nor summed over a shuffle of their own, which would be one row for each word."""
    plan = fill_in_middle.op12_fill_in_middle(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    lines = plan.splitlines()
    explode = next(i for i, x in enumerate(lines) if "posexplode" in x and "Generate" in x)
    above = [x for x in lines[:explode] if "Exchange" in x and x.index("-") < lines[explode].index("-")]
    assert all("BroadcastExchange" in x or "doc_id" in x for x in above) and "CartesianProduct" not in plan


# ---- 13


def trie(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = collections.defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p], digest(p)) for p, m in members.items())


def nodes(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"depth": F.lit("mine"), "part": F.lit(1), "a.b": F.lit(2)})
    return sorted(tuple(-1 if v is None else v for v in r) for r in prefix_trie.prefix_trie(df).collect())


def test_trie_odd(spark):
    r = random.Random(3)
    ids = [None, -41, -40, -3, 0, 1, 2, 19, 20, 21, 39, 40, 77, 5000, 123456, 9999999999]
    rows = [(r.choice(ids), r.choice([None, 0, 1, 2, 3]), r.choice([None, "u", "a"]), r.choice([None, "", "x y", " z\n", "q"])) for _ in range(80)]
    assert nodes(spark, rows) == trie(rows)
    assert nodes(spark, []) == []


def test_trie_of_small_blocks_and_hot_keys(spark, monkeypatch):
    """Running sums, tries, merges and end lists in many pieces; popular nodes looked up apart; one conversation of a third of all turns."""
    for name, value in {"RUN_BITS": 2, "BLOCK_BITS": 3, "FAN_IN_BITS": 1, "HOT_ROWS": 3, "HOT_SHARE": 10**9}.items():
        monkeypatch.setattr(prefix_trie, name, value)
    r = random.Random(9)
    rows = [(c, t, "u", "same words" if c % 3 == 0 else r.choice("ab")) for c in range(200) for t in range(r.choice([0, 1, 2, 3, 9]))]
    rows += [(1000, t // 2, "u", r.choice("xy") + " " * (t % 3)) for t in range(400)] + [(1001, 0, "u", "word " * 30_000)]
    assert nodes(spark, rows) == trie(rows)


@pytest.mark.parametrize("n", [1, 200])
def test_end_lists_in_order(spark, monkeypatch, n):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2)
    rows = [(c * 20, 0, "u", "same") for c in range(n)]
    assert nodes(spark, rows) == trie(rows)
