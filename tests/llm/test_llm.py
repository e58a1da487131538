"""The training-data operators against brute force, round trips and defined edge cases."""

import hashlib
import math
import os
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from stemmata.llm import bpe, bwt_dedup, common, components, html_text, langid, licenses, ngram_join, quality, sharding, token_files, wu_manber
from stemmata.llm import queries as llm
from stemmata.llm.common import scratch, staged, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], schema)


def words(r, n, alphabet="abcdefg"):
    return " ".join("".join(r.choices(alphabet, k=r.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, short, long, repeated and equal texts, one repeated row, and columns with clashing names."""
    r = random.Random(5)
    long = words(r, 12_000)
    passage = words(r, 90)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One two"), (6, long), (7, long), (8, "x " * 400), (9, passage + " " + words(r, 60)), (10, words(r, 80) + " " + passage), (11, "é日本 " * 60), (11, "é日本 " * 60), (12, "<|endoftext|> a\r\n\x0b b"), (13, "a\n\na\nb\na")]
    df = frame(spark, texts)
    for c in ("kept", "n_bytes", "n_removed", "starts", "ends", "ids", "decoded", "score", "lang_pred", "component_id", "shard", "slot", "items", "n_words", "key", "bucket", "size", "rep", "count"):
        df = df.withColumn(c, F.lit("clash"))
    return staged(df, "odd"), texts


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "one TWO"), (4, "x x x x x x x x x x x x x"), (5, "x x x x x x x x x x x x x"), (6, "one two")], "item_id long, text string")


# ---- 1 and 6: tokens


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocab_file())


def test_bpe_equals_the_library_on_mixed_text():
    codec, lib, r = bpe.Codec(bpe.vocab_file()), library(), random.Random(2)
    assert codec.cuts.any() and codec.merger is not None
    parts = [*" \t\n\r\x0b\x0c 　'sdtab1!?é", "<|endoftext|>", "  ", "'ll", "日本", "\n\n", "  \n", "🙂"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(2000)]
    ids, at = codec.encode([t.encode() for t in texts])
    for t, a, b in zip(texts, at, at[1:]):
        want = lib.encode(t, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, repr(t)
        assert codec.decode(want) == lib.decode(want, skip_special_tokens=False)
    assert codec.decode([codec.pieces.index("é".encode()[:1])]) == "�"


def test_bpe_cuts_anywhere_and_encodes_each_fragment_alone():
    codec, lib, r = bpe.Codec(bpe.vocab_file()), library(), random.Random(12)
    parts = [*"'sStTmMdD7 \n\t\u00a0\u3000\u2009\u1680\u0085\x1c.,!?;:(){}[]#$%&-_=+/\\|<>~`^@\"", "'s", "'re", "\u2019", "日", "本", "語", "。", "、", "「", "」", "カ", "é", "ñ", "ß", "Ω", "я", "ק", "ع", "ไ", "½", "٣", "🙂", "👩‍🚀", "e\u0301", "the", "of", "ing", "qz", "<|endoftext|>", "endoftext"]
    texts = ["".join(r.choices(parts, k=r.randint(1, 40))) for _ in range(4000)]
    ids, at = codec.encode([t.encode() for t in texts])
    for t, a, b, e in zip(texts, at, at[1:], lib.encode_batch(texts, add_special_tokens=False)):
        assert ids[a:b].tolist() == e.ids, repr(t)
    text = "日本語の文章には空白がありませんが切れ目はあります" * 3
    fragments, _ = codec.fragments([text.encode()])
    assert len(fragments) > 10 and b"".join(fragments) == text.encode()
    one_by_one = [i for f in fragments for i in lib.encode(f.decode(), add_special_tokens=False).ids]
    assert one_by_one == lib.encode(text, add_special_tokens=False).ids


def test_bpe_every_token_and_cache_turnover(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    codec, lib = bpe.Codec(bpe.vocab_file()), library()
    texts = [p.decode() for p in codec.pieces if _utf8(p)][:20_000]
    for lo in range(0, len(texts), 2000):
        part = texts[lo : lo + 2000]
        ids, at = codec.encode([t.encode() for t in part])
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [e.ids for e in lib.encode_batch(part, add_special_tokens=False)]


def _utf8(p):
    try:
        p.decode()
    except UnicodeDecodeError:
        return False
    return True


def test_bpe_frames(spark, odd, nothing):
    df, texts = odd
    out = bpe.decode(bpe.encode(df, bpe.vocab_file()), bpe.vocab_file()).collect()
    lib = library()
    assert sorted((r["doc_id"], r["ids"], r["decoded"], r["key"]) for r in out) == sorted((i, lib.encode(t or "", add_special_tokens=False).ids, t or "", "clash") for i, t in texts)
    assert bpe.decode(bpe.encode(nothing, bpe.vocab_file()), bpe.vocab_file()).count() == 0
    once_through = bpe.round_trip(df, bpe.vocab_file())
    assert once_through.columns == out[0].__fields__ and sorted(map(tuple, once_through.collect()), key=str) == sorted(map(tuple, out), key=str)
    assert bpe.round_trip(nothing, bpe.vocab_file()).count() == 0


def test_a_worker_keeps_one_of_a_kind_and_forgets_the_others():
    made = []
    make = lambda x: lambda: made.append(x) or x
    assert [common.once("a", k, make(k)) for k in (1, 1, 2, 2)] == [1, 1, 2, 2] and made == [1, 2]
    common.once("b", 3, make(3))
    list(common.trimmed(iter, "a")([]))
    assert common.once("a", 2, make(2)) == 2 and common.once("b", 3, make(3)) == 3 and made == [1, 2, 3, 3]
    common.forget()


def test_token_files(spark, odd, nothing):
    df, texts = odd
    manifest = token_files.write(df, bpe.vocab_file(), scratch(spark, "t"), length=64, shard_bytes=20_000)
    assert len(manifest) > 1
    got = token_files.read(spark, manifest).orderBy("start").collect()
    lib, at = library(), 0
    for r, (i, t) in zip(got, sorted(texts, key=lambda x: x[0])):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    shard = token_files.Shard(*manifest[-1][2:4])
    tokens, mask = shard.sequence(int(shard.rows[-1]) - 1)
    assert len(tokens) == 64 and mask.sum() == (manifest[-1][4] - 1) % 64 + 1
    assert token_files.read(spark, token_files.write(nothing, bpe.vocab_file(), scratch(spark, "t"))).count() == 0


def test_shared_folder_of_a_plain_session(tmp_path):
    """A session without spark.checkpoint.dir: in a process of its own, as the setting can't be changed."""
    import subprocess
    import sys

    code = """
from pyspark.sql import SparkSession
from stemmata.llm.common import qualified, shared_dir, staged
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert staged(spark.range(3), "x").count() == 3 and shared_dir(spark) == shared_dir(spark)
assert qualified(spark, "/a/b") == "file:///a/b" and qualified(spark, "file:///a/b") == "file:///a/b"
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[2], timeout=120, env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)})


# ---- 2: quality


def test_quality_counts(spark, odd):
    df, texts = odd
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in quality.measure(df).collect()}
    assert got == {i: quality.brute_force(t) for i, t in texts}
    r = random.Random(1)
    texts = ["".join(r.choices("ab \n\t#|é", k=r.randint(0, 80))) for _ in range(300)]
    found = quality.measure_texts([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert tuple(int(found[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == quality.brute_force(t)


def test_quality_adapts_by_group_and_merges(spark, nothing):
    r = random.Random(4)
    rows = [(i, words(r, 100), "en", "plain", 0) for i in range(150)] + [(1000 + i, " ".join(w + "|" for w in words(r, 100).split()), "en", "tables", 0) for i in range(150)]
    rows += [(5000, " ".join(w + "|" for w in words(r, 100).split()), "en", "plain", 0), (5001, words(r, 100), None, None, 0)]
    kept = {x["doc_id"]: x["kept"] for x in quality.judged(staged(quality.measure(spark.createDataFrame(rows, SCHEMA)), "m")).collect()}
    assert not kept[5000] and kept[5001] and all(kept[i] for i in range(150)) and sum(kept[1000 + i] for i in range(150)) == 150
    assert quality.judged(quality.measure(nothing)).count() == 0
    m = quality.measure(spark.createDataFrame(rows, SCHEMA))
    half = lambda k: quality.sketches(m.where(F.col("doc_id") % 2 == k))
    both = half(0).union(half(1)).groupBy("lang", "source", "measure", "bin").agg(F.sum("n").alias("n"))
    assert both.exceptAll(quality.sketches(m)).count() == 0
    exact = np.quantile([quality.brute_force(t)[1] / quality.brute_force(t)[0] for _, t, *_ in rows[:150]], 0.5, method="inverted_cdf")
    row = quality.quantiles(quality.sketches(m.where("source = 'plain' and doc_id < 150")), ["source"]).where("measure = 'word_length'").first()
    assert quality.GAMMA ** row["mid"] == pytest.approx(exact, rel=quality.GAMMA - 1)


def test_quality_bounds_follow_the_group(spark, sf_dir):
    """On the table: a change of one source's texts moves that source's bounds; another's hardly, by what the language weighs."""
    docs = table(spark, sf_dir, "documents").withColumn("source", F.when(F.col("doc_id") % 3 == 0, "one").otherwise("two"))
    noisy = docs.withColumn("text", F.when(F.col("source") == "one", F.regexp_replace("text", " ", " # ")).otherwise(F.col("text")))
    def bounds(df):
        many = df.unionAll(df).unionAll(df).unionAll(df)
        return {(r["lang"], r["source"]): (r["symbol_ratio_hi"], r["word_length_hi"]) for r in quality.thresholds(quality.sketches(quality.measure(many))).collect()}
    plain, moved = bounds(docs.withColumn("lang", F.lit("en"))), bounds(noisy.withColumn("lang", F.lit("en")))
    far, near = ([abs(math.log(moved["en", k][m] / plain["en", k][m])) for m in (0, 1)] for k in ("one", "two"))
    assert all(3 * b < a for a, b in zip(far, near))
    assert moved["en", "one"][0] > plain["en", "one"][0] + 0.3 and moved["en", "one"][1] < plain["en", "one"][1]


def test_quality_fences_are_not_degenerate(spark, sf_dir):
    """One symbol loses no clean text, a group without spread keeps its own, junk among few goes, and bounds of every measure differ by group and can be passed."""
    r = random.Random(6)
    rows = [(i, words(r, r.randint(60, 1500)), "en", "plain", 0) for i in range(150)] + [(200, words(r, 2000) + " #", "en", "plain", 0), (201, words(r, 60) + " #", "en", "plain", 0)]
    rows += [(300 + i, words(r, 400), "en", "even", 0) for i in range(40)] + [(400, words(r, 400) + " #", "en", "even", 0)]
    rows += [(500, " ".join(w + "##" for w in words(r, 300).split()), "en", "alone", 0), (501, words(r, 300), "en", "alone", 0)]
    rows += [(600, "\n".join([words(r, 30)] + ["Share this story"] * 12 + [words(r, 60)]), "en", "plain", 0)]
    kept = {x["doc_id"]: x["kept"] for x in quality.judged(quality.measure(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert {i for i, k in kept.items() if not k} == {500, 600}
    limits = quality.thresholds(quality.sketches(quality.measure(table(spark, sf_dir, "documents")))).toPandas()
    for k in quality.COUNTED:
        assert limits[f"{k}_hi"].nunique() > 1 and (limits[f"{k}_hi"] > 0).all()
    assert limits["word_length_hi"].nunique() > 1


# ---- 3: licences


def test_licences(spark, nothing):
    mit, apache = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0"]
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/x.py", "code " * 40 + "\n# " + apache + "\nmore"), (3, "a/b/y.py", "code"), (4, "a/b/c/COPYING.txt", apache), (5, "a/b/c/d/z.py", None), (6, "other/q.py", "no licence here"),
        (7, "top.py", "x"), (8, None, ""), (3, "a/b/y.py", "code"), (9, "ab/y.py", "x"), (10, "z/only.txt", mit), (11, "z/n.py", "x"),
    ]
    got = {r["file_id"]: (r["licence"], r["source"], r["found_in"]) for r in licenses.scan(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("Apache-2.0", "own", None), 3: ("MIT", "inherited", "a"), 4: ("Apache-2.0", "own", None), 5: ("Apache-2.0", "inherited", "a/b/c"), 6: (None, "none", None), 7: (None, "none", None),
        8: (None, "none", None), 9: (None, "none", None), 10: ("MIT", "own", None), 11: ("MIT", "inherited", "z"),
    }
    assert licenses.scan(spark.createDataFrame([], "file_id long, path string, text string")).count() == 0
    for k, t in licenses.TEMPLATES.items():
        best = licenses.matches(spark.createDataFrame([(b"k", t)], "passage_key binary, passage string")).first()
        assert best["licence"] == k and best["score"] == pytest.approx(1, abs=1e-5)


def test_licences_as_they_are_written(spark, sf_dir):
    gpl = "it under the terms of the GNU General Public License as published by"
    mit = licenses.FORMS["MIT"][-1].replace("MIT License Copyright", "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n").replace(". ", ".\n")
    bsd = licenses.FORMS["BSD-3-Clause"][-2].replace("Copyright Redis", "Copyright (c) 1990 The Regents. All rights reserved.\n\nRedis")
    want = {
        "All rights reserved.": "Proprietary", "# Copyright 2020 Example Inc. All rights reserved.": "Proprietary", "Copyright (c) 2020 Jane Doe": None,
        "MIT License": "MIT", "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "/* SPDX-License-Identifier: GPL-3.0-or-later */": "GPL-3.0", "SPDX-License-Identifier: Foo-1.0": None,
        "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        f"import x\n\n# This program is free software: you can redistribute it and/or modify\n# {gpl}\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n\nx()": "GPL-3.0",
        mit: "MIT", bsd: "BSD-3-Clause",
    }
    rows = [(i, f"{i}/x.txt", t) for i, t in enumerate(want)]
    named = {"MIT": mit, "BSD-3-Clause": bsd}
    for k, file in {"GPL-3.0": "GPL-3", "GPL-2.0": "GPL-2", "LGPL-3.0": "LGPL-3", "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}.items():
        if (path := Path("/usr/share/common-licenses") / file).exists():
            named[k] = path.read_text()
    rows += [(100 + i, f"n{i}/LICENSE", t) for i, t in enumerate(named.values())] + [(200 + i, f"n{i}/x.py", "x") for i in range(len(named))]
    got = {r["file_id"]: r["licence"] for r in licenses.scan(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())
    assert [got[100 + i] for i in range(len(named))] == [got[200 + i] for i in range(len(named))] == list(named)
    docs = table(spark, sf_dir, "documents")
    cued = {r["doc_id"] for r in docs.where(F.col("text").rlike(licenses.CUE)).select("doc_id").collect()}
    assert cued <= {r["file_id"] for r in licenses.scan(licenses.as_files(docs)).where("source = 'own'").collect()}


def test_licences_of_plain_lines(spark):
    """Lines without the word licence: every form is reached, and each licence's short forms and paragraphs by themselves."""
    import re

    cue = re.compile(licenses.CUE.replace(r"[^\p{L}\p{N}]", r"[\W_]"))
    assert {f for forms in licenses.FORMS.values() for f in forms if not cue.search(f)} == {"MIT", "ISC"}
    want = {
        "Released under GPLv3.": "GPL-3.0", "# GPL-3.0-or-later": "GPL-3.0", "This code is under Apache-2.0": "Apache-2.0", "(c) X, BSD-3-Clause": "BSD-3-Clause", licenses._ISC: "ISC", licenses._MIT: "MIT", licenses._ZLIB: "Zlib",
        "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0", "Licensed under the EUPL": "EUPL-1.2", "mit": None, "MIT": None, "wir gehen mit dem Hund": None, "the public was told of the domain": None,
        "Permission to enter was not given": None, "Apache helicopters flew over the village at dawn": None, "the gnu ran over the plain": None,
    }
    rows = [(i, f"{i}/x.py", "x = 1\n" * 5000 + f"{t}\n" + "y = 2\n" * 10) for i, t in enumerate(want)] + [(900 + i, f"z/{i}.py", f"# note {i} on gnu and apache, permission is needed for this code and for all of it") for i in range(40)]
    got = {r["file_id"]: r["licence"] for r in licenses.scan(spark.createDataFrame(rows, "file_id long, path string, text string").withColumn("dir", F.lit("d")).withColumn("licence", F.lit("l"))).collect()}
    assert {t: got[i] for i, t in enumerate(want)} == want


# ---- 4: languages


def test_language_held_out(spark):
    r = random.Random(7)
    letters = {"aa": "abcde ", "bb": "abfgh ", "cc": "éèàçê "}
    rows = [(i, "".join(r.choices(letters[k], k=r.randint(40, 300))), k, "s", 0) for i, k in enumerate(list(letters) * 120)]
    rows += [(9001, None, "aa", "s", 0), (9002, "", "aa", "s", 0), (9003, "12 !?", "aa", "s", 0), (9004, "abcde " * 20_000, None, "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit("x"))
    model = langid.fit(langid.training_rows(df, ~langid.held_out()))
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in langid.predict(df, model, ["doc_id"]).collect()}
    assert [got[i][0] for i in (9001, 9002, 9003)] == ["und"] * 3 and got[9004][0] == "aa"
    held = [(i, k) for i, _, k, *_ in rows[:360] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and sum(got[i][0] == k for i, k in held) >= 0.98 * len(held)
    assert all(0 <= s <= 1 for _, s in got.values())
    left = langid.in_a_language(df)
    assert left.columns == df.columns and left.count() == 361


def test_language_without_labels(spark, nothing):
    df = frame(spark, [(1, "abc")]).withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(langid.training_rows(df, ~langid.held_out())) is None
    assert [tuple(r) for r in langid.predict(df, None, ["doc_id"]).collect()] == [(1, "und", 0.0)]
    assert langid.in_a_language(df).count() == 0 and langid.predict(nothing, None, ["doc_id"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 4, 200])
def test_rejection_whatever_the_number_of_languages(n):
    class Fixed:
        model = langid.Model([str(k) for k in range(n)], [], None, None, None)

        def scores(self, texts):
            return np.array([[float(t.split()[1])] + [-1.0] * (n - 1) for t in texts])

    langs, margin = langid.predictions(["a 1.0", "a 0.5", "a -0.2", "a -0.95", None], Fixed(), by_margin=True)
    assert langs == ["0"] * 4 + ["und"] and margin[:4] == pytest.approx([2, 1.5, 0.8, 0.05])
    assert list(margin >= langid.LEAST_MARGIN) == [True] * 3 + [False] * 2


def test_kernel_is_shared_presence():
    model = langid.fit([("a", b"abab abc"), ("a", b"abba"), ("b", b"xyzx"), ("b", b"xyy z")] * 3)
    scorer = langid.Scorer(model)
    a, b = scorer.presence([b"abab", b"abc"])
    shared = sum(len(set(map(int, x)) & set(map(int, y)) & set(map(int, c))) for x, y, c in zip(langid.grams(b"abab"), langid.grams(b"abc"), model.codes))
    assert int(a @ b) == shared


# ---- 5: repeated strings


def want5(texts):
    return bwt_dedup.brute_force(list({i: (t or "").encode() for i, t in texts}.items()))


def test_dedup_odd(spark, odd, nothing):
    df, texts = odd
    out = bwt_dedup.deduplicated(df)
    assert out.columns[: len(df.columns)] == df.columns and {r["kept"] for r in out.collect()} == {"clash"}
    got = {(r["doc_id"], r["__n_bytes"], r["__n_removed"], len(r["__starts"]), hashlib.sha256(bytes(r["__kept"])).hexdigest()) for r in out.collect()}
    assert got == {(i, *v) for i, v in want5(texts).items()} and out.count() == len(texts)
    assert bwt_dedup.deduplicated(nothing).count() == 0
    assert bwt_dedup.without_repeats(df).columns == df.columns


@pytest.mark.parametrize("seed", range(3))
def test_dedup_random_overlaps(spark, seed):
    r = random.Random(seed)
    pool = ["".join(r.choices("abc é\n", k=r.randint(60, 400))) for _ in range(12)]
    texts = [(i * 3, "".join(p[r.randint(0, 30) : len(p) - r.randint(0, 30)] if r.random() < 0.8 else words(r, 20) for p in r.choices(pool, k=r.randint(1, 5)))) for i in range(60)]
    r.shuffle(texts)
    got = {x["doc_id"]: (x["__n_bytes"], x["__n_removed"], len(x["__starts"]), hashlib.sha256(bytes(x["__kept"])).hexdigest()) for x in bwt_dedup.deduplicated(frame(spark, texts)).collect()}
    assert got == want5(texts)


def test_cuts_halve_no_character_and_leave_others(spark):
    r = random.Random(6)
    same = "".join(r.choices("abcdefgh ", k=150))
    # é and è begin with the same byte, é and ũ end with the same.
    texts = [(1, "é" + same + "é"), (2, "\ufffdown\ufffd ũ" + same + "è \ufffdend"), (3, "plain \ufffd"), (None, same + "\ufffd"), (None, same)]
    got = sorted((str(x["doc_id"]), x["text"], x["n_chars"]) for x in bwt_dedup.without_repeats(frame(spark, texts)).collect())
    want = [*texts[:1], (2, "\ufffdown\ufffd  \ufffdend"), *texts[2:]]
    assert got == sorted((str(i), t, len(t)) for i, t in want)
    assert bwt_dedup.characters("é日本".encode(), [(1, 3)]) == "本".encode() and bwt_dedup.characters("日あ".encode(), [(1, 4)]) == b""


def strings5(seed):
    r = random.Random(seed)
    base = [bytes(r.choices(b"abc ", k=150)) for _ in range(30)]
    return [x[: 100 + r.randint(0, 50)] for x in base for _ in range(3)] + [x[r.randint(0, 40) :] for x in base] + [b"ab" * 80, b"a" * 140]


def intervals5(shards, strings, several):
    found = {}
    for j, i, q in zip(*(x.tolist() for x in bwt_dedup.merged(shards, np.array([len(x) for x in strings]), several))):
        found.setdefault(q, []).append((j, i))
    return sorted(map(sorted, found.values()))


def test_transform_sorts_suffixes_and_steps_by_its_letters():
    strings = strings5(1)
    codes, places = bwt_dedup.transform(strings)
    flat = b"\0".join(bytes(c + 1 for c in s) for s in strings) + b"\0"
    at = sorted((s[i:], j, sum(len(x) + 1 for x in strings[:j]) + i) for j, s in enumerate(strings) for i in range(len(s) + 1))
    assert places.tolist() == [p for _, _, p in at]
    assert codes.tolist() == [flat[p - 2] << 8 | flat[p - 1] for p in places.tolist()]
    step = bwt_dedup.steps(codes)
    inside = [(r, p) for r, p in enumerate(places.tolist()) if 0 not in flat[max(0, p - 2) : p] and p >= 2]
    assert all(places[step[r]] == p - 2 for r, p in inside)


def test_merge_of_transforms_decides():
    strings = strings5(2)
    parts = [strings[k::3] for k in range(3)]
    flat = [x for p in parts for x in p]
    shards = [bwt_dedup.transform(p) for p in parts]
    want = {}
    for j, x in enumerate(flat):
        for i in range(len(x) - 99):
            want.setdefault(x[i : i + 100], []).append((j, i))
    few = np.zeros(len(flat), bool)
    assert intervals5(shards, flat, few) == sorted(sorted(v) for v in want.values() if len(v) > 1)
    some = np.arange(len(flat)) % 4 == 0
    assert intervals5(shards, flat, some) == sorted(sorted(v) for v in want.values() if len(v) > 1 or some[v[0][0]])
    # The order of the transforms' rows, their letters and the LF steps all bear on the result.
    turn = np.random.default_rng(1).permutation(len(shards[0][0]))
    for wrong in ((shards[0][0][turn], shards[0][1][turn]), (shards[0][0][turn], shards[0][1]), (shards[0][0], shards[0][1][turn])):
        assert intervals5([wrong, *shards[1:]], flat, few) != intervals5(shards, flat, few)
    alone = [q for k, p in enumerate(parts) for q in intervals5([shards[k]], p, np.zeros(len(p), bool))]
    assert len(alone) != len(intervals5(shards, flat, few))


def test_hot_anchor_is_dealt_out(monkeypatch):
    r = random.Random(8)
    passage = bytes(r.choices(b"abcdefgh ", k=130))
    texts = [bytes(r.choices(b"xyz ", k=60)) + passage + bytes(r.choices(b"xyz ", k=60)) for _ in range(40)]
    texts += texts[:5]
    monkeypatch.setattr(bwt_dedup, "HOT_STRINGS", 7)
    rows = bwt_dedup.segments(*bwt_dedup.packed(texts), np.arange(45))
    strings, several, later = bwt_dedup.settle(rows)
    assert not set(strings["key"].tolist()) <= set(rows["key"].tolist())
    places = {i: [] for i in range(45)}
    for key in set(strings["key"].tolist()):
        mine = strings[strings["key"] == key]
        named = np.zeros(len(mine), bwt_dedup._STRING)
        named["doc"], named["at"], named["n"] = mine["doc"], mine["at"], mine["n"] + 256 * several[strings["key"] == key].astype(int)
        of = [texts[s["doc"]][s["at"] : s["at"] + s["n"] + 99] for s in mine]
        for doc, at, n in zip(*(x.tolist() for x in bwt_dedup.repeated(named, of, later[later["key"] == key]))):
            places[doc].append((at, n))
    want = bwt_dedup.brute_force(list(enumerate(texts)))
    assert {i: hashlib.sha256(bwt_dedup.cut(texts[i], places[i])[0]).hexdigest() for i in places} == {i: v[3] for i, v in want.items()}


def test_dedup_by_row_not_by_id(spark):
    r = random.Random(9)
    a, b = words(r, 60), words(r, 60)
    got = sorted((x["doc_id"], x["text"], x["__n_removed"], x["kept"]) for x in bwt_dedup.deduplicated(frame(spark, [(1, a), (1, b), (2, a), (3, b[50:])]).withColumn("kept", F.lit("mine"))).collect())
    assert got == sorted([(1, a, 0, "mine"), (1, b, 0, "mine"), (2, a, len(a), "mine"), (3, b[50:], len(b) - 50, "mine")])
    back = bwt_dedup.without_repeats(frame(spark, [(1, a), (2, a + b)]).withColumn("n_bytes", F.lit("mine"))).collect()
    assert sorted((x["doc_id"], x["text"], x["n_bytes"]) for x in back) == [(1, a, "mine"), (2, b, "mine")]


def test_stages_keep_columns_of_any_name(spark, bench):
    """Values, not just names, of columns that are named like an operator's own or can't stand unquoted."""
    r = random.Random(21)
    a, b, c = words(r, 80, "abc"), words(r, 80, "def"), words(r, 70, "ghi")
    rows = [(1, a, "en"), (2, a, "en"), (3, b, "fr"), (4, b[-300:] + c, "fr"), (5, c[:200], None), (6, None, "en"), (7, "x " * 40, "fr")]
    df = spark.createDataFrame([(i, t, g, len(t or "")) for i, t, g in rows], "doc_id long, text string, lang string, n_chars int")
    names = ["doc", "__row", "__places", "__lang_pred", "a.b", "__kept", "with`tick", "id", "tokens"]
    df = df.withColumns({c: F.concat(F.lit(f"{c} of "), "doc_id") for c in names})
    own = lambda x: [x[n] for n in names] == [f"{n} of {x['doc_id']}" for n in names]
    stages = {
        "language": (langid.in_a_language, None), "join": (ngram_join.one_of_each, {1, 3, 4, 5, 6, 7}), "dedup": (bwt_dedup.without_repeats, {1, 3, 4, 6, 7}),
        "clean": (lambda d: wu_manber.clean_documents(d, bench), {1, 2, 3, 4, 5, 6}),
    }
    for stage, want in stages.values():
        out = stage(df)
        got = out.collect()
        assert out.columns == df.columns and all(own(x) for x in got)
        assert want is None or {x["doc_id"] for x in got} == want
    got = bwt_dedup.deduplicated(df).collect()
    assert all(x["doc"] == f"doc of {x['doc_id']}" and x["a.b"] == f"a.b of {x['doc_id']}" for x in got)
    assert {x["doc_id"]: x["__n_removed"] for x in got}[2] == len(a)


# ---- 7: pages


def page(*parts):
    return "<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body>" + "".join(parts) + "</body></html>"


NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>More</a></li></ul></nav>"


def test_html_cases(spark):
    cases = {
        page(NAV, "<article><h1>A &amp; B</h1><p>One\n two&nbsp;three.</p><p><b>Four<br><p>Five.</article>", "<footer>foot</footer>"): "A & B\nOne two three.\nFour\nFive.",
        page("<div class='ad'>Buy this now.</div>", "<article><p>Text of it, a sentence.</p><aside>Side words here.</aside><p>End.</p></article>"): "Text of it, a sentence.\nEnd.",
        page("<div class='cookie-notice'><p>We use cookies.</p><button>Ok</button></div>", "<main><p>Main text stands here.</p></main>", "<form><label>Name</label><input></form>"): "Main text stands here.",
        page("<article><p>Long enough, this is the text.</p></article>", "<section id='comments'><div class='comment'><p>First!</p></div></section>"): "Long enough, this is the text.",
        page("<article><ul><li>a first item.<li>a second item.</ul><pre>x  y</pre></article>"): "a first item.\na second item.\nx y",
        page(NAV): "", "": "", None: "", "<": "", "<p": "", "<!-- <p>no</p> -->": "",
    }
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(cases)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert html_text.extracted(df.where("false")).count() == 0


def test_html_keeps_formulas_and_own_elements():
    text = "A sentence of the article, and more of it. " * 20
    pages = [page(f"<article><p>{text}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be <x-term>so</x-term><noscript>, as said</noscript>.</p></article>")]
    assert html_text.extract(pages, html_text.trained())[0].split("\n")[1] == "Let x=1 be so, as said."


def test_html_long_and_broken_pages_take_linear_time():
    import time

    shapes = ['<a "', "<div></p>", "<svg>", "<li><figure>", "</section><div>", "<!-", "< <", "<template>", "<p><b>", "<x y='"]
    for shape in shapes:
        html_text.parse(shape * 100)
        began = time.process_time()
        html_text.parse(shape * (400_000 // len(shape)))
        assert time.process_time() - began < 20, shape


def test_html_without_body():
    bare = ["Words <b>of</b> a text.<br>More.", "\ufeffIntro text<p hidden></p>", "<html><body><p></p></body></html>bare", "\ufeff<!DOCTYPE html>\n<html><body></body></html>\n", "<title>t</title>"]
    assert html_text.extract(bare, html_text.trained()) == ["Words of a text. More.", "Intro text", "bare", "", ""]
    text = "Intro text, of some length. <p>" + "A sentence of the article, and more of it. " * 20 + "</p>"
    one, two = html_text.extract([text, f"<html><body>{text}</body></html>"], html_text.trained())
    assert one.startswith("Intro text, of some length.") and two.startswith("Intro text, of some length.")


def test_html_composed_pages_and_hierarchy():
    forest, wrong = html_text.trained(), 0
    pages = html_text.composed(4242)
    for nodes, label in pages:
        kept = html_text.decoded(nodes, forest.scores(html_text.features(nodes)))
        assert all(kept[n.parent] for n, k in zip(nodes[1:], kept[1:]) if k)
        wrong += html_text.text_of(nodes, kept) != html_text.text_of(nodes, label > 0)
    assert wrong <= 0.02 * len(pages)


def test_html_table(spark, sf_dir):
    import html as h
    import re

    def truth(s):
        blocks = re.split(r"</?(?:p|h1)>", s[s.index("<article>") + 9 : s.index("</article>")])
        return "\n".join(b for b in (" ".join(h.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in blocks) if b)

    rows = llm.QUERIES["op7_html_text"](spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in table(spark, sf_dir, "pages").collect()}
    assert all(r["text"] == truth(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in rows) and len(rows) == len(pages)


# ---- 8: near duplicates


def test_join_odd(spark, odd, nothing):
    df, texts = odd
    got = sorted({(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.joined(df).collect()})
    assert got == sorted((i, *v) for i, v in ngram_join.brute_force(texts).items())
    assert ngram_join.joined(df).count() == len(texts) and ngram_join.joined(nothing).count() == 0
    assert ngram_join.one_of_each(df).columns == df.columns


def test_join_large_group_and_chains(spark):
    r = random.Random(9)
    base, texts = words(r, 120).split(), []
    for i in range(90):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = words(r, 1, "xyz")
        texts.append((i, " ".join(w)))
    passage = words(r, 30)
    texts += [(200 + i, words(r, 60) + " " + passage) for i in range(50)]
    chain = words(r, 100).split()
    for i in range(6):
        texts.append((400 + i, " ".join(chain)))
        chain = chain[6:] + words(r, 6).split()
    r.shuffle(texts)
    want = ngram_join.brute_force(texts)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.joined(frame(spark, texts)).collect()}
    assert got == want and sum(1 for i in got if got[i][1] != i) > 60


def test_prefix_filter_loses_nothing():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(1, 60)
        x = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
        y = np.unique(np.concatenate([x[: r.randint(0, len(x))], np.array([r.getrandbits(64) for _ in range(r.randint(0, 12))], np.uint64)]))
        if not len(y):
            continue
        shared = len(np.intersect1d(x, y))
        if 100 * shared >= 80 * (len(x) + len(y) - shared):
            for k in (2, 4, 5):
                c = len(np.intersect1d(ngram_join.prefix(ngram_join.mixed(x, k)), ngram_join.prefix(ngram_join.mixed(y, k))))
                rest = max(-(-80 * len(s) // 100) - 1 for s in (x, y))
                assert c >= 1 and 180 * (c + rest) >= 80 * (len(x) + len(y))


@pytest.mark.parametrize("few", [100_000, 0])
def test_components_both_ways(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    r = random.Random(few)
    links = [(i, i + 1) for i in range(30, 10, -1)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(45)]
    got = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert got == {x: find(x) for p in links if p[0] != p[1] for x in p}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 9: shards


def test_shards(spark, odd, nothing):
    df, texts = odd
    r = random.Random(6)
    many = frame(spark, [(i, None if i % 50 == 0 else words(r, r.randint(1, 60)) if i % 3 else "one hot text " * 5) for i in range(1500)])
    for docs, n in ((df, len(texts)), (many, 1500)):
        rows = sharding.sharded(docs).toPandas()
        assert len(rows) == n and rows["shard"].between(0, 23).all()
        for _, g in rows.groupby("shard"):
            assert sorted(g["slot"]) == list(range(len(g)))
        text = {x["doc_id"]: x["text"] or "" for x in docs.select("doc_id", "text").collect()}
        assert all(s == len(text[i].encode()) + 8 and c == zlib.crc32(text[i].encode()) for i, s, c in zip(rows["doc_id"], rows["size"], rows["text_crc32"]))
    by = rows.groupby("shard")["size"].sum()
    assert len(by) == 24 and by.max() - by.min() <= 2 * (rows["size"].max() + by.mean() / sharding.KEEP)
    assert sharding.sharded(nothing).count() == 0
    plan = sharding.sharded(many)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 10: decontamination


def test_contamination(spark, odd, nothing, bench):
    df, texts = odd
    want = {(a, b, c, d, f) for a, b, c, d, _, f in wu_manber.brute_force(texts, [(r[0], r[1]) for r in bench.collect()])}
    for limit in (wu_manber.PATTERN_BYTES, 16 * 20):
        found = wu_manber.judged(wu_manber.find(df, bench, pattern_bytes=limit))
        assert {(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), r["contaminated"]) for r in found.collect()} == want
    assert wu_manber.find(nothing, bench).count() == 0
    assert {r["n_hit"] for r in wu_manber.judged(wu_manber.find(df, bench.where("false"))).collect()} == {0}
    assert wu_manber.clean_documents(df, bench).columns == df.columns


def test_contamination_by_row_with_any_benchmark_size(spark, monkeypatch):
    r = random.Random(4)
    items = [(i, words(r, 20)) for i in range(6)]
    texts = [(1, items[0][1]), (1, words(r, 30)), (1, items[1][1] + " " + words(r, 9)), (None, items[2][1]), (None, words(r, 40)), (None, items[3][1] + " " + items[4][1]), (2, None), (3, items[5][1]), (3, items[5][1])]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = wu_manber.brute_force(texts, items)
    rows = lambda x: sorted((str(i), n, h, k, bad) for i, n, h, k, bad in x)
    for pattern_bytes in (16, wu_manber.PATTERN_BYTES):
        found = wu_manber.judged(wu_manber.find(docs, bench, pattern_bytes=pattern_bytes)).withColumn("n_items", F.size("items"))
        assert rows(found.select("doc_id", "n_words", "n_hit", "n_items", "contaminated").collect()) == rows((i, n, h, k, bad) for i, n, h, k, _, bad in want)
        monkeypatch.setattr(wu_manber, "PATTERN_BYTES", pattern_bytes)
        clean = [(x["doc_id"], x["text"]) for x in wu_manber.clean_documents(docs, bench).collect()]
        assert sorted(clean, key=str) == sorted((x for x, y in zip(texts, want) if not y[5]), key=str)


def test_search_against_brute_force():
    r = random.Random(8)
    for _ in range(60):
        items = [(i, " ".join(r.choices("ab", k=r.randint(0, 16)))) for i in range(4)]
        text = " ".join(r.choices("abA!", k=r.randint(0, 60)))
        search = wu_manber.Search(wu_manber.Patterns([(i, t.encode()) for i, t in items]))
        spans = list(search.hits(wu_manber.words(text.encode())))
        hit = {k for a, b, _ in spans for k in range(a, b)}
        (_, n, n_hit, n_items, _, _), = wu_manber.brute_force([(1, text)], items)
        assert (len(wu_manber.words(text.encode())), len(hit), len({i for *_, s in spans for i in s})) == (n, n_hit, n_items)


# ---- the registered queries


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_query(spark, sf_dir, duck, same, name):
    same(llm.QUERIES[name](spark, sf_dir), duck.execute(llm.ORACLE_SQL[name]))


def test_tokens_of_the_table(spark, sf_dir):
    lib, start = library(), 0
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect())
    one = {r["doc_id"]: r for r in llm.QUERIES["op1_bpe"](spark, sf_dir).collect()}
    six = {r["doc_id"]: r for r in llm.QUERIES["op6_token_files"](spark, sf_dir).collect()}
    for i, t in docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert (one[i]["n_tokens"], one[i]["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert one[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (six[i]["start"], six[i]["n_tokens"]) == (start, len(ids) + 1)
        start += len(ids) + 1


def test_dedup_of_the_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in llm.QUERIES["op5_bwt_dedup"](spark, sf_dir).collect()}
    assert got == want5(docs)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "BPE encoding"]
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    joined = {i for i, (_, c) in ngram_join.brute_force(list(left.items())).items() if c == i}
    cut = bwt_dedup.brute_force([(i, left[i].encode()) for i in joined])
    out = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    gone = [i for i in joined if cut[i][1] == cut[i][0] > 0]
    assert set(out) <= joined - set(gone) and len(out) > 0.9 * (len(joined) - len(gone))
    lib = library()
    whole = [i for i in out if cut[i][1] == 0]
    assert all(out[i] == len(lib.encode(left[i], add_special_tokens=False).ids) for i in whole)


def test_pipeline_exactly(spark, sf_dir):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.in_a_language(spark, docs, sf_dir).collect()}
    left = {i: left[i] for i, (_, c) in ngram_join.brute_force(list(left.items())).items() if c == i}
    seen, cut = set(), {}
    for i, text in sorted(left.items()):
        data = text.encode()
        hit = np.zeros(len(data), bool)
        for k in range(len(data) - bwt_dedup.WIDTH + 1):
            w = data[k : k + bwt_dedup.WIDTH]
            if w in seen:
                hit[k : k + bwt_dedup.WIDTH] = True
            seen.add(w)
        if not (len(data) and hit.all()):
            ends = np.cumsum([0] + [len(c.encode()) for c in text])
            cut[i] = "".join(c for c, a, b in zip(text, ends[:-1], ends[1:]) if not hit[a:b].any())
    bench = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    bad = {r[0] for r in wu_manber.brute_force(list(cut.items()), bench) if r[5]}
    lib, want = library(), {}
    for i in cut.keys() - bad:
        ids = lib.encode(cut[i], add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want and bad and any(cut[i] != left[i] for i in cut)
