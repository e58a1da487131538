"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each text is measured whole (words, symbols, repeated lines, repeated three-word windows). Documents that
pass the two base rules feed one sketch for each language, source and measure: counts of values by
logarithmic bin, so a quantile is known to within GAMMA - 1 relatively, sketches merge by adding counts,
and no order of rows or loss of executors changes them.

What is counted feeds the sketch as (count + 1/2) / (rest + 1/2): a text without a symbol shows only that its rate lies
below what its length can tell, so a group of texts without any still has a median and a tail, and no fence is zero.
A repeat's rest is what isn't repeated, so every fence can be passed. A document fails a measure if its value, reckoned
without one occurrence, lies beyond the group's fence, t + REACH * (t - median), where t is the group's own tail quantile
(for mean word length also below, at the quantile that far from the other end). A count of one never fails. There is
no absolute cutoff: in a group without spread, what lies more than some bins beyond the common value fails.
The quantiles of a group of n documents are drawn towards its language's with the weight of PRIOR documents, and those
towards everything's in the same way (means of logarithms), so bounds change with the number of documents by no jump.

Defined cases: a null text has no words and fails the base rules; a null language or source counts as the
empty string; an empty table gives an empty result; of extra columns none is read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, arrow_batches, packed, slices, staged, table, text_bytes, trimmed

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
GAMMA = 1.02
REACH = 3.0
#: The documents that a group's language, and a language's everything, weigh in its quantiles.
PRIOR = 100
#: The measures, and the tail quantile in per cent from which their fence is reckoned: far out where single
#: documents of good text differ much (repeats), further in where junk itself may make up the tail.
TAIL = {"symbol_ratio": 85, "dup_line_ratio": 99, "repeat_ratio": 99, "word_length": 90}
#: The measure that can also be too small.
BOTH_SIDES = "word_length"
#: Groups up to which the thresholds are broadcast; more are joined by key.
BROADCAST_GROUPS = 20_000

_SPACE = np.zeros(256, bool)
_SPACE[list(ASCII_SPACE)] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """For each document, its words in three-word windows that occur twice or more in it; ids and doc go by word."""
    out = np.zeros(n_docs, np.int64)
    if len(ids) < 3:
        return out
    size = int(ids.max()) + 1
    pair = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)[1]
    triple = np.unique(pair * size + ids[2:], return_inverse=True)[1]
    key = doc[:-2] * (int(triple.max()) + 1) + triple
    whole = doc[:-2] == doc[2:]
    key[~whole] = -1
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    equal = (key[order][1:] == key[order][:-1]) & (key[order][1:] >= 0)
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(same)] |= same
    return np.bincount(doc[covered], minlength=n_docs)


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def measure_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    data, at = packed(texts)
    raw = np.frombuffer(data, np.uint8)
    split = [t.split() for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    ids = np.fromiter((put(w, len(seen)) for ws in split for w in ws), np.int64, int(n_words.sum()))
    doc = np.repeat(np.arange(len(texts)), n_words)
    lines = np.array([line_counts(t) for t in texts], np.int64).reshape(-1, 2)
    return {
        "n_words": n_words,
        "word_chars": _sums(((raw & 0xC0) != 0x80) & ~_SPACE[raw], at),
        "n_symbols": _sums(_SYMBOL[raw], at),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeated_words(ids, doc, len(texts)),
        "n_lines": lines[:, 0],
    }


def measure(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of every document."""
    arrow_batches(documents.sparkSession)
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.col("text").cast("string").alias("text")
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text_bytes(batch.column(3))):
                if part.num_rows:
                    found = measure_texts(texts)
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], *[pa.array(found[c], pa.int64()) for c in names]], names=["doc_id", "lang", "source", *names])

    return docs.mapInArrow(trimmed(run), "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in names))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: What each measure counts, and what its rest is.
COUNTED = {"symbol_ratio": ("n_symbols", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines - n_dup_lines"), "repeat_ratio": ("n_repeat_words", "n_words - n_repeat_words")}


def _of_rest(count: Column, rest: str) -> Column:
    return count.cast("double") / (F.expr(rest).cast("double") + 0.5)


def _word_length() -> Column:
    return F.coalesce(F.try_divide(F.col("word_chars").cast("double"), F.col("n_words").cast("double")), F.lit(0.0))


def sketched() -> dict[str, Column]:
    """The measures as they feed the sketches; all above zero where the base rules pass."""
    return {**{k: _of_rest(F.col(n).cast("double") + 0.5, rest) for k, (n, rest) in COUNTED.items()}, "word_length": _word_length()}


def ratios() -> dict[str, Column]:
    """The measures as they are judged: what a document shows with one occurrence taken away."""
    return {**{k: _of_rest(F.greatest(F.col(n) - 1, F.lit(0)), rest) for k, (n, rest) in COUNTED.items()}, "word_length": _word_length()}


def bin_of(value: Column) -> Column:
    """The sketch's bin of a value above zero."""
    return F.ceil(F.log(value) / math.log(GAMMA)).cast("int")


def value_of(bin_: Column, part: int) -> Column:
    """The least (0), middle (1) or greatest (2) value of a bin, or of a mean of bins."""
    power = F.pow(F.lit(GAMMA), bin_.cast("double"))
    return (power / GAMMA, 2 * power / (1 + GAMMA), power)[part]


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the sketches, mergeable by adding n."""
    rows = measured.where(~base_failed()).select("lang", "source", F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in sketched()]), F.array(*sketched().values()))).alias("measure", "value"))
    return rows.groupBy("lang", "source", "measure", bin_of(F.col("value")).alias("bin")).agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """n and the bins of the median and of both tails (`mid`, `low`, `high`) of each measure for the sketches merged by the given columns."""
    merged = sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    tail = F.create_map(*[F.lit(x) for kv in TAIL.items() for x in kv])[F.col("measure")]
    ranked = merged.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    at = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("all"), F.col("bin")))
    return ranked.groupBy(*by, "measure").agg(F.first("all").alias("n"), at(F.lit(50)).alias("mid"), at(100 - tail).alias("low"), at(tail).alias("high"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source, and for each measure its lowest and highest value allowed (`symbol_ratio_lo`, ...)."""
    bins = ("mid", "low", "high")
    fine = quantiles(sketch, ["lang", "source"])
    lang = quantiles(sketch, ["lang"]).select("lang", "measure", *[F.col(c).alias(f"lang_{c}") for c in ("n", *bins)])
    # One row for each measure: the sketch of everything has no more.
    every = quantiles(sketch, []).select("measure", *[F.col(c).alias(f"all_{c}") for c in bins])
    both = fine.join(lang, ["lang", "measure"]).join(F.broadcast(every), "measure")
    drawn = lambda n, own, to: (F.col(n) * own + PRIOR * to) / (F.col(n) + PRIOR)
    q = {c: drawn("n", F.col(c), drawn("lang_n", F.col(f"lang_{c}"), F.col(f"all_{c}"))) for c in bins}
    mid, low, high = value_of(q["mid"], 1), value_of(q["low"], 0), value_of(q["high"], 2)
    hi = high + REACH * (high - mid)
    lo = F.when(F.col("measure") == BOTH_SIDES, low - REACH * (mid - low)).otherwise(F.lit(0.0))
    pick = lambda k, c: F.max(F.when(F.col("measure") == k, F.col(c)))
    return both.select("lang", "source", "measure", lo.alias("lo"), hi.alias("hi")).groupBy("lang", "source").agg(*[pick(k, c).alias(f"{k}_{c}") for k in TAIL for c in ("lo", "hi")])


def judged(measured: DataFrame) -> DataFrame:
    """The measures with base_failed and kept."""
    limits = staged(thresholds(staged(sketches(measured), "sketches")), "limits")
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    both = measured.join(limits, ["lang", "source"], "left")
    fits = F.lit(True)
    for k, v in ratios().items():
        fits = fits & F.coalesce(v.between(F.col(f"{k}_lo"), F.col(f"{k}_hi")), F.lit(True))
    return both.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & fits)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    measured = staged(measure(table(spark, sf_dir, "documents")), "measured")
    return judged(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def brute_force(text: str | None) -> tuple[int, int, int, int, int]:
    """The five counts of one text, straight from their definition; for tests."""
    import re

    word = re.compile("[^\x20\x09-\x0d]+")
    w = word.findall(text or "")
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if word.search(x) and x in lines[:i])
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(triples)
    hit = {i + k for i, t in enumerate(triples) if many[t] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)
