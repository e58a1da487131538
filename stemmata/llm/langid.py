"""Language identification with string kernels.

The kernel of two texts is the blended spectrum of byte n-grams (1 to 3) in presence form: the number of
n-grams that both contain, over the root of the product of the numbers that each contains. Landmarks drawn
from the training sample give Nyström features K_nm K_mm^(-1/2); one-versus-rest kernel ridge regression on
them has one weight vector for each language. Both fold into one matrix, so a batch of texts is scored by
two matrix products: presence x landmarks, then kernel values x weights.

Only ASCII letters and bytes of other scripts tell languages apart here: case is folded, and digits,
punctuation and white space count as one blank. n-grams are those found in at least two landmarks, the
most frequent VOCABULARY of them and those tied with the last.

Fitting uses a bounded sample of labelled rows: at most PER_LANGUAGE of each language, drawn by a hash of doc_id, and as many
fewer as keep a language within its share of TRAIN_CHARS characters, but one at least, so that every labelled language is learnt.
Their texts are learnt from whole; one longer than the whole share is drawn only where there is none within it. The cut to so many
rows is made before the driver gets them. Everything else, prediction above all, reads all texts whole.

Defined cases: `und` with score 0 for a null text, one without a letter, or where no labelled row exists to
learn from; empty tables give no rows; equal texts get equal predictions; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, carried, staged, table, trimmed

ORDERS = 3
PER_LANGUAGE = 300
TRAIN_CHARS = 20_000_000
LANDMARKS = 128
VOCABULARY = 6000
RIDGE = 1e-2
SHARPNESS = 6.0
#: The pipeline's stage takes a document for no language if its best value stands out from the mean of the others by
#: less than gives this score among four languages; that doesn't depend on how many languages there are.
REJECT_BELOW = 0.3
LEAST_MARGIN = float(np.log(3 * REJECT_BELOW / (1 - REJECT_BELOW)) / (SHARPNESS / 2))

_FOLD = np.full(256, 0x20, np.uint8)
for _c in range(26):
    _FOLD[0x41 + _c] = _FOLD[0x61 + _c] = 0x61 + _c
_FOLD[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def grams(text: bytes) -> list[np.ndarray]:
    """The codes of the n-grams at each place, by order; a blank stands at either end."""
    b = np.empty(len(text) + 2, np.uint8)
    b[0] = b[-1] = 0x20
    b[1:-1] = _FOLD[np.frombuffer(text, np.uint8)]
    out = [b]
    if len(b) > 1:
        wide = b.astype(np.uint32)
        two = wide[:-1] << 8 | wide[1:]
        out.append(two)
        out.append(two[:-1] << 8 | wide[2:])
    return out[:ORDERS]


@dataclass
class Model:
    langs: list[str]
    codes: list[np.ndarray]  # by order, the n-grams of the vocabulary
    landmarks: np.ndarray  # presence / norm, vocabulary x landmarks
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray


class Scorer:
    """A model with its tables from code to column, for one Python worker."""

    def __init__(self, model: Model) -> None:
        self.model, at = model, 0
        self.size = sum(map(len, model.codes))
        self.look, kind = [], np.int16 if self.size < 1 << 15 else np.int32
        for n, codes in enumerate(model.codes):
            look = np.full(1 << 8 * (n + 1), self.size, kind)
            look[codes] = np.arange(at, at + len(codes), dtype=kind)
            at += len(codes)
            self.look.append(look)

    def presence(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), self.size + 1), np.float32)
        for row, text in zip(out, texts):
            for look, codes in zip(self.look, grams(text)):
                row[look[codes]] = 1
        return out[:, : self.size]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        found = self.presence(texts)
        norm = np.sqrt(np.maximum(found.sum(1, keepdims=True), 1))
        return (found @ self.model.landmarks / norm) @ self.model.weights + self.model.bias


def fit(rows: list[tuple[str, bytes]]) -> Model | None:
    """A model from (language, text) pairs; None from none."""
    if not rows:
        return None
    langs = sorted({lang for lang, _ in rows})
    by_lang = {k: [t for lang, t in rows if lang == k] for k in langs}
    each = max(2, LANDMARKS // len(langs))
    marks = [t for k in langs for t in by_lang[k][:each]]
    codes, counts = [], []
    for n in range(ORDERS):
        every = np.concatenate([np.unique(g[n]) for t in marks if len(g := grams(t)) > n])
        code, count = np.unique(every, return_counts=True)
        least = 2 if len(marks) > 4 else 1
        codes.append(code[count >= least].astype(np.int64))
        counts.append(count[count >= least])
    limit = np.sort(np.concatenate(counts))[::-1][:VOCABULARY][-1] if sum(map(len, codes)) > VOCABULARY else 0
    codes = [c[n >= limit] for c, n in zip(codes, counts)]
    blank = Model(langs, codes, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    scorer = Scorer(blank)

    def unit(texts: list[bytes]) -> np.ndarray:
        p = scorer.presence(texts)
        return p / np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))

    land = unit(marks)
    value, vector = np.linalg.eigh((land @ land.T).astype(np.float64))
    root = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T
    x = np.concatenate([unit([t for _, t in rows[lo : lo + 256]]) @ land.T for lo in range(0, len(rows), 256)]).astype(np.float64) @ root
    y = np.array([[1.0 if lang == k else -1.0 for k in langs] for lang, _ in rows])
    # Each language weighs the same, however many rows it has.
    weight = np.array([len(rows) / (len(langs) * len(by_lang[lang])) for lang, _ in rows])[:, None]
    mean, middle = (x * weight).sum(0) / weight.sum(), (y * weight).sum(0) / weight.sum()
    centred = x - mean
    solved = np.linalg.solve(centred.T @ (centred * weight) + RIDGE * len(rows) / 100 * np.eye(x.shape[1]), centred.T @ ((y - middle) * weight))
    return Model(langs, codes, np.ascontiguousarray(land.T, np.float32), (root @ solved).astype(np.float32), (middle - mean @ solved).astype(np.float32))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def training_rows(documents: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE) -> list[tuple[str, bytes]]:
    """The bounded sample, in an order that depends on doc_id alone."""
    rows = documents.where(learnable & F.col("lang").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    counts = staged(rows.groupBy("lang").agg(F.count("*").alias("__n")), "languages")
    languages = counts.count()
    if not languages:
        return []
    budget = max(200, TRAIN_CHARS // languages)
    per_language = max(1, min(per_language, budget // 200))
    draw = F.xxhash64(F.col("doc_id").cast("string"), F.lit("train"))
    # A draw of about twice as many as wanted, and some more, keeps the ranking below small however large a language is.
    share = (2.0 * per_language + 40) / F.col("__n")
    drawn = rows.withColumn("draw", draw).join(F.broadcast(counts) if languages <= 50_000 else counts, "lang").where(F.pmod("draw", F.lit(1 << 30)) / float(1 << 30) < share)
    order = Window.partitionBy("lang").orderBy(F.length("text") > budget, "draw", "doc_id")
    # Whole texts, as many as the budget of characters holds; one of each language always.
    sample = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    sample = sample.withColumn("chars", F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = sample.where((F.col("rank") == 1) | (F.col("chars") <= budget)).select("lang", "rank", "text").collect()
    return [(r["lang"], r["text"].encode()) for r in sorted(found, key=lambda r: (r["lang"], r["rank"])) if has_letter(r["text"])]


def margins(raw: np.ndarray) -> np.ndarray:
    """How far the best one-versus-rest value lies above the mean of the others; of one language, above -1."""
    best, n = raw.max(1), raw.shape[1]
    return best - (raw.sum(1) - best) / (n - 1) if n > 1 else best + 1


def predictions(texts: list[str | None], scorer: Scorer | None, by_margin: bool = False) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; by_margin, the margin in place of the score."""
    langs, score = ["und"] * len(texts), np.zeros(len(texts))
    if scorer is None:
        return langs, score
    use = [i for i, t in enumerate(texts) if has_letter(t)]
    for lo in range(0, len(use), 256):
        part = use[lo : lo + 256]
        raw = scorer.scores([texts[i].encode() for i in part]).astype(np.float64)
        sharp = raw * SHARPNESS / 2
        odds = np.exp(sharp - sharp.max(1, keepdims=True))
        odds /= odds.sum(1, keepdims=True)
        value = margins(raw) if by_margin else np.clip(odds.max(1), 0, 1)
        for i, k, s in zip(part, odds.argmax(1).tolist(), value.tolist()):
            langs[i], score[i] = scorer.model.langs[k], s
    return langs, score


def predict(documents: DataFrame, model: Model | None, keep: list[str], names: tuple[str, str] = ("lang_pred", "score"), by_margin: bool = False) -> DataFrame:
    """The columns named in keep, and language and score (or margin) of every document under the names given."""
    spark = documents.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = documents.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value is not None else None
        for batch in batches:
            langs, score = predictions(batch.column(len(keep)).to_pylist(), scorer, by_margin)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=[*keep, *names])

    schema = rows.drop("__text").withColumn(names[0], F.lit("")).withColumn(names[1], F.lit(0.0)).schema
    return rows.mapInArrow(trimmed(run), schema)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, fit(training_rows(docs, ~held_out())), ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def in_a_language(documents: DataFrame) -> DataFrame:
    """The documents that are in some language, with all their columns."""
    rows, back = carried(documents, "doc_id", "text", "lang")
    model = fit(training_rows(rows, ~held_out()))
    said = predict(rows, model, rows.columns, ("__lang_pred", "__margin"), by_margin=True)
    return said.where((F.col("__lang_pred") != "und") & (F.col("__margin") >= LEAST_MARGIN)).select(*back)
