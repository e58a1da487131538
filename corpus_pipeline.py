"""The corpus pipeline: each stage reads what the one before kept.

Defined cases, for all stages: an empty table gives no rows; extra columns pass through unchanged, whatever their names;
repeated rows are judged each by itself, but for rows of equal doc_id and text, which are one document. A document with a
null or empty text, or one without a letter, is in no language and goes in the first stage; one without words is linked with
nothing; one under 100 bytes loses nothing; one without words has no contamination. A null doc_id has no place in the
order of ids: such a row loses nothing and isn't an earlier occurrence. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stemmata.llm import bpe, bwt_dedup, langid, ngram_join, wu_manber
from stemmata.llm.common import staged, table


def in_a_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (4), learnt from the stage's own documents: documents in no language go."""
    return langid.in_a_language(docs)


def one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (8): of each group of near duplicates the document with the least id stays."""
    return ngram_join.one_of_each(docs)


def without_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup (5): strings that stand earlier too are cut out; documents that lose all their bytes go."""
    return bwt_dedup.without_repeats(docs)


def decontaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (10): contaminated documents go."""
    return wu_manber.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding (1)."""
    return bpe.digests(bpe.round_trip(docs, bpe.vocab_file(), keep=["doc_id"]))


STAGES = [
    ("language ID", in_a_language),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("BPE encoding", encoded),
]

#: A suffix array, a Nyström classifier and a BPE encoder have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage{k}")
    return docs
