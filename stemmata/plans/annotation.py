"""Genres for works that have none: questions, answers kept in a ledger as they are given, and catalogue entries made of them.

Asking may be dear, so an answer is never asked for twice. Questions are put into numbered batches; a task writes the answers of each
batch to the ledger before it goes on, under the batch's own name, and a task that is done again takes what stands there. A run
that was cut short is followed by one that leaves out all works with an answer, whatever batches they were in.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators import catalogues, genres, rewrite
from ..operators.shred import shred
from ..operators.validation import numbered_within
from ..runtime import bounded, qualified, staged
from ..sources.corpus import texts, work_catalogues
from ..sources.listing import opened
from .commands import work_table

#: Questions of one batch.
BATCH = 50
_ANSWER = pa.schema([("path", pa.string()), ("suggestion", pa.string()), ("run", pa.string()), ("batch", pa.int64()), ("attempt", pa.string())])
ANSWER = "path string, suggestion string, run string, batch long, attempt string"


def questions(files: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """path, urn, what is known of each catalogued work without a genre, and the prompt."""
    works = staged(work_table(files), "works").where(strip(F.col("genre")) == "")
    docs = texts(files).select("path", "textgroup", "work")
    nodes = shred(texts(files), ("node_id", "kind", "ns", "name", "attrs", "in_text")).join(docs, "path").withColumn("key", F.struct("textgroup", "work"))
    found = catalogues.signals(nodes, "key").select("key.*", "sp_count", "l_count", "p_count", "div_types")
    rows = works.join(found, ["textgroup", "work"], "left").na.fill(0, ["sp_count", "l_count", "p_count"]).withColumn("div_types", F.coalesce("div_types", F.array().cast("array<string>")))
    lines = "\n".join(f"  {r[0]}: {r[1]}" for r in sorted(taxonomy.select("target", "description").collect()))
    return rows.withColumn("structural", catalogues.inferred_family()).withColumn("prompt", catalogues.prompt(F.lit(lines))).drop("genre", "confidence")


def concluded(said: DataFrame, files: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """path, urn, genre, confidence and the catalogue entry to be written, of questions with their suggestion."""
    said = genres.with_family(said, taxonomy, "suggestion")
    said = said.withColumn("target", F.when(F.col("family").isNull(), "unknown").otherwise(F.col("suggestion"))).withColumn("cert", catalogues.confidence(F.col("family"), F.col("structural")))
    entries = said.join(work_catalogues(files).select("path", "xml"), "path")
    return said.select("path", "urn", F.col("target").alias("genre"), F.col("cert").alias("confidence")).join(rewrite.rewritten(entries, ("set_catalogue_genre",)), "path")


def annotate(files: DataFrame, taxonomy: DataFrame, classify: Callable = catalogues.by_structure) -> DataFrame:
    """All questions asked as the result is read, nothing kept."""
    return concluded(catalogues.suggested(questions(files, taxonomy), classify), files, taxonomy)


def answers(spark: SparkSession, ledger: str) -> DataFrame:
    """What the ledger holds; the first of a path, should two runs have gone at once."""
    rows = spark.read.schema(ANSWER).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(ledger)
    return rows.groupBy("path").agg(F.min_by("suggestion", F.struct("run", "batch")).alias("suggestion"))


def _started(spark: SparkSession, ledger: str) -> str:
    ledger = qualified(spark, ledger).rstrip("/")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    return ledger


def ask(asked: DataFrame, classify: Callable, ledger: str, size: int = BATCH) -> int:
    """Asks the questions (path and what the classifier reads) that the ledger has no answer to; gives the number of answers made or found."""
    spark = asked.sparkSession
    bounded(spark)
    ledger = _started(spark, ledger)
    todo = asked.join(answers(spark, ledger).select("path"), "path", "left_anti").withColumn("__all", F.lit(0))
    # Written with their batches, so that all attempts see the same ones.
    plan = numbered_within(todo, "__all", "path").withColumn("batch", F.floor(F.col("number") / size)).drop("__all", "number")
    plan = staged(plan, "questions")
    run = uuid.uuid4().hex

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = str(TaskContext.get().taskAttemptId())
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["batch"] != row["batch"]:
                    yield _answered(held, classify, f"{ledger}/run={run}", run, attempt)
                    held = []
                held.append(row)
        if held:
            yield _answered(held, classify, f"{ledger}/run={run}", run, attempt)

    return plan.repartition("batch").sortWithinPartitions("batch", "path").mapInArrow(work, ANSWER).count()


def _answered(rows: list[dict], classify: Callable, folder: str, run: str, attempt: str) -> pa.RecordBatch:
    """The answers to one batch: those in the ledger, or new ones, which stand there before they are given back."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    number = rows[0]["batch"]
    system, base = opened(f"{folder}/{number}.parquet")
    if system.get_file_info(base).type != fs.FileType.File:
        said = [(a or "").strip().rstrip(".") for a in classify([{k: v for k, v in r.items() if k != "batch"} for r in rows])]
        if len(said) != len(rows):
            raise ValueError(f"{len(said)} answers to {len(rows)} questions")
        columns = [[r["path"] for r in rows], said, [run] * len(rows), [number] * len(rows), [attempt] * len(rows)]
        system.create_dir(base.rpartition("/")[0], recursive=True)
        part = f"{base}.{uuid.uuid4().hex}"
        pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, _ANSWER)], schema=_ANSWER), part, filesystem=system)
        system.move(part, base)
    return pq.read_table(base, filesystem=system, schema=_ANSWER, partitioning=None).combine_chunks().to_batches()[0]


def annotate_with_ledger(files: DataFrame, taxonomy: DataFrame, classify: Callable, ledger: str, size: int = BATCH) -> DataFrame:
    """As annotate(), with every answer kept: run again after a failure, it asks only what has no answer."""
    asked = staged(questions(files, taxonomy), "asked")
    ask(asked, classify, ledger, size)
    return concluded(asked.join(answers(files.sparkSession, _started(files.sparkSession, ledger)), "path"), files, taxonomy)


def dry_run(files: DataFrame, taxonomy: DataFrame, ledger: str | None = None) -> DataFrame:
    """path, urn and prompt of what would be asked."""
    asked = questions(files, taxonomy)
    if ledger:
        asked = asked.join(answers(files.sparkSession, _started(files.sparkSession, ledger)).select("path"), "path", "left_anti")
    return asked.select("path", "urn", "prompt")
