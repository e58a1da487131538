"""External validator output: lines to errors, errors to counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import validator_line
from ..runtime import staged

#: Files that a validator is given at once.
BATCH = 500


def parsed(lines: DataFrame) -> DataFrame:
    """All columns, and stem, subject and message of the lines that are errors; the others go."""
    out = lines.withColumn("__e", validator_line(F.col("line"))).where("__e is not null")
    return out.select(*lines.columns, "__e.stem", "__e.subject", "__e.message")


def counted(errors: DataFrame) -> DataFrame:
    """family, element, message, instance_count and file_count (distinct stems)."""
    keys = ["family", F.col("subject").alias("element"), "message"]
    by_stem = errors.groupBy(*keys, "stem").agg(F.count("*").alias("n"))
    return by_stem.groupBy("family", "element", "message").agg(F.sum("n").alias("instance_count"), F.count("*").alias("file_count"))


def ordered(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("instance_count"), "family", "element", "message")


def numbered_within(rows: DataFrame, by: str, order: str, name: str = "number") -> DataFrame:
    """Numbers from 0 in the order of a column within each group, made over sorted ranges: a group of any size is dealt out."""
    ordered = rows.repartitionByRange(by, order).sortWithinPartitions(by, order).withColumn("__id", F.monotonically_increasing_id())
    ordered = staged(ordered.withColumn("__part", F.shiftright("__id", 33)), "ordered")
    # As many rows as ranges and groups.
    parts = ordered.groupBy(by, "__part").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("__before", F.coalesce(before, F.lit(0)))
    return ordered.join(parts, [by, "__part"]).withColumn(name, F.col("__id") - F.col("__first") + F.col("__before")).drop("__id", "__part", "__first", "__n", "__before")


def batched(files: DataFrame, schemas: DataFrame, size: int = BATCH) -> DataFrame:
    """family, batch, path and stem of the files (path, stem, family) that can be validated: those of a family with a schema, `size` to a batch in the order of paths."""
    known = files.where("family is not null").join(F.broadcast(schemas.select("family").distinct()), "family", "left_semi").select("family", "path", "stem")
    return numbered_within(known, "family", "path").select("family", F.floor(F.col("number") / size).alias("batch"), "path", "stem")


def batch_counts(files: DataFrame, schemas: DataFrame, size: int = BATCH) -> DataFrame:
    """family, status, files and batches: what is validated, what is left out as its family has no schema, and what is skipped as it has no family."""
    there = F.broadcast(schemas.select("family").distinct().withColumn("there", F.lit(True)))
    counts = files.groupBy("family").agg(F.count("*").alias("files")).join(there, "family", "left")
    status = F.when(F.col("family").isNull(), "skipped").when(F.col("there"), "validated").otherwise("schema not found")
    return counts.select(F.coalesce("family", F.lit("")).alias("family"), status.alias("status"), "files", F.when(status == "validated", F.ceil(F.col("files") / size)).otherwise(0).cast("long").alias("batches"))


def attributed(lines: DataFrame, batches: DataFrame) -> DataFrame:
    """The errors in validator lines (family, batch, line) with the path of the file they are about: the one of that stem in the line's own batch.

    A stem may stand in several families and batches; a line whose batch has no such file keeps a null path."""
    errors = parsed(lines)
    of_batch = batches.groupBy("family", "batch", "stem").agg(F.min("path").alias("path"))
    return errors.join(of_batch, ["family", "batch", "stem"], "left")
