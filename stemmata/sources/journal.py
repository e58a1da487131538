"""Writing many files so that all of them appear, or none.

A run has a journal beside the files: the plan (path, target, temporary), written before any file is, and a mark once all files stand
complete under their temporary names. Until the mark, giving up means removing the temporary folders, and no file has changed; from then
on, going on means moving what isn't moved yet. recover() does one or the other for every journal that it finds. Tasks may be done
twice or lost: a file is written under a name of its attempt and then moved, and moving is done once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import bounded, qualified, remove
from .listing import folder_of, opened

JOURNAL = ".stemmata-journal"
_PLAN = "path string, target string, temporary string"


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    where, system = _path(spark, path)
    return system.exists(where)


def prepare(rows: DataFrame, targets: DataFrame, home: str, column: str = "xml") -> str:
    """Plans and writes the files (path and the text or bytes in `column`) under temporary names below the folders of their targets; gives the run's journal."""
    spark = rows.sparkSession
    bounded(spark)
    run_id = uuid.uuid4().hex
    journal = f"{qualified(spark, home).rstrip('/')}/{JOURNAL}/{run_id}"
    target: Column = F.col("target")
    temporary = F.concat(folder_of(target), F.lit(f"/.{run_id}/"), F.sha2(target, 256))
    targets.select("path", "target", temporary.alias("temporary")).write.parquet(f"{journal}/plan")
    plan = plan_of(spark, journal)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, base = opened(uri)
                system.create_dir(base.rpartition("/")[0], recursive=True)
                part = f"{base}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as f:
                    f.write(text if isinstance(text, bytes) else text.encode())
                system.move(part, base)
            yield pa.RecordBatch.from_arrays([batch.column(1)], names=["temporary"])

    try:
        rows.select("path", column).join(plan, "path").select(column, "temporary").mapInArrow(write, "temporary string").write.parquet(f"{journal}/written")
    except Exception:
        roll_back(spark, journal)
        raise
    return journal


def plan_of(spark: SparkSession, journal: str) -> DataFrame:
    return spark.read.schema(_PLAN).parquet(f"{journal}/plan")


def commit(spark: SparkSession, journal: str) -> None:
    """From here on, the files are to appear."""
    where, system = _path(spark, f"{journal}/COMMIT")
    if not system.mkdirs(where):
        raise OSError(f"no mark could be set in {journal}")


def publish(spark: SparkSession, journal: str) -> int:
    """Moves the files that aren't moved yet, and closes the journal; gives their number."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for target, temporary in zip(*(c.to_pylist() for c in batch.columns)):
                system, base = opened(temporary)
                place = opened(target)[1]
                there, done = (x.type == fs.FileType.File for x in system.get_file_info([base, place]))
                if there:
                    system.move(base, place)
                elif not done:
                    raise FileNotFoundError(f"neither {temporary} nor {target}")
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["target"])

    n = plan_of(spark, journal).select("target", "temporary").mapInArrow(move, "target string").count()
    _close(spark, journal)
    return n


def roll_back(spark: SparkSession, journal: str) -> None:
    """Removes the temporary files and the journal; what was there before is as it was."""
    _close(spark, journal)


def _close(spark: SparkSession, journal: str) -> None:
    """The temporary folders go, from the tasks, with whatever lost attempts left in them; then the journal."""

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, base = opened(uri)
                if system.get_file_info(base).type == fs.FileType.Directory:
                    system.delete_dir(base)
            yield batch

    if _exists(spark, f"{journal}/plan/_SUCCESS"):
        plan_of(spark, journal).select(folder_of(F.col("temporary")).alias("folder")).distinct().mapInArrow(clear, "folder string").count()
    remove(spark, journal)


def recover(spark: SparkSession, home: str) -> dict[str, str]:
    """Ends every run below the folder that was cut short: its id, and whether its files have `appeared` or are `withdrawn`."""
    root = f"{qualified(spark, home).rstrip('/')}/{JOURNAL}"
    out = {}
    if _exists(spark, root):
        where, system = _path(spark, root)
        for at in system.listStatus(where):
            journal, name = at.getPath().toString(), at.getPath().getName()
            if _exists(spark, f"{journal}/COMMIT"):
                publish(spark, journal)
                out[name] = "appeared"
            else:
                roll_back(spark, journal)
                out[name] = "withdrawn"
    return out


def write_all(rows: DataFrame, targets: DataFrame, home: str, column: str = "xml") -> int:
    """All files, or none: prepare, commit and publish. Where publishing is cut short, recover() ends it."""
    journal = prepare(rows, targets, home, column)
    commit(rows.sparkSession, journal)
    return publish(rows.sparkSession, journal)
