"""Folders listed by tasks, and files read in partitions of bounded bytes.

Each level of folders is one job: its folders are dealt out, listed where they are, and the folders found are the next level. Nothing but
counts comes to the driver. What is to be read is put into slots by cumulated bytes in the order of paths; a data source has one
partition for each slot, so that many small files make few partitions, and a large one its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..runtime import bounded, qualified, scratch, ship, staged

#: Bytes of one partition, and what a file counts besides its bytes.
PARTITION_BYTES, OPEN_BYTES = 64 << 20, 64 << 10
#: Bytes of one Arrow batch.
BATCH_BYTES = 8 << 20
_FILE = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("is_folder", pa.bool_())])


def opened(uri: str):
    """The file system of a URI (file: where it has no scheme), and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            system, base = opened(uri)
            rows = [(f"{uri.rstrip('/')}/{x.base_name}", x.size or 0, x.mtime, x.type == fs.FileType.Directory) for x in system.get_file_info(fs.FileSelector(base, allow_not_found=True))]
            for lo in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[lo : lo + 10_000]], kind) for k, kind in enumerate(_FILE.types)], schema=_FILE)


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """path, size and modified of all files below a directory, names of any kind; those of folders that begin with a dot, as writing in progress, are passed over."""
    ship(spark)
    level = spark.createDataFrame([(qualified(spark, directory).rstrip("/"),)], "path string")
    found = []
    while not level.isEmpty():
        dealt = level.repartition(4 * spark.sparkContext.defaultParallelism) if found else level
        listed = staged(dealt.mapInArrow(_children, "path string, size long, modified timestamp, is_folder boolean"), "listing")
        found.append(listed.where("not is_folder").drop("is_folder"))
        level = listed.where("is_folder").where(~F.substring_index("path", "/", -1).startswith(".")).select("path")
    return reduce(DataFrame.unionByName, found)


def slots(files: DataFrame, partition_bytes: int = PARTITION_BYTES) -> tuple[str, int]:
    """Writes the files (path, size, modified) with the slot of each, and gives the place and the number of slots."""
    spark = files.sparkSession
    ordered = files.repartitionByRange("path").sortWithinPartitions("path").withColumn("id", F.monotonically_increasing_id())
    ordered = staged(ordered.withColumn("part", F.shiftright("id", 33)), "files")
    before = F.sum(F.col("size") + OPEN_BYTES).over(Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1))
    cut = ordered.withColumn("piece", F.floor(F.coalesce(before, F.lit(0)) / partition_bytes))
    # As many rows as slots: numbered in one task.
    pieces = cut.groupBy("part", "piece").agg(F.count("*").alias("n"))
    numbers = staged(pieces.withColumn("slot", F.row_number().over(Window.orderBy("part", "piece")) - 1).drop("n"), "slots")
    path = scratch(spark, "slotted")
    cut.join(numbers, ["part", "piece"]).repartition("slot").sortWithinPartitions("slot", "path").select("path", "size", "modified", "slot").write.partitionBy("slot").parquet(path)
    return path, numbers.count()


class CorpusSource(DataSource):
    """Files by slots: option `listing` is what slots() wrote, `slots` their number. Gives path, size, modified and the bytes as xml."""

    @classmethod
    def name(cls) -> str:
        return "stemmata-corpus"

    def schema(self) -> str:
        return "path string, size long, modified timestamp, xml binary"

    def reader(self, schema) -> DataSourceReader:
        return CorpusReader(self.options["listing"], int(self.options["slots"]))


class CorpusReader(DataSourceReader):
    def __init__(self, listing: str, slots: int) -> None:
        self.listing, self.slots = listing, slots

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(self.slots)]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        if partition is None:  # there are no slots
            return
        system, base = opened(f"{self.listing}/slot={partition.value}")
        schema = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("xml", pa.binary())])
        rows, held = [], 0
        for x in pq.read_table(base, filesystem=system, columns=["path", "size", "modified"], partitioning=None).to_pylist():
            where, at = opened(x["path"])
            with where.open_input_stream(at) as f:
                content = f.read()
            rows.append((x["path"], x["size"], x["modified"], content))
            held += len(content)
            if held >= BATCH_BYTES or len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(schema.types)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(schema.types)], schema=schema)


def read_files(files: DataFrame, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """path, size, modified and xml (bytes) of the files listed."""
    spark = files.sparkSession
    bounded(spark)
    spark.dataSource.register(CorpusSource)
    path, n = slots(files, partition_bytes)
    return spark.read.format(CorpusSource.name()).option("listing", path).option("slots", n).load()


def named(files: DataFrame, ending: str = ".xml") -> DataFrame:
    return files.where(F.col("path").endswith(ending))


def stated(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """path, size and modified of the files named by path; one that isn't there is an error."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for uri in batch.column(0).to_pylist():
                system, base = opened(uri)
                info = system.get_file_info(base)
                if info.type != fs.FileType.File:
                    raise FileNotFoundError(uri)
                rows.append((uri, info.size, info.mtime))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(_FILE.types[:3])], names=_FILE.names[:3])

    return paths.select("path").mapInArrow(run, "path string, size long, modified timestamp")


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)
