"""The vocabulary survey over documents as they arrive, again and changed.

What a file has contributed (elements and their numbers, under its genre) is kept by path beside the stream's checkpoint, in tables: a piece
for each batch, and now and then one in place of all before. When the file comes again, its old contribution is taken back and the new one
added, for all files of a batch in one join: the stream writes differences, and the survey is their sum. A file that has become broken
contributes nothing from then on; one that hasn't changed writes nothing. The state is bounded by the files and their vocabularies, not by how
often they come. Differences are written by batch, each once, however often a run is cut short and taken up again from its checkpoint;
compact() folds them between runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import stem
from ..runtime import bounded, remove
from ..sources.corpus import TEI
from ..sources.encodings import readable
from ..vocabulary import NAMES, Names

#: path, xml and version (the greatest of a path in one batch counts; a later batch always counts).
FEED = "path string, xml string, version long"
_CONTRIBUTION = "path string, version long, genre string, names array<string>, counts array<long>"
_DIFFERENCE = "element string, genre string, files long, instances long"
_STATE = "path string, genre string, names array<string>, counts array<long>, kind string, number long"
#: Pieces of the state from which on they are put together; the last two batches are left, as they may be done again.
PIECES = 16


def document_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """The rows of a growing folder of Parquet files of FEED."""
    return spark.readStream.schema(FEED).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def read(xml: str | bytes, names: Names) -> tuple[str, dict[str, int]]:
    """The genre in a document's header, without its leading # (empty if there is none), and how often each element stands in it; nothing of a broken one."""
    found: dict[str, int] = {}
    above: list[str] = []
    genres: list[str] = []
    known: dict[str, str] = {}
    parser = expat.ParserCreate(namespace_separator="}")

    def start(tag: str, attrs: dict[str, str]) -> None:
        name = known.get(tag)
        if name is None:
            name = known[tag] = tag.rpartition("}")[2]
        found[name] = found.get(name, 0) + 1
        if tag == f"{TEI}}}catRef" and above[-2:] == ["profileDesc", "textClass"] and attrs.get("scheme") == names.scheme and "target" in attrs:
            genres.append(attrs["target"].lstrip("#"))
        above.append(name)

    parser.StartElementHandler, parser.EndElementHandler = start, lambda _: above.pop()
    try:
        parser.Parse(readable(xml), True)
    except (expat.ExpatError, ValueError, LookupError):
        return "", {}
    return (genres or [""])[0], found


def contributions(docs: DataFrame, names: Names = NAMES) -> DataFrame:
    """path, version, genre, names and counts of the elements of each document (path, xml, version), all made where it is parsed; nothing of a broken one."""
    bounded(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, xml, version in zip(*(c.to_pylist() for c in batch.columns)):
                genre, found = read(xml or "", names)
                each = sorted(found.items())
                rows.append((path, version, genre, [k for k, _ in each], [n for _, n in each]))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["path", "version", "genre", "names", "counts"])

    return docs.select("path", "xml", "version").mapInArrow(run, _CONTRIBUTION)


def with_genre(found: DataFrame, by_stem: DataFrame | None = None, default: str = "unknown") -> DataFrame:
    """The genre of a contribution: the document's own, that of a table (stem, map_genre), or the default."""
    given = F.nullif("genre", F.lit(""))
    if by_stem is None:
        return found.withColumn("genre", F.coalesce(given, F.lit(default)))
    both = found.withColumn("stem", stem(F.col("path"))).join(by_stem.select("stem", "map_genre"), "stem", "left")
    return both.withColumn("genre", F.coalesce(given, F.nullif("map_genre", F.lit("")), F.lit(default))).drop("stem", "map_genre")


def _found(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a pattern."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return [x.getPath().toString() for x in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []]


def _earlier(spark: SparkSession, state: str, number: int) -> list[tuple[str, int]]:
    """The pieces, as kind and number, that hold the state before a batch: the last sum and the batches after it, all written to their end."""
    whole = [tuple(x.split("=", 1)[1] for x in path.split("/")[-3:-1]) for path in _found(spark, f"{state}/kind=*/number=*/_SUCCESS")]
    there = [(kind, int(n)) for kind, n in whole if int(n) < number]
    summed = max((n for kind, n in there if kind == "sum"), default=-1)
    return sorted((kind, n) for kind, n in there if n > summed or (kind, n) == ("sum", summed))


def _read(spark: SparkSession, state: str, pieces: list[tuple[str, int]]) -> DataFrame:
    return spark.read.schema(_STATE).option("basePath", state).parquet(*[f"{state}/kind={kind}/number={n}" for kind, n in pieces])


def _differences(spark: SparkSession, state: str, number: int) -> DataFrame:
    """What the contributions of a batch change in the survey."""
    said = F.struct("genre", "names", "counts")
    rows = _read(spark, state, [*_earlier(spark, state, number), ("batch", number)])
    each = rows.groupBy("path").agg(F.max_by(F.when(F.col("number") == number, said), F.when(F.col("number") == number, F.col("number"))).alias("new"), F.max_by(F.when(F.col("number") < number, said), F.when(F.col("number") < number, F.col("number"))).alias("old"))
    changed = each.where("new is not null and not new <=> old")
    signed = changed.select(F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("c")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("c")))).alias("s")).where("s.c is not null")
    e = signed.select(F.col("s.sign").cast("long").alias("sign"), F.col("s.c.genre").alias("genre"), F.explode(F.arrays_zip("s.c.names", "s.c.counts")).alias("e"))
    return _summed(e.select(F.col("e.names").alias("element"), "genre", F.col("sign").alias("files"), (F.col("sign") * F.col("e.counts")).alias("instances")))


def _put_together(spark: SparkSession, state: str, number: int) -> None:
    """One piece in place of those that no batch that is done again asks for: of each path the last contribution."""
    old = _earlier(spark, state, number - 1)
    if len(old) < PIECES:
        return
    last = max(n for _, n in old)
    said = F.max_by(F.struct("genre", "names", "counts"), "number").alias("c")
    # It counts only when it is written to its end, and the others go after that.
    _read(spark, state, old).groupBy("path").agg(said).select("path", "c.*").write.mode("overwrite").parquet(f"{state}/kind=sum/number={last}")
    if ("sum", last) in _earlier(spark, state, number - 1):
        for kind, n in old:
            remove(spark, f"{state}/kind={kind}/number={n}")


def start(docs: DataFrame, folder: str, checkpoint: str, by_stem: DataFrame | None = None, names: Names = NAMES) -> StreamingQuery:
    """Runs over what is there, writes differences below the folder and stops; run again with the same checkpoint, it takes only what is new."""
    found, state = with_genre(contributions(docs, names), by_stem), f"{checkpoint}/contributions"
    if _found(docs.sparkSession, f"{checkpoint}/state"):
        raise ValueError(f"{checkpoint} is of an earlier version, which kept contributions in another form")

    def write(batch: DataFrame, number: int) -> None:
        # A batch that is done again replaces what it left.
        spark = batch.sparkSession
        newest = batch.groupBy("path").agg(F.max_by(F.struct("genre", "names", "counts"), F.coalesce("version", F.lit(0))).alias("c")).select("path", "c.*")
        newest.write.mode("overwrite").parquet(f"{state}/kind=batch/number={number}")
        _differences(spark, state, number).write.mode("overwrite").parquet(f"{folder}/kind=batch/number={number}")
        _put_together(spark, state, number)

    return found.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def _pieces(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """All differences with the kind and number of their piece, and the number of the last sum: it stands for the batches up to it."""
    rows = spark.read.schema(f"{_DIFFERENCE}, kind string, number long").option("basePath", folder).parquet(folder)
    return rows, rows.where("kind = 'sum'").agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0]


def _valid(rows: DataFrame, summed: int) -> DataFrame:
    return rows.where((F.col("number") > summed) | ((F.col("number") == summed) & (F.col("kind") == "sum")))


def _summed(rows: DataFrame) -> DataFrame:
    total = rows.groupBy("element", "genre").agg(F.sum("files").alias("files"), F.sum("instances").alias("instances"))
    return total.where("files != 0 or instances != 0")


def table(spark: SparkSession, folder: str) -> DataFrame:
    """element, genre, file_count and instance_count: the differences in sum."""
    return _summed(_valid(*_pieces(spark, folder))).withColumnsRenamed({"files": "file_count", "instances": "instance_count"})


def compact(spark: SparkSession, folder: str) -> None:
    """Between runs: one difference for each element and genre in place of all before. The sum, as large as the table, is one file that appears at once, and from then on older batches don't count."""
    rows, summed = _pieces(spark, folder)
    old = [tuple(r) for r in rows.select("kind", "number").distinct().collect()]
    last = max([number for _, number in old], default=-1)
    if last > summed:
        _summed(_valid(rows, summed)).coalesce(1).write.mode("overwrite").parquet(f"{folder}/kind=sum/number={last}")
    for kind, number in old:
        if (kind, number) != ("sum", summed if last <= summed else last):
            remove(spark, f"{folder}/kind={kind}/number={number}")


def batch_table(docs: DataFrame, by_stem: DataFrame | None = None, names: Names = NAMES) -> DataFrame:
    """The same table of documents (path, xml, version) that are all there: of each path the greatest version."""
    found = with_genre(contributions(docs.groupBy("path").agg(F.max_by("xml", "version").alias("xml"), F.max("version").alias("version")), names), by_stem)
    each = found.select("genre", F.explode(F.arrays_zip("names", "counts")).alias("e"))
    return each.groupBy(F.col("e.names").alias("element"), "genre").agg(F.count("*").alias("file_count"), F.sum("e.counts").alias("instance_count"))
