"""Element and attribute vocabulary of a corpus by genre, and its tables' orders."""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import bounded
from ..sources.encodings import readable
from ..vocabulary import TOP_VALUES, VALUE_ATTRIBUTES, VALUE_LENGTH


def names_of(xml: str | bytes) -> dict[str, int]:
    """How often each element stands in a document; nothing for one that isn't well formed."""
    found: dict[str, int] = {}
    parser = expat.ParserCreate(namespace_separator="}")

    def start(tag: str, _: dict) -> None:
        name = tag.rpartition("}")[2]
        found[name] = found.get(name, 0) + 1

    parser.StartElementHandler = start
    try:
        parser.Parse(readable(xml), True)
    except (expat.ExpatError, ValueError, LookupError):
        return {}
    return found


def local_name(key):
    return F.regexp_replace(key, r"^(\{[^}]*\}|xml:)", "")


def element_files(docs: DataFrame) -> DataFrame:
    """genre, path, element and n: the elements of each well-formed document (path, xml, genre), counted where it is parsed."""
    bounded(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, xml, genre in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(genre, path, element, n) for element, n in names_of(xml or "").items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if k == 3 else pa.string()) for k in range(4)], names=["genre", "path", "element", "n"])

    return docs.select("path", "xml", "genre").mapInArrow(run, "genre string, path string, element string, n long")


def files_of(nodes: DataFrame) -> DataFrame:
    """The same from a node table, whose nodes carry a genre."""
    return nodes.where(F.col("kind") == "element").groupBy("genre", "path", F.col("name").alias("element")).agg(F.count("*").alias("n"))


def element_counts(by_file: DataFrame) -> DataFrame:
    """element, genre, file_count, instance_count. Counts by file come first, so no set of paths is ever held."""
    return by_file.groupBy("element", "genre").agg(F.count("*").alias("file_count"), F.sum("n").alias("instance_count"))


def ordered_elements(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("instance_count"), "element", "genre")


def attribute_values(nodes: DataFrame) -> DataFrame:
    """element, attribute, genre, value, count of all surveyed attributes; values are cut to their first letters."""
    pairs = nodes.where((F.col("kind") == "element") & (F.size("attrs") > 0)).select(F.col("name").alias("element"), "genre", F.explode("attrs").alias("key", "raw"))
    rows = pairs.withColumn("attribute", local_name(F.col("key"))).where(F.col("attribute").isin(*VALUE_ATTRIBUTES))
    return rows.groupBy("element", "attribute", "genre", F.substring("raw", 1, VALUE_LENGTH).alias("value")).agg(F.count("*").alias("count"))


def top_values(counts: DataFrame, k: int = TOP_VALUES) -> DataFrame:
    """The k most frequent values of each element, attribute and genre; ties go to the greater value."""
    rank = F.row_number().over(Window.partitionBy("element", "attribute", "genre").orderBy(F.desc("count"), F.desc("value")))
    return counts.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def ordered_attributes(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("count"), "element", "attribute", "genre", F.desc("value"))
