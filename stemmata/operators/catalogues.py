"""Work and text-group catalogues, structural signals of works, and suggestions of genres."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_empty, or_null, strip
from ..runtime import ship
from ..sources.corpus import TEI
from ..vocabulary import FAMILY_DEFAULT

CTS = "http://chs.harvard.edu/xmlns/cts"


def group_names(nodes: DataFrame) -> DataFrame:
    """path and the stripped text of the first groupname."""
    here = (F.col("kind") == "element") & (F.col("ns") == CTS) & (F.col("name") == "groupname")
    return nodes.groupBy("path").agg(or_empty(strip(F.min_by(F.when(here, or_empty(F.col("text"))), F.when(here, F.col("node_id"))))).alias("author"))


def works(nodes: DataFrame) -> DataFrame:
    """path, urn, title, description, genre and confidence of catalogue documents; what is absent or unreadable is empty."""
    el = lambda n: (F.col("kind") == "element") & (F.col("ns") == CTS) & (F.col("name") == n)
    first = lambda when, what: or_empty(F.min_by(F.when(when, what), F.when(when, F.col("node_id"))))
    text = or_empty(F.col("text"))
    described = el("description") & F.col("attrs")["xml:lang"].isin("eng", "mul")
    return nodes.groupBy("path").agg(
        first(F.col("depth") == 0, F.col("attrs")["urn"]).alias("urn"), first(el("title"), strip(text)).alias("title"), first(described, strip(text)).alias("description"),
        first(el("genre"), text).alias("genre"), first(el("genre"), or_empty(F.col("attrs")["confidence"])).alias("confidence"),
    ).withColumn("urn", F.coalesce(or_null(F.col("urn")), F.col("path")))


def signals(nodes: DataFrame, by: str = "work") -> DataFrame:
    """Of each work: speeches, verse lines and paragraphs of its texts, and its div types in the order they come."""
    tei = (F.col("kind") == "element") & (F.col("ns") == TEI)
    kind = F.when(tei & (F.col("name") == "div"), or_null(F.col("attrs")["type"]))
    # By type first: what meets in one place is a work's types, not its divs.
    by_type = nodes.withColumn("__type", kind).groupBy(by, "__type").agg(
        F.count_if(tei & (F.col("name") == "sp")).alias("sp"), F.count_if(tei & F.col("name").isin("l", "lg")).alias("l"), F.count_if(tei & (F.col("name") == "p") & F.col("in_text")).alias("p"),
        F.min(F.struct("path", "node_id")).alias("first"),
    )
    ordered = F.array_sort(F.collect_list(F.when(F.col("__type").isNotNull(), F.struct("first", F.col("__type").alias("t")))))
    return by_type.groupBy(by).agg(F.sum("sp").alias("sp_count"), F.sum("l").alias("l_count"), F.sum("p").alias("p_count"), F.transform(ordered, lambda x: x["t"]).alias("div_types"))


def inferred_family() -> Column:
    sp, verse, p = F.col("sp_count"), F.col("l_count"), F.col("p_count")
    return F.when(sp > 0, "drama").when((verse > 0) & (verse > p), "verse").when(p > 0, "prose")


def confidence(family: Column, structural: Column) -> Column:
    """Of a suggestion with this family (null: not valid) beside the family that the structure suggests."""
    return F.when(family.isNull(), "low").when(structural.isNull(), "medium").when(family == structural, "high").otherwise("medium")


def prompt(taxonomy_lines: Column) -> Column:
    """The question for a classifier; columns author, title, description and the signals."""
    known = lambda label, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{label}: "), F.col(c)))
    counted = F.concat_ws(", ", *[F.concat(F.col(c).cast("string"), F.lit(f" {what}")) for c, what in (("sp_count", "speeches"), ("l_count", "lines of verse"), ("p_count", "paragraphs"))])
    parts = F.when(F.size("div_types") > 0, F.concat(F.lit("Its divisions are called "), F.array_join("div_types", ", "), F.lit(".")))
    return F.concat_ws(
        "\n", F.lit("To which genre does this work belong? Choose one of the identifiers below and reply with it alone."), known("Work", "title"), known("By", "author"), known("About", "description"),
        F.concat(F.lit("Its texts contain "), counted, F.lit(".")), parts, F.lit("Identifiers and what they stand for:"), taxonomy_lines,
    )


def by_structure(rows: list[dict]) -> list[str]:
    """The stand-in classifier: the default of the family that the structure suggests."""
    return [FAMILY_DEFAULT.get(r["structural"] or "", "unknown") for r in rows]


def suggested(works_: DataFrame, classify: Callable[[list[dict]], list[str]] = by_structure) -> DataFrame:
    """All columns and the classifier's answer, stripped of white space and final dots. The classifier takes rows and may ask a model."""
    ship(works_.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [(a or "").strip().rstrip(".") for a in classify(batch.to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string())], names=[*batch.schema.names, "suggestion"])

    return works_.mapInArrow(run, works_.withColumn("suggestion", F.lit("").cast("string")).schema)
