"""Structure signatures, the subclasses they support, and the best of a family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.corpus import TEI
from ..vocabulary import HIERARCHY, LINE


def signatures(nodes: DataFrame) -> DataFrame:
    """path, div_types, contains (pairs of units, outer and inner), has_lines, lines_under; one row for each well-formed document."""
    tei = (F.col("kind") == "element") & (F.col("ns") == TEI)
    inside = tei & F.col("in_body")
    unit = F.when(inside & (F.col("name") == "div"), F.col("unit"))
    line = inside & (F.col("name") == "l")
    pair = F.explode_outer(F.when(unit.isNotNull() | line, F.array_distinct("anc_units")))
    rows = nodes.where(F.col("kind") != "error").select("path", unit.alias("unit"), line.alias("line"), pair.alias("above"))
    under = F.when(F.col("line"), F.col("above"))
    inner = F.when(F.col("unit").isNotNull() & F.col("above").isNotNull(), F.struct(F.col("above").alias("anc"), F.col("unit").alias("des")))
    return rows.groupBy("path").agg(
        F.array_sort(F.collect_set("unit")).alias("div_types"),
        F.array_sort(F.collect_set(inner)).alias("contains"),
        F.max("line").alias("has_lines"),
        F.array_sort(F.collect_set(under)).alias("lines_under"),
    )


def describe() -> Column:
    """The signature as text: sorted div types, then l where there are lines; (none) where there is nothing."""
    text = F.array_join(F.concat("div_types", F.when(F.col("has_lines"), F.array(F.lit("l"))).otherwise(F.array().cast("array<string>"))), "+")
    return F.when(text == "", "(none)").otherwise(text)


def hierarchy(spark: SparkSession) -> DataFrame:
    """subclass, family, units and depth: 19 rows."""
    return spark.createDataFrame([(k, k.split("-")[0], list(v), len(v)) for k, v in sorted(HIERARCHY.items())], "subclass string, family string, units array<string>, depth int")


def fits() -> Column:
    """Whether the signature has every unit, every step from one unit to the next, and lines where they belong."""
    divs = F.filter("units", lambda u: u != LINE)
    every = F.forall(divs, lambda u: F.array_contains("div_types", u))
    step = lambda i: F.struct(F.element_at(divs, i).alias("anc"), F.element_at(divs, i + 1).alias("des"))
    steps = F.when(F.size(divs) < 2, F.lit(True)).otherwise(
        F.forall(F.sequence(F.lit(1), F.greatest(F.size(divs) - 1, F.lit(1))), lambda i: F.array_contains("contains", F.when(i < F.size(divs), step(i))))
    )
    lines = F.when(F.element_at("units", -1) != LINE, F.lit(True)).when(F.size(divs) == 0, F.col("has_lines")).otherwise(F.array_contains("lines_under", F.when(F.size(divs) > 0, F.element_at(divs, -1))))
    return every & steps & lines


def fitting(signed: DataFrame, by_family: bool = False) -> DataFrame:
    """Each document with each subclass that its signature supports; by_family only those of its column `family`."""
    dim = F.broadcast(hierarchy(signed.sparkSession))
    both = signed.join(dim, "family") if by_family else signed.crossJoin(dim)
    return both.where(fits())


def best(fitted: DataFrame) -> DataFrame:
    """path and the deepest fitting subclass; ties go to the lesser name."""
    return fitted.groupBy("path").agg(F.min_by("subclass", F.struct(-F.col("depth"), "subclass")).alias("best"))
