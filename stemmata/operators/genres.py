"""Genre lookups: taxonomy, proposals, and the resolution of a document's genre from several places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import or_empty, or_null, strip, without_hashes
from ..sources.corpus import TEI
from ..vocabulary import LITERARY, NAMES, Names


def literary_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(LITERARY.items()), "target string, proposed string")


def families_union(taxonomy: DataFrame) -> DataFrame:
    """All valid targets."""
    return taxonomy.where("kind = 'family'").select("target").union(taxonomy.where("kind = 'subclass'").select("target")).distinct()


def missing_defaults(taxonomy: DataFrame) -> DataFrame:
    """Family defaults that are no subclass; must be empty."""
    return taxonomy.where("kind = 'family'").select(F.col("default_subclass").alias("target")).exceptAll(taxonomy.where("kind = 'subclass'").select("target"))


def _lookup(taxonomy: DataFrame, prefix: str) -> DataFrame:
    return F.broadcast(taxonomy.select(F.col("target").alias(f"{prefix}_target"), F.col("kind").alias(f"{prefix}_kind"), F.col("family").alias(f"{prefix}_family"), F.col("default_subclass").alias(f"{prefix}_default")))


def with_family(rows: DataFrame, taxonomy: DataFrame, genre: str = "genre", strict: bool = False) -> DataFrame:
    """Adds the family of a valid target, else null; strict makes an unknown one an error that names what is valid."""
    out = rows.join(_lookup(taxonomy, "tax"), F.col(genre) == F.col("tax_target"), "left")
    family = F.col("tax_family")
    if strict:
        valid = ", ".join(sorted(r[0] for r in taxonomy.select("target").collect()))
        family = F.coalesce(family, F.raise_error(F.concat(F.lit("unknown genre "), or_empty(F.col(genre)), F.lit(f"; valid: {valid}"))))
    return out.withColumn("family", family).drop("tax_target", "tax_kind", "tax_family", "tax_default")


def with_proposal(rows: DataFrame, taxonomy: DataFrame, genre: str = "genre") -> DataFrame:
    """Adds proposed_subclass (itself, the family's default, the literary map's, or empty) and proposed_family."""
    clean = strip(or_empty(F.col(genre)))
    out = rows.withColumn("__clean", F.when(clean == "unknown", "").otherwise(clean))
    out = out.join(_lookup(taxonomy, "t"), F.col("__clean") == F.col("t_target"), "left")
    out = out.join(F.broadcast(literary_map(rows.sparkSession)), F.col("__clean") == F.col("target"), "left")
    known = F.when(F.col("t_kind") == "subclass", F.col("t_target")).when(F.col("t_kind") == "family", F.col("t_default"))
    out = out.withColumn("proposed_subclass", or_empty(F.coalesce(known, F.col("proposed")))).drop("__clean", "t_target", "t_kind", "t_family", "t_default", "target", "proposed")
    out = out.join(_lookup(taxonomy, "p"), F.col("proposed_subclass") == F.col("p_target"), "left")
    return out.withColumn("proposed_family", or_empty(F.col("p_family"))).drop("p_target", "p_kind", "p_family", "p_default")


def document_genre(nodes: DataFrame, names: Names = NAMES, anywhere: bool = False) -> DataFrame:
    """path and genre_tei of documents whose header names one: the first catRef of the scheme, in textClass or anywhere."""
    ref = (F.col("kind") == "element") & (F.col("ns") == TEI) & (F.col("name") == "catRef") & (F.col("attrs")["scheme"] == names.scheme) & F.col("attrs")["target"].isNotNull()
    if not anywhere:
        up = F.slice("anc_names", -2, 2)
        ref = ref & (F.size("anc_names") >= 2) & F.when(F.size("anc_names") >= 2, up == F.array(F.lit("profileDesc"), F.lit("textClass"))).otherwise(False)
    return nodes.where(ref).groupBy("path").agg(without_hashes(F.min_by(F.col("attrs")["target"], "node_id")).alias("genre_tei"))


def first_of(*columns: str, default: str = "") -> Column:
    """The first of the columns that isn't empty."""
    return F.coalesce(*[or_null(F.col(c)) for c in columns], F.lit(default))
