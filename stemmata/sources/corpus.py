"""Sources: document trees, catalogues, CSV maps, taxonomies and validator logs."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_name, or_null, stem, strip
from ..runtime import qualified, staged
from ..vocabulary import FAMILY_DEFAULT, HIERARCHY
from . import listing

CATALOGUE = "__cts__.xml"
TEI = "http://www.tei-c.org/ns/1.0"
XML = "http://www.w3.org/XML/1998/namespace"
MAP_COLUMNS = "urn path author title suggested_genre confidence family proposed_subclass structure_signature match needs_review recommended_genre notes".split()


def read_corpus(spark: SparkSession, directory: str) -> DataFrame:
    """path, rel, textgroup, work, stem, is_catalog and xml (the bytes) of every XML file below the directory, however deep.

    Tasks list the folders, names that begin with an underscore and empty files too. Bytes are decoded where they are parsed, so a file that can't be is an error row."""
    files = listing.read_files(listing.named(listing.list_files(spark, directory)))
    return with_places(files.select("path", "xml"), directory)


def with_places(files: DataFrame, directory: str = "") -> DataFrame:
    """Adds what a path says: place below the directory, its own folder, the folder above it (textgroup, as a path) and its folder's name (work), stem, whether it is a catalogue file."""
    base = directory.rstrip("/").removeprefix("file:")
    plain = F.regexp_replace("path", "^file:/*", "/")
    rel = F.when(plain.startswith(base + "/"), F.substr(plain, F.lit(len(base) + 2))).otherwise(F.col("path")) if base else F.col("path")
    folder = F.regexp_extract("rel", "^(.*)/[^/]*$", 1)
    return (
        files.withColumn("rel", rel)
        .withColumn("folder", folder)
        .withColumn("textgroup", F.regexp_extract("folder", "^(.*)/[^/]*$", 1))
        .withColumn("work", file_name(F.col("folder")))
        .withColumn("stem", stem(F.col("path")))
        .withColumn("depth_in_tree", F.size(F.split("rel", "/")))
        .withColumn("is_catalog", file_name(F.col("path")) == CATALOGUE)
    )


def texts(files: DataFrame) -> DataFrame:
    return files.where(~F.col("is_catalog"))


def work_catalogues(files: DataFrame) -> DataFrame:
    """Catalogue files exactly two directories down."""
    return files.where(F.col("is_catalog") & (F.col("depth_in_tree") == 3))


def group_catalogues(files: DataFrame) -> DataFrame:
    return files.where(F.col("is_catalog") & (F.col("depth_in_tree") == 2))


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """An explicit list of files."""
    named = spark.createDataFrame([(qualified(spark, p),) for p in paths], "path string")
    return with_places(listing.read_files(listing.stated(spark, named)).select("path", "xml"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns strings, absent values empty."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    return df.na.fill("")


def genre_lookup(rows: DataFrame) -> DataFrame:
    """stem and genre of a genre map in row order (row_no): recommended, else suggested; the last row of a stem counts."""
    suggested = F.col("suggested_genre") if "suggested_genre" in rows.columns else F.lit("")
    genre = F.coalesce(or_null(strip(F.col("recommended_genre"))), or_null(strip(suggested)), F.lit(""))
    return rows.groupBy(stem(F.col("path")).alias("stem")).agg(F.max_by(genre, "row_no").alias("map_genre"))


def numbered(rows: DataFrame) -> DataFrame:
    """row_no, which rises in file order."""
    return rows.withColumn("row_no", F.monotonically_increasing_id())


def read_validator_log(spark: SparkSession, path: str) -> DataFrame:
    """line of a log; of a folder with a log for each batch (`<family>-<batch>.log`) also its family and batch."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.regexp_extract("_metadata.file_name", r"^(.+)-(\d+)\.log$", 1).alias("family"), F.regexp_extract("_metadata.file_name", r"^(.+)-(\d+)\.log$", 2).try_cast("long").alias("batch"))
    return lines.withColumn("family", F.nullif("family", F.lit("")))


def schemas_in(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """family of the schemas `<prefix><family>.rng` that are in the folder."""
    files = listing.list_files(spark, folder)
    return files.select(F.regexp_extract(file_name(F.col("path")), f"^{re.escape(prefix)}(.+)\\.rng$", 1).alias("family")).where("family != ''").distinct()


def default_taxonomy(spark: SparkSession) -> DataFrame:
    """target, kind (family or subclass), family, default_subclass and description, from the built-in vocabulary."""
    return taxonomy_frame(spark, {family: {s: "" for s in HIERARCHY if s.split("-")[0] == family} for family in FAMILY_DEFAULT})


def taxonomy_frame(spark: SparkSession, families: dict[str, dict[str, str]]) -> DataFrame:
    rows = []
    for family, leaves in sorted(families.items()):
        default = FAMILY_DEFAULT[family]
        if default not in leaves:
            raise ValueError(f"the default {default} of {family} is not in the taxonomy")
        rows.append((family, "family", family, default, ""))
        rows += [(leaf, "subclass", family, default, text) for leaf, text in sorted(leaves.items())]
    return spark.createDataFrame(rows, "target string, kind string, family string, default_subclass string, description string")


def read_taxonomy(spark: SparkSession, odd: str, taxonomy_id: str) -> DataFrame:
    """A taxonomy from an ODD document (a path, or its text): families are the top categories, subclasses the leaves below them, at any depth."""
    from ..operators import taxonomies

    docs = spark.createDataFrame([("odd", odd)], "path string, xml string") if odd.lstrip().startswith("<") else read_files(spark, [odd])
    found = staged(taxonomies.categories(docs, taxonomy_id), "taxonomy")
    if found.isEmpty():
        raise ValueError(f"no taxonomy {taxonomy_id}")
    return staged(taxonomies.checked(found), "taxonomy")


def load_env(path: str) -> None:
    """KEY=VALUE lines into the environment; # starts a comment line; what is set already stays."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in map(str.strip, f):
                if line and not line.startswith("#") and "=" in line:
                    key, value = line.split("=", 1)
                    os.environ.setdefault(key.strip(), value.strip().strip("\"'"))
