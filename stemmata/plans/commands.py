"""The commands: whole plans from a corpus to its tables, and the sinks they are written to."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import map_urn, or_empty, or_null, pipeline_urn, strip, truthy
from ..operators import audit, catalogues, genres, rewrite, schema_files, schematron, structure, validation, vocabulary
from ..operators.axes import probed
from ..operators.shred import AUDIT, CHECKS, HOLDERS, ROOTS, SIGNATURE, shred
from ..runtime import qualified, staged
from ..sources import journal
from ..sources.corpus import MAP_COLUMNS, TEI, group_catalogues, texts, work_catalogues
from ..vocabulary import FAMILY_DEFAULT, NAMES, Names


def base_urns(nodes: DataFrame) -> DataFrame:
    """path and the first body's base."""
    here = (F.col("kind") == "element") & (F.col("ns") == TEI) & (F.col("name") == "body") & F.col("attrs")["xml:base"].isNotNull()
    return nodes.where(here).groupBy("path").agg(F.min_by(F.col("attrs")["xml:base"], "node_id").alias("base_urn"))


def work_table(files: DataFrame, anywhere: bool = False) -> DataFrame:
    """textgroup, work, author, title, description, genre, confidence and urn of each catalogued work: those two folders down, or anywhere."""
    cat = files.where("is_catalog") if anywhere else work_catalogues(files)
    found = catalogues.works(shred(cat)).join(cat.select("path", "textgroup", "work"), "path")
    groups = files.where("is_catalog") if anywhere else group_catalogues(files)
    names = catalogues.group_names(shred(groups)).join(groups.select("path", F.col("folder").alias("textgroup")), "path").select("textgroup", "author")
    return found.join(names, "textgroup", "left").withColumn("author", or_empty(F.col("author")))


def resolved_genres(files: DataFrame, nodes: DataFrame, genre_map: DataFrame | None = None, default: str = "unknown", names: Names = NAMES) -> DataFrame:
    """path and genre: the document's own, that of the catalogue in its own folder, the map's, or the default."""
    docs = texts(files).select("path", "textgroup", "work", "stem")
    own = genres.document_genre(nodes, names)
    cat = work_table(files, anywhere=True).select("textgroup", "work", strip(F.col("genre")).alias("genre_cat"))
    out = docs.join(own.hint("merge"), "path", "left").join(cat, ["textgroup", "work"], "left")
    out = out.join(genre_map, "stem", "left") if genre_map is not None else out.withColumn("map_genre", F.lit(None).cast("string"))
    return out.select("path", "textgroup", "work", "stem", genres.first_of("genre_tei", "genre_cat", "map_genre", default=default).alias("genre"))


def surveyed_genres(files: DataFrame, nodes: DataFrame) -> DataFrame:
    """path and genre of every text."""
    # Places of all files and the text of catalogues, from one reading: both are asked for in several places.
    listed = staged(files.withColumn("xml", F.when(F.col("is_catalog"), F.col("xml"))), "files")
    return staged(resolved_genres(listed, nodes).select("path", "genre"), "genres")


def structural_types(files: DataFrame) -> DataFrame:
    """path, genre and structural_type of every well-formed text, as in the survey's structure table.

    What it asks of the nodes of a document is which kinds there are, so each kind stands once."""
    nodes = staged(shred(texts(files), audit.KINDS, only=audit.STRUCTURAL | {"catRef"}, under=frozenset(("catRef",)), keys=("type", "scheme", "target"), once=True), "kinds")
    return audit.structural_types(nodes).join(surveyed_genres(files, nodes).hint("merge"), "path").select("path", "genre", "structural_type")


def survey(files: DataFrame, nodes: DataFrame | None = None, genre: str | None = None) -> dict[str, DataFrame]:
    """elements, attributes and structure tables of a corpus; a genre narrows all three before anything is counted."""
    # Shredded once: four plans read the nodes.
    nodes = staged(shred(texts(files), AUDIT), "nodes") if nodes is None else nodes
    which = surveyed_genres(files, nodes)
    audited = nodes
    if genre:
        which = which.where(F.col("genre") == genre)
        audited = nodes.join(which.hint("merge"), "path", "left_semi")
    here = nodes.where("kind != 'error'").join(which.hint("merge"), "path")
    report = audit.structure_report(audited).join(which.hint("merge"), "path")
    base = report.select(
        F.col("base_urn").alias("urn"), "path", "genre", "structural_type", F.array_join("div_subtypes", "|").alias("div_subtypes"),
        F.array_join(F.col("milestones.unit"), "|").alias("milestone_units"), F.array_join("issues", "; ").alias("issues"),
    )
    return {
        "elements": vocabulary.ordered_elements(vocabulary.element_counts(vocabulary.files_of(here))),
        "attributes": vocabulary.ordered_attributes(vocabulary.top_values(vocabulary.attribute_values(here))),
        "structure": base.orderBy("path"),
    }


def verified(signed: DataFrame) -> DataFrame:
    """path, structure_signature, proposed_subclass and match of signatures with a family (empty: none)."""
    best = structure.best(structure.fitting(signed, by_family=True))
    default = F.create_map(*[F.lit(x) for pair in FAMILY_DEFAULT.items() for x in pair])[F.col("family")]
    out = signed.join(best, "path", "left")
    return out.select(
        "path", structure.describe().alias("structure_signature"), or_empty(F.coalesce(F.col("best"), default)).alias("proposed_subclass"),
        F.when(or_null(F.col("family")).isNull(), "").when(F.col("best").isNotNull(), "ready").otherwise("review").alias("match"),
    )


def genre_map(files: DataFrame, taxonomy: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """A row for each text of a catalogued work, for review: what its catalogue suggests and what its structure supports."""
    nodes = staged(shred(texts(files), (*SIGNATURE, "node_id", "attrs")), "nodes") if nodes is None else nodes
    works = genres.with_proposal(work_table(files).withColumnRenamed("genre", "suggested_genre"), taxonomy, "suggested_genre")
    works = works.select("textgroup", "work", "author", "title", "suggested_genre", "confidence", F.col("proposed_family").alias("family"))
    works = staged(works, "works")
    docs = texts(files).select("path", "rel", "textgroup", "work").join(works, ["textgroup", "work"])
    signed = structure.signatures(nodes).join(docs.select("path", "family"), "path")
    default = F.create_map(*[F.lit(x) for pair in FAMILY_DEFAULT.items() for x in pair])[F.col("family")]
    out = docs.join(verified(signed), "path", "left").join(base_urns(nodes), "path", "left")
    broken = F.col("match").isNull()
    proposed = F.when(broken, or_empty(default)).otherwise(F.col("proposed_subclass"))
    match = F.when(broken, "review").otherwise(F.col("match"))
    rows = out.select(
        map_urn(F.col("path"), or_empty(F.col("base_urn"))).alias("urn"), F.col("rel").alias("path"), "author", "title", "suggested_genre", "confidence", "family", proposed.alias("proposed_subclass"),
        F.when(broken, "(parse-error)").otherwise(F.col("structure_signature")).alias("structure_signature"), match.alias("match"), F.when(match == "ready", "false").otherwise("true").alias("needs_review"),
        proposed.alias("recommended_genre"), F.lit("").alias("notes"),
    )
    return rows.select(*MAP_COLUMNS)


def map_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("match") == "ready").alias("ready"), F.count_if(F.col("needs_review") == "true").alias("review"))


def invalid_targets(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Rows whose recommended genre no taxonomy has; while there is one, nothing may be applied."""
    wanted = rows.withColumn("genre", strip(or_empty(F.col("recommended_genre")))).where("genre != ''")
    return wanted.join(F.broadcast(taxonomy.select(F.col("target").alias("genre"))), "genre", "left_anti").select("path", "genre")


def apply_plan(rows: DataFrame, docs: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """path, genre, cert and status (apply, skipped, p4, error) of every row of a reviewed map; docs has rel, parse_ok, root_name and root_ns."""
    wanted = rows.select("path", strip(or_empty(F.col("recommended_genre"))).alias("genre"), or_empty(F.col("needs_review")).alias("needs_review"))
    families = F.broadcast(taxonomy.where("kind = 'family'").select(F.col("target").alias("genre"), F.lit(True).alias("is_family")))
    out = wanted.join(families, "genre", "left").join(docs.select(F.col("rel").alias("path"), "parse_ok", "root_name", "root_ns", F.lit(True).alias("there")), "path", "left")
    status = (
        F.when(F.col("genre") == "", "skipped").when(F.col("there").isNull() | ~F.col("parse_ok"), "error").when((F.col("root_name") == "TEI.2") & (F.col("root_ns") == ""), "p4").otherwise("apply")
    )
    cert = F.when((status == "apply") & (F.coalesce("is_family", F.lit(False)) | truthy(F.col("needs_review"))), "low").otherwise("")
    return out.select("path", "genre", cert.alias("cert"), status.alias("status"))


def apply_genre_map(rows: DataFrame, files: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """path, status, xml and error; raises before anything is rewritten if any target is invalid."""
    # All of them: a map is reviewed by hand, so that its faults are few.
    bad = [tuple(r) for r in invalid_targets(rows, taxonomy).collect()]
    if bad:
        raise ValueError(f"invalid genre values, nothing was changed: {bad}")
    docs = roots(shred(texts(files), ROOTS)).join(texts(files).select("path", "rel", "xml"), "path")
    plan = apply_plan(rows, docs, taxonomy)
    todo = plan.where("status = 'apply'").join(docs.select(F.col("rel").alias("path"), "xml"), "path").withColumnRenamed("genre", "target")
    done = rewrite.rewritten(todo, ("set_genre",))
    return plan.join(done, "path", "left").withColumn("status", F.when(F.col("error").isNotNull(), "error").otherwise(F.col("status")))


def roots(nodes: DataFrame) -> DataFrame:
    """path, parse_ok, parse_error, root_name, root_ns of every document."""
    root = (F.col("kind") == "element") & (F.col("depth") == 0)
    return nodes.groupBy("path").agg(
        (F.count_if(F.col("kind") == "error") == 0).alias("parse_ok"), F.max(F.when(F.col("kind") == "error", F.col("text"))).alias("parse_error"),
        F.max(F.when(root, F.col("name"))).alias("root_name"), F.max(F.when(root, F.col("ns"))).alias("root_ns"),
    )


def run_counts(rows: DataFrame) -> DataFrame:
    """How many rows have each status: what a run reports, and the number of errors its exit code."""
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def normalize(files: DataFrame, taxonomy: DataFrame, names: Names = NAMES) -> DataFrame:
    """path, xml and error of every text, rewritten by the pipeline of its genre's family."""
    nodes = staged(shred(texts(files), ("node_id", "kind", "ns", "name", "attrs", "anc_names")), "nodes")
    own = genres.with_family(genres.document_genre(nodes, names, anywhere=True), taxonomy, "genre_tei").select("path", "genre_tei", "family")
    docs = texts(files).select("path", "xml").join(own, "path", "left").join(base_urns(nodes), "path", "left")
    return rewrite.rewritten(docs.withColumn("cts_base", pipeline_urn(F.col("path"), or_empty(F.col("base_urn")))), names=names)


def set_genre(files: DataFrame, target: str, taxonomy: DataFrame, cert: str = "", names: Names = NAMES) -> DataFrame:
    if target and taxonomy.where(F.col("target") == target).isEmpty():
        raise ValueError(f"unknown genre {target!r}")
    return rewrite.rewritten(files.withColumn("target", F.lit(target)).withColumn("cert", F.lit(cert)), ("set_genre",), names)


def validate(files: DataFrame, names: Names = NAMES, schema: schema_files.Schema | None = None) -> DataFrame:
    """path, findings and valid of every text, by the checks of normalized documents or those of a Schematron file."""
    checks = schema.checks if schema else schematron.normalized_checks(names)
    nodes = staged(shred(texts(files), (*(schema.columns if schema else CHECKS), "depth", "text"), schema.holders if schema else HOLDERS, only=schema.asked if schema else schematron.asked(checks), beside=schema.beside if schema else ()), "nodes")
    bad = schematron.gate(schematron.run_checks(probed(nodes, schema.probes, schema.beside) if schema else nodes, checks)).groupBy("path").agg(F.count("*").alias("findings"))
    return roots(nodes).join(bad.hint("merge"), "path", "left").select("path", F.coalesce("findings", F.lit(0)).alias("findings"), (F.col("parse_ok") & F.col("findings").isNull()).alias("valid"))


def validation_plan(resolved: DataFrame, taxonomy: DataFrame, schemas: DataFrame, size: int = validation.BATCH) -> tuple[DataFrame, DataFrame]:
    """The batches in which texts (path, stem, genre) are to be validated, and the counts of what is validated, skipped, or without a schema."""
    files = staged(genres.with_family(resolved, taxonomy).select("path", "stem", "family"), "families")
    return validation.batched(files, schemas, size), validation.batch_counts(files, schemas, size)


def batch_report(lines: DataFrame, batches: DataFrame) -> DataFrame:
    """Counts of the errors in the lines of batches (family, batch, line), by the family of the batch."""
    return validation.ordered(validation.counted(validation.attributed(lines, batches)))


def validation_report(lines: DataFrame, family_of: DataFrame) -> DataFrame:
    """Counts of the errors in the lines of one log; family_of has stem and family of the validated texts, so a stem of two families counts for both."""
    return validation.ordered(validation.counted(validation.parsed(lines).join(family_of, "stem")))


def family_counts(rows: DataFrame) -> DataFrame:
    """Texts by family; those without a valid genre count as skipped."""
    return rows.groupBy(F.coalesce("family", F.lit("skipped")).alias("family")).agg(F.count("*").alias("files"))


# ---- sinks


def write_csv(df: DataFrame, path: str) -> None:
    """One ordered CSV with a header; for reports, whose size is bounded by the vocabulary."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="")


def write_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def targets(paths: DataFrame, folder: str | None, suffix: str = "", root: str | None = None) -> DataFrame:
    """path and target: where each document goes. Below the folder, its path under the root (None: the directory that all share); without a folder, its own place.

    Raises if two documents would go to one place."""
    plain = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    if folder is None:
        out = paths.select("path", F.col("path").alias("target"))
    else:
        # What the least and the greatest path share, all share.
        least, most = paths.agg(F.min(plain), F.max(plain)).first()
        shared = os.path.commonprefix([least or "", most or ""])
        under = re.sub("^[a-z0-9]+:/*", "/", root).rstrip("/") + "/" if root else ""
        place = F.substr(plain, F.lit(len(under) + 1 if under and shared.startswith(under) else shared.rfind("/") + 2))
        out = paths.select("path", F.concat(F.lit(folder.rstrip("/") + "/"), place).alias("target"))
    if suffix:
        out = out.withColumn("target", F.concat(F.regexp_replace("target", r"\.[^./]*$", ""), F.lit(suffix)))
    twice = [r[0] for r in out.groupBy("target").count().where("count > 1").limit(5).collect()]
    if twice:
        raise ValueError(f"several documents would be written to one place, nothing was written: {twice}")
    return out


def write_documents(done: DataFrame, folder: str | None, suffix: str = "", column: str = "xml", root: str | None = None) -> DataFrame:
    """Writes each row's text below the folder (None: to where it came from), keeping the tree, all of them or none; returns path and target.

    The rows are made once. The journal is below the folder, or in the root (else the folder that all share); journal.recover() ends a run that was cut short."""
    spark = done.sparkSession
    folder = folder and qualified(spark, folder)
    rows = staged(done.where(F.col(column).isNotNull()).select("path", column), "documents")
    placed = staged(targets(rows.select("path"), folder, suffix, root), "targets")
    least, most = placed.agg(F.min("target"), F.max("target")).first()
    if least is not None:
        home = folder or root or os.path.commonprefix([least, most]).rpartition("/")[0]
        journal.write_all(rows, placed, home, column)
    return placed


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("__r = 1").drop("__r")
