"""Declarative checks as rule specifications over the node table, and reports read back from their XML form."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import after_hash, collapse, or_empty
from ..runtime import bounded
from ..sources.corpus import TEI
from ..vocabulary import FAMILY_DEFAULT, HIERARCHY, NAMES, Names
from .shred import parse

ASSERT, REPORT = "failed-assert", "successful-report"


@dataclass(frozen=True)
class Check:
    """An assert (a finding where `test` fails) or report (where it holds) on every node of a context."""

    check_id: str
    kind: str
    role: str
    context: Column
    test: Column
    message: Column
    source: str  # the test as it is written in reports
    name: str | None = None  # that of the nodes of the context, where it is known


def asked(checks: list[Check]) -> frozenset[str] | None:
    """The names of the nodes that the checks are about: others need not be made. None: all are."""
    names = frozenset(c.name for c in checks if c.name is not None)
    return names if all(c.name is not None for c in checks) else None


def _holds(path: str) -> Column:
    """Whether a holder of the shredder has this child or grandchild."""
    return F.coalesce(F.array_contains("holds", path), F.lit(False))


def _element(name: str) -> Column:
    return (F.col("kind") == "element") & (F.col("ns") == TEI) & (F.col("name") == name)


# The ids and messages of both lists of checks, and the layout of the text report at the end.
def normalized_checks(names: Names = NAMES) -> list[Check]:
    """What a normalized document must hold."""
    ref = _element("catRef") & (F.col("attrs")["scheme"] == names.scheme)
    target = or_empty(F.col("attrs")["target"])
    base = F.col("attrs")["xml:base"]
    pi = (F.col("kind") == "pi") & (F.col("name") == "xml-model")
    valid = sorted([*HIERARCHY, *FAMILY_DEFAULT])
    text = or_empty(F.col("text"))
    return [
        Check("genre-annotation", ASSERT, "error", _element("profileDesc"), _holds(f"textClass/catRef[@scheme='{names.scheme}']"), F.lit(f"profileDesc must contain textClass/catRef[@scheme='{names.scheme}']. Run set-genre first."), "textClass/catRef", "profileDesc"),
        Check("genre-category", ASSERT, "error", ref, after_hash(target).isin(*valid), F.concat(F.lit("catRef target '"), target, F.lit("' is not a recognized genre category.")), "substring-after(@target, '#') = $valid-genres", "catRef"),
        Check("cts-xml-base", ASSERT, "error", _element("body"), base.isNotNull(), F.lit("body must carry @xml:base with the CTS URN."), "@xml:base", "body"),
        Check("cts-xml-base-urn", ASSERT, "error", _element("body"), or_empty(base).startswith("urn:cts:"), F.concat(F.lit("body/@xml:base must be a CTS URN (starting with 'urn:cts:'). Got: "), or_empty(base)), "starts-with(@xml:base, 'urn:cts:')", "body"),
        Check("cts-idno", ASSERT, "error", _element("publicationStmt"), _holds("idno[@type='CTS']"), F.lit("publicationStmt must contain idno[@type='CTS']."), "idno[@type='CTS']", "publicationStmt"),
        Check("refs-decl", ASSERT, "error", _element("encodingDesc"), _holds("refsDecl[@n='CTS']"), F.lit("encodingDesc must contain refsDecl[@n='CTS']."), "refsDecl[@n='CTS']", "encodingDesc"),
        Check("refs-decl-cite", ASSERT, "error", _element("encodingDesc"), _holds("refsDecl[@n='CTS']/citeStructure"), F.lit("refsDecl[@n='CTS'] must contain a citeStructure element."), "refsDecl[@n='CTS']/citeStructure", "encodingDesc"),
        Check("schema-pi", ASSERT, "error", pi, F.contains(text, F.lit(names.schema_base)), F.concat(F.lit("xml-model PI does not point to a corpus schema. Got: "), text), "contains(., schema base)", "xml-model"),
        Check("schema-pi-types", ASSERT, "error", pi, F.contains(text, F.lit("schematypens")), F.lit("xml-model PI is missing schematypens attribute."), "contains(., 'schematypens')", "xml-model"),
    ]


def encoding_checks(names: Names = NAMES) -> list[Check]:
    """What editors should look at."""
    ref = _element("catRef") & (F.col("attrs")["scheme"] == names.scheme)
    family = after_hash(or_empty(F.col("attrs")["target"]))
    always = F.lit(True)
    return [
        Check("empty-s-milestone", REPORT, "warning", _element("s"), ~F.col("has_child_node"), F.lit("Empty <s/> used as a sentence milestone rather than a segment."), "not(node())", "s"),
        Check("legacy-said", REPORT, "warning", _element("said"), always, F.lit("<said> is a legacy element. Migrate to <q> for quoted speech."), "true()", "said"),
        Check("legacy-docAuthor", REPORT, "warning", _element("docAuthor"), always, F.lit("<docAuthor> is not part of the schema. Use <author> inside titleStmt for a work's author."), "true()", "docAuthor"),
        Check("legacy-reg", REPORT, "warning", _element("reg"), always, F.lit("Standalone <reg> is not allowed. Pair it with the original reading inside a choice."), "true()", "reg"),
        Check("genre-needs-review", REPORT, "warning", ref, (or_empty(F.col("attrs")["cert"]) == "low") | family.isin(*FAMILY_DEFAULT), F.concat(F.lit("Genre classification needs review: the catRef targets a bare family ('"), family, F.lit("') or is marked cert=\"low\".")), "@cert='low' or bare family", "catRef"),
    ]


def _fires(checks: list[Check]) -> list[Column]:
    """Whether a node is a finding of each check."""
    return [c.context & (~F.coalesce(c.test, F.lit(False)) if c.kind == ASSERT else F.coalesce(c.test, F.lit(False))) for c in checks]


def run_checks(nodes: DataFrame, checks: list[Check]) -> DataFrame:
    """path, check_id, kind, role, location (where the nodes have theirs), test, message of every finding; contexts that are absent give none."""
    place = [F.col("location")] if "location" in nodes.columns else []
    fires = _fires(checks)
    each = [
        F.when(
            here,
            F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.kind).alias("kind"), F.lit(c.role).alias("role"), *place, F.lit(c.source).alias("test"), collapse(c.message).alias("message")),
        )
        for c, here in zip(checks, fires)
    ]
    # Most nodes have no finding, and go before any is composed.
    rows = nodes.where(F.col("kind").isin("element", "pi") & reduce(Column.__or__, fires, F.lit(False)))
    return rows.select("path", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("f")).select("path", "f.*")


def count_checks(nodes: DataFrame, checks: list[Check], by: Column) -> DataFrame:
    """by, check_id, findings over nodes that stand for as many as their `times` says: a document's nodes are added up before anything moves."""
    ids = list(dict.fromkeys(c.check_id for c in checks))
    by_id = {i: [f for c, f in zip(checks, _fires(checks)) if c.check_id == i] for i in ids}
    times = lambda fires: reduce(Column.__add__, [F.when(f, F.col("times")).otherwise(0) for f in fires])
    counts = nodes.where("kind = 'element'").groupBy(by).agg(*[F.sum(times(by_id[i])).alias(f"n_{k}") for k, i in enumerate(ids)])
    each = F.array(*[F.struct(F.lit(i).alias("check_id"), F.col(f"n_{k}").alias("findings")) for k, i in enumerate(ids)])
    return counts.select(F.col(counts.columns[0]), F.explode(F.filter(each, lambda x: x["findings"] > 0)).alias("f")).select(F.col(counts.columns[0]), "f.*")


def gate(found: DataFrame) -> DataFrame:
    """The findings that make a document invalid: failed asserts, and reports of role error."""
    return found.where((F.col("kind") == ASSERT) | (F.col("role") == "error"))


def errors(found: DataFrame) -> DataFrame:
    return gate(found)


def warnings(found: DataFrame) -> DataFrame:
    return found.where(F.col("role").isin("warning", "warn"))


SVRL = "http://purl.oclc.org/dsdl/svrl"


def read_svrl(reports: DataFrame) -> DataFrame:
    """path, kind, role, location, test, message of the findings in SVRL reports (path, xml)."""
    bounded(reports.sparkSession)
    names = ["path", "kind", "role", "location", "test", "message"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, xml in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes = parse(xml or "", frozenset())
                for n in nodes:
                    if n["kind"] == "element" and n["ns"] == SVRL and n["name"] in (ASSERT, REPORT):
                        text = next((m["text"] for m in nodes[n["node_id"] : n["end_id"]] if m["name"] == "text"), "")
                        rows.append((path, n["name"], *[n["attrs"].get(k, "") for k in ("role", "location", "test")], " ".join((text or "").split())))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(6)], names=names)

    return reports.select("path", "xml").mapInArrow(run, ", ".join(f"{c} string" for c in names))


def report(found: DataFrame) -> DataFrame:
    """path and the findings of each document in one row."""
    fields = [F.col(c) for c in ("location", "check_id", "kind", "role", "test", "message")]
    return found.groupBy("path").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("findings"))


def report_text(reports: DataFrame) -> DataFrame:
    """path and the report as text."""
    line = "=" * 70
    tag = lambda f: F.when(f["role"] != "", F.upper(f["role"])).otherwise(f["kind"])
    each = F.transform("findings", lambda f: F.concat(F.lit("  ["), tag(f), F.lit("] "), f["location"], F.lit("\n    "), f["message"]))
    head = F.concat(F.lit(f"\n{line}\nFILE: "), F.substring_index("path", "/", -1), F.lit(f"  [schematron audit]\n{line}\n\nFINDINGS ("), F.size("findings").cast("string"), F.lit("):\n"))
    return reports.select("path", F.concat(head, F.array_join(each, "\n")).alias("text"))
