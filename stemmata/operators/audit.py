"""Audits: rules as Columns over a facts table, citation levels, milestones, and the reports made of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import or_empty, or_null
from ..sources.corpus import TEI


@dataclass(frozen=True)
class Rule:
    """A finding for each document where `fires` holds."""

    rule_id: str
    role: str
    fires: Column
    message: Column
    location: Column | None = None
    description: str = ""


RULES: dict[str, Callable[[], Rule]] = {}
#: What audits ask for, for shred's `only` (besides each document's root), its `under`, and its columns.
NAMED = frozenset(("div", "milestone", "refsDecl", "citeStructure", "cRefPattern"))
UNDER = frozenset(("refsDecl", "citeStructure", "cRefPattern"))
#: The same for structural types alone.
STRUCTURAL = frozenset(("div", "milestone"))
KINDS = ("node_id", "kind", "ns", "name", "attrs", "anc_names")
COLUMNS = ("node_id", "parent_id", "depth", "kind", "ns", "name", "attrs", "anc_textparts", "anc_names", "doc_base")


def audit_rule(rule_id: str, role: str = "warning", description: str = "") -> Callable:
    """Registers a function that returns (fires, message) as a rule."""

    def take(f: Callable[[], tuple[Column, Column]]) -> Callable[[], Rule]:
        def rule() -> Rule:
            fires, message = f()
            return Rule(rule_id, role, fires, message, description=description)

        RULES[rule_id] = rule
        return rule

    return take


def wrong_base(part: Column) -> Column:
    """Whether a text part has a base that doesn't begin with the document's, where the document has one."""
    base = F.col("attrs")["xml:base"]
    return part & base.isNotNull() & (F.col("doc_base") != "") & ~base.startswith(F.col("doc_base"))


def first_wrong(parts: DataFrame, by: list[str], k: int = 3) -> DataFrame:
    """The first k wrong bases (expected, actual) of each group as `examples`: ranked before they are brought together, so no more of a group ever meet."""
    rows = parts.where(wrong_base(F.lit(True))).select(*by, "node_id", F.col("doc_base").alias("expected"), F.col("attrs")["xml:base"].alias("actual"))
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("node_id"))).where(F.col("place") <= k)
    found = first.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("place", "expected", "actual"))).alias("w"))
    return found.select(*by, F.transform("w", lambda w: F.struct(w["expected"].alias("expected"), w["actual"].alias("actual"))).alias("examples"))


def facts(nodes: DataFrame) -> DataFrame:
    """One row for each well-formed document, with all that the rules ask."""
    tei = (F.col("kind") == "element") & (F.col("ns") == TEI)
    part = tei & (F.col("name") == "div") & (F.col("attrs")["type"] == "textpart")
    base = F.col("attrs")["xml:base"]
    parent = F.slice("anc_names", -2, 2)
    decl = tei & (F.col("name") == "refsDecl") & F.when(F.size("anc_names") >= 2, parent == F.array(F.lit("teiHeader"), F.lit("encodingDesc"))).otherwise(False)
    cite = tei & (F.col("name") == "citeStructure") & F.when(F.size("anc_names") >= 3, F.slice("anc_names", -3, 3) == F.array(F.lit("teiHeader"), F.lit("encodingDesc"), F.lit("refsDecl"))).otherwise(False)
    crefs = tei & (F.col("name") == "cRefPattern") & (F.element_at("anc_names", -1) == "refsDecl")
    ordered = lambda when, *what: F.array_sort(F.collect_list(F.when(when, F.struct("node_id", *what))))
    # The root stands for a document with nothing else.
    rows = nodes.where((F.col("kind") == "element") & ((F.col("depth") == 0) | F.col("name").isin(*NAMED))).withColumn("anc_names", F.when(F.size("anc_names") > 0, F.col("anc_names")).otherwise(F.array(F.lit(""))))
    out = rows.groupBy("path").agg(
        or_empty(F.max("doc_base")).alias("base_urn"),
        F.count_if(part).alias("textparts"),
        F.count_if(part & F.col("attrs")["n"].isNull()).alias("without_n"),
        F.array_sort(F.collect_set(F.when(part & F.col("attrs")["n"].isNull(), F.coalesce(F.col("attrs")["subtype"], F.lit("(none)"))))).alias("subtypes_without_n"),
        F.count_if(tei & (F.col("name") == "milestone")).alias("milestones"),
        F.count_if(wrong_base(part)).alias("wrong_count"),
        ordered(decl, or_empty(F.col("attrs")["xml:id"]).alias("id"), or_empty(F.col("attrs")["default"]).alias("default")).alias("decls"),
        ordered(cite, F.col("parent_id").alias("decl")).alias("cites"),
        ordered(crefs, or_empty(F.col("attrs")["n"]).alias("n")).alias("crefs"),
    )
    out = out.join(first_wrong(nodes.where(part), ["path"]).select("path", F.col("examples.actual").alias("wrong_examples")).hint("merge"), "path", "left")
    defaults = F.filter("decls", lambda d: d["default"] == "true")
    return (
        out.withColumn("wrong_examples", F.coalesce("wrong_examples", F.array().cast("array<string>")))
        .withColumn("has_cite_structures", F.size("cites") > 0)
        .withColumn("has_default_refsdecl", F.size(defaults) > 0)
        .withColumn("default_is_cite_structure", F.when((F.size(defaults) > 0) & (F.size("cites") > 0), F.get("cites", F.lit(0))["decl"] == F.get(defaults, F.lit(0))["node_id"]).otherwise(False))
        .withColumn("has_divs", F.col("textparts") > 0)
        .withColumn("has_milestones", F.col("milestones") > 0)
    )


def structural_types(nodes: DataFrame) -> DataFrame:
    """path and structural_type of each well-formed document; nodes may be those of its kinds (KINDS)."""
    tei = (F.col("kind") == "element") & (F.col("ns") == TEI)
    part = tei & (F.col("name") == "div") & (F.col("attrs")["type"] == "textpart")
    out = nodes.where("kind = 'element'").groupBy("path").agg((F.count_if(part) > 0).alias("has_divs"), (F.count_if(tei & (F.col("name") == "milestone")) > 0).alias("has_milestones"))
    return out.select("path", structural_type().alias("structural_type"))


def structural_type() -> Column:
    both, divs = F.col("has_divs") & F.col("has_milestones"), F.col("has_divs")
    return F.when(both, "mixed").when(divs, "div-based").when(F.col("has_milestones"), "milestone-based").otherwise("unknown")


# Identifiers, roles and messages of the built-in rules.
@audit_rule("REF001", role="warning")
def base_urn_rule():
    return F.col("base_urn") == "", F.lit("CTS URN not found on <body>/@xml:base — ReferenceParser requires it there, not on <div type='edition'>/@n")


@audit_rule("REF002", role="info")
def cite_structures_rule():
    return ~F.col("has_cite_structures"), F.lit("No <citeStructure> elements found; only legacy <cRefPattern> declarations present")


@audit_rule("REF003", role="warning")
def default_declaration_rule():
    return ~F.col("has_default_refsdecl"), F.lit("<citeStructure> present but no <refsDecl default='true'>; ReferenceParser cannot auto-select a declaration")


@audit_rule("STR001", role="warning")
def has_structure_rule():
    return ~F.col("has_divs") & ~F.col("has_milestones"), F.lit("No <div type='textpart'> or <milestone> elements found; document appears unstructured.")


@audit_rule("STR002", role="info")
def mixed_structure_rule():
    return F.col("has_divs") & F.col("has_milestones"), F.lit("Document uses both <div type='textpart'> and <milestone> elements; citation may be ambiguous.")


@audit_rule("STR003", role="warning")
def numbered_divs_rule():
    text = F.concat(F.col("without_n").cast("string"), F.lit(" <div type='textpart'> element(s) lack @n (subtypes: "), F.array_join("subtypes_without_n", ", "), F.lit("); citation by position unreliable."))
    return F.col("without_n") > 0, text


@audit_rule("STR004", role="warning")
def base_values_rule():
    examples = F.array_join(F.transform("wrong_examples", lambda b: F.concat(F.lit("  "), b)), "\n")
    text = F.concat(F.col("wrong_count").cast("string"), F.lit(" <div type='textpart'>/@xml:base value(s) do not start with the document base URN ("), F.col("base_urn"), F.lit("). Examples:\n"), examples)
    return F.col("wrong_count") > 0, text


REFERENCE_RULES, STRUCTURE_RULES = ("REF001", "REF002", "REF003"), ("STR001", "STR002", "STR003", "STR004")


def _fired(rules: list[Rule]) -> Column:
    """What the rules that fire say of a document, in their order."""
    each = [
        F.when(r.fires, F.struct(F.lit(i).alias("rule_no"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.role).alias("role"), r.message.alias("message"), (F.lit("") if r.location is None else r.location).alias("location")))
        for i, r in enumerate(rules)
    ]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def findings(table: DataFrame, rules: list[Rule]) -> DataFrame:
    """path, rule_no, rule_id, role, message, location of every rule that fires, all rules in one pass."""
    return table.select("path", F.explode(_fired(rules)).alias("f")).select("path", "f.*")


def run_rules(nodes: DataFrame, ids: tuple[str, ...]) -> DataFrame:
    return findings(facts(nodes), [RULES[i]() for i in ids])


def with_role(found: DataFrame, role: str) -> DataFrame:
    return found.where(F.col("role") == role)


def citation_levels(nodes: DataFrame) -> DataFrame:
    """One row for each document and subtype of text part, in the order of depth (level_no)."""
    tei = (F.col("kind") == "element") & (F.col("ns") == TEI)
    part = tei & (F.col("name") == "div") & (F.col("attrs")["type"] == "textpart")
    subtype = or_empty(F.col("attrs")["subtype"])
    rows = nodes.where(part)
    right = (F.col("doc_base") != "") & F.coalesce(F.col("attrs")["xml:base"].startswith(F.col("doc_base")), F.lit(False))
    out = rows.groupBy("path", subtype.alias("subtype")).agg(
        (F.min_by("anc_textparts", "node_id") + 1).alias("depth"),
        F.min("node_id").alias("first_node"),
        F.count("*").alias("count"),
        F.count_if(F.col("attrs")["n"].isNotNull()).alias("with_n"),
        F.count_if(F.col("attrs")["xml:base"].isNotNull()).alias("with_base"),
        F.count_if(F.col("attrs")["xml:id"].isNotNull()).alias("with_id"),
        F.count_if(right).alias("base_correct"),
    )
    examples = first_wrong(rows.where(F.col("attrs")["xml:base"] != "").withColumn("subtype", subtype), ["path", "subtype"]).withColumnRenamed("examples", "base_wrong_examples")
    out = out.join(examples.hint("merge"), ["path", "subtype"], "left")
    out = out.withColumn("base_wrong_examples", F.coalesce("base_wrong_examples", F.array().cast("array<struct<expected: string, actual: string>>")))
    return out.withColumn("element", F.lit("div")).withColumn("level_no", F.row_number().over(Window.partitionBy("path").orderBy("depth", "first_node")))


def milestones(nodes: DataFrame) -> DataFrame:
    tei = (F.col("kind") == "element") & (F.col("ns") == TEI) & (F.col("name") == "milestone")
    return nodes.where(tei).groupBy("path", or_empty(F.col("attrs")["unit"]).alias("unit")).agg(F.count("*").alias("count"))


def proposed_structure(subtypes: Column) -> Column:
    """The citation declaration that the levels suggest, outermost level first."""
    n = F.size(subtypes)
    line = lambda s, i: F.concat(
        F.repeat(F.lit("  "), i + 1), F.lit('<citeStructure unit="'), s, F.lit('" match="tei:div[@subtype=\''), s, F.lit('\']" use="@n" delim="'), F.when(i == 0, ":").otherwise("."), F.when(i == n - 1, '"/>').otherwise('">')
    )
    ends = F.transform(F.when(n > 1, F.reverse(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))))).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.repeat(F.lit("  "), i), F.lit("</citeStructure>")))
    whole = F.array_join(F.concat(F.array(F.lit('<refsDecl default="true">')), F.transform(subtypes, line), ends, F.array(F.lit("</refsDecl>"))), "\n")
    return F.when(n == 0, F.lit("(no citation structure detected)")).otherwise(whole)


def _issues(ids: tuple[str, ...]) -> Column:
    """The messages of the rules that fire, from a document's facts: nothing is gathered again."""
    return F.transform(_fired([RULES[i]() for i in ids]), lambda f: f["message"])


def reference_report(nodes: DataFrame) -> DataFrame:
    declared = F.transform("decls", lambda d: F.exists("cites", lambda c: c["decl"] == d["node_id"]))
    return facts(nodes).select(
        "path", "base_urn", F.size("decls").alias("refsDecl_count"), F.col("decls.id").alias("refsDecl_ids"), declared.alias("refsDecl_has_cite_structure"),
        "has_cite_structures", F.col("has_default_refsdecl").alias("has_default_refsDecl"), _issues(REFERENCE_RULES).alias("issues"),
    )


def structure_report(nodes: DataFrame) -> DataFrame:
    level = F.struct("level_no", "element", "subtype", "depth", "count", "with_n", "with_base", "with_id", "base_correct", "base_wrong_examples")
    levels = citation_levels(nodes).groupBy("path").agg(F.array_sort(F.collect_list(level)).alias("levels"))
    marks = milestones(nodes).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("unit", "count"))).alias("marks"))
    both = facts(nodes).join(levels.hint("merge"), "path", "left").join(marks.hint("merge"), "path", "left")
    for df, c in ((levels, "levels"), (marks, "marks")):
        both = both.withColumn(c, F.coalesce(c, F.array().cast(df.schema[c].dataType)))
    subtypes = F.col("levels.subtype")
    plain = F.transform("levels", lambda v: F.struct(*[v[c].alias(c) for c in ("element", "subtype", "depth", "count", "with_n", "with_base", "with_id", "base_correct", "base_wrong_examples")]))
    return both.select(
        "path", "base_urn", structural_type().alias("structural_type"), plain.alias("citation_levels"), F.col("marks").alias("milestones"), F.col("crefs.n").alias("cref_patterns"),
        _issues(STRUCTURE_RULES).alias("issues"), proposed_structure(subtypes).alias("proposed_cite_structure"), subtypes.alias("div_subtypes"),
    )


def as_json(report: DataFrame) -> DataFrame:
    """path and each row as indented JSON."""
    return report.select("path", F.to_json(F.struct(*report.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


# The layout of the text reports below, which other programs may read.
_RULE = "=" * 70


def finding_text(found: DataFrame) -> DataFrame:
    """path and the findings of a rule report as text, in the order of the rules."""
    head = F.concat(F.lit(f"\n{_RULE}\nFILE: "), F.substring_index("path", "/", -1), F.lit(f"  [rule audit]\n{_RULE}\n\nFINDINGS ("), F.size("f").cast("string"), F.lit("):\n"))
    each = F.transform("f", lambda x: F.concat(F.lit("  ["), F.upper(x["role"]), F.lit("] "), x["rule_id"], F.when(x["location"] != "", F.concat(F.lit(" — "), x["location"])).otherwise(""), F.lit("\n    "), x["message"]))
    rows = found.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("rule_no", "rule_id", "role", "message", "location"))).alias("f"))
    return rows.select("path", F.concat(head, F.array_join(each, "\n")).alias("text"))


def reference_text(report: DataFrame) -> DataFrame:
    """path and the reference report as text."""
    shown = lambda b: F.when(b, "True").otherwise("False")
    decls = F.zip_with("refsDecl_ids", "refsDecl_has_cite_structure", lambda i, c: F.concat(F.lit("  id="), F.coalesce(or_null(i), F.lit("(none)")), F.lit(" citeStructure="), shown(c)))
    issues = F.when(F.size("issues") > 0, F.concat(F.array(F.lit("\nISSUES:")), F.transform("issues", lambda x: F.concat(F.lit("  "), x)))).otherwise(F.array(F.lit("\nNo issues found.")))
    lines = F.concat(
        F.array(
            F.lit(f"\n{_RULE}"), F.concat(F.lit("FILE: "), F.substring_index("path", "/", -1), F.lit("  [reference audit]")), F.lit(_RULE),
            F.concat(F.lit("Edition URN:         "), F.coalesce(or_null(F.col("base_urn")), F.lit("(none)"))), F.concat(F.lit("Has citeStructure:   "), shown(F.col("has_cite_structures"))),
            F.concat(F.lit("Has default refsDecl:"), shown(F.col("has_default_refsDecl"))), F.lit("\nREFSDECLS:"),
        ),
        decls, issues,
    )
    return report.select("path", F.array_join(lines, "\n").alias("text"))


def structure_text(report: DataFrame) -> DataFrame:
    """path and the structure report as text."""
    left, right = lambda c, n: F.rpad(c, F.greatest(F.lit(n), F.length(c)), F.lit(" ")), lambda c, n: F.lpad(c.cast("string"), F.greatest(F.lit(n), F.length(c.cast("string"))), F.lit(" "))
    joined = lambda c: F.coalesce(or_null(F.array_join(c, ", ")), F.lit("(none)"))
    wrong = lambda v: F.array_join(F.transform(v["base_wrong_examples"], lambda w: F.concat(F.lit("\n    xml:base problems (examples):\n      expected prefix: "), w["expected"], F.lit("\n      actual:          "), w["actual"])), "")
    level = lambda v: F.concat(
        F.concat_ws(" ", F.concat(F.lit("  "), left(v["element"], 8)), left(v["subtype"], 12), right(v["depth"], 5), right(v["count"], 7), right(v["with_n"], 7), right(v["with_base"], 9), right(v["with_id"], 7), right(v["base_correct"], 8)), wrong(v)
    )
    marks = F.when(F.size("milestones") > 0, F.concat(F.array(F.lit("\nMILESTONES:")), F.transform("milestones", lambda m: F.concat(F.lit("  unit='"), m["unit"], F.lit("': "), m["count"].cast("string"))))).otherwise(F.array().cast("array<string>"))
    issues = F.when(F.size("issues") > 0, F.concat(F.array(F.lit("\nISSUES:")), F.transform("issues", lambda x: F.concat(F.lit("  "), x)))).otherwise(F.array(F.lit("\nNo issues found.")))
    titles = f"  {'element':<8} {'subtype':<12} {'depth':>5} {'count':>7} {'@n':>7} {'xml:base':>9} {'xml:id':>7} {'base OK':>8}"
    dashes = "  " + " ".join("-" * n for n in (8, 12, 5, 7, 7, 9, 7, 8))
    lines = F.concat(
        F.array(
            F.lit(f"\n{_RULE}"), F.concat(F.lit("FILE: "), F.substring_index("path", "/", -1), F.lit("  [structure audit]")), F.lit(_RULE),
            F.concat(F.lit("Base URN:         "), F.coalesce(or_null(F.col("base_urn")), F.lit("(none found)"))), F.concat(F.lit("Structural type:  "), F.col("structural_type")),
            F.concat(F.lit("cRefPatterns:     "), joined("cref_patterns")), F.lit("\nCITATION LEVELS:"), F.lit(titles), F.lit(dashes),
        ),
        F.transform("citation_levels", level), marks, issues, F.array(F.concat(F.lit("\nPROPOSED citeStructure:\n"), F.col("proposed_cite_structure"))),
    )
    return report.select("path", F.array_join(lines, "\n").alias("text"))
