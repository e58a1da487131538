"""Command line: python -m stemmata.cli COMMAND ... ; each command is a thin wrapper around its plan.

The exit code is the number of documents with an error (255 at most), as a caller may want to stop on it."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import audit, catalogues, genres, schema_files, schematron
from .operators.axes import probed
from .operators.shred import HOLDERS, shred
from .plans import annotation, commands
from .sources import corpus
from .vocabulary import Names


def _folder(args) -> str | None:
    """Where documents go: below the output folder, or with --in-place to where they came from."""
    return None if args.in_place else args.output


def _root(args) -> str | None:
    """The corpus folder, below which documents keep their places; None for a list of files."""
    return os.path.abspath(args.input[0]) if len(args.input) == 1 and not args.input[0].endswith(".xml") and "://" not in args.input[0] else None


def _files(spark: SparkSession, args) -> DataFrame:
    return corpus.read_corpus(spark, args.input[0]) if len(args.input) == 1 and not args.input[0].endswith(".xml") else corpus.read_files(spark, args.input)


def _taxonomy(spark: SparkSession, args) -> DataFrame:
    return corpus.read_taxonomy(spark, args.odd, args.taxonomy_id) if args.odd else corpus.default_taxonomy(spark)


def _names(args) -> Names:
    given = {k: getattr(args, k) for k in ("scheme", "schema_base", "schema_prefix") if getattr(args, k)}
    return Names(**given)


def _schema(args) -> schema_files.Schema | None:
    return schema_files.read_schema(args.schematron) if args.schematron else None


def _write(done: DataFrame, output: str | None, root: str | None, suffix: str = "", column: str = "xml") -> int:
    """Writes the documents and reports the errors, whose number it returns."""
    done = done.persist()
    bad = done.where(F.col("error").isNotNull()).select("path", "error") if "error" in done.columns else None
    written = commands.write_documents(done, output, suffix, column, root).count()
    errors = bad.count() if bad is not None else 0
    print(f"{written} written, {errors} errors", file=sys.stderr)
    for r in bad.limit(20).collect() if errors else ():
        print(f"ERROR: {r[0]}: {r[1]}", file=sys.stderr)
    return errors


def survey(spark, args):
    found = commands.survey(_files(spark, args), genre=args.genre)
    for name, df in found.items():
        commands.write_csv(df, f"{args.output}/{name}")


def genre_map(spark, args):
    rows = commands.genre_map(_files(spark, args), _taxonomy(spark, args)).orderBy("path")
    commands.write_csv(rows, args.output)
    ready, review = commands.map_summary(rows).first()
    print(f"{ready} ready, {review} to review", file=sys.stderr)


def apply_map(spark, args):
    files = _files(spark, args)
    out = commands.apply_genre_map(corpus.read_csv(spark, args.map), files, _taxonomy(spark, args)).persist()
    counts = {r["status"]: r["n"] for r in commands.run_counts(out).collect()}
    print(", ".join(f"{n} {k}" for k, n in sorted(counts.items())), file=sys.stderr)
    commands.write_documents(out.where("status = 'apply'").join(files.select("rel", "path").withColumnsRenamed({"path": "whole", "rel": "path"}), "path").withColumn("path", F.col("whole")), _folder(args), root=_root(args)).count()
    return counts.get("error", 0)


def annotate(spark, args):
    files, tax = _files(spark, args), _taxonomy(spark, args)
    if args.dry_run:
        asked = annotation.dry_run(files, tax, args.ledger).orderBy("path")
        print(f"{asked.count()} to ask", file=sys.stderr)
        for r in asked.limit(20).collect():
            print(f"--- {r['urn']}\n{r['prompt']}", file=sys.stderr)
        return 0
    corpus.load_env(".env")  # what a classifier may need
    done = annotation.annotate_with_ledger(files, tax, catalogues.by_structure, args.ledger) if args.ledger else annotation.annotate(files, tax)
    return _write(done, _folder(args), _root(args))


def normalize(spark, args):
    return _write(commands.normalize(corpus.texts(_files(spark, args)), _taxonomy(spark, args), _names(args)), _folder(args), _root(args))


def set_genre(spark, args):
    return _write(commands.set_genre(corpus.texts(_files(spark, args)), args.genre or "", _taxonomy(spark, args), args.cert, _names(args)), _folder(args), _root(args))


def validate(spark, args):
    out = commands.validate(_files(spark, args), _names(args), _schema(args)).where("not valid").persist()
    for r in out.orderBy("path").limit(200).collect():
        print(f"{r['path']}: {r['findings']} findings", file=sys.stderr)
    return out.count()


def _reports(suffix):
    def run(spark, args):
        schema = _schema(args)
        nodes = shred(corpus.texts(_files(spark, args)), holders=schema.holders if schema else HOLDERS)
        if suffix == "schema":
            names = _names(args)
            checks = schema.checks if schema else schematron.normalized_checks(names) + schematron.encoding_checks(names)
            report = schematron.report(schematron.run_checks(probed(nodes, schema.probes) if schema else nodes, checks))
            shown = schematron.report_text(report)
        else:
            report = audit.reference_report(nodes) if suffix == "refs" else audit.structure_report(nodes)
            shown = audit.reference_text(report) if suffix == "refs" else audit.structure_text(report)
        if args.json:
            _write(audit.as_json(report), args.output, _root(args), f"-{suffix}.json", "json")
        else:
            _write(shown, args.output, _root(args), f"-{suffix}.txt", "text")
        return commands.roots(nodes).where("not parse_ok").count()

    return run


def rng_report(spark, args):
    files = _files(spark, args)
    lookup = corpus.genre_lookup(corpus.numbered(corpus.read_csv(spark, args.map))) if args.map else None
    resolved = commands.resolved_genres(files, shred(corpus.texts(files)), lookup, default="", names=_names(args))
    tax = _taxonomy(spark, args)
    lines = corpus.read_validator_log(spark, args.log)
    if args.schemas:
        batches, counts = commands.validation_plan(resolved, tax, corpus.schemas_in(spark, args.schemas, _names(args).schema_prefix))
        for r in counts.orderBy("family").collect():
            print(f"{r['family'] or '(no genre)'}: {r['files']} {r['status']}", file=sys.stderr)
        commands.write_csv(commands.batch_report(lines.where("family is not null"), batches), args.output)
        return
    families = genres.with_family(resolved, tax).where("family is not null").select("stem", "family").distinct()
    commands.write_csv(commands.validation_report(lines.select("line"), families), args.output)


COMMANDS = {
    "survey": survey, "genre-map": genre_map, "apply-genre-map": apply_map, "annotate": annotate, "normalize": normalize, "set-genre": set_genre, "validate": validate,
    "audit-refs": _reports("refs"), "audit-structure": _reports("structure"), "audit-schema": _reports("schema"), "validation-report": rng_report,
}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="stemmata")
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("input", nargs="+", help="a corpus folder, or XML files")
    p.add_argument("-o", "--output", default="out")
    for name in ("odd", "map", "log", "schemas", "genre", "scheme", "schema-base", "schema-prefix", "schematron", "ledger"):
        p.add_argument(f"--{name}")
    p.add_argument("--taxonomy-id", default="genres")
    p.add_argument("--cert", default="")
    p.add_argument("--json", action="store_true")
    p.add_argument("--dry-run", action="store_true", help="show what would be asked")
    p.add_argument("--in-place", action="store_true", help="rewrite documents where they are")
    args = p.parse_args(argv)
    from .runtime import session

    return min(255, COMMANDS[args.command](SparkSession.getActiveSession() or session(), args) or 0)


if __name__ == "__main__":
    sys.exit(main())
