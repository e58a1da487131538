"""Answers are asked for once, whatever fails; batches of validation."""

import collections
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stemmata.operators import validation
from stemmata.plans import annotation, commands
from stemmata.plans.synthetic import NS
from stemmata.sources import corpus

TI = 'xmlns:ti="http://chs.harvard.edu/xmlns/cts"'


@pytest.fixture(scope="module")
def files(spark):
    rows = [("/c/g/__cts__.xml", f"<ti:textgroup {TI}><ti:groupname>G</ti:groupname></ti:textgroup>")]
    for k in range(40):
        rows.append((f"/c/g/w{k:02}/__cts__.xml", f'<ti:work {TI} urn="urn:{k}"><ti:title>T{k}</ti:title>{"<ti:genre>prose</ti:genre>" if k % 10 == 0 else ""}</ti:work>'))
        rows.append((f"/c/g/w{k:02}/t.xml", f"<TEI {NS}><text><body>{'<sp/>' if k % 2 else '<p/>'}</body></text></TEI>"))
    return corpus.with_places(spark.createDataFrame(rows, "path string, xml string"), "/c")


def classifier(log, fail_at=None):
    """Notes every question in a file of its own process; fails when it meets the title."""

    def classify(rows):
        with open(os.path.join(log, f"{os.getpid()}"), "a") as f:
            for r in rows:
                f.write(r["title"] + "\n")
        if any(r["title"] == fail_at for r in rows):
            raise RuntimeError("the model is gone")
        return ["drama-line." if r["structural"] == "drama" else " prose-standard" for r in rows]

    return classify


def asked(log):
    return collections.Counter(line for p in Path(log).iterdir() for line in p.read_text().split())


def test_answers_are_asked_for_once(spark, files, tmp_path):
    tax, log, ledger = corpus.default_taxonomy(spark), tmp_path / "log", str(tmp_path / "ledger")
    log.mkdir()
    assert annotation.dry_run(files, tax, ledger).count() == 36 and not list(log.iterdir())
    with pytest.raises(Exception, match="the model is gone"):
        annotation.annotate_with_ledger(files, tax, classifier(str(log), "T25"), ledger, size=5)
    before = asked(log)
    kept = annotation.answers(spark, ledger).count()
    assert 0 < kept < 36 and annotation.dry_run(files, tax, ledger).count() == 36 - kept
    out = {x["urn"]: x for x in annotation.annotate_with_ledger(files, tax, classifier(str(log)), ledger, size=5).collect()}
    assert len(out) == 36 and out["urn:1"]["genre"] == "drama-line" and out["urn:2"]["genre"] == "prose-standard" and 'confidence="high">drama-line<' in out["urn:1"]["xml"]
    # Twice at most only what was in the batch that failed.
    twice = {t for t, n in asked(log).items() if n > 1}
    assert set(asked(log)) == {f"T{k}" for k in range(40) if k % 10} and "T25" in twice and len(twice) <= 5 and set(twice) <= set(before)
    again = asked(log)
    assert annotation.annotate_with_ledger(files, tax, classifier(str(log)), ledger).count() == 36 and asked(log) == again
    assert annotation.dry_run(files, tax, ledger).count() == 0


def test_a_task_done_again_takes_the_ledger(tmp_path):
    rows = [{"path": "p", "batch": 3, "title": "t", "structural": "drama"}]
    calls = []
    for attempt in "12":
        out = annotation._answered(rows, lambda r: calls.append(1) or ["x. "], f"{tmp_path}/run=a", "a", attempt)
        assert out.to_pylist() == [{"path": "p", "suggestion": "x", "run": "a", "batch": 3, "attempt": "1"}]
    assert len(calls) == 1
    with pytest.raises(ValueError, match="2 answers to 1"):
        annotation._answered([{**rows[0], "batch": 4}], lambda r: ["x", "y"], f"{tmp_path}/run=a", "a", "1")


def test_batches_of_validation(spark, tmp_path):
    rows = [(f"/c/{k % 2}/t{k:04}.xml", f"t{k % 300}", "prose" if k < 900 else "verse" if k < 950 else "drama" if k < 980 else None) for k in range(1000)]
    files = spark.createDataFrame(rows, "path string, stem string, family string").repartition(7)
    schemas = spark.createDataFrame([("prose",), ("verse",), ("verse",), ("none",)], "family string")
    got = validation.batched(files, schemas, 100).collect()
    for family, n in (("prose", 900), ("verse", 50)):
        mine = sorted((x["path"], x["batch"]) for x in got if x["family"] == family)
        assert [b for _, b in mine] == [i // 100 for i in range(n)]
    assert len(got) == 950
    counts = {(x["family"], x["status"], x["files"], x["batches"]) for x in validation.batch_counts(files, schemas, 100).collect()}
    assert counts == {("prose", "validated", 900, 9), ("verse", "validated", 50, 1), ("drama", "schema not found", 30, 0), ("", "skipped", 20, 0)}
    assert validation.batched(files.limit(0), schemas).count() == 0
    batches = spark.createDataFrame([("prose", 0, "/a/t.xml", "t"), ("prose", 1, "/b/t.xml", "t"), ("verse", 0, "/c/t.xml", "t")], "family string, batch long, path string, stem string")
    for family, batch, n in (("prose", 0, 1), ("prose", 1, 2), ("verse", 0, 3)):
        (tmp_path / f"{family}-{batch}.log").write_text('/x/t.xml:1:2: error: element "l" not allowed here; expected p\n' * n + "fine\n/x/u.xml:1:2: error: text not allowed here\n")
    lines = corpus.read_validator_log(spark, str(tmp_path))
    found = {(x["path"], x["stem"]): x["n"] for x in validation.attributed(lines, batches).groupBy("path", "stem").agg(F.count("*").alias("n")).collect()}
    assert found == {("/a/t.xml", "t"): 1, ("/b/t.xml", "t"): 2, ("/c/t.xml", "t"): 3, (None, "u"): 3}
    report = {(x["family"], x["element"]): (x["instance_count"], x["file_count"]) for x in commands.batch_report(lines, batches).collect()}
    assert report[("prose", "l")] == (3, 1) and report[("verse", "l")] == (3, 1) and report[("prose", "")] == (2, 1)
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "x-prose.rng").write_text("")
    (tmp_path / "s" / "y.rng").write_text("")
    assert [x[0] for x in corpus.schemas_in(spark, str(tmp_path / "s"), "x-").collect()] == ["prose"]
    resolved = spark.createDataFrame([("/a.xml", "a", "prose-standard"), ("/b.xml", "b", "verse"), ("/c.xml", "c", "unknown")], "path string, stem string, genre string")
    plan, summary = commands.validation_plan(resolved, corpus.default_taxonomy(spark), spark.createDataFrame([("prose",)], "family string"))
    assert [tuple(x) for x in plan.collect()] == [("prose", 0, "/a.xml", "a")]
    assert {(x["family"], x["status"]) for x in summary.collect()} == {("prose", "validated"), ("verse", "schema not found"), ("", "skipped")}
