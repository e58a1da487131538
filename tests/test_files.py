"""Folders listed and files read by tasks, and documents that are written all together or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from stemmata.plans import commands
from stemmata.sources import journal, listing


@pytest.fixture
def tree(tmp_path):
    sizes = {}
    for k in range(150):
        at = tmp_path / "data" / f"g{k % 3}" / f"w{k % 5}" / (f"t{k}.xml" if k % 10 else f"__cts{k}__.xml")
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(b"x" * (k * 100))
        sizes[f"file://{at}"] = k * 100
    (tmp_path / "data" / "top.txt").write_text("no xml")
    (tmp_path / "data" / ".unfinished").mkdir()
    (tmp_path / "data" / ".unfinished" / "a.xml").write_text("x")
    (tmp_path / "data" / "nothing").mkdir()
    return tmp_path / "data", sizes


def test_listing_and_slots(spark, tree):
    folder, sizes = tree
    files = listing.list_files(spark, str(folder))
    assert {x["path"]: x["size"] for x in listing.named(files).collect()} == sizes
    assert files.count() == len(sizes) + 1
    read = listing.read_files(listing.named(files), partition_bytes=200_000)
    got = read.withColumn("slot", F.spark_partition_id()).select("path", "slot", F.length("xml").alias("n")).collect()
    assert {x["path"]: x["n"] for x in got} == sizes
    by_slot = {}
    for x in got:
        by_slot.setdefault(x["slot"], []).append(x["n"] + listing.OPEN_BYTES)
    # No slot holds more than the bound and one file; many small files share one.
    assert all(sum(v) <= 200_000 + max(v) for v in by_slot.values()) and len(by_slot) < len(sizes) / 2 + 8
    assert listing.list_files(spark, str(folder / "nothing")).count() == 0
    assert listing.read_files(listing.list_files(spark, str(folder / "nothing"))).count() == 0
    missing = spark.createDataFrame([(f"file://{folder}/none.xml",)], "path string")
    with pytest.raises(Exception, match="none.xml"):
        listing.stated(spark, missing).collect()


def documents(spark, folder, n=12):
    for k in range(n):
        (folder / f"d{k % 3}").mkdir(parents=True, exist_ok=True)
        (folder / f"d{k % 3}" / f"{k}.xml").write_text(f"old {k}")
    return spark.createDataFrame([(f"file://{folder}/d{k % 3}/{k}.xml", f"new {k}") for k in range(n)], "path string, xml string")


def state(folder):
    """Every file's text, hidden ones too."""
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), errors="replace").read() for d, _, names in os.walk(folder) for f in names}


def texts(word, n=12):
    return {f"d{k % 3}/{k}.xml": f"{word} {k}" for k in range(n)}


def test_all_files_appear(spark, tmp_path):
    done = documents(spark, tmp_path)
    counted = spark.sparkContext.accumulator(0)

    def rewriting(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    out = commands.write_documents(done.mapInArrow(rewriting, done.schema), None)
    assert out.count() == 12 and state(tmp_path) == texts("new")
    assert counted.value == 12  # rewritten once
    assert journal.recover(spark, str(tmp_path)) == {}
    assert commands.write_documents(done.limit(0), None).count() == 0


def targets(done):
    return done.select("path", F.col("path").alias("target"))


def test_cut_short_before_the_mark(spark, tmp_path):
    done = documents(spark, tmp_path)
    at = journal.prepare(done, targets(done), str(tmp_path))
    assert {k: v for k, v in state(tmp_path).items() if k.endswith(".xml") and not k.startswith(".")} == texts("old")
    assert journal.recover(spark, str(tmp_path)) == {at.rpartition("/")[2]: "withdrawn"}
    assert state(tmp_path) == texts("old")


def test_cut_short_after_the_mark(spark, tmp_path):
    """The second phase ends after some moves: recovery goes on, from another session's point of view with nothing but the folder."""
    done = documents(spark, tmp_path)
    at = journal.prepare(done, targets(done), str(tmp_path))
    journal.commit(spark, at)
    for x in journal.plan_of(spark, at).orderBy("target").limit(5).collect():
        os.replace(x["temporary"].removeprefix("file://"), x["target"].removeprefix("file://"))
    found = [v for k, v in state(tmp_path).items() if k.endswith(".xml") and not k.startswith(".")]
    assert {v.split()[0] for v in found} == {"old", "new"}
    assert journal.recover(spark, str(tmp_path)) == {at.rpartition("/")[2]: "appeared"}
    assert state(tmp_path) == texts("new") and journal.recover(spark, str(tmp_path)) == {}


def test_a_file_that_can_not_be_written(spark, tmp_path):
    """One task fails: no file changes, and nothing is left behind."""
    done = documents(spark, tmp_path)
    (tmp_path / "file").write_text("in the way")
    wrong = done.select("path", F.when(F.col("path").endswith("/7.xml"), F.lit(f"file://{tmp_path}/file/7.xml")).otherwise(F.col("path")).alias("target"))
    with pytest.raises(Exception):  # noqa: B017
        journal.write_all(done, wrong, str(tmp_path))
    assert state(tmp_path) == texts("old") | {"file": "in the way"}


def test_two_documents_for_one_place(spark, tmp_path):
    done = documents(spark, tmp_path)
    twice = done.unionByName(done.limit(1))
    with pytest.raises(ValueError, match="nothing was written"):
        commands.write_documents(twice, None)
    assert state(tmp_path) == texts("old")
