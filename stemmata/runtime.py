"""What operators need of the session: this package on the executors, bounded batches, and intermediate results in the shared folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, whose Python workers need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="stemmata-code-")) / "stemmata_base.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(target))


def bounded(spark: SparkSession, rows: int = 1000, size: str = "8388608") -> None:
    """Ships this package and bounds what one Arrow batch holds, so that long texts don't add up in a Python worker."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    with contextlib.suppress(Exception):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, or the checkpoint folder that the session was given.

    Where neither is set, a local session gets a temporary folder; on a cluster that is an error, as executors wouldn't see it."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    given = context._jsc.sc().getCheckpointDir()
    if given.isEmpty():
        if not found:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            found = "file://" + tempfile.mkdtemp(prefix="stemmata-")
        context.setCheckpointDir(found)
    return found or given.get()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that Spark takes where they are missing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/stemmata/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back: lineage ends here, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def session(app: str = "stemmata", cores: str = "*", memory: str = "4g") -> SparkSession:
    """A local session as the tests and the benchmark use it; on a cluster, pass your own session instead."""
    found = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    found.sparkContext.setLogLevel("ERROR")
    return found
