"""Session defaults and durable intermediates."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold for any input size; partition counts are left to AQE.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Set where the session has Spark's default. A sort-merge join turns into a hash join at run time when every partition of the built
# side is measured to be below this. Written tables are compressed: boxes take some thirty times their file in memory, and a file just
# under the limit for broadcasts would be hundreds of MB in the driver.
RUNTIME = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": ("0b", "64MB"), "spark.sql.sources.fileCompressionFactor": ("1.0", "32.0")}


def tune(spark: SparkSession) -> None:
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    for key, (default, value) in RUNTIME.items():
        if spark.conf.get(key, default).lower() in (default, "0"):
            spark.conf.set(key, value)


def build_session(app: str = "pageloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session with ``values`` set; afterwards as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a private one only where none is set and one machine runs all (tests).

    A cluster without the setting is an error: other machines could not read a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="pageloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


_written: list[str] = []


def _remove_written() -> None:
    """At the end of the application its intermediate tables go, by Spark's own file systems."""
    with contextlib.suppress(Exception):  # the JVM may have ended first
        spark = SparkSession.getActiveSession()
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _written:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder, removed at the end of the application."""
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if not _written:
        atexit.register(_remove_written)
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back.

    Cuts lineage in a way that survives lost executors, and later readers get column pruning and
    filter pushdown, which an RDD checkpoint would not give.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share_pages(spark: SparkSession) -> None:
    """From here on joins on page and more keys take tables that are dealt by page as they lie."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


# Spark adds up the bytes of an open Arrow batch after each row, which takes longer than a row of a few numbers itself. A batch of such rows
# is bounded by their count (spark.sql.execution.arrow.maxRecordsPerBatch); where rows may be large the limit stays.
NARROW_ROWS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1)}


def by_page(df: DataFrame, name: str) -> DataFrame:
    """As :func:`materialize`, dealt by page into as many buckets as there are shuffle partitions: what is keyed by page and more is then
    joined, grouped and ordered without another shuffle, and written again without one if it is still dealt so."""
    n, page = parts(df.sparkSession), ["doc_id", "page_idx"]
    path = scratch(df.sparkSession, name)
    table = re.sub(r"\W", "_", os.path.basename(path))
    # a task has the rows of one bucket and need not sort them by bucket before it writes
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
        df.repartition(n, *page).write.option("path", path).bucketBy(n, *page).saveAsTable(table)
    return df.sparkSession.table(table)
