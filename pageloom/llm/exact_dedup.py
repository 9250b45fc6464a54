"""Exact dedup by a stream with disk-backed keyed state.

1. ``ingest`` reads the files of a table as a stream. Its state, in RocksDB with checkpoints in the shared folder and no expiry, holds
   for every digest of a normalised text the row that stays so far (length, stable identifier, content locator) and the number of
   rows. Run again on the same checkpoint it takes only the files that are new.
2. ``decide`` reads the state as a table and joins all rows with it. On every hit the full bytes of row and kept row are compared:
   texts that only share a digest are taken out and grouped by their bytes.

Rows of one digest meet in a count and a minimum first, so a text that a third of all rows have costs one row a task. Whole texts are
moved once, those of groups a second time for the comparison, by sort-merge joins that Spark splits where a key is hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, settings
from .common import cut

SPACES = " \t\n\x0b\x0c\r"
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",  # all stores of an executor share so much memory
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each store reserves megabytes of disk, however small it is
}


@dataclass(frozen=True)
class Params:
    digest_bytes: int = 32  # of SHA-256
    batch_bytes: int = 256 << 30  # input of a micro-batch


def normalised(text: Column) -> Column:
    """Whole text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _rows(files: DataFrame, p: Params) -> DataFrame:
    """Of each row the digest, its order among equals (longest, smallest doc_id, null last, then place), and the normalised text."""
    at = files.metadataColumn("_metadata")
    out = files.select(
        F.col("doc_id"), F.char_length(F.coalesce("text", F.lit(""))).alias("length"), normalised(F.col("text")).alias("body"),
        at["file_path"].alias("file"), at["row_index"].alias("row"))
    sha = F.sha2(F.col("body").cast("binary"), 256)
    return out.withColumn("text_sha256", sha).select(
        F.unhex(F.substring("text_sha256", 1, 2 * p.digest_bytes)).alias("digest"), "text_sha256", "body",
        F.struct((-F.col("length")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row").alias("place"))


def ingest(spark: SparkSession, path: str, checkpoint: str, p: Params = Params()) -> None:
    """Takes all files under ``path`` (a Parquet table: a file or a folder) that the state in ``checkpoint`` does not have yet."""
    source = spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", str(p.batch_bytes))
    files = source.parquet(f"{path[:-1]}[{path[-1]}]")  # as a pattern, so that a table of one file is found too
    state = _rows(files, p).groupBy("digest").agg(F.min("place").alias("best"), F.count("*").alias("n"))
    with settings(spark, STORE):
        run = (state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
        run.awaitTermination()


def retained(spark: SparkSession, checkpoint: str, p: Params = Params()) -> DataFrame:
    """(digest, best, n): what the state holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/0")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):  # no file has been read
        return spark.createDataFrame([], "digest binary, best struct<shorter:int,unnamed:boolean,doc_id:long,file:string,row:long>, n long")
    return spark.read.format("statestore").load(checkpoint).select("key.digest", F.col("value.min").alias("best"), F.col("value.count").alias("n"))


def decide(spark: SparkSession, path: str, checkpoint: str, p: Params = Params()) -> DataFrame:
    """(doc_id, file, row, keep_id, group_size, kept, text_sha256) for every row under ``path``, as the state has them.

    Equal are texts that are identical without white space; null and empty texts are equal. Of equal rows the longest original stays,
    then the smallest doc_id (null last); of rows repeated with the same doc_id the one that stands first. Other columns are not read.
    """
    held = cut(retained(spark, checkpoint, p), "exact-state")
    rows = _rows(spark.read.parquet(path), p).join(held, "digest")
    rows = cut(rows.withColumn("body", F.when(F.col("n") > 1, F.col("body"))), "exact-rows")
    differ = _unequal(rows)
    group = {"doc_id": "place.doc_id", "file": "place.file", "row": "place.row"}
    if not differ.isEmpty():
        rows = _regrouped(rows, differ)
    return rows.select(*(F.col(v).alias(k) for k, v in group.items()), F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                       (F.col("place") == F.col("best")).alias("kept"), "text_sha256")


def _unequal(rows: DataFrame) -> DataFrame:
    """(place, digest, body) of hits whose full bytes are not those of the row kept for their digest."""
    several = rows.filter(F.col("n") > 1)
    stays = F.col("place") == F.col("best")
    first = several.filter(stays).select("digest", F.col("body").alias("kept_body"))
    hits = several.filter(~stays).select("digest", "place", "body")
    return cut(hits.join(first, "digest").filter(F.col("body") != F.col("kept_body")).drop("kept_body"), "exact-unequal")


def _regrouped(rows: DataFrame, differ: DataFrame) -> DataFrame:
    """Rows with the groups of ``differ`` on their own, by whole text, and taken off their digest's group."""
    own = differ.groupBy("digest", "body").agg(F.min("place").alias("own_best"), F.count("*").alias("own_n"))
    moved = differ.join(own, ["digest", "body"]).select("place", "own_best", "own_n")
    fewer = differ.groupBy("digest").agg(F.count("*").alias("gone"))
    out = rows.join(moved, "place", "left").join(fewer, "digest", "left")
    return (out.withColumn("n", F.coalesce("own_n", F.col("n") - F.coalesce("gone", F.lit(0)))).withColumn("best", F.coalesce("own_best", "best")))


def exact_duplicates(spark: SparkSession, path: str, p: Params = Params()) -> DataFrame:
    """``ingest`` into a new state, then ``decide``."""
    checkpoint = scratch(spark, "exact-stream")
    ingest(spark, path, checkpoint, p)
    return decide(spark, path, checkpoint, p)


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (SELECT t, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""
