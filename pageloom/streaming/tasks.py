"""Task and document streams."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import checkpoint_root
from ..sources.files import route_by_extension

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process all that has arrived, into a table of the checkpoint folder; progress is kept beside it."""
    spark = stream.sparkSession
    base = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    query = (
        stream.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/table")
        .option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def read_folder(spark: SparkSession, folder: str, like: DataFrame, **options) -> DataFrame:
    """Stream of the parquet files of a folder."""
    return spark.readStream.schema(like.schema).options(**options).parquet(folder)


OUTPUT = "task_id bigint, event_id bigint, ts timestamp, status string, worker string, legal boolean"
BUCKETS = 4096  # of tasks, each with one state; as with shuffle partitions, a stream keeps the number that it began with
MEMORY = "tasks array<bigint>, status array<string>, worker array<string>"


def _advance(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known = {task: (status, worker) for task, status, worker in zip(*state.get)} if state.exists else {}
    events = pd.concat(list(batches), ignore_index=True).sort_values(["task_id", "ts", "event_id"])
    legal = []
    for task, new, by in zip(events["task_id"].tolist(), events["status"].tolist(), events["worker"].tolist()):
        task = None if task != task else task
        status, worker = known.get(task, (None, None))
        if new == "pending":
            ok = status is None
        elif new in ("processing", "cancelled"):
            ok = status == "pending"
        else:
            ok = new in ("completed", "failed") and status == "processing" and by == worker
        legal.append(ok)
        known[task] = (new, by if new == "processing" else worker) if ok else (status, worker)
    state.update(([*known], [s for s, _ in known.values()], [w for _, w in known.values()]))
    yield events.assign(legal=legal)[["task_id", "event_id", "ts", "status", "worker", "legal"]]


def task_transitions(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """ST2: each task event with ``legal``; illegal ones are the reject output.

    The state of a task is its status and worker. Events of one task within a batch are taken in time order. Tasks share the state of
    their bucket, as a call of the function for each task costs a hundred times what its few events do.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = events.select("task_id", "event_id", "ts", "status", F.col("worker").cast("string").alias("worker"))
    # Events without a task are apart: in a frame with them other ids would be floats.
    bucket = F.when(F.col("task_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("task_id"), F.lit(buckets)))
    return rows.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(_advance, OUTPUT, MEMORY, "append", GroupStateTimeout.NoTimeout)


def queue_monitor(events: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """ST3: events per window and status, emitted once the watermark has passed the window."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    counts = timed.withWatermark("ts", late).groupBy(F.window("ts", window), "status").agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "status", "n")


def submit_documents(files: DataFrame, late: str = "1 hour") -> DataFrame:
    """ST1: arriving files (path, modificationTime, content) as pending tasks, each content once within
    the watermark, with the route of its extension."""
    tagged = files.withWatermark("modificationTime", late).withColumn("task_id", F.sha2("content", 256))
    fresh = tagged.dropDuplicatesWithinWatermark(["task_id"])
    return fresh.select(
        "task_id", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("path").alias("file_path"),
        route_by_extension(F.col("path")).alias("route"), F.lit("pending").alias("status"), F.col("modificationTime").alias("created_at"))
