"""Parsing tasks as tables: state, queue, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINAL = ["completed", "failed"]


def is_legal(status: Column, worker: Column, new: Column, new_worker: Column) -> Column:
    """ST2: what may follow: pending opens a task; processing and cancelled follow pending; completed and
    failed follow processing, by the worker that started."""
    return (
        F.when(new == "pending", status.isNull())
        .when(new.isin("processing", "cancelled"), status.eqNullSafe("pending"))
        .when(new.isin(FINAL), status.eqNullSafe("processing") & worker.eqNullSafe(new_worker))
        .otherwise(F.lit(False)))


def task_states(events: DataFrame) -> DataFrame:
    """ST2, batch form: state of each task after its events (task_id, ts, event_id, status, worker) in
    order; illegal events are counted and change nothing."""
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", "status", F.col("worker").cast("string").alias("worker"))))
    time = dict(events.dtypes)["ts"]
    start = F.struct(*(F.lit(None).cast(k).alias(n) for n, k in (
        ("status", "string"), ("worker", "string"), ("started_at", time), ("completed_at", time))), F.lit(0).cast("bigint").alias("rejected"))

    def step(state: Column, e: Column) -> Column:
        taken = F.struct(
            e["status"].alias("status"),
            F.when(e["status"] == "processing", e["worker"]).otherwise(state["worker"]).alias("worker"),
            F.when(e["status"] == "processing", e["ts"]).otherwise(state["started_at"]).alias("started_at"),
            F.when(e["status"].isin(FINAL), e["ts"]).otherwise(state["completed_at"]).alias("completed_at"),
            state["rejected"].alias("rejected"))
        refused = state.withField("rejected", state["rejected"] + 1)
        return F.when(is_legal(state["status"], state["worker"], e["status"], e["worker"]), taken).otherwise(refused)

    states = events.groupBy("task_id").agg(ordered.alias("events"))
    return states.select("task_id", F.aggregate("events", start, step).alias("s")).select("task_id", "s.*")


def queue_stats(tasks: DataFrame) -> DataFrame:
    """AG16: tasks per status and, with status ``total``, all of them."""
    return tasks.rollup("status").agg(F.count("*").alias("count")).select(F.coalesce("status", F.lit("total")).alias("status"), "count")


def next_tasks(tasks: DataFrame, n: int = 1) -> DataFrame:
    """SO3: the pending tasks that come next: highest priority, then oldest."""
    return tasks.where("status = 'pending'").orderBy(F.desc("priority"), "created_at", "task_id").limit(n)


def newest_tasks(tasks: DataFrame, status: str | None = None, n: int = 100) -> DataFrame:
    """SO4: the newest n tasks, of one status or of all."""
    chosen = tasks if status is None else tasks.where(F.col("status") == status)
    return chosen.orderBy(F.desc("created_at"), "task_id").limit(n)


def reset_stale(tasks: DataFrame, now: Column, minutes: int = 60) -> DataFrame:
    """ST4: tasks in work for longer go back to pending, without worker, one retry more."""
    stale = (F.col("status") == "processing") & (F.col("started_at") < now - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    stale = F.coalesce(stale, F.lit(False))
    return tasks.withColumns({
        "status": F.when(stale, "pending").otherwise(F.col("status")), "worker_id": F.when(~stale, F.col("worker_id")),
        "retry_count": F.col("retry_count") + stale.cast("int")})


def _older(now: Column, days: int) -> Column:
    old = F.col("status").isin(FINAL) & (F.col("completed_at") < now - F.expr(f"INTERVAL {int(days)} DAYS"))
    return F.coalesce(old, F.lit(False))


def expire_results(tasks: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """ST5: result paths of tasks finished longer ago are blanked; the record stays."""
    return tasks.withColumn("result_path", F.when(~_older(now, days), F.col("result_path")))


def expire_records(tasks: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """ST5: records of tasks finished longer ago go."""
    return tasks.where(~_older(now, days))


def attach_results(rows: DataFrame, results: DataFrame, keys: list[str], value: str, score: str = "score") -> DataFrame:
    """Results of a recogniser back to their rows by id; rows without one keep what they had."""
    fresh = results.select(*keys, F.col(value).alias("_v"), F.col(score).alias("_s"), F.lit(True).alias("_hit"))
    joined = rows.join(fresh, keys, "left")
    return joined.withColumns({value: F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(value)),
                               score: F.when(F.col("_hit"), F.col("_s")).otherwise(F.col(score))}).drop("_v", "_s", "_hit")
