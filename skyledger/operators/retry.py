"""Order of the backlog and retry state from attempt logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .order import backlog_order


def rank_backlog(files: DataFrame, limit: int | None = None) -> DataFrame:
    """The backlog by (priority, file name, path); directories don't matter before names.

    A total order: Spark sorts by ranges, or keeps the first ``limit`` of each task.
    """
    ordered = files.orderBy(*backlog_order())
    return ordered.limit(limit) if limit is not None else ordered


def retry_state(attempts: DataFrame, *, policy: str = "linear", initial: float = 1.0, factor: float = 2.0, limit: float = 60.0) -> DataFrame:
    """``item, failures, backoff_sec, next_attempt, priority``: failures since the last success of each item.

    ``linear``: min(limit, initial * factor * failures); ``exp``: min(limit, initial * factor^(failures - 1)). Failed
    items sink by one priority for each failure. Needs ``item, ts, event_id, success, priority``;
    an aggregation with partial sums, so an item may have any number of attempts.
    """
    # the last success by time; failures after it count
    at = F.struct("ts", "event_id")
    last = attempts.groupBy("item").agg(F.max(F.when(F.col("success"), at)).alias("_ok"))
    n = F.sum(F.when(F.col("_ok").isNull() | (at > F.col("_ok")), 1).otherwise(0))
    state = attempts.join(last, "item").groupBy("item").agg(
        n.cast("bigint").alias("failures"), F.max("ts").alias("last_ts"), F.max_by("priority", at).alias("_priority")
    )
    return with_backoff(state, policy=policy, initial=initial, factor=factor, limit=limit)


def with_backoff(state: DataFrame, *, policy: str, initial: float, factor: float, limit: float) -> DataFrame:
    """``item, failures, backoff_sec, next_attempt, priority`` of ``item, failures, last_ts, _priority`` (that of the last attempt)."""
    f = F.col("failures")
    backoff = F.lit(initial * factor) * f if policy == "linear" else F.lit(initial) * F.pow(F.lit(factor), f - 1)
    backoff = F.when(f == 0, F.lit(0.0)).otherwise(F.least(F.lit(float(limit)), backoff.cast("double")))
    state = state.withColumn("backoff_sec", backoff)
    later = F.timestamp_micros((F.unix_micros(F.col("last_ts").cast("timestamp")) + F.col("backoff_sec") * 1_000_000).cast("bigint"))
    return state.select("item", "failures", "backoff_sec", later.alias("next_attempt"), (F.col("_priority") + f).cast("bigint").alias("priority"))


def failure_runs(attempts: DataFrame) -> DataFrame:
    """Per attempt ``n_failures``: failures in a row up to it, since the item's last success."""
    w = Window.partitionBy("item").orderBy("ts", "event_id")
    run = attempts.withColumn("_run", F.sum(F.col("success").cast("int")).over(w))
    inside = Window.partitionBy("item", "_run").orderBy("ts", "event_id")
    return run.withColumn("n_failures", F.sum((~F.col("success")).cast("bigint")).over(inside)).drop("_run")
