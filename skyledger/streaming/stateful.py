"""Streams that judge rows by event time themselves: late rows, silent hosts, retries, and request events keyed by compute job.

Spark drops a row behind the watermark before a stateful operator sees it. Where that must not happen (``unfiltered``), the event time goes
on without its mark, and another column carries that.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.requests import FIELDS, apply_rules, is_named
from ..operators.retry import with_backoff

WATERMARK = "10 minutes"
DAY_MS = 86_400_000


def unfiltered(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """``rows`` of a query whose watermark is that of ``time``, but of which none counts as late.

    The column ``_open`` takes over the mark by which Spark tells late rows, and holds a time that no watermark reaches.
    """
    plain = F.timestamp_micros(F.unix_micros(F.col(time).cast("timestamp")))
    never = F.to_timestamp(F.lit("2262-01-01")).alias("_open", metadata={"spark.watermarkDelayMs": 0})
    return rows.withWatermark(time, delay).withColumn(time, plain).select("*", never)


# --- late rows ---


def mark_late(rows: DataFrame, time: str = "ts", delay: str = WATERMARK, lanes: int = 64) -> DataFrame:
    """All rows of a stream with ``late``: whether the row was behind the watermark when it came. A row without a time is late.

    The first rows of a query are never late, as there is no watermark yet. Rows are dealt over ``lanes`` tasks; no state is kept.
    """
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        for frame in frames:
            late = frame["_ms"].isna() | (frame["_ms"] < mark)
            yield frame[columns].assign(_late=late.to_numpy(bool))

    columns = rows.columns
    lane = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns if not rows.schema[c].dataType.simpleString().startswith("map")]), F.lit(lanes))
    timed = unfiltered(rows, time, delay).withColumns({"_lane": lane, "_ms": F.unix_millis(time)})
    out = timed.groupBy("_lane").applyInPandasWithState(step, ", ".join([*names, "_late boolean"]), "unused int", "append", "EventTimeTimeout")
    # a computed column makes rows that Spark's writer can sort by it
    return out.withColumn("late", F.coalesce("_late", F.lit(True))).drop("_late")


def write_marked(marked: DataFrame, folder: str):
    """A stream writer that puts accepted rows at ``folder/late=false`` and dead letters at ``folder/late=true``, each row exactly once."""
    return marked.writeStream.format("parquet").partitionBy("late").option("path", folder).option("checkpointLocation", f"{folder}/_query").outputMode("append")


def accepted(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The accepted rows of ``folder`` as a stream."""
    return spark.readStream.schema(schema).parquet(f"{folder}/late=false")


def dead_letters(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The rows of ``folder`` that came too late, as a table."""
    return spark.read.schema(schema).option("basePath", folder).parquet(folder).where(F.col("late").cast("boolean")).drop("late")


# --- hosts ---


def host_changes(packets: DataFrame, timeout_sec: int, delay: str = WATERMARK, forget_sec: int = 30 * 86_400) -> DataFrame:
    """``host, change, last_ts``: a row ``missing`` when the watermark has gone more than ``timeout_sec`` beyond a host's last packet, a row ``back`` when packets come again.

    At each watermark the hosts whose last change is ``missing`` are those of ``streams.missing_hosts`` at that time, whether or not packets come of any
    host but one, and late packets count too. A host's state is one time; it ends ``forget_sec`` after the last packet (a row ``forgotten``).
    """
    timeout, forget = timeout_sec * 1000, max(forget_sec, timeout_sec + 1) * 1000

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        last, missing = state.get if state.exists else (None, False)
        told = []

        def tell(change: str) -> None:
            told.append((key[0], change, pd.Timestamp(last, unit="us")))

        if not state.hasTimedOut:
            seen = [int(f["_us"].max()) for f in frames if f["_us"].notna().any()]
            if not seen:
                return
            last = max([*seen, *([last] if last is not None else [])])
        due = last // 1000 + timeout
        silent = due < mark
        if missing and not silent:
            tell("back")
        if silent and not missing:
            tell("missing")
        if silent and last // 1000 + forget < mark:
            tell("forgotten")
            state.remove()
        else:
            state.update((last, silent))
            # a timer fires once the watermark is beyond it
            state.setTimeoutTimestamp(max(last // 1000 + forget if silent else due, mark) + 1)
        if told:
            yield pd.DataFrame(told, columns=["host", "change", "last_ts"])

    rows = unfiltered(packets.select("host", "ts"), "ts", delay).withColumn("_us", F.unix_micros("ts"))
    return rows.groupBy("host").applyInPandasWithState(step, "host string, change string, last_ts timestamp", "last bigint, missing boolean", "append", "EventTimeTimeout")


# --- retries ---


def retry_stream(attempts: DataFrame, *, policy: str = "linear", initial: float = 1.0, factor: float = 2.0, limit: float = 60.0, delay: str = WATERMARK, keep_sec: int = 7 * 86_400) -> DataFrame:
    """``retry.retry_state`` of a stream of attempts: a row of an item in each batch that holds attempts of it; the last one counts.

    Attempts may come in any order, however late: an item's state is its last success and the failures after it by (ts, event_id), so an old failure
    isn't counted and an old success takes the failures before it away. The state ends ``keep_sec`` after the last attempt, by the watermark.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ok, fails, last, priority = state.get if state.exists else ([], [], [], None)
        ok, last = tuple(ok), tuple(last)
        held = {tuple(f) for f in fails}
        for frame in frames:
            for us, event, success, rank in frame[["_us", "event_id", "success", "priority"]].itertuples(index=False):
                at = (int(us), int(event))
                if success:
                    ok = max(ok, at)
                else:
                    held.add(at)
                if at >= last:
                    last, priority = at, None if pd.isna(rank) else int(rank)
        held = sorted(f for f in held if f > ok)
        state.update((list(ok), [list(f) for f in held], list(last), priority))
        state.setTimeoutTimestamp(max(last[0] // 1000 + 1000 * keep_sec, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"item": [key[0]], "failures": [len(held)], "last_ts": [pd.Timestamp(last[0], unit="us")], "_priority": pd.array([priority], "Int64")})

    rows = unfiltered(attempts.select("item", "ts", "event_id", "success", "priority"), "ts", delay).withColumn("_us", F.unix_micros("ts"))
    kept = "ok array<bigint>, failures array<array<bigint>>, last array<bigint>, priority bigint"
    out = rows.groupBy("item").applyInPandasWithState(step, "item string, failures bigint, last_ts timestamp, _priority bigint", kept, "update", "EventTimeTimeout")
    return with_backoff(out, policy=policy, initial=initial, factor=factor, limit=limit)


# --- request events ---

_EVENT = "id bigint, job bigint, at bigint, event_id bigint, needs bigint, payload string, touches array<string>, kind string, mark timestamp"
_NAMES = [c.split()[0] for c in _EVENT.split(", ")]


class _ByJob(StatefulProcessor):
    """Keyed by compute job (``j``): which requests were submitted with it and when, and events of it that later submissions may still claim. Events
    keyed by their request (``r``) pass.

    An event goes on, as one that ``needs`` this job, to each request submitted before it. It is held until the watermark is beyond it: by then
    every submission before it has come, in whatever order. One that no request claimed goes on alone.
    """

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.submitted = handle.getMapState("submitted", "at bigint, event_id bigint, id bigint", "unused boolean")
        self.held = handle.getMapState("held", "at bigint, event_id bigint", "payload string, touches array<string>, claimed boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark, kind, job = timerValues.getCurrentWatermarkInMs(), key[0][0], int(key[0][1:])
        if kind == "r":
            for frame in rows:
                yield _frame([(job, None, int(r.at), int(r.event_id), None, r.payload, list(r.touches), "event") for r in frame.itertuples(index=False)], mark)
            return
        submissions, events = [], []
        for frame in rows:
            for r in frame.itertuples(index=False):
                if pd.isna(r.id):
                    events.append((int(r.at), int(r.event_id), r.payload, list(r.touches)))
                else:
                    submissions.append((int(r.at), int(r.event_id), int(r.id)))
        known = [tuple(k) for k in self.submitted.keys()]
        for s in set(submissions) - set(known):
            self.submitted.updateValue(s, (True,))
            self.handle.registerTimer(max(s[0] // 1000 + self.keep_ms, mark) + 1)
        old = [(*k, *v) for k, v in self.held.iterator()]
        out = []
        for at, event, payload, touches, claimed in [*old, *[(*e, False) for e in events]]:
            new = (at, event, payload, touches) in events
            by = {i for a, e, i in ([*known, *submissions] if new else submissions) if (a, e) < (at, event)}
            out += [(i, job, at, event, job, payload, touches, "event") for i in sorted(by)]
            if new or (by and not claimed):
                self.held.updateValue((at, event), (payload, touches, bool(by) or claimed))
            if new:
                self.handle.registerTimer(max(at // 1000, mark) + 1)
        if out:
            yield _frame(out, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark, job = timerValues.getCurrentWatermarkInMs(), int(key[0][1:])
        out = []
        for (at, event), (payload, touches, claimed) in list(self.held.iterator()):
            if at // 1000 < mark:
                self.held.removeKey((at, event))
                if not claimed:
                    out.append((None, job, at, event, job, payload, list(touches), "unmatched"))
        for k in list(self.submitted.keys()):
            if k[0] // 1000 + self.keep_ms < mark:
                self.submitted.removeKey(tuple(k))
        if out:
            yield _frame(out, mark)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple], mark_ms: int) -> pd.DataFrame:
    """Rows of ``_EVENT``; what goes on must not lie behind the watermark, so ``mark`` is at it at least."""
    out = pd.DataFrame([(*r, pd.Timestamp(max(r[2], 1000 * mark_ms), unit="us")) for r in rows], columns=_NAMES)
    return out.astype({"id": "Int64", "needs": "Int64", "job": "Int64"})


class _ByRequest(StatefulProcessor):
    """Keyed by request: the row folded from all events behind the watermark, and the events since, which may still come in any order."""

    def __init__(self, fields: list[str], keep_ms: int) -> None:
        self.fields, self.keep_ms = fields, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", "job bigint, at bigint, event_id bigint, row string")
        self.recent = handle.getMapState("recent", "at bigint, event_id bigint, needs bigint", "payload string, touches array<string>")

    def _fold(self, job: int | None, row: dict, events: list[tuple]) -> tuple[int | None, dict]:
        row = dict(row)
        for _, _, needs, payload, touches in events:
            if needs >= 0 and needs != job:
                continue
            written = json.loads(payload) if payload else {}
            row |= {f: written.get(f) for f in touches}
            if "slurm_job_id" in touches:
                text = written.get("slurm_job_id")
                job = int(text) if text is not None and text.lstrip("-").isdigit() else None
        return job, row

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        job, _, _, row = self.settled.get() if self.settled.exists() else (None, None, None, "{}")
        row, recent = json.loads(row), {tuple(k): tuple(v) for k, v in self.recent.iterator()}
        newest = 0
        for frame in rows:
            for r in frame.itertuples(index=False):
                k = (int(r.at), int(r.event_id), -1 if pd.isna(r.needs) else int(r.needs))
                recent[k] = (r.payload, list(r.touches))
                self.recent.updateValue(k, recent[k])
                newest = max(newest, k[0])
        events = [(*k, *v) for k, v in sorted(recent.items())]
        final = [e for e in events if e[0] // 1000 < mark]
        if final:
            job, row = self._fold(job, row, final)
            self.settled.update((job, final[-1][0], final[-1][1], json.dumps(row)))
            for e in final:
                self.recent.removeKey(e[:3])
        now = self._fold(job, row, events[len(final) :])[1]
        self.handle.registerTimer(max(newest // 1000 + self.keep_ms, mark) + 1)
        last = events[-1][0] if events else 0
        yield pd.DataFrame([[int(key[0]), *[now.get(f) for f in self.fields], pd.Timestamp(max(last, 1000 * mark), unit="us")]], columns=["id", *self.fields, "mark"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # a later event has a timer of its own, and each ends what is its: only the last one clears the row
        if not any(t > expiredTimerInfo.getExpiryTimeInMs() for t in self.handle.listTimers()):
            self.settled.clear()
            self.recent.clear()
        yield from ()

    def close(self) -> None:
        pass


def _resolved(events: DataFrame, delay: str, keep_sec: int) -> DataFrame:
    """Rows of ``_EVENT`` for all events. One stream with one watermark: were the two kinds of event split before, the one that falls silent would hold up time."""
    if "slurm_job_id" not in events.columns:
        events = events.withColumn("slurm_job_id", F.lit(None).cast("bigint"))
    ruled = apply_rules(events).withColumn("mark", F.col("ts").cast("timestamp")).withWatermark("mark", delay)
    named, sets = is_named(events), F.coalesce(F.array_contains("touches", "slurm_job_id"), F.lit(False))
    job, ids, none = F.col("payload")["slurm_job_id"].try_cast("bigint"), F.coalesce("request_ids", F.array().cast("array<bigint>")), F.lit(None).cast("bigint")
    key = lambda kind, number, i: F.struct(F.concat(F.lit(kind), number.cast("string")).alias("key"), i.cast("bigint").alias("id"))
    targets = F.concat(
        F.when(named, F.transform(ids, lambda i: key("r", i, i))).otherwise(F.array(key("j", F.col("slurm_job_id"), none))),
        F.when(sets & job.isNotNull(), F.transform(ids, lambda i: key("j", job, i))).otherwise(F.array().cast("array<struct<key:string,id:bigint>>")),
    )
    rows = ruled.select(F.explode_outer(targets).alias("to"), F.unix_micros("mark").alias("at"), "event_id", F.to_json("payload").alias("payload"), "touches", "mark")
    rows = rows.select("to.key", "to.id", "at", "event_id", "payload", "touches", "mark").where("key IS NOT NULL")
    return rows.groupBy("key").transformWithStateInPandas(_ByJob(1000 * keep_sec), _EVENT, "Append", "EventTime", eventTimeColumnName="mark")


def events_by_job(events: DataFrame, delay: str = WATERMARK, keep_sec: int = 30 * 86_400) -> DataFrame:
    """Stream form of ``requests.resolve_requests`` for events keyed by a compute job: each once for each request that was submitted with the job before it.

    Rows of kind ``unmatched`` are events that no submission before them claims; they are known as such when the watermark is beyond them. A submission ends
    ``keep_sec`` after it was made. Events behind the watermark are Spark's to drop: take them apart before (``mark_late``).
    """
    return _resolved(events, delay, keep_sec).where("needs IS NOT NULL")


def fold_stream(events: DataFrame, fields: list[str] | None = None, delay: str = WATERMARK, keep_sec: int = 30 * 86_400) -> DataFrame:
    """State of each request, updated by every batch of a stream of events: ``id`` and the ``fields``; the last row of an id counts.

    It equals ``requests.fold_requests`` of all events so far, in whatever order they come within the watermark's ``delay``, those keyed by a compute job
    included. Two chained states: by job (``events_by_job``), then by request. A request's state ends ``keep_sec`` after its last event. The session's
    ``spark.sql.streaming.stateStore.providerClass`` must be that of RocksDB, which Spark asks for here.
    """
    fields = FIELDS if fields is None else fields
    rows = _resolved(events, delay, keep_sec).where("kind = 'event'")
    out = ", ".join(["id bigint", *[f"`{f}` string" for f in fields], "mark timestamp"])
    return rows.groupBy("id").transformWithStateInPandas(_ByRequest(fields, 1000 * keep_sec), out, "Append", "EventTime", eventTimeColumnName="mark").drop("mark")
