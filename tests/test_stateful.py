"""Streams with rules of event time against their batch forms, in shuffled orders of arrival; and that their states end."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skyledger.operators import requests, retry
from skyledger.streaming import stateful, streams

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


def feed(spark, folder, frames, schema):
    """A stream whose batches are these lists of rows, in order."""
    for rows in frames:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(df, name, mode, folder):
    """(rows, keys left in state) of a stream that has read all there is."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(folder / f"ck-{name}")).start()
    q.processAllAvailable()
    left = sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"])
    q.stop()
    return df.sparkSession.table(name).collect(), left


def test_accepted_and_late_rows_are_all_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, at(40 * i - (rng.randrange(900, 4000) if rng.random() < 0.3 else 0)), {"a": "b"}) for i in range(100)] + [(100, None, {})]
    frames = [rows[i : i + 20] for i in range(0, 101, 20)]
    schema = "n int, ts timestamp, m map<string,string>"
    source = feed(spark, tmp_path / "in", frames, schema)
    folder = str(tmp_path / "out")
    q = stateful.write_marked(stateful.mark_late(source, "ts", "10 minutes"), folder).start()
    q.processAllAvailable()
    q.stop()
    want, mark = set(), None
    for frame in frames:
        want |= {r[0] for r in frame if r[1] is None or (mark and r[1] < mark)}
        mark = max(r[1] for frame in frames[: frames.index(frame) + 1] for r in frame if r[1]) - timedelta(minutes=10)
    late = stateful.dead_letters(spark, folder, source.schema)
    assert {r.n for r in late.collect()} == want and 5 < len(want) < 60 and late.schema == source.schema
    good, _ = drain(stateful.accepted(spark, folder, source.schema), "accepted", "append", tmp_path)
    assert sorted([r.n for r in good] + [r.n for r in late.collect()]) == list(range(101))


@pytest.mark.parametrize("batches", [2, 4, 7])
def test_silent_hosts(spark, tmp_path, batches):
    rng = random.Random(2)
    rows = []
    for i in range(140):
        host = f"h{rng.randrange(5)}" if i < 60 or i > 110 else f"h{rng.randrange(2)}"
        rows.append((host, at(30 * i - (rng.randrange(1500) if rng.random() < 0.2 else 0))))
    frames = [rows[i : i + 20] for i in range(0, 140, 20)][:batches]
    stream = stateful.host_changes(feed(spark, tmp_path / "in", frames, "host string, ts timestamp"), 400, "60 seconds")
    got, _ = drain(stream, f"hosts{batches}", "append", tmp_path)
    seen = [r for f in frames for r in f]
    mark = max(r[1] for r in seen) - timedelta(seconds=60)
    missing = streams.missing_hosts(spark.createDataFrame(seen, "host string, ts timestamp"), mark.strftime("%Y-%m-%d %H:%M:%S"), 400)
    last = {}
    for r in got:
        # changes alternate: a host is missing once, then back once
        assert r.change != last.get(r.host, "back")
        last[r.host] = r.change
    assert {h for h, c in last.items() if c == "missing"} == {r.host for r in missing.collect()}
    assert batches < 4 or any(r.change == "missing" for r in got)


def test_silent_hosts_are_forgotten(spark, tmp_path):
    frames = [[("a", at(0)), ("b", at(0))], [("a", at(1000))], [("a", at(5000))], [("a", at(5001))]]
    got, left = drain(stateful.host_changes(feed(spark, tmp_path / "in", frames, "host string, ts timestamp"), 100, "10 seconds", 2000), "forgotten", "append", tmp_path)
    assert [r.change for r in got if r.host == "b"] == ["missing", "forgotten"] and left == 1
    assert [r.change for r in got if r.host == "a"] == ["missing", "back", "missing", "back"] or [r.change for r in got if r.host == "a"] == []


@pytest.mark.parametrize("seed", range(3))
def test_retries_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(f"i{rng.randrange(5)}", at(60 * i), i, rng.random() < 0.35, rng.choice([None, 1, 7])) for i in range(90)]
    schema = "item string, ts timestamp, event_id long, success boolean, priority int"
    shuffled = rng.sample(rows, len(rows))
    frames = [shuffled[i : i + 18] for i in range(0, 90, 18)]
    got, _ = drain(stateful.retry_stream(feed(spark, tmp_path / "in", frames, schema)), f"retried{seed}", "update", tmp_path)
    last = {r["item"]: tuple(r) for r in got}
    assert last == {r["item"]: tuple(r) for r in retry.retry_state(spark.createDataFrame(rows, schema)).collect()}


def test_retry_states_end(spark, tmp_path):
    schema = "item string, ts timestamp, event_id long, success boolean, priority int"
    frames = [[("a", at(0), 1, False, 1), ("b", at(0), 2, False, 1)], [("b", at(90_000), 3, False, 1)], [("b", at(90_001), 4, False, 1)]]
    got, left = drain(stateful.retry_stream(feed(spark, tmp_path / "in", frames, schema), delay="10 seconds", keep_sec=3600), "ended", "update", tmp_path)
    assert left == 1 and [(r["item"], r.failures) for r in got][-1][0] == "b"


EVENTS = "event_id long, ts timestamp, kind string, request_ids array<long>, slurm_job_id long, payload map<string,string>, touches array<string>"


def lifecycle(rng, n=24):
    """Events of requests that are submitted, computed by jobs that several share, resubmitted and failed."""
    rows, event = [], 0

    def add(t, kind, ids, job, payload):
        nonlocal event
        event += 1
        rows.append((event, at(t), kind, ids, job, {k: str(v) for k, v in payload.items()}, []))

    for r in range(n):
        add(10 * r, "submit_download", [r], None, {"job_id": 900 + r, "submitted_datetime": r})
    for turn in range(3):
        for first in range(0, n, 3):
            if rng.random() < 0.8:
                job, t = 100 * turn + first, 1000 * (turn + 1) + first
                add(t, "submit_compute", [first, first + 1, first + 2][: rng.randrange(1, 4)], None, {"job_id": job, "submitted_datetime": t})
                add(t + rng.randrange(1, 300), "assign", None, job, {"hostname": f"h{turn}", "started_datetime": t})
                add(t + rng.randrange(300, 400), "download", None, job, rng.choice([{"completed_datetime": t}, {"error_datetime": t, "error_message": "no"}]))
                add(t + rng.randrange(400, 500), "calibration_started", None, job, {"started_datetime": t})
                # some come after the requests went to another job
                add(t + rng.randrange(500, 2500), "calibration", None, job, rng.choice([{"completed_datetime": t, "fit_id": t}, {"error_datetime": t, "error_message": "bad"}]))
    add(50, "assign", None, 100, {"hostname": "before its submission", "started_datetime": 0})
    add(60, "assign", None, 77_777, {"hostname": "of no request", "started_datetime": 0})
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_requests_by_job_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = lifecycle(rng)
    shuffled = rng.sample(rows, len(rows))
    step = -(-len(rows) // 4)
    frames = [shuffled[i : i + step] for i in range(0, len(rows), step)]
    got, _ = drain(stateful.fold_stream(feed(spark, tmp_path / "in", frames, EVENTS), delay="2 hours"), f"folded{seed}", "append", tmp_path)
    last = {r.id: tuple(r) for r in got}
    want = {r.id: tuple(r) for r in requests.fold_requests(spark.createDataFrame(rows, EVENTS)).collect()}
    assert last == want and any(v for r in want.values() for v in r[-4:])


def test_fold_state_ends_and_unmatched_events_are_told(spark, tmp_path):
    rows = lifecycle(random.Random(9), 6)
    source = [rows, [(9001, at(40_000), "assign", [1], None, {"hostname": "x"}, [])], [(9002, at(400_000), "assign", [99], None, {"hostname": "y"}, [])], [(9003, at(400_001), "assign", [99], None, {"hostname": "z"}, [])]]
    stream = feed(spark, tmp_path / "in", source, EVENTS)
    got, left = drain(stateful.fold_stream(stream, delay="10 seconds", keep_sec=50_000), "ends", "append", tmp_path)
    # of request 99: what is settled and what is recent, and their timers
    assert left <= 8 and {r.id: r.assigned_hostname for r in got}[99] == "z"
    got, left = drain(stateful.events_by_job(stream, "10 seconds", 50_000), "unmatched", "append", tmp_path)
    resolved = {(r.event_id, r.id) for r in requests.resolve_requests(requests.apply_rules(spark.createDataFrame(rows, EVENTS))).collect()}
    told = {r.event_id for r in got if r.kind == "unmatched"}
    assert {r[0] for r in rows if r[5].get("hostname") in ("before its submission", "of no request")} <= told and left == 0
    assert not told & {e for e, _ in resolved} and {r.event_id for r in got} >= {r[0] for r in rows if r[4] is not None}
