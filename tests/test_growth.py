"""Work and memory that grow with the rows, not with their pairs; held against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import catalog, ledger, order, requests
from skyledger.sources.commits import CommittedTables
from skyledger.sources.durable import new_folder

EVENTS = "event_id long, ts timestamp, kind string, request_ids array<long>, slurm_job_id long, payload map<string,string>"


def range_joins(df):
    """The joins of a plan that compare by order."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [x for x in lines if "Join " in x and any(c in x for c in (" > ", " < ", " >= ", " <= "))]


@pytest.fixture(scope="module")
def events(spark):
    """Requests that share four jobs and come back to them, over many hours and at equal times; a request may be named twice, a job never taken."""
    rng, out = random.Random(7), []
    for e in range(600):
        hour, kind = rng.randrange(60), rng.choice(["submit_compute", "submit_compute", "submit_download", "assign", "download", "calibration_started", "calibration"])
        named = kind.startswith("submit")
        job = rng.randrange(5)
        payload = {"job_id": str(job) if named and (kind == "submit_download" or job < 4) else None, "hostname": f"h{e}", "started_datetime": f"b{e}", "submitted_datetime": f"s{e}"}
        payload |= {"completed_datetime": f"c{e}", "fit_id": f"f{e}"} if e % 3 else {"error_datetime": f"e{e}", "error_message": f"m{e}"}
        ids = [rng.randrange(30) for _ in range(rng.choice([1, 1, 2]))] if named else None
        out.append((e, 3600 * hour + 1800 * rng.randrange(2), kind, [*ids, ids[0]] if ids and e % 9 == 0 else ids, None if named else job, payload))
    raw = spark.createDataFrame(out, EVENTS.replace("timestamp", "long"))
    return out, raw.withColumn("ts", F.timestamp_seconds("ts"))


def touched(data):
    """(event, request) for each hit, by a plain walk along time."""
    jobs, hits = {}, []
    for e, ts, kind, ids, job, payload in sorted(data, key=lambda r: (r[1], r[0])):
        if ids is not None:
            hits += [(e, i) for i in ids]
            if kind == "submit_compute":
                jobs |= {i: int(payload["job_id"]) if payload["job_id"] else None for i in ids}
        else:
            hits += [(e, i) for i, j in jobs.items() if j == job]
    return hits


def test_fold_does_not_pair_events_with_requests(spark, events):
    data, df = events
    kinds = {r[0]: (r[2], r[5]) for r in data}
    want = {}
    for e, i in touched(data):
        kind, payload = kinds[e]
        want.setdefault(i, {}).update({f: payload.get(k) if k else None for f, k in requests.RULES[kind].items()})
    out = requests.fold_requests(df)
    got = {r.id: {f: r[f] for f in requests.FIELDS} for r in out.collect()}
    assert got == {i: {f: w.get(f) for f in requests.FIELDS} for i, w in want.items()}
    assert not range_joins(out)


def test_touched_does_not_pair_events_with_requests(spark, events):
    data, df = events
    there = spark.createDataFrame([(i,) for i in range(30) if i % 3 != 1] + [(5,)], "id long")
    weight = {i: 1 + (i == 5) for i in range(30) if i % 3 != 1}
    count = dict.fromkeys((r[0] for r in data), 0)
    for e, i in touched(data):
        count[e] += weight.get(i, 0)
    named = {r[0]: len(r[3]) if r[3] is not None else None for r in data}
    out = requests.check_touched(df, there)
    got = sorted((r.event_id, r.n_named, r.n_hit) for r in out.collect())
    assert got == sorted((e, named[e], n) for e, n in count.items() if (n == 0 if named[e] is None else n != named[e]))
    assert not range_joins(out)


def test_running_over_slices(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.randrange(400), i, rng.choice([None, rng.randrange(90)])) for i in range(500)]
    df = spark.createDataFrame(data, "k string, t long, i long, v long").withColumns({"_b": F.floor(F.col("t") / 7), "n": F.col("v")}).withColumn("_c", F.floor(F.col("_b") / 4))
    want, seen = {}, {}
    for k, t, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        seen.setdefault(k, []).extend([] if v is None else [v])
        want[i] = (max(seen[k], default=None), sum(seen[k]) if seen[k] else None)
    for slices in ([], ["_b"], ["_b", "_c"]):
        got = order.running(df, ["k"], slices, [F.col("t").asc(), F.col("i").asc()], {"v": F.max, "n": F.sum})
        assert {r.i: (r.v, r.n) for r in got.collect()} == want
    assert {r.v for r in order.running(df, [], ["_b", "_c"], [F.col("t").asc()], {"v": F.max}).where("t = 399 OR t = 398").collect()} <= {max(v for *_, v in data if v is not None)}


def test_dispatch_of_long_windows(spark):
    """Windows that span everything cost a row each, not one for each slot; those that overlap, touch, are empty or open at an end count as before."""
    rng = random.Random(5)
    files = [(i, 8 * rng.randrange(2**28)) for i in range(300)] + [(1000, 512), (1001, 511), (1002, 8 * 2**28)]
    windows = [(s, s + rng.choice([-8, 0, 8, 512, 2**20])) for s in (8 * rng.randrange(2**28) for _ in range(60))] + [(s, s + 4096) for _, s in files[:20]] + [(e - 4096, e) for _, e in files[20:40]]
    h = spark.createDataFrame(files, "path long, subobs_id long").withColumn("mode", F.lit("CORRELATOR"))
    for more in ([], [(0, 512)], [(0, 2**40)], [(None, 4096)]):
        d = spark.createDataFrame(windows + more, "start_gps long, end_gps long")
        out = catalog.dispatch_subfiles(h, "C", d)
        got = {r.path for r in out.where("action = 'dump'").collect()}
        assert got == {i for i, s in files if any((a is None or s >= a) and s < b for a, b in windows + more)}
        assert out.columns == ["path", "subobs_id", "mode", "action", "pause", "free"] and out.count() == len(files)
    assert "Generate explode(sequence" not in out._jdf.queryExecution().optimizedPlan().toString() and not range_joins(out)


def test_updates_travel_without_map_sides(spark):
    """The ledger's rows are dealt once, with no sums or sorts before that, which would hold all files of a task; keys that are null match nothing."""
    cols = "observation_num long, filename string, size long, remote_archived boolean, location int, bucket string, folder string"
    rng = random.Random(11)
    key = lambda: (rng.choice([None, *range(12)]), rng.choice([None, "a", "b", "c"]))
    held = [(*key(), i, rng.random() < 0.2, None, "old", None) for i in range(60)]
    asked = [(*key(), i, "b", None) for i in range(25)]
    updates = spark.createDataFrame(asked, "observation_num int, filename string, location int, bucket string, folder string")
    out, bad = ledger.mark_archived(spark.createDataFrame(held, cols), updates)
    n = lambda rows, k: 0 if None in k else sum(r[:2] == k for r in rows)
    good = {r[:2]: r for r in asked if n(held, r[:2]) == 1 and n(asked, r[:2]) == 1}
    want = [(*h[:3], True, *good[h[:2]][2:]) if h[:2] in good else h for h in held]
    assert good and out.schema.simpleString() == spark.createDataFrame([], cols).schema.simpleString()
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert {tuple(r) for r in bad.collect()} == {(*k, sum(r[:2] == k for r in asked), n(held, k)) for k in {r[:2] for r in asked} - set(good)}
    for df in (out, bad):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        before = plan[plan.index("Exchange hashpartitioning") :]
        assert not any(x in before for x in ("Aggregate", "Sort"))


def test_a_published_update_runs_nothing_again(spark, monkeypatch):
    tables = CommittedTables(spark, new_folder(spark, "ledger"))
    files = spark.createDataFrame([(1000000001, "a", False, None, None, None, -1)], "observation_num long, filename string, remote_archived boolean, location int, bucket string, folder string, trigger_id long")
    ledger.append_batch(tables, "one", files, files.select(F.col("observation_num").alias("obs_id")), "s-")
    updates = files.select("observation_num", "filename", F.lit(2).alias("location"), F.lit("b").alias("bucket"), F.lit("f").alias("folder"))
    asked, buckets = [], ledger._buckets
    monkeypatch.setattr(ledger, "_buckets", lambda *a: asked.append(1) or buckets(*a))
    assert ledger.archive_batch(tables, "set", updates, "s-").count() == 0 and len(asked) == 2
    assert ledger.archive_batch(tables, "set", updates, "s-").count() == 0 and len(asked) == 3
    assert [(r.remote_archived, r.bucket) for r in tables.read(ledger.FILES).collect()] == [(True, "b")]


def test_dump_of_long_windows(spark):
    """A window of any length takes few rows in the join, and still each of its files once."""
    rng = random.Random(9)
    files = [(f"{i:04}", 1000 + 8 * rng.randrange(2**18), i if i % 3 == 0 else None) for i in range(400)]
    span = 512 * requests.SPAN
    starts = [0, 1000, *(8 * rng.randrange(2**18) for _ in range(20)), 3 * span, 3 * span + 1, 3 * span - 1]
    dumps = [(i, s, s + d, 9000 + i) for i, (s, d) in enumerate((s, d) for s in starts for d in (-8, 0, 8, 511, 512, span - 1, span, 2 * span, 2**40))]
    f = spark.createDataFrame(files, "path string, subobs_id long, trigger_id long").withColumn("mode", F.lit("CORRELATOR"))
    d = spark.createDataFrame(dumps, "request_id long, start_gps long, end_gps long, trigger_id long")
    got = sorted(tuple(r) for r in requests.select_dump(f, d).collect())
    assert got == sorted((i, p, s, t if t is not None else u) for i, a, b, u in dumps for p, s, t in files[2:] if (a == 0 or s >= a) and s <= b)
    places = spark.range(200).select(F.col("id").alias("a"), F.explode(F.array(*[F.col("id") + n for n in (0, 1, 62, 63, 64, 300, 4500, 9000)])).alias("b")).withColumn("p", requests._places(F.col("a"), F.col("b"))).collect()
    for r in places[::7]:
        assert sorted(x for p in r.p for x in range(p.number * requests.SPAN**p.level, (p.number + 1) * requests.SPAN**p.level)) == list(range(r.a, r.b + 1))
    assert spark.range(1).select(F.size(requests._places(F.lit(5).cast("long"), F.lit(100_000).cast("long"))).alias("n")).first().n < 300


def shuffled(spark, run):
    """What ``run`` returns, and the rows that its jobs dealt out."""
    sc = spark.sparkContext
    sc.setJobGroup(group := f"shuffled-{random.random()}", group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = {s for j in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(j).stageIds}
    done = [sc._jsc.sc().statusStore().lastStageAttempt(s) for s in stages]
    return out, sum(s.shuffleWriteRecords() for s in done if s.status().toString() == "COMPLETE")


def test_dump_deals_each_file_once(spark, monkeypatch):
    """Without a broadcast a file is dealt once; the same in many slices, blocks and chunks. Files without path or time, and windows without a bound, are in no result."""
    rng = random.Random(4)
    files = [(f"{i:05}", 1000 + rng.randrange(2**20) if i % 50 else 5000, i if i % 3 == 0 else None) for i in range(400)] + [(None, 7000, None), (None, 7001, 3), ("x", None, None)]
    starts = [0, 1, 999, 5000, *(rng.randrange(2**20) for _ in range(6))]
    dumps = [(i, s, s + d, 9000 + i) for i, (s, d) in enumerate((s, d) for s in starts for d in (-1, 0, 300, 2**14, 2**16 + 5, 2**40))] + [(900, None, 2**40, 1), (901, 0, None, 2), (902, 5000, 5000, None)]
    f = spark.createDataFrame(files, "path string, subobs_id long, trigger_id long").withColumn("mode", F.lit("CORRELATOR"))
    d = spark.createDataFrame(dumps, "request_id long, start_gps long, end_gps long, trigger_id long")
    held = [(p, s, t) for p, s, t in files[2:] if p is not None and s is not None]
    bounded = [x for x in dumps if x[1] is not None and x[2] is not None]
    want = sorted(((i, p, s, t if t is not None else u) for i, a, b, u in bounded for p, s, t in held if (a == 0 or s >= a) and s <= b), key=str)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = spark.range(5000).selectExpr("CAST(id AS STRING) AS path", "1000 + 80 * id AS subobs_id", "CAST(NULL AS BIGINT) AS trigger_id", "'CORRELATOR' AS mode")
        _, dealt = shuffled(spark, lambda: len(requests.select_dump(many, d.where("request_id IN (1, 2, 13, 20)")).collect()))
        assert 5000 <= dealt < 5500
        assert requests.select_dump(f.limit(0), d).count() == requests.select_dump(f, d.limit(0)).count() == 0
        for least, block, chunk in ((requests.SLICE_FILES, requests.BLOCK, requests.CHUNK), (7, 3, 2), (1 / 16, 1, 3)):  # 1, 58 and all slices
            monkeypatch.setattr(requests, "SLICE_FILES", least)
            monkeypatch.setattr(requests, "BLOCK", block)
            monkeypatch.setattr(requests, "CHUNK", chunk)
            assert sorted((tuple(r) for r in requests.select_dump(f, d).collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)


def test_dump_written_in_small_columns(spark, tmp_path):
    """Windows repeat within a page: a file of many windows costs a small part of their numbers. A file far from all others makes no slice wide."""
    files = spark.range(2000).selectExpr("CAST(id AS STRING) AS path", "IF(id = 5, 0, 10000000 + 8 * id) AS subobs_id", "CAST(NULL AS BIGINT) AS trigger_id", "'CORRELATOR' AS mode")
    dumps = spark.range(2003).selectExpr("id AS request_id", "IF(id % 2 = 0, 0, 9000000) AS start_gps", "20000000 AS end_gps", "id AS trigger_id")
    out = requests.select_dump(files, dumps)
    out.coalesce(1).write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1997 * 2003 + 1002
    size = sum(x.stat().st_size for x in (tmp_path / "out").glob("*.parquet"))
    assert size < 1.2 * 1997 * 2003  # 11 bits for each number of a window, twice
