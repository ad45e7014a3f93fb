"""Queries on committed batches and on the life of requests told by events of all kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import ledger, requests
from ..sources.commits import CommittedTables
from ..sources.durable import checkpointed, new_folder
from .registry import query

_L = """, k AS (SELECT o_orderkey + CASE WHEN o_orderkey % 11 = 3 THEN 100000000 ELSE 0 END AS o FROM observations),
l AS (SELECT 1244973688 + observation_num * 8 AS observation_num, filename, size, nullif(trigger_id, -1) AS trigger_id FROM ledger WHERE observation_num IN (SELECT o FROM k)),
g AS (SELECT observation_num, filename FROM l GROUP BY ALL HAVING count(*) = 1 AND count(*) FILTER (WHERE size % 3 = 0) = 1)
SELECT l.*, 'site-' || substr(CAST(observation_num AS VARCHAR), 1, 5) AS obs_bucket, g.filename IS NOT NULL AS remote_archived, CASE WHEN g.filename IS NOT NULL THEN 2 END AS location, CASE WHEN g.filename IS NOT NULL THEN 'b' END AS bucket
FROM l LEFT JOIN g USING (observation_num, filename)"""


@query("a6_committed_ledger", _L, "ledger", "observations")
def _(rows: DataFrame, obs: DataFrame) -> DataFrame:
    """The ledger appended in batches, one of them given twice, updated, and read back."""
    tables = CommittedTables(rows.sparkSession, new_folder(rows.sparkSession, "ledger"))
    gps = lambda c: (1244973688 + F.col(c) * 8).alias("observation_num")
    known = obs.select((1244973688 + 8 * (F.col("o_orderkey") + F.when(F.col("o_orderkey") % 11 == 3, 100_000_000).otherwise(0))).alias("obs_id"))
    new = rows.select(gps("observation_num"), "filename", "size", "trigger_id", F.lit(False).alias("remote_archived"), "location", "bucket", "folder")
    for batch, part in (("b0", 0), ("b1", 1), ("b0", 0), ("b2", 2)):
        ledger.append_batch(tables, batch, new.where(F.col("size") % 3 == part), known, "site-")
    updates = tables.read(ledger.FILES).where("size % 3 = 0").select("observation_num", "filename", F.lit(2).alias("location"), F.lit("b").alias("bucket"), F.lit("f").alias("folder"))
    for _ in range(2):
        ledger.archive_batch(tables, "archived", updates, "site-")
    out = checkpointed(tables.read(ledger.FILES).drop("folder"))
    tables.delete()
    return out


@query("c7_committed_fits", "SELECT obs_id AS obsid, CAST(1704067200000000 AS BIGINT) AS fitid, count(*) AS n_tiles, '1' AS code_version, TIMESTAMP '2024-01-01' AS fit_time, 'me' AS creator, 1 AS fit_niter, 20 AS fit_limit, 9.5::DOUBLE AS gain_max_cutoff FROM tiles GROUP BY obs_id", "tiles")
def _(tiles: DataFrame) -> DataFrame:
    """Headers and the rows of their tiles published together, twice, and read back."""
    store = CommittedTables(tiles.sparkSession, new_folder(tiles.sparkSession, "fits"))
    header = requests.fit_header(tiles, fit_time="2024-01-01 00:00:00", creator="me", code_version="1", niter=1, limit=20, gain_max_cutoff=9.5)
    solutions = tiles.select(F.col("obs_id").alias("obsid"), "tile_id").join(header.select("obsid", "fitid"), "obsid")
    for _ in range(2):
        requests.commit_fits(store, "night", header, solutions)
    counts = store.read("calibration_solutions").groupBy("obsid", "fitid").agg(F.count("*").alias("n_tiles"))
    out = checkpointed(store.read("calibration_fits").join(counts, ["obsid", "fitid"]))
    store.delete()
    return out


#: Kinds of event in turn; a request's computing job is shared by others, and used again over time.
_KINDS = ("submit_download", "submit_compute", "assign", "download", "calibration_started", "calibration")
_E = """, e AS (SELECT event_id, ts, CAST(item AS BIGINT) AS i, CAST(event_id % 6 AS INT) AS k, (CAST(item AS BIGINT) % 40) * 10 + event_id % 2 AS job, event_id % 5 = 0 AS bad, CAST(event_id AS VARCHAR) AS v FROM attempts),
s AS (SELECT i, job, ts, event_id, lead(ts) OVER w AS ts2, lead(event_id) OVER w AS event2 FROM e WHERE k = 1 WINDOW w AS (PARTITION BY i ORDER BY ts, event_id)),
h AS (SELECT e.i AS id, e.* FROM e WHERE k < 2 UNION ALL SELECT s.i, e.* FROM e JOIN s USING (job) WHERE e.k > 1 AND (e.ts, e.event_id) > (s.ts, s.event_id) AND (s.ts2 IS NULL OR (e.ts, e.event_id) < (s.ts2, s.event2)))"""
#: Each field with the kinds that write it, and what they write.
_WRITES = {
    "download_job_id": {0: "job"}, "download_job_submitted_datetime": {0: "'s' || v"}, "download_job_submitted_error_datetime": {0: "e"}, "download_job_submitted_error_message": {0: "m"},
    "slurm_job_id": {1: "job"}, "download_slurm_job_submitted_datetime": {1: "'s' || v"}, "download_slurm_job_submitted_error_datetime": {1: "e"}, "download_slurm_job_submitted_error_message": {1: "m"},
    "assigned_hostname": {2: "'h' || v"}, "assigned_datetime": {2: "'b' || v"}, "download_started_datetime": {2: "'b' || v"},
    "download_completed_datetime": {3: "c", 4: "'b' || v"}, "download_error_datetime": {3: "e"}, "download_error_message": {3: "m"},
    "calibration_started_datetime": {4: "'b' || v"}, "calibration_completed_datetime": {4: "NULL", 5: "c"}, "calibration_fit_id": {4: "NULL", 5: "CASE WHEN NOT bad THEN v END"},
    "calibration_error_datetime": {4: "NULL", 5: "e"}, "calibration_error_message": {4: "NULL", 5: "m"},
}
_SHORT = {"job": "CAST(job AS VARCHAR)", "e": "CASE WHEN bad THEN 'e' || v END", "m": "CASE WHEN bad THEN 'm' || v END", "c": "CASE WHEN NOT bad THEN 'c' || v END"}


def _fold_sql() -> str:
    last = []
    for f, by in _WRITES.items():
        value = " ".join(f"WHEN {k} THEN {_SHORT.get(x, x)}" for k, x in by.items())
        last.append(f"nullif(arg_max(coalesce(CASE k {value} END, 'none'), (ts, event_id)) FILTER (WHERE k IN ({', '.join(map(str, by))})), 'none') AS {f}")
    return f"{_E} SELECT id, {', '.join(last)} FROM h GROUP BY id"


def _lifecycle(rows: DataFrame) -> DataFrame:
    """One event of each kind in turn, keyed by requests or by a job that several requests share; a fifth of them are errors."""
    v, bad = F.col("event_id").cast("string"), F.col("event_id") % 5 == 0
    item, k = F.col("item").cast("bigint"), F.col("event_id") % 6
    job = (item % 40) * 10 + F.col("event_id") % 2
    mark = lambda letter: F.concat(F.lit(letter), v)
    payload = F.create_map(*[x for key, value in {
        "job_id": job.cast("string"), "submitted_datetime": mark("s"), "hostname": mark("h"), "started_datetime": mark("b"), "completed_datetime": F.when(~bad, mark("c")), "fit_id": F.when(~bad, v),
        "error_datetime": F.when(bad, mark("e")), "error_message": F.when(bad, mark("m")),
    }.items() for x in (F.lit(key), value)])
    kind = F.element_at(F.array(*[F.lit(x) for x in _KINDS]), (k + 1).cast("int"))
    return rows.select("event_id", "ts", kind.alias("kind"), F.when(k < 2, F.array(item)).alias("request_ids"), F.when(k > 1, job).alias("slurm_job_id"), payload.alias("payload"), F.array().cast("array<string>").alias("touches"))


@query("c3_fold_by_kind", _fold_sql(), "attempts")
def _(rows: DataFrame) -> DataFrame:
    """All six kinds, all fields; events keyed by a job touch the requests whose last submission set it."""
    return requests.fold_requests(_lifecycle(rows)).select("id", *_WRITES)


@query("c4_touched_by_kind", _E + ", n AS (SELECT event_id, count(*) FILTER (WHERE id % 3 <> 1) AS n_hit FROM h GROUP BY event_id) SELECT event_id, CASE WHEN k < 2 THEN CAST(1 AS BIGINT) END AS n_named, coalesce(n_hit, 0) AS n_hit FROM e LEFT JOIN n USING (event_id) WHERE CASE WHEN k < 2 THEN coalesce(n_hit, 0) <> 1 ELSE coalesce(n_hit, 0) = 0 END", "attempts")
def _(rows: DataFrame) -> DataFrame:
    """A third of the requests isn't there."""
    item = F.col("item").cast("bigint")
    there = rows.select(F.when(item % 3 == 1, -item).otherwise(item).alias("id")).distinct()
    return requests.check_touched(_lifecycle(rows), there)
