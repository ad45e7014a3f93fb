"""Calibration requests and jobs: selection, admission, snapshots and state folded from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import is_mode
from ..sources.commits import CommittedTables
from .order import running

#: States in which a job is over.
FINISHED = ("Cancelled", "Error", "Ready")
#: States a job service reports.
STATES = ("Queued", "WaitCal", "Staging", "Staged", "Downloading", "Preprocessing", "Imaging", "Delivering", "Ready", "Error", "Expired", "Cancelled")


def unrequested_cal_obs(observations: DataFrame, schedule: DataFrame, data_files: DataFrame, fits: DataFrame, requests: DataFrame, oldest: int, mode_prefix: str = "") -> DataFrame:
    """``obs_id`` of calibrators nobody asked for: correlator mode, archivable, with visibility files, no fit, no request, not the Sun."""
    # a null name of the calibrator, and files without a name, drop out
    cal = schedule.where("calibration AND upper(calibrators) <> 'SUN'").select(F.col("observation_number").alias("obs_id"))
    files = data_files.where("filetype = 18 AND filename IS NOT NULL AND deleted_timestamp IS NULL").select(F.col("observation_num").alias("obs_id"))
    return (
        observations.where((F.col("mode") == mode_prefix + "CORRELATOR") & (F.col("project_id") != "C123") & (F.col("obs_id") > oldest))
        .select("obs_id").distinct().join(cal, "obs_id", "left_semi").join(files, "obs_id", "left_semi")
        .join(fits.select(F.col("obsid").alias("obs_id")), "obs_id", "left_anti")
        .join(requests.select(F.col("cal_id").alias("obs_id")), "obs_id", "left_anti")
        .orderBy("obs_id")
    )


def open_requests(requests: DataFrame) -> DataFrame:
    """Requests not yet submitted for computing: realtime ones, and downloads neither complete nor failed; plain before bulk, then oldest first.

    A request whose ``realtime`` is null is neither.
    """
    free = "slurm_job_id IS NULL AND (realtime OR (NOT realtime AND download_completed_datetime IS NULL AND download_error_datetime IS NULL AND download_job_submitted_error_datetime IS NULL))"
    return requests.where(free).orderBy(F.col("bulk_request").asc_nulls_last(), F.col("request_added_datetime").asc_nulls_last(), "id")


def job_class(requests: DataFrame) -> DataFrame:
    """Adds ``nice, wall_hours, partition`` of the compute job."""
    return requests.withColumns({
        "nice": F.when(F.col("realtime"), 0).when(F.col("bulk_request"), 10_000).otherwise(1_000),
        "wall_hours": F.when(F.col("realtime"), 4).otherwise(10),
        "partition": F.when(F.col("realtime"), "priority,gpu").otherwise("gpu"),
    })


def admit(requests: DataFrame, jobs: DataFrame, max_jobs: int) -> DataFrame:
    """Adds ``decision`` (realtime, tracked, admit, queued) and ``rank`` to open requests.

    Downloads are admitted in order of (bulk, added, id) while jobs in progress are fewer than ``max_jobs``; those admitted
    have their ``rank``, others none. So only the first ``max_jobs`` of the backlog are put in order: each task keeps as many.
    """
    busy = jobs.agg(F.count_if(~F.col("state").isin(*FINISHED)).alias("_busy"))
    tracked = jobs.select(F.explode("request_ids").alias("id")).distinct().withColumn("_tracked", F.lit(True))
    rows = requests.join(tracked, "id", "left").crossJoin(F.broadcast(busy))  # one row
    order = [F.col("bulk_request").asc_nulls_last(), F.col("request_added_datetime").asc_nulls_last(), F.col("id").asc()]
    first = rows.where("NOT realtime AND _tracked IS NULL").select("id", "bulk_request", "request_added_datetime", "_busy").orderBy(*order).limit(max_jobs)
    # at most max_jobs rows
    ranked = first.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")).where(F.col("rank") <= F.lit(max_jobs) - F.col("_busy"))
    rows = rows.join(ranked.select("id", "rank"), "id", "left")
    decision = F.when(F.col("realtime"), "realtime").when(F.col("_tracked"), "tracked").when(F.col("rank").isNotNull(), "admit").otherwise("queued")
    return rows.withColumn("decision", decision).drop("_busy", "_tracked")


def parse_snapshot(snapshots: DataFrame) -> DataFrame:
    """``snapshot_ts, job_id, obs_id, state, url, valid`` from JSON objects of jobs; an error is an object, its key is the state."""
    jobs = snapshots.select("snapshot_ts", F.explode(F.from_json("body", "map<string,string>")).alias("key", "job"))
    raw = F.get_json_object("job", "$.jobState")
    state = F.when(raw.startswith("{"), F.json_object_keys(raw)[0]).otherwise(raw)
    rows = jobs.select(
        "snapshot_ts", F.get_json_object("job", "$.jobId").try_cast("bigint").alias("job_id"), F.get_json_object("job", "$.obsid").try_cast("bigint").alias("obs_id"),
        state.alias("state"), F.get_json_object("job", "$.files[0].fileUrl").alias("url"),
    )
    return rows.withColumn("url", F.when(F.col("state") == "Ready", F.col("url"))).withColumn("valid", F.coalesce(F.col("state").isin(*STATES), F.lit(False)))


def sync_jobs(jobs: DataFrame, snapshot: DataFrame, seen_at: str) -> DataFrame:
    """Tracked jobs after a snapshot, with ``change``: changed, same, or removed for those that it doesn't hold."""
    new = snapshot.select("job_id", F.col("state").alias("_state"), F.col("url").alias("_url"))
    rows = jobs.join(new, "job_id", "left")
    there = F.col("_state").isNotNull()
    moved = ~F.col("state").eqNullSafe(F.col("_state")) | ~F.col("url").eqNullSafe(F.col("_url"))
    rows = rows.withColumn("change", F.when(~there, "removed").when(moved, "changed").otherwise("same"))
    return rows.withColumns({
        "state": F.coalesce("_state", "state"), "url": F.when(there, F.col("_url")).otherwise(F.col("url")),
        "last_seen": F.when(there, F.to_timestamp(F.lit(seen_at))).otherwise(F.col("last_seen")),
    }).drop("_state", "_url")


def drop_removed(jobs: DataFrame, snapshot: DataFrame) -> DataFrame:
    return jobs.join(snapshot.select("job_id"), "job_id", "left_semi")


def is_tracked(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    return requests.join(jobs.select(F.explode("request_ids").alias("id")), "id", "left_semi")


def job_actions(jobs: DataFrame) -> DataFrame:
    """Adds ``action``: record_error, submit (ready and not yet submitted) or wait."""
    return jobs.withColumn("action", F.when(F.col("state") == "Error", "record_error").when((F.col("state") == "Ready") & ~F.col("slurm_submitted"), "submit").otherwise("wait"))


def queue_counters(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """One row: open requests of each class and jobs in progress (all states but cancelled, error and ready)."""
    r = requests.agg(
        F.count_if(F.col("realtime")).alias("open_realtime"),
        F.count_if(~F.col("realtime") & F.coalesce("bulk_request", F.lit(False))).alias("open_bulk"),
        F.count_if(~F.col("realtime") & ~F.coalesce("bulk_request", F.lit(False))).alias("open_download"),
    )
    return r.crossJoin(jobs.agg(F.count_if(~F.col("state").isin(*FINISHED)).alias("in_progress")))  # one row each


def name_prefix_count(queue: DataFrame, prefix: str) -> DataFrame:
    """One row: jobs of a compute queue (``name``) whose name starts with ``prefix``."""
    return queue.agg(F.count_if(F.col("name").startswith(prefix)).alias("n_jobs"))


def new_requests(unrequested: DataFrame) -> DataFrame:
    return unrequested.select(F.col("obs_id").alias("cal_id"), F.lit(True).alias("realtime"), F.lit(False).alias("bulk_request"))


def validate_events(events: DataFrame) -> DataFrame:
    """Adds ``accepted``: a download event is complete or has an error with its message, not both; a calibration event likewise, with a fit when complete."""
    p = lambda k: F.col("payload")[k].isNotNull()
    error = p("error_datetime") & p("error_message")
    none = ~p("error_datetime") & ~p("error_message")
    download = (p("completed_datetime") & none) | (~p("completed_datetime") & error)
    calibration = (p("completed_datetime") & p("fit_id") & none) | (~p("completed_datetime") & ~p("fit_id") & error)
    return events.withColumn("accepted", F.when(F.col("kind") == "download", download).when(F.col("kind") == "calibration", calibration).otherwise(True))


_ERROR = {"error_datetime": "error_datetime", "error_message": "error_message"}
#: Fields of a request that each kind of event writes, and the payload's key that each is taken from (none: it is cleared).
RULES: dict[str, dict[str, str | None]] = {
    "submit_download": {"download_job_id": "job_id", "download_job_submitted_datetime": "submitted_datetime", **{f"download_job_submitted_{k}": v for k, v in _ERROR.items()}},
    "submit_compute": {"slurm_job_id": "job_id", "download_slurm_job_submitted_datetime": "submitted_datetime", **{f"download_slurm_job_submitted_{k}": v for k, v in _ERROR.items()}},
    "assign": {"assigned_hostname": "hostname", "assigned_datetime": "started_datetime", "download_started_datetime": "started_datetime"},
    "download": {"download_completed_datetime": "completed_datetime", **{f"download_{k}": v for k, v in _ERROR.items()}},
    "calibration_started": {
        "download_completed_datetime": "started_datetime", "calibration_started_datetime": "started_datetime", "calibration_completed_datetime": None, "calibration_fit_id": None,
        "calibration_error_datetime": None, "calibration_error_message": None,
    },
    "calibration": {"calibration_completed_datetime": "completed_datetime", "calibration_fit_id": "fit_id", **{f"calibration_{k}": v for k, v in _ERROR.items()}},
}
#: All fields that events write, in order.
FIELDS = list(dict.fromkeys(f for rule in RULES.values() for f in rule))
#: Kinds that name their requests; the others are keyed by the compute job if they have one.
SUBMITS = ("submit_download", "submit_compute")


def apply_rules(events: DataFrame) -> DataFrame:
    """``payload`` and ``touches`` by the event's kind; those of a kind without a rule, and all without a kind, stay."""
    if "kind" not in events.columns:
        return events
    source = F.col("payload")
    touches = F.col("touches") if "touches" in events.columns else F.array().cast("array<string>")
    payload = source
    for kind, rule in RULES.items():
        values = {f: source[k] if k else F.lit(None).cast("string") for f, k in rule.items()}
        if kind == "submit_compute" and "slurm_job_id" in events.columns:
            values["slurm_job_id"] = F.coalesce(values["slurm_job_id"], F.col("slurm_job_id").cast("string"))
        mine = F.col("kind") == kind
        payload = F.when(mine, F.create_map(*[x for f, v in values.items() for x in (F.lit(f), v)])).otherwise(payload)
        touches = F.when(mine, F.array(*[F.lit(f) for f in rule])).otherwise(touches)
    return events.withColumns({"payload": payload, "touches": touches})


def is_named(events: DataFrame) -> Column:
    """Whether an event (after ``apply_rules``) is keyed by its ``request_ids``."""
    if "slurm_job_id" not in events.columns:
        return F.lit(True)
    named = F.col("slurm_job_id").isNull() | F.coalesce(F.array_contains("touches", "slurm_job_id"), F.lit(False))
    return named | F.coalesce(F.col("kind").isin(*SUBMITS), F.lit(False)) if "kind" in events.columns else named


def _at() -> Column:
    return F.struct("ts", "event_id")


def _held(events: DataFrame) -> DataFrame:
    """``id, _from, _to, _job``: from when to when (null: still) a request has the job that a computing submission set."""
    sets = events.where(F.array_contains("touches", "slurm_job_id")).select(F.explode("request_ids").alias("id"), _at().alias("_from"), F.col("payload")["slurm_job_id"].try_cast("bigint").alias("_job"))
    held = sets.withColumn("_to", F.lead("_from").over(Window.partitionBy("id").orderBy("_from")))
    return held.where("_job IS NOT NULL AND (_to IS NULL OR _from < _to)").distinct()


def resolve_requests(events: DataFrame) -> DataFrame:
    """Each event (after ``apply_rules``) once for each request it touches, as ``id``.

    Submissions and events without a ``slurm_job_id`` touch their ``request_ids``; other events touch the requests
    whose last computing submission before them, by (ts, event_id), set that job. An event of a job that many requests
    share gives as many rows: what needs only the last event or a number takes ``running`` along the job's times instead.
    """
    if "slurm_job_id" not in events.columns:
        return events.withColumn("id", F.explode("request_ids"))
    named, held = is_named(events), _held(events)
    by_job = events.where(~named).withColumn("_at", _at()).join(held, (F.col("slurm_job_id") == F.col("_job")) & (F.col("_at") > F.col("_from")) & (F.col("_to").isNull() | (F.col("_at") < F.col("_to"))))
    return events.where(named).withColumn("id", F.explode("request_ids")).unionByName(by_job.select(*events.columns, "id"))


def _sliced(rows: DataFrame) -> DataFrame:
    """Adds ``_slice``, the hour of ``_at``; what has no time because it lies after all events (``_open``) has the last."""
    return rows.withColumn("_slice", F.when(F.col("_open"), F.lit(2**62)).otherwise(F.floor(F.unix_seconds(F.col("_at.ts").cast("timestamp")) / 3600)))


def _along() -> list[Column]:
    """Order along a job's times: of equal ones an end goes before an event, and a start after it."""
    return [F.col("_open").asc(), F.col("_at").asc(), F.col("_step").asc()]


def fold_requests(events: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Current row of each request: for each field what the last event that touches it wrote, which may be null.

    ``events``: ``event_id, ts (a time or a number), request_ids, payload (map), touches (array of fields)`` and, where there are, ``kind``
    (which then gives payload and touches by ``RULES``) and ``slurm_job_id``; values stay strings. One aggregation with
    partial results, whatever the number of events of a request. Of the events of a job a request needs the last one of each field before
    it leaves the job, so events aren't repeated for the requests that share it. Events are taken as accepted (see ``validate_events``).
    """
    fields = FIELDS if fields is None else fields
    ruled = apply_rules(events)
    last = [f"_{i}" for i in range(len(fields))]
    written = [F.when(F.array_contains("touches", f), F.struct(_at().alias("at"), F.col("payload")[f].alias("v"))).alias(n) for f, n in zip(fields, last, strict=True)]
    rows = ruled.where(is_named(ruled)).select(F.explode("request_ids").alias("id"), *written)
    if "slurm_job_id" in events.columns:
        told = ruled.where(~is_named(ruled)).select(F.col("slurm_job_id").try_cast("bigint").alias("_job"), F.lit(False).alias("_open"), _at().alias("_at"), F.lit(1).alias("_step"), *written)
        asked = _held(ruled).select("_job", F.col("_to").isNull().alias("_open"), F.col("_to").alias("_at"), F.lit(0).alias("_step"), "id", "_from")
        known = running(_sliced(told.unionByName(asked, allowMissingColumns=True)), ["_job"], ["_slice"], _along(), {n: F.max for n in last}).where("_step = 0")
        rows = rows.unionByName(known.select("id", *[F.when(F.col(n)["at"] > F.col("_from"), F.col(n)).alias(n) for n in last]))
    return rows.groupBy("id").agg(*[F.max(n).alias(n) for n in last]).select("id", *[F.col(n)["v"].alias(f) for f, n in zip(fields, last, strict=True)])


def check_touched(events: DataFrame, requests: DataFrame) -> DataFrame:
    """Events that don't hit exactly the requests they name: ``event_id, n_named, n_hit``.

    An event keyed by its compute job names no number (``n_named`` is null), so it is one of these if it hits none. Its hits are counted along the
    job's times: requests that have come to the job before it, less those that have left.
    """
    ruled, there = apply_rules(events), requests.groupBy("id").agg(F.count("*").alias("n_hit"))
    hits = ruled.where(is_named(ruled)).select("event_id", F.explode("request_ids").alias("id")).join(there, "id").select("event_id", "n_hit")
    if "slurm_job_id" in events.columns:
        told = ruled.where(~is_named(ruled)).select(F.col("slurm_job_id").try_cast("bigint").alias("_job"), _at().alias("_at"), F.lit(1).alias("_step"), "event_id", F.lit(0).cast("bigint").alias("n_hit"))
        held = _held(ruled).join(there, "id")
        come = held.select("_job", F.col("_from").alias("_at"), F.lit(2).alias("_step"), "n_hit")
        left = held.where("_to IS NOT NULL").select("_job", F.col("_to").alias("_at"), F.lit(0).alias("_step"), (-F.col("n_hit")).alias("n_hit"))
        along = told.unionByName(come, allowMissingColumns=True).unionByName(left, allowMissingColumns=True).withColumn("_open", F.lit(False))
        hits = hits.unionByName(running(_sliced(along), ["_job"], ["_slice"], _along(), {"n_hit": F.sum}).where("_step = 1").select("event_id", "n_hit"))
    hits = hits.groupBy("event_id").agg(F.sum("n_hit").alias("n_hit"))
    named = F.when(is_named(events) & F.col("request_ids").isNotNull(), F.size("request_ids").cast("bigint"))
    rows = ruled.select("event_id", named.alias("n_named")).join(hits, "event_id", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("bigint")))
    return rows.where("n_named <> n_hit OR n_named IS NULL AND n_hit = 0")


def fit_header(batch: DataFrame, *, fit_time: str, creator: str, code_version: str, niter: int, limit: int, gain_max_cutoff: float | None = None) -> DataFrame:
    """One header row for each observation: its id is the caller's time in whole microseconds, so that a rerun makes the same."""
    when = F.to_timestamp(F.lit(fit_time))
    return batch.select("obs_id").distinct().select(
        F.unix_micros(when).alias("fitid"), F.col("obs_id").alias("obsid"), F.lit(code_version).alias("code_version"), when.alias("fit_time"), F.lit(creator).alias("creator"),
        F.lit(niter).alias("fit_niter"), F.lit(limit).alias("fit_limit"), F.lit(gain_max_cutoff).cast("double").alias("gain_max_cutoff"),
    )


def commit_fits(tables: CommittedTables, batch: str, header: DataFrame, solutions: DataFrame) -> bool:
    """Headers (``fit_header``) and the rows of all their tiles published together, once; False if ``batch`` is published already.

    Solutions without a header, and headers without a solution, are an error before anything is published: a reader never meets half a fit.
    """
    key = ["fitid", "obsid"]
    apart = header.select(*key).distinct().withColumn("_h", F.lit(1)).join(solutions.select(*key).distinct().withColumn("_s", F.lit(1)), key, "full").where("_h IS NULL OR _s IS NULL")
    if not apart.isEmpty():
        raise ValueError("headers and solutions don't belong together")
    return tables.commit(batch, adds={"calibration_fits": header, "calibration_solutions": solutions})


def solution_for_channel(requests: DataFrame, solution_files: DataFrame) -> DataFrame:
    """``cal_obs, rec_chan, path``: the file that holds a channel's solution; one for all channels goes first, then by first channel and path."""
    files = solution_files.where("obs_id IS NOT NULL").select(F.col("obs_id").alias("cal_obs"), "path", F.when(F.col("all_chans"), 0).otherwise(F.col("chan_from")).alias("_from"), "chan_to", "all_chans")
    asked = requests.select("cal_obs", "rec_chan").distinct()
    hits = asked.join(files, "cal_obs").where("all_chans OR rec_chan BETWEEN _from AND chan_to")
    best = hits.groupBy("cal_obs", "rec_chan").agg(F.min(F.struct("_from", "path")).alias("best"))
    return asked.join(best, ["cal_obs", "rec_chan"], "left").select("cal_obs", "rec_chan", F.col("best.path").alias("path"))


#: Slices of a span, and spans of a long one (level 2): a window takes a row for each long span in it, and at most four times as many as this at its ends.
SPAN, LEVELS = 64, 2
#: Slices of time at most, and files of a slice on average at least.
SLICES, SLICE_FILES = SPAN**LEVELS, 1024
#: Files of a slice, and windows of a place, that meet as one row each: their pairs come out together, so that columns of a written page repeat.
BLOCK, CHUNK = 16, 256


def _place(level: int, number: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), number.alias("number"))


def _places(first: Column, last: Column, level: int = 0) -> Column:
    """Slices ``first`` to ``last`` as whole spans and what is before and after them (level 0: slices), each slice once."""
    up = lambda a, b: F.when(a <= b, F.transform(F.sequence(a, b), lambda x: _place(level, x))).otherwise(F.array().cast("array<struct<level:int,number:bigint>>"))
    if level == LEVELS:
        return up(first, last)
    begin, end = F.ceil(first / SPAN), F.floor((last + 1) / SPAN)  # the span at end isn't whole any more
    return F.when(begin < end, F.concat(up(first, begin * SPAN - 1), _places(begin, end - 1, level + 1), up(end * SPAN, last))).otherwise(up(first, last))


def select_dump(subfiles: DataFrame, dumps: DataFrame, retain: int = 2, end_inclusive: bool = True, mode_prefix: str = "") -> DataFrame:
    """``request_id, path, subobs_id, trigger_id``: files to dump for each request.

    The first ``retain`` free files by path, of any mode, are left to the capture; start 0 is no lower bound; voltage files aren't
    dumped; a file's own trigger goes before the request's. The result has a row for each file of each window. A file travels once,
    to its slice of time; windows are gathered at the spans of slices that they cover, and arrays of both meet in a slice. Few
    files far from the others make no slices wide.
    """
    subfiles = subfiles.where("path IS NOT NULL")
    skip = subfiles.orderBy("path").limit(retain).select("path")
    rows = subfiles.where(~is_mode(F.col("mode"), "vcs", mode_prefix)).join(F.broadcast(skip), "path", "left_anti").withColumnRenamed("trigger_id", "_trigger")
    most = F.greatest(F.lit(1), F.least(F.lit(SLICES), F.ceil(F.count("subobs_id") / SLICE_FILES)))
    ends = rows.agg(F.min("subobs_id").alias("_low"), F.max("subobs_id").alias("_high"), F.percentile_approx("subobs_id", [0.001, 0.999]).alias("_q"), most.alias("_slices"))  # one row
    ends = ends.selectExpr("_low", "_high", "_slices", "greatest(_low, _q[0] - (_q[1] - _q[0]) div 100) AS _first", "least(_high, _q[1] + (_q[1] - _q[0]) div 100) AS _last")
    ends = F.broadcast(ends.selectExpr("_low", "_high", "_slices", "_first AS _begin", "(_last - _first) div _slices + 1 AS _width"))
    slice_of = lambda gps: F.greatest(F.lit(0), F.least(F.col("_slices") - 1, F.floor((F.col(gps) - F.col("_begin")) / F.col("_width"))))
    nth = lambda key, size, *by: F.floor((F.row_number().over(Window.partitionBy(key).orderBy(*by)) - 1) / size)
    asked = dumps.withColumn("_to", F.col("end_gps") if end_inclusive else F.col("end_gps") - 1).where("start_gps IS NOT NULL AND _to IS NOT NULL").crossJoin(ends)
    asked = asked.withColumns({"_from": F.when(F.col("start_gps") == 0, F.col("_low")).otherwise(F.greatest("start_gps", "_low")), "_to": F.least("_to", "_high")}).where("_from <= _to")
    asked = asked.select("_from", "_to", "request_id", "trigger_id", F.explode(_places(slice_of("_from"), slice_of("_to"))).alias("_place"))
    held = asked.withColumn("_chunk", nth("_place", CHUNK, "_from", "_to")).groupBy("_place", "_chunk").agg(
        F.min("_from").alias("_first"), F.max("_to").alias("_last"), F.collect_list(F.struct("_from", "_to", "request_id", "trigger_id")).alias("_windows")
    )
    number, wide = F.col("_place.number"), F.pow(F.lit(SPAN), F.col("_place.level")).cast("long")
    held = held.select("_first", "_last", "_windows", F.explode(F.sequence(number * wide, (number + 1) * wide - 1)).alias("_slice"))
    placed = rows.where("subobs_id IS NOT NULL").crossJoin(ends).select("path", "subobs_id", "_trigger", slice_of("subobs_id").alias("_slice"))
    blocks = placed.withColumn("_block", nth("_slice", BLOCK, "subobs_id")).groupBy("_slice", "_block").agg(
        F.min("subobs_id").alias("_begin"), F.max("subobs_id").alias("_end"), F.collect_list(F.struct("path", "subobs_id", "_trigger")).alias("_files")
    )
    met = blocks.join(held, "_slice").where("_begin <= _last AND _end >= _first").select("_windows", F.inline("_files"))
    hits = met.select("path", "subobs_id", "_trigger", F.inline("_windows")).where("subobs_id BETWEEN _from AND _to")
    return hits.select("request_id", "path", "subobs_id", F.coalesce("_trigger", "trigger_id").alias("trigger_id"))
