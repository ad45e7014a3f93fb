"""Operators applied to the stand-in views, each with the same question in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import exprs
from ..operators import catalog, fits, ledger, order, requests, retry, solutions
from ..sources import files as sources
from ..streaming import streams
from .registry import ORACLE_SQL, QUERIES, query, r
from .request_queries import UNREQUESTED, schedule_files_requests
from .standins import duck

__all__ = ["ORACLE_SQL", "QUERIES"]

# files
_NAMED = """, n AS (SELECT *, split_part(path, '/', 4) AS name FROM files), m AS (SELECT *, lower(regexp_extract(name, '^.+(\\.[^.]*)$', 1)) AS file_ext, regexp_replace(name, '^(.+)\\.[^.]*$', '\\1') AS stem,
  TRY_CAST(regexp_extract(name, '^([0-9]{10})', 1) AS BIGINT) AS obs_id FROM n),
t AS (SELECT *, CASE WHEN obs_id IS NULL THEN NULL WHEN file_ext = '.sub' THEN 17 WHEN file_ext = '.fits' AND substr(stem, 11) IN ('_metafits', '_metafits_ppds') THEN 14 WHEN file_ext = '.fits' THEN 18
  WHEN file_ext = '.metafits' THEN 14 WHEN file_ext = '.zip' THEN 10 WHEN file_ext IN ('.vdif', '.hdr') THEN 19 WHEN file_ext = '.fil' THEN 20 END AS filetype_id FROM m),
v AS (SELECT t.path, t.obs_id, t.filetype_id, t.file_ext, o.project_id, o.calibrator AND o.calibrator_source <> 'SUN' AS calibrator,
  CASE WHEN t.obs_id IS NULL THEN 'name does not begin with an observation id' WHEN filetype_id IS NULL THEN 'unknown extension'
  WHEN NOT CASE filetype_id WHEN 17 THEN length(stem) IN (23, 24, 25) WHEN 18 THEN length(stem) = 35 WHEN 14 THEN length(stem) IN (24, 19, 10) WHEN 10 THEN length(stem) = 16 ELSE length(stem) IN (23, 34) END
  THEN 'name has a wrong length for its type' WHEN o.obs_id IS NULL THEN 'observation not found' ELSE '' END AS message FROM t LEFT JOIN observations o USING (obs_id)),
p AS (SELECT *, message = '' AS valid, CASE WHEN message <> '' THEN NULL WHEN filetype_id = 14 THEN 1 WHEN filetype_id = 18 THEN CASE WHEN calibrator THEN 2 WHEN project_id = 'D0006' THEN 3 ELSE 30 END
  WHEN filetype_id IN (19, 20) THEN CASE WHEN project_id = 'C001' THEN 5 ELSE 10 END WHEN filetype_id = 17 THEN CASE WHEN project_id = 'C001' THEN 20 ELSE 90 END ELSE 100 END AS priority FROM v)"""
_VIEWS = ("files", "observations")
_ARCH = "upper(project_id) <> 'C123'"


def _prioritised(listing: DataFrame, obs: DataFrame) -> DataFrame:
    return catalog.with_priority(catalog.validate_files(listing.select("path"), obs), ["D0006"], ["C001"])


def _files_sql(tail: str) -> str:
    return duck(*_VIEWS) + _NAMED + " " + tail


@query("a11_validate_files", _files_sql("SELECT path, obs_id, filetype_id, file_ext, project_id, calibrator, message, valid FROM p"), *_VIEWS)
def _(listing, obs):
    return catalog.validate_files(listing.select("path"), obs).select("path", "obs_id", "filetype_id", "file_ext", "project_id", "calibrator", "message", "valid")


@query("a12_priority", _files_sql("SELECT path, priority FROM p"), *_VIEWS)
def _(listing, obs):
    return _prioritised(listing, obs).select("path", "priority")


@query("a13_route_ingest", _files_sql(f"SELECT path, CASE WHEN filetype_id = 18 THEN 'processing_stats' WHEN filetype_id IN (17, 14, 19, 20) THEN CASE WHEN {_ARCH} THEN 'outgoing' ELSE 'dont_archive' END END AS route FROM p"), *_VIEWS)
def _(listing, obs):
    return catalog.route_ingest(_prioritised(listing, obs), True).select("path", "route")


@query("a14_route_visibility", _files_sql(f"SELECT path, ends_with(path, '_000.fits') AS stats_selected, CASE WHEN NOT coalesce({_ARCH}, false) THEN 'dont_archive' WHEN calibrator THEN 'outgoing_cal' ELSE 'outgoing' END AS route FROM p WHERE filetype_id = 18"), *_VIEWS)
def _(listing, obs):
    return catalog.route_visibility(_prioritised(listing, obs).where("filetype_id = 18"), True).select("path", "stats_selected", "route")


@query("a15_release_cal", _files_sql(f"SELECT path, CASE WHEN {_ARCH} THEN 'outgoing' ELSE 'dont_archive' END AS route FROM p WHERE obs_id IN (SELECT obs_id FROM observations WHERE o_orderkey % 3 = 0)"), *_VIEWS)
def _(listing, obs):
    return catalog.release_cal(_prioritised(listing, obs), obs.select(F.expr("CASE WHEN o_orderkey % 3 = 0 THEN obs_id ELSE -obs_id END AS obs_id")), True).select("path", "route")


@query("a17_bucket", _files_sql("SELECT path, 'site-' || substr(CAST(obs_id AS VARCHAR), 1, 5) AS bucket FROM p WHERE valid"), *_VIEWS)
def _(listing, obs):
    return catalog.with_bucket(_prioritised(listing, obs).where("valid"), 2, "site-").select("path", "bucket")


@query("e1_backlog_top", _files_sql("SELECT path, priority FROM p WHERE valid ORDER BY priority, split_part(path, '/', 4), path LIMIT 100"), *_VIEWS)
def _(listing, obs):
    return retry.rank_backlog(_prioritised(listing, obs).where("valid"), 100).select("path", "priority")


@query("e1_backlog_rank", _files_sql("SELECT path, priority, row_number() OVER (ORDER BY priority ASC NULLS LAST, split_part(path, '/', 4), path) AS rank FROM p"), *_VIEWS)
def _(listing, obs):
    return order.rank_files(_prioritised(listing, obs)).select("path", "priority", "rank")


@query("a19_beam_names", "SELECT path, TRY_CAST(nullif(regexp_extract(split_part(path, '/', 4), '^([0-9]{10})_([0-9]{10})_ch([0-9]{1,3})_beam([0-9]{2})\\.(vdif|hdr|fil)$', 2), '') AS BIGINT) AS subobs_id, "
       "CASE WHEN ends_with(path, '.fil') THEN regexp_replace(path, '([0-9]{10})_[0-9]{10}(_ch[0-9]{1,3}_beam[0-9]{2}\\.[a-z]+)$', '\\1\\2') END AS stitched FROM files", "files")  # fmt: skip
def _(listing):
    return catalog.parse_names(listing, "beam").select("path", "subobs_id", "stitched")


@query("f3_retention", "SELECT path, CASE WHEN lower(path) LIKE '%.sub' AND TIMESTAMP '2000-01-01' - modification_time >= INTERVAL 1 DAY THEN 'age' ELSE 'partial' END AS reason FROM files WHERE lower(path) LIKE '%.sub' AND TIMESTAMP '2000-01-01' - modification_time >= INTERVAL 1 DAY OR path LIKE '%.part%' AND TIMESTAMP '2000-01-01' - modification_time > INTERVAL 1 HOUR", "files")
def _(listing):
    return ledger.retention_candidates(listing, F.to_timestamp(F.lit("2000-01-01")), 86_400, ["sub"]).select("path", "reason")


# ledger
@query("a6_append_ledger", "SELECT observation_num, filename, nullif(trigger_id, -1) AS trigger_id, 'site-' || substr(CAST(observation_num AS VARCHAR), 1, 5) AS obs_bucket FROM ledger WHERE observation_num IN (SELECT o_orderkey FROM observations)", "ledger", "observations")
def _(new, obs):
    return ledger.append_data_files(new, obs.select(F.col("o_orderkey").alias("obs_id")), "site-")[0].select("observation_num", "filename", "trigger_id", "obs_bucket")


@query("a7_mark_archived", "SELECT observation_num, filename, count(*) AS n_updates, count(*) AS n_rows FROM ledger GROUP BY ALL HAVING count(*) > 1", "ledger")
def _(rows):
    return ledger.mark_archived(rows, rows.select("observation_num", "filename", F.lit(2).alias("location"), F.lit("b").alias("bucket"), F.lit("f").alias("folder")))[1]


@query("a7_rewritten_ledger", """, k AS (SELECT observation_num, filename FROM ledger GROUP BY ALL HAVING count(*) = 1)
SELECT l.observation_num, l.filename, remote_archived OR k.filename IS NOT NULL AS remote_archived, CASE WHEN k.filename IS NOT NULL THEN 2 END AS location, CASE WHEN k.filename IS NOT NULL THEN 'b' END AS bucket, count(*) AS n
FROM ledger l LEFT JOIN k USING (observation_num, filename) GROUP BY ALL""", "ledger")  # fmt: skip
def _(rows):
    updates = rows.select("observation_num", "filename", F.lit(2).alias("location"), F.lit("b").alias("bucket"), F.lit("f").alias("folder"))
    return ledger.mark_archived(rows, updates)[0].groupBy("observation_num", "filename", "remote_archived", "location", "bucket").agg(F.count("*").alias("n"))


@query("b1_verify_archive", """, l AS (SELECT obs_id, filename, count(*) AS n, any_value(size) AS lsize, any_value(checksum) AS lmd5 FROM ledger GROUP BY ALL)
SELECT d.obs_id, d.filename, d.size, d.checksum, CASE WHEN coalesce(n, 0) <> 1 THEN 'error' WHEN size = 0 THEN 'drop' WHEN size <> lsize THEN 'drop' WHEN checksum <> lmd5 THEN 'retry' ELSE 'archive' END AS decision FROM disk d LEFT JOIN l USING (obs_id, filename)""", "disk", "ledger")  # fmt: skip
def _(disk, rows):
    return ledger.verify_archive(disk, rows)


@query("b6_obs_ready", """, e AS (SELECT DISTINCT obs_id, filename FROM ledger WHERE NOT deleted), pr AS (SELECT DISTINCT obs_id, filename FROM disk),
c AS (SELECT coalesce(e.obs_id, pr.obs_id) AS obs_id, count(e.filename) AS n_expected, count(pr.filename) AS n_present, array_to_string(list_sort(coalesce(list(e.filename) FILTER (WHERE pr.filename IS NULL), [])), ',') AS missing
FROM e FULL JOIN pr ON e.obs_id = pr.obs_id AND e.filename = pr.filename GROUP BY 1)
SELECT c.obs_id, n_expected, n_present, coalesce(missing, '') AS missing, n_expected = n_present AND n_expected > 0 AND c.obs_id + 180 <= 10000 AS ready FROM c""", "ledger", "disk")  # fmt: skip
def _(rows, disk):
    ends = rows.select("obs_id", F.col("obs_id").alias("end_gps")).unionByName(disk.select("obs_id", F.col("obs_id").alias("end_gps"))).distinct()
    return ledger.obs_ready(rows, disk, ends, F.lit(10_000)).withColumn("missing", F.array_join("missing", ","))


# retries
_RUNS = """, g AS (SELECT *, sum(success::INT) OVER (PARTITION BY item ORDER BY ts, event_id) AS run FROM attempts)"""
_STATE = _RUNS + """, s AS (SELECT item, max(run) AS last FROM g GROUP BY item), c AS (SELECT item, count(*) FILTER (WHERE NOT success AND run = last) AS failures, max(ts) AS ts, arg_max(priority, (ts, event_id)) AS pr FROM g JOIN s USING (item) GROUP BY item)"""


@query("e2_retry_state", _STATE + " SELECT item, failures, CASE WHEN failures = 0 THEN 0.0 ELSE least(60.0, 2.0 * failures) END::DOUBLE AS backoff_sec, CAST(pr + failures AS BIGINT) AS priority FROM c", "attempts")
def _(attempts):
    return retry.retry_state(attempts).drop("next_attempt")


@query("e3_retry_exponential", _STATE + " SELECT item, failures, CASE WHEN failures = 0 THEN 0.0 ELSE least(3600.0, 10.0 * pow(2, failures - 1)) END::DOUBLE AS backoff_sec FROM c", "attempts")
def _(attempts):
    return retry.retry_state(attempts, policy="exp", initial=10, factor=2, limit=3600).select("item", "failures", "backoff_sec")


@query("e2_failure_runs", _RUNS + " SELECT event_id, CAST(count(*) FILTER (WHERE NOT success) OVER (PARTITION BY item, run ORDER BY ts, event_id) AS BIGINT) AS n_failures FROM g", "attempts")
def _(attempts):
    return retry.failure_runs(attempts).select("event_id", "n_failures")


# requests and jobs
_OPEN = "slurm_job_id IS NULL AND (realtime OR (NOT realtime AND download_completed_datetime IS NULL AND download_error_datetime IS NULL AND download_job_submitted_error_datetime IS NULL))"


def _jobs(rows: DataFrame) -> DataFrame:
    """One job for each request; those of most track none (a negative number) and are ready."""
    tracked = F.col("id") % 50 == 3
    return rows.select(F.col("id").alias("job_id"), F.array(F.when(tracked, F.col("id")).otherwise(-F.col("id") - 1)).alias("request_ids"), F.when(F.col("id") % 100 == 3, "Queued").otherwise("Ready").alias("state"))


@query("b3_open_requests", f"SELECT id, realtime, bulk_request FROM requests WHERE {_OPEN}", "requests")
def _(rows):
    return requests.open_requests(rows).select("id", "realtime", "bulk_request")


@query("a23_job_class", "SELECT id, CASE WHEN realtime THEN 0 WHEN bulk_request THEN 10000 ELSE 1000 END AS nice, CASE WHEN realtime THEN 4 ELSE 10 END AS wall_hours, CASE WHEN realtime THEN 'priority,gpu' ELSE 'gpu' END AS partition FROM requests", "requests")
def _(rows):
    return requests.job_class(rows).select("id", "nice", "wall_hours", "partition")


@query("e4_admission", f""", o AS (SELECT * FROM requests WHERE {_OPEN}), b AS (SELECT count(*) AS busy FROM requests WHERE id % 100 = 3),
w AS (SELECT id, row_number() OVER (ORDER BY bulk_request ASC NULLS LAST, request_added_datetime ASC NULLS LAST, id) AS rank FROM o WHERE NOT realtime AND id % 50 <> 3)
SELECT o.id, CASE WHEN w.rank <= 1000 - busy THEN w.rank END AS rank, CASE WHEN realtime THEN 'realtime' WHEN o.id % 50 = 3 THEN 'tracked' WHEN w.rank <= 1000 - busy THEN 'admit' ELSE 'queued' END AS decision FROM o CROSS JOIN b LEFT JOIN w ON o.id = w.id""", "requests")  # fmt: skip
def _(rows):
    return requests.admit(requests.open_requests(rows), _jobs(rows), 1000).select("id", "rank", "decision")


@query("d14_queue_counters", f"SELECT count(*) FILTER (WHERE realtime) AS open_realtime, count(*) FILTER (WHERE NOT realtime AND coalesce(bulk_request, false)) AS open_bulk, count(*) FILTER (WHERE NOT realtime AND NOT coalesce(bulk_request, false)) AS open_download, (SELECT count(*) FROM requests WHERE id % 100 = 3) AS in_progress FROM requests WHERE {_OPEN}", "requests")
def _(rows):
    return requests.queue_counters(requests.open_requests(rows), _jobs(rows))


@query("b2_unrequested", UNREQUESTED + " SELECT DISTINCT obs_id FROM u WHERE o_orderkey % 5 <> 2", "observations", "ledger", "requests")
def _(obs, rows, asked):
    fitted = obs.select(F.when(F.col("o_orderkey") % 5 == 2, F.col("obs_id")).otherwise(-F.col("obs_id")).alias("obsid"))
    return requests.unrequested_cal_obs(obs, *schedule_files_requests(obs, rows, asked, fitted), 1244980000, "XYZ_")


@query("c3_fold_requests", "SELECT CAST(item AS BIGINT) AS id, arg_max(CASE WHEN success THEN CAST(event_id AS VARCHAR) ELSE 'none' END, (ts, event_id)) AS job, arg_max(CAST(event_id AS VARCHAR), (ts, event_id)) FILTER (WHERE NOT success) AS error FROM attempts GROUP BY item", "attempts")
def _(rows):
    events = rows.select(
        "event_id", "ts", F.array(F.col("item").cast("bigint")).alias("request_ids"),
        F.create_map(F.lit("job"), F.when(F.col("success"), F.col("event_id").cast("string")), F.lit("error"), F.col("event_id").cast("string")).alias("payload"),
        F.when(F.col("success"), F.array(F.lit("job"))).otherwise(F.array(F.lit("job"), F.lit("error"))).alias("touches"),
    )
    # a failure writes a null job; it is shown as none, apart from a job never written
    return requests.fold_requests(events, ["job", "error"]).withColumn("job", F.coalesce("job", F.lit("none")))


# solutions
@query("d2_coarse_ranges", ", c AS (SELECT DISTINCT obs_id, tile_id // 7 + 3 * (tile_id // 70) + tile_id % 7 AS ch FROM tiles), i AS (SELECT *, ch - row_number() OVER (PARTITION BY obs_id ORDER BY ch) AS run FROM c), x AS (SELECT obs_id, min(ch) AS chan_from, max(ch) AS chan_to, count(*) AS n_chans FROM i GROUP BY obs_id, run) SELECT obs_id, CAST(row_number() OVER (PARTITION BY obs_id ORDER BY chan_from) - 1 AS INT) AS range_idx, chan_from, chan_to, n_chans FROM x", "tiles")
def _(tiles):
    return solutions.coarse_ranges(tiles.select("obs_id", F.expr("CAST(tile_id div 7 + 3 * (tile_id div 70) + tile_id % 7 AS INT) AS rec_chan")))


@query("d1_refant", "SELECT obs_id, min(tile_id) FILTER (WHERE NOT flag AND tile_id > 20) AS tile_id, 'Tile' || CAST(min(tile_id) FILTER (WHERE NOT flag AND tile_id > 20) AS VARCHAR) AS name FROM tiles GROUP BY obs_id", "tiles")
def _(tiles):
    return solutions.refant(tiles, tiles.select("obs_id", F.col("name").alias("tile_name"), (F.col("tile_id") <= 20).alias("flag")))


_BLOCKS = "SELECT obs_id, tile_id, rx AS band, chan_idx, CASE WHEN chan_idx % 5 = 0 THEN NULL ELSE re / 1000 END AS result FROM gains"


def _blocks(gains: DataFrame) -> DataFrame:
    return gains.select("obs_id", "tile_id", F.col("rx").alias("band"), "chan_idx", F.when(F.col("chan_idx") % 5 != 0, F.col("re") / 1000).alias("result"))


@query("d4_conv_weights", f", b AS ({_BLOCKS}), e AS (SELECT *, CASE WHEN result >= 0 AND result <= 1e-4 THEN exp(-result) END AS e FROM b), w AS (SELECT *, min(e) OVER (PARTITION BY obs_id) AS lo, max(e) OVER (PARTITION BY obs_id) AS hi FROM e) SELECT tile_id, chan_idx, round(coalesce((e - lo) / nullif(hi - lo, 0), 0), 6) AS weight FROM w", "gains")
def _(gains):
    return solutions.conv_weights(_blocks(gains)).select("tile_id", "chan_idx", r("weight", "weight"))


@query("d5_convergence_summary", f", b AS ({_BLOCKS}) SELECT obs_id, band, count(*) AS n_total, count(result) AS n_converged, round(100.0 * count(result) / count(*), 6)::DOUBLE AS percent, round(avg(result), 9) AS mean_result FROM b GROUP BY obs_id, band", "gains")
def _(gains):
    return solutions.convergence_summary(_blocks(gains)).select("obs_id", "band", "n_total", "n_converged", r("percent", "percent"), r("mean_result", "mean_result", 9))


_JONES = ", j AS (SELECT obs_id, tile_id, chan_idx, re AS xr, im AS xi, 0.1 * im AS ar, 0.2 * re AS ai, 0.3 * re AS br, 0.1 * im AS bi, im + 2 AS yr, re AS yi FROM gains)"


def _jones(gains: DataFrame) -> DataFrame:
    re, im = F.col("re"), F.col("im")
    cells = {"xx": (re, im), "xy": (0.1 * im, 0.2 * re), "yx": (0.3 * re, 0.1 * im), "yy": (im + 2, re)}
    return gains.select("obs_id", F.lit(0).alias("time_idx"), F.col("tile_id").alias("ant_idx"), "chan_idx", *[v.alias(f"{p}_{x}") for p, c in cells.items() for x, v in zip(("re", "im"), c, strict=True)])


def _normalised_sql() -> str:
    """All four products of each matrix with the inverse of the reference's."""
    times = lambda p, q: (f"({p}r * {q}r - {p}i * {q}i)", f"({p}r * {q}i + {p}i * {q}r)")
    minus = lambda p, q: tuple(f"({u} - {v})" for u, v in zip(p, q, strict=True))
    det = minus(times("rx", "ry"), times("ra", "rb"))
    tops = {"xx": minus(times("x", "ry"), times("a", "rb")), "xy": minus(times("a", "rx"), times("x", "ra")), "yx": minus(times("b", "ry"), times("y", "rb")), "yy": minus(times("y", "rx"), times("b", "ra"))}
    cells = ", ".join(f"{re} AS {p}r, {im} AS {p}i" for p, (re, im) in tops.items())
    shown = ", ".join(
        f"round(({v}) / (1 + abs({v})), 5) + 0.0 AS {p}_{x}"  # no negative zeros
        for p in tops for x, v in (("re", f"(({p}r * dr + {p}i * di) / nullif(dr * dr + di * di, 0))"), ("im", f"(({p}i * dr - {p}r * di) / nullif(dr * dr + di * di, 0))"))
    )
    return f"""{_JONES}, q AS (SELECT j.obs_id, chan_idx, xr AS rxr, xi AS rxi, ar AS rar, ai AS rai, br AS rbr, bi AS rbi, yr AS ryr, yi AS ryi FROM j WHERE tile_id < 7),
d AS (SELECT obs_id, tile_id, chan_idx, {det[0]} AS dr, {det[1]} AS di, {cells} FROM j JOIN q USING (obs_id, chan_idx)) SELECT obs_id, tile_id AS ant_idx, chan_idx, {shown} FROM d"""


@query("b8_normalise_to_ref", _normalised_sql(), "gains")
def _(gains):
    """Every row; values are shown as x / (1 + |x|), which is exact to so many digits for small and large ones alike."""
    j = _jones(gains)
    out = solutions.normalise_to_ref(j, j.where("ant_idx < 7").select("obs_id", "ant_idx").distinct())
    return out.select("obs_id", "ant_idx", "chan_idx", *[r(F.col(c) / (1 + F.abs(c)), c, 5) for p in solutions.POLS for c in (f"{p}_re", f"{p}_im")])


@query("d10_clip_report", _JONES + ", a AS (SELECT obs_id, sqrt(xr * xr + xi * xi) AS a, sqrt(ar * ar + ai * ai) AS b, sqrt(br * br + bi * bi) AS c, sqrt(yr * yr + yi * yi) AS d FROM j) SELECT obs_id, count(*) FILTER (WHERE a > 2.1) + count(*) FILTER (WHERE b > 2.1) + count(*) FILTER (WHERE c > 2.1) + count(*) FILTER (WHERE d > 2.1) AS n_samples, count(*) FILTER (WHERE greatest(a, b, c, d) > 2.1) AS n_matrices, 4 * count(*) FILTER (WHERE greatest(a, b, c, d) > 2.1) AS n_values, round(max(a), 6) AS max_xx, round(max(d), 6) AS max_yy FROM a GROUP BY obs_id", "gains")
def _(gains):
    return solutions.clip_gains(_jones(gains), 2.1)[1].select("obs_id", "n_samples", "n_matrices", "n_values", r("max_xx", "max_xx"), r("max_yy", "max_yy"))


@query("d6_fit_gains", """, y AS (SELECT obs_id, tile_id, coarse, freq_hz, CASE WHEN weight > 0 THEN 1 / sqrt(re * re + im * im) END AS y, weight AS w FROM gains),
c AS (SELECT *, freq_hz - avg(CASE WHEN y IS NOT NULL THEN freq_hz END) OVER (PARTITION BY obs_id, tile_id, coarse) AS x FROM y),
s AS (SELECT obs_id, tile_id, coarse, count(y) AS n_valid, sum(y * w) / sum(w) AS gain, sum(w * w) AS s, sum(w * w * x) AS sx, sum(w * w * y) AS sy, sum(w * w * x * x) AS sxx, sum(w * w * x * y) AS sxy FROM c WHERE y IS NOT NULL GROUP BY ALL),
f AS (SELECT *, (s * sxy - sx * sy) / (s * sxx - sx * sx) AS slope FROM s), l AS (SELECT *, (sy - slope * sx) / s AS level FROM f),
res AS (SELECT c.*, y - level - slope * x AS r, n_valid, gain, slope FROM c JOIN l USING (obs_id, tile_id, coarse)), g AS (SELECT *, stddev_pop(r) OVER (PARTITION BY obs_id, tile_id, coarse) AS sigma FROM res),
q AS (SELECT *, count(*) FILTER (WHERE r IS NOT NULL AND (sigma < 1e-10 OR abs(r) < 2 * sigma)) OVER (PARTITION BY obs_id, tile_id) / count(*) OVER (PARTITION BY obs_id, tile_id) AS q FROM g)
SELECT obs_id, tile_id, coarse, round(any_value(gain), 5) AS gain, round(any_value(sigma), 5) AS sigma_resid, any_value(n_valid) AS n_valid, round(any_value(slope) * 1e6, 4) AS slope, round(any_value(q), 6) AS quality FROM q GROUP BY obs_id, tile_id, coarse""", "gains")  # fmt: skip
def _(gains):
    out = solutions.fit_gains(gains.withColumn("pol", F.lit("XX")))
    return out.select("obs_id", "tile_id", "coarse", r("gain", "gain", 5), r("sigma_resid", "sigma_resid", 5), "n_valid", r(F.col("pol1") * 1e6, "slope", 4), r("quality", "quality"))


_FITS = ", t AS (SELECT obs_id, tile_id, 'XX' AS pol, any_value(rx) AS rx, avg(re) AS chi2dof, avg(im * im) AS sigma_resid, avg(re) * 100 AS length FROM gains GROUP BY obs_id, tile_id UNION ALL SELECT obs_id, tile_id, 'YY', any_value(rx), avg(re * re), avg(im), avg(im) * 100 FROM gains GROUP BY obs_id, tile_id)"


def _fits(gains: DataFrame) -> DataFrame:
    re, im = F.col("re"), F.col("im")
    g = gains.groupBy("obs_id", "tile_id")
    x = g.agg(F.lit("XX").alias("pol"), F.first("rx").alias("rx"), F.avg(re).alias("chi2dof"), F.avg(im * im).alias("sigma_resid"), (F.avg(re) * 100).alias("length"))
    y = g.agg(F.lit("YY").alias("pol"), F.first("rx").alias("rx"), F.avg(re * re).alias("chi2dof"), F.avg(im).alias("sigma_resid"), (F.avg(im) * 100).alias("length"))
    return x.unionByName(y)


def _outlier_sql() -> str:
    sql, last, n = _FITS + ", o0 AS (SELECT *, false AS o FROM t)", "o0", 0
    for metric in ("chi2dof", "sigma_resid"):
        for pol in ("XX", "YY"):
            n += 1
            mine = f"(CASE WHEN NOT o AND pol = '{pol}' THEN {metric} END)"
            sql += f", o{n} AS (SELECT * EXCLUDE (o), o OR coalesce({metric} >= avg{mine} OVER (PARTITION BY obs_id) + 2 * stddev_samp{mine} OVER (PARTITION BY obs_id), false) AS o FROM {last})"
            last = f"o{n}"
    return sql + f" SELECT obs_id, tile_id, pol, o AS outlier FROM {last}"


@query("e5_reject_outliers", _outlier_sql(), "gains")
def _(gains):
    return fits.reject_outliers(_fits(gains), nstd=2).select("obs_id", "tile_id", "pol", "outlier")


@query("d7_rx_lengths", _FITS + " SELECT obs_id, rx, pol, count(*) AS n, round(avg(length), 6) AS mean_length, round(quantile_cont(length, 0.25), 6) AS low_length, round(quantile_cont(length, 0.5), 6) AS median_length, round(quantile_cont(length, 0.75), 6) AS high_length FROM t GROUP BY obs_id, rx, pol", "gains")
def _(gains):
    out = fits.rx_lengths(_fits(gains).withColumn("outlier", F.lit(False)))
    return out.select("obs_id", "rx", "pol", "n", r("mean_length", "mean_length"), *[r(F.col("quartiles")[i], n) for i, n in enumerate(("low_length", "median_length", "high_length"))])


@query("b10_pivot_fits", _FITS + " SELECT x.obs_id, x.tile_id, round(x.chi2dof, 6) AS chi2dof_xx, round(y.chi2dof, 6) AS chi2dof_yy, round(x.length, 6) AS length_xx, round(y.length, 6) AS length_yy FROM t x JOIN t y ON x.obs_id = y.obs_id AND x.tile_id = y.tile_id AND x.pol = 'XX' AND y.pol = 'YY'", "gains")
def _(gains):
    f = _fits(gains)
    out = fits.pivot_phase_fits(f.select("obs_id", "tile_id", "pol", "chi2dof", "length"), f.select("obs_id", "tile_id").distinct())
    return out.select("obs_id", "tile_id", *[r(c, c) for c in ("chi2dof_xx", "chi2dof_yy", "length_xx", "length_yy")])


@query("d8_residual_spectrum", ", f AS (SELECT obs_id, tile_id, avg(re) * 100 AS length, avg(im) AS icpt FROM gains GROUP BY ALL), v AS (SELECT g.obs_id, rx, freq_hz, atan2(im, re) - (2 * pi() / 299792458.0 * length * freq_hz + icpt) AS a FROM gains g JOIN f USING (obs_id, tile_id)) SELECT obs_id, rx AS flavor, freq_hz, round(median(a + pi() - 2 * pi() * floor((a + pi()) / (2 * pi())) - pi()), 5) AS residual, count(*) AS n_tiles FROM v GROUP BY obs_id, rx, freq_hz", "gains")
def _(gains):
    f = gains.groupBy("obs_id", "tile_id").agg((F.avg("re") * 100).alias("length"), F.avg("im").alias("intercept"), F.first("rx").alias("flavor")).withColumn("pol", F.lit("XX"))
    out = fits.residual_spectrum(gains.withColumn("pol", F.lit("XX")), f)
    return out.select("obs_id", "flavor", "freq_hz", r("residual", "residual", 5), "n_tiles")


@query("e7_interpolate", """, p AS (SELECT *, chan_idx % 9 IN (4, 5) OR chan_idx < 2 AS bad FROM gains),
n AS (SELECT *, max(CASE WHEN NOT bad THEN chan_idx END) OVER w AS x0, min(CASE WHEN NOT bad THEN chan_idx END) OVER u AS x1 FROM p WINDOW w AS (PARTITION BY tile_id ORDER BY chan_idx), u AS (PARTITION BY tile_id ORDER BY chan_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT n.tile_id, n.chan_idx, round(CASE WHEN NOT n.bad THEN n.re ELSE coalesce(a.re + (b.re - a.re) * (n.chan_idx - x0) / (x1 - x0), a.re, b.re) END, 6) AS re FROM n LEFT JOIN gains a ON a.tile_id = n.tile_id AND a.chan_idx = x0 LEFT JOIN gains b ON b.tile_id = n.tile_id AND b.chan_idx = x1""", "gains")  # fmt: skip
def _(gains):
    return fits.interpolate_gains(gains.withColumn("bad", F.expr("chan_idx % 9 IN (4, 5) OR chan_idx < 2")), ["re"]).select("tile_id", "chan_idx", r("re", "re"))


@query("b12_pad_channels", "SELECT obs_id, tile_id, array_to_string(list_transform([-1, 0, 1, 2, 3], lambda c: CASE WHEN c < 0 OR c = tile_id % 4 THEN 'none' ELSE CAST(c AS VARCHAR) END), ',') AS chans FROM (SELECT DISTINCT obs_id, tile_id FROM gains)", "gains")
def _(gains):
    gains = gains.withColumn("coarse", F.expr("CASE WHEN coarse = tile_id % 4 THEN 99 ELSE coarse END"))
    have = gains.select("obs_id", "tile_id", F.lit("XX").alias("pol"), "coarse", F.col("coarse").alias("chans")).distinct()
    expected = gains.select("obs_id", F.explode(F.array(*[F.lit(x) for x in (-1, 0, 1, 2, 3)])).alias("rec_chan")).distinct()
    return solutions.pad_channels(have, expected, ["chans"]).select("obs_id", "tile_id", F.array_join("chans", ",", "none").alias("chans"))


@query("e8_fit_phase", None, "gains")
def _(gains):
    return fits.fit_phase(gains.withColumn("pol", F.lit("XX")))


@query("e6_flag_bad_gains", None, "gains")
def _(gains):
    rows = gains.select("obs_id", "tile_id", "chan_idx", F.col("re").alias("xx_re"), F.col("im").alias("xx_im"), F.col("im").alias("yy_re"), F.col("re").alias("yy_im"), (F.col("weight") == 0).alias("base_bad"))
    return fits.flag_bad_gains(rows)


@query("flagship_solutions", None, "gains", "tiles")
def _(gains, tiles):
    """Weights, phase and gain fits, padding and assembly: one wide row for each tile."""
    g = gains.withColumn("pol", F.lit("XX")).unionByName(gains.withColumn("pol", F.lit("YY")).withColumns({"re": F.col("im"), "im": F.col("re")}))
    expected = gains.select("obs_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("rec_chan")).distinct()
    gain = solutions.pad_channels(solutions.fit_gains(g), expected, ["gain", "pol0", "pol1", "sigma_resid", "quality"]).withColumnRenamed("gain", "gains").withColumn("quality", F.array_max("quality"))
    header = requests.fit_header(tiles, fit_time="2024-01-01 00:00:00", creator="batch", code_version="1", niter=1, limit=20)
    return fits.assemble_solutions(tiles, gain, fits.fit_phase(g), header, 4)


# telemetry and transfers
@query("g3_worker_health", "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, host, worker, max(queue_size) AS max_queue, round(avg(queue_size), 6) AS mean_queue, count(*) AS n FROM health GROUP BY ALL", "health")
def _(rows):
    return streams.worker_health(rows).withColumn("mean_queue", F.round("mean_queue", 6))


@query("d12_transfer_stats", "SELECT destination, count(*) AS n, count(*) FILTER (WHERE NOT ok) AS n_failed, round(sum(bytes / 1e9), 4) AS gb, round(sum(bytes / 1e9) / 1.07374, 4) AS gib, round(avg(CASE WHEN elapsed_sec > 0 THEN 8 * bytes / 1e9 / elapsed_sec ELSE 0 END), 4) AS mean_gbps FROM transfers GROUP BY destination", "transfers")
def _(rows):
    return sources.transfer_stats(rows).select("destination", "n", "n_failed", r("gb", "gb", 4), r("gib", "gib", 4), r("mean_gbps", "mean_gbps", 4))


@query("s8_gps_unix", "SELECT obs_id, CAST(obs_id + 315964800 - 18 AS BIGINT) AS unix_s, CAST(obs_id AS BIGINT) AS back FROM observations", "observations")
def _(obs):
    return obs.select("obs_id", exprs.gps_to_unix(F.col("obs_id")).cast("bigint").alias("unix_s"), exprs.unix_to_gps(exprs.gps_to_unix(F.col("obs_id"))).cast("bigint").alias("back"))


# further queries by area, registered as they are imported
from . import catalog_queries, lifecycle_queries, request_queries, solution_queries  # noqa: E402, F401
