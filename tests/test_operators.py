"""Semantics on small tables: golden values and edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.functions import exprs
from skyledger.operators import catalog, fits, ledger, requests, retry, solutions
from skyledger.sources import files as sources
from skyledger.streaming import streams

OBS = "obs_id bigint, project_id string, calibrator boolean, calibrator_source string"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_validation_and_priority(spark):
    obs = spark.createDataFrame([(1244973688, "C001", False, ""), (1347318488, "D0006", True, "HydA"), (1347318496, "G1", True, "SUN")], OBS)
    names = ["1244973688_20190619100110_ch114_000.fits", "1347318488_20190619100110_ch114_000.fits", "1347318496_20190619100110_ch114_000.fits", "1244973688_1244973688_109.sub",
             "1244973688_metafits_ppds.fits", "1244973688_flags.zip", "x.fits", "1244973688.txt", "1244973688_1.sub", "1999999999.metafits"]
    listing = spark.createDataFrame([("/d/" + n,) for n in names], "path string")
    out = catalog.with_priority(catalog.validate_files(listing, obs), ["D0006"], ["C001"])
    got = {r.path[3:]: (r.filetype_id, r.calibrator, r.priority, r.message) for r in out.collect()}
    assert got[names[0]] == (18, False, 30, "")
    assert got[names[1]] == (18, True, 2, "")
    assert got[names[2]][1] is False and got[names[2]][2] == 30
    assert got[names[3]][2] == 20 and got[names[4]][2] == 1 and got[names[5]][2] == 100
    assert [got[n][3] for n in names[6:]] == ["name does not begin with an observation id", "unknown extension", "name has a wrong length for its type", "observation not found"]
    assert all(got[n][2] is None for n in names[6:])
    routed = catalog.route_ingest(out.where("valid"), True)
    assert {r.route for r in routed.where("filetype_id = 18").collect()} == {"processing_stats"}
    assert {r.route for r in catalog.route_ingest(out.where("filetype_id = 17 AND valid"), False).collect()} == {"dont_archive"}


def test_names(spark):
    df = lambda *x: spark.createDataFrame([(v,) for v in x], "path string")
    got = catalog.parse_names(df("/t/1234567890_1234567898_ch123_beam00.fil"), "beam").first()
    assert got.stitched == "/t/1234567890_ch123_beam00.fil" and got.beam == 0
    s = catalog.parse_names(df("1234567890_solutions.fits", "1234567890_ch57_solutions.fits", "1234567890_ch109-120_solutions.fits", "x.txt"), "solution")
    assert [(r.all_chans, r.chan_from, r.chan_to) for r in s.orderBy("chan_from", "path").collect()][:2] == [(True, None, None), (False, None, None)]
    assert catalog.parse_names(df("https://h/a/b.tar?x=1"), "url").first().basename == "b.tar"
    assert catalog.parse_names(df("user@host1:/d/f"), "host").first().host == "host1"
    d = catalog.with_description(spark.createDataFrame([("1_ch100_stats.txt",), ("zzz",)], "filename string")).orderBy("filename").collect()
    assert d[0].description.endswith("for receiver channel 100 (128.000 MHz)") and d[1].description == "Miscellaneous file"


def test_output_estimate_and_tool_output(spark):
    o = spark.createDataFrame([(1, 120_000, 2000, 1_280_000, 10_000, 24, 8256, 4)], "obs_id int, sched_duration_ms long, int_time_ms long, coarse_chan_width_hz long, fine_chan_width_hz long, num_coarse long, num_baselines long, num_pols long")
    assert catalog.estimate_output(o, 40_000, 2000).first().bytes == 60 * 8256 * 24 * 32 * 4 * 13
    t = spark.createDataFrame([(0, "Submitted 1 as ABC job ID 123"), (1, "Job already queued, processing or complete. Job Id: 1234567"), (2, '{"error_code": 2}'), (3, "an outage"), (4, "?")], "i int, text string")
    assert [(r.outcome, r.number) for r in catalog.classify_tool_output(t, "ABC").orderBy("i").collect()] == [("new_job", 123), ("existing_job", 1234567), ("error_code", 2), ("outage", None), ("transient", None)]


def test_subfiles(spark):
    h = spark.createDataFrame([(100, "X_CORRELATOR"), (108, "X_VCS"), (116, "X_CORR_BF"), (124, "NO_CAPTURE"), (132, "odd")], "subobs_id long, mode string")
    d = spark.createDataFrame([(100, 108)], "start_gps long, end_gps long")
    got = lambda host: [r.action for r in catalog.dispatch_subfiles(h, host, d, mode_prefix="X_").orderBy("subobs_id").collect()]
    assert got("C") == ["dump", "process", "process", "drain", "ignore"]
    assert got("B") == ["dump", "ignore", "ignore", "drain", "ignore"]
    s = spark.createDataFrame([(f"/s/{i}", 1000 + 8 * i, "X_CORRELATOR", None) for i in range(6)], "path string, subobs_id long, mode string, trigger_id long")
    q = spark.createDataFrame([(1, 1000, 1032, 7)], "request_id long, start_gps long, end_gps long, trigger_id long")
    assert rows(requests.select_dump(s, q, mode_prefix="X_"), "subobs_id") == [(1, f"/s/{i}", 1000 + 8 * i, 7) for i in (2, 3, 4)]


def test_ledger(spark):
    led = spark.createDataFrame([(1, "a", 5, "m"), (1, "b", 5, "m"), (1, "b", 5, "m"), (1, "c", 5, "m")], "observation_num long, filename string, size long, checksum string")
    disk = spark.createDataFrame([(1, "a", 5, "m"), (1, "b", 5, "m"), (1, "c", 5, "x"), (1, "d", 5, "m"), (1, "e", 0, "m"), (1, "f", 0, "m")], "obs_id long, filename string, size long, checksum string")
    more = led.union(spark.createDataFrame([(1, "f", 5, "m")], led.schema))
    assert [r.decision for r in ledger.verify_archive(disk, more).orderBy("filename").collect()] == ["archive", "error", "retry", "error", "error", "drop"]
    full = led.select("*", F.lit(False).alias("remote_archived"), *[F.lit(None).cast(t).alias(c) for c, t in (("location", "int"), ("bucket", "string"), ("folder", "string"))])
    up = spark.createDataFrame([(1, "a", 2, "x", None), (1, "b", 2, "x", None), (1, "z", 2, "x", None)], "observation_num long, filename string, location int, bucket string, folder string")
    out, bad = ledger.mark_archived(full, up)
    assert out.count() == 4 and [r.filename for r in out.where("remote_archived").collect()] == ["a"]
    assert {(r.filename, r.n_rows) for r in bad.collect()} == {("b", 2), ("z", 0)}


def test_retry_and_backlog(spark):
    b = spark.createDataFrame([(1, "p1/f3"), (1, "p1/f1"), (1, "p2/f2")], "priority int, path string")
    assert [r.path for r in retry.rank_backlog(b).collect()] == ["p1/f1", "p2/f2", "p1/f3"]
    a = spark.createDataFrame([("x", i, i, ok, 1) for i, ok in enumerate([False, True, False, False])] + [("y", 0, 9, True, 2)], "item string, ts int, event_id int, success boolean, priority int")
    a = a.withColumn("ts", F.timestamp_seconds("ts"))
    assert rows(retry.retry_state(a).select("item", "failures", "backoff_sec", "priority"), "item") == [("x", 2, 4.0, 3), ("y", 0, 0.0, 2)]
    assert rows(retry.retry_state(a, policy="exp", initial=10, limit=3600).select("failures", "backoff_sec"), "failures") == [(0, 0.0), (2, 20.0)]
    assert retry.retry_state(a.where("false")).count() == 0


def test_requests(spark):
    body = '{"1": {"jobId": 1, "obsid": 9, "jobState": "Ready", "files": [{"fileUrl": "u"}]}, "2": {"jobId": 2, "obsid": 8, "jobState": {"Error": "no"}}, "3": {"jobId": 3, "obsid": 7, "jobState": {"Odd": 1}}}'
    got = requests.parse_snapshot(spark.createDataFrame([(0, body)], "snapshot_ts int, body string"))
    assert rows(got.select("job_id", "state", "url", "valid"), "job_id") == [(1, "Ready", "u", True), (2, "Error", None, True), (3, "Odd", None, False)]
    files = spark.createDataFrame([("b_all",), ("a_lo",)], "path string")
    files = spark.createDataFrame([(1, "ch", False, 100, 110), (1, "all", True, None, None), (2, "ch2", False, 5, 6)], "obs_id long, path string, all_chans boolean, chan_from int, chan_to int")
    asked = spark.createDataFrame([(1, 105), (2, 6), (2, 7)], "cal_obs long, rec_chan int")
    assert rows(requests.solution_for_channel(asked, files), "cal_obs", "rec_chan") == [(1, 105, "all"), (2, 6, "ch2"), (2, 7, None)]
    ev = spark.createDataFrame([(1, "download", {"completed_datetime": "t"}), (2, "download", {"completed_datetime": "t", "error_message": "m"}), (3, "calibration", {"completed_datetime": "t"}), (4, "calibration", {"error_datetime": "t", "error_message": "m"})], "event_id int, kind string, payload map<string,string>")
    assert [r.accepted for r in requests.validate_events(ev).orderBy("event_id").collect()] == [True, False, False, True]
    fold = spark.createDataFrame([(1, 1, [5], {"job": "a"}, ["job"]), (2, 2, [5], {}, ["job"]), (3, 3, [5], {"err": "x"}, ["err"])], "event_id int, ts int, request_ids array<long>, payload map<string,string>, touches array<string>")
    assert rows(requests.fold_requests(fold, ["job", "err"])) == [(5, None, "x")]
    assert rows(requests.check_touched(fold, spark.createDataFrame([(6,)], "id long")), "event_id")[0] == (1, 1, 0)


def test_select_dump_modes(spark):
    subfiles = spark.createDataFrame([("a", 8, "X_VCS"), ("b", 16, "X_VCS"), ("c", 24, "X_CORRELATOR"), ("d", 32, None), ("e", 40, "X_VCS")], "path string, subobs_id long, mode string").withColumn("trigger_id", F.lit(None).cast("long"))
    dumps = spark.createDataFrame([(1, 0, 100, 7)], "request_id long, start_gps long, end_gps long, trigger_id long")
    assert rows(requests.select_dump(subfiles, dumps, mode_prefix="X_").select("path", "trigger_id"), "path") == [("c", 7), ("d", 7)]
    assert rows(requests.select_dump(subfiles.where("path >= 'b'"), dumps, mode_prefix="X_").select("path"), "path") == [("d",)]


def test_fold_by_compute_job(spark):
    data = [
        (1, 1, "submit_compute", [5, 6], None, {"job_id": "70", "submitted_datetime": "t1"}),
        (2, 2, "assign", None, 70, {"hostname": "h", "started_datetime": "t2"}),
        (3, 3, "calibration", [], 70, {"error_datetime": "t3", "error_message": "m"}),
        (4, 4, "submit_compute", [6], 71, {"submitted_datetime": "t4"}),
        (5, 5, "calibration_started", None, 71, {"started_datetime": "t5"}),
        (6, 6, "calibration", None, 71, {"completed_datetime": "t6", "fit_id": "9"}),
        (7, 7, "calibration_started", None, 70, {"started_datetime": "t7"}),  # 6 has left job 70 by then
        (8, 8, "calibration", None, 99, {"completed_datetime": "t8", "fit_id": "1"}),
        (9, 9, "submit_download", [7], None, {"job_id": "3", "submitted_datetime": "t9"}),
    ]
    events = spark.createDataFrame(data, "event_id int, ts int, kind string, request_ids array<long>, slurm_job_id long, payload map<string,string>")
    got = {r.id: r.asDict() for r in requests.fold_requests(events).collect()}
    set_ = {i: {k: v for k, v in r.items() if v is not None and k != "id"} for i, r in got.items()}
    start = {"assigned_hostname": "h", "assigned_datetime": "t2", "download_started_datetime": "t2"}
    assert set_[5] == start | {"slurm_job_id": "70", "download_slurm_job_submitted_datetime": "t1", "download_completed_datetime": "t7", "calibration_started_datetime": "t7"}
    assert set_[6] == start | {
        "slurm_job_id": "71", "download_slurm_job_submitted_datetime": "t4", "download_completed_datetime": "t5", "calibration_started_datetime": "t5", "calibration_completed_datetime": "t6", "calibration_fit_id": "9",
    }
    assert set_[7] == {"download_job_id": "3", "download_job_submitted_datetime": "t9"}
    assert set(got[5]) == {"id", *requests.FIELDS}
    assert rows(requests.check_touched(events, spark.createDataFrame([(5,), (6,)], "id long")), "event_id") == [(8, None, 0), (9, 1, 0)]
    queue = spark.createDataFrame([("dl_1",), ("dl_2",), ("rt_dl",), (None,)], "name string")
    assert requests.name_prefix_count(queue, "dl").first().n_jobs == 2
    cols = ", ".join(f"{p}_{x} double" for p in solutions.POLS for x in ("re", "im"))
    g = spark.createDataFrame([(1, t, 0, c, *[float(3 * t + c)] * 2, *[float("nan")] * 2, *[1.0, 0.0] * 2) for t in range(2) for c in range(2)], f"obs_id long, time_idx int, ant_idx int, chan_idx int, {cols}")
    top = rows(solutions.max_amplitudes(g), "chan_idx")
    assert [(r[0], r[1], r[2], r[4], r[5], r[6]) for r in top] == [(1, 0, c, None, 1.0, 1.0) for c in range(2)] and [r[3] for r in top] == pytest.approx([3 * 2**0.5, 4 * 2**0.5])


def test_weights_and_gain_fits(spark):
    b = spark.createDataFrame([(1, "a", i, v) for i, v in enumerate([1e-5, 2e-5, 3e-5, -1.0, float("nan")])] + [(2, "a", 0, None)], "obs_id long, band string, chan_idx int, result double")
    w = [r.weight for r in solutions.conv_weights(b).orderBy("obs_id", "chan_idx").collect()]
    assert w[0] == pytest.approx(1) and w[2:5] == [0, 0, 0] and w[5] == 1
    g = [(1, 1, "XX", 0, 100 + i, a, 0.0, wt) for i, (a, wt) in enumerate(zip([1.0, 2.0, 4.0, 8.0], [1.0, 2.0, 1.0, 2.0], strict=True))]
    g += [(1, 1, "XX", 1, 200 + i, float("nan"), 0.0, 1.0) for i in range(4)]
    out = solutions.fit_gains(spark.createDataFrame(g, "obs_id long, tile_id int, pol string, coarse int, freq_hz long, re double, im double, weight double")).orderBy("coarse").collect()
    assert out[0].gain == pytest.approx(2.5 / 6) and out[1].gain is None and out[0].quality <= 0.5
    x, y, wt = np.arange(4) + 100.0, 1 / np.array([1, 2, 4, 8.0]), np.array([1, 2, 1, 2.0])
    assert [out[0].pol1, out[0].pol0] == pytest.approx(np.polyfit(x, y, 1, w=wt), rel=1e-6)


def test_jones_clip_and_flags(spark):
    rng = np.random.default_rng(1)
    cols = [f"{p}_{x}" for p in solutions.POLS for x in ("re", "im")]
    data = [(1, 0, a, c, *map(float, rng.normal(size=8))) for a in range(3) for c in range(2)]
    g = spark.createDataFrame(data, "obs_id long, time_idx int, ant_idx int, chan_idx int, " + ", ".join(f"{c} double" for c in cols))
    out = {(r.ant_idx, r.chan_idx): r for r in solutions.normalise_to_ref(g, spark.createDataFrame([(1, 1)], "obs_id long, ant_idx int")).collect()}
    m = lambda v: (np.array(v[0::2]) + 1j * np.array(v[1::2])).reshape(2, 2)
    for _, _, a, c, *v in data:
        ref = next(x[4:] for x in data if x[2] == 1 and x[3] == c)
        assert np.allclose(m([out[a, c][k] for k in cols]), m(v) @ np.linalg.inv(m(ref)))
    big = g.withColumn("xx_re", F.when((F.col("ant_idx") == 0) & (F.col("chan_idx") == 0), 200.0).otherwise(F.lit(1.0))).withColumn("xx_im", F.lit(0.0))
    clipped, report = solutions.clip_gains(big, 100.0)
    assert clipped.where("yy_re IS NULL").count() == 1 and report.first().n_values == 4
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    base = spark.createDataFrame([(1, k, float("nan") if p == (1, 2) else 1.0) for k, p in enumerate((i, j) for i in range(4) for j in range(i + 1, 4))], "obs_id long, baseline_idx int, weight double")
    assert len(pairs) == 10 and [r.flag for r in solutions.tile_flags(base, 4).orderBy("ant_idx").collect()] == [False, True, True, False]


@pytest.mark.parametrize("length, intercept", [(10, 0.5), (5, 0.0), (0, 0.3), (-8, 0.7)])
def test_phase_ramp(length, intercept):
    f = np.linspace(140e6, 170e6, 100)
    z = np.exp(1j * (2 * np.pi * length / exprs.C_LIGHT * f + intercept))
    got = fits.fit_ramp(f, z, np.ones(100))
    assert got["length"] == pytest.approx(length, abs=1e-6) and got["intercept"] == pytest.approx(intercept, abs=1e-6) and got["quality"] == 1
    assert fits.fit_ramp(f, z * np.nan, np.ones(100)) is None and fits.fit_ramp(f, z, np.zeros(100)) is None
    with pytest.raises(ValueError):
        fits.fit_ramp(f, z, np.ones(100), niter=0)


def test_outliers_and_interpolation(spark):
    v = [9.0] * 9 + [1000.0]
    f = spark.createDataFrame([(1, i, "XX", x, 0.0) for i, x in enumerate(v)], "obs_id long, tile_id int, pol string, chi2dof double, sigma_resid double")
    assert [r.tile_id for r in fits.reject_outliers(f, ("chi2dof",), 1).where("outlier").collect()] == [9]
    assert fits.reject_outliers(f, nstd=0).where("outlier").count() == 0
    g = spark.createDataFrame([(1, 1, c, float(c * c), c in (2, 3, 5)) for c in range(6)], "obs_id long, tile_id int, chan_idx int, x double, bad boolean")
    assert [round(r.x, 6) for r in fits.interpolate_gains(g, ["x"]).orderBy("chan_idx").collect()] == [0, 1, 6, 11, 16, 16]
    a = spark.createDataFrame([(1, i, x, True) for i, x in enumerate([1.0, 1.1, 1.0, 1.1, 9.0, 1.0, 1.1, 1.0])], "g int, c int, a double, ok boolean")
    assert [r.c for r in fits.reject_by_polynomial(a, ("g",), "c", ("a",), "ok").where("NOT kept_a").collect()] == [4]


def test_padding_ranges_and_refant(spark):
    fit = spark.createDataFrame([(1, 1, "XX", c, float(c)) for c in (100, 101, 102, 200)], "obs_id long, tile_id int, pol string, coarse int, gain double")
    want = spark.createDataFrame([(1, c) for c in (100, 101, 102, 103)], "obs_id long, rec_chan int")
    assert solutions.pad_channels(fit, want, ["gain"]).first().gain == [100.0, 101.0, 102.0, None]
    assert [(r.chan_from, r.chan_to) for r in solutions.coarse_ranges(fit.select("obs_id", F.col("coarse").alias("rec_chan"))).orderBy("range_idx").collect()] == [(100, 102), (200, 200)]
    t = spark.createDataFrame([(1, 3, "c", False), (1, 1, "a", True), (1, 2, "b", False), (2, 1, "a", True)], "obs_id long, tile_id int, name string, flag boolean")
    assert rows(solutions.refant(t), "obs_id") == [(1, 2, "b"), (2, None, None)]


def test_files(spark, tmp_path):
    import hashlib

    body = b"MODE CORRELATOR\nOBS_ID 5\nMODE SECOND\nBAD LINE HERE\n" + b"\0" * 5000
    (tmp_path / "a.sub").write_bytes(body)
    (tmp_path / "b.sub.free").write_bytes(b"x")
    content = spark.read.format("binaryFile").load(str(tmp_path))
    assert [r.path.rsplit("/")[-1] for r in sources.list_files(spark, str(tmp_path), ".sub").collect()] == ["a.sub"]
    h = sources.subfile_headers(content.where("path LIKE '%.sub'"), ["MODE", "OBS_ID", "NONE"]).first()
    assert (h.mode, h.obs_id, h.none) == ("CORRELATOR", "5", None)
    want = '"' + hashlib.md5(b"".join(hashlib.md5(body[i : i + 2048]).digest() for i in range(0, len(body), 2048))).hexdigest() + '-3"'
    more = spark.createDataFrame([("a", bytearray(body)), ("b", bytearray(b"x")), ("c", bytearray())], "path string, content binary")
    assert [r.etag for r in sources.etag_manifest(more, 2048).orderBy("path").collect()] == [want, f'"{hashlib.md5(b"x").hexdigest()}"', '""']
    assert [r.checksum for r in sources.md5_manifest(more).orderBy("path").collect()][0] == hashlib.md5(body).hexdigest()


def test_streams_equal_batches(spark, tmp_path):
    obs = spark.createDataFrame([(1234567890, 24)], "obs_id long, exposure_sec int")
    names = [(f"/d/1234567890_{1234567890 + 8 * i}_ch123_beam00.fil",) for i in (0, 1, 2)] + [("/d/bad.fil",)]
    files = spark.createDataFrame(names, "path string")
    batch = streams.stitch_plan(files, obs).collect()
    assert len(batch) == 1 and batch[0].n_present == 3 and batch[0].n_expected == 3
    for i in range(4):
        files.where(F.col("path") == names[i][0]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema("path string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = streams.stitch_stream(feed, obs).writeStream.format("memory").queryName("stitched").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    last = spark.table("stitched").collect()
    assert len(last) >= 1 and last[0].obs_id == 1234567890
    packets = spark.createDataFrame([("2024-01-01 00:00:01", '{"main": {"hostname": "h"}, "workers": [{"name": "w", "queue_size": 3}]}'), ("2024-01-01 00:00:02", "junk")], "ts string, value string").withColumn("ts", F.to_timestamp("ts"))
    health = streams.worker_health(streams.health_rows(packets)).first()
    assert (health.host, health.max_queue) == ("h", 3)
    assert streams.missing_hosts(streams.health_rows(packets), "2024-01-01 01:00:00", 60).count() == 1


def test_stitch_stream_out_of_order(spark, tmp_path):
    import time

    start = 1234567890
    obs = spark.createDataFrame([(start, 24), (start + 800, 16)], "obs_id long, exposure_sec int")
    name = lambda o, i, beam: f"/d/{o}_{o + 8 * i}_ch123_beam{beam:02d}.fil"
    # beam 0 gets its second file after its last one, beam 1 is in order, beam 2 never ends
    names = [name(start, 0, 0), name(start, 2, 0), name(start, 0, 1), "/d/bad.fil", name(start, 1, 1), name(start, 1, 0), name(start + 8000, 0, 0), name(start, 2, 1), name(start, 0, 2)]
    (tmp_path / "in").mkdir()
    feed = spark.readStream.schema("path string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    put = lambda n: spark.createDataFrame([(n,)], "path string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put(names[0])
    q = streams.stitch_stream(feed, obs, keep_sec=8, delay="0 seconds").writeStream.format("memory").queryName("out_of_order").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    for n in names[1:]:
        q.processAllAvailable()
        put(n)
    q.processAllAvailable()
    got = spark.table("out_of_order").collect()
    files = spark.createDataFrame([(n,) for n in names], "path string")
    batch = {r.beam: r for r in streams.stitch_plan(files, obs).collect()}
    assert sorted(batch) == [0, 1] and {r.beam: r for r in got if r.beam == 1} == {1: batch[1]}
    assert batch[1].output == f"/d/{start}_ch123_beam01.fil" and batch[1].missing == []
    plan, late = (r for r in got if r.beam == 0)
    assert (plan.kind, plan.n_present, plan.missing, late.kind, late.missing) == ("plan", 2, [start + 8], "late", [])
    assert sorted(plan.files + late.files) == batch[0].files
    assert dict(rows(streams.stitch_rejects(files, obs))) == {"/d/bad.fil": "not a name of a beam's file", names[6]: "observation or its exposure not found"}
    for _ in range(2):  # the watermark moves with arrivals, and counts from the next batch on
        time.sleep(9)
        put(name(start + 800, 0, 5))
        q.processAllAvailable()
    q.stop()
    more = spark.table("out_of_order").where("kind = 'expired'").collect()
    assert [(r.beam, r.n_present, r.files, r.missing) for r in more if r.beam == 2] == [(2, 1, [names[8]], [start + 8, start + 16])]


def test_angles(spark):
    got = spark.range(1).select(exprs.wrap_angle(F.lit(math.pi)).alias("a"), exprs.wrap_angle(F.lit(-7.0)).alias("b")).first()
    assert got.a == pytest.approx(-math.pi) and got.b == pytest.approx(-7 + 2 * math.pi)
