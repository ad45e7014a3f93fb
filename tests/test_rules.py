"""Rules of fits, flags, files and streams: golden values made by plain numpy or Python, and streams against their batch forms."""

import hashlib
import math
import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.functions import exprs
from skyledger.operators import catalog, fits, requests, retry, solutions
from skyledger.plans import queries as plans
from skyledger.plans.standins import view
from skyledger.sources import files as sources
from skyledger.streaming import streams

SF = os.environ.get("SKYLEDGER_SF", "/root/testdata/sf0.001")


def clipped(amplitudes, initial, degree, threshold):
    """The rule in plain numpy: every round judges all points that were valid at the start."""
    place, valid, residual = np.arange(len(amplitudes)), initial, np.full(len(amplitudes), np.nan)
    for _ in range(10):
        if valid.sum() < degree + 2:
            break
        r = amplitudes - np.polyval(np.polyfit(place[valid], amplitudes[valid], degree), place)
        middle = np.median(r[valid])
        mad = np.median(np.abs(r[valid] - middle))
        if mad == 0:
            return valid, np.zeros(len(amplitudes))
        residual = np.abs(r - middle) / mad
        now = initial & (residual <= threshold)
        if now.sum() < degree + 2 or (now == valid).all():
            break
        valid = now
    return valid, residual


def test_rejected_points_may_return(spark):
    rng = np.random.default_rng(5)
    groups = []
    for _ in range(300):
        n = int(rng.integers(3, 40))
        a = 1 + 0.05 * rng.normal(size=n)
        a[rng.integers(0, n, n // 6)] += rng.normal(scale=3, size=n // 6)
        groups.append((a, rng.random(n) > 0.1))
    groups += [(np.zeros(9), np.arange(9) > 1), (np.ones(3), np.ones(3, bool)), (np.full(12, 0.1), np.ones(12, bool)), (np.array([1, 1.1, 1, 1.1, 9, 1, 1.1, 1]), np.ones(8, bool))]
    rows = [(g, c, float(v), bool(ok), float(-v)) for g, (a, good) in enumerate(groups) for c, (v, ok) in enumerate(zip(a, good, strict=True))]
    df = spark.createDataFrame(rows, "g int, c int, a double, ok boolean, b double")
    found = defaultdict(dict)
    for r in fits.reject_by_polynomial(df, ("g",), "c", ("a", "b"), "ok", 2, 2.9).collect():
        found[r.g][r.c] = r
    # 2.9, as five even points may make ratios of 3 exactly; numpy's own rounding decides for equal values
    for g, (a, good) in enumerate(groups[:302]):
        want, residual = clipped(a, good, 2, 2.9)
        got = [found[g][c] for c in range(len(a))]
        for v in ("a", "b"):
            assert [r[f"kept_{v}"] for r in got] == want.tolist()
            assert np.allclose([math.nan if r[f"residual_{v}"] is None else r[f"residual_{v}"] for r in got], residual, rtol=1e-6, atol=1e-6, equal_nan=True)
    assert not found[303][4].kept_a and all(r.residual_a == 0 for r in found[302].values())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_bad_gains_of_all_rows(spark):
    """The registered query against plain numpy, every row of its table."""
    gains = view(spark, SF, "gains").toPandas()
    want = {}
    for (obs, tile), g in gains.sort_values("chan_idx").groupby(["obs_id", "tile_id"]):
        base, amp = (g["weight"] == 0).to_numpy(), np.hypot(g["re"], g["im"]).to_numpy()
        kept, residual = clipped(amp, ~base, 2, 5.0)
        for c, b, k, r in zip(g["chan_idx"], base, kept, residual, strict=True):
            want[obs, tile, c] = (bool(b or not k), bool(not b and not k), r)
    got = plans.QUERIES["e6_flag_bad_gains"](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        bad, new, residual = want[r.obs_id, r.tile_id, r.chan_idx]
        assert (r.bad, r.new_flag) == (bad, new) and r.residual == pytest.approx(residual, rel=1e-6, abs=1e-9)


def test_bad_gains(spark):
    rows = [(1, 1, c, *[1.0 + 0.01 * (c % 3) + (5.0 if c == 7 else 0.0), 0.0] * 4) for c in range(12)] + [(1, 2, c, *[1.0, 0.0] * 4) for c in range(12)]
    rows[3] = (*rows[3][:6], float("nan"), *rows[3][7:])
    cells = ", ".join(f"{p}_{x} double" for p in solutions.POLS for x in ("re", "im"))
    gains = spark.createDataFrame(rows, f"obs_id long, tile_id int, chan_idx int, {cells}")
    blocks = spark.createDataFrame([(1, c, float("nan") if c == 5 else 1e-5) for c in range(12)], "obs_id long, chan_idx int, result double")
    flags = spark.createDataFrame([(1, 1, False), (1, 2, True)], "obs_id long, tile_id int, flag boolean")
    out = fits.flag_bad_gains(fits.base_flags(gains, blocks, flags)).collect()
    assert {r.chan_idx for r in out if r.tile_id == 1 and r.bad} == {3, 5, 7} and {r.chan_idx for r in out if r.new_flag} == {7}
    assert all(r.bad and not r.new_flag for r in out if r.tile_id == 2)


def test_phase_quality_counts_all_frequencies():
    f = np.linspace(140e6, 170e6, 100)
    z = np.exp(1j * (2 * np.pi * 5 / exprs.C_LIGHT * f + 0.5))
    half = np.arange(100) % 2
    assert fits.fit_ramp(f, z, half.astype(float))["quality"] == 0.5
    assert fits.fit_ramp(f, np.where(half == 1, z, np.nan), np.ones(100))["quality"] == 0.5
    noisy = z.copy()
    noisy[10] *= np.exp(1.5j)
    assert fits.fit_ramp(f, noisy, np.ones(100))["quality"] == 0.99


def test_polynomials_and_text(spark):
    assert fits.polynomial_text([0.5, -12.0, 1e-5]) == "+1e-05 -12.0×x +0.5×x²"
    assert fits.polynomial_text([1234.5] + [0.0] * 10, "ν").endswith("+1.23e+03×ν¹⁰")
    f = np.linspace(80e6, 200e6, 40)
    rows = [(1, "A", "XX", int(x), float(2 + 0.01 * x / 1e6)) for x in f] + [(1, "B", "XX", int(x), float(1 + 30 / (x / 1e6))) for x in f] + [(1, "C", "XX", 100, 1.0)]
    got = {r.flavor: r for r in fits.residual_poly(spark.createDataFrame(rows, "obs_id long, flavor string, pol string, freq_hz long, residual double")).collect()}
    assert got["A"].variable == "f" and got["B"].variable == "1/f" and got["C"].coeffs is None
    for name, x in (("A", f / 1e6), ("B", 1e6 / f)):
        want = [r[4] for r in rows if r[1] == name]
        assert np.allclose(np.polyval(got[name].coeffs, x), want, atol=1e-6) and got[name].text.startswith("+")


def test_nearest_phase_over_bins(spark):
    gains = spark.createDataFrame([(1, 1, f, 1.0, 0.0) for f in (5, 50, 99, 101, 460, 990)], "obs_id long, tile_id int, freq_hz long, re double, im double")
    tiles = spark.createDataFrame([(1, 1, "A-NI")], "obs_id long, tile_id int, flavor string")
    table = [(95, 0.1), (105, 0.2), (400, 0.3), (520, 0.4)]
    diffs = spark.createDataFrame(table, "freq_hz long, diff_rad double")
    for width in (10, 100, 10_000):
        for r in fits.apply_phase_diff(gains, tiles, diffs, bin_hz=width).collect():
            d = min(table, key=lambda t: (abs(t[0] - r.freq_hz), t[0]))[1]
            assert (r.re, r.im) == pytest.approx((math.cos(d), -math.sin(d)))
    assert fits.apply_phase_diff(gains, tiles, diffs.where("false")).where("re = 1 AND im = 0").count() == 6


def test_reference_tile_and_report(spark, tmp_path):
    t = spark.createDataFrame([(1, 3, "c", False), (2, 1, "a", True)], "obs_id long, tile_id int, name string, flag boolean")
    assert solutions.refant(t.where("obs_id = 1"), strict=True).first().tile_id == 3
    with pytest.raises(Exception, match="no unflagged tile"):
        solutions.refant(t, strict=True).collect()
    fit = spark.createDataFrame([(1, 3, "XX", 1.0), (1, 3, "YY", 2.0)], "obs_id long, tile_id int, pol string, length double")
    sources.write_tsv(fits.pivot_phase_fits(fit, t), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "obs_id\ttile_id\tname\tflag\tlength_xx\tlength_yy\n1\t3\tc\tfalse\t1.0\t2.0\n"


def test_files_by_stream(spark, tmp_path):
    body = b"MODE CORRELATOR\nOBS_ID 5\n" + bytes(range(256)) * 40
    data = {"a.sub": body, "b.sub": b"", "c.sub": b"x" * 4096}
    for name, raw in data.items():
        (tmp_path / name).write_bytes(raw)
    listing = spark.createDataFrame([(str(tmp_path / n),) for n in data] + [("file://" + str(tmp_path / "a.sub"),)], "path string")
    heads = {r.path.rsplit("/", 1)[1]: r.content for r in sources.read_heads(listing, 100).collect()}
    assert {n: bytes(h) for n, h in heads.items()} == {n: raw[:100] for n, raw in data.items()}
    assert sources.subfile_headers(sources.read_heads(listing.limit(1)), ["MODE"]).first().mode == "CORRELATOR"
    content = spark.createDataFrame([(n, bytearray(raw)) for n, raw in data.items()], "path string, content binary")
    for chunk in (2048, 4096, 1 << 20):
        etags = {r.path: r.etag for r in sources.etag_manifest(content, chunk).collect()}
        for r in sources.checksums(listing, chunk, piece=1000).collect():
            name = r.path.rsplit("/", 1)[1]
            assert (r.size, r.checksum, r.etag) == (len(data[name]), hashlib.md5(data[name]).hexdigest(), etags[name])


def test_admission_beyond_the_limit(spark):
    rows = spark.createDataFrame([(i, False, i % 2 == 0, i) for i in range(10)] + [(20, True, None, 0)], "id long, realtime boolean, bulk_request boolean, request_added_datetime int")
    jobs = spark.createDataFrame([([1], "Queued"), ([], "Ready")], "request_ids array<long>, state string")
    got = {r.id: (r.decision, r["rank"]) for r in requests.admit(rows, jobs, 4).collect()}
    assert {i for i, d in got.items() if d[0] == "admit"} == {3, 5, 7} and got[1] == ("tracked", None) and got[20] == ("realtime", None) and got[3] == ("admit", 1)
    assert sum(d[0] == "queued" for d in got.values()) == 6


def feed(spark, folder, frames, schema):
    """A stream whose batches are these frames, in order."""
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(df, name, mode, folder):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(folder / "ck")).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name).collect()


def test_ingest_stream_equals_batch(spark, tmp_path):
    names = ["1244973688_20190619100110_ch114_000.fits", "1244973688_metafits_ppds.fits", "bad.fits", "1244973696_1244973696_109.sub", "1244973688_metafits_ppds.fits"]
    rows = [(f"/d/{n}", f"2024-01-01 00:00:0{i}") for i, n in enumerate(names)]
    listing = spark.createDataFrame(rows, "path string, t string").select("path", F.to_timestamp("t").alias("seen_at"))
    obs = spark.createDataFrame([(1244973688, "C001", False, ""), (1244973696, "G1", False, "")], "obs_id long, project_id string, calibrator boolean, calibrator_source string")
    conf = {"pattern": ".*", "exclude": ".sub", "corr_high": [], "vcs_high": ["C001"], "archiving_enabled": True}
    frames = [listing.where(f"path = '/d/{n}'") for n in names]
    live = drain(streams.ingest_stream(feed(spark, tmp_path / "in", frames, listing.schema), obs, **conf), "ingested", "append", tmp_path)
    cols = ("path", "obs_id", "filetype_id", "priority", "route", "message", "valid")
    show = lambda found: sorted(repr([r[c] for c in cols]) for r in found)
    assert show(live) == show(streams.ingest_stream(listing, obs, **conf).collect()) and len(live) == 3
    both = streams.with_startup(listing.limit(2), listing)
    assert sorted(r.path for r in both.collect()) == sorted({r[0] for r in rows})


def test_dumps_and_modes(spark):
    h = spark.createDataFrame([(t, m) for t in (1000, 1496, 1504, 5000) for m in ("P_VCS", "Q_VCS", None)], "subobs_id long, mode string")
    d = spark.createDataFrame([(1400, 1504), (1504, 1504), (9, 3)], "start_gps long, end_gps long")
    got = {(r.subobs_id, r.mode): r.action for r in catalog.dispatch_subfiles(h, "C", d, mode_prefix="P_").collect()}
    assert {k: v for k, v in got.items() if v == "dump"} == {(1496, m): "dump" for m in ("P_VCS", "Q_VCS", None)}
    assert got[1000, "P_VCS"] == "process" and got[1000, "Q_VCS"] == got[1000, None] == "ignore"
    assert catalog.dispatch_subfiles(h, "C", d.where("false")).count() == 12


def test_every_query_reads_its_tables(spark):
    assert set(plans.ORACLE_SQL) <= set(plans.QUERIES) and len(plans.QUERIES) > 80
