"""The folder source and places in total orders."""

import os
import random
import time

import numpy as np
import pytest

from skyledger.operators import fits, order
from skyledger.sources import folders


def test_listing_of_many_nested_files(spark, tmp_path):
    rng = random.Random(1)
    for i in range(10_000):
        folder = tmp_path / "/".join(f"d{rng.randrange(4)}" for _ in range(rng.randrange(4)))
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{i}{rng.choice(['.fits', '.sub', '.part', ''])}").write_bytes(b"x" * rng.randrange(3))
    want = {os.path.join(d, n): os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(tmp_path) for n in names}
    for depth in ("0", "1", "2", "6"):
        got = folders.list_folder(spark, str(tmp_path), depth=depth).collect()
        assert len(got) == len(want) == 10_000 and {r.path: r.length for r in got} == want
    assert any(v == 0 for v in want.values())
    some = folders.list_folder(spark, str(tmp_path), pattern=".fits", recursive="false").collect()
    assert {r.path for r in some} == {p for p in want if p.endswith(".fits") and os.path.dirname(p) == str(tmp_path)}
    rest = folders.list_folder(spark, str(tmp_path), exclude=".part")
    assert {r.path for r in rest.collect()} == {p for p in want if not p.endswith(".part")}
    with pytest.raises(Exception, match="nowhere"):
        folders.list_folder(spark, str(tmp_path / "nowhere")).collect()


def test_arrivals_go_on_after_a_restart(spark, tmp_path):
    root = tmp_path / "root"
    (root / "a").mkdir(parents=True)

    def put(name, old=False):
        (root / name).parent.mkdir(exist_ok=True)
        if old:  # moved in with an old time
            other = tmp_path / "elsewhere"
            other.write_bytes(b"")
            os.utime(other, (1, 1))
            other.rename(root / name)
        else:
            (root / name).write_bytes(b"")

    def read():
        time.sleep(0.4)
        stream = folders.watch_folder(spark, str(root), settle_ms="100")
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).start()
        # time goes on, so there is always a next offset: wait for batches instead of the end
        time.sleep(4)
        q.stop()
        return sorted(os.path.relpath(r.path, root) for r in spark.read.schema(folders.SCHEMA).parquet(str(tmp_path / "out")).collect())

    put("one")
    put("a/two")
    assert read() == ["a/two", "one"]
    put("b/three")
    put("a/four", old=True)
    assert read() == ["a/four", "a/two", "b/three", "one"]
    assert read() == ["a/four", "a/two", "b/three", "one"]


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_rank(spark, n):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 30]), f"/d{rng.randrange(3)}/{rng.randrange(500)}.fits") for _ in range(n)]
    df = spark.createDataFrame(rows, "priority int, path string")
    out = order.rank_files(df)
    key = lambda r: (r[0] is None, r[0] or 0, r[1].rpartition("/")[2], r[1])
    assert [(r.priority, r.path) for r in sorted(out.collect(), key=lambda r: r["rank"])] == sorted(rows, key=key)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, n + 1))
    assert "Window" not in out._jdf.queryExecution().toString()


def test_orders(spark):
    files = spark.createDataFrame([("b", 57), ("a", None), ("c", 5)], "path string, chan_from int")
    assert [r.path for r in order.order_solutions(files).collect()] == ["a", "c", "b"] and [r.path for r in order.order_files(files).collect()] == ["a", "b", "c"]
    tiles = spark.createDataFrame([(2, 1), (1, 9), (1, 3)], "obs_id long, tile_id int")
    assert [tuple(r) for r in order.order_tiles(tiles).collect()] == [(1, 3), (1, 9), (2, 1)]
    assert [r.input_id for r in order.order_inputs(tiles.withColumnRenamed("tile_id", "input_id")).collect()] == [3, 9, 1]


def test_ramps_by_transform_and_delay_by_delay(monkeypatch):
    rng = np.random.default_rng(6)
    for k in range(40):
        n = int(rng.integers(3, 200))
        f = 1e8 + 4e4 * np.sort(rng.choice(400, n, replace=False)) if k % 2 else np.sort(1e8 + rng.uniform(0, 2e7, n))
        z = np.exp(1j * (f * rng.uniform(-1e-6, 1e-6) + 0.05 * rng.normal(size=n)))
        w = rng.uniform(0, 1, n)
        monkeypatch.setattr(fits, "GRID", 1 << 21)
        a = fits.fit_ramp(f, z, w)
        monkeypatch.setattr(fits, "GRID", 0)
        b = fits.fit_ramp(f, z, w)
        assert all(a[c] == pytest.approx(b[c], rel=1e-9, abs=1e-9) for c in a)


def test_fits_of_many_tiles_with_gaps(spark):
    f = [1.5e8 + 4e4 * i for i in range(64)]
    rows = [(1, t, "XX", x, None if t == 3 else float(np.cos(1e-7 * t * x)), float(np.sin(1e-7 * t * x)), None if i % 5 == 0 else 1.0) for t in range(1, 5) for i, x in enumerate(f)]
    got = {r.tile_id: r for r in fits.fit_phase(spark.createDataFrame(rows, "obs_id long, tile_id int, pol string, freq_hz double, re double, im double, weight double")).collect()}
    assert got[3].length is None and all(got[t].length == pytest.approx(1e-7 * t * 299792458 / (2 * np.pi), rel=1e-6) for t in (1, 2, 4))
    assert got[1].quality == pytest.approx(51 / 64)
