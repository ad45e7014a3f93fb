"""Fits over many observations: phase ramps, outliers, bad gains, interpolation, residuals and solution rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import C_LIGHT, complex_product, known, let, phase, suffixed, wrap_angle
from .quantiles import exact_quantiles


def reject_outliers(fits: DataFrame, metrics: tuple[str, ...] = ("chi2dof", "sigma_resid"), nstd: float = 3.0, cross_pol: bool = True) -> DataFrame:
    """Adds ``outlier``. For each metric, for XX then YY: the threshold is mean + nstd * sample deviation of that
    polarisation's rows not yet flagged; every row at or above it is flagged, of any polarisation unless ``cross_pol`` is
    off. 0 changes nothing; a negative ``nstd`` flags at or below. Aggregates of an observation, joined back.
    """
    rows = fits.withColumn("outlier", F.lit(False))
    if nstd == 0:
        return rows
    for metric in metrics:
        value = known(F.col(metric))
        for pol in ("XX", "YY"):
            w = Window.partitionBy("obs_id")
            mine = F.when(~F.col("outlier") & (F.col("pol") == pol), value)
            rows = rows.withColumn("_t", F.avg(mine).over(w) + nstd * F.stddev_samp(mine).over(w))
            hit = value >= F.col("_t") if nstd > 0 else value <= F.col("_t")
            if not cross_pol:
                hit = hit & (F.col("pol") == pol)
            rows = rows.withColumn("outlier", F.col("outlier") | F.coalesce(hit, F.lit(False))).drop("_t")
    return rows


#: Points of a grid of frequencies, at most; spacings that would need more are searched delay by delay.
GRID = 1 << 21


def _start_delay(x: np.ndarray, u: np.ndarray, step: float) -> float:
    """The delay whose phasors fit ``u`` at frequencies ``x`` (from 0) best, of four to a resolution element, as far as the least spacing ``step`` can tell.

    The phasors, turned by the least delay, are put on an even grid of the spacing or an eighth of it; one transform of the grid, padded to four times its
    length, holds the sums for all delays.
    """
    delays = np.arange(-0.5 / step, 0.5 / step, 1 / (4 * x[-1]))
    fine = 1 if np.abs(x / step - np.rint(x / step)).max() < 1e-3 else 8
    places = np.rint(x / step * fine).astype(np.int64)
    if places[-1] >= GRID:
        power = np.concatenate([np.abs(np.exp(-2j * np.pi * d[:, None] * x) @ u) for d in np.array_split(delays, max(1, len(delays) // 512))])
    else:
        grid = np.zeros(4 * places[-1], complex)
        np.add.at(grid, places, u * np.exp(1j * np.pi * x / step))
        power = np.abs(np.fft.fft(grid))[: len(delays)]
    return delays[power.argmax()]


def fit_ramp(freq: np.ndarray, z: np.ndarray, weight: np.ndarray, niter: int = 1, clip_sigma: float = 2.0) -> dict | None:
    """Phase ramp angle(z) = slope * freq + intercept; None for fewer than two valid points.

    A start slope comes from a search over delays of weighted unit phasors; then least squares of wrapped residuals
    until it settles. Each round drops residuals beyond ``clip_sigma`` deviations (ddof 2). The quality is the share of all
    frequencies, those without a valid point too, that the last round kept.
    """
    if niter < 1:
        raise ValueError("niter must be at least 1")
    ok = np.isfinite(z) & (np.nan_to_num(weight) > 0) & (np.abs(z) > 0)
    order = np.argsort(freq[ok], kind="stable")
    f, z, w = freq[ok][order], z[ok][order], weight[ok][order]
    if len(f) < 2 or f[-1] == f[0]:
        return None
    step = np.diff(np.unique(f)).min()
    centre, wrap = f.mean(), lambda a: (a + np.pi) % (2 * np.pi) - np.pi
    u, x = z / np.abs(z) * w, f - f.mean()
    slope = 2 * np.pi * _start_delay(x - x[0], u, step)
    level = np.angle((u * np.exp(-1j * slope * x)).mean())
    angle = np.angle(z)
    for _ in range(niter):
        for _ in range(20):
            r = wrap(angle - slope * x - level)
            dx = x - x.mean()
            a = (dx * r).sum() / (dx * dx).sum()
            b = r.mean() - a * x.mean()
            slope, level = slope + a, level + b
            if abs(a) * np.ptp(x) < 1e-12 and abs(b) < 1e-12:
                break
        r = wrap(angle - slope * x - level)
        n = len(r)
        spread = float(np.sqrt((r**2).sum() / (n - 2))) if n > 2 else 0.0
        chi2dof = spread**2
        sigma = float(r.std())
        dx = x - x.mean()
        stderr = spread / float(np.sqrt((dx**2).sum()))
        keep = np.abs(r) < clip_sigma * spread if spread > 1e-10 else np.ones(n, bool)
        kept = int(keep.sum())
        if kept < 2 or np.ptp(x[keep]) == 0:
            break
        x, angle = x[keep], angle[keep]
    return {
        "length": C_LIGHT * slope / (2 * np.pi), "intercept": float(wrap(level - slope * centre)), "sigma_resid": sigma,
        "chi2dof": chi2dof, "quality": kept / len(freq), "stderr": stderr,
    }


PHASE_FITS = "obs_id bigint, tile_id int, pol string, length double, intercept double, sigma_resid double, chi2dof double, quality double, stderr double"


def fit_phase(gains: DataFrame, niter: int = 1) -> DataFrame:
    """One row for each (obs, tile, pol) of ``gains`` (``freq_hz, re, im, weight``); a group that can't be fitted has null values.

    A group is one tile's channels, at most some thousands of numbers, so it travels as one row, and a task takes many at a time.
    """
    names = [k.split()[0] for k in PHASE_FITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch["points"]
            ends = points.offsets.to_numpy() - points.offsets[0].as_py()
            f, re, im, w = (c.to_numpy(zero_copy_only=False) for c in points.flatten().flatten())
            found = [fit_ramp(f[a:b], re[a:b] + 1j * im[a:b], w[a:b], niter) or {} for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array([x.get(n) for x in found], pa.float64()) for n in names[3:]]], names=names)

    point = F.struct(*[F.col(c).cast("double").alias(c) for c in ("freq_hz", "re", "im", "weight")])
    tiles = gains.groupBy(F.col("obs_id").cast("bigint").alias("obs_id"), F.col("tile_id").cast("int").alias("tile_id"), "pol").agg(F.collect_list(point).alias("points"))
    return tiles.mapInArrow(run, PHASE_FITS)


def _median(numbers: Column) -> Column:
    """The median of an array of numbers without nulls; null for none."""
    n = F.size(numbers)
    return F.when(n > 0, let(F.sort_array(numbers), lambda s: (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2))


def _judged(points: Column, degree: int, threshold: float) -> Column:
    """One round over a group's points (``x, y, good, kept, residual``): struct ``points, done``, with ``kept`` and ``residual`` anew.

    The polynomial is a sum of orthogonal ones over the kept points, each made from the two before it, so it needs nothing but sums.
    """
    same = ("x", "y", "good", "kept", "residual")
    point = lambda r, **more: F.struct(*[r[c].alias(c) for c in same if c not in more], *[c.alias(n) for n, c in more.items()])
    none = F.struct(*[F.lit(0.0).alias(c) for c in "stu"])

    def add(acc: Column, r: Column) -> Column:
        p = r["p"]
        return F.when(r["kept"], F.struct((acc["s"] + p * p).alias("s"), (acc["t"] + p * r["rest"]).alias("t"), (acc["u"] + r["x"] * p * p).alias("u"))).otherwise(acc)

    def lowered(rows: Column, sums: Column, before: Column) -> Column:
        s = F.nullif(sums["s"], F.lit(0.0))
        share, centre, back = (F.coalesce(x, F.lit(0.0)) for x in (sums["t"] / s, sums["u"] / s, s / F.nullif(before, F.lit(0.0))))
        scale = let(F.struct(share.alias("share"), centre.alias("centre"), back.alias("back")), lambda k: F.transform(
            rows, lambda r: point(r, rest=r["rest"] - k["share"] * r["p"], p=(r["x"] - k["centre"]) * r["p"] - k["back"] * r["q"], q=r["p"])
        ))
        return F.struct(scale.alias("rows"), sums["s"].alias("before"))

    start = F.transform(points, lambda r: point(r, rest=r["y"], p=F.lit(1.0), q=F.lit(0.0)))
    state = F.struct(start.alias("rows"), F.lit(1.0).alias("before"))
    fitted = F.aggregate(
        F.sequence(F.lit(0), F.lit(degree)), state, lambda a, _: let(F.aggregate(a["rows"], none, add), lambda sums: lowered(a["rows"], sums, a["before"])), lambda a: a["rows"]
    )

    def judge(rows: Column) -> Column:
        kept = F.filter(rows, lambda r: r["kept"])
        return let(_median(F.transform(kept, lambda r: r["rest"])), lambda m: let(
            F.struct(
                m.alias("m"), _median(F.transform(kept, lambda r: F.abs(r["rest"] - m))).alias("mad"), F.array_max(F.transform(kept, lambda r: F.abs(r["y"]))).alias("size"), F.size(kept).alias("n")
            ),
            lambda k: settle(rows, k),
        ))

    def settle(rows: Column, k: Column) -> Column:
        # a spread that is nothing but rounding is none
        few, flat = k["n"] < degree + 2, k["mad"] <= 1e-14 * k["size"]
        told = lambda r: F.when(few, r["residual"]).when(flat, F.lit(0.0)).otherwise(F.abs(r["rest"] - k["m"]) / k["mad"])
        return let(F.transform(rows, lambda r: point(r, was=r["kept"], residual=told(r))), lambda new: let(near_of(new), lambda near: closed(near, few | flat)))

    def near_of(new: Column) -> Column:
        return F.transform(new, lambda r: point(r, was=r["was"], kept=F.coalesce(r["good"] & (r["residual"] <= threshold), F.lit(False))))

    def closed(near: Column, idle: Column) -> Column:
        # a polynomial through fewer points than it has places for would bend to them: the set stays
        stays = idle | (F.size(F.filter(near, lambda r: r["kept"])) < degree + 2) | F.forall(near, lambda r: r["kept"] == r["was"])
        return let(stays, lambda end: F.struct(F.transform(near, lambda r: point(r, kept=F.when(end, r["was"]).otherwise(r["kept"]))).alias("points"), end.alias("done")))

    return let(fitted, judge)


def reject_by_polynomial(rows: DataFrame, key: tuple[str, ...], place: str, values: tuple[str, ...], good: str, degree: int = 2, threshold: float = 5.0, rounds: int = 10) -> DataFrame:
    """Adds ``kept_v`` and ``residual_v`` for each of ``values``: points of a group that lie near its polynomial over ``place``.

    A round fits the kept points, and judges all that were ``good`` (and finite) at the start by the distance of their residual from the
    median over the median of such distances (of the kept ones, unscaled); so a point may come back. A group is done
    when nothing changes, and after ``rounds``. With fewer than ``degree + 2`` points there is no judgement (residual null); no spread makes
    all residuals 0.

    A group is one tile's channels, at most some thousands of rows, so it travels as one row, in the order of ``place``: one exchange for all
    rounds, which are steps of a fold over built-in functions. No column may be of a type without an order (a map).
    """
    held = [c for c in rows.columns if c != place]
    packed = rows.groupBy(F.struct(*key).alias("_g")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(place), *held))).alias("_rows"), F.min(place).alias("_low"), (F.max(place) - F.min(place)).alias("_span")
    )

    def folded(v: str) -> Column:
        x = lambda r: F.coalesce((r[place] - F.col("_low")) * 2.0 / F.nullif(F.col("_span"), F.lit(0)) - 1, F.lit(0.0))
        usable = lambda r: F.coalesce(r[good] & known(r[v]).isNotNull(), F.lit(False))
        nothing = F.lit(None).cast("double")
        points = F.transform("_rows", lambda r: F.struct(x(r).alias("x"), r[v].cast("double").alias("y"), usable(r).alias("good"), usable(r).alias("kept"), nothing.alias("residual")))
        # fields in the order in which a round returns them
        order = ("x", "y", "good", "residual", "kept")
        tidy = lambda a: F.transform(a, lambda r: F.struct(*[r[c].alias(c) for c in order]))
        one = lambda s: let(_judged(s["points"], degree, threshold), lambda n: F.struct(tidy(n["points"]).alias("points"), n["done"].alias("done")))
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(rounds)), F.struct(tidy(points).alias("points"), F.lit(False).alias("done")), lambda s, _: F.when(s["done"], s).otherwise(one(s)), lambda s: s["points"]
        )

    told = packed.select("_rows", *[folded(v).alias(f"_p{i}") for i, v in enumerate(values)])
    flat = told.select(F.inline(F.arrays_zip(F.col("_rows").alias("_r"), *[F.col(f"_p{i}").alias(f"_p{i}") for i in range(len(values))])))
    return flat.select(*[F.col("_r")[c].alias(c) for c in rows.columns], *[F.col(f"_p{i}")[n].alias(f"{n}_{v}") for i, v in enumerate(values) for n in ("kept", "residual")])


def base_flags(gains: DataFrame, blocks: DataFrame, tile_flags: DataFrame) -> DataFrame:
    """Adds ``base_bad``: the channel didn't converge (no finite result), the tile is flagged, or some of the matrix is missing.

    ``gains``: ``obs_id, tile_id, chan_idx`` and re/im of xx, xy, yx, yy; ``blocks``: ``obs_id, chan_idx, result``; ``tile_flags``:
    ``obs_id, tile_id, flag``. A channel or tile that its table doesn't hold is bad, or not flagged.
    """
    converged = blocks.groupBy("obs_id", "chan_idx").agg(F.bool_or(known(F.col("result")).isNotNull()).alias("_converged"))
    flagged = tile_flags.groupBy("obs_id", "tile_id").agg(F.bool_or("flag").alias("_flagged"))
    missing = F.lit(False)
    for p in ("xx", "xy", "yx", "yy"):
        for x in ("re", "im"):
            missing = missing | known(F.col(f"{p}_{x}")).isNull()
    rows = gains.join(converged, ["obs_id", "chan_idx"], "left").join(flagged, ["obs_id", "tile_id"], "left")
    bad = ~F.coalesce("_converged", F.lit(False)) | F.coalesce("_flagged", F.lit(False)) | missing
    return rows.withColumn("base_bad", bad).drop("_converged", "_flagged")


def phase_rejects(gains: DataFrame, tiles: DataFrame, fits: DataFrame) -> DataFrame:
    """``obs_id, tile_id, pol, reason`` of tiles without a phase fit: not exactly one row in ``tiles``, flagged, or no fit found."""
    known_tiles = tiles.groupBy("obs_id", "tile_id").agg(F.count("*").alias("_n"), F.bool_or("flag").alias("_flag"))
    rows = gains.select("obs_id", "tile_id", "pol").distinct().join(known_tiles, ["obs_id", "tile_id"], "left")
    fitted = fits.where("length IS NOT NULL").select("obs_id", "tile_id", "pol").withColumn("_fit", F.lit(True))
    reason = (
        F.when(F.coalesce("_n", F.lit(0)) != 1, "not exactly one tile").when(F.col("_flag"), "flagged").when(F.col("_fit").isNull(), "too few points or no fit")
    )
    return rows.join(fitted, ["obs_id", "tile_id", "pol"], "left").select("obs_id", "tile_id", "pol", reason.alias("reason")).where("reason IS NOT NULL")


def usable_gains(gains: DataFrame, tiles: DataFrame) -> DataFrame:
    """Gains of tiles that are exactly one row of ``tiles`` and not flagged: what is worth fitting."""
    good = tiles.groupBy("obs_id", "tile_id").agg(F.count("*").alias("_n"), F.bool_or("flag").alias("_flag")).where("_n = 1 AND NOT _flag")
    return gains.join(good.select("obs_id", "tile_id"), ["obs_id", "tile_id"], "left_semi")


def flag_bad_gains(gains: DataFrame, degree: int = 2, threshold: float = 5.0) -> DataFrame:
    """``obs_id, tile_id, chan_idx, bad, new_flag, residual`` of ``gains`` (``xx_re .. yy_im, base_bad``, see ``base_flags``), tile by tile.

    The amplitudes of XX and YY over the channels are each held against a polynomial; bad in one is bad. The residual is the larger one.
    """
    pols = ("xx", "yy")
    rows = gains.select("obs_id", "tile_id", "chan_idx", "base_bad", (~F.col("base_bad")).alias("usable"), *[F.hypot(f"{p}_re", f"{p}_im").alias(p) for p in pols])
    out = reject_by_polynomial(rows, ("obs_id", "tile_id"), "chan_idx", pols, "usable", degree, threshold)
    bad = F.col("base_bad") | ~F.col("kept_xx") | ~F.col("kept_yy")
    return out.select("obs_id", "tile_id", "chan_idx", bad.alias("bad"), (bad & ~F.col("base_bad")).alias("new_flag"), F.greatest("residual_xx", "residual_yy").alias("residual"))


def interpolate_gains(gains: DataFrame, values: list[str], key: tuple[str, ...] = ("obs_id", "tile_id")) -> DataFrame:
    """``values`` of rows marked ``bad`` by straight lines between the nearest good channels, ends held; null with fewer than two good ones."""
    w = Window.partitionBy(*key).orderBy("chan_idx")
    before, after, whole = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing), Window.partitionBy(*key)
    good = lambda c: F.when(~F.col("bad"), c)
    rows = gains.withColumn("_n", F.count(good(F.lit(1))).over(whole))
    out = {}
    for v in values:
        point = good(F.struct(F.col("chan_idx").cast("double").alias("x"), F.col(v).alias("y")))
        a, b = F.last(point, True).over(before), F.first(point, True).over(after)
        line = a["y"] + (b["y"] - a["y"]) * (F.col("chan_idx") - a["x"]) / (b["x"] - a["x"])
        out[v] = F.when(~F.col("bad"), F.col(v)).when(F.col("_n") >= 2, F.coalesce(line, a["y"], b["y"]))
    return rows.withColumns(out).drop("_n")


def flag_summary(flags: DataFrame, n: int = 5) -> DataFrame:
    """``obs_id, n_cells, n_bad, percent, examples``: the first ``n`` bad cells by tile and channel."""
    w = Window.partitionBy("obs_id").orderBy("tile_id", "chan_idx")
    bad = flags.where("bad").select("obs_id", "tile_id", "chan_idx", F.row_number().over(w).alias("_k")).where(F.col("_k") <= n)
    shown = bad.groupBy("obs_id").agg(F.concat_ws(",", F.sort_array(F.collect_list(F.struct("_k", F.concat_ws(":", "tile_id", "chan_idx").alias("t"))))["t"]).alias("examples"))
    counts = flags.groupBy("obs_id").agg(F.count("*").alias("n_cells"), F.count_if("bad").alias("n_bad"), (100 * F.avg(F.col("bad").cast("int"))).alias("percent"))
    return counts.join(shown, "obs_id", "left").withColumn("examples", F.coalesce("examples", F.lit("")))


def apply_phase_diff(gains: DataFrame, tiles: DataFrame, diffs: DataFrame, bin_hz: int = 10_000_000) -> DataFrame:
    """Gains (``re, im``) of tiles whose flavour ends in -NI turned by minus the phase at the nearest tabulated frequency (the lower of two).

    The nearest is looked for in the frequency's bin of ``bin_hz``, to which the last tabulated frequency below the bin and the first
    above it are added, so that no task orders more than one bin.
    """
    bin_of = lambda c: F.floor(F.col(c) / bin_hz)
    table = diffs.groupBy("freq_hz").agg(F.first("diff_rad").alias("d")).select(F.struct(F.col("freq_hz").cast("double").alias("f"), F.col("d").cast("double").alias("d")).alias("p"), bin_of("freq_hz").alias("bin"))
    # one row for each bin that holds something: bins are few, whatever the number of frequencies
    edges = table.groupBy("bin").agg(F.min("p").alias("least"), F.max("p").alias("most"))
    freqs = gains.select("freq_hz").distinct().withColumn("bin", bin_of("freq_hz"))
    every = edges.select("bin", "least", "most").unionByName(freqs.select("bin").distinct().select("bin", F.lit(None).cast("struct<f:double,d:double>").alias("least"), F.lit(None).cast("struct<f:double,d:double>").alias("most")))
    every = every.groupBy("bin").agg(F.max("least").alias("least"), F.max("most").alias("most"))
    w = Window.orderBy("bin")
    around = every.select(
        "bin", F.last("most", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("below"), F.first("least", True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("above")
    )
    both = freqs.select("freq_hz", "bin", F.lit(None).cast("struct<f:double,d:double>").alias("p")).unionByName(table.select(F.col("p.f").cast("bigint").alias("freq_hz"), "bin", "p"))
    w = Window.partitionBy("bin").orderBy("freq_hz")
    lo, hi = F.last("p", True).over(w.rangeBetween(Window.unboundedPreceding, 0)), F.first("p", True).over(w.rangeBetween(0, Window.unboundedFollowing))
    near = both.withColumns({"lo": lo, "hi": hi}).where("p IS NULL").join(around, "bin")
    near = near.select("freq_hz", F.coalesce("lo", "below").alias("lo"), F.coalesce("hi", "above").alias("hi"))
    d = F.when(F.col("lo").isNull(), F.col("hi.d")).when(F.col("hi").isNull() | (F.col("freq_hz") - F.col("lo.f") <= F.col("hi.f") - F.col("freq_hz")), F.col("lo.d")).otherwise(F.col("hi.d"))
    near = near.select("freq_hz", d.alias("_d"))
    ni = tiles.where(F.col("flavor").endswith("-NI")).select("obs_id", "tile_id", F.lit(True).alias("_ni")).distinct()
    rows = gains.join(near, "freq_hz", "left").join(ni, ["obs_id", "tile_id"], "left")
    re, im = complex_product((F.col("re"), F.col("im")), (F.cos("_d"), -F.sin("_d")))
    turn = F.col("_ni") & F.col("_d").isNotNull()
    return rows.withColumns({"re": F.when(turn, re).otherwise(F.col("re")), "im": F.when(turn, im).otherwise(F.col("im"))}).drop("_d", "_ni")


def pivot_phase_fits(fits: DataFrame, tiles: DataFrame) -> DataFrame:
    """One row for each tile with both polarisations: tile columns, then fit columns in order with ``_xx`` and ``_yy``."""
    values = sorted(c for c in fits.columns if c not in ("obs_id", "tile_id", "pol"))
    key = ("obs_id", "tile_id")
    x, y = (suffixed(fits.where(F.col("pol") == p).select(*key, *values), f"_{p.lower()}", key) for p in ("XX", "YY"))
    rows = tiles.join(x, list(key)).join(y, list(key))
    return rows.select(*tiles.columns, *[f"{v}_{p}" for v in values for p in ("xx", "yy")])


def rx_lengths(fits: DataFrame) -> DataFrame:
    """Mean and exact quartiles of cable length by receiver over fits that aren't outliers."""
    key = ("obs_id", "rx", "pol")
    good = fits.where("NOT outlier")
    means = good.groupBy(F.struct(*key).alias("_g")).agg(F.count("*").alias("n"), F.avg("length").alias("mean_length"))
    quartiles = exact_quantiles(good, key, F.col("length"), (0.25, 0.5, 0.75)).select(F.struct(*key).alias("_g"), F.col("quantiles").alias("quartiles"))
    return means.join(quartiles, "_g").select("_g.*", "n", "mean_length", "quartiles")


def residual_spectrum(gains: DataFrame, fits: DataFrame) -> DataFrame:
    """Exact median over tiles of the wrapped phase residual by (obs, flavor, pol, freq); missing values don't count."""
    ramp = 2 * 3.141592653589793 / C_LIGHT * F.col("length") * F.col("freq_hz") + F.col("intercept")
    rows = gains.join(fits.select("obs_id", "tile_id", "pol", "flavor", "length", "intercept"), ["obs_id", "tile_id", "pol"])
    r = wrap_angle(phase(known(F.col("re")), known(F.col("im"))) - ramp)
    key = ("obs_id", "flavor", "pol", "freq_hz")
    return exact_quantiles(rows, key, r, (0.5,)).select(*key, F.col("quantiles")[0].alias("residual"), F.col("n").alias("n_tiles"))


def polynomial_text(coeffs: list[float], variable: str = "x") -> str:
    """A polynomial as text, from its coefficients, highest power first: signed terms of three digits, from the constant upwards."""
    terms = [f"{c:+.3}" for c in reversed(coeffs)]
    for power in range(1, len(terms)):
        raised = "" if power == 1 else str(power).translate(str.maketrans("0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹"))
        terms[power] += f"×{variable}{raised}"
    return " ".join(terms)


def residual_poly(spectrum: DataFrame, max_order: int = 8) -> DataFrame:
    """Per (obs, flavor, pol) the polynomial of least order * mean squared error, orders 1 to 8 in frequency or its inverse (MHz), and its text.

    Coefficients are for the variable that was fitted, highest power first.
    """

    def one(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.dropna(subset=["residual"])
        best: tuple = (np.inf, None, None, None)
        for name, x in (("f", g["freq_hz"].to_numpy(float) / 1e6), ("1/f", 1e6 / g["freq_hz"].to_numpy(float))):
            span = np.ptp(x) if len(x) else 0
            for order in range(1, max_order + 1):
                if len(x) <= order or span == 0:
                    break
                c = np.polyfit((x - x.mean()) / span, g["residual"], order)
                cost = order * float(((np.polyval(c, (x - x.mean()) / span) - g["residual"]) ** 2).mean())
                if cost < best[0]:
                    plain = np.poly1d(c)(np.poly1d([1 / span, -x.mean() / span]))
                    best = (cost, name, order, [float(v) for v in plain.coeffs])
        text = None if best[3] is None else polynomial_text(best[3], {"f": "ν", "1/f": "ν⁻¹"}[best[1]])
        return pd.DataFrame([{"obs_id": key[0], "flavor": key[1], "pol": key[2], "cost": best[0], "variable": best[1], "order": best[2], "coeffs": best[3], "text": text}])

    return spectrum.groupBy("obs_id", "flavor", "pol").applyInPandas(one, "obs_id bigint, flavor string, pol string, cost double, variable string, order int, coeffs array<double>, text string")


def residual_report(spectrum: DataFrame, names: list[str] | None = None, max_columns: int = 1000) -> DataFrame:
    """A row for each (obs, frequency) with one column for each flavour and polarisation (``flavor_pol``), by name.

    ``names`` are the columns wanted; without them all that occur, which must be ``max_columns`` at most.
    """
    if names is None:
        names = sorted(r["n"] for r in spectrum.select(F.concat_ws("_", "flavor", "pol").alias("n")).distinct().limit(max_columns + 1).collect())
        if len(names) > max_columns:
            raise ValueError(f"more than {max_columns} flavours and polarisations")
    return spectrum.withColumn("n", F.concat_ws("_", "flavor", "pol")).groupBy("obs_id", "freq_hz").pivot("n", names).agg(F.first("residual")).orderBy("obs_id", "freq_hz")


def count_empty(solutions: DataFrame) -> DataFrame:
    """``obsid, n_tiles, n_empty``: rows of assembled solutions, and those of which nothing is known."""
    nothing = F.lit(True)
    for letter in ("x", "y"):
        nothing = nothing & F.col(f"{letter}_delay_m").isNull() & ~F.exists(f"{letter}_gains", lambda v: ~F.isnan(v))
    return solutions.groupBy("obsid").agg(F.count("*").alias("n_tiles"), F.count_if(nothing).alias("n_empty"))


def assemble_solutions(tiles: DataFrame, gain_fits: DataFrame, phase_fits: DataFrame, header: DataFrame, n_chans: int = 24) -> DataFrame:
    """One wide row for each tile of a solution, flagged ones too: missing fits are NaN arrays or nulls, lengths change sign (they are delays)."""
    key = ("obs_id", "tile_id")
    arrays, empty = ("gains", "pol0", "pol1", "sigma_resid"), F.array_repeat(F.lit(float("nan")), n_chans)
    rows = tiles.select(*key).join(header.select(F.col("obsid").alias("obs_id"), "fitid"), "obs_id")
    for letter, pol in (("x", "XX"), ("y", "YY")):
        g = gain_fits.where(F.col("pol") == pol).select(*key, *[F.col(a).alias(f"_g_{letter}_{a}") for a in arrays], F.col("quality").alias(f"{letter}_gains_fit_quality"))
        p = phase_fits.where(F.col("pol") == pol).select(
            *key, (-F.col("length")).alias(f"{letter}_delay_m"), F.col("intercept").alias(f"{letter}_intercept"), F.col("sigma_resid").alias(f"{letter}_phase_sigma_resid"),
            F.col("chi2dof").alias(f"{letter}_phase_chi2dof"), F.col("quality").alias(f"{letter}_phase_fit_quality"),
        )
        rows = rows.join(g, list(key), "left").join(p, list(key), "left")
        fill = lambda a, letter=letter: F.coalesce(F.transform(f"_g_{letter}_{a}", lambda v: F.coalesce(v, F.lit(float("nan")))), empty)
        rows = rows.withColumns({f"{letter}_gains" + ("" if a == "gains" else f"_{a}"): fill(a) for a in arrays}).drop(*[f"_g_{letter}_{a}" for a in arrays])
    return rows.withColumnRenamed("obs_id", "obsid").withColumnRenamed("tile_id", "tileid")
