"""Calibration solutions in long form: consistency, weights, clipping, normalisation, gain fits and padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import amplitude, complex_product, complex_quotient, known

POLS = ("xx", "xy", "yx", "yy")


def refant(tiles: DataFrame, soln_tiles: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """``obs_id, tile_id, name``: the lowest tile that neither metadata nor (if given) a solution flags; null if there is none, or with ``strict`` an error when read."""
    rows = tiles.select("obs_id", "tile_id", "name", F.col("flag").alias("_flag"))
    if soln_tiles is not None:
        bad = soln_tiles.groupBy("obs_id", F.col("tile_name").alias("name")).agg(F.bool_or("flag").alias("_bad"))
        rows = rows.join(bad, ["obs_id", "name"], "left").withColumn("_flag", F.col("_flag") | F.coalesce("_bad", F.lit(False)))
    best = rows.groupBy("obs_id").agg(F.min(F.when(~F.col("_flag"), F.struct("tile_id", "name"))).alias("b"))
    if strict:
        best = best.withColumn("b", F.coalesce("b", F.raise_error(F.concat(F.lit("no unflagged tile in observation "), F.col("obs_id").cast("string"))).cast(best.schema["b"].dataType)))
    return best.select("obs_id", "b.tile_id", "b.name")


def coarse_ranges(chans: DataFrame) -> DataFrame:
    """``obs_id, range_idx, chan_from, chan_to, n_chans``: runs of adjacent channels; repeats count once."""
    w = Window.partitionBy("obs_id").orderBy("rec_chan")
    rows = chans.select("obs_id", "rec_chan").distinct().withColumn("_run", F.col("rec_chan") - F.row_number().over(w))
    runs = rows.groupBy("obs_id", "_run").agg(F.min("rec_chan").alias("chan_from"), F.max("rec_chan").alias("chan_to"), F.count("*").alias("n_chans"))
    return runs.select("obs_id", (F.row_number().over(Window.partitionBy("obs_id").orderBy("chan_from")) - 1).alias("range_idx"), "chan_from", "chan_to", "n_chans")


def range_overlaps(ranges: DataFrame) -> DataFrame:
    """``obs_id, chan_from, chan_to, next_from`` of ranges that the next one, by first channel, begins within."""
    w = Window.partitionBy("obs_id").orderBy("chan_from", "chan_to")
    rows = ranges.select("obs_id", "chan_from", "chan_to", F.lead("chan_from").over(w).alias("next_from"))
    return rows.where("next_from <= chan_to")


def check_file_count(bands: DataFrame, ranges: DataFrame) -> DataFrame:
    """``obs_id, n_files, n_ranges`` of observations that have not one solution file (``band``) for each range of channels."""
    files = bands.groupBy("obs_id").agg(F.countDistinct("band").alias("n_files"))
    wanted = ranges.groupBy("obs_id").agg(F.count("*").alias("n_ranges"))
    both = files.join(wanted, "obs_id", "full").select("obs_id", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("n_ranges", F.lit(0)).alias("n_ranges"))
    return both.where("n_files <> n_ranges")


def check_chanblocks(blocks: DataFrame, fine_hz: int, coarse_hz: int, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(violations, bands): ``obs_id, band, problem`` rows, and each band with its ``coarse_chan``.

    Bands: ascending frequencies at a constant step that is a multiple of the fine width, two blocks or more,
    as many blocks as the observation's other bands; a coarse channel that is expected and no other band's.
    """
    w = Window.partitionBy("obs_id", "band").orderBy("chan_idx")
    steps = blocks.withColumn("_step", F.col("freq_hz") - F.lag("freq_hz").over(w))
    b = steps.groupBy("obs_id", "band").agg(
        F.count("*").alias("n"), F.min("_step").alias("lo"), F.max("_step").alias("hi"), F.avg("freq_hz").alias("mean"),
    )
    middle = F.when(F.col("n") > 1, F.col("mean") + F.col("lo") / 2).otherwise(F.col("mean"))
    b = b.withColumn("coarse_chan", F.floor(middle / coarse_hz).cast("int"))
    obs = Window.partitionBy("obs_id")
    b = b.withColumn("_most", F.max("n").over(obs)).withColumn("_same", F.count("*").over(Window.partitionBy("obs_id", "coarse_chan")))
    b = b.join(expected.select("obs_id", F.col("rec_chan").alias("coarse_chan"), F.lit(True).alias("_expected")).distinct(), ["obs_id", "coarse_chan"], "left")
    problems = [
        (F.col("n") < 2, "fewer than two blocks"), (F.col("lo") <= 0, "not ascending"), (F.col("lo") != F.col("hi"), "step not constant"),
        (F.col("lo") % fine_hz != 0, "step not a multiple of the fine width"), (F.col("n") != F.col("_most"), "number of blocks differs"),
        (F.col("_expected").isNull(), "coarse channel not expected"), (F.col("_same") > 1, "coarse channel repeated"),
    ]
    found = b.select("obs_id", "band", F.explode(F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in problems]), lambda x: x.isNotNull())).alias("problem"))
    return found, b.select("obs_id", "band", "coarse_chan", F.col("n").alias("n_blocks"))


def conv_weights(blocks: DataFrame, worst: float = 1e-4) -> DataFrame:
    """Adds ``weight``: exp(-result) scaled to 0..1 within the observation; 0 for results that are negative, above ``worst`` or NaN.

    Observations without any result have weight 1 throughout; equal results all get 0.
    """
    r = known(F.col("result"))
    obs = Window.partitionBy("obs_id")
    e = F.when((r >= 0) & (r <= worst), F.exp(-r))
    rows = blocks.withColumn("_e", e).withColumn("_n", F.count("result").over(obs)).withColumn("_lo", F.min("_e").over(obs)).withColumn("_hi", F.max("_e").over(obs))
    scaled = F.coalesce(F.try_divide(F.col("_e") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    return rows.withColumn("weight", F.when(F.col("_n") == 0, 1.0).otherwise(scaled)).drop("_e", "_n", "_lo", "_hi")


def convergence_summary(blocks: DataFrame) -> DataFrame:
    r = known(F.col("result"))
    return blocks.groupBy("obs_id", "band").agg(
        F.count("*").alias("n_total"), F.count(r).alias("n_converged"), (100.0 * F.count(r) / F.count("*")).alias("percent"), F.avg(r).alias("mean_result")
    )


def normalise_to_ref(gains: DataFrame, ref: DataFrame) -> DataFrame:
    """Each tile's Jones matrix times the inverse of the reference tile's, of the same observation, time and channel.

    ``gains``: ``obs_id, time_idx, ant_idx, chan_idx`` and re/im of xx, xy, yx, yy; ``ref``: ``obs_id, ant_idx``. A
    reference whose determinant is 0 gives nulls. The reference's rows are one in as many as there are tiles.
    """
    key = ["obs_id", "time_idx", "chan_idx"]
    r = gains.join(ref.select("obs_id", "ant_idx"), ["obs_id", "ant_idx"], "left_semi").select(*key, *[F.col(f"{p}_{x}").alias(f"_{p}_{x}") for p in POLS for x in ("re", "im")])
    z = lambda p, at="": (F.col(f"{at}{p}_re"), F.col(f"{at}{p}_im"))
    minus = lambda a, b: (a[0] - b[0], a[1] - b[1])
    det = minus(complex_product(z("xx", "_"), z("yy", "_")), complex_product(z("xy", "_"), z("yx", "_")))
    over = lambda a, p, b, q: complex_quotient(minus(complex_product(z(a), z(p, "_")), complex_product(z(b), z(q, "_"))), det)
    out = {"xx": over("xx", "yy", "xy", "yx"), "xy": over("xy", "xx", "xx", "xy"), "yx": over("yx", "yy", "yy", "yx"), "yy": over("yy", "xx", "yx", "xy")}
    rows = gains.join(r, key)
    others = [c for c in gains.columns if c[:3] not in [f"{p}_" for p in POLS]]
    return rows.select(*others, *[v.alias(f"{p}_{x}") for p, pair in out.items() for x, v in zip(("re", "im"), pair, strict=True)])


def clip_gains(gains: DataFrame, cutoff: float) -> tuple[DataFrame, DataFrame]:
    """(clipped, report): all four products of a matrix are null where any amplitude is above ``cutoff``; the report per observation."""
    amps = [amplitude(known(F.col(f"{p}_re")), known(F.col(f"{p}_im"))) for p in POLS]
    over = [F.coalesce(a > cutoff, F.lit(False)) for a in amps]
    hit = over[0] | over[1] | over[2] | over[3]
    clipped = gains.withColumns({f"{p}_{x}": F.when(~hit, F.col(f"{p}_{x}")) for p in POLS for x in ("re", "im")})
    n = F.count_if(hit)
    report = gains.groupBy("obs_id").agg(
        sum((F.count_if(o) for o in over), F.lit(0)).alias("n_samples"), n.alias("n_matrices"), (4 * n).alias("n_values"), *[F.max(a).alias(f"max_{p}") for p, a in zip(POLS, amps, strict=True)]
    )
    return clipped, report


def max_amplitudes(gains: DataFrame) -> DataFrame:
    """``obs_id, ant_idx, chan_idx`` and the largest amplitude of each product over time; of no known one it is null."""
    amps = {p: amplitude(known(F.col(f"{p}_re")), known(F.col(f"{p}_im"))) for p in POLS}
    return gains.groupBy("obs_id", "ant_idx", "chan_idx").agg(*[F.max(a).alias(f"max_{p}") for p, a in amps.items()])


def tile_flags(baselines: DataFrame, n_tiles: Column | int) -> DataFrame:
    """``obs_id, ant_idx, flag``: a tile is flagged if any of its baselines (numbered over pairs i < j) has no weight."""
    last = (n_tiles if isinstance(n_tiles, Column) else F.lit(n_tiles)) - 1
    # row i of the pairs begins at i * (2n - i - 1) / 2
    n = last + 1
    k, two = F.col("baseline_idx"), 2.0 * n - 1
    i = F.floor((two - F.sqrt(two * two - 8.0 * k)) / 2).cast("int")
    j = (k - (i * (2 * n - i - 1) / 2) + i + 1).cast("int")
    rows = baselines.select("obs_id", F.explode(F.array(i, j)).alias("ant_idx"), known(F.col("weight")).isNull().alias("_bad"))
    return rows.groupBy("obs_id", "ant_idx").agg(F.bool_or("_bad").alias("flag"))


def fit_gains(gains: DataFrame) -> DataFrame:
    """``obs_id, tile_id, pol, coarse, gain, pol0, pol1, sigma_resid, n_valid, quality`` of inverse amplitudes.

    ``gains``: ``obs_id, tile_id, pol, coarse, freq_hz, re, im, weight``. Valid are finite values of positive weight;
    a channel needs two. The gain is their weighted mean; the line through them weighs residuals (so squares of the
    weights count); frequencies are centred first. Quality is the share of all blocks within two standard deviations.
    """
    amp = amplitude(known(F.col("re")), known(F.col("im")))
    ok = known(F.col("weight")) > 0
    rows = gains.select("obs_id", "tile_id", "pol", "coarse", "freq_hz", F.when(ok & (amp > 0), 1.0 / amp).alias("y"), F.col("weight").alias("w"))
    key = ["obs_id", "tile_id", "pol", "coarse"]
    whole = Window.partitionBy(*key)
    v = F.col("y").isNotNull()
    rows = rows.withColumn("x", F.col("freq_hz") - F.avg(F.when(v, F.col("freq_hz"))).over(whole)).withColumn("w2", F.when(v, F.col("w") * F.col("w")))
    s = rows.groupBy(*key).agg(
        F.count("y").alias("n_valid"), F.try_divide(F.sum(F.col("y") * F.when(v, F.col("w"))), F.sum(F.when(v, F.col("w")))).alias("gain"),
        F.sum("w2").alias("s"), F.sum(F.col("w2") * F.col("x")).alias("sx"), F.sum(F.col("w2") * F.col("y")).alias("sy"),
        F.sum(F.col("w2") * F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("w2") * F.col("x") * F.col("y")).alias("sxy"),
        F.avg(F.when(v, F.col("freq_hz"))).alias("centre"),
    ).where("n_valid >= 2")
    det = F.col("s") * F.col("sxx") - F.col("sx") * F.col("sx")
    s = s.withColumn("slope", F.coalesce(F.try_divide(F.col("s") * F.col("sxy") - F.col("sx") * F.col("sy"), det), F.lit(0.0)))
    s = s.withColumn("level", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("s"))
    r = F.col("y") - F.col("level") - F.col("slope") * F.col("x")
    fitted = rows.join(s.select(*key, "gain", "slope", "level", "centre", "n_valid"), key, "left").withColumn("r", r).withColumn("sigma", F.stddev_pop("r").over(whole))
    fitted = fitted.withColumn("good", F.col("r").isNotNull() & ((F.col("sigma") < 1e-10) | (F.abs("r") < 2 * F.col("sigma"))))
    per = fitted.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in ("gain", "slope", "level", "centre", "sigma")], F.coalesce(F.first("n_valid"), F.lit(0)).alias("n_valid"), F.count_if("good").alias("_good"), F.count("*").alias("_all")
    )
    q = Window.partitionBy("obs_id", "tile_id", "pol")
    return per.select(
        *key, "gain", (F.col("level") - F.col("slope") * F.col("centre")).alias("pol0"), F.col("slope").alias("pol1"), F.col("sigma").alias("sigma_resid"), "n_valid",
        (F.sum("_good").over(q) / F.sum("_all").over(q)).alias("quality"),
    )


def pad_channels(fits: DataFrame, expected: DataFrame, values: list[str]) -> DataFrame:
    """``obs_id, tile_id, pol`` and an array for each value over the expected channels in order; null where there is none, others are dropped."""
    tiles = fits.select("obs_id", "tile_id", "pol").distinct()
    grid = tiles.join(expected.select("obs_id", F.col("rec_chan").alias("coarse")).distinct(), "obs_id")
    rows = grid.join(fits.select("obs_id", "tile_id", "pol", "coarse", *values), ["obs_id", "tile_id", "pol", "coarse"], "left")
    packed = rows.groupBy("obs_id", "tile_id", "pol").agg(F.sort_array(F.collect_list(F.struct("coarse", *values))).alias("_p"))
    return packed.select("obs_id", "tile_id", "pol", *[F.col("_p").getField(v).alias(v) for v in values])


def concat_bands(gains: DataFrame, blocks: DataFrame) -> DataFrame:
    """Gains with ``global_chan``: channels of all bands counted in order of band start, then channel."""
    start = blocks.groupBy("obs_id", "band").agg(F.min("freq_hz").alias("start"), F.count("*").alias("n"))
    w = Window.partitionBy("obs_id").orderBy("start", "band")
    offset = start.withColumn("_before", F.sum("n").over(w) - F.col("n")).select("obs_id", "band", "_before")
    return gains.join(offset, ["obs_id", "band"]).withColumn("global_chan", (F.col("_before") + F.col("chan_idx")).cast("int")).drop("_before")


def tile_mismatches(soln_tiles: DataFrame) -> DataFrame:
    """``obs_id, tile_name, n_bands, n_all``: tiles that not all bands (``band``) of an observation hold, so that these can't be put together."""
    bands = soln_tiles.groupBy("obs_id").agg(F.countDistinct("band").alias("n_all"))
    held = soln_tiles.groupBy("obs_id", "tile_name").agg(F.countDistinct("band").alias("n_bands"))
    return held.join(bands, "obs_id").where("n_bands < n_all").select("obs_id", "tile_name", "n_bands", "n_all")
