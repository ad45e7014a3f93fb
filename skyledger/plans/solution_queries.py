"""Queries on calibration solutions: channels, bands, flags, phases and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import fits, solutions
from .registry import query, r

_BANDS = """SELECT obs_id, tile_id AS band, chan_idx, 1280000 * (100 + tile_id % 60) + chan_idx * CASE WHEN tile_id % 11 = 5 THEN 30000 ELSE 20000 END + CASE WHEN tile_id % 13 = 4 AND chan_idx = 7 THEN 100 ELSE 0 END AS freq_hz FROM {gains}"""


@query("d3_chanblocks", ", b AS (" + _BANDS.format(gains="gains") + """), l AS (SELECT *, freq_hz - lag(freq_hz) OVER (PARTITION BY obs_id, band ORDER BY chan_idx) AS step FROM b),
g AS (SELECT obs_id, band, count(*) AS n, min(step) AS lo, max(step) AS hi, CAST(floor((avg(freq_hz) + min(step) / 2) / 1280000) AS INT) AS cc FROM l GROUP BY obs_id, band),
m AS (SELECT *, count(*) OVER (PARTITION BY obs_id, cc) AS same FROM g)
SELECT obs_id, band, unnest(list_filter([CASE WHEN lo <> hi THEN 'step not constant' END, CASE WHEN lo % 20000 <> 0 THEN 'step not a multiple of the fine width' END, CASE WHEN cc > 150 THEN 'coarse channel not expected' END, CASE WHEN same > 1 THEN 'coarse channel repeated' END], lambda x: x IS NOT NULL)) AS problem FROM m""", "gains")  # fmt: skip
def _(gains: DataFrame) -> DataFrame:
    blocks = gains.sparkSession.sql(_BANDS.format(gains="{gains}"), gains=gains)
    expected = gains.select("obs_id").distinct().select("obs_id", F.explode(F.sequence(F.lit(90), F.lit(150))).alias("rec_chan"))
    return solutions.check_chanblocks(blocks, 20_000, 1_280_000, expected)[0]


@query("d3_file_count", ", f AS (SELECT obs_id, count(DISTINCT rx) AS n_files FROM gains GROUP BY obs_id), w AS (SELECT obs_id, count(DISTINCT CASE WHEN tile_id < 40 OR obs_id % 2 = 0 THEN tile_id ELSE tile_id % 40 - 40 END) AS n_ranges FROM gains GROUP BY obs_id) SELECT obs_id, coalesce(n_files, 0) AS n_files, coalesce(n_ranges, 0) AS n_ranges FROM f FULL JOIN w USING (obs_id) WHERE coalesce(n_files, 0) <> coalesce(n_ranges, 0)", "gains")
def _(gains: DataFrame) -> DataFrame:
    ranges = gains.select("obs_id", F.expr("CASE WHEN tile_id < 40 OR obs_id % 2 = 0 THEN tile_id ELSE tile_id % 40 - 40 END AS tile_id")).distinct()
    return solutions.check_file_count(gains.select("obs_id", F.col("rx").alias("band")), ranges)


@query("d2_range_overlaps", ", x AS (SELECT obs_id, tile_id * 3 AS chan_from, tile_id * 3 + tile_id % 31 AS chan_to FROM tiles), l AS (SELECT *, lead(chan_from) OVER (PARTITION BY obs_id ORDER BY chan_from, chan_to) AS next_from FROM x) SELECT * FROM l WHERE next_from <= chan_to", "tiles")
def _(tiles: DataFrame) -> DataFrame:
    return solutions.range_overlaps(tiles.select("obs_id", (F.col("tile_id") * 3).alias("chan_from"), (F.col("tile_id") * 3 + F.col("tile_id") % 31).alias("chan_to")))


@query("d10_max_amplitudes", "SELECT obs_id, tile_id AS ant_idx, chan_idx, round(sqrt(re * re + im * im), 6) AS max_xx, round(2 * sqrt(re * re + im * im), 6) AS max_yy FROM gains", "gains")
def _(gains: DataFrame) -> DataFrame:
    re, im = F.col("re"), F.col("im")
    cells = {"xx": (re, im), "xy": (re, im), "yx": (re, im), "yy": (re * 2, im * 2)}
    rows = gains.select("obs_id", F.col("tile_id").alias("ant_idx"), "chan_idx", F.explode(F.array(F.lit(0), F.lit(1))).alias("time_idx"), *[v.alias(f"{p}_{x}") for p, c in cells.items() for x, v in zip(("re", "im"), c, strict=True)])
    half = rows.withColumns({f"{p}_re": F.when(F.col("time_idx") == 0, F.col(f"{p}_re")).otherwise(F.lit(float("nan"))) for p in cells})
    return solutions.max_amplitudes(half).select("obs_id", "ant_idx", "chan_idx", r("max_xx", "max_xx"), r("max_yy", "max_yy"))


@query("d11_tile_flags", """, p AS (SELECT i, j, row_number() OVER (ORDER BY i, j) - 1 AS k FROM (SELECT unnest(range(0, 8)) AS i), (SELECT unnest(range(0, 8)) AS j) WHERE i < j),
b AS (SELECT (id - id % 28) // 28 AS obs, id % 28 AS k, obs_id % 9 = 0 AS bad FROM jobs), e AS (SELECT obs, i AS ant, bad FROM b JOIN p USING (k) UNION ALL SELECT obs, j, bad FROM b JOIN p USING (k))
SELECT obs AS obs_id, CAST(ant AS INT) AS ant_idx, bool_or(bad) AS flag FROM e GROUP BY obs, ant""", "jobs")  # fmt: skip
def _(jobs: DataFrame) -> DataFrame:
    weight = F.when(F.expr("obs_id % 18 = 0"), F.lit(float("nan"))).when(F.expr("obs_id % 9 = 0"), F.lit(None)).otherwise(F.lit(1.0))
    return solutions.tile_flags(jobs.select(F.expr("(id - id % 28) div 28 AS obs_id"), F.expr("CAST(id % 28 AS INT) AS baseline_idx"), weight.alias("weight")), 8)


@query("e6_base_flags", "SELECT obs_id, tile_id, chan_idx, chan_idx % 5 = 0 OR rx = 3 OR chan_idx % 7 = 2 AND tile_id % 2 = 0 AS base_bad FROM gains", "gains")
def _(gains: DataFrame) -> DataFrame:
    lost = F.expr("chan_idx % 7 = 2 AND tile_id % 2 = 0")
    cells = {f"{p}_{x}": F.when(lost & F.lit(p == "xy" and x == "im"), F.lit(float("nan"))).otherwise(F.col(x)) for p in solutions.POLS for x in ("re", "im")}
    rows = gains.select("obs_id", "tile_id", "chan_idx", *[v.alias(k) for k, v in cells.items()])
    blocks = gains.select("obs_id", "chan_idx", F.when(F.col("chan_idx") % 5 != 0, 1e-5).otherwise(F.lit(float("nan"))).alias("result")).distinct()
    flags = gains.select("obs_id", "tile_id", (F.col("rx") == 3).alias("flag")).distinct()
    return fits.base_flags(rows, blocks, flags).select("obs_id", "tile_id", "chan_idx", "base_bad")


#: Every 14th tile is listed under another number, and as many are listed twice.
_ODD_TILES = "explode(CASE tile_id % 14 WHEN 0 THEN array(-1 - tile_id) WHEN 7 THEN array(tile_id, tile_id) ELSE array(tile_id) END) AS tile_id"


@query("e8_phase_rejects", """, g AS (SELECT DISTINCT obs_id, tile_id, rx FROM gains), n AS (SELECT obs_id, tile_id, CASE WHEN tile_id % 7 = 0 THEN 'not exactly one tile' WHEN rx = 3 THEN 'flagged' WHEN tile_id % 5 = 1 THEN 'too few points or no fit' END AS reason FROM g)
SELECT obs_id, tile_id, 'XX' AS pol, reason FROM n WHERE reason IS NOT NULL""", "gains")  # fmt: skip
def _(gains: DataFrame) -> DataFrame:
    rows = gains.select("obs_id", "tile_id", "rx").distinct()
    tiles = rows.select("obs_id", F.expr(_ODD_TILES), (F.col("rx") == 3).alias("flag"))
    fitted = rows.select("obs_id", "tile_id", F.lit("XX").alias("pol"), F.when(F.expr("tile_id % 5 <> 1"), F.lit(1.0)).alias("length"))
    return fits.phase_rejects(gains.withColumn("pol", F.lit("XX")), tiles, fitted)


@query("e8_usable_gains", "SELECT obs_id, tile_id, count(*) AS n FROM gains WHERE rx <> 3 AND tile_id % 7 <> 0 GROUP BY obs_id, tile_id", "gains")
def _(gains: DataFrame) -> DataFrame:
    tiles = gains.select("obs_id", "tile_id", "rx").distinct().select("obs_id", F.expr(_ODD_TILES), (F.col("rx") == 3).alias("flag"))
    return fits.usable_gains(gains, tiles).groupBy("obs_id", "tile_id").agg(F.count("*").alias("n"))


@query("e9_flag_summary", """, b AS (SELECT obs_id, tile_id, chan_idx, weight = 0 AND tile_id % 3 <> 1 AS bad FROM gains), k AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY tile_id, chan_idx) AS k FROM b WHERE bad),
e AS (SELECT obs_id, string_agg(tile_id || ':' || chan_idx, ',' ORDER BY k) AS examples FROM k WHERE k <= 5 GROUP BY obs_id)
SELECT obs_id, count(*) AS n_cells, count(*) FILTER (WHERE bad) AS n_bad, round(100 * avg(bad::INT), 6) AS percent, coalesce(any_value(examples), '') AS examples FROM b LEFT JOIN e USING (obs_id) GROUP BY obs_id""", "gains")  # fmt: skip
def _(gains: DataFrame) -> DataFrame:
    flags = gains.select("obs_id", "tile_id", "chan_idx", F.expr("weight = 0 AND tile_id % 3 <> 1").alias("bad"))
    return fits.flag_summary(flags).withColumn("percent", F.round("percent", 6))


@query("f2_concat_bands", """, b AS (SELECT DISTINCT obs_id, rx AS band, chan_idx, freq_hz + (9 - rx) * 10000000 AS freq_hz FROM gains), s AS (SELECT obs_id, band, min(freq_hz) AS start, count(*) AS n FROM b GROUP BY obs_id, band),
o AS (SELECT obs_id, band, sum(n) OVER (PARTITION BY obs_id ORDER BY start, band) - n AS before FROM s) SELECT g.obs_id, tile_id, chan_idx, CAST(before + chan_idx AS INT) AS global_chan FROM gains g JOIN o ON g.obs_id = o.obs_id AND g.rx = o.band""", "gains")  # fmt: skip
def _(gains: DataFrame) -> DataFrame:
    rows = gains.withColumnRenamed("rx", "band")
    blocks = rows.select("obs_id", "band", "chan_idx", (F.col("freq_hz") + (9 - F.col("band")) * 10_000_000).alias("freq_hz")).distinct()
    return solutions.concat_bands(rows, blocks).select("obs_id", "tile_id", "chan_idx", "global_chan")


@query("f2_tile_mismatches", ", t AS (SELECT DISTINCT obs_id, tile_id % 50 AS tile_name, rx AS band FROM tiles), a AS (SELECT obs_id, count(DISTINCT band) AS n_all FROM t GROUP BY obs_id), h AS (SELECT obs_id, tile_name, count(DISTINCT band) AS n_bands FROM t GROUP BY obs_id, tile_name) SELECT obs_id, tile_name, n_bands, n_all FROM h JOIN a USING (obs_id) WHERE n_bands < n_all", "tiles")
def _(tiles: DataFrame) -> DataFrame:
    return solutions.tile_mismatches(tiles.select("obs_id", (F.col("tile_id") % 50).alias("tile_name"), F.col("rx").alias("band")))


@query("b9_apply_phase_diff", """, d AS (SELECT 100000000 + obs_id * 7919 AS f, CAST(obs_id % 7 AS DOUBLE) / 3 AS v FROM setups), q AS (SELECT DISTINCT freq_hz FROM gains),
lo AS (SELECT freq_hz, f, v FROM q ASOF LEFT JOIN d ON freq_hz >= f), hi AS (SELECT freq_hz, f, v FROM q ASOF LEFT JOIN d ON freq_hz <= f),
w AS (SELECT lo.freq_hz, CASE WHEN lo.f IS NULL THEN hi.v WHEN hi.f IS NULL OR lo.freq_hz - lo.f <= hi.f - lo.freq_hz THEN lo.v ELSE hi.v END AS a FROM lo JOIN hi USING (freq_hz))
SELECT obs_id, tile_id, chan_idx, round(CASE WHEN rx % 2 = 0 THEN re * cos(a) + im * sin(a) ELSE re END, 6) AS re, round(CASE WHEN rx % 2 = 0 THEN im * cos(a) - re * sin(a) ELSE im END, 6) AS im FROM gains JOIN w USING (freq_hz)""", "gains", "tiles", "setups")  # fmt: skip
def _(gains: DataFrame, tiles: DataFrame, setups: DataFrame) -> DataFrame:
    table = setups.select((F.lit(100_000_000) + F.col("obs_id") * 7919).alias("freq_hz"), F.expr("CAST(obs_id % 7 AS DOUBLE) / 3 AS diff_rad"))
    out = fits.apply_phase_diff(gains, tiles, table, bin_hz=500_000)
    return out.select("obs_id", "tile_id", "chan_idx", r("re", "re"), r("im", "im"))


_RX = range(10)


@query("a10_residual_report", ", c AS (SELECT DISTINCT obs_id, freq_hz, rx, chan_idx FROM gains) SELECT obs_id, freq_hz, " + ", ".join(f'max(CASE WHEN rx = {i} THEN CAST(chan_idx + {i} + 0.5 AS DOUBLE) END) AS "{i}_XX"' for i in _RX) + " FROM c GROUP BY obs_id, freq_hz", "gains")
def _(gains: DataFrame) -> DataFrame:
    spectrum = gains.select("obs_id", "freq_hz", F.col("rx").cast("string").alias("flavor"), F.lit("XX").alias("pol"), (F.col("chan_idx") + F.col("rx") + 0.5).cast("double").alias("residual")).distinct()
    return fits.residual_report(spectrum, [f"{i}_XX" for i in _RX])


@query("b11_empty_solutions", ", x AS (SELECT obs_id, tile_id, tile_id % 4 <> 0 AS has FROM tiles) SELECT obs_id AS obsid, count(*) AS n_tiles, count(*) FILTER (WHERE NOT has) AS n_empty FROM x GROUP BY obs_id", "tiles")
def _(tiles: DataFrame) -> DataFrame:
    from ..operators import requests

    # fits of other tiles than these have numbers that aren't in ``tiles``
    every = tiles.select("obs_id", "tile_id", F.explode(F.array(F.lit("XX"), F.lit("YY"))).alias("pol"))
    gains = every.withColumn("tile_id", F.expr("CASE WHEN tile_id % 4 = 1 THEN tile_id ELSE -1 - tile_id END")).withColumns({c: F.array(F.lit(1.0), F.lit(None).cast("double")) for c in ("gains", "pol0", "pol1", "sigma_resid")} | {"quality": F.lit(1.0)})
    phases = every.withColumn("tile_id", F.expr("CASE WHEN tile_id % 4 > 1 AND pol = 'YY' THEN tile_id ELSE -1 - tile_id END")).withColumns({c: F.lit(1.0) for c in ("length", "intercept", "sigma_resid", "chi2dof", "quality")})
    header = requests.fit_header(tiles, fit_time="2024-01-01 00:00:00", creator="batch", code_version="1", niter=1, limit=20)
    return fits.count_empty(fits.assemble_solutions(tiles, gains, phases, header, 2))
