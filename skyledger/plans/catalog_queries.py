"""Queries on files, headers, names, plans of preprocessing and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import exprs
from ..operators import catalog, ledger
from ..sources import files as sources
from .registry import query, r

_IN_DUMP = "EXISTS (SELECT 1 FROM dumps d WHERE s.subobs_id >= d.start_gps AND s.subobs_id < d.end_gps)"


def _dispatch_sql(process: str, ignored: str, stuck: str) -> str:
    return f""", x AS (SELECT path, coalesce(mode, '') AS mode, {_IN_DUMP} AS dump FROM subfiles s),
a AS (SELECT *, CASE WHEN dump THEN 'dump' WHEN mode IN ({ignored}) THEN 'ignore' WHEN mode IN ({process}) THEN 'process' WHEN mode IN ('NO_CAPTURE', 'CORR_MODE_CHANGE', 'XYZ_BUFFER') THEN 'drain' ELSE 'ignore' END AS action FROM x)
SELECT path, action, action = 'process' AND mode = 'XYZ_VCS' AS pause, action <> 'dump' AND mode NOT IN ({stuck}) AS free FROM a"""


@query("a18_dispatch", _dispatch_sql("'XYZ_CORRELATOR', 'XYZ_CORR_BF', 'XYZ_VCS'", "'XYZ_BEAMFORMER'", "''''"), "subfiles", "dumps")
def _(subfiles: DataFrame, dumps: DataFrame) -> DataFrame:
    return catalog.dispatch_subfiles(subfiles, "C", dumps, mode_prefix="XYZ_").select("path", "action", "pause", "free")


@query("a18_dispatch_beams", _dispatch_sql("'XYZ_BEAMFORMER'", "'XYZ_CORRELATOR', 'XYZ_CORR_BF', 'XYZ_VCS'", "'XYZ_CORR_BF'"), "subfiles", "dumps")
def _(subfiles: DataFrame, dumps: DataFrame) -> DataFrame:
    return catalog.dispatch_subfiles(subfiles, "B", dumps, mode_prefix="XYZ_").select("path", "action", "pause", "free")


_KINDS = [k for k, _ in catalog.DESCRIPTIONS] + ["other.dat", "phase_fits.tsv.bak"]
_REPORTS = "SELECT o_orderkey AS id, CAST(o_orderkey AS {s}) || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_ch' || CAST(57 + o_custkey % 90 AS {s}) || '_' ELSE '_ch' || CAST(60 + o_custkey % 9 AS {s}) || '-' || CAST(70 + o_custkey % 80 AS {s}) || '_' END || CASE o_orderkey % 14 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END AS filename FROM {t}"


@query("a20_description", ", n AS (" + _REPORTS.format(s="VARCHAR", t="(SELECT id AS o_orderkey, obs_id AS o_custkey FROM jobs)") + """),
p AS (SELECT filename, CASE """ + " ".join(f"WHEN contains(filename, '{k}') THEN '{v}'" for k, v in catalog.DESCRIPTIONS) + """ END AS text, regexp_extract(filename, '_ch([0-9]{1,3})(-([0-9]{1,3}))?_', 1) AS a, regexp_extract(filename, '_ch([0-9]{1,3})(-([0-9]{1,3}))?_', 3) AS b FROM n)
SELECT filename, coalesce(text || CASE WHEN a = '' THEN ' for all coarse channels' WHEN b = '' THEN ' for receiver channel ' || a || printf(' (%.3f MHz)', TRY_CAST(a AS DOUBLE) * 1.28)
  ELSE ' for receiver channels ' || a || '-' || b || printf(' (%.3f - %.3f MHz)', TRY_CAST(a AS DOUBLE) * 1.28, TRY_CAST(b AS DOUBLE) * 1.28) END, 'Miscellaneous file') AS description FROM p""", "jobs")  # fmt: skip
def _(jobs: DataFrame) -> DataFrame:
    names = _REPORTS.format(s="STRING", t="{jobs}")
    rows = jobs.select(F.col("id").alias("o_orderkey"), F.col("obs_id").alias("o_custkey"))
    return catalog.with_description(jobs.sparkSession.sql(names, jobs=rows)).select("filename", "description")


@query("a21_preprocess_plan", "SELECT obs_id, CASE WHEN oversampled THEN 0 ELSE greatest(fine_chan_width_hz, 30000) END AS edge_width_hz, CASE WHEN oversampled THEN 0 ELSE greatest(fine_chan_width_hz, 30000) END % fine_chan_width_hz = 0 AS edge_ok, CASE WHEN fine_chan_width_hz < 40000 THEN 40000 END AS avg_freq_hz, CASE WHEN int_time_ms < 2000 THEN 2000 END AS avg_time_ms FROM setups", "setups")
def _(setups: DataFrame) -> DataFrame:
    return catalog.preprocess_plan(setups, 30_000, 40_000, 2_000)


@query("a22_estimate_output", ", b AS (SELECT obs_id, (sched_duration_ms // greatest(int_time_ms, 2000))::BIGINT * num_coarse * (coarse_chan_width_hz // greatest(fine_chan_width_hz, 40000)) * num_baselines * num_pols * 13 AS bytes FROM setups), g AS (SELECT obs_id, CAST(bytes AS BIGINT) AS bytes, CAST(greatest(bytes // 1000000000, 1) AS BIGINT) AS gb FROM b) SELECT obs_id, bytes, gb, gb < 50 AS use_temp FROM g", "setups")
def _(setups: DataFrame) -> DataFrame:
    return catalog.estimate_output(setups, 40_000, 2_000, small_gb=50)


@query("a24_tool_output", "SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'new_job' WHEN 1 THEN 'existing_job' WHEN 2 THEN 'existing_job' WHEN 3 THEN 'error_code' WHEN 4 THEN 'outage' ELSE 'transient' END AS outcome, CASE WHEN event_id % 7 <= 2 THEN event_id WHEN event_id % 7 = 3 THEN CAST(regexp_extract(text, '([0-9]+)', 1) AS BIGINT) END AS number FROM tool_lines", "tool_lines")
def _(lines: DataFrame) -> DataFrame:
    return catalog.classify_tool_output(lines, "ABC").select("event_id", "outcome", "number")


@query("a25_beam_headers", """SELECT id AS obs_id, CAST(100 + id % 5 AS INT) AS rec_chan, CAST(id % 4 AS INT) AS beam, CASE WHEN id % 4 < 3 AND id % 2 = 0 THEN 'PSR' || CAST(id AS VARCHAR) ELSE 'field' || CAST(obs_id AS VARCHAR) END AS source,
  CASE WHEN id % 4 < 3 AND id % 3 = 1 THEN 7.5::DOUBLE WHEN id % 4 < 3 AND id % 6 <> 0 THEN CAST(id % 360 AS DOUBLE) + 0.5 ELSE 180.25 END AS ra_deg, CASE WHEN id % 4 < 3 AND id % 3 = 1 THEN -7.5::DOUBLE WHEN id % 4 < 3 AND id % 6 <> 0 THEN -10.5::DOUBLE ELSE -26.75::DOUBLE END AS dec_deg,
  CASE WHEN id % 4 < 3 THEN 100.0::DOUBLE END AS tsamp_us, CASE WHEN id % 5 < 4 THEN (100 + id % 5) * 1280000 / 1e6 END AS freq_mhz, CASE WHEN id % 5 < 4 THEN 1.28::DOUBLE END AS bw_mhz FROM jobs""", "jobs")  # fmt: skip
def _(jobs: DataFrame) -> DataFrame:
    products = jobs.select(F.col("id").alias("obs_id"), F.expr("CAST(100 + id % 5 AS INT) AS rec_chan"), F.expr("CAST(id % 4 AS INT) AS beam"))
    obs = jobs.select(F.col("id").alias("obs_id"), F.expr("'field' || CAST(obs_id AS STRING) AS obs_name"), F.lit(180.25).alias("obs_ra_deg"), F.lit(-26.75).alias("obs_dec_deg"))
    zero = lambda test, value: F.when(F.expr(test), F.lit(value)).otherwise(F.lit(0.0))
    beams = jobs.select(
        F.col("id").alias("obs_id"), F.explode(F.array(*[F.lit(b) for b in range(3)])).alias("beam_no"), F.expr("CASE WHEN id % 2 = 0 THEN 'PSR' || CAST(id AS STRING) END AS target_name"),
        zero("id % 3 = 1", 7.5).alias("start_ra_deg"), zero("id % 3 = 1", -7.5).alias("start_dec_deg"),
        F.when(F.expr("id % 6 = 0"), F.lit(0.0)).otherwise(F.expr("CAST(id % 360 AS DOUBLE) + 0.5")).alias("ra_deg"), F.when(F.expr("id % 6 = 0"), F.lit(0.0)).otherwise(F.lit(-10.5)).alias("dec_deg"),
        F.lit(10_000.0).alias("frequency_resolution_hz"),
    )
    chans = jobs.select(F.col("id").alias("obs_id"), F.explode(F.sequence(F.lit(100), F.lit(103))).alias("rec_chan")).select("obs_id", "rec_chan", (F.col("rec_chan") * 1_280_000).alias("centre_hz"), F.lit(1_280_000).alias("width_hz"))
    return catalog.beam_headers(products, obs, beams, chans)


@query("a3_subfile_headers", "SELECT path, mode, CAST(subobs_id AS VARCHAR) AS obs_id, CAST(NULL AS VARCHAR) AS none FROM subfiles", "subfiles")
def _(subfiles: DataFrame) -> DataFrame:
    lines = F.concat_ws("\n", F.concat(F.lit("MODE  "), "mode"), F.concat(F.lit("OBS_ID\t"), F.col("subobs_id").cast("string")), F.lit("MODE second"), F.lit("three words here"), F.lit("NONE"), F.repeat(F.lit("\0"), F.lit(5000)))
    content = F.when(F.col("mode").isNull(), F.regexp_replace(lines, "MODE second\n", "")).otherwise(lines)
    return sources.subfile_headers(subfiles.select("path", F.encode(content, "ISO-8859-1").alias("content")), ["MODE", "OBS_ID", "NONE"])


@query("a4_md5_manifest", "SELECT path, CAST(strlen(text) AS BIGINT) AS size, md5(text) AS checksum FROM (SELECT CAST(event_id AS VARCHAR) AS path, text FROM tool_lines)", "tool_lines")
def _(lines: DataFrame) -> DataFrame:
    return sources.md5_manifest(lines.select(F.col("event_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content")))


@query("a5_etag_manifest", """, c AS (SELECT event_id, text, CAST(ceil(strlen(text) / 16) AS INT) AS n FROM tool_lines)
SELECT CAST(event_id AS VARCHAR) AS path, '"' || CASE n WHEN 0 THEN '' WHEN 1 THEN md5(text) ELSE md5(unhex(array_to_string(list_transform(range(0, n), lambda i: md5(substr(text, i * 16 + 1, 16))), ''))) || '-' || n END || '"' AS etag FROM c""", "tool_lines")  # fmt: skip
def _(lines: DataFrame) -> DataFrame:
    return sources.etag_manifest(lines.select(F.col("event_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content")), 16)


@query("a9_plot_index_upsert", "SELECT id AS fitid, f AS filename, CASE WHEN f = 'b.png' THEN 30 WHEN id % 2 = 0 THEN 20 ELSE 10 END AS image_width, CASE WHEN f = 'b.png' THEN 40 WHEN id % 2 = 0 THEN 10 ELSE 20 END AS image_height, 2 AS version, 'now' AS generated_at FROM jobs, (SELECT unnest(['a.png', 'b.png']) AS f) WHERE f = 'a.png' OR id % 3 = 0 UNION ALL SELECT -id, f, 30, 40, 2, 'now' FROM jobs, (SELECT unnest(['a.png', 'b.png']) AS f) WHERE id % 3 <> 0", "jobs")
def _(jobs: DataFrame) -> DataFrame:
    old = jobs.select(F.col("id").alias("fitid"), F.lit("a.png").alias("filename"), F.lit(10).alias("image_width"), F.lit(20).alias("image_height"), F.expr("CASE WHEN id % 2 = 0 THEN 1 ELSE 2 END AS version"))
    # two thirds of the new documents are of other fits
    new = jobs.select(F.expr("CASE WHEN id % 3 = 0 THEN id ELSE -id END AS fitid"), F.explode(F.array(F.lit("a.png"), F.lit("b.png"))).alias("filename"), F.lit(30).alias("image_width"), F.lit(40).alias("image_height"), F.lit(2).alias("version"))
    return sources.upsert_plot_index(old, new, "now")


@query("a8_plot_index", """SELECT id AS fitid, '{"version":1,"base_url":"http://h/","files":[{"filename":"a.png","url":"http://h/' || id || '/a.png","size_bytes":' || obs_id || ',"last_modified":"2024-01-01T00:00:00Z","content_type":"image/png","description":"d","image_width":258,"image_height":7},'
  || '{"filename":"b.tsv","url":"http://h/' || id || '/b.tsv","size_bytes":' || obs_id || ',"last_modified":"2024-01-01T00:00:00Z","content_type":"text/tab-separated-values","description":"d"}]}' AS body FROM jobs""", "jobs")  # fmt: skip
def _(jobs: DataFrame) -> DataFrame:
    head = F.unhex(F.lit("89504E470D0A1A0A0000000D49484452" + "00000102" + "00000007"))
    files = jobs.select(
        F.col("id").alias("fitid"), F.explode(F.array(*[F.lit(n) for n in ("/p/b.tsv", "/p/a.png", "/p/index.json")])).alias("path"), F.col("obs_id").alias("length"), F.to_timestamp(F.lit("2024-01-01")).alias("modification_time"),
        head.alias("content"), F.lit("d").alias("description"),
    )
    return sources.plot_index(files, "http://h/")


@query("d13_tool_log", "SELECT CAST(user_id AS VARCHAR) AS run, CAST(arg_max(event_id, event_id) FILTER (WHERE good) AS BIGINT) AS transfers, CAST(arg_max(user_id, event_id) FILTER (WHERE good) AS BIGINT) AS bytes, CASE WHEN bool_or(good) THEN 0 END AS errors, CASE WHEN bool_or(good) THEN 1.5::DOUBLE END AS elapsed_sec FROM (SELECT CAST(item AS BIGINT) AS user_id, event_id, success AND event_id % 3 <> 0 AS good FROM attempts) GROUP BY user_id", "attempts")
def _(rows: DataFrame) -> DataFrame:
    stats = F.concat(F.lit('{"level":"info","stats":{"transfers":'), F.col("event_id").cast("string"), F.lit(',"bytes":'), "item", F.lit(',"errors":0,"elapsedTime":1.5}}'))
    text = F.when(F.col("success") & (F.col("event_id") % 3 != 0), stats).when(F.col("success"), '{"stats":').otherwise("plain text")
    return sources.last_stats(rows.select(F.col("item").alias("run"), F.col("event_id").alias("line_no"), text.alias("text"))).withColumn("errors", F.col("errors").cast("int"))


@query("d15_release_hosts", "SELECT DISTINCT observation_num AS obs_id, 'h' || CAST(TRY_CAST(host AS BIGINT) % 5 AS VARCHAR) AS host FROM ledger WHERE TRY_CAST(host AS BIGINT) % 7 <> 0", "ledger")
def _(rows: DataFrame) -> DataFrame:
    source = F.when(F.expr("CAST(host AS BIGINT) % 7 = 0"), "/local/path").otherwise(F.concat(F.when(F.expr("deleted"), "user@").otherwise(""), F.lit("h"), F.expr("CAST(CAST(host AS BIGINT) % 5 AS STRING)"), F.lit(":/data/f")))
    return ledger.release_hosts(rows.select(F.col("observation_num").alias("obs_id"), source.alias("source")))


@query("g3_missing_hosts", "SELECT host, max(ts) AS last_ts FROM health GROUP BY host HAVING epoch_us(TIMESTAMP '2030-01-01') - epoch_us(max(ts)) > 60000000", "health")
def _(rows: DataFrame) -> DataFrame:
    from ..streaming import streams

    return streams.missing_hosts(rows, "2030-01-01 00:00:00", 60)


@query("s1_wrap_angle", "SELECT event_id, round(v + pi() - 2 * pi() * floor((v + pi()) / (2 * pi())) - pi(), 6) AS angle FROM (SELECT event_id, CAST(bytes AS DOUBLE) / 1e7 - 40 AS v FROM (SELECT row_number() OVER () AS event_id, bytes FROM transfers WHERE false UNION ALL SELECT event_id, CAST(event_id * 37 % 1000000007 AS BIGINT) AS bytes FROM attempts))", "transfers", "attempts")
def _(transfers: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select("event_id", r(exprs.wrap_angle(F.expr("CAST(event_id * 37 % 1000000007 AS DOUBLE) / 1e7 - 40")), "angle"))


@query("s3_slope_length", "SELECT obs_id, tile_id, round(re * 1e-7 * 299792458.0 / (2 * pi()), 6) AS length, chan_idx FROM gains", "gains")
def _(gains: DataFrame) -> DataFrame:
    return gains.select("obs_id", "tile_id", "chan_idx", r(exprs.slope_to_length(F.col("re") * 1e-7), "length"))


@query("s4_number_list", "SELECT id, round(CAST(id AS DOUBLE) + 0.5 + obs_id, 3) AS total, CAST(4 AS INT) AS n FROM jobs", "jobs")
def _(jobs: DataFrame) -> DataFrame:
    text = F.concat(F.col("id").cast("string"), F.lit(", 0.5 ,x,"), F.col("obs_id").cast("string"))
    rows = catalog.numbers_of(jobs.select("id", text.alias("v")), "v")
    return rows.select("id", r(F.aggregate("v", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))), "total", 3), F.size("v").alias("n"))


@query("s6_modes", "SELECT path, coalesce(mode IN ('XYZ_CORRELATOR', 'XYZ_CORR_BF'), false) AS correlator, coalesce(mode = 'XYZ_VCS', false) AS vcs, coalesce(mode IN ('XYZ_BEAMFORMER', 'XYZ_CORR_BF'), false) AS beamformer, coalesce(mode = 'XYZ_BUFFER', false) AS buffer, coalesce(mode IN ('NO_CAPTURE', 'CORR_MODE_CHANGE'), false) AS no_capture FROM subfiles", "subfiles")
def _(subfiles: DataFrame) -> DataFrame:
    return subfiles.select("path", *[exprs.is_mode(F.col("mode"), k, "XYZ_").alias(k) for k in ("correlator", "vcs", "beamformer", "buffer", "no_capture")])


_TEXTS = """SELECT event_id, CASE event_id % 9 WHEN 0 THEN CAST(event_id AS {s}) WHEN 1 THEN '-' || CAST(event_id AS {s}) WHEN 2 THEN ' ' || CAST(event_id AS {s}) || ' ' WHEN 3 THEN CAST(event_id AS {s}) || '.5' WHEN 4 THEN '99999999999999999999' || CAST(event_id AS {s})
  WHEN 5 THEN '+' || CAST(event_id AS {s}) WHEN 6 THEN '' WHEN 7 THEN 'x' || CAST(event_id AS {s}) END AS text FROM {t}"""


@query("s7_integers", ", t AS (" + _TEXTS.format(s="VARCHAR", t="tool_lines") + ") SELECT event_id, coalesce(regexp_matches(text, '^ *[+-]?[0-9]{1,18} *$'), false) AS number FROM t", "tool_lines")
def _(lines: DataFrame) -> DataFrame:
    texts = lines.sparkSession.sql(_TEXTS.format(s="STRING", t="{lines}"), lines=lines)
    return texts.select("event_id", exprs.is_integer(F.col("text")).alias("number"))