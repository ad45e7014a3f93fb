"""Views that dress the star-schema tables as the observatory's, in SQL that Spark and DuckDB both read.

``{name}`` stands for a table; ``@STAMP@`` for an order date as yyyyMMddHHmmss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBS = "1244973688 + o_orderkey * 8"
_S = f"CAST({OBS} AS STRING)"

VIEWS: dict[str, str] = {
    "observations": f"""
SELECT {OBS} + CASE WHEN o_orderkey % 13 = 5 THEN 4 ELSE 0 END AS obs_id, o_orderkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'C001' WHEN 'MACHINERY' THEN 'C123' WHEN 'HOUSEHOLD' THEN 'D0006' ELSE 'G0024' END AS project_id,
  o_orderstatus = 'F' AS calibrator, CASE WHEN o_orderkey % 17 = 0 THEN 'SUN' ELSE 'HydA' END AS calibrator_source,
  CASE WHEN o_orderkey % 4 = 0 THEN 'XYZ_VCS' ELSE 'XYZ_CORRELATOR' END AS mode
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey""",
    "files": f"""
SELECT '/data/' || CAST(o_orderkey % 3 AS STRING) || '/' || CASE o_orderkey % 11
  WHEN 0 THEN {_S} || '_' || {_S} || '_109.sub' WHEN 1 THEN {_S} || '_metafits.fits' WHEN 2 THEN {_S} || '_metafits_ppds.fits' WHEN 3 THEN {_S} || '.metafits'
  WHEN 4 THEN {_S} || CASE WHEN o_custkey % 3 = 0 THEN '_flag.zip' ELSE '_flags.zip' END WHEN 5 THEN {_S} || '_ch123_beam00.vdif' WHEN 6 THEN {_S} || '_' || {_S} || '_ch123_beam00.fil' WHEN 7 THEN 'x' || {_S} || '.fits' WHEN 8 THEN {_S} || '.txt'
  WHEN 10 THEN {_S} || '_' || @STAMP@ || '.fits.part' || CAST(o_custkey % 4 AS STRING)
  ELSE {_S} || '_' || @STAMP@ || '_ch' || lpad(CAST(o_custkey % 256 AS STRING), 3, '0') || '_00' || CAST(o_custkey % 2 AS STRING) || '.fits' END AS path, o_orderkey, o_orderdate AS modification_time
FROM {{orders}}""",
    "ledger": """
SELECT l_orderkey AS obs_id, l_orderkey AS observation_num, CAST(l_linenumber AS STRING) || '.fits' AS filename, CAST(l_suppkey AS STRING) AS host, CAST(floor(l_extendedprice) AS BIGINT) AS size,
  md5(CAST(l_partkey AS STRING)) AS checksum, l_returnflag = 'R' AS deleted, CASE WHEN l_suppkey % 2 = 0 THEN 18 ELSE 8 END AS filetype, l_linestatus = 'F' AS remote_archived,
  CASE WHEN l_partkey % 3 = 0 THEN -1 ELSE l_partkey END AS trigger_id, CAST(NULL AS INT) AS location, CAST(NULL AS STRING) AS bucket, CAST(NULL AS STRING) AS folder
FROM {lineitem}""",
    "disk": """
SELECT DISTINCT l_orderkey AS obs_id, CASE WHEN l_suppkey % 5 = 0 THEN 'x' ELSE '' END || CAST(l_linenumber AS STRING) || '.fits' AS filename, CASE WHEN l_partkey % 9 = 0 THEN 0 WHEN l_partkey % 10 = 0 THEN 7 ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS size,
  CASE WHEN l_partkey % 7 = 0 THEN 'bad' ELSE md5(CAST(l_partkey AS STRING)) END AS checksum
FROM {lineitem}""",
    "requests": """
SELECT o_orderkey AS id, 1244973688 + o_custkey * 8 AS cal_id, CASE WHEN o_orderkey % 23 = 1 THEN NULL ELSE o_orderkey % 5 = 0 END AS realtime, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 3 = 0 END AS bulk_request, o_orderdate AS request_added_datetime,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS slurm_job_id, CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate END AS download_completed_datetime,
  CASE WHEN o_orderkey % 10 = 1 THEN o_orderdate END AS download_error_datetime, CASE WHEN o_orderkey % 21 = 1 THEN o_orderdate END AS download_job_submitted_error_datetime
FROM {orders}""",
    "attempts": """
SELECT CAST(user_id AS STRING) AS item, ts, event_id, event_type <> 'error' AS success, CAST(user_id % 4 AS INT) AS priority FROM {events}""",
    "health": """
SELECT ts, CAST(user_id % 10 AS STRING) AS host, event_type AS worker, CAST(floor(value) AS BIGINT) AS queue_size FROM {events}""",
    "transfers": """
SELECT CAST(user_id % 10 AS STRING) AS destination, CAST(floor(value * 1000000000) AS BIGINT) AS bytes, CAST(event_id % 6 AS DOUBLE) AS elapsed_sec, event_type <> 'error' AS ok FROM {events}""",
    "subfiles": f"""
SELECT '/sub/' || CAST(o_orderkey AS STRING) AS path, {OBS} AS subobs_id, CASE o_orderkey % 9 WHEN 0 THEN 'XYZ_VCS' WHEN 1 THEN 'XYZ_CORR_BF' WHEN 2 THEN 'XYZ_BUFFER' WHEN 3 THEN 'XYZ_BEAMFORMER' WHEN 4 THEN 'NO_CAPTURE'
  WHEN 5 THEN 'OTHER_VCS' WHEN 6 THEN CAST(NULL AS STRING) ELSE 'XYZ_CORRELATOR' END AS mode, CASE WHEN o_custkey % 4 = 0 THEN o_custkey END AS trigger_id
FROM {{orders}}""",
    "dumps": """
SELECT s_suppkey AS request_id, CASE WHEN s_suppkey % 50 = 3 THEN 0 ELSE 1244973688 + s_suppkey * 1008 END AS start_gps, 1244973688 + s_suppkey * 1008 + s_nationkey * 40 AS end_gps, s_suppkey + 500000 AS trigger_id
FROM {supplier}""",
    "setups": """
SELECT p_partkey AS obs_id, 10000 * CAST(pow(2, p_size % 4) AS BIGINT) AS fine_chan_width_hz, 500 * (1 + p_size % 8) AS int_time_ms, p_partkey % 3 = 0 AS oversampled, 8000 * (1 + p_partkey % 40) AS sched_duration_ms,
  1280000 AS coarse_chan_width_hz, 24 AS num_coarse, 8256 + p_size AS num_baselines, 4 AS num_pols
FROM {part}""",
    "tool_lines": """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'Submitted ' || CAST(user_id AS STRING) || ' as ABC job ID ' || CAST(event_id AS STRING) WHEN 1 THEN 'Job already queued, processing or complete. Job Id: ' || CAST(event_id AS STRING)
  WHEN 2 THEN 'Job already running or complete. Job Id: ' || CAST(event_id AS STRING) || ' ObsID: 5' WHEN 3 THEN '{{"error_code": ' || CAST(user_id AS STRING) || '}}' WHEN 4 THEN 'No obs locations found' WHEN 5 THEN 'as XYZ job ID 5' ELSE event_type END AS text
FROM {events}""",
    "jobs": """
SELECT o_orderkey AS id, CAST(o_custkey AS BIGINT) AS obs_id, CASE o_orderkey % 5 WHEN 0 THEN 'Ready' WHEN 1 THEN 'Error' WHEN 2 THEN 'Queued' WHEN 3 THEN 'Cancelled' ELSE 'Staging' END AS state,
  CASE WHEN o_orderkey % 5 = 0 THEN 'u' || CAST(o_orderkey AS STRING) END AS url, o_orderkey % 4 = 0 AS slurm_submitted
FROM {orders}""",
    "tiles": """
SELECT CAST(1000 + vec_id % 7 AS BIGINT) AS obs_id, CAST(vec_id AS INT) AS tile_id, 'Tile' || CAST(vec_id AS STRING) AS name, label = 3 AS flag, CAST(label AS INT) AS rx,
  CASE WHEN label % 2 = 0 THEN 'RG6-NI' ELSE 'LMR400' END AS flavor
FROM {embeddings}""",
}
#: Long tables of gains differ between the engines in how an array is taken apart.
GAINS_SPARK = """
SELECT CAST(1000 + vec_id % 7 AS BIGINT) AS obs_id, CAST(vec_id AS INT) AS tile_id, CAST(label AS INT) AS rx, CAST(chan AS INT) AS chan_idx, 100000000 + chan * 80000 AS freq_hz, CAST(v AS DOUBLE) AS re,
  CAST(embedding[(chan + 1) % 64] AS DOUBLE) AS im, CASE WHEN chan % 9 = 4 THEN 0D ELSE 1D + chan % 3 END AS weight, CAST(chan div 16 AS INT) AS coarse
FROM {embeddings} LATERAL VIEW posexplode(embedding) AS chan, v"""
GAINS_DUCK = """
SELECT CAST(1000 + vec_id % 7 AS BIGINT) AS obs_id, CAST(vec_id AS INT) AS tile_id, CAST(label AS INT) AS rx, CAST(chan AS INT) AS chan_idx, 100000000 + chan * 80000 AS freq_hz, CAST(embedding[chan + 1] AS DOUBLE) AS re,
  CAST(embedding[(chan + 1) % 64 + 1] AS DOUBLE) AS im, CASE WHEN chan % 9 = 4 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE + chan % 3 END AS weight, CAST(chan // 16 AS INT) AS coarse
FROM (SELECT vec_id, label, embedding, unnest(range(0, 64)) AS chan FROM {embeddings})"""
TABLES = ("orders", "customer", "lineitem", "events", "embeddings", "part", "supplier", "pages", "conversations")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = GAINS_SPARK if name == "gains" else VIEWS[name].replace("@STAMP@", "date_format(o_orderdate, 'yyyyMMddHHmmss')")
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql})


def duck(*names: str) -> str:
    """Leading common table expressions of a DuckDB query."""
    one = lambda n: GAINS_DUCK if n == "gains" else VIEWS[n].replace("@STAMP@", "strftime(o_orderdate, '%Y%m%d%H%M%S')")
    return "WITH " + ", ".join(f"{n} AS ({one(n).format(**{t: t for t in TABLES})})" for n in names)
