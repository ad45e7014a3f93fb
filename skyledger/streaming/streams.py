"""Streams of arrivals, observation completion and worker health."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import basename
from ..operators.catalog import parse_names, route_ingest, validate_files, with_priority

WATERMARK = "10 minutes"


def arrivals(listing: DataFrame, pattern: str, exclude: str = "") -> DataFrame:
    """New files of a listing stream (``path, seen_at``) whose name ends in ``pattern`` (``.*``: any); each path once within the watermark."""
    name = basename(F.col("path"))
    rows = listing if pattern == ".*" else listing.where(name.endswith(pattern))
    rows = rows.where(~name.endswith(exclude)) if exclude else rows
    return rows.withWatermark("seen_at", WATERMARK).dropDuplicatesWithinWatermark(["path"]) if rows.isStreaming else rows.dropDuplicates(["path"])


def with_startup(scan: DataFrame, arrived: DataFrame) -> DataFrame:
    """Files that one scan at the start found and files that arrived since, as one listing (``path, seen_at``); a path of both comes once.

    For a stream give the scan as a stream too (a folder of listings, of which the scan is the first), so that ``arrivals`` can tell repeats.
    """
    return arrivals(scan.select("path", "seen_at").unionByName(arrived.select("path", "seen_at")), ".*")


def ingest_stream(listing: DataFrame, observations: DataFrame, *, pattern: str, exclude: str, corr_high: list[str], vcs_high: list[str], archiving_enabled: bool) -> DataFrame:
    """Arrivals, validated against the table of observations, with priority and route; the same for a batch."""
    files = validate_files(arrivals(listing, pattern, exclude), observations)
    return route_ingest(with_priority(files, corr_high, vcs_high), archiving_enabled)


STITCH_KEY = ["obs_id", "rec_chan", "beam", "ext"]
STITCH_OUT = "obs_id bigint, rec_chan bigint, beam bigint, ext string, kind string, n_expected bigint, n_present bigint, missing array<bigint>, output string, files array<string>"


def _named(files: DataFrame, observations: DataFrame) -> DataFrame:
    """All files with the parts of their names, their observation's exposure and the ``reason`` why one is left out, else null."""
    named = parse_names(files, "beam").withColumn("ext", F.substring_index("path", ".", -1)).join(observations.select("obs_id", "exposure_sec"), "obs_id", "left")
    reason = F.when(F.col("obs_id").isNull(), "not a name of a beam's file").when(F.col("exposure_sec").isNull(), "observation or its exposure not found")
    return named.withColumn("reason", reason)


def stitch_rejects(files: DataFrame, observations: DataFrame) -> DataFrame:
    """``path, reason`` of the files that no beam gets; for a batch or a stream."""
    return _named(files, observations).where("reason IS NOT NULL").select("path", "reason")


def stitch_plan(files: DataFrame, observations: DataFrame) -> DataFrame:
    """Batch form: beams whose last sub-observation (start + exposure - 8) is there, with their files in order, how many were expected, which are missing and the output's name."""
    rows = _named(files, observations).where("reason IS NULL").groupBy(*STITCH_KEY).agg(
        F.collect_set("subobs_id").alias("_subobs"), F.first("exposure_sec").alias("_exp"), F.min("stitched").alias("output"), F.sort_array(F.collect_set("path")).alias("files")
    )
    done = rows.where("array_max(_subobs) >= obs_id + _exp - 8").withColumn("n_expected", F.expr("cast(_exp div 8 as bigint)"))
    wanted = F.expr("if(n_expected > 0, transform(sequence(0L, n_expected - 1), i -> obs_id + 8 * i), cast(array() as array<bigint>))")
    return done.select(*STITCH_KEY, F.lit("plan").alias("kind"), "n_expected", F.size("files").cast("bigint").alias("n_present"), F.array_except(wanted, "_subobs").alias("missing"), "output", "files")


def stitch_stream(files: DataFrame, observations: DataFrame, keep_sec: int = 86_400, delay: str = WATERMARK) -> DataFrame:
    """The same on a stream: a row of kind ``plan`` when the last sub-observation arrives, whatever is missing then.

    Files that arrive after it are rows of kind ``late`` (``files`` and ``n_present`` are theirs, ``missing`` is what is
    still missing), so a plan's files and its late ones are those of the batch. State is a beam's file names, then a mark
    with what is missing. Both end ``keep_sec`` after the beam's last arrival, as later files of any beam arrive; a
    beam without its end is then a row of kind ``expired``. Time is that of arrival, so no file is too late for the watermark.
    """

    def row(key: tuple, kind: str, exposure: int, missing: list[int], output: str, paths: list[str]) -> pd.DataFrame:
        return pd.DataFrame([[*key, kind, exposure // 8, len(paths), missing, output, paths]], columns=[c.split()[0] for c in STITCH_OUT.split(", ")])

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        before, missing, last, exposure, output, done = state.get if state.exists else ([], [], 0, 0, "", False)
        if state.hasTimedOut:
            state.remove()
            if not done:
                yield row(key, "expired", exposure, list(missing), output, list(before))
            return
        rows, start = pd.concat(list(frames)), int(key[0])
        paths, arrived = set(before) | set(rows["path"]), int(rows["_arrived"].max())
        if not state.exists:
            exposure = int(rows["exposure_sec"].iloc[0])
            missing = [start + 8 * i for i in range(exposure // 8)]
        missing = sorted(set(missing) - set(rows["subobs_id"]))
        output = min([*([output] if output else []), *rows["stitched"]])
        last = max(last, int(rows["subobs_id"].max()))
        ends = not done and last >= start + exposure - 8
        state.update(([] if done or ends else sorted(paths), missing, last, exposure, output, bool(done or ends)))
        state.setTimeoutTimestamp(arrived + 1000 * keep_sec)
        if done or ends:
            yield row(key, "late" if done else "plan", exposure, missing, output, sorted(paths))

    rows = _named(files.withColumn("_at", F.current_timestamp()).withWatermark("_at", delay), observations).where("reason IS NULL")
    rows = rows.withColumn("_arrived", F.unix_millis("_at"))
    kept = "paths array<string>, missing array<bigint>, last bigint, exposure bigint, output string, done boolean"
    return rows.groupBy(*STITCH_KEY).applyInPandasWithState(step, STITCH_OUT, kept, "append", "EventTimeTimeout")


PACKET = "main struct<hostname:string,process:string>, workers array<struct<name:string,queue_size:bigint,status:string>>"


def health_rows(packets: DataFrame) -> DataFrame:
    """A row for each worker of each packet (``ts, value``); packets that don't parse are left out."""
    p = packets.select("ts", F.from_json("value", PACKET).alias("p")).where("p.main IS NOT NULL")
    return p.select("ts", F.col("p.main.hostname").alias("host"), F.explode("p.workers").alias("w")).select("ts", "host", F.col("w.name").alias("worker"), F.col("w.queue_size").alias("queue_size"), F.col("w.status").alias("status"))


def worker_health(rows: DataFrame, window: str = "1 minute") -> DataFrame:
    """Largest and mean queue of each worker in each window; on a stream, late rows beyond the watermark are dropped."""
    rows = rows.withWatermark("ts", WATERMARK) if rows.isStreaming else rows
    out = rows.groupBy(F.window("ts", window).alias("w"), "host", "worker").agg(F.max("queue_size").alias("max_queue"), F.avg("queue_size").alias("mean_queue"), F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), "host", "worker", "max_queue", "mean_queue", "n")


def missing_hosts(rows: DataFrame, now: str, timeout_sec: int) -> DataFrame:
    """Hosts whose last packet is older than ``timeout_sec``."""
    last = rows.groupBy("host").agg(F.max("ts").alias("last_ts"))
    return last.where(F.unix_micros(F.to_timestamp(F.lit(now))) - F.unix_micros(F.col("last_ts").cast("timestamp")) > timeout_sec * 1_000_000)
