"""Archive ledger: appends, updates and reconciliation by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import bucket_of, extension
from ..sources.commits import CommittedTables


def append_data_files(new_files: DataFrame, observations: DataFrame, bucket_prefix: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, orphaned): files whose observation is known, with their partition key, and the others."""
    rows = new_files.withColumn("trigger_id", F.nullif(F.col("trigger_id"), F.lit(-1))).withColumn("obs_bucket", bucket_of(F.col("observation_num"), bucket_prefix))
    known = observations.select(F.col("obs_id").alias("observation_num"))
    return rows.join(known, "observation_num", "left_semi"), rows.join(known, "observation_num", "left_anti")


_KEY = ["observation_num", "filename"]


def _side_by_side(data_files: DataFrame, updates: DataFrame) -> DataFrame:
    """Ledger and updates (``_asked``) dealt by file, with what an update sets as ``_to``.

    Almost every file has one row, so rows travel as they are: partial sums would hold a task's whole share of the files and save nothing. All shuffle
    partitions are used, as the rows are so small that those put together by their bytes have millions.
    """
    asked = updates.select(*_KEY, F.lit(True).alias("_asked"), F.struct("location", "bucket", "folder").alias("_to"))
    both = data_files.withColumn("_asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    return both.repartition(int(data_files.sparkSession.conf.get("spark.sql.shuffle.partitions")), *_KEY)


def _counts() -> dict[str, Column]:
    """Rows of a file in the ledger (an unknown file has none) and updates of it."""
    named = F.col("observation_num").isNotNull() & F.col("filename").isNotNull()
    return {"n_updates": F.count_if("_asked"), "n_rows": F.count_if(~F.col("_asked") & named)}


def _checked(data_files: DataFrame, updates: DataFrame) -> DataFrame:
    """``observation_num, filename, n_updates, n_rows`` of each file with updates."""
    return _side_by_side(data_files, updates).groupBy(*_KEY).agg(*[c.alias(n) for n, c in _counts().items()]).where("n_updates > 0")


_GOOD = "n_updates = 1 AND n_rows = 1"


def mark_archived(data_files: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ledger, violations): the ledger with location columns of ``updates`` set, by observation and file name.

    An update must touch exactly one row; others change nothing and are returned as violations with ``n_rows``.
    Repeated updates of one file count as one violation each.
    """
    over = Window.partitionBy(*_KEY)
    rows = _side_by_side(data_files, updates).withColumns({n: c.over(over) for n, c in (_counts() | {"_new": F.max("_to")}).items()}).where("NOT _asked")
    rows = rows.withColumn("_new", F.when(F.expr(_GOOD), F.col("_new")))
    kept = [c for c in data_files.columns if c not in ("remote_archived", "location", "bucket", "folder")]
    out = rows.select(
        *[F.col(c).cast(data_files.schema[c].dataType).alias(c) if c in _KEY else F.col(c) for c in kept],
        (F.col("remote_archived") | F.col("_new").isNotNull()).alias("remote_archived"),
        *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in ("location", "bucket", "folder")],
    )
    return out, _checked(data_files, updates).where(f"NOT ({_GOOD})")


FILES = "data_files"
_BY_BUCKET = {FILES: "obs_bucket"}


def append_batch(tables: CommittedTables, batch: str, new_files: DataFrame, observations: DataFrame, bucket_prefix: str) -> DataFrame:
    """``append_data_files`` committed as ``batch`` to the table ``data_files``, once however often it is called; the orphaned rows."""
    accepted, orphaned = append_data_files(new_files, observations, bucket_prefix)
    tables.commit(batch, adds={FILES: accepted}, partition=_BY_BUCKET)
    return orphaned


def archive_batch(tables: CommittedTables, batch: str, updates: DataFrame, bucket_prefix: str) -> DataFrame:
    """``mark_archived`` committed as ``batch``; the violations, judged against the ledger as it is now.

    Only the partitions that the updates name are read and rewritten; one in which every update is a violation is left alone.
    """
    at = tables.snapshot()
    held = tables.read(FILES, _buckets(updates, bucket_prefix), at)
    out, violations = mark_archived(held, updates)
    # a batch that is published already has nothing to look for
    changed = [] if batch in at.batches else _buckets(_checked(held, updates).where(_GOOD), bucket_prefix)
    if changed:
        tables.commit(batch, replaces={FILES: out.where(F.col("obs_bucket").isin(changed)).select(*held.columns)}, partition=_BY_BUCKET, based_on=at)
    return violations


def _buckets(rows: DataFrame, bucket_prefix: str) -> list[str]:
    """The buckets of ``rows``, as few as the days that they are from."""
    return [r[0] for r in rows.select(bucket_of(F.col("observation_num"), bucket_prefix).alias("b")).where("b IS NOT NULL").distinct().collect()]


def verify_archive(files: DataFrame, data_files: DataFrame) -> DataFrame:
    """Adds ``decision`` to files on disk (``obs_id, filename, size, checksum``): archive, retry, drop or error.

    A file without exactly one row in the ledger is an error, whatever its size, so that nothing unknown is dropped.
    """
    ledger = data_files.groupBy(F.col("observation_num").alias("obs_id"), "filename").agg(
        F.count("*").alias("_n"), F.first("size").alias("_size"), F.first("checksum").alias("_md5")
    )
    decision = (
        F.when(F.coalesce("_n", F.lit(0)) != 1, "error")
        .when(F.col("size") == 0, "drop")
        .when(~F.col("size").eqNullSafe(F.col("_size")), "drop")
        .when(~F.col("checksum").eqNullSafe(F.col("_md5")), "retry")
        .otherwise("archive")
    )
    return files.join(ledger, ["obs_id", "filename"], "left").withColumn("decision", decision).drop("_n", "_size", "_md5")


def obs_ready(data_files: DataFrame, present: DataFrame, ends: DataFrame, now_gps: Column, wait: int = 180) -> DataFrame:
    """``obs_id, n_expected, n_present, missing, ready``: visibility files in the ledger against those present.

    Ready: as many present as expected, and the observation ended ``wait`` seconds ago. ``ends``: ``obs_id, end_gps``.
    """
    expected = data_files.where("filetype IN (18, 8) AND NOT deleted").select(F.col("observation_num").alias("obs_id"), "filename").distinct()
    both = expected.withColumn("_e", F.lit(1)).join(present.select("obs_id", "filename").distinct().withColumn("_p", F.lit(1)), ["obs_id", "filename"], "full")
    counts = both.groupBy("obs_id").agg(
        F.count("_e").alias("n_expected"), F.count("_p").alias("n_present"), F.array_sort(F.collect_list(F.when(F.col("_p").isNull(), F.col("filename")))).alias("missing")
    )
    done = (F.col("n_expected") == F.col("n_present")) & (F.col("n_expected") > 0) & (F.col("end_gps") + wait <= now_gps)
    return counts.join(ends.select("obs_id", "end_gps"), "obs_id", "left").select("obs_id", "n_expected", "n_present", "missing", F.coalesce(done, F.lit(False)).alias("ready"))


def retention_candidates(listing: DataFrame, now: Column, age_seconds: int, extensions: list[str], partial_age: int = 3600) -> DataFrame:
    """Files old enough to go: of a listed extension (any case, dot or not), or stale partial ones. Nothing is deleted."""
    wanted = [x.lower() if x.startswith(".") else "." + x.lower() for x in extensions]
    age = now.cast("timestamp").cast("double") - F.col("modification_time").cast("timestamp").cast("double")
    partial = F.substring_index("path", "/", -1).contains(".part") & (age > partial_age)
    listed = extension(F.col("path")).isin(wanted) & (age >= age_seconds) if wanted else F.lit(False)
    return listing.withColumn("reason", F.when(listed, "age").when(partial, "partial")).where("reason IS NOT NULL")


def release_hosts(downloads: DataFrame, col: str = "source") -> DataFrame:
    """Distinct hosts that hold an observation's files, from sources like ``user@host:/path``."""
    host = F.nullif(F.regexp_extract(F.col(col), r"^(?:[^@:/]+@)?([^@:/]+):/", 1), F.lit(""))
    return downloads.select("obs_id", host.alias("host")).where("host IS NOT NULL").distinct()
