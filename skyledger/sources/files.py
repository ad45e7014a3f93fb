"""File listings, headers and manifests from file contents; report sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.exprs import basename, extension


def list_files(spark: SparkSession, root: str, pattern: str = "", recursive: bool = False, exclude: str = "") -> DataFrame:
    """``path, length, modification_time`` of files whose name ends in ``pattern`` and not in ``exclude``; contents aren't read.

    Spark's reader leaves out files of no bytes; those come from a listing table.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{pattern}").option("recursiveFileLookup", recursive).load(root)
    rows = files.select("path", "length", F.col("modificationTime").alias("modification_time"))
    return (rows.where(~basename(F.col("path")).endswith(exclude)) if exclude else rows).orderBy("path")


def subfile_headers(files: DataFrame, keys: list[str]) -> DataFrame:
    """``path`` and a column for each key from the first 4096 bytes: lines of two words; a key's first line counts, a missing key is null."""
    lines = F.split(F.decode(F.substring("content", 1, 4096), "ISO-8859-1"), "\n")
    pairs = F.filter(F.transform(lines, lambda x: F.split(F.trim(F.regexp_replace(x, "[\\s\\x00]+", " ")), " ")), lambda x: F.size(x) == 2)

    def first(key: str) -> Column:
        return F.get(F.filter("_p", lambda x: x[0] == key), F.lit(0))[1].alias(key.lower())

    return files.select("path", pairs.alias("_p")).select("path", *[first(k) for k in keys])


def md5_manifest(files: DataFrame) -> DataFrame:
    return files.select("path", F.length("content").cast("long").alias("size"), F.md5("content").alias("checksum"))


def multipart_etag(content: Column, chunk_bytes: int) -> Column:
    """Quoted MD5 of the chunks' MD5 digests and their number; of one chunk its MD5; of none an empty string."""
    n = F.ceil(F.length(content) / chunk_bytes).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.md5(F.substring(content, i * chunk_bytes + 1, F.lit(chunk_bytes))))
    many = F.concat(F.md5(F.unhex(F.array_join(parts, ""))), F.lit("-"), n.cast("string"))
    return F.concat(F.lit('"'), F.when(n == 0, "").when(n == 1, F.md5(content)).otherwise(many), F.lit('"'))


def etag_manifest(files: DataFrame, chunk_bytes: int) -> DataFrame:
    return files.select("path", multipart_etag(F.col("content"), chunk_bytes).alias("etag"))


def _opened(path: str):
    """A stream of a file's bytes in any store that Arrow reaches by its address."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    return store.open_input_stream(inner)


def read_heads(listing: DataFrame, length: int = 4096) -> DataFrame:
    """``path, content``: the first bytes of each listed file, for ``subfile_headers``; the rest isn't read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path in frame["path"]:
                with _opened(path) as stream:
                    out.append(stream.read(length))
            yield pd.DataFrame({"path": frame["path"], "content": out})

    return listing.select("path").mapInPandas(run, "path string, content binary")


def checksums(listing: DataFrame, chunk_bytes: int, piece: int = 4 << 20) -> DataFrame:
    """``path, size, checksum, etag`` of listed files of any size, read as streams in pieces: MD5, and the multipart tag of ``multipart_etag``.

    One file is one row's work: a listing is dealt over tasks by ``repartition`` on its path.
    """

    def one(path: str) -> tuple[int, str, str]:
        whole, part, digests, size, left = hashlib.md5(), hashlib.md5(), [], 0, chunk_bytes
        with _opened(path) as stream:
            while data := stream.read(min(piece, left)):
                whole.update(data)
                part.update(data)
                size += len(data)
                left -= len(data)
                if not left:
                    digests.append(part.digest())
                    part, left = hashlib.md5(), chunk_bytes
        if left < chunk_bytes:
            digests.append(part.digest())
        tag = "" if not digests else whole.hexdigest() if len(digests) == 1 else f"{hashlib.md5(b''.join(digests)).hexdigest()}-{len(digests)}"
        return size, whole.hexdigest(), f'"{tag}"'

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(path, *one(path)) for path in frame["path"]]
            yield pd.DataFrame(rows, columns=["path", "size", "checksum", "etag"])

    return listing.select("path").repartition("path").mapInPandas(run, "path string, size bigint, checksum string, etag string")


#: Media types of listed files.
MEDIA = {".png": "image/png", ".tsv": "text/tab-separated-values", ".txt": "text/plain"}


def plot_index(files: DataFrame, base_url: str) -> DataFrame:
    """``fitid, body``: a JSON manifest of each fit's plots and reports, by name. ``files``: ``fitid, path, length, modification_time, content, description``."""
    ext = extension(F.col("path"))
    size = lambda at: F.when((ext == ".png") & (F.length("content") >= 24), F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("bigint"))
    kind = F.coalesce(*[F.when(ext == k, F.lit(v)) for k, v in MEDIA.items()])
    entry = F.struct(
        basename(F.col("path")).alias("filename"), F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("fitid").cast("string"), F.lit("/"), basename(F.col("path"))).alias("url"),
        F.col("length").alias("size_bytes"), F.date_format("modification_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_modified"), kind.alias("content_type"),
        "description", size(17).alias("image_width"), size(21).alias("image_height"),
    )
    rows = files.where(ext.isin(*MEDIA)).select("fitid", entry.alias("e"))
    # a fit has a few dozen files
    body = F.struct(F.lit(1).alias("version"), F.lit(base_url).alias("base_url"), F.sort_array(F.collect_list("e")).alias("files"))
    return rows.groupBy("fitid").agg(F.to_json(body).alias("body"))


def upsert_plot_index(entries: DataFrame, new: DataFrame, generated_at: str) -> DataFrame:
    """Entries ``fitid, filename, image_width, image_height, version, ..`` and those of ``new`` that aren't there yet; width and height of version 1 are swapped."""
    swap = F.col("version") == 1
    fixed = entries.withColumns({"image_width": F.when(swap, F.col("image_height")).otherwise(F.col("image_width")), "image_height": F.when(swap, F.col("image_width")).otherwise(F.col("image_height"))})
    added = new.join(entries.select("fitid", "filename"), ["fitid", "filename"], "left_anti")
    return fixed.unionByName(added, allowMissingColumns=True).withColumn("version", F.lit(2)).withColumn("generated_at", F.lit(generated_at))


def write_tsv(df: DataFrame, path: str) -> None:
    """A report as tab-separated values with a header: ``fits.pivot_phase_fits`` for phase fits, ``fits.residual_report`` for residuals."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def transfer_stats(log: DataFrame) -> DataFrame:
    """By destination: transfers, failures, GB, GiB and mean Gbps (0 where no time passed)."""
    gb = F.col("bytes") / 1e9
    gbps = F.when(F.col("elapsed_sec") > 0, 8 * gb / F.col("elapsed_sec")).otherwise(0.0)
    return log.groupBy("destination").agg(
        F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("n_failed"), F.sum(gb).alias("gb"), (F.sum(gb) / 1.07374).alias("gib"), F.avg(gbps).alias("mean_gbps")
    )


def last_stats(lines: DataFrame) -> DataFrame:
    """Per run the last line that is JSON with a ``stats`` object: ``transfers, bytes, errors, elapsed_sec``."""
    stats = F.get_json_object("text", "$.stats")
    best = lines.groupBy("run").agg(F.max_by(stats, F.when(stats.isNotNull(), F.col("line_no"))).alias("s"))
    get = lambda k, t: F.get_json_object("s", f"$.{k}").try_cast(t)
    return best.select("run", get("transfers", "bigint").alias("transfers"), get("bytes", "bigint").alias("bytes"), get("errors", "bigint").alias("errors"), get("elapsedTime", "double").alias("elapsed_sec"))


def arrival_times(listing: DataFrame) -> DataFrame:
    """Files in the order in which they were seen, with the seconds since the one before of the same host."""
    w = Window.partitionBy("host").orderBy("seen_at", "path")
    return listing.withColumn("gap_sec", F.col("seen_at").cast("timestamp").cast("double") - F.lag(F.col("seen_at").cast("timestamp").cast("double")).over(w))
