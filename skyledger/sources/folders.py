"""Folders on a file system that all executors mount, as a data source: ``spark.read`` or ``readStream`` ``.format("folder")``.

Columns: ``path, length, modification_time, seen_at``; files of any size, empty ones too. Options: ``path`` (the root), ``pattern`` (a name's end; ``.*``: any),
``exclude`` (a name's end), ``recursive`` (true), ``depth`` (1: how deep folders are listed on the driver to make partitions, one for each; deeper ones are
walked by the tasks), ``settle_ms`` (1000). A stream's first batch is a scan of what is there; then come files whose inode changed since, so those moved in count with
whatever time they carry. Its offset is a time, so a restart goes on where the last batch ended. A file that is rewritten comes again (``streams.arrivals`` drops repeats).
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "path string, length bigint, modification_time timestamp, seen_at timestamp"


class Prefix(InputPartition):
    """One folder, with what lies below it or without, and the span of inode times (nanoseconds) that count."""

    def __init__(self, folder: str, below: bool, after: int, until: int) -> None:
        super().__init__(None)
        self.folder, self.below, self.after, self.until = folder, below, after, until


def _entries(folder: str) -> Iterator[os.DirEntry]:
    try:
        with os.scandir(folder) as found:
            yield from found
    except FileNotFoundError:  # gone since it was listed
        return


class _Lister:
    def __init__(self, options: dict) -> None:
        self.root = options["path"].removeprefix("file://").rstrip("/") or "/"
        self.pattern, self.exclude = options.get("pattern", ".*"), options.get("exclude", "")
        self.recursive, self.depth = options.get("recursive", "true").lower() == "true", int(options.get("depth", "1"))
        self.settle = int(options.get("settle_ms", "1000")) * 1_000_000

    def prefixes(self, after: int, until: int) -> list[Prefix]:
        if not os.path.isdir(self.root):
            raise FileNotFoundError(self.root)
        if not self.recursive:
            return [Prefix(self.root, False, after, until)]
        out, level = [], [self.root]
        for _ in range(self.depth):
            out += [Prefix(f, False, after, until) for f in level]
            level = sorted(e.path for f in level for e in _entries(f) if e.is_dir(follow_symlinks=False))
        return out + [Prefix(f, True, after, until) for f in level]

    def files(self, prefix: Prefix) -> Iterator[tuple]:
        todo, now = [prefix.folder], datetime.now(timezone.utc)
        while todo:
            for e in _entries(todo.pop()):
                if e.is_dir(follow_symlinks=False):
                    if prefix.below:
                        todo.append(e.path)
                    continue
                if (self.pattern != ".*" and not e.name.endswith(self.pattern)) or (self.exclude and e.name.endswith(self.exclude)):
                    continue
                try:
                    s = e.stat()
                except FileNotFoundError:
                    continue
                if prefix.after < s.st_ctime_ns <= prefix.until:
                    yield e.path, s.st_size, datetime.fromtimestamp(s.st_mtime, timezone.utc), now


class FolderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folder"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return FolderReader(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FolderStream(dict(self.options))


class FolderReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.lister = _Lister(options)

    def partitions(self) -> list[Prefix]:
        return self.lister.prefixes(-1, 1 << 62)

    def read(self, partition: Prefix) -> Iterator[tuple]:
        return self.lister.files(partition)


class FolderStream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.lister = _Lister(options)

    def initialOffset(self) -> dict:
        return {"until": -1}

    def latestOffset(self) -> dict:
        # inode times of the last moments may still be given to others
        return {"until": time.time_ns() - self.lister.settle}

    def partitions(self, start: dict, end: dict) -> list[Prefix]:
        return self.lister.prefixes(start["until"], end["until"])

    def read(self, partition: Prefix) -> Iterator[tuple]:
        return self.lister.files(partition)


def list_folder(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """All files below ``root``, those of zero bytes included."""
    spark.dataSource.register(FolderSource)
    return spark.read.format("folder").options(path=root, **options).load()


def watch_folder(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """A stream of the files below ``root``: first all that are there, then those that arrive."""
    spark.dataSource.register(FolderSource)
    return spark.readStream.format("folder").options(path=root, **options).load()
