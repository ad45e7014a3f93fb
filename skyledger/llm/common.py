"""Helpers shared by the operators: shared folder, written tables, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of input that a Python worker works on at a time (a larger row is alone). Spark bounds what it gets at a time
#: (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB by default).
BATCH_BYTES = 8 << 20

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def bounded(run: Run) -> Run:
    """``run`` for ``mapInArrow``, given batches of about ``BATCH_BYTES``, whatever the session's settings."""

    def smaller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                yield batch.slice(at, step)

    return lambda batches: run(smaller(batches))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset, as in local tests, a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_dir()
    return base.rstrip("/")


@lru_cache
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="skyledger-")


#: Paths made within each call of ``written_alone`` that is under way in this thread, outermost first.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES.get():
        scope.append(path)
    return path


def written_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, written; all other tables that were written on the way are deleted."""
    made: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        out = written(df := make(), name)
    finally:
        _SCOPES.reset(token)
    for path in made[:-1]:
        _delete(df.sparkSession, path)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    It cuts lineage and survives lost executors.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by ``written`` that nothing needs any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(out: DataFrame, name: str, *tables: DataFrame | None) -> DataFrame:
    """``out`` written, after which the written ``tables`` that it was made from are deleted."""
    out = written(out, name)
    for t in tables:
        if t is not None:
            discard(t)
    return out


#: The most bytes of a ``BitFilter``; one that would need more lets more through.
MAX_FILTER_BYTES = 16 << 20


class BitFilter:
    """A Bloom filter of 64-bit numbers, at most ``MAX_FILTER_BYTES`` large: it lets all of them through and few others.

    What it lets through is always joined exactly afterwards, so a filter that is too small costs time and changes no result.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @staticmethod
    def places(values: np.ndarray, words: int) -> np.ndarray:
        """Four bits for each value."""
        h = values.astype(np.uint64)
        for _ in range(2):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        step = (h >> np.uint64(32)) | np.uint64(1)
        return (h[None] + np.arange(4, dtype=np.uint64)[:, None] * step) % np.uint64(64 * words)

    def might_hold(self, values: np.ndarray) -> np.ndarray:
        at = self.places(values, len(self.bits))
        return ((self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)

    @classmethod
    def of(cls, values: DataFrame, n: int, bits_each: int = 16) -> BitFilter:
        """From the only column (bigint, no nulls) of ``values``, about ``n`` rows. Spark joins the bits; the filter alone comes to the driver."""
        words = max(1, min(MAX_FILTER_BYTES // 8, n * bits_each // 64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = cls.places(batch.column(0).to_numpy(zero_copy_only=False), words).ravel()
                word, row = np.unique(at >> np.uint64(6), return_inverse=True)
                bits = np.zeros(len(word), np.uint64)
                np.bitwise_or.at(bits, row, np.uint64(1) << (at & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])

        found = values.mapInArrow(bounded(run), "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        out = np.zeros(words, np.uint64)
        out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return cls(out)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component label of every node of an undirected graph.

    ``edges``: columns ``a`` and ``b`` of one orderable type; loops and repeats are
    allowed, rows with a null end are ignored. Returns ``node, label`` for nodes
    that occur in an edge; nodes of one component share a label, the least node
    of that component.

    Each round maps every node to the least node next to it and contracts the
    graph, so edges shrink fast when node keys are in random order (as digests
    are). Each round works on written tables; nothing is collected.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    live = written(edges.distinct(), "edges")
    labels: DataFrame | None = None
    for _ in range(max_rounds):
        if live.isEmpty():
            break
        ends = live.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(
            live.select(F.col("b").alias("node"), F.col("a").alias("next"))
        )
        hooks = written(ends.groupBy("node").agg(F.min("next").alias("next")).select("node", F.least("node", "next").alias("to")), "hooks")
        if labels is None:
            new = hooks.select("node", F.col("to").alias("label"))
        else:
            new = (
                labels.join(hooks.withColumnRenamed("node", "label"), "label", "left")
                .select("node", F.coalesce("to", "label").alias("label"))
            )
        new = written(new, "labels")
        mapped = (
            live.join(hooks.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(hooks.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        after = written(mapped, "edges")
        for old in (live, hooks, *([labels] if labels is not None else [])):
            discard(old)
        live, labels = after, new
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
