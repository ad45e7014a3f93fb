"""Embedding near-duplicates by an epsilon grid order join.

Vectors of unit length are rotated to their principal axes (fitted on a bounded sample;
a rotation keeps all distances, so it bears on speed only) and cut into cells as wide
as epsilon on the leading axes. Sorted by cells they form a sequence; intervals of it
have a bounding box, and two intervals whose boxes are more than epsilon apart hold
no link. Intervals are split and joined recursively: parts of the sequence, blocks of a
part (joins of Spark tables), then halves of blocks inside a task. What is left is compared
by a bound on the leading axes (Cauchy-Schwarz on the rest), and what that lets
through by the cosine in double precision.

Vectors are scaled by powers of two, which changes no cosine, so that none overflows. Equal ones
are one class with a count. A task holds one block and meets its near blocks one by one, so a block travels once for
each near block and none is copied into pairs. It returns numbers of links and a spanning
forest of its links, never the links themselves, so a dense group of n vectors gives
about n rows for each pair of blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, connected_components, discard, settled, written

#: Bytes of a block's vectors in double precision; a task holds two blocks.
BLOCK_BYTES = 8 << 20
#: Vectors of a part of the sequence, at least, and near blocks that one task meets with a block, at most (about).
PART, PARTNERS = 8192, 32
LEAF = 512
LEADING = CELL_AXES = 16
#: The rotation is fitted on at most so many classes of vectors, those of least key.
SAMPLE = 20_000
SLACK = 1e-5
#: Cosines nearer to the threshold than this are decided by ``cosines`` alone.
CLOSE = 1e-9


def scaled(v: list | None) -> np.ndarray | None:
    """The vector times a power of two, its largest component between a half and 1; None for one that links with nothing."""
    x = np.array([np.nan if c is None else c for c in (v or [])], np.float64)
    if not len(x) or not np.isfinite(x).all() or not (top := np.abs(x).max()):
        return None
    return np.ldexp(x, -int(np.frexp(top)[1])) + 0.0


def vector_classes(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, key, dim, vec``: the scaled vector and a digest of its components; null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [scaled(v.as_py()) for v in batch["v"]]
            keys = [None if x is None else hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in vectors]
            dims = [None if x is None else len(x) for x in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(vectors, pa.list_(pa.float64()))], names=["vec_id", "key", "dim", "vec"]
            )

    source = df.select(df[id_col].cast("bigint").alias("vec_id"), df[vector_col].cast("array<double>").alias("v"))
    return source.mapInArrow(bounded(run), "vec_id bigint, key binary, dim int, vec array<double>")


def packed(v: np.ndarray) -> bytes:
    """Rows of vectors as bytes: in single precision where that holds them exactly."""
    single = v.astype(np.float32)
    return single.tobytes() if (single == v).all() else v.tobytes()


def unpacked(raw: bytes, n: int, dim: int) -> np.ndarray:
    """The ``n`` vectors of ``dim`` components behind ``packed``."""
    return np.frombuffer(raw, np.float32 if len(raw) == 4 * n * dim else np.float64).reshape(n, dim).astype(np.float64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of ``a`` with rows of ``b``, always by this one expression."""
    return np.einsum("nd,nd->n", a, b) / np.sqrt(np.einsum("nd,nd->n", a, a)) / np.sqrt(np.einsum("nd,nd->n", b, b))


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose columns are the axes of the vectors' scatter, largest first."""
    x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.linalg.eigh(np.cov(x, rowvar=False).reshape(x.shape[1], x.shape[1]))[1][:, ::-1]


def box_gap(lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> float:
    return float(np.sqrt((np.maximum(0.0, np.maximum(lo_a - hi_b, lo_b - hi_a)) ** 2).sum()))


def join_blocks(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked rows of ``a`` and ``b``, by leaves of the recursion; each pair once if both are the ``same`` block."""
    ua, ub = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    epsilon = math.sqrt(2 - 2 * threshold) + SLACK
    lead_a, lead_b = ((u @ axes)[:, :LEADING].astype(np.float32) for u in (ua, ub))
    rest_a, rest_b = (np.sqrt(np.maximum(0, 1 - (x.astype(np.float64) ** 2).sum(axis=1))).astype(np.float32)[:, None] for x in (lead_a, lead_b))
    # the last column pair multiplies to the bound on what the other axes can add
    left, right = np.hstack([lead_a, rest_a]), np.hstack([lead_b, rest_b])
    boxes: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(which: int, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        if (which, i, j) not in boxes:
            x = (lead_a, lead_b)[which][i:j]
            boxes[which, i, j] = x.min(axis=0), x.max(axis=0)
        return boxes[which, i, j]

    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if i >= j or k >= m or (same and k >= j) or box_gap(*box(0, i, j), *box(1, k, m)) > epsilon:
            continue
        if max(j - i, m - k) > LEAF:
            h, g = ((i + j) // 2, (k + m) // 2)
            todo += [(x, y, z, w) for x, y in ((i, h), (h, j)) for z, w in ((k, g), (g, m))]
            continue
        bound = left[i:j] @ right[k:m].T
        if (hit := bound >= threshold - SLACK).any():
            x, y = np.nonzero(hit)
            if len(x) > 0.02 * hit.size:
                c = (ua[i:j] @ ub[k:m].T)[x, y]
                close = np.abs(c - threshold) < CLOSE
                c[close] = cosines(a[i + x[close]], b[k + y[close]])
            else:
                c = cosines(a[i + x], b[k + y])
            fine = c >= threshold
            x, y = x[fine] + i, y[fine] + k
            if same:
                x, y = x[x > y], y[x > y]
            if len(x):
                yield x, y


def spanning_forest(x: np.ndarray, y: np.ndarray, parent: list[int]) -> list[tuple[int, int]]:
    """Those of the links (x, y) that join two trees; ``parent`` holds the trees."""

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(x.tolist(), y.tolist(), strict=True):
        if (p := root(i)) != (q := root(j)):
            parent[max(p, q)] = min(p, q)
            out.append((i, j))
    return out


def _blocks(classes: DataFrame, axes: np.ndarray, threshold: float, n: int, block: int) -> DataFrame:
    """Blocks of the sequence in epsilon grid order: ``part, block, lo, hi, keys, counts, vectors``, one row for each."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(axes)
    epsilon = math.sqrt(2 - 2 * threshold)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.array(batch["vec"].to_pylist(), np.float64).reshape(batch.num_rows, len(shared.value))
            c = np.floor((v / np.linalg.norm(v, axis=1, keepdims=True)) @ shared.value[:, :CELL_AXES] / epsilon).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(c), pa.list_(pa.int64()))], names=[*batch.schema.names, "cell"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        keys: list = []
        counts: list = []
        vectors: list = []

        def row() -> pa.RecordBatch:
            v = np.array(vectors, np.float64)
            lead = ((v / np.linalg.norm(v, axis=1, keepdims=True)) @ shared.value)[:, :LEADING]
            values = [part, number, lead.min(axis=0), lead.max(axis=0), keys, counts, packed(v)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            for k, c, v in zip(batch["key"].to_pylist(), batch["copies"].to_pylist(), batch["vec"].to_pylist(), strict=True):
                keys.append(k)
                counts.append(c)
                vectors.append(v)
                if len(keys) == block:
                    yield row()
                    keys, counts, vectors, number = [], [], [], number + 1
        if keys:
            yield row()

    names = ["part", "block", "lo", "hi", "keys", "counts", "vectors"]
    types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // min(PART, 2 * block)))
    celled = classes.select("key", "copies", "vec").mapInArrow(bounded(cells), "key binary, copies bigint, vec array<double>, cell array<bigint>")
    # a cell may hold any share of the vectors, so keys take part in the order
    ordered = celled.repartitionByRange(parts, "cell", "key").sortWithinPartitions("cell", "key")
    return ordered.mapInArrow(bounded(pack), "part int, block int, lo array<double>, hi array<double>, keys array<binary>, counts array<bigint>, vectors binary")


def _near_boxes(epsilon: float) -> str:
    gap = "aggregate(sequence(1, size(lo)), 0D, (s, i) -> s + pow(greatest(0D, lo[i - 1] - hi2[i - 1], lo2[i - 1] - hi[i - 1]), 2))"
    return f"sqrt({gap}) <= {epsilon!r}"


def _block_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of blocks whose boxes are near: first of parts, by the cells they span on the leading axis, then of their blocks."""
    boxes = blocks.select("part", "block", "lo", "hi")
    axes = range(LEADING)
    low = F.array(*[F.min(F.try_element_at("lo", F.lit(i + 1))) for i in axes])
    high = F.array(*[F.max(F.try_element_at("hi", F.lit(i + 1))) for i in axes])
    parts = boxes.groupBy("part").agg(F.filter(low, lambda x: x.isNotNull()).alias("lo"), F.filter(high, lambda x: x.isNotNull()).alias("hi"))
    span = lambda more: F.sequence(F.floor(F.col("lo")[0] / epsilon) - more, F.floor(F.col("hi")[0] / epsilon) + more)
    left = parts.select("part", "lo", "hi", F.explode(span(0)).alias("cell"))
    right = parts.select(F.col("part").alias("part2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.explode(span(1)).alias("cell"))
    near = left.join(right, "cell").where("part <= part2").where(_near_boxes(epsilon)).select("part", "part2").distinct()
    two = near.join(boxes, "part").join(boxes.select(F.col("part").alias("part2"), F.col("block").alias("block2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2")), "part2")
    return two.where("part < part2 OR block <= block2").where(_near_boxes(epsilon)).select("part", "block", "part2", "block2")


def _links(blocks: DataFrame, axes: np.ndarray, threshold: float) -> DataFrame:
    """``key, links, other``: numbers of links of each class (``other`` null), and links of a spanning forest (``links`` null)."""
    shared = blocks.sparkSession.sparkContext.broadcast(axes)

    def meet(mine: dict, theirs: dict, same: bool) -> pa.RecordBatch:
        a, b, ka, kb = mine["v"], theirs["v"], mine["keys"], theirs["keys"]
        copies_a, copies_b = np.array(mine["counts"]), np.array(theirs["counts"])
        links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        shift = 0 if same else len(a)
        parent = list(range(shift + len(b)))
        edges: list[tuple[int, int]] = []
        for x, y in join_blocks(a, b, shared.value, threshold, same):
            np.add.at(links_a, x, copies_b[y])
            np.add.at(links_b, y, copies_a[x])
            edges += spanning_forest(x, y + shift, parent)
        if same:
            links_a, links_b = links_a + links_b, links_b[:0]
        key = [ka[i] for i in np.nonzero(links_a)[0]] + [kb[i] for i in np.nonzero(links_b)[0]]
        count = [*links_a[links_a > 0].tolist(), *links_b[links_b > 0].tolist()]
        key += [ka[i] for i, _ in edges]
        other = [None] * len(count) + [kb[j - shift] for _, j in edges]
        count += [None] * len(edges)
        return pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(count, pa.int64()), pa.array(other, pa.binary())], names=["key", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict = {}
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch[n][r].as_py() for n in batch.schema.names}
                row["v"] = unpacked(row.pop("vectors"), len(row["keys"]), len(shared.value))
                if row["first"]:
                    mine = row
                    if not row["chunk"]:
                        yield meet(mine, mine, True)
                else:
                    yield meet(mine, row, False)

    pairs = _block_pairs(blocks, math.sqrt(2 - 2 * threshold) + SLACK)
    chunks = pairs.groupBy("part", "block").agg(F.ceil(F.count("*") / PARTNERS).alias("chunks"))
    pairs = pairs.join(chunks, ["part", "block"]).withColumn("chunk", F.pmod(F.xxhash64("part2", "block2"), "chunks").cast("int"))
    payload = ["keys", "counts", "vectors"]
    # chunk 0 is always there, as every block meets itself
    groups = pairs.select("part", "block", "chunk").unionByName(blocks.select("part", "block", F.lit(0).alias("chunk"))).distinct()
    first = groups.join(blocks.select("part", "block", *payload), ["part", "block"]).withColumn("first", F.lit(True))
    second = blocks.select(F.col("part").alias("part2"), F.col("block").alias("block2"), *payload)
    second = pairs.where("part <> part2 OR block <> block2").join(second, ["part2", "block2"]).withColumn("first", F.lit(False))
    rows = first.unionByName(second.select(*first.columns)).repartition("part", "block", "chunk").sortWithinPartitions("part", "block", "chunk", F.desc("first"))
    return rows.mapInArrow(bounded(run), "key binary, links bigint, other binary")


def embedding_duplicates(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, block: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``.

    Linked are vectors with cosine >= ``threshold`` in double precision, whatever their size. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, and so do
    vectors of different lengths with each other. Equal vectors, and repeated rows, link as
    any others do. Rows with a null id are returned; a component's id is the least non-null one. Other columns are ignored.
    ``block``: vectors of a block; without it as many as take ``BLOCK_BYTES``.
    """
    spark = df.sparkSession
    rows = written(vector_classes(df, id_col, vector_col), "vectors")
    classes = written(rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("vec").alias("vec"), F.first("dim").alias("dim")), "classes")
    told: list[DataFrame] = []
    # lengths of vectors, nearly always one; a lone class has no links to others
    for dim, n in sorted((r["dim"], r["count"]) for r in classes.groupBy("dim").count().where("count > 1").collect()):
        mine = classes.where(F.col("dim") == dim)
        sample = [r["vec"] for r in mine.orderBy("key").limit(SAMPLE).select("vec").collect()]
        axes = principal_axes(np.array(sample))
        blocks = written(_blocks(mine, axes, threshold, n, block or max(LEAF, BLOCK_BYTES // (8 * dim))), "blocks")
        told.append(written(_links(blocks, axes, threshold), "links"))
        discard(blocks)
    found = reduce(DataFrame.unionByName, told) if told else spark.createDataFrame([], "key binary, links bigint, other binary")
    labels = connected_components(found.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    counts = found.where("other IS NULL").groupBy("key").agg(F.sum("links").alias("links"))
    known = (
        classes.select("key", "copies", "least").join(counts, "key", "left").join(labels.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "key").alias("part"))
    )
    ids = known.groupBy("part").agg(F.min("least").alias("component_id"))
    known = known.join(ids, "part").select("key", "n_links", "component_id")
    out = rows.select("vec_id", "key").join(known, "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    out = out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    return settled(out, "embedding_duplicates", rows, classes, labels, *told)


def op2(embeddings: DataFrame) -> DataFrame:
    return embedding_duplicates(embeddings)


def op2_sql(threshold: float = 0.9) -> str:
    """The same rows in DuckDB's SQL: all pairs, and components by a recursive walk."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
finite AS (SELECT vec_id, e, list_max(list_transform(e, lambda x: abs(x))) AS top FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
fine AS (SELECT vec_id, list_transform(e, lambda x: x / pow(2.0, floor(log2(top)))) AS e FROM finite WHERE top > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= {threshold}),
walk AS (SELECT vec_id AS n, vec_id AS r FROM v UNION SELECT link.b, walk.r FROM walk JOIN link ON link.a = walk.n),
part AS (SELECT n, min(r) AS component_id FROM walk GROUP BY n),
many AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN part ON n = vec_id LEFT JOIN many ON a = vec_id"""
