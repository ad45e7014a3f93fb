"""Vector codes by integer k-means over parts, on metric trees of balls.

Vectors are cut into equal parts; each part position has a codebook. The vectors of a batch form a block, written once. Of each part
position a block holds a tree made by the anchors hierarchy, middle-out: about sqrt(n) anchors, each of which took over from the others
the points that lie nearer to it, are merged upwards pair by pair into enclosing balls, and split downwards in the
same way. A ball caches its count, the sum of its points, its pivot (one of them) and its radius.

A round of k-means walks all trees of a block level by level. A ball comes with the list of entries that may own some of its
points, inherited from its parent; the entry nearest to the pivot strikes out those that are farther from every point of the ball, and
where it alone is left, the ball's cached sum counts as a whole. Only leaves that several entries share are taken point by point, against
what is left of their list. Entries are struck out by a margin that floating point can't spoil, and distances are compared as
integers, so codes and codebooks are exactly those of comparing all with all, ties included.

What leaves a task in a round is one sum for each entry met; what comes to the driver is the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, discard, written
from .ragged import gather

#: Vectors of a block, at most.
BLOCK = 8192
#: Points of a leaf, at most, unless they are all the same.
LEAF = 64
#: Labels whose sums are broadcast, at most; more are joined with hot ones spread.
LABELS = 100_000


def component_bound(dim: int) -> int:
    """Integer components must be smaller than this in size, so that a vector's squared distance fits a long."""
    return 1 << ((62 - max(1, dim - 1).bit_length()) // 2 - 1)


# --- trees -----------------------------------------------------------------


class Tree:
    """Balls over ``order``, the points' places: a ball is ``order[lo:hi]``, a node's children are at ``kids`` (-1: a leaf), the root comes first."""

    FIELDS = ("kids", "lo", "hi", "pivot", "radius", "sums")

    def __init__(self, order: np.ndarray, **fields: np.ndarray) -> None:
        self.order = order
        for name in self.FIELDS:
            setattr(self, name, fields[name])


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def anchors(points: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, owner): up to ``wanted`` points as anchors, and for each point the number of its nearest anchor.

    The next anchor is the point farthest from its own. Of an owner's points only those farther from it than half the way
    to the new anchor can change hands; the others aren't compared.
    """
    chosen = [0]
    owner = np.zeros(len(points), np.int64)
    far = _squared(points, points[0])
    while len(chosen) < wanted:
        new = int(far.argmax())
        if not far[new]:
            break
        apart = _squared(points[chosen], points[new])
        reach = np.flatnonzero(4 * far > apart[owner])
        mine = _squared(points[reach], points[new])
        closer = mine < far[reach]
        reach, mine = reach[closer], mine[closer]
        owner[reach], far[reach] = len(chosen), mine
        chosen.append(new)
    return np.array(chosen), owner


def _merged(centre: np.ndarray, reach: np.ndarray) -> list[tuple[int, int]]:
    """Pairs to join, by number, until one is left: each time the two balls whose common ball is smallest; new ones get the next numbers."""
    n = len(centre)
    total = 2 * n - 1
    at, size = np.zeros((total, centre.shape[1])), np.zeros(total)
    at[:n], size[:n] = centre, reach
    live, cost = np.zeros(total, bool), np.full((total, total), np.inf)
    live[:n] = True

    def priced(i: int) -> None:
        d = np.sqrt(_squared(at, at[i]))
        both = np.maximum(np.maximum(size, size[i]), (d + size + size[i]) / 2)
        both[~live] = np.inf
        both[i] = np.inf
        cost[i], cost[:, i] = both, both

    for i in range(n):
        priced(i)
    pairs = []
    for new in range(n, total):
        i, j = divmod(int(cost.argmin()), total)
        pairs.append((i, j))
        r, d = cost[i, j], float(np.sqrt(_squared(at[i], at[j])))
        at[new] = at[i] if not d else at[i] + (at[j] - at[i]) * min(1.0, max(0.0, (r - size[i]) / d))
        size[new] = r
        live[[i, j]], live[new] = False, True
        cost[[i, j]], cost[:, [i, j]] = np.inf, np.inf
        priced(new)
    return pairs


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of integer ``points``, middle-out."""
    order: list[np.ndarray] = []
    kids: list[tuple[int, int]] = []
    spans: list[tuple[int, int]] = []
    filled = 0

    def grow(node: int, places: np.ndarray) -> None:
        """Makes ``node`` the root over ``places``."""
        nonlocal filled
        mine = points[places]
        chosen, owner = anchors(mine, max(2, int(np.sqrt(len(places))))) if len(places) > leaf else (np.zeros(1, int), None)
        if len(chosen) == 1:
            order.append(places)
            spans[node] = (filled, filled + len(places))
            filled += len(places)
            return
        groups = [np.flatnonzero(owner == k) for k in range(len(chosen))]
        reach = np.sqrt(np.array([_squared(mine[g], mine[c]).max() for g, c in zip(groups, chosen, strict=True)], float))
        pairs = _merged(mine[chosen].astype(float), reach)

        def place(node: int, number: int) -> None:
            if number < len(chosen):
                grow(node, places[groups[number]])
                return
            first = len(kids)
            kids[node] = (first, first + 1)
            kids.extend([(-1, -1)] * 2)
            spans.extend([(0, 0)] * 2)
            for child, other in zip(kids[node], pairs[number - len(chosen)], strict=True):
                place(child, other)
            spans[node] = (spans[first][0], spans[first + 1][1])

        place(node, 2 * len(chosen) - 2)

    kids.append((-1, -1))
    spans.append((0, 0))
    grow(0, np.arange(len(points)))
    places = np.concatenate(order)
    lo, hi = (np.array(x) for x in zip(*spans, strict=True))
    in_order = points[places]
    before = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(in_order, axis=0)])
    sums = before[hi] - before[lo]
    # the pivot is the point nearest to the ball's middle
    pivot, radius = np.zeros((len(lo), points.shape[1]), np.int64), np.zeros(len(lo), np.int64)
    for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
        ball = in_order[a:b]
        pivot[i] = ball[_squared(ball, sums[i] / (b - a)).argmin()]
        radius[i] = _squared(ball, pivot[i]).max()
    return Tree(places, kids=np.array(kids), lo=lo, hi=hi, pivot=pivot, radius=radius, sums=sums)


# --- a round over a tree ---------------------------------------------------


def owners(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]:
    """(balls, points): whole balls with their owner, and single points (places) with theirs, together all points once."""
    between = np.sqrt(_squared(book[:, None], book[None]).astype(float))
    balls: list[tuple[np.ndarray, np.ndarray]] = []
    single: list[tuple[np.ndarray, np.ndarray]] = []
    front, lists, offsets = np.zeros(1, np.int64), np.arange(len(book)), np.array([0, len(book)])
    while len(front):
        lens = np.diff(offsets)
        row = np.repeat(np.arange(len(front)), lens)
        d = _squared(tree.pivot[front][row], book[lists])
        near, owner = _nearest(d, lists, offsets)
        # |x - near|^2 - |x - e|^2 is largest on the ball's far side: |p - near|^2 - |p - e|^2 + 2 r |near - e|
        gain = 2 * np.sqrt(tree.radius[front][row].astype(float)) * between[owner[row], lists]
        stay = (near[row] + gain) * (1 + 1e-9) + 1 >= d * (1 - 1e-9)
        stay |= lists == owner[row]
        count = np.add.reduceat(stay, offsets[:-1])
        whole = count == 1
        balls.append((front[whole], owner[whole]))
        lists, row = lists[stay & ~whole[row]], row[stay & ~whole[row]]
        rest = np.flatnonzero(~whole)
        offsets = np.concatenate([[0], np.cumsum(count[rest])])
        kids = tree.kids[front[rest]]
        is_leaf = kids[:, 0] < 0
        if is_leaf.any():
            nodes, at = front[rest][is_leaf], np.flatnonzero(is_leaf)
            n = tree.hi[nodes] - tree.lo[nodes]
            places = np.repeat(tree.lo[nodes] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            places = tree.order[places]
            mine, k = gather(lists, offsets, np.repeat(at, n))
            d = _squared(points[np.repeat(places, k)], book[mine])
            single.append((places, _nearest(d, mine, np.concatenate([[0], np.cumsum(k)]))[1]))
        inner = np.flatnonzero(~is_leaf)
        front = kids[inner].ravel()
        lists, k = gather(lists, offsets, np.repeat(inner, 2))
        offsets = np.concatenate([[0], np.cumsum(k)])
    return balls, single


def _nearest(d: np.ndarray, lists: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each run of candidates the least distance and the first entry that has it; entries ascend within a run."""
    least = np.minimum.reduceat(d, offsets[:-1])
    runs = np.repeat(np.arange(len(least)), np.diff(offsets))
    hits = np.flatnonzero(d == least[runs])
    first = np.unique(runs[hits], return_index=True)[1]
    return least, lists[hits[first]]


# --- blocks ----------------------------------------------------------------


def _packed(a: np.ndarray) -> bytes:
    """An array of integers in the smallest type that holds it, with that type's letter first."""
    kind = next(t for t in "bhiq" if a.size == 0 or (np.iinfo(t).min <= a.min() and a.max() <= np.iinfo(t).max))
    return kind.encode() + a.astype("<" + kind).tobytes()


def _unpacked(raw: bytes, width: int = 0) -> np.ndarray:
    a = np.frombuffer(raw, "<" + chr(raw[0]), offset=1).astype(np.int64)
    return a.reshape(-1, width) if width else a


BLOCKS = "vectors binary, trees array<binary>"


def _blocks(rows: DataFrame, label_type: str, dim: int, parts: int, block: int) -> DataFrame:
    """Written blocks of ``rows`` (``vec_id, label, vec``, array of doubles): ids, labels, integer vectors and a tree for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for at in range(0, batch.num_rows, block):
                some = batch.slice(at, block)
                vectors = np.floor(some["vec"].flatten().to_numpy(zero_copy_only=False) * 256).astype(np.int64).reshape(-1, dim)
                trees = []
                for p in range(parts):
                    t = build_tree(vectors[:, p * dim // parts : (p + 1) * dim // parts])
                    trees += [_packed(x) for x in (t.order, *(getattr(t, f) for f in Tree.FIELDS))]
                one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                yield pa.RecordBatch.from_arrays([one(some["vec_id"]), one(some["label"]), pa.array([_packed(vectors)]), pa.array([trees], pa.list_(pa.binary()))], names=["vec_id", "label", "vectors", "trees"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= block:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                full = whole.num_rows // block * block
                yield from made(whole.slice(0, full))
                held = [whole.slice(full)] if full < whole.num_rows else []
        if held:
            yield from made(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return written(rows.mapInArrow(bounded(run), f"vec_id array<bigint>, label array<{label_type}>, {BLOCKS}"), "blocks")


def _trees(batch: pa.RecordBatch, r: int, dim: int, parts: int) -> tuple[np.ndarray, list[Tree]]:
    width, step = dim // parts, len(Tree.FIELDS) + 1
    raw = batch["trees"][r].as_py()
    shape = {"kids": 2, "pivot": width, "sums": width}
    trees = [Tree(_unpacked(raw[p * step]), **{f: _unpacked(raw[p * step + 1 + i], shape.get(f, 0)) for i, f in enumerate(Tree.FIELDS)}) for p in range(parts)]
    return _unpacked(batch["vectors"][r].as_py(), dim), trees


def _sums(blocks: DataFrame, books: np.ndarray, dim: int) -> DataFrame:
    """``part, entry, place, total, n`` over all blocks: sums of the parts that each entry owns, component by component."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)

        def told() -> pa.RecordBatch:
            p, e = np.nonzero(n)
            at = [np.repeat(x, width) for x in (p, e)]
            place = np.tile(np.arange(width), len(p))
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((at[0], pa.int32()), (at[1], pa.int32()), (place, pa.int32()), (total[p, e].ravel(), pa.int64()), (np.repeat(n[p, e], width), pa.int64()))], names=["part", "entry", "place", "total", "n"])

        for batch in batches:
            for r in range(batch.num_rows):
                vectors, trees = _trees(batch, r, dim, parts)
                for p, tree in enumerate(trees):
                    points = vectors[:, p * width : (p + 1) * width]
                    balls, single = owners(tree, points, books[p])
                    for nodes, own in balls:
                        np.add.at(n[p], own, tree.hi[nodes] - tree.lo[nodes])
                        np.add.at(total[p], own, tree.sums[nodes])
                    for places, own in single:
                        np.add.at(n[p], own, 1)
                        np.add.at(total[p], own, points[places])
                # a block's sums fit a long by far; many blocks' may not
                yield told()
                n[:], total[:] = 0, 0

    found = blocks.select("vectors", "trees").mapInArrow(bounded(run), "part int, entry int, place int, total bigint, n bigint")
    return found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def _coded(blocks: DataFrame, label_type: str, books: np.ndarray, dim: int) -> DataFrame:
    """``vec_id, label, code, error`` of every vector."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                vectors, trees = _trees(batch, r, dim, parts)
                codes = np.zeros((len(vectors), parts), np.int64)
                for p, tree in enumerate(trees):
                    balls, single = owners(tree, vectors[:, p * width : (p + 1) * width], books[p])
                    for nodes, own in balls:
                        n = tree.hi[nodes] - tree.lo[nodes]
                        places = np.repeat(tree.lo[nodes] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                        codes[tree.order[places], p] = np.repeat(own, n)
                    for places, own in single:
                        codes[places, p] = own
                error = _squared(vectors.reshape(-1, parts, width), books[np.arange(parts), codes]).sum(axis=1)
                text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch["vec_id"][r].values, batch["label"][r].values, pa.array(text, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(bounded(run), f"vec_id bigint, label {label_type}, code string, error bigint")


def _with_label_error(rows: DataFrame, n_labels: int, salts: int = 64) -> DataFrame:
    """Adds ``label_error``: errors summed over equal labels, nulls together. Sums that don't fit a long are null.

    The labels' sums are broadcast if they are few; else rows of a label are dealt to ``salts`` copies of its sum.
    """
    sums = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum")).withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if n_labels <= LABELS:
        out = rows.join(F.broadcast(sums), same)
    else:
        sums = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        out = rows.withColumn("_salt2", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int")).join(sums, same & (F.col("_salt") == F.col("_salt2")))
    return out.withColumn("label_error", F.expr("try_cast(_sum AS bigint)"))


def vector_codes(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id, code, error, label_error, codebooks_sha256``, codebooks): the codes of ``df``'s vectors and the entries, by part and entry.

    Components are floor(256 x). Vectors that are null, empty or hold null or non-finite components are left out. The first ``entries`` vectors by
    id (null ids last; equal ids by vector) begin the codebooks. A vector whose length isn't that of most (of those that the parts divide), or with a component
    of ``component_bound`` or more in size, can't be coded: its row has a null code and error. Null and shared ids, and equal rows, are rows
    like all others; other columns are ignored. An empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256, as two hexadecimal digits name them")
    label_type = df.schema[label_col].dataType.simpleString()
    vector: Column = F.col("vec")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("vec") > 0)
    rows = df.select(df[id_col].cast("bigint").alias("vec_id"), df[label_col].alias("label"), df[vector_col].cast("array<double>").alias("vec")).where(vector.isNotNull() & fine)
    ids = [F.col("vec_id").asc_nulls_last(), F.col("vec").asc()]
    head = rows.groupBy(F.size("vec").alias("n")).count().where(F.col("n") % parts == 0).orderBy(F.desc("count"), "n").first()
    dim = head["n"] if head else parts
    bound = component_bound(dim)
    small = (F.size("vec") == dim) & F.forall("vec", lambda x: F.abs(x) < bound / 256)
    first = rows.where(small).orderBy(*ids).limit(entries).select("vec").collect()
    if not first:
        none = rows.select("vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"), F.lit(None).cast("bigint").alias("label_error"), F.lit(hashlib.sha256().hexdigest()).alias("codebooks_sha256"))
        return none, np.zeros((parts, 0, dim // parts), np.int64)
    books = np.floor(np.array([r["vec"] for r in first]) * 256).astype(np.int64).reshape(len(first), parts, -1).swapaxes(0, 1).copy()
    blocks = _blocks(rows.where(small), label_type, dim, parts, block)
    for _ in range(rounds):
        # as many rows as the codebooks have numbers
        for r in _sums(blocks, books, dim).collect():
            books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = written(_coded(blocks, label_type, books, dim), "codes")
    discard(blocks)
    rest = rows.where(~small).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    coded = coded.unionByName(rest)
    out = _with_label_error(coded, coded.select("label").distinct().count())
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), books


def op12(embeddings: DataFrame) -> DataFrame:
    return vector_codes(embeddings)[0]


def op12_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The same rows in DuckDB's SQL, all parts against all entries."""
    assign = "(SELECT v.vec_id, v.part, v.p, min(list_sum(list_transform(list_zip(v.p, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + c.k) AS best FROM p v JOIN {c} c USING (part) GROUP BY ALL)"
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED {assign.format(c=f'c{i}')}")
        steps.append(f"s{i} AS (SELECT part, best % 256 AS k, j, CAST(sum(p[j]) AS BIGINT) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(p) + 1)) AS j FROM a{i}) GROUP BY ALL)")
        steps.append(f"m{i} AS (SELECT part, k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM s{i} GROUP BY ALL)")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT part, k, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} m USING (part, k))")
    last = f"c{rounds}"
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, e[part * len(e) // {parts} + 1:(part + 1) * len(e) // {parts}] AS p FROM (SELECT *, unnest(range(0, {parts})) AS part FROM v)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS k, p AS c FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})),
{", ".join(steps)},
f AS {assign.format(c=last)},
e AS (SELECT vec_id, string_agg(lower(printf('%02x', best % 256)), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM f GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, k)) AS h FROM {last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM e JOIN v USING (vec_id), h"""
