"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations make the whole signature: the first, a hash, scatters shingles over
2^32 places; the second, shifted circularly by k places, gives coordinate k, the least
value over a document's shingles. Bands of coordinates are the buckets.

Documents with equal shingle sets become one node. In each bucket nodes are compared with
its least node only (a star, not all pairs), links are confirmed on full sets of word
tuples, and buckets whose nodes are all in one component are done. The next rounds compare the others
with a second node, a third and so on; once few pairs are left between different
components of a bucket, or after ``star_rounds``, those are compared in full, in blocks
of nodes where a bucket is large. So the components are those of all candidate pairs, while a group of
n near copies costs about n comparisons. With 40 bands of 6 a pair at similarity 0.8
shares no bucket with probability 5e-6, one at 0.9 with 1e-13.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import BitFilter, bounded, connected_components, discard, settled, written
from .embed_dedup import spanning_forest

MAX_REMEMBERED = 250_000
#: Buckets of at most so many nodes are compared pair by pair in the end, others in blocks.
SMALL_BUCKET = 16
#: Nodes of a block, and their shingles, at most on average (a longer text is a block of its own, or in one).
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 19
#: Shingles times coordinates worked on at once, in 4-byte numbers.
TILE = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``size`` words; the whole sequence if it is shorter; none without words."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)], strict=False))


class ShingleHasher:
    def __init__(self, size: int) -> None:
        self.size = size
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's shingles."""
        words, known = words_of(text), self.known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > MAX_REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - self.size + 1)
        out = np.full(n, len(h) if len(h) < self.size else self.size, np.uint64)
        for i in range(min(self.size, len(h))):
            out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return np.unique(out)


def circulant_signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Least value of each circular shift of the second permutation over the places of ``hashes``."""
    places = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    step = max(1, TILE // (4 * coordinates))
    for at in range(0, len(places), step):
        # a bijection of the 32-bit integers, taken at places shifted around the circle
        x = places[None, at : at + step] + shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(best, x.min(axis=1), out=best)
    return best


def text_digest(text: str | None) -> bytes:
    return hashlib.blake2b((text or "").encode(), digest_size=16).digest()


def _halves(digests: list[bytes]) -> list[pa.Array]:
    """128-bit digests as two columns of longs."""
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


SIGNATURES = "doc_id bigint, n_shingles bigint, node binary, t1 bigint, t2 bigint, bands array<bigint>"


def signatures(df: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """``SIGNATURES``: node is a 128-bit digest of the shingle set, null for an empty one; t1 and t2 are a digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(shingle)
        number = np.arange(bands, dtype=np.uint64)
        for batch in batches:
            n, nodes, digests, keys = [], [], [], []
            for text in batch["text"]:
                text = text.as_py()
                h = hasher(text)
                n.append(len(h))
                digests.append(text_digest(text))
                if not len(h):
                    nodes.append(None)
                    keys.append([])
                    continue
                nodes.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                key = number.copy()
                for column in circulant_signature(h, bands * rows).reshape(bands, rows).T:
                    key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(32)
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), *_halves(digests), pa.array(keys, pa.list_(pa.int64()))], names=names)

    names = [c.split()[0] for c in SIGNATURES.split(", ")]
    source = df.select(df[id_col].cast("bigint").alias("doc_id"), df[text_col].alias("text"))
    return source.mapInArrow(bounded(run), SIGNATURES)


def _texts(df: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """``node, text`` for each row of ``wanted`` (``node, t1, t2``), by the texts' digests, packed (see ``unpacked``) before any shuffle.

    Ids don't matter. A filter of the wanted digests, bounded in size, keeps most other texts out of the shuffle, and a task lets a text
    through once for as many copies as it has (of those it remembers); the join decides.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(BitFilter.of(wanted.select("t1"), wanted.count()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            digests = [text_digest(t.as_py()) for t in batch["text"]]
            may = shared.value.might_hold(np.frombuffer(b"".join(digests), np.int64)[::2])
            rows = []
            for i in np.flatnonzero(may).tolist():
                if digests[i] not in seen:
                    seen.add(digests[i])
                    rows.append(i)
            texts = [packer.compress((batch["text"][i].as_py() or "").encode()) for i in rows]
            yield pa.RecordBatch.from_arrays([*_halves([digests[i] for i in rows]), pa.array(texts, pa.binary())], names=["t1", "t2", "text"])
            if len(seen) > MAX_REMEMBERED:
                seen.clear()

    packed = df.select(df[text_col].alias("text")).mapInArrow(bounded(pack), "t1 bigint, t2 bigint, text binary")
    return packed.join(wanted, ["t1", "t2"]).dropDuplicates(["t1", "t2"]).select("node", "text")


def unpacked(text: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(text).decode()


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, set] = (None, set())
        for batch in batches:
            keep = []
            for a, ta, tb in zip(batch["a"], batch["ta"], batch["tb"], strict=True):
                if last[0] != a.as_py():
                    last = (a.as_py(), shingle_set(words_of(unpacked(ta.as_py())), shingle))
                mine, theirs = last[1], shingle_set(words_of(unpacked(tb.as_py())), shingle)
                both = len(mine & theirs)
                keep.append(100 * both >= percent * (len(mine) + len(theirs) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    both = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(bounded(run), "a binary, b binary")


def _linked_in_blocks(live: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between different parts of large buckets, block by block: a spanning forest of each two blocks' links.

    Nodes of a bucket are dealt by hash into blocks of about ``BLOCK_NODES`` nodes or ``BLOCK_SHINGLES`` shingles, and each two
    blocks are one group, so a bucket of n nodes makes n^2 / BLOCK_NODES rows and no task holds more than two blocks.
    """

    def run(group: pa.Table) -> pa.Table:
        nodes, parts, block = group["node"].to_pylist(), group["part"].to_pylist(), np.array(group["block"])
        hasher, raw = ShingleHasher(shingle), [unpacked(t) for t in group["text"].to_pylist()]
        sets = [hasher(t) for t in raw]
        size = np.array([len(x) for x in sets])
        values, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), size)
        # a shingle of one node alone is in no intersection
        shared = times[at] > 1
        column = (np.cumsum(times > 1) - 1)[at[shared]]
        owner, both = owner[shared], np.zeros((len(sets), len(sets)), np.float32)
        for first in range(0, int((times > 1).sum()), 4096):
            here = (column >= first) & (column < first + 4096)
            has = np.zeros((len(sets), 4096), np.float32)
            has[owner[here], column[here] - first] = 1
            both += has @ has.T
        union = size[:, None] + size[None, :] - both
        label = np.unique(np.array([p.hex() for p in parts]), return_inverse=True)[1]
        ok = (100 * both.astype(np.float64) >= percent * union) & (label[:, None] < label[None, :])
        if group["lo"][0].as_py() != group["hi"][0].as_py():
            ok &= block[:, None] != block[None, :]
        # nodes of one part are joined already
        parent = list(range(len(sets)))
        for p in np.unique(label):
            same = np.nonzero(label == p)[0]
            spanning_forest(np.full(len(same), same[0]), same, parent)
        edges = spanning_forest(*np.nonzero(ok), parent)
        full = {i: shingle_set(words_of(raw[i]), shingle) for e in edges for i in e}
        sure = [(i, j) for i, j in edges if 100 * len(full[i] & full[j]) >= percent * len(full[i] | full[j])]
        return pa.table({"a": pa.array([nodes[i] for i, _ in sure], pa.binary()), "b": pa.array([nodes[j] for _, j in sure], pa.binary())})

    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    counts = live.groupBy("key").agg(blocks.cast("int").alias("blocks"))
    rows = live.select("key", "node", "part").join(counts, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "node", "part")
    return rows.join(texts, "node").groupBy("key", "lo", "hi").applyInArrow(run, "a binary, b binary")


def near_duplicates(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 6,
    star_rounds: int = 3,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``df``.

    Linked are documents with ``100 * intersection >= percent * union`` of their sets of
    ``shingle``-word shingles; ``component_id`` is the least id reachable, ``kept`` marks
    the document with that id. Rows are told apart by what they hold, never by their ids: those with a null or shared id are compared as
    all others are. A null id is no component's id, unless the component has no other: then it is null and one of its rows is kept.
    Null or empty texts have an empty set and stand alone (kept). Repeated rows are all returned.
    Ids must be castable to bigint; other columns are ignored.
    """
    numbered = signatures(df, id_col, text_col, shingle, bands, rows).withColumn("row", F.monotonically_increasing_id())
    docs = written(numbered, "signatures")
    # one row for each distinct set; equal sets have equal bands, and any of their texts stands for them
    sets = docs.where("node IS NOT NULL").groupBy("node")
    sets = written(sets.agg(F.first("bands").alias("bands"), F.first("n_shingles").alias("n"), F.min(F.struct("t1", "t2")).alias("t")), "sets")
    keyed = sets.select("node", F.explode("bands").alias("key"))
    # only keys are counted; what few buckets hold several sets is joined
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = written(keyed.join(shared, "key").join(sets.select("node", "n"), "node"), "members")
    leaders = found.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("other")).where("leader <> other").select("key", "leader")
    members = written(found.join(leaders, "key").select("key", "node", "n", "leader"), "members")
    discard(found)
    wanted = written(sets.select("node", "t.t1", "t.t2").join(members.select("node").distinct(), "node", "left_semi"), "wanted")
    discard(sets)
    texts = written(_texts(df, text_col, wanted), "texts")
    discard(wanted)

    similar = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    links: DataFrame | None = None
    labels: DataFrame | None = None
    made = [docs, members, texts]
    live = members
    last = False
    for turn in range(star_rounds + 1):
        if turn:
            # what is left: buckets that still hold nodes of several components
            told = live.join(labels.withColumnRenamed("label", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
            several = told.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.min("node").alias("leader")).where("x <> y").select("key", "leader")
            live = written(told.drop("leader").join(several, "key"), "members")
            made.append(live)
            sizes = live.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum("n").alias("nodes"), F.sum(F.expr("n * (n - 1) div 2")).alias("pairs")).first()
            if not sizes["nodes"]:
                break
            # few pairs are left: compare them all; else another round of stars, which joins most nodes to some group
            last = turn == star_rounds or sizes["pairs"] <= 2 * sizes["nodes"]
        if not last:
            heads = live.where("node = leader").select("key", F.col("n").alias("m"), *(["part"] if turn else [])).withColumnsRenamed({"part": "head_part"})
            pairs = live.where("node <> leader").join(heads, "key").where(similar + (" AND part <> head_part" if turn else ""))
            pairs = pairs.select(F.col("leader").alias("a"), F.col("node").alias("b"))
        else:
            other = live.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("part").alias("other_part"))
            few = live.join(live.groupBy("key").count().where(F.col("count") <= SMALL_BUCKET).select("key"), "key", "left_semi")
            pairs = few.withColumnRenamed("node", "a").join(other, "key").where(f"a < b AND part <> other_part AND {similar}").select("a", "b")
        new = written(_verified(pairs.distinct(), texts, shingle, percent), "links")
        made.append(new)
        if last:
            many = live.join(live.groupBy("key").count().where(F.col("count") > SMALL_BUCKET).select("key"), "key", "left_semi")
            made.append(written(_linked_in_blocks(many, texts, shingle, percent), "links"))
            new = new.unionByName(made[-1])
        links = new if links is None else links.unionByName(new)
        if labels is not None:
            made.append(labels)
        labels = connected_components(links)
        if last:
            break
        # this round's leaders have met every other node of their buckets
        live = live.where("node <> leader").select("key", "node", "n", "leader")
    parts = docs.select("doc_id", "n_shingles", "node", "row").join(labels, "node", "left").withColumn("part", F.coalesce("label", "node"))
    least = parts.where("part IS NOT NULL").groupBy("part").agg(F.min("doc_id").alias("least"), F.min("row").alias("first"))
    out = parts.join(least, "part", "left").withColumn("component_id", F.coalesce("least", F.when(F.col("part").isNull(), F.col("doc_id"))))
    kept = F.when(F.col("part").isNull(), True).when(F.col("least").isNull(), F.col("row") == F.col("first")).otherwise(F.col("doc_id").eqNullSafe(F.col("least")))
    return settled(out.select("doc_id", "n_shingles", "component_id", kept.alias("kept")), "near_duplicates", labels, *made)


def op8(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents, shingle=2)
