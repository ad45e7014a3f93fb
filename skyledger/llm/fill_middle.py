"""Fill-in-the-middle texts by secondary sort.

A text is cut into units (lines, or characters) at two drawn places; prefix, middle and suffix are then told apart by
sentinels and put in another order. Each text leaves its task as pieces, runs of whole units, keyed by the document and
by the place in the output. Spark deals the pieces by document and sorts them within partitions, so that a task reads
each output from start to end and holds one piece at a time; its digest grows piece by piece. The output's pieces are then
sorted once more, within the same partitions and without another exchange, by the place that the sentinels and the form give
them in the text, and the restored text's digest grows in the same way.

A document's key is a digest of its id and text, with the partition that it was read from: it is the same when a task is
repeated, rows that share an id stay apart, and equal rows, which are interchangeable, are spread as their partitions are.
Pieces are packed before the exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import bounded

#: Bytes of a piece, at most; a longer unit is cut.
PIECE_BYTES = 256 << 10
#: Marks of prefix, suffix and middle.
SENTINELS = (b"<P>", b"<S>", b"<M>")
#: Order of prefix (0), suffix (1) and middle (2) in the output, by form.
ORDER = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
#: Rank of prefix, suffix and middle in the text.
RANK = (0, 2, 1)

HEAD = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
PIECES = f"key binary, part int, pos bigint, data binary, {HEAD}"
OUTPUTS = f"{PIECES}, output_sha256 string, output binary"


def unit_ends(raw: np.ndarray, unit: str) -> np.ndarray:
    """0 and the end of each unit of a text's bytes: a line with its newline, or a code point."""
    if unit == "line":
        ends = np.flatnonzero(raw == 10) + 1
    elif unit == "character":
        ends = np.flatnonzero((raw & 0xC0) != 0x80)[1:]
    else:
        raise ValueError(f"unit must be line or character, not {unit}")
    last = [len(raw)] if len(raw) and (not len(ends) or ends[-1] < len(raw)) else []
    return np.concatenate([[0], ends, last]).astype(np.int64)


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers of a document; those of a null id are of the word null."""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def runs(ends: np.ndarray, start: int, stop: int, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole units of ``start`` to ``stop``, of at most ``size`` bytes; a longer unit is cut."""
    while start < stop:
        to = int(ends[np.searchsorted(ends, start + size, "right") - 1])
        to = min(stop, to if to > start else start + size)
        yield start, to
        start = to


def _code_points(raw: np.ndarray) -> int:
    return int(((raw & 0xC0) != 0x80).sum())


def _split(df: DataFrame, id_col: str, text_col: str, unit: str, seed: int, fim_percent: int, spm_percent: int, piece_bytes: int) -> DataFrame:
    """The pieces (``PIECES``) of every row; the one at place 0 carries the columns of ``HEAD``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, packer = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text = text.as_py() or b""
                key = hashlib.blake2b(b"%d:" % doc_id + text if doc_id is not None else b":" + text, digest_size=16).digest()
                raw = np.frombuffer(text, np.uint8)
                ends = unit_ends(raw, unit)
                n = len(ends) - 1
                h = draws(seed, doc_id)
                a, b = (int(ends[x]) for x in sorted((h[0] % (n + 1), h[1] % (n + 1))))
                if not n or h[2] % 100 >= fim_percent or any(s in text for s in SENTINELS):
                    head, sections = (doc_id, n, "plain", None, None), [(b"", 0, len(text))]
                else:
                    form = "spm" if h[3] % 100 < spm_percent else "psm"
                    places = ((0, a), (b, len(text)), (a, b))
                    head, sections = (doc_id, n, form, _code_points(raw[:a]), _code_points(raw[a:b])), [(SENTINELS[s], *places[s]) for s in ORDER[form]]
                pos = 0
                for mark, start, stop in sections:
                    for at, to in list(runs(ends, start, stop, piece_bytes)) or [(start, start)]:
                        data = packer.compress(mark + text[at:to])
                        rows.append((key, part, pos, data, *(head if not pos else (None,) * 5)))
                        pos, mark, held = pos + 1, b"", held + len(data)
                if held > 4 << 20:
                    yield _batch(rows, PIECES)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, PIECES)

    return df.select(df[id_col].cast("bigint").alias("doc_id"), df[text_col].cast("binary").alias("text")).mapInArrow(bounded(run), PIECES)


#: Arrow types of the columns' types above.
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[c.split() for c in schema.split(", ")], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def _emitted(rows: Iterator[tuple[tuple, int]], schema: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of (row, bytes) of about ``size`` bytes or 4096 rows."""
    out: list[tuple] = []
    held = 0
    for row, n in rows:
        out.append(row)
        held += n
        if held > size or len(out) >= 4096:
            yield _batch(out, schema)
            out, held = [], 0
    if out:
        yield _batch(out, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Pieces as tuples, in their order; equal rows of one partition share key and places."""
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _assemble(with_output: bool) -> Callable:
    """Reads outputs from start to end. Every piece goes on with its place in the text; a document's last row has place -1,
    its head and the output's digest, once for each of the equal rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        def done(key, part, head, digest, chunks, copies):
            whole = b"".join(chunks) if with_output else None
            for _ in range(copies):
                yield (key, part, -1, None, *head, digest.hexdigest(), whole), len(whole or b"") + 200

        def rows() -> Iterator[tuple[tuple, int]]:
            now = head = digest = None
            last, section, copies, chunks = -1, 0, 0, []
            for key, part, pos, data, *more in _pieces(batches):
                if now != (key, part):
                    if now:
                        yield from done(*now, head, digest, chunks, copies)
                    now, head, digest, last, section, copies, chunks = (key, part), tuple(more), hashlib.sha256(), -1, 0, 0, []
                copies += not pos
                if pos == last:
                    continue
                last, piece = pos, unpack(data)
                digest.update(piece)
                if with_output:
                    chunks.append(piece)
                if head[2] != "plain" and piece[:3] in SENTINELS:
                    section = RANK[SENTINELS.index(piece[:3])]
                yield (key, part, (section << 40) | pos, data, None, None, head[2], None, None, None, None), len(data) + 100
            if now:
                yield from done(*now, head, digest, chunks, copies)

        yield from _emitted(rows(), OUTPUTS)

    return bounded(run)


RESULT = f"{HEAD}, output_sha256 string, restored_sha256 string, output binary"


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads texts from start to end out of their outputs' pieces, sentinels taken off."""
    unpack = zstandard.ZstdDecompressor().decompress

    def rows() -> Iterator[tuple[tuple, int]]:
        now, ready, digest = None, [], None
        for key, part, pos, data, *more in _pieces(batches):
            if now != (key, part):
                for head in ready:
                    yield (*head[:6], digest.hexdigest(), head[6]), len(head[6] or b"") + 200
                now, ready, digest = (key, part), [], hashlib.sha256()
            if pos < 0:
                ready.append(more)
                continue
            piece = unpack(data)
            digest.update(piece[3:] if more[2] != "plain" and piece[:3] in SENTINELS else piece)
        for head in ready:
            yield (*head[:6], digest.hexdigest(), head[6]), len(head[6] or b"") + 200

    yield from _emitted(rows(), RESULT)


def fill_in_middle(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    seed: int = 7,
    fim_percent: int = 100,
    spm_percent: int = 50,
    piece_bytes: int = PIECE_BYTES,
    with_output: bool = True,
) -> DataFrame:
    """One row for each row of ``df``: ``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, output``.

    ``n`` counts the text's units, ``form`` is psm, spm or plain: plain are empty and null texts, those that hold a sentinel
    and ``100 - fim_percent`` in a hundred others. ``output`` (binary, UTF-8; null unless ``with_output``) is the text in its new
    order. ``restored_sha256`` is of the text put together again from the output's pieces. Ids are cast to bigint; rows with a null id
    share one draw; equal rows each have their row; other columns are ignored, whatever their names. An empty table gives no rows.
    """
    pieces = _split(df, id_col, text_col, unit, seed, fim_percent, spm_percent, piece_bytes)
    in_order = pieces.repartition("key", "part").sortWithinPartitions("key", "part", "pos")
    outputs = in_order.mapInArrow(_assemble(with_output), OUTPUTS).sortWithinPartitions("key", "part", "pos")
    return outputs.mapInArrow(bounded(_restore), RESULT)


def restore_texts(df: DataFrame, *, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """Adds ``restored``, the text (string) behind a whole ``output`` and its ``form``, by built-in functions; null where either is null."""
    out = F.col(output_col).cast("string")
    p, s, m = (F.locate(x.decode(), out) for x in SENTINELS)
    between = lambda a, b: F.substring(out, a + 3, F.when(b > 0, b - a - 3).otherwise(F.length(out)))
    psm = F.concat(between(p, s), F.substring(out, m + 3, F.length(out)), between(s, m))
    spm = F.concat(between(p, m), F.substring(out, m + 3, F.length(out)), between(s, p))
    return df.withColumn("restored", F.when(F.col(form_col) == "psm", psm).when(F.col(form_col) == "spm", spm).when(F.col(form_col) == "plain", out))


def op13(documents: DataFrame) -> DataFrame:
    return fill_in_middle(documents, with_output=False).drop("output")


def op13_sql(seed: int = 7) -> str:
    """The same rows in DuckDB's SQL; the text is restored by a pattern over the whole output."""
    h = ", ".join(f"CAST('0x' || h[{8 * i + 1}:{8 * i + 8}] AS BIGINT) AS h{i + 1}" for i in range(4))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l, {h} FROM d),
c AS (SELECT *, CAST(len(l) AS BIGINT) AS n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
  least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS lo, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS hi FROM u),
s AS (SELECT *, coalesce(array_to_string(l[1:lo], ''), '') AS p, coalesce(array_to_string(l[lo + 1:hi], ''), '') AS m, coalesce(array_to_string(l[hi + 1:], ''), '') AS s FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM s)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(o) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN o WHEN 'psm' THEN regexp_replace(o, '^<P>(.*)<S>(.*)<M>(.*)$', '\1\3\2', 's') ELSE regexp_replace(o, '^<S>(.*)<P>(.*)<M>(.*)$', '\2\3\1', 's') END) AS restored_sha256 FROM o"""
