"""Packing of documents into sequences by vector best-fit.

A sequence is a bin with several capacities: tokens, documents and attention cost (the sum of its pieces' squared lengths).
Pieces are taken in order of falling length; each goes into the open bin that has room for it under every capacity and
scores best: the least weighted norm of what would be left (``norm``), or the least weighted dot product of demand and residual
(``dot``). Where no bin has room a new one opens.

All pieces of one length ask for the same, and putting one into the best bin leaves that bin the best, since both scores fall
with the residual. So each length is placed at once: bins in order of score, each filled as far as it goes. The result is
that of one piece after the other.

Only ids, lengths and checksums are dealt out, in groups of about ``GROUP`` pieces, each packed in one task. Sequences that a group leaves
with room to spare are taken apart, and their pieces are packed again together with those of other groups, as long as that saves sequences.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, settled, written
from .ragged import kept, portions
from .token_output import WordTokenizer

#: Pieces of a group, on average.
GROUP = 8192
#: Repacking rounds at most; a round follows only while the last one saved sequences.
ROUNDS = 4
#: A sequence with at most this share of its tokens free is left as it is.
SPARE = 1 / 128


class Capacities:
    """What a sequence may hold; ``weights`` of tokens, documents and attention cost count in the scores."""

    def __init__(self, tokens: int = 2048, documents: int | None = None, cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.1, 0.1)) -> None:
        # beyond these, a capacity can't bind before the tokens' does
        self.limits = np.array([tokens, documents or tokens, cost or tokens**2], np.int64)
        if (self.limits < 1).any():
            raise ValueError("every capacity must be at least 1")
        self.weights = np.array(weights, float)

    @property
    def piece(self) -> int:
        """Tokens of the longest piece that fits."""
        return min(int(self.limits[0]), math.isqrt(int(self.limits[2])))


def best_fit(lengths: np.ndarray, caps: Capacities, rule: str = "norm") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, given in order of falling length, and the tokens left in each bin."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule must be norm or dot, not {rule}")
    left = np.zeros((64, 3), np.int64)
    n_bins = 0
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    values, starts, counts = np.unique(-lengths, return_index=True, return_counts=True)
    for length, at, n in zip((-values).tolist(), starts.tolist(), counts.tolist(), strict=True):
        demand = np.array([length, 1, length * length], np.int64)
        open_bins = left[:n_bins]
        fit = np.flatnonzero((open_bins >= demand).all(axis=1))
        rest = open_bins[fit]
        if rule == "norm":
            score = (((rest - demand) / caps.limits) ** 2) @ caps.weights
        else:
            score = (rest / caps.limits * (demand / caps.limits)) @ caps.weights
        chosen = fit[np.argsort(score, kind="stable")]
        room = (left[chosen] // demand).min(axis=1)
        each = int((caps.limits // demand).min())
        if not each:
            raise ValueError(f"a piece of {length} tokens fits into no sequence")
        missing = max(0, n - int(room.sum()))
        new = -(-missing // each)
        while n_bins + new > len(left):
            left = np.concatenate([left, np.zeros_like(left)])
        left[n_bins : n_bins + new] = caps.limits
        chosen, room = np.concatenate([chosen, np.arange(n_bins, n_bins + new)]), np.concatenate([room, np.full(new, each)])
        n_bins += new
        taken = np.minimum(room, np.maximum(0, n - (np.cumsum(room) - room)))
        k = np.arange(n) - np.repeat(np.cumsum(taken) - taken, taken)
        mine = np.repeat(chosen, taken)
        bins[at : at + n], offsets[at : at + n] = mine, caps.limits[0] - left[mine, 0] + k * length
        left[chosen] -= taken[:, None] * demand
    return bins, offsets, left[:n_bins, 0]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(df: DataFrame, make_encoder: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]], longest: int, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every text's ids in pieces of at most ``longest``: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for batch in batches:
            at = 0
            for texts in portions(t.as_py() or "" for t in batch["text"]):
                ids, lens = encode(texts)
                ids = ids.astype("<u4")
                n = -(-lens // longest)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = piece * longest
                length = np.minimum(longest, np.repeat(lens, n) - start)
                ends = np.cumsum(length)
                crc = [zlib.crc32(ids[e - k : e]) for e, k in zip(ends.tolist(), length.tolist(), strict=True)]
                rows = pa.array(np.repeat(np.arange(at, at + len(texts)), n))
                columns = [batch["doc_id"].take(rows), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at += len(texts)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return df.select(df[id_col].cast("bigint").alias("doc_id"), df[text_col].alias("text")).mapInArrow(bounded(run), schema)


def _packed(items: DataFrame, n: int, turn: int, caps: Capacities, rule: str, group: int) -> DataFrame:
    """``items`` with ``sequence_id``, ``offset`` and ``room``, the tokens left in the sequence."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("length", "descending"), ("_item", "ascending")])
        bins, offsets, room = best_fit(rows["length"].to_numpy(), caps, rule)
        rows = rows.select(names)
        for name, values in (("sequence_id", (turn << 58) | (key[0].as_py() << 28) | bins), ("offset", offsets), ("room", room[bins])):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows

    names = [c for c in items.columns if c not in ("sequence_id", "offset", "room")]
    dealt = items.select(*names, F.pmod(F.xxhash64("_item", F.lit(turn)), F.lit(-(-n // group))).alias("_group"))
    schema = ", ".join(f"{c} {items.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id bigint, offset bigint, room bigint"
    return dealt.groupBy("_group").applyInArrow(run, schema)


def pack_pieces(pieces: DataFrame, caps: Capacities, *, rule: str = "norm", group: int = GROUP) -> DataFrame:
    """Written ``pieces`` (``length`` and any other columns; none longer than ``caps.piece``) with ``_item``, ``sequence_id`` and ``offset``.

    ``_item`` numbers the rows of the written table, so that equal rows are spread over groups like others and a repeated task deals them alike.
    """
    made = [written(pieces.withColumn("_item", F.monotonically_increasing_id()), "items")]
    live, out, before = made[0], None, None
    spare = int(caps.limits[0] * SPARE)
    n = live.count()
    for turn in range(ROUNDS):
        packed = written(_packed(live, n, turn, caps, rule, group), "packed")
        made.append(packed)
        # a round counts if its pieces take fewer sequences than they did
        if before is not None and packed.where("offset = 0").count() >= before:
            break
        settled_now, live = packed.where(F.col("room") <= spare), packed.where(F.col("room") > spare)
        out = settled_now if out is None else out.unionByName(settled_now)
        loose = live.agg(F.count("*").alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).first()
        if n <= group or not loose["n"]:
            break
        n, before = loose["n"], loose["bins"]
    return settled(out.unionByName(live).drop("room"), "packing", *made)


def pack_documents(
    df: DataFrame,
    make_encoder: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]],
    caps: Capacities | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: str = "norm",
    group: int = GROUP,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of every piece of ``df``'s texts.

    Texts with more ids than fit into a sequence (``caps.piece``) are cut, others stay whole. A null text counts as empty. Rows with
    equal or null ids are packed each for itself; equal rows are interchangeable. An empty table gives no rows; other columns are ignored.
    """
    caps = caps or Capacities()
    pieces = cut_pieces(df, make_encoder, caps.piece, id_col=id_col, text_col=text_col, with_ids=with_ids)
    return pack_pieces(pieces, caps, rule=rule, group=group).drop("_item")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_starts``: whole sequences out of pieces that carry their ``ids``; where each piece begins is kept for attention masks."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.offset").alias("doc_starts"))


def op11(documents: DataFrame, tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """As few sequences as it can: document counts and attention costs are limited by what ``tokens`` tokens can hold, so only those bind."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        text = f.read()
    key, definition = hashlib.sha256(text.encode()).hexdigest(), documents.sparkSession.sparkContext.broadcast(text)

    def make() -> Callable:
        words = kept("word_tokenizer", key, lambda: WordTokenizer(definition.value))
        return lambda texts: words.encode(texts, end_id)

    return pack_documents(documents, make, Capacities(tokens))
