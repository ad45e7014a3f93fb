"""Token ids in bit-plane shuffled segments.

Format. A table of segments, in Parquet; a segment holds the ids of whole documents:

* ``part, seq``: segments in order of (part, seq) hold documents in ascending id order;
* ``doc_ids, doc_lens``: the documents and how many ids each has;
* ``n_ids``, ``width`` (planes of an id: bits, or bytes times 8), ``block`` (ids of a block);
* ``chunks``: the chunk index, byte offsets of each (block, plane) in ``payload``;
* ``payload``: for each block of ``block`` ids (the last one padded with zeros), for each
  plane from the lowest, the block's bits (or bytes) of that plane, compressed with zstandard.

High planes of small ids are all zeros and cost a few bytes. Any block of a segment can be
read on its own by the index, and Spark's own writer commits each file once, so lost
executors and repeated tasks leave no half-written data.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .common import bounded, new_path
from .ragged import WordMemory, kept, portions

BLOCK = 16_384
#: A segment is closed when it holds so many ids; a longer document makes a longer one.
SEGMENT_IDS = 1 << 20
MAX_REMEMBERED = 400_000

SEGMENTS = "part int, seq int, doc_ids array<bigint>, doc_lens array<bigint>, n_ids bigint, width int, block int, chunks array<bigint>, payload binary"


def shuffle_planes(ids: np.ndarray, width: int, block: int, bits: bool = True) -> tuple[bytes, list[int]]:
    """Payload and chunk index of ``ids``; ``width`` bits of each id are kept, which must be all that are set."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    zstd = zstandard.ZstdCompressor(level=3)
    out, index = [], [0]
    for at in range(0, len(ids), block):
        one = np.zeros(block, "<u4")
        part = ids[at : at + block]
        one[: len(part)] = part
        if bits:
            planes = [np.packbits((one >> np.uint32(k)).astype(np.uint8) & 1, bitorder="little") for k in range(width)]
        else:
            planes = list(np.ascontiguousarray(one.view(np.uint8).reshape(block, 4).T)[: width // 8])
        for plane in planes:
            out.append(zstd.compress(plane.tobytes()))
            index.append(index[-1] + len(out[-1]))
    return b"".join(out), index


def unshuffle_planes(payload: bytes, index: list[int], n_ids: int, width: int, block: int, bits: bool = True) -> np.ndarray:
    """The ids behind ``payload``: the exact inverse of ``shuffle_planes``."""
    zstd = zstandard.ZstdDecompressor()
    planes = width if bits else width // 8
    out = np.zeros(-(-n_ids // block) * block, "<u4")
    for k in range(len(index) - 1):
        b, plane = divmod(k, planes)
        raw = np.frombuffer(zstd.decompress(payload[index[k] : index[k + 1]]), np.uint8)
        one = np.unpackbits(raw, count=block, bitorder="little").astype("<u4") if bits else raw.astype("<u4")
        out[b * block : (b + 1) * block] |= one << np.uint32(plane if bits else 8 * plane)
    return out[:n_ids]


#: What a tokenizer's definition says where ``WordTokenizer`` may encode word by word.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class WordTokenizer:
    """Encodes texts as a ``tokenizers`` file does, each distinct word once where the file's rules allow that.

    They do if its normaliser and pre-tokenizer are ``NORMALIZER`` and ``PRE_TOKENIZER``, it neither drops merges at random nor
    cuts or pads texts, adds nothing after the model, and all its added tokens begin with ``<|``: then tokens never span white
    space. Any other file encodes whole texts by the library.

    Texts are cut at ASCII white space, and full stops and commas at the end of a word are
    cut off too where they are pre-tokens of their own; words are lower-cased in ASCII, as
    the tokenizer would. Each distinct word is encoded once by the library: the pre-tokens
    of ASCII words and words of letters, already normalised, by its model, others by the whole of it.
    Texts that hold ``<|`` go to the library whole and unchanged, as added tokens are matched before lower-casing.
    """

    #: A full stop or comma that may be in one pre-token with what stands before it.
    JOINED = re.compile("[^a-z0-9àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß \n][.,]")
    #: Fixed value: the file's pre-token pattern, as it reads for lower-cased ASCII.
    PRE_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(definition)
        self.by_word = self.splits_at_space(json.loads(definition))
        self.byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.memory = WordMemory(self._encode_words, MAX_REMEMBERED)

    @staticmethod
    def splits_at_space(rules: dict) -> bool:
        model = rules["model"]
        return (
            rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER and model["type"] == "BPE" and not model["dropout"]
            and not any(rules[k] for k in ("truncation", "padding", "post_processor")) and all(t["content"].startswith("<|") for t in rules["added_tokens"])
        )

    def _encode_words(self, words: list[bytes]) -> list[list[int]]:
        tokenize, pre_tokens = self.tokenizer.model.tokenize, self.PRE_TOKEN.findall
        out: list = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            text = word.decode()
            if text.isascii():
                if text.isprintable() and "<|" not in text:
                    out[i] = [t.id for p in pre_tokens(text) for t in tokenize(p)]
                    continue
            elif text.isalpha() and max(text) < "ɐ" and text.lower() == text and unicodedata.is_normalized("NFC", text):
                out[i] = [t.id for t in tokenize(self._mapped(text))]
                continue
            rest.append(i)
        if rest:
            for i, ids in zip(rest, self._whole([words[i].decode() for i in rest]), strict=True):
                out[i] = ids
        return out

    def _mapped(self, text: str) -> str:
        return self.byte_level.pre_tokenize_str(text)[0][0]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts with ``end_id`` after each, end to end, and how many each has."""
        marked = [i for i, text in enumerate(texts) if not self.by_word or "<|" in text]
        whole = set(marked)
        words, counts = [], []
        for i, text in enumerate(texts):
            raw = b"" if i in whole else text.encode().lower()
            if not self.JOINED.search(raw.decode()):
                raw = raw.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n")
            found = raw.split()
            words += found
            counts.append(len(found))
        ids, lens = self.memory.ids(words)
        ends = np.concatenate([[0], np.cumsum(lens)])[np.cumsum(counts, dtype=np.int64)]
        if marked:
            pieces = np.split(ids, ends[:-1])
            for i, found in zip(marked, self._whole([texts[i] for i in marked]), strict=True):
                pieces[i] = np.array(found, ids.dtype)
            ids, ends = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
        return np.insert(ids, ends, end_id), np.diff(ends, prepend=0) + 1


def write_tokens(
    df: DataFrame,
    path: str,
    make_encoder: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 17,
    block: int = BLOCK,
    bits: bool = True,
) -> None:
    """Encode ``df``'s texts and write segments at ``path`` in ascending ``id_col`` order.

    Documents are range-partitioned by id (equal ids: by text), so that parts can be written
    in parallel; ``make_encoder()`` is called in each task. Null texts count as empty; rows
    with equal ids are all kept; null ids come first. An empty table makes an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, seq = make_encoder(), TaskContext.get().partitionId(), 0
        docs: list = []
        lens: list = []
        held: list = []

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held).astype(np.uint32)
            payload, index = shuffle_planes(ids, width, block, bits)
            row = [[part], [seq], [docs], [lens], [len(ids)], [width], [block], [index], [payload]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            at = 0
            for texts in portions(t.as_py() or "" for t in batch["_text"]):
                ids, counts = encode(texts)
                docs += batch["_id"].slice(at, len(texts)).to_pylist()
                lens += counts.tolist()
                held.append(ids)
                at += len(texts)
                if sum(map(len, held)) >= SEGMENT_IDS:
                    yield segment()
                    docs, lens, held, seq = [], [], [], seq + 1
        if docs:
            yield segment()

    longs = pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), longs, longs, pa.int64(), pa.int32(), pa.int32(), longs, pa.binary()]
    names = [x.split()[0] for x in SEGMENTS.split(", ")]
    ordered = df.select(df[id_col].cast("bigint").alias("_id"), df[text_col].alias("_text")).repartitionByRange("_id", F.length("_text")).sortWithinPartitions("_id", "_text")
    ordered.mapInArrow(bounded(run), SEGMENTS).write.option("compression", "none").parquet(path)


def read_tokens(spark, path: str, bits: bool = True) -> DataFrame:
    """Documents of the segments at ``path``: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it. It comes from the index columns
    alone: sums of each part first, then within a part, so one task sees a row for
    each part at most. ``ids_crc32`` is of the ids, read back, as little-endian 32-bit integers.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq")
    starts = segments.select("part", "seq", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("seq_start"))
    placed = segments.join(starts.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("start")), ["part", "seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = {n: batch[n][i].as_py() for n in names}
                ids = unshuffle_planes(s["payload"], s["chunks"], s["n_ids"], s["width"], s["block"], bits)
                at = np.cumsum([0, *s["doc_lens"]])
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["doc_ids"], pa.int64()), pa.array(at[:-1] + s["start"], pa.int64()), pa.array(s["doc_lens"], pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    names = ["doc_ids", "doc_lens", "n_ids", "width", "block", "chunks", "payload", "start"]
    return placed.select(*names).mapInArrow(bounded(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op5(documents: DataFrame, end_id: int = 2) -> DataFrame:
    import public_tokenizers

    spark = documents.sparkSession
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        text = f.read()
    key, definition = hashlib.sha256(text.encode()).hexdigest(), spark.sparkContext.broadcast(text)

    def make() -> Callable:
        words = kept("word_tokenizer", key, lambda: WordTokenizer(definition.value))
        return lambda texts: words.encode(texts, end_id)

    path = new_path(spark, "tokens")
    write_tokens(documents, path, make)
    return read_tokens(spark, path)
