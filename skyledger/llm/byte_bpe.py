"""Byte-level BPE through a sentencepiece model written directly from a vocabulary of ranks.

Each byte is mapped to a printable character, each vocabulary entry becomes a piece
of such characters scored by its negative rank, and the normaliser is the identity
(no prefix, no white-space escapes), so sentencepiece merges exactly the pair of
lowest rank, leftmost first. Texts are split into pre-tokens by a pattern; pre-tokens
are encoded on their own; decoding maps ids to pieces and characters back to bytes.

One scan, no shuffle: a text's encoding depends on that text alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as pb

from .common import bounded
from .ragged import WordMemory, gather, kept, portions, table

#: The most distinct pre-tokens that a worker process remembers; those met later are encoded anew in each batch.
MAX_REMEMBERED = 200_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable in Latin-1, else one from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of lines "base64 rank"; ranks run from 0 without gaps."""
    with open(path, "rb") as lines:
        ranks = {int(n): base64.b64decode(t) for t, n in (line.split() for line in lines if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model of these tokens; ids are ranks, and the unknown piece follows as the last id."""
    chars = byte_characters()
    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        piece = model.pieces.add()
        piece.piece, piece.score = "".join(chars[b] for b in token), -float(rank)
    unknown = model.pieces.add()
    # a character that no byte maps to, so that no text can spell it
    unknown.piece, unknown.score, unknown.type = "⁇", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    spec = model.trainer_spec
    spec.model_type, spec.vocab_size, spec.unk_id = pb.TrainerSpec.BPE, len(tokens) + 1, len(tokens)
    spec.bos_id, spec.eos_id, spec.pad_id, spec.unk_piece = -1, -1, -1, unknown.piece
    spec.treat_whitespace_as_suffix = False
    norm = model.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class ByteBpe:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.split = regex.compile(pattern).findall
        self.to_chars = dict(enumerate(byte_characters()))
        to_bytes = {ord(c): b for b, c in self.to_chars.items()}
        # the inverse mapping, piece by piece
        self.bytes_of = table([self.sp.id_to_piece(i).translate(to_bytes).encode("latin-1") for i in range(len(tokens))])
        self.memory = WordMemory(self._encode_words, MAX_REMEMBERED)

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        return self.sp.encode([w.encode().decode("latin-1").translate(self.to_chars) for w in words], num_threads=1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, end to end, and how many each has."""
        words, counts = [], []
        for text in texts:
            found = self.split(text)
            words += found
            counts.append(len(found))
        ids, lens = self.memory.ids(words)
        ends = np.concatenate([[0], np.cumsum(lens)])[np.cumsum([0, *counts])]
        return ids, np.diff(ends)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, end to end, and how many each id has."""
        return gather(*self.bytes_of, ids)


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` (and ``ids`` when asked for), one row for each input row.

    ``ids_sha256`` is of the decimal ids joined by one space, ``decoded_sha256`` of the bytes
    that the ids decode to. Null and empty texts have no ids; repeated rows are encoded
    each; a text of any length is encoded whole. ``ranks_path`` is read on the driver and
    its tokens (a vocabulary, fixed in size) are broadcast.
    """
    spark = df.sparkSession
    tokens = read_ranks(ranks_path)
    key = hashlib.sha256(b"".join([pattern.encode(), *(b"%d " % len(t) + t for t in tokens)])).hexdigest()
    shared = spark.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, digits = kept("byte_bpe", key, lambda: (ByteBpe(shared.value, pattern), table([b"%d " % i for i in range(len(shared.value))])))
        for batch in batches:
            n, sha, back, all_ids = [], [], [], []
            for texts in portions(text.as_py() or "" for text in batch["_text"]):
                ids, counts = bpe.encode(texts)
                (decimal, wide), (decoded, long) = gather(*digits, ids), bpe.decode(ids)
                at = np.cumsum([0, *counts])
                shown, raw = (np.concatenate([[0], np.cumsum(x)])[at] for x in (wide, long))
                n += counts.tolist()
                for i in range(len(texts)):
                    # each id is followed by a space; the last one's is left out
                    sha.append(hashlib.sha256(decimal[shown[i] : max(shown[i], shown[i + 1] - 1)]).hexdigest())
                    back.append(hashlib.sha256(decoded[raw[i] : raw[i + 1]]).hexdigest())
                all_ids.append(ids)
            columns = [batch[id_col], pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(np.cumsum([0, *n]).astype(np.int32), pa.array(np.concatenate([*all_ids, np.zeros(0, np.int32)]))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    return df.select(id_col, df[text_col].alias("_text")).mapInArrow(bounded(run), schema)


def op10(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    return encode_texts(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
