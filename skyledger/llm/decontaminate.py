"""Benchmark decontamination by winnowing.

Fingerprints: of every ``window - k + 1`` consecutive k-gram hashes the least is kept (the
rightmost of equal ones). Two texts that share ``window`` words share those k-grams, so they
keep the same one: every shared span of ``window`` words or more is found. Items shorter than
``window`` words have one fingerprint, the hash of all their words, and are looked for at every place.

A fingerprint carries its context: the words that a window around it can reach, at most ``2 * window - k``.
Documents' and benchmark's fingerprints are joined as tables, and each hit is extended to both sides, word by word,
within the two contexts; the spans of a document's hits are then put together. Neither texts nor items are shuffled.

Documents are scanned once. A filter of the benchmark's fingerprints, bounded in size whatever the benchmark,
keeps most of the documents' fingerprints out of the join; the join decides, so its size changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from .common import BitFilter, bounded, discard, written
from .ragged import kept

MAX_REMEMBERED = 250_000

#: Lower-cases A-Z and turns every other ASCII character but digits and a-z into a space.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters (lower-cased), digits and non-ASCII characters."""
    return (text or "").encode().translate(_BYTES).split()


class WordHashes(dict):
    """64-bit hash of each word; it forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """Positions that hold the least hash of some ``span`` consecutive ones, the rightmost of equals; all of fewer."""
    if len(grams) <= span:
        return np.arange(len(grams)) if span == 1 or len(grams) < span else np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))])
    if span == 1:
        return np.arange(len(grams))
    low = sliding_window_view(grams[::-1], span).argmin(axis=1)
    return np.unique(len(grams) - 1 - (np.arange(len(low)) + low))


def prints_of(words: list[bytes], hashes: np.ndarray, window: int, k: int, short: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(fingerprints, places, words of each, words of context on either side): the winnowed k-grams, and all grams of the ``short`` lengths."""
    sizes = [(k, window - k), *[(n, 0) for n in short]]
    for i, (n, reach) in enumerate(sizes):
        if len(words) < (n if i else window):
            continue
        grams = gram_hashes(hashes, n)
        at = winnow(grams, window - k + 1) if i == 0 else np.arange(len(grams))
        # whole short items of n words and k-grams of longer ones are told apart, and so are lengths
        yield (grams[at] ^ np.uint64(n << 1 | (i > 0))).view(np.int64), at, n, reach


def context(words: list[bytes], at: int, n: int, reach: int) -> tuple[int, bytes]:
    """The words that a window around ``words[at:at + n]`` can reach, and where in them that gram begins."""
    low = max(0, at - reach)
    return at - low, b" ".join(words[low : at + n + reach])


def extend(a: list[bytes], i: int, b: list[bytes], j: int, n: int) -> tuple[int, int] | None:
    """How far ``a`` before and after ``a[i:i + n]`` goes on as ``b`` does around ``b[j:j + n]``; None if these differ."""
    if a[i : i + n] != b[j : j + n]:
        return None
    left, right = 0, n
    while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
        left += 1
    while right < min(len(a) - i, len(b) - j) and a[i + right] == b[j + right]:
        right += 1
    return left, right


def benchmark_prints(items: DataFrame, window: int, k: int) -> DataFrame:
    """``print, size, need, item_at, item_words, item_class``, each once, of items (``item_class, words``); ``need`` words in a row are a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("word_hashes", "", WordHashes)
        for batch in batches:
            rows = []
            for name, text in zip(batch["item_class"].to_pylist(), batch["words"], strict=True):
                words = text.as_py().encode().split()
                short = [len(words)] if len(words) < window else []
                for found, places, n, reach in prints_of(words, hashes.of(words), window, k, short):
                    rows += [(h, n, min(window, len(words)), *context(words, p, n, reach), name) for h, p in zip(found.tolist(), places.tolist(), strict=True)]
            columns = list(zip(*sorted(set(rows)), strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    names = ["print", "size", "need", "item_at", "item_words", "item_class"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return items.mapInArrow(bounded(run), "print bigint, size int, need int, item_at int, item_words binary, item_class binary").distinct()


def _item_classes(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item, item_class, words`` of items with words; equal sequences of words are one class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [b" ".join(words_of(t.as_py())) for t in batch["text"]]
            classes = [hashlib.blake2b(w, digest_size=16).digest() if w else None for w in words]
            yield pa.RecordBatch.from_arrays([batch["item"], pa.array(classes, pa.binary()), pa.array([w.decode() for w in words], pa.string())], names=["item", "item_class", "words"])

    source = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return source.mapInArrow(bounded(run), "item string, item_class binary, words string").where("item_class IS NOT NULL")


_SPANS = "array<struct<start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _extended(hits: DataFrame) -> DataFrame:
    """``row_key, span, item_class`` of the joined fingerprints that extend to ``need`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, start, end = [], [], []
            columns = [batch[c].to_pylist() for c in ("at", "doc_at", "doc_words", "item_at", "item_words", "size", "need")]
            for at, i, a, j, b, n, need in zip(*columns, strict=True):
                found = extend(a.split(b" "), i, b.split(b" "), j, n)
                keep.append(found is not None and sum(found) >= need)
                if keep[-1]:
                    start.append(at - found[0])
                    end.append(at + found[1])
            some = batch.filter(pa.array(keep, pa.bool_()))
            span = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([some["row_key"], span, some["item_class"]], names=["row_key", "span", "item_class"])

    return hits.mapInArrow(bounded(run), "row_key bigint, span struct<start:bigint,end:bigint>, item_class binary")


def _merged(rows: DataFrame) -> DataFrame:
    """``row_key, spans``: each row's ``spans`` sorted, those that touch or overlap as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch["spans"].to_pylist():
                merged: list[list[int]] = []
                for a, b in sorted((s["start"], s["end"]) for s in spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                out.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([batch["row_key"], pa.array(out, _SPAN)], names=["row_key", "spans"])

    return rows.mapInArrow(bounded(run), f"row_key bigint, spans {_SPANS}")


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    k: int = 5,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of ``documents``: ``id_col, n_words, spans, items`` and the columns ``keep``.

    ``spans``: merged (start, end) word positions inside an occurrence of ``window`` consecutive
    words of an item (or of a whole shorter item); ``items``: the ids, as strings and sorted,
    of items with such an occurrence; an item without an id counts for ``spans`` only. Null and empty
    texts have no words. Every row is judged on its own, whether its id is null, repeated or neither; columns of
    any name may be kept. An empty benchmark leaves every row without spans.

    The scan's result is written (with the kept columns) with a key for each row; only rows with a fingerprint that may be
    the benchmark's are joined. A document's work grows with its words and with its matching fingerprints.
    """
    spark = documents.sparkSession
    named = written(_item_classes(benchmark, item_col, item_text_col), "items")
    prints = written(benchmark_prints(named.select("item_class", "words").distinct(), window, k), "prints")
    # lengths below the window: fewer than ``window`` numbers
    short = sorted(r["size"] for r in prints.where(F.col("need") < window).select("size").distinct().collect())
    shared = spark.sparkContext.broadcast(BitFilter.of(prints.select("print"), prints.count()))
    text_at = f"_keep_{text_col}" if text_col in keep else "_text"
    extra = [] if text_col in keep else [F.col(text_col).alias("_text")]
    rows = documents.select(F.col(id_col).alias("_id"), *extra, *[F.col(c).alias(f"_keep_{c}") for c in keep])
    passed = [c for c in rows.columns if c != "_text"]
    mark = pa.struct([("print", pa.int64()), ("at", pa.int32()), ("doc_at", pa.int32()), ("doc_words", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = kept("word_hashes", "", WordHashes)
        for batch in batches:
            n, marks = [], []
            for text in batch[text_at]:
                words = words_of(text.as_py())
                n.append(len(words))
                mine = []
                for found, places, size, reach in prints_of(words, hashes.of(words), window, k, short):
                    some = shared.value.might_hold(found)
                    mine += [(h, p, *context(words, p, size, reach)) for h, p in zip(found[some].tolist(), places[some].tolist(), strict=True)]
                marks.append(mine)
            flat = [m for mine in marks for m in mine]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*flat, strict=True) if flat else [()] * 4, mark, strict=True)]
            ends = np.cumsum([0, *map(len, marks)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, fields=list(mark)))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in passed], pa.array(n, pa.int64()), lists, pa.array(list(map(bool, marks)), pa.bool_())], names=[*passed, "n_words", "marks", "marked"])

    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = "".join(f"`{c}` {fields[c]}, " for c in passed) + "n_words bigint, marks array<struct<print:bigint,at:int,doc_at:int,doc_words:binary>>, marked boolean"
    first = written(rows.mapInArrow(bounded(scan), schema).withColumn("row_key", F.monotonically_increasing_id()), "scanned")

    hits = first.where("marked").select("row_key", F.explode("marks").alias("m")).select("row_key", "m.*").join(prints, "print")
    found = written(_extended(hits), "hits")
    spans = _merged(found.groupBy("row_key").agg(F.collect_set("span").alias("spans")))
    names = named.where("item IS NOT NULL").select("item", "item_class").distinct()
    ids = found.select("row_key", "item_class").distinct().join(names, "item_class").groupBy("row_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    told = written(spans.join(ids, "row_key", "left"), "spans")
    for table in (named, prints, found):
        discard(table)
    none, nobody = F.array().cast(_SPANS), F.array().cast("array<string>")
    base = [F.col("_id").alias(id_col), "n_words"]
    rest = [F.col(f"_keep_{c}").alias(c) for c in keep]
    clean = first.where("NOT marked").select(*base, none.alias("spans"), nobody.alias("items"), *rest)
    return clean.unionAll(
        first.where("marked").join(told, "row_key", "left").select(*base, F.coalesce("spans", none).alias("spans"), F.coalesce("items", nobody).alias("items"), *rest)
    )


def judged(rows: DataFrame, share: int = 20) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated``: some word is hit, and at least one in ``share``."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, x: acc + x["end"] - x["start"])
    return rows.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def op7(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return judged(contamination(documents, benchmark)).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def op7_sql(window: int = 13) -> str:
    """The same rows in DuckDB's SQL, by joining every run of words with every window."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"
    return f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT item, w, CAST(least(len(w), {window}) AS INTEGER) AS n, unnest(range(1, len(w) - least(len(w), {window}) + 2)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {words} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT doc_id, p, win.n, item FROM g JOIN win USING (n, g)),
cover AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM h)) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)"""
