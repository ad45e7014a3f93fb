"""Shards of equal mixture by proportional stratified interleaving (built-in functions only).

Rows of each source are put in a seeded order; the row at rank r of a source of
n rows gets the fractional rank (r + 1/2) / n. In the order of fractional ranks
every stretch holds each source in its share, so cutting that order into equal
runs gives shards that all match the mixture.

A source may hold any share of the rows: ranks are counted per (source, bucket
of the seeded key), and offsets come from summed bucket counts, so no task sees
a whole source. The same is done for the global order, in cells of equal
fractions. Rows that are equal in all that is ordered by are interchangeable:
they travel as one row with a count until their cell is put in order, so that
no task sees all copies either. Only ids, keys and sizes are shuffled, never
texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Equal runs of fractional ranks, each put in order by itself, and the most copies of a row that are made at a time.
CELLS, STRETCH = 4096, 65_536


def stratified_shards(
    df: DataFrame,
    n_shards: int = 16,
    *,
    source: str = "source",
    order_key: str = "order_key",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Assign every row of ``df`` a shard and a slot within it.

    ``order_key`` names a column with a hexadecimal string of a seeded hash (at
    least 3 digits); equal keys are ordered by the ``carry`` columns, and rows equal
    in all of these are interchangeable. Returns ``carry`` columns, ``shard`` (int) and
    ``slot`` (long, gapless from 0). Shard sizes differ by one row at most.
    A null source counts as a source of its own; an empty table gives no rows.
    Sums of at most 4096 counts are the only work of a single task. A source may have up to 2^40 rows.
    """
    ties = ["_key", *carry]
    rows = df.select(
        # nulls get a key of their own, apart from every string
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("_source"),
        F.substring(order_key, 1, 3).alias("_bucket"),
        F.col(order_key).alias("_key"),
        *carry,
    )
    # equal rows travel as one, with their number
    rows = rows.groupBy("_source", "_bucket", *ties).agg(F.count("*").alias("_copies"))
    counts = rows.groupBy("_source", "_bucket").agg(F.sum("_copies").alias("_n"))
    in_source = Window.partitionBy("_source")
    before = counts.select(
        "_source",
        "_bucket",
        (F.sum("_n").over(in_source.orderBy("_bucket")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(in_source).alias("_total"),
    )
    w = Window.partitionBy("_source", "_bucket").orderBy(*ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        rows.withColumn("_upto", F.sum("_copies").over(w))
        .join(before, ["_source", "_bucket"])
        .withColumn("_end", F.col("_before") + F.col("_upto"))
        .withColumn("_start", F.col("_end") - F.col("_copies"))
    )
    # the copies of a row are cut where cells begin: rank i is in cell (i + 1/2) * CELLS div total
    cell = lambda rank: f"((2 * ({rank}) + 1) * {CELLS}) div (2 * _total)"
    first = lambda c: f"(({c}) * _total + {CELLS // 2 - 1}) div {CELLS}"
    pieces = ranked.select(
        "_source", *ties, "_total", "_start", "_end", F.explode(F.expr(f"sequence({cell('_start')}, {cell('_end - 1')})")).alias("_cell")
    )
    pieces = pieces.withColumns({"_start": F.greatest("_start", F.expr(first("_cell"))), "_end": F.least("_end", F.expr(first("_cell + 1")))}).where("_start < _end")
    cells = pieces.groupBy("_cell").agg(F.sum(F.col("_end") - F.col("_start")).alias("_n"))
    whole = Window.partitionBy(F.lit(0))
    cells = cells.select(
        "_cell",
        (F.sum("_n").over(whole.orderBy("_cell")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_rows"),
    )
    # copies become rows again only where their cell is put in order, a stretch at a time
    spread = (
        pieces.repartition("_cell")
        .withColumn("_from", F.explode(F.expr(f"sequence(_start, _end - 1, {STRETCH}L)")))
        .withColumn("_rank", F.explode(F.expr(f"sequence(_from, least(_from + {STRETCH - 1}, _end - 1))")))
    )
    spread = spread.select("_cell", "_source", *ties, ((F.col("_rank") + 0.5) / F.col("_total")).alias("_fraction"))
    place = F.row_number().over(Window.partitionBy("_cell").orderBy("_fraction", "_source", *ties)) - 1
    # at most CELLS rows, whatever the input
    placed = spread.withColumn("_at", place).join(F.broadcast(cells), "_cell").withColumn("_position", F.col("_before") + F.col("_at"))
    shard = F.expr(f"(_position * {n_shards}) div _rows")
    start = F.expr(f"((_position * {n_shards}) div _rows * _rows + {n_shards - 1}) div {n_shards}")
    return placed.select(*carry, shard.cast("int").alias("shard"), (F.col("_position") - start).cast("long").alias("slot"))


def seeded_key(seed: int, *cols: Column) -> Column:
    """Hexadecimal key that puts rows in a seeded random order, the same in every engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols]).cast("binary"))


def op3(documents: DataFrame, n_shards: int = 16, seed: int = 17) -> DataFrame:
    """Law ``rows``: shard counts at most one apart; ``grown_shard`` is null under it.

    Null texts have size 1 and the checksum of the empty text. The order's key is of the id and that checksum, so rows with
    a null or shared id are spread as others are.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    ).withColumn("order_key", seeded_key(seed, F.col("doc_id"), F.col("text_crc32")))
    out = stratified_shards(rows, n_shards, carry=("doc_id", "size", "text_crc32"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_sql(n_shards: int = 16, seed: int = 17) -> str:
    """The same rows by plain windows in DuckDB's SQL; it has no crc32, so that is folded from bytes."""
    return f"""
WITH t AS (SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
c AS (SELECT doc_id, source, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
  coalesce('s' || source, 'n') AS s,
  xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: (instr('0123456789ABCDEF', h[1]) - 1) * 16 + instr('0123456789ABCDEF', h[2]) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, t),
d AS (SELECT *, md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(text_crc32 AS BIGINT)) AS k FROM c),
f AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY k, doc_id NULLS FIRST, size, text_crc32) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY s) AS f FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY f, s, k, doc_id NULLS FIRST, size, text_crc32) - 1 AS p, count(*) OVER () AS n FROM f)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(p * {n_shards} // n AS INTEGER) AS shard,
  CAST(p - (p * {n_shards} // n * n + {n_shards - 1}) // {n_shards} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p"""
