"""Total orders over whole tables, and places in them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import basename
from ..sources.durable import checkpointed


def with_rank(rows: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Adds the place (from 1) of each row in the order; rows equal in it get different places.

    Spark sorts by ranges, written once, as a second run might cut the ranges elsewhere. A row's place is its place within its range after the sizes of
    the ranges before it, of which there are as many as shuffle partitions. No task sees more than a range.
    """
    held = checkpointed(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before, total = [], 0
    for r in held.groupBy(part.alias("part")).count().orderBy("part").collect():
        before.append((r["part"], total))
        total += r["count"]
    starts = F.broadcast(rows.sparkSession.createDataFrame(before, "_part long, _before long"))  # one row for each range
    return held.withColumn("_part", part).join(starts, "_part").withColumn(name, F.col("_before") + within + 1).drop("_at", "_part", "_before")


def running(rows: DataFrame, keys: list[str], slices: list[str], order: list[Column], values: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``rows`` with each of ``values`` (a column and its aggregate: ``F.max``, ``F.min`` or ``F.sum``) taken over the rows of the same ``keys`` up to this one in the order.

    ``slices`` are columns that never fall along the order (nulls first), from fine to coarse, each a function of the one before it. Rows are put in order within a fine slice alone;
    all that goes before the slice is one row, made from the slices' own aggregates in the same way. So no task holds a key or the whole order.
    """
    to_here = lambda by, at: Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not slices:
        return rows.withColumns({c: f(F.col(c)).over(to_here(keys, order)) for c, f in values.items()})
    by, turn = [*keys, *slices], f"_turn{len(slices)}"
    whole = rows.groupBy(*by).agg(*[f(F.col(c)).alias(c) for c, f in values.items()])
    both = whole.select(*by, F.explode(F.array(F.lit(0), F.lit(1))).alias(turn), *values)
    # the rows of turn 0 stand before their slice and add nothing
    both = both.withColumns({c: F.when(F.col(turn) == 1, F.col(c)) for c in values})
    before = running(both, keys, slices[1:], [F.col(slices[0]).asc(), F.col(turn).asc()], values).where(F.col(turn) == 0)
    told = rows.withColumn(turn, F.lit(1)).unionByName(before, allowMissingColumns=True)
    out = told.withColumns({c: f(F.col(c)).over(to_here(by, [F.col(turn).asc(), *order])) for c, f in values.items()})
    return out.where(F.col(turn) == 1).drop(turn)


def backlog_order() -> list[Column]:
    """By priority and file name; directories don't matter before names."""
    return [F.col("priority").asc_nulls_last(), basename(F.col("path")).asc(), F.col("path").asc()]


def rank_files(files: DataFrame) -> DataFrame:
    """The backlog (``priority, path``) with its ``rank``."""
    return with_rank(files, *backlog_order())


def order_files(files: DataFrame) -> DataFrame:
    return files.orderBy("path")


def order_solutions(files: DataFrame) -> DataFrame:
    """Solution files (``chan_from, path``, see ``parse_names``) by first channel, 0 where it isn't known, and path."""
    return files.orderBy(F.coalesce("chan_from", F.lit(0)), "path")


def order_tiles(tiles: DataFrame) -> DataFrame:
    return tiles.orderBy("obs_id", "tile_id")


def order_inputs(inputs: DataFrame) -> DataFrame:
    return inputs.orderBy("obs_id", "input_id")
