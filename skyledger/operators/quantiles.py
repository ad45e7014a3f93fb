"""Exact quantiles of groups of any size, by selection: count in buckets, pick the bucket, refine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.durable import checkpointed

#: Cuts of a round, and copies of a group's cuts over which its values are spread when they look them up.
CUTS, SALTS = 63, 16


def _at_rank(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """``_g, _rank, _v``: the value at each rank of ``ranks`` (``_g, _set, _left, _rank``) among the counted ``values`` (``_g, _set, _v, _n``).

    Cumulative counts over one set, which the caller keeps small.
    """
    w = Window.partitionBy("_g", "_set").orderBy("_v")
    upto = values.withColumn("_upto", F.sum("_n").over(w))
    near = upto.join(ranks, ["_g", "_set"]).where("_left >= _upto - _n AND _left < _upto")
    return near.select("_g", "_rank", "_v")


def _narrowed(values: DataFrame, ranks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over sets that are too large: values and ranks of the buckets that hold a wanted rank, each a set of its own now.

    Cuts come from a mergeable sketch of a set's distinct values; bucket counts are exact whatever the sketch's error, so cuts decide
    speed alone. The greatest cut is below the greatest value, so at least two buckets are not empty.
    """
    set_ = ["_g", "_set"]
    steps = F.array(*[F.lit((i + 1) / (CUTS + 1)) for i in range(CUTS)])
    cuts = values.groupBy(*set_).agg(F.array_distinct(F.percentile_approx("_v", steps, 2000)).alias("_cuts"), F.max("_v").alias("_most"))
    cuts = cuts.select(*set_, F.filter("_cuts", lambda c: c < F.col("_most")).alias("_cuts"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    # a set may hold most rows: its values meet its cuts in SALTS places
    salted = values.withColumn("_salt", F.pmod(F.hash("_v"), F.lit(SALTS)))
    bucket = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    placed = checkpointed(salted.join(cuts, [*set_, "_salt"]).select(*set_, "_v", "_n", bucket.alias("_bucket")))
    counts = placed.groupBy(*set_, "_bucket").agg(F.sum("_n").alias("_in"))
    counts = counts.withColumn("_before", F.sum("_in").over(Window.partitionBy(*set_).orderBy("_bucket")) - F.col("_in"))
    # at most CUTS + 1 buckets for each set
    held = ranks.join(counts, set_).where("_left >= _before AND _left < _before + _in")
    held = checkpointed(held.select(*set_, "_bucket", (F.col("_left") - F.col("_before")).alias("_left"), "_rank"))
    new_set = F.concat_ws(".", "_set", F.col("_bucket").cast("string")).alias("_set")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    wanted = held.select(*set_, "_bucket").distinct().select("*", salts)
    kept = placed.withColumn("_salt", F.pmod(F.hash("_v"), F.lit(SALTS))).join(wanted, [*set_, "_bucket", "_salt"], "left_semi")
    return checkpointed(kept.select("_g", new_set, "_v", "_n")), held.select("_g", new_set, "_left", "_rank")


def exact_quantiles(rows: DataFrame, key: tuple[str, ...], value: Column, probs: tuple[float, ...], small: int = 100_000) -> DataFrame:
    """One row for each group of ``rows``: ``key``, ``n`` (values, nulls left out) and ``quantiles`` (array of double, in the order of ``probs``).

    Quantiles are exact, with linear interpolation between neighbours; NaN is greater than all numbers. A group without values has
    n = 0 and null quantiles; null keys are groups of their own. Equal values are counted together before anything else. Groups of at
    most ``small`` distinct values are settled by cumulative counts; in larger ones about one value in 64 for each wanted rank is left
    after each round, so no task or buffer ever holds a group, and 10^12 values take five rounds.
    """
    group = F.struct(*key)  # structs with nulls inside are equal, where nulls are not
    counted = checkpointed(rows.select(group.alias("_g"), value.cast("double").alias("_v")).groupBy("_g", "_v").agg(F.count("*").alias("_n")))
    n = F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))), F.lit(0))
    sizes = checkpointed(counted.groupBy("_g").agg(n.cast("long").alias("n"), F.count("_v").alias("_distinct")))
    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    wanted = F.array_distinct(F.array(*[f(place(p)).cast("long") for p in probs for f in (F.floor, F.ceil)]))
    ranks = sizes.where("n > 0").select("_g", F.lit("").alias("_set"), F.explode(wanted).alias("_left")).withColumn("_rank", F.col("_left"))
    values = counted.where("_v IS NOT NULL").select("_g", F.lit("").alias("_set"), "_v", "_n")

    large = sizes.where(F.col("_distinct") > small).select("_g", F.lit("").alias("_set"))
    found = None
    while not large.isEmpty():
        done = _at_rank(values.join(large, ["_g", "_set"], "left_anti"), ranks.join(large, ["_g", "_set"], "left_anti"))
        found = done if found is None else found.unionAll(done)
        values, ranks = _narrowed(values.join(large, ["_g", "_set"], "left_semi"), ranks.join(large, ["_g", "_set"], "left_semi"))
        large = checkpointed(values.groupBy("_g", "_set").count().where(F.col("count") > small).select("_g", "_set"))
    done = _at_rank(values, ranks)
    found = done if found is None else found.unionAll(done)

    # at most two values for each of probs
    ends = found.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    out = sizes.join(ends, "_g", "left")

    def between(p: float) -> Column:
        lo, hi = (F.col("_at")[f(place(p)).cast("long")] for f in (F.floor, F.ceil))
        share = place(p) - F.floor(place(p))
        return F.when(lo == hi, lo).otherwise(lo * (1 - share) + hi * share)

    return out.select("_g.*", "n", F.when(F.col("n") > 0, F.array(*[between(p) for p in probs])).alias("quantiles"))
