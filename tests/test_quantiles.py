"""Exact quantiles against numpy's, with rounds forced by small sets."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators.quantiles import exact_quantiles

SCHEMA = "obs_id long, rx string, v double"


def plain(rows, probs):
    groups = {}
    for *key, v in rows:
        groups.setdefault(tuple(key), []).append(v)
    out = {}
    for key, values in groups.items():
        held = [v for v in values if v is not None]
        out[key] = (len(held), [float(x) for x in np.quantile(held, probs)] if held else None)
    return out


@pytest.mark.parametrize("small", [64, 100_000])
def test_quantiles_of_groups_of_any_size(spark, small):
    """A group with most rows, one of equal values, ties, far outliers, nulls alone, null keys, a single value."""
    rng = np.random.default_rng(5)
    rows = [(1, "hot", float(v)) for v in rng.normal(size=12_000)]
    rows += [(1, "far", float(v)) for v in np.concatenate([rng.normal(size=700), rng.normal(size=5) * 1e300])]
    rows += [(2, "ties", float(v)) for v in rng.integers(0, 90, 3000)] + [(2, "same", 7.5)] * 500
    rows += [(3, "none", None)] * 3 + [(3, "one", -2.0), (3, "some", 1.0), (3, "some", None), (3, "some", 4.0)]
    rows += [(None, None, float(v)) for v in rng.exponential(size=400)] + [(None, "x", 1.0)]
    probs = (0.0, 0.25, 0.5, 0.99, 1.0)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("other", F.lit(1)).repartition(7)
    got = {(r["obs_id"], r["rx"]): (r["n"], r["quantiles"]) for r in exact_quantiles(df, ("obs_id", "rx"), F.col("v"), probs, small=small).collect()}
    want = plain(rows, probs)
    assert got.keys() == want.keys()
    for key, (n, values) in want.items():
        assert got[key][0] == n
        assert got[key][1] is None if values is None else got[key][1] == pytest.approx(values, rel=1e-12)


def test_quantiles_nan_and_empty(spark):
    rows = [(1, "a", v) for v in [1.0, 2.0, math.nan] * 40 + [float(x) for x in range(3, 103)]]
    [row] = exact_quantiles(spark.createDataFrame(rows, SCHEMA), ("obs_id",), F.col("v"), (0.0, 0.5, 1.0), small=64).collect()
    held = sorted((v for *_, v in rows), key=lambda v: (math.isnan(v), v))
    assert row["n"] == 220 and row["quantiles"][0] == 1.0 and row["quantiles"][1] == (held[109] + held[110]) / 2 and math.isnan(row["quantiles"][2])
    assert exact_quantiles(spark.createDataFrame([], SCHEMA), ("obs_id", "rx"), F.col("v"), (0.5,)).count() == 0
