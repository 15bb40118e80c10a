"""Exact percentiles from sketches against Spark's own."""

import random

import pytest
from pyspark.sql import functions as F

from genrec.operators import quantiles


def values(spark, seed, n, spread):
    rng = random.Random(seed)
    return spark.createDataFrame([(int(rng.paretovariate(0.7) * spread) % 10 ** 9, i % 3) for i in range(n)], "v long, day int")


def exact(df, share):
    return df.select(F.percentile("v", F.lit(share))).first()[0]


@pytest.mark.parametrize("n, spread, limit", [(1, 1, None), (2, 5, None), (5000, 1, None), (20000, 1000, 20), (20000, 1000, None)])
def test_equal_to_percentile(spark, n, spread, limit):
    df = values(spark, n, n, spread).cache()
    for share in (0.0, 0.5, 0.7, 0.98, 1.0):
        assert quantiles.exact_percentile(df, "v", share, limit=limit) == exact(df, share), share


def test_sketches_of_days_merge(spark):
    df = values(spark, 3, 9000, 50).cache()
    days = quantiles.quantile_sketch(df.where("day < 2"), "v", ["day"]).unionByName(quantiles.quantile_sketch(df.where("day = 2"), "v", ["day"]))
    assert days.count() == 3
    whole = quantiles.merged_sketch(days)
    for share in (0.3, 0.7, 0.98):
        assert quantiles.exact_percentile(df, "v", share, whole) == exact(df, share)


def test_a_sketch_that_misses_is_noticed(spark, monkeypatch):
    """Brackets that lie beside the rank are widened until the counts hold it."""
    df = values(spark, 4, 5000, 50).cache()
    real, calls = quantiles._bracket, []

    def off(sketch, share, margin):
        calls.append(margin)
        return real(sketch, share, margin) if margin > 0.1 else real(sketch, max(share - 0.2, 0.0), margin)

    monkeypatch.setattr(quantiles, "_bracket", off)
    assert quantiles.exact_percentile(df, "v", 0.7) == exact(df, 0.7) and len(calls) > 1


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "v long")
    assert quantiles.exact_percentile(df, "v", 0.5) is None and quantiles.exact_percentile(df.limit(0), "v", 0.5) is None
    mixed = spark.createDataFrame([(None,), (4,), (7,)], "v long")
    assert quantiles.exact_percentile(mixed, "v", 0.5) == 5.5
