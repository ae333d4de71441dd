"""Ranks and quantiles against NumPy, on the plain path and on the path that splits groups."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.functions.ranks import (
    column_quantiles, exact_quantiles, running_totals, values_at_positions)


def rows(seed=3, n=3000):
    """One group holds two thirds of the rows and repeats many values."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.67, "hot", rng.choice(["a", "b"], n))
    value = np.where(key == "hot", rng.integers(0, 40, n) / 4.0, rng.normal(size=n))
    return [(str(k), float(v)) for k, v in zip(key, value)]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_running_totals(spark, limit):
    data = rows()
    df = spark.createDataFrame(data, "k string, v double")
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["k"], r["v"]): (r["n_below"], r["n_total"])
           for r in running_totals(counts, ["k"], "v", "n", limit).collect()}
    for (k, v), (below, total) in got.items():
        mine = [x for g, x in data if g == k]
        assert below == sum(x < v for x in mine)
        assert total == len(mine)
    assert len(got) == len(set(data))


@pytest.mark.parametrize("limit", [10**6, 0])
@pytest.mark.parametrize("interpolate", [True, False])
def test_exact_quantiles(spark, limit, interpolate):
    data = rows(seed=5)
    df = spark.createDataFrame(data + [("hot", None), ("a", None)], "k string, v double")
    points = [0.0, 0.1, 0.30000000000000004, 0.5, 0.97, 1.0]
    got = {r["k"]: r["quantiles"] for r in
           exact_quantiles(df, ["k"], "v", points, interpolate, single_task_rows=limit).collect()}
    for k in ("hot", "a", "b"):
        mine = [x for g, x in data if g == k]
        method = "linear" if interpolate else "inverted_cdf"
        assert got[k] == pytest.approx(list(np.quantile(mine, points, method=method)), abs=1e-12)


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([(1.0, 98), (2.0, 1), (3.0, 1)], "v double, n long").withColumn(
        "k", F.lit(0))
    got = exact_quantiles(df, ["k"], "v", [0.5, 0.99, 1.0], weight="n").first()["quantiles"]
    assert got == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_values_at_positions(spark, limit):
    df = spark.createDataFrame([(float(v),) for v in range(100)], "v double")
    assert values_at_positions(df, "v", ["0", "n_total div 4", "n_total - 1"], limit) == [0, 25, 99]


@pytest.mark.parametrize("exact", [False, True])
def test_column_quantiles_keep_groups_without_values(spark, exact):
    df = spark.createDataFrame([("a", 1, None), ("a", 3, None), ("b", None, None)],
                               "k string, x int, y double")
    got = {r["k"]: (r["x"], r["y"])
           for r in column_quantiles(df, ["k"], ["x", "y"], [0.5], exact).collect()}
    assert got == {"a": ([1.0], None), "b": (None, None)}
