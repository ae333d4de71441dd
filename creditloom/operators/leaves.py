"""Leaf values of boosted trees by regularised Newton steps.

The trees keep their splits. Tree after tree, the value of a leaf becomes -S(G) / (H + lambda) times the
learning rate, where G and H are the sums of gradient and Hessian of the logistic loss over its rows,
given the trees before, and S shrinks G towards zero by alpha. One aggregation by leaf a tree; margins
are expressions over the leaf numbers, so rows are never joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import session

LEAF = "_leaf"
STAGE_EVERY = 25  # trees after which the margin is written out, which keeps expressions short


def regularised(params: Mapping) -> bool:
    return "reg_alpha" in params or "reg_lambda" in params


def with_leaves(model, df: DataFrame) -> DataFrame:
    """`df` (with `features`) and the array of leaf numbers, one per tree."""
    name = "_leaf_vector"
    found = model.copy().setLeafCol(name).transform(df)
    return found.withColumn(LEAF, vector_to_array(name)).drop(
        name, *[c for c in ("rawPrediction", "probability", "prediction") if c not in df.columns])


def leaf_counts(model) -> list[int]:
    return [(t.numNodes + 1) // 2 for t in model.trees]


def value_of(values: Sequence[float], tree: int) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col(LEAF)[tree].cast("int") + 1)


def margin(values: Sequence[Sequence[float]], first: int = 0) -> Column:
    """The sum of the trees' values; `first` is the number of the first of them."""
    total = F.lit(0.0)
    for k, v in enumerate(values):
        total = total + value_of(v, first + k)
    return total


def leaf_sums(rows: DataFrame, tree: int, label: str = "label") -> DataFrame:
    """leaf, g, h, n of one tree: gradient and Hessian of the logistic loss at `_margin`."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
    return rows.groupBy(F.col(LEAF)[tree].cast("int").alias("leaf")).agg(
        F.sum(p - F.col(label)).alias("g"), F.sum(p * (1 - p)).alias("h"), F.count(F.lit(1)).alias("n"))


def step(g: float, h: float, alpha: float, reg_lambda: float, rate: float) -> float:
    shrunk = max(abs(g) - alpha, 0.0) * (1 if g > 0 else -1)
    return -rate * shrunk / (h + reg_lambda) if h + reg_lambda > 0 else 0.0


def newton(model, df: DataFrame, params: Mapping, label: str = "label") -> list[list[float]]:
    """Values per tree and leaf, fitted on `df` (with `features` and the label). Leaves without rows have 0."""
    alpha, reg_lambda = float(params.get("reg_alpha", 0.0)), float(params.get("reg_lambda", 1.0))
    rate = float(params.get("learning_rate", 0.1))
    base, _ = session.stage(with_leaves(model, df).select(
        F.col(label).cast("double").alias(label), LEAF, F.lit(0.0).alias("_so_far")), "leaves")
    values: list[list[float]] = []
    staged = 0
    for tree, count in enumerate(leaf_counts(model)):
        if tree - staged >= STAGE_EVERY:
            base, _ = session.stage(base.withColumn("_so_far", F.col("_so_far") + margin(values[staged:], staged)), "leaves")
            staged = tree
        rows = base.withColumn("_margin", F.col("_so_far") + margin(values[staged:], staged))
        found = {r["leaf"]: step(r["g"], r["h"], alpha, reg_lambda, rate) for r in leaf_sums(rows, tree, label).collect()}
        values.append([found.get(leaf, 0.0) for leaf in range(count)])
    return values


def scored(model, values: Sequence[Sequence[float]], df: DataFrame) -> DataFrame:
    """Adds `raw_score`, the probability under the new leaf values."""
    return with_leaves(model, df).withColumn(
        "raw_score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(values)))).drop(LEAF)
