"""Quantile sketches as a table: one per month and column, made once and merged afterwards.

A KLL sketch of size k answers a rank with an error below `rank_error(k)` of the rows, whatever their
number, and so does a merge of sketches. A month that is added is sketched on its own; quantiles of
any set of months come from the stored sketches, without a row of the months before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 1000


def rank_error(size: int = SIZE) -> float:
    """Two-sided error of a single rank at 99 % confidence, by the published fit for KLL sketches."""
    return 2.296 / size ** 0.9021


def month_sketches(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("snapshot_date",),
                   size: int = SIZE) -> DataFrame:
    """keys, column, n, sketch: one row per group and column; nulls and NaN are left out."""
    known = lambda c: F.expr(f"nullif(double(`{c}`), double('NaN'))")
    wide = df.groupBy(*keys).agg(*[F.struct(
        F.count(known(c)).alias("n"), F.kll_sketch_agg_double(known(c), F.lit(size)).alias("sketch")).alias(c) for c in columns])
    return wide.unpivot(list(keys), [F.col(f"`{c}`") for c in columns], "column", "s").select(*keys, "column", "s.n", "s.sketch")


def quantile(sketch: Column, n: Column, p: float) -> Column:
    """The quantile of a sketch, null for one without values."""
    return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))))


def quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ("column",),
              size: int = SIZE) -> DataFrame:
    """by, n, quantiles: of all sketches of a group merged."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))
    return merged.select(*by, "n", F.array(*[quantile(F.col("sketch"), F.col("n"), p) for p in probabilities]).alias("quantiles"))


def quantiles_so_far(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ("column",),
                     size: int = SIZE) -> DataFrame:
    """by, snapshot_date, n, quantiles of every month with all months before it.

    A window holds one sketch per calendar month.
    """
    so_far = (Window.partitionBy(*by).orderBy("snapshot_date")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    merged = sketches.select(*by, "snapshot_date", F.sum("n").over(so_far).alias("n"),
                             F.kll_merge_agg_double("sketch", F.lit(size)).over(so_far).alias("sketch"))
    return merged.select(*by, "snapshot_date", "n", F.array(
        *[quantile(F.col("sketch"), F.col("n"), p) for p in probabilities]).alias("quantiles")).distinct()
