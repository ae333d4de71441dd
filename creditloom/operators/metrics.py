"""Ranking, decision and calibration metrics per group, from one pass over the scored rows.

Rows are first combined to (group, score) with counts of good and bad; everything else is computed
from that table, so a score that many rows share, or a group holding most rows, costs one row per
distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.ranks import exact_quantiles, running_totals

THRESHOLD = 0.5


def score_counts(df: DataFrame, keys: Sequence[str], score: str = "model_predictions",
                 label: str = "label") -> DataFrame:
    bad = F.col(label) == 1
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*keys, F.col(score).alias("score"))
            .agg(F.count_if(bad).alias("pos"), F.count_if(~bad).alias("neg")))


def _share(a: Column, b: Column) -> Column:
    """a/b, 0 where nothing can be divided."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def classification_metrics(df: DataFrame, keys: Sequence[str], score: str = "model_predictions",
                           label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """n, n_pos, auc, gini, precision, recall, f1, brier per group; all metrics are null unless
    both classes occur."""
    return count_metrics(score_counts(df, keys, score, label), keys, threshold)


def count_metrics(counts: DataFrame, keys: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """The same from counts: one row per group and score with `pos` and `neg`."""
    keys = list(keys)
    ranked = running_totals(counts, keys, "score", "neg")
    c = F.col
    predicted = c("score") >= threshold
    sums = ranked.groupBy(*keys).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(F.when(predicted, c("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(predicted, c("neg")).otherwise(0)).alias("fp"),
        # Pairs ordered correctly, ties counting one half.
        F.sum(c("pos").cast("double") * (c("neg_below") + c("neg") / F.lit(2.0))).alias("pairs"),
        F.sum(c("pos") * (1 - c("score")) * (1 - c("score")) + c("neg") * c("score") * c("score"))
        .alias("squares"))
    both = (c("P") > 0) & (c("N") > 0)
    auc = c("pairs") / (c("P").cast("double") * c("N"))
    return sums.select(
        *keys, (c("P") + c("N")).alias("n"), c("P").alias("n_pos"),
        F.when(both, auc).alias("auc"),
        F.when(both, 2 * auc - 1).alias("gini"),
        F.when(both, _share(c("tp"), c("tp") + c("fp"))).alias("precision"),
        F.when(both, _share(c("tp"), c("P"))).alias("recall"),
        F.when(both, _share(2 * c("tp"), c("tp") + c("fp") + c("P"))).alias("f1"),
        F.when(both, c("squares") / (c("P") + c("N"))).alias("brier"))


def round_metrics(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Rounded values; unknown ones (null or NaN) stay null."""
    return df.selectExpr(*[
        f"round(nullif(`{c}`, double('NaN')), {digits}) as `{c}`" if c in columns else f"`{c}`"
        for c in df.columns])


def reliability(df: DataFrame, keys: Sequence[str], score: str = "model_predictions",
                label: str = "label", bins: int = 10) -> DataFrame:
    """Mean score and observed rate per quantile bin of the score; empty bins give no row. A score
    equal to an edge belongs to the bin below it."""
    keys = list(keys)
    counts = score_counts(df, keys, score, label).withColumn("n", F.col("pos") + F.col("neg"))
    inner = [i * (1.0 / bins) for i in range(1, bins)]
    edges = exact_quantiles(counts, keys, "score", inner, interpolate=True, weight="n")
    number = F.expr(" + ".join(f"int(score > quantiles[{i}])" for i in range(bins - 1)))
    binned = counts.join(edges, keys)
    return (binned.withColumn("bin", number).groupBy(*keys, "bin")
            .agg(F.sum("n").alias("n"),
                 (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_predicted"),
                 (F.sum("pos") / F.sum("n")).alias("observed_rate")))


def verdict(score: Column, threshold: float = THRESHOLD) -> Column:
    return (score >= threshold).cast("int")


def score_summary(predictions: DataFrame, keys: Sequence[str] = ("model_name", "snapshot_date")):
    """Scored rows, mean score, predicted defaults and their share per group."""
    return predictions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.avg("model_predictions").alias("mean_score"),
        F.sum("prediction_label").alias("n_default"),
        F.avg("prediction_label").alias("default_rate"))
