"""Population stability of scores and features against a fixed baseline month.

Bin edges are exact deciles of the baseline, one array per score or feature. Every row is then
binned by comparing it with its array (a small staged table that the planner may broadcast) and
counted into ten columns before anything is shuffled, so a month costs one row however many
customers it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import session
from creditloom.functions.ranks import exact_quantiles

BINS = 10
MIN_SHARE = 1e-4
DRIFT_THRESHOLD = 0.25
MODERATE_THRESHOLD = 0.10
AUC_DROP_THRESHOLD = 0.05
BRIER_RISE_THRESHOLD = 0.05
TOP_FEATURES = 15


def first_months(predictions: DataFrame) -> DataFrame:
    """The earliest scored month of every model: the fixed reference."""
    return predictions.groupBy("model_name").agg(F.min("snapshot_date").alias("baseline_date"))


def _bin_counts(df: DataFrame, keys: Sequence[str], value: str, bins: int,
                weight: str | None = None) -> DataFrame:
    """Rows per bin as columns; `df` carries the inner edges in `edges`. Equal edges only make
    bins that stay empty on both sides, which contribute nothing. `weight` counts repeated rows."""
    number = " + ".join(f"int(`{value}` >= edges[{i}])" for i in range(bins - 1))
    times = F.lit(1) if weight is None else F.col(weight)
    counted = ", ".join(f"'bin_{b}', sum(if(_bin = {b}, _times, 0L))" for b in range(bins))
    return (df.select(*keys, F.expr(number).alias("_bin"), times.cast("long").alias("_times")).groupBy(*keys)
            .agg(F.expr(f"named_struct('n', sum(if(_bin is null, 0L, _times)), {counted})").alias("counts")))


def _index(bins: int) -> Column:
    """Sum over bins of (actual - expected) * ln(actual / expected) with floored shares."""
    share = lambda side, b: f"greatest({side}.bin_{b} / {side}.n, {MIN_SHARE}D)"
    return F.expr(" + ".join(
        f"({share('a', b)} - {share('e', b)}) * ln({share('a', b)} / {share('e', b)})"
        for b in range(bins)))


def _known(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is a number: neither null nor NaN."""
    return df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))


def binned_pairs(values: DataFrame, baseline: DataFrame, by: Sequence[str], over: Sequence[str],
                 value: str, bins: int = BINS, weight: str | None = None) -> DataFrame:
    """Bin counts of every (by, over) group of `values` next to those of its `by` baseline.

    Columns: by, over, struct `a` (actual: n, bin_0 ...) and struct `e` (expected), null without a
    baseline. Nulls and NaN are not counted.
    """
    by, over = list(by), list(over)
    values, baseline = _known(values, value), _known(baseline, value)
    inner = [i * (1.0 / bins) for i in range(1, bins)]
    edges, _ = session.stage(
        exact_quantiles(baseline, by, value, inner, interpolate=True, weight=weight)
        .withColumnRenamed("quantiles", "edges"), "edges")
    expected = _bin_counts(baseline.join(edges, by), by, value, bins, weight)
    actual = _bin_counts(values.join(edges, by, "left"), [*by, *over], value, bins, weight)
    # Both sides are one row per group by now.
    return actual.withColumnRenamed("counts", "a").join(
        expected.withColumnRenamed("counts", "e"), by, "left")


def stability(values: DataFrame, baseline: DataFrame, by: Sequence[str], over: Sequence[str],
              value: str, bins: int = BINS, weight: str | None = None) -> DataFrame:
    """The index of every (by, over) group of `values` against the `by` group of `baseline`.

    Columns: by, over, n, psi. The index is null where the baseline is empty, and for fewer than
    two bins.
    """
    by, over = list(by), list(over)
    if bins < 2:
        return _known(values, value).groupBy(*by, *over).agg(
            (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"), F.lit(None).cast("double").alias("psi"))
    return binned_pairs(values, baseline, by, over, value, bins, weight).select(
        *by, *over, "a.n", F.when(F.col("e.n") > 0, _index(bins)).alias("psi"))


def first_month_rows(predictions: DataFrame, scored_months: DataFrame | None = None) -> DataFrame:
    """The predictions of every model's first scored month. `scored_months` (model_name,
    snapshot_date) saves a pass when the months are already known."""
    start, _ = session.stage(
        first_months(predictions if scored_months is None else scored_months), "first_months")
    return only_dates(predictions, start.select("baseline_date")).join(start, "model_name").where(
        F.col("snapshot_date") == F.col("baseline_date")).drop("baseline_date")


def only_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of the given snapshot dates, as literals, so that a scan lists only their partitions.
    `dates` is one column of calendar months, a few hundred values at most."""
    wanted = [r[0] for r in dates.distinct().collect()]
    return df.where(F.col("snapshot_date").isin(wanted))


def score_psi(predictions: DataFrame, bins: int = BINS,
              scored_months: DataFrame | None = None) -> DataFrame:
    """model_name, snapshot_date, n, psi of every scored month against the model's first."""
    baseline = first_month_rows(predictions, scored_months)
    return stability(predictions, baseline, ["model_name"], ["snapshot_date"],
                     "model_predictions", bins)


def feature_long(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """snapshot_date, feature, value for the named features that exist."""
    present = [c for c in columns if c in features.columns]
    return features.selectExpr(
        "snapshot_date", *[f"double(`{c}`) as `{c}`" for c in present]
    ).unpivot(["snapshot_date"], [F.col(f"`{c}`") for c in present], "feature", "value")


def feature_csi(features: DataFrame, columns: Sequence[str], baseline_date,
                bins: int = BINS) -> DataFrame:
    """feature, snapshot_date, n, psi of every month against the baseline month."""
    long = feature_long(features, columns)
    baseline = feature_long(
        features.where(F.col("snapshot_date") == F.lit(baseline_date).cast("date")), columns)
    return stability(long, baseline, ["feature"], ["snapshot_date"], "value", bins)


def csi_scope(feature_columns: DataFrame, importance: DataFrame | None = None,
              top_n: int = TOP_FEATURES) -> DataFrame:
    """The features to watch: by stored rank, or by position where no ranking exists.

    `feature_columns` has (feature, position); `importance` has (feature, rank). Both are one row
    per model input.
    """
    if importance is not None:
        ranked = importance.join(feature_columns, "feature").select("feature", "rank", "position")
    else:
        ranked = feature_columns.select("feature", F.col("position").alias("rank"), "position")
    return ranked.orderBy("rank", "position").limit(top_n)


def worst_feature(csi: DataFrame, keys: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """csi_max and csi_max_feature per group; unknown values are ignored, the first feature in
    `position` order wins a tie."""
    known = F.when(F.col("psi").isNotNull(), F.struct(F.col("psi"), -F.col("position")))
    return csi.groupBy(*keys).agg(
        F.max("psi").alias("csi_max"),
        F.max_by("feature", known).alias("csi_max_feature"))


def drift_band(value: Column) -> Column:
    return (F.when(value > DRIFT_THRESHOLD, "significant")
            .when(value > MODERATE_THRESHOLD, "moderate")
            .when(value.isNotNull(), "stable").otherwise("n/a"))


def auc_drop(oot_auc: Column, auc: Column, digits: int = 4) -> Column:
    return F.round(oot_auc - auc, digits)


def latest_row(monitoring: DataFrame, keys: Sequence[str] = ("model_name",)) -> DataFrame:
    """The newest monitoring row per model."""
    rest = [c for c in monitoring.columns if c not in keys]
    return (monitoring.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), "snapshot_date").alias("_row"))
            .select(*keys, "_row.*"))


def first_row_brier(monitoring: DataFrame, keys: Sequence[str] = ("model_name",)) -> DataFrame:
    return monitoring.groupBy(*keys).agg(
        F.min_by(F.struct("brier"), "snapshot_date")["brier"].alias("baseline_brier"))


def breach(monitoring: DataFrame, baseline_brier: DataFrame) -> DataFrame:
    """The newest month of each model with the rules it breaks.

    `baseline_brier` has (model_name, baseline_brier): the value stored at training, or
    `first_row_brier`.
    """
    c = F.col
    rise = c("brier") - c("baseline_brier")
    shown = lambda name, value, limit: F.format_string(f"{name}=%.4f > {limit}", value)
    rules = [
        (c("psi") > DRIFT_THRESHOLD, shown("PSI", c("psi"), DRIFT_THRESHOLD)),
        (c("csi_max") > DRIFT_THRESHOLD, shown("CSI_max", c("csi_max"), DRIFT_THRESHOLD)),
        ((c("auc_drop_from_oot1") > AUC_DROP_THRESHOLD) & c("auc").isNotNull(),
         shown("AUC drop", c("auc_drop_from_oot1"), AUC_DROP_THRESHOLD)),
        (rise > BRIER_RISE_THRESHOLD, shown("Brier increase", rise, BRIER_RISE_THRESHOLD)),
    ]
    latest = latest_row(monitoring).join(baseline_brier, "model_name", "left")
    any_broken = F.greatest(*[F.coalesce(rule, F.lit(False)).cast("int") for rule, _ in rules]) == 1
    return latest.select(
        "model_name", "snapshot_date", any_broken.alias("breached"),
        F.concat_ws("; ", *[F.when(rule, text) for rule, text in rules]).alias("reasons"))


def previous_month(monitoring: DataFrame, months: DataFrame) -> DataFrame:
    """Each (model_name, ds) of `months` with the monitoring row of exactly one month earlier."""
    earlier = monitoring.withColumn("ds", F.add_months("snapshot_date", 1))
    return months.join(earlier, ["model_name", "ds"], "left")


def previous_month_breach(monitoring: DataFrame, months: DataFrame,
                          threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Per (model_name, ds): whether the month before drifted, PSI checked first, and why. A model
    without any monitoring row has no history yet, which is no breach."""
    c = F.col
    seen = monitoring.select("model_name", F.lit(True).alias("_seen")).distinct()
    before = F.date_format(F.add_months("ds", -1), "yyyy-MM-dd")
    where = F.concat(F.lit(" for "), c("model_name"), F.lit(" at "), before)
    by_psi, by_csi = c("psi") > threshold, c("csi_max") > threshold
    # Fixed output contract: the texts that alerts are read by.
    message = (
        F.when(c("_seen").isNull(), F.concat(F.lit("no monitoring history yet for "), c("model_name"),
                                             F.lit(" (first eligible month)")))
        .when(c("snapshot_date").isNull(),
               F.concat(F.lit("no monitoring row found"), where))
        .when(by_psi, F.concat(F.format_string(f"PSI=%.4f > {threshold}", "psi"), where))
        .when(by_csi, F.concat(F.format_string(f"CSI=%.4f > {threshold} on '%s'", "csi_max",
                                               F.coalesce("csi_max_feature", F.lit("unknown"))),
                               where))
        .otherwise(F.concat(F.lit("no drift breach"), where)))
    return previous_month(monitoring, months).join(seen, "model_name", "left").select(
        "model_name", "ds",
        (F.coalesce(by_psi, F.lit(False)) | F.coalesce(by_csi, F.lit(False))).alias("breached"),
        message.alias("message"))
