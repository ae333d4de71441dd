"""Features meet outcomes, and time decides which rows train, test and validate."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import session
from creditloom.functions.ranks import exact_quantiles, values_at_positions

OFFSET_MONTHS = 6


def default_labels(lms: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """The label store: loans at the given month on book, 1 when at least `dpd` days past due."""
    return lms.where(F.col("mob") == mob).select(
        "loan_id", "Customer_ID",
        F.when(F.col("dpd") >= dpd, 1).otherwise(0).cast("int").alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date")


def align_offset(features: DataFrame, labels: DataFrame, start=None, end=None,
                 months: int = OFFSET_MONTHS) -> DataFrame:
    """Features of the application month with the labels observed `months` later; the result is
    dated by the label. `start`/`end` bound the label date, inclusive."""
    outcomes = labels.select("Customer_ID", "snapshot_date", "label")
    if start is not None:
        outcomes = outcomes.where(F.col("snapshot_date") >= F.lit(start).cast("date"))
    if end is not None:
        outcomes = outcomes.where(F.col("snapshot_date") <= F.lit(end).cast("date"))
    dated = features.withColumn("snapshot_date", F.add_months("snapshot_date", months))
    return dated.join(outcomes, ["Customer_ID", "snapshot_date"], "inner")


def align_same_month(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Every label with the features of its own month, nulls where there are none."""
    return labels.join(features, ["Customer_ID", "snapshot_date"], "left")


def _shift(d: dt.date, months: int) -> dt.date:
    """Calendar shift with the day clamped to the month's end."""
    index = d.year * 12 + d.month - 1 + months
    year, month = divmod(index, 12)
    last = (dt.date(year + month // 11, (month + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(d.day, last))


@dataclass(frozen=True)
class Windows:
    """Label-date ranges of one training run, all inclusive."""

    train_start: dt.date
    train_end: dt.date
    test_end: dt.date
    oot_start: dt.date
    oot_end: dt.date

    @staticmethod
    def before(train_date: str | dt.date, tt_months: int = 12, oot_months: int = 2,
               test_months: int = 2) -> Windows:
        """The last `oot_months` before the training date are out of time; the `tt_months` before
        those are train and test, the last `test_months` of them test."""
        date = dt.date.fromisoformat(train_date) if isinstance(train_date, str) else train_date
        day = dt.timedelta(days=1)
        oot_start = _shift(date, -oot_months)
        test_end = oot_start - day
        return Windows(_shift(oot_start, -tt_months), _shift(test_end, -test_months), test_end,
                       oot_start, date - day)


def temporal_split(df: DataFrame, windows: Windows) -> DataFrame:
    """Adds `split` (train, test, oot) by label date and drops rows outside all windows."""
    d = F.col("snapshot_date")
    split = (F.when(d.between(F.lit(windows.oot_start), F.lit(windows.oot_end)), "oot")
             .when(d.between(F.lit(windows.train_start), F.lit(windows.train_end)), "train")
             .when((d > F.lit(windows.train_end)) & (d <= F.lit(windows.test_end)), "test"))
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def _hash_order(*columns) -> Column:
    """A seeded pseudo-random whole number per row that a double holds exactly."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double")


def stratified_split(df: DataFrame, test_share: float = 0.2, label: str = "label",
                     key: str = "loan_id", seed: int = 88) -> DataFrame:
    """Adds `split` (train, test): ceil(test_share * n) rows of every label test, picked by a
    seeded hash of the key.

    Only the hash value where each label is cut is ranked; rows are then compared with it, so
    nothing but hash values is shuffled. Rows with equal keys stay together. Rows without a label
    are a group of their own.
    """
    ordered = df.withColumn("_order", _hash_order(F.col(key), F.lit(seed)))
    cuts, _ = session.stage(
        exact_quantiles(ordered.select(label, "_order"), [label], "_order", [test_share])
        .select(label, F.col("quantiles")[0].alias("_cut")), "cuts")
    split = F.when(F.col("_order") <= F.col("_cut"), "test").otherwise("train")
    cuts = cuts.withColumnRenamed(label, "_label")
    return (ordered.join(cuts, F.col(label).eqNullSafe(F.col("_label")), "left")
            .withColumn("split", split).drop("_order", "_cut", "_label"))


def split_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("bad_rate"))


def expanding_folds(df: DataFrame, folds: int = 3, key: str = "Customer_ID") -> DataFrame:
    """Adds `block` 0..folds: rows in date order cut into folds+1 blocks, the last `folds` of them
    of n // (folds+1) rows. Fold i trains on blocks < i and tests on block i, for i = 1..folds."""
    # Date plus a hash fraction: an order that puts months one after another and cuts inside them.
    order = F.unix_date("snapshot_date") + _hash_order(key, "snapshot_date") / F.lit(2.0 ** 52)
    ordered = df.withColumn("_order", order)
    starts = [f"n_total - {folds - i} * (n_total div {folds + 1})" for i in range(folds)]
    cuts = values_at_positions(ordered.select("_order"), "_order", starts)
    block = " + ".join(f"int(_order >= {c!r}D)" for c in cuts) or "0"
    return ordered.withColumn("block", F.expr(block)).drop("_order")
