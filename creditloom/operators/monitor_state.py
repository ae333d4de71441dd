"""What monitoring needs of predictions and outcomes, as a table that months are added to.

A month of a model is kept as one row per distinct score: how often it was given, and how many of the
scored customers were good and bad in the same month and `OFFSET_MONTHS` later. Volume, score drift,
ranking and calibration all follow from these rows, so predictions are read once, and a late
outcome changes the rows of its own months only. Months are dated by their first day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators import drift
from creditloom.operators.metrics import count_metrics
from creditloom.operators.scoring import OFFSET_MONTHS

KEYS = ["model_name", "snapshot_date"]
COUNTS = ["n", "n_same", "pos_same", "neg_same", "pos_later", "neg_later"]


def outcome_counts(labels: DataFrame, months: int = OFFSET_MONTHS) -> DataFrame:
    """Per customer and scored month: outcomes of that month and of `months` later, good and bad.
    A customer with several outcomes in a month still has one row."""
    c = F.col
    dated = labels.select("Customer_ID", "label", F.explode(F.array(
        F.struct(c("snapshot_date").alias("snapshot_date"), F.lit(False).alias("later")),
        F.struct(F.add_months("snapshot_date", -months).alias("snapshot_date"), F.lit(True).alias("later")))).alias("d"))
    bad, good, later = c("label") == 1, c("label") != 1, c("d.later")
    return dated.groupBy("Customer_ID", c("d.snapshot_date").alias("snapshot_date")).agg(
        F.count_if(~later).alias("n_same"),
        F.count_if(bad & ~later).alias("pos_same"), F.count_if(good & ~later).alias("neg_same"),
        F.count_if(bad & later).alias("pos_later"), F.count_if(good & later).alias("neg_later"))


def score_state(predictions: DataFrame, labels: DataFrame, months: int = OFFSET_MONTHS) -> DataFrame:
    """model_name, snapshot_date, score and `COUNTS`: one row per model, month and distinct score."""
    joined = predictions.select("Customer_ID", *KEYS, F.col("model_predictions").alias("score")).join(
        outcome_counts(labels, months), ["Customer_ID", "snapshot_date"], "left")
    return joined.groupBy(*KEYS, "score").agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS[1:]])


def merged(*states: DataFrame) -> DataFrame:
    """States of disjoint sets of predictions as one."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy(*KEYS, "score").agg(*[F.sum(c).alias(c) for c in COUNTS])


def month_totals(state: DataFrame) -> DataFrame:
    """Volume and mean score per model and month, and whether its outcomes are those of the same month."""
    return state.groupBy(*KEYS).agg(
        F.sum("n").alias("n_scored"),
        (F.sum(F.col("score") * F.col("n")) / F.sum(F.when(F.col("score").isNotNull(), F.col("n")))).alias("mean_score"),
        (F.sum("n_same") > 0).alias("direct"))


def quality(state: DataFrame, totals: DataFrame) -> DataFrame:
    """The metrics of every model and month. A month with any outcome of the same month is measured on
    those, every other on the later ones."""
    c = F.col
    pick = lambda side: F.when(c("direct"), c(f"{side}_same")).otherwise(c(f"{side}_later")).alias(side)
    counts = state.join(totals.select(*KEYS, "direct"), KEYS).select(*KEYS, "score", pick("pos"), pick("neg"))
    return count_metrics(counts.where(c("score").isNotNull() & (c("pos") + c("neg") > 0)), KEYS)


def psi(state: DataFrame, first_months: DataFrame) -> DataFrame:
    """Score drift of every model and month of `state` against the model's first month, which must be
    among them. `first_months` has (model_name, baseline_date)."""
    start, _ = session.stage(first_months, "first_months")
    baseline = drift.only_dates(state, start.select("baseline_date")).join(start, "model_name").where(
        F.col("snapshot_date") == F.col("baseline_date"))
    return drift.stability(state, baseline, ["model_name"], ["snapshot_date"], "score", weight="n")
