"""Scores: column alignment, prediction tables, and their join with outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators.metrics import THRESHOLD, verdict

OFFSET_MONTHS = 6


def align_to_model(df: DataFrame, feature_columns: Sequence[str],
                   keep: Sequence[str] = ("Customer_ID", "snapshot_date")) -> DataFrame:
    """Exactly the model's columns in its order; a column the data lacks is 0."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0).alias(c)
                              for c in feature_columns])


def missing_columns(df: DataFrame, feature_columns: Sequence[str]) -> list[str]:
    return [c for c in feature_columns if c not in df.columns]


def prediction_rows(scored: DataFrame, model_name: str, score: Column, label_months: int = 0,
                    threshold: float = THRESHOLD) -> DataFrame:
    """The predictions table: dated `label_months` after the features, with verdict."""
    date = F.add_months("snapshot_date", label_months) if label_months else F.col("snapshot_date")
    return (scored.select("Customer_ID", date.alias("snapshot_date"),
                          F.lit(model_name).alias("model_name"), score.alias("model_predictions"))
            .withColumn("prediction_label", verdict(F.col("model_predictions"), threshold)))


def with_outcomes(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions with the outcomes of the same customer and month."""
    return predictions.join(labels.select("Customer_ID", "snapshot_date", "label"),
                            ["Customer_ID", "snapshot_date"], "inner")


def direct_months(predictions: DataFrame, labels: DataFrame,
                  keys: Sequence[str] = ("model_name", "snapshot_date")) -> DataFrame:
    """The months of `keys` in which any prediction has an outcome of the same month."""
    outcomes = labels.select("Customer_ID", "snapshot_date")
    return (predictions.select(*dict.fromkeys([*keys, "Customer_ID", "snapshot_date"]))
            .join(outcomes, ["Customer_ID", "snapshot_date"], "left_semi")
            .select(*keys).distinct())


def with_month_outcomes(predictions: DataFrame, labels: DataFrame, months: int = OFFSET_MONTHS,
                        keys: Sequence[str] = ("model_name", "snapshot_date")) -> DataFrame:
    """Predictions with outcomes of the same month (`offset` 0) where the month has any, else of
    `months` later (`offset` = months). Every prediction has one label date and is joined once."""
    direct, _ = session.stage(
        direct_months(predictions, labels, keys).withColumn("_direct", F.lit(True)), "direct")
    dated = (predictions.join(direct, list(keys), "left")
             .withColumn("offset", F.when(F.col("_direct"), 0).otherwise(months))
             .withColumn("label_date", F.add_months("snapshot_date", F.col("offset")))
             .drop("_direct"))
    outcomes = labels.select("Customer_ID", F.col("snapshot_date").alias("label_date"), "label")
    return dated.join(outcomes, ["Customer_ID", "label_date"], "inner")
