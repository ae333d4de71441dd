"""Loan-type lists as token counts. Counting happens inside each row, so nothing is shuffled
except the distinct tokens that name the output columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions import text


def bounded_labels(df: DataFrame, column: str) -> list[str]:
    """The distinct labels of a column that will name output columns, in the frame's order.

    A table cannot have unbounded columns: like Spark's own pivot, more labels than
    `spark.sql.pivotMaxValues` is an error rather than a truncation.
    """
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    labels = [r[0] for r in df.select(column).limit(most + 1).collect()]
    if len(labels) > most:
        raise ValueError(f"{column} has more than {most} distinct labels")
    return labels


def loan_type_counts(raw: DataFrame) -> DataFrame:
    """Customer_ID, snapshot_date and the map of loan type to count."""
    return raw.select(
        "Customer_ID",
        text.as_date(F.col("snapshot_date")).alias("snapshot_date"),
        text.token_counts(text.list_tokens(F.col("Type_of_Loan"))).alias("loan_type_counts"))


def loan_type_long(raw: DataFrame) -> DataFrame:
    return loan_type_counts(raw).select(
        "Customer_ID", "snapshot_date", F.explode("loan_type_counts").alias("loan_type", "n"))


def distinct_loan_types(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    types = raw.select(
        *[text.as_date(F.col(k)).alias(k) for k in keys],
        F.explode(text.list_tokens(F.col("Type_of_Loan"))).alias("loan_type"))
    return types.distinct()


def loan_type_vocabulary(raw: DataFrame) -> list[str]:
    return sorted(bounded_labels(distinct_loan_types(raw), "loan_type"))


def loan_type_columns(raw: DataFrame, vocabulary: Sequence[str] | None = None) -> DataFrame:
    """One `loan_<type>` count column per vocabulary entry; absent types are 0, types outside the
    vocabulary are ignored. `vocabulary=None` reads it from the data."""
    names = loan_type_vocabulary(raw) if vocabulary is None else vocabulary
    tokens = raw.select(
        "Customer_ID", text.as_date(F.col("snapshot_date")).alias("snapshot_date"),
        text.list_tokens(F.col("Type_of_Loan")).alias("tokens"))
    return tokens.select(
        "Customer_ID", "snapshot_date",
        *[text.count_in(F.col("tokens"), n).alias(f"loan_{n}") for n in names])
