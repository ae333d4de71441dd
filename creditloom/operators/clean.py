"""Raw text tables to typed, validated tables. One projection per table, no UDF, no shuffle except
the per-month quantiles of the outlier clip."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import schemas, session
from creditloom.functions import loans, text
from creditloom.functions.ranks import column_quantiles


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns, keep the others."""
    return df.select(*[
        text.CASTS[types[c]](F.col(c)).alias(c) if c in types else F.col(c) for c in df.columns])


def at_snapshot(df: DataFrame, snapshot_date: str | Column) -> DataFrame:
    value = F.lit(snapshot_date).cast("date") if isinstance(snapshot_date, str) else snapshot_date
    return df.where(F.col("snapshot_date") == value)


def loan_status(df: DataFrame) -> DataFrame:
    """Adds mob, installments_missed, first_missed_date and dpd to typed loan rows."""
    c = F.col
    return (
        df.select("*", loans.month_on_book(c("installment_num")).alias("mob"),
                  loans.installments_missed(c("overdue_amt"), c("due_amt"))
                  .alias("installments_missed"))
        .select("*", loans.first_missed_date(c("snapshot_date"), c("installments_missed"))
                .alias("first_missed_date"))
        .select("*", loans.days_past_due(c("overdue_amt"), c("snapshot_date"),
                                         c("first_missed_date")).alias("dpd"))
    )


def clean_lms(raw: DataFrame) -> DataFrame:
    return loan_status(typed(raw, schemas.LMS))


def clean_attributes(raw: DataFrame) -> DataFrame:
    c = F.col
    return raw.select(
        "Customer_ID",
        "Name",
        text.only_between(text.number(c("Age"), "int"), 0, 120).alias("Age"),
        text.only_matching(c("SSN"), text.SSN).alias("SSN"),
        F.nullif(c("Occupation"), F.lit("_______")).alias("Occupation"),
        text.as_date(c("snapshot_date")).alias("snapshot_date"),
    )


def financial_values(raw: DataFrame) -> DataFrame:
    """All financial cleaning up to, but without, the outlier clip."""
    c = F.col

    def value(name: str, type_name: str) -> Column:
        v = text.number(c(name), type_name)
        return text.only_non_negative(v) if name in schemas.NON_NEGATIVE else v

    return raw.select(
        "Customer_ID",
        text.as_date(c("snapshot_date")).alias("snapshot_date"),
        *[value(n, t).alias(n) for n, t in schemas.FINANCIAL_NUMBERS.items()],
        text.duration_months(c("Credit_History_Age")).alias("Credit_History_Age"),
        F.nullif(c("Credit_Mix"), F.lit("_")).alias("Credit_Mix"),
        "Payment_of_Min_Amount",
        text.spend_level(c("Payment_Behaviour")).alias("payment_behaviour_spent"),
        text.payment_value(c("Payment_Behaviour")).alias("payment_behaviour_value"),
    )


def clip_to_quantile(df: DataFrame, columns: Sequence[str], probability: float = 0.97,
                     keys: Sequence[str] = ("snapshot_date",), exact: bool = False) -> DataFrame:
    """Values above the group's quantile become the quantile; nulls and the low tail stay."""
    limits, _ = session.stage(
        column_quantiles(df, keys, columns, [probability], exact)
        .select(*keys, *[F.col(c)[0].alias(f"_{c}_limit") for c in columns]), "limits")

    def clipped(name: str, type_name: str) -> Column:
        limit = F.col(f"_{name}_limit")
        return (F.when(F.col(name) > limit, limit.cast(type_name))
                .otherwise(F.col(name)).alias(name))

    kinds = dict(df.dtypes)
    joined = df.join(limits, list(keys), "left")
    return joined.select(*[clipped(c, kinds[c]) if c in columns else F.col(c) for c in df.columns])


def clean_financials(raw: DataFrame, exact: bool = False) -> DataFrame:
    return clip_to_quantile(financial_values(raw), schemas.CLIPPED, exact=exact)


def clean_clickstream(raw: DataFrame) -> DataFrame:
    return typed(raw.select(*schemas.CLICKSTREAM), schemas.CLICKSTREAM)
