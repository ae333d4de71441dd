"""What is known about each customer, carried from month to month.

The state has one row per customer: the latest row of every source with its date, and running sums and
counts of the behaviour columns. A month adds its own rows and nothing older is read again; joined with
the month's applications, the state gives what `as_of` finds by reading all history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.ranks import exact_quantiles
from creditloom.operators.point_in_time import KEYS, monthly_sums, one_row_per


def extend(before: DataFrame | None, sources: Mapping[str, DataFrame], history: DataFrame | None = None,
           history_columns: Sequence[str] = ()) -> DataFrame:
    """The state after the rows of `sources` and `history`, which are dated later than all in `before`.

    Rows are reduced to one per customer and date first. What is grouped then is one row per customer
    of the old state and few of the new months.
    """
    parts = [] if before is None else [before]
    for name, source in sources.items():
        columns = [c for c in source.columns if c not in KEYS]
        parts.append(one_row_per(source).select(
            "Customer_ID", F.struct(F.col("snapshot_date").alias("_date"), *columns).alias(f"_src_{name}")))
    if history is not None:
        parts.append(monthly_sums(history, history_columns).drop("snapshot_date"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    # The date is the first field, so the greatest struct is the latest row.
    return rows.groupBy("Customer_ID").agg(
        *[F.max(f"_src_{name}").alias(f"_src_{name}") for name in sources],
        *[F.sum(f"{c}_{kind}").alias(f"{c}_{kind}") for c in history_columns for kind in ("sum", "n")])


def as_of_state(anchors: DataFrame, state: DataFrame, sources: Mapping[str, DataFrame],
                history_columns: Sequence[str] = ()) -> DataFrame:
    """The anchors of one month with the state at its end: the columns of `point_in_time.as_of`."""
    out = [F.col(c) for c in [*KEYS, *[c for c in anchors.columns if c not in KEYS]]]
    for name, source in sources.items():
        out += [F.col(f"_src_{name}.{c}") for c in source.columns if c not in KEYS]
    out += [F.try_divide(F.col(f"{c}_sum"), F.col(f"{c}_n")).alias(c) for c in history_columns]
    return anchors.join(state, "Customer_ID", "left").select(*out)


def value_counts(before: DataFrame | None, history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, n: how often each value of each column has occurred so far."""
    fresh = (history.select(*[F.col(c).cast("double").alias(c) for c in columns])
             .unpivot([], list(columns), "column", "value").where("value is not null")
             .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    if before is None:
        return fresh
    return before.unionByName(fresh).groupBy("column", "value").agg(F.sum("n").alias("n"))


def medians_of(counts: DataFrame, month, columns: Sequence[str]) -> DataFrame:
    """snapshot_date, column, median of a month from the value counts up to it; 0.0 without values."""
    found = exact_quantiles(counts, ["column"], "value", [0.5], weight="n").select(
        "column", F.col("quantiles")[0].alias("median"))
    every = counts.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))
    return every.join(found, "column", "left").select(
        F.lit(month).cast("date").alias("snapshot_date"), "column", F.coalesce("median", F.lit(0.0)).alias("median"))
