"""What was known about a customer at an application date.

All sources meet the applications in one exchange: their rows are put under each other and read in
date order per customer, the smallest of a customer and date last, so an application is never
multiplied. Only where one customer has more rows than a task should sort are they reduced to one per
customer and date before the exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom import session

KEYS = ["Customer_ID", "snapshot_date"]

# Rows of all sources that one partition of the sort by customer and date is meant to hold.
SORT_ROWS = 250_000


def one_row_per(df: DataFrame, keys: Sequence[str] = KEYS, order: str | None = None) -> DataFrame:
    """One row per key, combined before the shuffle: the row with the smallest `order`, or the
    smallest row when no order is given.

    A minimum of whole rows sorts and shuffles them all. Without an order (rows of any width) the keys
    are counted first, and only rows whose key repeats are compared; with more than
    `session.SINGLE_TASK_ROWS` repeated keys, all of them are.
    """
    rest = [c for c in df.columns if c not in keys]

    def least(rows: DataFrame) -> DataFrame:
        row = F.struct(*rest)
        picked = F.min(row) if order is None else F.min_by(row, order)
        return rows.groupBy(*keys).agg(picked.alias("_row")).select(*keys, "_row.*")

    if order is not None:
        return least(df)
    repeated, n = session.stage(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        .select(*[F.col(k).alias(f"_repeated_{k}") for k in keys]), "repeated")
    if n == 0:
        return df.select(*keys, *rest)
    if n > session.SINGLE_TASK_ROWS:
        return least(df)
    same = [F.col(k).eqNullSafe(F.col(f"_repeated_{k}")) for k in keys]
    return df.join(repeated, same, "left_anti").select(*keys, *rest).unionByName(
        least(df.join(repeated, same, "left_semi")))


def applications(lms: DataFrame, mob: int = 0) -> DataFrame:
    """Customers applying in each month, with the loan of the lowest loan_id."""
    return one_row_per(
        lms.where(F.col("mob") == mob)
        .select("Customer_ID", "snapshot_date", "loan_id", "loan_amt", "tenure"),
        order="loan_id").drop("loan_id")


def monthly_sums(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum and non-null count of each column per customer and date: enough for any later mean."""
    return history.groupBy(*KEYS).agg(
        *[F.expr(f"sum(double(`{c}`))").alias(f"{c}_sum") for c in columns],
        *[F.expr(f"count(`{c}`)").alias(f"{c}_n") for c in columns])


def _sizes(tables: Sequence[DataFrame]) -> tuple[int, int]:
    """Rows of all tables, and rows of the customer with the most of them: from a sketch, too many by a
    two-thousandth of all rows at most, so that no key is shuffled to be counted."""
    keys = tables[0].select("Customer_ID")
    for table in tables[1:]:
        keys = keys.unionAll(table.select("Customer_ID"))
    n, top = keys.agg(F.count(F.lit(1)), F.expr("approx_top_k(Customer_ID, 1, 10000)")).first()
    return n, top[0]["count"] if top else 0


def as_of(anchors: DataFrame, sources: Mapping[str, DataFrame],
          history: DataFrame | None = None, history_columns: Sequence[str] = (),
          dates: bool = False) -> DataFrame:
    """Each anchor with the latest row of every source, and the mean of `history_columns`, dated
    on or before it. Anchors without such rows get nulls. `dates` adds `<source>_date`.

    Of several source rows of a customer and date the smallest counts. Anchors must be unique per
    customer and date.
    """
    columns = {name: [c for c in source.columns if c not in KEYS] for name, source in sources.items()}
    anchor_columns = [c for c in anchors.columns if c not in KEYS]
    tables = [*sources.values(), *([] if history is None else [history])]
    n, most = _sizes(tables) if tables else (0, 0)
    crowded = most > session.SINGLE_TASK_ROWS

    rows = anchors.select(*KEYS, F.struct(F.lit(1).alias("_is"), *anchor_columns).alias("_anchor"))
    for name, source in sources.items():
        source = one_row_per(source) if crowded else source
        rows = rows.unionByName(source.select(
            *KEYS, F.struct(F.col("snapshot_date").alias("_date"), *columns[name]).alias(f"_src_{name}")),
            allowMissingColumns=True)
    if history is not None:
        # One struct, so that the rows of other sources do not carry an empty field per column.
        values = [F.expr(f"double(`{c}`)").alias(c) for c in history_columns]
        if crowded:
            history = monthly_sums(history, history_columns)
            values = [c for c in history.columns if c not in KEYS]
        rows = rows.unionByName(history.select(*KEYS, F.struct(*values).alias("_history")),
                                allowMissingColumns=True)
    # Before the window takes the fields out of the structs: what is shuffled and sorted stays narrow.
    # Compressed bytes, by which Spark would join partitions, are a tenth of what a sort holds, so
    # their number is fixed, and grows with the rows.
    parts = max(int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // SORT_ROWS))
    rows = rows.repartition(parts, "Customer_ID").sortWithinPartitions(
        *KEYS, *[F.desc(f"_src_{name}") for name in sources])

    so_far = (Window.partitionBy("Customer_ID").orderBy("snapshot_date")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    known = [F.last(f"_src_{name}", ignorenulls=True).over(so_far).alias(f"_src_{name}")
             for name in sources]
    means = []
    if history is not None:
        total, count = ("sum(_history.`{}_sum`)", "sum(_history.`{}_n`)") if crowded else (
            "sum(_history.`{}`)", "count(_history.`{}`)")
        means = [F.try_divide(F.expr(total.format(c)).over(so_far), F.expr(count.format(c)).over(so_far)).alias(c)
                 for c in history_columns]
    seen = rows.select(*KEYS, "_anchor", *known, *means).where(F.col("_anchor").isNotNull())
    out = [*KEYS, *[f"_anchor.{c}" for c in anchor_columns]]
    for name in sources:
        if dates:
            out.append(F.col(f"_src_{name}._date").alias(f"{name}_date"))
        out += [f"_src_{name}.{c}" for c in columns[name]]
    return seen.select(*out, *(history_columns if history is not None else []))


def left_as_coded(anchors: DataFrame, source: DataFrame) -> DataFrame:
    """The plain left join on the customer alone: every snapshot of the source matches, also later
    ones. Equal to `as_of` when each customer has one snapshot not later than the application."""
    return anchors.join(source.drop("snapshot_date"), "Customer_ID", "left")


def latest_application(anchors: DataFrame) -> DataFrame:
    """One application per customer: its most recent."""
    return anchors.groupBy("Customer_ID").agg(F.max("snapshot_date").alias("application_date"))


def history_of(history: DataFrame, last_applications: DataFrame) -> DataFrame:
    """History rows of customers that applied, any date; at most one match per history row."""
    return history.join(last_applications, "Customer_ID", "inner")


def history_until(history: DataFrame, last_applications: DataFrame) -> DataFrame:
    """History rows dated on or before the customer's application."""
    return history.join(
        last_applications,
        (history["Customer_ID"] == last_applications["Customer_ID"])
        & (history["snapshot_date"] <= last_applications["application_date"]),
        "inner").drop(last_applications["Customer_ID"])


def history_mean(anchors: DataFrame, history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per application: the mean of each column over the customer's history up to it; null
    without history (the left join of applications and averages)."""
    return as_of(anchors.select(*KEYS), {}, history, columns)
