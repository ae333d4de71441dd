"""Missing numbers: neutral fill of behaviour without history, and per-month medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom import session
from creditloom.functions.ranks import column_quantiles, slice_count

SKETCH_SIZE = 1000  # rank error of about 0.3 %
MIN_SLICES = 32


def non_null_profile(df: DataFrame, columns: Sequence[str],
                     keys: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """Non-null count of every column per group, in one pass."""
    return df.groupBy(*keys).agg(*[F.expr(f"count(`{c}`)").alias(c) for c in columns])


def fill_constant(df: DataFrame, value, columns: Sequence[str]) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def median_impute(df: DataFrame, columns: Sequence[str],
                  keys: Sequence[str] = ("snapshot_date",), exact: bool = False) -> DataFrame:
    """Null or NaN becomes the median of the column in the row's group, or 0 when the group has no
    value at all. Integer columns stay integer: a median is always an element of the data."""
    kinds = dict(df.dtypes)

    def clean(name: str) -> str:
        return f"nullif(`{name}`, double('NaN'))" if kinds[name] == "double" else f"`{name}`"

    seen = df.selectExpr(*[f"`{k}`" for k in keys], *[f"{clean(c)} as `{c}`" for c in columns])
    medians, _ = session.stage(
        column_quantiles(seen, keys, columns, [0.5], exact)
        .selectExpr(*[f"`{k}`" for k in keys], *[f"`{c}`[0] as `_{c}_median`" for c in columns]),
        "medians")
    joined = df.join(medians, list(keys), "left")
    wanted = set(columns)
    return joined.selectExpr(*[
        f"coalesce({clean(c)}, cast(`_{c}_median` as {kinds[c]}), cast(0 as {kinds[c]})) as `{c}`"
        if c in wanted else f"`{c}`" for c in df.columns])


def medians_so_far(history: DataFrame, months: DataFrame, columns: Sequence[str],
                   exact: bool = False) -> DataFrame:
    """For every month of `months` (column snapshot_date): the median of each column over all
    history rows dated on or before it, 0.0 when there are none. Long form: snapshot_date,
    column, median.

    History is read once: each month is sketched, and sketches are merged in month order.
    """
    columns = list(columns)
    wanted, _ = session.stage(months.select("snapshot_date").distinct(), "months")
    if exact:
        found = _exact_medians_so_far(history, wanted, columns)
    else:
        sketched = history.groupBy("snapshot_date").agg(*[
            F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_SIZE)).alias(c)
            for c in columns])
        long = sketched.unpivot(["snapshot_date"], columns, "column", "sketch")
        ticks = wanted.select("snapshot_date", F.explode(F.array(*map(F.lit, columns)))
                              .alias("column"), F.lit(None).cast("binary").alias("sketch"),
                              F.lit(True).alias("wanted"))
        # One sketch per calendar month and column, so a column's window is small.
        so_far = (Window.partitionBy("column").orderBy("snapshot_date")
                  .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        merged = (long.withColumn("wanted", F.lit(False)).unionByName(ticks)
                  .withColumn("sketch", F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE))
                              .over(so_far))
                  .where("wanted"))
        n = F.kll_sketch_get_n_double("sketch")
        found = merged.select("snapshot_date", "column", F.when(
            n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))).alias("median"))
    every = wanted.select("snapshot_date",
                          F.explode(F.array(*map(F.lit, columns))).alias("column"))
    return (every.join(found, ["snapshot_date", "column"], "left")
            .withColumn("median", F.coalesce("median", F.lit(0.0))))


def _exact_medians_so_far(history, wanted, columns):
    """Exact medians of growing prefixes.

    Each column's values are cut into slices. Slice totals, summed over the months so far, tell
    which slice holds a month's median; only the values of that slice are then looked at.
    """
    c = F.col
    counts, values = session.stage(
        history.select("snapshot_date", *[c(f).cast("double").alias(f) for f in columns])
        .unpivot(["snapshot_date"], columns, "column", "value").where(c("value").isNotNull())
        .groupBy("snapshot_date", "column", "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    slices = max(MIN_SLICES, slice_count(values))
    fractions = [i / slices for i in range(1, slices)]
    cuts, _ = session.stage(counts.groupBy("column").agg(
        F.percentile_approx("value", fractions, max(2000, 10 * slices)).alias("cuts")), "cuts")
    sliced = counts.join(cuts, "column").withColumn(
        "slice", F.size(F.filter("cuts", lambda x: x < c("value")))).drop("cuts")
    per_slice, rows = session.stage(
        sliced.groupBy("column", "slice", "snapshot_date").agg(F.sum("n").alias("n")), "slices")
    none = counts.select("snapshot_date", "column", F.lit(None).cast("double").alias("median"))
    span = wanted.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    if not rows or span[0] is None:
        return none.limit(0)

    calendar = F.expr(f"sequence(date'{span[0]}', date'{span[1]}', interval 1 month)")
    ticks = per_slice.select("column", "slice").distinct().select(
        "column", "slice", F.explode(calendar).alias("snapshot_date"), F.lit(0).alias("n"),
        F.lit(True).alias("tick"))
    months_so_far = (Window.partitionBy("column", "slice").orderBy("snapshot_date")
                     .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    so_far = (per_slice.withColumn("tick", F.lit(False)).unionByName(ticks)
              .withColumn("n", F.sum("n").over(months_so_far)).where("tick"))
    month = Window.partitionBy("column", "snapshot_date")
    below = month.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    located = so_far.select(
        "column", "slice", "snapshot_date", "n",
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("below"),
        F.ceil(F.sum("n").over(month) * 0.5).alias("rank"))
    inside = (c("rank") > c("below")) & (c("rank") <= c("below") + c("n"))
    targets, _ = session.stage(
        located.where(inside).join(wanted, "snapshot_date", "left_semi").select(
            "column", "slice", c("snapshot_date").alias("month"),
            (c("rank") - c("below")).alias("rank")), "targets")
    near = (sliced.join(targets, ["column", "slice"]).where(c("snapshot_date") <= c("month"))
            .groupBy("column", "month", "value", "rank").agg(F.sum("n").alias("n")))
    upto = (Window.partitionBy("column", "month").orderBy("value")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (near.withColumn("upto", F.sum("n").over(upto)).where(c("upto") >= c("rank"))
            .groupBy(c("month").alias("snapshot_date"), "column")
            .agg(F.min("value").alias("median")))


def fill_history_medians(df: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the month's median from `medians_so_far`."""
    columns = list(columns)
    wide, _ = session.stage(
        medians.groupBy("snapshot_date").pivot("column", columns).agg(F.first("median"))
        .select("snapshot_date", *[F.col(c).alias(f"_{c}_median") for c in columns]), "fills")
    joined = df.join(wide, "snapshot_date", "left")
    return joined.selectExpr(*[f"coalesce(`{c}`, `_{c}_median`) as `{c}`" if c in columns
                               else f"`{c}`" for c in df.columns])


def fill_overall_medians(df: DataFrame, history: DataFrame, columns: Sequence[str],
                         exact: bool = False) -> DataFrame:
    """The same with one median per column over all of history, as the monthly job did it."""
    everything = history.select(F.lit("all").alias("scope"), *columns)
    medians, _ = session.stage(
        column_quantiles(everything, ["scope"], columns, [0.5], exact)
        .select(*[F.coalesce(F.col(c)[0], F.lit(0.0)).alias(c) for c in columns]), "medians")
    row = medians.first() or {c: 0.0 for c in columns}
    return df.select(*[F.coalesce(F.col(c), F.lit(row[c])).alias(c) if c in columns else F.col(c)
                       for c in df.columns])
