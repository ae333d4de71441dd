"""Exact ranks and quantiles per group that never sort a whole group in one task.

`percentile` and an unbounded window keep all distinct values of a group in one task's memory.
Here rows are first combined to one per distinct value, the value range is cut at approximate
quantiles, each slice is summed on its own, and slices are offset by the totals of the slices
below them. The cut points only balance the work: results are exact wherever they fall.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom import session


def slice_count(rows: int, slice_rows: int | None = None) -> int:
    """How many slices keep a sort task at about `session.SINGLE_TASK_ROWS` rows."""
    limit = session.SINGLE_TASK_ROWS if slice_rows is None else slice_rows
    return max(1, -(-rows // max(1, limit)))


def running_totals(df: DataFrame, keys: Sequence[str], order: str, amount: str,
                   single_task_rows: int | None = None) -> DataFrame:
    """Adds `<amount>_below` (sum over smaller `order` values of the group) and `<amount>_total`.

    Expects one row per (keys, order). A group is cut into as many slices as the whole table needs,
    so a group that holds nearly all rows is cut as finely as one that holds them all.
    """
    keys = list(keys)
    base, rows = session.stage(df, "ranks")
    below, total = f"{amount}_below", f"{amount}_total"
    slices = slice_count(rows, single_task_rows)
    if slices == 1:
        group = Window.partitionBy(*keys)
        before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return (base.withColumn(below, F.coalesce(F.sum(amount).over(before), F.lit(0)))
                    .withColumn(total, F.sum(amount).over(group)))

    keyed = base if keys else base.withColumn("_all", F.lit(0))
    by = keys or ["_all"]
    fractions = [i / slices for i in range(1, slices)]
    cuts, _ = session.stage(
        keyed.groupBy(*by).agg(F.percentile_approx(order, fractions, max(2000, 10 * slices)).alias("_cuts")), "cuts")
    sliced = (keyed.join(cuts, by)
              .withColumn("_slice", F.size(F.filter("_cuts", lambda c: c < F.col(order))))
              .drop("_cuts"))
    group = Window.partitionBy(*by)
    lower = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = session.stage(
        sliced.groupBy(*by, "_slice").agg(F.sum(amount).alias("_sum"))
        .select(*by, "_slice",
                F.coalesce(F.sum("_sum").over(lower), F.lit(0)).alias("_offset"),
                F.sum("_sum").over(group).alias(total)), "offsets")
    inside = (Window.partitionBy(*by, "_slice").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (sliced.join(offsets, [*by, "_slice"])
            .withColumn(below, F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
            .select(*base.columns, below, total))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
                    interpolate: bool = False, weight: str | None = None,
                    single_task_rows: int | None = None) -> DataFrame:
    """One row per group with the array `quantiles`, nulls ignored; `weight` counts repeated rows.

    `interpolate=False` picks the element at rank ceil(p*n); `True` interpolates linearly between
    the neighbours of rank (n-1)*p.
    """
    keys = list(keys)
    wanted = []
    for i, p in enumerate(probabilities):
        p = f"{float(p)!r}D"
        if interpolate:
            low = f"bigint(floor((n_total - 1) * {p}))"
            high, part = f"least({low} + 1, n_total - 1)", f"(n_total - 1) * {p} - {low}"
        else:
            low = high = f"greatest(bigint(ceil(n_total * {p})) - 1, 0)"
            part = "0D"
        for side, position in (("true", low), ("false", high)):
            wanted.append(f"named_struct('i', {i}, 'low', {side}, 'position', {position}, "
                          f"'part', double({part}))")
    hits = _values_at(df, keys, value, wanted, weight, single_task_rows)
    per_point = (hits.groupBy(*keys, F.col("w.i").alias("i")).agg(
        F.expr(f"max(case when w.low then double(`{value}`) end)").alias("a"),
        F.expr(f"max(case when not w.low then double(`{value}`) end)").alias("b"),
        F.max("w.part").alias("part"))
        # From the nearer neighbour, as NumPy does it, so that edges equal to a value stay equal.
        .select(*keys, "i", F.expr("if(part >= 0.5D, b - (b - a) * (1 - part), "
                                   "a + (b - a) * part)").alias("q")))
    return (per_point.groupBy(*keys)
            .agg(F.expr("sort_array(collect_list(struct(i, q)))").alias("points"))
            .select(*keys, F.col("points.q").alias("quantiles")))


def _values_at(df: DataFrame, keys: list[str], value: str, wanted: Sequence[str],
               weight: str | None, single_task_rows: int | None) -> DataFrame:
    """The values at the wanted positions of each group's order: keys, value, w. A position is a
    SQL struct with a 0-based `position`, computed from `n_total`."""
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value)
              .agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n")))
    ranked = running_totals(counts, keys, value, "n", single_task_rows)
    covered = (f"filter(array({', '.join(wanted)}), "
               "w -> w.position >= n_below and w.position < n_below + n)")
    return ranked.select(*keys, value, F.explode(F.expr(covered)).alias("w"))


def values_at_positions(df: DataFrame, value: str, positions: Sequence[str],
                        single_task_rows: int | None = None) -> list[float]:
    """The values at given 0-based positions of the whole order, as numbers for the driver.

    A position is a SQL expression over `n_total`, the number of non-null rows.
    """
    wanted = [f"named_struct('i', {i}, 'position', bigint({p}))" for i, p in enumerate(positions)]
    rows = _values_at(df, [], value, wanted, None, single_task_rows).select("w.i", value).collect()
    return [v for _, v in sorted(tuple(r) for r in rows)]


def column_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     probabilities: Sequence[float], exact: bool = False,
                     accuracy: int = 1_000) -> DataFrame:
    """One row per group; each column holds the array of its quantiles (data elements).

    The default is one pass of mergeable sketches with rank error 1/accuracy; `exact` ranks the
    distinct values of every column.
    """
    keys, columns = list(keys), list(columns)
    probabilities = [float(p) for p in probabilities]
    if not exact:
        points = ", ".join(f"{p!r}D" for p in probabilities)
        return df.groupBy(*keys).agg(*[
            F.expr(f"percentile_approx(double(`{c}`), array({points}), {accuracy})").alias(c)
            for c in columns])
    long = df.selectExpr(*[f"`{k}`" for k in keys], *[f"double(`{c}`) as `{c}`" for c in columns]
                         ).unpivot(keys, [F.col(f"`{c}`") for c in columns], "column", "value")
    found = exact_quantiles(long, [*keys, "column"], "value", probabilities)
    groups = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    wide = (found.groupBy(*keys).pivot("column", columns)
            .agg(F.first("quantiles")))
    # A group whose columns are all null has no quantiles but still needs its row.
    return groups.join(wide, keys, "left") if keys else wide
