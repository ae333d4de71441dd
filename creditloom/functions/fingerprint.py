"""Fingerprints of sets of rows that do not depend on their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(names: Sequence[str]) -> Column:
    """64-bit hash of the named columns; nulls take part by their place, which a hash of the values
    alone would skip."""
    absent = F.concat(*[F.col(f"`{c}`").isNull().cast("string") for c in names])
    return F.xxhash64(absent, *[F.col(f"`{c}`") for c in names])


def wide_sum(h: Column) -> Column:
    """Sum of 64-bit hashes as text, without overflow."""
    return F.sum(h.cast("decimal(38,0)")).cast("string")


def fingerprints(df: DataFrame, *by: str) -> DataFrame:
    """by, fingerprint: the number of rows and two sums of row hashes. Sums do not depend on the order
    of rows and count repeated ones; partial sums meet, so no group is gathered."""
    row = row_hash(sorted(df.columns))
    return df.groupBy(*by).agg(F.concat_ws(
        "/", F.count(F.lit(1)).cast("string"), F.coalesce(wide_sum(row), F.lit("0")),
        F.coalesce(wide_sum(F.xxhash64(row, F.lit(1))), F.lit("0"))).alias("fingerprint"))
