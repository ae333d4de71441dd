"""Category columns as 0/1 columns with a vocabulary that is fixed by a stored table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom import session

UNKNOWN = "unknown"


def fill_unknown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(UNKNOWN, subset=list(columns))


def label_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, label, n for all category columns in one pass."""
    return (fill_unknown(df.select(*columns), columns)
            .unpivot([], list(columns), "column", "label")
            .groupBy("column", "label").agg(F.count(F.lit(1)).alias("n")))


def label_counts(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """by, column, label, n: a table that months are added to; a vocabulary of any window, and what it
    does not cover, follow from it without reading rows again."""
    return (fill_unknown(df.select(by, *columns), columns)
            .unpivot([by], list(columns), "column", "label")
            .groupBy(by, "column", "label").agg(F.count(F.lit(1)).alias("n")))


def frequent_labels(counts: DataFrame, columns: Sequence[str], most: int, min_share: float = 0.0) -> DataFrame:
    """column, position, label, n, share: at most `most` labels per column, those with the largest counts
    and at least `min_share` of the column's rows; ties in alphabetical order.

    Counts are combined before they are shuffled and only the first `most` of each task are sorted, so
    a column may have any number of labels; nothing is approximate.
    """
    totals, _ = session.stage(counts.groupBy("column", "label").agg(F.sum("n").alias("n")), "labels")
    found = None
    for c in columns:
        of = totals.where(F.col("column") == c)
        rows = of.agg(F.sum("n").alias("rows"))
        top = of.orderBy(F.desc("n"), "label").limit(most)
        # `rows` is a single number.
        ranked = top.select("column", "label", "n", (F.col("n") / rows.scalar()).alias("share")).where(
            F.col("share") >= min_share)
        found = ranked if found is None else found.unionByName(ranked)
    position = Window.partitionBy("column").orderBy(F.desc("n"), "label")
    return found.select("column", (F.row_number().over(position) - 1).alias("position"), "label", "n", "share")


def unseen_labels(counts: DataFrame, vocabulary: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """by, column, n, n_unseen, n_unseen_labels: rows whose label has no column of its own."""
    listed = vocabulary.select("column", "label", F.lit(True).alias("listed"))
    out = F.col("listed").isNull()
    return counts.join(listed, ["column", "label"], "left").groupBy(by, "column").agg(
        F.sum("n").alias("n"), F.sum(F.when(out, F.col("n")).otherwise(0)).alias("n_unseen"),
        F.count_if(out).alias("n_unseen_labels"))


def fit_vocabulary(df: DataFrame, columns: Sequence[str], most: int | None = None,
                   min_share: float = 0.0) -> dict[str, list[str]]:
    """Labels per column, the most frequent first, ties in alphabetical order.

    Labels become columns, so their number is bounded: by `most` (the others share the column of
    `one_hot(..., other=True)`), or, without it, by `spark.sql.pivotMaxValues`, beyond which there is
    an error as with Spark's pivot.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    counts = label_frequencies(df, columns)
    if most is not None:
        rows = frequent_labels(counts, columns, most, min_share).collect()
    else:
        rows = counts.limit(limit * len(columns) + 1).collect()
    vocabulary: dict[str, list[str]] = {}
    for c in columns:
        ranked = sorted((-r["n"], r["label"]) for r in rows if r["column"] == c)
        if len(ranked) > limit:
            raise ValueError(f"{c} has more than {limit} distinct labels; pass `most`")
        vocabulary[c] = [label for _, label in ranked]
    return vocabulary


def vocabulary_table(spark: SparkSession, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    return spark.createDataFrame(
        [(c, i, label) for c, labels in vocabulary.items() for i, label in enumerate(labels)],
        "column string, position int, label string")


def vocabulary_of(table: DataFrame) -> dict[str, list[str]]:
    """Reads a vocabulary table (bounded when it was fitted) back."""
    out: dict[str, list[str]] = {}
    for r in table.orderBy("column", "position").collect():
        out.setdefault(r["column"], []).append(r["label"])
    return out


def column_name(column: str, label: str) -> str:
    return f"{column}_{label.lower().replace(' ', '_')}"


def one_hot(df: DataFrame, vocabulary: Mapping[str, Sequence[str]], other: bool = False) -> DataFrame:
    """Replaces each category column by one int column per label. Null counts as 'unknown'; a
    label outside the vocabulary gives zeros everywhere, and a one in `<column>_other` with `other`."""
    kept = [c for c in df.columns if c not in vocabulary]
    known = df.select(*[F.col(f"`{c}`") for c in kept],
                      *[F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in vocabulary])
    flags = []
    for c, labels in vocabulary.items():
        flags += [(F.col(c) == label).cast("int").alias(column_name(c, label)) for label in labels]
        if other:
            flags.append((~F.col(c).isin(list(labels))).cast("int").alias(column_name(c, "other")))
    return known.select(*[F.col(f"`{c}`") for c in kept], *flags)
