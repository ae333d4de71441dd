"""Partitioned tables: where they live, how they are read, and how a month is rewritten."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditloom import session


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists on whichever file system the path names."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def read_table(spark: SparkSession, path: str, merge_schemas: bool = False) -> DataFrame | None:
    """All partitions as one table; None when the table was never written.

    Column sets are fixed by stored vocabularies, so one footer tells the schema. Tables written
    without them need `merge_schemas`, or columns that only some months have are lost.
    """
    if not _exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", merge_schemas).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The named columns of the table (a DDL schema), or no rows of the same schema."""
    found = read_table(spark, path)
    if found is None:
        return spark.createDataFrame([], schema)
    return found.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(schema)])


def read_month(spark: SparkSession, path: str, snapshot_date: str) -> DataFrame | None:
    """One month; only its folder is listed and read (partition pruning)."""
    table = read_table(spark, path)
    if table is None:
        return None
    return table.where(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))


def _months_below(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Folders of each month of a table, also below another partition column."""
    context = spark.sparkContext
    jvm_path = context._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(context._jsc.hadoopConfiguration())
    found: dict[str, list[str]] = {}
    waiting = [path] if _exists(spark, path) else []
    while waiting:
        for status in fs.listStatus(jvm_path(waiting.pop())):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith("snapshot_date="):
                found.setdefault(name.partition("=")[2], []).append(status.getPath().toString())
            elif status.isDirectory() and "=" in name:
                waiting.append(status.getPath().toString())
    return found


def months(spark: SparkSession, path: str) -> list[str]:
    """The months a partitioned table has, from its folders."""
    return sorted(_months_below(spark, path))


def drop_months(spark: SparkSession, path: str, gone: Sequence[str]) -> None:
    """Delete the partitions of the given months."""
    there = _months_below(spark, path) if gone else {}
    for month in map(str, gone):
        for folder in there.get(month, ()):
            session.delete_path(spark, folder)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str] = ("snapshot_date",),
                         fmt: str = "parquet", rebalance: bool = True, **options) -> Observation:
    """Rewrite exactly the partitions present in `df`; the others stay. Running it again gives the
    same table.

    Rows are rebalanced by partition value: small months become one file each, and a month that
    holds most of the rows is split over several tasks. `rebalance=False` writes rows where they are
    read, without a shuffle: each task makes a file of every value it has. The returned observation has the
    row count, without another job.
    """
    counted = Observation()
    options = ({"compression": session.CODEC} if fmt == "parquet" else session.TEXT) | options
    spark = df.sparkSession
    # Text is written as it comes; an open parquet file holds its rows, so its values are sorted.
    with session.writing(spark), session.open_files(spark) if fmt == "csv" else nullcontext():
        ((df.hint("rebalance", *by) if rebalance else df)
         .observe(counted, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").format(fmt)
         .option("partitionOverwriteMode", "dynamic").options(**options)
         .partitionBy(*by).save(path))
    return counted


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path, compression=session.CODEC)
