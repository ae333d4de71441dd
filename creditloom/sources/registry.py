"""The raw sources: file name, schema and cleaner of each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from creditloom import schemas
from creditloom.operators import clean


@dataclass(frozen=True)
class Source:
    name: str
    file_name: str
    clean: Callable[[DataFrame], DataFrame]

    @property
    def schema(self) -> StructType:
        return schemas.raw_schema(self.name)


SOURCES = {
    s.name: s for s in (
        Source("lms", "lms_loan_daily.csv", clean.clean_lms),
        Source("clickstream", "feature_clickstream.csv", clean.clean_clickstream),
        Source("attributes", "features_attributes.csv", clean.clean_attributes),
        Source("financials", "features_financials.csv", clean.clean_financials),
    )
}


def source(name: str) -> Source:
    if name not in SOURCES:
        raise ValueError(f"Unknown source table: {name}")
    return SOURCES[name]


def read_raw_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A header CSV with a given schema: no inference pass, and text such as '28_' or long numbers
    arrives unchanged. The parser's buffer is filled anew per line, so it is not larger than lines are; longer
    lines fill it several times."""
    return spark.read.schema(schema).options(header=True, inputBufferSize=8192).csv(path)
