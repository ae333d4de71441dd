"""Column expressions that turn raw text into typed values. Bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source data's formats.
NUMBER = r"([-+]?\d*\.?\d+)"
SSN = r"^\d{3}-\d{2}-\d{4}$"
YEARS = r"(\d+)\s+Year"
MONTHS = r"(\d+)\s+Month"
BEHAVIOUR = r"(Low|High)_spent_(Small|Medium|Large)_value"


def as_double(c: Column) -> Column:
    return c.try_cast("double")


def as_int(c: Column) -> Column:
    """Through double, so that '5.0' is 5; a direct try_cast would give null."""
    return as_double(c).try_cast("int")


def as_date(c: Column) -> Column:
    return c.try_cast("date")


CASTS = {
    "string": lambda c: c.cast("string"),
    "int": as_int,
    "double": as_double,
    "date": as_date,
}


def first_match(c: Column, pattern: str, group: int) -> Column:
    """The group of the first match; null without a match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def number_text(c: Column) -> Column:
    """The first number inside junk text: '__-5.2_' gives '-5.2'."""
    return first_match(c, NUMBER, 1)


def number(c: Column, type_name: str) -> Column:
    return CASTS[type_name](number_text(c))


def only_between(c: Column, low, high) -> Column:
    return F.when(c.between(low, high), c)


def only_non_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def only_matching(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), c)


def duration_months(c: Column) -> Column:
    """'10 Years and 9 Months' gives 129; text without a duration, or null, gives 0."""
    years = F.coalesce(as_int(F.regexp_extract(c, YEARS, 1)), F.lit(0))
    months = F.coalesce(as_int(F.regexp_extract(c, MONTHS, 1)), F.lit(0))
    return (years * 12 + months).cast("int")


def spend_level(c: Column) -> Column:
    return first_match(c, BEHAVIOUR, 1)


def payment_value(c: Column) -> Column:
    return first_match(c, BEHAVIOUR, 2)


def column_label(c: Column) -> Column:
    """A category label as it appears inside a column name."""
    return F.lower(F.replace(c, F.lit(" "), F.lit("_")))


def list_tokens(c: Column) -> Column:
    """'Auto Loan, and Payday Loan' gives [auto_loan, payday_loan]; null gives an empty list."""
    parts = F.split(F.replace(F.coalesce(c, F.lit("")), F.lit(" and "), F.lit(",")), ",")
    stripped = F.transform(parts, lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    return F.transform(F.filter(stripped, lambda p: p != ""), column_label)


def count_in(tokens: Column, token: str) -> Column:
    return F.size(F.filter(tokens, lambda t: t == token)).cast("int")


def token_counts(tokens: Column) -> Column:
    """Map of token to its number of occurrences, built inside the row."""
    return F.map_from_entries(F.transform(
        F.array_distinct(tokens),
        lambda t: F.struct(t, F.size(F.filter(tokens, lambda u: u == t)).cast("int"))))
