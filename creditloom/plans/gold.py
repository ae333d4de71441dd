"""Label store and feature store, all months in one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from creditloom import schemas, session
from creditloom.functions.loans import credit_ratios
from creditloom.operators import customer_state, encode, impute
from creditloom.operators.align import default_labels
from creditloom.operators.point_in_time import applications, as_of, left_as_coded
from creditloom.plans import ledger
from creditloom.sources import tables


def known_by(df: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """Rows dated up to the last of the months: later ones are not known in any of them."""
    return df if months is None else df.where(
        F.col("snapshot_date") <= F.lit(max(map(str, months))).cast("date"))


def only_months(df: DataFrame, months: Sequence[str] | None) -> DataFrame:
    return df if months is None else df.where(
        F.col("snapshot_date").isin([F.lit(m).cast("date") for m in months]))


def joined_sources(lms: DataFrame, financials: DataFrame, attributes: DataFrame,
                   loan_type: DataFrame | None, clickstream: DataFrame,
                   mode: str = "as_of", months: Sequence[str] | None = None) -> DataFrame:
    """Applications (of the given months, or all) with everything known about the customer; nulls where nothing is known.

    `as_of` takes the latest rows up to the application; `as_coded` joins every snapshot of the
    customer, whatever its date.
    """
    anchors = applications(only_months(lms, months))
    sources = {"financials": financials, "attributes": attributes.select(
        "Customer_ID", "snapshot_date", "Age", "Occupation")}
    if loan_type is not None:
        sources["loan_type"] = loan_type
    if months is not None:
        # Before anything is grouped: later partitions are not read, other customers dropped.
        customers = anchors.select("Customer_ID").distinct()
        of_applicants = lambda df: df.join(customers, "Customer_ID", "left_semi")
        sources = {name: of_applicants(known_by(df, months) if mode == "as_of" else df)
                   for name, df in sources.items()}
        clickstream = of_applicants(known_by(clickstream, months))
    if mode == "as_of":
        return as_of(anchors, sources, clickstream, schemas.FE_COLUMNS)
    if mode != "as_coded":
        raise ValueError(f"mode must be as_of or as_coded, not {mode}")
    wide = as_of(anchors, {}, clickstream, schemas.FE_COLUMNS)
    for table in sources.values():
        wide = left_as_coded(wide, table)
    return wide


def build_feature_store(lms: DataFrame, financials: DataFrame, attributes: DataFrame,
                        loan_type: DataFrame | None, clickstream: DataFrame,
                        vocabulary: Mapping[str, Sequence[str]] | None = None,
                        mode: str = "as_of", median_scope: str = "as_of",
                        months: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """The model-ready table, keyed by customer and application month, without nulls in numbers.

    The joined sources are staged once, because vocabularies and medians are fitted on them.
    `median_scope` is the history the neutral clickstream fill is taken from: up to each
    application month (`as_of`) or all of it (`all`). `exact` replaces sketched quantiles by
    exact ones.
    """
    base, _ = session.stage(joined_sources(
        lms, financials, attributes, loan_type, clickstream, mode, months), "joined")
    if median_scope == "as_of":
        medians = impute.medians_so_far(known_by(clickstream, months), base, schemas.FE_COLUMNS, exact)
        filled = impute.fill_history_medians(base, medians, schemas.FE_COLUMNS)
    else:
        filled = impute.fill_overall_medians(base, clickstream, schemas.FE_COLUMNS, exact)
    if vocabulary is None:
        vocabulary = encode.fit_vocabulary(base, schemas.CATEGORIES)
    return model_columns(filled, vocabulary, exact)


def model_columns(filled: DataFrame, vocabulary: Mapping[str, Sequence[str]], exact: bool = False) -> DataFrame:
    """Ratios, one column per category label, and medians of the month for what is still missing."""
    ratios = filled.select("*", *[e.alias(n) for n, e in credit_ratios().items()])
    encoded = encode.one_hot(ratios, vocabulary)
    # Flags are never null, and the behaviour columns have been filled above.
    numbers = [f.name for f in encoded.schema.fields if isinstance(f.dataType, NumericType)
               and f.nullable and f.name not in schemas.FE_COLUMNS]
    return impute.median_impute(encoded, numbers, exact=exact)


def carried_month(before: tuple[DataFrame, DataFrame] | None, anchors: DataFrame, sources: Mapping[str, DataFrame],
                  clickstream: DataFrame, month: str, vocabulary: Mapping[str, Sequence[str]],
                  exact: bool = False) -> tuple[tuple[DataFrame, DataFrame], DataFrame]:
    """(state, features) of one month from the state before it and the rows dated since.

    The state is two tables: customers (see `customer_state.extend`) and, for the neutral fill, how
    often each behaviour value has occurred. Both are staged, so the next month reads tables.
    """
    customers, counts = before or (None, None)
    customers, _ = session.stage(customer_state.extend(customers, sources, clickstream, schemas.FE_COLUMNS), "customers")
    counts, _ = session.stage(customer_state.value_counts(counts, clickstream, schemas.FE_COLUMNS), "counts")
    base = customer_state.as_of_state(anchors, customers, sources, schemas.FE_COLUMNS)
    medians = customer_state.medians_of(counts, month, schemas.FE_COLUMNS)
    filled = impute.fill_history_medians(base, medians, schemas.FE_COLUMNS)
    return (customers, counts), model_columns(filled, vocabulary, exact)


@session.job
def advance(spark: SparkSession, root: str, month: str, exact: bool = False) -> Observation:
    """Writes the features of `month` from the carried state, and the state of the month.

    Reads the state of the latest month before (all rows up to `month` where there is none) and the
    silver partitions dated since. Months are advanced in order; one that is done again starts from
    the state before it.
    """
    month = str(month)
    paths = [tables.table_path(root, "gold", n) for n in ("customer_state", "value_counts")]
    # A month counts as carried when both tables have it.
    earlier = [m for m in tables.months(spark, paths[0]) if m < month and m in tables.months(spark, paths[1])]
    before = None
    if earlier:
        before = tuple(tables.read_month(spark, p, earlier[-1]).drop("snapshot_date") for p in paths)
    since = lambda df: known_by(df, [month]).where(
        F.lit(True) if not earlier else F.col("snapshot_date") > F.lit(earlier[-1]).cast("date"))
    lms, financials, attributes, loan_type, clickstream = (
        _silver(spark, root, n) for n in ("lms", "financials", "attributes", "loan_type", "clickstream"))
    sources = {"financials": since(financials), "attributes": since(attributes.select(
        "Customer_ID", "snapshot_date", "Age", "Occupation"))}
    if loan_type is not None:
        sources["loan_type"] = since(loan_type)
    state, features = carried_month(before, applications(only_months(lms, [month])), sources, since(clickstream),
                                    month, stored_vocabulary(spark, root), exact)
    for table, path in zip(state, paths):
        tables.overwrite_partitions(table.withColumn("snapshot_date", F.lit(month).cast("date")), path)
    return tables.overwrite_partitions(features, tables.table_path(root, "gold", "feature_store"))


def _silver(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return tables.read_table(spark, tables.table_path(root, "silver", name))


def label_store(spark: SparkSession, root: str, dpd: int = 30, mob: int = 6,
                months: Sequence[str] | None = None) -> Observation:
    """Writes the label store, all months or only the `months` asked for."""
    return tables.overwrite_partitions(
        default_labels(only_months(_silver(spark, root, "lms"), months), dpd, mob),
        tables.table_path(root, "gold", "label_store"))


def stored_vocabulary(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The category labels that name columns: fitted by the first run, stored, and used ever after."""
    path = tables.table_path(root, "gold", "vocabulary")
    stored = tables.read_table(spark, path)
    if stored is not None:
        return encode.vocabulary_of(stored)
    # One pass per source: a union would count every row as unknown in the other's columns.
    vocabulary = {**encode.fit_vocabulary(_silver(spark, root, "attributes"), ["Occupation"]),
                  **encode.fit_vocabulary(_silver(spark, root, "financials"), schemas.CATEGORIES[1:])}
    tables.overwrite_table(encode.vocabulary_table(spark, vocabulary).coalesce(1), path)
    return vocabulary


def audit(spark: SparkSession, root: str, run: str, months: Sequence[str] | None = None) -> DataFrame:
    """Keeps, per month, what the feature store collapses or cannot name, and returns these counts."""
    part = {n: only_months(_silver(spark, root, n), months) for n in ("lms", "financials", "attributes", "clickstream")}
    labels = tables.read_or_empty(spark, tables.table_path(root, "gold", "label_store"), "snapshot_date date, label int")
    counts, _ = session.stage(ledger.audit(
        part["lms"], {n: part[n] for n in ("financials", "attributes", "clickstream")}, only_months(labels, months),
        tables.read_table(spark, tables.table_path(root, "gold", "vocabulary")),
        {"attributes": ["Occupation"], "financials": schemas.CATEGORIES[1:]}), "audit")
    ledger.keep(counts, root, "feature_store", run)
    return counts


@session.job
def feature_store(spark: SparkSession, root: str, **options) -> Observation:
    """Writes the feature store, all months or only the `months` asked for. The category vocabulary is fitted on the first run and reused
    afterwards, so that every month has the same columns."""
    lms, financials, attributes, loan_type, clickstream = (
        _silver(spark, root, n)
        for n in ("lms", "financials", "attributes", "loan_type", "clickstream"))
    vocabulary = stored_vocabulary(spark, root)
    features = build_feature_store(lms, financials, attributes, loan_type, clickstream,
                                   vocabulary, **options)
    return tables.overwrite_partitions(features, tables.table_path(root, "gold", "feature_store"))
