"""Hand cases of the cleaning and loan rules."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom.functions import loans, text
from creditloom.operators import clean, encode, impute, loan_types
from creditloom.operators.drift import drift_band


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize("value, expected", [
    ("28_", 28), ("__-333333333__", -333333333), ("1,234.5", 1), ("5.", 5), ("5.0", 5),
    ("abc", None), (None, None), ("", None), ("99999999999", None)])
def test_number_in_junk(spark, value, expected):
    assert one(spark, value, lambda c: text.number(c, "int")) == expected


@pytest.mark.parametrize("value, expected", [(-500, None), (130, None), (120, 120), (0, 0)])
def test_age_range(spark, value, expected):
    assert one(spark, value, lambda c: text.only_between(c, 0, 120), "int") == expected


@pytest.mark.parametrize("value, expected", [
    ("10 Years and 9 Months", 129), ("NA", 0), (None, 0), ("3 Months", 3), ("2 Year", 24)])
def test_duration(spark, value, expected):
    assert one(spark, value, text.duration_months) == expected


@pytest.mark.parametrize("value, expected", [
    ("High_spent_Medium_value_payments", ("High", "Medium")), ("!@9#%8", (None, None)),
    (None, (None, None))])
def test_behaviour(spark, value, expected):
    assert (one(spark, value, text.spend_level), one(spark, value, text.payment_value)) == expected


@pytest.mark.parametrize("value, expected", [
    ("Auto Loan, Credit-Builder Loan, and Auto Loan", {"auto_loan": 2, "credit-builder_loan": 1}),
    ("A and B", {"a": 1, "b": 1}), (" ,, ", {}), (None, {})])
def test_token_counts(spark, value, expected):
    assert one(spark, value, lambda c: text.token_counts(text.list_tokens(c))) == expected


@pytest.mark.parametrize("due, overdue, snapshot, missed, first, dpd, label", [
    (100.0, 200.0, "2023-07-01", 2, "2023-05-01", 61, 1),
    (100.0, 50.0, "2023-03-01", 1, "2023-02-01", 28, 0),
    (0.0, 50.0, "2023-03-01", 0, None, None, 0),
    (100.0, 0.0, "2023-03-01", 0, None, 0, 0),
    (100.0, None, "2023-03-01", 0, None, 0, 0)])
def test_loan_status(spark, due, overdue, snapshot, missed, first, dpd, label):
    rows = spark.createDataFrame(
        [(6, due, overdue, dt.date.fromisoformat(snapshot))],
        "installment_num int, due_amt double, overdue_amt double, snapshot_date date")
    row = clean.loan_status(rows).withColumn(
        "label", loans.past_due_flag(F.col("dpd"), 30)).first()
    assert row["installments_missed"] == missed
    assert row["first_missed_date"] == (dt.date.fromisoformat(first) if first else None)
    assert (row["dpd"], row["label"]) == (dpd, label)


@pytest.mark.parametrize("value, band", [
    (0.10, "stable"), (0.1001, "moderate"), (0.25, "moderate"), (0.2501, "significant"),
    (None, "n/a")])
def test_drift_band(spark, value, band):
    assert one(spark, value, drift_band, "double") == band


@pytest.mark.parametrize("exact", [False, True])
def test_clip_keeps_nulls_and_low_tail(spark, exact):
    rows = spark.createDataFrame(
        [("m", v) for v in [None, 3, 99, *range(1, 9), 10, 10]], "snapshot_date string, v int")
    out = clean.clip_to_quantile(rows, ["v"], 0.9, exact=exact)
    assert dict(out.dtypes)["v"] == "int"
    values = sorted((r["v"] for r in out.collect()), key=lambda v: (v is not None, v))
    assert values == [None, 1, 2, 3, 3, 4, 5, 6, 7, 8, 10, 10, 10]


def test_one_hot_vocabulary_order_and_unseen_labels(spark):
    rows = spark.createDataFrame([(x,) for x in ["b", "a", "c", "c", None]], "k string")
    vocabulary = encode.fit_vocabulary(rows, ["k"])
    assert vocabulary == {"k": ["c", "a", "b", "unknown"]}
    stored = encode.vocabulary_of(encode.vocabulary_table(spark, vocabulary))
    assert stored == vocabulary
    new = spark.createDataFrame([("New Kind",), (None,)], "k string")
    assert [tuple(r) for r in encode.one_hot(new, vocabulary).collect()] == [
        (0, 0, 0, 0), (0, 0, 0, 1)]


@pytest.mark.parametrize("exact", [False, True])
def test_median_impute(spark, exact):
    nan = float("nan")
    rows = spark.createDataFrame(
        [("m", 1, 1.0, None), ("m", 2, nan, None), ("m", 4, 3.0, None), ("m", None, 5.0, None),
         ("n", 7, 7.0, None)], "snapshot_date string, i int, d double, e double")
    out = impute.median_impute(rows, ["i", "d", "e"], exact=exact)
    assert dict(out.dtypes) == {"snapshot_date": "string", "i": "int", "d": "double", "e": "double"}
    assert sorted(tuple(r) for r in out.collect()) == [
        ("m", 1, 1.0, 0.0), ("m", 2, 3.0, 0.0), ("m", 2, 5.0, 0.0), ("m", 4, 3.0, 0.0),
        ("n", 7, 7.0, 0.0)]


@pytest.mark.parametrize("exact", [False, True])
def test_medians_only_look_back(spark, exact):
    d = dt.date
    history = spark.createDataFrame(
        [(d(2023, m, 1), v, None) for m, v in [(1, 1), (1, 9), (2, 5), (4, 100), (4, 101)]],
        "snapshot_date date, a int, b int")
    months = spark.createDataFrame([(d(2022, 12, 1),), (d(2023, 1, 1),), (d(2023, 3, 1),),
                                    (d(2023, 5, 1),)], "snapshot_date date")
    found = {(r["snapshot_date"].isoformat(), r["column"]): r["median"]
             for r in impute.medians_so_far(history, months, ["a", "b"], exact).collect()}
    assert {k: v for (k, c), v in found.items() if c == "a"} == {
        "2022-12-01": 0.0, "2023-01-01": 1.0, "2023-03-01": 5.0, "2023-05-01": 9.0}
    assert {v for (_, c), v in found.items() if c == "b"} == {0.0}


def test_fill_overall_medians(spark):
    rows = spark.createDataFrame([("x", None), ("y", 2.0)], "Customer_ID string, a double")
    history = spark.createDataFrame([(1,), (5,), (9,)], "a int")
    out = impute.fill_overall_medians(rows, history, ["a"])
    assert sorted(tuple(r) for r in out.collect()) == [("x", 5.0), ("y", 2.0)]


def test_loan_type_columns_ignore_types_outside_the_vocabulary(spark):
    raw = spark.createDataFrame([("c", "2023-01-01", "Auto Loan, and Boat Loan")],
                                "Customer_ID string, snapshot_date string, Type_of_Loan string")
    out = loan_types.loan_type_columns(raw, ["auto_loan", "payday_loan"]).first().asDict()
    assert (out["loan_auto_loan"], out["loan_payday_loan"]) == (1, 0)
    assert "loan_boat_loan" not in out
    assert loan_types.loan_type_vocabulary(raw) == ["auto_loan", "boat_loan"]


def test_too_many_labels_is_an_error(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        rows = spark.range(10).selectExpr("string(id) as k")
        with pytest.raises(ValueError, match="more than 3"):
            encode.fit_vocabulary(rows, ["k"])
        with pytest.raises(ValueError, match="more than 3"):
            loan_types.bounded_labels(rows, "k")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
