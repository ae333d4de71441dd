"""Metrics and stability indices against direct computations."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import drift, metrics, scoring
from creditloom.plans import operate


def scored(n=2500, seed=1):
    rng = np.random.default_rng(seed)
    p = np.round(rng.beta(2, 3, n), 2)
    y = (rng.random(n) < p).astype(int)
    g = np.where(rng.random(n) < 0.7, "hot", "cold")
    return [(str(a), float(b), int(c)) for a, b, c in zip(g, p, y)]


SCHEMA = "g string, model_predictions double, label int"


@pytest.mark.parametrize("path", ["plain", "sliced"])
def test_classification_metrics(spark, path, request):
    if path == "sliced":
        request.getfixturevalue("sliced")
    data = scored()
    got = {r["g"]: r for r in metrics.classification_metrics(
        spark.createDataFrame(data, SCHEMA), ["g"]).collect()}
    for g in ("hot", "cold"):
        p = np.array([b for a, b, _ in data if a == g])
        y = np.array([c for a, _, c in data if a == g])
        diff = p[y == 1][:, None] - p[y == 0][None, :]
        auc = ((diff > 0).sum() + 0.5 * (diff == 0).sum()) / diff.size
        tp, fp = ((p >= 0.5) & (y == 1)).sum(), ((p >= 0.5) & (y == 0)).sum()
        r = got[g]
        assert r["auc"] == pytest.approx(auc, abs=1e-12)
        assert r["gini"] == pytest.approx(2 * auc - 1, abs=1e-12)
        assert r["precision"] == pytest.approx(tp / (tp + fp))
        assert r["recall"] == pytest.approx(tp / y.sum())
        assert r["f1"] == pytest.approx(2 * tp / (tp + fp + y.sum()))
        assert r["brier"] == pytest.approx(((p - y) ** 2).mean())


def test_one_class_has_no_metrics_and_no_predicted_defaults_give_zero(spark):
    rows = [("good", 0.7, 0), ("good", 0.2, 0), ("low", 0.1, 0), ("low", 0.2, 1)]
    got = {r["g"]: r for r in metrics.classification_metrics(
        spark.createDataFrame(rows, SCHEMA), ["g"]).collect()}
    assert [got["good"][c] for c in ("auc", "gini", "precision", "recall", "f1", "brier")] == [None] * 6
    assert [got["low"][c] for c in ("auc", "precision", "recall", "f1")] == [1.0, 0.0, 0.0, 0.0]


def test_auc_ignores_monotone_calibration(spark):
    rows = spark.createDataFrame(scored(), SCHEMA)
    bent = rows.withColumn("model_predictions", 1 / (1 + F.exp(3 - 5 * F.col("model_predictions"))))
    auc = lambda df: {r["g"]: r["auc"] for r in metrics.classification_metrics(df, ["g"]).collect()}
    assert auc(rows) == pytest.approx(auc(bent))


def test_reliability(spark):
    data = [r for r in scored(800) if r[0] == "hot"]
    got = metrics.reliability(spark.createDataFrame(data, SCHEMA), ["g"]).collect()
    p, y = np.array([r[1] for r in data]), np.array([r[2] for r in data])
    edges = np.quantile(p, np.linspace(0, 1, 11))[1:-1]
    bins = np.searchsorted(edges, p)
    assert {r["bin"] for r in got} == set(bins)
    for r in got:
        mine = bins == r["bin"]
        assert r["n"] == mine.sum()
        assert r["mean_predicted"] == pytest.approx(p[mine].mean())
        assert r["observed_rate"] == pytest.approx(y[mine].mean())


def stability_index(expected, actual, bins=10):
    """The index from the definition: baseline deciles, open ends, floored shares."""
    cuts = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1))[1:-1])
    shares = [np.maximum(np.bincount(np.searchsorted(cuts, x, side="right"),
                                     minlength=len(cuts) + 1) / len(x), 1e-4)
              for x in (np.asarray(expected), np.asarray(actual))]
    return float(((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum())


def monthly(seed=2):
    rng = np.random.default_rng(seed)
    out = []
    for m in range(1, 5):
        for v in np.round(rng.normal(0.4 + 0.05 * m, 0.1, 300 * (5 if m == 3 else 1)), 2):
            out.append(("m1", dt.date(2024, m, 1), float(v)))
    return out


@pytest.mark.parametrize("path", ["plain", "sliced"])
def test_score_psi(spark, path, request):
    if path == "sliced":
        request.getfixturevalue("sliced")
    data = monthly()
    rows = spark.createDataFrame(data, "model_name string, snapshot_date date, model_predictions double")
    got = {r["snapshot_date"]: r for r in drift.score_psi(rows).collect()}
    first = [v for _, d, v in data if d == dt.date(2024, 1, 1)]
    assert got[dt.date(2024, 1, 1)]["psi"] == 0
    for d, r in got.items():
        mine = [v for _, x, v in data if x == d]
        assert (r["n"], r["psi"]) == (len(mine), pytest.approx(stability_index(first, mine)))
    assert {r["psi"] for r in drift.score_psi(rows, bins=1).collect()} == {None}


def test_csi_with_ties_nulls_and_empty_baseline(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rows = [(d1, 0, 1.5, None)] * 90 + [(d1, 5, None, None)] * 10 + [(d2, 0, 1.5, 1)] * 40 + [
        (d2, 5, 2.5, 2)] * 60
    df = spark.createDataFrame(rows, "snapshot_date date, tied int, gaps double, late int")
    got = {(r["feature"], r["snapshot_date"]): r["psi"]
           for r in drift.feature_csi(df, ["tied", "gaps", "late", "absent"], d1.isoformat()).collect()}
    assert got["tied", d2] == pytest.approx(
        stability_index([0] * 90 + [5] * 10, [0] * 40 + [5] * 60))
    assert got["gaps", d2] == pytest.approx(stability_index([1.5] * 90, [1.5] * 40 + [2.5] * 60))
    assert got["tied", d1] == 0 and got["late", d2] is None


def test_worst_feature_ignores_unknown_and_takes_first_on_tie(spark):
    rows = spark.createDataFrame(
        [("m", "a", 1, None), ("m", "b", 2, 0.3), ("m", "c", 3, 0.3), ("n", "a", 1, None)],
        "snapshot_date string, feature string, position int, psi double")
    got = {r[0]: (r[1], r[2]) for r in drift.worst_feature(rows).collect()}
    assert got == {"m": (0.3, "b"), "n": (None, None)}


MON = ("model_name string, snapshot_date date, psi double, csi_max double, csi_max_feature string,"
       " auc double, auc_drop_from_oot1 double, brier double")


def test_breach_rules_use_the_newest_month(spark):
    d = lambda m: dt.date(2024, m, 1)
    rows = spark.createDataFrame([
        ("m", d(1), 0.0, 0.0, "a", 0.8, 0.0, 0.10), ("m", d(2), 0.9, 0.9, "a", 0.8, 0.0, 0.10),
        ("m", d(3), 0.26, 0.20, "a", 0.7, 0.06, 0.16), ("q", d(1), None, None, None, None, None, None),
    ], MON)
    got = {r["model_name"]: r for r in drift.breach(rows, drift.first_row_brier(rows)).collect()}
    assert got["m"]["snapshot_date"] == d(3) and got["m"]["breached"] is True
    assert got["m"]["reasons"] == (
        "PSI=0.2600 > 0.25; AUC drop=0.0600 > 0.05; Brier increase=0.0600 > 0.05")
    assert (got["q"]["breached"], got["q"]["reasons"]) == (False, "")


def test_previous_month_breach(spark):
    d = lambda m: dt.date(2024, m, 1)
    rows = spark.createDataFrame([
        ("m", d(1), 0.30, 0.50, "a", None, None, None), ("m", d(2), 0.1, 0.8234, "fe_4", None, None, None),
        ("m", d(4), 0.1, None, None, None, None, None)], MON)
    months = spark.createDataFrame([("m", d(m)) for m in (2, 3, 4, 5)] + [("new", d(12))],
                                   "model_name string, ds date")
    got = {r["ds"].month: (r["breached"], r["message"])
           for r in drift.previous_month_breach(rows, months).collect()}
    assert got.pop(12) == (False, "no monitoring history yet for new (first eligible month)")
    assert got == {
        2: (True, "PSI=0.3000 > 0.25 for m at 2024-01-01"),
        3: (True, "CSI=0.8234 > 0.25 on 'fe_4' for m at 2024-02-01"),
        4: (False, "no monitoring row found for m at 2024-03-01"),
        5: (False, "no drift breach for m at 2024-04-01")}


def test_outcomes_prefer_the_same_month(spark):
    d = lambda m: dt.date(2024, m, 1)
    p = spark.createDataFrame(
        [("a", d(1), "m", 0.9), ("b", d(1), "m", 0.1), ("a", d(2), "m", 0.8)],
        "Customer_ID string, snapshot_date date, model_name string, model_predictions double")
    labels = spark.createDataFrame(
        [("a", d(1), 1), ("b", d(7), 0), ("a", d(8), 0), ("z", d(8), 1)],
        "Customer_ID string, snapshot_date date, label int")
    rows = scoring.with_month_outcomes(p, labels).collect()
    assert sorted((r["Customer_ID"], r["snapshot_date"].month, r["label"]) for r in rows) == [
        ("a", 1, 1), ("a", 2, 0)]


def test_monitoring_table_without_labels_or_features(spark):
    p = spark.createDataFrame(monthly(), "model_name string, snapshot_date date, model_predictions double"
                              ).withColumn("Customer_ID", F.lit("c"))
    labels = spark.createDataFrame([], "Customer_ID string, snapshot_date date, label int")
    features = spark.createDataFrame([], "Customer_ID string, snapshot_date date, x double")
    baselines = spark.createDataFrame([("m1", 0.8)], "model_name string, oot_auc double")
    rows = operate.monitoring_table(p, labels, features, ["x"], baselines).collect()
    assert len(rows) == 4
    for r in rows:
        assert r["auc"] is None and r["csi_max"] is None and r["csi_x"] is None
        assert not math.isnan(r["psi"])


def test_data_summary(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    df = spark.createDataFrame([(d1, 1.0), (d1, None), (d2, 2.0), (d2, 4.0)],
                               "snapshot_date date, x double")
    got = {r["side"]: r for r in operate.data_summary(df, ["x"], "2024-01-01", "2024-02-01").collect()}
    assert (got["baseline"]["null_share"], got["baseline"]["is_constant"]) == (0.5, True)
    assert (got["current"]["mean"], got["current"]["n_distinct"]) == (3.0, 2)


def test_nan_is_not_binned(spark):
    """A value that is not a number is left out, as a null is."""
    nan = float("nan")
    base = [("1994-01-01", float(k)) for k in range(50)]
    rows = base + [("1994-02-01", 1.0), ("1994-02-01", nan), ("1994-02-01", None)]
    frame = spark.createDataFrame(rows, "d string, f double").selectExpr("date(d) as snapshot_date", "f")
    from creditloom.operators import drift as operators
    got = {str(r.snapshot_date): r for r in operators.feature_csi(frame, ["f"], "1994-01-01").collect()}
    assert got["1994-02-01"].n == 1 and got["1994-02-01"].psi > 1
