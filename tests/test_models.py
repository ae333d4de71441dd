"""Fitted models against NumPy, and what a stored model keeps."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import models
from creditloom.operators.align import Windows, temporal_split
from creditloom.plans import train

SPACE = {"n_estimators": [5], "max_depth": [2, 3], "learning_rate": [0.1, 0.3]}


@pytest.fixture(scope="module")
def frame(spark):
    """Two years of customers whose default depends on x; y is noise, k is constant."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1400):
        m = int(rng.integers(0, 14))
        x, y = rng.normal(), rng.normal()
        rows.append((f"c{i}", dt.date(2023 + (6 + m) // 12, (6 + m) % 12 + 1, 1),
                     float(x), float(y), 1.0, int(rng.random() < 1 / (1 + np.exp(1 - 1.5 * x)))))
    df = spark.createDataFrame(
        rows, "Customer_ID string, snapshot_date date, x double, y double, k double, label int")
    return temporal_split(df, Windows.before("2024-09-01")).persist()


def test_scaler_uses_train_rows_only(frame):
    rows = frame.where("split = 'train'")
    scaler = models.fit_scaler(rows, ["x", "k"])
    values = np.array([r["x"] for r in rows.collect()])
    assert scaler["x"] == pytest.approx((values.mean(), values.std()))
    assert scaler["k"] == (1.0, 1.0)


def newton_logistic(X, y, w, penalty):
    """Minimises sum of weighted log losses + penalty/2 * |b|^2, intercept free."""
    A = np.c_[X, np.ones(len(X))]
    R = np.diag([penalty] * X.shape[1] + [0.0])
    b = np.zeros(A.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-A @ b))
        g = A.T @ (w * (p - y)) + R @ b
        b -= np.linalg.solve((A * (w * p * (1 - p))[:, None]).T @ A + R, g)
    return b


def test_balanced_logistic_regression(frame):
    rows = frame.where("split = 'train'")
    scaler = models.fit_scaler(rows, ["x", "y"])
    model = models.fit_logreg(models.inputs(rows, scaler))
    data = rows.collect()
    X = np.array([[(r[c] - scaler[c][0]) / scaler[c][1] for c in ("x", "y")] for r in data])
    y = np.array([r["label"] for r in data], float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    expected = newton_logistic(X, y, w, 1.0)
    assert [*model.coefficients, model.intercept] == pytest.approx(list(expected), abs=1e-5)


def test_platt_calibration(spark):
    rng = np.random.default_rng(9)
    s = np.round(rng.random(1500), 2)
    y = (rng.random(1500) < s ** 2).astype(int)
    rows = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)],
                                 "raw_score double, label int")
    slope, intercept = models.fit_platt(rows)
    P, N = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (P + 1) / (P + 2), 1 / (N + 2))
    expected = newton_logistic(s[:, None], t, np.ones(len(s)), 0.0)
    assert (slope, intercept) == pytest.approx(tuple(expected), abs=1e-4)
    fitted = 1 / (1 + np.exp(-(slope * s + intercept)))
    assert ((fitted - y) ** 2).mean() <= ((s - y) ** 2).mean()


def test_draws_are_distinct_and_seeded():
    a = models.draw_parameters(40)
    assert a == models.draw_parameters(40) and len({tuple(p.values()) for p in a}) == 40
    assert len(models.draw_parameters(40, space=SPACE)) == 4


def test_models_find_the_signal_and_survive_storage(spark, frame, tmp_path):
    root = str(tmp_path)
    for kind in train.MODEL_KINDS:
        artefact = train.fit(frame, kind, "2024-09-01", draws=2, folds=2, space=SPACE)
        assert artefact.feature_columns == ["x", "y", "k"]
        assert artefact.results["auc_oot"] > 0.6
        assert (artefact.calibration is None) == (kind == "logreg")
        artefact.save(spark, root)
        loaded = models.load(spark, root, artefact.model_version)
        a, b = train.oot_predictions(artefact, frame), train.oot_predictions(loaded, frame)
        assert sorted(a.collect()) == sorted(b.collect())
        train.write_predictions(a, root)
        ranked = train.write_importance(spark, root, artefact)
        assert models.top_features(ranked, 1).first()["feature"] == "x"
    best = train.select_champion(spark, root, "2024-09-01").first()
    stored = {r["model_version"]: r["results"]["auc_oot"]
              for r in models.registry(spark, root).collect()}
    assert best["champion"] == max(stored, key=stored.get)
    assert train.current_champion(spark, root) == best["champion"]
    assert spark.read.parquet(f"{root}/gold/model_predictions").agg(
        F.min("snapshot_date")).first()[0] == dt.date(2024, 7, 1)
    with pytest.raises(FileNotFoundError, match="credit_gbt_2025_01_01"):
        train.select_champion(spark, root, "2025-01-01")
    with pytest.raises(FileNotFoundError):
        models.load(spark, root, "credit_gbt_2030_01_01")


def test_linear_score_equals_the_stored_pipeline(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, -2.0)], "a double, `b-c` double")
    scaler = {"a": (1.0, 2.0), "b-c": (0.5, 1.5)}
    model = models.linear_model(["a", "b-c"], [0.3, -0.2], 0.1, scaler)
    direct = models.linear_score(["a", "`b-c`"], [0.3, -0.2], 0.1, {**scaler, "`b-c`": scaler["b-c"]})
    rows = model.transform(df).withColumn("direct", direct).collect()
    for r in rows:
        assert r["raw_score"] == pytest.approx(r["direct"])


def test_importance(spark):
    table = models.importance_table(spark, ["a", "b", "c"], [0.2, 0.2, 0.6])
    assert [r["feature"] for r in models.top_features(table, 2).collect()] == ["c", "a"]
    assert models.importance_share(table, 2).first()["top_share"] == pytest.approx(0.8)
    zero = models.importance_table(spark, ["a"], [0.0])
    assert models.importance_share(zero, 1).first()["top_share"] is None
    with pytest.raises(ValueError, match="neither"):
        models.importance_values(object())


def test_model_versions():
    assert models.version("gbt", "2024-09-01") == "credit_gbt_2024_09_01"
    assert models.version("gbt", "2024-09-01", 18) == "credit_gbt_2024_09_01_tt18m"


def test_scaler_statistics_group_by_column(spark):
    """Means and deviations of many columns are two aggregates, not two per column; columns with nulls only,
    and all columns of an empty table, keep their row."""
    names = [f"c{i}" for i in range(60)] + ["with space"]
    values = np.random.default_rng(5).normal(2, 3, (80, len(names)))
    values[::7, 3] = np.nan
    rows = [[None if np.isnan(v) else float(v) for v in row] + [None] for row in values]
    frame = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in [*names, "none"]))
    stats = models.scaler_statistics(frame, [*names, "none"])
    assert stats._jdf.queryExecution().optimizedPlan().toString().count("avg(") == 1
    found = {r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}
    for i, c in enumerate(names):
        assert found[c] == pytest.approx((np.nanmean(values[:, i]), np.nanstd(values[:, i])))
    assert found["none"] == (None, None)
    assert models.scaler_statistics(frame.limit(0), names).count() == len(names)


def test_spread_rows_keep_their_own_exchange(spark):
    """Rows that widen are dealt anew also where the number of parts is that of a shuffle."""
    from workload import tables
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * spark.sparkContext.defaultParallelism))
    try:
        rows = tables.raw(spark, "/root/testdata/sf0.001", "financials").groupBy("Credit_Mix").count()
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    dealt = [x for x in plan.split("Initial Plan")[0].splitlines() if "hashpartitioning(o_custkey" in x]
    assert any("REPARTITION_BY_NUM" in x for x in dealt)
