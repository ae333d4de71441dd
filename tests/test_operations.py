"""Open vocabularies, stored sketches, resumable search, leaf values, profiles and the run ledger."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators import align, customer_state, encode, leaves, models, point_in_time, sketches
from creditloom.plans import ledger, operate, train


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_vocabulary_of_a_million_labels(spark):
    """One label has a third of all rows, a million others occur once or twice."""
    rows = spark.range(1_500_000).select(
        F.lit("2024-01-01").cast("date").alias("snapshot_date"),
        F.when(F.col("id") % 3 == 0, "often").when(F.col("id") % 100 == 1, "sometimes")
        .otherwise(F.concat(F.lit("rare"), F.col("id") % 999_983)).alias("kind"))
    counts, labels = session.stage(encode.label_counts(rows, ["kind"]), "labels")
    assert labels > 600_000
    vocabulary = encode.frequent_labels(counts, ["kind"], most=10, min_share=0.005)
    assert [(r.position, r.label) for r in vocabulary.orderBy("position").collect()] == [(0, "often"), (1, "sometimes")]
    unseen = encode.unseen_labels(counts, vocabulary).first()
    known = rows.where("kind in ('often', 'sometimes')").count()
    assert unseen["n_unseen"] == 1_500_000 - known and unseen["n_unseen_labels"] == labels - 2
    fitted = encode.fit_vocabulary(rows, ["kind"], most=2)
    assert fitted == {"kind": ["often", "sometimes"]}
    with pytest.raises(ValueError, match="most"):
        encode.fit_vocabulary(rows, ["kind"])
    sums = encode.one_hot(rows, fitted, other=True).agg(F.sum("kind_often"), F.sum("kind_sometimes"), F.sum("kind_other")).first()
    assert sum(sums) == 1_500_000 and sums[2] == unseen["n_unseen"]


def test_sketches_of_months_merge(spark):
    rows = spark.range(30_000).select(
        F.expr("add_months(date'2024-01-01', cast(id % 3 as int))").alias("snapshot_date"),
        F.expr("cast((id * 7919) % 30011 as double)").alias("x"), F.when(F.col("id") % 5 == 0, 1).alias("y"), F.lit(None).cast("int").alias("z"))
    table, n = session.stage(sketches.month_sketches(rows, ["x", "y", "z"]), "sketches")
    assert n == 9
    values = np.array([r.x for r in rows.select("x").collect()])
    months = np.array([r[0].month for r in rows.select("snapshot_date").collect()])
    bound = sketches.rank_error()
    for r in sketches.quantiles_so_far(table, [0.1, 0.5, 0.97]).collect():
        if r["column"] != "x":
            assert r.n == {"y": 2000 * r.snapshot_date.month, "z": 0}[r["column"]]
            continue
        part = np.sort(values[months <= r.snapshot_date.month])
        assert r.n == len(part)
        for p, q in zip((0.1, 0.5, 0.97), r.quantiles):
            assert abs(np.searchsorted(part, q) / len(part) - p) <= bound
    every = {r["column"]: r for r in sketches.quantiles(table, [0.5]).collect()}
    assert every["x"].n == 30_000 and every["z"].quantiles == [None]


def test_carried_state_equals_reading_everything(spark):
    row = lambda n, m: spark.range(n).select(
        F.concat(F.lit("c"), F.col("id") * 7 % 31).alias("Customer_ID"),
        F.expr(f"add_months(date'2024-01-01', cast(id * {m} % 7 as int))").alias("snapshot_date"), (F.col("id") % 13).cast("int").alias("a"))
    anchors = row(60, 5).groupBy("Customer_ID", "snapshot_date").agg(F.max("a").alias("amount"))
    source, history = row(90, 3).withColumn("b", F.when(F.col("a") % 4 > 0, F.col("a"))), row(200, 2).withColumnRenamed("a", "fe")
    want = point_in_time.as_of(anchors, {"s": source}, history, ["fe"])
    state, out = None, None
    for month in range(7):
        at = F.col("snapshot_date") == F.expr(f"add_months(date'2024-01-01', {month})")
        state = session.stage(customer_state.extend(state, {"s": source.where(at)}, history.where(at), ["fe"]), "state")[0]
        part = customer_state.as_of_state(anchors.where(at), state, {"s": source}, ["fe"])
        out = part if out is None else out.unionByName(part)
    assert rows_of(out.select(want.columns)) == rows_of(want)
    assert state.count() == state.select("Customer_ID").distinct().count()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3))
    y = (rng.random(600) < 1 / (1 + np.exp(-1.5 * x[:, 0] + x[:, 1]))).astype(int)
    rows = spark.createDataFrame([(*map(float, a), int(b), int(k % 3)) for k, (a, b) in enumerate(zip(x, y))],
                                 "a double, b double, c double, label int, block int")
    return session.stage(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows), "vectors")[0]


def test_leaf_values_are_newton_steps(spark, vectors):
    params = {"n_estimators": 4, "max_depth": 2, "learning_rate": 0.3, "reg_alpha": 1.0, "reg_lambda": 2.0}
    model = models.gbt(params).fit(vectors)
    values = leaves.newton(model, vectors, params)
    rows = leaves.with_leaves(model, vectors).collect()
    margin = np.zeros(len(rows))
    y, leaf = np.array([r.label for r in rows]), np.array([r._leaf for r in rows]).astype(int)
    for t, count in enumerate(leaves.leaf_counts(model)):
        p = 1 / (1 + np.exp(-margin))
        want = []
        for k in range(count):
            at = leaf[:, t] == k
            g, h = (p - y)[at].sum(), (p * (1 - p))[at].sum()
            want.append(-0.3 * np.sign(g) * max(abs(g) - 1.0, 0) / (h + 2.0))
        assert values[t] == pytest.approx(want, abs=1e-9)
        margin += np.array(values[t])[leaf[:, t]]
    score = np.array([r.raw_score for r in leaves.scored(model, values, vectors).collect()])
    assert np.allclose(score, 1 / (1 + np.exp(-margin)))
    held = np.array(leaves.newton(model, vectors, params | {"reg_alpha": 1e9})[0])
    assert (held == 0).all()  # alpha shrinks everything to nothing, lambda only makes values smaller
    more = leaves.newton(model, vectors, params | {"reg_alpha": 0.0, "reg_lambda": 50.0})[0]
    less = leaves.newton(model, vectors, params | {"reg_alpha": 0.0, "reg_lambda": 0.0})[0]
    assert all(abs(a) < abs(b) for a, b in zip(more, less))


def test_search_goes_on_where_it_stopped(spark, vectors, monkeypatch):
    folder = session.scratch_path(spark, "ledger")
    book = models.SearchLedger(spark, folder)
    points = [{"n_estimators": 2, "max_depth": d, "reg_lambda": 1} for d in (1, 2)]
    assert book.rows().count() == 0
    done, fit = [], models.fold_auc

    def counted(v, point, fold, label="label"):
        if len(done) == 3:
            raise RuntimeError("stopped")
        done.append((point["max_depth"], fold))
        return fit(v, point, fold, label)
    monkeypatch.setattr(models, "fold_auc", counted)
    with pytest.raises(RuntimeError):
        models.temporal_search(vectors, points, 2, parallelism=1, ledger=book)
    assert book.rows().count() == 3
    again = []
    monkeypatch.setattr(models, "fold_auc", lambda *a, **k: again.append(a[2]) or fit(*a, **k))
    ranked = models.temporal_search(vectors, points, 2, parallelism=1, ledger=book)
    assert len(again) == 1 and book.rows().count() == 4
    best = book.best(2).first()
    assert best["point"] == models.SearchLedger.key(ranked[0][0]) and best["mean_auc"] == pytest.approx(ranked[0][1])
    assert models.temporal_search(vectors, points, 2, parallelism=2, ledger=book) == ranked and len(again) == 1


def test_searched_parameters_all_have_an_effect():
    assert set(models.SEARCH_SPACE) == {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "gamma",
                                        "min_child_weight", "reg_alpha", "reg_lambda"}


def test_profile_finds_equal_columns_and_rows(spark):
    rows = spark.range(200).select(
        F.col("id").cast("string").alias("Customer_ID"), F.expr("add_months(date'2024-01-01', cast(id % 2 as int))").alias("snapshot_date"),
        (F.col("id") % 9).alias("a"), F.when(F.col("id") % 4 > 1, F.col("id")).alias("b"))
    rows = rows.withColumns({"copy_a": F.col("a").cast("double"), "copy_b": F.col("b"), "other": F.col("a") + F.when(F.col("id") == 7, 1).otherwise(0)
                             if "id" in rows.columns else F.col("a") + (F.col("Customer_ID") == "7").cast("int")})
    found = {(r.side, r.feature): r for r in operate.data_summary(
        rows, ["a", "b", "copy_a", "copy_b", "other"], "2024-01-01", "2024-02-01").collect()}
    assert {k: r.duplicate_of for k, r in found.items() if r.duplicate_of} == {
        (s, f"copy_{c}"): c for s in ("baseline", "current") for c in "ab"} | {("baseline", "other"): "a"}
    assert found["current", "a"].quartiles == [2.0, 4.0, 6.0]
    twice = operate.repeated_rows(rows.unionAll(rows.limit(5)), rows.columns).collect()
    assert sum(r.n_repeated for r in twice) == 5 and sum(r.n_rows for r in twice) == 205


def test_ledger_keeps_what_jobs_noticed(spark, tmp_path):
    root = str(tmp_path)
    assert ledger.read(spark, root).count() == 0
    lms = spark.sql("select 'c' as Customer_ID, date'2024-01-01' as snapshot_date, 0 as mob from range(3)")
    source = spark.sql("select id as Customer_ID, date'2024-02-01' as snapshot_date, if(id = 1, 'new', 'old') as kind from range(4)")
    labels = spark.sql("select date'2024-01-01' as snapshot_date, if(id = 0, null, 1) as label from range(3)")
    vocabulary = encode.vocabulary_table(spark, {"kind": ["old"]})
    ledger.keep(ledger.audit(lms, {"s": source}, labels, vocabulary, {"s": ["kind"]}), root, "feature_store", "first")
    ledger.note(spark, root, "score", "m", {"absent:x": 1})
    got = {(r.job, r.metric): r.n for r in ledger.read(spark, root).collect()}
    assert got == {("feature_store", "collapsed:applications"): 2, ("feature_store", "collapsed:s"): 0,
                   ("feature_store", "unseen:kind"): 1, ("feature_store", "unlabelled"): 1, ("score", "absent:x"): 1}


def test_rows_without_label_and_lonely_champions(spark):
    rows = spark.range(100).select(F.col("id").alias("loan_id"), F.when(F.col("id") % 5 > 0, F.col("id") % 2).cast("int").alias("label"))
    split = align.stratified_split(rows)
    assert split.count() == 100 and split.where("label is null").select("split").distinct().count() == 2
    one = models.champion(spark.createDataFrame([("m", 0.7, 1)], "model_version string, auc_oot double, position int")).first()
    assert (one["champion"], one["runner_up"], one["margin"]) == ("m", None, None)
    assert train.MODEL_KINDS


def test_months_from_the_carried_state_do_not_derive_raw_rows_again(spark):
    """Applications are stored once: no month's features read the given orders."""
    import __spark_entry__
    files = __spark_entry__.queries()["m3_carried_state"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "/testdata/" in f]
