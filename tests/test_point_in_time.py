"""Point-in-time joins against a row-by-row search; nothing from the future may enter."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from creditloom.operators import align
from creditloom.operators import point_in_time as pit
from creditloom.operators.align import Windows


def month(i: int) -> dt.date:
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    customers = ["hot"] * 30 + [f"c{i}" for i in range(15)]
    anchors = sorted({(rng.choice(customers), month(rng.randrange(24))) for _ in range(120)})
    source = {(rng.choice(customers), month(rng.randrange(24))): rng.randrange(100)
              for _ in range(150)}
    history = [(rng.choice(customers), month(rng.randrange(24)), rng.randrange(50))
               for _ in range(400)]
    return anchors, source, history


def test_as_of_and_history(spark, data):
    anchors, source, history = data
    a = spark.createDataFrame([(c, d, i) for i, (c, d) in enumerate(anchors)],
                              "Customer_ID string, snapshot_date date, i int")
    s = spark.createDataFrame([(c, d, v) for (c, d), v in source.items()],
                              "Customer_ID string, snapshot_date date, v int")
    h = spark.createDataFrame(history, "Customer_ID string, snapshot_date date, fe int")
    got = pit.as_of(a, {"s": s}, h, ["fe"], dates=True).collect()
    assert sorted(r["i"] for r in got) == list(range(len(anchors)))
    for r in got:
        c, d = r["Customer_ID"], r["snapshot_date"]
        known = [(x, v) for (k, x), v in source.items() if k == c and x <= d]
        assert (r["s_date"], r["v"]) == (max(known) if known else (None, None))
        past = [v for k, x, v in history if k == c and x <= d]
        assert r["fe"] == (pytest.approx(sum(past) / len(past)) if past else None)


def test_repeated_source_rows_do_not_multiply_applications(spark):
    d = dt.date(2023, 1, 1)
    a = spark.createDataFrame([("c", d, 1.0)], "Customer_ID string, snapshot_date date, x double")
    s = spark.createDataFrame([("c", d, v) for v in (3, 1, 2) * 50],
                              "Customer_ID string, snapshot_date date, v int")
    assert [tuple(r) for r in pit.as_of(a, {"s": s}).collect()] == [("c", d, 1.0, 1)]


def test_as_coded_join_equals_as_of_for_single_early_snapshots(spark):
    a = spark.createDataFrame([("c", month(5)), ("e", month(6))],
                              "Customer_ID string, snapshot_date date")
    s = spark.createDataFrame([("c", month(1), 7)], "Customer_ID string, snapshot_date date, v int")
    assert (sorted(map(tuple, pit.as_of(a, {"s": s}).collect()), key=str)
            == sorted(map(tuple, pit.left_as_coded(a, s).collect()), key=str))


def test_applications_take_the_lowest_loan(spark):
    d = dt.date(2023, 1, 1)
    lms = spark.createDataFrame(
        [("l2", "c", d, 0, 20.0, 10), ("l1", "c", d, 0, 10.0, 12), ("l0", "c", d, 1, 5.0, 10)],
        "loan_id string, Customer_ID string, snapshot_date date, mob int, loan_amt double,"
        " tenure int")
    assert [tuple(r) for r in pit.applications(lms).collect()] == [("c", d, 10.0, 12)]


def test_windows():
    w = Windows.before("2024-09-01")
    assert [str(x) for x in (w.train_start, w.train_end, w.test_end, w.oot_start, w.oot_end)] == [
        "2023-07-01", "2024-04-30", "2024-06-30", "2024-07-01", "2024-08-31"]
    assert str(Windows.before("2024-05-01", tt_months=12).train_end) == "2023-12-29"


def test_temporal_split_is_ordered_and_complete(spark):
    rows = spark.createDataFrame([(month(i),) for i in range(60)], "snapshot_date date")
    split = align.temporal_split(rows, Windows.before("2024-09-01")).collect()
    dates = {s: sorted(r["snapshot_date"] for r in split if r["split"] == s)
             for s in ("train", "test", "oot")}
    assert {k: len(v) for k, v in dates.items()} == {"train": 10, "test": 2, "oot": 2}
    assert dates["train"][-1] < dates["test"][0] and dates["test"][-1] < dates["oot"][0]


@pytest.mark.parametrize("path", ["plain", "sliced"])
def test_stratified_split_has_exact_counts(spark, path, request):
    if path == "sliced":
        request.getfixturevalue("sliced")
    rows = spark.range(1003).selectExpr("string(id) as loan_id", "int(id % 10 = 0) as label")
    got = align.stratified_split(rows).groupBy("label", "split").count().collect()
    assert {(r[0], r[1]): r[2] for r in got} == {
        (0, "train"): 721, (0, "test"): 181, (1, "train"): 80, (1, "test"): 21}


@pytest.mark.parametrize("path", ["plain", "sliced"])
def test_expanding_folds(spark, path, request):
    if path == "sliced":
        request.getfixturevalue("sliced")
    rows = spark.createDataFrame([(f"c{i}", month(i % 7)) for i in range(103)],
                                 "Customer_ID string, snapshot_date date")
    got = align.expanding_folds(rows).collect()
    sizes = [sum(r["block"] == b for r in got) for b in range(4)]
    assert sizes == [28, 25, 25, 25]
    for b in range(3):
        assert (max(r["snapshot_date"] for r in got if r["block"] == b)
                <= min(r["snapshot_date"] for r in got if r["block"] == b + 1))


def test_only_rows_whose_key_repeats_are_compared(spark, monkeypatch):
    from creditloom import session
    rows = [("a", dt.date(2024, 1, 1), 2, "x"), ("a", dt.date(2024, 1, 1), 1, "z"), (None, None, 5, "n"),
            (None, None, 4, None), ("b", dt.date(2024, 1, 1), 7, "y"), ("a", None, 3, "q")]
    schema = "Customer_ID string, snapshot_date date, v int, t string"
    want = {("a", dt.date(2024, 1, 1), 1, "z"), (None, None, 4, None), ("b", dt.date(2024, 1, 1), 7, "y"),
            ("a", None, 3, "q")}
    for most in (1_000_000, 0):
        monkeypatch.setattr(session, "SINGLE_TASK_ROWS", most)
        got = pit.one_row_per(spark.createDataFrame(rows, schema)).collect()
        assert len(got) == 4 and {tuple(r) for r in got} == want
    # Without repeated keys nothing is aggregated, and as_of has no shuffle of whole rows but its own.
    once = spark.createDataFrame(rows[4:], schema)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan(pit.one_row_per(once))
    both = pit.as_of(once.select("Customer_ID", "snapshot_date"), {"s": once})
    assert plan(both).count("Exchange") == 1


def test_sources_meet_the_applications_in_one_exchange(spark, monkeypatch):
    """No exchange, aggregate or sort of keys or behaviour rows before that of the join itself; a customer
    with more rows than a task should sort is reduced first, with the same result."""
    from creditloom import session
    day = lambda m: dt.date(2024, m, 1)
    a = spark.createDataFrame([("a", day(2)), ("a", day(4)), ("b", day(3))], "Customer_ID string, snapshot_date date")
    s = spark.createDataFrame(
        [("a", day(1), 5, None), ("a", day(1), 5, "x"), ("a", day(3), 9, "y"), ("a", day(3), 2, "z"), ("a", day(3), None, "w"),
         ("b", day(3), 1, "q"), ("b", day(3), 1, "p"), ("b", day(5), 0, "late"), (None, None, 0, "none")],
        "Customer_ID string, snapshot_date date, v int, t string")
    h = spark.createDataFrame(
        [("a", day(1), 1, 10), ("a", day(1), 2, None), ("a", day(4), 6, None), ("b", day(4), 1, 1)],
        "Customer_ID string, snapshot_date date, fe_1 int, fe_2 int")
    want = {("a", day(2), 5, None, 1.5, 10.0), ("a", day(4), None, "w", 3.0, 10.0), ("b", day(3), 1, "p", None, None)}
    for most in (1_000_000, 0):
        monkeypatch.setattr(session, "SINGLE_TASK_ROWS", most)
        joined = pit.as_of(a, {"s": s}, h, ["fe_1", "fe_2"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in joined.collect()} == want
        if most:
            assert plan.count("Exchange") == 1 and "Aggregate" not in plan
    # The sort's partitions grow with the rows, whatever number the session has.
    monkeypatch.setattr(pit, "SORT_ROWS", 1)
    plan = pit.as_of(a, {"s": s}, h, ["fe_1", "fe_2"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(Customer_ID" in plan and ", 13)" in plan
