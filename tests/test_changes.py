"""Change-driven backfill and monitoring from its state."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators import monitor_state
from creditloom.operators.metrics import classification_metrics
from creditloom.operators.scoring import with_month_outcomes
from creditloom.plans import changes
from creditloom.sources import tables
from creditloom.sources.registry import SOURCES, source

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_fingerprints_see_rows_not_their_order(spark):
    rows = [("2024-01-01", "a", None), ("2024-01-01", "b", "x"), ("2024-02-01", None, "a")]
    one = lambda r: {x.snapshot_date: x.fingerprint for x in changes.fingerprints(
        spark.createDataFrame(r, "snapshot_date string, p string, q string"), "snapshot_date").collect()}
    base = one(rows)
    assert one(rows[::-1]) == base
    assert one([*rows, rows[0]])["2024-01-01"] != base["2024-01-01"]  # repeated rows count
    assert one([rows[0], rows[1], ("2024-02-01", "a", None)])["2024-02-01"] != base["2024-02-01"]  # nulls have a place
    assert one(rows[:2]).keys() == {"2024-01-01"}


def test_changed_months(spark):
    made = lambda *r: spark.createDataFrame([(s, dt.date.fromisoformat(d), f) for s, d, f in r], changes.FINGERPRINT)
    now = made(("lms", "2024-01-01", "1"), ("lms", "2024-02-01", "2"), ("lms", "2024-03-01", "3"))
    before = made(("lms", "2024-01-01", "1"), ("lms", "2024-02-01", "x"), ("lms", "2023-12-01", "0"))
    got = {(str(r.snapshot_date), r.change) for r in changes.changed(now, before).collect()}
    assert got == {("2024-02-01", "changed"), ("2024-03-01", "new"), ("2023-12-01", "removed")}
    assert changes.changed(now, now).count() == 0


def test_plan_follows_what_reads_what(spark):
    months = [dt.date(2023 + k // 12, k % 12 + 1, 1) for k in range(24)]
    tables_ = {t for t, _, _ in changes.READS} | {r for _, r, _ in changes.READS}
    calendars = spark.createDataFrame([(t, m) for t in tables_ for m in months], "table string, snapshot_date date")

    def planned(name, month):
        change = spark.createDataFrame([(name, month)], "source string, snapshot_date date")
        out = {}
        for r in changes.plan(change, calendars).collect():
            out.setdefault(r.table, set()).add(r.snapshot_date)
        return out
    got = planned("attributes", months[10])
    assert got["bronze/attributes"] == got["silver/attributes"] == {months[10]}
    assert got["gold/feature_store"] == set(months[10:]) and "gold/label_store" not in got
    assert got["gold/model_predictions"] == got["gold/model_monitoring"] == set(months[16:])
    got = planned("lms", months[10])
    assert got["gold/label_store"] == got["gold/feature_store"] == {months[10]}
    assert got["gold/model_predictions"] == {months[16]}
    assert got["gold/model_monitoring"] == {months[10], months[4], months[16]}
    assert planned("clickstream", months[23]).keys() == {"bronze/clickstream", "silver/clickstream", "gold/feature_store"}
    # The first month with predictions is what all months are measured against; here it is made again.
    first = calendars.where("table <> 'gold/model_predictions'").unionByName(
        calendars.where("table = 'gold/model_predictions'").where(F.col("snapshot_date") >= F.lit(months[16])))
    got = {r.snapshot_date for r in changes.plan(
        spark.createDataFrame([("lms", months[10])], "source string, snapshot_date date"), first).where(
        "table = 'gold/model_monitoring'").collect()}
    assert got == set(months)


def land(spark, folder, raw_of):
    for name in SOURCES:
        raw_of(name).write.option("header", True).csv(f"{folder}/{source(name).file_name}")


@given
def test_backfill_makes_what_changed_and_nothing_else(spark):
    from workload.inputs import Inputs
    x, root = Inputs(spark, SF), session.scratch_path(spark, "mart")
    since = {"lms": "2001-04-01", "clickstream": "2001-05-01", "financials": "2001-03-01", "attributes": "1995-11-01"}
    raw = {name: x.raw(name).where(F.col("snapshot_date") >= since.get(name, "")).select(*source(name).schema.names)
           for name in SOURCES}
    first, second, fresh = (session.scratch_path(spark, n) for n in ("raw", "raw", "mart"))
    land(spark, first, raw.__getitem__)
    assert changes.backfill(spark, first, root).count() > 10
    assert changes.backfill(spark, first, root).count() == 0  # nothing changed, nothing is done

    month = max(str(r[0]) for r in raw["attributes"].select("snapshot_date").distinct().collect())
    altered = dict(raw)
    altered["attributes"] = raw["attributes"].withColumn(
        "Age", F.when(F.col("snapshot_date") == month, "55").otherwise(F.col("Age")))
    altered["lms"] = raw["lms"].where("snapshot_date <> '2001-08-01'")  # a month that is withdrawn
    land(spark, second, altered.__getitem__)

    def files():
        found = {}
        for layer, name in (("silver", "attributes"), ("silver", "lms"), ("gold", "feature_store"), ("gold", "label_store")):
            t = tables.read_table(spark, tables.table_path(root, layer, name))
            for r in t.select(F.col("snapshot_date").cast("string").alias("m"), F.input_file_name().alias("f")).distinct().collect():
                found.setdefault(f"{layer}/{name}", {}).setdefault(r.m, set()).add(r.f)
        return found
    before = files()
    done = {}
    for r in changes.backfill(spark, second, root).collect():
        done.setdefault(r.table, set()).add(str(r.snapshot_date))
    after = files()
    assert done["silver/attributes"] == {month} and done["gold/feature_store"] and done["silver/lms"] == {"2001-08-01"}
    for table, parts in before.items():
        rewritten = {m for m in parts if after[table].get(m) != parts[m]}
        assert rewritten == done.get(table, set()) & set(parts), table
    assert "2001-08-01" not in after["silver/lms"] and "2001-08-01" not in after["gold/feature_store"]

    # The same tables as a run from nothing gives with the vocabularies of the first run.
    for layer, name in (("silver", "loan_type_vocabulary"), ("gold", "vocabulary")):
        tables.overwrite_table(tables.read_table(spark, tables.table_path(root, layer, name)), tables.table_path(fresh, layer, name))
    changes.backfill(spark, second, fresh)
    for layer, name in (("silver", "attributes"), ("silver", "loan_type"), ("gold", "label_store"), ("gold", "feature_store")):
        assert rows_of(tables.read_table(spark, tables.table_path(root, layer, name))) == rows_of(
            tables.read_table(spark, tables.table_path(fresh, layer, name))), name


def test_state_gives_the_metrics_of_the_rows(spark):
    predictions = spark.sql("""
        select m as model_name, add_months(date'2024-01-01', cast(id % 9 as int)) as snapshot_date,
               cast(id as string) as Customer_ID, round(((id * 37) % 101) / 101d, 2) as model_predictions
        from range(3000) lateral view explode(array('a', 'b')) as m""")
    labels = spark.sql("""
        select cast(id as string) as Customer_ID, add_months(date'2024-01-01', cast(id % 9 as int) + if(id % 9 < 4, 0, 6))
               as snapshot_date, cast((id * 13) % 7 < 2 as int) as label
        from range(3000) where id % 5 <> 0""")
    state = monitor_state.score_state(predictions, labels)
    totals = monitor_state.month_totals(state)
    measures = ["auc", "precision", "recall", "f1", "brier"]
    want = classification_metrics(with_month_outcomes(predictions, labels), monitor_state.KEYS)
    key = lambda df: {tuple(r[:2]): [round(v, 9) for v in r[2:]] for r in df.select(*monitor_state.KEYS, *measures).collect()}
    assert key(monitor_state.quality(state, totals)) == key(want)
    halves = [monitor_state.score_state(predictions.where(f"Customer_ID % 2 = {k}"), labels) for k in (0, 1)]
    assert rows_of(monitor_state.merged(*halves)) == rows_of(state)
    assert {r.n_scored for r in totals.collect()} <= {333, 334}
