"""Registered queries against their SQL on the smallest given tables. Set ALL_QUERIES=1 for the
ones that take long; tools/check.py runs all of them at any scale."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from creditloom.operators.align import Windows, temporal_split
from tools.check import compare
from workload import registry
from workload.model_queries import TRAIN_DATE
from workload.tables import GIVEN

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LONG = ("b1", "b2", "b4", "b5", "b6", "b7", "b8_backfill", "m2", "m3", "m12", "m14", "p17_as")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in GIVEN:
        connection.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", [
    n for n in entry.oracle_sql() if os.environ.get("ALL_QUERIES") or not n.startswith(LONG)])
def test_query_equals_sql(spark, db, name):
    result = compare(entry.queries()[name](spark, SF), db.sql(entry.oracle_sql()[name]))
    assert result.startswith("ok") and "[" not in result, result


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_sql_binds(db, name):
    """The text of every query, also of those that take long, names only what there is."""
    db.sql("explain " + entry.oracle_sql()[name])


@pytest.mark.parametrize("first", ["model_queries", "table_queries", "join_queries", "drift_queries"])
def test_sql_does_not_depend_on_the_order_of_imports(first):
    code = (f"import sys, json; sys.path.insert(0, {ROOT!r}); import workload.{first}; import __spark_entry__ as e;"
            "print(json.dumps(e.oracle_sql(), sort_keys=True))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout
    assert json.loads(out.splitlines()[-1]) == entry.oracle_sql()


def test_an_unknown_shared_table_is_an_error():
    with pytest.raises(KeyError, match="t_nobody"):
        registry.with_shared("select * from t_nobody")


def test_entry(spark):
    assert entry.entry(spark).count() > 50


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_calibration_is_fitted_on_the_test_split(spark):
    """At the fitted sigmoid the probabilities of the test rows add up to their smoothed outcomes."""
    out = temporal_split(entry.queries()["m10_platt_calibrate"](spark, SF), Windows.before(TRAIN_DATE))
    rows = out.where("split = 'test'").select("label", "calibrated").collect()
    pos = sum(r["label"] for r in rows)
    neg = len(rows) - pos
    wanted = pos * (pos + 1) / (pos + 2) + neg / (neg + 2)
    assert pos and neg and abs(sum(r["calibrated"] for r in rows) - wanted) < 1e-3 * len(rows)
