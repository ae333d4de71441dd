"""The jobs end to end on a small raw delivery: idempotent, complete, guarded."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from creditloom import session
from creditloom.operators import models
from creditloom.plans import gold, ingest, operate, train
from creditloom.sources import calendar, registry, tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def mart(spark):
    from workload.table_queries import Warehouse
    return Warehouse(spark, SF).need("labels", "features")


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_ingest_counts(spark, mart):
    audit = {(r["layer"], r["table_name"]): r["n"] for r in mart.audit.collect()}
    assert audit["bronze", "lms"] == 1500 * 11
    for name in registry.SOURCES:
        assert audit["bronze", name] == audit["silver", name] == mart.table("silver", name).count()


def test_feature_store_is_unique_complete_and_without_nulls(spark, mart):
    features = mart.table("gold", "feature_store")
    numbers = [f.name for f in features.schema.fields if isinstance(f.dataType, NumericType)]
    nulls = features.agg(*[F.count_if(F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`")
                                      .cast("double"))).alias(str(i))
                           for i, c in enumerate(numbers)]).first()
    assert len(numbers) > 70 and set(nulls) == {0}
    keys = features.select("Customer_ID", "snapshot_date")
    assert keys.distinct().count() == keys.count()
    applied = mart.table("silver", "lms").where("mob = 0").select("Customer_ID", "snapshot_date")
    assert keys.count() == applied.distinct().count()


def test_rerunning_one_month_changes_nothing(spark, mart):
    month = "1998-06-01"
    before = {n: rows_of(mart.table(*n)) for n in (
        ("silver", "attributes"), ("silver", "financials"), ("silver", "loan_type"),
        ("gold", "label_store"), ("gold", "feature_store"))}
    for name in ("attributes", "financials"):
        ingest.bronze(spark, mart.raw, mart.root, name, [month])
        ingest.silver(spark, mart.root, name, [month])
    gold.label_store(spark, mart.root)
    written = gold.feature_store(spark, mart.root, months=[month])
    assert written.get["rows"] == mart.table("gold", "feature_store").where(
        F.col("snapshot_date") == F.lit(month).cast("date")).count()
    for n, rows in before.items():
        assert rows_of(mart.table(*n)) == rows, n


def test_later_data_does_not_change_earlier_features(spark, mart):
    """Dropping everything after a month leaves the features of that month as they were."""
    cutoff = F.lit("1997-06-01").cast("date")
    part = {n: mart.table("silver", n) for n in
            ("lms", "financials", "attributes", "loan_type", "clickstream")}
    from creditloom.operators.encode import vocabulary_of
    vocabulary = vocabulary_of(mart.table("gold", "vocabulary"))
    early = gold.build_feature_store(
        *[part[n].where(F.col("snapshot_date") <= cutoff) for n in part], vocabulary)
    full = mart.table("gold", "feature_store").where(F.col("snapshot_date") <= cutoff)
    assert rows_of(early.select(*sorted(early.columns))) == rows_of(
        full.select(*sorted(early.columns)))


def test_as_coded_mode_matches_every_snapshot(spark, mart):
    part = [mart.table("silver", n) for n in
            ("lms", "financials", "attributes", "loan_type", "clickstream")]
    coded = gold.joined_sources(*part, mode="as_coded")
    fins = part[1].groupBy("Customer_ID").count()
    types = part[3].groupBy("Customer_ID").agg(F.count("*").alias("t"))
    expected = (gold.applications(part[0]).join(fins, "Customer_ID", "left")
                .join(types, "Customer_ID", "left")
                .agg(F.sum(F.coalesce("count", F.lit(1)) * F.coalesce("t", F.lit(1)))).first()[0])
    assert coded.count() == expected
    with pytest.raises(ValueError, match="mode"):
        gold.joined_sources(*part, mode="other")


def test_train_score_monitor_alert(spark, mart):
    mart.need("monitoring")
    champion = train.current_champion(spark, mart.root)
    monitored = mart.table("gold", "model_monitoring")
    months = [str(r[0]) for r in monitored.select("snapshot_date").orderBy("snapshot_date").collect()]
    assert months == ["1998-07-01", "1998-08-01", "1998-09-01", "1998-10-01", "1998-11-01",
                      "1998-12-01"]
    first = monitored.orderBy("snapshot_date").first()
    assert first["psi"] == 0 and first["csi_max"] == 0 and first["model_name"] == champion
    curves = {(r["model_name"], r["kind"]): r["n"] for r in mart.table("gold", "model_reliability").groupBy(
        "model_name", "kind").agg(F.sum("n").alias("n")).collect()}
    assert len(curves) == 3 and len(set(curves.values())) == 1  # the linear model has no calibration
    assert operate.alert(spark, mart.root).count() == 1
    assert operate.alert(spark, mart.root, "first_row").count() == 1
    watched = operate.watched_features(spark, mart.root, champion).count()
    assert len([c for c in monitored.columns if c.startswith("csi_")]) == watched + 2
    before = rows_of(monitored)
    assert rows_of(operate.monitor(spark, mart.root, champion)) == before
    comparison = train.train(spark, mart.root, "1998-09-01", 18, kinds=["logreg"])
    assert comparison[0].model_version.endswith("_tt18m")
    assert train.current_champion(spark, mart.root) == champion
    assert models.registry(spark, mart.root).count() == 3


def test_guards(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="Unknown source table"):
        registry.source("bureau")
    assert operate.score_months(spark, root, "credit_gbt_2024_09_01") is None
    assert operate.monitor(spark, root, "credit_gbt_2024_09_01") is None
    assert operate.alert(spark, root) is None
    assert train.current_champion(spark, root) is None
    assert tables.read_month(spark, root + "/none", "2024-01-01") is None
    assert tables.read_or_empty(spark, root + "/none", "a int").count() == 0


def test_partition_overwrite_leaves_other_months(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("2024-01-01", 1), ("2024-02-01", 2)], "snapshot_date string, v int")
    assert tables.overwrite_partitions(both, path).get["rows"] == 2
    tables.overwrite_partitions(both.where("v = 2").withColumn("v", F.lit(9)), path)
    assert sorted(r["v"] for r in tables.read_table(spark, path).collect()) == [1, 9]


def test_merged_schema_keeps_late_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).selectExpr("'2024-01-01' as snapshot_date", "1 as a").write.partitionBy(
        "snapshot_date").parquet(path)
    spark.range(1).selectExpr("'2024-02-01' as snapshot_date", "1 as a", "2 as b").write.mode(
        "append").partitionBy("snapshot_date").parquet(path)
    assert "b" in tables.read_table(spark, path, merge_schemas=True).columns


def test_calendar(spark):
    months = [str(r[0]) for r in calendar.month_calendar(spark, "2023-11-15", "2024-02-01").collect()]
    assert months == ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    gate = calendar.training_gate(calendar.month_calendar(spark, "2024-08-01", "2024-10-01"), "2024-09-01")
    assert [r["should_train"] for r in gate.orderBy("snapshot_date").collect()] == [False, True, False]
    ds = spark.sql("select date'2024-09-01' as ds").select(calendar.application_month(F.col("ds")))
    assert str(ds.first()[0]) == "2024-03-01"


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Cluster())


def test_loan_types_are_fitted_on_a_window_and_later_ones_counted(spark, mart):
    root = session.scratch_path(spark, "window")
    ingest.bronze(spark, mart.raw, root, "financials")
    with pytest.raises(ValueError, match="all months"):
        ingest.silver(spark, root, "financials", ["1994-11-01"])
    early = ingest.fit_loan_types(spark, root, until="1992-01-31")
    every = ingest.fit_loan_types(spark, root)
    assert set(early) <= set(every)
    assert ingest.unseen_loan_types(spark, root).count() == 0
    from creditloom.operators.encode import vocabulary_table
    from creditloom.sources import tables
    tables.overwrite_table(vocabulary_table(spark, {"loan_type": every[1:]}).coalesce(1),
                           tables.table_path(root, "silver", "loan_type_vocabulary"))
    unseen = ingest.unseen_loan_types(spark, root).collect()
    assert {r.loan_type for r in unseen} == {every[0]} and sum(r.n for r in unseen) > 0


def test_scope_deletes_its_tables(spark):
    def there(path):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    with pytest.raises(RuntimeError):
        with session.Scope(spark, "test") as scope:
            table = scope.table(spark.range(5))
            assert table.count() == 5 and there(table.scope_path)
            raise RuntimeError
    assert not there(table.scope_path)


def test_a_job_deletes_what_it_staged(spark):
    seen = []

    @session.job
    def run(fail):
        table, rows = session.stage(spark.range(5))
        seen.append((rows, os.path.dirname(table.inputFiles()[0]).replace("file:", "")))
        if fail:
            raise ValueError("stopped")
        return table.count()

    assert run(False) == 5
    with pytest.raises(ValueError):
        run(True)
    assert [rows for rows, _ in seen] == [5, 5]
    assert not any(os.path.exists("/" + path.lstrip("/")) for _, path in seen)
    kept, _ = session.stage(spark.range(3))  # outside a job
    assert kept.count() == 3


def test_monitoring_without_features(spark):
    predictions = spark.sql("""
        select 'm' as model_name, date'2024-01-01' as snapshot_date, cast(id as string) as Customer_ID,
               id / 10d as model_predictions from range(10)""")
    labels = spark.sql("""
        select cast(id as string) as Customer_ID, date'2024-07-01' as snapshot_date,
               cast(id > 4 as int) as label from range(10)""")
    baselines = spark.createDataFrame([("m", 1.0)], "model_name string, oot_auc double")
    row = operate.monitoring_table(predictions, labels, None, ["fe_1"], baselines).first()
    assert (row["n_scored"], row["auc"], row["csi_max"], row["csi_fe_1"]) == (10, 1.0, None, None)


def test_late_outcomes_update_their_months(spark, mart):
    """Last in this file: it changes the labels of the warehouse."""
    mart.need("monitoring")
    champion = train.current_champion(spark, mart.root)
    path = tables.table_path(mart.root, "gold", "label_store")
    monitored = lambda: tables.read_table(spark, tables.table_path(mart.root, "gold", "model_monitoring"))
    labels = session.stage(tables.read_table(spark, path))[0]
    late = F.col("snapshot_date") == F.lit("1998-11-01").cast("date")
    tables.overwrite_partitions(labels.where(late).withColumn("label", 1 - F.col("label")), path)
    before = {r.snapshot_date: r for r in monitored().collect()}
    state = tables.table_path(mart.root, "gold", "monitor_state")
    other = lambda: sorted(r[0] for r in tables.read_table(spark, state).where(~late).select(F.input_file_name()).distinct().collect())
    untouched = other()
    operate.monitor(spark, mart.root, champion, months=["1998-11-01"])
    assert other() == untouched
    after = {r.snapshot_date: r for r in monitored().collect()}
    changed = {str(m) for m in after if after[m] != before[m]}
    assert changed == {"1998-11-01"}
    part = rows_of(monitored())
    operate.monitor(spark, mart.root, champion)
    assert rows_of(monitored()) == part


def test_landed_tables_are_compressed_and_no_shuffle_file_is_left(spark, mart):
    def files(folder):
        return [os.path.join(at, f) for at, _, names in os.walk(folder.removeprefix("file:")) for f in names
                if f.startswith("part-")]

    landed = files(mart.raw) + files(f"{mart.root}/bronze")
    assert landed and all(f.endswith(".csv.gz") for f in landed)
    text = sum(len(",".join(v or "" for v in r)) for r in ingest.read_bronze(spark, mart.root, "lms").collect())
    assert sum(map(os.path.getsize, files(f"{mart.root}/bronze/lms"))) < text / 2
    # A month that one bronze file holds is one silver file, written as it was read.
    for name in registry.SOURCES:
        assert len(files(f"{mart.root}/silver/{name}")) <= len(files(f"{mart.root}/bronze/{name}"))

    kept = spark.conf.get(session.CLEANUP, "false")
    with session.freed_shuffles(spark):
        with session.freed_shuffles(spark):
            pass
        assert spark.conf.get(session.CLEANUP) == "true"
    assert spark.conf.get(session.CLEANUP, "false") == kept


def test_a_process_leaves_no_folder_behind_also_when_its_session_was_stopped(tmp_path):
    """Landed files, bronze, silver and gold of a query go with its process: the next one has the disk."""
    import subprocess
    import sys
    run = """
import os, sys
from creditloom import session
from workload.table_queries import Warehouse
spark = session.get_spark("leave", "local[2]", **{"spark.checkpoint.dir": sys.argv[1], "spark.sql.shuffle.partitions": "2"})
w = Warehouse(spark, sys.argv[2])
session.stage(spark.range(3))
assert os.listdir(w.root.removeprefix("file:")) and len(os.listdir(sys.argv[1])) >= 3
spark.stop()
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", run, str(tmp_path), SF], check=True, timeout=300,
                   env=os.environ | {"PYTHONPATH": repo}, cwd=repo)
    left = [os.path.join(at, f) for at, _, names in os.walk(tmp_path) for f in names]
    assert not left  # the empty folder of Spark's own checkpoints stays


def test_wide_tables_are_written_by_code_that_can_be_compiled(spark, tmp_path, monkeypatch):
    """While a table is staged or written the limit of a method is the JVM's; afterwards it is what it was."""
    seen = []
    held = spark.conf.get(session.METHOD_LIMIT, None)
    with session.writing(spark):
        seen.append(spark.conf.get(session.METHOD_LIMIT))
        with session.writing(spark):
            pass
        seen.append(spark.conf.get(session.METHOD_LIMIT))
    assert seen == ["8000", "8000"]
    assert spark.conf.get(session.METHOD_LIMIT, None) == (held or "65535")
    entered = []
    whole = session.writing
    monkeypatch.setattr(session, "writing", lambda s: entered.append(s) or whole(s))
    session.stage(spark.range(2))
    tables.overwrite_partitions(spark.range(2).withColumn("snapshot_date", F.lit("2024-01-01").cast("date")), str(tmp_path / "t"))
    assert len(entered) == 2


def test_a_large_raw_table_is_not_shuffled_to_bronze_and_goes_when_it_is_there(spark, mart, monkeypatch):
    """Rows over `DEALT_BYTES` are written where they are read, so that no shuffle of a whole raw table lies
    beside it; a delivered file goes before the next one comes."""
    from workload.table_queries import Warehouse
    monkeypatch.setattr(ingest, "DEALT_BYTES", 0)
    dealt, open_files = [], spark.conf.get(session.OPEN_FILES, "0")
    whole = tables.overwrite_partitions

    def written(df, path, *args, **options):
        if "/bronze/" in path:
            dealt.append((options["rebalance"], "RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString()))
        return whole(df, path, *args, **options)
    monkeypatch.setattr(tables, "overwrite_partitions", written)
    large = Warehouse(spark, SF, keep_raw=False)
    assert dealt == [(False, False)] * len(registry.SOURCES) and spark.conf.get(session.OPEN_FILES, "0") == open_files
    assert not os.listdir(large.raw.removeprefix("file:")) and os.listdir(mart.raw.removeprefix("file:"))
    assert rows_of(large.audit) == rows_of(mart.audit)
    for name in registry.SOURCES:
        assert rows_of(ingest.read_bronze(spark, large.root, name)) == rows_of(ingest.read_bronze(spark, mart.root, name))
        assert rows_of(large.table("silver", name)) == rows_of(mart.table("silver", name))
    month = f"{large.root}/bronze/lms/snapshot_date=1996-06-01".removeprefix("file:")
    assert len([f for f in os.listdir(month) if f.startswith("part-")]) > 1
    ingest.bronze(spark, mart.raw, large.root, "lms", ["1996-06-01"])  # few rows: dealt by month again
    assert dealt[-1][0] and len([f for f in os.listdir(month) if f.startswith("part-")]) == 1
    assert rows_of(ingest.read_bronze(spark, large.root, "lms")) == rows_of(ingest.read_bronze(spark, mart.root, "lms"))


def test_text_is_compressed_at_the_fastest_level(spark, mart):
    """Compression was the larger part of writing raw and bronze text."""
    import gzip
    import zlib
    folders = [mart.raw, f"{mart.root}/bronze/lms"]
    found = [os.path.join(at, f) for folder in folders for at, _, names in os.walk(folder.removeprefix("file:"))
             for f in names if f.endswith(".csv.gz")]
    assert found
    for file in sorted(found, key=os.path.getsize)[-8:]:
        with gzip.open(file) as f:
            text = f.read()
        fast, usual = (len(zlib.compress(text, level)) for level in (1, 6))
        assert abs(os.path.getsize(file) - fast) < abs(os.path.getsize(file) - usual), file


def test_long_csv_values_arrive_whole(spark, tmp_path):
    """Also those longer than the parser's buffer."""
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(c, StringType()) for c in ("a", "b")])
    rows = [("x" * 30_000, "q " * 9_000 + "z"), ("1", None), (",y" * 5_000, "2")]
    spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True).csv(str(tmp_path / "long"))
    assert rows_of(registry.read_raw_csv(spark, str(tmp_path / "long"), schema)) == sorted(map(str, spark.createDataFrame(rows, schema).collect()))
