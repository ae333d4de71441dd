"""Sources and sinks (S), and whole jobs (B): written to a scratch folder and read back."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom import schemas, session
from creditloom.functions.fingerprint import fingerprints
from creditloom.operators import encode, metrics, models, sketches
from creditloom.plans import changes, gold, ingest, ledger, operate, train
from creditloom.sources import calendar, tables
from creditloom.sources.registry import SOURCES, read_raw_csv, source
from workload.inputs import Inputs
from workload.model_queries import SMALL_TREES, TRAIN_DATE
from workload.registry import query, steady

KEYS = ["Customer_ID", "snapshot_date"]


def land_raw(x: Inputs, name: str, folder: str) -> None:
    """The raw table as the compressed CSV files the source system would deliver; a compressed file
    is read by one task, so none has more than a million rows."""
    src = source(name)
    with session.writing(x.spark):
        x.raw(name).select(*src.schema.names).write.options(**session.TEXT, header=True).option(
            "maxRecordsPerFile", session.SINGLE_TASK_ROWS).csv(f"{folder}/{src.file_name}")


@query("s1_csv_scan", "select * from t_financials_raw")
def s1(spark, sf):
    folder = session.kept_folder(spark, "raw")
    land_raw(Inputs(spark, sf), "financials", folder)
    src = source("financials")
    return read_raw_csv(spark, f"{folder}/{src.file_name}", src.schema)


@query("s2_source_registry", """
    select 'lms' as source, 'lms_loan_daily.csv' as file_name, 11 as n_columns, count(*) as n
    from t_lms_raw
    union all select 'clickstream', 'feature_clickstream.csv', 22, count(*) from t_clickstream_raw
    union all select 'attributes', 'features_attributes.csv', 6, count(*) from t_attributes_raw
    union all select 'financials', 'features_financials.csv', 22, count(*)
    from t_financials_raw""")
def s2(spark, sf):
    x = Inputs(spark, sf)
    parts = [x.raw(name).agg(
        F.lit(name).alias("source"), F.lit(src.file_name).alias("file_name"),
        F.lit(len(src.schema)).alias("n_columns"), F.count(F.lit(1)).alias("n"))
        for name, src in SOURCES.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("s3_parquet_multi_scan", "select * from t_clickstream")
def s3(spark, sf):
    path = session.kept_folder(spark, "clickstream")
    tables.overwrite_partitions(Inputs(spark, sf).clickstream, path)
    return tables.read_table(spark, path)


@query("s4_parquet_partition_scan", """
    select * from t_clickstream
    where snapshot_date = date '1998-06-01'""")
def s4(spark, sf):
    path = session.kept_folder(spark, "clickstream")
    tables.overwrite_partitions(Inputs(spark, sf).clickstream, path)
    return tables.read_month(spark, path, "1998-06-01")


@query("s5_label_concat", "select Customer_ID, snapshot_date, label from t_labels")
def s5(spark, sf):
    path = session.kept_folder(spark, "labels")
    schema = "Customer_ID string, snapshot_date date, label int"
    nothing = tables.read_or_empty(spark, path, schema)
    tables.overwrite_partitions(Inputs(spark, sf).labels, path)
    return nothing.unionAll(tables.read_or_empty(spark, path, schema))


@query("s6_bronze_sink", "select * from t_clickstream_raw")
def s6(spark, sf):
    raw, root = session.kept_folder(spark, "raw"), session.kept_folder(spark, "mart")
    land_raw(Inputs(spark, sf), "clickstream", raw)
    ingest.bronze(spark, raw, root, "clickstream")
    return ingest.read_bronze(spark, root, "clickstream")


@query("s7_partition_overwrite_sink", """
    select loan_id, Customer_ID, label_def, snapshot_date,
           case when snapshot_date = date '1998-06-01' then 1 - label else label end as label
    from t_labels""")
def s7(spark, sf):
    """Writes all months, then one month again with changed rows, twice."""
    labels, path = Inputs(spark, sf).labels, session.kept_folder(spark, "labels")
    tables.overwrite_partitions(labels, path)
    changed = labels.where(F.col("snapshot_date") == F.lit("1998-06-01").cast("date")).withColumn(
        "label", 1 - F.col("label"))
    tables.overwrite_partitions(changed, path)
    tables.overwrite_partitions(changed, path)
    return tables.read_table(spark, path)


@query("s8_grouped_partition_sink", "select * from t_predictions")
def s8(spark, sf):
    root = session.kept_folder(spark, "mart")
    train.write_predictions(Inputs(spark, sf).predictions, root)
    return tables.read_table(spark, tables.table_path(root, "gold", "model_predictions"))


@query("s9_predictions_sink", """
    select * from t_predictions where model_name = 'credit_gbt_1996_01_01'
       and snapshot_date = date '1998-06-01'""")
def s9(spark, sf):
    root = session.kept_folder(spark, "mart")
    train.write_predictions(Inputs(spark, sf).predictions, root)
    month = tables.read_month(
        spark, tables.table_path(root, "gold", "model_predictions"), "1998-06-01")
    return month.where(F.col("model_name") == "credit_gbt_1996_01_01")


@query("s10_monitoring_sink", """
    select model_name, snapshot_date, n_scored, mean_score from t_summary""")
def s10(spark, sf):
    path = session.kept_folder(spark, "monitoring")
    summary = metrics.score_summary(Inputs(spark, sf).predictions).select(
        "model_name", "snapshot_date", "n_scored", steady("mean_score"))
    for _ in range(2):
        tables.overwrite_partitions(summary, path, ("model_name",))
    return tables.read_table(spark, path)


@query("s11_ranking_sink_source", """
    select feature, importance, 'credit_history_1996_01_01' as model_name,
           cast(row_number() over (order by importance desc, position) as integer) as rank
    from t_importance""")
def s11(spark, sf):
    path = session.kept_folder(spark, "importance")
    ranked = Inputs(spark, sf).importance.withColumn(
        "model_name", F.lit("credit_history_1996_01_01"))
    tables.overwrite_partitions(ranked, path, ("model_name",))
    return models.ranks(tables.read_table(spark, path)).select(
        "feature", "importance", "model_name", "rank")


@query("s14_stage_row_audit", """
    select 'bronze' as layer, 'attributes' as table_name, count(*) as n from t_attributes_raw
    union all select 'silver', 'attributes', count(*) from t_attributes
    union all select 'gold', 'label_store', count(*) from t_labels""")
def s14(spark, sf):
    x = Inputs(spark, sf)
    raw, root = session.kept_folder(spark, "raw"), session.kept_folder(spark, "mart")
    land_raw(x, "attributes", raw)
    written = [
        ("bronze", "attributes", ingest.bronze(spark, raw, root, "attributes")),
        ("silver", "attributes", ingest.silver(spark, root, "attributes")),
        ("gold", "label_store", tables.overwrite_partitions(
            x.labels, tables.table_path(root, "gold", "label_store"))),
    ]
    return spark.createDataFrame([(layer, name, o.get["rows"]) for layer, name, o in written],
                                 "layer string, table_name string, n long")


# --- whole jobs ----------------------------------------------------------------------------------

@query("b3_label_rates", """
    select snapshot_date, count(*) as n_loans, cast(sum(case when dpd >= 30 then 1 else 0 end)
             as bigint) as n_default,
           round(avg(case when dpd >= 30 then 1e0 else 0e0 end), 6) as default_rate,
           max(dpd) as max_dpd
    from t_lms where mob = 6 group by 1""")
def b3_rates(spark, sf):
    """Default rate and worst days past due per label month, for loans at month on book 6."""
    at_six = Inputs(spark, sf).lms.where(F.col("mob") == 6)
    bad = F.when(F.col("dpd") >= 30, 1).otherwise(0)
    return at_six.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum(bad).alias("n_default"),
        F.round(F.avg(bad), 6).alias("default_rate"), F.max("dpd").alias("max_dpd"))


class Warehouse:
    """One run of the jobs from raw files to monitoring, each done when first asked for. Without `keep_raw`
    a delivered file goes when its rows are in bronze and silver, before the next one is delivered."""

    def __init__(self, spark, sf: str, keep_raw: bool = True):
        self.spark, self.inputs = spark, Inputs(spark, sf)
        self.raw = session.kept_folder(spark, "raw")
        self.root = session.kept_folder(spark, "mart")
        audits = []
        for name in SOURCES:
            land_raw(self.inputs, name, self.raw)
            audits.append(ingest.ingest(spark, self.raw, self.root, names=[name]))
            if not keep_raw:
                session.delete_path(spark, f"{self.raw}/{source(name).file_name}")
        self.audit = reduce(DataFrame.unionAll, audits)
        self.done = set()

    def table(self, layer: str, name: str):
        return tables.read_table(self.spark, tables.table_path(self.root, layer, name))

    def need(self, *steps: str) -> Warehouse:
        for step in steps:
            if step not in self.done:
                getattr(self, f"_{step}")()
                self.done.add(step)
        return self

    def _labels(self):
        gold.label_store(self.spark, self.root)

    def _features(self):
        gold.feature_store(self.spark, self.root)

    def _models(self):
        self.need("labels", "features")
        train.train(self.spark, self.root, TRAIN_DATE, draws=1, space=SMALL_TREES)
        train.select_champion(self.spark, self.root, TRAIN_DATE)

    def _scores(self):
        self.need("models")
        months = ["1998-09-01", "1998-10-01", "1998-11-01", "1998-12-01"]
        for kind in train.MODEL_KINDS:
            operate.score_months(self.spark, self.root, models.version(kind, TRAIN_DATE), months)

    def _all_scores(self):
        self.need("models")
        for kind in train.MODEL_KINDS:
            operate.score_months(self.spark, self.root, models.version(kind, TRAIN_DATE))

    def _monitoring(self):
        self.need("scores")
        operate.monitor(self.spark, self.root, train.current_champion(self.spark, self.root))

    def _all_monitoring(self):
        self.need("all_scores")
        operate.monitor(self.spark, self.root, train.current_champion(self.spark, self.root))


@cache
def _warehouse(application_id: str, spark, sf: str) -> Warehouse:
    return Warehouse(spark, sf, keep_raw=False)


def warehouse(spark, sf: str, *steps: str) -> Warehouse:
    return _warehouse(spark.sparkContext.applicationId, spark, sf).need(*steps)


_RAW = " union all ".join(
    f"select '{n}' as table_name, snapshot_date, count(*) as n from t_{n}_raw group by 2"
    for n in SOURCES)


@query("b1_bronze_ingest", _RAW)
def b1(spark, sf):
    w = warehouse(spark, sf)
    out = None
    for name in SOURCES:
        part = ingest.read_bronze(spark, w.root, name).groupBy("snapshot_date").agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "snapshot_date",
                                                 "n")
        out = part if out is None else out.unionAll(part)
    return out


@query("b2_silver_clean", """
    select table_name, snapshot_date, n, checksum from (
      select 'lms' as table_name, snapshot_date, count(*) as n,
             cast(sum(dpd) as bigint) as checksum from t_lms group by 2
      union all select 'clickstream', snapshot_date, count(*), cast(sum(fe_1 + fe_20) as bigint)
      from t_clickstream group by 2
      union all select 'attributes', snapshot_date, count(*), cast(sum(Age) as bigint)
      from t_attributes group by 2
      union all select 'financials', snapshot_date, count(*),
             cast(sum(Credit_History_Age) as bigint) from t_financials group by 2
      union all select 'loan_type', snapshot_date, count(*),
             cast(sum(loan_auto_loan + loan_payday_loan) as bigint) from t_loan_type group by 2
    ) x""")
def b2(spark, sf):
    w = warehouse(spark, sf)
    sums = {"lms": F.col("dpd"), "clickstream": F.col("fe_1") + F.col("fe_20"),
            "attributes": F.col("Age"), "financials": F.col("Credit_History_Age"),
            "loan_type": F.col("loan_auto_loan") + F.col("loan_payday_loan")}
    out = None
    for name, value in sums.items():
        part = w.table("silver", name).groupBy("snapshot_date").agg(
            F.count(F.lit(1)).alias("n"), F.sum(value).alias("checksum")).select(
            F.lit(name).alias("table_name"), "snapshot_date", "n", "checksum")
        out = part if out is None else out.unionAll(part)
    return out


@query("b3_label_store", "select * from t_labels")
def b3(spark, sf):
    return warehouse(spark, sf, "labels").table("gold", "label_store")


@query("b4_feature_store", """
    select snapshot_date, count(*) as n, count(Outstanding_Debt) as n_known,
           cast(sum(loan_auto_loan) as bigint) as n_auto
    from t_features group by 1""")
def b4(spark, sf):
    """The stored feature store per month; its medians are sketched, so columns that are often
    missing are not compared here (see m3_build_feature_store)."""
    return warehouse(spark, sf, "features").table("gold", "feature_store").groupBy(
        "snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("Outstanding_Debt").alias("n_known"),
        F.sum("loan_auto_loan").alias("n_auto"))


@query("b5_train")
def b5(spark, sf):
    warehouse_ = warehouse(spark, sf, "models")
    return models.registry(spark, warehouse_.root).select(
        "model_version", "model_type", F.size("feature_columns").alias("n_features"),
        F.explode("results").alias("metric", "value"))


@query("b5_split_rows", """
    select model_name, split, count(*) as n, true as auc_kept from t_split, (
      select unnest(['credit_gbt_1998_09_01', 'credit_logreg_1998_09_01']) as model_name) m
    where split is not null group by 1, 2""")
def b5_rows(spark, sf):
    """The rows of each split that the registry keeps for a model, and metrics of all three."""
    kept = models.registry(spark, warehouse(spark, sf, "models").root)
    rows = kept.select(F.col("model_version").alias("model_name"), "results", F.explode("dates").alias("key", "n")).where(
        F.col("key").startswith("rows_"))
    split = F.substring_index("key", "_", -1)
    return rows.select("model_name", split.alias("split"), F.col("n").cast("long").alias("n"), F.col("results")[
        F.concat(F.lit("auc_"), split)].between(0, 1).alias("auc_kept"))


@query("b5_reliability", """
    select m.model_name, m.kind, count(*) as n, cast(sum(label) as bigint) as n_pos, true as rising from t_split, (
      select unnest(['credit_gbt_1998_09_01', 'credit_gbt_1998_09_01', 'credit_logreg_1998_09_01']) as model_name,
             unnest(['raw', 'calibrated', 'raw']) as kind) m
    where split = 'oot' group by 1, 2""")
def b5_reliability(spark, sf):
    """The calibration table of training holds every out-of-time row once per kind of score, and mean
    scores rise with the bin."""
    table = warehouse(spark, sf, "models").table("gold", "model_reliability")
    bins = F.array_sort(F.collect_list(F.struct("bin", "mean_predicted")))  # at most ten
    return table.groupBy("model_name", "kind").agg(
        F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("observed_rate"))).cast("long").alias("n_pos"),
        (F.array_sort(bins["mean_predicted"]) == bins["mean_predicted"]).alias("rising"))


@query("b6_score")
def b6(spark, sf):
    return warehouse(spark, sf, "all_scores").table("gold", "model_predictions")


@query("b7_monitor")
def b7(spark, sf):
    return warehouse(spark, sf, "all_monitoring").table("gold", "model_monitoring")


@query("b7_alert")
def b7_alert(spark, sf):
    w = warehouse(spark, sf, "all_monitoring")
    return operate.alert(spark, w.root)


@query("b8_backfill", """
    select c.snapshot_date, coalesce(l.n, 0) as n_loan_rows, coalesce(b.n, 0) as n_labels,
           coalesce(f.n, 0) as n_features, c.snapshot_date = date '1998-09-01' as should_train
    from t_calendar c
    left join (select snapshot_date, count(*) as n from t_lms group by 1) l
      on l.snapshot_date = c.snapshot_date
    left join (select snapshot_date, count(*) as n from t_labels group by 1) b
      on b.snapshot_date = c.snapshot_date
    left join (select snapshot_date, count(*) as n from t_applications group by 1) f
      on f.snapshot_date = c.snapshot_date""")
def b8(spark, sf):
    """What the backfill holds for every month of the order calendar."""
    from workload.drift_queries import order_months
    w = warehouse(spark, sf, "labels", "features")
    months = calendar.training_gate(order_months(spark, sf), TRAIN_DATE)
    for layer, name, n in (("silver", "lms", "n_loan_rows"), ("gold", "label_store", "n_labels"),
                           ("gold", "feature_store", "n_features")):
        counts = w.table(layer, name).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias(n))
        months = months.join(counts, "snapshot_date", "left").fillna(0, subset=[n])
    return months




@query("b6_score_counts", """
    select 'credit_' || k || '_1998_09_01' as model_name,
           cast(a.snapshot_date + to_months(6) as date) as snapshot_date, count(*) as n,
           count(*) as n_in_range, count(*) as n_verdicts
    from t_applications a, (select unnest(['gbt', 'logreg']) as k) m group by 1, 2""")
def b6_counts(spark, sf):
    """Every application is scored by both models for its label month, with a probability and the
    verdict that follows from it."""
    score, label = F.col("model_predictions"), F.col("prediction_label")
    return warehouse(spark, sf, "all_scores").table("gold", "model_predictions").groupBy(
        "model_name", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(score.between(0, 1)).alias("n_in_range"),
        F.count_if((score >= 0.5) == (label == 1)).alias("n_verdicts"))


_CHANGED = {"attributes": "1995-06-01", "lms": "1998-03-01"}


@query("b8_change_plan", f"""
    select 'bronze/attributes' as "table", date '{_CHANGED["attributes"]}' as snapshot_date
    union all select 'silver/attributes', date '{_CHANGED["attributes"]}'
    union all select 'bronze/lms', date '{_CHANGED["lms"]}'
    union all select 'silver/lms', date '{_CHANGED["lms"]}'
    union all select distinct 'gold/label_store', snapshot_date from t_labels
              where snapshot_date = date '{_CHANGED["lms"]}'
    union all select distinct 'gold/feature_store', snapshot_date from t_applications
              where snapshot_date >= date '{_CHANGED["attributes"]}'
    union all select distinct 'gold/model_predictions', cast(snapshot_date + to_months(6) as date)
              from t_applications where snapshot_date >= date '{_CHANGED["attributes"]}'
    union all
    select distinct 'gold/model_monitoring', cast(snapshot_date + to_months(6) as date) from t_applications
    where snapshot_date >= date '{_CHANGED["attributes"]}'
       or cast(snapshot_date + to_months(6) as date) in (
          date '{_CHANGED["lms"]}', cast(date '{_CHANGED["lms"]}' - to_months(6) as date))""")
def b8_plan(spark, sf):
    """One month of two raw tables is altered: found by fingerprints of all raw rows, and followed to all
    months that read them."""
    x = Inputs(spark, sf)
    altered = {"attributes": ("Age", "55"), "lms": ("balance", "0")}

    def prints(change: bool):
        out = None
        for name in SOURCES:
            rows = x.raw(name).select(*source(name).schema.names)
            if change and name in altered:
                column, value = altered[name]
                rows = rows.withColumn(column, F.when(
                    F.col("snapshot_date").cast("date") == F.lit(_CHANGED[name]).cast("date"), value).otherwise(F.col(column)))
            part = fingerprints(rows, "snapshot_date").select(
                F.lit(name).alias("source"), F.col("snapshot_date").cast("date").alias("snapshot_date"), "fingerprint")
            out = part if out is None else out.unionByName(part)
        return session.stage(out, "fingerprints")[0]
    before = prints(False)
    found = changes.changed(prints(True), before)
    return changes.plan(found, changes.month_calendars(before.select("source", "snapshot_date"), x.lms))


@query("b7_monitor_counts", """
    select cast(snapshot_date + to_months(6) as date) as snapshot_date, count(*) as n_scored, true as sound
    from t_applications group by 1""")
def b7_counts(spark, sf):
    """Every scored month of the champion has its row: volume as scored, mean recomputed from the stored
    predictions, no drift in the first month, and metrics within their ranges."""
    w = warehouse(spark, sf, "all_monitoring")
    predicted = w.table("gold", "model_predictions").groupBy("model_name", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.avg("model_predictions").alias("mean"))
    rows = w.table("gold", "model_monitoring").join(predicted, ["model_name", "snapshot_date"])
    first = rows.agg(F.min("snapshot_date").alias("first"))
    inside = [F.coalesce(F.col(c).between(0, 1), F.lit(True)) for c in ("auc", "brier", "precision", "recall", "f1")]
    sound = (F.col("n") == F.col("n_scored")) & (F.abs(F.col("mean") - F.col("mean_score")) < 1e-4)
    for check in inside:
        sound = sound & check
    start = F.col("snapshot_date") == F.lit(first.first()["first"])
    return rows.select("snapshot_date", "n_scored", (sound & (~start | (F.col("psi") == 0)) & (F.col("psi") >= 0)).alias("sound"))


@query("s14_run_ledger", """
    select snapshot_date, 'collapsed:applications' as metric, count(*) - count(distinct Customer_ID) as n
    from t_lms where mob = 0 group by 1
    union all select snapshot_date, 'collapsed:attributes', count(*) - count(distinct Customer_ID) from t_attributes group by 1
    union all select snapshot_date, 'unlabelled', cast(0 as bigint) from t_labels group by 1
    union all select snapshot_date, 'unseen:Occupation',
              cast(sum(case when coalesce(Occupation, 'unknown') not in ('BUILDING', 'unknown') then 1 else 0 end) as bigint)
    from t_attributes group by 1""")
def s14_ledger(spark, sf):
    """Counts that a run keeps by month, written and read back."""
    x, root = Inputs(spark, sf), session.kept_folder(spark, "mart")
    vocabulary = encode.vocabulary_table(spark, {"Occupation": ["BUILDING", "unknown"]})
    ledger.keep(ledger.audit(x.lms, {"attributes": x.attributes}, x.labels, vocabulary, {"attributes": ["Occupation"]}),
                root, "feature_store", "run")
    return ledger.read(spark, root).select("snapshot_date", "metric", "n")


@query("p17_stored_sketches", " union all ".join(
    f"select '{c}' as \"column\", snapshot_date, count({c}) as n, 0 as n_outside from t_clickstream group by 2"
    for c in schemas.FE_COLUMNS))
def p17_sketches(spark, sf):
    """Median and tail of every month from its stored sketch: their exact ranks are within the bound."""
    clicks = Inputs(spark, sf).clickstream
    path = session.kept_folder(spark, "sketches")
    tables.overwrite_partitions(sketches.month_sketches(clicks, schemas.FE_COLUMNS), path)
    points = [0.5, 0.97]
    found = sketches.quantiles(tables.read_table(spark, path), points, ["snapshot_date", "column"])
    counts = clicks.select("snapshot_date", *[F.col(c).cast("double").alias(c) for c in schemas.FE_COLUMNS]).unpivot(
        ["snapshot_date"], schemas.FE_COLUMNS, "column", "value").where("value is not null")
    outside = F.lit(0)
    for k, p in enumerate(points):
        q, slack = F.col("quantiles")[k], F.col("n") * sketches.rank_error() + 1
        below, upto = F.count_if(F.col("value") < q), F.count_if(F.col("value") <= q)
        n = F.first("n")
        outside = outside + ((below > n * p + F.first(slack)) | (upto < n * p - F.first(slack))).cast("int")
    checked = counts.join(found, ["snapshot_date", "column"]).groupBy("snapshot_date", "column").agg(outside.alias("n_outside"))
    return found.join(checked, ["snapshot_date", "column"], "left").select(
        "column", "snapshot_date", "n", F.coalesce("n_outside", F.lit(0)).alias("n_outside"))
