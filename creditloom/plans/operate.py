"""Monthly scoring, monitoring and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom import session
from creditloom.functions.fingerprint import row_hash, wide_sum
from creditloom.operators import drift, models, monitor_state
from creditloom.operators.metrics import round_metrics
from creditloom.operators.scoring import (
    OFFSET_MONTHS, align_to_model, missing_columns, prediction_rows)
from creditloom.plans import ledger
from creditloom.plans.gold import only_months
from creditloom.plans.train import write_predictions
from creditloom.sources import tables


@session.job
def score_months(spark: SparkSession, root: str, model_version: str,
                 label_months: Sequence[str] | None = None,
                 offset: int = OFFSET_MONTHS) -> DataFrame | None:
    """Scores the features of `offset` months before each label month and writes them under the
    label month. Without months, every feature month is scored. Returns the written rows per
    month, or None when the model or the features do not exist."""
    features = tables.read_table(spark, tables.table_path(root, "gold", "feature_store"))
    known = tables.read_table(spark, tables.table_path(root, "gold", "model_registry"))
    if features is None or known is None or not known.where(
            F.col("model_version") == model_version).take(1):
        return None
    artefact = models.load(spark, root, model_version)
    if label_months is not None:
        wanted = [F.add_months(F.lit(m).cast("date"), -offset) for m in label_months]
        features = features.where(F.col("snapshot_date").isin(*wanted))
    absent = missing_columns(features, artefact.feature_columns)
    scored = artefact.scores(align_to_model(features, artefact.feature_columns))
    rows = prediction_rows(scored, model_version, F.col("score"), offset)
    written = write_predictions(rows, root)
    ledger.note(spark, root, "score", model_version, {"rows": written.get["rows"], **{f"absent:{c}": 1 for c in absent}})
    return spark.createDataFrame([(model_version, written.get["rows"])],
                                 "model_name string, n_scored long")


CSI = "model_name string, snapshot_date date, feature string, position int, psi double"


def monitoring_table(predictions: DataFrame, labels: DataFrame, features: DataFrame | None,
                     csi_features: Sequence[str], baselines: DataFrame,
                     feature_offset_months: int = OFFSET_MONTHS, digits: int = 4) -> DataFrame:
    """One row per model and month: volume, score drift, ranking and calibration quality, feature
    drift, and the drop against the out-of-time AUC. Predictions are read once, into a state.

    `baselines` has (model_name, oot_auc). Feature drift of a month is measured on the features
    that were scored, `feature_offset_months` before it, against the model's first month; it is
    null where there are no features.
    """
    state, _ = session.stage(monitor_state.score_state(predictions, labels), "monitor_state")
    return state_table(state, features, csi_features, baselines, feature_offset_months, digits)


def state_table(state: DataFrame, features: DataFrame | None, csi_features: Sequence[str],
                baselines: DataFrame, feature_offset_months: int = OFFSET_MONTHS, digits: int = 4,
                months: Sequence[str] | None = None, scored: DataFrame | None = None) -> DataFrame:
    """The monitoring rows of a state, of all months or of those given. `scored` (model_name,
    snapshot_date) names all scored months where that is known without reading the state."""
    c = F.col
    keys = monitor_state.KEYS
    if scored is None:
        scored = state.select(*keys).distinct()
    scored, _ = session.stage(scored, "scored")
    first = drift.first_months(scored)
    wanted = scored
    if months is not None:
        wanted = only_months(scored, months)
        baselines_of = [str(r[0]) for r in first.select("baseline_date").distinct().collect()]
        state = only_months(state, sorted({*map(str, months), *baselines_of}))
    totals, _ = session.stage(monitor_state.month_totals(state), "months")
    psi = monitor_state.psi(state, first).select(*keys, "psi")
    quality = monitor_state.quality(only_months(state, months), totals).select(
        *keys, "auc", "gini", "precision", "recall", "f1", "brier")
    rows = totals.join(wanted, keys, "left_semi").drop("direct")
    if features is None or not csi_features:
        csi = state.sparkSession.createDataFrame([], CSI)
        per_feature = rows.select(*keys, *[F.lit(None).cast("double").alias(f)
                                           for f in csi_features])
    else:
        csi, _ = session.stage(model_csi(
            scored, features, csi_features, feature_offset_months, wanted), "csi")
        per_feature = csi.groupBy(*keys).pivot("feature", list(csi_features)).agg(F.first("psi"))
    per_feature = per_feature.select(
        *keys, *[F.round(c(f"`{f}`"), digits).alias(f"csi_{f}") for f in csi_features])
    worst = drift.worst_feature(csi, keys)
    table = (rows.join(psi, keys, "left").join(quality, keys, "left")
             .join(worst, keys, "left").join(baselines, "model_name", "left"))
    table = table.withColumn("auc_drop_from_oot1", c("oot_auc") - c("auc")).drop("oot_auc")
    rounded = round_metrics(
        table, ["mean_score", "psi", "f1", "precision", "recall", "brier", "auc", "gini",
                "auc_drop_from_oot1", "csi_max"], digits)
    return rounded.join(per_feature, keys, "left").select(
        *keys, "n_scored", "mean_score", "psi", "f1", "precision", "recall", "brier", "auc",
        "gini", "auc_drop_from_oot1", "csi_max", "csi_max_feature",
        *[f"csi_{f}" for f in csi_features])


def model_csi(months: DataFrame, features: DataFrame, csi_features: Sequence[str],
              feature_offset_months: int = OFFSET_MONTHS,
              wanted: DataFrame | None = None) -> DataFrame:
    """model_name, snapshot_date, feature, position, psi for every scored month, or for the `wanted`
    ones among them.

    Bin counts are taken once per (baseline month, feature month): models that share a first month
    share the work.
    """
    c = F.col
    scored = months.select(
        "model_name", "snapshot_date",
        F.add_months("snapshot_date", -feature_offset_months).alias("feature_date"))
    # A model's reference is its first scored month that has features.
    available = features.select(c("snapshot_date").alias("feature_date")).distinct()
    with_features, _ = session.stage(scored.join(available, "feature_date"), "scored_months")
    reference = with_features.groupBy("model_name").agg(
        F.min("feature_date").alias("baseline_date"))
    baseline = drift.feature_long(
        drift.only_dates(features, reference.select("baseline_date")), csi_features).select(
        c("snapshot_date").alias("baseline_date"), "feature", "value")
    if wanted is not None:
        with_features = with_features.join(wanted, ["model_name", "snapshot_date"], "left_semi")
        features = drift.only_dates(features, with_features.select("feature_date"))
    long = drift.feature_long(features, csi_features)
    pairs = (with_features.join(reference, "model_name")
             .select("baseline_date", "feature_date").distinct())
    values = long.withColumnRenamed("snapshot_date", "feature_date").join(pairs, "feature_date")
    found = drift.stability(values, baseline, ["baseline_date", "feature"], ["feature_date"],
                            "value")
    position = F.array_position(F.array(*map(F.lit, csi_features)), c("feature"))
    return (with_features.join(reference, "model_name")
            .join(found, ["baseline_date", "feature_date"])
            .select("model_name", "snapshot_date", "feature", position.alias("position"), "psi"))


@session.job
def monitor(spark: SparkSession, root: str, model_version: str,
            feature_offset_months: int = OFFSET_MONTHS,
            months: Sequence[str] | None = None) -> DataFrame | None:
    """Monitoring rows of one model; None when there are no predictions.

    The state of each month (see `monitor_state`) is stored. Without `months` it is made anew from all
    predictions. With `months` (say, those that got late outcomes) predictions of these months, and of
    months that have no state yet, are read; the other months' states and rows stay as they are.
    """
    source = tables.table_path(root, "gold", "model_predictions")
    predictions = tables.read_table(spark, source)
    if predictions is None:
        return None
    model = F.col("model_name") == model_version
    predictions = predictions.where(model)
    labels = tables.read_or_empty(
        spark, tables.table_path(root, "gold", "label_store"),
        "Customer_ID string, snapshot_date date, label int")
    state_path = tables.table_path(root, "gold", "monitor_state")
    stored = tables.read_table(spark, state_path)
    there = {str(r[0]) for r in predictions.select("snapshot_date").distinct().collect()}
    if months is not None:
        known = set() if stored is None else {str(r[0]) for r in stored.where(model).select("snapshot_date").distinct().collect()}
        months = sorted((set(map(str, months)) | (there - known)) & there)
        gone = known - there
    else:
        gone = set() if stored is None else {str(r[0]) for r in stored.where(model).select("snapshot_date").distinct().collect()} - there
    for month in gone:
        session.delete_path(spark, f"{state_path}/model_name={model_version}/snapshot_date={month}")
    if months is not None:
        # Outcomes are those of the month or of `OFFSET_MONTHS` later.
        dates = [F.add_months(F.lit(m).cast("date"), k) for m in months for k in (0, OFFSET_MONTHS)]
        predictions, labels = only_months(predictions, months), labels.where(F.col("snapshot_date").isin(*dates) if dates else F.lit(False))
    if months is None or months:
        tables.overwrite_partitions(monitor_state.score_state(predictions, labels), state_path, tuple(monitor_state.KEYS))

    features = tables.read_table(spark, tables.table_path(root, "gold", "feature_store"))
    registered = models.registry(spark, root).where(F.col("model_version") == model_version)
    baselines = registered.select(F.col("model_version").alias("model_name"),
                                  F.col("results")["auc_oot"].alias("oot_auc"))
    watched = [r["feature"] for r in watched_features(spark, root, model_version).collect()]
    scored = spark.createDataFrame([(model_version, m) for m in sorted(there)], "model_name string, month string").select(
        "model_name", F.col("month").cast("date").alias("snapshot_date"))
    table = state_table(tables.read_table(spark, state_path).where(model), features, watched, baselines,
                        feature_offset_months, months=months, scored=scored)
    path = tables.table_path(root, "gold", "model_monitoring")
    before = tables.read_table(spark, path)
    if months is not None and before is not None:
        kept = before.where(model).where(~F.col("snapshot_date").isin([F.lit(m).cast("date") for m in [*months, *gone]]))
        # One row per month: staged, because the table they come from is rewritten.
        table = session.stage(kept.unionByName(table, allowMissingColumns=True), "rows")[0]
    tables.overwrite_partitions(table, path, ("model_name",))
    return tables.read_table(spark, path).where(model)


def watched_features(spark: SparkSession, root: str, model_version: str,
                     top_n: int = drift.TOP_FEATURES) -> DataFrame:
    """The features whose drift is monitored, the most important first."""
    listed = (models.registry(spark, root).where(F.col("model_version") == model_version)
              .select(F.posexplode("feature_columns").alias("position", "feature")))
    ranking = tables.read_table(spark, tables.table_path(root, "gold", "feature_importance"))
    if ranking is not None:
        ranking = ranking.where(F.col("model_name") == model_version)
        if not ranking.take(1):
            ranking = None
    ranked = None if ranking is None else ranking.select(
        "feature", (-F.col("importance")).alias("rank"))
    return drift.csi_scope(listed, ranked, top_n)


def alert(spark: SparkSession, root: str, brier_baseline: str = "stored") -> DataFrame | None:
    """Breach verdict for the newest month of the champion."""
    path = tables.table_path(root, "gold", "model_monitoring")
    table = tables.read_table(spark, path)
    stored = tables.read_table(spark, tables.table_path(root, "gold", "champion"))
    if table is None or stored is None:
        return None
    rows = table.join(stored.select(F.col("champion").alias("model_name")), "model_name",
                      "left_semi")
    if brier_baseline == "first_row":
        baseline = drift.first_row_brier(rows)
    else:
        baseline = models.registry(spark, root).select(
            F.col("model_version").alias("model_name"),
            F.col("results")["brier_oot_calibrated"].alias("baseline_brier"))
    return drift.breach(rows, baseline)


def drift_report(predictions: DataFrame, features: DataFrame, csi_features: Sequence[str],
                 current: str, csi_baseline: str) -> DataFrame:
    """The tables of a drift report for one month: score drift of every model against its first
    scored month, and every watched feature against the baseline month, with bands."""
    at = lambda df: df.where(F.col("snapshot_date") == F.lit(current).cast("date"))
    start = drift.first_month_rows(predictions)
    scores = drift.stability(at(predictions), start, ["model_name"], ["snapshot_date"],
                             "model_predictions")
    baseline = features.where(F.col("snapshot_date") == F.lit(csi_baseline).cast("date"))
    csi = drift.stability(
        drift.feature_long(at(features), csi_features), drift.feature_long(baseline, csi_features),
        ["feature"], ["snapshot_date"], "value")
    rows = lambda df, section, name: df.select(
        F.lit(section).alias("section"), F.col(name).alias("name"), "snapshot_date",
        F.round("psi", 6).alias("psi"), drift.drift_band(F.col("psi")).alias("band"))
    return rows(scores, "score", "model_name").unionAll(rows(csi, "feature", "feature"))


def data_summary(features: DataFrame, columns: Sequence[str], baseline: str,
                 current: str, key: Sequence[str] = ("Customer_ID", "snapshot_date")) -> DataFrame:
    """Profile of every feature on both sides: volume, nulls, distinct values, range, moments,
    quartiles (sketched), and `duplicate_of`, the first feature that has the same value in every row.

    Features are compared by the sum of hashes of (row, value), so no pair of columns meets.
    """
    side = (F.when(F.col("snapshot_date") == F.lit(baseline).cast("date"), "baseline")
            .when(F.col("snapshot_date") == F.lit(current).cast("date"), "current"))
    long = (features.withColumn("side", side).where(F.col("side").isNotNull())
            .select("side", row_hash([k for k in key if k in features.columns]).alias("_row"),
                    *[F.col(c).cast("double").alias(c) for c in columns])
            .unpivot(["side", "_row"], list(columns), "feature", "value"))
    per_value = long.groupBy("side", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    # Distinct values are combined first, so no group's value set is held by one task.
    distinct = per_value.groupBy("side", "feature").agg(
        F.sum("n").alias("n_rows"), F.count("value").alias("n_distinct"))
    moments = long.groupBy("side", "feature").agg(
        F.count("value").alias("n_known"), F.min("value").alias("smallest"),
        F.max("value").alias("largest"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.percentile_approx("value", [0.25, 0.5, 0.75], 10_000).alias("quartiles"),
        F.concat_ws("/", wide_sum(row_hash(["_row", "value"])),
                    wide_sum(F.xxhash64(F.lit(1), "_row", row_hash(["value"])))).alias("_print"))
    # One row per side and feature by now.
    position = F.array_position(F.array(*map(F.lit, columns)), F.col("feature"))
    equal = Window.partitionBy("side", "_print")
    first = F.min_by("feature", position).over(equal)
    return distinct.join(moments, ["side", "feature"]).withColumn(
        "null_share", 1 - F.col("n_known") / F.col("n_rows")).withColumn(
        "is_constant", F.col("n_distinct") <= 1).withColumn(
        "duplicate_of", F.when(first != F.col("feature"), first)).drop("_print")


def repeated_rows(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """snapshot_date, n_rows, n_repeated: rows of a month that equal an earlier one in all `columns`."""
    per_row = features.groupBy("snapshot_date", *[F.col(f"`{c}`") for c in columns if c != "snapshot_date"]).agg(
        F.count(F.lit(1)).alias("n"))
    return per_row.groupBy("snapshot_date").agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_repeated"))
