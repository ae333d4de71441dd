"""Training, selection and the out-of-time scores that later drift is measured against."""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import schemas, session
from creditloom.functions.fingerprint import fingerprints
from creditloom.operators import impute, leaves, models
from creditloom.operators.align import (
    Windows, align_offset, align_same_month, expanding_folds, split_stats, stratified_split,
    temporal_split)
from creditloom.operators.metrics import classification_metrics, reliability
from creditloom.operators.scoring import align_to_model, prediction_rows
from creditloom.sources import tables

MODEL_KINDS = ("gbt", "logreg")
METRICS = ("auc", "gini", "precision", "recall", "f1", "brier")


def training_frame(features: DataFrame, labels: DataFrame, windows: Windows) -> DataFrame:
    """Aligned and split rows, staged once for all fits of the run."""
    aligned = align_offset(features, labels, windows.train_start, windows.oot_end)
    return session.stage(temporal_split(aligned, windows), "training")[0]


def split_metrics(scored: DataFrame, score: str = "score") -> dict[str, float]:
    """auc_train, ... brier_oot from one grouped pass."""
    rows = classification_metrics(scored, ["split"], score).collect()
    return {f"{m}_{r['split']}": r[m] for r in rows for m in METRICS if r[m] is not None}


def fit(frame: DataFrame, kind: str, train_date: str, tt_months: int = 12, draws: int = 40,
        folds: int = 3, space: Mapping[str, Sequence] = models.SEARCH_SPACE,
        parallelism: int | None = None, columns: Sequence[str] | None = None,
        ledger: models.SearchLedger | None = None) -> models.Artefact:
    """Fits one model kind on the train split, calibrates trees on the test split, and measures
    all splits. The out-of-time rows are never fitted on. Finished fits of the search are kept in
    the `ledger`."""
    values = None
    columns = list(columns or schemas.feature_columns(
        c for c in frame.columns if c != "split"))
    train = frame.where(F.col("split") == "train")
    scaler = models.fit_scaler(train, columns)
    prepare = models.Pipeline(stages=models.input_stages(scaler)).fit(train)
    if kind == "logreg":
        model = models.fit_logreg(prepare.transform(train))
        pipeline = models.linear_model(columns, model.coefficients.toArray(), model.intercept,
                                       scaler)
        params = {"max_iter": 1000, "class_weight": "balanced"}
    else:
        vectors, _ = session.stage(
            expanding_folds(prepare.transform(train).select(
                "Customer_ID", "snapshot_date", "label", "features"), folds), "vectors")
        points = models.draw_parameters(draws, space=space)
        params = models.temporal_search(
            vectors, points, folds, parallelism=parallelism, ledger=ledger)[0][0]
        model = models.gbt(params).fit(vectors)
        if leaves.regularised(params):
            values = leaves.newton(model, vectors, params)
        pipeline = PipelineModel([*prepare.stages, model])
    artefact = models.Artefact(
        models.version(kind, train_date, tt_months), kind, columns,
        pipeline, models.importance_values(model), leaf_values=values, params=dict(params),
        dates={"train_date": train_date, "tt_months": str(tt_months)})

    raw, _ = session.stage(
        artefact.raw_scores(frame).select("split", "label", "raw_score"), "raw_scores")
    if kind != "logreg":
        artefact.calibration = models.fit_platt(raw.where(F.col("split") == "test"))
    raw_metrics = split_metrics(raw, "raw_score")
    results = {k: v for k, v in raw_metrics.items() if not k.startswith("brier")}
    if artefact.calibration is None:
        results["brier_oot_calibrated"] = raw_metrics.get("brier_oot", float("nan"))
    else:
        slope, intercept = artefact.calibration
        calibrated = split_metrics(raw.withColumn(
            "score", models.sigmoid(F.col("raw_score") * slope + intercept)))
        results["brier_oot_raw"] = raw_metrics.get("brier_oot", float("nan"))
        results["brier_oot_calibrated"] = calibrated.get("brier_oot", float("nan"))
        results["auc_oot_calibrated"] = calibrated.get("auc_oot", float("nan"))
    artefact.results = results
    return artefact


def oot_predictions(artefact: models.Artefact, frame: DataFrame) -> DataFrame:
    """Scores of the out-of-time months: the first prediction partitions of the model."""
    oot = artefact.scores(frame.where(F.col("split") == "oot"))
    return prediction_rows(oot, artefact.model_version, F.col("score"))


def reliability_table(artefact: models.Artefact, frame: DataFrame, bins: int = 10) -> DataFrame:
    """model_name, kind (raw, calibrated), bin, n, mean_predicted, observed_rate of the out-of-time
    rows with an outcome: the two curves of a calibration plot. A model without calibration has the
    raw one only."""
    known = frame.where((F.col("split") == "oot") & F.col("label").isNotNull())
    scores = [F.struct(F.lit("raw").alias("kind"), F.col("raw_score").alias("score"))]
    if artefact.calibration is not None:
        slope, intercept = artefact.calibration
        scores.append(F.struct(F.lit("calibrated").alias("kind"), models.sigmoid(
            F.col("raw_score") * slope + intercept).alias("score")))
    rows = artefact.raw_scores(known).select("label", F.inline(F.array(*scores)))
    return reliability(rows, ["kind"], "score", bins=bins).select(
        F.lit(artefact.model_version).alias("model_name"), "kind", "bin", "n", "mean_predicted",
        "observed_rate")


def write_reliability(root: str, table: DataFrame):
    return tables.overwrite_partitions(
        table, tables.table_path(root, "gold", "model_reliability"), ("model_name",))


def same_month_frame(clickstream: DataFrame, labels: DataFrame, windows: Windows,
                     test_share: float = 0.2) -> DataFrame:
    """Rows of the early variant, staged: outcomes with the clickstream of their own month, 0 where a
    customer has none. Months before the out-of-time window are split at random, each label alike;
    rows without an outcome are left out."""
    joined = align_same_month(labels.where(F.col("label").isNotNull()), clickstream)
    filled = impute.fill_constant(joined, 0, [c for c in clickstream.columns if c.startswith("fe_")])
    date = F.col("snapshot_date")
    early = filled.where(date.between(F.lit(windows.train_start), F.lit(windows.test_end)))
    late = filled.where(date.between(F.lit(windows.oot_start), F.lit(windows.oot_end)))
    return session.stage(stratified_split(early, test_share).unionByName(
        late.withColumn("split", F.lit("oot"))), "same_month")[0]


def fit_same_month(frame: DataFrame, train_date: str, params: Mapping | None = None) -> models.Artefact:
    """Trees on the clickstream columns of `same_month_frame`, with the metrics of all three splits."""
    columns = [c for c in frame.columns if c.startswith("fe_")]
    learn = frame.where(F.col("split") == "train")
    prepare = models.Pipeline(stages=models.input_stages(models.fit_scaler(learn, columns))).fit(learn)
    model = models.gbt(params or {}).fit(prepare.transform(learn))
    artefact = models.Artefact(
        models.version("clicks", train_date), "gbt", columns, PipelineModel([*prepare.stages, model]),
        models.importance_values(model), params=dict(params or {}), dates={"train_date": train_date})
    artefact.results = split_metrics(artefact.raw_scores(frame), "raw_score")
    return artefact


def score_same_month(artefact: models.Artefact, clickstream: DataFrame, month: str) -> DataFrame:
    """Prediction rows of one month of clickstream, dated by that month."""
    rows = clickstream.where(F.col("snapshot_date") == F.lit(month).cast("date"))
    columns = artefact.feature_columns
    filled = impute.fill_constant(align_to_model(rows, columns), 0, columns)
    return prediction_rows(artefact.scores(filled), artefact.model_version, F.col("score"))


def write_predictions(predictions: DataFrame, root: str):
    return tables.overwrite_partitions(
        predictions, tables.table_path(root, "gold", "model_predictions"),
        ("model_name", "snapshot_date"))


def write_importance(spark: SparkSession, root: str, artefact: models.Artefact) -> DataFrame:
    """The ranked importance table of a model, read later to scope feature drift."""
    ranked = models.importance_table(
        spark, artefact.feature_columns, artefact.importances).withColumn(
        "model_name", F.lit(artefact.model_version))
    tables.overwrite_partitions(
        ranked, tables.table_path(root, "gold", "feature_importance"), ("model_name",))
    return ranked


@session.job
def train(spark: SparkSession, root: str, train_date: str, tt_months: int = 12,
          kinds: Sequence[str] = MODEL_KINDS, **options) -> list[models.Artefact]:
    """Fits and stores every model kind for one training month."""
    windows = Windows.before(train_date, tt_months)
    frame = training_frame(
        tables.read_table(spark, tables.table_path(root, "gold", "feature_store")),
        tables.read_table(spark, tables.table_path(root, "gold", "label_store")), windows)
    stats = {r["split"]: r for r in split_stats(frame).collect()}
    # Fits of a search count only for the rows they were made on.
    data = zlib.crc32(fingerprints(frame).first()["fingerprint"].encode())
    artefacts = []
    for kind in kinds:
        ledger = models.SearchLedger(spark, tables.table_path(
            root, "ops", f"search_ledger/{models.version(kind, train_date, tt_months)}/data={data}"))
        artefact = fit(frame, kind, train_date, tt_months, ledger=ledger, **options)
        artefact.dates.update({k: str(v) for k, v in vars(windows).items()})
        artefact.dates.update({f"rows_{k}": str(r["n"]) for k, r in stats.items()})
        artefact.save(spark, root)
        write_predictions(oot_predictions(artefact, frame), root)
        write_importance(spark, root, artefact)
        write_reliability(root, reliability_table(artefact, frame))
        artefacts.append(artefact)
    return artefacts


def select_champion(spark: SparkSession, root: str, train_date: str, tt_months: int = 12,
                    kinds: Sequence[str] = MODEL_KINDS) -> DataFrame:
    """Compares the candidates of a training month; only the standard window replaces the stored
    champion."""
    wanted = [models.version(k, train_date, tt_months) for k in kinds]
    position = F.array_position(F.array(*map(F.lit, wanted)), F.col("model_version"))
    candidates = (models.registry(spark, root).where(F.col("model_version").isin(wanted))
                  .select("model_version", F.col("results")["auc_oot"].alias("auc_oot"),
                          position.alias("position")))
    found = {r["model_version"] for r in candidates.select("model_version").collect()}
    missing = [w for w in wanted if w not in found]
    if missing:
        raise FileNotFoundError(f"expected models are missing: {', '.join(missing)}")
    best = session.stage(models.champion(candidates), "champion")[0]
    if tt_months == 12:
        tables.overwrite_table(best.coalesce(1), tables.table_path(root, "gold", "champion"))
    return best


def current_champion(spark: SparkSession, root: str) -> str | None:
    stored = tables.read_table(spark, tables.table_path(root, "gold", "champion"))
    return None if stored is None else stored.first()["champion"]
