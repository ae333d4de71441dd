"""Fitting, calibrating, ranking and storing default models with spark.ml."""

from __future__ import annotations

import hashlib
import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.operators import leaves
from creditloom.operators.metrics import count_metrics, score_counts
from creditloom.sources import tables

SEED = 88

# The search space of the boosted trees.
SEARCH_SPACE = {
    "n_estimators": [50, 100, 200],
    "max_depth": [2, 3, 4],
    "learning_rate": [0.01, 0.05, 0.1],
    "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0],
    "gamma": [0.0, 0.1, 0.3],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 2, 5],
}


# --- scaling -------------------------------------------------------------------------------------

def scaler_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, mean, std (population) of every column. Values are grouped by the column's place: one
    row of two aggregates per column is code too long to be compiled, and takes several times as long."""
    columns = list(columns)
    values = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_place", "_value"))
    found = values.groupBy("_place").agg(F.avg("_value").alias("mean"), F.stddev_pop("_value").alias("std"))
    every = df.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, columns))).alias("_place", "feature"))
    return every.join(found, "_place", "left").select("feature", "mean", "std")


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and scale per column; a constant column keeps scale 1."""
    return {r["feature"]: (r["mean"], r["std"] or 1.0)
            for r in scaler_statistics(df, columns).collect()}


def scaled(c: Column, mean: float, scale: float) -> Column:
    return (c - F.lit(mean)) / F.lit(scale)


def scale_columns(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.select(*[scaled(F.col(c), *scaler[c]).alias(c) if c in scaler else F.col(c)
                       for c in df.columns])


def input_stages(scaler: Mapping[str, tuple[float, float]]) -> list:
    """Scaling and assembling as stored pipeline stages, without touching the input columns."""
    names = list(scaler)
    terms = ", ".join(
        f"(`{c}` - ({scaler[c][0]!r}D)) / ({scaler[c][1]!r}D) AS `_z{i}`"
        for i, c in enumerate(names))
    return [
        SQLTransformer(statement=f"SELECT *, {terms} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_z{i}" for i in range(len(names))], outputCol="features"),
        SQLTransformer(statement="SELECT * EXCEPT ("
                       + ", ".join(f"`_z{i}`" for i in range(len(names))) + ") FROM __THIS__"),
    ]


def inputs(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    """The frame with the scaled `features` vector."""
    return Pipeline(stages=input_stages(scaler)).fit(df).transform(df)


# --- estimators ----------------------------------------------------------------------------------

def balanced_weights(df: DataFrame, label: str = "label") -> tuple[DataFrame, int]:
    """Adds `class_weight` = n / (2 * n of the class); also returns n."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    n = sum(counts.values())
    weight = F.when(F.col(label) == 1, n / (2.0 * counts.get(1, 1))).otherwise(
        n / (2.0 * counts.get(0, 1)))
    return df.withColumn("class_weight", weight), n


def fit_logreg(vectors: DataFrame, label: str = "label", max_iter: int = 1000):
    """L2 logistic regression with unit penalty on the summed, class-balanced loss."""
    weighted, n = balanced_weights(vectors, label)
    return LogisticRegression(
        labelCol=label, weightCol="class_weight", regParam=1.0 / n, elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-8).fit(weighted)


def gbt(params: Mapping[str, float], label: str = "label") -> GBTClassifier:
    return GBTClassifier(
        labelCol=label, seed=SEED,
        maxIter=int(params.get("n_estimators", 100)),
        maxDepth=int(params.get("max_depth", 3)),
        stepSize=float(params.get("learning_rate", 0.1)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy=str(float(params.get("colsample_bytree", 1.0))),
        minInfoGain=float(params.get("gamma", 0.0)),
        minInstancesPerNode=int(params.get("min_child_weight", 1)))


def draw_parameters(draws: int, seed: int = 42,
                    space: Mapping[str, Sequence] = SEARCH_SPACE) -> list[dict]:
    """Distinct random points of the grid."""
    rng, seen, out = random.Random(seed), set(), []
    size = 1
    for values in space.values():
        size *= len(values)
    while len(out) < min(draws, size):
        point = {k: rng.choice(list(v)) for k, v in space.items()}
        if tuple(point.values()) not in seen:
            seen.add(tuple(point.values()))
            out.append(point)
    return out


LEDGER = "point string, fold int, auc double"


class SearchLedger:
    """Finished fits of a search, so that a search that stops goes on where it was. Each has a folder of
    its own, because fits end in several threads, and a write into a shared one would end the others'."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @staticmethod
    def key(point: Mapping) -> str:
        return json.dumps(dict(point), sort_keys=True)

    def rows(self) -> DataFrame:
        found = tables.read_table(self.spark, self.path)
        empty = self.spark.createDataFrame([], LEDGER)
        return empty if found is None else found.select(empty.columns).distinct()

    def add(self, point: Mapping, fold: int, auc: float) -> None:
        fit = f"{hashlib.sha256(self.key(point).encode()).hexdigest()[:24]}_{fold}"
        self.spark.createDataFrame([(self.key(point), fold, float(auc))], LEDGER).coalesce(1).write.mode(
            "overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/fit={fit}")

    def best(self, folds: int) -> DataFrame:
        """point, n_folds, mean_auc of the points with all folds, best first, ties by the point's text."""
        return (self.rows().groupBy("point").agg(F.count(F.lit(1)).alias("n_folds"), F.avg("auc").alias("mean_auc"))
                .where(F.col("n_folds") == folds).orderBy(F.desc("mean_auc"), "point"))


def fold_auc(vectors: DataFrame, point: Mapping, fold: int, label: str = "label") -> float:
    """AUC on one fold of a model fitted on the folds before it, leaf values by the point's regularisation."""
    model = gbt(point, label).fit(vectors.where(F.col("block") < fold))
    test = vectors.where(F.col("block") == fold)
    if leaves.regularised(point):
        values = leaves.newton(model, vectors.where(F.col("block") < fold), point, label)
        scored = leaves.scored(model, values, test).select(F.col("raw_score").alias("model_predictions"), label)
        return count_metrics(score_counts(scored, [], label=label), []).first()["auc"]
    return BinaryClassificationEvaluator(labelCol=label, numBins=0).evaluate(model.transform(test))


def temporal_search(vectors: DataFrame, points: Sequence[Mapping], folds: int = 3,
                    label: str = "label", parallelism: int | None = None,
                    ledger: SearchLedger | None = None) -> list[tuple[dict, float]]:
    """Mean AUC of every parameter point over expanding folds, best first.

    `vectors` has `features`, the label and `block` from `expanding_folds`, and should be a staged
    table: every fit reads it again. Fits are independent Spark jobs started from a few threads, by
    default one for four cores. With a `ledger`, fits it has are not done again.
    """
    spark = vectors.sparkSession
    if parallelism is None:
        parallelism = max(1, spark.sparkContext.defaultParallelism // 4)
    done = {(r["point"], r["fold"]): r["auc"] for r in ledger.rows().collect()} if ledger else {}

    def one(task):
        point, fold = task
        known = done.get((SearchLedger.key(point), fold))
        if known is not None:
            return known
        auc = fold_auc(vectors, point, fold, label)
        if ledger:
            ledger.add(point, fold, auc)
        return auc

    tasks = [(p, f) for p in points for f in range(1, folds + 1)]
    with ThreadPool(parallelism) as pool:
        values = pool.map(one, tasks, chunksize=1)
    scores = [(dict(p), sum(values[i * folds:(i + 1) * folds]) / folds)
              for i, p in enumerate(points)]
    return sorted(scores, key=lambda s: -s[1])


def platt_targets(counts: DataFrame) -> DataFrame:
    """(score, label, weight): every distinct score once per class, weighted by smoothed targets.

    `counts` is (score, pos, neg).
    """
    totals = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    row = totals.first()
    high = (row["P"] + 1.0) / (row["P"] + 2.0)
    low = 1.0 / (row["N"] + 2.0)
    as_bad = F.col("pos") * high + F.col("neg") * low
    as_good = F.col("pos") * (1 - high) + F.col("neg") * (1 - low)
    return counts.select("score", F.explode(F.array(
        F.struct(F.lit(1).alias("label"), as_bad.alias("weight")),
        F.struct(F.lit(0).alias("label"), as_good.alias("weight")))).alias("t")).select(
        "score", "t.label", "t.weight")


def fit_platt(df: DataFrame, score: str = "raw_score", label: str = "label") -> tuple[float, float]:
    """Slope and intercept of the sigmoid that maps raw scores to probabilities."""
    rows = platt_targets(score_counts(df, [], score, label))
    model = LogisticRegression(weightCol="weight", regParam=0.0, maxIter=1000, tol=1e-10).fit(
        VectorAssembler(inputCols=["score"], outputCol="features").transform(rows))
    return float(model.coefficients[0]), float(model.intercept)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear_score(columns: Sequence[str], coefficients: Sequence[float], intercept: float,
                 scaler: Mapping[str, tuple[float, float]]) -> Column:
    """A logistic model as one expression, evaluated inside the scan's code."""
    z = F.lit(float(intercept))
    for c, w in zip(columns, coefficients, strict=True):
        z = z + F.lit(float(w)) * scaled(F.col(c), *scaler[c])
    return sigmoid(z)


def linear_model(columns: Sequence[str], coefficients: Sequence[float], intercept: float,
                 scaler: Mapping[str, tuple[float, float]]) -> PipelineModel:
    """The same as a storable pipeline that adds `raw_score`."""
    terms = "".join(f" + ({float(w)!r}D) * (`{c}` - ({scaler[c][0]!r}D)) / ({scaler[c][1]!r}D)"
                    for c, w in zip(columns, coefficients, strict=True))
    z = f"({float(intercept)!r}D){terms}"
    return PipelineModel([SQLTransformer(
        statement=f"SELECT *, 1.0D / (1.0D + exp(-({z}))) AS raw_score FROM __THIS__")])


# --- stored models -------------------------------------------------------------------------------

@dataclass
class Artefact:
    """A fitted model with all that scoring and monitoring need to know about it."""

    model_version: str
    model_type: str
    feature_columns: list[str]
    model: PipelineModel
    importances: list[float]
    calibration: tuple[float, float] | None = None
    leaf_values: list[list[float]] | None = None  # by regularised Newton steps, instead of the trees' own
    results: dict[str, float] = field(default_factory=dict)
    params: dict = field(default_factory=dict)
    dates: dict[str, str] = field(default_factory=dict)

    def raw_scores(self, df: DataFrame) -> DataFrame:
        if self.leaf_values is not None:
            prepare, trees = PipelineModel(self.model.stages[:-1]), self.model.stages[-1]
            return leaves.scored(trees, self.leaf_values, prepare.transform(df)).drop("features")
        out = self.model.transform(df)
        if "raw_score" in out.columns:
            return out
        return (out.withColumn("raw_score", vector_to_array("probability")[1])
                .drop("features", "rawPrediction", "probability", "prediction"))

    def scores(self, df: DataFrame) -> DataFrame:
        """Adds `score`: calibrated where the model has a calibration, else raw."""
        out = self.raw_scores(df)
        if self.calibration is None:
            return out.withColumnRenamed("raw_score", "score")
        slope, intercept = self.calibration
        return out.withColumn("score", sigmoid(F.col("raw_score") * slope + intercept)).drop(
            "raw_score")

    def save(self, spark: SparkSession, root: str) -> None:
        self.model.write().overwrite().save(f"{root}/model_bank/{self.model_version}")
        row = spark.createDataFrame([(
            self.model_version, self.model_type, self.feature_columns, self.importances,
            list(self.calibration) if self.calibration else None, self.leaf_values,
            {k: float(v) for k, v in self.results.items()}, json.dumps(self.params), self.dates)],
            REGISTRY)
        (row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("model_version").parquet(f"{root}/gold/model_registry"))


REGISTRY = ("model_version string, model_type string, feature_columns array<string>, "
            "importances array<double>, calibration array<double>, leaf_values array<array<double>>, "
            "results map<string,double>, params string, "
            "dates map<string,string>")


def registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(f"{root}/gold/model_registry")


def load(spark: SparkSession, root: str, model_version: str) -> Artefact:
    rows = registry(spark, root).where(F.col("model_version") == model_version).take(1)
    if not rows:
        raise FileNotFoundError(f"no model {model_version} in the registry")
    r = rows[0]
    return Artefact(
        r["model_version"], r["model_type"], list(r["feature_columns"]),
        PipelineModel.load(f"{root}/model_bank/{model_version}"), list(r["importances"]),
        tuple(r["calibration"]) if r["calibration"] else None,
        [list(v) for v in r["leaf_values"]] if r["leaf_values"] else None,
        dict(r["results"]), json.loads(r["params"]), dict(r["dates"]))


def version(kind: str, train_date: str, tt_months: int = 12) -> str:
    """Comparison runs with another window get a suffix."""
    suffix = "" if tt_months == 12 else f"_tt{tt_months}m"
    return f"credit_{kind}_{train_date.replace('-', '_')}{suffix}"


def champion(candidates: DataFrame) -> DataFrame:
    """The model with the largest out-of-time AUC, the runner-up and the margin.

    `candidates` has (model_version, auc_oot, position); the lowest position wins a tie. A single
    candidate has no runner-up and no margin.
    """
    order = F.struct("auc_oot", -F.col("position"))
    two = candidates.orderBy(F.desc("auc_oot"), "position").limit(2)
    return two.agg(
        F.max_by("model_version", order).alias("champion"),
        F.max("auc_oot").alias("auc_oot"),
        F.when(F.count(F.lit(1)) > 1, F.min_by("model_version", order)).alias("runner_up"),
        F.when(F.count(F.lit(1)) > 1, F.max("auc_oot") - F.min("auc_oot")).alias("margin"))


# --- importance ----------------------------------------------------------------------------------

def importance_values(model) -> list[float]:
    """Gain importances of trees, absolute standardised coefficients of linear models."""
    if hasattr(model, "featureImportances"):
        return [float(v) for v in model.featureImportances.toArray()]
    if hasattr(model, "coefficients"):
        return [abs(float(v)) for v in model.coefficients.toArray()]
    raise ValueError(f"{type(model).__name__} has neither importances nor coefficients")


def importance_table(spark: SparkSession, columns: Sequence[str],
                     values: Sequence[float]) -> DataFrame:
    """feature, position, importance: one row per model input."""
    return spark.createDataFrame(
        [(c, i, float(v)) for i, (c, v) in enumerate(zip(columns, values, strict=True))],
        "feature string, position int, importance double")


def top_features(importance: DataFrame, n: int) -> DataFrame:
    """The n most important features; the original order decides ties."""
    return importance.orderBy(F.desc("importance"), "position").limit(n)


def importance_share(importance: DataFrame, n: int) -> DataFrame:
    """Share of total importance held by the top n; null when there is no importance at all."""
    top = top_features(importance, n).select("feature", F.lit(True).alias("top"))
    return importance.join(top, "feature", "left").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.try_divide(F.sum(F.when(F.col("top"), F.col("importance"))), F.sum("importance"))
        .alias("top_share"))


def ranks(importance: DataFrame) -> DataFrame:
    """Adds `rank` from 1; a table has one row per model input, so one sort is enough."""
    order = Window.partitionBy("model_name").orderBy(F.desc("importance"), "position")
    return importance.withColumn("rank", F.row_number().over(order))
