"""Feature transforms, training and scoring (M), evaluation metrics (E)."""

from __future__ import annotations

from functools import cache

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom import schemas, session
from creditloom.functions.loans import ENGINEERED
from creditloom.operators import align, clean, customer_state, drift, encode, impute, metrics, models, scoring
from creditloom.operators import point_in_time as pit
from creditloom.plans import gold, train
from workload.inputs import LOAN_COLUMNS, Inputs
from workload.join_queries import bin_number, candidates
from workload.registry import edges_sql, query, shared, steady, steady_sql
from workload.tables import FE

KEYS = ["Customer_ID", "snapshot_date"]
TRAIN_DATE = "1998-09-01"

# Category labels of the derived tables, as the reference SQL must name its columns.
LABELS = {
    "Occupation": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "unknown"],
    "Credit_Mix": ["Good", "Standard", "Bad", "unknown"],
    "Payment_of_Min_Amount": ["Yes", "No", "NM"],
    "payment_behaviour_spent": ["Low", "High", "unknown"],
    "payment_behaviour_value": ["Small", "Medium", "Large", "unknown"],
}


def one_hot_sql(columns, labels=LABELS) -> str:
    return ", ".join(
        f"case when coalesce({c}, 'unknown') = '{v}' then 1 else 0 end"
        f" as {encode.column_name(c, v)}" for c in columns for v in labels[c])


FINANCIAL_CATEGORIES = schemas.CATEGORIES[1:]


@query("m1_one_hot", f"""
    select Customer_ID, snapshot_date, {one_hot_sql(FINANCIAL_CATEGORIES)}
    from t_financial_values""")
def m1(spark, sf):
    rows = Inputs(spark, sf).financial_values.select(*KEYS, *FINANCIAL_CATEGORIES)
    return encode.one_hot(rows, encode.fit_vocabulary(rows, FINANCIAL_CATEGORIES))


@query("m1_category_frequencies", " union all ".join(
    f"select '{c}' as \"column\", coalesce({c}, 'unknown') as label, count(*) as n"
    " from t_financial_values group by 2" for c in FINANCIAL_CATEGORIES))
def m1_frequencies(spark, sf):
    return encode.label_frequencies(Inputs(spark, sf).financial_values, FINANCIAL_CATEGORIES)


_OPEN = ["Credit_Mix", "payment_behaviour_value"]


@query("m1_open_vocabulary", " union all ".join(f"""
    select '{c}' as "column", snapshot_date, count(*) as n,
           cast(sum(case when v.label is null then 1 else 0 end) as bigint) as n_unseen,
           cast(sum(case when v.label is null then 1 else 0 end) as bigint) as n_other
    from (select snapshot_date, coalesce({c}, 'unknown') as label from t_financial_values) r
    left join (select coalesce({c}, 'unknown') as label from t_financial_values
               where snapshot_date <= date '1996-12-01' group by 1
               order by count(*) desc, 1 limit 2) v on v.label = r.label
    group by snapshot_date""" for c in _OPEN))
def m1_open(spark, sf):
    """The two most frequent labels of a training window name columns; all other rows, per month, are
    counted as unseen and have a one in the `other` column."""
    rows = Inputs(spark, sf).financial_values.select(*KEYS, *_OPEN)
    counts, _ = session.stage(encode.label_counts(rows, _OPEN), "labels")
    window = counts.where(F.col("snapshot_date") <= F.lit("1996-12-01").cast("date"))
    vocabulary, _ = session.stage(encode.frequent_labels(window, _OPEN, 2), "vocabulary")
    unseen = encode.unseen_labels(counts, vocabulary)
    encoded = encode.one_hot(rows, encode.vocabulary_of(vocabulary), other=True)
    others = encoded.groupBy("snapshot_date").agg(*[F.sum(f"{c}_other").alias(c) for c in _OPEN]).unpivot(
        ["snapshot_date"], _OPEN, "column", "n_other")
    return unseen.join(others, ["snapshot_date", "column"]).select("column", "snapshot_date", "n", "n_unseen", "n_other")


@query("m1_one_hot_occupation", f"""
    select Customer_ID, snapshot_date, {one_hot_sql(["Occupation"])} from t_attributes""")
def m1_occupation(spark, sf):
    rows = Inputs(spark, sf).attributes.select(*KEYS, "Occupation")
    return encode.one_hot(rows, encode.fit_vocabulary(rows, ["Occupation"]))


@query("u2_one_hot_array", f"""
    select Customer_ID, snapshot_date, {one_hot_sql(FINANCIAL_CATEGORIES)}
    from t_financial_values""")
def u2(spark, sf):
    """Vectors of a fitted indexer and encoder as plain columns, without a Python function."""
    names = FINANCIAL_CATEGORIES
    rows = encode.fill_unknown(Inputs(spark, sf).financial_values.select(*KEYS, *names), names)
    indexer = StringIndexer(inputCols=names, outputCols=[f"{c}_i" for c in names],
                            stringOrderType="alphabetAsc").fit(rows)
    indexed = indexer.transform(rows)
    encoded = OneHotEncoder(inputCols=[f"{c}_i" for c in names],
                            outputCols=[f"{c}_v" for c in names],
                            dropLast=False).fit(indexed).transform(indexed)
    return encoded.select(*KEYS, *[
        vector_to_array(f"{c}_v")[i].cast("int").alias(encode.column_name(c, label))
        for c, labels in zip(names, indexer.labelsArray) for i, label in enumerate(labels)])


NUMBERS = [*schemas.FINANCIAL_NUMBERS, "Credit_History_Age"]
_KINDS = {**{c: ("integer" if t == "int" else "double")
             for c, t in schemas.FINANCIAL_NUMBERS.items()}, "Credit_History_Age": "integer"}


@query("m2_median_impute", "select v.Customer_ID, v.snapshot_date, " + ", ".join(
    f"coalesce(v.{c}, cast(m.{c} as {_KINDS[c]}), 0) as {c}" for c in NUMBERS)
    + " from t_financial_values v join (select snapshot_date, " + ", ".join(
        f"quantile_disc({c}, 0.5e0) as {c}" for c in NUMBERS)
    + " from t_financial_values group by 1) m on m.snapshot_date = v.snapshot_date")
def m2(spark, sf):
    rows = Inputs(spark, sf).financial_values.select(*KEYS, *NUMBERS)
    return impute.median_impute(rows, NUMBERS, exact=True)


# --- the feature store as one SQL text -----------------------------------------------------------

# Applications without any known finances have every category unknown.
_JOINED_LABELS = {**LABELS, "Payment_of_Min_Amount": ["Yes", "No", "NM", "unknown"]}
_HOT = [encode.column_name(c, v) for c in schemas.CATEGORIES for v in _JOINED_LABELS[c]]
_ALL = ["loan_amt", "tenure", *NUMBERS, "Age", *LOAN_COLUMNS, *FE, *ENGINEERED, *_HOT]
_q = lambda c: f'"{c}"'
shared("t_joined", f"""
    select a.Customer_ID, a.snapshot_date, a.loan_amt, a.tenure,
           {', '.join('f.' + c for c in [*NUMBERS, *FINANCIAL_CATEGORIES])}, t.Age, t.Occupation,
           {', '.join('l.' + _q(c) for c in LOAN_COLUMNS)}, {', '.join('h.' + c for c in FE)}
    from t_applications a
    join t_history_filled h on h.Customer_ID = a.Customer_ID and h.snapshot_date = a.snapshot_date
    asof left join t_financials f
      on f.Customer_ID = a.Customer_ID and f.snapshot_date <= a.snapshot_date
    asof left join t_attributes t
      on t.Customer_ID = a.Customer_ID and t.snapshot_date <= a.snapshot_date
    asof left join t_loan_type l
      on l.Customer_ID = a.Customer_ID and l.snapshot_date <= a.snapshot_date""")
shared("t_encoded", f"""
    select *, Outstanding_Debt / nullif(Annual_Income + 1.0e0, 0) as debt_to_income,
           Total_EMI_per_month / nullif(Monthly_Inhand_Salary + 1.0e0, 0) as emi_to_salary,
           Amount_invested_monthly / nullif(Monthly_Inhand_Salary + 1.0e0, 0) as savings_rate,
           Num_of_Delayed_Payment / nullif(Num_of_Loan + 1.0e0, 0) as payment_stress,
           Num_of_Loan / nullif(Num_Credit_Card + 1.0e0, 0) as loans_per_credit_card,
           Monthly_Inhand_Salary - Total_EMI_per_month as monthly_surplus,
           {one_hot_sql(schemas.CATEGORIES, _JOINED_LABELS)}
    from t_joined""")
shared("t_feature_medians", "select snapshot_date, " + ", ".join(
    f"quantile_disc({_q(c)}, 0.5e0) as {_q(c)}" for c in _ALL) + " from t_encoded group by 1")
_INTS = {"tenure", "Age", *LOAN_COLUMNS, *_HOT, *[c for c, k in _KINDS.items() if k == "integer"]}
shared("t_features", "select e.Customer_ID, e.snapshot_date, " + ", ".join(
    f"coalesce(e.{_q(c)}, m.{_q(c)}, 0) as {_q(c)}" for c in _ALL)
    + " from t_encoded e join t_feature_medians m on m.snapshot_date = e.snapshot_date")


@query("m3_build_feature_store", "select Customer_ID, snapshot_date, " + ", ".join(
    f"{_q(c)}" if c in _INTS else f"round({_q(c)}, 6) as {_q(c)}" for c in _ALL)
    + " from t_features")
def m3(spark, sf):
    x = Inputs(spark, sf)
    features = gold.build_feature_store(x.lms, x.financials, x.attributes, x.loan_type,
                                        x.clickstream, exact=True)
    kinds = dict(features.dtypes)
    return features.select(*[F.round(f"`{c}`", 6).alias(c) if kinds[c] == "double"
                             else F.col(f"`{c}`") for c in features.columns])


CARRIED = ["1998-06-01", "1998-07-01", "1998-08-01"]


@query("m3_carried_state", "select Customer_ID, snapshot_date, " + ", ".join(
    f"{_q(c)}" if c in _INTS else f"round({_q(c)}, 6) as {_q(c)}" for c in _ALL)
    + " from t_features where snapshot_date in ("
    + ", ".join(f"date '{m}'" for m in CARRIED) + ")")
def m3_carried(spark, sf):
    """Features of three months from the carried state: all rows before them make the first state, then
    every month reads its own rows and the state before."""
    x = Inputs(spark, sf)
    every = {"financials": x.financials, "attributes": x.attributes.select(*KEYS, "Age", "Occupation"),
             "loan_type": x.loan_type}
    every = {name: session.stage(df, name)[0] for name, df in every.items()}
    clicks, date = session.stage(x.clickstream, "clicks")[0], F.col("snapshot_date")
    # Stored like the sources: every month reads its own rows, not all raw loans again.
    anchors, _ = session.stage(x.applications.where(date.isin([F.lit(m).cast("date") for m in CARRIED])), "anchors")
    vocabulary = encode.fit_vocabulary(every["attributes"], ["Occupation"]) | encode.fit_vocabulary(
        every["financials"], FINANCIAL_CATEGORIES) | {"Payment_of_Min_Amount": _JOINED_LABELS["Payment_of_Min_Amount"]}
    vocabulary = {c: vocabulary[c] for c in schemas.CATEGORIES}
    old = date < F.lit(CARRIED[0]).cast("date")
    state = tuple(session.stage(df, "state")[0] for df in (
        customer_state.extend(None, {n: df.where(old) for n, df in every.items()}, clicks.where(old), FE),
        customer_state.value_counts(None, clicks.where(old), FE)))
    out = None
    for month in CARRIED:
        at = date == F.lit(month).cast("date")
        state, features = gold.carried_month(
            state, anchors.where(at), {n: df.where(at) for n, df in every.items()}, clicks.where(at),
            month, vocabulary, exact=True)
        out = features if out is None else out.unionByName(features)
    kinds = dict(out.dtypes)
    return out.select(*[F.round(f"`{c}`", 6).alias(c) if kinds[c] == "double" else F.col(f"`{c}`") for c in out.columns])


@query("m3_feature_store_default")
def m3_default(spark, sf):
    """The same as it is run in production: sketched quantiles, two passes over the sources."""
    x = Inputs(spark, sf)
    return gold.build_feature_store(
        x.lms, clean.clean_financials(x.raw("financials")), x.attributes, x.loan_type,
        x.clickstream)


# --- splits, scaling -----------------------------------------------------------------------------

def frame(x: Inputs):
    """Applications with outcomes and history means, split by time around one training date."""
    aligned = align.align_offset(x.applications, x.labels)
    return align.temporal_split(aligned, align.Windows.before(TRAIN_DATE))


@query("m4_temporal_split", """
    select Customer_ID, snapshot_date, loan_amt, label, split from t_split
    where split is not null""")
def m4(spark, sf):
    return frame(Inputs(spark, sf)).drop("tenure")


@query("m5_stratified_split", """
    select label, unnest(['train', 'test']) as split,
           cast(unnest([count(*) - ceil(count(*) * 0.2e0), ceil(count(*) * 0.2e0)]) as bigint) as n
    from t_labels group by label""")
def m5(spark, sf):
    return align.stratified_split(Inputs(spark, sf).labels).groupBy("label", "split").agg(
        F.count(F.lit(1)).alias("n"))


shared("t_train_scale", """
    select avg(loan_amt) as mean, stddev_pop(loan_amt) as std, avg(tenure) as tenure_mean
    from t_split where split = 'train'""")


@query("m6_standard_scale", """
    select f.Customer_ID, f.snapshot_date, f.split, round((loan_amt - mean) / std, 6) as loan_amt,
           round((tenure - tenure_mean) / 1e0, 6) as tenure
    from t_split f, t_train_scale s where f.split is not null""")
def m6(spark, sf):
    rows = frame(Inputs(spark, sf))
    scaler = models.fit_scaler(rows.where(F.col("split") == "train"), ["loan_amt", "tenure"])
    return models.scale_columns(rows, scaler).select(
        *KEYS, "split", F.round("loan_amt", 6).alias("loan_amt"),
        F.round("tenure", 6).alias("tenure"))


# --- fitted models -------------------------------------------------------------------------------

FEATURES = _ALL  # every column of the feature store
SMALL_TREES = {"n_estimators": [10], "max_depth": [2, 3], "learning_rate": [0.1],
               "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0]}


@cache
def _training_rows(application_id: str, spark, sf: str):
    x = Inputs(spark, sf)
    features = gold.build_feature_store(
        x.lms, clean.clean_financials(x.raw("financials")), x.attributes, x.loan_type, x.clickstream)
    return train.training_frame(features, x.labels, align.Windows.before(TRAIN_DATE, tt_months=24))


def training_rows(x: Inputs):
    """The training frame over the whole feature store, made once a session."""
    return _training_rows(x.spark.sparkContext.applicationId, x.spark, x.sf_dir)


@cache
def _fitted(application_id: str, spark, sf: str, kind: str):
    rows = training_rows(Inputs(spark, sf))
    return rows, train.fit(rows, kind, TRAIN_DATE, 24, draws=1, space=SMALL_TREES, columns=FEATURES)


def fitted(x: Inputs, kind: str):
    """The training frame and a model on it, fitted once a session."""
    return _fitted(x.spark.sparkContext.applicationId, x.spark, x.sf_dir, kind)


def result_rows(spark, artefact):
    return spark.createDataFrame(
        [(artefact.model_version, k, float(v)) for k, v in sorted(artefact.results.items())],
        "model_version string, metric string, value double")


@query("m7_logreg_balanced")
def m7(spark, sf):
    rows = training_rows(Inputs(spark, sf)).where(F.col("split") == "train")
    model = models.fit_logreg(models.inputs(rows, models.fit_scaler(rows, FEATURES)))
    values = [*zip(FEATURES, map(float, model.coefficients)), ("intercept", model.intercept)]
    return spark.createDataFrame(values, "term string, coefficient double")


@query("m7_gradient", "select unnest([" + ", ".join(
    f"'{c}'" for c in [*FEATURES, "intercept"]) + "]) as term, true as at_minimum")
def m7_gradient(spark, sf):
    """Every partial derivative of the penalised loss at the fitted coefficients is zero, up to a
    thousandth of the rows it sums over."""
    rows = training_rows(Inputs(spark, sf)).where(F.col("split") == "train")
    vectors = models.inputs(rows, models.fit_scaler(rows, FEATURES))
    model = models.fit_logreg(vectors)
    weighted, n = models.balanced_weights(vectors)
    x = vector_to_array("features")
    z = F.lit(float(model.intercept))
    for i, w in enumerate(model.coefficients):
        z = z + F.lit(float(w)) * x[i]
    error = F.col("class_weight") * (models.sigmoid(z) - F.col("label"))
    sums = weighted.agg(*[F.sum(error * x[i]).alias(c) for i, c in enumerate(FEATURES)],
                        F.sum(error).alias("intercept"))
    penalty = dict(zip(FEATURES, map(float, model.coefficients)), intercept=0.0)
    flat = F.array(*[F.struct(F.lit(c).alias("term"),
                              (F.abs(F.col(c) + w) < 1e-3 * n).alias("at_minimum"))
                     for c, w in penalty.items()])
    return sums.select(F.inline(flat))


@query("m8_boosted_trees")
def m8(spark, sf):
    rows = training_rows(Inputs(spark, sf)).where(F.col("split") == "train")
    vectors = models.inputs(rows, models.fit_scaler(rows, FEATURES))
    model = models.gbt({"n_estimators": 10, "max_depth": 3, "subsample": 0.8}).fit(vectors)
    scored = model.transform(vectors).select(
        *KEYS, vector_to_array("probability")[1].alias("model_predictions"))
    return scored


_TRAIN = "t_aligned where snapshot_date between date '1996-07-01' and date '1998-04-30'"


@query("m8_score_counts", f"""
    select snapshot_date, count(*) as n, count(*) as n_in_range, cast(sum(label) as bigint) as n_pos
    from {_TRAIN} group by 1""")
def m8_counts(spark, sf):
    """The trees score every training row once, with a probability, under its own outcome."""
    rows = training_rows(Inputs(spark, sf)).where(F.col("split") == "train")
    return m8(spark, sf).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("model_predictions").between(0, 1)).alias("n_in_range")).join(
        rows.groupBy("snapshot_date").agg(F.sum("label").alias("n_pos")), "snapshot_date")


@query("m9_search_ledger", f"""
    select fold, count(*) as n_fits, max(n) as n_rows, true as best_first, true as fitted_once from (
      select unnest([1, 2, 3]) as fold, n from (select count(*) as n from {_TRAIN}) c,
             (select unnest([1, 2]) as draw) d) x group by fold""")
def m9_ledger(spark, sf):
    """A search leaves one row per draw and fold, the best draw is the one with the largest mean in the
    ledger, and a search that is run again fits nothing."""
    rows = training_rows(Inputs(spark, sf)).where(F.col("split") == "train")
    vectors = models.inputs(rows, models.fit_scaler(rows, FEATURES)).select(*KEYS, "label", "features")
    folded, n = session.stage(align.expanding_folds(vectors), "vectors")
    book = models.SearchLedger(spark, session.kept_folder(spark, "ledger"))
    points = models.draw_parameters(2, space=SMALL_TREES)
    ranked = models.temporal_search(folded, points, ledger=book)
    files = sorted(book.rows().inputFiles())
    again = models.temporal_search(folded, points, ledger=book)
    best = book.best(3).first()
    return book.rows().groupBy("fold").agg(F.count(F.lit(1)).alias("n_fits")).select(
        "fold", "n_fits", F.lit(n).cast("long").alias("n_rows"),
        F.lit(abs(best["mean_auc"] - ranked[0][1]) < 1e-12).alias("best_first"),
        F.lit(again == ranked and sorted(book.rows().inputFiles()) == files).alias("fitted_once"))


@query("m9_random_search_temporal_cv")
def m9(spark, sf):
    rows = training_rows(Inputs(spark, sf)).where(F.col("split") == "train")
    vectors = models.inputs(rows, models.fit_scaler(rows, FEATURES)).select(
        *KEYS, "label", "features")
    folded, _ = session.stage(align.expanding_folds(vectors), "vectors")
    ranked = models.temporal_search(folded, models.draw_parameters(2, space=SMALL_TREES))
    return spark.createDataFrame(
        [(i, str(sorted(p.items())), float(auc)) for i, (p, auc) in enumerate(ranked)],
        "rank int, params string, mean_auc double")


@query("m9_expanding_folds", """
    select cast(0 as integer) as block, count(*) - 3 * (count(*) // 4) as n from t_split
    where split = 'train'
    union all select b, n from (select unnest([1, 2, 3]) as b, count(*) // 4 as n
                                from t_split where split = 'train')""")
def m9_folds(spark, sf):
    x = Inputs(spark, sf)
    loans = x.labels.select(*KEYS, "loan_id", "label")
    applied = x.applications.withColumn("snapshot_date", F.add_months("snapshot_date", 6))
    rows = align.temporal_split(applied.join(loans, KEYS), align.Windows.before(TRAIN_DATE)).where(
        F.col("split") == "train")
    # One key per row, so that the cuts fall exactly between rows.
    return align.expanding_folds(rows, key="loan_id").groupBy("block").agg(
        F.count(F.lit(1)).alias("n"))


@query("m10_platt_calibrate")
def m10(spark, sf):
    """All matched scores, calibrated by a sigmoid that is fitted on the test split alone."""
    x = Inputs(spark, sf)
    matched = scoring.with_outcomes(x.predictions, x.labels)
    gbt = matched.where(F.col("model_name").contains("gbt"))
    test = align.temporal_split(gbt, align.Windows.before(TRAIN_DATE)).where(
        F.col("split") == "test")
    slope, intercept = models.fit_platt(test, "model_predictions")
    return gbt.select(*KEYS, "label", "model_predictions", models.sigmoid(
        F.col("model_predictions") * slope + intercept).alias("calibrated"))


@query("m10_platt_targets", """
    select score, label, round(case when label = 1 then w else pos + neg - w end, 6) as weight
    from (select c.*, l.label,
                 pos * (t.p + 1e0) / (t.p + 2e0) + neg * 1e0 / (t.n + 2e0) as w
          from (select model_predictions as score, sum(label) as pos, sum(1 - label) as neg
                from t_matched where model_name = 'credit_gbt_1996_01_01' group by 1) c,
               (select sum(label) as p, sum(1 - label) as n from t_matched
                where model_name = 'credit_gbt_1996_01_01') t,
               (select unnest([0, 1]) as label) l) x""")
def m10_targets(spark, sf):
    x = Inputs(spark, sf)
    matched = scoring.with_outcomes(
        x.predictions.where(F.col("model_name") == "credit_gbt_1996_01_01"), x.labels)
    counts = metrics.score_counts(matched, [])
    return models.platt_targets(counts).select("score", "label",
                                               F.round("weight", 6).alias("weight"))


@query("m11_batch_score", """
    select Customer_ID, cast(a.snapshot_date + to_months(6) as date) as snapshot_date,
           'credit_logreg_1998_09_01' as model_name, round(score, 6) as model_predictions,
           case when score >= 0.5 then 1 else 0 end as prediction_label
    from (select a.*, 1e0 / (1e0 + exp(-(-0.4e0 + 0.8e0 * (loan_amt - mean) / std
                                         + 0.3e0 * (tenure - tenure_mean)))) as score
          from t_applications a, t_train_scale s) a""")
def m11(spark, sf):
    """Scores every application with given coefficients and a scaler fitted on the train split."""
    x = Inputs(spark, sf)
    columns = ["loan_amt", "tenure"]
    scaler = models.fit_scaler(frame(x).where(F.col("split") == "train"), columns)
    rows = scoring.align_to_model(x.applications, columns)
    score = models.linear_score(columns, [0.8, 0.3], -0.4, scaler)
    out = scoring.prediction_rows(rows, "credit_logreg_1998_09_01", score, label_months=6)
    return out.withColumn("model_predictions", F.round("model_predictions", 6))


@query("m12_save_oot_scores")
def m12(spark, sf):
    rows, artefact = fitted(Inputs(spark, sf), "logreg")
    root = session.kept_folder(spark, "oot")
    train.write_predictions(train.oot_predictions(artefact, rows), root)
    return spark.read.parquet(f"{root}/gold/model_predictions")


@query("m13_champion_select", """
    select max(case when r = 1 then model_version end) as champion,
           max(case when r = 2 then model_version end) as runner_up,
           round(max(auc_oot), 6) as auc_oot, round(max(auc_oot) - min(auc_oot), 6) as margin
    from (select *, row_number() over (order by auc_oot desc, position) as r
          from t_candidates) x""")
def m13(spark, sf):
    return models.champion(candidates(Inputs(spark, sf))).select(
        "champion", "runner_up", F.round("auc_oot", 6).alias("auc_oot"),
        F.round("margin", 6).alias("margin"))


@query("m14_model_persist")
def m14(spark, sf):
    """Stores a fitted model, loads it again and scores the out-of-time rows with it."""
    rows, artefact = fitted(Inputs(spark, sf), "gbt")
    root = session.kept_folder(spark, "bank")
    artefact.save(spark, root)
    loaded = models.load(spark, root, artefact.model_version)
    return train.oot_predictions(loaded, rows)


_OOT = """
    select count(*) as n, count(distinct snapshot_date) as n_months
    from t_aligned where snapshot_date between date '1998-07-01' and date '1998-08-31'"""


@query("m12_oot_score_counts", f"select 'credit_logreg_1998_09_01_tt24m' as model_name, n, n_months, "
       f"n as n_verdicts from ({_OOT}) x")
def m12_counts(spark, sf):
    """The stored out-of-time scores: one per application with an outcome, with its verdict."""
    score = F.col("model_predictions")
    return m12(spark, sf).groupBy("model_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("snapshot_date").alias("n_months"),
        F.count_if((score >= 0.5) == (F.col("prediction_label") == 1)).alias("n_verdicts"))


@query("m14_reload_equal", f"select n, n as n_equal from ({_OOT}) x")
def m14_equal(spark, sf):
    """A stored and loaded model gives the scores it gave before."""
    rows, artefact = fitted(Inputs(spark, sf), "gbt")
    root = session.kept_folder(spark, "bank")
    artefact.save(spark, root)
    loaded = models.load(spark, root, artefact.model_version)
    oot = rows.where(F.col("split") == "oot").withColumn("_row", F.monotonically_increasing_id())
    both = artefact.scores(oot).select("_row", F.col("score").alias("a")).join(
        loaded.scores(oot).select("_row", F.col("score").alias("b")), "_row")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias(
        "n_equal"))


@query("m15_feature_importance")
def m15(spark, sf):
    _, artefact = fitted(Inputs(spark, sf), "gbt")
    table = models.importance_table(spark, artefact.feature_columns, artefact.importances)
    return models.top_features(table, drift.TOP_FEATURES)


@query("m15_importance_ranks", "select unnest([" + ", ".join(f"'{c}'" for c in FEATURES)
       + f"]) as feature, cast({len(FEATURES)} as bigint) as n_features, true as in_order, true as shares_sum_to_one")
def m15_ranks(spark, sf):
    """Every model input has its place: ranks go from 1 to n, none is above a more important one, and the
    shares sum to one."""
    _, artefact = fitted(Inputs(spark, sf), "gbt")
    ranked = models.ranks(models.importance_table(
        spark, artefact.feature_columns, artefact.importances).withColumn(
        "model_name", F.lit(artefact.model_version)))
    # One row per model input.
    one, by_rank = Window.partitionBy("model_name"), Window.partitionBy("model_name").orderBy("rank")
    n = F.count(F.lit(1)).over(one)
    above = F.coalesce(F.lag("importance").over(by_rank), "importance")
    return ranked.select(
        "feature", n.alias("n_features"),
        ((F.max("rank").over(one) == n) & (F.row_number().over(by_rank) == F.col("rank"))
         & (above >= F.col("importance"))).alias("in_order"),
        (F.abs(F.sum("importance").over(one) - 1) < 1e-9).alias("shares_sum_to_one"))


def same_month(x: Inputs):
    """The early variant around the training date, with its frame."""
    windows = align.Windows.before(TRAIN_DATE, tt_months=24)
    rows = train.same_month_frame(x.clickstream, x.labels, windows)
    return rows, train.fit_same_month(rows, TRAIN_DATE, {"n_estimators": 10, "max_depth": 2})


@query("m16_out_of_time", """
    select s.split, cast(sum(s.n) as bigint) as n, cast(sum(s.n * label) as bigint) as n_pos, true as in_range
    from (select label, unnest(['train', 'test']) as split,
                 unnest([count(*) - ceil(count(*) * 0.2e0), ceil(count(*) * 0.2e0)]) as n
          from t_labels where snapshot_date between date '1996-07-01' and date '1998-06-30' group by label
          union all
          select label, 'oot', count(*) from t_labels
          where snapshot_date between date '1998-07-01' and date '1998-08-31' group by label) s
    group by 1""")
def m16_oot(spark, sf):
    """Random train and test rows before the out-of-time window, and what is measured on all three."""
    rows, artefact = same_month(Inputs(spark, sf))
    names = ("auc", "precision", "recall", "f1", "brier")
    sound = F.create_map(*[F.lit(v) for s in ("train", "test", "oot") for v in (s, all(
        0 <= artefact.results[f"{m}_{s}"] <= 1 for m in names if f"{m}_{s}" in artefact.results))])
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("n_pos")).withColumn(
        "in_range", sound[F.col("split")])


@query("m16_raw_month", """
    select Customer_ID, snapshot_date, 'credit_clicks_1998_09_01' as model_name, true as in_range
    from t_clickstream where snapshot_date = date '1998-09-01'""")
def m16_raw(spark, sf):
    """One month of raw clickstream is cleaned and scored by the early variant."""
    x = Inputs(spark, sf)
    clicks = clean.clean_clickstream(x.raw("clickstream"))
    return train.score_same_month(same_month(x)[1], clicks, "1998-09-01").select(
        *KEYS, "model_name", F.col("model_predictions").between(0, 1).alias("in_range"))


@query("m16_clickstream_only_model")
def m16(spark, sf):
    """The early variant: same-month clickstream only, random split, trees on fe_ columns."""
    x = Inputs(spark, sf)
    joined = align.align_same_month(x.labels, x.clickstream)
    columns = [c for c in joined.columns if c.startswith("fe_")]
    filled, _ = session.stage(align.stratified_split(impute.fill_constant(joined, 0, columns)),
                              "same_month")
    learn = filled.where(F.col("split") == "train")
    prepare = models.Pipeline(stages=models.input_stages(models.fit_scaler(learn, columns))).fit(
        learn)
    model = models.gbt({"n_estimators": 10, "max_depth": 2}).fit(prepare.transform(learn))
    scored = model.transform(prepare.transform(filled)).select(
        "split", "label", vector_to_array("probability")[1].alias("score"))
    return metrics.classification_metrics(scored, ["split"], "score")


# --- metrics -------------------------------------------------------------------------------------

def quality(x: Inputs):
    return metrics.classification_metrics(
        scoring.with_month_outcomes(x.predictions, x.labels), ["model_name", "snapshot_date"])


def _metric_query(name: str, columns: list[str], derived: str | None = None):
    sql = "select model_name, snapshot_date, " + ", ".join(
        f"{steady_sql(derived or c)} as {c}" for c in columns) + " from t_quality"

    @query(name, sql)
    def run(spark, sf):
        return quality(Inputs(spark, sf)).select(
            "model_name", "snapshot_date", *[steady(c) for c in columns])


_metric_query("e1_roc_auc", ["auc"])
_metric_query("e2_gini", ["gini"], "2 * auc - 1")
_metric_query("e3_precision_recall_f1", ["precision", "recall", "f1"])
_metric_query("e4_brier", ["brier"])

shared("t_reliability_edges", edges_sql("model_name", "model_predictions", "select * from t_matched"))


@query("e5_reliability_curve", f"""
    select model_name, bin, count(*) as n,
           {steady_sql('avg(model_predictions)')} as mean_predicted,
           round(avg(label), 6) as observed_rate
    from (select m.*, {bin_number('m.model_predictions', test='>')} as bin
          from t_matched m join t_reliability_edges e on e.model_name = m.model_name) x
    group by 1, 2""")
def e5(spark, sf):
    x = Inputs(spark, sf)
    matched = scoring.with_month_outcomes(x.predictions, x.labels)
    return metrics.reliability(matched, ["model_name"]).select(
        "model_name", "bin", "n", steady("mean_predicted"),
        F.round("observed_rate", 6).alias("observed_rate"))


shared("t_scored_split", """
    select p.model_predictions as score, l.label,
           case when l.snapshot_date between date '1998-07-01' and date '1998-08-31' then 'oot'
                when l.snapshot_date between date '1997-07-01' and date '1998-04-30' then 'train'
                when l.snapshot_date between date '1998-05-01' and date '1998-06-30' then 'test'
           end as split, p.model_name
    from t_predictions p join t_labels l
      on l.Customer_ID = p.Customer_ID and l.snapshot_date = p.snapshot_date""")
shared("t_split_ranked", """
    select *, sum(neg) over (partition by model_name, split order by score
                             rows between unbounded preceding and 1 preceding) as below
    from (select model_name, split, score, sum(label) as pos, sum(1 - label) as neg
          from t_scored_split where split is not null group by 1, 2, 3) c""")


@query("m10_platt_first_order", """
    select count(*) as n, cast(sum(label) as bigint) as n_pos, true as slope_zero,
           true as intercept_zero, true as order_kept
    from t_scored_split where split = 'test' and model_name = 'credit_gbt_1996_01_01'""")
def m10_first_order(spark, sf):
    """The calibration is fitted on the test split: both derivatives of its loss are zero, and a
    higher score stays a higher probability."""
    x = Inputs(spark, sf)
    rows = align.temporal_split(scoring.with_outcomes(
        x.predictions.where(F.col("model_name") == "credit_gbt_1996_01_01"), x.labels),
        align.Windows.before(TRAIN_DATE)).where(F.col("split") == "test")
    slope, intercept = models.fit_platt(rows, "model_predictions")
    counts = metrics.score_counts(rows, [])
    error = F.col("weight") * (models.sigmoid(F.col("score") * slope + intercept) - F.col("label"))
    sums = models.platt_targets(counts).agg(
        F.sum(error).alias("a"), F.sum(error * F.col("score")).alias("b"))
    totals = counts.agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("n_pos"))
    return totals.join(sums).select(
        "n", "n_pos", (F.abs("b") < 1e-4 * F.col("n")).alias("slope_zero"),
        (F.abs("a") < 1e-4 * F.col("n")).alias("intercept_zero"),
        F.lit(slope > 0).alias("order_kept"))


@query("e6_metrics_by_split", """
    select model_name, split, cast(sum(pos) + sum(neg) as bigint) as n,
           round(sum(cast(pos as double) * (coalesce(below, 0) + neg / 2e0))
                 / (cast(sum(pos) as double) * cast(sum(neg) as double)), 6) as auc,
           round(coalesce(sum(case when score >= 0.5 then pos end) * 1e0
                 / nullif(sum(case when score >= 0.5 then pos + neg end), 0), 0), 6) as precision,
           round(coalesce(sum(case when score >= 0.5 then pos end) * 1e0 / sum(pos), 0), 6)
             as recall,
           round(2 * sum(cast(pos as double) * (coalesce(below, 0) + neg / 2e0))
                 / (cast(sum(pos) as double) * cast(sum(neg) as double)) - 1, 6) as gini,
           round(2e0 * coalesce(sum(case when score >= 0.5 then pos end), 0)
                 / nullif(coalesce(sum(case when score >= 0.5 then pos + neg end), 0)
                          + sum(pos), 0), 6) as f1,
           round(sum(pos * (1 - score) * (1 - score) + neg * score * score)
                 / sum(pos + neg), 6) as brier
    from t_split_ranked group by 1, 2""")
def e6(spark, sf):
    x = Inputs(spark, sf)
    rows = align.temporal_split(scoring.with_outcomes(x.predictions, x.labels),
                                align.Windows.before(TRAIN_DATE))
    return metrics.classification_metrics(rows, ["model_name", "split"]).select(
        "model_name", "split", "n", *[F.round(c, 6).alias(c)
                                      for c in (
            "auc", "precision", "recall", "gini", "f1", "brier")])


@query("e7_confusion_free_guard", """
    select split, one_class, count(*) as n, cast(sum(label) as bigint) as n_pos,
           case when count(distinct label) = 2 then 1 else 0 end as has_metrics
    from (select *, case when one_class = 1 then 0 else label0 end as label
          from (select split, label as label0, unnest([0, 1]) as one_class from t_split
                where split is not null) a) b
    group by 1, 2""")
def e7(spark, sf):
    """Every split once as it is and once with all outcomes good: the latter must have none."""
    rows = frame(Inputs(spark, sf)).select(
        "split", "loan_amt", "label", F.explode(F.array(F.lit(0), F.lit(1))).alias("one_class"))
    guarded = rows.withColumn("label", F.when(F.col("one_class") == 1, 0).otherwise(
        F.col("label"))).withColumn("score", F.col("loan_amt") / (F.col("loan_amt") + 250000.0))
    found = metrics.classification_metrics(guarded, ["split", "one_class"], "score")
    known = [F.col(c).isNotNull() for c in ("auc", "precision", "recall", "f1", "brier")]
    every = known[0]
    for k in known[1:]:
        every = every & k
    return found.select("split", "one_class", "n", "n_pos", every.cast("int").alias("has_metrics"))
