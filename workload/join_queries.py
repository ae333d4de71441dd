"""Joins (J), aggregations (A), ordering and per-model picks (W), and the UDF replacements (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import schemas
from creditloom.functions import loans
from creditloom.functions.ranks import column_quantiles
from creditloom.operators import align, drift, impute, loan_types, metrics, models, scoring
from creditloom.operators import point_in_time as pit
from workload.inputs import LOAN_COLUMNS, Inputs
from workload.registry import edges_sql, query, shared, steady, steady_sql
from workload.tables import FE

KEYS = ["Customer_ID", "snapshot_date"]


def _latest_sql(table: str, columns: str) -> str:
    """The latest row of `table` dated on or before each application."""
    return f"""
    select a.Customer_ID, a.snapshot_date, a.loan_amt, a.tenure, s.source_date, {columns}
    from t_applications a left join (
      select x.Customer_ID as cid, x.snapshot_date as ad, y.* exclude (Customer_ID, snapshot_date),
             y.snapshot_date as source_date,
             row_number() over (partition by x.Customer_ID, x.snapshot_date
                                order by y.snapshot_date desc) as rn
      from t_applications x join {table} y
        on x.Customer_ID = y.Customer_ID and y.snapshot_date <= x.snapshot_date) s
      on s.cid = a.Customer_ID and s.ad = a.snapshot_date and s.rn = 1"""


FINANCE = ["Annual_Income", "Num_of_Loan", "Outstanding_Debt", "Credit_History_Age", "Credit_Mix"]


@query("j1_applications_financials", _latest_sql(
    "t_financial_values", ", ".join(f"s.{c}" for c in FINANCE)))
def j1(spark, sf):
    x = Inputs(spark, sf)
    return pit.as_of(x.applications, {"source": x.financial_values.select(*KEYS, *FINANCE)},
                     dates=True)


@query("j2_applications_attributes", _latest_sql("t_attributes", "s.Age, s.Occupation"))
def j2(spark, sf):
    x = Inputs(spark, sf)
    return pit.as_of(x.applications, {"source": x.attributes.select(*KEYS, "Age", "Occupation")},
                     dates=True)


@query("j3_applications_loan_type", _latest_sql(
    "t_loan_type", ", ".join(f's."{c}"' for c in LOAN_COLUMNS)))
def j3(spark, sf):
    x = Inputs(spark, sf)
    return pit.as_of(x.applications, {"source": x.loan_type}, dates=True)


shared("t_latest_application", """
    select Customer_ID, max(snapshot_date) as application_date from t_applications group by 1""")


@query("j4_history_inner_join", """
    select c.*, a.application_date from t_clickstream c join t_latest_application a on a.Customer_ID = c.Customer_ID""")
def j4(spark, sf):
    x = Inputs(spark, sf)
    return pit.history_of(x.clickstream, pit.latest_application(x.applications))


@query("j5_history_range_predicate", """
    select c.*, a.application_date from t_clickstream c join t_latest_application a
      on a.Customer_ID = c.Customer_ID and c.snapshot_date <= a.application_date""")
def j5(spark, sf):
    x = Inputs(spark, sf)
    return pit.history_until(x.clickstream, pit.latest_application(x.applications))


ROUNDED_FE = ", ".join(f"round({f}, 6) as {f}" for f in FE)


@query("j6_applications_clickstream", f"""
    select Customer_ID, snapshot_date, {ROUNDED_FE} from t_history_mean""")
def j6(spark, sf):
    x = Inputs(spark, sf)
    return pit.history_mean(x.applications, x.clickstream, FE).select(
        *KEYS, *[F.round(f, 6).alias(f) for f in FE])


shared("t_aligned", """
    select a.Customer_ID, cast(a.snapshot_date + to_months(6) as date) as snapshot_date,
           a.loan_amt, a.tenure, l.label
    from t_applications a join t_labels l on l.Customer_ID = a.Customer_ID
     and l.snapshot_date = cast(a.snapshot_date + to_months(6) as date)""")


@query("j7_offset_aligned_join", """
    select * from t_aligned
    where snapshot_date between date '1996-01-01' and date '2001-06-30'""")
def j7(spark, sf):
    x = Inputs(spark, sf)
    return align.align_offset(x.applications, x.labels, "1996-01-01", "2001-06-30")


@query("j8_same_month_join", """
    select l.Customer_ID, l.snapshot_date, l.loan_id, l.label, l.label_def,
           c.* exclude (Customer_ID, snapshot_date)
    from t_labels l left join t_clickstream c
      on c.Customer_ID = l.Customer_ID and c.snapshot_date = l.snapshot_date""")
def j8(spark, sf):
    x = Inputs(spark, sf)
    return align.align_same_month(x.labels, x.clickstream)


@query("j9_as_of_join", """
    select a.Customer_ID, a.snapshot_date, f.snapshot_date as financials_date, f.Outstanding_Debt,
           t.snapshot_date as attributes_date, t.Age
    from t_applications a
    asof left join t_financial_values f
      on f.Customer_ID = a.Customer_ID and f.snapshot_date <= a.snapshot_date
    asof left join t_attributes t
      on t.Customer_ID = a.Customer_ID and t.snapshot_date <= a.snapshot_date""")
def j9(spark, sf):
    x = Inputs(spark, sf)
    return pit.as_of(x.applications.select(*KEYS), {
        "financials": x.financial_values.select(*KEYS, "Outstanding_Debt"),
        "attributes": x.attributes.select(*KEYS, "Age")}, dates=True)


@query("j10_predictions_labels", """
    select p.Customer_ID, p.snapshot_date, p.model_name, p.model_predictions, l.label
    from t_predictions p join t_labels l
      on l.Customer_ID = p.Customer_ID and l.snapshot_date = p.snapshot_date""")
def j10(spark, sf):
    x = Inputs(spark, sf)
    return scoring.with_outcomes(x.predictions, x.labels).select(
        *KEYS, "model_name", "model_predictions", "label")


shared("t_matched", """
    with direct as (
      select p.Customer_ID, p.snapshot_date, p.model_name, p.model_predictions, l.label
      from t_predictions p join t_labels l
        on l.Customer_ID = p.Customer_ID and l.snapshot_date = p.snapshot_date)
    select * from direct
    union all
    select p.Customer_ID, p.snapshot_date, p.model_name, p.model_predictions, l.label
    from t_predictions p join t_labels l on l.Customer_ID = p.Customer_ID
     and l.snapshot_date = cast(p.snapshot_date + to_months(6) as date)
    where not exists (select 1 from direct d where d.model_name = p.model_name
                      and d.snapshot_date = p.snapshot_date)""")


@query("j11_offset_fallback_join", "select * from t_matched")
def j11(spark, sf):
    x = Inputs(spark, sf)
    return scoring.with_month_outcomes(x.predictions, x.labels).select(
        *KEYS, "model_name", "model_predictions", "label")


# Baseline deciles of each model's first month, and rows per bin and month.
shared("t_first_month", """
    select model_name, min(snapshot_date) as baseline_date from t_predictions group by 1""")
shared("t_edges", edges_sql("model_name", "model_predictions", """
    select p.model_name, model_predictions from t_predictions p join t_first_month f
      on f.model_name = p.model_name and f.baseline_date = p.snapshot_date"""))


def bin_number(value: str, edges: str = "e.edges", test: str = ">=") -> str:
    return " + ".join(
        f"(case when {value} {test} {edges}[{i}] then 1 else 0 end)" for i in range(1, 10))


shared("t_bins", f"""
    select p.model_name, p.snapshot_date, {bin_number('model_predictions')} as bin, count(*) as n
    from t_predictions p join t_edges e on e.model_name = p.model_name group by 1, 2, 3""")


def _bin_columns(alias: str, prefix: str) -> str:
    return ", ".join(
        f"cast(coalesce(sum(case when {alias}.bin = {b} then {alias}.n end), 0) as bigint)"
        f" as {prefix}_{b}" for b in range(10))


@query("j12_baseline_current", f"""
    select c.*, b.* exclude (model_name)
    from (select model_name, snapshot_date, {_bin_columns('t_bins', 'actual')}
          from t_bins group by 1, 2) c
    join (select t_bins.model_name, {_bin_columns('t_bins', 'expected')}
          from t_bins join t_first_month f
            on f.model_name = t_bins.model_name and f.baseline_date = t_bins.snapshot_date
          group by 1) b on b.model_name = c.model_name""")
def j12(spark, sf):
    p = Inputs(spark, sf).predictions
    pairs = drift.binned_pairs(p, drift.first_month_rows(p), ["model_name"], ["snapshot_date"],
                               "model_predictions")
    return pairs.select("model_name", "snapshot_date",
                        *[F.col(f"a.bin_{b}").alias(f"actual_{b}") for b in range(10)],
                        *[F.col(f"e.bin_{b}").alias(f"expected_{b}") for b in range(10)])


# --- aggregations --------------------------------------------------------------------------------

@query("a1_history_mean", "select c.Customer_ID, " + ", ".join(
    f"round(avg({f}), 6) as {f}" for f in FE) + """
    from t_clickstream c join t_latest_application a
      on a.Customer_ID = c.Customer_ID and c.snapshot_date <= a.application_date group by 1""")
def a1(spark, sf):
    x = Inputs(spark, sf)
    rows = pit.history_until(x.clickstream, pit.latest_application(x.applications))
    return rows.groupBy("Customer_ID").agg(*[F.round(F.avg(f), 6).alias(f) for f in FE])


@query("a2_multi_column_median", "select 'clickstream' as scope, " + ", ".join(
    f"cast(quantile_disc({f}, 0.5e0) as double) as {f}" for f in FE) + " from t_clickstream")
def a2(spark, sf):
    rows = Inputs(spark, sf).clickstream.withColumn("scope", F.lit("clickstream"))
    return column_quantiles(rows, ["scope"], FE, [0.5], exact=True).select(
        "scope", *[F.col(f)[0].alias(f) for f in FE])


@query("a3_percentile_97", "select snapshot_date, " + ", ".join(
    f"cast({c} as double) as {c}" for c in schemas.CLIPPED) + " from t_limits")
def a3(spark, sf):
    return column_quantiles(Inputs(spark, sf).financial_values, ["snapshot_date"],
                            schemas.CLIPPED, [0.97], exact=True).select(
        "snapshot_date", *[F.col(c)[0].alias(c) for c in schemas.CLIPPED])


TOKEN_COUNTS = """
    select Customer_ID, snapshot_date, token as loan_type, cast(count(*) as integer) as n
    from t_tokens group by 1, 2, 3"""


@query("a4_token_frequency", TOKEN_COUNTS)
def a4(spark, sf):
    return loan_types.loan_type_long(Inputs(spark, sf).raw("financials"))


@query("a5_distinct_keys", "select distinct snapshot_date, token as loan_type from t_tokens")
def a5(spark, sf):
    return loan_types.distinct_loan_types(Inputs(spark, sf).raw("financials"), ["snapshot_date"])


@query("a6_frequency_pivot", "select * from t_loan_type")
def a6(spark, sf):
    return Inputs(spark, sf).loan_type


@query("a7_dedup_by_key", """
    select * exclude (rn) from (
      select Customer_ID, loan_id, loan_amt, loan_start_date,
             row_number() over (partition by Customer_ID order by loan_id) as rn
      from t_lms where mob = 0) x where rn = 1""")
def a7(spark, sf):
    rows = Inputs(spark, sf).lms.where(F.col("mob") == 0).select(
        "Customer_ID", "loan_id", "loan_amt", "loan_start_date")
    return pit.one_row_per(rows, ["Customer_ID"], order="loan_id")


@query("a8_non_null_profile", "select snapshot_date, " + ", ".join(
    f"count({c}) as {c}" for c in schemas.FINANCIAL_NUMBERS)
    + " from t_financial_values group by 1")
def a8(spark, sf):
    return impute.non_null_profile(Inputs(spark, sf).financial_values,
                                   list(schemas.FINANCIAL_NUMBERS))


@query("a9_rate_by_group", """
    select mob, round(avg(case when dpd >= 30 then 1e0 else 0e0 end), 6) as bad_rate
    from t_lms group by 1 order by 1""")
def a9(spark, sf):
    flagged = Inputs(spark, sf).lms.select("mob", loans.past_due_flag(F.col("dpd"), 30).alias("f"))
    return flagged.groupBy("mob").agg(F.round(F.avg("f"), 6).alias("bad_rate")).orderBy("mob")


@query("a10_score_summary", f"""
    select model_name, snapshot_date, count(*) as n_scored,
           {steady_sql('avg(model_predictions)')} as mean_score
    from t_predictions group by 1, 2""")
def a10(spark, sf):
    return metrics.score_summary(Inputs(spark, sf).predictions).select(
        "model_name", "snapshot_date", "n_scored", steady("mean_score"))


@query("a11_predicted_default_rate", """
    select model_name, snapshot_date, cast(sum(prediction_label) as bigint) as n_default,
           round(avg(prediction_label), 6) as default_rate
    from t_predictions group by 1, 2""")
def a11(spark, sf):
    return metrics.score_summary(Inputs(spark, sf).predictions).select(
        "model_name", "snapshot_date", "n_default",
        F.round("default_rate", 6).alias("default_rate"))


@query("a12_class_count_guard", f"""
    select model_name, snapshot_date, count(*) as n, cast(sum(label) as bigint) as n_pos,
           case when count(distinct label) = 2
                then {steady_sql('avg((model_predictions - label) * (model_predictions - label))')} end
             as brier
    from t_matched group by 1, 2""")
def a12(spark, sf):
    x = Inputs(spark, sf)
    per_month = metrics.classification_metrics(
        scoring.with_month_outcomes(x.predictions, x.labels), ["model_name", "snapshot_date"])
    return per_month.select(
        "model_name", "snapshot_date", "n", "n_pos", steady("brier"))


shared("t_split", """
    select *, case when snapshot_date between date '1998-07-01' and date '1998-08-31' then 'oot'
                   when snapshot_date between date '1997-07-01' and date '1998-04-30' then 'train'
                   when snapshot_date between date '1998-05-01' and date '1998-06-30' then 'test'
              end as split
    from t_aligned""")


@query("a13_split_stats", """
    select split, count(*) as n, round(avg(label), 6) as bad_rate
    from t_split where split is not null group by 1""")
def a13(spark, sf):
    x = Inputs(spark, sf)
    frame = align.temporal_split(align.align_offset(x.applications, x.labels),
                                 align.Windows.before("1998-09-01"))
    return align.split_stats(frame).select("split", "n", F.round("bad_rate", 6).alias("bad_rate"))


@query("a14_importance_share", """
    select count(*) as n_features,
           round(sum(case when rn <= 15 then importance end) / sum(importance), 6) as top_share
    from (select *, row_number() over (order by importance desc, position) as rn
          from t_importance) x""")
def a14(spark, sf):
    return models.importance_share(Inputs(spark, sf).importance, 15).select(
        "n_features", F.round("top_share", 6).alias("top_share"))


# --- picks and order -----------------------------------------------------------------------------

shared("t_summary", f"""
    select model_name, snapshot_date, count(*) as n_scored,
           {steady_sql('avg(model_predictions)')} as mean_score
    from t_predictions group by 1, 2""")


def _summary(x: Inputs):
    return metrics.score_summary(x.predictions).select(
        "model_name", "snapshot_date", "n_scored", steady("mean_score"))


@query("w1_first_scored_baseline", """
    select p.model_name, p.snapshot_date, p.Customer_ID, p.model_predictions
    from t_predictions p join t_first_month f
      on f.model_name = p.model_name and f.baseline_date = p.snapshot_date""")
def w1(spark, sf):
    return drift.first_month_rows(Inputs(spark, sf).predictions).select(
        "model_name", "snapshot_date", "Customer_ID", "model_predictions")


@query("w2_latest_row", """
    select * exclude (rn) from (
      select *, row_number() over (partition by model_name order by snapshot_date desc) as rn
      from t_summary) x where rn = 1""")
def w2(spark, sf):
    return drift.latest_row(_summary(Inputs(spark, sf)))


@query("w3_previous_month_lookup", """
    select m.model_name, m.snapshot_date as ds, p.snapshot_date, p.n_scored, p.mean_score
    from t_summary m left join t_summary p on p.model_name = m.model_name
     and cast(p.snapshot_date + to_months(1) as date) = m.snapshot_date""")
def w3(spark, sf):
    summary = _summary(Inputs(spark, sf))
    months = summary.select("model_name", F.col("snapshot_date").alias("ds"))
    return drift.previous_month(summary, months)


@query("w4_date_sort", """
    select model_name, snapshot_date, n_scored, mean_score from t_summary
    order by model_name, snapshot_date""")
def w4(spark, sf):
    return _summary(Inputs(spark, sf)).orderBy("model_name", "snapshot_date")


@query("w5_top_n_features", """
    select feature, cast(position as integer) as position, importance from t_importance
    order by importance desc, position limit 15""")
def w5(spark, sf):
    return models.top_features(Inputs(spark, sf).importance, 15)


shared("t_auc_ranked", """
    select *, sum(neg) over (partition by model_name, snapshot_date order by score
                             rows between unbounded preceding and 1 preceding) as below
    from (select model_name, snapshot_date, model_predictions as score,
                 sum(label) as pos, sum(1 - label) as neg
          from t_matched group by 1, 2, 3) c""")
shared("t_quality", """
    select model_name, snapshot_date, cast(sum(pos) + sum(neg) as bigint) as n,
           cast(sum(pos) as bigint) as n_pos,
           case when sum(pos) > 0 and sum(neg) > 0 then
             sum(cast(pos as double) * (coalesce(below, 0) + neg / 2e0))
             / (cast(sum(pos) as double) * cast(sum(neg) as double)) end as auc,
           case when sum(pos) > 0 and sum(neg) > 0 then
             sum(pos * (1 - score) * (1 - score) + neg * score * score) / (sum(pos) + sum(neg)) end
             as brier,
           case when sum(pos) > 0 and sum(neg) > 0 then
             coalesce(sum(case when score >= 0.5 then pos end) * 1e0
                      / nullif(sum(case when score >= 0.5 then pos + neg end), 0), 0) end
             as precision,
           case when sum(pos) > 0 and sum(neg) > 0 then
             coalesce(sum(case when score >= 0.5 then pos end) * 1e0 / sum(pos), 0) end as recall,
           case when sum(pos) > 0 and sum(neg) > 0 then
             coalesce(2e0 * sum(case when score >= 0.5 then pos end)
                      / (coalesce(sum(case when score >= 0.5 then pos + neg end), 0) + sum(pos)), 0)
             end as f1
    from t_auc_ranked group by 1, 2""")
shared("t_candidates", """
    select model_name as model_version, max(case when model_name like '%gbt%' then 1 else 2 end)
             as position, avg(auc) as auc_oot
    from t_quality where snapshot_date between date '1998-07-01' and date '1998-08-31'
    group by 1""")


def candidates(x: Inputs):
    """Both models' mean AUC over the out-of-time months."""
    per_month = metrics.classification_metrics(
        scoring.with_month_outcomes(x.predictions, x.labels), ["model_name", "snapshot_date"])
    window = align.Windows.before("1998-09-01")
    return (per_month
            .where(F.col("snapshot_date").between(F.lit(window.oot_start), F.lit(window.oot_end)))
            .groupBy(F.col("model_name").alias("model_version"))
            .agg(F.avg("auc").alias("auc_oot"))
            .withColumn("position", F.when(F.col("model_version").contains("gbt"), 1)
                        .otherwise(2)))


@query("w6_argmax_model", """
    select model_version as champion, round(auc_oot, 6) as auc_oot from t_candidates
    order by t_candidates.auc_oot desc, position limit 1""")
def w6(spark, sf):
    return models.champion(candidates(Inputs(spark, sf))).select(
        "champion", F.round("auc_oot", 6).alias("auc_oot"))


# --- what replaced the Python UDFs ---------------------------------------------------------------

@query("u1_token_map", """
    select r.Customer_ID, r.snapshot_date, coalesce(t.counts, '') as counts
    from (select Customer_ID, try_cast(snapshot_date as date) as snapshot_date
          from t_financials_raw) r
    left join (select Customer_ID, snapshot_date,
                      string_agg(loan_type || '=' || n, ';' order by loan_type) as counts
               from (""" + TOKEN_COUNTS + """) c group by 1, 2) t
      on t.Customer_ID = r.Customer_ID and t.snapshot_date = r.snapshot_date""")
def u1(spark, sf):
    counts = loan_types.loan_type_counts(Inputs(spark, sf).raw("financials"))
    pairs = F.transform(F.array_sort(F.map_entries("loan_type_counts")),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return counts.select(*KEYS, F.array_join(pairs, ";").alias("counts"))


@query("u3_distinct_tokens", "select distinct token as loan_type from t_tokens")
def u3(spark, sf):
    return loan_types.distinct_loan_types(Inputs(spark, sf).raw("financials"))


