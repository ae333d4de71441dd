"""Projections, filters and cleaning (P), loan derivations (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import schemas
from creditloom.functions import loans, text
from creditloom.functions.loans import credit_ratios
from creditloom.operators import clean, encode, impute, metrics, point_in_time, scoring
from workload.inputs import NUMBERS_SQL, Inputs
from workload.registry import query, shared
from workload.tables import FE

FE_LIST = ", ".join(FE)


@query("p1_snapshot_filter", """
    select loan_id, Customer_ID, installment_num, overdue_amt, snapshot_date
    from t_lms_typed where snapshot_date = date '1998-06-01'""")
def p1(spark, sf):
    typed = clean.typed(Inputs(spark, sf).raw("lms"), schemas.LMS)
    return clean.at_snapshot(typed, "1998-06-01").select(
        "loan_id", "Customer_ID", "installment_num", "overdue_amt", "snapshot_date")


@query("p2_typed_projection", "select * from t_lms_typed")
def p2(spark, sf):
    return clean.typed(Inputs(spark, sf).raw("lms"), schemas.LMS)


@query("p3_numeric_extract", f"""
    select Customer_ID, snapshot_date, {NUMBERS_SQL} from t_financials_raw""")
def p3(spark, sf):
    return Inputs(spark, sf).raw("financials").select(
        "Customer_ID", "snapshot_date",
        *[text.number(F.col(c), t).alias(c) for c, t in schemas.FINANCIAL_NUMBERS.items()])


@query("p4_range_to_null", "select Customer_ID, Age from t_attributes")
def p4(spark, sf):
    return Inputs(spark, sf).raw("attributes").select(
        "Customer_ID", text.only_between(text.number(F.col("Age"), "int"), 0, 120).alias("Age"))


@query("p5_format_validate", "select Customer_ID, SSN from t_attributes")
def p5(spark, sf):
    return Inputs(spark, sf).raw("attributes").select(
        "Customer_ID", text.only_matching(F.col("SSN"), text.SSN).alias("SSN"))


@query("p6_sentinel_to_null", """
    select Customer_ID, snapshot_date, 'Occupation' as field, Occupation as value
    from t_attributes
    union all
    select Customer_ID, snapshot_date, 'Credit_Mix', Credit_Mix from t_financial_values""")
def p6(spark, sf):
    x = Inputs(spark, sf)
    rows = lambda df, c: df.select("Customer_ID", "snapshot_date", F.lit(c).alias("field"),
                                   F.col(c).alias("value"))
    return rows(x.attributes, "Occupation").unionAll(rows(x.financial_values, "Credit_Mix"))


@query("p7_negative_to_null", """
    select Customer_ID, snapshot_date, Num_of_Loan, Delay_from_due_date, Num_of_Delayed_Payment
    from t_financial_values""")
def p7(spark, sf):
    return Inputs(spark, sf).financial_values.select(
        "Customer_ID", "snapshot_date", *schemas.NON_NEGATIVE)


@query("p8_duration_parse", """
    select Customer_ID, snapshot_date, Credit_History_Age from t_financial_values""")
def p8(spark, sf):
    return Inputs(spark, sf).financial_values.select(
        "Customer_ID", "snapshot_date", "Credit_History_Age")


@query("p9_behaviour_split", """
    select Customer_ID, snapshot_date, payment_behaviour_spent, payment_behaviour_value
    from t_financial_values""")
def p9(spark, sf):
    return Inputs(spark, sf).financial_values.select(
        "Customer_ID", "snapshot_date", "payment_behaviour_spent", "payment_behaviour_value")


@query("p10_quantile_clip", f"""
    select Customer_ID, snapshot_date, {', '.join(schemas.CLIPPED)} from t_financials""")
def p10(spark, sf):
    return Inputs(spark, sf).financials.select("Customer_ID", "snapshot_date", *schemas.CLIPPED)


@query("p11_date_range_filter", """
    select * from t_labels
    where snapshot_date between date '1996-03-01' and date '1999-12-01'""")
def p11(spark, sf):
    return Inputs(spark, sf).labels.where(
        F.col("snapshot_date").between(F.lit("1996-03-01").cast("date"),
                                       F.lit("1999-12-01").cast("date")))


@query("p12_mob_filter", """
    select loan_id, mob, dpd, snapshot_date from t_lms where mob = 6
    union all select loan_id, mob, dpd, snapshot_date from t_lms where mob = 0""")
def p12(spark, sf):
    lms = Inputs(spark, sf).lms
    at = lambda mob: lms.where(F.col("mob") == mob).select("loan_id", "mob", "dpd", "snapshot_date")
    return at(6).unionAll(at(0))


@query("p13_project_rename_drop", """
    select Customer_ID, Age, Occupation, snapshot_date as att_date from t_attributes""")
def p13(spark, sf):
    return (Inputs(spark, sf).attributes.withColumnRenamed("snapshot_date", "att_date")
            .drop("Name", "SSN", "fin_date"))


@query("p14_feature_column_select", f"""
    select {FE_LIST} from t_labels l join t_clickstream c
      on l.Customer_ID = c.Customer_ID and l.snapshot_date = c.snapshot_date""")
def p14(spark, sf):
    x = Inputs(spark, sf)
    wide = x.labels.join(x.clickstream, ["Customer_ID", "snapshot_date"])
    return wide.select(*schemas.feature_columns(wide.columns))


@query("p15_align_to_model_schema", """
    select Customer_ID, snapshot_date, fe_20, fe_3, 0 as bureau_score, fe_1 from t_clickstream""")
def p15(spark, sf):
    return scoring.align_to_model(Inputs(spark, sf).clickstream,
                                  ["fe_20", "fe_3", "bureau_score", "fe_1"])


@query("p16_fill_constant", """
    select Customer_ID, snapshot_date, coalesce(Credit_Mix, 'unknown') as Credit_Mix,
           coalesce(payment_behaviour_spent, 'unknown') as payment_behaviour_spent,
           coalesce(Num_of_Loan, 0) as Num_of_Loan
    from t_financial_values""")
def p16(spark, sf):
    filled = encode.fill_unknown(Inputs(spark, sf).financial_values,
                                 ["Credit_Mix", "payment_behaviour_spent"])
    return impute.fill_constant(filled, 0, ["Num_of_Loan"]).select(
        "Customer_ID", "snapshot_date", "Credit_Mix", "payment_behaviour_spent", "Num_of_Loan")


shared("t_history_mean", """
    select a.Customer_ID, a.snapshot_date, """
       + ", ".join(f"avg(c.{f}) as {f}" for f in FE) + """
    from t_applications a left join t_clickstream c
      on c.Customer_ID = a.Customer_ID and c.snapshot_date <= a.snapshot_date
    group by 1, 2""")
shared("t_medians_so_far", "select m.snapshot_date, "
       + ", ".join(f"quantile_disc(c.{f}, 0.5e0) as {f}" for f in FE) + """
    from (select distinct snapshot_date from t_applications) m
    join t_clickstream c on c.snapshot_date <= m.snapshot_date group by 1""")
shared("t_history_filled", "select h.Customer_ID, h.snapshot_date, " + ", ".join(
    f"coalesce(h.{f}, cast(m.{f} as double), 0.0e0) as {f}" for f in FE) + """
    from t_history_mean h left join t_medians_so_far m on h.snapshot_date = m.snapshot_date""")


@query("p17_fill_global_median", "select Customer_ID, snapshot_date, " + ", ".join(
    f"round({f}, 6) as {f}" for f in FE) + " from t_history_filled")
def p17(spark, sf):
    x = Inputs(spark, sf)
    means = point_in_time.history_mean(x.applications, x.clickstream, FE)
    medians = impute.medians_so_far(x.clickstream, x.applications, FE, exact=True)
    filled = impute.fill_history_medians(means, medians, FE)
    return filled.select("Customer_ID", "snapshot_date", *[F.round(f, 6).alias(f) for f in FE])


@query("p18_stamp_columns", """
    select Customer_ID, cast(snapshot_date + to_months(6) as date) as snapshot_date,
           'credit_history_1996_01_01' as model_name, fe_1 as model_predictions,
           case when fe_1 >= 0.5 then 1 else 0 end as prediction_label
    from t_clickstream""")
def p18(spark, sf):
    return scoring.prediction_rows(Inputs(spark, sf).clickstream, "credit_history_1996_01_01",
                                   F.col("fe_1"), label_months=6)


@query("p19_threshold_verdict", """
    select Customer_ID, snapshot_date, model_name, prediction_label from t_predictions""")
def p19(spark, sf):
    return Inputs(spark, sf).raw("predictions").select(
        "Customer_ID", "snapshot_date", "model_name",
        metrics.verdict(F.col("model_predictions")).alias("prediction_label"))


@query("p20_round_metrics", """
    select model_name, snapshot_date, round(a / (a + 3.0e0), 4) as share,
           cast(null as double) as unknown
    from (select model_name, snapshot_date, cast(sum(prediction_label) as double) as a
          from t_predictions group by 1, 2) x""")
def p20(spark, sf):
    sums = Inputs(spark, sf).predictions.groupBy("model_name", "snapshot_date").agg(
        F.sum("prediction_label").cast("double").alias("a"))
    values = sums.select("model_name", "snapshot_date", (F.col("a") / (F.col("a") + 3.0))
                         .alias("share"), F.lit(float("nan")).alias("unknown"))
    return metrics.round_metrics(values, ["share", "unknown"])


@query("p21_prefix_column_select", f"select {FE_LIST} from t_clickstream")
def p21(spark, sf):
    clicks = Inputs(spark, sf).clickstream
    return clicks.select(*[c for c in clicks.columns if c.startswith("fe_")])


@query("p22_cohort_filter", """
    select loan_id, loan_start_date, dpd from t_lms
    where loan_start_date < date '1999-01-01' and installment_num = 10""")
def p22(spark, sf):
    return Inputs(spark, sf).lms.where(
        (F.col("loan_start_date") < F.lit("1999-01-01").cast("date"))
        & (F.col("installment_num") == 10)).select("loan_id", "loan_start_date", "dpd")


@query("p23_date_normalise", """
    select r.snapshot_date, r.n as n_loans, p.n as n_predictions
    from (select try_cast(snapshot_date as date) as snapshot_date, count(*) as n
          from t_lms_raw group by 1) r
    join (select snapshot_date, count(*) as n from t_predictions group by 1) p
      on r.snapshot_date = p.snapshot_date""")
def p23(spark, sf):
    x = Inputs(spark, sf)
    counted = lambda df, n: df.groupBy(text.as_date(F.col("snapshot_date")).alias("snapshot_date")
                                       ).agg(F.count(F.lit(1)).alias(n))
    stamped = x.raw("predictions").withColumn("snapshot_date", F.col("snapshot_date").cast(
        "timestamp"))
    return counted(x.raw("lms"), "n_loans").join(
        counted(stamped, "n_predictions"), "snapshot_date")


# --- loans ---------------------------------------------------------------------------------------

@query("d1_mob", "select mob, count(*) as n from t_lms group by mob")
def d1(spark, sf):
    return Inputs(spark, sf).raw("lms").groupBy(
        loans.month_on_book(F.col("installment_num")).alias("mob")).agg(
        F.count(F.lit(1)).alias("n"))


@query("d2_installments_missed", """
    select snapshot_date, mob, installments_missed, count(*) as n from t_lms group by 1, 2, 3""")
def d2(spark, sf):
    return Inputs(spark, sf).lms.groupBy("snapshot_date", "mob", "installments_missed").agg(
        F.count(F.lit(1)).alias("n"))


@query("d3_first_missed_date", """
    select snapshot_date, first_missed_date, count(*) as n from t_lms group by 1, 2""")
def d3(spark, sf):
    return Inputs(spark, sf).lms.groupBy("snapshot_date", "first_missed_date").agg(
        F.count(F.lit(1)).alias("n"))


@query("d4_dpd", """
    select mob, cast(dpd as integer) as dpd, count(*) as n from t_lms group by 1, 2""")
def d4(spark, sf):
    return Inputs(spark, sf).lms.groupBy("mob", "dpd").agg(F.count(F.lit(1)).alias("n"))


@query("d5_default_label", "select * from t_labels")
def d5(spark, sf):
    return Inputs(spark, sf).labels


@query("d6_dpd_flag", """
    select mob, case when dpd >= 30 then 1 else 0 end as dpd_flag, count(*) as n
    from t_lms group by 1, 2""")
def d6(spark, sf):
    return Inputs(spark, sf).lms.groupBy(
        "mob", loans.past_due_flag(F.col("dpd"), 30).alias("dpd_flag")).agg(
        F.count(F.lit(1)).alias("n"))


@query("d7_application_anchor", "select * from t_applications")
def d7(spark, sf):
    return Inputs(spark, sf).applications


shared("t_ratios", """
    select *,
           Outstanding_Debt / nullif(Annual_Income + 1.0e0, 0) as debt_to_income,
           Total_EMI_per_month / nullif(Monthly_Inhand_Salary + 1.0e0, 0) as emi_to_salary,
           Amount_invested_monthly / nullif(Monthly_Inhand_Salary + 1.0e0, 0) as savings_rate,
           Num_of_Delayed_Payment / nullif(Num_of_Loan + 1.0e0, 0) as payment_stress,
           Num_of_Loan / nullif(Num_Credit_Card + 1.0e0, 0) as loans_per_credit_card,
           Monthly_Inhand_Salary - Total_EMI_per_month as monthly_surplus
    from t_financial_values""")


@query("d8_credit_ratios", """
    select Customer_ID, snapshot_date, round(debt_to_income, 6) as debt_to_income,
           round(emi_to_salary, 6) as emi_to_salary, round(savings_rate, 6) as savings_rate,
           round(payment_stress, 6) as payment_stress,
           round(loans_per_credit_card, 6) as loans_per_credit_card,
           round(monthly_surplus, 6) as monthly_surplus
    from t_ratios""")
def d8(spark, sf):
    return Inputs(spark, sf).financial_values.select(
        "Customer_ID", "snapshot_date",
        *[F.round(e, 6).alias(n) for n, e in credit_ratios().items()])
