"""Drift of scores and features, monitoring and alert rules (R), worst feature (W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators import align, drift, metrics, scoring
from creditloom.plans import operate
from creditloom.sources import calendar
from workload.inputs import Inputs
from workload.join_queries import bin_number, candidates
from workload.registry import edges_sql, query, shared, steady, steady_sql
from workload.tables import FE, given

WATCHED = FE


def psi_terms(actual: str, expected: str) -> str:
    """The index from per-group bin shares in two lists of ten."""
    return " + ".join(
        f"(greatest({actual}[{b}], 1e-4) - greatest({expected}[{b}], 1e-4))"
        f" * ln(greatest({actual}[{b}], 1e-4) / greatest({expected}[{b}], 1e-4))"
        for b in range(1, 11))


def shares(n: str = "n", b: str = "bin") -> str:
    return "[" + ", ".join(
        f"coalesce(sum(case when {b} = {i} then {n} end), 0) * 1e0 / sum({n})"
        for i in range(10)) + "]"


shared("t_shares", f"""
    select model_name, snapshot_date, {shares()} as shares, cast(sum(n) as bigint) as n
    from t_bins group by 1, 2""")
shared("t_psi", f"""
    select a.model_name, a.snapshot_date, a.n, {psi_terms('a.shares', 'e.shares')} as psi
    from t_shares a join t_first_month f on f.model_name = a.model_name
    join t_shares e on e.model_name = a.model_name and e.snapshot_date = f.baseline_date""")

# Feature drift: every clickstream month against the first.
shared("t_feature_long", f"""
    select snapshot_date, feature, value
    from (unpivot (select snapshot_date, {', '.join(FE)} from t_clickstream)
          on {', '.join(FE)} into name feature value value)""")
shared("t_feature_edges", edges_sql("feature", "value", """
    select feature, value from t_feature_long where snapshot_date = date '1995-01-01'"""))
shared("t_feature_shares", f"""
    select snapshot_date, feature, {shares()} as shares, cast(sum(n) as bigint) as n
    from (select l.snapshot_date, l.feature, {bin_number('l.value')} as bin, count(*) as n
          from t_feature_long l join t_feature_edges e on e.feature = l.feature group by 1, 2, 3) b
    group by 1, 2""")
shared("t_csi", f"""
    select a.feature, a.snapshot_date, a.n, {psi_terms('a.shares', 'e.shares')} as psi,
           cast(replace(a.feature, 'fe_', '') as integer) as position
    from t_feature_shares a join t_feature_shares e
      on e.feature = a.feature and e.snapshot_date = date '1995-01-01'""")


@query("r1_psi", """
    select model_name, snapshot_date, n, round(psi, 6) as psi from t_psi""")
def r1(spark, sf):
    return drift.score_psi(Inputs(spark, sf).predictions).select(
        "model_name", "snapshot_date", "n", F.round("psi", 6).alias("psi"))


def csi(x: Inputs):
    return drift.feature_csi(x.clickstream, WATCHED, "1995-01-01")


@query("r2_csi_per_feature", """
    select feature, snapshot_date, n, round(psi, 6) as psi from t_csi""")
def r2(spark, sf):
    return csi(Inputs(spark, sf)).select("feature", "snapshot_date", "n",
                                         F.round("psi", 6).alias("psi"))


@query("r3_csi_scope", """
    select 'ranked' as scope, feature, cast(position as integer) as position from (
      select * from t_importance order by importance desc, position limit 15) a
    union all
    select 'first', feature, cast(position as integer) from (
      select * from t_importance order by position limit 15) b""")
def r3(spark, sf):
    importance = Inputs(spark, sf).importance
    columns = importance.select("feature", "position")
    ranking = importance.select("feature", (-F.col("importance")).alias("rank"))
    pick = lambda scope, rows: rows.select(F.lit(scope).alias("scope"), "feature", "position")
    return pick("ranked", drift.csi_scope(columns, ranking)).unionAll(
        pick("first", drift.csi_scope(columns)))


WORST = """
    select snapshot_date, round(psi, 6) as csi_max, feature as csi_max_feature from (
      select *, row_number() over (partition by snapshot_date order by psi desc, position) as rn
      from t_csi) x where rn = 1"""


def _positioned(x: Inputs):
    return csi(x).withColumn("position", F.array_position(
        F.array(*map(F.lit, WATCHED)), F.col("feature")))


@query("r4_csi_max", WORST)
def r4(spark, sf):
    return drift.worst_feature(_positioned(Inputs(spark, sf))).select(
        "snapshot_date", F.round("csi_max", 6).alias("csi_max"), "csi_max_feature")


@query("w7_worst_feature", """
    select feature as worst, count(*) as n_months from (
      select *, row_number() over (partition by snapshot_date order by psi desc, position) as rn
      from t_csi) x where rn = 1 group by 1""")
def w7(spark, sf):
    return drift.worst_feature(_positioned(Inputs(spark, sf))).groupBy(
        F.col("csi_max_feature").alias("worst")).agg(F.count(F.lit(1)).alias("n_months"))


# --- monitoring ----------------------------------------------------------------------------------

shared("t_baselines", "select model_version as model_name, auc_oot as oot_auc from t_candidates")
shared("t_model_csi", """
    select s.model_name, s.snapshot_date, c.feature, c.position, c.psi
    from (select distinct model_name, snapshot_date from t_predictions) s
    join t_csi c on c.snapshot_date = cast(s.snapshot_date - to_months(6) as date)""")
shared("t_monitoring", """
    select v.model_name, v.snapshot_date, v.n_scored, v.mean_score, p.psi, q.auc,
           2 * q.auc - 1 as gini, q.precision, q.recall, q.f1, q.brier,
           b.oot_auc - q.auc as auc_drop_from_oot1, w.csi_max, w.csi_max_feature
    from (select model_name, snapshot_date, count(*) as n_scored,
                 avg(model_predictions) as mean_score from t_predictions group by 1, 2) v
    left join t_psi p on p.model_name = v.model_name and p.snapshot_date = v.snapshot_date
    left join t_quality q on q.model_name = v.model_name and q.snapshot_date = v.snapshot_date
    left join t_baselines b on b.model_name = v.model_name
    left join (select model_name, snapshot_date, psi as csi_max, feature as csi_max_feature
               from (select *, row_number() over (partition by model_name, snapshot_date
                                                  order by psi desc, position) as rn
                     from t_model_csi) x where rn = 1) w
      on w.model_name = v.model_name and w.snapshot_date = v.snapshot_date""")


def monitoring(x: Inputs, digits: int):
    baselines = candidates(x).select(F.col("model_version").alias("model_name"),
                                     F.col("auc_oot").alias("oot_auc"))
    return operate.monitoring_table(x.predictions, x.labels, x.clickstream, WATCHED, baselines,
                                    digits=digits)


_R6 = ["mean_score", "psi", "auc", "gini", "precision", "recall", "f1", "brier",
       "auc_drop_from_oot1", "csi_max"]


@query("r5_auc_drop", """
    select model_name, snapshot_date, round(auc_drop_from_oot1, 6) as auc_drop_from_oot1
    from t_monitoring""")
def r5(spark, sf):
    return monitoring(Inputs(spark, sf), 6).select("model_name", "snapshot_date",
                                                   "auc_drop_from_oot1")


@query("r6_monitoring_table", "select m.model_name, m.snapshot_date, m.n_scored, m.csi_max_feature, "
       + ", ".join(f"{steady_sql('m.' + c)} as {c}" for c in _R6) + ", "
       + ", ".join(steady_sql(f"max(case when c.feature = '{f}' then c.psi end)") + f" as csi_{f}"
                   for f in WATCHED)
       + """ from t_monitoring m left join t_model_csi c
             on c.model_name = m.model_name and c.snapshot_date = m.snapshot_date
           group by all""")
def r6(spark, sf):
    table = monitoring(Inputs(spark, sf), 15)
    kinds = dict(table.dtypes)
    return table.select(*[steady(c) if kinds[c] == "double" else c for c in table.columns])


@query("r7_drift_band", """
    select model_name, snapshot_date,
           case when psi > 0.25 then 'significant' when psi > 0.10 then 'moderate'
                when psi is not null then 'stable' else 'n/a' end as score_band,
           case when csi_max > 0.25 then 'significant' when csi_max > 0.10 then 'moderate'
                when csi_max is not null then 'stable' else 'n/a' end as feature_band
    from (select model_name, snapshot_date, round(psi, 4) as psi, round(csi_max, 4) as csi_max
          from t_monitoring) x""")
def r7(spark, sf):
    return monitoring(Inputs(spark, sf), 4).select(
        "model_name", "snapshot_date", drift.drift_band(F.col("psi")).alias("score_band"),
        drift.drift_band(F.col("csi_max")).alias("feature_band"))


shared("t_monitoring_rounded", """
    select model_name, snapshot_date, round(psi, 4) as psi, round(csi_max, 4) as csi_max,
           csi_max_feature, round(auc, 4) as auc, round(auc_drop_from_oot1, 4) as auc_drop,
           round(brier, 4) as brier from t_monitoring""")


@query("r8_breach_rules", """
    select model_name, snapshot_date,
           coalesce(psi > 0.25, false) or coalesce(csi_max > 0.25, false)
             or coalesce(auc_drop > 0.05, false) or coalesce(rise > 0.05, false) as breached,
           concat_ws('; ', case when psi > 0.25 then printf('PSI=%.4f > 0.25', psi) end,
                     case when csi_max > 0.25 then printf('CSI_max=%.4f > 0.25', csi_max) end,
                     case when auc_drop > 0.05 then printf('AUC drop=%.4f > 0.05', auc_drop) end,
                     case when rise > 0.05 then printf('Brier increase=%.4f > 0.05', rise) end)
             as reasons
    from (select l.*, l.brier - f.brier as rise
          from (select *, row_number() over (partition by model_name order by snapshot_date desc)
                       as rn from t_monitoring_rounded) l
          join (select *, row_number() over (partition by model_name order by snapshot_date) as rn
                from t_monitoring_rounded) f on f.model_name = l.model_name and f.rn = 1
          where l.rn = 1) x""")
def r8(spark, sf):
    table = monitoring(Inputs(spark, sf), 4)
    return drift.breach(table, drift.first_row_brier(table))


@query("r8_breach_stored_baseline", """
    select model_name, snapshot_date,
           coalesce(psi > 0.25, false) or coalesce(csi_max > 0.25, false)
             or coalesce(auc_drop > 0.05, false) or coalesce(rise > 0.05, false) as breached,
           concat_ws('; ', case when psi > 0.25 then printf('PSI=%.4f > 0.25', psi) end,
                     case when csi_max > 0.25 then printf('CSI_max=%.4f > 0.25', csi_max) end,
                     case when auc_drop > 0.05 then printf('AUC drop=%.4f > 0.05', auc_drop) end,
                     case when rise > 0.05 then printf('Brier increase=%.4f > 0.05', rise) end)
             as reasons
    from (select l.*, l.brier - b.baseline as rise
          from (select *, row_number() over (partition by model_name order by snapshot_date desc)
                       as rn from t_monitoring_rounded) l
          left join (select model_name, round(avg((score - label) * (score - label)), 4) as baseline
                     from t_scored_split where split = 'oot' group by 1
                     having min(label) < max(label)) b on b.model_name = l.model_name
          where l.rn = 1) x""")
def r8_stored(spark, sf):
    """The default rule: the Brier score of the out-of-time rows, as kept at training, is the baseline."""
    x = Inputs(spark, sf)
    oot = align.temporal_split(scoring.with_outcomes(x.predictions, x.labels), align.Windows.before(
        "1998-09-01")).where(F.col("split") == "oot")
    baseline = metrics.classification_metrics(oot, ["model_name"]).select(
        "model_name", F.round("brier", 4).alias("baseline_brier"))
    return drift.breach(monitoring(x, 4), baseline)


@query("r9_previous_month_breach", """
    select m.model_name, m.snapshot_date as ds,
           coalesce(p.psi > 0.25, false) or coalesce(p.csi_max > 0.25, false) as breached,
           case when p.model_name is null then 'no monitoring row found'
                when p.psi > 0.25 then printf('PSI=%.4f > 0.25', p.psi)
                when p.csi_max > 0.25 then
                  printf('CSI=%.4f > 0.25 on ''%s''', p.csi_max, p.csi_max_feature)
                else 'no drift breach' end || ' for ' || m.model_name || ' at '
             || strftime(cast(m.snapshot_date - to_months(1) as date), '%Y-%m-%d') as message
    from t_monitoring_rounded m left join t_monitoring_rounded p on p.model_name = m.model_name
     and cast(p.snapshot_date + to_months(1) as date) = m.snapshot_date""")
def r9(spark, sf):
    table = monitoring(Inputs(spark, sf), 4)
    months = table.select("model_name", F.col("snapshot_date").alias("ds"))
    return drift.previous_month_breach(table, months)


_KNOWN = "1995-06-01"


@query("r9_no_history_yet", f"""
    select m.model_name, m.snapshot_date as ds,
           coalesce(p.psi > 0.25, false) or coalesce(p.csi_max > 0.25, false) as breached,
           case when h.model_name is null
                then 'no monitoring history yet for ' || m.model_name || ' (first eligible month)'
                else case when p.model_name is null then 'no monitoring row found'
                          when p.psi > 0.25 then printf('PSI=%.4f > 0.25', p.psi)
                          when p.csi_max > 0.25 then
                            printf('CSI=%.4f > 0.25 on ''%s''', p.csi_max, p.csi_max_feature)
                          else 'no drift breach' end || ' for ' || m.model_name || ' at '
                  || strftime(cast(m.snapshot_date - to_months(1) as date), '%Y-%m-%d') end as message
    from t_monitoring_rounded m
    left join (select * from t_monitoring_rounded where snapshot_date <= date '{_KNOWN}') p
      on p.model_name = m.model_name
     and cast(p.snapshot_date + to_months(1) as date) = m.snapshot_date
    left join (select distinct model_name from t_monitoring_rounded
               where snapshot_date <= date '{_KNOWN}') h on h.model_name = m.model_name""")
def r9_no_history(spark, sf):
    """The rule as it answers when monitoring has reached a month in which one model has no scores."""
    table = session.stage(monitoring(Inputs(spark, sf), 4), "monitoring")[0]
    months = table.select("model_name", F.col("snapshot_date").alias("ds"))
    return drift.previous_month_breach(
        table.where(F.col("snapshot_date") <= F.lit(_KNOWN).cast("date")), months)


@query("r10_drift_report_tables", """
    select 'score' as section, model_name as name, snapshot_date, round(psi, 6) as psi,
           case when psi > 0.25 then 'significant' when psi > 0.10 then 'moderate'
                else 'stable' end as band
    from t_psi where snapshot_date = date '1998-06-01'
    union all
    select 'feature', feature, snapshot_date, round(psi, 6),
           case when psi > 0.25 then 'significant' when psi > 0.10 then 'moderate'
                else 'stable' end
    from t_csi where snapshot_date = date '1998-06-01'""")
def r10(spark, sf):
    x = Inputs(spark, sf)
    return operate.drift_report(x.predictions, x.clickstream, WATCHED, "1998-06-01", "1995-01-01")


_SUMMARY_SIDES = {"baseline": "1995-01-01", "current": "1998-06-01"}


@query("r11_data_summary", " union all ".join(f"""
    select '{side}' as side, feature, count(*) as n_rows, count(value) as n_known,
           count(distinct value) as n_distinct, round(1 - count(value) / count(*), 6) as null_share,
           cast(min(value) as double) as smallest, cast(max(value) as double) as largest,
           round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std,
           count(distinct value) <= 1 as is_constant
    from t_feature_long where snapshot_date = date '{d}' group by feature"""
                                            for side, d in _SUMMARY_SIDES.items()))
def r11(spark, sf):
    clicks = Inputs(spark, sf).clickstream
    return operate.data_summary(clicks, FE, "1995-01-01", "1998-06-01").select(
        "side", "feature", "n_rows", "n_known", "n_distinct",
        F.round("null_share", 6).alias("null_share"), "smallest", "largest",
        F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "is_constant")


@query("r11_profile", " union all ".join(f"""
    select '{side}' as side, feature,
           case when feature = 'fe_copy' then 'fe_3' end as duplicate_of, count(value) as n_known,
           0 as n_outside from (
      select snapshot_date, feature, value from t_feature_long
      union all select snapshot_date, 'fe_copy', value from t_feature_long where feature = 'fe_3') x
    where snapshot_date = date '{d}' group by feature""" for side, d in _SUMMARY_SIDES.items()))
def r11_profile(spark, sf):
    """Equal columns are found (one is planted), and the sketched quartiles have exact ranks within one
    in a thousand rows of theirs."""
    clicks = Inputs(spark, sf).clickstream.withColumn("fe_copy", F.col("fe_3"))
    columns = [*FE, "fe_copy"]
    found = operate.data_summary(clicks, columns, *_SUMMARY_SIDES.values())
    side = F.when(F.col("snapshot_date") == F.lit(_SUMMARY_SIDES["baseline"]).cast("date"), "baseline").when(
        F.col("snapshot_date") == F.lit(_SUMMARY_SIDES["current"]).cast("date"), "current")
    rows = drift.feature_long(clicks, columns).withColumn("side", side).where("side is not null and value is not null")
    outside = F.lit(0)
    for k, p in enumerate((0.25, 0.5, 0.75)):
        q, n = F.col("quartiles")[k], F.count("value")
        below, upto = F.sum(F.when(F.col("value") < q, 1).otherwise(0)), F.sum(F.when(F.col("value") <= q, 1).otherwise(0))
        outside = outside + ((below > n * p + n * 1e-3 + 1) | (upto < n * p - n * 1e-3 - 1)).cast("int")
    ranked = rows.join(found, ["side", "feature"]).groupBy("side", "feature").agg(outside.alias("n_outside"))
    return found.join(ranked, ["side", "feature"], "left").select(
        "side", "feature", "duplicate_of", "n_known", F.coalesce("n_outside", F.lit(0)).alias("n_outside"))


# --- calendar rules ------------------------------------------------------------------------------

ORDER_MONTHS = """
    select cast(unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                       max(o_orderdate), interval 1 month)) as date)
             as snapshot_date from orders"""
shared("t_calendar", ORDER_MONTHS)


def order_months(spark, sf):
    span = given(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return calendar.months_between(span, F.col("a"), F.col("b"))


@query("s12_snapshot_calendar", "select * from t_calendar")
def s12(spark, sf):
    return order_months(spark, sf)


@query("s13_availability_guard", """
    select c.snapshot_date, cast(c.snapshot_date - to_months(6) as date) as application_month,
           case when c.snapshot_date < date '1996-01-01' then 'model not trained yet'
                when a.snapshot_date is null then 'no features' else 'run' end as reason
    from (select cast(snapshot_date + to_months(12) as date) as snapshot_date from t_calendar
          union select snapshot_date from t_calendar) c
    left join (select distinct snapshot_date from t_applications) a
      on a.snapshot_date = cast(c.snapshot_date - to_months(6) as date)""")
def s13(spark, sf):
    months = order_months(spark, sf)
    longer = months.unionAll(months.select(
        F.add_months("snapshot_date", 12).alias("snapshot_date"))).distinct()
    return calendar.runnable_months(longer, Inputs(spark, sf).applications, "1996-01-01")


@query("s13_missing_months", """
    select snapshot_date from t_calendar
    where snapshot_date not in (select snapshot_date from t_labels)""")
def s13_missing(spark, sf):
    return calendar.missing_months(order_months(spark, sf), Inputs(spark, sf).labels)


@query("r12_training_gate", """
    select snapshot_date, snapshot_date = date '1998-09-01' as should_train from t_calendar""")
def r12(spark, sf):
    return calendar.training_gate(order_months(spark, sf), "1998-09-01")


@query("r13_inference_date_map", """
    select snapshot_date, cast(snapshot_date - to_months(6) as date) as application_month
    from t_calendar""")
def r13(spark, sf):
    return order_months(spark, sf).withColumn(
        "application_month", calendar.application_month(F.col("snapshot_date")))
