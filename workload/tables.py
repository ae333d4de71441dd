"""Raw credit tables derived from the given tables, one SQL text per table.

The given tables hold orders and customers; these texts read them as a loan book: an order is a
loan application, its instalments follow monthly, and dirt is planted where the cleaning rules
expect it. Each text is rendered once for Spark and once for DuckDB, so both sides start from the
same rows; what is under test (cleaning, joins, metrics, drift) is written separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FE = [f"fe_{i}" for i in range(1, 21)]


class _Spark:
    months = staticmethod(lambda d, n: f"add_months({d}, cast({n} as int))")
    month = staticmethod(lambda d: f"trunc(to_date({d}), 'MM')")
    div = staticmethod(lambda a, b: f"(({a}) div ({b}))")
    upto = staticmethod(lambda a, b: f"explode(sequence({a}, {b}))")
    pick = staticmethod(lambda names, i: f"element_at(array({names}), cast({i} as int) + 1)")
    # Wide text is made from few bytes, by which alone Spark would deal these rows to one or two tasks.
    spread = staticmethod(lambda *by: f"/*+ REPARTITION({{spread}}, {', '.join(by)}) */")


class _Duck:
    months = staticmethod(lambda d, n: f"cast({d} + to_months(cast({n} as integer)) as date)")
    month = staticmethod(lambda d: f"cast(date_trunc('month', {d}) as date)")
    div = staticmethod(lambda a, b: f"(({a}) // ({b}))")
    upto = staticmethod(lambda a, b: f"unnest(range({a}, {b} + 1))")
    pick = staticmethod(lambda names, i: f"list_extract([{names}], cast({i} as integer) + 1)")
    spread = staticmethod(lambda *by: "")


LOAN_TYPES = (
    "'Auto Loan', 'Credit-Builder Loan', 'Personal Loan', 'Home Equity Loan', 'Not Specified', "
    "'Mortgage Loan', 'Student Loan', 'Debt Consolidation Loan', 'Payday Loan'"
)


def _lms_raw(d) -> str:
    """One row per loan and month 0..10; about a quarter of the loans stop paying for good."""
    return f"""
    select concat(cast(o_custkey as string), '_', cast(o_orderkey as string)) as loan_id,
           concat('CUS_', cast(o_custkey as string)) as Customer_ID,
           cast(start as string) as loan_start_date,
           '10' as tenure,
           case when o_orderkey % 13 = 0 then concat(cast(k as string), '.0')
                else cast(k as string) end as installment_num,
           cast(amt as string) as loan_amt,
           case when k = 0 or (o_orderkey % 89 = 0 and k = 6) then '0'
                else cast(cast(amt / 10 as decimal(18, 3)) as string) end as due_amt,
           case when missed > 0 or k = 0 then '0'
                else cast(cast(amt / 10 as decimal(18, 3)) as string) end as paid_amt,
           case when o_orderkey % 97 = 0 and k = 3 then null
                when o_orderkey % 89 = 0 and k = 6 then '50'
                else cast(cast(amt * missed / 10 as decimal(18, 3)) as string) end as overdue_amt,
           cast(cast(amt * (10 - k + missed) / 10 as decimal(18, 3)) as string) as balance,
           cast({d.months('start', 'k')} as string) as snapshot_date
    from (
      select *,
             case when k = 0 then 0
                  when (o_orderkey * 7919) % 1000 < cast(floor(amt / 1000) as bigint)
                       then case when k - o_orderkey % 6 > 0 then k - o_orderkey % 6 else 0 end
                  when (o_orderkey + k) % 11 = 0 then 1
                  else 0 end as missed
      from (select o_orderkey, o_custkey, cast(o_totalprice as decimal(18, 2)) as amt,
                   {d.month('o_orderdate')} as start, {d.upto(0, 10)} as k
            from {{orders}}) loans) plan"""


def _attributes_raw(d) -> str:
    return f"""
    select concat('CUS_', cast(c_custkey as string)) as Customer_ID,
           c_name as Name,
           case when c_custkey % 11 = 0 then '-500'
                when c_custkey % 13 = 0 then '8034_'
                when c_custkey % 7 = 0 then concat(cast(18 + c_custkey % 60 as string), '_')
                else cast(18 + c_custkey % 60 as string) end as Age,
           case when c_custkey % 9 = 0 then '#F%$D@*&8'
                else concat(lpad(cast(c_custkey % 1000 as string), 3, '0'), '-',
                            lpad(cast(c_custkey % 100 as string), 2, '0'), '-',
                            lpad(cast(c_custkey % 10000 as string), 4, '0')) end as SSN,
           case when c_custkey % 8 = 0 then '_______' else c_mktsegment end as Occupation,
           cast({d.months("date '1995-01-01'", 'c_custkey % 12')} as string) as snapshot_date
    from {{customer}}"""


def _financials_raw(d) -> str:
    """One row per customer and order month, dated up to two months before or after it."""
    types = lambda i: d.pick(LOAN_TYPES, i)
    return f"""
    select concat('CUS_', cast(o_custkey as string)) as Customer_ID,
           cast({d.months('mon', 'o_custkey % 5 - 2')} as string) as snapshot_date,
           case when m % 7 = 0 then concat(cast(s as string), '_')
                else cast(s as string) end as Annual_Income,
           case when m % 19 = 0 then null
                else cast({d.div('s', '12')} as string) end as Monthly_Inhand_Salary,
           cast(case when m % 37 = 0 then m % 1500 else m % 11 end as string) as Num_Bank_Accounts,
           cast(case when m % 41 = 0 then 1400 else 1 + m % 9 end as string) as Num_Credit_Card,
           cast(case when m % 43 = 0 then 5000 else 1 + m % 34 end as string) as Interest_Rate,
           case when m % 10 = 0 then '-100'
                when m % 6 = 0 then concat(cast(m % 9 as string), '_')
                when m % 97 = 0 then '1496'
                else cast(m % 9 as string) end as Num_of_Loan,
           cast(m % 70 - 5 as string) as Delay_from_due_date,
           case when m % 8 = 0 then concat(cast(m % 28 as string), '_')
                else cast(m % 28 - 2 as string) end as Num_of_Delayed_Payment,
           case when m % 23 = 0 then '_'
                else concat(cast(m % 30 as string), '.',
                            lpad(cast(m % 100 as string), 2, '0')) end as Changed_Credit_Limit,
           concat(cast(m % 17 as string), '.0') as Num_Credit_Inquiries,
           concat(cast((m * 37) % 5000 as string), '.', lpad(cast(m % 100 as string), 2, '0'),
                  case when m % 29 = 0 then '_' else '' end) as Outstanding_Debt,
           concat(cast(20 + m % 30 as string), '.',
                  lpad(cast(m % 1000 as string), 3, '0')) as Credit_Utilization_Ratio,
           concat(cast(m % 400 as string), '.5') as Total_EMI_per_month,
           case when m % 31 = 0 then '__10000__'
                else cast(m % 900 as string) end as Amount_invested_monthly,
           case when m % 53 = 0 then '__-333333333__'
                else cast(m % 1200 as string) end as Monthly_Balance,
           case when m % 17 = 0 then 'NA'
                else concat(cast(m % 30 as string), ' Years and ',
                            cast(m % 12 as string), ' Months') end as Credit_History_Age,
           case when m % 4 = 0 then '_' when m % 4 = 1 then 'Good'
                when m % 4 = 2 then 'Standard' else 'Bad' end as Credit_Mix,
           case when m % 3 = 0 then 'Yes' when m % 3 = 1 then 'No' else 'NM' end
             as Payment_of_Min_Amount,
           case when m % 7 = 0 then '!@9#%8'
                else concat(case when m % 2 = 0 then 'Low' else 'High' end, '_spent_',
                            case when m % 3 = 0 then 'Small' when m % 3 = 1 then 'Medium'
                                 else 'Large' end, '_value_payments') end as Payment_Behaviour,
           case when m % 5 = 0 then null
                when m % 5 = 1 then {types('m % 9')}
                when m % 5 = 2 then concat({types('m % 9')}, ', and ',
                                           {types(d.div('m', '9') + ' % 9')})
                when m % 5 = 3 then concat({types('m % 9')}, ', ',
                                           {types(d.div('m', '9') + ' % 9')}, ', and ',
                                           {types(d.div('m', '81') + ' % 9')})
                else concat({types('m % 9')}, ' and ', {types(d.div('m', '9') + ' % 9')})
                end as Type_of_Loan
    from (select {d.spread('o_custkey', 'mon')} o_custkey, {d.month('o_orderdate')} as mon, min(o_orderkey) as m,
                 cast(sum(cast(floor(o_totalprice) as bigint)) as bigint) as s
          from {{orders}} group by o_custkey, {d.month('o_orderdate')}) months"""


def _clickstream_raw(d) -> str:
    """Twenty integer features per customer and month, dated up to two months after the orders,
    so that some first applications have no history yet."""
    fes = ",\n           ".join(
        f"cast(cast(sum((o_orderkey * {2 * i + 1} + {i * i}) % {150 + i} - 50"
        f" + case when o_totalprice > {20000 * i} then {i} else 0 end) as bigint) as string) as fe_{i}"
        for i in range(1, 21)
    )
    return f"""
    select concat('CUS_', cast(o_custkey as string)) as Customer_ID,
           cast({d.months('mon', 'o_custkey % 3')} as string) as snapshot_date,
           {fes}
    from (select o_orderkey, o_custkey, o_totalprice, {d.month('o_orderdate')} as mon
          from {{orders}}) clicks
    group by o_custkey, mon"""


def _predictions(d) -> str:
    """Scores of two models per customer and month (its first loan of the month). The first model
    is stamped with label months (+6), the second with application months."""
    return f"""
    select Customer_ID,
           case when which = 0 then {d.months('mon', '6')} else mon end as snapshot_date,
           case when which = 0 then 'credit_gbt_1996_01_01'
                else 'credit_logreg_1996_01_01' end as model_name,
           case when which = 0 then round(p / (p + 250000e0), 3)
                else round(0.4e0 * p / (p + 250000e0) + 0.0006e0 * ((o * 7919 + 131) % 1000), 4) end
             as model_predictions
    from (select concat('CUS_', cast(o_custkey as string)) as Customer_ID, mon, o, p,
                 {d.upto(0, 1)} as which
          from (select o_custkey, {d.month('o_orderdate')} as mon, min(o_orderkey) as o,
                       min_by(o_totalprice, o_orderkey) as p
                from {{orders}} group by o_custkey, {d.month('o_orderdate')}) firsts) scored"""


def _events_weekly(d) -> str:
    """The event stream as weekly behaviour snapshots, one feature per event type."""
    week = "cast(date_trunc('week', ts) as date)"
    fe = lambda i, kind: (
        f"cast(sum(case when event_type = '{kind}' then cast(floor(value) as bigint) else 0 end)"
        f" as int) as fe_{i}")
    kinds = ["click", "view", "purchase", "signup", "error"]
    return f"""
    select concat('CUS_', cast(user_id as string)) as Customer_ID, {week} as snapshot_date,
           {', '.join(fe(i, k) for i, k in enumerate(kinds, 1))}
    from {{events}} group by user_id, {week}"""


RAW = {
    "lms": _lms_raw,
    "attributes": _attributes_raw,
    "financials": _financials_raw,
    "clickstream": _clickstream_raw,
    "predictions": _predictions,
    "events_weekly": _events_weekly,
}

GIVEN = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. One small file is one task, so an input with fewer splits than there are
    cores is spread before rows are derived from it; larger inputs are read as they are."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw table `name` as a Spark DataFrame."""
    text = RAW[name](_Spark)
    used = {t: given(spark, sf_dir, t) for t in GIVEN if "{" + t + "}" in text}
    if "{spread}" in text:
        # As many as a shuffle has would be taken for the shuffle before it, and these rows not dealt.
        spread = 4 * spark.sparkContext.defaultParallelism
        used["spread"] = spread + (spread == int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.sql(text, **used)


def raw_sql(name: str) -> str:
    """The raw table `name` as DuckDB SQL."""
    return RAW[name](_Duck).format(**{t: t for t in GIVEN})
