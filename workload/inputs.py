"""The library's tables built from the given ones, and the same tables as SQL for the checks."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import schemas
from creditloom.operators import clean, loan_types
from creditloom.operators.align import default_labels
from creditloom.operators.metrics import verdict
from creditloom.operators.point_in_time import applications
from workload.registry import shared
from workload.tables import FE, raw, raw_sql

LOAN_COLUMNS = [f"loan_{t}" for t in (
    "auto_loan credit-builder_loan debt_consolidation_loan home_equity_loan mortgage_loan "
    "not_specified payday_loan personal_loan student_loan").split()]


class Inputs:
    """Lazily built tables of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return raw(self.spark, self.sf_dir, name)

    @cached_property
    def lms(self) -> DataFrame:
        return clean.clean_lms(self.raw("lms"))

    @cached_property
    def attributes(self) -> DataFrame:
        return clean.clean_attributes(self.raw("attributes"))

    @cached_property
    def financial_values(self) -> DataFrame:
        return clean.financial_values(self.raw("financials"))

    @cached_property
    def financials(self) -> DataFrame:
        return clean.clean_financials(self.raw("financials"), exact=True)

    @cached_property
    def clickstream(self) -> DataFrame:
        return clean.clean_clickstream(self.raw("clickstream"))

    @cached_property
    def loan_type(self) -> DataFrame:
        return loan_types.loan_type_columns(self.raw("financials"))

    @cached_property
    def applications(self) -> DataFrame:
        return applications(self.lms)

    @cached_property
    def labels(self) -> DataFrame:
        return default_labels(self.lms)

    @cached_property
    def predictions(self) -> DataFrame:
        return self.raw("predictions").withColumn(
            "prediction_label", verdict(F.col("model_predictions")))

    @cached_property
    def importance(self) -> DataFrame:
        """A feature ranking taken from the data: total absolute movement of each feature."""
        sums = self.clickstream.agg(*[F.sum(F.abs(c)).cast("double").alias(c) for c in FE])
        position = F.array_position(F.array(*map(F.lit, FE)), F.col("feature")) - 1
        return sums.unpivot([], FE, "feature", "importance").select(
            "feature", position.cast("int").alias("position"), "importance")


for _name in ("lms", "attributes", "financials", "clickstream", "events_weekly"):
    shared(f"t_{_name}_raw", raw_sql(_name))
shared("t_predictions", f"""
    select *, case when model_predictions >= 0.5 then 1 else 0 end as prediction_label
    from ({raw_sql('predictions')}) p""")


def _as_int(c: str) -> str:
    return f"try_cast(trunc(try_cast({c} as double)) as integer)"


def _cast(c: str, t: str) -> str:
    if t == "int":
        return f"{_as_int(c)} as {c}"
    return c if t == "string" else f"try_cast({c} as {t}) as {c}"


shared("t_lms_typed", "select " + ", ".join(_cast(c, t) for c, t in schemas.LMS.items())
       + " from t_lms_raw")
shared("t_lms", """
    select *, cast(case when overdue_amt > 0
                        then date_diff('day', first_missed_date, snapshot_date)
                        else 0 end as integer) as dpd
    from (select *, case when installments_missed > 0 then
                   cast(snapshot_date - to_months(installments_missed) as date) end
                   as first_missed_date
          from (select *, installment_num as mob,
                       cast(coalesce(case when due_amt <> 0 then ceil(overdue_amt / due_amt) end, 0)
                            as integer) as installments_missed
                from t_lms_typed) a) b""")
shared("t_labels", """
    select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label,
           '30dpd_6mob' as label_def, snapshot_date
    from t_lms where mob = 6""")
shared("t_applications", """
    select Customer_ID, snapshot_date, loan_amt, tenure from (
      select *, row_number() over (partition by Customer_ID, snapshot_date order by loan_id) as rn
      from t_lms where mob = 0) x where rn = 1""")
shared("t_attributes", r"""
    select Customer_ID, Name,
           case when age_n between 0 and 120 then age_n end as Age,
           case when regexp_matches(SSN, '^\d{3}-\d{2}-\d{4}$') then SSN end as SSN,
           nullif(Occupation, '_______') as Occupation,
           try_cast(snapshot_date as date) as snapshot_date
    from (select *, try_cast(trunc(try_cast(regexp_extract(Age, '([-+]?\d*\.?\d+)', 1) as double))
                             as integer) as age_n
          from t_attributes_raw) a""")


def _number(c: str, t: str) -> str:
    text = rf"nullif(regexp_extract({c}, '([-+]?\d*\.?\d+)', 1), '')"
    return _as_int(text) if t == "int" else f"try_cast({text} as double)"


NUMBERS_SQL = ", ".join(f"{_number(c, t)} as {c}" for c, t in schemas.FINANCIAL_NUMBERS.items())
shared("t_financial_numbers",
       f"select * replace ({NUMBERS_SQL}, try_cast(snapshot_date as date) as snapshot_date) "
       "from t_financials_raw")


def _kept(c: str) -> str:
    return f"case when {c} >= 0 then {c} end as {c}" if c in schemas.NON_NEGATIVE else c


shared("t_financial_values", rf"""
    select Customer_ID, snapshot_date, {', '.join(_kept(c) for c in schemas.FINANCIAL_NUMBERS)},
           cast(coalesce(try_cast(regexp_extract(Credit_History_Age, '(\d+)\s+Year', 1) as integer), 0) * 12
              + coalesce(try_cast(regexp_extract(Credit_History_Age, '(\d+)\s+Month', 1) as integer), 0)
              as integer) as Credit_History_Age,
           nullif(Credit_Mix, '_') as Credit_Mix,
           Payment_of_Min_Amount,
           nullif(regexp_extract(Payment_Behaviour, '(Low|High)_spent_(Small|Medium|Large)_value', 1), '')
             as payment_behaviour_spent,
           nullif(regexp_extract(Payment_Behaviour, '(Low|High)_spent_(Small|Medium|Large)_value', 2), '')
             as payment_behaviour_value
    from t_financial_numbers""")
shared("t_limits", "select snapshot_date, " + ", ".join(
    f"quantile_disc({c}, 0.97e0) as {c}" for c in schemas.CLIPPED)
    + " from t_financial_values group by snapshot_date")
shared("t_financials", "select v.* replace (" + ", ".join(
    f"case when v.{c} > l.{c} then l.{c} else v.{c} end as {c}" for c in schemas.CLIPPED)
    + ") from t_financial_values v join t_limits l on v.snapshot_date = l.snapshot_date")
shared("t_clickstream", "select " + ", ".join(
    _cast(c, t) for c, t in schemas.CLICKSTREAM.items()) + " from t_clickstream_raw")
shared("t_tokens", r"""
    select Customer_ID, snapshot_date, replace(lower(part), ' ', '_') as token
    from (select Customer_ID, try_cast(snapshot_date as date) as snapshot_date,
                 trim(unnest(string_split(replace(Type_of_Loan, ' and ', ','), ','))) as part
          from t_financials_raw) x
    where part <> ''""")
shared("t_loan_type", "select r.Customer_ID, try_cast(r.snapshot_date as date) as snapshot_date, "
       + ", ".join(f"cast(count(case when token = '{c[5:]}' then 1 end) as integer) as \"{c}\""
                   for c in LOAN_COLUMNS)
       + " from t_financials_raw r left join t_tokens t on t.Customer_ID = r.Customer_ID"
         " and t.snapshot_date = try_cast(r.snapshot_date as date) group by 1, 2")
shared("t_importance", " union all ".join(
    f"select '{c}' as feature, {i} as position, cast(sum(abs({c})) as double) as importance"
    " from t_clickstream" for i, c in enumerate(FE)))
