"""Column expressions over loan instalments, and ratios over a customer's finances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditloom.functions.text import as_int


def month_on_book(installment_num: Column) -> Column:
    return as_int(installment_num)


def installments_missed(overdue_amt: Column, due_amt: Column) -> Column:
    """Whole instalments covered by the overdue amount; 0 when nothing is due."""
    return F.coalesce(F.ceil(F.try_divide(overdue_amt, due_amt)).try_cast("int"), F.lit(0))


def first_missed_date(snapshot_date: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot_date, -missed))


def days_past_due(overdue_amt: Column, snapshot_date: Column, first_missed: Column) -> Column:
    """Null when an amount is overdue but no instalment can be dated as missed."""
    return F.when(overdue_amt > 0, F.datediff(snapshot_date, first_missed)).otherwise(0).cast("int")


def past_due_flag(dpd: Column, threshold: int) -> Column:
    """1 from `threshold` days on; an unknown dpd counts as 0."""
    return F.when(dpd >= threshold, 1).otherwise(0).cast("int")


# Ratio features: numerator over (denominator + 1).
RATIOS = {
    "debt_to_income": ("Outstanding_Debt", "Annual_Income"),
    "emi_to_salary": ("Total_EMI_per_month", "Monthly_Inhand_Salary"),
    "savings_rate": ("Amount_invested_monthly", "Monthly_Inhand_Salary"),
    "payment_stress": ("Num_of_Delayed_Payment", "Num_of_Loan"),
    "loans_per_credit_card": ("Num_of_Loan", "Num_Credit_Card"),
}
ENGINEERED = [*RATIOS, "monthly_surplus"]


def credit_ratios() -> dict[str, Column]:
    """The engineered features by name; null inputs give null."""
    out = {name: F.try_divide(F.col(a), F.col(b) + F.lit(1.0)) for name, (a, b) in RATIOS.items()}
    out["monthly_surplus"] = F.col("Monthly_Inhand_Salary") - F.col("Total_EMI_per_month")
    return out
