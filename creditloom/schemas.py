"""Column names and types of the tables. Raw tables are all strings; types are fixed in silver."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

FE_COLUMNS = [f"fe_{i}" for i in range(1, 21)]

LMS = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

ATTRIBUTES = {
    "Customer_ID": "string",
    "Name": "string",
    "Age": "int",
    "SSN": "string",
    "Occupation": "string",
    "snapshot_date": "date",
}

FINANCIAL_NUMBERS = {
    "Annual_Income": "double",
    "Monthly_Inhand_Salary": "double",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "int",
    "Num_of_Loan": "int",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "double",
    "Num_Credit_Inquiries": "double",
    "Outstanding_Debt": "double",
    "Credit_Utilization_Ratio": "double",
    "Total_EMI_per_month": "double",
    "Amount_invested_monthly": "double",
    "Monthly_Balance": "double",
}

FINANCIAL_TEXTS = ["Credit_History_Age", "Credit_Mix", "Payment_of_Min_Amount",
                   "Payment_Behaviour", "Type_of_Loan"]

CLICKSTREAM = {"Customer_ID": "string", "snapshot_date": "date", **{c: "int" for c in FE_COLUMNS}}

NON_NEGATIVE = ["Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment"]
CLIPPED = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
           "Num_of_Delayed_Payment"]
CATEGORIES = ["Occupation", "Credit_Mix", "Payment_of_Min_Amount", "payment_behaviour_spent",
              "payment_behaviour_value"]

# Columns that are never model features.
NON_FEATURES = ("Customer_ID", "snapshot_date", "label", "loan_id", "label_def")

RAW_COLUMNS = {
    "lms": list(LMS),
    "clickstream": list(CLICKSTREAM),
    "attributes": list(ATTRIBUTES),
    "financials": ["Customer_ID", "snapshot_date", *FINANCIAL_NUMBERS, *FINANCIAL_TEXTS],
}


def raw_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in RAW_COLUMNS[table]])


def feature_columns(columns) -> list[str]:
    return [c for c in columns if c not in NON_FEATURES]
