"""Column names and types of the tables that flow through the pipelines."""

from __future__ import annotations

KEYS = ["Customer_ID", "snapshot_date"]

# Columns and silver types of the loan ledger.
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}

# The label store layout.
LABEL_COLUMNS = ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]

# Silver attribute and financial layouts.
ATTRIBUTE_COLUMNS = ["Customer_ID", "Age", "Occupation", "snapshot_date"]

FINANCIAL_COLUMNS = [
    "Customer_ID",
    "snapshot_date",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Type_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Mix",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Credit_History_Age",
    "Credit_History_Age_Months",
    "Payment_of_Min_Amount",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Payment_Behaviour",
    "Monthly_Balance",
    "EMI_to_Monthly_Income_Ratio",
    "Debt_to_Monthly_Income_Ratio",
]

# Silver columns that the feature store leaves out.
FEATURE_STORE_DROPS = [
    "Credit_History_Age",
    "Total_EMI_per_month",
    "Outstanding_Debt",
    "Credit_Mix",
    "Num_Credit_Card",
]

# The clickstream family.
CLICKSTREAM_PREFIX = "fe_"
CLICKSTREAM_FAMILY = [f"{CLICKSTREAM_PREFIX}{i}" for i in range(1, 21)]

# Model features of the engagement and the financial-risk table.
ENGAGEMENT_FEATURES = [f"click_{i}m" for i in range(1, 7)]
RISK_FEATURES = [
    "Credit_History_Age",
    "Num_Fin_Pdts",
    "EMI_to_Salary",
    "Debt_to_Salary",
    "Repayment_Ability",
    "Loans_per_Credit_Item",
    "Loan_Extent",
    "Outstanding_Debt",
    "Interest_Rate",
    "Delay_from_due_date",
    "Changed_Credit_Limit",
]
MODEL_FEATURES = ENGAGEMENT_FEATURES + RISK_FEATURES

# Layouts of the prediction and monitor tables.
PREDICTION_COLUMNS = ["Customer_ID", "snapshot_date", "model_name", "model_predictions"]
MONITOR_COLUMNS = [
    "snapshot_date", "model_name", "predict_psi", "roc_auc", "psi_status", "auc_status",
]

# Fixed value: the label definition that training and monitoring use unless told otherwise.
LABEL_DEFINITION = "30dpd_6mob"

# Stored tables of fixed layout. Reading with a schema needs no footers and guesses no types.
LABELS = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"
PREDICTIONS = "Customer_ID string, model_predictions double, model_name string, snapshot_date date"
MONITOR = (
    "predict_psi double, roc_auc double, psi_status string, auc_status string, model_name string, snapshot_date date"
)
BASELINES = "edges array<double>, counts array<bigint>, model_name string, snapshot_date date"
ENGAGEMENT = ", ".join(["Customer_ID string", *[f"{c} double" for c in ENGAGEMENT_FEATURES], "snapshot_date date"])
RISK = ", ".join(["Customer_ID string", *[f"{c} double" for c in RISK_FEATURES], "snapshot_date date"])
JOINED = ", ".join(["Customer_ID string", *[f"{c} double" for c in MODEL_FEATURES], "snapshot_date date"])
LOAN_BRONZE = ", ".join(f"{c} {'date' if c == 'snapshot_date' else 'string'}" for c in LOAN_TYPES)
