"""Typed and cleaned tables from raw ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens import schemas
from vintagelens.functions import cleaning as c
from vintagelens.functions import delinquency
from vintagelens.operators.impute import impute_age, impute_limit
from vintagelens.operators.rows import counts_where, fill_numeric_zero


def cast_to_schema(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """One projection with every column cast to its type; text that does not parse becomes NULL."""
    have = dict(raw.dtypes)

    def typed(name: str, to: str):
        if have[name] == to:
            return F.col(name)
        if to == "date" and have[name] == "string":
            return c.parse_date(name)
        if to == "int" and have[name] == "string":
            return c.lenient_int(name)
        return F.col(name).try_cast(to)

    return raw.select(*[typed(name, to).alias(name) for name, to in types.items()])


def loans(bronze: DataFrame) -> DataFrame:
    """Loan ledger with months on book, instalments missed and days past due.

    The zero fill covers all numeric columns and comes before the dates are derived: an
    overdue amount with nothing due therefore has 0 instalments missed and no known dpd.
    """
    typed = cast_to_schema(bronze, schemas.LOAN_TYPES).select(
        "*", F.col("installment_num").alias("mob"), delinquency.installments_missed().alias("installments_missed")
    )
    return (
        fill_numeric_zero(typed)
        .withColumn("first_missed_date", delinquency.first_missed_date())
        .withColumn("dpd", delinquency.days_past_due())
    )


def loan_quality(silver: DataFrame) -> DataFrame:
    """Loans of each snapshot, and those overdue whose days past due are unknown, as nothing is due."""
    unknown = (F.col("overdue_amt") > 0) & F.col("dpd").isNull()
    return counts_where(silver, {"n_unknown_dpd": unknown})


def missing_medians(bronze: DataFrame) -> DataFrame:
    """Snapshots of the financials none of whose limits is valid: their gaps stay NULL."""
    parsed = parsed_financials(bronze)
    valid = F.count("Changed_Credit_Limit")
    counts = parsed.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"), valid.alias("n_valid"))
    return counts.where("n_valid = 0").drop("n_valid")


def labels(silver: DataFrame, days: int = 30, months_on_book: int = 6) -> DataFrame:
    """Default label of each loan at the given month on book."""
    return silver.where(F.col("mob") == months_on_book).select(
        "loan_id",
        "Customer_ID",
        delinquency.past_due_flag(days).alias("label"),
        F.lit(delinquency.label_definition(days, months_on_book)).alias("label_def"),
        "snapshot_date",
    )


def parsed_attributes(bronze: DataFrame) -> DataFrame:
    """Attributes with a numeric age, before imputation."""
    return bronze.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        c.strip_cast("Age", c.UNDERSCORES, "int").alias("Age"),
        F.col("SSN"),
        c.occupation("Occupation").alias("Occupation"),
        _snapshot(bronze).alias("snapshot_date"),
    )


def attributes(bronze: DataFrame) -> DataFrame:
    return impute_age(parsed_attributes(bronze).drop("SSN")).select(*schemas.ATTRIBUTE_COLUMNS)


def attribute_quality(bronze: DataFrame) -> DataFrame:
    """Counts of suspicious attribute values per snapshot."""
    age = F.col("Age")
    return counts_where(
        parsed_attributes(bronze),
        {
            "n_age_out_of_range": (age < 18) | (age > 100),
            "n_ssn_malformed": ~F.col("SSN").rlike(c.SSN_SHAPE),
            "n_occupation_unknown": F.col("Occupation") == c.UNKNOWN,
        },
    )


def parsed_financials(bronze: DataFrame) -> DataFrame:
    """Financials with typed columns, before the median fill and the ratios."""
    floats = ["Monthly_Inhand_Salary", "Credit_Utilization_Ratio", "Total_EMI_per_month"]
    stripped = ["Annual_Income", "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance"]
    ints = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Delay_from_due_date", "Num_Credit_Inquiries"]
    count = c.loan_count("Num_of_Loan", "Type_of_Loan")
    return bronze.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        _snapshot(bronze).alias("snapshot_date"),
        *[c.strip_cast(name, c.NON_DECIMALS, "float").alias(name) for name in stripped],
        *[c.lenient_float(name).alias(name) for name in floats],
        *[c.lenient_int(name).alias(name) for name in ints],
        count.alias("Num_of_Loan"),
        c.loan_types(count, "Type_of_Loan").alias("Type_of_Loan"),
        c.strip_cast("Num_of_Delayed_Payment", c.NON_DIGITS, "int").alias("Num_of_Delayed_Payment"),
        c.credit_limit("Changed_Credit_Limit").alias("Changed_Credit_Limit"),
        c.credit_mix("Credit_Mix").alias("Credit_Mix"),
        F.col("Credit_History_Age"),
        c.duration_months("Credit_History_Age").alias("Credit_History_Age_Months"),
        F.col("Payment_of_Min_Amount").cast("string").alias("Payment_of_Min_Amount"),
        c.payment_behaviour("Payment_Behaviour").alias("Payment_Behaviour"),
    )


def financials(bronze: DataFrame) -> DataFrame:
    return (
        impute_limit(parsed_financials(bronze))
        .withColumns(
            {
                "EMI_to_Monthly_Income_Ratio": c.ratio("Total_EMI_per_month", "Monthly_Inhand_Salary"),
                "Debt_to_Monthly_Income_Ratio": c.ratio("Outstanding_Debt", "Monthly_Inhand_Salary"),
            }
        )
        .select(*schemas.FINANCIAL_COLUMNS)
    )


def clickstream(bronze: DataFrame) -> DataFrame:
    """Clickstream with whichever members of the feature family it has, as integers."""

    def typed(name: str):
        if name == "snapshot_date":
            return _snapshot(bronze).alias(name)
        if name == "Customer_ID":
            return F.col(name).cast("string").alias(name)
        if name in schemas.CLICKSTREAM_FAMILY:
            return c.lenient_int(name).alias(name)
        return F.col(name)

    return bronze.select(*[typed(name) for name in bronze.columns])


def _snapshot(bronze: DataFrame):
    parsed = dict(bronze.dtypes)["snapshot_date"] == "date"
    return F.col("snapshot_date") if parsed else c.parse_date("snapshot_date")
