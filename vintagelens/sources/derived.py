"""Risk tables derived from the star-schema and event test tables.

The engine's own inputs (loan ledger, attributes, financials, clickstream, feature, label
and prediction tables) are derived here with SQL that reads the same in Spark and in
standard SQL engines, so that a query and its check start from the same rows. Only
integer arithmetic, integer sums and text functions are used. ``{table}`` names a source.

Event days 1 to 31 stand for 31 monthly snapshots from January 2023 on. Tables differ in
the customers they hold, so that joins meet missing keys: financials need a positive
balance, risk features an event other than a view, labels a click, purchase or error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _month(index: str) -> str:
    """First of the month ``index`` months after January 2023."""
    return f"make_date(cast(2023 + (({index}) - ({index}) % 12) / 12 as int), cast(({index}) % 12 + 1 as int), 1)"


_CUSTOMER_MONTH = _month("(c_custkey * 37) % 1009 % 24")

_EVENTS = f"""
  (select cast(user_id as string) as Customer_ID, {_month("day(ts) - 1")} as snapshot_date,
          day(ts) as slot, user_id, event_type, value
   from {{events}}) e"""


def _count_of(event_type: str) -> str:
    return f"sum(case when event_type = '{event_type}' then 1 else 0 end)"


_CENTS = "lpad(cast(c_custkey % 100 as string), 2, '0')"

TABLES: dict[str, str] = {
    "loan_snapshots": """
select cast(l_orderkey as string) as loan_id,
       cast(o_custkey as string) as Customer_ID,
       cast(date_trunc('month', o_orderdate) as date) as loan_start_date,
       10 as tenure,
       l_linenumber as installment_num,
       cast(o_totalprice as float) as loan_amt,
       cast(l_extendedprice * l_tax as float) as due_amt,
       cast(case when l_returnflag = 'R' then 0 else l_extendedprice * l_tax end as float) as paid_amt,
       cast(case when l_returnflag = 'R' then l_extendedprice * l_discount else 0 end as float) as overdue_amt,
       cast(case when l_linestatus = 'O' then o_totalprice else 0 end as float) as balance,
       cast(date_trunc('month', l_shipdate) as date) as snapshot_date
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
""",
    "loan_feed": """
select cast(l_orderkey as string) as loan_id,
       cast(l_suppkey as string) as Customer_ID,
       case when l_orderkey % 41 = 0 then '2020-13-45' when l_orderkey % 43 = 0 then ''
            else cast(cast(date_trunc('month', l_shipdate) as date) as string) end as loan_start_date,
       case when l_partkey % 31 = 0 then '10.0' when l_partkey % 37 = 0 then 'ten' else '10' end as tenure,
       case when l_orderkey % 29 = 0 then concat(cast(l_linenumber as string), '.7')
            when l_orderkey % 31 = 0 then '_' else cast(l_linenumber as string) end as installment_num,
       concat(cast(l_partkey % 9000 as string), '.', lpad(cast(l_suppkey % 100 as string), 2, '0')) as loan_amt,
       case when l_partkey % 17 = 0 then '0' when l_partkey % 19 = 0 then null
            else concat(cast(l_partkey % 300 as string), '.5') end as due_amt,
       case when l_partkey % 23 = 0 then 'n/a' else cast(l_partkey % 300 as string) end as paid_amt,
       case when l_suppkey % 3 = 0 then cast(l_partkey % 900 as string) when l_suppkey % 3 = 1 then '0'
            else null end as overdue_amt,
       concat('-', cast(l_partkey % 700 as string)) as balance,
       cast(cast(date_trunc('month', l_shipdate) as date) as string) as snapshot_date
from {lineitem}
""",
    "attributes_raw": f"""
select cast(c_custkey as string) as Customer_ID,
       case c_custkey % 10 when 0 then null when 1 then '-500'
            when 2 then concat(cast(18 + c_custkey % 50 as string), '_') when 3 then '8698'
            else cast(18 + (c_custkey * 7) % 60 as string) end as Age,
       case when c_custkey % 13 = 0 then '#F%$D@*&8' when c_custkey % 29 = 0 then null
            else concat(lpad(cast(c_custkey % 1000 as string), 3, '0'), '-', {_CENTS}, '-',
                        lpad(cast(c_custkey % 10000 as string), 4, '0')) end as SSN,
       case when c_custkey % 17 = 0 then '_______' when c_custkey % 19 = 0 then null
            else c_mktsegment end as Occupation,
       cast({_CUSTOMER_MONTH} as string) as snapshot_date
from {{customer}}
""",
    "financials_raw": f"""
select cast(c_custkey as string) as Customer_ID,
       cast({_CUSTOMER_MONTH} as string) as snapshot_date,
       concat(cast(20000 + (c_custkey * 37) % 90000 as string), '.', {_CENTS},
              case when c_custkey % 7 = 0 then '_' else '' end) as Annual_Income,
       case when c_custkey % 23 = 0 then '0' else cast(1000 + (c_custkey * 31) % 9000 as string) end
         as Monthly_Inhand_Salary,
       cast(c_custkey % 11 as string) as Num_Bank_Accounts,
       cast(c_custkey % 9 as string) as Num_Credit_Card,
       cast(1 + c_custkey % 34 as string) as Interest_Rate,
       case c_custkey % 12 when 0 then '-100' when 1 then '3_' when 2 then null when 3 then '0'
            when 4 then '967' else cast(c_custkey % 10 as string) end as Num_of_Loan,
       case c_custkey % 8 when 0 then null when 1 then 'Auto Loan' when 2 then 'Auto Loan, Student Loan'
            when 3 then '' else 'Payday Loan, Student Loan, and Home Equity Loan' end as Type_of_Loan,
       cast(c_custkey % 60 - 5 as string) as Delay_from_due_date,
       case c_custkey % 9 when 0 then '8_' when 1 then '-1' when 2 then null
            else cast(c_custkey % 28 as string) end as Num_of_Delayed_Payment,
       case c_custkey % 10 when 0 then '_' when 1 then '-3.25' when 2 then null
            else concat(cast(c_custkey % 30 as string), '.', {_CENTS}) end as Changed_Credit_Limit,
       cast(c_custkey % 17 as string) as Num_Credit_Inquiries,
       case c_custkey % 4 when 0 then '_' when 1 then 'Good' when 2 then 'Standard' else 'Bad' end as Credit_Mix,
       concat(cast((c_custkey * 13) % 5000 as string), '.', {_CENTS},
              case when c_custkey % 15 = 1 then '_' else '' end) as Outstanding_Debt,
       concat(cast(20 + c_custkey % 30 as string), '.5') as Credit_Utilization_Ratio,
       case c_custkey % 10 when 1 then null when 2 then 'NA'
            when 3 then concat(cast(c_custkey % 33 as string), ' Years') when 4 then '7 Months'
            else concat(cast(c_custkey % 33 as string), ' Years and ', cast(c_custkey % 12 as string), ' Months')
            end as Credit_History_Age,
       case c_custkey % 3 when 0 then 'Yes' when 1 then 'No' else 'NM' end as Payment_of_Min_Amount,
       concat(cast(c_custkey % 400 as string), '.25') as Total_EMI_per_month,
       case when c_custkey % 14 = 0 then '__10000__'
            else concat(cast(c_custkey % 700 as string), '.', {_CENTS}) end as Amount_invested_monthly,
       case c_custkey % 6 when 0 then null when 1 then '!@9#%8' when 2 then 'High_spent_Large_value_payments'
            else 'Low_spent_Small_value_payments' end as Payment_Behaviour,
       case when c_custkey % 31 = 0 then '__-333__'
            else concat(cast(c_custkey % 900 as string), '.', {_CENTS}) end as Monthly_Balance
from {{customer}}
where c_acctbal > 0
""",
    "clickstream_raw": f"""
select Customer_ID,
       cast(snapshot_date as string) as snapshot_date,
       cast({_count_of("click")} as string) as fe_1,
       cast({_count_of("view")} as string) as fe_2,
       cast({_count_of("purchase")} as string) as fe_3,
       case when {_count_of("signup")} = 0 then '' else cast({_count_of("signup")} as string) end as fe_4,
       concat(cast({_count_of("error")} as string), '.0') as fe_5,
       cast(count(*) as string) as fe_6
from {_EVENTS}
group by Customer_ID, snapshot_date
""",
    "engagement": f"""
select Customer_ID,
       snapshot_date,
       cast(nullif({_count_of("click")}, 0) as double) as click_1m,
       cast(nullif({_count_of("view")}, 0) as double) as click_2m,
       cast(nullif({_count_of("purchase")}, 0) as double) as click_3m,
       cast(nullif({_count_of("signup")}, 0) as double) as click_4m,
       cast(nullif({_count_of("error")}, 0) as double) as click_5m,
       cast(count(*) as double) as click_6m
from {_EVENTS}
group by Customer_ID, snapshot_date
""",
    "cust_fin_risk": f"""
select Customer_ID,
       snapshot_date,
       case when max(user_id + slot) % 3 = 0 then null else cast(max(floor(value)) as double) end
         as Credit_History_Age,
       case when max(user_id + slot) % 3 = 1 then null else cast(count(*) as double) end as Num_Fin_Pdts,
       case when max(user_id + slot) % 4 = 0 then null else cast(min(floor(value)) as double) end as EMI_to_Salary,
       case when max(user_id + slot) % 4 = 1 then null else cast(max(user_id % 17) as double) end as Debt_to_Salary,
       case when max(user_id + slot) % 4 = 2 then null
            else cast(max(floor(value)) - min(floor(value)) as double) end as Repayment_Ability,
       case when max(user_id + slot) % 5 = 0 then null else cast(max(user_id % 5) as double) end
         as Loans_per_Credit_Item,
       case when max(user_id + slot) % 5 = 1 then null else cast(max(user_id % 7) as double) end as Loan_Extent,
       case when max(user_id + slot) % 5 = 2 then null
            else cast(sum(cast(floor(value) as bigint)) as double) end as Outstanding_Debt,
       case when max(user_id + slot) % 5 = 3 then null else cast(max(1 + user_id % 34) as double) end
         as Interest_Rate,
       case when max(user_id + slot) % 7 = 0 then null else cast(max(user_id % 60) as double) end
         as Delay_from_due_date,
       case when max(user_id + slot) % 7 = 1 then null else cast(max(user_id % 30) as double) end
         as Changed_Credit_Limit
from {_EVENTS}
where event_type <> 'view'
group by Customer_ID, snapshot_date
""",
    "label_store": f"""
select concat(Customer_ID, '_', cast(max(slot) as string)) as loan_id,
       Customer_ID,
       case when max(value) >= 60 then 1 else 0 end as label,
       '30dpd_6mob' as label_def,
       snapshot_date
from {_EVENTS}
where event_type in ('click', 'purchase', 'error')
group by Customer_ID, snapshot_date
""",
    "predictions": f"""
select Customer_ID,
       snapshot_date,
       'm1' as model_name,
       cast((max(user_id) * 37 + max(slot) * 11 + count(*) * 97) % 1000 as double) / 1000 as model_predictions
from {_EVENTS}
group by Customer_ID, snapshot_date
""",
}

SOURCES = ["customer", "orders", "lineitem", "events"]


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the risk tables, computed from the Parquet tables in ``sf_dir``."""
    text = TABLES[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def portable_sql(name: str) -> str:
    """The same derivation over tables registered under their own names."""
    return TABLES[name].format(**{t: t for t in SOURCES})
