"""Standard SQL for the queries, run by another engine over the same tables.

The derived input tables come as common table expressions; everything after them states
the operator's result on its own, in a different way where there is one.
"""

from __future__ import annotations

from checks.queries import (
    BACKFILL, DEVELOPMENT_END, FLAT_MONTH, LOAN_MONTH, MONTH, MOVED_FEATURES, RERUN_GONE, SCORECARD, TRAIN_DATE,
)
from vintagelens import schemas
from vintagelens.sources.derived import TABLES, portable_sql

ORACLES: dict[str, str] = {}

LABELS = ", ".join(schemas.LABEL_COLUMNS)
FEATURES = ", ".join(schemas.MODEL_FEATURES)
LOANS = list(schemas.LOAN_TYPES)

# Steps that several statements share, each with the tables or steps it needs.
STEPS: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    """Register a statement, prefixed with the tables and steps it mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for step in [*TABLES, *STEPS]:
            if _mentions(text, step) and step not in needed:
                visit(portable_sql(step) if step in TABLES else STEPS[step])
                if step not in needed:
                    needed.append(step)

    visit(sql)
    ctes = ",\n".join(f"{n} as ({(portable_sql(n) if n in TABLES else STEPS[n]).strip()})" for n in needed)
    ORACLES[name] = f"with {ctes}\n{sql.strip()}"


def _mentions(text: str, name: str) -> bool:
    return any(f"{word} {name}{end}" in text + " " for word in ("from", "join") for end in (" ", "\n", ")"))


def nine(value: str) -> str:
    return f"cast(cast({value} as decimal(28,9)) as double)"


def whole(text: str) -> str:
    """Text to a whole number, cut towards zero."""
    return f"try_cast(trunc(try_cast({text} as double)) as int)"


def digits(column: str) -> str:
    return f"regexp_replace({column}, '[^0-9]', '', 'g')"


def decimals(column: str) -> str:
    return f"try_cast(regexp_replace({column}, '[^0-9.]', '', 'g') as float)"


def day(text: str) -> str:
    """Date from text that is exactly year, month and day."""
    return f"try_cast(case when regexp_full_match({text}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') then {text} end as date)"


# Cleaned tables

_CASTS = {"date": day, "int": whole, "float": lambda x: f"try_cast({x} as float)", "string": lambda x: x}

STEPS["loan_typed"] = (
    "select " + ", ".join(f"{_CASTS[t](n)} as {n}" for n, t in schemas.LOAN_TYPES.items()) + " from loan_feed"
)


def zero_filled(columns: list[str]) -> str:
    numeric = {n for n, t in schemas.LOAN_TYPES.items() if t in ("int", "float")} | {"mob", "installments_missed"}
    return ", ".join(f"coalesce({x}, 0) as {x}" if x in numeric else x for x in columns)


MISSED = "cast(ceil(cast(overdue_amt as double) / nullif(cast(due_amt as double), 0)) as int)"

STEPS["loan_missed"] = f"select *, installment_num as mob, {MISSED} as installments_missed from loan_snapshots"
STEPS["loan_filled"] = f"select {zero_filled([*LOANS, 'mob', 'installments_missed'])} from loan_missed"
STEPS["loan_dated"] = """
select *, case when installments_missed > 0 then cast(snapshot_date - to_months(installments_missed) as date) end
  as first_missed_date from loan_filled"""
STEPS["loan_silver"] = """
select *, cast(case when overdue_amt > 0 then datediff('day', first_missed_date, snapshot_date) else 0 end as int) as dpd
from loan_dated"""


def labels(days: int, mob: int) -> str:
    return f"""
select loan_id, Customer_ID, case when dpd >= {days} then 1 else 0 end as label,
       '{days}dpd_{mob}mob' as label_def, snapshot_date
from loan_silver where mob = {mob}"""


STEPS["attr_parsed"] = f"""
select Customer_ID, {whole("replace(Age, '_', '')")} as Age, SSN,
       case when regexp_full_match(Occupation, '_{{3,}}') then 'Unknown' else Occupation end as Occupation,
       {day("snapshot_date")} as snapshot_date
from attributes_raw"""
STEPS["age_median"] = """
select snapshot_date, quantile_disc(Age, 0.5) as median, count(*) as n_valid
from attr_parsed where Age between 18 and 100 group by snapshot_date"""
STEPS["attr_silver"] = """
select Customer_ID, case when Age between 18 and 100 then Age else median end as Age, Occupation, snapshot_date
from attr_parsed left join age_median using (snapshot_date)"""

LISTED = "case when Type_of_Loan is null then 0 else len(string_split(Type_of_Loan, ',')) end"
COUNT = f"cast(case when {whole(digits('Num_of_Loan'))} between 0 and 50 then {whole(digits('Num_of_Loan'))} else {LISTED} end as int)"
TYPES = f"case when {COUNT} = 0 then 'No Loan' when Type_of_Loan <> '' then Type_of_Loan end"
YEARS = r"coalesce(try_cast(nullif(regexp_extract(Credit_History_Age, '(\d+)\s*Years?', 1), '') as int), 0)"
MONTHS = r"coalesce(try_cast(nullif(regexp_extract(Credit_History_Age, '(\d+)\s*Months?', 1), '') as int), 0)"
DURATION = f"case when Credit_History_Age is not null then {YEARS} * 12 + {MONTHS} end"
BEHAVIOUR = "case when regexp_full_match(Payment_Behaviour, '[A-Za-z_]+') then Payment_Behaviour else 'Unknown' end"
MIX = "case when Credit_Mix = '_' then 'Unknown' else Credit_Mix end"
LIMIT = "case when try_cast(Changed_Credit_Limit as float) >= 0 then try_cast(Changed_Credit_Limit as float) end"


def ratio(column: str) -> str:
    return f"round(cast({column} as double) / nullif(cast(Monthly_Inhand_Salary as double), 0), 3)"


STEPS["fin_parsed"] = f"""
select Customer_ID, {day("snapshot_date")} as snapshot_date, {decimals("Annual_Income")} as Annual_Income,
       try_cast(Monthly_Inhand_Salary as float) as Monthly_Inhand_Salary,
       {whole("Num_Bank_Accounts")} as Num_Bank_Accounts, {whole("Num_Credit_Card")} as Num_Credit_Card,
       {whole("Interest_Rate")} as Interest_Rate, {COUNT} as Num_of_Loan, {TYPES} as Type_of_Loan,
       {whole("Delay_from_due_date")} as Delay_from_due_date,
       {whole(digits("Num_of_Delayed_Payment"))} as Num_of_Delayed_Payment, {LIMIT} as Changed_Credit_Limit,
       {whole("Num_Credit_Inquiries")} as Num_Credit_Inquiries, {MIX} as Credit_Mix,
       {decimals("Outstanding_Debt")} as Outstanding_Debt,
       try_cast(Credit_Utilization_Ratio as float) as Credit_Utilization_Ratio, Credit_History_Age,
       {DURATION} as Credit_History_Age_Months, Payment_of_Min_Amount,
       try_cast(Total_EMI_per_month as float) as Total_EMI_per_month,
       {decimals("Amount_invested_monthly")} as Amount_invested_monthly, {BEHAVIOUR} as Payment_Behaviour,
       {decimals("Monthly_Balance")} as Monthly_Balance
from financials_raw"""
STEPS["limit_median"] = """
select snapshot_date, quantile_disc(Changed_Credit_Limit, 0.5) as median from fin_parsed
where Changed_Credit_Limit is not null group by snapshot_date"""
STEPS["fin_silver"] = f"""
select * exclude (median, Changed_Credit_Limit),
       round(cast(coalesce(Changed_Credit_Limit, median) as double), 2) as Changed_Credit_Limit,
       {ratio("Total_EMI_per_month")} as EMI_to_Monthly_Income_Ratio,
       {ratio("Outstanding_Debt")} as Debt_to_Monthly_Income_Ratio
from fin_parsed left join limit_median using (snapshot_date)"""
STEPS["click_silver"] = (
    f"select Customer_ID, {day('snapshot_date')} as snapshot_date, "
    + ", ".join(f"{whole(f'fe_{i}')} as fe_{i}" for i in range(1, 7))
    + " from clickstream_raw"
)

# Sources and sinks

oracle(
    "bronze_loan_ingest",
    f"select * replace ({day('snapshot_date')} as snapshot_date) from loan_feed where snapshot_date = '{LOAN_MONTH}'",
)
oracle(
    "bronze_feature_ingest",
    f"""select * replace ({day('snapshot_date')} as snapshot_date) from clickstream_raw
where snapshot_date between '2023-01-01' and '2024-12-01'""",
)
oracle("read_one_snapshot", f"select {LABELS} from label_store where snapshot_date = date '{MONTH}'")
oracle("read_all_snapshots", f"select {LABELS} from label_store")
oracle(
    "read_snapshot_list",
    f"""select {LABELS} from label_store
where snapshot_date in (date '2022-12-01', date '2023-02-01', date '2023-07-01', date '2024-01-01')""",
)
oracle("write_predictions", "select * from predictions")
oracle(
    "label_store_rerun",
    f"""select {LABELS} from label_store where snapshot_date <> date '{RERUN_GONE}'
union all select {LABELS.replace("label_def", "'60dpd_6mob' as label_def")} from label_store """,
)
oracle(
    "snapshot_calendar",
    """select cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), interval 1 month)) as date) as snapshot_date
from loan_snapshots""",
)

# Projections, filters, predicates

oracle("filter_snapshot_eq", f"select * from loan_snapshots where snapshot_date = date '{LOAN_MONTH}'")
oracle(
    "filter_snapshot_range",
    "select * from label_store where snapshot_date >= date '2023-03-01' and snapshot_date <= date '2024-02-01'",
)
oracle("loan_schema_cast", "select * from loan_typed ")
oracle("clickstream_silver", "select * from click_silver ")
oracle("select_by_prefix", "select Customer_ID, snapshot_date, columns('^fe_') from clickstream_raw ")
oracle("fill_numeric_zero", f"select {zero_filled(LOANS)} from loan_typed ")
oracle(
    "actual_bads",
    """select loan_id, snapshot_date, installment_num, dpd, case when dpd >= 30 then 1 else 0 end as dpd_flag
from loan_silver where installment_num = 7""",
)
oracle(
    "bad_rate_curve",
    """select mob, count(*) as n_rows, cast(sum(f) as bigint) as n_bad, cast(sum(f) as double) / count(*) as bad_rate
from (select mob, case when dpd >= 30 then 1 else 0 end as f from loan_silver where loan_start_date < date '1999-01-01') t
group by mob""",
)
oracle(
    "dq_attributes",
    r"""select snapshot_date, count(*) as n_rows,
       count(*) filter (where Age < 18 or Age > 100) as n_age_out_of_range,
       count(*) filter (where not regexp_full_match(SSN, '\d{3}-\d{2}-\d{4}')) as n_ssn_malformed,
       count(*) filter (where Occupation = 'Unknown') as n_occupation_unknown
from attr_parsed group by snapshot_date""",
)
oracle(
    "top_rows",
    """select snapshot_date, loan_id, installment_num, due_amt, loan_amt, dpd, paid_amt, overdue_amt from loan_silver
order by snapshot_date, loan_id, installment_num, due_amt desc, loan_amt nulls first, dpd desc nulls last, paid_amt, overdue_amt
limit 20""",
)

# Scalar functions

oracle(
    "strip_cast",
    f"""select Customer_ID, snapshot_date, {decimals("Annual_Income")} as Annual_Income,
       {decimals("Monthly_Balance")} as Monthly_Balance,
       {whole(digits("Num_of_Delayed_Payment"))} as Num_of_Delayed_Payment,
       {whole("replace(Num_of_Loan, '_', '')")} as Num_of_Loan
from financials_raw """,
)
oracle(
    "placeholder_unknown",
    f"""select a.Customer_ID, a.snapshot_date,
       case when regexp_full_match(Occupation, '_{{3,}}') then 'Unknown' else Occupation end as Occupation,
       f.Credit_Mix, f.Payment_Behaviour
from attributes_raw a left join (
  select Customer_ID, snapshot_date, {MIX} as Credit_Mix, {BEHAVIOUR} as Payment_Behaviour from financials_raw ) f
on a.Customer_ID = f.Customer_ID and a.snapshot_date = f.snapshot_date""",
)
oracle("impute_age_median", "select * from attr_silver ")
oracle("impute_limit_median", "select Customer_ID, snapshot_date, Changed_Credit_Limit from fin_silver ")
oracle("loan_count_repair", f"select Customer_ID, snapshot_date, Num_of_Loan, {COUNT} as Num_of_Loan_repaired from financials_raw ")
oracle("loan_type_norm", f"select Customer_ID, snapshot_date, {TYPES} as Type_of_Loan from financials_raw ")
oracle(
    "credit_history_months",
    f"select Customer_ID, snapshot_date, Credit_History_Age, {DURATION} as Credit_History_Age_Months from financials_raw ",
)
oracle(
    "affordability_ratios",
    "select Customer_ID, snapshot_date, EMI_to_Monthly_Income_Ratio, Debt_to_Monthly_Income_Ratio from fin_silver ",
)
oracle(
    "installments_missed",
    f"select loan_id, snapshot_date, overdue_amt, due_amt, {MISSED} as installments_missed from loan_snapshots ",
)
oracle("days_past_due", "select * from loan_silver ")
# A cycle of 400 years has 4,800 months and 146,097 days: the dates themselves would not fit.
STEPS["loan_late"] = """
select loan_id, snapshot_date, coalesce(installment_num, 0) as installment_num, coalesce(overdue_amt, 0) as overdue_amt,
       coalesce(cast(case when missed > 2147483647 then 2147483647 else missed end as int), 0) as installments_missed
from (select *, ceil(cast(overdue_amt as double) / nullif(cast(cast(
        cast(due_amt as double) * pow(10.0::double, -3 * (installment_num % 5)) as float) as double), 0)) as missed
      from loan_snapshots ) m"""
STEPS["loan_later"] = """
select *, least(installments_missed, 70000000) as months,
       cast(case when overdue_amt <= 0 then 0 when installments_missed > 0 then
         (least(installments_missed, 70000000) // 4800) * 146097 + datediff('day',
           cast(snapshot_date - to_months(cast(least(installments_missed, 70000000) % 4800 as int)) as date), snapshot_date)
       end as int) as dpd
from loan_late """
oracle(
    "arrears_edge",
    """select loan_id, snapshot_date, installment_num, installments_missed, dpd, case when dpd >= 30 then 1 else 0 end as label
from loan_later """,
)
oracle("loan_label", labels(31, 3))
oracle(
    "parse_snapshot_date",
    f"select loan_id, {day('loan_start_date')} as loan_start_date, {day('snapshot_date')} as snapshot_date from loan_feed ",
)

# Quality counts

oracle(
    "dq_feed",
    f"""select count(*) as n_raw, count(*) filter (d is null) as n_no_date,
count(*) filter (not d between date '1993-01-01' and date '1997-12-01') as n_outside,
count(*) filter (d between date '1993-01-01' and date '1997-12-01') as n_kept
from (select {day('snapshot_date')} as d from loan_feed ) t""",
)
oracle(
    "dq_loans",
    """select snapshot_date, count(*) as n_rows, count(*) filter (overdue_amt > 0 and dpd is null) as n_unknown_dpd
from loan_silver group by snapshot_date""",
)
oracle(
    "dq_missing_medians",
    """select snapshot_date, count(*) as n_rows from fin_parsed group by snapshot_date
having count(case when month(snapshot_date) % 4 <> 0 then Changed_Credit_Limit end) = 0""",
)

# A blank field of a CSV file is NULL.
oracle("csv_round_trip", f"select {', '.join(f"nullif({n}, '') as {n}" for n in LOANS)} from loan_feed ")
_REASONS = ", ".join(
    f"case when trim({n}) <> '' and {_CASTS[t](n)} is null then concat('{n}: ', {n}) end"
    for n, t in schemas.LOAN_TYPES.items()
    if t != "string"
)
oracle(
    "quarantine_loans",
    f"""select loan_id, installment_num, snapshot_date, reasons, true as has_file
from (select *, concat_ws('; ', {_REASONS}) as reasons from loan_feed ) t where reasons <> ''""",
)
oracle(
    "quarantine_counts",
    f"""select snapshot_date, count(*) as n_raw, count(*) - count(nullif(reasons, '')) as n_kept, count(nullif(reasons, '')) as n_held
from (select *, concat_ws('; ', {_REASONS}) as reasons from loan_feed ) t group by snapshot_date""",
)
oracle(
    "backfill_resumed",
    f"select * from ({labels(30, 6)}) t where snapshot_date between date '{BACKFILL[0]}' and date '{BACKFILL[1]}'",
)
oracle(
    "write_interrupted",
    f"""select loan_id, Customer_ID, 1 - label as label, label_def, snapshot_date from label_store
where snapshot_date <> date '{RERUN_GONE}'
union all select loan_id, Customer_ID, label, '60dpd_6mob' as label_def, snapshot_date from label_store """,
)

# Joins

oracle(
    "join_attr_fin",
    "select f.*, a.Age, a.Occupation from attr_silver a join fin_silver f using (Customer_ID, snapshot_date)",
)
oracle(
    "join_click_left",
    """select c.*, a.Age, a.Occupation, a.snapshot_date as feature_snapshot_date from click_silver c
left join attr_silver a on c.Customer_ID = a.Customer_ID and c.snapshot_date = a.snapshot_date""",
)
STEPS["features_joined"] = f"""
select e.Customer_ID, e.snapshot_date, {FEATURES} from engagement e
left join cust_fin_risk r on e.Customer_ID = r.Customer_ID and e.snapshot_date = r.snapshot_date"""
oracle("join_eng_left", "select * from features_joined ")
oracle(
    "join_risk_left",
    f"""select r.Customer_ID, r.snapshot_date, {FEATURES} from cust_fin_risk r
left join engagement e on e.Customer_ID = r.Customer_ID and e.snapshot_date = r.snapshot_date""",
)
oracle(
    "join_full_outer",
    f"""select Customer_ID, snapshot_date, {FEATURES}
from engagement e
full join cust_fin_risk r using (Customer_ID, snapshot_date)""",
)


def nearest(column: str, direction: str) -> str:
    by = "(partition by Customer_ID order by snapshot_date rows between"
    earlier = f"last_value({column} ignore nulls) over {by} unbounded preceding and current row)"
    later = f"first_value({column} ignore nulls) over {by} current row and unbounded following)"
    value = {"forward": earlier, "backward": later, "both": f"coalesce({earlier}, {later})"}[direction]
    return f"{value} as {column}"


def filled(direction: str) -> str:
    columns = ", ".join(nearest(x, direction) for x in schemas.MODEL_FEATURES)
    return f"select Customer_ID, snapshot_date, {columns} from features_joined "


STEPS["features_filled"] = filled("both")
oracle("forward_fill", filled("forward"))
oracle("forward_fill_carried", filled("forward"))
oracle("backward_fill", filled("backward"))
oracle("two_way_fill", filled("both"))
STEPS["features_doubled"] = f"""
select Customer_ID, snapshot_date, {FEATURES} from features_joined
union all select Customer_ID, snapshot_date, {", ".join(f"{b} as {a}" for a, b in zip(schemas.MODEL_FEATURES, MOVED_FEATURES))}
from features_joined """
STEPS["features_by_date"] = f"""
select Customer_ID, snapshot_date, {", ".join(f"max({x}) as {x}" for x in schemas.MODEL_FEATURES)}
from features_doubled group by Customer_ID, snapshot_date"""
STEPS["features_carried"] = (
    f"select Customer_ID, snapshot_date, {', '.join(nearest(x, 'both') for x in schemas.MODEL_FEATURES)} from features_by_date "
)
oracle(
    "two_way_fill_by_date",
    f"""select d.Customer_ID, d.snapshot_date, {", ".join(f"coalesce(d.{x}, c.{x}) as {x}" for x in schemas.MODEL_FEATURES)}
from features_doubled d join features_carried c on d.Customer_ID = c.Customer_ID and d.snapshot_date = c.snapshot_date""",
)
STEPS["training_joined"] = f"""
select l.*, {FEATURES} from label_store l
left join features_filled f on l.Customer_ID = f.Customer_ID and l.snapshot_date = f.snapshot_date"""
COMPLETE = " and ".join(f"{x} is not null" for x in ["label", *schemas.MODEL_FEATURES])
oracle("training_frame", "select * from training_joined ")
oracle("drop_incomplete", f"select * from training_joined where {COMPLETE}")
STEPS["pairs"] = """
select Customer_ID, snapshot_date, model_name, label, model_predictions
from label_store join predictions using (Customer_ID, snapshot_date)
where label is not null and model_predictions is not null"""
oracle("label_prediction_join", "select * from pairs ")

# Aggregations

oracle("snapshot_median", "select * from age_median ")
oracle(
    "snapshot_counts",
    """select 'silver' as stage, snapshot_date, count(*) as n_rows from loan_silver group by snapshot_date
union all
select 'gold' as stage, snapshot_date, count(*) as n_rows from loan_silver where mob = 6 group by snapshot_date""",
)


def edges(source: str, group: str) -> str:
    """Breakpoints by rank: linear interpolation between the two neighbouring values."""
    return f"""
select {group}, list_distinct_sorted as edges from (
  select {group}, list(distinct v order by v) as list_distinct_sorted from (
    select {group}, i, case when t >= 0.5 then hi - (hi - lo) * (1 - t) else lo + (hi - lo) * t end as v from (
      select p.{group}, p.i, h - floor(h) as t,
             max(case when k = floor(h) then x end) as lo, max(case when k = ceil(h) then x end) as hi
      from (select {group}, i, cast(i as double) / 10 * (max(n) - 1) as h
            from (select {group}, count(*) as n from {source} group by {group}) g, range(11) s(i) group by {group}, i) p
      join (select {group}, model_predictions as x,
                   row_number() over (partition by {group} order by model_predictions) - 1 as k from {source} ) r
        on p.{group} = r.{group} and (r.k = floor(p.h) or r.k = ceil(p.h))
      group by p.{group}, p.i, p.h) q) u
  group by {group}) w"""


def binned(source: str, edge_source: str, group: str) -> str:
    return f"""
select {group}, bin, count(*) as n_rows from (
  select s.{group}, greatest(len(list_filter(edges, lambda e: e < model_predictions)), 1) as bin
  from {source} s join {edge_source} b on s.{group} = b.{group}
  where model_predictions >= edges[1] and model_predictions <= edges[-1]) t
group by {group}, bin"""


def psi(expected: str, actual: str, group: str) -> str:
    share = f"n_rows * 1.0::double / sum(n_rows) over (partition by {group})"
    return f"""
select {group}, sum((a - e) * ln(a / e)) as psi from (
  select {group}, bin, coalesce(x.s, 1e-6::double) as e, coalesce(y.s, 1e-6::double) as a
  from (select {group}, bin, {share} as s from {expected} ) x
  full join (select {group}, bin, {share} as s from {actual} ) y using ({group}, bin)) t
where {group} in (select {group} from {expected} ) and {group} in (select {group} from {actual} )
group by {group}"""


STEPS["snapshot_edges"] = edges("predictions", "snapshot_date")
STEPS["own_bins"] = binned("predictions", "snapshot_edges", "snapshot_date")
STEPS["next_edges"] = "select cast(snapshot_date + to_months(1) as date) as snapshot_date, edges from snapshot_edges "
STEPS["expected_bins"] = "select cast(snapshot_date + to_months(1) as date) as snapshot_date, bin, n_rows from own_bins "
STEPS["actual_bins"] = binned("predictions", "next_edges", "snapshot_date")
STEPS["snapshot_psi"] = psi("expected_bins", "actual_bins", "snapshot_date")
STEPS["early"] = f"select * from predictions where snapshot_date <= date '{DEVELOPMENT_END}'"
STEPS["late"] = f"select * from predictions where snapshot_date > date '{DEVELOPMENT_END}'"
STEPS["early_edges"] = edges("early", "model_name")
STEPS["early_bins"] = binned("early", "early_edges", "model_name")
STEPS["late_bins"] = binned("late", "early_edges", "model_name")
STEPS["window_psi"] = psi("early_bins", "late_bins", "model_name")

oracle(
    "quantile_breakpoints",
    """select snapshot_date, cast(unnest(range(len(edges))) as int) as position, unnest(edges) as breakpoint
from snapshot_edges """,
)
oracle(
    "binned_distribution",
    """select snapshot_date, cast(bin as int) as bin, n_rows,
       cast(n_rows as double) / sum(n_rows) over (partition by snapshot_date) as share from own_bins """,
)
oracle("psi", f"select {nine('psi')} as psi from window_psi ")
oracle("psi_by_snapshot", f"select 'm1' as model_name, snapshot_date, {nine('psi')} as psi from snapshot_psi ")

STEPS["snapshot_auc"] = """
select snapshot_date, cast(sum(p) as bigint) as n_pos, cast(sum(n) as bigint) as n_neg,
       cast(sum(p * (2 * below + n)) as double) / nullif(cast(2 * sum(p) * sum(n) as double), 0) as roc_auc
from (select *, sum(n) over (partition by snapshot_date order by x) - n as below
      from (select snapshot_date, model_predictions as x, sum(label) as p, sum(1 - label) as n
            from pairs group by snapshot_date, model_predictions) c) t
group by snapshot_date"""
oracle(
    "auc_gini",
    """select *, cast(round(cast(2 * roc_auc - 1 as decimal(18,12)), 3) as double) as gini from snapshot_auc """,
)
oracle(
    "score_density",
    f"""select 'm1' as model_name, g.snapshot_date, g.point, {nine("g.score")} as score,
       {nine("sum(exp(-0.5 * ((g.score - p.model_predictions) / h) * ((g.score - p.model_predictions) / h))) / max(n * h * sqrt(2 * pi()))")}
         as density
from (select *, lo - 3 * h + point * ((hi - lo + 6 * h) / 199) as score
      from (select snapshot_date, count(*) as n, min(model_predictions) as lo, max(model_predictions) as hi,
                   stddev_samp(model_predictions) * pow(cast(count(*) as double), -0.2) as h
            from predictions group by snapshot_date) s, (select cast(i as int) as point from range(200) r(i)) points) g
join predictions p on g.snapshot_date = p.snapshot_date
group by g.snapshot_date, g.point, g.score""",
)

oracle("psi_from_baselines", f"select 'm1' as model_name, snapshot_date, {nine('psi')} as psi from snapshot_psi ")
STEPS["density_settings"] = """
select snapshot_date, count(*) as n, min(model_predictions) as lo, max(model_predictions) as hi,
       stddev_samp(model_predictions) * pow(cast(count(*) as double), -0.2) as h
from predictions group by snapshot_date"""
STEPS["density_bins"] = """
select snapshot_date, bin, sum(share) as w from (
  select snapshot_date, floor(place) as bin, 1 - (place - floor(place)) as share from places
  union all select snapshot_date, floor(place) + 1, place - floor(place) from places ) b group by snapshot_date, bin"""
STEPS["places"] = """
select p.snapshot_date, (model_predictions - lo) / (h / 1000) as place
from predictions p join density_settings s on p.snapshot_date = s.snapshot_date"""
oracle(
    "score_density_binned",
    f"""select 'm1' as model_name, g.snapshot_date, g.point, {nine("g.score")} as score,
       {nine("sum(w * exp(-0.5 * pow((g.score - (lo + bin * (h / 1000))) / h, 2))) / max(n * h * sqrt(2 * pi()))")} as density
from (select *, lo - 3 * h + point * ((hi - lo + 6 * h) / 199) as score
      from density_settings s, (select cast(i as int) as point from range(200) r(i)) points) g
join density_bins b on g.snapshot_date = b.snapshot_date
group by g.snapshot_date, g.point, g.score""",
)

_EARLY_RISK = f"(select * from cust_fin_risk where snapshot_date <= date '{DEVELOPMENT_END}') e"
oracle(
    "scaler_fit",
    "\nunion all\n".join(
        f"select '{x}' as feature, {nine(f'avg({x})')} as mean, {nine(f'stddev_pop({x})')} as std from cust_fin_risk "
        for x in schemas.RISK_FEATURES
    ),
)
oracle(
    "scaler_transform",
    "select Customer_ID, snapshot_date, "
    + ", ".join(nine(f"(r.{x} - m_{x}) / (case when s_{x} = 0 then 1 else s_{x} end)") + f" as {x}" for x in schemas.RISK_FEATURES)
    + " from cust_fin_risk r, (select "
    + ", ".join(f"avg({x}) as m_{x}, stddev_pop({x}) as s_{x}" for x in schemas.RISK_FEATURES)
    + f" from {_EARLY_RISK}) p",
)

# Splits


def periods(train_date: str) -> dict[str, str]:
    oot_start = f"cast({train_date} - to_months(2) as date)"
    return {
        "oot_start": oot_start,
        "oot_end": f"{train_date} - 1",
        "train_test_start": f"cast({oot_start} - to_months(12) as date)",
        "train_test_end": f"{oot_start} - 1",
    }


HASH = "md5(concat_ws('|', Customer_ID, cast(snapshot_date as varchar), loan_id, '88'))"
THRESHOLD = f"case when substr({HASH}, 1, 8) < 'cccccccd' then 'train' else 'test' end"
_AT = periods(f"date '{TRAIN_DATE}'")
PERIOD = (
    f"case when snapshot_date between {_AT['oot_start']} and {_AT['oot_end']} then 'oot' "
    f"when snapshot_date between {_AT['train_test_start']} and {_AT['train_test_end']} then 'train_test' end"
)


def split_exactly(source: str) -> str:
    """Rows of the two periods: the label's lowest hashes train, the exact share of them."""
    return f"""select * exclude (period, k, n),
       case when period = 'oot' then 'oot' when k <= n - ceil(cast(n * 0.2 as decimal(28,6))) then 'train' else 'test' end as split
from (select *, row_number() over (partition by period, label order by {HASH}) as k,
             count(*) over (partition by period, label) as n
      from (select *, {PERIOD} as period from {source}) p where period is not null) t"""


oracle(
    "split_windows",
    "select train_date, "
    + ", ".join(f"{sql} as {n}" for n, sql in periods("train_date").items())
    + " from (select distinct snapshot_date as train_date from label_store ) t",
)
oracle("time_split", f"select * from (select *, {PERIOD} as period from label_store ) t where period is not null")
oracle(
    "stratified_split",
    f"""select * exclude (k, n), case when k <= n - ceil(cast(n * 0.2 as decimal(28,6))) then 'train' else 'test' end as split
from (select *, row_number() over (partition by label order by {HASH}) as k, count(*) over (partition by label) as n
      from label_store ) t""",
)
oracle("stratified_split_by_threshold", f"select *, {THRESHOLD} as split from label_store ")
oracle(
    "split_stats",
    f"""select split, count(*) as n_rows, cast(sum(label) as bigint) as n_bad, cast(sum(label) as double) / count(*) as label_mean
from ({split_exactly("label_store ")}) s group by split""",
)

# Monitoring

STEPS["report"] = """
select 'm1' as model_name, snapshot_date, psi as predict_psi, roc_auc,
       case when psi > 0.25 then 'CRITICAL' when psi > 0.1 then 'WARNING' else 'STABLE' end as psi_status,
       case when roc_auc is null then 'NO LABELS' when roc_auc < 0.65 then 'RETRAIN' else 'CLEAR' end as auc_status
from snapshot_psi left join snapshot_auc using (snapshot_date)"""
oracle("monitor_report", f"select * replace ({nine('predict_psi')} as predict_psi) from report ")
STEPS["flat"] = f"""
select * replace (case when snapshot_date = date '{FLAT_MONTH}' then 0.5 else model_predictions end as model_predictions)
from predictions """
STEPS["flat_edges"] = edges("flat", "snapshot_date")
STEPS["flat_own_bins"] = binned("flat", "flat_edges", "snapshot_date")
STEPS["flat_next_edges"] = STEPS["next_edges"].replace("snapshot_edges", "flat_edges")
STEPS["flat_expected"] = STEPS["expected_bins"].replace("own_bins", "flat_own_bins")
STEPS["flat_actual"] = binned("flat", "flat_next_edges", "snapshot_date")
STEPS["flat_psi"] = psi("flat_expected", "flat_actual", "snapshot_date")
STEPS["flat_report"] = f"""
select 'm1' as model_name, d.snapshot_date,
       case when d.snapshot_date <> date '{FLAT_MONTH}' + to_months(1) then psi end as predict_psi
from (select distinct cast(n.snapshot_date as date) as snapshot_date from flat_next_edges n
      join flat f on n.snapshot_date = f.snapshot_date) d left join flat_psi p on d.snapshot_date = p.snapshot_date"""
oracle(
    "monitor_flat_month",
    f"""select model_name, snapshot_date, {nine('predict_psi')} as predict_psi,
case when predict_psi > 0.25 then 'CRITICAL' when predict_psi > 0.1 then 'WARNING'
     when predict_psi is null then 'NO BINS' else 'STABLE' end as psi_status from flat_report """,
)
oracle("alert_tier", "select model_name, snapshot_date, psi_status, auc_status from report ")
oracle(
    "monitor_history",
    f"select model_name, snapshot_date, {nine('predict_psi')} as predict_psi, roc_auc from report ",
)
oracle("metric_trend", f"select model_name, snapshot_date, {nine('predict_psi')} as predict_psi from report ")

# Scores

STEPS["scored_features"] = f"""
select Customer_ID, snapshot_date, {", ".join(f"max({x}) as {x}" for x in schemas.MODEL_FEATURES)}
from (select r.Customer_ID, r.snapshot_date, {FEATURES} from cust_fin_risk r
      left join engagement e on e.Customer_ID = r.Customer_ID and e.snapshot_date = r.snapshot_date) t
group by Customer_ID, snapshot_date"""
STEPS["scaled_features"] = (
    "select Customer_ID, snapshot_date, "
    + ", ".join(f"coalesce(({x} - m_{x}) / (case when s_{x} = 0 then 1 else s_{x} end), 0) as {x}" for x in schemas.MODEL_FEATURES)
    + " from scored_features , (select "
    + ", ".join(f"avg({x}) as m_{x}, stddev_pop({x}) as s_{x}" for x in schemas.MODEL_FEATURES)
    + " from scored_features ) p"
)


def tree(node) -> str:
    if isinstance(node, float):
        return repr(node) + "::double"
    return f"case when {node[0]} <= {node[1]!r}::double then {tree(node[2])} else {tree(node[3])} end"


oracle(
    "score_scorecard",
    f"""select Customer_ID, snapshot_date, 'card' as model_name,
       {nine("1 / (1 + exp(-2 * (" + " + ".join(map(tree, SCORECARD)) + ")))")} as model_predictions from scaled_features """,
)

# Pipelines

oracle("label_store_pipeline", labels(30, 6))
_GOLD = [x for x in schemas.FINANCIAL_COLUMNS if x not in [*schemas.KEYS, *schemas.FEATURE_STORE_DROPS]]
oracle(
    "feature_store_pipeline",
    f"""select c.*, Age, Occupation, {", ".join(_GOLD)}, f.snapshot_date as feature_snapshot_date from click_silver c
left join (select * from attr_silver join fin_silver using (Customer_ID, snapshot_date)) f
on c.Customer_ID = f.Customer_ID and c.snapshot_date = f.snapshot_date""",
)
oracle(
    "training_set_pipeline",
    split_exactly(f"training_joined where {COMPLETE}"),
)
STEPS["clicks_joined"] = f"""
select l.*, {", ".join(f"fe_{i}" for i in range(1, 7))} from label_store l
left join click_silver c on l.Customer_ID = c.Customer_ID and l.snapshot_date = c.snapshot_date"""
oracle("clickstream_training_set", split_exactly("clicks_joined "))

# What SQL can say of trained models

STEPS["trained_rows"] = split_exactly(f"training_joined where {COMPLETE}")
oracle(
    "split_auc_counts",
    """select split, count(*) as n_rows, cast(sum(label) as bigint) as n_bad, cast(sum(label) as double) / count(*) as label_mean
from trained_rows group by split""",
)
for _name in ("model_reload", "score_by_stage"):
    oracle(_name, "select count(*) as n_rows, cast(0 as bigint) as n_differ from trained_rows ")
oracle(
    "score_backfill_keys",
    """select Customer_ID, snapshot_date, 'm1' as model_name, true as in_range from cust_fin_risk
where snapshot_date between date '2023-01-01' and date '2030-01-01'""",
)
oracle(
    "feature_importance_sum",
    f"select cast({len(schemas.MODEL_FEATURES)} as bigint) as n_features, 1.0::double as total from (select count(*) as n from label_store ) t",
)
