"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the derived risk tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelens import schemas
from vintagelens.functions import cleaning as c
from vintagelens.functions import delinquency
from vintagelens.functions.scores import gini
from vintagelens.operators import drift, features, fills, impute, modelling, monitoring, ranking, rows, scaling
from vintagelens.operators import silver, splits
from vintagelens.operators.treesql import Ensemble, Scale
from vintagelens.plans import backfill, feature_store, history, label_store, scoring, training
from vintagelens.plans.datamart import Datamart
from vintagelens.session import apply_settings, new_table_path
from vintagelens.sources import calendar, feeds, snapshots
from vintagelens.sources.derived import derive

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = schemas.KEYS
LOAN_MONTH = "1997-03-01"
MONTH = "2023-05-01"
TRAIN_DATE = "2024-09-01"
DEVELOPMENT_END = "2023-12-01"
MODEL = "m1"
MOVED_FEATURES = [*schemas.MODEL_FEATURES[1:], schemas.MODEL_FEATURES[0]]

# The checks search the scheduled trainer's whole grid with fewer draws than its 100: with three
# folds and the refit, that is seven fits. Only the number of draws is lowered. The training
# pipeline searches with all draws.
CHECK_DRAWS = 2
PIPELINE_DRAWS = modelling.DRAWS
# Periods of the carried fill and of the backfill that stops and goes on.
FILL_PERIODS = [("2023-01-01", "2023-04-01"), ("2023-05-01", "2023-05-01"), ("2023-06-01", "2025-12-01")]
BACKFILL = ("1996-01-01", "1999-12-01")
BACKFILL_STOP = "1997-06-01"
# A small fixed ensemble in the scaled features: (feature, threshold, left, right), leaves times weight.
# It stands for a fitted one where SQL has to know the trees beforehand.
SCORECARD = [
    ("Num_Fin_Pdts", 0.137, ("click_6m", -0.271, -0.31, 0.12), ("Outstanding_Debt", 0.613, 0.27, ("Interest_Rate", -0.419, -0.08, 0.45))),
    ("Credit_History_Age", -0.523, ("Loan_Extent", 0.211, 0.19, -0.23), ("click_1m", 0.333, -0.14, 0.09)),
    ("Delay_from_due_date", 0.777, ("EMI_to_Salary", -0.101, 0.05, -0.17), 0.21),
]
FLAT_MONTH = "2023-05-01"
RERUN_GONE = "2023-05-01"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(apply_settings(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


def nine_places(column: Column | str) -> Column:
    """Value to nine decimals: sums of doubles and logarithms differ in the last digits."""
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("decimal(28,9)").cast("double")


# Tables and models that several queries read are stored once per session and input.
_stored: dict[tuple, object] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def stored_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    def write() -> str:
        path = new_table_path(spark, name)
        snapshots.write_snapshots(build(), path)
        return path

    return stored(spark, sf_dir, name, write)


def label_table(spark: SparkSession, sf_dir: str) -> str:
    return stored_table(spark, sf_dir, "label_store", lambda: derive(spark, sf_dir, "label_store"))


def monitor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_table(spark, sf_dir, "monitor", lambda: monitor_report(spark, sf_dir))
    return snapshots.read_all(spark, path)


def risk_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(derive(spark, sf_dir, t) for t in ("label_store", "engagement", "cust_fin_risk"))


def step_store(spark: SparkSession) -> training.Store:
    def store(name: str, table: DataFrame) -> DataFrame:
        path = new_table_path(spark, name)
        table.write.parquet(path)
        return spark.read.schema(table.schema).parquet(path)

    return store


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: training.training_set(*risk_tables(spark, sf_dir), TRAIN_DATE, store=step_store(spark))
    return snapshots.read_all(spark, stored_table(spark, sf_dir, "training_set", build))


def trained(spark: SparkSession, sf_dir: str) -> training.Trained:
    def build() -> training.Trained:
        rows_, path = training_rows(spark, sf_dir), new_table_path(spark, "model")
        return training.train(rows_, schemas.MODEL_FEATURES, MODEL, TRAIN_DATE, path, draws=CHECK_DRAWS)

    return stored(spark, sf_dir, "trained", build)


# Sources and sinks


@query
def bronze_loan_ingest(spark, d):
    return feeds.bronze(derive(spark, d, "loan_feed"), LOAN_MONTH, LOAN_MONTH)


@query
def bronze_feature_ingest(spark, d):
    return feeds.bronze(derive(spark, d, "clickstream_raw"), "2023-01-01", "2024-12-01")


@query
def read_one_snapshot(spark, d):
    return snapshots.read_one(spark, label_table(spark, d), MONTH).select(*schemas.LABEL_COLUMNS)


@query
def read_all_snapshots(spark, d):
    return snapshots.read_all(spark, label_table(spark, d)).select(*schemas.LABEL_COLUMNS)


@query
def read_snapshot_list(spark, d):
    wanted = ["2022-12-01", "2023-02-01", "2023-07-01", "2024-01-01"]
    return snapshots.read_listed(spark, label_table(spark, d), wanted).select(*schemas.LABEL_COLUMNS)


@query
def write_predictions(spark, d):
    path = new_table_path(spark, "predictions")
    scoring.write_predictions(derive(spark, d, "predictions"), path)
    return snapshots.read_all(spark, path).select(*schemas.PREDICTION_COLUMNS)


@query
def monitor_history(spark, d):
    monitor = monitor_table(spark, d).select("model_name", "snapshot_date", "predict_psi", "roc_auc")
    new = F.col("snapshot_date") > F.lit(DEVELOPMENT_END).cast("date")
    return monitoring.with_history(monitor.where(~new), monitor.where(new))


@query
def metric_trend(spark, d):
    return monitoring.metric_trend(monitor_table(spark, d), "predict_psi")


@query
def label_store_rerun(spark, d):
    """Labels written, rerun with a snapshot gone, and with a second definition beside the first."""
    labels, path, whole = derive(spark, d, "label_store"), new_table_path(spark, "labels"), ("1990-01-01", "2100-01-01")
    other = labels.withColumn("label_def", F.lit("60dpd_6mob"))
    label_store.write_labels(labels, path, "30dpd_6mob", *whole)
    label_store.write_labels(other, path, "60dpd_6mob", *whole)
    rerun = labels.where(F.col("snapshot_date") != F.lit(RERUN_GONE).cast("date"))
    label_store.write_labels(rerun, path, "30dpd_6mob", *whole)
    return snapshots.read_all(spark, path).select(*schemas.LABEL_COLUMNS)


@query
def snapshot_calendar(spark, d):
    return calendar.snapshot_calendar(derive(spark, d, "loan_snapshots"), "snapshot_date")


@query
def csv_round_trip(spark, d):
    """The loan feed written as CSV files and scanned again as text; blank fields are NULL."""
    path = new_table_path(spark, "feed")
    derive(spark, d, "loan_feed").write.option("header", True).csv(path)
    return feeds.read_feed(spark, path)


@query
def quarantine_loans(spark, d):
    """Rows of the scanned feed that hold text which does not parse, with line and reasons."""
    path = new_table_path(spark, "feed")
    derive(spark, d, "loan_feed").write.option("header", True).csv(path)
    _, held = feeds.sort_out(feeds.read_feed(spark, path, with_file=True), schemas.LOAN_TYPES)
    known = F.col("file").endswith(".csv").alias("has_file")
    return held.select("loan_id", "installment_num", "snapshot_date", F.concat_ws("; ", "reasons").alias("reasons"), known)


@query
def quarantine_counts(spark, d):
    return feeds.quarantine_counts(derive(spark, d, "loan_feed"), schemas.LOAN_TYPES)


@query
def backfill_resumed(spark, d):
    """A backfill that stops after two stages of half its period, goes on, and meets changed rows."""
    mart = Datamart(new_table_path(spark, "mart"))
    ledger = derive(spark, d, "loan_snapshots")
    late = F.col("snapshot_date") == F.lit(BACKFILL_STOP).cast("date")
    # The last snapshot of the half arrives without its overdue amounts at first.
    backfill.run(ledger.withColumn("overdue_amt", F.when(~late, F.col("overdue_amt"))), mart, BACKFILL[0], BACKFILL_STOP, stages=["bronze", "silver"])
    backfill.run(ledger, mart, *BACKFILL)
    return snapshots.read_all(spark, mart.label_store, schemas.LABELS).select(*schemas.LABEL_COLUMNS)


@query
def write_interrupted(spark, d):
    """Labels whose rewrite dies after its intent was recorded; the next write finishes it first."""
    labels, path, whole = derive(spark, d, "label_store"), new_table_path(spark, "labels"), ("1990-01-01", "2100-01-01")
    columns = ["label_def", "snapshot_date"]
    snapshots.write_snapshots(labels, path, columns, period=whole)
    gone = F.col("snapshot_date") == F.lit(RERUN_GONE).cast("date")
    snapshots.stage(labels.where(~gone).withColumn("label", 1 - F.col("label")), path, columns, whole)
    other = labels.withColumn("label_def", F.lit("60dpd_6mob"))
    snapshots.write_snapshots(other, path, columns, period=whole, within={"label_def": "60dpd_6mob"})
    return snapshots.read_all(spark, path, schemas.LABELS).select(*schemas.LABEL_COLUMNS)


# Projections, filters, predicates


@query
def filter_snapshot_eq(spark, d):
    return snapshots.snapshot_equals(derive(spark, d, "loan_snapshots"), LOAN_MONTH)


@query
def filter_snapshot_range(spark, d):
    return snapshots.snapshot_between(derive(spark, d, "label_store"), "2023-03-01", "2024-02-01")


@query
def loan_schema_cast(spark, d):
    return silver.cast_to_schema(derive(spark, d, "loan_feed"), schemas.LOAN_TYPES)


@query
def clickstream_silver(spark, d):
    return silver.clickstream(derive(spark, d, "clickstream_raw"))


@query
def select_by_prefix(spark, d):
    return rows.select_by_prefix(derive(spark, d, "clickstream_raw"), schemas.CLICKSTREAM_PREFIX, KEYS)


@query
def fill_numeric_zero(spark, d):
    return rows.fill_numeric_zero(silver.cast_to_schema(derive(spark, d, "loan_feed"), schemas.LOAN_TYPES))


@query
def drop_incomplete(spark, d):
    return rows.drop_incomplete(training_frame(spark, d))


@query
def actual_bads(spark, d):
    flag = delinquency.past_due_flag(30).alias("dpd_flag")
    loans = silver.loans(derive(spark, d, "loan_snapshots"))
    return rows.rows_at_instalment(loans.select("loan_id", "snapshot_date", "installment_num", "dpd", flag), 7)


@query
def bad_rate_curve(spark, d):
    return rows.bad_rate_curve(silver.loans(derive(spark, d, "loan_snapshots")), "1999-01-01")


@query
def dq_attributes(spark, d):
    return silver.attribute_quality(derive(spark, d, "attributes_raw"))


@query
def dq_feed(spark, d):
    return feeds.feed_counts(derive(spark, d, "loan_feed"), "1993-01-01", "1997-12-01")


@query
def dq_loans(spark, d):
    return silver.loan_quality(silver.loans(derive(spark, d, "loan_snapshots")))


@query
def dq_missing_medians(spark, d):
    """Every fourth snapshot loses its limits first, so that there is something to count."""
    raw = derive(spark, d, "financials_raw")
    gone = F.when(F.month("snapshot_date") % 4 != 0, F.col("Changed_Credit_Limit"))
    return silver.missing_medians(raw.withColumn("Changed_Credit_Limit", gone))


@query
def top_rows(spark, d):
    shown = ["snapshot_date", "loan_id", "installment_num", "due_amt", "loan_amt", "dpd", "paid_amt", "overdue_amt"]
    order = [F.desc(x) if x in ("due_amt", "dpd") else x for x in shown]
    return rows.top_rows(silver.loans(derive(spark, d, "loan_snapshots")).select(*shown), 20, order)


# Scalar functions


@query
def strip_cast(spark, d):
    return derive(spark, d, "financials_raw").select(
        *KEYS,
        c.strip_cast("Annual_Income", c.NON_DECIMALS, "float").alias("Annual_Income"),
        c.strip_cast("Monthly_Balance", c.NON_DECIMALS, "float").alias("Monthly_Balance"),
        c.strip_cast("Num_of_Delayed_Payment", c.NON_DIGITS, "int").alias("Num_of_Delayed_Payment"),
        c.strip_cast("Num_of_Loan", c.UNDERSCORES, "int").alias("Num_of_Loan"),
    )


@query
def placeholder_unknown(spark, d):
    financials, attributes = derive(spark, d, "financials_raw"), derive(spark, d, "attributes_raw")
    cleaned = financials.select(
        *KEYS,
        c.credit_mix("Credit_Mix").alias("Credit_Mix"),
        c.payment_behaviour("Payment_Behaviour").alias("Payment_Behaviour"),
    )
    occupations = attributes.select(*KEYS, c.occupation("Occupation").alias("Occupation"))
    return occupations.join(cleaned, KEYS, "left")


@query
def impute_age_median(spark, d):
    return silver.attributes(derive(spark, d, "attributes_raw"))


@query
def impute_limit_median(spark, d):
    parsed = silver.parsed_financials(derive(spark, d, "financials_raw"))
    return impute.impute_limit(parsed.select(*KEYS, "Changed_Credit_Limit"))


@query
def loan_count_repair(spark, d):
    count = c.loan_count("Num_of_Loan", "Type_of_Loan").alias("Num_of_Loan_repaired")
    return derive(spark, d, "financials_raw").select(*KEYS, "Num_of_Loan", count)


@query
def loan_type_norm(spark, d):
    types = c.loan_types(c.loan_count("Num_of_Loan", "Type_of_Loan"), "Type_of_Loan")
    return derive(spark, d, "financials_raw").select(*KEYS, types.alias("Type_of_Loan"))


@query
def credit_history_months(spark, d):
    months = c.duration_months("Credit_History_Age").alias("Credit_History_Age_Months")
    return derive(spark, d, "financials_raw").select(*KEYS, "Credit_History_Age", months)


@query
def affordability_ratios(spark, d):
    return silver.parsed_financials(derive(spark, d, "financials_raw")).select(
        *KEYS,
        c.ratio("Total_EMI_per_month", "Monthly_Inhand_Salary").alias("EMI_to_Monthly_Income_Ratio"),
        c.ratio("Outstanding_Debt", "Monthly_Inhand_Salary").alias("Debt_to_Monthly_Income_Ratio"),
    )


@query
def installments_missed(spark, d):
    missed = delinquency.installments_missed().alias("installments_missed")
    return derive(spark, d, "loan_snapshots").select("loan_id", "snapshot_date", "overdue_amt", "due_amt", missed)


@query
def days_past_due(spark, d):
    return silver.loans(derive(spark, d, "loan_snapshots"))


@query
def loan_label(spark, d):
    return silver.labels(silver.loans(derive(spark, d, "loan_snapshots")), days=31, months_on_book=3)


@query
def arrears_edge(spark, d):
    """Arrears far beyond any calendar: amounts due are cut to as little as 1e-12 of what they were."""
    loans = derive(spark, d, "loan_snapshots")
    small = F.col("due_amt").cast("double") * F.pow(F.lit(10.0), -3 * (F.col("installment_num") % 5))
    late = silver.loans(loans.withColumn("due_amt", small.cast("float")))
    label = delinquency.past_due_flag(30).alias("label")
    return late.select("loan_id", "snapshot_date", "installment_num", "installments_missed", "dpd", label)


@query
def parse_snapshot_date(spark, d):
    return derive(spark, d, "loan_feed").select(
        "loan_id",
        c.parse_date("loan_start_date").alias("loan_start_date"),
        c.parse_date("snapshot_date").alias("snapshot_date"),
    )


# Joins


@query
def join_attr_fin(spark, d):
    return features.attributes_with_financials(
        silver.attributes(derive(spark, d, "attributes_raw")), silver.financials(derive(spark, d, "financials_raw"))
    )


@query
def join_click_left(spark, d):
    profile = silver.attributes(derive(spark, d, "attributes_raw"))
    return features.with_clickstream(silver.clickstream(derive(spark, d, "clickstream_raw")), profile)


def _model_features(spark: SparkSession, d: str, base: str) -> DataFrame:
    joined = features.model_features(derive(spark, d, "engagement"), derive(spark, d, "cust_fin_risk"), base)
    return joined.select(*KEYS, *schemas.MODEL_FEATURES)


@query
def join_eng_left(spark, d):
    return _model_features(spark, d, "engagement")


@query
def join_risk_left(spark, d):
    return _model_features(spark, d, "risk")


@query
def join_full_outer(spark, d):
    return _model_features(spark, d, "both")


@query
def training_frame(spark, d):
    labels, engagement, risk = risk_tables(spark, d)
    joined = step_store(spark)("features", features.model_features(engagement, risk))
    return features.training_frame(labels, fills.fill_history(joined, schemas.MODEL_FEATURES))


@query
def label_prediction_join(spark, d):
    return features.labelled_predictions(derive(spark, d, "label_store"), derive(spark, d, "predictions"))


# Aggregations


@query
def snapshot_median(spark, d):
    parsed = silver.parsed_attributes(derive(spark, d, "attributes_raw"))
    return impute.snapshot_median(parsed, "Age", F.col("Age").between(18, 100))


@query
def snapshot_counts(spark, d):
    loans = silver.loans(derive(spark, d, "loan_snapshots"))
    return rows.snapshot_counts({"silver": loans, "gold": silver.labels(loans)})


@query
def split_stats(spark, d):
    labels = snapshots.read_all(spark, label_table(spark, d))
    return splits.split_stats(training.split_rows(labels, TRAIN_DATE))


@query
def quantile_breakpoints(spark, d):
    edges = drift.breakpoints(derive(spark, d, "predictions"), ["snapshot_date"], "model_predictions")
    return edges.select("snapshot_date", F.posexplode("edges").alias("position", "breakpoint"))


@query
def binned_distribution(spark, d):
    predictions = derive(spark, d, "predictions")
    edges = drift.breakpoints(predictions, ["snapshot_date"], "model_predictions")
    counts = drift.histogram(predictions, edges, ["snapshot_date"], "model_predictions")
    return drift.shares(counts, ["snapshot_date"])


@query
def psi(spark, d):
    predictions = derive(spark, d, "predictions")
    development = F.col("snapshot_date") <= F.lit(DEVELOPMENT_END).cast("date")
    index = drift.psi(predictions.where(development), predictions.where(~development), [], "model_predictions")
    return index.select(nine_places("psi").alias("psi"))


@query
def psi_by_snapshot(spark, d):
    index = drift.psi_by_snapshot(derive(spark, d, "predictions"), ["model_name"])
    return index.select("model_name", "snapshot_date", nine_places("psi").alias("psi"))


@query
def auc_gini(spark, d):
    pairs = features.labelled_predictions(derive(spark, d, "label_store"), derive(spark, d, "predictions"))
    quality = ranking.auc(pairs, ["snapshot_date"], "label", "model_predictions")
    return quality.withColumn("gini", gini("roc_auc"))


@query
def score_density(spark, d):
    density = drift.score_density(derive(spark, d, "predictions"), ["model_name", "snapshot_date"], "model_predictions")
    rounded = [nine_places(x).alias(x) for x in ("score", "density")]
    return density.select("model_name", "snapshot_date", "point", *rounded)


@query
def score_density_binned(spark, d):
    density = drift.score_density_binned(derive(spark, d, "predictions"), ["model_name", "snapshot_date"], "model_predictions")
    rounded = [nine_places(x).alias(x) for x in ("score", "density")]
    return density.select("model_name", "snapshot_date", "point", *rounded)


@query
def psi_from_baselines(spark, d):
    """PSI of every snapshot against stored bin edges and counts of the one before."""
    predictions, path = derive(spark, d, "predictions"), new_table_path(spark, "baselines")
    snapshots.write_snapshots(drift.baselines(predictions, ["model_name"]), path, ["model_name", "snapshot_date"])
    stored_ = snapshots.read_all(spark, path, schemas.BASELINES)
    index = drift.psi_from_baselines(predictions, stored_, ["model_name"])
    return index.select("model_name", "snapshot_date", nine_places("psi").alias("psi"))


@query
def scaler_fit(spark, d):
    fitted = scaling.scaler_fit(derive(spark, d, "cust_fin_risk"), schemas.RISK_FEATURES)
    return fitted.select("feature", nine_places("mean").alias("mean"), nine_places("std").alias("std"))


@query
def scaler_transform(spark, d):
    risk = derive(spark, d, "cust_fin_risk")
    early = risk.where(F.col("snapshot_date") <= F.lit(DEVELOPMENT_END).cast("date"))
    transformed = scaling.scaler_transform(risk, early, schemas.RISK_FEATURES)
    return transformed.select(*KEYS, *[nine_places(f).alias(f) for f in schemas.RISK_FEATURES])


# Fills and splits


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    path = stored_table(spark, d, "features", lambda: _model_features(spark, d, "engagement"))
    return snapshots.read_all(spark, path).select(*KEYS, *schemas.MODEL_FEATURES)


def _fill(spark: SparkSession, d: str, direction: str) -> DataFrame:
    return fills.fill_history(feature_rows(spark, d), schemas.MODEL_FEATURES, direction)


@query
def forward_fill(spark, d):
    return _fill(spark, d, "forward")


@query
def forward_fill_carried(spark, d):
    """The forward fill period by period, each from the stored state of the one before."""
    rows_, path = feature_rows(spark, d), new_table_path(spark, "carried")
    for start, end in FILL_PERIODS:
        history.fill_period(rows_, f"{path}/filled", f"{path}/state", start, end, schemas.MODEL_FEATURES)
    return snapshots.read_all(spark, f"{path}/filled", schemas.JOINED).select(*KEYS, *schemas.MODEL_FEATURES)


@query
def backward_fill(spark, d):
    return _fill(spark, d, "backward")


@query
def two_way_fill(spark, d):
    return _fill(spark, d, "both")


@query
def two_way_fill_by_date(spark, d):
    """Rows that share a date: each row twice, the second time with the columns' values moved on."""
    rows_ = feature_rows(spark, d)
    moved = [F.col(b).alias(a) for a, b in zip(schemas.MODEL_FEATURES, MOVED_FEATURES, strict=True)]
    return fills.fill_history(rows_.unionByName(rows_.select(*KEYS, *moved)), schemas.MODEL_FEATURES, "both")


@query
def split_windows(spark, d):
    dates = derive(spark, d, "label_store").select(F.col("snapshot_date").alias("train_date")).distinct()
    return dates.select("train_date", *[w.alias(n) for n, w in splits.split_windows(F.col("train_date")).items()])


@query
def time_split(spark, d):
    return splits.time_split(derive(spark, d, "label_store"), TRAIN_DATE)


@query
def stratified_split(spark, d):
    return splits.stratified_split(derive(spark, d, "label_store"), "label", training.SPLIT_KEYS)


@query
def stratified_split_by_threshold(spark, d):
    return splits.hash_split(derive(spark, d, "label_store"), training.SPLIT_KEYS)


# Monitoring


@query
def monitor_report(spark, d):
    report = monitoring.monitor_report(derive(spark, d, "predictions"), derive(spark, d, "label_store"))
    return report.withColumn("predict_psi", nine_places("predict_psi"))


@query
def monitor_flat_month(spark, d):
    """A month of equal scores: no PSI for the month after it, all others as ever."""
    predictions = derive(spark, d, "predictions")
    flat = F.when(F.col("snapshot_date") == F.lit(FLAT_MONTH).cast("date"), 0.5).otherwise(F.col("model_predictions"))
    report = monitoring.monitor_report(predictions.withColumn("model_predictions", flat), derive(spark, d, "label_store"))
    return report.select("model_name", "snapshot_date", nine_places("predict_psi").alias("predict_psi"), "psi_status")


@query
def alert_tier(spark, d):
    return monitor_table(spark, d).select("model_name", "snapshot_date", "psi_status", "auc_status")


# Model jobs


@query
def train_gbt(spark, d):
    train = training_rows(spark, d).where(F.col("split") == "train")
    model = modelling.fit(train, schemas.MODEL_FEATURES, {"n_estimators": 25, "max_depth": 3})
    return modelling.score(model, train, MODEL)


@query
def random_search(spark, d):
    return trained(spark, d).trials


@query
def split_auc(spark, d):
    return trained(spark, d).report


@query
def feature_importance(spark, d):
    return modelling.feature_importance(spark, trained(spark, d).model, schemas.MODEL_FEATURES)


@query
def model_registry(spark, d):
    path = new_table_path(spark, "registry")
    snapshots.write_snapshots(trained(spark, d).registry, path, ["model_name"])
    return snapshots.read_all(spark, path)


def _score(spark: SparkSession, d: str, start: str, end: str) -> DataFrame:
    model = modelling.load_model(trained(spark, d).registry.first().model_path)
    _, engagement, risk = risk_tables(spark, d)
    return scoring.score_snapshots(model, MODEL, engagement, risk, start, end)


def scorecard(spark: SparkSession, d: str) -> Ensemble:
    """The fixed trees, with the scaler fitted on all features that are scored."""
    names = schemas.MODEL_FEATURES
    p = scaling.scaler_row(_model_features(spark, d, "risk"), names).first()

    def placed(node):
        return node if isinstance(node, float) else (names.index(node[0]), node[1], placed(node[2]), placed(node[3]))

    return Ensemble(names, [Scale(p[f"mean_{c}"], p[f"std_{c}"] or 1.0) for c in names], [placed(t) for t in SCORECARD])


@query
def score_scorecard(spark, d):
    """Scores of all snapshots by compiled trees: split values against SQL that scales first."""
    _, engagement, risk = risk_tables(spark, d)
    scores = scoring.score_snapshots(scorecard(spark, d), "card", engagement, risk, "2023-01-01", "2030-01-01")
    return scores.withColumn("model_predictions", nine_places("model_predictions"))


@query
def model_reload(spark, d):
    """Rows scored by the model in memory and by the stored one read back, and how many differ."""
    kept = trained(spark, d)
    rows_ = training_rows(spark, d)
    loaded = modelling.ensemble(modelling.load_model(kept.registry.first().model_path))
    both = loaded.with_score(modelling.ensemble(kept.model).with_score(rows_, "_memory"), "_loaded")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_memory") != F.col("_loaded")).alias("n_differ"))


@query
def score_by_stage(spark, d):
    """Rows scored by the compiled trees and by the library's own transformation, and how many differ."""
    kept, rows_ = trained(spark, d), training_rows(spark, d)
    both = modelling.ensemble(kept.model).with_score(kept.model.transform(rows_), "_compiled")
    apart = F.abs(vector_to_array("probability")[1] - F.col("_compiled")) > 1e-12
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(apart).alias("n_differ"))


@query
def score_snapshot(spark, d):
    return _score(spark, d, TRAIN_DATE, TRAIN_DATE)


@query
def score_backfill(spark, d):
    return _score(spark, d, "2023-01-01", "2030-01-01")


# Pipelines


@query
def label_store_pipeline(spark, d):
    return label_store.label_store(derive(spark, d, "loan_snapshots"))


@query
def feature_store_pipeline(spark, d):
    return feature_store.feature_store(
        derive(spark, d, "attributes_raw"), derive(spark, d, "financials_raw"), derive(spark, d, "clickstream_raw")
    )


@query
def training_set_pipeline(spark, d):
    return training.training_set(*risk_tables(spark, d), TRAIN_DATE, store=step_store(spark))


@query
def clickstream_training_set(spark, d):
    clicks = silver.clickstream(derive(spark, d, "clickstream_raw"))
    return training.clickstream_training_set(derive(spark, d, "label_store"), clicks, TRAIN_DATE, step_store(spark))


@query
def score_backfill_keys(spark, d):
    """Keys of all scores, and whether each lies in range: what SQL can say of a model's output."""
    inside = F.col("model_predictions").between(0, 1).alias("in_range")
    return score_backfill(spark, d).select(*KEYS, "model_name", inside)


@query
def split_auc_counts(spark, d):
    """Rows and labels of each split of the trained model's report."""
    return trained(spark, d).report.select("split", "n_rows", "n_bad", "label_mean")


@query
def feature_importance_sum(spark, d):
    """Number of features in the importances, and their sum, which is one."""
    weights = feature_importance(spark, d)
    return weights.agg(F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).alias("total"))


@query
def train_pipeline(spark, d):
    path = new_table_path(spark, "model")
    rows_path = new_table_path(spark, "rows")
    training_set_pipeline(spark, d).write.parquet(rows_path)
    rows_ = spark.read.parquet(rows_path)
    return training.train(rows_, schemas.MODEL_FEATURES, MODEL, TRAIN_DATE, path, draws=PIPELINE_DRAWS).report


@query
def score_pipeline(spark, d):
    path = new_table_path(spark, "predictions")
    scoring.write_predictions(score_backfill(spark, d), path)
    return snapshots.read_all(spark, path).select(*schemas.PREDICTION_COLUMNS)
