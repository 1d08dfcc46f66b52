"""The queries. Each takes (spark, folder of the generated tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.catalog import study as S
from ebbline.functions.stamps import within_days
from ebbline.functions.values import round_half_up
from ebbline.names import TARGET
from ebbline.operators import contributions as ctb
from ebbline.operators import decision as dec
from ebbline.operators import drift as dr
from ebbline.operators import drift_state as ds
from ebbline.operators import encoding as enc
from ebbline.operators import features as ft
from ebbline.operators import gates
from ebbline.operators import isotonic as iso
from ebbline.operators import labels as lb
from ebbline.operators import metrics as mt
from ebbline.operators import models as md
from ebbline.operators import performance as pf
from ebbline.operators import prep
from ebbline.operators import profiles as pr
from ebbline.operators import reports as rp
from ebbline.operators import snapshots as sn
from ebbline.session import pin, shared_folder, store, tune
from ebbline.sources import commits, lake
from ebbline.sources.star import Commerce, commerce
from ebbline.sources.telemetry import current_telemetry, partition_statuses

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[SparkSession, Commerce], DataFrame]) -> Callable:
    """Register a builder under its own name; it is handed the commerce tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        tune(spark)
        return build(spark, commerce(spark, folder))

    QUERIES[build.__name__] = run
    return build


# --- shared inputs ---------------------------------------------------------------------


def _features(c: Commerce, end: str = S.CUTOFF) -> DataFrame:
    return ft.feature_matrix(*c, S.START, end)


def _labelled(c: Commerce, end: str = S.CUTOFF) -> DataFrame:
    return lb.labelled_features(*c, S.START, end, S.WINDOW_DAYS)


def _split(c: Commerce) -> DataFrame:
    return prep.hash_split(_labelled(c), seed=S.SEED)


def _train(c: Commerce) -> DataFrame:
    return _split(c).where(F.col("split") == "train")


def _train_features(c: Commerce) -> DataFrame:
    """Training rows without labels: a row's part depends on its key alone."""
    return prep.hash_split(_features(c), seed=S.SEED).where(F.col("split") == "train")


def _recency_score() -> Column:
    odds = F.exp(-(F.col("recency_days") - 180) / F.lit(90.0))
    return round_half_up(F.lit(1.0) / (F.lit(1.0) + odds), 6)


def _frequency_score() -> Column:
    odds = F.exp((F.col("frequency") - 8) / F.lit(3.0))
    return round_half_up(F.lit(1.0) / (F.lit(1.0) + odds), 6)


def _scored(df: DataFrame) -> DataFrame:
    return df.withColumn(S.PREDICTION, _recency_score())


def _test_scores(c: Commerce) -> DataFrame:
    """Test rows scored by two models: (model, segment, label, probability)."""
    test = _split(c).where(F.col("split") == "test")
    models = F.array(
        F.struct(F.lit("challenger").alias("model"), _recency_score().alias(S.PREDICTION)),
        F.struct(F.lit("champion").alias("model"), _frequency_score().alias(S.PREDICTION)),
    )
    return test.select("customer_unique_id", "customer_state", TARGET, F.inline(models))


def _profile(c: Commerce) -> DataFrame:
    train = store(_scored(_train_features(c)))
    return pr.binned_profile(train, [*S.NUMERICAL, S.PREDICTION], S.CATEGORICAL, S.N_BINS)


def _frozen_profile(c: Commerce) -> DataFrame:
    """The profile as monitoring meets it: written once, then only read."""
    return pin(_profile(c))


def _telemetry(c: Commerce) -> DataFrame:
    return rp.telemetry_log(_scored(_features(c, S.EXECUTION)), S.RUN)


def _evaluation(c: Commerce) -> DataFrame:
    then = store(_scored(_features(c, S.LOOKBACK)).select("customer_unique_id", S.PREDICTION))
    labels = lb.matured_labels(then, lb.future_targets(*c, S.LOOKBACK, S.WINDOW_DAYS))
    return pf.evaluation_join(then.select("customer_unique_id", S.PREDICTION), labels)


def _run_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"model_run_id": F.lit(S.MODEL), "execution_date": F.lit(S.EXECUTION)})


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: round_half_up(F.col(n), digits) for n in names})


# --- features and labels ---------------------------------------------------------------


@query
def feature_snapshots(spark, c):
    """Features of three snapshot days in one pass."""
    return sn.feature_snapshots(*c, S.START, S.SNAPSHOTS)


@query
def feature_matrix(spark, c):
    return _features(c)


@query
def masked_orders(spark, c):
    return ft.visible_orders(c.orders, S.START, S.CUTOFF)


@query
def payments_per_order(spark, c):
    paid = ft.payments_per_order(c.payments)
    return paid.withColumn("order_payment_value", F.col("order_payment_value").cast("double"))


@query
def enriched_orders(spark, c):
    rows = ft.enriched_orders(*c, S.START, S.CUTOFF)
    return rows.withColumn("payment_value", F.col("payment_value").cast("double"))


@query
def future_targets(spark, c):
    return lb.future_targets(*c, S.CUTOFF, S.WINDOW_DAYS)


@query
def training_table(spark, c):
    return lb.training_table(*c, S.START, S.CUTOFF, window_days=S.WINDOW_DAYS).drop("ingested_at_utc")


@query
def row_count(spark, c):
    return _labelled(c).agg(F.count(F.lit(1)).alias("n_rows"))


# --- lake ------------------------------------------------------------------------------


@query
def partition_orders(spark, c):
    rows = lake.orders_by_day(c.orders)
    return rows.select("order_id", "order_status", "order_purchase_timestamp", "year", "month", "day")


@query
def partition_customers(spark, c):
    return lake.customers_by_day(c.customers, c.orders)


@query
def partition_payments(spark, c):
    rows = lake.payments_by_day(c.payments, c.orders)
    return rows.withColumn("payment_value", F.col("payment_value").cast("double"))


def _fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def pruned_scan(spark, c):
    """Days of a lake; only their folders are read."""
    base = _fresh_folder(spark, "lake")
    lake.write_by_day(lake.orders_by_day(c.orders), f"{base}/orders")
    rows = within_days(lake.read_table(spark, base, "orders"), S.SCAN_START, S.SCAN_END)
    return rows.select("order_id", "order_purchase_timestamp", "year", "month", "day")


@query
def lake_roundtrip(spark, c):
    """Payments laid out by the day of their order and read back whole."""
    base = _fresh_folder(spark, "lake")
    lake.write_by_day(lake.payments_by_day(c.payments, c.orders), f"{base}/order_payments")
    rows = lake.read_table(spark, base, "order_payments")
    return rows.withColumn("payment_value", F.col("payment_value").cast("double"))


@query
def ingest_roundtrip(spark, c):
    """Customers as CSV files in two folders, ingested to tables and read back."""
    base = _fresh_folder(spark, "ingest")
    plain = c.customers.select("customer_id", "customer_unique_id", "customer_state")
    odd = F.col("customer_id") % 2 == 1
    lake.write_csv(plain.where(odd), f"{base}/in/odd")
    lake.write_csv(plain.where(~odd), f"{base}/in/even")
    schemas = {path.rsplit("/", 1)[-1].removesuffix(".csv"): plain.schema for path in lake.csv_files(spark, f"{base}/in")}
    written = lake.ingest_csv(spark, f"{base}/in", base, schemas)
    tables = [lake.read_table(spark, f"{base}/raw_data", name) for name, done in written.items() if done]
    return reduce(DataFrame.unionByName, tables)


@query
def multiline_csv(spark, c):
    """Customers with notes that hold quotes, commas and line breaks, as CSV files and back, every file read in splits."""
    base = _fresh_folder(spark, "notes")
    note = F.concat(F.lit('said "'), "customer_state", F.lit('",\nthen\n\n'), F.repeat(F.lit('x "\n'), (F.col("customer_id") % 7).cast("int")))
    plain = c.customers.select("customer_id", "customer_state", note.alias("note"))
    lake.write_csv(plain, f"{base}/in")
    return lake.read_csv(spark, f"{base}/in", plain.schema, multi_line=True)


@query
def run_table(spark, c):
    """The training table as a run has written it."""
    path = lake.write_run_table(_labelled(c), _fresh_folder(spark, "runs"), S.RUN)
    return spark.read.parquet(path)


@query
def published_day(spark, c):
    """Telemetry of a day, committed and found by monitoring."""
    base = _fresh_folder(spark, "published")
    commits.publish_day({"telemetry": _telemetry(c)}, base, S.EXECUTION)
    today = current_telemetry(spark, f"{base}/telemetry", S.EXECUTION)
    return today.scores.withColumn("status", F.lit(today.status))


@query
def evaluation_day(spark, c):
    """The evaluation set of a day as it was written."""
    base = _fresh_folder(spark, "evaluations")
    commits.publish_day({"evaluations": _evaluation(c)}, base, S.EXECUTION)
    return commits.read_day(spark, f"{base}/evaluations", S.EXECUTION)


@query
def published_report(spark, c):
    """A day's report (CSV) and telemetry published twice and read back together, one row per person.

    The first version holds no one; a third publication breaks off before its commit.
    """
    base = _fresh_folder(spark, "reports")
    scored = store(_scored(_features(c, S.EXECUTION)))
    kinds = {"business_report": "csv"}
    outputs = {"telemetry": rp.telemetry_log(scored, S.RUN), "business_report": rp.business_report(scored)}
    commits.publish_day({n: df.limit(0) for n, df in outputs.items()}, base, S.EXECUTION, kinds)
    commits.publish_day(outputs, base, S.EXECUTION, kinds, rerun=True)
    commits.write_day(outputs["telemetry"].limit(1), f"{base}/telemetry", S.EXECUTION)
    report = commits.read_day(spark, f"{base}/business_report", S.EXECUTION)
    told = commits.read_days(spark, f"{base}/telemetry").select("customer_unique_id", "inference_run_id", S.PREDICTION, "year", "month", "day")
    return report.join(told, "customer_unique_id", "full")


@query
def required_columns(spark, c):
    """Critical columns that reduced tables lack."""
    tables = {
        "orders": c.orders.drop("order_status"),
        "customers": c.customers.select("customer_state"),
        "order_payments": c.payments,
    }
    # The rows that the gap concerns are counted too.
    lacking = [(df, name, column) for name, df in tables.items() for column in gates.missing_columns(name, df)]
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), F.lit(x).alias("column_name"), "n_rows") for df, n, x in lacking]
    return reduce(DataFrame.unionByName, counted)


@query
def empty_matrix(spark, c):
    """Matrices of two windows, one before all orders: whether scoring halts for want of rows."""
    parts = []
    for start, end in ((S.START, S.CUTOFF), S.BEFORE_ALL):
        matrix = ft.feature_matrix(*c, start, end)
        try:
            gates.require_rows(matrix)
            halted = False
        except gates.GateError:
            halted = True
        counted = matrix.agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(counted.select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"), "n_rows", F.lit(halted).alias("is_halted")))
    return parts[0].unionByName(parts[1])


@query
def partition_months(spark, c):
    tables = {
        "orders": c.orders,
        "customers": c.customers,
        "order_payments": lake.payments_by_day(c.payments, c.orders),
    }
    parts = [
        lake.months_present(df, S.SCAN_START, S.SCAN_END).withColumn("dataset", F.lit(name))
        for name, df in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def day_partition(spark, c):
    """Status of every day and its look-back over telemetry by day: one row for each
    person who ordered on the day, as if the day's buyers had been scored."""
    people = c.orders.join(c.customers.select("customer_id", "customer_unique_id"), "customer_id")
    base = _fresh_folder(spark, "telemetry")
    lake.write_by_day(people.select("customer_unique_id", "year", "month", "day"), f"{base}/telemetry")
    rows = partition_statuses(lake.read_table(spark, base, "telemetry"), S.CALENDAR_START, S.CALENDAR_END, 30)
    return rows.withColumns({d: F.col(d).cast("string") for d in ("day", "lookback_day")})


# --- gates -----------------------------------------------------------------------------


def _bronze(c: Commerce) -> dict[str, DataFrame]:
    return {"orders": c.orders, "customers": c.customers, "order_payments": c.payments}


@query
def window_counts(spark, c):
    return gates.window_counts(_bronze(c), S.START, S.CUTOFF)


@query
def null_counts(spark, c):
    return gates.null_counts(_bronze(c), S.START, S.CUTOFF)


@query
def gate_violations(spark, c):
    """Broken rules where a nullable column poses as a critical one, the window runs
    past the data and the person's id poses as the order's customer id."""
    late = c.orders.withColumn("order_status", F.when(F.col("order_status") != "shipped", F.col("order_status")))
    policy = gates.GatePolicy(strict=False, fail_fast=False)
    found = gates.violations({"orders": late, "customers": c.customers}, "2001-01-01", "2001-06-01", policy)
    persons = c.customers.select(F.col("customer_unique_id").alias("customer_id"))
    return (
        found.unionByName(gates.censoring_warning(c.orders, "2001-06-01", S.WINDOW_DAYS))
        .unionByName(gates.repeated_keys_warning(persons))
        .select("table_name", "check_name", "column_name", "n", "severity")
    )


@query
def contract_missing(spark, c):
    """Names a contract learned in training asks for and a reduced matrix lacks."""
    train = _train(c)
    kinds = prep.FeatureKinds(list(S.NUMERICAL), list(S.CATEGORICAL))
    contract = prep.schema_contract(train, kinds)
    system = gates.observed_schema(train.select("customer_unique_id", "snapshot_date"))
    expected = contract.select(F.col("feature").alias("name")).unionByName(system.select("name"))
    matrix = _features(c).drop("aov", "customer_state", "snapshot_date")
    return gates.contract_missing(expected, gates.observed_schema(matrix))


@query
def schema_fingerprint(spark, c):
    return gates.fingerprint(_labelled(c), S.START, S.CUTOFF)


# --- preparation and profiles ----------------------------------------------------------


@query
def hash_split(spark, c):
    return _split(c).select("customer_unique_id", "split")


@query
def split_sizes(spark, c):
    return prep.split_sizes(_split(c))


@query
def feature_set(spark, c):
    return _rounded(prep.drop_system_columns(_labelled(c)), "aov")


@query
def category_lists(spark, c):
    return prep.category_contract(_train_features(c), S.CATEGORICAL)


@query
def schema_enforced(spark, c):
    """The trained schema forced on a table with unknown states, text for numbers
    and a column missing."""
    kinds = prep.FeatureKinds(list(S.NUMERICAL), list(S.CATEGORICAL))
    state, late = F.col("customer_state"), F.col("has_undelivered_order") == 1
    odd = _features(c).withColumns(
        {
            "customer_state": F.when(F.col("recency_days") > 300, F.lower(state)).otherwise(state),
            "frequency": F.when(late, "many").otherwise(F.col("frequency").cast("string")),
        }
    ).drop("aov")
    categories = prep.category_contract(_train_features(c), S.CATEGORICAL)
    return prep.enforce_schema(odd, kinds, categories, keep=["customer_unique_id"])


@query
def profile_numeric(spark, c):
    rows = pr.numeric_profile(_train_features(c), S.NUMERICAL)
    return _rounded(rows, "mean", "std", "missing_rate")


@query
def profile_categorical(spark, c):
    return _rounded(pr.categorical_profile(_train_features(c), S.CATEGORICAL), "frequency", "missing_rate")


@query
def profile_bins(spark, c):
    return _rounded(_profile(c), "expected_pct")


# --- metrics ---------------------------------------------------------------------------


@query
def brier_logloss(spark, c):
    rows = mt.brier_logloss(_test_scores(c), by=["model"])
    return _rounded(rows, "brier_score", "log_loss")


@query
def roc_auc(spark, c):
    return _rounded(mt.roc_auc(_test_scores(c), by=["model", "customer_state"]), "roc_auc")


def _gaps(df: DataFrame) -> DataFrame:
    """Scores of some customers missing, as NULL or as NaN."""
    person = F.col("customer_unique_id") % 10
    gone = F.when(person == 3, F.lit(None).cast("double")).when(person == 7, F.lit(float("nan")))
    return df.withColumn(S.PREDICTION, gone.when(~person.isin(3, 7), F.col(S.PREDICTION)))


@query
def realised_roi(spark, c):
    return mt.realised_roi(_gaps(_test_scores(c)), by=["model"])


@query
def threshold_sweep(spark, c):
    return _rounded(mt.threshold_returns(_gaps(_test_scores(c)), by=["model"]), "eroi")


@query
def best_threshold(spark, c):
    return _rounded(mt.best_threshold(_gaps(_test_scores(c)), by=["model"]), "eroi")


@query
def model_metrics(spark, c):
    return _rounded(mt.model_metrics(_test_scores(c)), "brier_score", "log_loss", "roc_auc", "eroi")


def _duels(c: Commerce) -> DataFrame:
    """One duel per state."""
    rows = mt.model_metrics(_test_scores(c), by=["model", "customer_state"])
    champions = F.col("model") == "champion"
    return mt.duel(
        rows.where(F.col("model") == "challenger"), rows.where(champions), keys=["customer_state"]
    )


@query
def model_duel(spark, c):
    rows = _duels(c).select("customer_state", "eroi", "champion_eroi", "has_champion", "is_approved")
    return _rounded(rows, "eroi", "champion_eroi")


@query
def baseline_record(spark, c):
    rows = mt.baseline_record(_duels(c), keys=["customer_state"])
    return _rounded(rows, "log_loss", "roc_auc", "brier_score", "expected_roi_per_user")


# --- scoring outputs -------------------------------------------------------------------


@query
def business_report(spark, c):
    return rp.business_report(_gaps(_scored(_features(c))))


@query
def impact_summary(spark, c):
    return rp.impact_summary(_scored(_features(c)))


@query
def telemetry(spark, c):
    return _telemetry(c)


# --- monitoring ------------------------------------------------------------------------


@query
def matured_labels(spark, c):
    then = _features(c, S.LOOKBACK).select("customer_unique_id")
    return lb.matured_labels(then, lb.future_targets(*c, S.LOOKBACK, S.WINDOW_DAYS))


@query
def evaluation_join(spark, c):
    """Rows fit for evaluation; scores of unknown recency bands are missing on purpose."""
    rows = _evaluation(c)
    odd = F.when(F.col(S.PREDICTION) > 0.9, F.lit(float("nan"))).otherwise(F.col(S.PREDICTION))
    return mt.complete_rows(rows.withColumn(S.PREDICTION, odd))


def _importance(c: Commerce) -> DataFrame:
    """Correlation with the label as a stand-in for a model's importance."""
    rows = _train(c)
    target = F.col(TARGET).cast("double")
    values = prep.long_values(rows.withColumn("y", target), S.NUMERICAL, "double", ["y"])
    strength = round_half_up(F.abs(F.corr("value", "y")), 6)
    return values.where(F.col("value").isNotNull()).groupBy("feature").agg(strength.alias("importance"))


@query
def top_features(spark, c):
    return dr.top_features(_importance(c), 5)


@query
def bin_counts(spark, c):
    rows = dr.bin_counts(_telemetry(c), _frozen_profile(c), [*S.MONITORED, S.PREDICTION])
    return _rounded(rows, "expected_pct")


@query
def category_counts(spark, c):
    rows = dr.category_counts(_telemetry(c), _frozen_profile(c), [*S.MONITORED, S.PREDICTION])
    return _rounded(rows, "expected_pct")


@query
def psi_numeric(spark, c):
    return _rounded(dr.psi_numeric(_telemetry(c), _frozen_profile(c), [*S.MONITORED, S.PREDICTION]), "psi")


@query
def psi_categorical(spark, c):
    return _rounded(dr.psi_categorical(_telemetry(c), _frozen_profile(c), S.CATEGORICAL), "psi")


@query
def drift_windows(spark, c):
    """Drift of two windows of three days, from the counts that each of five days has left."""
    base, profile, names = _fresh_folder(spark, "counts"), _frozen_profile(c), [*S.MONITORED, S.PREDICTION]
    live = store(_telemetry(c))
    for k, day in enumerate(S.COUNTED_DAYS):
        ds.publish_counts(live.where(F.col("customer_unique_id") % len(S.COUNTED_DAYS) == k), profile, names, f"{base}/cells", day)
    rows = ds.window_stability(spark, f"{base}/cells", profile, names, [S.COUNTED_DAYS[2], S.COUNTED_DAYS[4]], width=3)
    return _rounded(rows.withColumn("window_end", F.col("window_end").cast("string")), "psi")


def _drift(c: Commerce) -> DataFrame:
    return dr.drift_report(_run_keys(_telemetry(c)), _frozen_profile(c), S.MONITORED, by=dec.KEYS)


@query
def drift_report(spark, c):
    return _drift(c)


@query
def performance_report(spark, c):
    return _rounded(pf.performance_report(_evaluation(c)), "brier_score", "log_loss", "realized_roi")


def _judged(c: Commerce) -> DataFrame:
    """The rules read three finished reports."""
    performance = pf.performance_report(_run_keys(_evaluation(c)), by=dec.KEYS)
    test = _test_scores(c).where(F.col("model") == "challenger")
    baseline = mt.brier_logloss(test, by=["model"]).withColumn("model_run_id", F.lit(S.MODEL))
    drift, performance, baseline = (pin(t) for t in (_drift(c), performance, baseline))
    return dec.judged(drift, performance, baseline, psi_limit=0.02, feature_psi_limit=0.02)


@query
def rule_evaluations(spark, c):
    rows = dec.rule_evaluations(_judged(c))
    return _rounded(rows, "actual_value", "threshold")


@query
def decision(spark, c):
    return dec.decision(_judged(c))


# --- encodings, curves and contributions ---------------------------------------------


@query
def category_codes(spark, c):
    """Label shares that stand for categories: by fold from the other folds, and from all rows."""
    train = _train(c)
    return _rounded(enc.category_codes(train, S.CATEGORICAL, enc.label_shares(train)), "code")


@query
def encoded_categories(spark, c):
    """Training rows with the code of their category, learnt without their own fold."""
    train = store(_train(c).select("customer_unique_id", TARGET, *S.CATEGORICAL))
    encoder = enc.fit_encoder(train, prep.FeatureKinds([], list(S.CATEGORICAL)))
    rows = encoder.coded(train, out_of_fold=True)
    return _rounded(rows.select("customer_unique_id", F.col("__code_customer_state").alias("customer_state_code")), "customer_state_code")


def _recency_points(c: Commerce) -> DataFrame:
    return _scored(_train(c)).select(S.PREDICTION, F.col(TARGET).alias("label"))


@query
def isotonic_fit(spark, c):
    """Blocks of equal label share along the recency score, exact over all training rows."""
    return _rounded(iso.isotonic_blocks(_recency_points(c), ranges=8), "value")


@query
def isotonic_scores(spark, c):
    """Test rows with the recency score brought onto the curve of the training rows."""
    test = _scored(_split(c).where(F.col("split") == "test"))
    rows = iso.apply_curve(test, iso.fit_isotonic(_recency_points(c)), S.PREDICTION, "calibrated")
    return _rounded(rows.select("customer_unique_id", "calibrated"), "calibrated")


@query
def fixed_contributions(spark, c):
    """What two features add to the margin of a fixed pair of trees, for every training row."""
    features = F.array("recency_days", "frequency").alias("x")
    rows = ctb.contributions(_train(c).select("customer_unique_id", features), spark.createDataFrame(S.TREES, ctb.NODES), "x", ["customer_unique_id"])
    names = [F.get("contributions", F.lit(k)).alias(n) for k, n in enumerate(["by_recency", "by_frequency"])]
    margin = (F.aggregate("contributions", F.col("base"), lambda a, b: a + b)).alias("margin")
    return _rounded(rows.select("customer_unique_id", *names, "base", margin), "by_recency", "by_frequency", "base", "margin")


# --- model jobs ------------------------------------------------------------------------

# All run on the default budgets of the jobs.


class _Fitted:
    """Stored split, encoder and encoded rows shared by the model queries."""

    def __init__(self, c: Commerce):
        self.kinds = prep.FeatureKinds(list(S.NUMERICAL), list(S.CATEGORICAL))
        self.rows = store(_split(c))
        self.train = self.rows.where(F.col("split") == "train")
        self.encoder = md.fit_encoder(self.train, self.kinds)
        vectors = md.stored_split(self.encoder, self.rows)
        self.train_vectors = vectors.where(F.col("split") == "train").drop("split")
        self.val_vectors = vectors.where(F.col("split") == "val").drop("split")
        self.params = md.TreeParams()

    def part(self, name: str) -> DataFrame:
        return self.rows.where(F.col("split") == name)


@query
def tuned_model(spark, c):
    fit = _Fitted(c)
    trials = md.tune(fit.train_vectors, fit.val_vectors, seed=S.SEED)
    rows = [(i + 1, t.asked, *t.params, t.log_loss, t.curve) for i, t in enumerate(trials)]
    names = "rank int, trees_asked int, trees_kept int, step_size double, max_depth int, min_instances int, " \
            "subsample double, feature_share string, min_gain double, log_loss double, curve array<double>"
    return spark.createDataFrame(rows, names)


@query
def trained_scores(spark, c):
    fit = _Fitted(c)
    model = md.train_model(fit.train_vectors, fit.params, seed=S.SEED)
    vectors = md.encoded(fit.encoder, fit.part("test"))
    return md.with_probability(model, vectors).select("customer_unique_id", S.PREDICTION)


@query
def calibrated_scores(spark, c):
    fit = _Fitted(c)
    model = md.calibrate(fit.encoder, fit.train_vectors, fit.params, seed=S.SEED)
    return md.score(model, fit.part("test")).select("customer_unique_id", TARGET, S.PREDICTION)


@query
def importance_fixed_score(spark, c):
    """Growth of the log loss when a feature of a fixed score is shuffled, over all training rows."""
    rows = md.shuffle_importance(_train(c), ["recency_days", "frequency"], _scored, seed=S.SEED)
    return _rounded(rows, "importance")


@query
def permutation_importance(spark, c):
    fit = _Fitted(c)
    model = md.train_model(fit.train_vectors, fit.params, seed=S.SEED)
    return md.permutation_importance(fit.encoder, model, fit.train, fit.kinds)


@query
def mean_contributions(spark, c):
    fit = _Fitted(c)
    model = md.train_model(fit.train_vectors, fit.params, seed=S.SEED)
    return md.mean_contributions(model, fit.train_vectors, fit.kinds)
