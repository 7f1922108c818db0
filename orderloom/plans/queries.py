"""Every operator as a named query over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from orderloom.config import RunConfig
from orderloom.functions.scalar import MONEY, stamp
from orderloom.operators import (
    evaluation,
    kpi,
    merge,
    model,
    noise,
    quality,
    registry,
    sales,
    scoring,
    series,
    silver,
    snapshots,
    training,
)
from orderloom.plans import training as training_plan
from orderloom.plans.views import create_gold_views
from orderloom.schemas import RAW_ORDERS, TABLES
from orderloom.sources import raw_csv, testtables as src
from orderloom.sources.ledger import load_new_files
from orderloom.sources.ordered_files import read_ordered, write_ordered
from orderloom.sources.staging import fresh_path, stage
from orderloom.sources.tables import LayerTables, conform
from orderloom.streaming import incremental

RUN_TS = datetime(2024, 1, 1)
OLD_TS = datetime(2001, 9, 1)
SCALE = 6
# The key of the test tables' orders is declared unique, as the merge into silver makes it.
ORDER_ROWS = True

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles rounded for comparison; everything else as it is."""
    return df.withColumns({c: F.round(c, SCALE) for c in columns})


def _silver(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return src.silver_orders(spark, sf), src.silver_order_items(spark, sf), src.silver_accounts(spark, sf)


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    return sales.transactions(*_silver(spark, sf))


def _facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders, items, customers = _silver(spark, sf)
    return model.fact_orders(orders, customers, RUN_TS), model.fact_order_items(items, RUN_TS)


# --- key performance indicators -------------------------------------------------


def kpi_monthly_tx(spark, sf):
    return kpi.monthly_revenue_tx(_tx(spark, sf), ORDER_ROWS)


def kpi_daily_tx(spark, sf):
    return kpi.daily_revenue_tx(_tx(spark, sf), ORDER_ROWS)


def kpi_rfm_tx(spark, sf):
    return kpi.customer_rfm_tx(_tx(spark, sf), ORDER_ROWS)


def kpi_monthly_model(spark, sf):
    fact, lines = _facts(spark, sf)
    return kpi.monthly_revenue_model(fact, lines, model.dim_date(src.silver_orders(spark, sf)), ORDER_ROWS)


def kpi_daily_model(spark, sf):
    return kpi.daily_revenue_model(*_facts(spark, sf), ORDER_ROWS)


def kpi_rfm_model(spark, sf):
    return kpi.customer_rfm_model(*_facts(spark, sf), ORDER_ROWS)


def transaction_lines(spark, sf):
    return sales.transaction_lines(*_silver(spark, sf))


# --- layers ---------------------------------------------------------------------


def silver_orders(spark, sf):
    return silver.silver_orders(src.bronze_orders(spark, sf))


def silver_items(spark, sf):
    return silver.silver_order_items(src.bronze_order_items(spark, sf))


def silver_customers(spark, sf):
    return silver.silver_customers(src.bronze_customers(spark, sf))


def dim_customer(spark, sf):
    return model.dim_customer(src.silver_customers(spark, sf), RUN_TS)


def dim_date(spark, sf):
    return model.dim_date(src.silver_orders(spark, sf))


def fact_orders(spark, sf):
    return _facts(spark, sf)[0]


def fact_order_items(spark, sf):
    return _facts(spark, sf)[1]


# --- upserts: each table in an earlier state, merged with a newer delivery -------


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("updated_at", stamp(OLD_TS))


def upsert_orders(spark, sf):
    """Known: all but pending orders, as created. Delivered now: all but open ones."""
    orders = src.silver_orders(spark, sf)
    known = orders.filter(F.col("order_status") != "p").withColumns(
        {"order_status": F.lit("created"), "order_approved_ts": F.lit(None).cast("timestamp_ntz")}
    )
    return merge.upsert_orders(_stamped(known), orders.filter(F.col("order_status") != "o"), run_ts=RUN_TS)


def _flagged_items(spark: SparkSession, sf: str, without_flag: str) -> DataFrame:
    lines = src.read_table(spark, sf, "lineitem").filter(F.col("l_returnflag") != without_flag)
    return lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_ts"),
        *[c.alias(name) for name, c in src.line_money().items()],
        F.col("l_shipdate").alias("ingested_at"),
    )


def upsert_items(spark, sf):
    """The newest line per key wins within a delivery."""
    known = merge.latest_per_key(_flagged_items(spark, sf, "N"), merge.ORDER_ITEMS_KEY).withColumn(
        "freight_value", F.lit(None).cast(MONEY)
    )
    return merge.upsert_order_items(
        _stamped(known), _flagged_items(spark, sf, "R"), run_ts=RUN_TS, on_duplicate="latest"
    )


def upsert_customers(spark, sf):
    customers = src.silver_customers(spark, sf)
    known = customers.filter(F.col("customer_state") != "ASIA").withColumn("customer_city", F.lit("unknown"))
    return merge.upsert_customers(_stamped(known), customers.filter(F.col("customer_state") != "EUROPE"), run_ts=RUN_TS)


# --- data quality ---------------------------------------------------------------


def dq_gold_rowcount(spark, sf):
    tx = stage(_tx(spark, sf), "transactions")
    return quality.rowcount_checks(
        {
            "KPI_MONTHLY_REVENUE": kpi.monthly_revenue_tx(tx),
            "KPI_DAILY_REVENUE": kpi.daily_revenue_tx(tx),
            "KPI_CUSTOMER_RFM": kpi.customer_rfm_tx(tx),
        }
    )


def dq_gold_notnull(spark, sf):
    tx = stage(_tx(spark, sf), "transactions")
    return quality.not_null_checks(
        {
            "MONTHLY": (kpi.monthly_revenue_tx(tx), "year_month"),
            "DAILY": (kpi.daily_revenue_tx(tx), "order_date"),
            "RFM": (kpi.customer_rfm_tx(tx), "customer_id"),
        }
    )


def dq_layer_counts(spark, sf):
    orders, items, _ = _silver(spark, sf)
    customers = src.silver_customers(spark, sf)
    fact, lines = _facts(spark, sf)
    return quality.layer_row_counts(
        {
            "bronze.orders_raw": src.bronze_orders(spark, sf),
            "bronze.order_items_raw": src.bronze_order_items(spark, sf),
            "bronze.customers_raw": src.bronze_customers(spark, sf),
            "silver.orders": orders,
            "silver.order_items": items,
            "silver.customers": customers,
            "model.dim_customer": model.dim_customer(customers),
            "model.dim_date": model.dim_date(orders),
            "model.fact_orders": fact,
            "model.fact_order_items": lines,
        }
    )


def dq_duplicate_items(spark, sf):
    return quality.duplicate_key_check(
        _facts(spark, sf)[1], ["order_id", "order_item_id"], "MODEL.FACT_ORDER_ITEMS"
    )


def dq_missing_customer(spark, sf):
    known = model.dim_customer(src.silver_customers(spark, sf))
    return quality.missing_reference_check(
        _facts(spark, sf)[0], "customer_key", known, "customer_key", "FACT_ORDERS missing DIM_CUSTOMER"
    )


def dq_missing_date(spark, sf):
    known = model.dim_date(src.silver_orders(spark, sf))
    return quality.missing_reference_check(_facts(spark, sf)[0], "order_date", known, "date_key", "FACT_ORDERS missing DIM_DATE")


def dq_referential(spark, sf):
    """Both checks in one report."""
    return dq_missing_customer(spark, sf).unionByName(dq_missing_date(spark, sf))


# --- customer features and rule-based scores ---------------------------------------


def customer_features(spark, sf):
    orders, items, _ = _silver(spark, sf)
    dated = orders.withColumn("order_date", F.to_date("order_purchase_ts"))
    return sales.customer_features(dated, items)


def customer_orders(spark, sf):
    return sales.customer_orders(*_silver(spark, sf))


def _rfm_scores(spark, sf):
    return scoring.score_rfm(kpi.customer_rfm_tx(_tx(spark, sf)))


def churn_score_rfm(spark, sf):
    return scoring.current_churn_rows(_rfm_scores(spark, sf), "scoring_rfm_v1", RUN_TS)


def churn_score_legacy(spark, sf):
    return scoring.legacy_churn_rows(_rfm_scores(spark, sf), RUN_TS)


def label_churn_recency(spark, sf):
    return scoring.label_churn(kpi.customer_rfm_tx(_tx(spark, sf)))


def daily_anomaly(spark, sf):
    return series.score_daily_anomaly(kpi.daily_revenue_tx(_tx(spark, sf)), RUN_TS)


def zscore_generic(spark, sf):
    """Order totals of the whole table against their own mean."""
    orders = src.read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("total_price")
    )
    return _rounded(series.detect_anomalies(orders, "total_price", z_threshold=1.5), "z_score")


def forecast_ma7(spark, sf):
    return _rounded(series.forecast_next_period(kpi.daily_revenue_tx(_tx(spark, sf))), "forecast")


def eval_dataset(spark, sf):
    return _rounded(_baseline(spark, sf), "score")


def eval_cutoff(spark, sf):
    orders, _, customers = _silver(spark, sf)
    return scoring.cutoff_dates(scoring.person_orders(orders, customers))


def _baseline(spark: SparkSession, sf: str) -> DataFrame:
    orders, _, customers = _silver(spark, sf)
    return scoring.build_eval_dataset(scoring.person_orders(orders, customers))


# --- snapshots --------------------------------------------------------------------

SNAPSHOT_DOUBLES = ["monetary_30d", "monetary_90d", "monetary_lifetime", "avg_order_value_lifetime"]


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.build_snapshot_dataset(sales.customer_orders(*_silver(spark, sf)))


def snapshot_dataset(spark, sf):
    return _rounded(_snapshots(spark, sf), *SNAPSHOT_DOUBLES)


def snapshot_split(spark, sf):
    ds = _snapshots(spark, sf)
    split = snapshots.with_split(ds, snapshots.snapshot_splits(ds))
    return split.groupBy("snapshot_date", "split").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("target_1").alias("positives")
    )


def latest_snapshot(spark, sf):
    return snapshots.latest_snapshot(_snapshots(spark, sf)).select("customer_id", "snapshot_date", "recency_days", "target_1")


def winsor_limits(spark, sf):
    limits = noise.winsor_limits(stage(_snapshots(spark, sf).select(*noise.MONEY_FEATURES), "money"))
    return limits.select(
        *[F.round(F.col(c)[j], SCALE).alias(f"{c}_{end}") for c in noise.MONEY_FEATURES for j, end in enumerate(("lo", "hi"))]
    )


def features_noise_reduced(spark, sf):
    ds = stage(_snapshots(spark, sf), "snapshots")
    return _rounded(noise.add_noise_reduction_features(ds), *SNAPSHOT_DOUBLES, *noise.ENGINEERED_COLS)


# --- evaluation --------------------------------------------------------------------


def _scored_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Baseline scores with their outcome, staged because evaluation reads them repeatedly."""
    rows = _baseline(spark, sf).select("customer_id", F.col("is_churn").alias("y"), "score")
    return stage(rows, "baseline-scores")


def eval_metrics_baseline(spark, sf):
    metrics = evaluation.eval_metrics(_scored_baseline(spark, sf), lift_without_positives=0.0)
    return _rounded(metrics, *evaluation.METRICS)


def best_threshold(spark, sf):
    return _rounded(evaluation.choose_threshold(_scored_baseline(spark, sf)), "threshold", "f1")


def decile_diagnostics(spark, sf):
    out = evaluation.decile_diagnostics(_scored_baseline(spark, sf))
    return _rounded(out, "min_score", "max_score", "avg_score", "positive_rate")


def calibration_bins(spark, sf):
    out = evaluation.calibration_by_bin(_scored_baseline(spark, sf))
    return _rounded(out, "avg_pred", "actual_rate", "abs_gap")


def brier(spark, sf):
    return _rounded(evaluation.brier_score(_scored_baseline(spark, sf)), "brier_score")


RULES = ("recent_buyers", "frequent_buyers")


def _candidate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two rule-based candidates scored on every snapshot: the training snapshots serve
    as validation folds, the newest ones together as holdout."""
    ds = stage(_snapshots(spark, sf), "snapshots")
    scores = {
        "recent_buyers": 1 - F.col("recency_days") / 120.0,
        "frequent_buyers": F.col("orders_lifetime") / (F.col("tenure_days") + 30.0),
    }
    both = F.array(*[F.struct(F.lit(n).alias("model_name"), s.alias("score")) for n, s in scores.items()])
    split_name = F.when(F.col("split") == "holdout", "holdout").otherwise(
        F.concat(F.lit("cv_fold_"), F.date_format("snapshot_date", "yyyy_MM"))
    )
    candidates = snapshots.with_split(ds, snapshots.snapshot_splits(ds)).select(
        "customer_id", "snapshot_date", F.col("target_1").alias("y"), split_name.alias("split_name"), F.inline(both)
    )
    return stage(candidates, "candidates")


def _candidate_wide(rows: DataFrame) -> DataFrame:
    return evaluation.eval_metrics(rows, keys=["customer_id", "snapshot_date"], by=["model_name", "split_name"])


def _candidate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.long_metrics(_candidate_wide(_candidate_rows(spark, sf)), ["model_name", "split_name"])


def candidate_metrics(spark, sf):
    return _rounded(_candidate_metrics(spark, sf), "metric_value")


def selection_score(spark, sf):
    return _rounded(evaluation.selection_scores(stage(_candidate_metrics(spark, sf), "metrics")), "selection_score")


def registry_choice(spark, sf):
    """The registry's rows for both rules: the one with the higher selection score is champion."""
    wide = stage(_candidate_wide(_candidate_rows(spark, sf)), "metrics")
    selection = evaluation.selection_scores(evaluation.long_metrics(wide, ["model_name", "split_name"]))
    best = registry.best_candidate(selection, RULES)
    rows = registry.registry_rows(wide.filter(F.col("split_name") == "holdout"), selection, best, "v1", RUN_TS, "rules")
    metrics = [c for c in rows.columns if c.startswith("holdout_")]
    return _rounded(
        rows.select("model_name", "status", "model_version", "run_ts", "notes", *[F.col(c).cast("double").alias(c) for c in metrics]),
        *metrics,
    )


def metric_table(spark, sf):
    """The metric table's rows for both rules, with the dates of their splits."""
    scored = _candidate_rows(spark, sf)
    dates = scored.groupBy("model_name", "split_name").agg(
        F.min("snapshot_date").alias("snapshot_start"), F.max("snapshot_date").alias("snapshot_end")
    )
    long = evaluation.long_metrics(_candidate_wide(scored), ["model_name", "split_name"])
    rows = registry.metric_rows(long, dates, "v1", RUN_TS, "rules")
    wanted = ["model_name", "split_name", "snapshot_start", "snapshot_end", "metric_name", "metric_value", "model_version", "run_ts"]
    return _rounded(rows.select(*wanted), "metric_value")


def repeat_labels(spark, sf):
    """Baseline scores labelled by the threshold with the best F1."""
    scored = _scored_baseline(spark, sf)
    threshold = evaluation.choose_threshold(scored).first()["threshold"]
    return training.label_repeat(scored, threshold).select("customer_id", "churn_label")


def boundary_nulls(spark, sf):
    """Customers as stored: NaN becomes NULL, and so does a column that the frame lacks."""
    balance = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    rows = src.read_table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"), balance.alias("balance"))
    return conform(rows, StructType.fromDDL("customer_id string, balance double, note string"))


# --- raw files: the tables written as CSV, then loaded by position -----------------------


def _raw_folder(spark: SparkSession, name: str, df: DataFrame, compression: str) -> str:
    folder = fresh_path(spark, "raw")
    df.write.option("header", True).option("compression", compression).csv(f"{folder}/{name}_dataset.csv")
    return folder


def load_orders_csv(spark, sf):
    folder = _raw_folder(spark, "orders", src.bronze_orders(spark, sf), "gzip")
    return raw_csv.load_orders(spark, folder, run_ts=RUN_TS)


def load_items_csv(spark, sf):
    folder = _raw_folder(spark, "order_items", src.bronze_order_items(spark, sf), "gzip")
    return raw_csv.load_order_items(spark, folder, run_ts=RUN_TS)


def load_customers_csv(spark, sf):
    folder = _raw_folder(spark, "customers", src.bronze_customers(spark, sf), "none")
    return raw_csv.load_customers(spark, folder, run_ts=RUN_TS)


def raw_items_as_text(spark, sf):
    return raw_csv.as_text(src.bronze_order_items(spark, sf))


# --- tables: written through the catalog, then read back --------------------------------


def _tables(spark: SparkSession) -> LayerTables:
    tables = LayerTables(spark, fresh_path(spark, "tables"), prefix=f"t{uuid.uuid4().hex[:12]}_")
    tables.create_layers()
    return tables


def _model_tables(spark: SparkSession, sf: str) -> LayerTables:
    tables = _tables(spark)
    fact, lines = _facts(spark, sf)
    tables.replace("model.fact_orders", fact)
    tables.replace("model.fact_order_items", lines)
    tables.replace("model.dim_date", model.dim_date(src.silver_orders(spark, sf)))
    create_gold_views(tables)
    return tables


def view_monthly(spark, sf):
    return _model_tables(spark, sf).read("gold.v_kpi_monthly_revenue")


def view_daily(spark, sf):
    return _model_tables(spark, sf).read("gold.v_kpi_daily_revenue")


def view_rfm(spark, sf):
    return _model_tables(spark, sf).read("gold.v_kpi_customer_rfm")


def table_refresh(spark, sf):
    """A table rebuilt from itself: every person's money is doubled in place."""
    tables = _tables(spark)
    tables.replace("gold.kpi_customer_rfm", kpi.customer_rfm_tx(_tx(spark, sf)))
    before = tables.read("gold.kpi_customer_rfm")
    tables.replace("gold.kpi_customer_rfm", before.withColumn("monetary", F.col("monetary") * 2))
    return tables.read("gold.kpi_customer_rfm")


def table_append(spark, sf):
    """Days without delivered orders are appended to the days with some; nothing is appended last."""
    tables = _tables(spark)
    daily = kpi.daily_revenue_tx(_tx(spark, sf))
    other = src.silver_orders(spark, sf).select(F.to_date("order_purchase_ts").alias("order_date")).distinct()
    tables.append("gold.kpi_daily_revenue", daily)
    known = tables.read("gold.kpi_daily_revenue")
    quiet = stage(other.join(known, "order_date", "left_anti").withColumn("orders", F.lit(0)), "quiet-days")
    tables.append("gold.kpi_daily_revenue", quiet)
    tables.append("gold.kpi_daily_revenue", daily.filter("orders < 0"))
    return tables.read("gold.kpi_daily_revenue")


def table_evolve(spark, sf):
    """A customer table without person and zip gains both, then is merged with full rows."""
    tables = _tables(spark)
    customers = src.silver_customers(spark, sf)
    old = _stamped(customers.filter(F.col("customer_state") != "ASIA")).drop(
        "customer_unique_id", "customer_zip_code_prefix"
    )
    tables.create_table("silver.customers", old.schema)
    tables.append("silver.customers", old)
    tables.evolve("silver.customers", TABLES["silver.customers"])
    tables.upsert(
        "silver.customers",
        customers.filter(F.col("customer_state") != "EUROPE"),
        merge.CUSTOMERS_KEY,
        touch_matched=False,
        run_ts=RUN_TS,
    )
    return tables.read("silver.customers")


def merge_arriving_orders(spark, sf):
    """Order files merged by a stream: first the open ones; then, in one batch, an older
    state of every order (whose text sorts last) and the newer one that must win."""
    tables = _tables(spark)
    tables.create_table("silver.orders")
    folder = fresh_path(spark, "arriving")
    orders = src.bronze_orders(spark, sf)

    def deliver(name: str, rows: DataFrame) -> None:
        rows.write.option("header", True).csv(f"{folder}/{name}_orders_dataset.csv")

    def merge_arrived() -> None:
        incremental.merge_new_orders(
            tables, folder, f"{folder}/progress", pattern="*orders_dataset.csv", run_ts=RUN_TS
        ).awaitTermination()

    deliver("a", orders.filter(F.col("order_status") == "o"))
    merge_arrived()
    deliver("b", orders.withColumn("order_status", F.lit("zz_older")))
    deliver("c", orders)
    merge_arrived()
    return tables.read("silver.orders")


# --- models: fits differ between learners, so these have no SQL ----------------------------

def fold_plan(spark, sf):
    """The validation folds of the whole history: dates, and the rows and positives trained on and validated."""
    ds = stage(_snapshots(spark, sf), "snapshots")
    cfg = RunConfig()
    split = snapshots.snapshot_splits(ds, cfg.holdout_snapshots, cfg.min_train_snapshots)
    train = ds.join(F.broadcast(split.filter(F.col("split") == "train").select("snapshot_date")), "snapshot_date", "left_semi")
    counts = training.snapshot_class_counts(train)
    rows = []
    for fold in training.expanding_folds(counts, cfg.min_train_snapshots):
        before = [c for c in counts if c[0] < fold.validation]
        own = next(c for c in counts if c[0] == fold.validation)
        rows.append((fold.name, fold.train_start, fold.validation, sum(c[2] for c in before), sum(c[1] for c in before), own[2], own[1]))
    return spark.createDataFrame(
        rows,
        "fold string, train_start date, validation date, train_rows long, train_positives long, rows long, positives long",
    )


def _training_set(spark: SparkSession, sf: str) -> tuple[DataFrame, RunConfig]:
    cfg = RunConfig(run_ts=RUN_TS)
    return training_plan.staged_dataset(sales.customer_orders(*_silver(spark, sf)), cfg), cfg


def train_logreg(spark, sf):
    ds, _ = _training_set(spark, sf)
    return training.fit_calibrated_logistic(ds).score(ds).select(*training.KEYS, "target_1", "score")


def train_gbt(spark, sf):
    ds, _ = _training_set(spark, sf)
    return training.fit_boosted_trees(ds).score(ds).select(*training.KEYS, "target_1", "score")


def train_extended(spark, sf):
    """Metric rows of the 17-feature model."""
    return training_plan.run_extended(*_training_set(spark, sf))[0]


def extended_calibration(spark, sf):
    return training_plan.run_extended(*_training_set(spark, sf))[1]


_runs: dict[tuple[str, str], training_plan.TrainingRun] = {}


def _training_run(spark: SparkSession, sf: str) -> training_plan.TrainingRun:
    """Both candidates with all their defaults on all folds; the registry, the scores and the diagnostics come out of one run."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _runs:
        _runs[key] = training_plan.run_training(*_training_set(spark, sf))
    return _runs[key]


def model_registry(spark, sf):
    """Champion and challenger of the calibrated logistic and the boosted trees, validated on all folds."""
    return _training_run(spark, sf).registry


def repeat_scores(spark, sf):
    """The latest snapshot scored by the champion, labelled by its threshold over all folds."""
    return _training_run(spark, sf).scores


def model_deciles(spark, sf):
    """Decile rows of both candidates on the holdout."""
    return _training_run(spark, sf).deciles


# --- rows of the diagnostics tables over scores that SQL can work out too --------------------------------


def _on_holdout(spark: SparkSession, sf: str, rule: str) -> DataFrame:
    rows = _candidate_rows(spark, sf)
    return rows.filter((F.col("model_name") == rule) & (F.col("split_name") == "holdout"))


def _holdout_dates(rows: DataFrame) -> tuple:
    return tuple(rows.agg(F.min("snapshot_date"), F.max("snapshot_date")).first())


def decile_rows(spark, sf):
    """The decile table's rows of one rule on the holdout."""
    rows = _on_holdout(spark, sf, RULES[0])
    out = registry.decile_rows(evaluation.decile_diagnostics(rows), RULES[0], "holdout", *_holdout_dates(rows), "v1", RUN_TS, "rules")
    return _rounded(out, "min_score", "max_score", "avg_score", "positive_rate")


def extension_metrics(spark, sf):
    """Metric rows of an extension run, its Brier score included, for one rule on the holdout."""
    rows = _on_holdout(spark, sf, RULES[0]).withColumn("split_name", F.lit("holdout_ext"))
    long = training_plan.extension_metrics(rows, RunConfig().top_k_fraction)
    start, end = _holdout_dates(rows)
    splits = spark.createDataFrame(
        [(RULES[0], "holdout_ext", start, end)], "model_name string, split_name string, snapshot_start date, snapshot_end date"
    )
    out = registry.metric_rows(long, splits, "v1", RUN_TS, training_plan.EXTENDED_NOTES)
    wanted = ["model_name", "split_name", "snapshot_start", "snapshot_end", "metric_name", "metric_value", "notes", "run_ts"]
    return _rounded(out.select(*wanted), "metric_value")


def extension_calibration(spark, sf):
    """Calibration rows of one rule on the holdout."""
    rows = _on_holdout(spark, sf, RULES[0])
    bins = evaluation.calibration_by_bin(rows)
    out = registry.calibration_rows(bins, RULES[0], "holdout_ext", "v1", RUN_TS, training_plan.EXTENDED_NOTES)
    return _rounded(out, "avg_pred", "actual_rate", "abs_gap")


# Three parts of a calibrated logistic with coefficients that stand for a fit.
_SLOPES = (0.5, 1.0, 1.5)


def extended_scores(spark, sf):
    """All snapshots scored by a calibrated logistic on the 17 features, its coefficients given."""
    ds = stage(_snapshots(spark, sf), "snapshots")
    wide = noise.add_noise_reduction_features(ds)
    columns = tuple(snapshots.FEATURE_COLS + noise.ENGINEERED_COLS)
    size = len(columns)
    stats = training.FeatureStats(columns, (0.0,) * size, tuple(float(j) for j in range(size)), (100.0,) * size)
    weights = tuple((-1.0) ** j / (j + 1) for j in range(size))
    parts = tuple(training.LinearPart(stats, weights, 0.25, slope, -0.5) for slope in _SLOPES)
    scored = training.CalibratedLogistic(parts).score(wide)
    return _rounded(scored.select("customer_id", "snapshot_date", "score"), "score")


# --- ordered delivery: written by position, read with a check --------------------------------------------


def _in_order(df: DataFrame, order_by: list[str], descending: bool = False) -> DataFrame:
    path = fresh_path(df.sparkSession, "ordered")
    write_ordered(df, path, order_by, descending)
    return read_ordered(df.sparkSession, path)


def ordered_monthly(spark, sf):
    return _in_order(kpi_monthly_tx(spark, sf), ["year_month"])


def ordered_rfm(spark, sf):
    """Persons by money, the highest first."""
    return _in_order(kpi_rfm_tx(spark, sf), ["monetary", "customer_id"], descending=True)


def ordered_layer_counts(spark, sf):
    return _in_order(dq_layer_counts(spark, sf), ["obj"])


def ordered_deciles(spark, sf):
    return _in_order(decile_diagnostics(spark, sf), ["decile"], descending=True)


# --- loads and merges whose work follows the delivery -----------------------------------------------------


def bronze_loads(spark, sf):
    """Order files loaded, loaded again, then joined by a file of the open orders: each file counts once."""
    tables = _tables(spark)
    folder = fresh_path(spark, "raw")
    orders = src.bronze_orders(spark, sf)

    def deliver(name: str, rows: DataFrame) -> None:
        rows.write.option("header", True).csv(f"{folder}/{name}_orders_dataset.csv")
        for _ in range(2):
            load_new_files(tables, "bronze.orders_raw", f"{folder}/{raw_csv.ORDERS_PATTERN}", RAW_ORDERS, RUN_TS)

    deliver("a", orders)
    deliver("b", orders.filter(F.col("order_status") == "o"))
    return tables.read("bronze.orders_raw").select("order_id", "order_status", "ingested_at")


def upsert_touched(spark, sf):
    """Orders by bucket after a delivery of a few customers' orders: how many rows, how many of them new, and whether the bucket was rewritten."""
    tables = _tables(spark)
    orders = src.silver_orders(spark, sf)
    tables.replace("silver.orders", _stamped(orders))
    before = tables.manifest("silver.orders")["parts"]
    delivered = orders.filter(F.col("order_id") == orders.agg(F.max("order_id")).scalar())
    tables.upsert("silver.orders", delivered, merge.ORDERS_KEY, run_ts=RUN_TS)
    after = tables.manifest("silver.orders")["parts"]
    parts = spark.createDataFrame([(int(p), after[p] != before.get(p)) for p in after], "bucket int, rewritten boolean")
    rows = spark.table(tables.qualified("silver.orders")).groupBy(F.col("_bucket").alias("bucket"))
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum((F.col("updated_at") == stamp(RUN_TS)).cast("int")).alias("merged"))
    joined = counts.join(F.broadcast(parts), "bucket")
    return joined.agg(
        F.sum("rows").alias("rows"), F.sum("merged").alias("merged"),
        F.sum(F.col("rewritten").cast("int")).alias("buckets_rewritten"),
        F.sum(F.when(F.col("rewritten") & (F.col("merged") == 0), 1).otherwise(0)).alias("rewritten_in_vain"),
    )


def baseline_report(spark, sf):
    """The baseline evaluation as rows of the metrics table."""
    orders, _, customers = _silver(spark, sf)
    metrics = evaluation.eval_metrics(_scored_baseline(spark, sf), lift_without_positives=0.0)
    dates = scoring.cutoff_dates(scoring.person_orders(orders, customers))
    return _rounded(
        registry.baseline_metric_rows(metrics, dates, RUN_TS, RunConfig().baseline_notes()), "metric_value"
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        kpi_monthly_tx, kpi_daily_tx, kpi_rfm_tx,
        kpi_monthly_model, kpi_daily_model, kpi_rfm_model, transaction_lines,
        silver_orders, silver_items, silver_customers,
        dim_customer, dim_date, fact_orders, fact_order_items,
        upsert_orders, upsert_items, upsert_customers,
        dq_gold_rowcount, dq_gold_notnull, dq_layer_counts,
        dq_duplicate_items, dq_missing_customer, dq_missing_date, dq_referential, fold_plan,
        customer_features, customer_orders,
        churn_score_rfm, churn_score_legacy, label_churn_recency,
        daily_anomaly, zscore_generic, forecast_ma7,
        eval_cutoff, eval_dataset,
        snapshot_dataset, snapshot_split, latest_snapshot, winsor_limits, features_noise_reduced,
        eval_metrics_baseline, best_threshold, decile_diagnostics, calibration_bins, brier,
        candidate_metrics, selection_score, baseline_report, registry_choice, metric_table, repeat_labels, boundary_nulls,
        decile_rows, extension_metrics, extension_calibration, extended_scores,
        ordered_monthly, ordered_rfm, ordered_layer_counts, ordered_deciles, bronze_loads, upsert_touched,
        load_orders_csv, load_items_csv, load_customers_csv, raw_items_as_text,
        view_monthly, view_daily, view_rfm,
        table_refresh, table_append, table_evolve, merge_arriving_orders,
        train_logreg, train_gbt, train_extended, extended_calibration, model_registry, repeat_scores, model_deciles,
    )
}
