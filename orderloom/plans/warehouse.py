"""Raw files to gold tables, step by step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderloom.config import RunConfig
from orderloom.operators import kpi, merge, model, quality, sales, scoring, series, silver
from orderloom.plans.views import create_gold_views
from orderloom.schemas import MERGE_KEYS, RAW_CUSTOMERS, RAW_ORDER_ITEMS, RAW_ORDERS
from orderloom.sources import raw_csv
from orderloom.sources.ledger import load_new_files
from orderloom.sources.staging import discard, stage, staged_run
from orderloom.sources.tables import LayerTables


@dataclass(frozen=True)
class QualityReport:
    gold_rowcount: DataFrame
    gold_not_null: DataFrame
    layer_counts: DataFrame
    duplicate_items: DataFrame
    missing_customer: DataFrame
    missing_date: DataFrame

    def failed(self) -> DataFrame:
        return quality.failed(
            self.gold_rowcount, self.gold_not_null, self.duplicate_items, self.missing_customer, self.missing_date
        )


BRONZE = (
    ("bronze.orders_raw", raw_csv.ORDERS_PATTERN, RAW_ORDERS),
    ("bronze.order_items_raw", raw_csv.ORDER_ITEMS_PATTERN, RAW_ORDER_ITEMS),
    ("bronze.customers_raw", raw_csv.CUSTOMERS_PATTERN, RAW_CUSTOMERS),
)


def load_bronze(tables: LayerTables, cfg: RunConfig, append: bool = True, force: bool = False) -> dict[str, int]:
    """Raw files into bronze, each once: added to what is there, or all of them in its place. Gives the number of files per table."""
    return {
        name: load_new_files(tables, name, f"{cfg.raw_path}/{pattern}", schema, cfg.run_ts, force, replace=not append)
        for name, pattern, schema in BRONZE
    }


def merge_silver(tables: LayerTables, cfg: RunConfig, on_duplicate: str = "error") -> None:
    options = {"run_ts": cfg.run_ts, "on_duplicate": on_duplicate}
    steps = (
        ("silver.orders", "bronze.orders_raw", silver.silver_orders, True),
        ("silver.order_items", "bronze.order_items_raw", silver.silver_order_items, True),
        ("silver.customers", "bronze.customers_raw", silver.silver_customers, False),
    )
    for target, raw, typed, touch in steps:
        source, keys = tables.read(raw), MERGE_KEYS[target]
        if on_duplicate == "latest":
            source = merge.latest_per_key(source, keys)
        tables.upsert(target, typed(source), keys, touch_matched=touch, **{**options, "on_duplicate": "error"})


def build_model(tables: LayerTables, cfg: RunConfig) -> None:
    orders, customers = tables.read("silver.orders"), tables.read("silver.customers")
    tables.replace("model.dim_customer", model.dim_customer(customers, cfg.run_ts))
    tables.replace("model.dim_date", model.dim_date(orders))
    tables.replace("model.fact_orders", model.fact_orders(orders, customers, cfg.run_ts))
    tables.replace("model.fact_order_items", model.fact_order_items(tables.read("silver.order_items"), cfg.run_ts))


def staged_transactions(tables: LayerTables) -> DataFrame:
    """The transaction base, joined once and read by every KPI and score."""
    tx = sales.transactions(
        tables.read("silver.orders"), tables.read("silver.order_items"), tables.read("silver.customers")
    )
    return stage(tx, "transactions")


def build_gold(tables: LayerTables, tx: DataFrame) -> None:
    # Silver is merged by order id, so the transaction base has one row per order.
    tables.replace("gold.kpi_monthly_revenue", kpi.monthly_revenue_tx(tx, one_row_per_order=True))
    tables.replace("gold.kpi_daily_revenue", kpi.daily_revenue_tx(tx, one_row_per_order=True))
    tables.replace("gold.kpi_customer_rfm", kpi.customer_rfm_tx(tx, one_row_per_order=True))


def build_scores(tables: LayerTables, tx: DataFrame, cfg: RunConfig) -> None:
    scored = stage(scoring.score_rfm(kpi.customer_rfm_tx(tx)), "rfm-scores")
    tables.replace("ml.customer_churn_score", scoring.current_churn_rows(scored, cfg.scoring_version, cfg.run_ts))
    tables.replace("ml.customer_churn_score_legacy", scoring.legacy_churn_rows(scored, cfg.run_ts))
    discard(scored)
    tables.replace("ml.daily_revenue_anomaly", series.score_daily_anomaly(kpi.daily_revenue_tx(tx), cfg.run_ts))


def check_quality(tables: LayerTables) -> QualityReport:
    gold = {name: tables.read(f"gold.{name}") for name in ("kpi_monthly_revenue", "kpi_daily_revenue", "kpi_customer_rfm")}
    layers = [
        "bronze.orders_raw", "bronze.order_items_raw", "bronze.customers_raw",
        "silver.orders", "silver.order_items", "silver.customers",
        "model.dim_customer", "model.dim_date", "model.fact_orders", "model.fact_order_items",
    ]
    fact = tables.read("model.fact_orders")
    return QualityReport(
        gold_rowcount=quality.rowcount_checks({n.upper(): df for n, df in gold.items()}),
        gold_not_null=quality.not_null_checks(
            {
                "MONTHLY": (gold["kpi_monthly_revenue"], "year_month"),
                "DAILY": (gold["kpi_daily_revenue"], "order_date"),
                "RFM": (gold["kpi_customer_rfm"], "customer_id"),
            }
        ),
        layer_counts=quality.layer_row_counts({n: tables.read(n) for n in layers}),
        duplicate_items=quality.duplicate_key_check(
            tables.read("model.fact_order_items"), ["order_id", "order_item_id"], "MODEL.FACT_ORDER_ITEMS"
        ),
        missing_customer=quality.missing_reference_check(
            fact, "customer_key", tables.read("model.dim_customer"), "customer_key", "FACT_ORDERS missing DIM_CUSTOMER"
        ),
        missing_date=quality.missing_reference_check(
            fact, "order_date", tables.read("model.dim_date"), "date_key", "FACT_ORDERS missing DIM_DATE"
        ),
    )


def run_warehouse(
    spark: SparkSession,
    root: str,
    cfg: RunConfig,
    prefix: str = "",
    load: bool = True,
    fail_on_dq: bool = False,
    on_duplicate: str = "error",
    append_bronze: bool = False,
    force_load: bool = False,
) -> QualityReport:
    """Load, merge, model, gold, scores, checks. ``load=False`` reruns from bronze as it is.

    With ``append_bronze`` the files that bronze doesn't have yet are added to it instead of all files taking its place;
    then ``on_duplicate="latest"`` lets the newest delivery of a key win. ``force_load`` adds known files once
    more. A failed check stops the run only with ``fail_on_dq``.
    """
    cfg = cfg.started()
    tables = LayerTables(spark, root, prefix)
    with staged_run():
        tables.create_all()
        if load:
            load_bronze(tables, cfg, append=append_bronze, force=force_load)
        merge_silver(tables, cfg, on_duplicate)
        build_model(tables, cfg)
        create_gold_views(tables)
        tx = staged_transactions(tables)
        build_gold(tables, tx)
        build_scores(tables, tx, cfg)
        report = check_quality(tables)
        if fail_on_dq:
            names = [r["check_name"] for r in report.failed().collect()]
            if names:
                raise RuntimeError(f"data quality checks failed: {', '.join(names)}")
    return report
