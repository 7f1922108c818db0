"""Fixed schemas of the raw files and of every layer table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
    "decimal(18,2)": DecimalType(18, 2),
    "decimal(9,6)": DecimalType(9, 6),
    "decimal(18,6)": DecimalType(18, 6),
}


def _schema(ddl: str) -> StructType:
    """``"name type, name type"`` as a schema; needs no running session."""
    pairs = (column.split(" ") for column in ddl.split(", "))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw files, in load order. Timestamps stay text until the silver layer.
RAW_ORDERS = _schema(
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, "
    "order_delivered_customer_date string, order_estimated_delivery_date string"
)
RAW_ORDER_ITEMS = _schema(
    "order_id string, order_item_id bigint, product_id string, seller_id string, "
    "shipping_limit_date string, price decimal(18,2), freight_value decimal(18,2)"
)
RAW_CUSTOMERS = _schema(
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string"
)

_INGESTED = "ingested_at timestamp_ntz"
_UPDATED = "updated_at timestamp_ntz"


def _with(base: StructType, ddl: str) -> StructType:
    return StructType(base.fields + _schema(ddl).fields)


LAYERS = ("bronze", "silver", "model", "gold", "ml")

TABLES: dict[str, StructType] = {
    "bronze.orders_raw": _with(RAW_ORDERS, _INGESTED),
    "bronze.order_items_raw": _with(RAW_ORDER_ITEMS, _INGESTED),
    "bronze.customers_raw": _with(RAW_CUSTOMERS, _INGESTED),
    # One row per file of a load. A load counts once it is a part of its bronze table.
    "bronze.load_ledger": _schema(
        "table_name string, file_path string, file_length bigint, modified_at timestamp_ntz, load_id string, loaded_at timestamp_ntz"
    ),
    "silver.orders": _schema(
        "order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz, "
        "order_approved_ts timestamp_ntz, order_delivered_carrier_ts timestamp_ntz, "
        "order_delivered_customer_ts timestamp_ntz, order_estimated_delivery_ts timestamp_ntz, "
        + _UPDATED
    ),
    "silver.order_items": _schema(
        "order_id string, order_item_id bigint, product_id string, seller_id string, "
        "shipping_limit_ts timestamp_ntz, price decimal(18,2), freight_value decimal(18,2), "
        "revenue decimal(18,2), " + _UPDATED
    ),
    "silver.customers": _with(RAW_CUSTOMERS, _UPDATED),
    "model.dim_customer": _schema(
        "customer_key string, customer_id string, customer_unique_id string, "
        "customer_city string, customer_state string, " + _UPDATED
    ),
    "model.dim_date": _schema("date_key date, year_month string, year int, month int, day int"),
    "model.fact_orders": _schema(
        "order_id string, customer_key string, order_status string, order_date date, " + _UPDATED
    ),
    "model.fact_order_items": _schema(
        "order_id string, order_item_id bigint, product_id string, revenue decimal(18,2), " + _UPDATED
    ),
    "gold.kpi_monthly_revenue": _schema(
        "year_month string, revenue decimal(18,2), orders bigint, unique_customers bigint"
    ),
    "gold.kpi_daily_revenue": _schema("order_date date, revenue decimal(18,2), orders bigint"),
    "gold.kpi_customer_rfm": _schema(
        "customer_id string, recency_days int, frequency bigint, monetary decimal(18,2), "
        "last_order_date date"
    ),
    # Rule-based and model-based scores mean different things, so each has its table.
    "ml.customer_churn_score": _schema(
        "customer_id string, snapshot_date date, churn_score decimal(9,6), churn_label string, "
        "model_version string, scored_at timestamp_ntz"
    ),
    "ml.customer_churn_score_legacy": _schema(
        "customer_id string, recency_days int, frequency bigint, monetary decimal(18,2), "
        "churn_score decimal(9,6), churn_label string, scored_at timestamp_ntz"
    ),
    "ml.customer_repeat_score": _schema(
        "customer_id string, snapshot_date date, churn_score double, churn_label string, "
        "model_version string, scored_at timestamp_ntz"
    ),
    "ml.daily_revenue_anomaly": _schema(
        "order_date date, revenue decimal(18,2), orders bigint, z_score decimal(18,6), "
        "is_anomaly boolean, scored_at timestamp_ntz"
    ),
    # Superset of the rolling-validation and the cutoff-split shapes.
    "ml.model_metrics": _schema(
        "model_name string, model_version string, run_ts timestamp_ntz, split_name string, "
        "snapshot_start date, snapshot_end date, train_cutoff date, test_start date, test_end date, "
        "metric_name string, metric_value double, notes string"
    ),
    "ml.model_decile_diagnostics": _schema(
        "model_name string, model_version string, run_ts timestamp_ntz, split_name string, "
        "snapshot_start date, snapshot_end date, decile bigint, min_score double, max_score double, "
        "avg_score double, positive_rate double, sample_size bigint, notes string"
    ),
    "ml.model_calibration_diagnostics": _schema(
        "model_name string, model_version string, run_ts timestamp_ntz, split_name string, "
        "bin bigint, avg_pred double, actual_rate double, abs_gap double, sample_size bigint, "
        "notes string"
    ),
    "ml.model_registry": _schema(
        "model_name string, model_version string, run_ts timestamp_ntz, status string, "
        "selection_reason string, holdout_auc double, holdout_pr_auc double, "
        "holdout_lift_at_k double, holdout_precision_at_k double, holdout_positive_rate double, "
        "holdout_sample_size bigint, notes string"
    ),
}

# Tables that are merged by key, and tables that files are loaded into.
MERGE_KEYS: dict[str, list[str]] = {
    "silver.orders": ["order_id"],
    "silver.order_items": ["order_id", "order_item_id"],
    "silver.customers": ["customer_id"],
}
LOADED_TABLES = ("bronze.orders_raw", "bronze.order_items_raw", "bronze.customers_raw")
