"""Bronze to silver: typed timestamps, exact money, renamed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.scalar import MONEY, try_timestamp


def silver_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        try_timestamp(F.col("order_purchase_timestamp")).alias("order_purchase_ts"),
        try_timestamp(F.col("order_approved_at")).alias("order_approved_ts"),
        try_timestamp(F.col("order_delivered_carrier_date")).alias("order_delivered_carrier_ts"),
        try_timestamp(F.col("order_delivered_customer_date")).alias("order_delivered_customer_ts"),
        try_timestamp(F.col("order_estimated_delivery_date")).alias("order_estimated_delivery_ts"),
    )


def silver_order_items(raw_items: DataFrame) -> DataFrame:
    """Revenue is price plus freight and NULL when either is NULL."""
    return raw_items.select(
        "order_id",
        F.col("order_item_id").cast("bigint").alias("order_item_id"),
        "product_id",
        "seller_id",
        try_timestamp(F.col("shipping_limit_date")).alias("shipping_limit_ts"),
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
        (F.col("price") + F.col("freight_value")).cast(MONEY).alias("revenue"),
    )


def silver_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").cast("string").alias("customer_zip_code_prefix"),
        "customer_city",
        "customer_state",
    )
