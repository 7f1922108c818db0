"""Silver to model: two dimensions and two facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.scalar import month_key, stamp


def dim_customer(customers: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per distinct (person, account, place); persons may repeat."""
    return (
        customers.filter(F.col("customer_unique_id").isNotNull())
        .select(
            F.col("customer_unique_id").cast("string").alias("customer_key"),
            "customer_id",
            "customer_unique_id",
            "customer_city",
            "customer_state",
        )
        .distinct()
        .withColumn("updated_at", stamp(run_ts))
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """Calendar dates on which any order was placed."""
    days = (
        orders.filter(F.col("order_purchase_ts").isNotNull())
        .select(F.to_date("order_purchase_ts").alias("date_key"))
        .distinct()
    )
    return days.select(
        "date_key",
        month_key(F.col("date_key")).alias("year_month"),
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
    )


def fact_orders(orders: DataFrame, customers: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Orders with a purchase time and a known account; the person may be NULL."""
    accounts = customers.select("customer_id", F.col("customer_unique_id").cast("string").alias("customer_key"))
    return (
        orders.filter(F.col("order_purchase_ts").isNotNull())
        .select("order_id", "customer_id", "order_status", F.to_date("order_purchase_ts").alias("order_date"))
        .join(accounts, "customer_id")
        .select("order_id", "customer_key", "order_status", "order_date")
        .withColumn("updated_at", stamp(run_ts))
    )


def fact_order_items(items: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return items.select("order_id", "order_item_id", "product_id", "revenue").withColumn(
        "updated_at", stamp(run_ts)
    )
