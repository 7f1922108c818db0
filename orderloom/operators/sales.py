"""Joins that put orders, their revenue and their buyer on one row.

Items are summed per order before any join, so an order with very many items
reaches the shuffle as a handful of partial sums, and every later join and
aggregation works at order grain. The join to accounts comes last: whatever
follows aggregates again, which leaves adaptive execution free to split a hot
account's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.scalar import MONEY, month_key, zero_if_null

DELIVERED = "delivered"


def order_revenue(items: DataFrame) -> DataFrame:
    """Revenue per order; NULL item revenues are skipped, all-NULL stays NULL."""
    return items.groupBy("order_id").agg(F.sum("revenue").alias("revenue"))


def delivered_orders(orders: DataFrame, ignore_case: bool = False) -> DataFrame:
    status = F.lower("order_status") if ignore_case else F.col("order_status")
    return orders.filter(status == DELIVERED).select(
        "order_id", "customer_id", F.to_date("order_purchase_ts").alias("order_date")
    )


def transaction_lines(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered item lines with date, month and person: the transaction base, line by line."""
    return (
        items.select("order_id", "product_id", "revenue")
        .join(delivered_orders(orders), "order_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .withColumn("year_month", month_key(F.col("order_date")))
    )


def transactions(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """The transaction base at order grain: sums and distinct counts over it equal
    those over ``transaction_lines``. Orders without items are left out."""
    return (
        delivered_orders(orders)
        .join(order_revenue(items), "order_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .select("order_id", "customer_unique_id", "order_date", "revenue")
    )


def customer_orders(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per (person, order, date); delivered in any letter case, orders
    without items kept with revenue 0.

    Accounts are joined first, so the rows end up partitioned by ``order_id`` and the
    final grouping and later per-order windows need no further shuffle. Asking for
    that partitioning costs nothing when the join has already produced it.
    """
    persons = customers.filter(F.col("customer_unique_id").isNotNull()).select(
        "customer_id", F.col("customer_unique_id").cast("string").alias("person_id")
    )
    return (
        delivered_orders(orders.filter(F.col("order_purchase_ts").isNotNull()), ignore_case=True)
        .join(persons, "customer_id")
        .join(order_revenue(items), "order_id", "left")
        .repartition("order_id")
        .groupBy(F.col("person_id").alias("customer_id"), "order_id", "order_date")
        .agg(zero_if_null(F.sum("revenue")).cast(MONEY).alias("order_revenue"))
    )


def customer_features(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue, orders and last date per account; a missing price or freight counts as 0.

    ``orders`` needs ``order_id, customer_id, order_date``.
    """
    line_revenue = zero_if_null(F.col("price")) + zero_if_null(F.col("freight_value"))
    per_order = items.groupBy("order_id").agg(F.sum(line_revenue).alias("revenue"))
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .select("order_id", "customer_id", "order_date")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            F.sum("revenue").cast(MONEY).alias("total_revenue"),
            F.count_distinct("order_id").alias("order_count"),
            F.max("order_date").alias("last_order_date"),
        )
    )
