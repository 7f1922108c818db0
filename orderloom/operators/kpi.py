"""Revenue KPIs and recency/frequency/monetary profiles.

Two variants exist on purpose. The ``tx`` variant works on the transaction base:
only orders with items count and a NULL date or person forms its own group. The
``model`` variant works on the facts: recency and frequency see every delivered
order, and a person needs items (and an id) to appear at all.

``one_row_per_order`` declares that no order id occurs on two rows: silver is merged by it, and a
second one stops the merge. Orders are then counted instead of told apart, and persons are told apart by
grouping per person first, so that no row is expanded once per distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.scalar import MONEY, month_key, sorted_report
from orderloom.operators.sales import DELIVERED, order_revenue


def _money_sum(name: str):
    return F.sum(name).cast(MONEY)


def _orders(one_row_per_order: bool):
    return F.count("order_id") if one_row_per_order else F.count_distinct("order_id")


def _monthly(sales: DataFrame, person: str, one_row_per_order: bool) -> DataFrame:
    if not one_row_per_order:
        return sales.groupBy("year_month").agg(
            _money_sum("revenue").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct(person).alias("unique_customers"),
        )
    per_person = sales.groupBy("year_month", person).agg(F.sum("revenue").alias("revenue"), F.count("order_id").alias("orders"))
    return per_person.groupBy("year_month").agg(
        _money_sum("revenue").alias("revenue"), F.sum("orders").alias("orders"), F.count(person).alias("unique_customers")
    )


def monthly_revenue_tx(tx: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    sales = tx.select(month_key(F.col("order_date")).alias("year_month"), "order_id", "customer_unique_id", "revenue")
    return sorted_report(_monthly(sales, "customer_unique_id", one_row_per_order), "year_month")


def daily_revenue_tx(tx: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    report = (
        tx.groupBy("order_date")
        .agg(_money_sum("revenue").alias("revenue"), _orders(one_row_per_order).alias("orders"))
    )
    return sorted_report(report, "order_date")


def _with_recency(profiles: DataFrame, anchored: DataFrame) -> DataFrame:
    """Add ``recency_days`` to ``anchored`` against the newest date in ``profiles``.

    The maximum runs over whole rows rather than the date alone, so that both
    readers of ``profiles`` need the same columns and share one shuffle.
    """
    newest = profiles.agg(
        F.max(F.struct("last_order_date", *[c for c in profiles.columns if c != "last_order_date"])).alias("row")
    ).select("row.last_order_date")
    return anchored.select(
        "customer_id",
        F.date_diff(newest.scalar(), F.col("last_order_date")).alias("recency_days"),
        "frequency",
        F.col("monetary").cast(MONEY).alias("monetary"),
        "last_order_date",
    )


def customer_rfm_tx(tx: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    profiles = tx.groupBy(F.col("customer_unique_id").alias("customer_id")).agg(
        F.max("order_date").alias("last_order_date"),
        _orders(one_row_per_order).alias("frequency"),
        F.sum("revenue").alias("monetary"),
    )
    return _with_recency(profiles, profiles)


def _delivered_facts(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.filter(F.col("order_status") == DELIVERED).select("order_id", "customer_key", "order_date")


def monthly_revenue_model(
    fact_orders: DataFrame, fact_items: DataFrame, dim_date: DataFrame, one_row_per_order: bool = False
) -> DataFrame:
    """``dim_date`` holds one row per calendar day, which bounds the broadcast."""
    sales = (
        _delivered_facts(fact_orders)
        .join(order_revenue(fact_items), "order_id")
        .join(F.broadcast(dim_date.select("date_key", "year_month")), F.col("date_key") == F.col("order_date"))
    )
    return sorted_report(_monthly(sales, "customer_key", one_row_per_order), "year_month")


def daily_revenue_model(fact_orders: DataFrame, fact_items: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    report = (
        _delivered_facts(fact_orders)
        .join(order_revenue(fact_items), "order_id")
        .groupBy("order_date")
        .agg(_money_sum("revenue").alias("revenue"), _orders(one_row_per_order).alias("orders"))
    )
    return sorted_report(report, "order_date")


def customer_rfm_model(fact_orders: DataFrame, fact_items: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    """One pass over the facts: orders without items still move the last date,
    the frequency and the anchor, but a person without any item is dropped."""
    per_order = order_revenue(fact_items).withColumn("has_items", F.lit(1))
    profiles = (
        _delivered_facts(fact_orders)
        .join(per_order, "order_id", "left")
        .groupBy(F.col("customer_key").alias("customer_id"))
        .agg(
            F.max("order_date").alias("last_order_date"),
            _orders(one_row_per_order).alias("frequency"),
            F.sum("revenue").alias("monetary"),
            F.max("has_items").alias("has_items"),
        )
    )
    bought = profiles.filter(F.col("customer_id").isNotNull() & F.col("has_items").isNotNull())
    return _with_recency(profiles, bought)
