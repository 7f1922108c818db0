"""The retail model read from the star-schema test tables.

``bronze_*`` gives raw rows (timestamps as text), ``silver_*`` the same rows
already typed, so that queries that start at silver do not pay for parsing.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.functions.scalar import MONEY

# Given up front, so that opening a table starts no job to look into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _status() -> Column:
    return F.when(F.col("o_orderstatus") == "F", "delivered").otherwise(F.lower("o_orderstatus"))


def _days_later(days: int, only_delivered: bool = False) -> Column:
    moved = F.col("o_orderdate") + F.expr(f"interval {days} days")
    return F.when(F.col("o_orderstatus") == "F", moved) if only_delivered else moved


def _hundredths(name: str) -> Column:
    """A non-negative double with two decimals as a whole number of hundredths."""
    return F.floor(F.col(name) * 100 + 0.5)


def _money(hundredths: Column) -> Column:
    return (hundredths.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def line_money() -> dict[str, Column]:
    """Price, freight (price times tax, rounded to cents) and their sum. Worked out in
    whole cents: decimals made from doubles are slow, and only the results need to be decimals."""
    price = _hundredths("l_extendedprice")
    freight = F.floor((price * _hundredths("l_tax") + 50) / 100)
    return {"price": _money(price), "freight_value": _money(freight), "revenue": _money(price + freight)}


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        _status().alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_ts"),
        _days_later(1).alias("order_approved_ts"),
        _days_later(3, only_delivered=True).alias("order_delivered_carrier_ts"),
        _days_later(9, only_delivered=True).alias("order_delivered_customer_ts"),
        _days_later(20).alias("order_estimated_delivery_ts"),
    )


def silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_ts"),
        *[c.alias(name) for name, c in line_money().items()],
    )


def _person() -> Column:
    """Two neighbouring accounts belong to one person."""
    return F.concat(F.lit("U"), F.expr("c_custkey div 2").cast("string"))


def silver_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account and person only, for readers that need no address."""
    return read_table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("customer_id"), _person().alias("customer_unique_id")
    )


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (
        read_table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text("c_custkey").alias("customer_id"),
            _person().alias("customer_unique_id"),
            F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        )
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders: the five timestamps as text, missing ones as empty text."""
    raw_names = {
        "order_purchase_ts": "order_purchase_timestamp",
        "order_approved_ts": "order_approved_at",
        "order_delivered_carrier_ts": "order_delivered_carrier_date",
        "order_delivered_customer_ts": "order_delivered_customer_date",
        "order_estimated_delivery_ts": "order_estimated_delivery_date",
    }
    return silver_orders(spark, sf_dir).select(
        "order_id",
        "customer_id",
        "order_status",
        *[F.coalesce(_text(ts), F.lit("")).alias(raw) for ts, raw in raw_names.items()],
    )


def bronze_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_order_items(spark, sf_dir).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        _text("shipping_limit_ts").alias("shipping_limit_date"),
        "price",
        "freight_value",
    )


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_customers(spark, sf_dir)
