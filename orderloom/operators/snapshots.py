"""Leakage-free customer snapshots and their time-ordered splits.

At every snapshot date an active customer gets features from orders up to that
date and a label from the orders after it. Instead of comparing every order with
every snapshot, each customer-day is expanded only into the snapshots whose
windows it can touch; lifetime values ride along as running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType

from orderloom.functions.scalar import month_index, month_index_ceil, month_start, safe_ratio

WARMUP_DAYS = 120
MIN_MONTH_STARTS = 6
FALLBACK_STEP_DAYS = 14

# The model's features, in order.
FEATURE_COLS = [
    "recency_days",
    "frequency_30d",
    "frequency_90d",
    "monetary_30d",
    "monetary_90d",
    "orders_lifetime",
    "monetary_lifetime",
    "avg_order_value_lifetime",
    "tenure_days",
]


def _snapshot_span(days: DataFrame, horizon_days: int) -> Column:
    """Struct of first and last possible snapshot and whether month starts are used.

    The extremes are taken over whole rows so that this reader of ``days`` needs
    the same columns as the main one and shares its shuffle.
    """
    row = F.struct("order_date", *[c for c in days.columns if c != "order_date"])
    span = (
        days.agg(F.min(row).alias("first"), F.max(row).alias("last"))
        .select(
            F.date_add("first.order_date", WARMUP_DAYS).alias("start"),
            F.date_sub("last.order_date", horizon_days).alias("end"),
        )
        .withColumn("monthly", month_index("end") - month_index_ceil("start") + 1 >= MIN_MONTH_STARTS)
        .select(
            F.when(F.col("start") < F.col("end"), F.struct("start", "end", "monthly"))
            .otherwise(F.raise_error(F.lit("Not enough date span for snapshot-based train/test setup")).cast(
                "struct<start:date,end:date,monthly:boolean>"
            ))
            .alias("span")
        )
    )
    return span.scalar()


def _per_unit(tx: DataFrame) -> int:
    """100 when money is a decimal with at most two places: then it is summed in whole
    cents, which is exact and far cheaper than wide decimals. Otherwise 1: as it is."""
    kind = tx.schema["order_revenue"].dataType
    return 100 if isinstance(kind, DecimalType) and kind.scale <= 2 else 1


def _fractions(tx: DataFrame) -> Column:
    money = F.col("order_revenue")
    return (money * 100).cast("bigint") if _per_unit(tx) == 100 else money


def _customer_days(tx: DataFrame) -> DataFrame:
    """Orders and revenue per (customer, day, previous day of the same order).

    An order normally has one date. If an order id comes back on a later date it
    must count once per window, so its previous date is kept as part of the key.
    Further lines of the same order and day add revenue but no order.
    Revenue is in ``_per_unit`` fractions of the money unit.
    """
    same_order = Window.partitionBy("customer_id", "order_id").orderBy("order_date")
    known = tx.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    earlier = F.col("earlier_date")
    repeated_line = earlier == F.col("order_date")
    return (
        known.withColumn("earlier_date", F.lag("order_date").over(same_order))
        .groupBy("customer_id", "order_date", F.when(~repeated_line, earlier).alias("prev_date"))
        .agg(
            F.sum(F.when(repeated_line, 0).otherwise(1)).alias("orders"),
            F.sum(_fractions(tx)).alias("revenue"),
        )
    )


def _with_lifetime(days: DataFrame) -> DataFrame:
    """Running lifetime values, valid from this day until the customer's next one.

    A customer has at most one row per day (plus returning orders), so the window
    stays small however many orders the customer has.
    """
    timeline = Window.partitionBy("customer_id").orderBy("order_date", "prev_date")
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_seen = F.when(F.col("prev_date").isNull(), F.col("orders")).otherwise(0)
    return days.select(
        "*",
        F.lead("order_date").over(timeline).alias("next_date"),
        F.min("order_date").over(so_far).alias("first_order_date"),
        F.sum(first_seen).over(so_far).alias("cum_orders"),
        F.sum("revenue").over(so_far).alias("cum_revenue"),
    )


def build_snapshot_dataset(
    tx: DataFrame, horizon_days: int = 30, active_lookback_days: int = 120, min_orders_lifetime: int = 2
) -> DataFrame:
    """One row per (snapshot, active customer).

    ``tx`` has ``customer_id, order_id, order_date, order_revenue``. ``target_1``
    is 1 when the customer orders again within the horizon.
    """
    days = _customer_days(tx)
    reach = max(active_lookback_days, 90)
    d, snap = F.col("order_date"), F.col("snapshot_date")

    # Index of the snapshots this day can touch: from the first that still has the
    # day ahead of it to the last that still looks back on it.
    start, end = F.col("span.start"), F.col("span.end")
    earliest = F.greatest(F.date_sub(d, horizon_days), start)
    latest = F.least(F.date_add(d, reach), end)
    monthly = F.col("span.monthly")
    lo = F.when(monthly, month_index_ceil(earliest)).otherwise(
        F.ceil(F.date_diff(earliest, start) / FALLBACK_STEP_DAYS).cast("int")
    )
    hi = F.when(monthly, month_index(latest)).otherwise(
        F.floor(F.date_diff(latest, start) / FALLBACK_STEP_DAYS).cast("int")
    )
    touched = (
        _with_lifetime(days)
        .withColumn("span", _snapshot_span(days, horizon_days))
        .withColumn("lo", lo)
        .withColumn("hi", hi)
        .filter(F.col("lo") <= F.col("hi"))
        .withColumn("index", F.explode(F.sequence("lo", "hi")))
        .withColumn(
            "snapshot_date",
            F.when(monthly, month_start(F.col("index"))).otherwise(
                F.date_add(start, (F.col("index") * FALLBACK_STEP_DAYS).cast("int"))
            ),
        )
    )

    past = d <= snap
    current = past & (F.col("next_date").isNull() | (F.col("next_date") > snap))

    def in_window(days_back: int) -> Column:
        return past & (d > F.date_sub(snap, days_back))

    def order_count(days_back: int) -> Column:
        opened = F.date_sub(snap, days_back)
        newly = F.col("prev_date").isNull() | (F.col("prev_date") <= opened)
        return F.sum(F.when(in_window(days_back) & newly, F.col("orders")).otherwise(0))

    per_unit = _per_unit(tx)

    def in_units(amount: Column) -> Column:
        return amount.cast("double") / per_unit

    def money(days_back: int) -> Column:
        return in_units(F.coalesce(F.sum(F.when(in_window(days_back), F.col("revenue"))), F.lit(0)))

    features = touched.groupBy("snapshot_date", "customer_id").agg(
        F.max(F.when(past, d)).alias("last_order_date"),
        F.min("first_order_date").alias("first_order_date"),
        F.sum(F.when(current, F.col("cum_orders")).otherwise(0)).alias("orders_lifetime"),
        in_units(F.sum(F.when(current, F.col("cum_revenue")))).alias("monetary_lifetime"),
        order_count(30).alias("frequency_30d"),
        money(30).alias("monetary_30d"),
        order_count(90).alias("frequency_90d"),
        money(90).alias("monetary_90d"),
        F.max(F.when(d > snap, 1).otherwise(0)).alias("target_1"),
    )
    return (
        features.withColumn("recency_days", F.date_diff("snapshot_date", "last_order_date"))
        .filter(
            (F.col("recency_days") <= active_lookback_days) & (F.col("orders_lifetime") >= min_orders_lifetime)
        )
        .select(
            "customer_id",
            "snapshot_date",
            "last_order_date",
            "first_order_date",
            "recency_days",
            F.date_diff("snapshot_date", "first_order_date").alias("tenure_days"),
            "orders_lifetime",
            "frequency_30d",
            "frequency_90d",
            "monetary_30d",
            "monetary_90d",
            "monetary_lifetime",
            safe_ratio(F.col("monetary_lifetime"), F.col("orders_lifetime"), F.lit(0.0)).alias(
                "avg_order_value_lifetime"
            ),
            "target_1",
        )
    )


def snapshot_splits(ds: DataFrame, holdout_snapshots: int = 5, min_train_snapshots: int = 5) -> DataFrame:
    """``(snapshot_date, split)`` with the newest snapshots as ``holdout``, the rest ``train``.

    The windows run over distinct snapshot dates only. Too few training snapshots
    for validation is an error.
    """
    everything = Window.partitionBy()
    dates = ds.select("snapshot_date").distinct()
    ranked = dates.select(
        "snapshot_date",
        F.row_number().over(everything.orderBy("snapshot_date")).alias("rn"),
        F.count(F.lit(1)).over(everything).alias("n"),
    ).withColumn("holdout", F.least(F.greatest(F.lit(1), F.lit(holdout_snapshots)), F.greatest(F.lit(1), F.col("n") - 2)))
    train_n = F.col("n") - F.col("holdout")
    return ranked.select(
        "snapshot_date",
        F.when(
            train_n < min_train_snapshots + 1,
            F.raise_error(F.lit("Not enough snapshots left for CV after holdout split")).cast("string"),
        )
        .when(F.col("rn") > train_n, "holdout")
        .otherwise("train")
        .alias("split"),
    )


def with_split(ds: DataFrame, splits: DataFrame) -> DataFrame:
    """Attach the split; ``splits`` has one row per snapshot date, which bounds the broadcast."""
    return ds.join(F.broadcast(splits), "snapshot_date")


def latest_snapshot(ds: DataFrame) -> DataFrame:
    return ds.filter(F.col("snapshot_date") == ds.agg(F.max("snapshot_date")).scalar())
