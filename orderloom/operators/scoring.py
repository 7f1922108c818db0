"""Rule-based churn scores and labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.functions.scalar import MONEY, clip, min_max_scale, stamp, zero_if_null
from orderloom.operators.sales import delivered_orders

# Weights and label limits of the rule-based score.
RECENCY_WEIGHT, FREQUENCY_WEIGHT, MONETARY_WEIGHT = 0.6, 0.25, 0.15
HIGH_FROM, MEDIUM_FROM = 0.67, 0.34
BASELINE_RECENCY_WEIGHT, BASELINE_FREQUENCY_WEIGHT = 0.75, 0.25


def normalised(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<c>_norm``: NULL as 0, then min-max scaled over the whole frame.

    The extra maximum over whole rows gives this reader of ``df`` the same columns as
    the main one, so that an aggregated ``df`` is shuffled once for both.
    """
    filled = {c: zero_if_null(F.col(c)) for c in columns}
    bounds = (
        df.agg(
            F.max(F.struct(*df.columns)).alias("_row"),
            *[F.min(e).alias(f"{c}_lo") for c, e in filled.items()],
            *[F.max(e).alias(f"{c}_hi") for c, e in filled.items()],
        )
        .select(F.struct("*").alias("b"))
        .scalar()
    )
    return (
        df.withColumn("_b", bounds)
        .withColumns(
            {
                f"{c}_norm": min_max_scale(e, F.col(f"_b.{c}_lo"), F.col(f"_b.{c}_hi"))
                for c, e in filled.items()
            }
        )
        .drop("_b")
    )


def churn_risk_label(score: Column) -> Column:
    return F.when(score >= HIGH_FROM, "HIGH").when(score >= MEDIUM_FROM, "MEDIUM").otherwise("LOW")


def score_rfm(rfm: DataFrame) -> DataFrame:
    """Add ``churn_score`` and ``churn_label`` to RFM profiles: long absence raises
    the risk, many orders and much money lower it."""
    scaled = normalised(rfm, ["recency_days", "frequency", "monetary"])
    score = (
        F.lit(RECENCY_WEIGHT) * F.col("recency_days_norm")
        + F.lit(FREQUENCY_WEIGHT) * (1 - F.col("frequency_norm"))
        + F.lit(MONETARY_WEIGHT) * (1 - F.col("monetary_norm"))
    )
    return (
        scaled.withColumn("churn_score", clip(score, 0.0, 1.0))
        .withColumn("churn_label", churn_risk_label(F.col("churn_score")))
        .drop("recency_days_norm", "frequency_norm", "monetary_norm")
    )


def legacy_churn_rows(scored: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return scored.select(
        "customer_id",
        "recency_days",
        "frequency",
        F.col("monetary").cast(MONEY).alias("monetary"),
        F.col("churn_score").cast("decimal(9,6)").alias("churn_score"),
        "churn_label",
        stamp(run_ts).alias("scored_at"),
    )


def current_churn_rows(scored: DataFrame, model_version: str, run_ts: datetime | None = None) -> DataFrame:
    """Rows dated by the newest order date seen by the profiles."""
    newest = scored.agg(F.max(F.struct("last_order_date", *[c for c in scored.columns if c != "last_order_date"])).alias("r"))
    return scored.select(
        "customer_id",
        newest.select("r.last_order_date").scalar().alias("snapshot_date"),
        F.col("churn_score").cast("decimal(9,6)").alias("churn_score"),
        "churn_label",
        F.lit(model_version).alias("model_version"),
        stamp(run_ts).alias("scored_at"),
    )


def label_churn(features: DataFrame, recency_threshold_days: int = 90) -> DataFrame:
    if "recency_days" not in features.columns:
        raise ValueError("features must include recency_days")
    return features.withColumn(
        "is_churn", F.when(F.col("recency_days") >= recency_threshold_days, 1).otherwise(0)
    )


def person_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered orders with their person and date, for the baseline evaluation."""
    persons = customers.filter(F.col("customer_unique_id").isNotNull()).select(
        "customer_id", F.col("customer_unique_id").alias("person_id")
    )
    return (
        delivered_orders(orders)
        .filter(F.col("order_date").isNotNull())
        .join(persons, "customer_id")
        .select(F.col("person_id").alias("customer_id"), "order_id", "order_date")
    )


def cutoff_dates(orders: DataFrame, fraction: float = 0.7) -> DataFrame:
    """One row ``(cutoff, test_start, test_end)``: the date that ``fraction`` of the
    distinct order dates precede. The window runs over calendar days only."""
    everything = Window.partitionBy()
    days = orders.select("order_date").distinct()
    ranked = days.select(
        "order_date",
        F.row_number().over(everything.orderBy("order_date")).alias("rn"),
        F.count(F.lit(1)).over(everything).alias("n"),
    )
    at = F.floor(F.col("n").cast("double") * fraction)
    return ranked.agg(
        F.max(F.when(F.col("rn") - 1 == at, F.col("order_date"))).alias("cutoff"),
        F.max("order_date").alias("test_end"),
    ).select("cutoff", F.col("cutoff").alias("test_start"), "test_end")


def build_eval_dataset(orders: DataFrame, churn_window_days: int = 90) -> DataFrame:
    """Per person: history up to the cutoff, first order after it, churn label, baseline score.

    History and future are conditional aggregates of one grouping.
    """
    cutoff = cutoff_dates(orders).select("cutoff").scalar()
    d = F.col("order_date")
    split = orders.withColumn("cutoff", cutoff)
    past, future = d <= F.col("cutoff"), d > F.col("cutoff")
    persons = (
        split.groupBy("customer_id", "cutoff")
        .agg(
            F.max(F.when(past, d)).alias("last_order_date"),
            F.count_distinct(F.when(past, F.col("order_id"))).alias("frequency"),
            F.min(F.when(future, d)).alias("next_order_date"),
        )
        .filter(F.col("last_order_date").isNotNull())
        .withColumn("recency_days", F.date_diff("cutoff", "last_order_date"))
        .withColumn("days_to_next", F.date_diff("next_order_date", "cutoff"))
    )
    late = F.col("days_to_next").isNull() | (F.col("days_to_next") > churn_window_days)
    score = F.lit(BASELINE_RECENCY_WEIGHT) * F.col("recency_days_norm") + F.lit(BASELINE_FREQUENCY_WEIGHT) * (
        1 - F.col("frequency_norm")
    )
    return normalised(persons, ["recency_days", "frequency"]).select(
        "customer_id",
        "last_order_date",
        "frequency",
        "recency_days",
        "next_order_date",
        "days_to_next",
        F.when(late, 1).otherwise(0).alias("is_churn"),
        clip(score, 0.0, 1.0).alias("score"),
    )
