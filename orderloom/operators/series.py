"""Revenue series: z-score anomalies and the moving-average forecast."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.scalar import nan_to_null, stamp, zero_if_null


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"missing column: {column}")


def detect_anomalies(df: DataFrame, value_col: str = "revenue", z_threshold: float = 3.0) -> DataFrame:
    """Add ``z_score`` (population deviation) and ``is_anomaly``.

    Missing values are skipped by the statistics and get a NULL score. A constant
    column scores 0 everywhere; constancy is read off the extremes because the
    deviation of equal floats need not come out as exactly 0.
    """
    _require(df, value_col)
    value = nan_to_null(F.col(value_col).cast("double"))
    stats = (
        df.agg(
            F.avg(value).alias("mean"),
            F.stddev_pop(value).alias("std"),
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
        )
        .select(F.struct("*").alias("s"))
        .scalar()
    )
    s = F.col("_stats")
    constant = s["std"].isNull() | (s["lo"] == s["hi"])
    return (
        df.withColumn("_stats", stats)
        .withColumn(
            "z_score",
            F.when(constant, F.lit(0.0)).otherwise((value - s["mean"]) / F.nullif(s["std"], F.lit(0.0))),
        )
        .withColumn("is_anomaly", F.when(constant, False).otherwise(F.coalesce(F.abs("z_score") >= z_threshold, F.lit(False))))
        .drop("_stats")
    )


def score_daily_anomaly(daily: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Daily revenue with its z-score; a NULL revenue counts as 0 in the score only."""
    scored = detect_anomalies(daily.withColumn("_value", zero_if_null(F.col("revenue"))), "_value")
    return scored.select(
        "order_date",
        "revenue",
        "orders",
        F.col("z_score").cast("decimal(18,6)").alias("z_score"),
        "is_anomaly",
        stamp(run_ts).alias("scored_at"),
    )


def forecast_next_period(
    df: DataFrame, value_col: str = "revenue", order_by: str = "order_date", window: int = 7
) -> DataFrame:
    """One row ``forecast``: the mean of the last ``min(window, n)`` values in ``order_by`` order.

    Missing values inside that tail are skipped; an empty series is an error.
    """
    _require(df, value_col)
    tail = df.select(F.col(value_col).cast("double").alias("v"), F.col(order_by).alias("o")).orderBy(F.desc("o")).limit(window)
    return tail.agg(F.count(F.lit(1)).alias("n"), F.avg(nan_to_null(F.col("v"))).alias("forecast")).select(
        F.when(F.col("n") == 0, F.raise_error(F.lit("series must not be empty")).cast("double"))
        .otherwise(F.col("forecast"))
        .alias("forecast")
    )
