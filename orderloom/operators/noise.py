"""Winsorised, logged and velocity features on the snapshot dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.quantiles import exact_quantiles
from orderloom.functions.scalar import clip

# Clipped features, and the engineered ones in order.
MONEY_FEATURES = ["monetary_30d", "monetary_90d", "monetary_lifetime", "avg_order_value_lifetime"]

ENGINEERED_COLS = [
    "log_monetary_30d",
    "log_monetary_90d",
    "log_monetary_lifetime",
    "log_avg_order_value_lifetime",
    "freq_delta_30_vs_90",
    "monetary_delta_30_vs_90",
    "monetary_per_day_90d",
    "order_rate_lifetime",
]


def winsor_limits(ds: DataFrame, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """One row with a ``[low, high]`` array per money feature."""
    limits = exact_quantiles(ds, MONEY_FEATURES, [lower, upper])
    return limits.agg(
        *[F.max(F.when(F.col("name") == c, F.col("quantiles"))).alias(c) for c in MONEY_FEATURES]
    )


def add_noise_reduction_features(ds: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Clip money to the 1st-99th percentile, then add logs and velocities.

    The limits come from ``fit_on`` (the training rows, so that the holdout leaks
    nothing) or, when it is omitted, from ``ds`` itself. Both are read several
    times: pass staged frames when they are expensive.
    """
    fit = ds if fit_on is None else fit_on
    limits = winsor_limits(fit).select(F.struct(*MONEY_FEATURES).alias("l")).scalar()
    bounded = ds.withColumn("_limits", limits)
    clipped = bounded.withColumns(
        {
            c: F.when(F.col("_limits")[c].isNull(), F.col(c)).otherwise(
                clip(F.col(c), F.col("_limits")[c][0], F.col("_limits")[c][1])
            )
            for c in MONEY_FEATURES
        }
    ).drop("_limits")
    return clipped.withColumns(
        {
            **{f"log_{c}": F.log1p(c) for c in MONEY_FEATURES},
            "freq_delta_30_vs_90": F.col("frequency_30d") - F.col("frequency_90d") / 3.0,
            "monetary_delta_30_vs_90": F.col("monetary_30d") - F.col("monetary_90d") / 3.0,
            "monetary_per_day_90d": F.col("monetary_90d") / 90.0,
            "order_rate_lifetime": F.col("orders_lifetime") / F.greatest(F.col("tenure_days"), F.lit(1)),
        }
    )
