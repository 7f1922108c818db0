"""Rows of the metrics, diagnostics and registry tables of a training run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.scalar import stamp
from orderloom.operators.evaluation import long_metrics
from orderloom.schemas import TABLES


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in order and type; those the frame lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].fields
        ]
    )


def _run_columns(version: str, run_ts: datetime | None, notes: str) -> dict[str, Column]:
    return {"model_version": F.lit(version), "run_ts": stamp(run_ts), "notes": F.lit(notes)}


def metric_rows(long: DataFrame, splits: DataFrame, version: str, run_ts: datetime | None, notes: str) -> DataFrame:
    """Long metrics with the dates of their split. ``splits`` has one row per
    (model, split): ``model_name, split_name, snapshot_start, snapshot_end``."""
    dated = long.join(F.broadcast(splits), ["model_name", "split_name"])
    return _shaped(dated.withColumns(_run_columns(version, run_ts, notes)), "ml.model_metrics")


def decile_rows(
    deciles: DataFrame, model_name: str, split: str, start, end, version: str, run_ts: datetime | None, notes: str
) -> DataFrame:
    named = deciles.withColumns(
        {
            "model_name": F.lit(model_name),
            "split_name": F.lit(split),
            "snapshot_start": F.lit(start),
            "snapshot_end": F.lit(end),
            **_run_columns(version, run_ts, notes),
        }
    )
    return _shaped(named, "ml.model_decile_diagnostics")


def calibration_rows(
    bins: DataFrame, model_name: str, split: str, version: str, run_ts: datetime | None, notes: str
) -> DataFrame:
    named = bins.withColumns(
        {"model_name": F.lit(model_name), "split_name": F.lit(split), **_run_columns(version, run_ts, notes)}
    )
    return _shaped(named, "ml.model_calibration_diagnostics")


def best_candidate(selection: DataFrame, candidates: Sequence[str]) -> str:
    """The highest score; equal scores go to the candidate listed first."""
    place = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("model_name"))
    score = F.when(~F.isnan("selection_score"), F.col("selection_score"))
    return selection.orderBy(score.desc_nulls_last(), place).select("model_name").first()[0]


def registry_rows(
    holdout: DataFrame, selection: DataFrame, best: str, version: str, run_ts: datetime | None, notes: str
) -> DataFrame:
    """One row per candidate. ``holdout`` has the wide holdout metrics by ``model_name``."""
    joined = holdout.join(F.broadcast(selection), "model_name")
    rows = joined.select(
        "model_name",
        F.when(F.col("model_name") == best, "CHAMPION").otherwise("CHALLENGER").alias("status"),
        F.concat(
            F.lit("selection_score="), F.coalesce(F.format_string("%.4f", "selection_score"), F.lit("nan"))
        ).alias("selection_reason"),
        F.col("auc").alias("holdout_auc"),
        F.col("pr_auc").alias("holdout_pr_auc"),
        F.col("lift_at_k").alias("holdout_lift_at_k"),
        F.col("precision_at_k").alias("holdout_precision_at_k"),
        F.col("positive_rate").alias("holdout_positive_rate"),
        F.col("sample_size").alias("holdout_sample_size"),
    )
    return _shaped(rows.withColumns(_run_columns(version, run_ts, notes)), "ml.model_registry")


def baseline_metric_rows(metrics: DataFrame, dates: DataFrame, run_ts: datetime | None, notes: str) -> DataFrame:
    """The baseline report: six metrics with the cutoff and test dates (one row of each)."""
    names = ["auc", "pr_auc", "precision_at_k", "lift_at_k", "sample_size", "churn_rate"]
    long = long_metrics(metrics.withColumnRenamed("positive_rate", "churn_rate"), names=names)
    when = dates.select(F.struct("cutoff", "test_start", "test_end").alias("d")).scalar()
    rows = long.withColumn("d", when).select(
        F.lit("churn_baseline").alias("model_name"),
        F.col("d.cutoff").alias("train_cutoff"),
        "d.test_start",
        "d.test_end",
        "metric_name",
        "metric_value",
    )
    return _shaped(rows.withColumns(_run_columns("v1", run_ts, notes)), "ml.model_metrics")
