"""Training, extension and baseline runs against the layer tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from orderloom.config import RunConfig
from orderloom.functions.scalar import stamp
from orderloom.operators import evaluation, registry, sales, scoring
from orderloom.plans.training import CANDIDATES, TrainingRun, run_extended, run_training, staged_dataset
from orderloom.sources.staging import stage, staged_run
from orderloom.sources.tables import LayerTables


def train_and_register(
    tables: LayerTables, cfg: RunConfig, candidates=CANDIDATES, options: dict | None = None, extended: bool = True
) -> TrainingRun:
    """Compare the candidates, store metrics, diagnostics, registry and the winner's
    scores, then (by default) add the extended model's metrics and calibration.

    The frames of the returned run read the stored rows.
    """
    cfg = cfg.started()
    with staged_run():
        orders = sales.customer_orders(
            tables.read("silver.orders"), tables.read("silver.order_items"), tables.read("silver.customers")
        )
        ds = staged_dataset(orders, cfg)
        run = run_training(ds, cfg, candidates, options)
        tables.append("ml.model_metrics", run.metrics)
        tables.append("ml.model_decile_diagnostics", run.deciles)
        tables.append("ml.model_registry", run.registry)
        tables.replace("ml.customer_repeat_score", run.scores)
        if extended:
            metrics, calibration = run_extended(ds, cfg)
            tables.append("ml.model_metrics", metrics)
            tables.append("ml.model_calibration_diagnostics", calibration)

    def stored(name: str) -> DataFrame:
        rows = tables.read(name)
        return rows.filter((rows["run_ts"] == stamp(cfg.run_ts)) & (rows["model_version"] == cfg.model_version))

    return replace(
        run,
        metrics=stored("ml.model_metrics"),
        deciles=stored("ml.model_decile_diagnostics"),
        registry=stored("ml.model_registry"),
        scores=tables.read("ml.customer_repeat_score"),
    )


def evaluate_baseline(tables: LayerTables, cfg: RunConfig) -> None:
    cfg = cfg.started()
    with staged_run():
        orders = stage(
            scoring.person_orders(tables.read("silver.orders"), tables.read("silver.customers")), "person-orders"
        )
        rows = scoring.build_eval_dataset(orders, cfg.baseline_window_days).withColumnRenamed("is_churn", "y")
        metrics = evaluation.eval_metrics(stage(rows, "baseline"), cfg.top_k_fraction, lift_without_positives=0.0)
        tables.append(
            "ml.model_metrics",
            registry.baseline_metric_rows(metrics, scoring.cutoff_dates(orders), cfg.run_ts, cfg.baseline_notes()),
        )
