"""Train, compare, register and score: the repeat-purchase models."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from orderloom.config import RunConfig
from orderloom.functions.scalar import stamp
from orderloom.operators import evaluation, noise, registry, snapshots, training
from orderloom.sources.staging import stage

CANDIDATES = ("logreg_calibrated", "hgb_challenger")
# Names and notes in the model tables.
EXTENDED_MODEL = "logreg_calibrated_ext"
EXTENDED_NOTES = "extension_cell: winsorize+log+trend+calibration"


@dataclass(frozen=True)
class TrainingRun:
    """Frames for the run's tables, and what decided them."""

    metrics: DataFrame
    deciles: DataFrame
    registry: DataFrame
    scores: DataFrame
    best: str
    thresholds: dict[str, float]


def staged_dataset(customer_orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """The snapshot dataset, written as it is dealt, by customer: no snapshot is one task. Files are sorted by
    snapshot date, so a date filter skips pages. Ranges of dates would need a sample, and for it all rows twice."""
    ds = snapshots.build_snapshot_dataset(
        customer_orders, cfg.horizon_days, cfg.active_lookback_days, cfg.min_orders_lifetime
    )
    return stage(ds.sortWithinPartitions("snapshot_date"), "snapshots")


def _split(ds: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame, list, list]:
    """Train and holdout frames and their snapshot dates (one value per snapshot)."""
    if ds.isEmpty():
        raise RuntimeError("no active customer at any snapshot")
    dates = sorted(
        (r["snapshot_date"], r["split"])
        for r in snapshots.snapshot_splits(ds, cfg.holdout_snapshots, cfg.min_train_snapshots).collect()
    )
    train_dates = [d for d, s in dates if s == "train"]
    holdout_dates = [d for d, s in dates if s == "holdout"]
    first_holdout = F.lit(holdout_dates[0])
    day = F.col("snapshot_date")
    return ds.filter(day < first_holdout), ds.filter(day >= first_holdout), train_dates, holdout_dates


def side_by_side(*works: Callable) -> list:
    """What the works give, run at the same time: each submits its jobs, and tasks of one fill the cores that another leaves idle."""
    with ThreadPoolExecutor(len(works)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, work) for work in works]]


def run_training(ds: DataFrame, cfg: RunConfig, candidates=CANDIDATES, options: dict | None = None) -> TrainingRun:
    """``options`` maps a model name to extra fit arguments."""
    options = options or {}
    cfg = cfg.started()
    train, holdout, _, holdout_dates = _split(ds, cfg)
    notes = cfg.training_notes(len(holdout_dates))
    spark = ds.sparkSession

    models, scored, splits = {}, [], []
    for name in candidates:
        own = options.get(name, {})
        # The fit on all rows first: it is the longest task of all.
        models[name], (folds, oof) = side_by_side(
            lambda: training.fit_model(name, train, **own),
            lambda: training.rolling_time_cv(train, name, cfg.min_train_snapshots, **own),
        )
        scored += [oof, training.scored_rows(models[name], holdout, name, "holdout")]
        splits += [(name, f.name, f.train_start, f.validation) for f in folds]
        splits.append((name, "holdout", holdout_dates[0], holdout_dates[-1]))
    scores = stage(reduce(DataFrame.unionByName, scored), "candidate-scores")
    split_dates = spark.createDataFrame(
        splits, "model_name string, split_name string, snapshot_start date, snapshot_end date"
    )

    wide = stage(
        evaluation.eval_metrics(scores, cfg.top_k_fraction, training.KEYS, by=["model_name", "split_name"]), "metrics"
    )
    long = evaluation.long_metrics(wide, ["model_name", "split_name"])
    selection = evaluation.selection_scores(long)
    best = registry.best_candidate(selection, candidates)
    thresholds = {
        r["model_name"]: r["threshold"]
        for r in evaluation.choose_threshold(
            scores.filter(F.col("split_name") != "holdout"), by=["model_name"]
        ).collect()
    }

    on_holdout = scores.filter(F.col("split_name") == "holdout")
    deciles = [
        registry.decile_rows(
            evaluation.decile_diagnostics(on_holdout.filter(F.col("model_name") == name)),
            name, "holdout", holdout_dates[0], holdout_dates[-1], cfg.model_version, cfg.run_ts, notes,
        )
        for name in candidates
    ]
    latest = models[best].score(ds.filter(F.col("snapshot_date") == F.lit(holdout_dates[-1])))
    labelled = training.label_repeat(latest, thresholds[best]).select(
        "customer_id",
        "snapshot_date",
        F.col("score").alias("churn_score"),
        "churn_label",
        F.lit(cfg.model_version).alias("model_version"),
        stamp(cfg.run_ts).alias("scored_at"),
    )
    return TrainingRun(
        metrics=registry.metric_rows(long, split_dates, cfg.model_version, cfg.run_ts, notes),
        deciles=reduce(DataFrame.unionByName, deciles),
        registry=registry.registry_rows(
            wide.filter(F.col("split_name") == "holdout"), selection, best, cfg.model_version, cfg.run_ts, notes
        ),
        scores=labelled,
        best=best,
        thresholds=thresholds,
    )


def extension_metrics(scored: DataFrame, top_k_fraction: float) -> DataFrame:
    """Long metrics of an extension run: the usual ones and the Brier score."""
    by = ["model_name", "split_name"]
    wide = evaluation.eval_metrics(scored, top_k_fraction, training.KEYS, by=by)
    brier = scored.groupBy(*by).agg(F.avg(F.pow(F.col("score") - F.col("y"), 2)).alias("brier_score"))
    return evaluation.long_metrics(wide, by).unionByName(evaluation.long_metrics(brier, by, ["brier_score"]))


def run_extended(
    ds: DataFrame, cfg: RunConfig, fit_limits_on: str = "train", max_iter: int = training.LOGISTIC_ITERATIONS
) -> tuple[DataFrame, DataFrame]:
    """The calibrated logistic on 17 features: its metric rows and calibration rows.

    ``fit_limits_on="all"`` takes the clipping limits from every row, holdout
    included; the default keeps them to the training rows.
    """
    cfg = cfg.started()
    train, _, _, holdout_dates = _split(ds, cfg)
    # A projection of staged rows that is read once for the fit and once for the scores.
    extended = noise.add_noise_reduction_features(ds, fit_on=train if fit_limits_on == "train" else None)
    first_holdout = F.lit(holdout_dates[0])
    columns = snapshots.FEATURE_COLS + noise.ENGINEERED_COLS
    model = training.fit_calibrated_logistic(
        extended.filter(F.col("snapshot_date") < first_holdout), columns, max_iter
    )
    holdout = extended.filter(F.col("snapshot_date") >= first_holdout)
    scored = stage(training.scored_rows(model, holdout, EXTENDED_MODEL, "holdout_ext"), "extended-scores")

    long = extension_metrics(scored, cfg.top_k_fraction)
    split_dates = ds.sparkSession.createDataFrame(
        [(EXTENDED_MODEL, "holdout_ext", holdout_dates[0], holdout_dates[-1])],
        "model_name string, split_name string, snapshot_start date, snapshot_end date",
    )
    metrics = registry.metric_rows(long, split_dates, cfg.model_version, cfg.run_ts, EXTENDED_NOTES)
    calibration = registry.calibration_rows(
        evaluation.calibration_by_bin(scored), EXTENDED_MODEL, "holdout_ext", cfg.model_version, cfg.run_ts, EXTENDED_NOTES
    )
    return metrics, calibration
