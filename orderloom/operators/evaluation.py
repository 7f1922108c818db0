"""Evaluation of scores against 0/1 outcomes, computed where the rows are.

Frames carry ``y`` and ``score`` and, where ties must be broken, key columns
that are unique per row. They are read several times, so stage costly ones.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from orderloom.functions.ordered import few_rows, running_sums
from orderloom.functions.quantiles import exact_quantiles, quantile_bin
from orderloom.functions.scalar import sorted_report
from orderloom.sources.staging import stage

# The thresholds that are tried.
THRESHOLDS = [float(t) for t in np.linspace(0.05, 0.95, 19)]


def _grouped(scored: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame and its group columns; one group for all rows when none are asked for.

    That group's key is computed from the row: as a literal it would be folded away
    and turn the equi-joins below into nested loops.
    """
    if by:
        return scored, list(by)
    return scored.withColumn("_all", F.coalesce(F.col("y").cast("int") * 0, F.lit(0))), ["_all"]


def _per_score(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running positives and rows by ascending score, one row per group and score."""
    counts = scored.groupBy(*by, "score").agg(F.sum("y").cast("bigint").alias("pos"), F.count(F.lit(1)).alias("n"))
    return running_sums(counts, ["score"], ["pos", "n"], partition_by=by)


def _positives_among_ties(scored: DataFrame, summary: DataFrame, keys: Sequence[str], by: list[str]) -> DataFrame:
    """Per group, positives among the first ``need`` rows, by key, that share the cut score.

    Only groups that take a part of the tied rows need an order among them.
    """
    whole = summary.filter("need = cut_n").select(*by, F.col("cut_pos").alias("tied_pos"))
    parted = summary.filter("need < cut_n").select(*by, "cut_score", "need")
    if parted.isEmpty():
        return whole
    tied = (
        scored.join(few_rows(parted), by)
        .filter(F.col("score") == F.col("cut_score"))
        .select(*by, *keys, "need", F.col("y").cast("bigint").alias("y"), F.lit(1).cast("bigint").alias("one"))
    )
    order = [k for k in keys if k not in by]
    first = running_sums(stage(tied, "tied-rows"), order, ["one"], partition_by=by).filter(F.col("cum_one") <= F.col("need"))
    return whole.unionByName(first.groupBy(*by).agg(F.sum("y").alias("tied_pos")))


def eval_metrics(
    scored: DataFrame,
    top_k_fraction: float = 0.10,
    keys: Sequence[str] = ("customer_id",),
    by: Sequence[str] = (),
    lift_without_positives: float | None = None,
) -> DataFrame:
    """``auc, pr_auc, precision_at_k, lift_at_k, positive_rate, sample_size`` per ``by`` group.

    All groups (folds, models) are evaluated in the same jobs, however many there are.
    Both areas are NULL when a group has one class.
    The top k rows are those with the highest scores; equal scores at the boundary
    are taken in key order.
    """
    scored, by = _grouped(scored, by)
    ranked = _per_score(scored, by)
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    below_neg = (F.col("cum_n") - F.col("n")) - (F.col("cum_pos") - F.col("pos"))
    at_or_above_pos = F.col("total_pos") - F.col("cum_pos") + F.col("pos")
    at_or_above_n = F.col("total_n") - F.col("cum_n") + F.col("n")
    above_n = F.col("total_n") - F.col("cum_n")
    above_pos = F.col("total_pos") - F.col("cum_pos")
    k = F.greatest(
        F.lit(1).cast("bigint"), F.floor(F.col("total_n").cast("double") * F.lit(top_k_fraction)).cast("bigint")
    )
    at_cut = (above_n < k) & (k <= above_n + F.col("n"))

    summary = ranked.groupBy(*by).agg(
        F.sum(pos * (below_neg + 0.5 * (n - pos))).alias("rank_sum"),
        F.sum(pos * at_or_above_pos / at_or_above_n).alias("precision_sum"),
        F.max("total_pos").cast("double").alias("p"),
        F.max("total_n").cast("double").alias("n"),
        F.max(k).cast("double").alias("k"),
        F.max(F.when(at_cut, F.col("score"))).alias("cut_score"),
        F.max(F.when(at_cut, k - above_n)).alias("need"),
        F.max(F.when(at_cut, F.col("n"))).alias("cut_n"),
        F.max(F.when(at_cut, F.col("pos"))).alias("cut_pos"),
        F.max(F.when(at_cut, above_pos)).alias("above_pos"),
    )
    summary = stage(summary, "metric-sums")
    ties = _positives_among_ties(scored, summary, keys, by)
    both = (F.col("p") > 0) & (F.col("p") < F.col("n"))
    base_rate = F.col("p") / F.col("n")
    return (
        summary.join(ties, by, "left")
        .withColumn("precision_at_k", (F.col("above_pos") + F.col("tied_pos")) / F.col("k"))
        .select(
            *[c for c in by if c != "_all"],
            F.when(both, F.col("rank_sum") / (F.col("p") * (F.col("n") - F.col("p")))).alias("auc"),
            F.when(both, F.col("precision_sum") / F.col("p")).alias("pr_auc"),
            "precision_at_k",
            F.when(base_rate > 0, F.col("precision_at_k") / base_rate)
            .otherwise(F.lit(lift_without_positives).cast("double"))
            .alias("lift_at_k"),
            base_rate.alias("positive_rate"),
            F.col("n").alias("sample_size"),
        )
    )


def choose_threshold(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(threshold, f1)`` per group: the lowest of 19 thresholds with the best F1.

    Rows are counted by how many thresholds they reach, so the data is read once
    and what is left has at most 20 rows per group.
    """
    scored, by = _grouped(scored, by)
    reached = sum((F.when(F.col("score") >= t, 1).otherwise(0) for t in THRESHOLDS), F.lit(0))
    counts = scored.groupBy(*by, reached.alias("reached")).agg(
        F.sum("y").cast("bigint").alias("pos"), F.count(F.lit(1)).alias("n")
    )
    steps = F.array(*[F.struct(F.lit(j).alias("step"), F.lit(t).alias("threshold")) for j, t in enumerate(THRESHOLDS)])
    hit = F.col("reached") > F.col("s.step")
    candidates = (
        counts.withColumn("s", F.explode(steps))
        .groupBy(*by, F.col("s.threshold").alias("threshold"))
        .agg(
            F.sum("pos").alias("p"),
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("hit"),
        )
    )
    precision = F.when(F.col("hit") > 0, F.col("tp") / F.nullif(F.col("hit"), F.lit(0))).otherwise(0.0)
    recall = F.when(F.col("p") > 0, F.col("tp") / F.nullif(F.col("p"), F.lit(0))).otherwise(0.0)
    f1 = F.when(
        precision + recall > 0, 2 * precision * recall / F.nullif(precision + recall, F.lit(0.0))
    ).otherwise(0.0)
    best = F.max(F.struct(f1.alias("f1"), (-F.col("threshold")).alias("low"), "threshold"))
    return (
        candidates.groupBy(*by)
        .agg(best.alias("best"))
        .select(*[c for c in by if c != "_all"], F.col("best.threshold").alias("threshold"), F.col("best.f1").alias("f1"))
    )


def _binned(scored: DataFrame, n_bins: int, name: str) -> DataFrame:
    probs = [float(q) for q in np.linspace(0, 1, n_bins + 1)]
    edges = exact_quantiles(scored, ["score"], probs).select("quantiles").scalar()
    return scored.withColumn("_edges", edges).withColumn(name, quantile_bin(F.col("score"), F.col("_edges")).cast("bigint"))


def decile_diagnostics(scored: DataFrame, n_bins: int = 10) -> DataFrame:
    """Per quantile bin (1 = lowest scores): score range, mean, positive rate and size."""
    report = (
        _binned(scored, n_bins, "decile")
        .groupBy("decile")
        .agg(
            F.min("score").alias("min_score"),
            F.max("score").alias("max_score"),
            F.avg("score").alias("avg_score"),
            F.avg("y").alias("positive_rate"),
            F.count(F.lit(1)).alias("sample_size"),
        )
    )
    return sorted_report(report, F.desc("decile"))


def calibration_by_bin(scored: DataFrame, n_bins: int = 10) -> DataFrame:
    """Per quantile bin: mean prediction, observed rate, their gap and the size."""
    report = (
        _binned(scored, n_bins, "bin")
        .groupBy("bin")
        .agg(
            F.avg("score").alias("avg_pred"),
            F.avg("y").alias("actual_rate"),
            F.count(F.lit(1)).alias("sample_size"),
        )
        .withColumn("abs_gap", F.abs(F.col("avg_pred") - F.col("actual_rate")))
    )
    return sorted_report(report, F.desc("bin"))


def brier_score(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col("score") - F.col("y"), 2)).alias("brier_score"))


METRICS = ["auc", "pr_auc", "precision_at_k", "lift_at_k", "positive_rate", "sample_size"]


def long_metrics(metrics: DataFrame, id_cols: Sequence[str] = (), names: Sequence[str] = METRICS) -> DataFrame:
    """Wide metrics to ``(id_cols, metric_name, metric_value)``; missing values are left out."""
    return (
        metrics.select(*id_cols, *[F.col(m).cast("double").alias(m) for m in names])
        .unpivot(list(id_cols), list(names), "metric_name", "metric_value")
        .filter(F.col("metric_value").isNotNull() & ~F.isnan("metric_value"))
    )


def selection_scores(metrics: DataFrame) -> DataFrame:
    """``(model_name, selection_score)`` from long metrics with ``split_name``:
    half the mean validation lift, plus holdout lift and AUC."""
    validation = F.col("split_name").startswith("cv_fold")
    holdout = F.col("split_name") == "holdout"
    lift, auc = F.col("metric_name") == "lift_at_k", F.col("metric_name") == "auc"
    value = F.col("metric_value")
    return (
        metrics.groupBy("model_name")
        .agg(
            F.avg(F.when(validation & lift, value)).alias("cv_lift"),
            F.max(F.when(holdout & lift, value)).alias("holdout_lift"),
            F.max(F.when(holdout & auc, value)).alias("holdout_auc"),
        )
        .select(
            "model_name",
            (0.5 * F.col("cv_lift") + 0.4 * F.col("holdout_lift") + 0.1 * F.col("holdout_auc")).alias("selection_score"),
        )
    )
