"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class gets the mean and covariance of transformed statistics of its
documents. Covariances are shrunk twice: towards the pooled one and towards a
multiple of the identity. The score is the posterior of label 1, from the
difference of the two log densities; their Mahalanobis terms use the inverse
Cholesky factors, computed once at fitting and written into one plain column
expression, so scoring is a narrow JVM projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import free_names, label_sample, labelled_rows, whole_text

MAX_LABELLED = 20_000
NAMES = ("symbols", "capitals", "digits", "stops", "word_length", "word_variety", "line_variety", "line_length")


def statistics(text: Column) -> Column:
    """Transformed statistics of a whole text, in the order of NAMES; shares are logged, as most are near 0."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.split(text, "[ \n]")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.split(text, "\n")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.log(F.regexp_count(text, F.lit(pattern)) / chars + F.lit(0.002))

    return F.array(
        share("[^\\p{L}\\p{N}\\s.,]"),
        share("\\p{Lu}"),
        share("\\p{N}"),
        share("[.,;:!?]"),
        F.log(chars / n_words),
        F.log1p(F.size(F.array_distinct(words))) / F.log1p(n_words),
        F.size(F.array_distinct(lines)) / n_lines,
        F.log1p(chars / n_lines),
    )


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians and their prior; a class that was never seen leaves a constant score."""

    means: np.ndarray | None
    whiteners: np.ndarray | None  # inverse Cholesky factors
    log_odds: float
    constant: float | None = None

    def score(self, x: Column) -> Column:
        """Probability of label 1 from an array column of statistics."""
        if self.constant is not None:
            return F.lit(self.constant)

        def distance(k: int) -> Column:
            total = F.lit(0.0)
            for row in self.whiteners[k]:
                z = F.lit(float(-(row @ self.means[k])))
                for j in np.flatnonzero(row):
                    z = z + F.get(x, F.lit(int(j))) * float(row[j])
                total = total + z * z
            return total

        gap = (distance(0) - distance(1)) * 0.5 + F.lit(self.log_odds)
        bounded = F.greatest(F.lit(-60.0), F.least(F.lit(60.0), gap))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded))


def fit(rows: DataFrame, to_pooled: float = 0.1, to_identity: float = 0.02) -> Discriminant:
    """Fit from rows of (``__label``, ``__x``); sums are distributed, a few hundred numbers reach the driver."""
    d = len(NAMES)
    x = [F.get(F.col("__x"), F.lit(j)) for j in range(d)]
    sums = [F.sum(v) for v in x] + [F.sum(x[i] * x[j]) for i in range(d) for j in range(i + 1)]
    found = rows.groupBy("__label").agg(F.count(F.lit(1)), *sums).collect()
    count = {r[0]: r[1] for r in found}
    if len(count) < 2:
        return Discriminant(None, None, 0.0, float(next(iter(count))) if count else 0.5)
    means, scatters = np.zeros((2, d)), np.zeros((2, d, d))
    for r in found:
        k, n = r[0], r[1]
        means[k] = np.array(r[2 : 2 + d]) / n
        lower = np.zeros((d, d))
        lower[np.tril_indices(d)] = r[2 + d :]
        full = lower + np.tril(lower, -1).T
        scatters[k] = full - n * np.outer(means[k], means[k])
    pooled = scatters.sum(0) / max(sum(count.values()) - 2, 1)
    whiteners, log_dets = np.zeros((2, d, d)), []
    for k in (0, 1):
        own = scatters[k] / max(count[k] - 1, 1)
        mixed = (1 - to_pooled) * own + to_pooled * pooled
        shrunk = (1 - to_identity) * mixed + to_identity * (np.trace(mixed) / d + 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        whiteners[k] = np.linalg.inv(factor)
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    log_odds = 0.5 * (log_dets[0] - log_dets[1]) + math.log(count[1] / count[0])
    return Discriminant(means, whiteners, float(log_odds))


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_LABELLED) -> Discriminant:
    """Learn from at most ``max_rows`` labelled documents among those where ``train`` holds."""
    sample = label_sample(labels, "quality", id_col, train, max_rows)
    rows = labelled_rows(docs.select(id_col, text_col), sample, id_col)
    return fit(rows.select("__label", statistics(whole_text(text_col)).alias("__x")))


def with_quality(docs: DataFrame, model: Discriminant, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``quality_score`` and ``quality_predicted``; every row is kept.

    Null and empty texts are scored as empty documents, texts of any length are
    read whole, repeated rows get equal scores, an empty table stays empty, and
    columns of the same names are replaced. Without labels of both classes the
    score is constant (0.5 if there are none).
    """
    (x,) = free_names(docs, "__x")
    scored = docs.withColumn(x, statistics(whole_text(text_col))).withColumn("quality_score", model.score(F.col(x)))
    return scored.drop(x).withColumn("quality_predicted", (F.col("quality_score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Discriminant, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that ``with_quality`` predicts 1 for, with all their columns as they are."""
    (x,) = free_names(docs, "__x")
    return docs.withColumn(x, statistics(whole_text(text_col))).filter(model.score(F.col(x)) >= threshold).drop(x)
