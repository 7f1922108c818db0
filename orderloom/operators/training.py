"""Candidate models on the snapshot dataset. All validation folds of a model are fitted in the same jobs;
only sums, trees and fold lists come to the driver.

Frames carry the feature columns, ``target_1`` and unique keys
``(customer_id, snapshot_date)``; pass staged ones or projections of them, fits read them twice.
Functions that run in executors travel by value.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.ordered import running_sums
from orderloom.functions.quantiles import grouped_quantiles
from orderloom.operators import boosting
from orderloom.operators.boosting import sigmoid
from orderloom.operators.snapshots import FEATURE_COLS
from orderloom.sources.staging import discard, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LABEL = "target_1"
KEYS = ["customer_id", "snapshot_date"]
CALIBRATION_FOLDS = 3
LOGISTIC_ITERATIONS = 500
# Boosted-tree settings.
TREE_ITERATIONS, TREE_DEPTH, TREE_STEP, TREE_LEAF_ROWS, TREE_BINS = 200, 6, 0.05, 50, 255


@dataclass(frozen=True)
class Fold:
    name: str
    train_start: date
    validation: date


#: A fold whose training rows are all rows there are.
ALL_ROWS = Fold("all", date.min, date.max)


@dataclass(frozen=True)
class FeatureStats:
    """Median for filling, then mean and population deviation for scaling."""

    columns: tuple[str, ...]
    median: tuple[float, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]

    def filled(self) -> list[Column]:
        return [F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(self.columns, self.median)]

    def scaled(self) -> list[Column]:
        return [(x - F.lit(m)) / F.lit(s or 1.0) for x, m, s in zip(self.filled(), self.mean, self.std)]


def _stats_of(columns: Sequence[str], n: int, found: Sequence[tuple]) -> FeatureStats:
    """From the row count and each column's median, mean, variance and count of known values. Filling with the
    median shifts mean and deviation, which is worked out from the counts rather than by a second pass."""
    median, mean, std = [], [], []
    for med, avg, var, known in found:
        gaps = n - known
        median.append(float(med))
        mean.append((known * avg + gaps * med) / n)
        std.append(((known * var + known * gaps / n * (avg - med) ** 2) / n) ** 0.5)
    return FeatureStats(tuple(columns), tuple(median), tuple(mean), tuple(std))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


@dataclass(frozen=True)
class LinearPart:
    """One balanced logistic fit and the sigmoid that calibrates its margin."""

    stats: FeatureStats
    weights: tuple[float, ...]
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self) -> Column:
        terms = [F.lit(w) * x for w, x in zip(self.weights, self.stats.scaled())]
        return reduce(lambda a, b: a + b, terms, F.lit(self.intercept))

    def probability(self) -> Column:
        return _sigmoid(F.lit(self.slope) * self.margin() + F.lit(self.offset))

    def numbers(self) -> list[float]:
        return [*self.stats.median, *self.stats.mean, *[s or 1.0 for s in self.stats.std], *self.weights, self.intercept, self.slope, self.offset]


@dataclass(frozen=True)
class CalibratedLogistic:
    """Mean of the calibrated probabilities: a plain column expression, so scoring
    is a projection that stays in generated code."""

    parts: tuple[LinearPart, ...]

    def score(self, df: DataFrame) -> DataFrame:
        total = reduce(lambda a, b: a + b, [p.probability() for p in self.parts])
        return df.withColumn("score", total / len(self.parts))


@dataclass(frozen=True)
class BoostedTrees:
    columns: tuple[str, ...]
    model: boosting.Model

    def score(self, df: DataFrame) -> DataFrame:
        return boosting.with_scores(df, {0: self.model}, self.columns, F.lit(0))


# --- what all folds share: ranks, counts, medians -----------------------------------------------------


@dataclass(frozen=True)
class Training:
    """Training rows: ``first`` is the first fold that a row is training data of, ``rank`` its
    place in its class by snapshot and key hash. Reading them joins a row of offsets per range to staged rows.

    Folds expand in time, so a fold's rows of a class have the ranks 0, 1, 2, and so on without a gap: taken
    modulo a number, they deal each class evenly in every fold.
    """

    rows: DataFrame
    folds: tuple[Fold, ...]
    columns: tuple[str, ...]
    counts: dict[tuple[int, int], tuple]  # (first, part): rows, positives, and mean, variance and count, or the count alone, per column

    def totals(self, fold: int, parts: Sequence[int] = range(CALIBRATION_FOLDS)) -> tuple[int, int]:
        """(positives, rows) of a fold, or of some parts of it."""
        own = [c for (first, part), c in self.counts.items() if first <= fold and part in parts]
        return sum(c[1] for c in own), sum(c[0] for c in own)


def _part() -> Column:
    return F.pmod("rank", F.lit(CALIBRATION_FOLDS)).cast("int")


def ranked_rows(df: DataFrame, folds: Sequence[Fold], columns: Sequence[str]) -> DataFrame:
    """Rows ``(first, y, rank, x0, x1, ...)`` that some fold trains on, ranked in one pass of running counts."""
    later = F.array(*[F.lit(f.validation) for f in folds])
    first = F.size(F.filter(later, lambda v: v <= F.col("snapshot_date")))
    numbers = [F.col(c).cast("double") for c in columns]
    rows = df.select(
        first.alias("first"), F.col(LABEL).cast("int").alias("y"), "snapshot_date", F.xxhash64(*KEYS).alias("h"), "customer_id",
        F.lit(1).cast("bigint").alias("one"), *[F.when(~F.isnan(v), v).alias(f"x{j}") for j, v in enumerate(numbers)],
    ).filter(F.col("first") < len(folds))
    ranked = running_sums(rows, ["snapshot_date", "h", "customer_id"], ["one"], partition_by=["y"])
    return ranked.select("first", "y", (F.col("cum_one") - 1).alias("rank"), *[f"x{j}" for j in range(len(columns))])


def _known_counts(rows: DataFrame, size: int) -> dict[tuple[int, int], tuple]:
    """Rows, positives and known values per column, by first fold and part."""
    known = [F.count(f"x{j}").alias(f"n{j}") for j in range(size)]
    found = rows.groupBy("first", _part().alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.sum("y").alias("pos"), *known).collect()
    return {(r["first"], r["part"]): (r["rows"], r["pos"], [r[f"n{j}"] for j in range(size)]) for r in found}


def _merged(moments: Sequence[tuple[float, float, int]]) -> tuple[float, float, int]:
    """Mean, variance and count of several sets together."""
    n = sum(m[2] for m in moments)
    if not n:
        return 0.0, 0.0, 0
    mean = sum(m[0] * m[2] for m in moments) / n
    return mean, sum(m[2] * (m[1] + (m[0] - mean) ** 2) for m in moments) / n, n


def _medians(training: Training, groups_of: Callable[[tuple], list]) -> dict:
    """Exact medians of the groups of (first, part), all in the same passes."""
    rows = training.rows.withColumn("part", _part())
    return grouped_quantiles(rows, [f"x{j}" for j in range(len(training.columns))], [0.5], ["first", "part"], groups_of)


# --- calibrated logistic regression ----------------------------------------------------------------------


#: Rows of a block: few enough for their numbers to stay in a core's cache.
BLOCK_ROWS = 1 << 12
#: Numbers of a matrix of rows and groups.
MATRIX = 1 << 15
BLOCK = {"first": np.int32, "y": np.int8, "part": np.int8, "x": np.float64}
BLOCKS = "first binary, y binary, part binary, x binary"


def _block(first: np.ndarray, y: np.ndarray, part: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    columns = [np.ascontiguousarray(v, kind).tobytes() for v, kind in zip((first, y, part, x), BLOCK.values())]
    return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], list(BLOCK))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(first, y, part, x) of one block after the other; ``x`` has a row of numbers per training row."""
    for batch in batches:
        for i in range(batch.num_rows):
            first, y, part, x = (np.frombuffer(batch.column(n)[i].as_buffer(), kind) for n, kind in BLOCK.items())
            yield first, y, part, x.reshape(len(y), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (first, y, rank, numbers) to blocks, in which rows of one part, first fold and class lie side by side; a missing number is NaN."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            cut = batch.slice(at, BLOCK_ROWS)
            first, y, rank = (cut.column(n).to_numpy() for n in ("first", "y", "rank"))
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in cut.columns[3:]], axis=1)
            part = rank % CALIBRATION_FOLDS
            order = np.lexsort((y, first, part))
            yield _block(first[order], y[order], part[order], x[order])


def _moments_of(found: np.ndarray | None, x: np.ndarray) -> np.ndarray:
    """Count, mean and sum of squared deviations of the known values per column, added to those found before."""
    known = ~np.isnan(x)
    n = known.sum(axis=0).astype(float)
    mean = np.where(known, x, 0.0).sum(axis=0) / np.maximum(n, 1.0)
    spread = (np.where(known, x - mean, 0.0) ** 2).sum(axis=0)
    if found is None:
        return np.stack([n, mean, spread])
    both = np.maximum(found[0] + n, 1.0)
    gap = mean - found[1]
    return np.stack([found[0] + n, found[1] + gap * n / both, found[2] + spread + gap**2 * found[0] * n / both])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, part, rows, pos, moments) per task: rows and moments by first fold and part."""
    found: dict[tuple[int, int], tuple[int, int, np.ndarray]] = {}
    for first, y, part, x in _blocks(batches):
        for atom in sorted(set(zip(first.tolist(), part.tolist()))):
            use = (first == atom[0]) & (part == atom[1])
            rows, pos, moments = found.get(atom, (0, 0, None))
            found[atom] = rows + int(use.sum()), pos + int(y[use].sum()), _moments_of(moments, x[use])
    if found:
        counts = [pa.array([c[i] for c in found.values()], pa.int64()) for i in (0, 1)]
        atoms = [pa.array([a[i] for a in found], pa.int32()) for i in (0, 1)]
        moments = pa.array([c[2].ravel() for c in found.values()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*atoms, *counts, moments], ["first", "part", "rows", "pos", "moments"])


def _block_counts(blocks: DataFrame, size: int) -> dict[tuple[int, int], tuple]:
    """Rows, positives and the mean, variance and count per column, by first fold and part; a few rows per task come to the driver."""
    found: dict[tuple[int, int], list] = {}
    for r in blocks.mapInArrow(_counted, "first int, part int, rows long, pos long, moments array<double>").collect():
        found.setdefault((r["first"], r["part"]), []).append((r["rows"], r["pos"], np.array(r["moments"]).reshape(3, size)))
    return {
        atom: (
            sum(t[0] for t in tasks), sum(t[1] for t in tasks),
            [_merged([(float(m[1, j]), float(m[2, j] / m[0, j]) if m[0, j] else 0.0, int(m[0, j])) for _, _, m in tasks]) for j in range(size)],
        )
        for atom, tasks in found.items()
    }


@dataclass(frozen=True)
class _Scales:
    """Median, mean and deviation of every column, by group ``(fold, part)``."""

    stats: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]

    def scaled(self, group: tuple[int, int], x: np.ndarray) -> np.ndarray:
        """Filled and scaled numbers, and a column of ones."""
        median, mean, std = self.stats[group]
        missing = np.isnan(x)
        filled = np.where(missing, median, x) if missing.any() else x
        z = np.ones((len(x), x.shape[1] + 1))
        np.divide(np.subtract(filled, mean, out=z[:, :-1]), std, out=z[:, :-1])
        return z

    def common(self) -> tuple[np.ndarray, np.ndarray]:
        """A mean and a deviation that are near those of all groups: numbers scaled by them are scaled once for all."""
        _, mean, std = self.stats[max(self.stats)]
        return mean, std

    def moved(self, group: tuple[int, int]) -> np.ndarray:
        """What turns commonly scaled numbers and a one into those that ``scaled`` gives, as a matrix."""
        (mean, std), (_, own_mean, own_std) = self.common(), self.stats[group]
        out = np.diag(np.append(std / own_std, 1.0))
        out[-1, :-1] = (mean - own_mean) / own_std
        return out


@dataclass(frozen=True)
class _Margins:
    """Turns blocks of features into blocks of margins: a number per fold, by the fit that hasn't seen the row."""

    folds: int
    scales: _Scales
    weights: dict[tuple[int, int], np.ndarray]

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, y, part, x in _blocks(batches):
            margins = np.zeros((len(y), self.folds))
            for (k, p), w in self.weights.items():
                use = (first <= k) & (part == p)
                if use.any():
                    margins[use, k] = self.scales.scaled((k, p), x[use]) @ w
            yield _block(first, y, part, margins)


@dataclass(frozen=True)
class _Step:
    """What a task needs for one Newton step of all groups ``(fold, part)``."""

    weights: dict[tuple[int, int], np.ndarray]
    balance: dict[tuple[int, int], tuple[float, float]]  # weight of a row of class 0, 1; calibration: its target
    scales: _Scales | None = None  # without: calibration, the fold's margin is the only feature
    margins: _Margins | None = None  # calibration: how to get margins, if the blocks hold features

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(k, p, sums) per task: loss, gradient and curvature.

        Rows of one part, first fold and class count for the same groups, with one weight and target each: margins of all these groups are
        one matrix product, and so are gradients and curvatures."""
        scales = self.scales or (self.margins.scales if self.margins else None)
        groups, size = list(self.weights), len(next(iter(self.weights.values())))
        k, p = (np.array([g[i] for g in groups]) for i in (0, 1))
        total, filled = np.zeros((2, len(groups), 1 + size + size * size))
        touched = np.zeros(len(groups), bool)
        moved = [scales.moved(g) for g in groups] if scales else []
        linear = self.weights if self.scales else self.margins.weights if scales else {}
        directions = np.stack([t @ linear[g] for t, g in zip(moved, groups)], axis=1) if scales else None
        weights = np.stack([self.weights[g] for g in groups], axis=1)
        balance = np.array([self.balance[g] for g in groups])
        for first, y, part, x in _blocks(batches):
            if scales:
                mean, std = scales.common()
                whole, common = ~np.isnan(x).any(axis=1), np.ones((len(x), x.shape[1] + 1))
                common[:, :-1] = (x - mean) / std
            change = (np.diff(first) != 0) | (np.diff(y) != 0) | (np.diff(part) != 0)
            bounds = [0, *(np.flatnonzero(change) + 1).tolist(), len(y)]
            for s, e in zip(bounds, bounds[1:]):
                use = np.flatnonzero((k >= first[s]) & ((p != part[s]) if self.scales else (p == part[s])))
                if not len(use):
                    continue
                touched[use] = True
                run, weight = slice(s, e), balance[use, y[s]]
                known = (common[run] if whole[run].all() else common[run][whole[run]]) if scales else x[run]
                step = max(1, MATRIX // len(use))
                for at in range(0, len(known), step):
                    rows = known[at : at + step]
                    if self.scales:
                        self._add_linear(total, use, rows, directions[:, use], weight, int(y[s]))
                    else:
                        self._add_calibration(total, use, rows @ directions[:, use] if scales else rows[:, k[use]], weights, weight)
            if scales and not whole.all():
                first, y, part, x = (v[~whole] for v in (first, y, part, x))
                for g, group in enumerate(groups):
                    use = (first <= k[g]) & ((part != p[g]) if self.scales else (part == p[g]))
                    for label in np.unique(y[use]):
                        # A missing number is filled by the group's own median.
                        z, one, weight = scales.scaled(group, x[use & (y == label)]), np.array([g]), balance[[g], label]
                        if self.scales:
                            self._add_linear(filled, one, z, self.weights[group][:, None], weight, int(label))
                        else:
                            self._add_calibration(total, one, z @ linear[group][:, None], weights, weight)
        if self.scales:
            total = filled + np.stack([self._moved(t, m, size) for t, m in zip(total, moved)])
        if touched.any():
            columns = [pa.array(v[touched], pa.int32()) for v in (k, p)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(total[touched]), pa.list_(pa.float64()))], ["k", "p", "sums"])

    @staticmethod
    def _moved(sums: np.ndarray, by: np.ndarray, size: int) -> np.ndarray:
        """Gradient and curvature of commonly scaled numbers as those of a group's own."""
        curve = by.T @ sums[1 + size :].reshape(size, size) @ by
        return np.concatenate([sums[:1], by.T @ sums[1 : 1 + size], curve.ravel()])

    @staticmethod
    def _logistic(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Loss for target 0, probability, and their product's curvature."""
        e = np.exp(-np.abs(m))
        d = 1 / (1 + e)
        q = np.where(m >= 0, d, e * d)
        return np.maximum(m, 0) - np.log(d), q, e * d * d

    def _add_linear(self, total: np.ndarray, use: np.ndarray, z: np.ndarray, directions: np.ndarray, weight: np.ndarray, target: int) -> None:
        """Rows of one class, ``weight`` and direction by group."""
        m = z @ directions
        loss, q, c = self._logistic(m)
        size = z.shape[1]
        i, j = np.triu_indices(size)
        half = (z[:, i] * z[:, j]).T @ c
        curve = np.empty((size * size, len(use)))
        curve[i * size + j], curve[j * size + i] = half, half
        found = [(loss - m if target else loss).sum(axis=0)[None], z.T @ (q - target), curve]
        total[use] += (np.concatenate(found) * weight).T

    def _add_calibration(self, total: np.ndarray, use: np.ndarray, m: np.ndarray, weights: np.ndarray, target: np.ndarray) -> None:
        s = m * weights[0, use] + weights[1, use]
        loss, q, c = self._logistic(s)
        off, cm = q - target, c * m
        found = [(loss - target * s).sum(axis=0), (off * m).sum(axis=0), off.sum(axis=0), (cm * m).sum(axis=0), cm.sum(axis=0), cm.sum(axis=0), c.sum(axis=0)]
        total[use] += np.stack(found, axis=1)


def _newton(rows: DataFrame, step: _Step, ridge: np.ndarray, max_iter: int) -> dict[tuple[int, int], np.ndarray]:
    """Weighted logistic fits of all groups at once over staged blocks, one job a step and one row of sums per task and group.

    Steps are halved where the loss would rise.
    """
    size = len(ridge)
    fitted = {g: w.astype(float) for g, w in step.weights.items()}
    move, loss, done = {g: np.zeros(size) for g in fitted}, {g: np.inf for g in fitted}, set()
    for _ in range(max_iter):
        tried = {g: fitted[g] + move[g] for g in fitted if g not in done}
        now = replace(step, weights=tried)
        parts = rows.mapInArrow(now.sums, "k int, p int, sums array<double>")
        total = parts.select("k", "p", F.posexplode("sums").alias("at", "v")).groupBy("k", "p", "at").agg(F.sum("v").alias("v")).collect()
        sums: dict[tuple[int, int], np.ndarray] = {g: np.zeros(1 + size + size * size) for g in tried}
        for r in total:
            sums[r["k"], r["p"]][r["at"]] = r["v"]
        for g, s in sums.items():
            value = s[0] + 0.5 * float((ridge * tried[g] ** 2).sum())
            if value > loss[g] + 1e-9 * abs(loss[g]) and np.abs(move[g]).max() > 1e-9:
                move[g] = move[g] / 2
                continue
            curve = s[1 + size :].reshape(size, size) + np.diag(ridge) + 1e-10 * np.eye(size)
            fitted[g], loss[g] = tried[g], value
            move[g] = -np.linalg.solve(curve, s[1 : 1 + size] + ridge * tried[g])
            if np.abs(move[g]).max() < 1e-8:
                done.add(g)
        if len(done) == len(fitted):
            break
    return fitted


def fit_calibrated_by_fold(
    df: DataFrame, folds: Sequence[Fold], columns: Sequence[str] = tuple(FEATURE_COLS), max_iter: int = LOGISTIC_ITERATIONS
) -> list[CalibratedLogistic]:
    """Balanced logistic regression of every fold's training rows, calibrated in three parts: a fit
    on two thirds of the rows, with classes weighted to equal mass and a penalty of strength 1 against the summed loss, has its margin
    calibrated on the third. Thirds hold equal shares of both classes. All folds and thirds are fitted in the same jobs.
    """
    parts, size = range(CALIBRATION_FOLDS), len(columns)
    rows = ranked_rows(df, folds, columns)
    blocks = stage(rows.mapInArrow(_packed, BLOCKS), "logistic-blocks")
    training = Training(rows, tuple(folds), tuple(columns), _block_counts(blocks, size))
    groups = [(k, p) for k in range(len(folds)) for p in parts]
    seen = {(k, p): training.totals(k, [q for q in parts if q != p]) for k, p in groups}
    held = {(k, p): training.totals(k, [p]) for k, p in groups}
    if any(not 0 < pos < n for of in (seen, held) for pos, n in of.values()):
        raise RuntimeError("both classes are needed to fit a model")

    def members(atom: tuple[int, int]) -> list[tuple[int, int]]:
        return [(k, p) for k in range(atom[0], len(folds)) for p in parts if p != atom[1]]

    medians, stats = _medians(training, members), {}
    for k, p in groups:
        own = [c[2] for (first, part), c in training.counts.items() if first <= k and part != p]
        moments = [_merged([c[j] for c in own]) for j in range(size)]
        middles = [medians.get(((k, p), f"x{j}"), [0.0])[0] for j in range(size)]
        stats[k, p] = _stats_of(columns, seen[k, p][1], [(med, *m) for med, m in zip(middles, moments)])
    scales = _Scales({g: (np.array(s.median), np.array(s.mean), np.array([v or 1.0 for v in s.std])) for g, s in stats.items()})
    balance = {g: (n / (2.0 * (n - pos)), n / (2.0 * pos)) for g, (pos, n) in seen.items()}
    step = _Step({g: np.zeros(size + 1) for g in groups}, balance, scales)
    weights = _newton(blocks, step, np.array([1.0] * size + [0.0]), max_iter)
    # Targets are pulled in from 0 and 1 by the class counts of the calibrating rows.
    targets = {g: (1.0 / (n - pos + 2.0), (pos + 1.0) / (pos + 2.0)) for g, (pos, n) in held.items()}
    step = _Step({g: np.array([1.0, 0.0]) for g in groups}, targets, margins=_Margins(len(folds), scales, weights))
    if len(folds) <= size:  # margins take no more room than features: they are worked out once, else in every step
        of_features, blocks = blocks, stage(blocks.mapInArrow(step.margins.blocks, BLOCKS), "margins")
        step = replace(step, margins=None)
        discard(of_features)
    sigmoids = _newton(blocks, step, np.zeros(2), max_iter)
    discard(blocks)
    return [
        CalibratedLogistic(tuple(LinearPart(stats[k, p], tuple(map(float, weights[k, p][:-1])), float(weights[k, p][-1]), *map(float, sigmoids[k, p])) for p in parts))
        for k in range(len(folds))
    ]


def fit_calibrated_logistic(
    df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLS), max_iter: int = LOGISTIC_ITERATIONS
) -> CalibratedLogistic:
    return fit_calibrated_by_fold(df, [ALL_ROWS], columns, max_iter)[0]


def _logistic_scores(df: DataFrame, models: Sequence[CalibratedLogistic], columns: Sequence[str]) -> DataFrame:
    """``score`` by the model of the row's ``fold``: coefficients come from a row per fold, so one scan serves all folds."""
    size = len(columns)
    width = 4 * size + 3
    table = df.sparkSession.createDataFrame(
        [(k, [v for p in m.parts for v in p.numbers()]) for k, m in enumerate(models)], "fold int, numbers array<double>"
    )

    def probability(part: int) -> Column:
        at = lambda i: F.get("numbers", F.lit(part * width + i))
        values = [(F.coalesce(F.col(c).cast("double"), at(j)) - at(size + j)) / at(2 * size + j) * at(3 * size + j) for j, c in enumerate(columns)]
        margin = reduce(lambda a, b: a + b, values, at(4 * size))
        return _sigmoid(at(4 * size + 1) * margin + at(4 * size + 2))

    total = reduce(lambda a, b: a + b, [probability(p) for p in range(CALIBRATION_FOLDS)])
    # One row per validation fold, each a snapshot date.
    return df.join(F.broadcast(table), "fold").withColumn("score", total / CALIBRATION_FOLDS).drop("numbers")


# --- boosted trees --------------------------------------------------------------------------------------------


def fit_boosted_by_fold(
    df: DataFrame, folds: Sequence[Fold], columns: Sequence[str] = tuple(FEATURE_COLS), max_iter: int = TREE_ITERATIONS,
    task_rows: int = boosting.TASK_ROWS,
) -> list[BoostedTrees]:
    """Boosted trees of every fold's training rows. Bins are cut once, at exact quantiles of all rows that some fold trains on;
    a missing value counts as the fold's median."""
    rows = ranked_rows(df, folds, columns)
    training = Training(rows, tuple(folds), tuple(columns), _known_counts(rows, len(columns)))
    counts = {k: training.totals(k) for k in range(len(folds))}
    if any(not 0 < pos < n for pos, n in counts.values()):
        raise RuntimeError("both classes are needed to fit a model")
    names = [f"x{j}" for j in range(len(columns))]
    cuts = grouped_quantiles(training.rows, names, [i / TREE_BINS for i in range(1, TREE_BINS)])
    layout = boosting.Layout(tuple(tuple(sorted(set(cuts.get(((), n), [0.0])))) for n in names))
    fills = {k: (0,) * len(columns) for k in counts}
    if any(c[0] > n for c in training.counts.values() for n in c[2]):
        medians = _medians(training, lambda atom: list(range(atom[0], len(folds))))
        middles = {k: np.array([[medians.get((k, n), [0.0])[0] for n in names]]) for k in counts}
        fills = {k: tuple(int(b) for b in layout.binned(m)[0]) for k, m in middles.items()}
    settings = boosting.Settings(max_iter, TREE_DEPTH, TREE_STEP, TREE_LEAF_ROWS, TREE_BINS)
    held = F.pmod("rank", F.lit(settings.held_every)) == 0
    rows = boosting.binned_rows(training.rows, layout, names, F.col("first"), F.col("y"), held)
    models = boosting.grow_folds(rows, layout, settings, counts, fills, task_rows)
    discard(rows)
    return [BoostedTrees(tuple(columns), models[k]) for k in range(len(folds))]


def fit_boosted_trees(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLS), max_iter: int = TREE_ITERATIONS) -> BoostedTrees:
    return fit_boosted_by_fold(df, [ALL_ROWS], columns, max_iter)[0]


def _boosted_scores(df: DataFrame, models: Sequence[BoostedTrees], columns: Sequence[str]) -> DataFrame:
    return boosting.with_scores(df, {k: m.model for k, m in enumerate(models)}, columns, F.col("fold"))


# --- candidates ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Candidate:
    """How a model is fitted on all folds at once, and how rows with a ``fold`` are scored by them."""

    fit: Callable
    score: Callable


CANDIDATES: dict[str, Candidate] = {
    "logreg_calibrated": Candidate(fit_calibrated_by_fold, _logistic_scores),
    "hgb_challenger": Candidate(fit_boosted_by_fold, _boosted_scores),
}


def candidate(name: str) -> Candidate:
    if name not in CANDIDATES:
        raise ValueError(f"Unknown model name: {name}")
    return CANDIDATES[name]


def fit_model(name: str, df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLS), **options):
    return candidate(name).fit(df, [ALL_ROWS], columns, **options)[0]


def expanding_folds(class_counts: Sequence[tuple[date, int, int]], min_train_snapshots: int) -> list[Fold]:
    """Train on all snapshots before the validated one. ``class_counts`` lists
    ``(snapshot, positives, rows)`` in date order; a history of one class is skipped."""
    if len(class_counts) <= min_train_snapshots:
        raise RuntimeError("Not enough snapshots for rolling time CV")
    folds: list[Fold] = []
    for i in range(min_train_snapshots, len(class_counts)):
        positives = sum(p for _, p, _ in class_counts[:i])
        rows = sum(n for _, _, n in class_counts[:i])
        if class_counts[i][2] and 0 < positives < rows:
            folds.append(Fold(f"cv_fold_{len(folds) + 1}", class_counts[0][0], class_counts[i][0]))
    if not folds:
        raise RuntimeError("No valid CV folds generated.")
    return folds


def snapshot_class_counts(ds: DataFrame) -> list[tuple[date, int, int]]:
    """One row per snapshot date comes to the driver."""
    rows = ds.groupBy("snapshot_date").agg(F.sum(LABEL).alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["snapshot_date"], r["pos"], r["n"]) for r in rows)


def scored_rows(model, df: DataFrame, model_name: str, split: str) -> DataFrame:
    return model.score(df).select(
        F.lit(model_name).alias("model_name"), F.lit(split).alias("split_name"), *KEYS, F.col(LABEL).alias("y"), "score"
    )


def rolling_time_cv(
    ds_train: DataFrame, model_name: str, min_train_snapshots: int = 5, columns: Sequence[str] = tuple(FEATURE_COLS), **options
) -> tuple[list[Fold], DataFrame]:
    """The folds and the staged out-of-fold scores of all of them."""
    chosen = candidate(model_name)
    folds = expanding_folds(snapshot_class_counts(ds_train), min_train_snapshots)
    models = chosen.fit(ds_train, folds, columns, **options)
    # One row per fold.
    plan = ds_train.sparkSession.createDataFrame([(f.validation, k, f.name) for k, f in enumerate(folds)], "snapshot_date date, fold int, split_name string")
    validated = chosen.score(ds_train.join(F.broadcast(plan), "snapshot_date"), models, columns)
    scored = validated.select(F.lit(model_name).alias("model_name"), "split_name", *KEYS, F.col(LABEL).alias("y"), "score")
    return folds, stage(scored, "oof")


def label_repeat(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn(
        "churn_label", F.when(F.col("score") >= threshold, "LIKELY_REPEAT").otherwise("UNLIKELY_REPEAT")
    )
