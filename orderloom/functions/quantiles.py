"""Exact quantiles by refinement: a few narrow aggregates, and no exchange of values.

The first pass finds each column's range and counts. Every further pass counts values in cells between known
bounds and keeps, of each wanted rank, only the cell that holds it, cut to the values that are
really in it. Once few values are left in the wanted cells, those come to the driver.

Values are counted in tasks, on Arrow batches: sorted, the cells are runs of them. Functions that run in executors travel by value.

One run serves many groups: rows are counted per atom (the values of ``atoms``, which must be few), and a
group is a set of atoms, so a row that counts for many groups, as in an expanding history, is read
and counted once. NULL and NaN are skipped.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What one pass may bring to the driver, in rows: cells of all atoms and columns, or values at the end.
DRIVER_ROWS = 1 << 16
CELLS = 512


def interpolated(lo: float, hi: float, t: float) -> float:
    """Linear interpolation, taken from the nearer end."""
    return hi - (hi - lo) * (1 - t) if t >= 0.5 else lo + (hi - lo) * t


@dataclass
class _Target:
    """A wanted rank of one group and column: the interval that holds it and its rank inside."""

    group: Hashable
    column: int
    rank: int
    interval: tuple[float, float]
    value: float | None = None


@dataclass
class _Pass:
    """The intervals that targets still wait for: disjoint and sorted within each column, numbered through."""

    intervals: list[tuple[int, tuple[float, float]]]

    @classmethod
    def over(cls, targets: Iterable[_Target]) -> _Pass:
        return cls(sorted({(t.column, t.interval) for t in targets}))

    def counts(self, df: DataFrame, atoms: Sequence[str], columns: Sequence[str], cells: int | None) -> DataFrame:
        """(atoms, i, cell, n, lo, hi): how many values are in each of equal parts of each interval, and the least and greatest of them.
        Without ``cells`` each value has its own, of which ``lo`` is the name."""
        names = [f"atom{i}" for i in range(len(atoms))]
        used = sorted({j for j, _ in self.intervals})
        values = [F.col(columns[j]).cast("double").alias(f"v{j}") for j in used]
        rows = df.select(*[F.col(a).alias(n) for a, n in zip(atoms, names)], *values)
        types = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in names]
        found = rows.mapInArrow(_counter(self.intervals, names, used, cells), ", ".join([*types, "i int, cell int, n long, lo double, hi double"]))
        key = ["i", "cell"] if cells else ["i", "cell", "lo"]
        least = [F.min("lo").alias("lo")] if cells else []
        return found.groupBy(*names, *key).agg(F.sum("n").alias("n"), *least, F.max("hi").alias("hi"))


#: Rows whose values are sorted at once.
RUN_ROWS = 1 << 17


def _cells(values: np.ndarray, intervals: list[tuple[float, float]], cells: int | None) -> tuple[np.ndarray, ...]:
    """(i, cell, n, lo, hi) of the values that are in one of the sorted intervals."""
    lows, highs = (np.array([bounds[k] for bounds in intervals]) for k in (0, 1))
    values = np.sort(values[~np.isnan(values)] + 0.0)  # -0.0 counts as 0.0
    at = np.searchsorted(highs, values, "left")
    inside = at < len(highs)
    inside[inside] = lows[at[inside]] <= values[inside]
    at, values = at[inside], values[inside]
    if cells:
        # Halves, so that the widest range of doubles doesn't overflow.
        with np.errstate(invalid="ignore"):
            share = (values / 2 - lows[at] / 2) / (highs[at] / 2 - lows[at] / 2)
            cell = np.minimum(cells - 1, np.floor(np.nan_to_num(share) * cells)).astype(np.int32)
    else:
        cell = np.zeros(len(at), np.int32)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (cell[1:] != cell[:-1] if cells else values[1:] != values[:-1])
    start = np.flatnonzero(new)
    ends = np.append(start, len(at))[1:]
    return at[start].astype(np.int32), cell[start], ends - start, values[start], values[ends - 1]


def _counter(intervals: list[tuple[int, tuple[float, float]]], names: Sequence[str], used: Sequence[int], cells: int | None):
    """Counts of a run of rows after the other; a task adds them up before it sends them, so that it sends few."""
    own = {j: [(k, bounds) for k, (column, bounds) in enumerate(intervals) if column == j] for j in used}
    fields = [*names, "i", "cell", "n", "lo", "hi"]
    key = [*names, "i", "cell"] + ([] if cells else ["lo"])

    def added(parts: list[pa.Table]) -> pa.Table:
        sums = [("n", "sum"), ("hi", "max")] + ([("lo", "min")] if cells else [])
        whole = pa.concat_tables(parts).group_by(key, use_threads=False).aggregate(sums)
        whole = whole.rename_columns([{"n_sum": "n", "hi_max": "hi", "lo_min": "lo"}.get(c, c) for c in whole.column_names])
        return whole.select(fields)

    def counted(rows: pa.Table) -> list[pa.Table]:
        code, atoms = np.zeros(rows.num_rows, np.int64), [()]
        for n in names:
            column = rows.column(n).combine_chunks().dictionary_encode("encode")
            code = code * len(column.dictionary) + column.indices.to_numpy()
            atoms = [(*a, column.dictionary[i : i + 1]) for a in atoms for i in range(len(column.dictionary))]
        values = {j: rows.column(f"v{j}").to_numpy() for j in used}
        out = []
        for c in np.unique(code).tolist() if names else [0]:
            mine = np.flatnonzero(code == c) if names else slice(None)
            for j in used:
                at, *rest = _cells(values[j][mine], [bounds for _, bounds in own[j]], cells)
                arrays = [pa.array(at + own[j][0][0], pa.int32()), *(pa.array(x, t) for x, t in zip(rest, (pa.int32(), pa.int64(), pa.float64(), pa.float64())))]
                first = [a.take(pa.array(np.zeros(len(at), np.int32))) for a in atoms[c]]
                out.append(pa.table([*first, *arrays], fields))
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        found: list[pa.Table] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= RUN_ROWS:
                found = [added([*found, *counted(pa.Table.from_batches(waiting))])]
                waiting = []
        if sum(b.num_rows for b in waiting):
            found = [added([*found, *counted(pa.Table.from_batches(waiting))])]
        for table in found:
            yield from table.to_batches()

    return count


def grouped_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], atoms: Sequence[str] = (),
    groups_of: Callable[[tuple], Iterable[Hashable]] = lambda atom: [()], driver_rows: int = DRIVER_ROWS,
) -> dict[tuple[Hashable, str], list[float]]:
    """``{(group, column): quantiles}`` with linear interpolation; a group without values of a column is left out.

    ``df`` is read once a pass, three or four times in all: pass a staged one.
    """
    names = [f"atom{i}" for i in range(len(atoms))]
    everything = _Pass([(j, (-math.inf, math.inf)) for j in range(len(columns))])
    first = everything.counts(df, atoms, columns, 1).collect()
    members = {atom: list(groups_of(atom)) for atom in {tuple(r[n] for n in names) for r in first}}

    totals: dict[tuple, int] = defaultdict(int)
    counts: dict[int, int] = defaultdict(int)
    whole: dict[int, tuple[float, float]] = {}
    for r in first:
        lo, hi = whole.get(r["i"], (math.inf, -math.inf))
        whole[r["i"]] = (min(lo, r["lo"]), max(hi, r["hi"]))
        counts[r["i"]] += r["n"]
        for g in members[tuple(r[n] for n in names)]:
            totals[g, r["i"]] += r["n"]
    targets = {
        (g, j, rank): _Target(g, j, rank, whole[j])
        for (g, j), n in totals.items() for p in probs for rank in (math.floor((n - 1) * p), math.ceil((n - 1) * p))
    }
    held = {(j, whole[j]): n for j, n in counts.items()}

    def settle() -> list[_Target]:
        for t in targets.values():
            if t.value is None and t.interval[0] == t.interval[1]:
                t.value = t.interval[0]
        return [t for t in targets.values() if t.value is None]

    while open_targets := settle():
        now = _Pass.over(open_targets)
        width = None
        if sum(held[i] for i in now.intervals) > driver_rows:
            width = max(16, min(CELLS, driver_rows // (len(members) * len(now.intervals))))
        found = now.counts(df, atoms, columns, width).toArrow().to_pydict()
        atom_of = zip(*[found[n] for n in names]) if names else repeat(())
        cells = list(zip(atom_of, found["i"], found["cell" if width else "lo"], found["n"], found["lo"], found["hi"]))
        held.update(_narrow(open_targets, now, cells, members))

    out: dict[tuple[Hashable, str], list[float]] = {}
    for (g, j), n in totals.items():
        at = [(n - 1) * p for p in probs]
        out[g, columns[j]] = [interpolated(targets[g, j, math.floor(r)].value, targets[g, j, math.ceil(r)].value, r - math.floor(r)) for r in at]
    return out


def _narrow(open_targets: list[_Target], now: _Pass, cells: list[tuple], members: dict[tuple, list]) -> dict[tuple, int]:
    """Move each target into the cell that holds its rank; gives the counts of the new intervals."""
    bounds: dict[tuple, tuple[float, float]] = {}
    counts: dict[tuple, int] = defaultdict(int)
    per_group: dict[tuple, dict] = defaultdict(lambda: defaultdict(int))
    number = {interval: i for i, interval in enumerate(now.intervals)}
    waiting: dict[int, set] = defaultdict(set)
    for t in open_targets:
        waiting[number[t.column, t.interval]].add(t.group)
    concerned = {(atom, i): [g for g in groups if g in waiting[i]] for atom, groups in members.items() for i in number.values()}
    for atom, i, cell, n, lo, hi in cells:
        low, high = bounds.get((i, cell), (math.inf, -math.inf))
        bounds[i, cell] = (min(low, lo), max(high, hi))
        counts[i, cell] += n
        for g in concerned[atom, i]:
            per_group[g, i][cell] += n
    runs = {place: (order := sorted(found), list(accumulate(found[c] for c in order))) for place, found in per_group.items()}
    held = {}
    for t in open_targets:
        i = number[t.column, t.interval]
        order, ends = runs[t.group, i]
        k = bisect_right(ends, t.rank)
        t.rank -= ends[k - 1] if k else 0
        t.interval = bounds[i, order[k]]
        held[t.column, t.interval] = counts[i, order[k]]
    return held


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per column that has values, ``(name, quantiles)``."""
    found = grouped_quantiles(df, columns, probs)
    rows = [(c, found[(), c]) for c in columns if ((), c) in found]
    return df.sparkSession.createDataFrame(rows, "name string, quantiles array<double>")


def quantile_bin(c: Column, edges: Column) -> Column:
    """1-based bin of ``c`` for sorted ``edges``: right-closed, repeated edges merged,
    the lowest value in bin 1. A constant column has one bin."""
    distinct = F.array_distinct(edges)
    inner = F.slice(distinct, 2, F.greatest(F.size(distinct) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda e: e < c)) + 1
