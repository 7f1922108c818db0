"""Near-duplicate vectors by PCA-ordered tiled comparison, exact at the threshold.

Equal vectors become one class first. Classes are ordered by their first
principal component and cut into blocks of bounded size; two unit vectors of
cosine t or more differ by at most sqrt(2 - 2t) in any direction, so only blocks
that are that close in the order are compared. Inside a pair of blocks, tiles
accumulate the leading principal dimensions first; what is left of a product is
at most the product of the two suffix norms, and a pair whose sum can't reach
the threshold is dropped. Pairs that survive all steps are decided in double
precision on the original numbers. A task gives back counts per vector and a
spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.blocks import star_forest
from orderloom.llm.components import connected_components
from orderloom.sources.staging import stage

BLOCK_ROWS = 8192
TILE_ROWS = 512
STEPS = (16, 32)
SLACK = 1e-4  # leading dimensions are accumulated in single precision


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _unit(rows) -> np.ndarray:
    x = np.array([np.asarray(r, float) for r in rows], float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, part in batch.groupby(batch["vector"].map(len)):
            x = _unit(part["vector"])
            sums[size] = sums.get(size, 0) + x.T @ x
    if sums:
        yield pd.DataFrame({"size": list(sums), "outer": [m.reshape(-1) for m in sums.values()]})


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, directions by falling second moment (about 0, as cosines are); length x length numbers each."""
    parts = classes.select("vector").mapInPandas(_moments, "size int, outer array<double>")
    total = parts.select("size", F.posexplode("outer").alias("at", "v")).groupBy("size", "at").agg(F.sum("v").alias("v")).collect()
    axes = {}
    for size in {r["size"] for r in total}:
        m = np.zeros(size * size)
        for r in total:
            if r["size"] == size:
                m[r["at"]] = r["v"]
        values, vectors = np.linalg.eigh(m.reshape(size, size))
        axes[size] = vectors[:, np.argsort(-values, kind="stable")]
    return axes


def _with_first(axes: dict[int, np.ndarray]):
    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, sizes = np.zeros(len(batch)), batch["vector"].map(len).to_numpy()
            for size in np.unique(sizes):
                first[sizes == size] = _unit(batch["vector"][sizes == size]) @ axes[int(size)][:, 0]
            yield batch.assign(first=first, size=sizes)

    return project


@dataclass(frozen=True)
class Order:
    """Blocks along the first component: a stretch between two cuts is one block or, if crowded, several."""

    cuts: np.ndarray
    base: np.ndarray  # first block of each stretch
    parts: np.ndarray  # its number of blocks
    first_partner: np.ndarray  # per block
    last_partner: np.ndarray

    def blocks(self, first: np.ndarray, ids: np.ndarray) -> np.ndarray:
        stretch = np.searchsorted(self.cuts, first, "right")
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.base[stretch] + (mixed % self.parts[stretch].astype(np.uint64)).astype(np.int64)


def _order(projected: DataFrame, reach: float, block_rows: int) -> Order:
    """A few numbers per block of ``block_rows`` classes reach the driver."""
    blocks = max(1, -(-projected.count() // block_rows))
    wanted = [k / blocks for k in range(1, blocks)]
    cuts = np.unique(projected.approxQuantile("first", wanted, 0.1 / blocks)) if wanted else np.zeros(0)

    @F.pandas_udf("long")
    def stretch(first: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, first.to_numpy(), "right"))

    found = projected.groupBy(stretch("first").alias("s")).agg(F.count(F.lit(1)).alias("c"), F.min("first").alias("lo"), F.max("first").alias("hi")).collect()
    parts, lo, hi = np.ones(len(cuts) + 1, np.int64), np.full(len(cuts) + 1, np.inf), np.full(len(cuts) + 1, -np.inf)
    for r in found:
        parts[r["s"]], lo[r["s"]], hi[r["s"]] = max(1, -(-r["c"] // (2 * block_rows))), r["lo"], r["hi"]
    # Empty stretches take the next one's bounds, so that both lists rise.
    lo, hi = np.minimum.accumulate(lo[::-1])[::-1], np.maximum.accumulate(hi)
    base = np.cumsum(parts) - parts
    before = np.searchsorted(hi, lo - reach, "left")
    after = np.searchsorted(lo, hi + reach, "right") - 1
    spread = np.repeat(np.arange(len(parts)), parts)
    return Order(cuts, base, parts, base[before][spread], (base + parts - 1)[after][spread])


def _dealer(order: Order):
    """A row for each pair of blocks (a <= b) that its block takes part in."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            block = order.blocks(batch["first"].to_numpy(), batch["rep"].to_numpy())
            rows = batch[["rep", "n", "vector"]].assign(block=block)
            for own in np.unique(block):
                part = rows[block == own]
                for other in range(order.first_partner[own], order.last_partner[own] + 1):
                    yield part.assign(a=min(own, other), b=max(own, other))

    return deal


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit rows (in principal order) whose cosine may reach the threshold."""
    d = x.shape[1]
    steps = [s for s in STEPS if s < d] + [d]
    xs, ys = x.astype(np.float32), y.astype(np.float32)
    tails = [(np.sqrt(np.square(x[:, s:]).sum(1)).astype(np.float32), np.sqrt(np.square(y[:, s:]).sum(1)).astype(np.float32)) for s in steps]
    floor = np.float32(threshold - SLACK)
    done = steps[0]
    dots = xs[:, :done] @ ys[:, :done].T
    i, j = np.nonzero(dots >= floor - np.outer(*tails[0]))
    value = dots[i, j]
    for s, (tx, ty) in zip(steps[1:], tails[1:]):
        value = value + np.einsum("ij,ij->i", xs[i, done:s], ys[j, done:s])
        alive = value + tx[i] * ty[j] >= floor
        i, j, value, done = i[alive], j[alive], value[alive], s
    return i, j


def _comparer(axes: np.ndarray, threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        same = rows["a"].iloc[0] == rows["b"].iloc[0]
        sides = []
        for part in [rows[rows["block"] == rows["a"]]] + ([] if same else [rows[rows["block"] == rows["b"]]]):
            unit = _unit(part["vector"]) if len(part) else np.zeros((0, len(axes)))
            sides.append((part["rep"].to_numpy(), part["n"].to_numpy(), unit, unit @ axes, np.zeros(len(part), np.int64)))
        (ida, na, ua, pa, counts_a), (idb, nb, ub, pb, counts_b) = sides[0], sides[-1]
        out = [pd.DataFrame({"a": ida[:0], "b": ida[:0], "links": na[:0]})]
        for p in range(0, len(ida), TILE_ROWS):
            for q in range(p if same else 0, len(idb), TILE_ROWS):
                i, j = tile_links(pa[p : p + TILE_ROWS], pb[q : q + TILE_ROWS], threshold)
                i, j = i + p, j + q
                if same:
                    i, j = i[i < j], j[i < j]
                linked = np.einsum("ij,ij->i", ua[i], ub[j]) >= threshold
                i, j = i[linked], j[linked]
                if len(i):
                    np.add.at(counts_a, i, nb[j])
                    np.add.at(counts_b, j, na[i])
                    x, y = star_forest(ida[i], idb[j])
                    out.append(pd.DataFrame({"a": x, "b": y, "links": 0}))
        for ids, _, _, _, counts in sides:
            some = counts > 0
            out.append(pd.DataFrame({"a": ids[some], "b": ids[some], "links": counts[some]}))
        return pd.concat(out, ignore_index=True)

    return compare


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, and so do vectors of different lengths. Equal vectors link with
    each other. Ids should be unique and not null; rows that repeat an id count as
    vectors of their own. An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = stage(rows.withColumn("usable", _usable(F.col("vector"))), "vectors")
    classes = stage(rows.filter("usable").groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "vector-classes")
    kind = classes.schema["vector"].dataType.simpleString()
    axes = principal_axes(classes)
    projected = stage(classes.mapInPandas(_with_first(axes), f"vector {kind}, rep long, n long, first double, size int"), "projected")
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    found = None
    for size, own_axes in sorted(axes.items()):
        own = projected.filter(F.col("size") == size)
        order = _order(own, reach, block_rows)
        dealt = own.mapInPandas(_dealer(order), f"rep long, n long, vector {kind}, block long, a long, b long")
        part = dealt.groupBy("a", "b").applyInPandas(_comparer(own_axes, threshold), "a long, b long, links long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = classes.select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.col("n").alias("links")).limit(0)
    found = stage(found, "links")
    counts = found.filter("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.filter("links = 0"), "a", "b").withColumnRenamed("node", "rep")
    described = stage(classes.join(counts, "rep", "left").join(parts, "rep", "left"), "described")
    keyed = rows.withColumn("key", F.when(F.col("usable"), F.col("vector")))
    joined = keyed.join(described.withColumnRenamed("vector", "key"), "key", "left")
    component = F.coalesce("component", "rep", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("n") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
