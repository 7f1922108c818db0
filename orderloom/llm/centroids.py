"""Centroid clustering of vectors by a bisector tournament, in integers throughout.

Components become ``floor(scale * x)``. A point is nearer to centroid b than to a
smaller-numbered a exactly where ``2 (b - a) . x > |b|^2 - |a|^2``, so the normals
and thresholds of all pairs are worked out once a round, and k - 1 sign tests
leave one centroid: the holder meets the next number, a zero keeps the holder. Only
the distance to the winner is then worked out, as the last step.

A round is one pass over the staged integer vectors: a task gives back one row of
counts and sums per centroid, Spark adds them up, and k x dimensions numbers
reach the driver.

Rows whose vector is null, has another number of components or holds a null or
non-finite one are left out. A null id takes part but comes last among the starting centroids; equal
ids are separate points. With fewer than k usable rows there are that many
centroids, and with none the result is empty. Distances must fit in a long: a
component beyond the bound of ``largest_component`` raises an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.sources.staging import discard, stage


def largest_component(dimensions: int) -> int:
    """Squared distances of integers up to this size, and the sign tests, stay below 2^63."""
    return math.isqrt((2**63 - 1) // max(1, dimensions)) // 2


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(id, v) of the usable rows."""
    v = F.col(vector_col).cast("array<double>")
    usable = (F.size(v) == dimensions) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    bound = largest_component(dimensions)

    def whole(x: Column) -> Column:
        wrong = F.raise_error(F.lit(f"a component is beyond {bound / scale}: distances would not fit in a long"))
        return F.when(F.abs(x * scale) <= bound, F.floor(x * scale)).otherwise(wrong.cast("long"))

    return vectors.filter(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("id"), F.transform(v, whole).alias("v"))


@dataclass(frozen=True)
class Tournament:
    """Centroids, and for numbers a < b the test that b passes where it is strictly nearer."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Tournament:
        norms = (centroids * centroids).sum(axis=1)
        return cls(centroids, 2 * (centroids[None] - centroids[:, None]), norms[None] - norms[:, None])

    def winners(self, x: np.ndarray) -> np.ndarray:
        holder = np.zeros(len(x), np.int64)
        for b in range(1, len(self.centroids)):
            for a in np.unique(holder):
                rows = np.flatnonzero(holder == a)
                nearer = x[rows] @ self.normals[a, b] > self.thresholds[a, b]
                holder[rows[nearer]] = b
        return holder

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row (cluster, n, total) per centroid and task."""
        k, d = self.centroids.shape
        n, total = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            won = self.winners(x)
            n += np.bincount(won, minlength=k)
            for c in np.unique(won):
                total[c] += x[won == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(n), pa.array(list(total), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    def assigned(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), self.centroids.shape[1])
            won = self.winners(x)
            away = x - self.centroids[won]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(won), pa.array((away * away).sum(axis=1))], ["id", "cluster", "distance"])


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def starting_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids hash lowest, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def moved(tournament: Tournament, rows: DataFrame) -> np.ndarray:
    """The centroids' floored means; those without a vector stay."""
    parts = rows.select("v").mapInArrow(tournament.sums, "cluster long, n long, total array<long>")
    found = parts.select("cluster", "n", F.posexplode("total").alias("at", "s")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = tournament.centroids.copy()
    for r in found.collect():
        if r["n"]:
            out[r["cluster"], r["at"]] = r["s"] // r["n"]
    return out


def cluster_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, seed: int = 3,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    spark = vectors.sparkSession
    rows = stage(integer_vectors(vectors, id_col, vector_col, dimensions, scale), "whole-vectors")
    id_type = rows.schema["id"].dataType.simpleString()
    centroids = starting_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"),
        )])
    for _ in range(rounds):
        centroids = moved(Tournament.of(centroids), rows)
    found = rows.mapInArrow(Tournament.of(centroids).assigned, f"id {id_type}, cluster long, distance long")
    found = stage(found, "clusters")
    discard(rows)

    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = spark.createDataFrame(
        [(c, inertia.get(c, 0), sum(inertia.values()), name) for c, name in enumerate(names)],
        "cluster long, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # One row per centroid: k of them.
    return found.join(F.broadcast(table), "cluster").select(
        F.col("id").alias(id_col), F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
