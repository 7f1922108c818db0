"""Connected components by repeated contraction of the edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.sources.staging import stage

#: Edges that one task labels at once: two longs each. More are contracted by joins first.
TASK_EDGES = 1 << 20


def _priority(node: str, turn: int) -> Column:
    # By id, stars with the least node as hub collapse at once; by a hash, long chains shrink by a constant factor.
    return F.col(node) if turn % 2 == 0 else F.xxhash64(F.col(node), F.lit(turn))


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node that it reaches) for all nodes of the edges."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = flat[: len(a)], flat[len(a) :], np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, label[x], label[y])
        np.minimum.at(least, label[y], label[x])
        least = least[least[label]]
        if (least == label).all():
            return nodes, nodes[label]
        label = least


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if parts:
        nodes, least = least_reachable(*(np.concatenate(c) for c in zip(*parts)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["v", "to"])


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge (longs); a component's name is its least node.

    Each turn every node moves onto its neighbour (or itself) of least priority
    and edges are rewritten, until none is left: a logarithmic number of turns.
    No neighbour list is gathered; joins read staged frames, so that Spark can
    split the rows of a node with very many edges. At most ``TASK_EDGES`` edges, which a
    task holds in memory whatever they are, are labelled in one step.
    """
    pairs = edges.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    pairs = stage(pairs, "edges")
    members, turn = None, 0
    while left := pairs.count():
        if left <= TASK_EDGES:
            moves = stage(pairs.coalesce(1).mapInArrow(_labelled, "v long, to long"), "moves")
            if members is None:
                return moves.select(F.col("v").alias("node"), F.col("to").alias("component"))
            members = members.join(moves, F.col("at") == F.col("v"), "left").select("node", F.coalesce("to", "at").alias("at"))
            members = stage(members, "members")
            break
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy(F.col("a").alias("v")).agg(F.min(F.struct(_priority("b", turn).alias("p"), F.col("b").alias("to"))).alias("m"))
        stays = _priority("v", turn) < F.col("m.p")
        moves = stage(best.select("v", F.when(stays, F.col("v")).otherwise(F.col("m.to")).alias("to")), "moves")
        moved = pairs.join(moves, F.col("a") == F.col("v")).select(F.col("to").alias("a"), "b")
        right = moved.join(moves, F.col("b") == F.col("v")).select("a", F.col("to").alias("b")).filter("a <> b")
        pairs = stage(right.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if members is None:
            members = moves.select(F.col("v").alias("node"), F.col("to").alias("at"))
        else:
            members = members.join(moves, F.col("at") == F.col("v"), "left").select("node", F.coalesce("to", "at").alias("at"))
        members = stage(members, "members")
        turn += 1
    if members is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    names = stage(members.groupBy(F.col("at").alias("v")).agg(F.min("node").alias("component")), "names")
    return members.join(names, F.col("at") == F.col("v")).select("node", "component")
