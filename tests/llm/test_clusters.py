"""Centroid clustering against whole-number brute force."""

import hashlib
import math

import numpy as np
import pytest

from orderloom.llm import centroids


def by_brute_force(rows, k, rounds, dimensions, scale=1024, seed=3):
    """Distances to every centroid, in Python's whole numbers."""
    ok = [(i, v) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    points = [(i, [math.floor(scale * x) for x in v]) for i, v in ok]
    order = sorted(points, key=lambda p: (p[0] is None, "" if p[0] is None else hashlib.sha256(f"{seed}:{p[0]}".encode()).hexdigest(), p[1]))
    means = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        won = [nearest(v)[1] for _, v in points]
        for c in range(len(means)):
            own = [v for (_, v), w in zip(points, won) if w == c]
            if own:
                means[c] = [sum(column) // len(own) for column in zip(*own)]
    found = [nearest(v) for _, v in points]
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    per = [sum(d for d, c in found if c == own) for own in range(len(means))]
    return sorted(((i, c, d, per[c], sum(per), names[c]) for (i, _), (d, c) in zip(points, found)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], "vec_id long, embedding array<double>, cluster int, id string, v double")


@pytest.mark.parametrize("k, rounds", [(1, 3), (2, 0), (5, 4), (8, 10)])
def test_clusters_match_brute_force(spark, k, rounds):
    rng = np.random.default_rng(k)
    rows = [(i, (rng.normal(size=6) + 3 * rng.normal(size=6).round()).tolist()) for i in range(150)]
    df = frame(spark, rows).repartition(5)
    assert got(centroids.cluster_vectors(df, k=k, rounds=rounds, dimensions=6)) == by_brute_force(rows, k, rounds, 6)


def test_clusters_ties_repeats_and_odd_rows(spark):
    # Points on a small grid: many equal distances, equal vectors, empty clusters.
    rows = [(i, [float(i % 3), float(i % 2), 0.0]) for i in range(40)] + [(3, [1.0, 1.0, 1.0])] * 3 + [(None, [2.0, 2.0, 2.0])] * 2
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, math.nan, 0.0]), (104, [math.inf, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [0.0, -0.0, -1e-9])]
    assert got(centroids.cluster_vectors(frame(spark, rows), k=8, rounds=5, dimensions=3)) == by_brute_force(rows, 8, 5, 3)


def test_clusters_of_few_or_no_rows(spark):
    few = [(1, [0.5, 1.0]), (2, [-0.5, 1.0])]
    assert got(centroids.cluster_vectors(frame(spark, few), dimensions=2)) == by_brute_force(few, 8, 10, 2)
    assert centroids.cluster_vectors(frame(spark, few).limit(0), dimensions=2).count() == 0
    assert centroids.cluster_vectors(frame(spark, [(1, None)]), dimensions=2).count() == 0


def test_tournament_is_exact_at_the_bound():
    bound = centroids.largest_component(64)
    means = np.array([[bound] * 64, [-bound] * 64, [bound] * 63 + [bound - 1]], np.int64)
    points = np.array([[-bound] * 64, [bound] * 63 + [bound - 1], [bound] * 64, [0] * 64], np.int64)
    want = [min((sum((int(x) - int(y)) ** 2 for x, y in zip(p, m)), c) for c, m in enumerate(means)) for p in points]
    tournament = centroids.Tournament.of(means)
    won = tournament.winners(points)
    assert won.tolist() == [c for _, c in want]
    away = points - means[won]
    assert (away * away).sum(axis=1).tolist() == [d for d, _ in want]


def test_component_beyond_the_bound_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster_vectors(frame(spark, [(1, [1e30, 0.0])]), dimensions=2).collect()
