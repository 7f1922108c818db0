"""Embedding near-dedup, n-gram Jaccard join and connected components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from cases import SF, TEXTS, Groups, documents, edge_docs, empty_docs, table

from orderloom.llm import components, embeddings, jaccard_join
from orderloom.llm.components import connected_components
from orderloom.llm.queries import QUERIES


def vectors_by_brute_force(rows, threshold=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    groups, links = Groups(), Counter()
    for a in ok:
        for b in ok:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    groups.join(rows[a][0], rows[b][0])
    return sorted((i, links[k], groups.find(i), groups.find(i) == i) for k, (i, _) in enumerate(rows))


def test_vectors_query(spark):
    rows = [(r[0], r[1]) for r in table("embeddings")]
    assert sorted(map(tuple, QUERIES["op6_embedding_near_dedup"](spark, SF).collect())) == vectors_by_brute_force(rows)


@pytest.mark.parametrize("block_rows", [16, 8192])
def test_vectors_groups_and_edges(spark, block_rows):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(12):
        centre = rng.normal(size=24)
        rows += [(len(rows) + j, (centre + rng.normal(size=24) * 0.25 * (j > 0)).tolist()) for j in range(10)]
    same = rows[0][1]
    rows += [(200 + j, same) for j in range(30)]
    odd = [None, [], [0.0] * 24, [float("nan")] + same[1:], [float("inf")] + same[1:], [None] + same[1:], same[:5], same[:5], [x * 1e150 for x in same]]
    rows += [(300 + j, v) for j, v in enumerate(odd)]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<double>, rep int, key string, links int")
    got = embeddings.near_vectors(df, block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == vectors_by_brute_force(rows)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_by_brute_force(docs):
    sets = [shingle_set(t or "") for _, t in docs]
    groups, links = Groups(), Counter()
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-12:
                links[a] += 1
                links[b] += 1
                groups.join(docs[a][0], docs[b][0])
    return sorted((i, links[k], groups.find(i), groups.find(i) == i) for k, (i, _) in enumerate(docs))


def test_near_query(spark):
    assert sorted(map(tuple, QUERIES["op9_jaccard_join"](spark, SF).collect())) == near_by_brute_force(documents())


def test_near_edges(spark):
    docs = [(i, t) for i, t in TEXTS if i is not None]
    got = jaccard_join.near_documents(edge_docs(spark).filter("doc_id is not null")).collect()
    assert sorted(map(tuple, got)) == near_by_brute_force(docs)
    alone = [r for r in jaccard_join.near_documents(edge_docs(spark)).collect() if r.doc_id is None]
    assert len(alone) == 1 and alone[0].n_links == 0
    assert jaccard_join.near_documents(empty_docs(spark)).count() == 0


def test_near_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 5)
    words = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(30):
        own = list(words)
        own[i * 4] = f"changed{i}"
        docs.append((i, " ".join(own)))
    docs += [(100 + i, docs[3][1]) for i in range(5)]
    got = jaccard_join.near_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == near_by_brute_force(docs)


def planted(rnd, families, members, words=90):
    """Texts of some families: members differ from their family's text in a few words, families from each other in most."""
    docs = []
    for f in range(families):
        base = [f"f{f}w{rnd.randrange(400)}" for _ in range(words)]
        for _ in range(members):
            own = list(base)
            for _ in range(rnd.randrange(3)):
                own[rnd.randrange(words)] = f"x{rnd.randrange(10_000)}"
            docs.append((len(docs), " ".join(own)))
    return docs


def test_forest_reaches_the_target_recall(spark):
    docs = planted(random.Random(12), 40, 12)
    sets = [shingle_set(t) for _, t in docs]
    links = sum(r.n_links for r in jaccard_join.near_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    exact = sum(n for _, n, _, _ in near_by_brute_force(docs))
    assert exact > 1000 and links >= 0.99 * exact and len(sets) == len(docs)


def test_forest_recall_on_real_tables(spark):
    sf = SF.replace("0.001", "0.01")
    want = {i: n for i, n, _, _ in near_by_brute_force(documents(sf))}
    got = {r.doc_id: r.n_links for r in QUERIES["op9_jaccard_join"](spark, sf).collect()}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.95 * sum(want.values()) > 0


def test_forest_rows_grow_with_the_documents(spark, monkeypatch):
    """A family of near copies shares its prefixes: what is staged may not grow with the square of its size."""
    from orderloom.llm import blocks

    def rows(members):
        counts, staged = [], jaccard_join.stage

        def counted(df, label):
            counts.append((label, staged(df, label)))
            return counts[-1][1]

        with monkeypatch.context() as patch:
            for module in (jaccard_join, blocks):
                patch.setattr(module, "stage", counted)
            patch.setattr(jaccard_join, "BLOCK_DOCS", 16)
            jaccard_join.near_documents(spark.createDataFrame(planted(random.Random(13), 1, members), "doc_id long, text string")).count()
        return sum(c.count() for _, c in counts)

    small, large = rows(100), rows(500)
    assert large < 7 * small


def test_shortest_prefix_meets_the_target():
    d = jaccard_join.shortest_prefix(0.8, 0.995)
    assert 1 - (1 - 0.8**d) ** jaccard_join.TREES >= 0.995 > 1 - (1 - 0.8 ** (d + 1)) ** jaccard_join.TREES


@pytest.mark.parametrize("task_edges", [0, 40, 1 << 20])
def test_components(spark, monkeypatch, task_edges):
    """All by joins, the last turns in one task, and all in one task."""
    monkeypatch.setattr(components, "TASK_EDGES", task_edges)
    rng = np.random.default_rng(4)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(int(a), int(b)) for a, b in rng.integers(2000, 2400, (150, 2))]
    groups = Groups()
    for a, b in pairs:
        groups.join(a, b)
    got = connected_components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert sorted(map(tuple, got)) == sorted((n, groups.find(n)) for n in linked)
    assert connected_components(spark.createDataFrame([(5, 5)], "x long, y long"), "x", "y").count() == 0
