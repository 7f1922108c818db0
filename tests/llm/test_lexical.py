"""Ranked lexical search against scores worked out document by document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import TEXTS, edge_docs, empty_docs

from orderloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def by_brute_force(docs, items, k=10):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms_of(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, item int, terms string")


def made_up(rows, seed=5):
    rng = np.random.default_rng(seed)
    words = [f"{'abcde'[j % 5]}w{j}é" for j in range(300)]
    odds = 1 / np.arange(1, 301)
    texts = [" ".join(rng.choice(words, rng.integers(1, 60), p=odds / odds.sum())) for _ in range(rows)]
    texts[10:60] = [texts[9]] * 50
    return list(enumerate(texts)), [(q, " ".join(rng.choice(words, rng.integers(1, 12)))) for q in range(25)]


@pytest.mark.parametrize("sizes", [{}, {"shard_docs": 40, "block_docs": 4}, {"shard_docs": 64, "block_docs": 1, "chunk_terms": 30}])
def test_search_matches_brute_force(spark, sizes):
    docs, items = made_up(400)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert got(lexical.search_documents(frame, items_frame(spark, items), **sizes)) == by_brute_force(docs, items)


def test_odd_rows(spark):
    items = [(1, "quick FOX"), (1, "quick FOX"), (2, None), (3, ""), (4, "no such wordatall"), (None, "word5x5 word7x7 row"), (5, "é x𝒳 ﬁ"), (6, "fox fox fox jumps")]
    found = lexical.search_documents(edge_docs(spark), items_frame(spark, items))
    assert got(found) == by_brute_force(TEXTS, items)
    assert got(lexical.search_documents(empty_docs(spark), items_frame(spark, items))) == []
    assert got(lexical.search_documents(edge_docs(spark), items_frame(spark, items).limit(0))) == []


def test_terms_fold_ascii_only_and_in_slices(monkeypatch):
    text = "ÀB-c_d\x00E9\x7ff{G}İ " + "Ab1 " * 50
    whole = lexical.term_counts(text.encode())
    monkeypatch.setattr(lexical, "SLICE", 7)
    assert lexical.term_counts(text.encode()) == whole
    assert whole[1] == Counter(t.encode() for t in terms_of(text)) and whole[0] == len(terms_of(text))


def test_bounds_hold_and_blocks_are_skipped():
    rng = np.random.default_rng(8)
    topics = [rng.choice(60, 8, replace=False) for _ in range(6)]
    rows = [np.unique(np.r_[rng.choice(topics[d % 6], 5), rng.integers(0, 60, 2)]) for d in range(600)]
    at, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    impacts = rng.integers(1, 1000, len(at))
    queries = [lexical.Query(q, np.unique(topics[q % 6][:5]), rng.integers(1, 50, 5)) for q in range(12)]
    together = lexical.asked_together(queries, 60)
    shard = lexical.Shard(list(range(600)), at, impacts, sizes, together, block_docs=8)
    for t, blocks in enumerate(shard.blocks):
        assert sorted(np.concatenate(blocks).tolist() if blocks else []) == (np.flatnonzero(shard.vectors[:, t]).tolist() if len(together[t]) else [])
        for block, top in zip(blocks, shard.maxima[t]):
            assert (shard.vectors[np.ix_(block, together[t])].max(axis=0) == top).all()
    skipped = 0
    for q in queries:
        best = lexical.Best(10)
        skipped += shard.search(q, [np.searchsorted(together[t], q.at) for t in q.at], best)
        scores = shard.scores(np.arange(600), q)
        assert best.rows == sorted(((int(s), i) for i, s in enumerate(scores) if s > 0), key=lambda r: (-r[0], r[1]))[:10]
    assert skipped > 0
