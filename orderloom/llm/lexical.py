"""Ranked lexical search: the best documents of each item, exact, with per-term blocks of similar documents.

Scores are sums over an item's terms of weight times impact, in whole numbers. The terms of the items are the
vocabulary; documents become sparse vectors over it, are ordered by a signature of their direction, so that like
stands by like, and are cut into shards of bounded size. In a shard every term's posting list is clustered: evenly
spaced postings of the list are centres, each posting goes to the centre its sketch agrees with most, and a block keeps,
for each coordinate that some item asks for together with the term, the largest impact of its documents. A block's
summary times an item's weights is an upper bound of the score of every document in it. Blocks are taken by falling bound; one
whose bound is below the item's k-th score so far is skipped, all others are scored in full. Any document with a score above 0 is in
a block of each of its terms, so nothing is lost.

A task keeps the best k of an item over all its shards, which raises its bounds as it goes on, and gives
back at most k rows an item. Items are worked through in chunks of about ``CHUNK_TERMS`` different terms, so
that what a task gets from the driver and a shard's matrix are bounded however many items there are; documents are read once a chunk.

Defined cases: a null text has no term. Documents without a term aren't counted. Rows that share a doc_id are separate documents, and
rows of items are separate items, equal ids or not. Equal scores rank by ascending doc_id, null last. An item without
terms, or without a document that scores, has no row. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderloom.sources.staging import discard, stage

CHUNK_TERMS = 1 << 13
SHARD_DOCS = 4096
SHARD_CELLS = 1 << 24
BLOCK_DOCS = 64
SKETCH = 32
SIGNATURE_BITS = 16
SLICE = 1 << 20
SEED = 17
#: ASCII letters in lower case, other ASCII characters but digits as spaces; bytes of other characters stay.
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_counts(text: bytes) -> tuple[int, Counter]:
    """Number of terms with repeats, and of each; a slice of a long text at a time."""
    flat, n, found, at = text.translate(FOLD), 0, Counter(), 0
    while at < len(flat):
        end = flat.find(b" ", at + SLICE)
        end = len(flat) if end < 0 else end
        terms = flat[at:end].split()
        n += len(terms)
        found.update(terms)
        at = end
    return n, found


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [term_counts(t)[1] for t in batch.column(1).to_pylist()]
        terms, counts = [list(c) for c in found], [list(c.values()) for c in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64()))], ["item", "terms", "counts"])


def _vectors(vocabulary: dict[bytes, int], id_type: pa.DataType):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, at, tf = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, found = term_counts(text.as_py())
                if n:
                    known = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                    ids.append(doc_id)
                    lengths.append(n)
                    at.append([a for a, _ in known])
                    tf.append([c for _, c in known])
            columns = [pa.array(ids, id_type), pa.array(lengths, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "at", "tf"])

    return read


@dataclass(frozen=True)
class Query:
    """An item over the vocabulary: its terms' places and weights (times their repeats)."""

    item: int
    at: np.ndarray
    weights: np.ndarray


@dataclass(frozen=True)
class Corpus:
    """Counts of all documents, and the weight of each term of the vocabulary."""

    documents: int
    terms: int
    weights: np.ndarray

    def impacts(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = 100 - 75 + (75 * n * self.documents) // self.terms
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Row sums over runs of the given sizes, none of them 0."""
    return np.add.reduceat(values, np.cumsum(sizes) - sizes, axis=0)


def _directions(terms: int, width: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(terms, width)).astype(np.float32)


def _signed(corpus: Corpus):
    """Adds ``signature``: the signs of a document's products with fixed random directions."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _directions(len(corpus.weights), SIGNATURE_BITS)
        for batch in batches:
            if not batch.num_rows:
                continue
            at, sizes = _flat(batch.column("at"))
            n = np.repeat(batch.column("n").to_numpy(), sizes)
            value = corpus.impacts(n, _flat(batch.column("tf"))[0]) * corpus.weights[at]
            signs = _sums(value.astype(np.float32)[:, None] * planes[at], sizes) > 0
            yield batch.append_column("signature", pa.array(signs @ (1 << np.arange(SIGNATURE_BITS, dtype=np.int64))))

    return add


@dataclass
class Best:
    """The best k (score, doc_id) of one item so far."""

    k: int
    rows: list[tuple[int, object]] = field(default_factory=list)

    @property
    def least(self) -> int:
        """A document needs at least this score."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def offer(self, scores: np.ndarray, ids: Sequence, rows: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good) > self.k:
            good = good[scores[good] >= np.partition(scores[good], -self.k)[-self.k]]
        found = self.rows + [(int(scores[g]), ids[rows[g]]) for g in good]
        self.rows = sorted(found, key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))[: self.k]


def asked_together(queries: Sequence[Query], terms: int) -> list[np.ndarray]:
    """Per term, the terms that some item asks for with it, in order."""
    found: list[list[np.ndarray]] = [[] for _ in range(terms)]
    for q in queries:
        for t in q.at:
            found[t].append(q.at)
    return [np.unique(np.concatenate(f)) if f else np.zeros(0, np.int64) for f in found]


class Shard:
    """Vectors of some documents, and the blocks of every term's posting list."""

    def __init__(self, ids: Sequence, at: np.ndarray, impacts: np.ndarray, sizes: np.ndarray, together: list[np.ndarray], block_docs: int = BLOCK_DOCS):
        self.ids, terms = ids, len(together)
        rows = np.repeat(np.arange(len(ids)), sizes)
        self.vectors = np.zeros((len(ids), terms), np.int32)
        self.vectors[rows, at] = impacts
        sketch = _sums(impacts.astype(np.float32)[:, None] * _directions(terms, SKETCH)[at], sizes)
        sketch /= np.linalg.norm(sketch, axis=1, keepdims=True) + 1e-30
        by_term = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[by_term], np.arange(terms + 1))
        self.blocks: list[list[np.ndarray]] = []
        self.maxima: list[np.ndarray] = []
        for t in range(terms):
            postings = rows[by_term[ends[t] : ends[t + 1]]]
            if not len(postings) or not len(together[t]):
                self.blocks.append([])
                self.maxima.append(np.zeros((0, len(together[t])), np.int32))
                continue
            centres = -(-len(postings) // block_docs)
            nearest = np.zeros(len(postings), np.int64)
            if centres > 1:
                spaced = postings[np.arange(centres) * len(postings) // centres]
                nearest = (sketch[postings] @ sketch[spaced].T).argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            postings, nearest = postings[order], nearest[order]
            starts = np.flatnonzero(np.r_[True, nearest[1:] != nearest[:-1]])
            self.blocks.append(np.split(postings, starts[1:]))
            self.maxima.append(np.maximum.reduceat(self.vectors[np.ix_(postings, together[t])], starts, axis=0))

    def scores(self, rows: np.ndarray, query: Query) -> np.ndarray:
        return self.vectors[np.ix_(rows, query.at)].astype(np.int64) @ query.weights

    def search(self, query: Query, places: list[np.ndarray], best: Best) -> int:
        """Offer ``best`` the documents of all blocks that may hold one; gives the number of blocks skipped.

        ``places`` has, per term of the query, where the query's terms are among the term's summary coordinates.
        """
        bounds = [self.maxima[t][:, p].astype(np.int64) @ query.weights for t, p in zip(query.at, places)]
        blocks = [b for t in query.at for b in self.blocks[t]]
        if not blocks:
            return 0
        bound = np.concatenate(bounds)
        order, seen, at, width = np.argsort(-bound, kind="stable"), np.zeros(len(self.ids), bool), 0, 4
        while at < len(order):
            chosen = order[at : at + width]
            chosen = chosen[bound[chosen] >= best.least]
            if not len(chosen):
                break
            rows = np.unique(np.concatenate([blocks[b] for b in chosen]))
            rows = rows[~seen[rows]]
            seen[rows] = True
            scores = self.scores(rows, query)
            best.offer(scores, self.ids, rows)
            at += len(chosen)
            width *= 2
        return len(order) - at


def _searcher(corpus: Corpus, queries: list[Query], k: int, id_type: pa.DataType, shard_docs: int, block_docs: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = len(corpus.weights)
        together = asked_together(queries, terms)
        places = [[np.searchsorted(together[t], q.at) for t in q.at] for q in queries]
        best = [Best(k) for _ in queries]
        docs = max(block_docs, min(shard_docs, SHARD_CELLS // max(1, terms)))
        held: list[pa.RecordBatch] = []

        def worked(table: pa.Table) -> None:
            batch = table.combine_chunks().to_batches()[0]
            at, sizes = _flat(batch.column("at"))
            impacts = corpus.impacts(np.repeat(batch.column("n").to_numpy(), sizes), _flat(batch.column("tf"))[0])
            shard = Shard(batch.column("doc_id").to_pylist(), at, impacts, sizes, together, block_docs)
            for q, p, b in zip(queries, places, best):
                shard.search(q, p, b)

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= docs:
                table = pa.Table.from_batches(held)
                worked(table.slice(0, docs))
                held = table.slice(docs).to_batches()
        if any(b.num_rows for b in held):
            worked(pa.Table.from_batches(held))
        found = [(q.item, i, s) for q, b in zip(queries, best) for s, i in b.rows]
        items, ids, scores = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return search


def _search_chunk(docs: DataFrame, items: list, k: int, shard_docs: int, block_docs: int) -> DataFrame:
    """Staged (item, doc_id, score): the best k of every task."""
    vocabulary = {t: j for j, t in enumerate(sorted({t for r in items for t in map(bytes, r["terms"])}))}
    spark_type = docs.schema["doc_id"].dataType
    id_type, columns = to_arrow_type(spark_type), f"doc_id {spark_type.simpleString()}, n long, at array<int>, tf array<long>"
    vectors = stage(docs.mapInArrow(_vectors(vocabulary, id_type), columns), "term-vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    df = {r["t"]: r["df"] for r in vectors.select(F.explode("at").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
    weights = np.array([term_weight(total["documents"], df.get(j, 0)) for j in range(len(vocabulary))], np.int64)
    corpus = Corpus(total["documents"], total["terms"] or 1, weights)
    queries = []
    for r in items:
        terms = sorted((vocabulary[bytes(t)], c) for t, c in zip(r["terms"], r["counts"]))
        at = np.array([t for t, _ in terms], np.int64)
        queries.append(Query(r["item"], at, weights[at] * np.array([c for _, c in terms], np.int64)))
    signed = vectors.filter(F.size("at") > 0).mapInArrow(_signed(corpus), f"{columns}, signature long")
    ordered = signed.repartitionByRange("signature", F.xxhash64("doc_id", "n")).sortWithinPartitions("signature")
    search = _searcher(corpus, queries, k, id_type, shard_docs, block_docs)
    found = stage(ordered.mapInArrow(search, f"item long, doc_id {spark_type.simpleString()}, score long"), "best-of-tasks")
    discard(vectors)
    return found


def search_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", shard_docs: int = SHARD_DOCS, block_docs: int = BLOCK_DOCS, chunk_terms: int = CHUNK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""

    def raw(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")

    docs = docs.select(F.col(id_col).alias("doc_id"), raw(text_col).alias("text"))
    named = stage(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), raw(item_text_col).alias("text")), "search-items")
    asked = stage(named.select("item", "text").mapInArrow(_item_terms, "item long, terms array<binary>, counts array<long>").filter(F.size("terms") > 0), "item-terms")
    chunks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // chunk_terms)
    found = []
    for c in range(chunks):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(chunks)) == c).collect()
        if rows:
            found.append(_search_chunk(docs, rows, k, shard_docs, block_docs))
    if not found:
        id_sql = docs.schema["doc_id"].dataType.simpleString()
        return named.limit(0).select("item_id", F.lit(None).cast("int").alias("rank"), F.lit(None).cast(id_sql).alias("doc_id"), F.lit(None).cast("long").alias("score"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(named.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
