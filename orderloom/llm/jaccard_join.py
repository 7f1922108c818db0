"""N-gram Jaccard self-join by a MinHash LSH forest and exact verification.

Every document has a signature of ``TREES`` labels of ``DEPTH`` minima each. A
tree's labels in sorted order are a prefix trie, and the documents that share a
prefix are a subtrie. Whole labels are matched first: in each subtrie every class of
documents is held against one representative, and those whose signatures agree enough
become one class. The prefix is then shortened, in two steps, but only for subtries that
still hold several classes under the shortest prefix; whatever stands in a subtrie of one class is
resolved. The shortest prefix is the one that a pair at the threshold shares in some tree with
the target recall; what is still mixed there is compared in full. The classes are candidate groups, and inside a
group all shingle sets are compared exactly, block by block: tasks give back
counts and a spanning forest, never the pairs. Copies of a text take part once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.blocks import bloom, classed, groups, linked_members, mixed_keys, parts_of, passes, star_forest, star_pairs
from orderloom.llm.components import connected_components
from orderloom.llm.tables import whole_text
from orderloom.sources.staging import stage

WORDS, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.995
TREES, DEPTH = 16, 8
BLOCK_DOCS = 256
EXACT_DOCS = 512  # documents of a block whose shingle sets are compared
SLICE = 1 << 18  # shingles hashed at a time
COLUMNS = 4096  # shingles compared at a time
SPARK_SEED = 42
ODD_A, ODD_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shortest_prefix(threshold: float, target: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix that a pair at the threshold shares in some tree with the target recall."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= target:
            return d
    return 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * ODD_B
    return h ^ (h >> np.uint64(32))


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row, and how many each has.

    Words are what white space separates, in lower case. A text of fewer words has one shingle, one without words none.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(texts)))
    coded = lists.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w.encode()) for w in coded.dictionary.to_pylist()], np.uint64)
    counts = np.diff(lists.offsets.to_numpy())
    counts[pc.equal(pc.binary_length(pc.utf8_trim_whitespace(texts)), 0).to_numpy(zero_copy_only=False)] = 0
    word = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(hashes) else np.zeros(0, np.uint64)
    starts = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
    rolled = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for k in range(words):
        rolled = rolled * ODD_A + word[k : k + len(rolled)]
    out, sizes = [], np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    for start, n, size in zip(starts.tolist(), counts.tolist(), sizes.tolist()):
        if n >= words:
            out.append(rolled[start : start + size])
        elif n:
            one = np.uint64(n)
            for w in word[start : start + n]:
                one = np.uint64((int(one) * int(ODD_A) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(np.array([one]))
    return _mixed(np.concatenate([np.zeros(0, np.uint64), *out])), sizes


def signatures(hashes: np.ndarray, sizes: np.ndarray, functions: int = TREES * DEPTH) -> np.ndarray:
    """Minima of all texts that have shingles, a row each."""
    rng = np.random.default_rng(2024)
    odd = rng.integers(0, 1 << 31, functions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    flip = rng.integers(0, 1 << 32, functions, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(sizes)
    out = np.empty((len(sizes), functions), np.uint32)
    at = 0
    while at < len(sizes):
        before = int(ends[at - 1]) if at else 0
        upto = max(int(np.searchsorted(ends, before + SLICE, "right")), at + 1)
        own, starts = short[before : int(ends[upto - 1])], (ends[at:upto] - sizes[at:upto] - before).astype(np.int64)
        for k in range(functions):
            mixed = (own ^ flip[k]) * odd[k]
            mixed ^= mixed >> np.uint32(15)
            out[at:upto, k] = np.minimum.reduceat(mixed, starts)
        at = upto
    return out


def text_id(text: str) -> int:
    """The same number as xxhash64 in Spark."""
    value = xxhash.xxh64_intdigest(text.encode(), SPARK_SEED)
    return value - (1 << 64) if value >= 1 << 63 else value


def _sign(words: int):
    """(node, signature) of every text with words, each text once a batch; of a minimum, 16 bits are kept."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.unique(batch.column(0))
            hashes, sizes = shingles(texts, words)
            some = np.flatnonzero(sizes)
            short = (signatures(hashes, sizes[some]) & np.uint32(0xFFFF)).astype("<u2")
            nodes = [text_id(t.as_py()) for t in texts.take(pa.array(some))]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([s.tobytes() for s in short], pa.binary())], names=["node", "signature"])

    return sign


def labels(signed: DataFrame) -> DataFrame:
    """(node, class, tree, label): one row per tree."""
    rows = signed.select("node", "class", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    label = F.substring("signature", F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * DEPTH))
    return rows.select("node", "class", "tree", label.alias("label"))


def at_depth(rows: DataFrame, depth: int) -> DataFrame:
    """``rows`` with ``key``: their subtrie under prefixes of ``depth`` minima."""
    return rows.withColumn("key", F.xxhash64("tree", F.substring("label", F.lit(1), F.lit(2 * depth))))


def _agree(least: float):
    """The pairs (x, y) whose signatures agree in a share of at least ``least``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(n).to_pylist()), "<u2").reshape(batch.num_rows, -1) for n in ("sx", "sy"))
            near = np.flatnonzero((a == b).mean(axis=1) >= least) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(n).take(pa.array(near)) for n in ("x", "y")], names=["x", "y"])

    return keep


def _linked_classes(rows: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """Staged links (x, y) between the classes of each subtrie and its representative, where signatures agree."""
    of = signed.select("node", "signature")
    pairs = star_pairs(rows).join(of.withColumnsRenamed({"node": "x", "signature": "sx"}), "x")
    pairs = pairs.join(of.withColumnsRenamed({"node": "y", "signature": "sy"}), "y")
    return stage(pairs.select("x", "y", "sx", "sy").mapInArrow(_agree(least), "x long, y long"), "forest-links")


def forest_classes(signed: DataFrame, shortest: int, least: float) -> DataFrame:
    """(node, component) of documents that share a prefix of at least ``shortest`` minima, and whose
    signatures agree, with another; ``signed`` (node, signature) is staged."""

    def mixed(rows: DataFrame, depth: int) -> DataFrame:
        rows = at_depth(rows, depth)
        return stage(rows.join(mixed_keys(rows), "key", "left_semi"), "forest-mixed")

    whole = mixed(labels(classed(signed, None)), DEPTH)
    links = _linked_classes(whole, signed, least)
    classes = stage(connected_components(links, "x", "y"), "forest-classes")
    # From here on only subtries count that are mixed under the shortest prefix.
    left = mixed(labels(classed(signed, classes)), shortest)
    for depth in range(min(DEPTH - 1, shortest + 1), shortest - 1, -1):
        here = mixed(left, depth)
        if here.isEmpty():
            continue
        links = links.unionByName(_linked_classes(here, signed, least))
        classes = stage(connected_components(links, "x", "y"), "forest-classes")
        left = mixed(classed(left, classes), shortest)
    if left.isEmpty():
        return classes
    values = signed.select("node", F.col("signature").alias("value"))
    return linked_members(left.select("key", "node", "class"), links, values, BLOCK_DOCS, _agreeing(least))


def _agreeing(least: float):
    """Star forests of documents whose signatures agree in a share of at least ``least``, per (key, a, b)."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for _, rows in groups(batches, 3):
                nodes = np.array([r[0] for r in rows], np.int64)
                # Sorted labels put the longest common prefixes side by side: the trie's order.
                signs = np.frombuffer(b"".join(r[2] for r in rows), "<u2").reshape(len(rows), -1)
                order = np.lexsort(signs[:, DEPTH - 1 :: -1].T)
                nodes, signs = nodes[order], signs[order]
                root = np.unique(np.array([r[1] for r in rows], np.int64), return_inverse=True)[1][order]
                # Neighbours in the trie first, the longest prefixes; what they join needn't be matched again.
                near = np.flatnonzero((root[1:] != root[:-1]) & ((signs[1:] == signs[:-1]).mean(1) >= least))
                for i in near:
                    root[root == root[i + 1]] = root[i]
                x, y = [near], [near + 1]
                for i in range(len(nodes) - 1):
                    rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
                    if len(rest):
                        match = rest[(signs[rest] == signs[i]).mean(1) >= least]
                        x.append(np.full(len(match), i))
                        y.append(match)
                x, y = np.concatenate(x), np.concatenate(y)
                if len(x):
                    yield star_forest(nodes[x], nodes[y])

        for part in parts_of(found(), 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], names=["x", "y"])

    return links


def _sets(bits: bytes, words: int):
    """(node, distinct shingles) of texts that the filter lets through, each once a batch."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.unique(batch.column(0))
            nodes = np.array([text_id(t) for t in texts.to_pylist()], np.int64)
            chosen = np.flatnonzero(passes(bits, nodes)) if len(nodes) else np.zeros(0, np.int64)
            hashes, sizes = shingles(texts.take(pa.array(chosen)), words)
            ends = np.cumsum(sizes)
            sets = [np.unique(hashes[e - s : e]).astype("<u8").tobytes() for s, e in zip(sizes, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[chosen], pa.int64()), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return pick


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, a matrix. Only shingles of two sets or more are compared, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1
    place = np.cumsum(several) - 1
    live = several[column]
    owner, column = owner[live], place[column[live]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(several.sum()), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return total


def _exact(threshold: float):
    """Per (group, a, b): links as a star forest (x, y, 0), and per document its number of links (x, x, n)."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for (_, a, b), rows in groups(batches, 3):
                nodes, copies = np.array([r[0] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
                sets = [np.frombuffer(r[1], "<u8") for r in rows]
                block = np.array([r[3] for r in rows])
                sizes = np.array([len(s) for s in sets], np.float64)
                both = shared_counts(sets).astype(np.float64)
                # both / union >= threshold, without dividing
                linked = both * (1 + threshold) >= threshold * (sizes[:, None] + sizes[None, :]) - 1e-9
                np.fill_diagonal(linked, False)
                if a != b:  # pairs inside a block are counted where it meets itself
                    linked &= block[:, None] != block[None, :]
                i, j = np.nonzero(np.triu(linked))
                if len(i):
                    x, y = star_forest(nodes[i], nodes[j])
                    yield x, y, np.zeros(len(x), np.int64)
                    n = linked @ copies
                    yield nodes[n > 0], nodes[n > 0], n[n > 0]

        for part in parts_of(found(), 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], names=["x", "y", "links"])

    return links


def near_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    target_recall: float = TARGET_RECALL,
    with_group: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, n_links, component_id, kept.

    ``n_links`` counts the other rows whose set of word shingles has a Jaccard
    similarity of at least ``threshold``, copies included; ``component_id`` is the
    least id reachable by links, and the row with that id is kept. Texts without
    words (null, empty, white space) link with nothing. Rows that repeat an id
    are documents of their own and may both be kept; a null id is never kept in a
    group that has ids. Other columns are ignored; an empty table gives no rows.
    ``with_group`` adds ``text_hash`` and ``text_group``, the same for all texts that
    are reachable by links whatever their ids, and null for texts without words.
    """
    text = whole_text(text_col)
    texts = docs.select(text.alias("__text"))
    prefix = shortest_prefix(threshold, target_recall)
    least = threshold - 3.5 * math.sqrt(threshold * (1 - threshold) / (TREES * DEPTH))
    rows = stage(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("node")), "rows")
    copies = stage(rows.groupBy("node").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "copies")
    signed = stage(texts.mapInArrow(_sign(words), "node long, signature binary").dropDuplicates(["node"]), "signatures")
    candidates = stage(forest_classes(signed, prefix, least), "candidates")

    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("members") / EXACT_DOCS)
    placed = candidates.join(sizes, "component").select(
        "component", "node", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).alias("block")
    )
    placed = placed.join(copies.select("node", "copies"), "node")
    sets = texts.mapInArrow(_sets(bloom(candidates, "node"), words), "node long, shingles binary").dropDuplicates(["node"])
    paired = placed.join(stage(sets, "shingles"), "node").select(
        "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "block", "node", "shingles", "copies"
    )
    paired = paired.select("component", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "node", "shingles", "copies", "block")
    exact = paired.repartition("component", "a", "b").sortWithinPartitions("component", "a", "b")
    links = stage(exact.mapInArrow(_exact(threshold), "x long, y long, links long"), "links")

    counts = links.filter("links > 0").groupBy(F.col("x").alias("node")).agg(F.sum("links").alias("links"))
    parts = stage(connected_components(links.filter("links = 0"), "x", "y"), "parts")
    named = stage(parts.join(copies, "node").groupBy("component").agg(F.min("rep").alias("name")), "names")
    described = copies.join(counts, "node", "left").join(parts.join(named, "component").select("node", "name", "component"), "node", "left")
    wordy = signed.select("node", F.lit(True).alias("wordy"))
    described = stage(described.join(wordy, "node", "left"), "described")
    joined = rows.join(described, "node")
    component = F.when(F.col("wordy"), F.coalesce("name", "rep")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("wordy"), F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        *((F.col("node").alias("text_hash"), F.when(F.col("wordy"), F.coalesce("component", "node")).alias("text_group")) if with_group else ()),
    )
