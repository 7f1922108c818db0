"""Near-duplicate lines by a segment-partition edit join.

A line is cut into threshold + 1 segments. If two lines are within the threshold,
some segment of the shorter one stands unchanged in the longer one, at a place
that can't have moved far. So every line puts its segments into an index keyed
by (line length, segment number, segment), and probes it with the substrings of
its own that could be such a segment, for each length it can match. Only hashes
travel at first; the texts of the few lines whose keys meet follow, chosen by a
Bloom filter, and pairs are decided by a banded bit-parallel edit distance.
Groups of any size are compared block by block, and a block gives back a
spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.blocks import bloom, classed, groups, linked_members, mixed_keys, parts_of, passes, star_pairs
from orderloom.llm.components import connected_components
from orderloom.llm.tables import free_names, whole_text
from orderloom.sources.staging import discard, stage

THRESHOLD = 2
MIN_CHARS = 20
CHARS_PER_EDIT = 20
BLOCK_LINES = 256
SPARK_SEED = 42
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())  # what str.strip takes off


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def line_id(line: str) -> int:
    """The same number as xxhash64 in Spark."""
    return _signed(xxhash.xxh64_intdigest(line.encode(), SPARK_SEED))


def allowed(length: int, threshold: int) -> int:
    """Edits allowed for a line: short lines bear fewer."""
    return min(threshold, length // CHARS_PER_EDIT)


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of nearly equal parts, longer ones last."""
    size, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        own = size + (i >= parts - longer)
        out.append((at, own))
        at += own
    return out


def _layout(n: int, threshold: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """For lines of ``n`` code points: (seed, start, end) of index segments and of probing substrings."""

    def seed(length: int, edits: int, i: int) -> int:
        return (length << 16) + (edits << 8) + i

    own = allowed(n, threshold)
    index = [(seed(n, own, i), s, s + z) for i, (s, z) in enumerate(segments(n, own + 1))]
    probe = []
    # A pair may use as many edits as its shorter line bears, and that one is in the index.
    for length in range(max(1, n - own), n + 1):
        edits, shift = allowed(length, threshold), n - length
        if shift > edits:
            continue
        for i, (start, size) in enumerate(segments(length, edits + 1)):
            # Edits before and after the segment bound how far it can have moved, from either end.
            low = max(0, start - i, start + shift - (edits - i))
            high = min(n - size, start + i, start + shift + (edits - i))
            probe += [(seed(length, edits, i), p, p + size) for p in range(low, high + 1)]
    return index, probe


def index_and_probe_keys(line: str, threshold: int, layouts: dict | None = None) -> tuple[list[int], list[int]]:
    """Hashes of segments and substrings, seeded with (length, allowed edits, segment number)."""
    digest, n = xxhash.xxh3_64_intdigest, len(line)
    layouts = {} if layouts is None else layouts
    index, probe = layouts.get(n) or layouts.setdefault(n, _layout(n, threshold))
    if line.isascii():  # the same bytes as below, encoded once
        raw = line.encode()
        return [digest(raw[a:b], k) for k, a, b in index], [digest(raw[a:b], k) for k, a, b in probe]
    return [digest(line[a:b].encode(), k) for k, a, b in index], [digest(line[a:b].encode(), k) for k, a, b in probe]


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance is at most ``limit``: bit-parallel columns of a band of 2 * limit + 1 cells."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return False
    head = 0
    while head < len(a) and a[head] == b[head]:
        head += 1
    a, b = a[head:], b[head:]
    tail = 0
    while tail < len(a) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a:
        return len(b) <= limit
    # Bit k of a state stands for the diagonal k - limit; states[e] holds the diagonals that e edits reach.
    # Each character of the band is compared at once: bit k of ``same`` says a[i] == b[i + k - limit].
    width = 2 * limit + 1
    mask = (1 << width) - 1
    places: dict[str, int] = {}
    for j, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << (j + limit)
    states = [((1 << (2 * e + 1)) - 1) << (limit - e) & mask & ~((1 << limit) - 1) for e in range(limit + 1)]
    for i, c in enumerate(a):
        same = places.get(c, 0) >> i & mask
        before = states
        states = []
        for e in range(limit + 1):
            now = before[e] & same
            if e:
                # substitution stays on its diagonal, deletion of a[i] goes one down, insertion one up
                now |= before[e - 1] | before[e - 1] >> 1 | (states[e - 1] << 1 & mask)
            states.append(now)
        if not states[limit]:
            return False
    return bool(states[limit] >> (len(b) - len(a) + limit) & 1)


def _entries(threshold: int, min_chars: int):
    """(key, line, role) of all lines, each line once a batch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts: dict = {}
        for batch in batches:
            lines = {line for text in batch.column(0).to_pylist() for line in map(str.strip, text.split("\n")) if len(line) >= min_chars}
            keys, ids, counts = [], [], []
            for line in lines:
                index, probe = index_and_probe_keys(line, threshold, layouts)
                keys += index
                keys += probe
                ids.append(line_id(line))
                counts += len(index), len(probe)
                if len(keys) > 1 << 18:
                    yield _entry_batch(keys, ids, counts)
                    keys, ids, counts = [], [], []
            yield _entry_batch(keys, ids, counts)

    return emit


def _entry_batch(keys: list[int], ids: list[int], counts: list[int]) -> pa.RecordBatch:
    """``counts`` has the numbers of index and probe keys of each line in turn."""
    each = np.array(counts, np.int64)
    key, line = np.array(keys, np.uint64).view(np.int64), np.repeat(np.array(ids, np.int64), each.reshape(-1, 2).sum(axis=1))
    role = np.repeat(np.arange(len(each)) % 2, each).astype(np.int8)
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(line), pa.array(role)], names=["key", "line", "role"])


def _with_key_in(bits: bytes):
    """(key, line) of the entries whose key the filter lets through."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = pa.array(np.flatnonzero(passes(bits, batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(some) for i in (0, 1)], names=["key", "node"])

    return keep


def _texts(bits: bytes, min_chars: int):
    """(line, text) of lines that the filter lets through, each once a batch."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [line for line in {x for text in batch.column(0).to_pylist() for x in map(str.strip, text.split("\n"))} if len(line) >= min_chars]
            ids = np.array([line_id(line) for line in lines], np.int64)
            chosen = np.flatnonzero(passes(bits, ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids[chosen]), pa.array([lines[i] for i in chosen], pa.string())], names=["line", "text"])

    return pick


def _verify(threshold: int):
    """Star forests of the links in runs of rows (sorted) with the same (key, a, b)."""

    def links(rows: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
        first: dict[int, int] = {}
        root = [first.setdefault(r[1], i) for i, r in enumerate(rows)]

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        out = []
        for i in range(len(rows)):
            for j in range(i):
                x, y = find(i), find(j)
                if x != y and within(rows[i][2], rows[j][2], allowed(min(len(rows[i][2]), len(rows[j][2])), threshold)):
                    root[max(x, y)] = min(x, y)
                    out.append((rows[i][0], rows[j][0]))
        return out

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (tuple(np.array(c, np.int64) for c in zip(*out)) for _, rows in groups(batches, 3) if (out := links(rows)))
        for part in parts_of(found, 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in part], names=["x", "y"])

    return check


def _near(threshold: int):
    """The pairs (x, y) of lines that are within the threshold of each other."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = zip(batch.column("vx").to_pylist(), batch.column("vy").to_pylist())
            near = pa.array([i for i, (a, b) in enumerate(lines) if within(a, b, allowed(min(len(a), len(b)), threshold))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(n).take(near) for n in ("x", "y")], names=["x", "y"])

    return keep


def line_links(docs: DataFrame, text_col: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """(line, class) of line ids that have a near-duplicate with another id.

    Lines that share a key are held against one representative of the key first, which joins most; only keys that still
    hold several classes are compared in full.
    """
    texts = docs.select(whole_text(text_col).alias("__text"))
    entries = stage(texts.mapInArrow(_entries(threshold, min_chars), "key long, line long, role byte"), "lines-entries")
    keys = entries.groupBy("key").agg(*(how(c).alias(f"{how.__name__}_{c}") for c in ("line", "role") for how in (F.min, F.max)))
    # A key counts if two lines have it, one in the index and one probing.
    keys = stage(keys.filter("min_line <> max_line and min_role <> max_role").select("key"), "lines-keys")
    met = entries.mapInArrow(_with_key_in(bloom(keys, "key")), "key long, node long").distinct().join(keys, "key")
    met = stage(classed(met, None), "lines-met")
    discard(entries)
    fetched = texts.mapInArrow(_texts(bloom(met, "node"), min_chars), "line long, text string")
    known = stage(fetched.distinct(), "line-texts").select(F.col("line").alias("node"), F.col("text").alias("value"))
    pairs = star_pairs(met).join(known.withColumnsRenamed({"node": "x", "value": "vx"}), "x")
    pairs = pairs.join(known.withColumnsRenamed({"node": "y", "value": "vy"}), "y").select("x", "y", "vx", "vy")
    links = stage(pairs.mapInArrow(_near(threshold), "x long, y long"), "line-pairs")
    rows = classed(met, stage(connected_components(links, "x", "y"), "line-classes"))
    left = stage(rows.join(mixed_keys(rows), "key", "left_semi"), "lines-mixed")
    found = linked_members(left, links, known, BLOCK_LINES, _verify(threshold))
    return found.select(F.col("node").alias("line"), F.col("component").alias("class"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_lines, removed (sorted line numbers from 0).

    Lines of at least ``min_chars`` code points, without white space at their ends, form classes:
    equal lines, and lines linked by an edit distance of at most ``threshold`` (one edit less for
    each 20 code points that the shorter line lacks). Of each class the occurrence with the least
    (id, text hash, line number) stays and the others are removed. Shorter lines always stay.
    Null and empty texts have one empty line. Rows repeated with the same id and text are one
    document and share its decisions. A null id comes first in order; other columns are ignored;
    an empty table gives no rows.
    """
    text = whole_text(text_col)
    keyed = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__hash"), text.alias("__text"))
    lines = keyed.select("__id", "__hash", F.posexplode(F.split("__text", "\n")).alias("no", "raw")).withColumn("raw", _stripped(F.col("raw")))
    long_lines = lines.filter(F.length("raw") >= min_chars).select("__id", "__hash", "no", F.xxhash64("raw").alias("line"), F.crc32(F.col("raw").cast("binary")).alias("check"))
    seen = stage(long_lines, "lines")
    classes = line_links(docs, text_col, threshold, min_chars)
    named = seen.join(stage(classes, "line-classes"), "line", "left").select(
        "__id", "__hash", "no", F.coalesce("class", "line").alias("class"), F.when(F.col("class").isNull(), F.col("check")).otherwise(F.lit(0)).alias("check")
    )
    named = stage(named, "lines-named")
    first = named.groupBy("class", "check").agg(F.min(F.struct("__id", "__hash", "no")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = stage(first.filter("n > 1").drop("n"), "lines-first")
    extra = named.join(first, ["class", "check"]).filter(~F.struct("__id", "__hash", "no").eqNullSafe(F.col("first")))
    removed = extra.groupBy("__id", "__hash").agg(F.sort_array(F.collect_set("no")).alias("removed"))
    n_lines = keyed.select("__id", "__hash", F.size(F.split("__text", "\n")).alias("n_lines"))
    removed = stage(removed.withColumnsRenamed({"__id": "__rid", "__hash": "__rhash"}), "lines-removed")
    same = F.col("__id").eqNullSafe(F.col("__rid")) & (F.col("__hash") == F.col("__rhash"))
    return n_lines.join(removed, same, "left").select(
        F.col("__id").alias(id_col), F.col("__hash").alias("text_hash"), "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed")
    )


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with removed lines taken out of the text; a document that loses its whole text goes.

    Null and empty texts stay. Rows repeated with the same id and text are one document and stay or go together.
    Other columns stay as they are, whatever their names; an empty table stays empty.
    """
    rid, rhash, rlines, cut_lines = free_names(docs, "__rid", "__rhash", "__lines", "__removed")
    found = repeated_lines(docs, id_col, text_col, **options).filter(F.size("removed") > 0).distinct()
    found = found.select(F.col(id_col).alias(rid), F.col("text_hash").alias(rhash), F.col("n_lines").alias(rlines), F.col("removed").alias(cut_lines))
    found = stage(found, "lines-cut")
    same = docs[id_col].eqNullSafe(found[rid]) & (F.xxhash64(whole_text(text_col)) == found[rhash])
    lines = F.split(F.col(text_col), "\n")
    rest = F.array_except(F.sequence(F.lit(0), F.col(rlines) - 1), F.col(cut_lines))
    cut = F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n")
    joined = docs.join(found, same, "left").withColumn(text_col, F.when(F.col(cut_lines).isNull(), F.col(text_col)).otherwise(cut))
    return joined.filter(F.col(cut_lines).isNull() | (F.trim(F.col(text_col)) != "")).select(*docs.columns)
