"""Groups of any size dealt into blocks, streams of sorted rows, and Bloom filters over ids."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.components import connected_components
from orderloom.sources.staging import stage

FILTER_BITS = 1 << 26


def classed(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``rows`` with ``class``: the component of their node, or the node itself."""
    rows = rows.drop("class")
    if classes is None:
        return rows.withColumn("class", F.col("node"))
    return rows.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")


def mixed_keys(rows: DataFrame) -> DataFrame:
    """The keys whose rows (key, class) are of more than one class."""
    return rows.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("key")


def star_pairs(rows: DataFrame) -> DataFrame:
    """(x, y): per key, one member of each class next to the key's least one; linear in the rows of any key.

    ``rows`` (key, node, class) are staged, and of mixed keys only.
    """
    members = rows.groupBy("key", "class").agg(F.min("node").alias("y"))
    first = rows.groupBy("key").agg(F.min("node").alias("x"))
    return members.join(first, "key").filter("x <> y").select("x", "y").distinct()


def linked_members(rows: DataFrame, links: DataFrame, values: DataFrame, block_rows: int, compare: Callable) -> DataFrame:
    """(node, component) of ``links`` and of all links that ``compare`` finds between members of one key.

    ``rows`` (key, node, class) are staged, ``class`` being the components of ``links``; ``values`` has (node, value). ``compare``
    reads runs of rows (key, a, b, node, class, value) and gives the links (x, y) of a run; rows of one class are
    joined already. No key's rows go to one task: a key of more than ``block_rows`` members is read in
    order of its values, of their ends and of a hash first, in overlapping runs that any range of the order may hold. What
    that joins is one class, and all pairs of different classes then meet, a pair of blocks at a time.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    sizes = stage(sizes, "key-sizes")
    place, run = ["key", "a", "b"], ["key", "a", "b", "node", "class", "value"]

    def compared(of: DataFrame, name: str) -> DataFrame:
        return stage(of.select(*run).mapInArrow(compare, "x long, y long"), name)

    few = rows.join(sizes.filter(F.col("members") <= block_rows).select("key"), "key", "left_semi").join(values, "node")
    few = few.withColumns({"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long")})
    links = links.unionByName(compared(few.repartition(*place).sortWithinPartitions(*place), "links"))
    large = sizes.filter(F.col("members") > block_rows)
    if large.isEmpty():
        return connected_components(links, "x", "y")

    many = stage(rows.join(large, "key").join(values, "node"), "large-keys")
    for order in (F.col("value"), F.reverse(F.hex("value")), F.xxhash64("node")):
        ordered = many.withColumn("order", order)
        ordered = ordered.repartitionByRange("key", "order", "node").sortWithinPartitions("key", "order", "node")
        # The last row of a run is the first of the next one.
        at, step = F.col("at"), block_rows - 1
        runs = F.floor(at / step)
        ordered = ordered.withColumn("at", F.monotonically_increasing_id()).withColumn(
            "a", F.explode(F.when(F.pmod(at, F.lit(step)) == 0, F.array(runs - 1, runs)).otherwise(F.array(runs)))
        )
        links = links.unionByName(compared(ordered.withColumn("b", F.col("a")), "links-in-order"))
    joined = stage(connected_components(links, "x", "y"), "joined")

    classes = stage(classed(many, joined), "classes")
    largest = classes.groupBy("key", "class", "members").agg(F.count(F.lit(1)).alias("n")).groupBy("key", "members")
    largest = largest.agg(F.max(F.struct("n", "class")).alias("main")).filter(F.col("members") > F.col("main.n"))
    main = F.col("class") == F.col("main.class")
    others, mains = F.ceil((F.col("members") - F.col("main.n")) / block_rows), F.ceil(F.col("main.n") / block_rows)
    hashed = F.xxhash64("node")
    dealt = classes.join(stage(largest, "classes-largest"), ["key", "members"]).select(
        "key",
        "node",
        "class",
        "value",
        F.when(main, others + F.pmod(hashed, mains)).otherwise(F.pmod(hashed, others)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.when(main, others - 1).otherwise(others + mains - 1))).alias("other"),
    )
    dealt = dealt.select("key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "node", "class", "value")
    rest = compared(dealt.repartition(*place).sortWithinPartitions(*place), "links-across")
    known = joined.select(F.col("node").alias("x"), F.col("component").alias("y"))
    return connected_components(known.unionByName(rest), "x", "y")


def parts_of(parts: Iterable[tuple[np.ndarray, ...]], rows: int) -> Iterator[list[np.ndarray]]:
    """Column tuples joined until they have about ``rows`` rows."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= rows:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Of sorted rows: (first ``keys`` columns, the other columns' rows) for each run of equal keys."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != at:
                if held:
                    yield at, held
                at, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield at, held


def bloom(ids: DataFrame, column: str, most_bits: int = FILTER_BITS) -> bytes:
    """One bit per id (a long); the bitmap never has more than ``most_bits`` bits.

    Beyond that bound it lets more rows through, and none is lost: what passes is joined exactly.
    """
    ids = ids.select(F.col(column).alias("id")).distinct()
    size, wanted = 1 << 10, 16 * ids.count()
    while size < min(wanted, most_bits):
        size *= 2
    at = F.pmod("id", F.lit(size))
    bit = F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))
    found = ids.select(F.shiftright(at, 3).alias("byte"), bit.alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bits"))
    out = bytearray(size // 8)
    for byte, value in found.toLocalIterator():
        out[byte] = value
    return bytes(out)


def passes(bits: bytes, ids: np.ndarray) -> np.ndarray:
    at = (ids.astype(np.int64) % (len(bits) * 8)).astype(np.int64)
    return (np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the components of the given links."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        np.minimum.at(least, y, label[x])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]
