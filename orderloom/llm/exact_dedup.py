"""Exact duplicates by content sort, in DataFrame operations only.

Rows are ordered by (first characters, SHA-256, whole text, id). Splitters
sampled from the data cut that order into ranges of about equal row counts;
since the id is part of the order, a text with very many copies spans several
ranges instead of one task. Each range is sorted externally and every row is
compared in full with the row before it. Runs inside a range are groups by that
comparison; a run at the edge of a range may go on in the next one, and such
runs are joined by their digest. Only digests and ids travel after the sort.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.tables import whole_text
from orderloom.sources.staging import stage

HEAD_CHARS = 24
SPLITTER_SCHEMA = "array<struct<head:string,sha:string,id:string>>"


def _splitters(keyed: DataFrame, rows: int, ranges: int, per_range: int) -> list[tuple[str, str, str]]:
    """At most ``ranges - 1`` keys, from a sample of about ``ranges * per_range`` keys."""
    if rows == 0 or ranges < 2:
        return []
    fraction = min(1.0, ranges * per_range / rows)
    sample = keyed.sample(fraction, seed=17).select("__head", "__sha", "__sid").orderBy("__head", "__sha", "__sid").collect()
    step = max(1.0, len(sample) / ranges)
    return [tuple(sample[int(i * step)]) for i in range(1, ranges) if int(i * step) < len(sample)]


def _range_of(splitters: list[tuple[str, str, str]]) -> Column:
    """Number of splitters at or below the row's key, by binary search."""
    if not splitters:
        return F.lit(0)
    text = json.dumps([{"head": a, "sha": b, "id": c} for a, b, c in splitters])
    found = F.from_json(F.lit(text), SPLITTER_SCHEMA)
    key = F.struct(F.col("__head").alias("head"), F.col("__sha").alias("sha"), F.col("__sid").alias("id"))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))

    def narrow(bounds: Column, _: Column) -> Column:
        middle = F.floor((bounds["lo"] + bounds["hi"]) / 2).cast("int")
        below = F.get(found, middle) <= key
        halved = F.struct(
            F.when(below, middle + 1).otherwise(bounds["lo"]).alias("lo"),
            F.when(below, bounds["hi"]).otherwise(middle).alias("hi"),
        )
        return F.when(bounds["lo"] < bounds["hi"], halved).otherwise(bounds)

    steps = math.ceil(math.log2(len(splitters) + 1)) + 1
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, narrow, lambda b: b["lo"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", per_range: int = 8) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which identifier stays, ``min`` or ``max``. A null text is the
    empty text; ids may be null (such a row stays if its whole group has no id).
    Rows repeated with the same id count as copies of each other and share the
    ``kept`` flag. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.col(id_col).alias("__id"), whole_text(text_col).alias("__text")).select(
        "__id",
        "__text",
        F.substring("__text", 1, HEAD_CHARS).alias("__head"),
        F.sha2(F.col("__text").cast("binary"), 256).alias("__sha"),
        F.coalesce(F.col("__id").cast("string"), F.lit("")).alias("__sid"),
    )
    splitters = _splitters(keyed, docs.count(), ranges, per_range)
    in_order = Window.partitionBy("__range").orderBy("__head", "__sha", "__text", "__sid")
    whole_range = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = keyed.withColumn("__range", _range_of(splitters)).select(
        "__id",
        "__sha",
        "__head",
        "__sid",
        "__range",
        (~F.lag("__text").over(in_order).eqNullSafe(F.col("__text"))).cast("long").alias("__starts"),
        ((F.col("__sha") == F.first("__sha").over(whole_range)) | (F.col("__sha") == F.last("__sha").over(whole_range))).alias("__edge"),
        F.row_number().over(in_order).alias("__at"),
    )
    runs = Window.partitionBy("__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grouped = compared.withColumn("__run", F.sum("__starts").over(runs)).select(
        "__id",
        "__sha",
        F.when(F.col("__edge"), F.col("__sha")).otherwise(F.concat_ws(":", "__range", "__run")).alias("__group"),
    )
    rows = stage(grouped, "content-sort")
    best = {"min": F.min, "max": F.max}[keep]
    groups = rows.groupBy("__group").agg(best("__id").alias("__keep"), F.count(F.lit(1)).alias("__n"))
    # Staged so that the join below shuffles both sides itself and can split a group with very many rows.
    several = stage(groups.filter("__n > 1"), "content-groups")
    return rows.join(several, "__group", "left").select(
        F.col("__id").alias(id_col),
        F.when(F.col("__n").isNull(), F.col("__id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__n", F.lit(1)).alias("group_size"),
        F.when(F.col("__n").isNull(), F.lit(True)).otherwise(F.col("__id").eqNullSafe(F.col("__keep"))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )
