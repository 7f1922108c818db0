"""Keyed upsert without a table format that knows MERGE.

A matched row takes every value from the source, so the result is the target rows
whose key the source lacks, plus the source. A small delivery is therefore broadcast
by Spark as a set of keys and the target streams past it unshuffled; a large one
becomes a sort-merge anti join. Rows whose key contains NULL match nothing; they
skip the joins, so any number of them never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.functions.scalar import any_null, stamp

ORDERS_KEY = ["order_id"]
ORDER_ITEMS_KEY = ["order_id", "order_item_id"]
CUSTOMERS_KEY = ["customer_id"]


def _single_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """Stop the run when a key occurs twice. Checks inside the plan, so no extra job."""
    order_in_key = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    repeated = F.raise_error(F.concat(F.lit("duplicate source key: "), F.to_json(F.struct(*keys))))
    return (
        source.withColumn("_rn", order_in_key)
        .filter(F.when(F.col("_rn") > 1, repeated.cast("boolean")).otherwise(F.lit(True)))
        .drop("_rn")
    )


def _newest(keyed: DataFrame, keys: list[str], order_by: Sequence[str]) -> DataFrame:
    """An aggregate, not a window: a key with very many copies shrinks before the shuffle."""
    values = [c for c in keyed.columns if c not in keys and c not in order_by]
    ranked = F.struct(*order_by, *values)
    return keyed.groupBy(*keys).agg(F.max(ranked).alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in values])


def latest_per_key(source: DataFrame, keys: list[str], order_by: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """The newest row of each key; equal times are decided by the other columns.

    Rows whose key contains NULL are no copies of each other: all of them stay. The
    columns in ``order_by`` are left out of the result.
    """
    newest = _newest(source.filter(~any_null(keys)), keys, order_by)
    return newest.unionByName(source.filter(any_null(keys)).select(*newest.columns))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    touch_matched: bool = True,
    run_ts: datetime | None = None,
    on_duplicate: str = "error",
    order_col: str = "ingested_at",
) -> DataFrame:
    """The target after merging ``source`` into it by ``keys``; the target holds a key once.

    Matched rows take every source value, NULLs included; unmatched source rows
    are inserted; target-only rows stay. ``updated_at`` becomes ``run_ts`` on
    inserts and, with ``touch_matched``, on matches. ``on_duplicate`` is
    ``"error"`` or ``"latest"`` (greatest ``order_col`` wins).
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    columns = target.columns
    values = [c for c in columns if c not in keys and c != "updated_at"]
    now = stamp(run_ts)

    keyed = source.filter(~any_null(keys))
    if on_duplicate == "latest":
        order_by = [order_col] if order_col in source.columns else []
        delivered = _newest(keyed.select(*keys, *values, *order_by), keys, order_by)
        delivered_keys = keyed.select(*keys).distinct()
    else:
        delivered = _single_per_key(keyed.select(*keys, *values), keys)
        delivered_keys = keyed.select(*keys)  # semi and anti joins don't mind repeats

    if touch_matched:
        stamped = delivered.withColumn("updated_at", now)
    else:
        known = (
            target.select(*keys, F.col("updated_at").alias("_was"))
            .join(delivered_keys, keys, "left_semi")
            .withColumn("_known", F.lit(True))
        )
        stamped = delivered.join(known, keys, "left").withColumn(
            "updated_at", F.when(F.col("_known"), F.col("_was")).otherwise(now)
        )
    keyless = source.filter(any_null(keys)).withColumn("updated_at", now)
    untouched = target.join(delivered_keys, keys, "left_anti")  # NULL keys match nothing here either
    return untouched.select(*columns).unionByName(stamped.select(*columns)).unionByName(keyless.select(*columns))


def upsert_orders(target: DataFrame, source: DataFrame, **options) -> DataFrame:
    return upsert(target, source, ORDERS_KEY, **options)


def upsert_order_items(target: DataFrame, source: DataFrame, **options) -> DataFrame:
    return upsert(target, source, ORDER_ITEMS_KEY, **options)


def upsert_customers(target: DataFrame, source: DataFrame, **options) -> DataFrame:
    """Matched customers keep their ``updated_at``."""
    return upsert(target, source, CUSTOMERS_KEY, touch_matched=False, **options)
