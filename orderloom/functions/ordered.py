"""Running sums over a globally ordered frame.

A window without partitions would sort everything in one task. Here rows are cut
into ranges by splitters drawn from the data, each range is summed on its own,
and the range totals (one row per range) carry the sums across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.sources.staging import stage


def _range_count(df: DataFrame) -> int:
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _range_of(splitters: str, key: str, ranges: int) -> Column:
    """Number of splitters below the key, by a binary search of the sorted array."""
    middle = "cast((b.lo + b.hi) div 2 as int)"
    return F.expr(
        f"""aggregate(sequence(0, {ranges.bit_length()}), named_struct('lo', 0, 'hi', size({splitters})),
          (b, i) -> if(b.lo >= b.hi, b, if(get({splitters}, {middle}) < {key},
            named_struct('lo', {middle} + 1, 'hi', b.hi), named_struct('lo', b.lo, 'hi', {middle}))),
          b -> b.lo)"""
    )


def _splitters(df: DataFrame, key: Column, carried: Sequence[str], n: int) -> Column:
    """Sorted sample of ``n`` keys: those with the smallest hash, so the choice is
    uniform over keys, depends on the data alone, and is the same on every run.

    The ``carried`` columns keep this reader of ``df`` on the same columns as the
    others, so that all of them share one shuffle.
    """
    sample = (
        df.select(key.alias("k"), *carried)
        .orderBy(F.xxhash64("k"), "k")
        .limit(n)
        .agg(F.array_sort(F.collect_list(F.struct("k", *carried))).alias("sample"))
    )
    return sample.select(F.transform("sample", lambda x: x["k"])).scalar()


def few_rows(df: DataFrame, most: int = 100_000) -> DataFrame:
    """With a broadcast hint if the frame, a staged one, has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def running_sums(
    df: DataFrame,
    order_by: Sequence[str],
    sums: Sequence[str],
    partition_by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum) and ``total_<c>`` for each ``c``.

    ``(partition_by, order_by)`` must be unique per row: aggregate ties first.
    ``df`` is read once if it ends in a shuffle (an aggregation), which the choice of
    splitters shares, else twice. Rows are written with the sums inside their range;
    what later readers need is that frame and one row per range and group.
    """
    key_cols = [*partition_by, *order_by]
    key = F.struct(*key_cols) if len(key_cols) > 1 else F.col(key_cols[0])
    ranges = ranges or _range_count(df)

    ranged = (
        df.withColumn("_key", key)
        .withColumn("_splitters", _splitters(df, key, sums, ranges))
        .withColumn("_range", F.coalesce(_range_of("_splitters", "_key", ranges), F.lit(0)))
        .drop("_key", "_splitters")
    )
    so_far = (
        Window.partitionBy(*partition_by, "_range")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = stage(ranged.select("*", *[F.sum(c).over(so_far).alias(f"_run_{c}") for c in sums]), "running-sums")

    totals = within.groupBy(*partition_by, "_range").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy(*partition_by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*partition_by)
    offsets = totals.select(
        *partition_by,
        "_range",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
    )
    # One row per range and group; groups may be many, so the hint waits for a count.
    offsets = few_rows(stage(offsets, "range-totals"))
    return within.join(offsets, [*partition_by, "_range"]).select(
        *df.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_run_{c}")).alias(f"cum_{c}") for c in sums],
        *[F.col(f"total_{c}") for c in sums],
    )
