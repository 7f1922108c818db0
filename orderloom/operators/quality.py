"""Data-quality checks. Each returns a frame of results and never stops a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.scalar import sorted_report


def _status(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rowcount_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: does it hold any row?"""
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("metric")).select(
                F.lit(f"{name} rowcount > 0").alias("check_name"),
                _status(F.col("metric") > 0).alias("status"),
                "metric",
            )
            for name, df in tables.items()
        ]
    )


def not_null_checks(columns: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per (label, column). An empty table fails with a NULL metric."""
    return _stack(
        [
            df.agg(F.sum(F.when(F.col(column).isNull(), 1).otherwise(0)).alias("null_rows")).select(
                F.lit(f"{label}: {column.upper()} is NOT NULL").alias("check_name"),
                _status(F.col("null_rows") == 0).alias("status"),
                "null_rows",
            )
            for label, (df, column) in columns.items()
        ]
    )


def layer_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name.upper()).alias("obj"), "row_count")
            for name, df in tables.items()
        ]
    )
    return sorted_report(counts, "obj")


def duplicate_key_check(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Counts keys that occur more than once, not their rows."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("dup_keys")).select(
        F.lit(f"{name} duplicate ({', '.join(k.upper() for k in keys)})").alias("check_name"),
        _status(F.col("dup_keys") == 0).alias("status"),
        "dup_keys",
    )


def missing_reference_check(
    fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, name: str
) -> DataFrame:
    """Fact rows whose key is NULL or absent from the dimension.

    The fact is counted per key before the anti join, so a key that holds a large
    part of the fact crosses the shuffle as a few rows.
    """
    per_key = fact.groupBy(F.col(fact_key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("_key"))
    return (
        per_key.join(known, "_key", "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("bad_rows"))
        .select(
            F.lit(name).alias("check_name"),
            _status(F.col("bad_rows") == 0).alias("status"),
            "bad_rows",
        )
    )


def failed(*checks: DataFrame) -> DataFrame:
    """Names of the failed checks."""
    return _stack([c.filter(F.col("status") == "FAIL").select("check_name") for c in checks])
