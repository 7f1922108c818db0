"""Results that keep their order on disk.

Rows are written in ranges of their position, each file sorted by it, with the position as a column; a
read checks that the files hold every position once and that each holds a stretch of them, so a consumer that goes
through the files by position gets the order back without sorting everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.functions.ordered import running_sums

POSITION = "position"


def write_ordered(df: DataFrame, path: str, order_by: Sequence[str], descending: bool = False) -> None:
    """Write ``df`` with its rows' positions from 0. ``order_by`` must be unique per row; NULL is the least value."""
    counted = running_sums(df.withColumn("_one", F.lit(1).cast("bigint")), order_by, ["_one"])
    place = F.col("total__one") - F.col("cum__one") if descending else F.col("cum__one") - 1
    placed = counted.select(place.alias(POSITION), *df.columns)
    placed.repartitionByRange(POSITION).sortWithinPartitions(POSITION).write.parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The rows with their positions; an error if a position is missing, repeated or out of its file's stretch."""
    rows = spark.read.parquet(path)
    files = rows.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(POSITION).alias("different"), F.min(POSITION).alias("lo"), F.max(POSITION).alias("hi")
    )
    broken = F.sum(F.when((F.col("hi") - F.col("lo") + 1 != F.col("n")) | (F.col("different") != F.col("n")), 1).otherwise(0))
    found = files.agg(broken.alias("broken"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if found["n"] and (found["broken"] or found["lo"] != 0 or found["hi"] + 1 != found["n"]):
        raise RuntimeError(f"rows under {path} are not in order: {found.asDict()}")
    return rows
