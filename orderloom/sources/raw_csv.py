"""Raw CSV files (plain or gzipped) to bronze frames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from orderloom.functions.scalar import blank_to_null, stamp
from orderloom.schemas import RAW_CUSTOMERS, RAW_ORDER_ITEMS, RAW_ORDERS

# One header line, optional double quotes, trimmed, empty is NULL. FAILFAST makes
# one bad row stop the load. Rows of the wrong length are seen by any read, as
# column pruning is off; a bad number is seen when its column is read, and the
# load into bronze reads them all.
DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "nullValue": "",
    "emptyValue": "",
    "mode": "FAILFAST",
    "enforceSchema": "true",
    "columnPruning": "false",
}

ORDERS_PATTERN = "*orders_dataset.csv*"
ORDER_ITEMS_PATTERN = "*order_items_dataset.csv*"
CUSTOMERS_PATTERN = "*customers_dataset.csv*"


def clean_text(df: DataFrame) -> DataFrame:
    """Text trimmed, blank text NULL; the reader leaves blanks inside quotes alone."""
    return df.select(
        *[
            blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, file_length, modified_at)`` of the files that a path or pattern names; contents aren't read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("file_path"), F.col("length").alias("file_length"), F.col("modificationTime").cast("timestamp_ntz").alias("modified_at")
    )


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Columns are taken by position with a fixed schema, never inferred."""
    return clean_text(spark.read.schema(schema).options(**DIALECT).csv(path))


def stamp_ingested(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return df.withColumn("ingested_at", stamp(run_ts))


def load_orders(spark: SparkSession, raw_path: str, pattern: str = ORDERS_PATTERN, run_ts=None) -> DataFrame:
    return stamp_ingested(read_csv(spark, f"{raw_path}/{pattern}", RAW_ORDERS), run_ts)


def load_order_items(
    spark: SparkSession, raw_path: str, pattern: str = ORDER_ITEMS_PATTERN, run_ts=None
) -> DataFrame:
    return stamp_ingested(read_csv(spark, f"{raw_path}/{pattern}", RAW_ORDER_ITEMS), run_ts)


def load_customers(
    spark: SparkSession, raw_path: str, pattern: str = CUSTOMERS_PATTERN, run_ts=None
) -> DataFrame:
    return stamp_ingested(read_csv(spark, f"{raw_path}/{pattern}", RAW_CUSTOMERS), run_ts)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, NULL staying NULL: the raw-refresh form of a bronze table."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
