"""New raw order files merged into silver as they arrive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators import merge, silver
from orderloom.schemas import RAW_ORDERS
from orderloom.sources import raw_csv
from orderloom.sources.tables import LayerTables

FILE_ORDER = ("file_modification_time", "file_path")


def merge_new_orders(
    tables: LayerTables, raw_path: str, checkpoint: str, pattern: str = raw_csv.ORDERS_PATTERN, run_ts: datetime | None = None
) -> StreamingQuery:
    """Merge every order file not seen before, then stop.

    A batch that is run again after a failure gives the same table, because the
    merge is by key; within one batch the row of the newest file wins, by time and
    then by name. Rows without an order id are all inserted.
    """
    files = tables.spark.readStream.schema(RAW_ORDERS).options(**raw_csv.DIALECT).csv(f"{raw_path}/{pattern}")
    files = files.select("*", *[F.col(f"_metadata.{c}").alias(f"_{c}") for c in FILE_ORDER])

    order_by = [f"_{c}" for c in FILE_ORDER]

    def merge_batch(batch: DataFrame, _: int) -> None:
        rows = raw_csv.clean_text(batch.select(*RAW_ORDERS.fieldNames(), *order_by))
        raw = merge.latest_per_key(raw_csv.stamp_ingested(rows, run_ts), merge.ORDERS_KEY, order_by)
        tables.upsert("silver.orders", silver.silver_orders(raw), merge.ORDERS_KEY, run_ts=run_ts)

    return (
        files.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
