"""Loads into bronze that take each file once.

The ledger has one row per file of a load: path, length, time of change, and the load it came with.
A load is written in three steps: its rows into a folder of their own, its files into the ledger, and last the folder as a
part of the bronze table. Only the last step makes it count: ledger rows of a load that isn't a
part of the table belong to a run that broke off, and their files are loaded again.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from orderloom.functions.scalar import stamp
from orderloom.sources import raw_csv
from orderloom.sources.tables import LayerTables

LEDGER = "bronze.load_ledger"
FILE = ["file_path", "file_length", "modified_at"]


def loaded_files(tables: LayerTables, name: str) -> DataFrame:
    """The files that the table's rows came from."""
    rows = tables.read(LEDGER).filter(F.col("table_name") == name)
    return rows.filter(F.col("load_id").isin(tables.loads(name)))


def load_new_files(
    tables: LayerTables, name: str, path: str, schema: StructType, run_ts: datetime | None = None, force: bool = False, replace: bool = False
) -> int:
    """Load the files that ``path`` names and the table doesn't have; gives their number.

    A file that has changed in length or time is a new one. ``force`` loads known files again; ``replace``
    makes this load, of all files, the only one.
    """
    tables.create_table(LEDGER)
    tables.create_table(name)
    files = raw_csv.list_files(tables.spark, path)
    if not (force or replace):
        files = files.join(loaded_files(tables, name), FILE, "left_anti")
    found = files.select(*FILE).collect()  # the listing, which the driver makes in any case
    if not found and not replace:
        return 0
    load = uuid.uuid4().hex
    entries = tables.spark.createDataFrame([(name, *f, load) for f in found], "table_name string, file_path string, file_length long, modified_at timestamp_ntz, load_id string")
    tables.append(LEDGER, entries.withColumn("loaded_at", stamp(run_ts)))
    rows = raw_csv.stamp_ingested(raw_csv.read_csv(tables.spark, [f["file_path"] for f in found], schema), run_ts)
    tables.add_load(name, rows, load, replace=replace)
    return len(found)
