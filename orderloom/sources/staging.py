"""Materialising a frame that is read more than once.

Staged frames go to the shared folder named by ``spark.checkpoint.dir`` as
Parquet: later reads prune columns, and losing an executor costs nothing
because no lineage hangs on executor-local blocks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from orderloom.sources.folders import delete_folder


_run: ContextVar[list[DataFrame] | None] = ContextVar("run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged data; a temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="orderloom-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a place to cut their lineage."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads it back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    if (held := _run.get()) is not None:
        held.append(staged)
    return staged


@contextmanager
def staged_run() -> Iterator[None]:
    """Frames staged inside belong to the run and are deleted with it.

    For plans that store their results themselves: a frame that leaves the block can't be read any more.
    """
    held: list[DataFrame] = []
    token = _run.set(held)
    try:
        yield
    finally:
        _run.reset(token)
        for frame in held:
            discard(frame)


def discard(staged: DataFrame) -> None:
    """Delete the files of a frame that ``stage`` returned and nothing reads any more."""
    delete_folder(staged.sparkSession, staged.staged_path)
