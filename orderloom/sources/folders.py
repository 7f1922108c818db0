"""Small files and folder listings in whatever store Spark writes to."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, path = _located(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def write_json(spark: SparkSession, path: str, value) -> None:
    files, target = _located(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str):
    files, source = _located(spark, path)
    stream = files.open(source)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, path = _located(spark, folder)
    files.delete(path, True)
