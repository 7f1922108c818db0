"""Session settings for runs that do not bring their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


#: For one machine and little data: more driver memory, and smaller merged partitions that keep every core busy.
ONE_MACHINE = {"spark.driver.memory": "12g", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k"}


def build_session(
    app_name: str = "orderloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with adaptive execution, skew handling and a fixed time zone.

    Shuffle partitions are left to the cluster's setting unless given: adaptive
    execution merges small ones, so a large value is safe for large inputs. Settings
    don't depend on the master; a run on one machine passes what it needs in ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():  # such as ONE_MACHINE
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
