"""SparkSession construction with the settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


# Settings for large inputs on a cluster: a wide shuffle that AQE coalesces
# down to ~256 MB partitions, 256 MB scan splits, and many small raw files
# packed into one split (each file counted as 8 MB when packing).
CLUSTER_PROFILE = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
}


def build_session(
    master: str | None = None,
    app_name: str = "opinio",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    profile: str = "local",
) -> SparkSession:
    """Create (or reuse) a session tuned for this library.

    * AQE on: partition coalescing and skew splitting are decided at run time.
    * UTC session time zone, so ``dt`` values never shift with the host.
    * The web UI stays off.
    * ``profile="cluster"`` adds ``CLUSTER_PROFILE`` (partition sizing for
      large inputs); explicit arguments still win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
    if profile == "cluster":
        conf.update(CLUSTER_PROFILE)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    driver_mem = os.environ.get("OPINIO_DRIVER_MEMORY")
    if driver_mem:
        builder = builder.config("spark.driver.memory", driver_mem)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
