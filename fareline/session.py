"""Spark session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correctness settings: zone-free timestamps compare the same everywhere, and bad casts fail loudly.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffles begin wide and are merged by size; an aggregation's shuffle could not be split later.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # Independent writes share the cluster.
    "spark.scheduler.mode": "FAIR",
    # Stored files come out of a rebalance, so this is their target size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app_name: str = "fareline", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submitter's
    values win and AQE coalesces from there. Tests and the bench pass local values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(CORE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
