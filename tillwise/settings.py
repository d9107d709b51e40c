"""Session settings for a large cluster.

Adaptive execution does the sizing at run time: it merges small shuffle partitions towards
the advisory size, splits skewed ones, and turns a join into a broadcast only once a side's
measured size is below the limit.  It can merge partitions but not add any, so the number
to start from has to suit the largest shuffle.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024

CLUSTER: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Enough partitions for ``shuffle_bytes`` at the advisory size, and at least two per core."""
    return max(-(-shuffle_bytes // PARTITION_BYTES), 2 * cores)


def apply(spark: SparkSession, shuffle_bytes: int, cores: int) -> None:
    for key, value in CLUSTER.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffle_bytes, cores)))
