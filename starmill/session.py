"""Session settings that the jobs rely on; all can be changed at run time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024
# Parquet grows by about this factor once decoded into shuffle rows.
DECODED_FACTOR = 4


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from the file system's own summary."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(location).getLength()


def tune(
    spark: SparkSession,
    *paths: str,
    partition_bytes: int = PARTITION_BYTES,
    most: int | None = None,
) -> dict[str, str | None]:
    """Turn on adaptive execution and size shuffles for the tables at ``paths``.

    A key with a large share of the rows makes one oversized join partition. Adaptive
    execution splits it; forcing that also covers joins whose output feeds another join
    on the same key. The initial partition count follows the inputs, one for each
    ``partition_bytes`` of decoded rows and ``most`` at most, and adaptive execution merges
    what turns out small. Returns the settings before, for :func:`restore`.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    if paths:
        size = sum(input_bytes(spark, path) for path in paths) * DECODED_FACTOR
        wanted = max(-(-size // partition_bytes), spark.sparkContext.defaultParallelism)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            wanted if most is None else min(wanted, most)
        )
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    return before


def restore(spark: SparkSession, before: Mapping[str, str | None]) -> None:
    """Put settings back that :func:`tune` has changed."""
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
