"""Session settings for large runs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 << 20
# keyed stream state on local disks, in a fixed part of an executor's memory
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # of the versions before the last ones nothing is wanted; 100 would stay
    "spark.sql.streaming.minBatchesToRetain": "4",
}
# shuffle files go with the query that made them, not when the driver happens to collect its garbage
OWN_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Initial number of shuffle partitions: about 128 MB each and at least two per core; AQE merges small ones."""
    return max(2 * cores, -(-shuffle_bytes // TARGET_PARTITION_BYTES))


def tune(spark: SparkSession, shuffle_bytes: int | None = None, disk_state: bool = False) -> SparkSession:
    """Settings the operators count on: UTC, adaptive plans with skew splitting, partitions that fit in memory.

    ``shuffle_bytes`` is the size of the largest shuffle, for responses about 40 bytes a row. Without it the session's
    number of partitions stays as it is. ``disk_state`` keeps keyed stream state in RocksDB on local disks, for state that
    outgrows the executors' heap.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }
    if disk_state:
        settings |= DISK_STATE
    if shuffle_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes, cores))
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings_of(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold inside; a stream keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
