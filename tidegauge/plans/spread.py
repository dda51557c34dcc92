"""Give a step that is heavy on CPU enough tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Spread a scan over all cores if it has fewer splits than there are.

    A table large enough to keep the cluster busy is left where it is, unshuffled.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def by_key(rows: DataFrame, *keys: str) -> DataFrame:
    """Partition by key for Python work per key.

    With an explicit count, adaptive execution does not merge partitions that are
    small in bytes but slow in Python. The exchange takes the place of the one the
    following window or grouping would add.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(count, *keys)
