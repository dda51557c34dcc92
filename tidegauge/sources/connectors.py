"""Sources whose connector the cluster must provide: message topics and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(servers: str, topic: str, group: str | None = None,
                  per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **extra}
    if group is not None:
        options["kafka.group.id"] = group
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def decode_messages(messages: DataFrame) -> DataFrame:
    """Message values as text, with where and when they were written."""
    return messages.select(F.col("value").cast("string").alias("value"),
                           "topic", "partition", "offset", "timestamp")


def kafka_text(spark: SparkSession, servers: str, topic: str, group: str | None = None,
               **extra: str) -> DataFrame:
    """A topic of UTF-8 strings as a stream."""
    options = kafka_options(servers, topic, group, **extra)
    return decode_messages(spark.readStream.format("kafka").options(**options).load())


def jdbc_options(url: str, table: str, *, split_by: str | None = None,
                 bounds: tuple[int, int] | None = None, partitions: int = 16,
                 fetch_rows: int = 10_000, **extra: str) -> dict[str, str]:
    """Options of a table read; with ``split_by`` it runs in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **extra}
    if split_by is not None:
        if bounds is None:
            raise ValueError("a parallel read needs the bounds of its column")
        options |= {"partitionColumn": split_by, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options


def lookup_table(spark: SparkSession, url: str, table: str, **how) -> DataFrame:
    """A database table to join with readings, in place of one query per reading."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **how)).load()
