"""Tables bucketed and sorted by one column, so that joins on it need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def create(spark: SparkSession, location: str, fields: str, key: str, buckets: int) -> str:
    """Name of a table over ``location``; rows that lie there already belong to it."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({key}) "
              f"SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return name


def append(rows: DataFrame, name: str, key: str, buckets: int) -> None:
    """One sorted file per bucket that has rows."""
    fields = rows.sparkSession.table(name).columns
    (rows.repartition(buckets, key).sortWithinPartitions(key).select(fields)
     .write.insertInto(name))


def id_ranges(docs: DataFrame, count: int) -> list[Column]:
    """Conditions that cut the rows into ``count`` ranges of ascending doc_id, nulls last.

    The bounds are quantiles, so ids far from the others leave the ranges even.
    """
    column = F.col("doc_id")
    shares = [i / count for i in range(1, count)]
    bounds = shares and docs.agg(F.percentile_approx("doc_id", shares)).first()[0]
    if not bounds:
        return [F.lit(True)]
    first = [F.lit(True), *(column >= b for b in bounds)]
    last = [*(column < b for b in bounds), F.lit(True)]
    ranges = [(a & b) & column.isNotNull() for a, b in zip(first, last, strict=True)]
    ranges[-1] = ranges[-1] | column.isNull()
    return ranges
