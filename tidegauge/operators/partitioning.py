"""Explicit placement of rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F


def partition_for(number: Column, partitions: int, spread_by: Column | None = None) -> Column:
    """Negative numbers go to partition 0, all others are spread.

    The spread is a hash, not a random draw: a retried task must place its rows
    where the first attempt did.
    """
    spread = F.xxhash64(number) if spread_by is None else spread_by
    return F.when(number < 0, F.lit(0)).otherwise(
        F.pmod(spread, F.lit(partitions))).cast("int")


def partition_custom(rows: DataFrame, number: str, partitions: int,
                     spread_by: Column | None = None) -> DataFrame:
    """Add ``partition``, the number that ``partition_for`` names.

    No row is moved: with all negatives in one partition, moving them would put any share
    of the rows into one task. A writer can use the column for its layout.
    """
    return rows.withColumn("partition", partition_for(F.col(number), partitions, spread_by))


def place(rows: DataFrame, number: str, partitions: int, spread_by: Column | None = None) -> DataFrame:
    """Move each row into the partition, or the range of partitions, that its number names.

    All negative numbers count as one. A number with at most a fair part of the rows is
    hashed to one partition. One with more gets a range of partitions wide enough for its
    rows, over which ``spread_by`` (a hash of the whole row unless given) deals them; equal
    rows are dealt together. Adds ``partition``, the partition that the row is in.
    """
    named = F.when(F.col(number) < 0, F.lit(-1)).otherwise(F.col(number)).cast("long")
    numbered = rows.withColumn("_number", named)
    total = rows.count()
    fair = max(1.0, total / partitions)
    # At most ``partitions`` numbers can have more than a fair part.
    hot = numbered.groupBy("_number").count().filter(F.col("count") > fair).orderBy(
        F.desc("count"), "_number").collect()
    ranges, begin = [], 0
    for row in hot:
        width = min(partitions, ceil(row["count"] / fair))
        ranges.append((row["_number"], begin % partitions, width))
        begin += width
    spread = F.xxhash64(*rows.columns) if spread_by is None else spread_by
    first = F.pmod(F.xxhash64("_number"), F.lit(partitions))
    if ranges:
        table = F.broadcast(rows.sparkSession.createDataFrame(
            ranges, "_of long, _begin int, _width int"))
        numbered = numbered.join(table, F.col("_number").eqNullSafe(F.col("_of")), "left")
        first = F.when(F.col("_width").isNotNull(), F.pmod(
            F.col("_begin") + F.pmod(spread, F.col("_width")), F.lit(partitions))).otherwise(first)
    return numbered.withColumn("partition", first.cast("int")).select(
        *rows.columns, "partition").repartitionById(partitions, F.col("partition"))


def by_key(rows: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash partitioning by key, for steps that need it outside an aggregate or window."""
    return rows.repartition(*keys) if partitions is None else rows.repartition(partitions, *keys)


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """One order over all rows; ranges of it are sorted side by side."""
    return rows.orderBy(*columns)
