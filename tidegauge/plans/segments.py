"""Split ordered groups into segments that fit one task.

A window function sorts each of its groups inside one task. That is fine while
groups are small and breaks down when one sensor, word or window holds a large
share of the rows. ``by_key`` measures the largest group first and cuts only the
groups above the bound; ``by_sequence`` cuts one global order by arithmetic on a
unique integer. No row is ever dropped; ``running.scan`` carries values over cuts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import DataFrame, functions as F

from tidegauge.session import written

# Rows of one ordered group that one task should sort.
SEGMENT_ROWS = 4_000_000
# Hot keys are broadcast up to this many; there are at most total / SEGMENT_ROWS.
BROADCAST_KEYS = 100_000

SEGMENT = "_segment"
UNCUT = -1


@dataclass(frozen=True)
class Segments:
    """Rows with a segment column, and which of them belong to cut groups."""

    rows: DataFrame
    order: tuple[str, ...]
    key: tuple[str, ...] = ()
    cut: DataFrame | None = None
    group: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        group = self.key if self.cut is None else (*self.key, SEGMENT)
        object.__setattr__(self, "group", group)


def _cut_by_range(df: DataFrame, key: Sequence[str], order: Sequence[str],
                  total: int, segment_rows: int) -> DataFrame:
    """Range-partition by (key, order) and note the partition of each row.

    The bounds are sampled, so partitions are even whatever the skew: the order
    is unique and a hot key simply spans many of them. The result is written
    because another run of the sampling could draw other bounds.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism,
                ceil(2 * total / segment_rows))
    ranged = df.repartitionByRange(parts, *[F.col(c) for c in (*key, *order)])
    return written(ranged.withColumn(SEGMENT, F.spark_partition_id().cast("long")), "segments")


def by_key(df: DataFrame, key: Sequence[str], order: Sequence[str],
           segment_rows: int = SEGMENT_ROWS, *, like: DataFrame | None = None) -> Segments:
    """Segments of each key's rows in ``order``.

    One aggregate over the key columns finds the groups above ``segment_rows``.
    Usually there are none and the window runs as it is. Otherwise only the hot
    groups go through the range cut; all others stay one segment each. Rows without a
    key are a group like any other. ``like`` is a cheaper frame with the same keys to
    count.
    """
    key, order = tuple(key), tuple(order)
    sizes = (df if like is None else like).groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    is_hot = F.col("_rows") > segment_rows
    found = sizes.agg(F.count_if(is_hot).alias("keys"),
                      F.sum(F.when(is_hot, F.col("_rows"))).alias("rows")).first()
    if not found["keys"]:
        return Segments(df, order, key)
    if not key:
        cut = _cut_by_range(df, key, order, found["rows"], segment_rows)
        return Segments(cut, order, key, cut)
    hot = written(sizes.filter(is_hot).select(*[F.col(k).alias(f"_hot_{k}") for k in key]),
                  "hot-keys")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in key])
    if found["keys"] <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    cut = _cut_by_range(df.join(hot, same, "left_semi"), key, order,
                        found["rows"], segment_rows)
    rest = df.join(hot, same, "left_anti").withColumn(SEGMENT, F.lit(UNCUT).cast("long"))
    return Segments(rest.unionByName(cut), order, key, cut)


def by_sequence(df: DataFrame, seq: str = "seq", segment_rows: int = SEGMENT_ROWS) -> Segments:
    """Segments of the global order given by a unique integer column.

    Ids that are close to dense need no sort and no write: a stretch of ``width``
    consecutive integers holds at most ``width`` rows. Where gaps make the
    stretches longer than a segment, their sizes are counted, and if one is too
    large the rows are range-cut instead.
    """
    seen = df.agg(F.min(seq).alias("low"), F.max(seq).alias("high"),
                  F.count(F.lit(1)).alias("rows")).first()
    low, span = seen["low"] or 0, (seen["high"] or 0) - (seen["low"] or 0) + 1
    parts = max(df.sparkSession.sparkContext.defaultParallelism,
                ceil(seen["rows"] / segment_rows))
    width = ceil(span / parts)
    # Integer division: a double would misplace ids above 2**53.
    stretch = F.call_function("div", F.col(seq) - F.lit(low), F.lit(width)).cast("long")
    if width > segment_rows:
        largest = df.groupBy(stretch.alias("_s")).count().agg(F.max("count")).first()[0]
        if largest > segment_rows:
            cut = _cut_by_range(df, (), (seq,), seen["rows"], segment_rows)
            return Segments(cut, (seq,), (), cut)
    cut = df.withColumn(SEGMENT, stretch)
    return Segments(cut, (seq,), (), cut)
