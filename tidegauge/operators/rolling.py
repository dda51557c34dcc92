"""Rolling aggregates: one output row per input row, in each key's own order.

All are running values over segments (``plans``): a key above ``segment_rows``
is cut and its parts are processed side by side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidegauge.functions import without_trailing_empty
from tidegauge.model import EVENT_ORDER
from tidegauge.operators.transforms import SEPARATORS, filter_above, tokenize
from tidegauge.plans import running, segments
from tidegauge.plans.segments import SEGMENT, SEGMENT_ROWS
from tidegauge.session import written

# Words of a stretch of texts that one task numbers, if words and what is between them take as
# many characters as said here.
STRETCH_WORDS, WORD_LENGTH = 1 << 19, 8


def counter(rows: DataFrame, seq: str = "seq", name: str = "n", *,
            segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Number all rows 0, 1, 2, ... in the order of ``seq``, without a global sort."""
    numbered = running.scan(segments.by_sequence(rows, seq, segment_rows),
                            **{name: running.running_count()})
    return numbered.withColumn(name, F.col(name) - 1)


def rolling_sum(rows: DataFrame, key: str, value: str, first: Sequence[str] = (), *,
                order: Sequence[str] = EVENT_ORDER,
                segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Running sum of ``value`` per key.

    Columns named in ``first`` keep the value of the key's first row, as a
    positional sum leaves the fields it does not add up.
    """
    cut = segments.by_key(rows, [key], order, segment_rows)
    return running.scan(
        cut, **{f"rolling_{value}": running.running_sum(F.col(value))},
        **{f"first_{c}": running.first_of(F.col(c)) for c in first})


def rolling_max_reading(readings: DataFrame, *, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The warmest reading of the sensor so far; of equal ones, the later."""
    rank = F.struct("temperature", "timestamp", "seq")
    cut = segments.by_key(readings.select("id", "timestamp", "seq", "temperature"),
                          ["id"], EVENT_ORDER, segment_rows)
    return running.scan(cut, _max=running.running_max(rank)).select(
        "id", "seq", F.col("_max.timestamp").alias("max_timestamp"),
        F.col("_max.temperature").alias("max_temperature"))


def rolling_concat(rows: DataFrame, key: str, items: str, *, order: Sequence[str],
                   segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Concatenation of the key's lists so far. The output grows with each row."""
    cut = segments.by_key(rows, [key], order, segment_rows)
    return running.scan(cut, **{f"rolling_{items}": running.running_concat(F.col(items))})


def list_size(items: str) -> Column:
    """Items in a list; none in a null one."""
    return F.when(F.col(items).isNull(), 0).otherwise(F.size(items)).cast("long")


def rolling_items(rows: DataFrame, key: str, items: str, *, order: Sequence[str],
                  segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The rows with item_from and item_to: where the row's items lie in the concatenation of
    the key's lists so far, from 0, the end exclusive.

    The concatenation itself repeats every item in all later rows. Here each item is there
    once, and the list that a row stands for is a range: the items before its item_to.
    """
    cut = segments.by_key(rows, [key], order, segment_rows)
    placed = running.scan(cut, item_to=running.running_sum(list_size(items)))
    return placed.withColumn("item_from", F.col("item_to") - list_size(items))


def items_before(placed: DataFrame, wanted: DataFrame, key: str, items: str,
                 last: int | None = None) -> DataFrame:
    """The wanted prefixes of ``rolling_items``, one row per item: the columns of ``wanted``
    (``key``, item_to and any others), position, item.

    With ``last`` only so many items at the end of each prefix. Only what is asked for is
    repeated, and no list is gathered into one row.
    """
    named = placed.select(F.col(key).alias("_key"), F.col("item_from").alias("_from"),
                          F.posexplode(items).alias("_place", "item"))
    singles = named.select("_key", (F.col("_from") + F.col("_place")).alias("position"), "item")
    inside = F.col(key).eqNullSafe(F.col("_key")) & (F.col("position") < F.col("item_to"))
    if last is not None:
        inside &= F.col("position") >= F.col("item_to") - last
    return wanted.join(singles, inside).drop("_key")


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of each word; a stream emits updated counts."""
    return tokenize(texts, column).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def rolling_word_count(texts: DataFrame, order: str, column: str = "text", *,
                       segment_rows: int = STRETCH_WORDS) -> DataFrame:
    """For each word occurrence, how often the word has occurred so far.

    The texts, not the words, are cut into stretches of the order. A word's count before a
    stretch comes from a table with one row per stretch and different word; inside it, a task
    numbers the words of its own texts. So no word is sorted or shuffled, however frequent.
    """
    texts = texts.select(order, column)
    length = texts.agg(F.sum(F.length(column))).first()[0] or 0
    parts = max(texts.sparkSession.sparkContext.defaultParallelism,
                ceil(length / WORD_LENGTH / segment_rows))
    # Written because another run of the sampling could draw other bounds.
    cut = written(texts.repartitionByRange(parts, order).withColumn(
        SEGMENT, F.spark_partition_id().cast("long")), "stretches")
    # The split is bound to a name of its own, or else each use of its parts would split again.
    words = F.transform(F.array(F.split(column, SEPARATORS)), without_trailing_empty)[0]
    lists = cut.select(SEGMENT, order, words.alias("words"))
    totals = lists.select(SEGMENT, "words").mapInArrow(
        _counted, f"{SEGMENT} long, word string, _n long").groupBy(SEGMENT, "word").agg(
        F.sum("_n").alias("_n"))
    before = Window.partitionBy("word").orderBy(SEGMENT).rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = totals.withColumn("_before", F.sum("_n").over(before)).filter(
        F.col("_before").isNotNull()).select(SEGMENT, "word", "_before")

    def number(lists: pa.Table, earlier: pa.Table) -> pa.Table:
        return _numbered(lists, earlier, order)

    kinds = T.StructType([texts.schema[order], T.StructField("position", T.IntegerType()),
                          T.StructField("word", T.StringType()),
                          T.StructField("count", T.LongType())])
    return lists.groupBy(SEGMENT).cogroup(earlier.groupBy(SEGMENT)).applyInArrow(number, kinds)


# These run in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word comes per stretch, in parts."""
    for batch in batches:
        for stretch in pc.unique(batch.column(0)):
            coded = batch.filter(pc.equal(batch.column(0), stretch)).column(
                "words").flatten().dictionary_encode()
            often = np.bincount(coded.indices.to_numpy(zero_copy_only=False),
                                minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(stretch, len(often)), coded.dictionary, pa.array(often)],
                [SEGMENT, "word", "_n"])


def _numbered(lists: pa.Table, earlier: pa.Table, order: str) -> pa.Table:
    """The words of a stretch, each with its count so far; ``earlier`` holds those before it."""
    lists = lists.take(pc.sort_indices(lists, [(order, "ascending")], null_placement="at_start"))
    words = lists.column("words").combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    # The places of each different word one after another, in order.
    by_word = np.argsort(code, kind="stable")
    often = np.bincount(code, minlength=len(coded.dictionary))
    known = pc.index_in(coded.dictionary, value_set=earlier.column("word").combine_chunks())
    before = pc.fill_null(earlier.column("_before").combine_chunks().take(known), 0).to_numpy(
        zero_copy_only=False)
    count = np.empty(len(code), np.int64)
    count[by_word] = np.arange(1, len(code) + 1) + np.repeat(before - (np.cumsum(often) - often),
                                                             often)
    position = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    texts = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    return pa.table({order: lists.column(order).take(texts),
                     "position": position.astype(np.int32),
                     "word": words.flatten(), "count": count})


def high_temperature_key_count(readings: DataFrame, above: float = 10.0, *,
                               segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """For each high reading, how many high readings its sensor had before."""
    high = filter_above(readings, "temperature", above).select("id", "timestamp", "seq")
    cut = segments.by_key(high, ["id"], EVENT_ORDER, segment_rows)
    return running.scan(cut, _n=running.running_count()).select(
        "id", "timestamp", "seq", (F.col("_n") - 1).alias("key_count"))


def hash_bucket(buckets: int, column: str = "id") -> Column:
    """Default assignment of readings to counting buckets."""
    return F.pmod(F.xxhash64(column), F.lit(buckets))


def high_temperature_bucket_count(readings: DataFrame, bucket: Column, above: float = 10.0, *,
                                  segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """For each high reading, the number of high readings in its bucket so far.

    There are few buckets, so at scale every one is cut into segments.
    """
    return _per_bucket(_bucketed(readings, bucket, above), segment_rows)[0]


def _bucketed(readings: DataFrame, bucket: Column, above: float) -> DataFrame:
    return filter_above(readings, "temperature", above).select(
        "id", "timestamp", "seq", bucket.alias("bucket"))


def _per_bucket(high: DataFrame, segment_rows: int) -> tuple[DataFrame, bool]:
    """Counts per bucket, and whether buckets had to be cut."""
    cut = segments.by_key(high, ["bucket"], EVENT_ORDER, segment_rows)
    return running.scan(cut, bucket_count=running.running_count()), cut.cut is not None


def high_temperature_both_counts(readings: DataFrame, bucket: Column, above: float = 10.0, *,
                                 segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Count before this reading per sensor, beside the count so far per bucket."""
    high = _bucketed(readings, bucket, above)
    per_bucket, was_cut = _per_bucket(high, segment_rows)
    if was_cut:
        # The second pass may read its input several times.
        per_bucket = written(per_bucket, "bucket-counts")
    cut = segments.by_key(per_bucket, ["id"], EVENT_ORDER, segment_rows, like=high)
    return running.scan(cut, _n=running.running_count()).select(
        "id", "timestamp", "seq", (F.col("_n") - 1).alias("key_count"), "bucket_count")
