"""Streaming forms built from streams of readings. None starts a query.

Stateless operators and windows need no form of their own: call them on the stream,
after ``lateness.watermark`` where they aggregate. The session must use the RocksDB
state store for the jobs below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidegauge import texts
from tidegauge.functions import reading_line
from tidegauge.operators.lateness import watermark
from tidegauge.operators.rolling import list_size
from tidegauge.operators.transforms import alert
from tidegauge.operators.windows import assign
from tidegauge.streaming import processors as p


def _delay(ms: int) -> str:
    return f"{ms} milliseconds"


def clocked(rows: DataFrame, delay_ms: int, only: Column | None = None) -> DataFrame:
    """``rows`` under a watermark that moves with their times and drops none of them.

    Spark drops a row that is behind the watermark if an operator that keeps state sees the
    row's event time. Here the watermark is taken from a column of its own, which the
    rows then leave behind: the processors get every row, know the watermark, and decide
    themselves. With ``only``, just the rows that satisfy it move the watermark (punctuated).
    """
    time = F.timestamp_millis("timestamp")
    ticking = rows.withColumn("_tick", time if only is None else F.when(only, time))
    return ticking.withWatermark("_tick", _delay(delay_ms)).drop("_tick", "ts")


def _stateful(rows: DataFrame, keys: tuple[str, ...], processor: StatefulProcessor,
              timers: bool = False) -> DataFrame:
    return rows.groupBy(*keys).transformWithStateInPandas(
        processor, processor.output_schema, "append", "EventTime" if timers else "None")


def _narrow(readings: DataFrame) -> DataFrame:
    return readings.select("id", "timestamp", "seq", "temperature")


def rolling_sum(readings: DataFrame) -> DataFrame:
    return _stateful(_narrow(readings), ("id",), p.RollingSum())


def rolling_max_reading(readings: DataFrame) -> DataFrame:
    return _stateful(_narrow(readings), ("id",), p.RollingMax())


def high_temperature_key_count(readings: DataFrame, above: float = 10.0) -> DataFrame:
    high = _narrow(readings).filter(F.col("temperature") > above)
    return _stateful(high, ("id",), p.HighCount(above))


# Parts of a counting bucket, and the stretch of event time that stays in one part.
BUCKET_SHARDS = 32
SLOT_MS = 1_000


def _dealt(readings: DataFrame, bucket: Column, above: float, slot_ms: int,
           shards: int) -> DataFrame:
    """High readings with the slot and the part of their bucket. Readings without a bucket have
    parts of their own behind the others, so that no key is null."""
    number = bucket.cast("long")
    part = F.pmod(F.xxhash64("slot"), F.lit(shards)) + F.when(number.isNull(), shards).otherwise(0)
    return readings.filter(F.col("temperature") > above).withColumn(
        "slot", F.floor(F.col("timestamp") / slot_ms)).select(
        "id", "timestamp", "seq", "temperature", "slot", part.cast("int").alias("shard"),
        F.coalesce(number, F.lit(0)).alias("bucket"))


def _bucket_counts(dealt: DataFrame, shards: int) -> DataFrame:
    ranked = _stateful(dealt, ("bucket", "shard"), p.SlotRanks())
    # Readings stay in their part; the size of a slot goes to every part of its bucket.
    base = F.when(F.col("shard") >= shards, shards).otherwise(0)
    parts = F.when(F.col("kind") == p.CONTROL, F.sequence(base, base + (shards - 1))).otherwise(
        F.array("shard"))
    counted = _stateful(ranked.withColumn("shard", F.explode(parts)), ("bucket", "shard"),
                        p.SlotCarries())
    return counted.withColumn("bucket", F.when(F.col("shard") < shards, F.col("bucket"))).drop(
        "shard")


def high_temperature_bucket_count(readings: DataFrame, bucket: Column, above: float = 10.0,
                                  slot_ms: int = SLOT_MS,
                                  shards: int = BUCKET_SHARDS) -> DataFrame:
    """For each high reading, the number of high readings in its bucket so far.

    A bucket is dealt over ``shards`` keys by slots of ``slot_ms``, so a bucket with a third of
    all readings is in no single task. The slots are ranked where they are; only their sizes
    go to all parts of the bucket, and each part carries the bucket's total. Within a
    micro-batch the order is the events' own, as in all rolling streams.
    """
    dealt = _dealt(readings, bucket, above, slot_ms, shards).withColumn(
        "key_count", F.lit(0).cast("long"))
    return _bucket_counts(dealt, shards).drop("key_count")


def high_temperature_both_counts(readings: DataFrame, bucket: Column, above: float = 10.0,
                                 slot_ms: int = SLOT_MS,
                                 shards: int = BUCKET_SHARDS) -> DataFrame:
    """Count before this reading per sensor, beside the count so far per bucket; see
    ``high_temperature_bucket_count``."""
    dealt = _dealt(readings, bucket, above, slot_ms, shards)
    counter = p.HighCount(above, bucket="long", shard="int", slot="long")
    return _bucket_counts(_stateful(dealt, ("id",), counter), shards).drop("bucket")


def rolling_items(rows: DataFrame, key: str, items: str, order: Sequence[str]) -> DataFrame:
    """``key``, ``order``, item_from, item_to: the places of a row's items in the concatenation
    of the lists of its key so far, see ``rolling.rolling_items``. State is one number per key."""
    placed = rows.select(key, *order, list_size(items).alias("items"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in placed.drop("items").schema) + ", item_from long, item_to long"
    # Numbers that are null would not survive as a key.
    grouped = placed.withColumn("group", F.to_json(F.struct(key)))
    return _stateful(grouped, ("group",), p.RollingItems(list(order), schema))


def temperature_changes(readings: DataFrame, threshold: float = 1.7) -> DataFrame:
    return _stateful(_narrow(readings), ("id",), p.ChangeAlert(threshold))


def self_cleaning_changes(readings: DataFrame, threshold: float = 1.5,
                          ttl_ms: int = 3_600_000, delay_ms: int = 5_000) -> DataFrame:
    """No reading is too late: what is forgotten follows from the readings' own times. The state
    of a sensor is freed when the watermark is past the time at which it is forgotten; a
    reading later than that is compared with 0.0."""
    return _stateful(clocked(_narrow(readings), delay_ms), ("id",),
                     p.ChangeAlert(threshold, ttl_ms, delay_ms), timers=True)


def rising_alerts(readings: DataFrame, hold_ms: int = 1_000, delay_ms: int = 5_000,
                  accepted_ms: int = 0) -> DataFrame:
    """Warnings wait for readings up to ``delay_ms + accepted_ms`` behind the latest; what
    comes later still is the late side of ``late_side`` with that delay."""
    timed = watermark(readings, _delay(delay_ms + accepted_ms))
    return _stateful(timed, ("id",), p.RisingAlert(hold_ms), timers=True)


def late_side(readings: DataFrame, delay_ms: int = 5_000, size_ms: int | None = None,
              only: Column | None = None) -> DataFrame:
    """Every reading with the watermark its micro-batch met (null before there is one) and a
    column ``late``: behind that watermark, or with ``size_ms``, in a window that it had
    closed. Filter it into both sides. With ``only``, the watermark is punctuated."""
    deadline = F.col("timestamp")
    if size_ms is not None:
        # Spark's watermark is past a window's last millisecond when the next one begins.
        deadline = deadline - deadline % size_ms + size_ms - 2
    rows = clocked(readings, delay_ms, only).withColumn("deadline", deadline)
    return _stateful(rows, ("id",), p.LateMarker(), timers=True)


def _merged(readings: DataFrame, controls: DataFrame, delay_ms: int) -> DataFrame:
    """One stream of control rows and readings; the watermark is the slower one's."""
    timed = watermark(readings, _delay(delay_ms)).withColumn("kind", F.lit(p.READING))
    marked = watermark(controls.withColumn("ts", F.timestamp_millis("timestamp")),
                       _delay(delay_ms)).withColumn("kind", F.lit(p.CONTROL))
    return marked.unionByName(timed, allowMissingColumns=True)


def switch_filter(readings: DataFrame, switches: DataFrame, delay_ms: int = 5_000,
                  accepted_ms: int = 3_600_000) -> DataFrame:
    """A switch takes effect when it arrives. The state of a switch is freed when the readings'
    watermark is ``accepted_ms`` past its end; up to then no reading is too late for it."""
    on = switches.select("id", "timestamp", "seq",
                         (F.col("timestamp") + F.col("duration_ms")).alias("until"))
    live = clocked(_narrow(readings), delay_ms)
    merged = on.withColumn("kind", F.lit(p.CONTROL)).unionByName(
        live.withColumn("kind", F.lit(p.READING)), allowMissingColumns=True)
    return _stateful(merged, ("id",), p.SwitchFilter(accepted_ms), timers=True)


def threshold_alerts(readings: DataFrame, thresholds: DataFrame,
                     delay_ms: int = 5_000) -> DataFrame:
    limits = thresholds.select("id", "timestamp", "seq", "threshold")
    return _stateful(_merged(readings, limits, delay_ms), ("id",), p.ThresholdAlert())


# Copies of a global level's history; readings are dealt over as many keys.
LEVEL_COPIES = 32


def readings_at_level(readings: DataFrame, control: DataFrame, level: str = "HIGH",
                      delay_ms: int = 5_000, accepted_ms: int = 0,
                      copies: int = LEVEL_COPIES) -> DataFrame:
    """Readings taken while the latest record of the stream ``control`` (timestamp, seq, level)
    says ``level``; of equal times the control record comes first.

    A control record goes to each of ``copies`` keys, a reading to one of them. The clock is
    the readings', so a control stream without news holds nothing up: a reading is decided
    when the watermark has passed it, by the control records that have come by then. Later
    readings are decided at once, from a history that reaches ``accepted_ms`` back.
    """
    spread = F.pmod(F.xxhash64("id", "seq"), F.lit(copies)).cast("int")
    live = clocked(_narrow(readings), delay_ms).withColumns(
        {"bucket": spread, "kind": F.lit(p.READING)})
    every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    levels = control.select("timestamp", "seq", "level", every.alias("bucket"),
                            F.lit(p.CONTROL).alias("kind"))
    merged = live.unionByName(levels, allowMissingColumns=True)
    return _stateful(merged, ("bucket",), p.LevelFilter(level, accepted_ms), timers=True)


def fire_alerts(readings: DataFrame, control: DataFrame, above: float = 100.0,
                delay_ms: int = 5_000, accepted_ms: int = 0,
                copies: int = LEVEL_COPIES) -> DataFrame:
    """An alert for each reading above the bound while the smoke level is HIGH."""
    risky = readings_at_level(readings.filter(F.col("temperature") > above), control, "HIGH",
                              delay_ms, accepted_ms, copies)
    return risky.select(*alert(F.concat(F.lit(texts.FIRE), reading_line())))


def late_updates(readings: DataFrame, size_ms: int = 10_000, delay_ms: int = 5_000,
                 lateness_ms: int = 5_000, only: Column | None = None) -> DataFrame:
    """With ``only``, windows close by a punctuated watermark."""
    timed = assign(clocked(readings, delay_ms, only), size_ms)
    return _stateful(timed, ("id",), p.LateUpdates(lateness_ms), timers=True)


def window_counts(placed: DataFrame, trigger, delay_ms: int = 5_000,
                  only: Column | None = None) -> DataFrame:
    """id, end_ts, eval_ts, readings: the count of each window (id, end_ts) at the times that
    ``trigger`` names (``processors.Every``, ``AtEnd``, ``AtShares`` or an own one).

    ``placed`` has id, timestamp and end_ts from any assigner (``windows.assign`` or own
    columns; a reading in several windows is several rows).
    """
    timed = clocked(placed.select("id", "timestamp", "end_ts"), delay_ms, only)
    return _stateful(timed, ("id", "end_ts"), p.WindowCounts(trigger), timers=True)


def early_counts(readings: DataFrame, size_ms: int = 30_000, every_ms: int = 1_000,
                 delay_ms: int = 5_000) -> DataFrame:
    return window_counts(assign(readings, size_ms), p.Every(every_ms), delay_ms)
