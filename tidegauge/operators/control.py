"""Readings combined with control streams: smoke level, switches, thresholds.

At equal times a control record comes before the readings. A control table of
checked size is broadcast and the readings stay where they are. A larger one is
merged with the readings into one ordered sequence, cut into segments, and the
last control value is carried along; this is linear in both inputs under any skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegauge import texts
from tidegauge.functions import reading_line
from tidegauge.operators.transforms import alert
from tidegauge.plans import running, segments
from tidegauge.plans.intervals import PER_BUCKET, TimeBuckets, level_intervals, within_any
from tidegauge.plans.segments import SEGMENT_ROWS
from tidegauge.plans.sizes import BROADCAST_ROWS, broadcast_if_small
from tidegauge.session import written

# Control records sort before readings of the same time.
CONTROL, READING = 0, 1
MERGED_ORDER = ("timestamp", "_kind", "seq")


def _merged(control: DataFrame, readings: DataFrame) -> DataFrame:
    return control.withColumn("_kind", F.lit(CONTROL)).unionByName(
        readings.select("id", "timestamp", "seq", "temperature")
        .withColumn("_kind", F.lit(READING)), allowMissingColumns=True)


def readings_at_level(readings: DataFrame, control: DataFrame, level: str = "HIGH", *,
                      broadcast_rows: int = BROADCAST_ROWS,
                      segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Readings taken while the latest control level is ``level``.

    ``control`` has timestamp, seq and level. No level is set before its first row.
    """
    readings = readings.select("id", "timestamp", "temperature", "seq")
    seen = control.agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("low"),
        F.max("timestamp").alias("high")).first()
    if not seen["rows"]:
        return readings.limit(0)
    if seen["rows"] <= broadcast_rows:
        buckets = TimeBuckets(seen["low"], seen["high"], seen["rows"])
        spread = written(buckets.spread(level_intervals(control, level)), "intervals")
        densest = spread.groupBy("_bucket").count().agg(F.max("count")).first()[0]
        if (densest or 0) <= PER_BUCKET:
            return within_any(readings, "timestamp", spread, buckets)
    cut = segments.by_key(_merged(control, readings), [], MERGED_ORDER, segment_rows)
    return running.scan(cut, _level=running.latest(F.col("level"))).filter(
        (F.col("_kind") == READING) & (F.col("_level") == level)).select(
        "id", "timestamp", "temperature", "seq")


def fire_alerts(readings: DataFrame, control: DataFrame, above: float = 100.0, *,
                broadcast_rows: int = BROADCAST_ROWS,
                segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """An alert for each reading above the bound while the smoke level is HIGH."""
    risky = readings_at_level(readings.filter(F.col("temperature") > above), control, "HIGH",
                              broadcast_rows=broadcast_rows, segment_rows=segment_rows)
    return risky.select(*alert(F.concat(F.lit(texts.FIRE), reading_line())))


def switch_filter(readings: DataFrame, switches: DataFrame, *,
                  broadcast_rows: int = BROADCAST_ROWS,
                  segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Readings of sensors whose switch is on.

    A switch (id, timestamp, seq, duration_ms) is on from its time until its
    duration has passed; of overlapping ones the later end counts, which makes
    them the union of their intervals.
    """
    columns = ["id", "timestamp", "temperature", "seq"]
    deadline = F.col("timestamp") + F.col("duration_ms")
    seen = switches.groupBy("id").count().agg(
        F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    if (seen["rows"] or 0) <= broadcast_rows and (seen["most"] or 0) <= PER_BUCKET:
        on = switches.select(F.col("id"), F.col("timestamp").alias("start"),
                             deadline.alias("end"))
        active = ((F.col("r.id") == F.col("s.id"))
                  & (F.col("r.timestamp") >= F.col("s.start"))
                  & (F.col("r.timestamp") < F.col("s.end")))
        return readings.select(*columns).alias("r").join(
            F.broadcast(on).alias("s"), active, "left_semi")
    switched = broadcast_if_small(switches.select("id").distinct(), broadcast_rows)
    control = switches.select("id", "timestamp", "seq", deadline.alias("_deadline"))
    cut = segments.by_key(_merged(control, readings.join(switched, "id", "left_semi")),
                          ["id"], MERGED_ORDER, segment_rows)
    return running.scan(cut, _until=running.running_max(F.col("_deadline"))).filter(
        (F.col("_kind") == READING) & (F.col("timestamp") < F.col("_until"))).select(*columns)


def threshold_alerts(readings: DataFrame, thresholds: DataFrame, *,
                     broadcast_rows: int = BROADCAST_ROWS,
                     segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Readings that differ from the sensor's previous one by more than its threshold.

    A threshold row (id, timestamp, seq, threshold) replaces the earlier one; 0.0
    removes it. Sensors without any threshold never alert, so their readings are
    left out before the shuffle. The first reading is compared with 0.0.
    """
    watched = broadcast_if_small(thresholds.select("id").distinct(), broadcast_rows)
    control = thresholds.select("id", "timestamp", "seq", "threshold")
    cut = segments.by_key(_merged(control, readings.join(watched, "id", "left_semi")),
                          ["id"], MERGED_ORDER, segment_rows)
    scanned = running.scan(
        cut, _threshold=running.latest(F.col("threshold")),
        _last=running.latest(F.col("temperature"), include_current=False))
    diff = F.abs(F.col("temperature") - F.coalesce("_last", F.lit(0.0)))
    return scanned.withColumn("diff", diff).filter(
        (F.col("_kind") == READING) & (F.col("_threshold") != 0.0)
        & (F.col("diff") > F.col("_threshold"))).select(
        "id", "timestamp", "temperature", "diff")
