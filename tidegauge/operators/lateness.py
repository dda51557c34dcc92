"""Watermarks, late readings and allowed lateness.

Batch forms follow the arrival order ``seq`` record by record: the watermark a
record meets is the greatest timestamp of strictly earlier arrivals minus the
delay. Spark's own streaming watermark moves once per micro-batch and its
aggregates drop late rows silently, so streams that must see late rows use
``streaming.processors`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge import texts
from tidegauge.operators import windows
from tidegauge.operators.transforms import late_message
from tidegauge.plans import running, segments
from tidegauge.plans.segments import SEGMENT_ROWS
from tidegauge.session import written


def watermark(readings: DataFrame, delay: str = "5 seconds") -> DataFrame:
    """Bounded out-of-orderness for streaming windows."""
    return readings.withWatermark("ts", delay)


def with_watermark_ms(readings: DataFrame, delay_ms: int = 5_000, *,
                      only: Column | None = None,
                      segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Add the watermark each record meets, null before any was set.

    With ``only``, a record moves the watermark just when it satisfies the
    condition (punctuated); otherwise every record may (periodic).
    """
    time = F.col("timestamp") if only is None else F.when(only, F.col("timestamp"))
    cut = segments.by_sequence(readings, "seq", segment_rows)
    marked = running.scan(cut, watermark=running.running_max(time, include_current=False))
    return marked.withColumn("watermark", F.col("watermark") - delay_ms)


def flag_late(readings: DataFrame, delay_ms: int = 5_000, *,
              segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    marked = with_watermark_ms(readings, delay_ms, segment_rows=segment_rows)
    return marked.withColumn(
        "late", F.coalesce(F.col("timestamp") < F.col("watermark"), F.lit(False)))


def split_late(readings: DataFrame, delay_ms: int = 5_000, *,
               segment_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(on-time readings, late readings with their message)."""
    flagged = flag_late(readings, delay_ms, segment_rows=segment_rows)
    columns = readings.columns
    on_time = flagged.filter(~F.col("late")).select(*columns)
    late = late_message(flagged.filter("late").select(*columns))
    return on_time, late


def _against_window(readings: DataFrame, size_ms: int, delay_ms: int, lateness_ms: int,
                    segment_rows: int) -> DataFrame:
    """Flag rows whose window had fired, and those whose window was gone.

    A window fires when the watermark reaches its last millisecond.
    """
    marked = with_watermark_ms(readings, delay_ms, segment_rows=segment_rows)
    placed = windows.assign(marked, size_ms)
    fired = F.col("watermark") >= F.col("end_ts") - 1
    gone = F.col("watermark") >= F.col("end_ts") - 1 + lateness_ms
    return placed.withColumns({"fired": F.coalesce(fired, F.lit(False)),
                               "gone": F.coalesce(gone, F.lit(False))})


def late_side_output(readings: DataFrame, size_ms: int = 10_000, delay_ms: int = 5_000, *,
                     segment_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(count per sensor and window of the rows in time, rows late for their window)."""
    placed = _against_window(readings, size_ms, delay_ms, 0, segment_rows)
    counts = placed.filter(~F.col("fired")).groupBy("id", "end_ts").agg(
        F.count(F.lit(1)).alias("readings"))
    late = late_message(placed.filter("fired").select(*readings.columns))
    return counts, late


def late_updates(readings: DataFrame, size_ms: int = 10_000, delay_ms: int = 5_000,
                 lateness_ms: int = 5_000, *,
                 segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Window counts, re-issued for each late row within the allowed lateness.

    ``first`` is the count when the window fires; each accepted late row adds an
    ``update``. A window with late rows only starts with its first late row. The
    rows in time are counted map-side; only accepted late rows are put in order. The
    placed rows are written once, as both steps start from them.
    """
    placed = written(
        _against_window(readings, size_ms, delay_ms, lateness_ms, segment_rows)
        .filter(~F.col("gone")).select("id", "end_ts", "seq", "fired"), "placed")
    in_time = placed.filter(~F.col("fired")).groupBy("id", "end_ts").agg(
        F.count(F.lit(1)).alias("readings"))
    accepted = placed.filter("fired").select("id", "end_ts", "seq")
    cut = segments.by_key(accepted, ["id", "end_ts"], ["seq"], segment_rows)
    numbered = running.scan(cut, _nth=running.running_count())
    updates = numbered.join(in_time, ["id", "end_ts"], "left").select(
        "id", "end_ts", (F.coalesce("readings", F.lit(0)) + F.col("_nth")).alias("readings"),
        F.when(F.col("readings").isNull() & (F.col("_nth") == 1), texts.FIRST_RESULT)
        .otherwise(texts.UPDATED_RESULT).alias("result"))
    first = in_time.select("id", "end_ts", "readings", F.lit(texts.FIRST_RESULT).alias("result"))
    return first.unionByName(updates)


def freezing_alarms(readings: DataFrame, below: float = 32.0) -> DataFrame:
    """Side output: one alarm per freezing reading. The main output is the input."""
    return readings.filter(F.col("temperature") < below).select(
        "id", "timestamp", F.concat(F.lit(texts.FREEZING), F.col("id")).alias("message"))
