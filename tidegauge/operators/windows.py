"""Tumbling event-time windows.

Each aggregate is combined map-side before the shuffle on (id, window), so a hot
sensor costs one row per task and window. The same functions run on a stream
after ``lateness.watermark``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidegauge.functions import celsius, end_iso, end_ms, floor_to


def _aggregate(rows: DataFrame, size: str, keys: tuple[str, ...], **aggregates) -> DataFrame:
    grouped = rows.groupBy(*keys, F.window("ts", size))
    return grouped.agg(*[c.alias(n) for n, c in aggregates.items()]).select(
        *keys, end_ms().alias("end_ts"), *aggregates)


def assign(readings: DataFrame, size_ms: int, offset_ms: int = 0) -> DataFrame:
    """Add ``start_ts`` and ``end_ts`` of the tumbling window of each reading.

    Plain arithmetic, for windows that ``F.window`` does not offer; group by the two
    columns like by any other.
    """
    start = floor_to(F.col("timestamp") - offset_ms, size_ms) + offset_ms
    return readings.withColumns({"start_ts": start, "end_ts": start + size_ms})


def avg_temperature(readings: DataFrame, size: str = "5 seconds", *,
                    in_celsius: bool = True, digits: int | None = None) -> DataFrame:
    """Average per sensor and window, in Celsius unless told otherwise."""
    mean = F.avg(celsius("temperature") if in_celsius else F.col("temperature"))
    return _aggregate(readings, size, ("id",),
                      avg_temp=mean if digits is None else F.round(mean, digits))


def min_temperature(readings: DataFrame, size: str = "15 seconds") -> DataFrame:
    return _aggregate(readings, size, ("id",), min_temp=F.min("temperature"))


def max_temperature(readings: DataFrame, size: str = "10 seconds") -> DataFrame:
    return _aggregate(readings, size, ("id",), max_temp=F.max("temperature"))


def min_max_temperature(readings: DataFrame, size: str = "5 seconds") -> DataFrame:
    return _aggregate(readings, size, ("id",), min_temp=F.min("temperature"),
                      max_temp=F.max("temperature"))


def count_readings(readings: DataFrame, size: str = "30 seconds") -> DataFrame:
    return _aggregate(readings, size, ("id",), readings=F.count(F.lit(1)))


def avg_all(readings: DataFrame, size: str = "1 second", *,
            digits: int | None = None) -> DataFrame:
    """Average over all sensors per window, labelled with the ISO end of the window.

    Only one partial average per task and window crosses the network.
    """
    mean = F.avg("temperature")
    return readings.groupBy(F.window("ts", size)).agg(
        (mean if digits is None else F.round(mean, digits)).alias("avg_temp")).select(
        end_iso().alias("end_time"), "avg_temp")


def early_counts(readings: DataFrame, size_ms: int = 30_000,
                 every_ms: int = 1_000) -> DataFrame:
    """Running count of each (sensor, window), reported at every tick and at its end.

    Ticks are multiples of ``every_ms`` after the first reading and before the end
    of the window; the end gives the final count. A tick counts the readings
    before it. Readings are first counted per tick interval, so the ordered step
    sees at most ``size_ms / every_ms`` rows of any window.
    """
    slots = assign(readings, size_ms).groupBy(
        "id", "end_ts",
        (floor_to("timestamp", every_ms) + every_ms).alias("_tick"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    per_window = Window.partitionBy("id", "end_ts").orderBy("_tick")
    so_far = F.sum("_n").over(per_window.rowsBetween(Window.unboundedPreceding, 0))
    next_tick = F.lead("_tick").over(per_window)
    # A count holds from its tick up to the next tick interval that has readings.
    counted = slots.select("id", "end_ts", "_tick", so_far.alias("readings"),
                           next_tick.alias("_next"))
    last_tick = F.coalesce(F.col("_next") - every_ms, F.col("end_ts") - 1)
    inner = F.when(F.col("_tick") <= last_tick,
                   F.sequence("_tick", last_tick, F.lit(every_ms)))
    ticks = F.filter(inner, lambda t: t < F.col("end_ts"))
    final = F.when(F.col("_next").isNull(), F.array("end_ts")).otherwise(
        F.array().cast("array<bigint>"))
    evaluations = F.concat(F.coalesce(ticks, F.array().cast("array<bigint>")), final)
    return counted.select("id", "end_ts", F.explode(evaluations).alias("eval_ts"), "readings")
