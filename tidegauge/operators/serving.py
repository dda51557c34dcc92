"""Keyed results kept for reading: latest value per sensor, reports, dashboard line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegauge.functions import celsius
from tidegauge.operators.windows import max_temperature
from tidegauge.plans.rank import rank


def latest_per_key(rows: DataFrame, key: str, values: Sequence[str],
                   order: Sequence[str] = ("timestamp", "seq")) -> DataFrame:
    """Last row per key. The aggregate keeps one row per key and task before the shuffle.

    ``order`` is unique within a key, so all values come from the same row.
    """
    by = rank(rows, order)
    return rows.groupBy(key).agg(*[F.max_by(v, by).alias(v) for v in values])


def upsert_latest(readings: DataFrame) -> DataFrame:
    """Final state of the keyed temperature table, in Celsius: last reading per sensor."""
    return latest_per_key(
        readings.select(F.col("id").alias("sensor"), celsius("temperature").alias("temp"),
                        "timestamp", "seq"), "sensor", ["temp"])


def upsert_report(temperatures: DataFrame) -> DataFrame:
    """The keyed table in order of sensor."""
    return temperatures.orderBy("sensor")


def latest_window_max(readings: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Maximum of each sensor's latest window."""
    return max_temperature(readings, size).groupBy("id").agg(
        F.max("end_ts").alias("end_ts"), F.max_by("max_temp", "end_ts").alias("max_temp"))


def dashboard(maxima: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """One line with the maxima of the named sensors; ``-`` where there is none."""
    cells = [F.max(F.when(F.col("id") == s, F.col("max_temp"))).alias(f"s{i}")
             for i, s in enumerate(sensors)]
    shown = [F.when(F.col(f"s{i}").isNull(), F.lit("-"))
             .otherwise(F.format_string("%1.3f", f"s{i}")) for i in range(len(sensors))]
    return maxima.filter(F.col("id").isin(list(sensors))).agg(*cells).select(
        F.concat_ws("\t| ", *shown).alias("line"))
