"""Record-at-a-time operators. All are narrow and work on batches and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge import texts
from tidegauge.functions import celsius, id_parts, reading_line, without_trailing_empty
from tidegauge.model import with_event_time
from tidegauge.plans.spread import spread


def to_celsius(readings: DataFrame) -> DataFrame:
    return readings.withColumn("temperature", celsius("temperature"))


def project_id(readings: DataFrame) -> DataFrame:
    return readings.select("id")


def project_temperature(readings: DataFrame) -> DataFrame:
    return readings.select("id", "temperature")


def filter_temperature(readings: DataFrame, at_least: float = 25.0) -> DataFrame:
    return readings.filter(F.col("temperature") >= at_least)


def filter_contains(lines: DataFrame, needle: str, column: str = "text") -> DataFrame:
    """Rows whose text contains the needle, case-sensitive."""
    return lines.filter(F.col(column).contains(needle))


def filter_above(rows: DataFrame, column: str, bound: float) -> DataFrame:
    return rows.filter(F.col(column) > bound)


# A run of characters between words.
SEPARATORS = r"\W+"


def tokenize(lines: DataFrame, column: str = "text", keep: tuple[str, ...] = (), *,
             separators: str = SEPARATORS) -> DataFrame:
    """One row per word of the whole text, with the word's position.

    ``separators`` matches a run of separators. The text is split once, in a step
    of its own, since the expression behind it looks at the parts several times.
    """
    parts = spread(lines.select(*keep, column)).select(
        *keep, F.split(column, separators).alias("_parts"))
    return parts.select(
        *keep, F.posexplode(without_trailing_empty(F.col("_parts"))).alias("position", "word"))


def split_id(readings: DataFrame) -> DataFrame:
    """One row per part of the sensor id."""
    return readings.select(F.explode(id_parts("id")).alias("part"))


def increment(numbers: DataFrame, column: str, by: int = 1) -> DataFrame:
    return numbers.withColumn(column, F.col(column) + by)


def to_persons(rows: DataFrame, name: str = "name", age: str = "age") -> DataFrame:
    """Give positional columns the person record's names and types."""
    return rows.select(F.col(name).cast("string").alias("name"),
                       F.col(age).cast("int").alias("age"))


def shuffle_timestamps(readings: DataFrame, max_offset_ms: int = 7000,
                       scale: int = 1, step: int = 7919) -> DataFrame:
    """Move each timestamp forward by a pseudo-random offset to make disorder.

    The offset is a function of ``seq``, so a retried task repeats it.
    """
    offset = F.pmod(F.col("seq") * step, F.lit(max_offset_ms)) * scale
    return with_event_time(readings.withColumn("timestamp", F.col("timestamp") + offset))


def late_message(readings: DataFrame) -> DataFrame:
    return readings.withColumn("message", F.concat(F.lit(texts.LATE), F.col("id")))


def reading_lines(readings: DataFrame) -> DataFrame:
    return readings.select(reading_line().alias("value"))


def alert(text: Column, timestamp: Column | str = "timestamp") -> list[Column]:
    """Columns of an alert record."""
    at = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return [text.alias("message"), at.alias("timestamp")]
