"""Text splitting and the line format of a reading.

Splitting follows the JVM default: empty parts at the end are dropped, others are
kept, and an empty text is one empty part.
"""

from pyspark.sql import Column, functions as F


def without_trailing_empty(parts: Column) -> Column:
    """Words of a text split at runs of separators.

    Such a split has at most one empty part at each end; a text of separators only
    has just these two and no word. A single part is an empty text or a word.
    """
    size = F.size(parts)
    words = F.when((size == 2) & (F.element_at(parts, 1) == ""), F.slice(parts, 1, 0)).otherwise(
        F.slice(parts, F.lit(1), size - 1))
    return F.when((size > 1) & (F.element_at(parts, -1) == ""), words).otherwise(parts)


def id_parts(sensor: Column | str, separator: str = "_") -> Column:
    """Parts of a sensor id around a literal separator."""
    column = F.col(sensor) if isinstance(sensor, str) else sensor
    quoted = "\\Q" + separator + "\\E"
    stripped = F.regexp_replace(column, f"(?:{quoted})+\\z", "")
    return F.when((stripped == "") & (column != ""), F.array().cast("array<string>")).otherwise(
        F.split(stripped, quoted))


def reading_line() -> Column:
    """One text line per reading: ``(id, timestamp, temperature)``."""
    return F.concat(F.lit("("), F.col("id"), F.lit(", "), F.col("timestamp").cast("string"),
                    F.lit(", "), F.col("temperature").cast("string"), F.lit(")"))
