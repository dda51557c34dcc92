"""Window bounds and time formats. Times leave the library as epoch milliseconds."""

from pyspark.sql import Column, functions as F


def end_ms(window: str = "window") -> Column:
    """End of a time window (exclusive) in epoch milliseconds."""
    return F.unix_millis(F.col(f"{window}.end"))


def end_iso(window: str = "window") -> Column:
    """End of a time window as ISO-8601 local date-time in whole seconds."""
    return F.date_format(F.col(f"{window}.end"), "yyyy-MM-dd'T'HH:mm:ss")


def floor_to(ms: Column | str, size_ms: int) -> Column:
    """Start of the epoch-aligned interval that holds an instant."""
    column = F.col(ms) if isinstance(ms, str) else ms
    return column - F.pmod(column, F.lit(size_ms))
