"""Measured size bounds for the side of a join that is to be replicated."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegauge.session import has_at_most

# Rows of a control or lookup table that may be sent to every executor.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the row count is within the bound, else leave the choice
    to Spark, whose adaptive skew join splits hot keys."""
    return F.broadcast(df) if has_at_most(df, rows) else df
