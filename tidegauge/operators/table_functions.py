"""Rows made from a row by a function of one's own, for what built-ins cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F


def flat_map(rows: DataFrame, function: Callable[..., Iterable[tuple]], returns: str,
             *columns: str) -> DataFrame:
    """Each row beside the rows that ``function`` makes of its ``columns``.

    ``returns`` is the schema of what the function yields; rows for which it yields nothing are
    left out. A table function in a lateral join: rows travel to Python in Arrow batches
    with the named columns only, nothing is shuffled, and streams take it as it is.
    """
    class Each:
        def eval(self, *values):
            yield from function(*values)

    made = F.udtf(Each, returnType=returns, useArrow=True)
    return rows.lateralJoin(made(*(F.col(c).outer() for c in columns)))
