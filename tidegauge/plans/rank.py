"""One comparable column for an order of several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType


def rank(rows: DataFrame, order: Sequence[str]) -> Column:
    """A column that orders rows as ``order`` does.

    ``max_by`` keeps its rank in the aggregation buffer. A decimal fits into a hash
    aggregate, while a struct would make Spark sort its whole input first, so two
    integers are packed into one decimal: the second is below 2**63 in size, and
    2 * 10**19 exceeds the distance of any two such numbers.
    """
    if len(order) == 1:
        return F.col(order[0])
    whole = all(isinstance(rows.schema[name].dataType, (IntegerType, LongType)) for name in order)
    if len(order) != 2 or not whole:
        return F.struct(*order)
    major, minor = (F.col(name).cast("decimal(19,0)") for name in order)
    return major * F.lit("20000000000000000000").cast("decimal(20,0)") + minor
