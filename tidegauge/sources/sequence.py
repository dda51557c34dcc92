"""A replayable sequence: the numbered rows of a growing folder of Parquet files.

The stream is Spark's file stream. Its offsets are files, stored with each micro-batch: a
failed micro-batch reads the same files again, a restarted query goes on behind the last
one, and a row counts whenever its file comes, however small its number is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidegauge.sources.basic import table_stream


def id_sequence(spark: SparkSession, path: str, id_column: str, *, start: int | None = None,
                schema: StructType | str | None = None,
                files_per_batch: int = 1_000) -> DataFrame:
    """Stream the rows of the folder, from the number ``start`` on if one is given."""
    columns = spark.read.parquet(path).schema if schema is None else schema
    rows = table_stream(spark, path, columns, files_per_batch=files_per_batch)
    return rows if start is None else rows.filter(F.col(id_column) >= start)
