"""Small and file-based sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType


def literal(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A bounded source of a few given rows."""
    return spark.createDataFrame(list(rows), schema)


def counter(spark: SparkSession, count: int, start: int = 0) -> DataFrame:
    """Numbers start, start + 1, ...; generated inside the tasks."""
    return spark.range(start, start + count)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def text_monitor(spark: SparkSession, path: str, *, files_per_batch: int = 10_000) -> DataFrame:
    """Lines of the files in a folder, including files that appear later."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def every(writer: DataStreamWriter, interval: str = "30 seconds") -> DataStreamWriter:
    """Look for new input at this interval."""
    return writer.trigger(processingTime=interval)


def table_stream(spark: SparkSession, path: str, schema: StructType | str, *,
                 files_per_batch: int = 1_000, pattern: str = "*") -> DataFrame:
    """A growing folder of Parquet files, or those whose name fits, as a stream."""
    return spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).parquet(path)
