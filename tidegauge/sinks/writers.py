"""Sinks that map to a stream writer. The caller sets the trigger and starts it."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.operators.transforms import reading_lines


def to_console(stream: DataFrame, mode: str = "append") -> DataStreamWriter:
    return stream.writeStream.format("console").outputMode(mode)


def to_memory(stream: DataFrame, name: str, mode: str = "append") -> DataStreamWriter:
    """For tests: collects the output under a table name on the driver."""
    return stream.writeStream.format("memory").queryName(name).outputMode(mode)


def to_text(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """UTF-8 lines in files, each row exactly once. ``lines`` has one string column."""
    return lines.writeStream.format("text").option("checkpointLocation", checkpoint).option(
        "path", path).outputMode("append")


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Parquet files, each row exactly once."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option(
        "path", path).outputMode("append")


def as_messages(rows: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """Columns of a topic's messages."""
    columns = [F.col(value).cast("string").alias("value")]
    return rows.select(*([F.col(key).cast("string").alias("key")] if key else []), *columns)


def to_kafka(stream: DataFrame, value: str, servers: str, topic: str, checkpoint: str,
             key: str | None = None) -> DataStreamWriter:
    """Strings to a topic; the cluster must provide the connector."""
    return as_messages(stream, value, key).writeStream.format("kafka").options(**{
        "kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint})


class LineTarget(Protocol):
    """What a line writer sends to, opened once per partition and micro-batch."""

    def send(self, line: str) -> None: ...

    def close(self) -> None: ...


class LineWriter:
    """Sends each reading as one line to a target that ``connect`` opens in the task."""

    def __init__(self, connect: Callable[[int, int], LineTarget]):
        self.connect = connect
        self.target: LineTarget | None = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.target = self.connect(partition_id, epoch_id)
        return True

    def process(self, row: Row) -> None:
        self.target.send(row["value"] + "\n")

    def close(self, error: Exception | None) -> None:
        if self.target is not None:
            self.target.close()


def to_lines(readings: DataFrame, connect: Callable[[int, int], LineTarget]) -> DataStreamWriter:
    return reading_lines(readings).writeStream.foreach(LineWriter(connect))


def to_both(stream: DataFrame, main: Callable[[DataFrame, int], None],
            side: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Main and side output of one stream: each micro-batch is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            main(batch, batch_id)
            side(batch, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write)
