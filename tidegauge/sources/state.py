"""Reading the state of a streaming query from its checkpoint, without the query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegauge.model import epoch_ms


def stored_state(spark: SparkSession, checkpoint: str, operator: int = 0,
                 batch_id: int | None = None) -> DataFrame:
    """key, value and partition_id of everything an aggregate holds, as of its last finished
    micro-batch or an earlier one that the checkpoint still has."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def stored_values(spark: SparkSession, checkpoint: str, name: str = "state",
                  operator: int = 0) -> DataFrame:
    """key and value of the state variable ``name`` of a processor with own state."""
    return spark.read.format("statestore").option("operatorId", operator).option(
        "stateVarName", name).load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, keys: tuple[str, ...] = ("id",),
                 operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """The windows that a windowed aggregate has not closed: keys, end_ts and the fields of
    its buffer (``max`` for a maximum, ``count`` for a count, ``sum`` and ``count`` for an
    average), as far as they have come.

    The query may be stopped or running; the store is read as files, key groups side by side.
    """
    rows = stored_state(spark, checkpoint, operator, batch_id)
    return rows.select(*(f"key.{k}" for k in keys), epoch_ms("key.window.end").alias("end_ts"),
                       "value.*")
