"""Enrichment of readings from a table of sensors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tidegauge.plans.sizes import BROADCAST_ROWS, broadcast_if_small
from tidegauge.texts import UNKNOWN_ROOM


def with_location(readings: DataFrame, locations: DataFrame, *,
                  unknown: str = UNKNOWN_ROOM,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the room of each sensor. Works with a stream on the left as well.

    For a table that changes, call it in ``foreachBatch`` on a fresh read.
    """
    rooms = broadcast_if_small(locations.select(F.col("sensor").alias("id"), "room"),
                               broadcast_rows)
    return readings.join(rooms, "id", "left").withColumn(
        "room", F.coalesce("room", F.lit(unknown)))


def from_service(readings: DataFrame, connect: Callable[[], Callable[[str], str | None]], *,
                 unknown: str = UNKNOWN_ROOM, capacity: int = 100,
                 timeout_s: float = 5.0) -> DataFrame:
    """Add the room of each sensor from a service that answers one sensor at a time.

    Prefer ``with_location`` wherever the data can be read as a table. Each task
    calls ``connect`` once and asks for each sensor of an Arrow batch once, with at
    most ``capacity`` requests under way; a sensor without an answer is ``unknown``,
    and a request that takes too long fails the task. Rows keep their order.
    """
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = connect()
        with ThreadPoolExecutor(capacity) as pool:
            for batch in batches:
                asked = {s: pool.submit(ask, s) for s in batch["id"].unique()}
                rooms = {s: f.result(timeout=timeout_s) or unknown for s, f in asked.items()}
                yield batch.assign(room=batch["id"].map(rooms))

    schema = T.StructType([*readings.schema.fields, T.StructField("room", T.StringType())])
    return readings.mapInPandas(answer, schema)
