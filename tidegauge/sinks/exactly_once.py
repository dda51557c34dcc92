"""Output that survives failures: transactional files and a write-ahead log.

Spark replays a failed micro-batch under the same batch id and with the same input,
so it is enough that a batch id takes effect once in each run. A run is a query with its
checkpoint; a new checkpoint starts at batch 0 again and must not be taken for a replay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.sinks.folders import Folder, per_run, publish

BATCH = "batch="


class TransactionalFiles:
    """Each micro-batch becomes visible as one folder, wholly or not at all.

    The batch is written under a hidden name (begin, write), and renamed when it is
    complete (commit). A failure removes the hidden files (abort); committing again
    finds the folder in place. The rename must be atomic on the file system used.
    """

    def __init__(self, spark: SparkSession, path: str, file_format: str = "parquet"):
        self.folder, self.format = Folder(spark, path), file_format

    def write(self, batch: DataFrame, batch_id: int, run: str = "") -> None:
        """``run`` names the query's run, see ``run_name``."""
        publish(batch, self.folder, f"{BATCH}{run and run + '-'}{batch_id}", self.format)

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(
            per_run(self.folder.spark, checkpoint, self.write)).option(
            "checkpointLocation", checkpoint)


class WriteAhead:
    """Logs each micro-batch, emits it from the log, then records its id.

    ``sink_id`` names the record of committed ids and must not change between runs.
    A failure while emitting makes the batch be emitted again from the same log, so
    a target that is not idempotent can see rows twice, but never lose any.
    """

    def __init__(self, spark: SparkSession, path: str, sink_id: str,
                 emit: Callable[[DataFrame, int], None]):
        self.spark, self.emit = spark, emit
        self.log = Folder(spark, f"{path}/{sink_id}/log")
        self.ledger = Folder(spark, f"{path}/{sink_id}/committed")

    def _records(self, run: str) -> list[str]:
        return [name for name in self.ledger.names() if name.rpartition("-")[0] == run]

    def last_committed(self, run: str = "") -> int:
        """Greatest committed batch id of a run, -1 if there is none. Ids are kept in hex."""
        return max((int(name.rpartition("-")[2], 16) for name in self._records(run)), default=-1)

    def is_committed(self, batch_id: int, run: str = "") -> bool:
        return batch_id <= self.last_committed(run)

    def write(self, batch: DataFrame, batch_id: int, run: str = "") -> None:
        if self.is_committed(batch_id, run):
            return
        prefix = f"{BATCH}{run and run + '-'}"
        publish(batch, self.log, f"{prefix}{batch_id}")
        self.emit(self.spark.read.schema(batch.schema).parquet(
            f"{self.log.path}/{prefix}{batch_id}"), batch_id)
        self.ledger.mark(f"{run and run + '-'}{batch_id:016x}")
        # Only a run's latest record counts; older ones and their log entries may go.
        for name in self._records(run)[:-1]:
            self.ledger.remove(name)
        for name in self.log.names():
            number = name.removeprefix(prefix)
            if name.startswith(prefix) and number.isdigit() and int(number) < batch_id:
                self.log.remove(name)

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(
            per_run(self.spark, checkpoint, self.write)).option(
            "checkpointLocation", checkpoint)
