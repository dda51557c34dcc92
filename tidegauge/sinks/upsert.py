"""Idempotent keyed output: the last write per key wins.

A micro-batch is reduced to one row per key and added as a file set with the next number,
its run and its batch id, so its cost follows the batch and not the table, and a batch
replayed in its run changes nothing. ``compact`` folds the additions into one file set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.operators.serving import latest_per_key
from tidegauge.sinks.folders import Folder, per_run, publish

ADDED, FOLDED, DONE = "added=", "folded=", ".done="
BATCH = "_batch"


def insert_columns(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename columns to those of a target table, as an object mapping does."""
    return rows.select(*[F.col(source).alias(target) for source, target in columns.items()])


class KeyedTable:
    """A table with one current row per key, in a folder of Parquet file sets."""

    def __init__(self, spark: SparkSession, path: str, key: str, values: Sequence[str],
                 order: Sequence[str] = ("timestamp", "seq"), compact_every: int = 20):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.values, self.order = list(values), list(order)
        self.columns = list(dict.fromkeys([*values, *order]))
        self.compact_every = compact_every
        self.folder = Folder(spark, path)

    def upsert(self, rows: DataFrame, batch_id: int, run: str = "") -> None:
        """Apply one micro-batch; a batch that its run applied before is skipped."""
        if self._applied(batch_id, run):
            return
        last = latest_per_key(rows, self.key, self.columns, self.order)
        number = max([base for base, *_ in self._additions()] + self.folder.numbered(FOLDED),
                     default=-1) + 1
        publish(last.withColumn(BATCH, F.lit(number).cast("long")), self.folder,
                f"{ADDED}{number}.{run}.{batch_id}")
        if len(self._pending()) >= self.compact_every:
            self.compact()

    def _additions(self) -> list[tuple[int, str, int, str]]:
        """(number, run, batch id, name) of the added file sets in order."""
        names = [n for n in self.folder.names() if n.startswith(ADDED)]
        parts = [(*n.removeprefix(ADDED).split("."), n) for n in names]
        return sorted((int(number), run, int(batch), name) for number, run, batch, name in parts)

    def _applied(self, batch_id: int, run: str) -> bool:
        done = [n.removeprefix(f"{DONE}{run}.") for n in self.folder.names()
                if n.startswith(f"{DONE}{run}.")]
        return (any(batch_id <= int(n) for n in done)
                or any((run, batch_id) == (r, b) for _, r, b, _ in self._additions()))

    def _pending(self) -> list[tuple[int, str, int, str]]:
        base = max(self.folder.numbered(FOLDED), default=-1)
        return [a for a in self._additions() if a[0] > base]

    def _all_rows(self) -> DataFrame | None:
        parts = [f"{self.path}/{FOLDED}{n}" for n in self.folder.numbered(FOLDED)[-1:]]
        parts += [f"{self.path}/{name}" for *_, name in self._pending()]
        return self.spark.read.parquet(*parts) if parts else None

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.key, [*self.columns, BATCH], [BATCH, *self.order])

    def compact(self) -> None:
        """Fold all additions into one file set, then drop what it replaces.

        The fold is in place and each run's last batch is recorded before anything is
        removed; after a crash in between, the next call goes on from there. The former
        fold stays until the next one, for queries that still read it.
        """
        pending = self._pending()
        if pending:
            publish(self._latest(self._all_rows()), self.folder, f"{FOLDED}{pending[-1][0]}")
        folds = self.folder.numbered(FOLDED)
        folded = [a for a in self._additions() if folds and a[0] <= folds[-1]]
        last = {}
        for _, run, batch, _ in folded:
            last[run] = max(batch, last.get(run, -1))
        for run, batch in last.items():
            self.folder.mark(f"{DONE}{run}.{batch}")
        for name in [name for *_, name in folded] + [f"{FOLDED}{n}" for n in folds[:-2]]:
            self.folder.remove(name)
        for name in self.folder.names():
            run, _, batch = name.removeprefix(DONE).rpartition(".")
            if name.startswith(DONE) and int(batch) < last.get(run, -1):
                self.folder.remove(name)

    def read(self) -> DataFrame:
        """Current row per key."""
        rows = self._all_rows()
        if rows is None:
            raise FileNotFoundError(f"no batch has been written to {self.path}")
        return self._latest(rows).select(self.key, *self.values)

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(
            per_run(self.spark, checkpoint, self.upsert)).option(
            "checkpointLocation", checkpoint)
