"""File system calls the sinks make on the driver: names and renames, never data."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """A folder on any file system Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self) -> list[str]:
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at()))

    def numbered(self, prefix: str) -> list[int]:
        """Numbers of the entries called ``prefix<number>``."""
        return sorted(int(n.removeprefix(prefix)) for n in self.names() if n.startswith(prefix))

    def move_in(self, source: str, name: str) -> bool:
        """Rename a finished folder to its final name unless that is taken already.

        A rename that the file system refuses is an error: the caller must not go on as
        if the folder were in place.
        """
        if self.exists(name):
            return False
        self._fs.mkdirs(self._at())
        if not self._rename(source, name) and not self.exists(name):
            raise OSError(f"{source} could not be renamed to {self.path}/{name}")
        return True

    def _rename(self, source: str, name: str) -> bool:
        return self._fs.rename(self._hadoop.Path(source), self._at(name))

    def mark(self, name: str) -> None:
        """Create an empty file; a second attempt finds it in place."""
        if not self.exists(name):
            self._fs.create(self._at(name), False).close()

    def text(self, name: str) -> str:
        """Content of a small text file."""
        stream = self._fs.open(self._at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """Name of a query's run: the same after a restart, another with a new checkpoint, where
    batch ids begin anew. It is the id that Spark gives a query when it makes its checkpoint,
    so a checkpoint that was made again under the same path is another run too."""
    return json.loads(Folder(spark, checkpoint).text("metadata"))["id"].replace("-", "")


def per_run(spark: SparkSession, checkpoint: str, write: Callable) -> Callable:
    """``write(batch, batch_id, run)`` as a function of a micro-batch; the run is looked up
    when a batch comes, as the checkpoint is there by then."""
    return lambda batch, batch_id: write(batch, batch_id, run_name(spark, checkpoint))


def publish(df: DataFrame, folder: Folder, name: str, file_format: str = "parquet") -> bool:
    """Write ``df`` beside the folder's entries, then make it visible in one rename.

    Entries that start with a dot are invisible to readers. If the entry exists
    nothing is written; if the write fails the partial files are removed.
    """
    if folder.exists(name):
        return False
    staged = f".staged-{name}-{uuid.uuid4().hex}"
    try:
        df.write.format(file_format).save(f"{folder.path}/{staged}")
        return folder.move_in(f"{folder.path}/{staged}", name)
    finally:
        folder.remove(staged)
