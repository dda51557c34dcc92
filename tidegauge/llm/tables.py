"""Reading inputs and keeping intermediate tables where every executor sees them."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder that driver and executors share."""
    return (f"{shared_folder(spark)}/tidegauge/{spark.sparkContext.applicationId}/"
            f"{label}-{uuid.uuid4().hex}")


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lost executors cost one task,
    not the steps before, and later steps read only the columns they use."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    table_ = df.sparkSession.read.schema(df.schema).parquet(path)
    table_._kept_at = path
    return table_


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``kept`` that no later step reads, and let go of the shuffle files of
    the steps that are done: Spark removes them once the JVM has collected their handles."""
    spark = tables[0].sparkSession
    for one in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(one._kept_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


# Seconds until the JVM has been told what Python no longer holds.
TOLD = 1.2


def let_go(spark: SparkSession) -> None:
    """Let go of the shuffle files of the steps that are done before the next one begins."""
    gc.collect()
    time.sleep(TOLD)
    spark._jvm.System.gc()


def public_vocabulary(name: str) -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / "tidegauge_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


# Rows of a few numbers each that may be sent to every executor.
SMALL_ROWS = 500_000


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint when ``df``, narrow rows of numbers, has at most that many; else a
    shuffled join, whose skew adaptive execution splits."""
    return F.broadcast(df) if df.count() <= rows else df.hint("merge")
