import itertools
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensor_rows import SMALL  # noqa: E402

from tidegauge.model import READING, with_event_time  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet")


@pytest.fixture
def make(spark):
    """Readings from (timestamp, temperature) pairs of one sensor, or full tuples."""
    def build(rows, sensor="s1"):
        full = [(sensor, r[0], float(r[1]), i) if len(r) == 2 else
                (r[0], r[1], float(r[2]), i) for i, r in enumerate(rows)]
        return with_event_time(spark.createDataFrame(full, READING))
    return build


_names = itertools.count()


@pytest.fixture
def drain(tmp_path):
    """Run a streaming frame to the end of its input and return its output rows."""
    def run(stream, mode="append", checkpoint=None):
        name = f"drained_{next(_names)}"
        query = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
                 .option("checkpointLocation", checkpoint or str(tmp_path / name))
                 .trigger(availableNow=True).start())
        assert query.awaitTermination(180)
        return [tuple(r) for r in stream.sparkSession.table(name).collect()]
    return run
