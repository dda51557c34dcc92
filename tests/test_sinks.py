import os

import pytest
from pyspark.sql import functions as F
from sensor_rows import rows

from tidegauge.functions import celsius
from tidegauge.model import readings
from tidegauge.operators import lateness, serving, transforms, windows
from tidegauge.sinks import writers
from tidegauge.sinks.exactly_once import TransactionalFiles, WriteAhead
from tidegauge.sinks.folders import Folder, publish, run_name
from tidegauge.sinks.upsert import KeyedTable, insert_columns
from tidegauge.sources.basic import table_stream
from test_streaming import folder, stream, batch  # noqa: F401


def finish(writer):
    query = writer.trigger(availableNow=True).start()
    assert query.awaitTermination(120)


def fails(writer, text):
    with pytest.raises(Exception, match=text):
        finish(writer)


def test_text_and_parquet(spark, stream, batch, tmp_path):  # noqa: F811
    finish(writers.to_text(transforms.reading_lines(stream), f"{tmp_path}/t", f"{tmp_path}/ct"))
    assert rows(spark.read.text(f"{tmp_path}/t")) == rows(transforms.reading_lines(batch))
    average = windows.avg_temperature(lateness.watermark(stream, "0 seconds"), "20 hours", digits=6)
    finish(writers.to_parquet(average, f"{tmp_path}/p", f"{tmp_path}/cp"))
    stored = spark.read.parquet(f"{tmp_path}/p")
    end = batch.agg(F.max("timestamp")).first()[0]
    assert rows(stored) == rows(windows.avg_temperature(batch, "20 hours", digits=6).filter(
        F.col("end_ts") <= end))


def test_console_and_memory(spark, stream, batch):  # noqa: F811
    finish(writers.to_console(transforms.project_id(stream).limit(2)))
    finish(writers.to_memory(transforms.project_temperature(stream), "kept"))
    assert rows(spark.table("kept")) == rows(transforms.project_temperature(batch))


def test_messages(spark, batch):  # noqa: F811
    messages = writers.as_messages(batch, "temperature", "id")
    assert messages.dtypes == [("key", "string"), ("value", "string")]
    assert writers.as_messages(batch, "id").columns == ["value"]


def test_lines(stream, batch, tmp_path):  # noqa: F811
    class FileTarget:
        """One file per partition and micro-batch; a repeated attempt replaces it."""

        def __init__(self, path, partition_id, epoch_id):
            self.file = open(os.path.join(path, f"{epoch_id}-{partition_id}"), "w")

        def send(self, line):
            self.file.write(line)

        def close(self):
            self.file.close()

    out = str(tmp_path / "out")
    os.mkdir(out)
    finish(writers.to_lines(stream, lambda p, e: FileTarget(out, p, e)).option(
        "checkpointLocation", str(tmp_path / "c")))
    lines = sorted(line for name in os.listdir(out)
                   for line in open(os.path.join(out, name)).read().splitlines())
    assert lines == sorted(r.value for r in transforms.reading_lines(batch).collect())


def as_temperatures(df):
    return df.select(F.col("id").alias("sensor"), celsius("temperature").alias("temp"),
                     "timestamp", "seq")


@pytest.mark.parametrize("compact_every", [2, 20])
def test_upsert(spark, stream, batch, tmp_path, compact_every):  # noqa: F811
    table = KeyedTable(spark, str(tmp_path / "t"), "sensor", ["temp"],
                       compact_every=compact_every)
    finish(table.writer(as_temperatures(stream), str(tmp_path / "c")))
    assert rows(table.read()) == rows(serving.upsert_latest(batch))
    table.compact()
    assert rows(table.read()) == rows(serving.upsert_latest(batch))


def test_upsert_ignores_a_replay_and_keeps_the_last_write(spark, tmp_path):
    schema = "sensor string, temp double, timestamp long, seq long"
    table = KeyedTable(spark, str(tmp_path / "t"), "sensor", ["temp"])
    with pytest.raises(FileNotFoundError):
        table.read()
    first = spark.createDataFrame([("a", 1.0, 5, 0), ("b", 2.0, 5, 1), ("a", 3.0, 6, 2)], schema)
    second = spark.createDataFrame([("a", 9.0, 1, 3)], schema)
    table.upsert(first, 0)
    table.upsert(second, 1)
    table.upsert(first, 0)
    assert rows(table.read()) == [("a", 9.0), ("b", 2.0)]
    table.compact()
    table.upsert(second, 1)
    assert rows(table.read()) == [("a", 9.0), ("b", 2.0)]


def test_mapped_insert(spark, batch, tmp_path):  # noqa: F811
    mapped = insert_columns(batch, {"id": "sensorId", "temperature": "temperature",
                                    "timestamp": "timestamp", "seq": "seq"})
    table = KeyedTable(spark, str(tmp_path / "t"), "sensorId", ["temperature"])
    table.upsert(mapped, 0)
    assert table.read().columns == ["sensorId", "temperature"]
    assert table.read().count() == batch.select("id").distinct().count()


def test_transactional_files_survive_failures(spark, stream, batch, tmp_path):  # noqa: F811
    sink, state = TransactionalFiles(spark, str(tmp_path / "out")), str(tmp_path / "c")
    narrow = stream.select("seq", "temperature")

    def flaky(part, batch_id):
        if batch_id == 1:
            # A row in the middle of the write fails, as a broken mapper would.
            part = part.withColumn("temperature", F.when(
                F.col("seq") % 16 == 15, F.raise_error(F.lit("broken"))).otherwise(
                F.col("temperature")))
        sink.write(part, batch_id, run_name(spark, state))

    fails(narrow.writeStream.foreachBatch(flaky).option("checkpointLocation", state), "broken")
    assert sink.folder.names() == [f"batch={run_name(spark, state)}-0"]

    def late_failure(part, batch_id):
        sink.write(part, batch_id, run_name(spark, state))
        if batch_id == 1:
            raise RuntimeError("after commit")

    fails(narrow.writeStream.foreachBatch(late_failure).option("checkpointLocation", state),
          "after commit")
    finish(sink.writer(narrow, state))
    stored = spark.read.parquet(str(tmp_path / "out")).select("seq", "temperature")
    assert rows(stored) == rows(batch, "seq", "temperature")


def test_publish_is_all_or_nothing(spark, tmp_path):
    target = Folder(spark, str(tmp_path / "f"))
    assert target.names() == [] and publish(spark.range(3), target, "x1")
    assert not publish(spark.range(9), target, "x1")
    assert spark.read.parquet(str(tmp_path / "f" / "x1")).count() == 3
    assert target.numbered("x") == [1]


def test_write_ahead_commits_up_to_an_id(spark, tmp_path):
    sink = WriteAhead(spark, str(tmp_path), "sink", lambda df, n: None)
    assert sink.last_committed() == -1 and not sink.is_committed(0)
    sink.ledger.mark(f"{5:016x}")
    assert sink.is_committed(4) and sink.is_committed(5) and not sink.is_committed(6)


def test_write_ahead_survives_failures(spark, stream, batch, tmp_path):  # noqa: F811
    state, taken, failures = str(tmp_path / "c"), {}, {"before": 1, "after": 1}

    def emit(part, batch_id):
        if batch_id == 1 and failures["before"]:
            failures["before"] -= 1
            raise RuntimeError("target down")
        taken[batch_id] = [r.seq for r in part.collect()]

    sink = WriteAhead(spark, str(tmp_path / "wal"), "averages", emit)
    narrow = stream.select("seq", "temperature")
    fails(sink.writer(narrow, state), "target down")

    def after(part, batch_id):
        sink.write(part, batch_id, run_name(spark, state))
        if batch_id == 1 and failures["after"]:
            failures["after"] -= 1
            raise RuntimeError("after commit")

    fails(narrow.writeStream.foreachBatch(after).option("checkpointLocation", state),
          "after commit")
    emitted_before = dict(taken)
    finish(WriteAhead(spark, str(tmp_path / "wal"), "averages", emit).writer(narrow, state))
    assert emitted_before == {k: taken[k] for k in emitted_before}
    assert sorted(s for part in taken.values() for s in part) == [
        r[0] for r in rows(batch, "seq")]
    assert sink.last_committed(run_name(spark, state)) == 2


def test_a_refused_rename_is_an_error(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame([("a", 1.0, 5, 0)], UPSERTED)
    monkeypatch.setattr(Folder, "_rename", lambda *_: False)
    with pytest.raises(OSError, match="could not be renamed"):
        TransactionalFiles(spark, str(tmp_path / "f")).write(frame, 0)
    table = KeyedTable(spark, str(tmp_path / "t"), "sensor", ["temp"])
    with pytest.raises(OSError):
        table.upsert(frame, 0)
    monkeypatch.undo()
    table.upsert(frame, 0)
    monkeypatch.setattr(Folder, "_rename", lambda *_: False)
    with pytest.raises(OSError):
        table.compact()
    monkeypatch.undo()
    assert rows(table.read()) == [("a", 1.0)]


UPSERTED = "sensor string, temp double, timestamp long, seq long"


def test_a_new_checkpoint_is_a_new_run(spark, tmp_path):
    old, new = (spark.createDataFrame([("a", t, 5, 0)], UPSERTED) for t in (1.0, 2.0))
    files = TransactionalFiles(spark, str(tmp_path / "f"))
    for run, frame in (("r1", old), ("r1", old), ("r2", new)):
        files.write(frame, 0, run)
    assert spark.read.parquet(str(tmp_path / "f")).count() == 2
    seen = []
    ahead = WriteAhead(spark, str(tmp_path), "sink", lambda df, n: seen.append(n))
    for run, number in (("r1", 0), ("r1", 1), ("r1", 1), ("r2", 0), ("r2", 0)):
        ahead.write(old, number, run)
    assert seen == [0, 1, 0] and ahead.last_committed("r1") == 1
    table = KeyedTable(spark, str(tmp_path / "t"), "sensor", ["temp"])
    for number in range(3):
        table.upsert(old, number, "r1")
    table.compact()
    table.upsert(new, 0, "r2")
    table.upsert(old, 2, "r1")
    assert rows(table.read()) == [("a", 2.0)]


@pytest.mark.parametrize("step", ["mark", "remove"])
def test_a_crash_while_compacting_loses_nothing(spark, tmp_path, monkeypatch, step):
    table = KeyedTable(spark, str(tmp_path / "t"), "sensor", ["temp"])
    frames = [spark.createDataFrame([("a", float(i), 5, 0), (f"b{i}", 1.0, 5, 1)], UPSERTED)
              for i in range(3)]
    for number, frame in enumerate(frames[:2]):
        table.upsert(frame, number, "r")
    real = getattr(Folder, step)

    def crash(folder, name):
        if not name.startswith(".staged"):
            raise RuntimeError("crash")
        real(folder, name)

    monkeypatch.setattr(Folder, step, crash)
    with pytest.raises(RuntimeError):
        table.compact()
    monkeypatch.undo()
    table.upsert(frames[1], 1, "r")
    table.upsert(frames[2], 2, "r")
    table.compact()
    table.upsert(frames[0], 0, "r")
    assert rows(table.read()) == [("a", 2.0), ("b0", 1.0), ("b1", 1.0), ("b2", 1.0)]


def test_a_checkpoint_made_again_is_another_run(spark, tmp_path):
    """All rows arrive though the path of the checkpoint and the batch ids are the same."""
    schema, state = "sensor string, temp double, timestamp long, seq long", tmp_path / "c"
    table = KeyedTable(spark, str(tmp_path / "t"), "sensor", ["temp"])
    files, taken = TransactionalFiles(spark, str(tmp_path / "f")), []
    ahead = WriteAhead(spark, str(tmp_path / "w"), "s",
                       lambda df, n: taken.extend(r.sensor for r in df.collect()))
    for number in range(2):
        rows_ = [(f"run{number}-{i}", 1.0, number, i) for i in range(2 + number)]
        spark.createDataFrame(rows_, schema).write.parquet(f"{tmp_path}/in{number}")
        source = table_stream(spark, f"{tmp_path}/in{number}", schema)
        for sink in (table, files, ahead):
            checkpoint = str(state / type(sink).__name__)
            finish(sink.writer(source, checkpoint))
            finish(sink.writer(source, checkpoint))  # a restart repeats nothing
        state.rename(tmp_path / f"old{number}")
    want = ["run0-0", "run0-1", "run1-0", "run1-1", "run1-2"]
    assert sorted(taken) == want
    assert [r[0] for r in rows(table.read(), "sensor")] == want
    assert [r[0] for r in rows(spark.read.parquet(str(tmp_path / "f")), "sensor")] == want
