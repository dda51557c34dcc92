import pytest
from sensor_rows import SMALL, rows
from pyspark.sql import functions as F

from tidegauge.model import ALERT, LOCATION, MIN_MAX_TEMP, SWITCH, THRESHOLD
from tidegauge.sources import basic, connectors
from tidegauge.sources.sequence import id_sequence


def test_counter(spark):
    assert rows(basic.counter(spark, 3)) == [(0,), (1,), (2,)]


def test_schemas():
    assert ALERT.fieldNames() == ["message", "timestamp"]
    assert MIN_MAX_TEMP.fieldNames() == ["id", "min", "max", "endTs"]
    assert [s.fieldNames()[0] for s in (LOCATION, THRESHOLD, SWITCH)] == ["sensor", "id", "id"]


def test_text_monitor(spark, drain, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()
    (folder / "a.txt").write_text("one\ntwo é\n", encoding="utf-8")
    assert sorted(drain(basic.text_monitor(spark, str(folder)), checkpoint=state)) == [
        ("one",), ("two é",)]
    (folder / "b.txt").write_text("three\n")
    found = basic.text_monitor(spark, str(folder)).writeStream.foreachBatch(
        lambda batch, _: seen.extend(r.value for r in batch.collect()))
    seen = []
    query = found.option("checkpointLocation", str(tmp_path / "s2")).trigger(
        availableNow=True).start()
    assert query.awaitTermination(60) and sorted(seen) == ["one", "three", "two é"]
    assert rows(basic.text_lines(spark, str(folder))) == [("one",), ("three",), ("two é",)]


def test_id_sequence_replays_from_its_offset(spark, tmp_path):
    path, state, seen = str(tmp_path / "table"), str(tmp_path / "state"), []
    events = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", "value")
    events.filter("event_id >= 20 and event_id < 42").write.parquet(path)

    def run(fail=False):
        def take(batch, _):
            ids = [r.event_id for r in batch.collect()]
            if fail:
                raise ValueError("lost")
            seen.append(sorted(ids))
        query = id_sequence(spark, path, "event_id").writeStream.foreachBatch(
            take).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination(60)

    run()
    events.filter("event_id >= 42 and event_id < 100").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="lost"):
        run(fail=True)
    run()
    events.filter("event_id < 20").write.mode("append").parquet(path)
    run()
    assert seen == [list(range(20, 42)), list(range(42, 100)), list(range(20))]


def test_id_sequence_from_a_number(spark, drain, tmp_path):
    path = str(tmp_path / "table")
    spark.range(0, 95, 1, 3).toDF("n").write.parquet(path)
    found = drain(id_sequence(spark, path, "n", start=42, schema="n long", files_per_batch=1))
    assert sorted(found) == [(n,) for n in range(42, 95)]


def test_kafka_mapping(spark):
    options = connectors.kafka_options("host:9092", "topic", "group", 500)
    assert options == {"kafka.bootstrap.servers": "host:9092", "subscribe": "topic",
                       "kafka.group.id": "group", "maxOffsetsPerTrigger": "500"}
    raw = spark.range(1).select(
        F.lit(b"k").alias("key"), F.encode(F.lit("é"), "utf-8").alias("value"),
        F.lit("t").alias("topic"), F.lit(3).alias("partition"), F.lit(7).alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))
    assert rows(connectors.decode_messages(raw), "value", "partition", "offset") == [("é", 3, 7)]


def test_jdbc_mapping():
    assert "partitionColumn" not in connectors.jdbc_options("url", "t")
    options = connectors.jdbc_options("url", "t", split_by="n", bounds=(1, 80), partitions=4)
    assert options["numPartitions"] == "4" and options["upperBound"] == "80"
    with pytest.raises(ValueError):
        connectors.jdbc_options("url", "t", split_by="n")
