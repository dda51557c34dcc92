"""Small inputs with results worked out by hand."""

import pytest
from sensor_rows import rows
from pyspark.sql import functions as F

from tidegauge.model import SMOKE_LEVEL, WORD_COUNT, PERSON, with_event_time
from tidegauge.operators import (alerts, control, lateness, lookup, partitioning, rolling,
                                 serving, transforms, windows)
from tidegauge.sources import basic

SWITCH_ROWS = "id string, duration_ms long, timestamp long, seq long"
THRESHOLD_ROWS = "id string, threshold double, timestamp long, seq long"
LEVEL_ROWS = "timestamp long, seq long, level string"


def test_rolling_sum(spark):
    data = basic.literal(spark, [(1, 2, 2, 0), (2, 3, 1, 1), (2, 2, 4, 2), (1, 5, 3, 3)],
                         "a int, b int, c int, seq int")
    out = rolling.rolling_sum(data, "a", "b", ["c"], order=["seq"])
    assert rows(out, "seq", "a", "rolling_b", "first_c") == [
        (0, 1, 2, 2), (1, 2, 3, 1), (2, 2, 5, 1), (3, 1, 7, 2)]


@pytest.mark.parametrize("size", [1, 100])
def test_rolling_concat(spark, size):
    data = basic.literal(spark, [("en", ["tea"], 0), ("fr", ["vin"], 1), ("en", ["cake"], 2)],
                         "lang string, words array<string>, seq int")
    out = rolling.rolling_concat(data, "lang", "words", order=["seq"], segment_rows=size)
    assert [(r.seq, r.rolling_words) for r in out.orderBy("seq").collect()] == [
        (0, ["tea"]), (1, ["vin"]), (2, ["tea", "cake"])]


def test_word_count(spark):
    lines = basic.literal(spark, [(0, "Big data is big."), (1, "Is data, data?")],
                          "line long, text string")
    counted = rolling.word_count(lines)
    assert counted.columns == WORD_COUNT.fieldNames()
    assert dict(rows(counted)) == {"Big": 1, "big": 1, "data": 3, "is": 1, "Is": 1}
    rolled = rolling.rolling_word_count(lines, "line")
    assert [r[3] for r in rows(rolled, "line", "position", "word", "count")
            if r[2] == "data"] == [1, 2, 3]


@pytest.mark.parametrize("line, words", [
    ("", [""]), ("a b", ["a", "b"]), (" a", ["", "a"]), ("a. ", ["a"]), ("...", []),
    ("café", ["caf"]), ("a\nb", ["a", "b"])])
def test_tokens_keep_leading_but_not_trailing_empties(spark, line, words):
    out = transforms.tokenize(basic.literal(spark, [(line,)], "text string"))
    assert [r.word for r in out.orderBy("position").collect()] == words


def test_split_id(spark):
    data = basic.literal(spark, [("sensor_12",), ("a__b__",)], "id string")
    assert [r.part for r in transforms.split_id(data).collect()] == [
        "sensor", "12", "a", "", "b"]


def test_small_transforms(spark, make):
    numbers = transforms.increment(basic.counter(spark, 5, 1), "id")
    assert rows(numbers) == [(2,), (3,), (4,), (5,), (6,)]
    people = basic.literal(spark, [("Adama", 17), ("Sarah", 23)], "name string, age long")
    persons = transforms.to_persons(people)
    assert [(f.name, f.dataType) for f in persons.schema] == [
        (f.name, f.dataType) for f in PERSON]
    assert rows(transforms.filter_above(persons, "age", 18)) == [("Sarah", 23)]
    readings = make([(0, 24.9), (1, 25.0)])
    assert rows(transforms.filter_temperature(readings), "timestamp") == [(1,)]
    assert rows(transforms.filter_temperature(readings, 24.0), "timestamp") == [(0,), (1,)]
    assert rows(transforms.reading_lines(readings)) == [("(s1, 0, 24.9)",), ("(s1, 1, 25.0)",)]


def test_partitioner(spark):
    data = spark.createDataFrame([(n,) for n in (-1, 2, 3, -4, -6, 5)], "n long")
    placed = partitioning.partition_custom(data, "n", 4).collect()
    assert {r.partition for r in placed if r.n < 0} == {0}
    assert all(0 <= r.partition < 4 for r in placed) and len(placed) == 6
    assert partitioning.by_key(data, "n", partitions=3).rdd.getNumPartitions() == 3
    assert [r.n for r in partitioning.in_order(data, "n").collect()] == [-6, -4, -1, 2, 3, 5]


def test_switches(spark, make):
    switches = basic.literal(spark, [("sensor_2", 10_000, 1_000, 0),
                                     ("sensor_7", 60_000, 1_000, 1)], SWITCH_ROWS)
    readings = make([("sensor_2", 999, 1), ("sensor_2", 1_000, 2), ("sensor_2", 10_999, 3),
                     ("sensor_2", 11_000, 4), ("sensor_7", 60_999, 5), ("sensor_1", 2_000, 6)])
    for bound in (100, 0):
        out = control.switch_filter(readings, switches, broadcast_rows=bound)
        assert [r[0] for r in rows(out, "temperature")] == [2.0, 3.0, 5.0]


def test_thresholds(spark, make):
    limits = basic.literal(spark, [("s1", 5.0, 0, 0), ("s2", 0.9, 0, 1), ("s3", 0.5, 0, 2),
                                   ("s1", 1.2, 50, 3), ("s3", 0.0, 50, 4)], THRESHOLD_ROWS)
    readings = make([("s1", 10, 4), ("s1", 20, 10), ("s1", 60, 12), ("s3", 40, 1), ("s3", 60, 9),
                     ("s2", 10, 0.5), ("s2", 70, 1.5), ("s9", 10, 99)])
    for size in (1, 100):
        out = control.threshold_alerts(readings, limits, segment_rows=size)
        assert rows(out, "id", "timestamp", "diff") == [
            ("s1", 20, 6.0), ("s1", 60, 2.0), ("s2", 70, 1.0), ("s3", 40, 1.0)]


def test_locations(spark, make):
    rooms = spark.range(1, 80).select(F.concat(F.lit("sensor_"), "id").alias("sensor"),
                                      F.concat(F.lit("room_"), F.col("id") % 10).alias("room"))
    readings = make([(f"sensor_{i}", i, 0) for i in (0, 1, 79, 80)])
    for bound in (100, 5):
        out = lookup.with_location(readings, rooms, broadcast_rows=bound)
        assert rows(out, "timestamp", "room") == [
            (0, "UNKNOWN ROOM"), (1, "room_1"), (79, "room_9"), (80, "UNKNOWN ROOM")]


def test_service_lookup(make):
    def connect():
        known = {"a": "room_1"}
        return lambda sensor: known.get(sensor)

    readings = make([("a", 0, 1), ("b", 1, 1), ("a", 2, 1)])
    out = lookup.from_service(readings, connect, capacity=2)
    assert [r.room for r in out.collect()] == ["room_1", "UNKNOWN ROOM", "room_1"]


def test_assigned_windows(make):
    readings = make([(-1, 1), (0, 1), (29_999, 1), (30_000, 1)])
    out = windows.assign(readings, 30_000)
    assert rows(out, "timestamp", "start_ts", "end_ts") == [
        (-1, -30_000, 0), (0, 0, 30_000), (29_999, 0, 30_000), (30_000, 30_000, 60_000)]
    assert rows(windows.assign(readings, 30_000, 10_000), "start_ts") == [
        (-20_000,), (-20_000,), (10_000,), (10_000,)]


def test_temperature_changes(make):
    out = alerts.temperature_changes(make([(0, 1.0), (1, 2.0), (2, 4.0), (3, 2.4)]))
    assert rows(out, "temperature", "diff") == [(4.0, 2.0)]


def test_self_cleaning_changes(make):
    out = alerts.self_cleaning_changes(make([(0, 70.0), (1_000, 70.5), (3_700_000, 71.0)]))
    assert rows(out, "timestamp", "diff") == [(0, 70.0), (3_700_000, 71.0)]


@pytest.mark.parametrize("size", [1, 2, 100])
@pytest.mark.parametrize("pairs, due", [
    ([(0, 10), (100, 11), (200, 11), (300, 12), (1200, 13)], [1100, 2200]),
    ([(0, 10), (100, 11), (500, 9), (2000, 9)], []),
    ([(0, 10), (100, 11), (1100, 9)], [1100]),
    ([(0, 0), (100, 11), (200, 12)], [1200]),
])
def test_rising_alerts(make, pairs, due, size):
    out = alerts.rising_alerts(make(pairs), segment_rows=size)
    assert [r[0] for r in rows(out, "timestamp")] == due


def test_high_counts(make):
    out = rolling.high_temperature_key_count(make([(0, 9), (1, 11), (2, 10), (3, 12)]))
    assert rows(out, "timestamp", "key_count") == [(1, 0), (3, 1)]
    both = rolling.high_temperature_both_counts(
        make([("a", 0, 20), ("b", 1, 20), ("a", 2, 20)]), F.lit(0))
    assert rows(both, "timestamp", "key_count", "bucket_count") == [(0, 0, 1), (1, 0, 2), (2, 1, 3)]


@pytest.mark.parametrize("size", [1, 100])
def test_rolling_max_takes_the_later_of_equals(make, size):
    out = rolling.rolling_max_reading(make([(0, 5.0), (1, 5.0), (2, 4.0)]), segment_rows=size)
    assert rows(out, "seq", "max_timestamp") == [(0, 0), (1, 1), (2, 1)]


def test_windows(make):
    readings = make([(0, 32), (4_999, 50), (5_000, 212)])
    average = rows(windows.avg_temperature(readings), "end_ts", "avg_temp")
    assert average == [(5_000, pytest.approx(5.0)), (10_000, pytest.approx(100.0))]
    assert rows(windows.avg_all(readings), "end_time") == [
        ("1970-01-01T00:00:01",), ("1970-01-01T00:00:05",), ("1970-01-01T00:00:06",)]
    assert rows(windows.min_max_temperature(readings)) == [
        ("s1", 5_000, 32.0, 50.0), ("s1", 10_000, 212.0, 212.0)]
    assert rows(windows.min_temperature(readings)) == [("s1", 15_000, 32.0)]
    assert rows(windows.max_temperature(readings)) == [("s1", 10_000, 212.0)]
    assert rows(windows.count_readings(readings)) == [("s1", 30_000, 3)]


def test_early_counts(make):
    out = rows(windows.early_counts(make([(500, 1), (1_500, 1), (2_500, 1)])),
               "eval_ts", "readings")
    assert out == [(t * 1_000, min(t, 3)) for t in range(1, 31)]


def test_early_counts_near_the_end(make):
    out = rows(windows.early_counts(make([(28_000, 1), (29_500, 1)])), "eval_ts", "readings")
    assert out == [(29_000, 1), (30_000, 2)]


def test_late_readings(make):
    arrivals = make([(10_000, 1), (16_000, 1), (10_500, 1), (12_000, 1)])
    on_time, late = lateness.split_late(arrivals)
    assert rows(late, "timestamp", "message") == [(10_500, "*** late reading ***s1")]
    assert rows(on_time, "timestamp") == [(10_000,), (12_000,), (16_000,)]


UPDATES = [(10_000, 1, "first"), (10_000, 2, "update"), (20_000, 1, "first"),
           (30_000, 1, "first")]


@pytest.mark.parametrize("size", [1, 100])
def test_late_updates(make, size):
    arrivals = make([(1_000, 1), (15_000, 1), (2_000, 1), (20_000, 1), (3_000, 1)])
    out = lateness.late_updates(arrivals, segment_rows=size)
    assert rows(out, "end_ts", "readings", "result") == UPDATES


def test_watermarks(make):
    arrivals = make([("sensor_2", 100_000, 1), ("sensor_1", 90_000, 1), ("sensor_2", 80_000, 1)])
    periodic = lateness.with_watermark_ms(arrivals, 60_000)
    assert [r[1] for r in rows(periodic, "seq", "watermark")] == [None, 40_000, 40_000]
    punctuated = lateness.with_watermark_ms(arrivals, 60_000, only=F.col("id") == "sensor_1")
    assert [r[1] for r in rows(punctuated, "seq", "watermark")] == [None, None, 30_000]


def test_freezing_alarms(make):
    out = lateness.freezing_alarms(make([(0, 31.9), (1, 32.0)], sensor="sensor_x"))
    assert rows(out) == [("sensor_x", 0, "Freezing Alarm forsensor_x")]


def test_fire_alerts(spark, make):
    levels = basic.literal(spark, [(10, 0, "HIGH"), (20, 1, "LOW")], LEVEL_ROWS)
    assert set(SMOKE_LEVEL.fieldNames()) <= set(levels.columns)
    readings = make([(5, 101.0), (10, 101.0), (15, 100.0), (19, 101.0), (20, 101.0)])
    for bound in (100, 0):
        out = control.fire_alerts(readings, levels, broadcast_rows=bound, segment_rows=2)
        assert rows(out) == [("Risk of fire! (s1, 10, 101.0)", 10),
                             ("Risk of fire! (s1, 19, 101.0)", 19)]


def test_level_without_end_and_repeated_levels(spark, make):
    levels = basic.literal(spark, [(10, 0, "LOW"), (20, 1, "HIGH"), (30, 2, "HIGH"),
                                   (40, 3, "HIGH"), (40, 4, "LOW"), (50, 5, "HIGH")], LEVEL_ROWS)
    readings = make([(t, 101.0) for t in (0, 15, 20, 39, 40, 49, 50, 5_000)])
    for bound in (100, 0):
        out = control.readings_at_level(readings, levels, broadcast_rows=bound)
        assert out.columns == ["id", "timestamp", "temperature", "seq"]
        assert rows(out, "timestamp") == [(20,), (39,), (50,), (5_000,)]


def test_no_control_means_no_alert(spark, make):
    empty = basic.literal(spark, [], LEVEL_ROWS)
    assert control.fire_alerts(make([(0, 101.0)]), empty).count() == 0


def test_dashboard_and_latest(spark, make):
    maxima = basic.literal(spark, [("sensor_1", 1.0), ("sensor_2", 2.5), ("sensor_4", 3.25),
                                   ("sensor_5", 4.0), ("sensor_9", 9.0)],
                           "id string, max_temp double")
    line = serving.dashboard(maxima, [f"sensor_{i}" for i in range(1, 6)])
    assert rows(line) == [("1.000\t| 2.500\t| -\t| 3.250\t| 4.000",)]
    readings = make([(0, 50), (9_000, 60), (12_000, 41), (12_000, 32)])
    assert rows(serving.latest_window_max(readings)) == [("s1", 20_000, 41.0)]
    assert rows(serving.upsert_report(serving.upsert_latest(readings))) == [("s1", 0.0)]


def test_event_time_column(make):
    assert with_event_time(make([(1_500, 1)])).select(
        F.date_format("ts", "ss.SSS")).first()[0] == "01.500"
