"""Streaming forms against batch forms, on windows and keys the final watermark closes."""

import random

import pytest
from pyspark.sql import functions as F
from sensor_rows import rows

from tidegauge.model import READING, readings, smoke_control, with_event_time
from tidegauge.operators import (alerts, control, lateness, lookup, rolling, serving,
                                 transforms, windows)
from tidegauge.sinks import writers
from tidegauge.sources.basic import table_stream
from tidegauge.sources.state import open_windows, stored_values
from tidegauge.streaming import jobs
from tidegauge.streaming.processors import AtEnd, AtShares

SECOND = 14_400_000
FAR = 40 * 86_400_000
CONTROL_SWITCH = "id string, duration_ms long, timestamp long, seq long"
CONTROL_THRESHOLD = "id string, threshold double, timestamp long, seq long"


def in_parts(df, path, bounds, column="seq"):
    """Write ``df`` as one file per part so that each becomes one micro-batch."""
    for low, high in zip(bounds, bounds[1:]):
        df.filter((F.col(column) >= low) & (F.col(column) < high)).coalesce(1).write.mode(
            "append").parquet(path)
    return path


@pytest.fixture(scope="module")
def folder(events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "parts")
    return in_parts(events, path, [0, 400, 800, 1_000], "event_id")


@pytest.fixture
def stream(spark, events, folder):
    return readings(table_stream(spark, folder, events.schema, files_per_batch=1))


@pytest.fixture
def batch(events):
    return readings(events)


def newest(batch):
    return batch.agg(F.max("timestamp")).first()[0]


PER_RECORD = {
    "celsius": (transforms.to_celsius, transforms.to_celsius),
    "filter": (transforms.filter_temperature, transforms.filter_temperature),
    "freezing": (lateness.freezing_alarms, lateness.freezing_alarms),
    "rolling max": (jobs.rolling_max_reading, rolling.rolling_max_reading),
    "key count": (jobs.high_temperature_key_count, rolling.high_temperature_key_count),
    "changes": (jobs.temperature_changes, alerts.temperature_changes),
    "cleaning": (lambda s: jobs.self_cleaning_changes(s, 1.5, 86_400_000, 0),
                 lambda b: alerts.self_cleaning_changes(b, 1.5, 86_400_000, 0)),
}


@pytest.mark.parametrize("name", list(PER_RECORD))
def test_per_record(stream, batch, drain, name):
    live, whole = (make(df) for make, df in zip(PER_RECORD[name], (stream, batch)))
    if "ts" in live.columns:
        live, whole = live.drop("ts"), whole.drop("ts")
    assert sorted(drain(live)) == rows(whole)


def test_rolling_sum(stream, batch, drain):
    whole = rolling.rolling_sum(batch.drop("ts"), "id", "temperature", ["timestamp"])
    live = sorted(drain(jobs.rolling_sum(stream)))
    expected = rows(whole, "id", "seq", "first_timestamp", "rolling_temperature")
    assert [r[:3] for r in live] == [r[:3] for r in expected]
    assert [r[3] for r in live] == pytest.approx([r[3] for r in expected])


def resumed(stream, folder):
    """Run to the end of the input, going on from the folder's checkpoint."""
    query = (stream.writeStream.format("parquet").option("path", f"{folder}/rows")
             .option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).start())
    assert query.awaitTermination(180)
    return stream.sparkSession.read.parquet(f"{folder}/rows")


def third():
    """Three buckets for the readings; a third of all rows in each."""
    return F.pmod(F.crc32("id"), F.lit(3))


@pytest.mark.parametrize("slot_ms,shards", [(1_000, 32), (SECOND, 2), (FAR * 100, 4), (1, 1)])
def test_bucket_counts(stream, batch, drain, slot_ms, shards):
    live = drain(jobs.high_temperature_both_counts(stream, third(), 10.0, slot_ms, shards).select(
        "id", "timestamp", "seq", "key_count", "bucket_count"))
    assert sorted(live) == rows(rolling.high_temperature_both_counts(batch, third()))


def test_bucket_count_goes_on_after_a_restart(spark, events, batch, tmp_path):
    path = str(tmp_path / "parts")
    whole = rolling.high_temperature_bucket_count(batch, third()).select(
        "id", "seq", "bucket", "bucket_count")
    for bounds in ([0, 300], [300, 301, 1_000]):
        in_parts(events, path, bounds, "event_id")
        given = readings(table_stream(spark, path, events.schema, files_per_batch=1))
        live = resumed(jobs.high_temperature_bucket_count(given, third(), slot_ms=SECOND), tmp_path)
    assert rows(live, "id", "seq", "bucket", "bucket_count") == rows(whole)


def test_slots_of_a_hot_bucket_lie_in_many_parts(spark, batch):
    slots = batch.withColumn("slot", F.floor(F.col("timestamp") / SECOND)).select("slot").distinct()
    shards = F.pmod(F.xxhash64("slot"), F.lit(32))
    assert slots.select(shards).distinct().count() > 16


def test_a_bucket_of_no_number_counts_too(spark, make, drain, tmp_path):
    data = make([("a", 1, 20), ("b", 2, 30), ("a", 2_500, 40)])
    path = in_parts(data, str(tmp_path / "parts"), [0, 2, 3])
    live = table_stream(spark, path, data.schema, files_per_batch=1)
    none = F.when(F.col("id") == "b", 1)
    counted = jobs.high_temperature_bucket_count(live, none)
    assert sorted(drain(counted.select("seq", "bucket", "bucket_count"))) == [
        (0, None, 1), (1, 1, 1), (2, None, 2)]


def test_items_of_numbered_keys(spark, drain, tmp_path):
    lists = spark.createDataFrame([(None, 1, ["n"], 0), (2**60 + 1, 1, ["x", "y"], 1),
                                   (None, 2, ["m"], 2), (2**60 + 1, 2, ["z"], 3)],
                                  "k long, turn int, words array<string>, seq long")
    path = in_parts(lists, str(tmp_path / "parts"), [0, 2, 4])
    live = table_stream(spark, path, lists.schema, files_per_batch=1)
    assert set(drain(jobs.rolling_items(live, "k", "words", ["turn"]))) == {
        (None, 1, 0, 1), (2**60 + 1, 1, 0, 2), (None, 2, 1, 2), (2**60 + 1, 2, 2, 3)}


def test_rolling_items(spark, tmp_path):
    lists = spark.createDataFrame(
        [("a", 1, ["x", "y"], 0), ("b", 1, ["p"], 1), ("a", 2, None, 2), ("a", 3, [], 3),
         (None, 1, ["n"], 4), ("a", 4, ["z"], 5), ("b", 2, ["q", "r"], 6)],
        "k string, turn int, words array<string>, seq long")
    path = str(tmp_path / "parts")
    for bounds in ([0, 3], [3, 5, 7]):
        in_parts(lists, path, bounds)
        given = table_stream(spark, path, lists.schema, files_per_batch=1)
        live = resumed(jobs.rolling_items(given, "k", "words", ["turn"]), tmp_path)
    placed = rolling.rolling_items(lists, "k", "words", order=["turn"])
    columns = ("k", "turn", "item_from", "item_to")
    assert rows(live, *columns) == rows(placed, *columns)
    singles = rolling.items_before(placed, placed.select("k", "turn", "item_to"), "k", "words")
    joined = {}
    for r in singles.orderBy("position").collect():
        joined.setdefault((r.k, r.turn), []).append(r.item)
    concat = rolling.rolling_concat(lists.fillna("").withColumn(
        "words", F.coalesce("words", F.array().cast("array<string>"))), "k", "words", order=["turn"])
    whole = {(r.k or None, r.turn): r.rolling_words for r in concat.collect()}
    assert joined == whole
    tail = rolling.items_before(placed, placed.filter("k = 'a' AND turn = 4").select(
        "k", "item_to"), "k", "words", last=2)
    assert rows(tail, "position", "item") == [(1, "y"), (2, "z")]


WINDOWED = {
    "average": lambda df: windows.avg_temperature(df, f"{5 * SECOND // 1000} seconds", digits=6),
    "average 15": lambda df: windows.avg_temperature(
        df, f"{15 * SECOND // 1000} seconds", in_celsius=False, digits=6),
    "min": lambda df: windows.min_temperature(df, f"{15 * SECOND // 1000} seconds"),
    "min max": lambda df: windows.min_max_temperature(df, f"{5 * SECOND // 1000} seconds"),
    "max": lambda df: windows.max_temperature(df, f"{10 * SECOND // 1000} seconds"),
    "count": lambda df: windows.count_readings(df, f"{30 * SECOND // 1000} seconds"),
}


@pytest.mark.parametrize("name", list(WINDOWED))
def test_windows(stream, batch, drain, name):
    live = drain(WINDOWED[name](lateness.watermark(stream, f"{5 * SECOND // 1000} seconds")))
    closed = WINDOWED[name](batch).filter(F.col("end_ts") <= newest(batch) - 5 * SECOND)
    assert sorted(live) == rows(closed)


def test_window_over_all(stream, batch, drain):
    size = f"{SECOND // 1000} seconds"
    live = sorted(drain(windows.avg_all(lateness.watermark(stream, "0 seconds"), size, digits=6)))
    whole = rows(windows.avg_all(batch, size, digits=6))
    assert 0 < len(whole) - len(live) <= 1 and live == whole[:len(live)]


def test_early_counts(stream, batch, drain):
    live = drain(jobs.early_counts(stream, 30 * SECOND, SECOND, 0))
    closed = windows.early_counts(batch, 30 * SECOND, SECOND).filter(
        F.col("eval_ts") <= newest(batch))
    assert sorted(live) == rows(closed)


def test_rising(stream, batch, drain):
    live = drain(jobs.rising_alerts(stream, SECOND, 0))
    due = alerts.rising_alerts(batch, SECOND).filter(F.col("timestamp") <= newest(batch))
    assert sorted(live) == rows(due)


def test_switches(spark, stream, batch, drain, tmp_path):
    on = spark.createDataFrame([("sensor_2", 10 * SECOND, 1_704_067_200_000, 0),
                                ("sensor_7", 60 * SECOND, 1_704_067_200_000, 1),
                                ("sensor_7", 20 * SECOND, 1_704_067_300_000, 2)], CONTROL_SWITCH)
    path = in_parts(on, str(tmp_path / "on"), [0, 9])
    live = drain(jobs.switch_filter(stream, table_stream(spark, path, on.schema)))
    assert sorted(live) == rows(control.switch_filter(batch, on))


def test_thresholds(spark, stream, batch, drain, tmp_path):
    """The second update arrives with the micro-batch of its time."""
    late = batch.filter("seq = 410").first()["timestamp"]
    limits = spark.createDataFrame([("sensor_1", 5.0, 1_704_067_200_000, 0),
                                    ("sensor_3", 0.5, 1_704_067_200_000, 1),
                                    ("sensor_1", 1.2, late, 2), ("sensor_3", 0.0, late, 3)],
                                   CONTROL_THRESHOLD)
    path = in_parts(limits, str(tmp_path / "limits"), [0, 2, 4])
    updates = table_stream(spark, path, limits.schema, files_per_batch=1)
    assert sorted(drain(jobs.threshold_alerts(stream, updates, FAR))) == rows(
        control.threshold_alerts(batch, limits))


def test_late_updates_one_arrival_at_a_time(spark, drain, tmp_path):
    arrivals = spark.createDataFrame(
        [("s1", at, 1.0, i) for i, at in enumerate(
            (1_000, 15_000, 2_000, 20_000, 3_000, 60_000, 61_000))], READING)
    path = in_parts(arrivals, str(tmp_path / "arrivals"), list(range(8)))
    source = with_event_time(table_stream(spark, path, READING, files_per_batch=1))
    assert sorted(drain(jobs.late_updates(source))) == [
        ("s1", 10_000, 1, "first"), ("s1", 10_000, 2, "update"),
        ("s1", 20_000, 1, "first"), ("s1", 30_000, 1, "first")]


def arriving(spark, tmp_path, rows_, per_batch=1):
    """A stream that takes ``rows_`` (id, time, temperature) in that order."""
    full = spark.createDataFrame([(s, at, float(t), i) for i, (s, at, t) in enumerate(rows_)],
                                 READING)
    path = in_parts(full, str(tmp_path / "arriving"),
                    [*range(0, len(rows_), per_batch), len(rows_)])
    return full, with_event_time(table_stream(spark, path, READING, files_per_batch=1))


def shuffled(seed, count=40, spread=9_000):
    rng = random.Random(seed)
    return [(f"s{rng.randrange(2)}", 100_000 + max(0, i * 1_500 - rng.randrange(spread)),
             rng.randrange(1, 9)) for i in range(count)]


def watermarks(rows_, delay, per_batch):
    """The watermark each micro-batch meets, -1 while there is none."""
    now, high, out = -1, None, []
    for first in range(0, len(rows_), per_batch):
        out.append(now)
        times = [at for _, at, _ in rows_[first:first + per_batch]]
        high = max([*times, *([high] if high is not None else [])])
        now = max(now, high - delay)
    return out


def test_late_updates_accept_all_rows_of_open_windows(spark, drain, tmp_path):
    """A simulation by micro-batches; five and more of them, in random disorder."""
    rows_, size, delay, late, per = shuffled(2, spread=25_000), 10_000, 2_000, 3_000, 4
    rows_.append(("s9", 10 ** 6, 1))
    rows_ += [("s9", 2 * 10 ** 6, 1)] * 3
    _, source = arriving(spark, tmp_path, rows_, per)
    live = drain(jobs.late_updates(source, size, delay, late))
    counts, final = {}, {}
    for now, first in zip(watermarks(rows_, delay, per), range(0, len(rows_), per)):
        for s, at, _ in rows_[first:first + per]:
            end = at - at % size + size
            if now < end - 1 + late:
                counts[s, end] = counts.get((s, end), 0) + 1
    for s, end, n, _ in live:
        final[s, end] = max(n, final.get((s, end), 0))
    assert final == {k: n for k, n in counts.items() if k[1] < 1_500_000}


def test_early_counts_accept_all_rows_of_open_windows(spark, drain, tmp_path):
    rows_, size, delay, per = shuffled(3, spread=25_000), 30_000, 1_000, 4
    rows_ += [("s9", 10 ** 6, 1)] * 4
    _, source = arriving(spark, tmp_path, rows_, per)
    live = drain(jobs.early_counts(source, size, 10_000, delay))
    counts = {}
    for now, first in zip(watermarks(rows_, delay, per), range(0, len(rows_), per)):
        for s, at, _ in rows_[first:first + per]:
            end = at - at % size + size
            if end > now:
                counts[s, end] = counts.get((s, end), 0) + 1
    assert {(s, end): n for s, end, at, n in live if at == end} == {
        k: n for k, n in counts.items() if k[1] < 500_000}


def test_changes_and_switches_take_late_rows(spark, drain, tmp_path):
    rows_ = [("s1", 1_000, 1), ("s2", 90_000, 1), ("s1", 10_500, 9), ("s2", 99_000, 1),
             ("s1", 35_500, 9)]
    full, source = arriving(spark, tmp_path, rows_)
    live = drain(jobs.self_cleaning_changes(source, 1.5, 3_600_000, 0))
    assert [r[1] for r in live] == [10_500]
    on = spark.createDataFrame([("s1", 0, 0, 60_000), ("s2", 0, 1, 60_000)],
                               "id string, timestamp long, seq long, duration_ms long")
    switches = table_stream(spark, in_parts(on, str(tmp_path / "on"), [0, 9]), on.schema)
    passed = drain(jobs.switch_filter(source, switches))
    assert sorted(r[1] for r in passed) == [1_000, 10_500, 35_500]


def test_rising_waits_for_accepted_rows(spark, drain, tmp_path):
    rows_ = [("s1", 10_000, 1), ("s2", 60_000, 1), ("s1", 20_000, 2), ("s2", 70_000, 1),
             ("s2", 200_000, 1), ("s2", 300_000, 1)]
    full, source = arriving(spark, tmp_path, rows_)
    assert [(r[0], r[1]) for r in drain(jobs.rising_alerts(source, 1_000, 0, 100_000))] == [
        ("s1", 21_000)]


@pytest.mark.parametrize("size", [None, 10_000])
def test_late_side_loses_no_row(spark, drain, tmp_path, size):
    rows_ = shuffled(5)
    _, source = arriving(spark, tmp_path, rows_, 4)
    live = drain(jobs.late_side(source, 2_000, size))
    assert sorted(r[3] for r in live) == list(range(len(rows_)))
    want = {}
    for now, first in zip(watermarks(rows_, 2_000, 4), range(0, len(rows_), 4)):
        for i, (_, at, _) in enumerate(rows_[first:first + 4], first):
            want[i] = at < now if size is None else now >= at - at % size + size - 1
    assert {r[3]: r[4] for r in live} == want


def test_word_count_in_update_mode(spark, drain, tmp_path):
    lines = spark.createDataFrame([(0, "a b a"), (1, "b c")], "seq long, text string")
    path = in_parts(lines, str(tmp_path / "lines"), [0, 1, 2])
    source = table_stream(spark, path, lines.schema, files_per_batch=1)
    out = drain(rolling.word_count(source), mode="update")
    assert sorted(out) == [("a", 2), ("b", 1), ("b", 2), ("c", 1)]


def test_lookup(spark, stream, batch, drain):
    rooms = spark.createDataFrame([("sensor_1", "room_1")], "sensor string, room string")
    live = lookup.with_location(stream, rooms).select("id", "seq", "room")
    assert sorted(drain(live)) == rows(lookup.with_location(batch, rooms), "id", "seq", "room")


def test_lookup_in_a_changing_table(spark, stream, tmp_path):
    """Each micro-batch reads the version of the table it finds."""
    versions = [spark.createDataFrame([("sensor_1", f"room_{v}")], "sensor string, room string")
                for v in (1, 2, 3)]
    seen = {}

    def enrich(batch, batch_id):
        found = lookup.with_location(batch.filter("id = 'sensor_1'"), versions[batch_id])
        seen[batch_id] = {r.room for r in found.collect()}

    query = (stream.writeStream.foreachBatch(enrich).trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "c")).start())
    assert query.awaitTermination(120)
    assert seen == {0: {"room_1"}, 1: {"room_2"}, 2: {"room_3"}}


@pytest.mark.parametrize("parts", [[0, 400, 800, 1_000], [0, 700, 1_000]])
def test_fire_alerts_of_two_streams(spark, events, stream, batch, drain, tmp_path, parts):
    """Control files arrive in steps of their own; the clock is the readings'."""
    levels = smoke_control(events)
    path = in_parts(levels, str(tmp_path / "levels"), parts)
    control_stream = table_stream(spark, path, levels.schema, files_per_batch=1)
    live = drain(jobs.fire_alerts(stream, control_stream, 50.0, 20 * SECOND, copies=4))
    want = control.fire_alerts(batch, levels, 50.0).filter(
        F.col("timestamp") < newest(batch) - 20 * SECOND)
    assert sorted(live) == rows(want) and live


def test_fire_alerts_in_disorder_and_after_a_restart(spark, tmp_path):
    rng = random.Random(8)
    control_rows = [(1_000_000 + i * 3_000, i, rng.choice(["HIGH", "LOW"])) for i in range(40)]
    rows_ = [(f"s{rng.randrange(3)}", 1_000_000 + i * 700 - rng.randrange(9_000),
              rng.choice([90, 120, 150])) for i in range(150)]
    full = spark.createDataFrame([(s, at, float(t), i) for i, (s, at, t) in enumerate(rows_)],
                                 READING)
    shuffled_control = rng.sample(control_rows, len(control_rows))
    levels = spark.createDataFrame(
        [(*row, place // 10) for place, row in enumerate(shuffled_control)],
        "timestamp long, seq long, level string, place long")
    def drain(alerts):
        query = alerts.writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(
            str(tmp_path / "out"))
        assert query.awaitTermination(180)
        found = spark.read.schema(alerts.schema).parquet(str(tmp_path / "out"))
        return [tuple(r) for r in found.collect()]

    for half in (0, 1):  # the second half comes after a stop
        in_parts(full, str(tmp_path / "readings"), [75 * half, 75 * half + 40, 75 * half + 75])
        in_parts(levels, str(tmp_path / "levels"), [2 * half, 2 * half + 1, 2 * half + 2], "place")
        live = with_event_time(table_stream(spark, str(tmp_path / "readings"), READING,
                                            files_per_batch=1))
        control_stream = table_stream(spark, str(tmp_path / "levels"), levels.schema,
                                      files_per_batch=1).drop("place")
        # Nothing is decided before the last time: all control records count.
        assert drain(jobs.fire_alerts(live, control_stream, 100.0, 10 ** 6, copies=3)) == []
    last = spark.createDataFrame([("s9", 10 ** 8, 1_000.0, 999)], READING)
    last.coalesce(1).write.mode("append").parquet(str(tmp_path / "readings"))
    out = drain(jobs.fire_alerts(live, control_stream, 100.0, 10 ** 6, copies=3))
    assert sorted(out) == rows(control.fire_alerts(full, levels.drop("place"))) and out


def test_late_readings_find_the_level_of_their_time(spark, drain, tmp_path):
    rows_ = [("s1", 10_000, 150), ("s2", 90_000, 1_000), ("s1", 35_000, 150), ("s1", 45_000, 150),
             ("s2", 200_000, 1_000), ("s2", 300_000, 1_000)]
    _, source = arriving(spark, tmp_path, rows_)
    levels = spark.createDataFrame([(30_000, 0, "HIGH"), (40_000, 1, "LOW"), (80_000, 2, "HIGH")],
                                   "timestamp long, seq long, level string")
    path = in_parts(levels, str(tmp_path / "levels"), [0, 9])
    live = drain(jobs.fire_alerts(source, table_stream(spark, path, levels.schema), 100.0, 0,
                                  accepted_ms=100_000, copies=2))
    assert sorted(r[1] for r in live) == [35_000, 90_000, 200_000]


def punctuated():
    return F.col("id") == "s1"


@pytest.mark.parametrize("size", [None, 10_000])
def test_punctuated_watermark_one_arrival_at_a_time(spark, drain, tmp_path, size):
    """The stream meets the batch form's watermark, also while no marker comes for long."""
    rows_ = [("s0", at + 5_000, t) for _, at, t in shuffled(6, 2)] + shuffled(7, 8, 40_000) + [
        ("s0", 900_000 - i * 70_000, 1) for i in range(4)] + [
        ("s1", 400_000, 1), ("s0", 0, 1), ("s1", 390_000, 1), ("s0", 399_000, 1)]
    full, source = arriving(spark, tmp_path, rows_)
    live = drain(jobs.late_side(source, 2_000, size, only=punctuated()))
    batch = lateness.with_watermark_ms(with_event_time(full), 2_000, only=punctuated())
    met = {r.seq: r.watermark for r in batch.collect()}
    assert {r[3]: r[5] for r in live} == met and None in met.values()
    for _, at, _, seq, late, _ in live:
        last = at if size is None else at - at % size + size - 2
        assert late == (met[seq] is not None and last < met[seq])
    assert {r[4] for r in live} == {True, False}


def test_windows_closed_by_a_punctuated_watermark(spark, drain, tmp_path):
    rows_ = shuffled(9, 16, 20_000) + [("s1", 10 ** 6, 1), ("s0", 2 * 10 ** 6, 1), ("s0", 3, 1)]
    _, source = arriving(spark, tmp_path, rows_)
    live = drain(jobs.late_updates(source, 10_000, 2_000, 0, only=punctuated()))
    counts, now, high = {}, -1, 0
    for s, at, _ in rows_:
        end = at - at % 10_000 + 10_000
        if now < end - 1:
            counts[s, end] = counts.get((s, end), 0) + 1
        high = max(high, at if s == "s1" else 0)
        now = max(now, high - 2_000)
    assert {(r[0], r[1]): r[2] for r in live} == {
        k: n for k, n in counts.items() if k[1] - 1 <= now}


def test_late_side_keeps_readings_of_any_time(spark, drain, tmp_path):
    rows_ = [("s1", 1_704_067_200_000, 1), ("s1", 0, 1), ("s2", -5, 1),
             ("s1", 32_503_680_000_000, 1), ("s2", 1_704_067_200_000, 1)]
    _, source = arriving(spark, tmp_path, rows_)
    live = drain(jobs.late_side(source, 2_000))
    assert sorted((r[3], r[4]) for r in live) == [
        (0, False), (1, True), (2, True), (3, False), (4, True)]


def test_silent_keys_leave_no_state(spark, drain, tmp_path):
    rows_ = [("s1", 1_000, 5), ("s3", 2_000, 5), ("s2", 50_000, 5), ("s2", 90_000, 5),
             ("s1", 4_000, 9), ("s2", 95_000, 5)]
    _, source = arriving(spark, tmp_path, rows_)
    state = str(tmp_path / "c1")
    live = drain(jobs.self_cleaning_changes(source, 1.5, 20_000, 1_000), checkpoint=state)
    # Late rows still alert: against the reading before while that is known, else against 0.0.
    assert sorted(r[:2] for r in live) == [
        ("s1", 1_000), ("s1", 4_000), ("s2", 50_000), ("s2", 90_000), ("s3", 2_000)]
    kept = stored_values(spark, state).select("key.id").collect()
    assert {r.id for r in kept} == {"s2"}
    on = spark.createDataFrame([("s1", 0, 0, 60_000), ("s2", 0, 1, 500_000)],
                               "id string, timestamp long, seq long, duration_ms long")
    switches = table_stream(spark, in_parts(on, str(tmp_path / "on"), [0, 9]), on.schema)
    state = str(tmp_path / "c2")
    passed = drain(jobs.switch_filter(source, switches, 0, 10_000), checkpoint=state)
    assert sorted(r[1] for r in passed) == [1_000, 4_000, 50_000, 90_000, 95_000]
    kept = stored_values(spark, state).select("key.id").collect()
    assert {r.id for r in kept} == {"s2"}


def test_open_windows_of_a_stopped_stream(spark, stream, batch, drain, tmp_path):
    size, state = f"{10 * SECOND // 1000} seconds", str(tmp_path / "c")
    closed = drain(windows.max_temperature(
        lateness.watermark(stream, f"{20 * SECOND // 1000} seconds"), size), checkpoint=state)
    still = open_windows(spark, state).select("id", "end_ts", F.col("max").alias("max_temp"))
    whole = rows(windows.max_temperature(batch, size))
    assert sorted([*closed, *(tuple(r) for r in still.collect())]) == whole
    assert 0 < still.count() < len(whole)


def test_triggers_and_assigners(spark, drain, tmp_path):
    rows_ = shuffled(4, 40, 15_000) + [("s9", 10 ** 6, 1)] * 2 + [("s9", 2 * 10 ** 6, 1)]
    full, source = arriving(spark, tmp_path, rows_, 8)
    late = 20_000

    def want(end_of, times_of):
        out = []
        for s, at, _ in rows_:
            for end in end_of(at):
                for when in times_of(end):
                    out.append((s, end, when))
        keys = sorted(set(out))
        firsts = {}
        for s, at, _ in rows_:
            for end in end_of(at):
                firsts[s, end] = min(at, firsts.get((s, end), at))
        return [(s, end, when, sum(s == r[0] and end in end_of(r[1]) and (
            r[1] < when) for r in rows_)) for s, end, when in keys
            if when > firsts[s, end] and when <= 2 * 10 ** 6 - late]

    # Sliding windows: each reading is in two of them.
    size, slide = 20_000, 10_000
    ends = F.transform(F.array(F.lit(1), F.lit(2)),
                       lambda i: F.col("timestamp") - F.col("timestamp") % slide + i * slide)
    sliding = source.withColumn("end_ts", F.explode(ends))
    live = drain(jobs.window_counts(sliding, AtShares(size, 0.25, 0.5), late))
    assert sorted(live) == want(
        lambda at: [at - at % slide + slide, at - at % slide + 2 * slide],
        lambda end: [end - 15_000, end - 10_000, end])
    shifted = windows.assign(source, 30_000, 7_000)
    live = drain(jobs.window_counts(shifted, AtEnd(), late))
    assert sorted(live) == want(lambda at: [(at - 7_000) // 30_000 * 30_000 + 37_000],
                                lambda end: [end])


def test_a_long_window_keeps_one_timer(spark, drain, tmp_path):
    """A day in ticks of a second: every tick is reported once, with one timer at a time."""
    day = 86_400_000
    rows_ = [("s1", 5 * day + at, 1) for at in (10, 2_500, day - 1, 70_000)] + [
        ("s1", 7 * day, 1), ("s1", 7 * day + 1, 1)]
    _, source = arriving(spark, tmp_path, rows_[:4])
    state = str(tmp_path / "c")
    assert len(drain(jobs.early_counts(source, day, 1_000, 2 * day), checkpoint=state)) == 0
    assert stored_values(spark, state, "state").count() == 1
    _, source = arriving(spark, tmp_path / "later", rows_)
    live = [r for r in drain(jobs.early_counts(source, day, 1_000, 2 * day - day // 2),
                             checkpoint=str(tmp_path / "c2")) if r[1] == 6 * day]
    assert [r[3] for r in live[:3]] == [1, 1, 2] and len(live) == day // 2 // 1_000


def test_main_and_side_output(stream, batch, tmp_path):
    main, side = [], []
    query = writers.to_both(
        stream, lambda part, _: main.append(part.count()),
        lambda part, _: side.extend(lateness.freezing_alarms(part).collect())).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert sum(main) == batch.count()
    assert sorted(tuple(r) for r in side) == rows(lateness.freezing_alarms(batch))


def test_latest_window_max_served_from_a_keyed_table(spark, stream, batch, tmp_path):
    from tidegauge.sinks.upsert import KeyedTable
    size = f"{10 * SECOND // 1000} seconds"
    table = KeyedTable(spark, str(tmp_path / "t"), "id", ["end_ts", "max_temp"], ["end_ts"])
    maxima = windows.max_temperature(lateness.watermark(stream, "0 seconds"), size)
    query = table.writer(maxima, str(tmp_path / "c")).outputMode("update").trigger(
        availableNow=True).start()
    assert query.awaitTermination(120)
    served = table.read().select("id", "end_ts", "max_temp")
    assert rows(served) == rows(serving.latest_window_max(batch, size))
