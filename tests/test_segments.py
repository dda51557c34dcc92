"""Cut groups give the same rows as whole ones, also when one key dominates."""

import random
import re

import pytest
from sensor_rows import rows
from pyspark.sql import functions as F

from tidegauge.model import EVENT_ORDER, readings
from tidegauge.operators import alerts, control, lateness, rolling
from tidegauge.operators.transforms import shuffle_timestamps
from tidegauge.plans import running, segments

HOUR = 3_600_000
THRESHOLDS = [("sensor_1", 5.0, 1_704_067_200_000, 0), ("sensor_0", 0.9, 1_704_844_800_000, 1)]


@pytest.fixture(scope="module")
def skewed(events):
    """Two thirds of the rows belong to one sensor."""
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 < 2, 0)
                            .otherwise(F.col("user_id")))
    return readings(hot)


OPERATORS = {
    "sum": lambda r, n: rolling.rolling_sum(
        r.select("id", "timestamp", "seq", F.col("seq").alias("v")), "id", "v",
        ["timestamp"], segment_rows=n),
    "max": lambda r, n: rolling.rolling_max_reading(r, segment_rows=n),
    "key count": lambda r, n: rolling.high_temperature_key_count(r, segment_rows=n),
    "both counts": lambda r, n: rolling.high_temperature_both_counts(
        r, rolling.hash_bucket(2), segment_rows=n),
    "counter": lambda r, n: rolling.counter(r.select("seq"), segment_rows=n),
    "late": lambda r, n: lateness.flag_late(
        shuffle_timestamps(r, scale=14_400), 20 * HOUR, segment_rows=n),
    "updates": lambda r, n: lateness.late_updates(
        shuffle_timestamps(r, scale=14_400), 40 * HOUR, 20 * HOUR, 20 * HOUR, segment_rows=n),
    "changes": lambda r, n: alerts.temperature_changes(r, segment_rows=n),
    "cleaning": lambda r, n: alerts.self_cleaning_changes(r, 1.5, 24 * HOUR, 0, segment_rows=n),
    "rising": lambda r, n: alerts.rising_alerts(r, 4 * HOUR, segment_rows=n),
    "steady rise": lambda r, n: alerts.rising_alerts(
        r.withColumn("temperature", F.col("seq") % 400 + 1.0), 3 * HOUR, segment_rows=n),
    "thresholds": lambda r, n: control.threshold_alerts(
        r, r.sparkSession.createDataFrame(
            THRESHOLDS, "id string, threshold double, timestamp long, seq long"),
        segment_rows=n),
    "switches": lambda r, n: control.switch_filter(
        r, r.sparkSession.createDataFrame(
            [("sensor_0", 50 * HOUR, 1_704_412_800_000 + i * 30 * HOUR, i) for i in (0, 1, 9)],
            "id string, duration_ms long, timestamp long, seq long"),
        broadcast_rows=0, segment_rows=n),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_cutting_changes_nothing(skewed, name):
    operator = OPERATORS[name]
    whole = rows(operator(skewed, 10_000_000))
    assert whole and rows(operator(skewed, 60)) == whole


def test_segments_are_small(skewed):
    cut = segments.by_key(skewed, ["id"], EVENT_ORDER, 100)
    assert cut.cut is not None and cut.rows.count() == skewed.count()
    largest = cut.rows.groupBy(*cut.group).count().agg(F.max("count")).first()[0]
    assert largest <= 200


def test_sequence_with_gaps(spark):
    """Ids in far-apart clusters are cut by range, not by arithmetic."""
    ids = [i for base in (0, 10**12) for i in range(base, base + 500)]
    df = spark.createDataFrame([(i, i % 7) for i in ids], "seq long, v long")
    cut = segments.by_sequence(df, "seq", 100)
    largest = cut.rows.groupBy(*cut.group).count().agg(F.max("count")).first()[0]
    assert largest <= 250
    out = running.scan(cut, top=running.running_sum(F.col("v")))
    total, expected = 0, []
    for i in ids:
        total += i % 7
        expected.append((i, total))
    assert rows(out, "seq", "top") == expected


def test_nulls_and_missing_values(spark):
    """Running values skip nulls the same way in cut and uncut groups."""
    rng = random.Random(5)
    data = [("a", i, rng.choice([None, rng.randint(0, 9)])) for i in range(80)]
    df = spark.createDataFrame(data, "id string, seq long, v long")
    values = {"s": running.running_sum(F.col("v")), "m": running.running_max(F.col("v")),
              "l": running.latest(F.col("v")), "f": running.first_of(F.col("v")),
              "p": running.previous(F.col("v")),
              "x": running.latest(F.col("v"), include_current=False)}
    whole = running.scan(segments.by_key(df, ["id"], ["seq"], 1_000), **values)
    cut = running.scan(segments.by_key(df, ["id"], ["seq"], 7), **values)
    assert rows(cut, *whole.columns) == rows(whole)


def test_rows_without_a_key_are_cut(spark):
    data = [(None if i % 4 else "a", i, i % 7) for i in range(1_000)]
    df = spark.createDataFrame(data, "id string, seq long, v long")
    cut = segments.by_key(df, ["id"], ["seq"], 100)
    assert cut.rows.groupBy(*cut.group).count().agg(F.max("count")).first()[0] <= 250
    total = {}
    want = []
    for key, i, v in data:
        total[key] = total.get(key, 0) + v
        want.append((i, total[key]))
    got = running.scan(cut, s=running.running_sum(F.col("v")))
    assert rows(got, "seq", "s") == want


def test_words_are_numbered_without_sorting_them(spark, capsys):
    """Also a word that is most of all, over stretches, texts without words and null texts."""
    texts = [None if i % 11 == 5 else "" if i % 11 == 6 else "..." if i % 11 == 7 else
             " the the, w%d the" % (i % 13) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "line long, text string").repartition(7)
    seen, want = {}, []
    for line, text in enumerate(texts):
        words = {None: [], "": [""], "...": []}.get(text, text and re.split(r"\W+", text))
        for position, word in enumerate(words):
            seen[word] = seen.get(word, 0) + 1
            want.append((line, position, word, seen[word]))
    for size in (10, 1 << 19):
        out = rolling.rolling_word_count(df, "line", segment_rows=size)
        assert out.columns == ["line", "position", "word", "count"]
        assert sorted(map(tuple, out.collect())) == want
    out.explain()
    assert "row_number" not in capsys.readouterr().out
    assert rolling.rolling_word_count(df.filter("line < 0"), "line").count() == 0


def test_empty_input(spark, skewed):
    nothing = skewed.filter("seq < 0")
    for name, operator in OPERATORS.items():
        assert operator(nothing, 60).count() == 0, name
