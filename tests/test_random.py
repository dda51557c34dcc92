"""Random inputs against a record-at-a-time simulation."""

import random

import pytest
from sensor_rows import rows

from tidegauge.operators import alerts, control, lateness


def simulate_rising(readings, hold):
    state, out = {}, []
    for sensor, at, value, _ in sorted(readings, key=lambda r: (r[1], r[3])):
        last, due = state.get(sensor, (0.0, None))
        if due is not None and due <= at:
            out.append((sensor, due))
            due = None
        if last != 0.0:
            if value < last:
                due = None
            elif value > last and due is None:
                due = at + hold
        state[sensor] = (value, due)
    return sorted(out + [(s, due) for s, (_, due) in state.items() if due is not None])


def simulate_switches(readings, switches):
    merged = sorted([(at, 0, seq, s, d) for s, d, at, seq in switches]
                    + [(at, 1, seq, s, v) for s, at, v, seq in readings])
    until, out = {}, []
    for at, kind, seq, sensor, value in merged:
        if kind == 0:
            until[sensor] = max(until.get(sensor, 0), at + value)
        elif at < until.get(sensor, 0):
            out.append((sensor, at, value, seq))
    return sorted(out)


def simulate_updates(readings, size, delay, lateness_ms):
    """One global arrival order; windows fire as soon as the watermark allows."""
    counts, fired, out, top = {}, set(), [], None
    for sensor, at, _, _ in sorted(readings, key=lambda r: r[3]):
        mark = None if top is None else top - delay
        key = (sensor, at // size * size + size)
        if mark is not None and mark >= key[1] - 1:
            if mark < key[1] - 1 + lateness_ms:
                counts[key] = counts.get(key, 0) + 1
                out.append((*key, counts[key], "update" if key in fired else "first"))
                fired.add(key)
        else:
            counts[key] = counts.get(key, 0) + 1
        top = at if top is None else max(top, at)
        for key, n in counts.items():
            if key not in fired and top - delay >= key[1] - 1:
                fired.add(key)
                out.append((*key, n, "first"))
    return sorted(out + [(*k, n, "first") for k, n in counts.items() if k not in fired])


def random_readings(rng, sensors, count, span, levels):
    return [(f"s{rng.randrange(sensors)}", rng.randrange(span), float(rng.randrange(levels)), i)
            for i in range(count)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("size", [150, 100_000])
def test_rising(spark, seed, size):
    rng = random.Random(seed)
    data = random_readings(rng, 60, 3_000, 4_000, rng.choice([3, 40]))
    df = spark.createDataFrame(data, "id string, timestamp long, temperature double, seq long")
    hold = rng.choice([20, 300])
    out = alerts.rising_alerts(df, hold, segment_rows=size)
    assert rows(out, "id", "timestamp") == simulate_rising(data, hold)


@pytest.mark.parametrize("size", [100, 100_000])
def test_long_rises_across_cuts(spark, size):
    rng = random.Random(11)
    data, value = [], {}
    for i in range(3_000):
        sensor = "hot" if rng.random() < 0.5 else f"s{rng.randrange(5)}"
        drop = rng.random() < 0.004
        value[sensor] = 1.0 if drop else value.get(sensor, 1.0) + rng.choice([0.0, 1.0])
        data.append((sensor, i * 10 + rng.randrange(10), value[sensor], i))
    df = spark.createDataFrame(data, "id string, timestamp long, temperature double, seq long")
    for hold in (35, 700, 9_000):
        out = alerts.rising_alerts(df, hold, segment_rows=size)
        assert rows(out, "id", "timestamp") == simulate_rising(data, hold)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bound", [1_000, 0])
def test_switches(spark, seed, bound):
    rng = random.Random(seed)
    data = random_readings(rng, 20, 1_000, 500, 9)
    switches = [(f"s{rng.randrange(20)}", rng.randrange(1, 60), rng.randrange(500), i)
                for i in range(60)]
    df = spark.createDataFrame(data, "id string, timestamp long, temperature double, seq long")
    on = spark.createDataFrame(switches, "id string, duration_ms long, timestamp long, seq long")
    out = control.switch_filter(df, on, broadcast_rows=bound, segment_rows=50)
    assert rows(out) == simulate_switches(data, switches)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("size", [30, 100_000])
def test_late_updates(spark, seed, size):
    rng = random.Random(seed)
    data = [(f"s{rng.randrange(4)}", i * 3 + rng.randrange(60), 1.0, i) for i in range(600)]
    df = spark.createDataFrame(data, "id string, timestamp long, temperature double, seq long")
    out = lateness.late_updates(df, 40, 15, 15, segment_rows=size)
    assert rows(out) == simulate_updates(data, 40, 15, 15)
