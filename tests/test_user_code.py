"""Aggregates, table functions and placement given by the user."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from sensor_rows import rows

from tidegauge.model import readings
from tidegauge.operators import aggregates, partitioning, transforms, windows
from tidegauge.operators.table_functions import flat_map
from test_streaming import folder, stream, batch  # noqa: F401

SECOND = 14_400_000


def close(got, want):
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], rel=1e-9)


@pytest.mark.parametrize("held", [1 << 18, 8])
def test_mean_with_merge_equals_the_window_average(batch, monkeypatch, held):  # noqa: F811
    monkeypatch.setattr(aggregates, "HELD", held)
    want = windows.avg_temperature(batch, f"{15 * SECOND // 1000} seconds", in_celsius=False)
    got = aggregates.windowed(batch.repartition(5), 15 * SECOND, aggregates.MEAN)
    close(rows(got, "id", "end_ts", "result"), rows(want, "id", "end_ts", "avg_temp"))


def test_only_accumulators_are_shuffled(batch):  # noqa: F811
    size = 15 * SECOND * 10
    groups = windows.assign(batch, size).select("id", "end_ts").distinct().count()
    parts = aggregates.partials(batch.coalesce(2), size, aggregates.MEAN)
    assert groups <= parts.count() <= 2 * groups < batch.count()
    plan = aggregates.windowed(batch, size, aggregates.MEAN)._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan"):]
    exchange = physical.index("Exchange hashpartitioning")
    assert physical.count("Exchange hashpartitioning") == 1
    assert physical.index("MapInArrow") < exchange < physical.rindex("MapInArrow")


def test_own_aggregate(spark, batch):  # noqa: F811
    geometric = aggregates.Aggregate(lambda v: (np.log(np.abs(v) + 1), np.ones(len(v))),
                                     (np.add, np.add), lambda s, n: np.exp(s / n))
    got = aggregates.windowed(batch, 30 * SECOND, geometric, name="middle")
    want = windows.assign(batch, 30 * SECOND).groupBy("id", "end_ts").agg(
        F.exp(F.avg(F.log(F.abs("temperature") + 1))).alias("middle"))
    close(rows(got), rows(want, "id", "end_ts", "middle"))
    odd = spark.createDataFrame([(None, 5, 1.0), (None, 6, 4.0), ("a", 7, None), ("b", 9, 2.0)],
                                "id string, timestamp long, temperature double")
    assert rows(aggregates.windowed(odd, 10, aggregates.SPREAD)) == [
        ("b", 10, 0.0), (None, 10, 3.0)]
    assert aggregates.windowed(odd.limit(0), 10, aggregates.MEAN).count() == 0


def test_table_function(spark, batch, stream, drain):  # noqa: F811
    def parts_of(sensor):
        for part in sensor.split("_"):
            yield (part,)

    want = rows(transforms.split_id(batch))
    made = flat_map(batch, parts_of, "part string", "id").select("part")
    assert rows(made) == want
    live = flat_map(stream, parts_of, "part string", "id").select("part")
    assert sorted(drain(live)) == want
    none = flat_map(batch, lambda sensor: [], "part string", "id")
    assert none.count() == 0


def test_rows_are_where_their_number_says(spark):
    many = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7) - F.col("id") % 2).when(
            F.col("id") % 3 == 1, F.lit(5)).otherwise(F.col("id")).alias("number"), "id")
    placed = partitioning.place(many, "number", 16)
    found = placed.withColumn("at", F.spark_partition_id()).collect()
    assert all(r["at"] == r["partition"] for r in found) and len(found) == 20_000
    sizes = np.bincount([r["at"] for r in found], minlength=16)
    assert sizes.max() <= 2.5 * 20_000 / 16
    of = {}
    for r in found:
        of.setdefault(-1 if r["number"] < 0 else r["number"], set()).add(r["at"])
    assert len(of[-1]) == 6 and len(of[5]) == 6 and not of[-1] & of[5]
    assert all(len(where) == 1 for number, where in of.items() if number not in (-1, 5))


def test_placement_of_few_rows(spark):
    frame = spark.createDataFrame([(None, 1), (3, 2), (-1, 3)], "number long, x int")
    placed = partitioning.place(frame, "number", 4).withColumn("at", F.spark_partition_id())
    assert all(r["at"] == r["partition"] for r in placed.collect()) and placed.count() == 3
    assert partitioning.place(frame.limit(0), "number", 4).count() == 0
