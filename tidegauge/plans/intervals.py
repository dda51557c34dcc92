"""Point-in-interval tests against a small table of disjoint intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Intervals that may share one time bucket; more would make each probe slow.
PER_BUCKET = 64


def level_intervals(control: DataFrame, level: str) -> DataFrame:
    """Intervals [start, end) during which a global level holds; the last may be open.

    Meant for control tables of checked size: it orders all of it in one task.
    """
    over_all = Window.orderBy("timestamp", "seq")
    changes = control.withColumn("_before", F.lag("level").over(over_all)).filter(
        F.col("_before").isNull() | (F.col("_before") != F.col("level")))
    spans = changes.select("level", F.col("timestamp").alias("start"),
                           F.lead("timestamp").over(over_all).alias("end"))
    return spans.filter((F.col("level") == level)
                        & (F.col("end").isNull() | (F.col("start") < F.col("end")))
                        ).select("start", "end")


class TimeBuckets:
    """Equal stretches of time between two instants; later instants share the last."""

    def __init__(self, low: int, high: int, count: int):
        self.low, self.count = low, max(1, count)
        self.width = max(1, -(-(high - low + 1) // self.count))

    def of(self, instant: str):
        index = F.call_function("div", F.col(instant) - self.low, F.lit(self.width))
        return F.least(index.cast("long"), F.lit(self.count).cast("long"))

    def spread(self, intervals: DataFrame) -> DataFrame:
        """One row per interval and bucket it touches."""
        last = F.coalesce(self.of("end"), F.lit(self.count).cast("long"))
        return intervals.withColumn("_bucket", F.explode(F.sequence(self.of("start"), last)))


def within_any(points: DataFrame, instant: str, spread: DataFrame,
               buckets: TimeBuckets) -> DataFrame:
    """Points inside one of the spread intervals: a broadcast equi-join on the bucket.

    The points are not shuffled, so neither hot keys nor busy hours matter.
    """
    probe = points.withColumn("_bucket", buckets.of(instant))
    inside = ((F.col("p._bucket") == F.col("i._bucket"))
              & (F.col(f"p.{instant}") >= F.col("i.start"))
              & (F.col("i.end").isNull() | (F.col(f"p.{instant}") < F.col("i.end"))))
    return probe.alias("p").join(F.broadcast(spread).alias("i"), inside, "left_semi").drop(
        "_bucket")
