"""Record schemas and the adapter that turns an event table into readings.

Every operator works on *readings*: ``id``, ``timestamp`` (epoch milliseconds),
``temperature`` (degrees Fahrenheit), ``seq`` (a unique integer that gives the
arrival order and breaks timestamp ties) and ``ts`` (the same instant as a Spark
timestamp, which windows and watermarks need).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

READING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])
ALERT = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])
SMOKE_LEVEL = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("level", T.StringType()),
])
PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
])
WORD_COUNT = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("count", T.LongType()),
])
MIN_MAX_TEMP = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("endTs", T.LongType()),
])
THRESHOLD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])
SWITCH = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("timestamp", T.LongType()),
])
LOCATION = T.StructType([
    T.StructField("sensor", T.StringType()),
    T.StructField("room", T.StringType()),
])

# Total order of one sensor's readings.
EVENT_ORDER = ("timestamp", "seq")


def epoch_ms(ts: Column | str) -> Column:
    """Instant of a timestamp column in whole milliseconds (rounded down)."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(column.cast("timestamp"))


def with_event_time(df: DataFrame, ms: str = "timestamp") -> DataFrame:
    """Add ``ts``, the timestamp form of an epoch-millisecond column."""
    return df.withColumn("ts", F.timestamp_millis(ms))


def readings(events: DataFrame, *, key: str = "user_id", time: str = "ts",
             value: str = "value", seq: str = "event_id",
             prefix: str = "sensor_") -> DataFrame:
    """Adapt an event table, batch or streaming, to readings.

    A narrow projection: only the four source columns reach the scan. A
    timestamp without time zone is taken in the session zone, which must be UTC.
    """
    return with_event_time(events.select(
        F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"),
        epoch_ms(time).alias("timestamp"),
        F.col(value).cast("double").alias("temperature"),
        F.col(seq).cast("long").alias("seq"),
    ))


def smoke_control(events: DataFrame, *, event_type: str = "error",
                  high_above: float = 100.0) -> DataFrame:
    """Control rows (timestamp, seq, level): HIGH above a value, LOW otherwise."""
    return events.filter(F.col("event_type") == event_type).select(
        epoch_ms("ts").alias("timestamp"),
        F.col("event_id").cast("long").alias("seq"),
        F.when(F.col("value") > high_above, "HIGH").otherwise("LOW").alias("level"),
    )
