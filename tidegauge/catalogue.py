"""Registered queries on the given tables, each with its SQL counterpart.

The tables hold one month of events, a reading per sensor about every seven hours,
so the durations of the operators are stretched: one second becomes four hours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge import model
from tidegauge.operators import (alerts, control, lateness, lookup, partitioning, rolling,
                                 serving, transforms, windows)

# Milliseconds and interval text of one stretched second.
SCALE = 14_400
SECOND = 1_000 * SCALE
DAY = 24 * 3_600_000


def _interval(seconds: int) -> str:
    return f"{seconds * SCALE} seconds"


NEEDLE = "que"
COUNT_BUCKETS = 8
PARTITIONS = 16
DASHBOARD_USERS = [1, 2, 3, 4, 5]
DASHBOARD = [f"sensor_{i}" for i in DASHBOARD_USERS]
HOLD = 12 * SECOND

# Fixed control inputs: (sensor, start or time, value), times in epoch milliseconds.
JAN_01, JAN_05, JAN_06 = 1_704_067_200_000, 1_704_412_800_000, 1_704_499_200_000
JAN_10, JAN_20 = 1_704_844_800_000, 1_705_708_800_000
SWITCHES = [("sensor_2", 10 * SECOND, JAN_05, 0), ("sensor_7", 60 * SECOND, JAN_05, 1),
            ("sensor_7", 20 * SECOND, JAN_06, 2)]
THRESHOLDS = [("sensor_1", 5.0, JAN_01, 0), ("sensor_2", 0.9, JAN_01, 1),
              ("sensor_3", 0.5, JAN_01, 2), ("sensor_1", 1.2, JAN_10, 3),
              ("sensor_3", 0.0, JAN_20, 4)]


class Tables:
    """The tables of one data folder, as the operators want them."""

    def __init__(self, spark: SparkSession, folder: str):
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def readings(self) -> DataFrame:
        return model.readings(self.table("events"))

    @property
    def disordered(self) -> DataFrame:
        return transforms.shuffle_timestamps(self.readings, scale=SCALE)

    def readings_of(self, users: list[int]) -> DataFrame:
        """Readings of some sensors; the filter on the stored column reaches the scan."""
        return model.readings(self.table("events").filter(F.col("user_id").isin(users)))

    @property
    def smoke(self) -> DataFrame:
        return model.smoke_control(self.table("events"))

    @property
    def switches(self) -> DataFrame:
        return self.spark.createDataFrame(
            SWITCHES, "id string, duration_ms long, timestamp long, seq long")

    @property
    def thresholds(self) -> DataFrame:
        return self.spark.createDataFrame(
            THRESHOLDS, "id string, threshold double, timestamp long, seq long")

    @property
    def locations(self) -> DataFrame:
        return self.spark.range(1, 80).select(
            F.concat(F.lit("sensor_"), F.col("id")).alias("sensor"),
            F.concat(F.lit("room_"), F.col("id") % 10).alias("room"))


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, query: Query, sql: str) -> None:
    QUERIES[name], ORACLES[name] = query, sql


R = """r AS (SELECT 'sensor_' || user_id AS id, epoch_us(ts) // 1000 AS "timestamp",
 value AS temperature, event_id AS seq, user_id, event_type FROM events)"""
SHUFFLED = f"""d AS (SELECT id, "timestamp" + (seq * 7919 % 7000) * {SCALE} AS "timestamp",
 temperature, seq FROM r)"""
MARKED = f"""m AS (SELECT *, max("timestamp") OVER (ORDER BY seq
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {5 * SECOND} AS wm FROM d)"""
BY_SENSOR = 'PARTITION BY id ORDER BY "timestamp", seq'
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
CELSIUS = "(temperature - 32) * (5e0 / 9e0)"
LINE = """'(' || id || ', ' || "timestamp" || ', ' || temperature || ')'"""
LATE = "'*** late reading ***' || id"


def _end(size: int) -> str:
    return f'("timestamp" // {size}) * {size} + {size}'


def _windowed(seconds: int, aggregates: str) -> str:
    return (f"WITH {R} SELECT id, {_end(seconds * SECOND)} AS end_ts, {aggregates} "
            "FROM r GROUP BY ALL")


# Sources, projections, filters, flat-maps.

_register("readings_scan", lambda t: t.readings.drop("ts"),
          f'WITH {R} SELECT id, "timestamp", temperature, seq FROM r')

_register("smoke_control", lambda t: t.smoke,
          """SELECT epoch_us(ts) // 1000 AS "timestamp", event_id AS seq,
CASE WHEN value > 100 THEN 'HIGH' ELSE 'LOW' END AS level
FROM events WHERE event_type = 'error'""")

_register("count_range",
          lambda t: rolling.counter(t.readings.select("seq")),
          "SELECT event_id AS seq, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events")

_register("reading_lines", lambda t: transforms.reading_lines(t.readings),
          f"WITH {R} SELECT {LINE} AS value FROM r")

_register("to_celsius",
          lambda t: transforms.to_celsius(t.readings).select(
              "id", "timestamp", "seq", F.round("temperature", 6).alias("temperature")),
          f'WITH {R} SELECT id, "timestamp", seq, round({CELSIUS}, 6) AS temperature FROM r')

_register("project_id", lambda t: transforms.project_id(t.readings),
          f"WITH {R} SELECT id FROM r")

_register("project_temperature", lambda t: transforms.project_temperature(t.readings),
          f"WITH {R} SELECT id, temperature FROM r")

_register("increment",
          lambda t: transforms.increment(t.table("events").select("event_id", "user_id"),
                                         "user_id"),
          "SELECT event_id, user_id + 1 AS user_id FROM events")

_register("shuffle_ts", lambda t: t.disordered.select("id", "timestamp", "seq"),
          f'WITH {R}, {SHUFFLED} SELECT id, "timestamp", seq FROM d')

_register("filter_temp", lambda t: transforms.filter_temperature(t.readings).drop("ts"),
          f'WITH {R} SELECT id, "timestamp", temperature, seq FROM r WHERE temperature >= 25')

_register("filter_contains",
          lambda t: transforms.filter_contains(t.table("documents"), NEEDLE).select("doc_id"),
          f"SELECT doc_id FROM documents WHERE contains(text, '{NEEDLE}')")

TOKENS = r"""s AS (SELECT doc_id, text, string_split_regex(text, '\W+') AS l FROM documents),
k AS (SELECT doc_id, l, CASE WHEN text = '' THEN 1
 WHEN len(l) = 2 AND l[1] = '' AND l[2] = '' THEN 0
 WHEN l[len(l)] = '' THEN len(l) - 1 ELSE len(l) END AS n FROM s),
w AS (SELECT doc_id, i - 1 AS position, l[i] AS word
 FROM (SELECT doc_id, l, unnest(range(1, n + 1)) AS i FROM k))"""

_register("tokenize",
          lambda t: transforms.tokenize(t.table("documents"), keep=("doc_id",)),
          f"WITH {TOKENS} SELECT doc_id, CAST(position AS INTEGER) AS position, word FROM w")

_register("split_id", lambda t: transforms.split_id(t.readings),
          f"WITH {R} SELECT unnest(string_split(id, '_')) AS part FROM r")


# Rolling aggregates.

_register("rolling_sum",
          lambda t: rolling.rolling_sum(
              t.readings.drop("ts"), "id", "temperature", first=["timestamp"]).select(
              "id", "seq", "first_timestamp",
              F.round("rolling_temperature", 6).alias("rolling_temperature")),
          f"""WITH {R} SELECT id, seq,
first_value("timestamp") OVER ({BY_SENSOR} {SO_FAR}) AS first_timestamp,
round(sum(temperature) OVER ({BY_SENSOR} {SO_FAR}), 6) AS rolling_temperature FROM r""")

_register("word_count", lambda t: rolling.word_count(t.table("documents")),
          f'WITH {TOKENS} SELECT word, count(*) AS "count" FROM w GROUP BY word')

_register("rolling_word_count",
          lambda t: rolling.rolling_word_count(t.table("documents"), "doc_id"),
          f"""WITH {TOKENS} SELECT doc_id, CAST(position AS INTEGER) AS position, word,
row_number() OVER (PARTITION BY word ORDER BY doc_id, position) AS "count" FROM w""")

_register("rolling_max_reading", lambda t: rolling.rolling_max_reading(t.readings),
          f"""WITH {R}, x AS (SELECT *, max(temperature) OVER ({BY_SENSOR} {SO_FAR}) AS top FROM r)
SELECT id, seq, last_value(CASE WHEN temperature = top THEN "timestamp" END IGNORE NULLS)
 OVER ({BY_SENSOR} {SO_FAR}) AS max_timestamp, top AS max_temperature FROM x""")

_register("rolling_concat",
          lambda t: rolling.rolling_concat(
              t.table("conversations").select("conv_id", "turn", F.array("text").alias("texts")),
              "conv_id", "texts", order=["turn"]).select(
              "conv_id", "turn", F.concat_ws(" | ", "rolling_texts").alias("texts")),
          f"""SELECT conv_id, turn, string_agg(text, ' | ')
OVER (PARTITION BY conv_id ORDER BY turn {SO_FAR}) AS texts FROM conversations""")

_register("rolling_items",
          lambda t: rolling.rolling_items(
              t.table("conversations").select("conv_id", "turn", F.split("text", " ").alias("words")),
              "conv_id", "words", order=["turn"]).select("conv_id", "turn", "item_from", "item_to"),
          f"""WITH s AS (SELECT conv_id, turn, coalesce(len(string_split(text, ' ')), 0) AS n
FROM conversations), t AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn {SO_FAR}) AS e
FROM s) SELECT conv_id, turn, CAST(e - n AS BIGINT) AS item_from, CAST(e AS BIGINT) AS item_to FROM t""")

HIGH = f"{R}, h AS (SELECT *, user_id % {COUNT_BUCKETS} AS bucket FROM r WHERE temperature > 10)"
BY_BUCKET = 'PARTITION BY bucket ORDER BY "timestamp", seq'


def _number_bucket():
    number = F.substring_index("id", "_", -1).cast("long")
    return F.pmod(number, F.lit(COUNT_BUCKETS))


_register("high_temp_key_count", lambda t: rolling.high_temperature_key_count(t.readings),
          f"""WITH {HIGH} SELECT id, "timestamp", seq,
row_number() OVER ({BY_SENSOR}) - 1 AS key_count FROM h""")

_register("high_temp_bucket_count",
          lambda t: rolling.high_temperature_bucket_count(t.readings, _number_bucket()).select(
              "bucket", "seq", "bucket_count"),
          f"""WITH {HIGH} SELECT bucket, seq,
row_number() OVER ({BY_BUCKET}) AS bucket_count FROM h""")

_register("high_temp_both_counts",
          lambda t: rolling.high_temperature_both_counts(t.readings, _number_bucket()),
          f"""WITH {HIGH} SELECT id, "timestamp", seq,
row_number() OVER ({BY_SENSOR}) - 1 AS key_count,
row_number() OVER ({BY_BUCKET}) AS bucket_count FROM h""")


# Windows.

_register("avg_temp_window",
          lambda t: windows.avg_temperature(t.readings, _interval(5), digits=6),
          _windowed(5, f"round(avg({CELSIUS}), 6) AS avg_temp"))

_register("min_temp_window", lambda t: windows.min_temperature(t.readings, _interval(15)),
          _windowed(15, "min(temperature) AS min_temp"))

_register("avg_temp_window15",
          lambda t: windows.avg_temperature(t.readings, _interval(15), in_celsius=False,
                                            digits=6),
          _windowed(15, "round(avg(temperature), 6) AS avg_temp"))

_register("minmax_window", lambda t: windows.min_max_temperature(t.readings, _interval(5)),
          _windowed(5, "min(temperature) AS min_temp, max(temperature) AS max_temp"))

_register("max_temp_window", lambda t: windows.max_temperature(t.readings, _interval(10)),
          _windowed(10, "max(temperature) AS max_temp"))

_register("avg_all_window", lambda t: windows.avg_all(t.readings, _interval(1), digits=6),
          f"""WITH {R} SELECT
strftime(make_timestamp(({_end(SECOND)}) * 1000), '%Y-%m-%dT%H:%M:%S') AS end_time,
round(avg(temperature), 6) AS avg_temp FROM r GROUP BY 1""")

_register("count_window30", lambda t: windows.count_readings(t.readings, _interval(30)),
          _windowed(30, "count(*) AS readings"))

_register("early_fire_counts",
          lambda t: windows.early_counts(t.readings, 30 * SECOND, SECOND),
          f"""WITH {R}, p AS (SELECT id, {_end(30 * SECOND)} AS end_ts, "timestamp" FROM r),
f AS (SELECT id, end_ts, min("timestamp") AS t0 FROM p GROUP BY ALL),
e AS (SELECT id, end_ts, unnest(range((t0 // {SECOND}) * {SECOND} + {SECOND}, end_ts, {SECOND}))
 AS eval_ts FROM f UNION ALL SELECT id, end_ts, end_ts FROM f)
SELECT e.id, e.end_ts, e.eval_ts, count(*) AS readings FROM e JOIN p
ON p.id = e.id AND p.end_ts = e.end_ts AND p."timestamp" < e.eval_ts GROUP BY ALL""")


# Watermarks and late data.

_register("watermark_periodic",
          lambda t: lateness.with_watermark_ms(t.disordered, 60 * SECOND).select(
              "id", "timestamp", "seq", "watermark"),
          f"""WITH {R}, {SHUFFLED} SELECT id, "timestamp", seq, max("timestamp") OVER (ORDER BY seq
ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {60 * SECOND} AS watermark FROM d""")

_register("watermark_punctuated",
          lambda t: lateness.with_watermark_ms(
              t.disordered, 60 * SECOND, only=F.col("id") == "sensor_1").select(
              "id", "timestamp", "seq", "watermark"),
          f"""WITH {R}, {SHUFFLED} SELECT id, "timestamp", seq,
max(CASE WHEN id = 'sensor_1' THEN "timestamp" END) OVER (ORDER BY seq
ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {60 * SECOND} AS watermark FROM d""")

_register("ontime_readings",
          lambda t: lateness.split_late(t.disordered, 5 * SECOND)[0].drop("ts"),
          f"""WITH {R}, {SHUFFLED}, {MARKED} SELECT id, "timestamp", temperature, seq FROM m
WHERE wm IS NULL OR "timestamp" >= wm""")

_register("late_readings",
          lambda t: lateness.split_late(t.disordered, 5 * SECOND)[1].drop("ts"),
          f"""WITH {R}, {SHUFFLED}, {MARKED} SELECT id, "timestamp", temperature, seq,
{LATE} AS message FROM m WHERE "timestamp" < wm""")

PLACED = f"""{R}, {SHUFFLED}, {MARKED},
p AS (SELECT *, {_end(10 * SECOND)} AS end_ts FROM m),
q AS (SELECT *, coalesce(wm >= end_ts - 1, false) AS fired,
 coalesce(wm >= end_ts - 1 + {5 * SECOND}, false) AS gone FROM p)"""

_register("late_side_counts",
          lambda t: lateness.late_side_output(t.disordered, 10 * SECOND, 5 * SECOND)[0],
          f"""WITH {PLACED} SELECT id, end_ts, count(*) AS readings FROM q WHERE NOT fired
GROUP BY ALL""")

_register("late_side_rows",
          lambda t: lateness.late_side_output(t.disordered, 10 * SECOND, 5 * SECOND)[1]
          .drop("ts"),
          f"""WITH {PLACED} SELECT id, "timestamp", temperature, seq, {LATE} AS message
FROM q WHERE fired""")

_register("late_update_counts",
          lambda t: lateness.late_updates(t.disordered, 10 * SECOND, 5 * SECOND, 5 * SECOND),
          f"""WITH {PLACED},
c AS (SELECT id, end_ts, seq, fired, count(*) FILTER (NOT fired) OVER (PARTITION BY id, end_ts) AS n,
 count(*) FILTER (fired) OVER (PARTITION BY id, end_ts ORDER BY seq {SO_FAR}) AS k
 FROM q WHERE NOT gone)
SELECT DISTINCT id, end_ts, n AS readings, 'first' AS result FROM c WHERE n > 0
UNION ALL SELECT id, end_ts, n + k, CASE WHEN n = 0 AND k = 1 THEN 'first' ELSE 'update' END
FROM c WHERE fired""")

_register("freezing_alarms", lambda t: lateness.freezing_alarms(t.readings),
          f"""WITH {R} SELECT id, "timestamp", 'Freezing Alarm for' || id AS message
FROM r WHERE temperature < 32""")


# Control streams and lookup.

_register("fire_alerts", lambda t: control.fire_alerts(t.readings, t.smoke),
          f"""WITH {R}, c AS (SELECT epoch_us(ts) // 1000 AS cts, value FROM events
 WHERE event_type = 'error')
SELECT 'Risk of fire! ' || {LINE} AS message, "timestamp"
FROM (SELECT * FROM r WHERE temperature > 100) x
ASOF JOIN c ON x."timestamp" >= c.cts WHERE c.value > 100""")


def _rows(rows: list[tuple]) -> str:
    return "VALUES " + ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else
                        f"CAST({v} AS {'DOUBLE' if isinstance(v, float) else 'BIGINT'})"
                        for v in row) + ")" for row in rows)


_register("switch_filter", lambda t: control.switch_filter(t.readings, t.switches),
          f"""WITH {R}, s(sid, duration, start, n) AS ({_rows(SWITCHES)})
SELECT id, "timestamp", temperature, seq FROM r WHERE EXISTS (SELECT 1 FROM s WHERE sid = id
AND "timestamp" >= start AND "timestamp" < start + duration)""")

_register("threshold_alerts",
          lambda t: control.threshold_alerts(t.readings, t.thresholds).withColumn(
              "diff", F.round("diff", 6)),
          f"""WITH {R}, c(sid, threshold, since, n) AS ({_rows(THRESHOLDS)}),
x AS (SELECT *, lag(temperature, 1, 0e0) OVER ({BY_SENSOR}) AS prev FROM r)
SELECT id, "timestamp", temperature, round(abs(temperature - prev), 6) AS diff
FROM x ASOF JOIN c ON x.id = c.sid AND x."timestamp" >= c.since
WHERE threshold <> 0 AND abs(temperature - prev) > threshold""")

_register("sensor_locations",
          lambda t: lookup.with_location(t.readings, t.locations).select(
              "id", "timestamp", "seq", "room"),
          f"""WITH {R} SELECT id, "timestamp", seq, CASE WHEN user_id BETWEEN 1 AND 79
THEN 'room_' || (user_id % 10) ELSE 'UNKNOWN ROOM' END AS room FROM r""")


# Keyed state and timers.

_register("temp_change_alerts",
          lambda t: alerts.temperature_changes(t.readings).withColumn(
              "diff", F.round("diff", 6)),
          f"""WITH {R}, x AS (SELECT *, lag(temperature, 1, 0e0) OVER ({BY_SENSOR}) AS prev FROM r)
SELECT id, "timestamp", temperature, round(abs(temperature - prev), 6) AS diff
FROM x WHERE abs(temperature - prev) > 1.7""")

_register("self_cleaning_alerts",
          lambda t: alerts.self_cleaning_changes(t.readings, 1.5, DAY, 0).withColumn(
              "diff", F.round("diff", 6)),
          f"""WITH {R}, x AS (SELECT *, lag(temperature) OVER ({BY_SENSOR}) AS prev,
 lag("timestamp") OVER ({BY_SENSOR}) AS pts FROM r),
y AS (SELECT *, CASE WHEN "timestamp" - pts <= {DAY} THEN prev ELSE 0e0 END AS base FROM x)
SELECT id, "timestamp", temperature, round(abs(temperature - base), 6) AS diff
FROM y WHERE abs(temperature - base) > 1.5""")

_register("rising_alerts", lambda t: alerts.rising_alerts(t.readings, HOLD),
          f"""WITH RECURSIVE {R},
o AS (SELECT id, "timestamp" AS t, temperature AS x, row_number() OVER ({BY_SENSOR}) AS n,
 count(*) OVER (PARTITION BY id) AS total FROM r),
s AS (SELECT id, n, total, x, CAST(NULL AS BIGINT) AS due, CAST(NULL AS BIGINT) AS fired
 FROM o WHERE n = 1
 UNION ALL
 SELECT o.id, o.n, o.total, o.x,
  CASE WHEN s.x = 0 OR o.x = s.x THEN CASE WHEN s.due > o.t THEN s.due END
   WHEN o.x < s.x THEN NULL
   WHEN s.due > o.t THEN s.due ELSE o.t + {HOLD} END,
  CASE WHEN s.due <= o.t THEN s.due END
 FROM s JOIN o ON o.id = s.id AND o.n = s.n + 1),
f AS (SELECT id, fired AS due FROM s WHERE fired IS NOT NULL
 UNION ALL SELECT id, due FROM s WHERE n = total AND due IS NOT NULL)
SELECT id, due AS "timestamp",
'Temperature of sensor ''' || id || ''' monotonically increased for 1 second.' AS message
FROM f""")


# Keyed results.

MAXIMA = f"""{R}, x AS (SELECT id, {_end(10 * SECOND)} AS end_ts, max(temperature) AS max_temp
 FROM r GROUP BY ALL),
l AS (SELECT id, max(end_ts) AS end_ts, arg_max(max_temp, end_ts) AS max_temp FROM x GROUP BY id)"""

_register("latest_window_max", lambda t: serving.latest_window_max(t.readings, _interval(10)),
          f"WITH {MAXIMA} SELECT id, end_ts, max_temp FROM l")

CELLS = " || chr(9) || '| ' || ".join(
    f"coalesce((SELECT printf('%.3f', max_temp) FROM l WHERE id = '{s}'), '-')"
    for s in DASHBOARD)

_register("temp_dashboard",
          lambda t: serving.dashboard(serving.latest_window_max(
              t.readings_of(DASHBOARD_USERS), _interval(10)), DASHBOARD),
          f"WITH {MAXIMA} SELECT {CELLS} AS line")

LATEST = f"""WITH {R} SELECT id AS sensor, round(arg_max({CELSIUS}, seq), 6) AS temp
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC, seq DESC) AS n
 FROM r) WHERE n = 1 GROUP BY id"""


def _upserted(t: Tables) -> DataFrame:
    return serving.upsert_latest(t.readings).withColumn("temp", F.round("temp", 6))


_register("upsert_latest", _upserted, LATEST)

_register("upsert_report", lambda t: serving.upsert_report(_upserted(t)),
          f"SELECT * FROM ({LATEST}) ORDER BY sensor")

_register("partition_custom",
          lambda t: partitioning.partition_custom(
              t.readings.select("seq", (F.floor("temperature").cast("long") - 32).alias("number")),
              "number", PARTITIONS, spread_by=F.col("seq")),
          f"""WITH {R}, x AS (SELECT seq, CAST(floor(temperature) AS BIGINT) - 32 AS number FROM r)
SELECT seq, number, CAST(CASE WHEN number < 0 THEN 0 ELSE seq % {PARTITIONS} END AS INTEGER)
AS "partition" FROM x""")


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Tables(spark, folder))
