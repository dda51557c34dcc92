"""Alerts that depend on a sensor's earlier readings."""

from __future__ import annotations

import sys
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge import texts
from tidegauge.model import EVENT_ORDER
from tidegauge.plans import running, segments, spread
from tidegauge.plans.segments import SEGMENT, SEGMENT_ROWS, UNCUT
from tidegauge.session import written


def _changes(readings: DataFrame, last: Column, threshold: float,
             segment_rows: int) -> DataFrame:
    """Readings whose distance to ``last``, built from ``_prev``, exceeds the threshold."""
    cut = segments.by_key(readings.select("id", "timestamp", "seq", "temperature"),
                          ["id"], EVENT_ORDER, segment_rows)
    scanned = running.scan(cut, _prev=running.previous(F.struct("temperature", "timestamp")))
    return scanned.withColumn("diff", F.abs(F.col("temperature") - last)).filter(
        F.col("diff") > threshold).select("id", "timestamp", "temperature", "diff")


def temperature_changes(readings: DataFrame, threshold: float = 1.7, *,
                        segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Readings that differ from the previous one by more than the threshold.

    The first reading is compared with 0.0.
    """
    last = F.coalesce(F.col("_prev.temperature"), F.lit(0.0))
    return _changes(readings, last, threshold, segment_rows)


def self_cleaning_changes(readings: DataFrame, threshold: float = 1.5,
                          ttl_ms: int = 3_600_000, delay_ms: int = 5_000, *,
                          segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The same with a memory that ends ``ttl_ms`` after the last reading.

    The clean-up follows the watermark, which trails by ``delay_ms``; after it the
    next reading is compared with 0.0 again.
    """
    kept = F.col("timestamp") - F.col("_prev.timestamp") <= ttl_ms + delay_ms
    last = F.when(kept, F.col("_prev.temperature")).otherwise(0.0)
    return _changes(readings, last, threshold, segment_rows)


# The functions below run in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rising alert. A first strict increase arms a timer, a strict decrease disarms it,
# and the next increase after it fired arms it again. Only increases and decreases
# matter, and what happens after a decrease does not depend on what was before: a
# sensor's changes fall into runs, each ended by a decrease or by the end of input.

NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class _Changes:
    """Changes of some sensors, sorted by sensor and event order."""

    names: np.ndarray
    sensor: np.ndarray
    time: np.ndarray
    rise: np.ndarray

    @classmethod
    def of(cls, pdf: pd.DataFrame) -> _Changes:
        codes, names = pd.factorize(pdf["id"])
        order = np.lexsort((pdf["seq"].to_numpy(), pdf["timestamp"].to_numpy(), codes))
        return cls(np.asarray(names), codes[order].astype(np.int64),
                   pdf["timestamp"].to_numpy(dtype=np.int64)[order],
                   pdf["_rise"].to_numpy(dtype=bool)[order])

    def follow(self, hold: int, pending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Follow the timers; ``pending`` is the due time each sensor starts with or NaN.

        Returns sensor and due time of each timer that fires, and the due time each
        sensor is left with. All runs advance together, one timer of each per round.
        """
        heads = np.diff(self.sensor, prepend=-1) > 0
        first = np.flatnonzero(heads | np.concatenate(([False], ~self.rise[:-1])))
        end = np.append(first[1:], len(self.time))
        owner = self.sensor[first]
        cutoff = np.where(self.rise[end - 1], NEVER, self.time[end - 1])

        # Times of different sensors are moved apart so that one search serves all.
        origin = int(self.time.min())
        stride = int(self.time.max()) - origin + hold + 1
        rises = np.flatnonzero(self.rise)
        clock = self.sensor[rises] * stride + (self.time[rises] - origin)
        low, high = np.searchsorted(rises, first), np.searchsorted(rises, end)

        due = np.full(len(first), NEVER)
        armed = low < high
        due[armed] = self.time[rises[low[armed]]] + hold
        carried = heads[first] & ~np.isnan(pending[owner])
        due[carried] = pending[owner[carried]].astype(np.int64)

        left = np.full(len(self.names), np.nan)
        who, when = [], []
        live = np.flatnonzero(due != NEVER)
        while len(live):
            # A timer outlives its run unless a decrease comes before it is due.
            live = live[due[live] <= cutoff[live]]
            offset = np.clip(due[live] - origin, 0, stride - 1)
            at = np.searchsorted(clock, owner[live] * stride + offset)
            again = at < high[live]
            waits = ~again & (cutoff[live] == NEVER)
            left[owner[live[waits]]] = due[live[waits]]
            who.append(owner[live[~waits]])
            when.append(due[live[~waits]])
            live, at = live[again], at[again]
            due[live] = self.time[rises[at]] + hold
        none = np.array([], dtype=np.int64)
        return np.concatenate(who or [none]), np.concatenate(when or [none]), left


def _timer_effect(pdf: pd.DataFrame, hold: int) -> pd.DataFrame:
    """How a segment of one sensor maps the timer pending at its start to that at its end.

    With a decrease inside, the end does not depend on the start. Without one, a
    timer carried in picks the first increase from its due time on: ``entry`` lists
    the increases that one can pick and ``leaving`` the timer each leads to. A timer
    is due at most ``hold`` after the segment starts, which bounds the list.
    """
    changes = _Changes.of(pdf)
    entry, leaving, fixed = [], [], np.nan
    resets = not changes.rise.all()
    if resets:
        fixed = changes.follow(hold, np.array([np.nan]))[2][0]
    else:
        times = changes.time
        follow = np.searchsorted(times, times + hold)
        jump = np.where(follow < len(times), follow, np.arange(len(times)))
        while not np.array_equal(jump[jump], jump):
            jump = jump[jump]
        reach = np.searchsorted(times, times[0] + hold, side="right") + 1
        entry, leaving = times[:reach].tolist(), (times[jump] + hold)[:reach].tolist()
    return pd.DataFrame({"id": [pdf["id"].iloc[0]], SEGMENT: [pdf[SEGMENT].iloc[0]],
                         "resets": [resets], "fixed": [fixed],
                         "entry": [entry], "leaving": [leaving]})


# Stands for the end of a sensor's input in the table of pending timers.
AT_END = -2


def _pending_timers(effects: pd.DataFrame) -> pd.DataFrame:
    """The timer pending at the start of each of one sensor's segments, and at the end."""
    effects = effects.sort_values(SEGMENT)
    pending, starts = np.nan, []
    for row in effects.itertuples(index=False):
        starts.append(pending)
        if row.resets:
            pending = row.fixed
            continue
        entry = np.asarray(row.entry)
        at = 0 if np.isnan(pending) else int(np.searchsorted(entry, pending))
        pending = row.leaving[at] if at < len(entry) else pending
    # The NaN of a timer that is not pending becomes null in Spark.
    return pd.DataFrame({"_id": effects["id"].iloc[0],
                         "_at": [*effects[SEGMENT], AT_END], "pending": [*starts, pending]})


def _warnings(pdf: pd.DataFrame, hold: int) -> pd.DataFrame:
    """Warnings of the sensors in one segment; uncut sensors also end their input here."""
    changes = _Changes.of(pdf)
    pending = pdf.groupby("id", sort=False)["pending"].first().to_numpy(dtype=float)
    who, when, left = changes.follow(hold, pending)
    if pdf[SEGMENT].iloc[0] == UNCUT:
        waiting = np.flatnonzero(~np.isnan(left))
        who = np.concatenate((who, waiting))
        when = np.concatenate((when, left[waiting].astype(np.int64)))
    return pd.DataFrame({"id": changes.names[who], "due": when})


def rising_alerts(readings: DataFrame, hold_ms: int = 1_000, *,
                  segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """A warning for each sensor that keeps rising for ``hold_ms``, with its due time.

    A timer fires before a reading at or after its due time; one still pending at
    the end of the input fires too. A previous temperature of exactly 0.0 counts as
    none. Sensors are handled many at a time, in buckets of about one segment; for
    cut sensors the timer pending at each cut comes from a small table with one row
    per segment.
    """
    total = readings.count()
    buckets = max(4 * readings.sparkSession.sparkContext.defaultParallelism,
                  ceil(4 * total / segment_rows))
    columns = readings.select("id", "timestamp", "seq", "temperature",
                              F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("_bucket"))
    cut = segments.by_key(columns, ["_bucket", "id"], EVENT_ORDER, segment_rows)
    if cut.cut is None:
        # One exchange serves the window per sensor and the grouping per bucket.
        cut = replace(cut, rows=spread.by_key(columns, "_bucket"))
    known = running.scan(cut, keep_segment=True, _prev=running.previous(F.col("temperature")))
    changes = known.filter(
        (F.col("_prev") != 0.0) & (F.col("temperature") != F.col("_prev"))).select(
        "_bucket", "id", SEGMENT, "timestamp", "seq",
        (F.col("temperature") > F.col("_prev")).alias("_rise"))

    def warnings(started: DataFrame) -> DataFrame:
        return started.groupBy("_bucket", SEGMENT).applyInPandas(
            lambda pdf: _warnings(pdf, hold_ms), "id string, due long")

    if cut.cut is None:
        fired = warnings(changes.withColumn("pending", F.lit(None).cast("double")))
    else:
        effects = changes.filter(F.col(SEGMENT) != UNCUT).groupBy("id", SEGMENT).applyInPandas(
            lambda pdf: _timer_effect(pdf, hold_ms),
            f"id string, {SEGMENT} long, resets boolean, fixed double, "
            "entry array<long>, leaving array<long>")
        timers = written(effects.groupBy("id").applyInPandas(
            _pending_timers, "_id string, _at long, pending double"), "timers")
        started = changes.join(
            timers, (F.col("id") == F.col("_id")) & (F.col(SEGMENT) == F.col("_at")), "left")
        at_end = timers.filter((F.col("_at") == AT_END) & F.col("pending").isNotNull())
        fired = warnings(started).unionByName(
            at_end.select(F.col("_id").alias("id"), F.col("pending").cast("long").alias("due")))
    message = F.concat(F.lit(texts.RISING_BEFORE_ID), F.col("id"),
                       F.lit(texts.RISING_AFTER_ID))
    return fired.select("id", F.col("due").alias("timestamp"), message.alias("message"))
