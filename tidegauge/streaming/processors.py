"""Keyed state for streams of readings.

The rows one key has in a micro-batch are put in event order and handled with
array operations; state per key is a few numbers. Bound the size of a micro-batch
at the source (``maxFilesPerTrigger``, ``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``):
it also bounds what a hot key brings to one task.

An event-time timer fires after the rows of a micro-batch, once the watermark has
passed it. Where a reading must see the effect of an earlier timer, the rule is
applied to the reading's own time, and the timer only settles keys that fell silent.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DoubleType, LongType, StringType,
                               StructField, StructType)

from tidegauge import texts

# These classes run in Python workers, which need not have this package.
for module in (sys.modules[__name__], texts):
    cloudpickle.register_pickle_by_value(module)

ORDER = ["timestamp", "seq"]
MERGED_ORDER = ["timestamp", "kind", "seq"]
CONTROL, READING = 0, 1


def _schema(**fields: type[DataType]) -> StructType:
    # Built by hand: parsing a schema string needs a session, which a worker lacks.
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


def _in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(order, kind="stable", ignore_index=True)


class _ValueProcessor(StatefulProcessor):
    """One struct of state per key."""

    state_schema = StructType()
    output_schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_schema)

    def load(self, default: tuple) -> tuple:
        known = self.state.get()
        return default if known is None else known

    def move_timer(self, old: int | None, new: int | None) -> None:
        if old == new:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if new is not None:
            self.handle.registerTimer(new)

    def close(self) -> None:
        pass


class RollingSum(_ValueProcessor):
    """Running sum of temperatures per sensor, with the first reading's time."""

    state_schema = _schema(total=DoubleType, first=LongType)
    output_schema = "id string, seq long, first_timestamp long, rolling_temperature double"

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, ORDER)
        total, first = self.load((0.0, int(pdf["timestamp"].iloc[0])))
        sums = np.cumsum(np.concatenate(([total], pdf["temperature"].to_numpy())))[1:]
        self.state.update((float(sums[-1]), first))
        yield pd.DataFrame({"id": key[0], "seq": pdf["seq"], "first_timestamp": first,
                            "rolling_temperature": sums})


class RollingMax(_ValueProcessor):
    """Warmest reading so far; of equal ones, the later."""

    state_schema = _schema(temperature=DoubleType, timestamp=LongType)
    output_schema = "id string, seq long, max_timestamp long, max_temperature double"

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, ORDER)
        top, at = self.load((-np.inf, 0))
        values = pdf["temperature"].to_numpy()
        tops = np.maximum.accumulate(np.maximum(values, top))
        holder = np.maximum.accumulate(np.where(values == tops, np.arange(len(values)), -1))
        times = np.where(holder >= 0, pdf["timestamp"].to_numpy()[holder], at)
        self.state.update((float(tops[-1]), int(times[-1])))
        yield pd.DataFrame({"id": key[0], "seq": pdf["seq"], "max_timestamp": times,
                            "max_temperature": tops})


class HighCount(_ValueProcessor):
    """Number of earlier high readings of the sensor, for each high reading.

    Columns named in ``passed`` (with their types) are passed on.
    """

    state_schema = _schema(n=LongType)
    output_schema = "id string, timestamp long, seq long, key_count long"

    def __init__(self, above: float = 10.0, **passed: str):
        self.above, self.passed = above, ["timestamp", "seq", *passed]
        for name, kind in passed.items():
            self.output_schema += f", {name} {kind}"

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, ORDER)
        pdf = pdf[pdf["temperature"] > self.above]
        if pdf.empty:
            return
        (count,) = self.load((0,))
        self.state.update((count + len(pdf),))
        yield pdf[self.passed].assign(id=key[0], key_count=count + np.arange(len(pdf)))


class RollingItems(_ValueProcessor):
    """Place of each row's items in the concatenation of all items of its key so far."""

    state_schema = _schema(n=LongType)

    def __init__(self, order: list[str], output_schema: str):
        self.order, self.output_schema = order, output_schema

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, self.order)
        (count,) = self.load((0,))
        upto = count + pdf["items"].to_numpy().cumsum()
        self.state.update((int(upto[-1]),))
        yield pdf.assign(item_from=upto - pdf["items"], item_to=upto).drop(
            columns=["items", "group"])


class SlotRanks(StatefulProcessor):
    """First step of a count per bucket: (bucket, shard) holds whole slots of time, and ranks
    the rows of a micro-batch inside their slots. Beside the rows, one row per slot says how
    many there are. Nothing is kept between micro-batches."""

    output_schema = ("kind int, slot long, n long, id string, timestamp long, seq long, "
                     "key_count long, bucket long, shard int")

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, ORDER)
        ranks = pdf.groupby("slot").cumcount() + 1
        yield pdf.assign(kind=READING, n=ranks, bucket=key[0], shard=key[1])
        sizes = pdf.groupby("slot").size()
        # No nulls beside numbers: pandas would make them floats.
        yield pd.DataFrame({"kind": CONTROL, "slot": sizes.index, "n": sizes.to_numpy(),
                            "id": None, "timestamp": 0, "seq": 0, "key_count": 0,
                            "bucket": key[0], "shard": key[1]})

    def close(self) -> None:
        pass


class SlotCarries(_ValueProcessor):
    """Second step: each shard of a bucket meets the sizes of all slots of the micro-batch, and
    adds to its own rows what earlier slots and earlier micro-batches hold."""

    state_schema = _schema(total=LongType)
    output_schema = ("id string, timestamp long, seq long, key_count long, bucket long, "
                     "shard int, bucket_count long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows))
        (total,) = self.load((0,))
        sizes = pdf[pdf["kind"] == CONTROL].groupby("slot")["n"].sum()
        carried = total + sizes.cumsum() - sizes
        self.state.update((int(total + sizes.sum()),))
        own = pdf[pdf["kind"] == READING]
        if own.empty:
            return
        counts = own["slot"].map(carried).to_numpy() + own["n"].to_numpy()
        yield own.assign(bucket=key[0], shard=key[1], bucket_count=counts)


ALERT_COLUMNS = "id string, timestamp long, temperature double, diff double"


class ChangeAlert(_ValueProcessor):
    """Readings that differ from the previous one by more than the threshold.

    With ``ttl_ms`` the previous reading is forgotten ``ttl_ms + delay_ms`` after its
    time. That is a matter of the readings' own times, so no row can be too late for it;
    a timer frees the state of a sensor when the watermark has passed that time.
    """

    state_schema = _schema(temperature=DoubleType, timestamp=LongType)
    output_schema = ALERT_COLUMNS

    def __init__(self, threshold: float = 1.7, ttl_ms: int | None = None, delay_ms: int = 0):
        self.threshold = threshold
        self.kept_ms = None if ttl_ms is None else ttl_ms + delay_ms

    def _freed(self, at: int | None) -> int | None:
        return None if at is None or self.kept_ms is None else at + self.kept_ms + 1

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, ORDER)
        last, at = self.load((0.0, None))
        values, times = pdf["temperature"].to_numpy(), pdf["timestamp"].to_numpy()
        before = np.concatenate(([last], values[:-1]))
        if self.kept_ms is not None:
            gaps = np.diff(times, prepend=times[0] if at is None else at)
            before = np.where(gaps > self.kept_ms, 0.0, before)
        newest = int(times[-1])
        # Where memory ends, a late row must not take the place of a newer one.
        if at is None or self.kept_ms is None or newest >= at:
            self.move_timer(self._freed(at), self._freed(newest))
            self.state.update((float(values[-1]), newest))
        diff = np.abs(values - before)
        yield pd.DataFrame({"id": key[0], "timestamp": times, "temperature": values,
                            "diff": diff})[diff > self.threshold]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        return iter(())


class RisingAlert(_ValueProcessor):
    """Warns when a sensor keeps rising for ``hold_ms``."""

    state_schema = _schema(temperature=DoubleType, due=LongType)
    output_schema = "id string, timestamp long, message string"

    def __init__(self, hold_ms: int = 1_000):
        self.hold_ms = hold_ms

    def _warn(self, key, times: list[int]) -> pd.DataFrame:
        text = f"{texts.RISING_BEFORE_ID}{key[0]}{texts.RISING_AFTER_ID}"
        return pd.DataFrame({"id": key[0], "timestamp": np.array(times, dtype=np.int64),
                             "message": text})

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, ORDER)
        last, armed = self.load((0.0, None))
        values, times = pdf["temperature"].to_numpy(), pdf["timestamp"].to_numpy()
        step = np.sign(values - np.concatenate(([last], values[:-1])))
        step[np.concatenate(([last], values[:-1])) == 0.0] = 0.0
        due, fired = armed, []
        for at in np.flatnonzero(step):
            if due is not None and due <= times[at]:
                fired.append(due)
                due = None
            if step[at] < 0:
                due = None
            elif due is None:
                due = int(times[at]) + self.hold_ms
        if due is not None and due <= times[-1]:
            fired.append(due)
            due = None
        self.move_timer(armed, due)
        self.state.update((float(values[-1]), due))
        yield self._warn(key, fired)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, due = self.state.get()
        if due is not None and due == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((last, None))
            yield self._warn(key, [due])


class SwitchFilter(_ValueProcessor):
    """Readings that pass while the sensor's switch is on. Input: merged rows.

    The state of a switch is freed when the watermark is ``accepted_ms`` past its end.
    """

    state_schema = _schema(until=LongType)
    output_schema = "id string, timestamp long, temperature double, seq long"

    def __init__(self, accepted_ms: int = 0):
        self.accepted_ms = accepted_ms

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, MERGED_ORDER)
        (until,) = self.load((None,))
        floor = np.iinfo(np.int64).min
        ends = pdf["until"].fillna(floor).to_numpy(dtype=np.int64)
        open_until = np.maximum.accumulate(np.concatenate(
            ([floor if until is None else until], ends)))[1:]
        latest = int(open_until[-1])
        if latest > floor and latest != until:
            self.move_timer(None if until is None else until + self.accepted_ms + 1,
                            latest + self.accepted_ms + 1)
            self.state.update((latest,))
        passes = (pdf["kind"] == READING) & (pdf["timestamp"] < open_until)
        yield pdf.loc[passes, ["timestamp", "temperature", "seq"]].assign(id=key[0])[
            ["id", "timestamp", "temperature", "seq"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        return iter(())


class LevelFilter(StatefulProcessor):
    """Readings taken while a global level holds. Input: merged rows, keyed by bucket.

    Every bucket has its own copy of the level's history and a share of the readings, so
    no task sees them all. A reading waits until the watermark has passed its time, when
    the levels up to then are there; then the latest level at or before its time counts. Of the
    history, what a reading ``accepted_ms`` behind the watermark may need is kept.
    """

    output_schema = "id string, timestamp long, temperature double, seq long"

    def __init__(self, level: str = "HIGH", accepted_ms: int = 0):
        self.level, self.accepted_ms = level, accepted_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels = handle.getListState("levels", _schema(timestamp=LongType, seq=LongType,
                                                            level=StringType))
        self.waiting = handle.getListState("waiting", _schema(
            id=StringType, timestamp=LongType, temperature=DoubleType, seq=LongType))
        self.timer = handle.getValueState("timer", _schema(at=LongType))

    def _wait_until(self, at: int) -> None:
        known = self.timer.get()
        if known is None or at < known[0]:
            if known is not None:
                self.handle.deleteTimer(known[0])
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues):
        for pdf in rows:
            control = pdf[pdf["kind"] == CONTROL]
            if len(control):
                self.levels.appendList(list(zip(
                    control["timestamp"].tolist(), control["seq"].tolist(),
                    control["level"].tolist())))
            readings = pdf[pdf["kind"] == READING]
            if len(readings):
                self.waiting.appendList(list(zip(
                    readings["id"].tolist(), readings["timestamp"].tolist(),
                    readings["temperature"].tolist(), readings["seq"].tolist())))
                # A time that has passed already makes the timer fire in this micro-batch.
                self._wait_until(int(readings["timestamp"].min()) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        levels = sorted(self.levels.get())
        times = [t for t, _, _ in levels]
        waiting = list(self.waiting.get())
        later = [row for row in waiting if row[1] >= now]
        due = sorted((row for row in waiting if row[1] < now), key=lambda r: (r[1], r[3]))
        at = np.searchsorted(times, [row[1] for row in due], side="right") - 1
        out = [row for row, i in zip(due, at.tolist()) if i >= 0 and levels[i][2] == self.level]
        needed = int(np.searchsorted(times, now - self.accepted_ms, side="left")) - 1
        if needed > 0:
            self.levels.put(levels[needed:])
        if later:
            self.waiting.put(later)
            self._wait_until(min(row[1] for row in later) + 1)
        else:
            self.waiting.clear()
        if out:
            yield pd.DataFrame(out, columns=["id", "timestamp", "temperature", "seq"])

    def close(self) -> None:
        pass


class ThresholdAlert(_ValueProcessor):
    """Alerts against the sensor's current threshold; 0.0 removes it. Input: merged rows."""

    state_schema = _schema(temperature=DoubleType, threshold=DoubleType)
    output_schema = ALERT_COLUMNS

    def handleInputRows(self, key, rows, timerValues):
        pdf = _in_order(rows, MERGED_ORDER)
        last, threshold = self.load((0.0, 0.0))
        limits = pdf["threshold"].ffill().fillna(threshold).to_numpy()
        values = pdf["temperature"]
        before = values.ffill().shift().fillna(last).to_numpy()
        known = values.ffill().fillna(last).to_numpy()
        self.state.update((float(known[-1]), float(limits[-1])))
        diff = np.abs(values.to_numpy() - before)
        hit = (pdf["kind"] == READING) & (limits != 0.0) & (diff > limits)
        yield pd.DataFrame({"id": key[0], "timestamp": pdf["timestamp"],
                            "temperature": values, "diff": diff})[hit]


class LateUpdates(_ValueProcessor):
    """Window counts with updates for late rows within the allowed lateness.

    Keyed by sensor, with its open windows in one state value: few at a time, as a
    window leaves when the watermark has passed its end by the lateness. The stream must
    accept rows of all windows that have not left (``jobs.clocked``). One timer per
    sensor waits for the next window to fire or leave.
    """

    state_schema = StructType([
        StructField("ends", ArrayType(LongType())), StructField("counts", ArrayType(LongType())),
        StructField("fired", ArrayType(BooleanType())), StructField("timer", LongType())])
    output_schema = "id string, end_ts long, readings long, result string"

    def __init__(self, lateness_ms: int = 5_000):
        self.lateness_ms = lateness_ms

    def _open(self) -> tuple[dict[int, list], int | None]:
        ends, counts, fired, timer = self.load(([], [], [], None))
        return {e: [c, f] for e, c, f in zip(ends, counts, fired)}, timer

    def _keep(self, windows: dict[int, list], timer: int | None, now: int) -> None:
        due = [end - 1 + (self.lateness_ms if fired else 0)
               for end, (_, fired) in windows.items()]
        following = min((max(d, now + 1) for d in due), default=None)
        self.move_timer(timer, following)
        if windows:
            self.state.update((list(windows), [c for c, _ in windows.values()],
                               [f for _, f in windows.values()], following))
        else:
            self.state.clear()

    def _settle(self, windows: dict[int, list], now: int) -> list[tuple]:
        """Fire and remove the windows whose time has come."""
        out = []
        for end in sorted(windows):
            count, fired = windows[end]
            if not fired and now >= end - 1:
                windows[end][1] = True
                out.append((end, count, texts.FIRST_RESULT))
            if now >= end - 1 + self.lateness_ms:
                del windows[end]
        return out

    def _rows(self, key, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            table = pd.DataFrame(out, columns=["end_ts", "readings", "result"])
            table.insert(0, "id", key[0])
            yield table

    def handleInputRows(self, key, rows, timerValues):
        ends, added = np.unique(np.concatenate([pdf["end_ts"].to_numpy() for pdf in rows]),
                                return_counts=True)
        now = timerValues.getCurrentWatermarkInMs()
        windows, timer = self._open()
        out = self._settle(windows, now)
        for end, n in zip(ends.tolist(), added.tolist()):
            count, fired = windows.get(end, (0, False))
            if now < end - 1:
                windows[end] = [count + n, False]
            elif now < end - 1 + self.lateness_ms:
                labels = [texts.UPDATED_RESULT if fired or i else texts.FIRST_RESULT
                          for i in range(n)]
                out += [(end, count + 1 + i, label) for i, label in enumerate(labels)]
                windows[end] = [count + n, True]
        self._keep(windows, timer, now)
        yield from self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        windows, _ = self._open()
        out = self._settle(windows, now)
        # The expired timer is gone already.
        self._keep(windows, None, now)
        yield from self._rows(key, out)


class Every:
    """A trigger: evaluate a window at each multiple of ``step_ms`` and at its end."""

    def __init__(self, step_ms: int):
        self.step_ms = step_ms

    def next_time(self, after: int, end: int) -> int:
        """The first evaluation later than ``after``, at most the window's end."""
        return min(after - after % self.step_ms + self.step_ms, end)


class AtEnd:
    """A trigger: evaluate a window once, at its end."""

    def next_time(self, after: int, end: int) -> int:
        return end


class AtShares:
    """A trigger: evaluate a window when given shares of it have passed, and at its end."""

    def __init__(self, size_ms: int, *shares: float):
        self.offsets = sorted(int(size_ms * share) for share in shares)
        self.size_ms = size_ms

    def next_time(self, after: int, end: int) -> int:
        start = end - self.size_ms
        return min((start + o for o in self.offsets if start + o > after), default=end)


class WindowCounts(StatefulProcessor):
    """Count of a window at each time its trigger names, of the readings before that time.

    Keyed by (id, end_ts), whatever assigner made the windows. A trigger is any object
    with ``next_time(after, end)``. State is the count so far and one count per trigger
    interval that has not been evaluated yet. Only the next evaluation has a timer, so a
    window's cost follows its readings and evaluations, each looked at once.
    """

    output_schema = "id string, end_ts long, eval_ts long, readings long"

    def __init__(self, trigger):
        self.trigger = trigger

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", _schema(tick=LongType),
                                         _schema(n=LongType))
        self.state = handle.getValueState("state", _schema(total=LongType, due=LongType))

    def _ticks(self, times: np.ndarray, end: int) -> Iterator[tuple[int, int]]:
        """(evaluation that first sees them, how many) of the readings' ascending times."""
        at = 0
        while at < len(times):
            tick = self.trigger.next_time(int(times[at]), end)
            upto = len(times) if tick >= end else int(np.searchsorted(times, tick))
            yield tick, max(upto, at + 1) - at
            at = max(upto, at + 1)

    def handleInputRows(self, key, rows, timerValues):
        end, now = key[1], timerValues.getCurrentWatermarkInMs()
        if end <= now:
            return iter(())  # the window has given its last count
        times = np.sort(np.concatenate([pdf["timestamp"].to_numpy() for pdf in rows]))
        total, due = self.state.get() or (0, None)
        first = None
        for tick, n in self._ticks(times, end):
            if due is not None and tick < due and tick <= now:
                total += n  # that evaluation is over; the next one sees them
                continue
            known = self.counts.getValue((tick,)) if self.counts.containsKey((tick,)) else (0,)
            self.counts.updateValue((tick,), (known[0] + n,))
            first = tick if first is None else first
        if first is not None and (due is None or first < due):
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(first)
            due = first
        self.state.update((total, due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        (sensor, end), now = key, timerValues.getCurrentWatermarkInMs()
        total, due = self.state.get()
        counts = {tick: n for (tick,), (n,) in self.counts.iterator()}
        pending, out = sorted(counts), []
        while due is not None and due <= now:
            while pending and pending[0] <= due:
                tick = pending.pop(0)
                total += counts[tick]
                self.counts.removeKey((tick,))
            out.append((sensor, end, due, total))
            due = self.trigger.next_time(due, end) if due < end else None
        if due is None:
            self.counts.clear()
            self.state.clear()
        else:
            self.handle.registerTimer(due)
            self.state.update((total, due))
        yield pd.DataFrame(out, columns=["id", "end_ts", "eval_ts", "readings"])

    def close(self) -> None:
        pass


class LateMarker(StatefulProcessor):
    """Each row with the watermark it met, and whether that had passed its deadline."""

    output_schema = ("id string, timestamp long, temperature double, seq long, late boolean, "
                     "watermark long")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            # A watermark of 0 stands for none yet.
            late = (pdf["deadline"] < now) & (now > 0)
            met = pd.array([now if now > 0 else None] * len(pdf), dtype="Int64")
            yield pdf[["timestamp", "temperature", "seq"]].assign(
                id=key[0], late=late, watermark=met)[
                ["id", "timestamp", "temperature", "seq", "late", "watermark"]]

    def close(self) -> None:
        pass
