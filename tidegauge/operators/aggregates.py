"""Aggregates of one's own over windows, combined on both sides of the shuffle.

An aggregate is given by what it makes of single values (create and add), how two
accumulators are merged, and the result of one. Fields of accumulators are arrays, and
merging is a NumPy ufunc per field, so tasks work on many windows at once. Every task sends
one accumulator per key and window it has seen, whatever the number of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tidegauge.operators.windows import assign

# The functions below run in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Accumulators that a task holds before it sends some.
HELD = 1 << 18


@dataclass(frozen=True)
class Aggregate:
    """``lift`` makes the accumulator fields of single values, ``merges`` joins two
    accumulators field by field, ``result`` makes results of accumulator fields."""

    lift: Callable[[np.ndarray], Sequence[np.ndarray]]
    merges: Sequence[np.ufunc]
    result: Callable[..., np.ndarray]


MEAN = Aggregate(lambda v: (v, np.ones(len(v))), (np.add, np.add), lambda s, n: s / n)
SPREAD = Aggregate(lambda v: (v, v), (np.minimum, np.maximum), lambda low, high: high - low)


@dataclass
class _Groups:
    """Accumulators by id and window; one group may stand in several rows."""

    ids: pa.Array
    ends: np.ndarray
    fields: list[np.ndarray]

    @staticmethod
    def joined(parts: list[_Groups]) -> _Groups:
        return _Groups(pa.concat_arrays([p.ids for p in parts]),
                       np.concatenate([p.ends for p in parts]),
                       [np.concatenate(f) for f in zip(*(p.fields for p in parts))])

    def merged(self, merges: Sequence[np.ufunc]) -> _Groups:
        """One row per group, in order of first appearance of ids, then of ends."""
        if not len(self.ends):
            return self
        codes = self.ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        order = np.lexsort((self.ends, codes))
        codes, ends = codes[order], self.ends[order]
        new = np.ones(len(ends), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (ends[1:] != ends[:-1])
        at = np.flatnonzero(new)
        return _Groups(self.ids.take(pa.array(order[at])), ends[at],
                       [m.reduceat(f[order], at) for m, f in zip(merges, self.fields)])

    def batch(self) -> pa.RecordBatch:
        names = [f"f{i}" for i in range(len(self.fields))]
        return pa.RecordBatch.from_arrays(
            [self.ids, pa.array(self.ends), *map(pa.array, self.fields)],
            ["id", "end_ts", *names])


def partials(readings: DataFrame, size_ms: int, aggregate: Aggregate,
             value: str = "temperature") -> DataFrame:
    """id, end_ts and accumulator fields, about one row per task, id and window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Groups] = []
        size = 0
        for batch in batches:
            values = batch.column("value").to_numpy(zero_copy_only=False)
            fields = [np.asarray(f, float) for f in aggregate.lift(values)]
            held.append(_Groups(batch.column("id"), batch.column("end_ts").to_numpy(
                zero_copy_only=False), fields))
            size += batch.num_rows
            if size >= HELD:
                held = [_Groups.joined(held).merged(aggregate.merges)]
                size = len(held[0].ends)
                if size > HELD // 2:
                    yield held.pop().batch()
                    size = 0
        if held:
            yield _Groups.joined(held).merged(aggregate.merges).batch()

    rows = assign(readings, size_ms).select("id", "end_ts", readings[value].cast("double")
                                            .alias("value")).filter("value is not null")
    fields = ", ".join(f"f{i} double" for i in range(len(aggregate.merges)))
    return rows.mapInArrow(run, f"id string, end_ts long, {fields}")


def windowed(readings: DataFrame, size_ms: int, aggregate: Aggregate,
             value: str = "temperature", name: str = "result") -> DataFrame:
    """id, end_ts and the aggregate of ``value`` per id and tumbling window, nulls left out.

    Accumulators are merged in sorted order as they come, so a task holds one batch of them,
    and a group has as many as there are tasks, not rows.
    """
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[_Groups] = []

        def done(groups: _Groups) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [groups.ids, pa.array(groups.ends),
                 pa.array(np.asarray(aggregate.result(*groups.fields), float))],
                ["id", "end_ts", name])

        for batch in batches:
            groups = _Groups(batch.column(0), batch.column(1).to_numpy(),
                             [c.to_numpy() for c in batch.columns[2:]])
            groups = _Groups.joined([*before, groups]).merged(aggregate.merges)
            # The last group of the order may go on in the next batch.
            last = len(groups.ends) - 1
            if last < 0:
                continue
            tail = batch.num_rows and (batch.column(0)[-1].as_py(), batch.column(1)[-1].as_py())
            at = next((i for i in range(last, -1, -1) if not tail or (
                groups.ids[i].as_py(), int(groups.ends[i])) == tail))
            keep = np.arange(last + 1) != at
            before = [_Groups(groups.ids.slice(at, 1), groups.ends[at:at + 1],
                              [f[at:at + 1] for f in groups.fields])]
            yield done(_Groups(groups.ids.filter(pa.array(keep)), groups.ends[keep],
                               [f[keep] for f in groups.fields]))
        for groups in before:
            yield done(groups)

    parts = partials(readings, size_ms, aggregate, value)
    placed = parts.repartition("id", "end_ts").sortWithinPartitions("id", "end_ts")
    return placed.mapInArrow(finish, f"id string, end_ts long, {name} double")
