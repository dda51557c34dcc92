"""Running values over ordered groups that may be cut into segments.

A running value is described by three expressions: its value inside one segment
(a window function), the contribution of a whole segment (an aggregate, combined
map-side), and how the contributions of earlier segments join the inner value.
``scan`` puts all requested values into one window, so one shuffle and one sort
serve them all, and looks at earlier segments only for groups that were cut.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidegauge.plans.rank import rank
from tidegauge.plans.segments import SEGMENT, UNCUT, Segments


@dataclass(frozen=True)
class Running:
    inside: Callable[[WindowSpec], Column]
    total: Callable[[Column], Column]
    earlier: Callable[[Column, WindowSpec], Column]
    combine: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda c: c


def _upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_sum(value: Column) -> Running:
    return Running(
        inside=lambda w: F.sum(value).over(_upto(w)),
        total=lambda _: F.sum(value),
        earlier=lambda total, w: F.sum(total).over(w),
        combine=lambda inner, outer: F.when(outer.isNull(), inner)
        .otherwise(outer + F.coalesce(inner, F.lit(0))),
    )


def running_count() -> Running:
    """Number of rows up to and including the current one."""
    return Running(
        inside=lambda w: F.row_number().over(w).cast("long"),
        total=lambda _: F.count(F.lit(1)),
        earlier=lambda total, w: F.sum(total).over(w),
        combine=lambda inner, outer: inner + F.coalesce(outer, F.lit(0)),
    )


def running_max(value: Column, *, include_current: bool = True) -> Running:
    """Greatest value so far; a struct compares field by field."""
    frame = _upto if include_current else _before
    return Running(
        inside=lambda w: F.max(value).over(frame(w)),
        total=lambda _: F.max(value),
        earlier=lambda total, w: F.max(total).over(w),
        combine=F.greatest,
    )


def first_of(value: Column) -> Running:
    """Value of the group's first row."""
    boxed = F.struct(value.alias("v"))
    return Running(
        inside=lambda w: F.first(boxed).over(_upto(w)),
        total=lambda order: F.min_by(boxed, order),
        earlier=lambda total, w: F.first(total, ignorenulls=True).over(w),
        combine=lambda inner, outer: F.coalesce(outer, inner),
        finish=lambda c: c["v"],
    )


def latest(value: Column, *, include_current: bool = True) -> Running:
    """Last value so far that is not null."""
    frame = _upto if include_current else _before
    return Running(
        inside=lambda w: F.last(value, ignorenulls=True).over(frame(w)),
        total=lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        earlier=lambda total, w: F.last(total, ignorenulls=True).over(w),
        combine=F.coalesce,
    )


def previous(value: Column) -> Running:
    """Value of the row just before, null on the first row."""
    boxed = F.struct(value.alias("v"))
    return Running(
        inside=lambda w: F.lag(boxed).over(w),
        total=lambda order: F.max_by(boxed, order),
        earlier=lambda total, w: F.last(total, ignorenulls=True).over(w),
        combine=F.coalesce,
        finish=lambda c: c["v"],
    )


def running_concat(items: Column) -> Running:
    """Concatenation of the array column over all rows so far."""
    def joined_in_order(order: Column) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), items.alias("v"))))
        return F.flatten(F.transform(pairs, lambda p: p["v"]))

    return Running(
        inside=lambda w: F.flatten(F.collect_list(items).over(_upto(w))),
        total=joined_in_order,
        earlier=lambda total, w: F.flatten(F.collect_list(total).over(w)),
        combine=lambda inner, outer: F.when(outer.isNull(), inner)
        .otherwise(F.concat(outer, inner)),
    )


def scan(segments: Segments, *, keep_segment: bool = False, **values: Running) -> DataFrame:
    """Add one column per running value."""
    window = Window.partitionBy(*segments.group).orderBy(*segments.order)
    inner = segments.rows.withColumns({n: v.inside(window) for n, v in values.items()})
    if segments.cut is None:
        done = inner.withColumns({n: v.finish(F.col(n)) for n, v in values.items()})
        return done.withColumn(SEGMENT, F.lit(UNCUT).cast("long")) if keep_segment else done

    # One row per segment of a cut group: a small table, ordered within its key.
    order = rank(segments.cut, segments.order)
    totals = segments.cut.groupBy(*segments.group).agg(
        *[v.total(order).alias(f"_total_{n}") for n, v in values.items()])
    before = _before(Window.partitionBy(*segments.key).orderBy(SEGMENT))
    carried = totals.select(
        *[F.col(g).alias(f"_of_{g}") for g in segments.group],
        *[v.earlier(F.col(f"_total_{n}"), before).alias(f"_carried_{n}")
          for n, v in values.items()])
    # No hint: adaptive execution broadcasts it if its measured size allows, and
    # the rows are already partitioned by the join columns if not.
    matches = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in segments.group])
    joined = inner.join(carried, matches, "left")
    return joined.withColumns({
        n: v.finish(v.combine(F.col(n), F.col(f"_carried_{n}"))) for n, v in values.items()
    }).drop(*carried.columns, *(() if keep_segment else (SEGMENT,)))
