"""Date-window predicates and day arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def date_filter(day: Column, start: date | None = None, end: date | None = None) -> Column:
    """``start <= day <= end``, either side open."""
    return interval_overlap(day, None, start, end)


def interval_overlap(
    begin: Column,
    finish: Column | None,
    start: date | None = None,
    end: date | None = None,
    coalesce_end: bool = False,
) -> Column:
    """The interval [begin, finish] touches [start, end].

    A missing ``finish`` column means a one-day interval. Rows whose finish is NULL are dropped unless
    ``coalesce_end`` lets them end on the day they begin.
    """
    if finish is None:
        finish = begin
    elif coalesce_end:
        finish = F.coalesce(finish, begin)
    hit = F.lit(True)
    if start is not None:
        hit = hit & (finish >= F.lit(start))
    if end is not None:
        hit = hit & (begin <= F.lit(end))
    return hit


def is_in_outcome(day: Column, index_day: Column, outcome_days: int, end_day: Column | None = None) -> Column:
    """The day (or the stay that ends on ``end_day``) touches the outcome window that opens on the index day."""
    last = day if end_day is None else F.coalesce(end_day, day)
    return (index_day <= last) & (day <= F.date_add(index_day, outcome_days))


def is_in_baseline(day: Column, index_day: Column, baseline_days: int) -> Column:
    """The day falls in the baseline window, which closes the day before the index day."""
    return (F.date_sub(index_day, baseline_days) <= day) & (day < index_day)


def days_since_1960(moment: Column) -> Column:
    """Whole days from 1960-01-01, the day-number form of a date or timestamp."""
    return F.datediff(moment.cast("date"), F.lit(date(1960, 1, 1)))
