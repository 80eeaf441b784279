"""Date windows: which days a run covers and how they are cut into chunks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.spec import EVENTS_RETENTION_DAYS, MAX_CHUNK_DAYS

ONE_DAY = dt.timedelta(days=1)


def chunk_count(start: dt.date, end: dt.date, max_days: int = MAX_CHUNK_DAYS) -> int:
    """How many chunks ``chunk_starts`` gives for fixed dates."""
    return -(-_span_days(start, end) // max_days)


def _span_days(first: dt.date, last: dt.date) -> int:
    """Days from ``first`` to ``last``, both included; a window cannot end before it begins."""
    days = last.toordinal() - first.toordinal() + 1
    if days < 1:
        raise ValueError(f"no day lies between {first} and {last}")
    return days


def chunk_starts(start: Column, end: Column, max_days: int = MAX_CHUNK_DAYS) -> Column:
    """Array of chunk start dates covering [start, end]; empty if start is after end."""
    step = F.make_dt_interval(days=F.lit(max_days))
    return F.when(start <= end, F.sequence(start, end, step)).otherwise(
        F.array().cast("array<date>")
    )


def chunk_end(chunk_start: Column, end: Column, max_days: int = MAX_CHUNK_DAYS) -> Column:
    return F.least(F.date_add(chunk_start, max_days - 1), end)


def at_midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def in_window(t: Column, start: Column, end: Column) -> Column:
    """Half open: from ``start`` 00:00 up to, not including, the day after ``end``."""
    return (t >= at_midnight(start)) & (t < at_midnight(F.date_add(end, 1)))


def backfill_window(
    today: dt.date,
    start: dt.date | None = None,
    end: dt.date | None = None,
    retention_days: int = EVENTS_RETENTION_DAYS,
) -> tuple[dt.date, dt.date]:
    """Explicit dates win; the default is the whole retention span up to yesterday."""
    last = today - ONE_DAY if end is None else end
    span = dt.timedelta(days=retention_days - 1)
    window = (last - span if start is None else start, last)
    _span_days(*window)
    return window


def daily_window(
    today: dt.date,
    date: dt.date | None = None,
    from_date: dt.date | None = None,
    to_date: dt.date | None = None,
    lookback_days: int = 1,
    retention_days: int = EVENTS_RETENTION_DAYS,
) -> tuple[dt.date, dt.date]:
    """An explicit date wins over a configured from/to, which wins over the lookback."""
    if lookback_days not in range(1, retention_days + 1):
        raise ValueError(f"a lookback of {lookback_days} days; 1 to {retention_days} are kept")
    if to_date is not None and from_date is None:
        raise ValueError("a window end needs a window start")
    if date is not None:
        return date, date
    yesterday = today - ONE_DAY
    if from_date is None:
        return yesterday - (lookback_days - 1) * ONE_DAY, yesterday
    last = yesterday if to_date is None else to_date
    _span_days(from_date, last)
    return from_date, last


def daily_window_columns(
    today: Column, date: Column, from_date: Column, to_date: Column, lookback_days: Column
) -> tuple[Column, Column]:
    """``daily_window`` over columns, for planning many runs at once."""
    yesterday = F.date_sub(today, 1)
    start = F.coalesce(date, from_date, F.date_sub(today, lookback_days.cast("int")))
    end = F.when(date.isNotNull(), date).otherwise(
        F.when(from_date.isNotNull(), F.coalesce(to_date, yesterday)).otherwise(yesterday)
    )
    return start, end


def before_floor(day: Column, today: Column, retention_days: int = EVENTS_RETENTION_DAYS) -> Column:
    """True where ``day`` is older than retention; the floor itself is fine."""
    return day < F.date_sub(today, retention_days)


def clamped_start(
    start: Column, today: Column, retention_days: int = EVENTS_RETENTION_DAYS
) -> Column:
    return F.greatest(start, F.date_sub(today, retention_days))
