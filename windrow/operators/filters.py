"""Row filters on a raw report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.spec import EVENTS, ReportSpec


def equals(column: str, value: str) -> Column:
    """Exact match; NULL never matches."""
    if not value.strip():
        raise ValueError(f"blank filter value for {column}")
    return F.col(column) == F.lit(value)


def one_of(column: str, values: Sequence[str]) -> Column:
    """Exact membership.  An empty list is refused: it would drop every row."""
    if isinstance(values, str):
        raise TypeError(f"filter for {column} must be a list of values, not one text")
    if not values or any(not v.strip() for v in values):
        raise ValueError(f"empty or blank filter list for {column}")
    return F.col(column).isin(list(values))


def report_predicate(
    columns: Sequence[str],
    media_source: str | None = None,
    event_names: Sequence[str] | None = None,
    spec: ReportSpec = EVENTS,
) -> Column:
    """Absent means no filter, a value filters, a blank value is an error.  Never NULL.

    A report without an event name column, such as installs, has no event filter.
    """
    wanted = F.lit(True)
    if media_source is not None:
        wanted = wanted & equals(spec.raw_name("media_source"), media_source)
    if event_names is not None:
        membership = one_of(spec.raw_name("event_name"), event_names)
        if spec.raw_name("event_name") in columns:
            wanted = wanted & membership
    return F.coalesce(wanted, F.lit(False))


def filter_report(
    raw: DataFrame,
    media_source: str | None = None,
    event_names: Sequence[str] | None = None,
    spec: ReportSpec = EVENTS,
) -> DataFrame:
    """Filter raw text, before parsing, so rows that are dropped are never validated."""
    return raw.filter(report_predicate(raw.columns, media_source, event_names, spec))
