"""Date windows: chunks, defaults, precedence, floors."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from windrow.functions.dates import (
    backfill_window,
    chunk_count,
    daily_window,
    daily_window_columns,
)
from windrow.operators.work_items import expand_windows, halve_windows, work_items
from windrow.spec import INSTALLS

D = dt.date


def pairs(items):
    return [(r.start_date, r.end_date) for r in items.df.orderBy("seq").collect()]


def test_chunks_of_a_quarter(spark):
    items = work_items(spark, ["a"], D(2026, 1, 1), D(2026, 3, 31), attribution_types=["x"])
    assert pairs(items) == [
        (D(2026, 1, 1), D(2026, 1, 31)),
        (D(2026, 2, 1), D(2026, 3, 3)),
        (D(2026, 3, 4), D(2026, 3, 31)),
    ]
    assert (items.count, items.days) == (3, 90)


@pytest.mark.parametrize("days", [1, 30, 31, 32, 62, 63, 400])
def test_chunks_cover_the_range_once(spark, days):
    start, end = D(2026, 1, 1), D(2026, 1, 1) + dt.timedelta(days=days - 1)
    items = work_items(spark, ["a"], start, end, attribution_types=["x"])
    covered = []
    for s, e in pairs(items):
        assert 1 <= (e - s).days + 1 <= 31
        covered += [s + dt.timedelta(days=i) for i in range((e - s).days + 1)]
    assert covered == [start + dt.timedelta(days=i) for i in range(days)]
    assert items.count == len(pairs(items)) == chunk_count(start, end)


def test_every_app_and_type_in_order(spark):
    items = work_items(spark, ["b", "a"], D(2026, 1, 1), D(2026, 2, 10))
    rows = items.df.orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(8)) and items.count == 8
    assert [(r.app_id, r.attribution_type) for r in rows[::2]] == [
        ("b", "non_organic"), ("b", "retargeting"), ("a", "non_organic"), ("a", "retargeting"),
    ]


def test_bad_spans_are_refused(spark):
    with pytest.raises(ValueError):
        work_items(spark, ["a"], D(2026, 1, 2), D(2026, 1, 1))
    with pytest.raises(ValueError):
        work_items(spark, [], D(2026, 1, 1), D(2026, 1, 1))
    spans = spark.createDataFrame(
        [("a", D(2026, 1, 2), D(2026, 1, 1))], "app_id string, start_date date, end_date date"
    )
    assert expand_windows(spans).isEmpty()


def test_backfill_defaults():
    assert backfill_window(D(2026, 7, 7)) == (D(2026, 4, 8), D(2026, 7, 6))
    assert backfill_window(D(2026, 7, 7), end=D(2026, 6, 1)) == (D(2026, 3, 4), D(2026, 6, 1))
    assert backfill_window(D(2026, 7, 7), D(2026, 1, 1), D(2026, 1, 5))[0] == D(2026, 1, 1)
    with pytest.raises(ValueError):
        backfill_window(D(2026, 7, 7), start=D(2026, 7, 7))


TODAY = D(2026, 7, 7)
CASES = [
    ({}, (D(2026, 7, 6), D(2026, 7, 6))),
    ({"lookback_days": 3}, (D(2026, 7, 4), D(2026, 7, 6))),
    ({"lookback_days": 3, "date": D(2026, 6, 1)}, (D(2026, 6, 1), D(2026, 6, 1))),
    ({"lookback_days": 3, "from_date": D(2026, 6, 1)}, (D(2026, 6, 1), D(2026, 7, 6))),
    (
        {"from_date": D(2026, 6, 1), "to_date": D(2026, 6, 9)},
        (D(2026, 6, 1), D(2026, 6, 9)),
    ),
    (
        {"date": D(2026, 5, 1), "from_date": D(2026, 6, 1), "to_date": D(2026, 6, 9)},
        (D(2026, 5, 1), D(2026, 5, 1)),
    ),
]


@pytest.mark.parametrize("given, expected", CASES)
def test_daily_precedence(spark, given, expected):
    assert daily_window(TODAY, **given) == expected
    lit = {k: F.lit(given.get(k)).cast("date") for k in ("date", "from_date", "to_date")}
    start, end = daily_window_columns(
        F.lit(TODAY), lit["date"], lit["from_date"], lit["to_date"],
        F.lit(given.get("lookback_days", 1)),
    )
    assert tuple(spark.range(1).select(start, end).first()) == expected


@pytest.mark.parametrize(
    "given",
    [{"lookback_days": 0}, {"lookback_days": 91}, {"to_date": D(2026, 6, 1)},
     {"from_date": D(2026, 6, 2), "to_date": D(2026, 6, 1)}, {"from_date": D(2026, 7, 7)}],
)
def test_daily_refuses(given):
    with pytest.raises(ValueError):
        daily_window(TODAY, **given)


def test_floor_is_flagged_not_clamped(spark):
    today = D(2026, 7, 9)
    at = work_items(spark, ["a"], D(2026, 4, 10), D(2026, 4, 12), today=today)
    below = work_items(spark, ["a"], D(2026, 4, 9), D(2026, 4, 12), today=today)
    assert {r.before_floor for r in at.df.collect()} == {False}
    assert {(r.start_date, r.before_floor) for r in below.df.collect()} == {(D(2026, 4, 9), True)}


def test_clamped_family(spark):
    today = D(2026, 7, 9)
    items = work_items(spark, ["a"], D(2026, 1, 1), D(2026, 7, 8), INSTALLS, today=today)
    assert pairs(items)[0][0] == D(2026, 5, 10)
    gone = work_items(spark, ["a"], D(2026, 1, 1), D(2026, 2, 1), INSTALLS, today=today)
    assert gone.count == 0 and gone.df.isEmpty()


def test_halving(spark):
    df = spark.createDataFrame(
        [("a", "x", D(2026, 1, 1), D(2026, 1, 31)), ("a", "x", D(2026, 2, 1), D(2026, 2, 1)),
         ("a", "x", D(2026, 3, 1), D(2026, 3, 2))],
        "app_id string, attribution_type string, start_date date, end_date date",
    )
    got = [tuple(r)[2:] for r in halve_windows(df).orderBy("start_date").collect()]
    assert got == [
        (D(2026, 1, 1), D(2026, 1, 16), True),
        (D(2026, 1, 17), D(2026, 1, 31), True),
        (D(2026, 2, 1), D(2026, 2, 1), False),
        (D(2026, 3, 1), D(2026, 3, 1), True),
        (D(2026, 3, 2), D(2026, 3, 2), True),
    ]
