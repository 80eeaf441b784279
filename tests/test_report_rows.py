"""Typing, filtering, validating and deduplicating the rows of one report."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE_ROW
from windrow.functions.typed import failed, parse_decimal, parse_timestamp
from windrow.operators.dedup import collapse_counters, keep_latest
from windrow.operators.filters import filter_report
from windrow.operators.validate import (
    at_table_scale,
    first_errors,
    missing_headers,
    quarantine,
    type_report,
)
from windrow.spec import EVENTS, EVENT_COLUMNS, INSTALLS, TABLE_COLUMNS, WINDOW_COLS

SOURCE, NAMES = BASE_ROW["Media Source"], [BASE_ROW["Event Name"], "another event"]


def load(raw):
    typed = type_report(filter_report(raw, SOURCE, NAMES))
    assert typed.filter("error IS NOT NULL").isEmpty()
    return at_table_scale(keep_latest(typed)).orderBy("row_ord").collect()


def error_of(raw):
    found = first_errors(type_report(filter_report(raw, SOURCE, NAMES))).collect()
    return found[0].error if found else None


def test_maps_and_tags(report):
    typed = at_table_scale(type_report(report({})))
    assert set(TABLE_COLUMNS) < set(typed.columns)
    assert "Region" not in typed.columns
    row = typed.first()
    assert row.event_time == dt.datetime(2023, 3, 4, 17, 42, 11)
    assert row.event_revenue == Decimal("12.5000")
    assert (row.app_id, row.attribution_type, row.device_id) == (
        "app1",
        "non_organic",
        BASE_ROW["Device ID"],
    )
    assert dict(typed.dtypes)["event_time"] == "timestamp_ntz"
    assert dict(typed.dtypes)["event_revenue"] == "decimal(18,4)"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_times_are_verbatim_in_any_session_zone(spark, report, zone):
    texts = ["2026-05-20 23:59:59", "2026-05-20 00:00:00", "2026-03-08 02:30:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = load(report(*[{"Event Time": t} for t in texts]))
        assert [str(r.event_time) for r in rows] == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "override", [{"Media Source": "Other Ads"}, {"Event Name": "login"}, {"Media Source": None}]
)
def test_filters_drop_other_rows(report, override):
    assert load(report(override)) == []


def test_absent_filters_keep_everything(report):
    raw = report({"Media Source": None}, {"Event Name": "login"})
    assert filter_report(raw).count() == 2
    assert filter_report(raw, event_names=["login"]).count() == 1


@pytest.mark.parametrize("blank", ["", "  "])
def test_blank_filters_are_refused(report, blank):
    with pytest.raises(ValueError):
        filter_report(report({}), media_source=blank)
    with pytest.raises(ValueError):
        filter_report(report({}), event_names=[blank])
    with pytest.raises(ValueError):
        filter_report(report({}), event_names=[])
    with pytest.raises(TypeError):
        filter_report(report({}), event_names="spend")


@pytest.mark.parametrize("blank", [None, "", "   ", "\xa0"])
def test_blank_optional_fields(report, blank):
    row = load(report({"Install Time": blank, "Event Revenue": blank}))[0]
    assert row.install_time is None and row.event_revenue is None


@pytest.mark.parametrize(
    "override, column",
    [
        ({"Device ID": ""}, "device_id"),
        ({"Device ID": None}, "device_id"),
        ({"Event Time": " "}, "event_time"),
        ({"Event Revenue": "seven"}, "event_revenue"),
        ({"Event Time": "a spring morning"}, "event_time"),
        ({"Install Time": "2026-02-30 10:00:00"}, "install_time"),
        ({"Event Revenue": "1e30"}, "event_revenue"),
        ({"Event Revenue": "99999999999999.99995"}, "event_revenue"),
    ],
)
def test_bad_rows_name_the_field(report, override, column):
    assert column in error_of(report({}, override))


def test_blank_but_not_empty_name_passes_the_report_path(report):
    typed = type_report(report({"Event Name": "  "}))
    assert typed.first().error is None


def test_first_error_in_report_and_field_order(report):
    raw = report({}, {"Event Revenue": "x", "Install Time": "y"}, {"Event Time": "z"})
    assert error_of(raw) == "install_time is not a timestamp: 'y'"


def test_dropped_rows_are_never_validated(report):
    assert error_of(report({"Media Source": "Other", "Event Revenue": "n/a"}, {})) is None


def test_bad_window_loses_all_rows_and_no_other(report):
    bad = report({}, {"Event Revenue": "x"}, {"Device ID": "d2"})
    good = report({}, window={"app_id": "app2"})
    typed = type_report(bad.unionByName(good))
    for bound in (2, None, 10**9):
        kept = quarantine(typed, first_errors(typed), bound).collect()
        assert [r.app_id for r in kept] == ["app2"]


def test_flag_of_primary_attribution_is_ignored(report):
    assert len(load(report({"Is Primary Attribution": "false"}))) == 1
    assert len(load(report({}, drop=["Is Primary Attribution"]))) == 1


def test_missing_headers():
    assert missing_headers([*EVENT_COLUMNS, "Extra"]) == []
    assert missing_headers([h for h in EVENT_COLUMNS if h != "Event Time"]) == ["Event Time"]


def test_vendor_headers(report):
    spec = EVENTS.with_raw_names(device_id="Vendor Device")
    raw = report({}).withColumnRenamed("Device ID", "Vendor Device")
    assert missing_headers(raw.columns, spec) == []
    assert type_report(raw, spec).first().device_id == BASE_ROW["Device ID"]
    installs = INSTALLS.with_raw_names(device_id="Vendor Device")
    assert missing_headers(raw.columns, installs) == []
    with pytest.raises(ValueError):
        EVENTS.with_raw_names(nothing="X")


# --- duplicates -------------------------------------------------------------------


def counters(raw):
    typed = type_report(raw)
    found = collapse_counters(typed.drop("error"), WINDOW_COLS).collect()
    if not found:
        return (0, 0, 0, 0, None)
    c = found[0]
    return (c.exact_duplicates, c.conflicts, c.ties, c.discarded_revenue, c.first_conflict)


def test_exact_duplicate_collapses(report):
    raw = report({}, {})
    assert len(load(raw)) == 1
    assert counters(raw)[:4] == (1, 0, 0, 0)


def test_same_number_in_other_spelling_is_an_exact_duplicate(report):
    assert counters(report({"Event Revenue": "10.0"}, {"Event Revenue": "10.00"}))[:2] == (1, 0)


OLD, NEW = {"Install Time": "2026-05-01 00:00:00"}, {"Install Time": "2026-05-02 00:00:00"}


@pytest.mark.parametrize("newest_first, lost", [(True, 21), (False, 17)])
def test_later_install_wins(report, newest_first, lost):
    pair = [{**NEW, "Event Revenue": "17"}, {**OLD, "Event Revenue": "21"}]
    if not newest_first:
        pair = [{**OLD, "Event Revenue": "17"}, {**NEW, "Event Revenue": "21"}]
    raw = report(*pair)
    assert [r.install_time for r in load(raw)] == [dt.datetime(2026, 5, 2)]
    assert counters(raw)[:4] == (0, 1, 0, lost)


@pytest.mark.parametrize("blank_first", [True, False])
def test_null_install_loses(report, blank_first):
    pair = [{"Install Time": "", "Event Revenue": "17"}, {"Event Revenue": "21"}]
    raw = report(*(pair if blank_first else reversed(pair)))
    assert load(raw)[0].event_revenue == 21
    assert counters(raw)[:4] == (0, 1, 0, 17)


def test_tie_goes_to_the_last_row(report):
    raw = report({"Event Revenue": "3"}, {"Event Revenue": "4"})
    assert load(raw)[0].event_revenue == 4
    assert counters(raw)[:4] == (0, 1, 1, 3)


def test_two_conflicts_report_the_first_key(report):
    raw = report(
        {"Device ID": "b", "Event Revenue": "3"},
        {"Device ID": "a", "Event Revenue": "5"},
        {"Device ID": "b", "Event Revenue": "4"},
        {"Device ID": "a", "Event Revenue": "6"},
    )
    assert len(load(raw)) == 2
    dups, conflicts, ties, lost, first = counters(raw)
    assert (dups, conflicts, lost, first.device_id) == (0, 2, 8, "b")


def test_counters_stay_separate(report):
    raw = report({}, {}, {"Device ID": "d2", "Event Revenue": "1"}, {"Device ID": "d2"})
    assert counters(raw)[:3] == (1, 1, 1)


def test_null_revenue_loser_counts_as_zero(report):
    assert counters(report({"Event Revenue": ""}, {"Event Revenue": "4"}))[3] == 0


def test_a_b_a_conflicts_twice(report):
    raw = report({"Event Revenue": "3"}, {"Event Revenue": "4"}, {"Event Revenue": "3"})
    assert counters(raw)[:4] == (0, 2, 2, 7)


def test_no_merge_across_attribution_types(report):
    both = report({}).unionByName(report({}, window={"attribution_type": "retargeting"}))
    assert keep_latest(type_report(both)).count() == 2


# --- parsers ----------------------------------------------------------------------


def test_timestamps_agree_with_strptime(spark):
    import itertools

    texts = [
        f"{y}-{m}-{d}{gap}{h}:{mi}:{s}"
        for y, m, d, gap, (h, mi, s) in itertools.product(
            ["2024", "0000", "0001", "24", "9999", "12024"],
            ["1", "02", "13", "00"],
            ["5", "05", " 5", "30", "31", "32", "0"],
            [" ", "   ", "\t", " ", "T", ""],
            [("0", "0", "0"), ("23", "59", "59"), ("24", "0", "0"), ("1", "60", "1"),
             ("1", "1", "60"), ("01", "1", "61"), ("1", "1", "1.5")],
        )
    ]
    base = "2024-01-05 10:00:00"
    texts += [base + "\n", " " + base, base + " ", base + "Z", base[:16], base[:10], "", " "]

    def expected(text):
        try:
            return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    parsed = parse_timestamp(F.col("t"))
    got = df.select("i", parsed.alias("p"), failed(F.col("t"), parsed).alias("bad"))
    for row in got.collect():
        want = expected(texts[row.i])
        assert row.p == want, repr(texts[row.i])
        assert row.bad == (want is None and texts[row.i].strip() != ""), repr(texts[row.i])


@pytest.mark.parametrize(
    "text", [" 9.99 ", "1e3", "+5", ".5", "5.", "1_000", "-0.010", "12E-2", "007", "\xa03\n"]
)
def test_decimals_accepted(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_decimal(F.col("t"))).first()[0] == Decimal(text)


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-inf", "1,5", "x", "1 000", "--1", "e3"])
def test_decimals_refused(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    parsed = parse_decimal(F.col("t"))
    assert tuple(df.select(parsed, failed(F.col("t"), parsed)).first()) == (None, True)
