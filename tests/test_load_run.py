"""Whole runs from files in a landing zone to the table."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE_ROW, csv_text, put_report
from windrow.operators.work_items import work_items
from windrow.plans.load_run import carry_out, plan_load, run_backfill, run_daily
from windrow.sinks.table import create_table
from windrow.sources.landing import scan_landing
from windrow.spec import EVENTS, INSTALLS

SOURCE, NAMES = BASE_ROW["Media Source"], [BASE_ROW["Event Name"]]
DAY = dt.date(2023, 3, 4)
QUIET = csv_text(bom=True, headers=[*BASE_ROW, "Cost Currency", "Partner"])


def by_app(plan):
    return {r.app_id: r for r in plan.results.collect()}


def plan_of(spark, root, apps, **options):
    items = work_items(spark, apps, DAY, DAY, attribution_types=["non_organic"])
    options = {"media_source": SOURCE, "event_names": NAMES, **options}
    return plan_load(spark, str(root), items, **options)


def test_each_kind_of_body(spark, tmp_path):
    bodies = {
        "good": csv_text({}, {"Device ID": "d2"}),
        "quiet": QUIET,
        "empty": "",
        "spaces": " \n\n ",
        "bom": "﻿",
        "errtext": "Plan limit reached. Contact your manager",
        "renamed": QUIET.replace("Event Time", "Event Time Renamed"),
        "short": "Event Name\n",
        "ragged": csv_text({}) + ",".join(["x"] * 25) + "\n",
        "badrow": csv_text({}, {"Event Revenue": "n/a"}),
        "newline": csv_text({"Campaign": 'two\nlines, and "quotes"'}),
        "capped": csv_text(*[{"Device ID": f"d{i}"} for i in range(5)]),
    }
    for app, body in bodies.items():
        put_report(tmp_path, app, "non_organic", DAY, DAY, body)
    spec = replace(EVENTS, row_cap=5)
    got = by_app(plan_of(spark, tmp_path, [*bodies, "absent"], spec=spec))
    fine = {"good": (2, 2), "quiet": (0, 0), "newline": (1, 1)}
    for app, counts in fine.items():
        assert got[app].error is None, app
        assert (got[app].fetched_rows, got[app].loaded_rows) == counts, app
    expected = {
        "empty": "empty",
        "spaces": "empty",
        "bom": "empty",
        "errtext": "missing columns",
        "renamed": "missing columns: ['Event Time']",
        "short": "missing columns",
        "ragged": "wrong width",
        "badrow": "event_revenue",
        "capped": "truncated",
        "absent": "no report",
    }
    for app, text in expected.items():
        assert text in got[app].error, app
        assert (got[app].fetched_rows, got[app].loaded_rows) == (0, 0), app
    assert set(got) == set(fine) | set(expected)


def test_quoted_newlines_and_quotes_survive(spark, tmp_path):
    put_report(tmp_path, "a", "non_organic", DAY, DAY, csv_text({"Ad": 'x\ny, "z"'}))
    assert plan_of(spark, tmp_path, ["a"]).rows.first().ad == 'x\ny, "z"'


def test_headers_in_other_order(spark, tmp_path):
    put_report(tmp_path, "a", "non_organic", DAY, DAY, csv_text({}))
    backwards = list(reversed(BASE_ROW))
    put_report(tmp_path, "b", "non_organic", DAY, DAY, csv_text({}, headers=backwards))
    rows = plan_of(spark, tmp_path, ["a", "b"]).rows.drop("app_id", "seq").collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_ids_and_odd_names_stay_text(spark, tmp_path):
    put_report(
        tmp_path, "007", "non_organic", DAY, DAY, csv_text({"Campaign ID": "120244023026200094"})
    )
    row = plan_of(spark, tmp_path, ["007"]).rows.first()
    assert (row.app_id, row.campaign_id) == ("007", "120244023026200094")


def test_order_of_rows_over_several_files_of_a_window(spark, tmp_path):
    tail = csv_text({"Event Revenue": "5"})
    head = csv_text(*[{"Event Revenue": str(i)} for i in range(4)])
    put_report(tmp_path, "a", "non_organic", DAY, DAY, tail, "part-2.csv")
    put_report(tmp_path, "a", "non_organic", DAY, DAY, head, "part-1.csv")
    put_report(tmp_path, "b", "non_organic", DAY, DAY, head)
    plan = plan_of(spark, tmp_path, ["a", "b"])
    kept = {r.app_id: r.event_revenue for r in plan.rows.collect()}
    assert kept == {"a": Decimal(5), "b": Decimal(3)}
    assert {r.app_id: r.conflicts for r in plan.counters.collect()} == {"a": 4, "b": 3}


def test_only_the_windows_of_the_run_are_read(spark, tmp_path):
    put_report(tmp_path, "a", "non_organic", DAY, DAY, csv_text({}))
    put_report(tmp_path, "a", "non_organic", "2023-03-03", "2023-03-03", csv_text({}))
    put_report(tmp_path, "b", "non_organic", DAY, DAY, "")
    plan = plan_of(spark, tmp_path, ["a"])
    assert plan.rows.count() == 1 and plan.results.count() == 1
    assert scan_landing(spark, str(tmp_path)).raw.count() == 2


@pytest.mark.parametrize("policy, error", [("latest", None), ("keep_all", None), ("fail", "key")])
def test_conflict_policies(spark, tmp_path, policy, error):
    put_report(
        tmp_path, "a", "non_organic", DAY, DAY,
        csv_text({"Event Revenue": "3"}, {"Event Revenue": "3"}, {"Event Revenue": "4"}),
    )
    put_report(tmp_path, "b", "non_organic", DAY, DAY, csv_text({}, {}))
    got = by_app(plan_of(spark, tmp_path, ["a", "b"], on_conflict=policy))
    assert got["b"].loaded_rows == 1 and got["b"].error is None
    assert got["a"].loaded_rows == {"latest": 1, "keep_all": 2, "fail": 0}[policy]
    assert (got["a"].error is None) == (error is None)
    with pytest.raises(ValueError):
        plan_of(spark, tmp_path, ["a"], on_conflict="other")


def test_lenient_policy_drops_and_counts(spark, tmp_path):
    put_report(tmp_path, "a", "non_organic", DAY, DAY, csv_text({}, {"Device ID": ""}))
    plan = plan_of(spark, tmp_path, ["a"], on_invalid="drop")
    assert by_app(plan)["a"].error is None and plan.rows.count() == 1
    assert [r.dropped_rows for r in plan.dropped.collect()] == [1]


def test_two_apps_two_types_and_isolation(spark, tmp_path, name):
    """One bad window keeps its old rows; the others are replaced."""
    create_table(spark, name)
    for app in ("app1", "app2"):
        for kind in ("non_organic", "retargeting"):
            put_report(tmp_path, app, kind, DAY, DAY, csv_text({"Device ID": f"{app}{kind}"}))
    options = {"media_source": SOURCE, "event_names": NAMES, "date": DAY}
    today = DAY + dt.timedelta(days=1)
    first = run_daily(spark, str(tmp_path), name, ["app1", "app2"], today, **options)
    assert spark.table(name).count() == 4
    assert [r.inserted for r in first.metrics.collect()] == [1] * 4

    again = run_daily(spark, str(tmp_path), name, ["app1", "app2"], today, **options)
    assert spark.table(name).count() == 4
    assert {(r.deleted, r.inserted, r.wiped) for r in again.metrics.collect()} == {(1, 1, False)}

    second = tmp_path / "second"
    put_report(second, "app1", "non_organic", DAY, DAY, csv_text({"Event Revenue": "x"}))
    put_report(second, "app1", "retargeting", DAY, DAY, QUIET)
    put_report(second, "app2", "non_organic", DAY, DAY, csv_text({"Device ID": "new"}))
    put_report(second, "app2", "retargeting", DAY, DAY, "")
    run = run_daily(spark, str(second), name, ["app1", "app2"], today, **options)
    devices = {r.device_id for r in spark.table(name).collect()}
    assert devices == {"app1non_organic", "new", "app2retargeting"}
    wiped = {(r.app_id, r.attribution_type): r.wiped for r in run.metrics.collect()}
    assert wiped == {("app1", "retargeting"): True, ("app2", "non_organic"): False}
    assert {r.error is None for r in run.results.collect()} == {True, False}


def test_dry_run_needs_no_table_and_writes_nothing(spark, tmp_path, name):
    put_report(tmp_path, "a", "non_organic", DAY, DAY, csv_text({}))
    args = (spark, str(tmp_path), name, ["a"], DAY + dt.timedelta(days=1))
    plan = run_daily(*args, dry_run=True, attribution_types=["non_organic"])
    assert plan.metrics is None and plan.rows.count() == 1
    with pytest.raises(RuntimeError, match="does not exist"):
        run_daily(*args)
    create_table(spark, name)
    run_daily(*args, dry_run=True)
    assert spark.table(name).count() == 0


def test_backfill_windows(spark, tmp_path, name):
    row = {"Event Time": "2026-04-20 01:02:03"}
    put_report(tmp_path, "a", "non_organic", "2026-04-08", "2026-05-08", csv_text(row))
    plan = run_backfill(
        spark, str(tmp_path), name, ["a"], dt.date(2026, 7, 7), dry_run=True,
        attribution_types=["non_organic"],
    )
    windows = sorted((r.start_date, r.end_date) for r in plan.results.collect())
    assert windows[0] == (dt.date(2026, 4, 8), dt.date(2026, 5, 8))
    assert windows[-1][1] == dt.date(2026, 7, 6) and len(windows) == 3


def test_installs_family_keeps_every_column(spark, tmp_path, name):
    headers = [*BASE_ROW, "Device Model"]
    row = {"Device Model": "phone", "Install Time": "2023-03-04 01:02:03"}
    body = csv_text(row, headers=headers)
    put_report(tmp_path, "a", "non_organic", DAY, DAY, body)
    plan = plan_of(spark, tmp_path, ["a"], spec=INSTALLS)
    got = plan.rows.first()
    assert (got.device_model, got.region) == ("phone", BASE_ROW["Region"])
    columns = dict(plan.rows.drop("seq", "row_ord", "start_date", "end_date").dtypes)
    create_table(spark, name, columns=columns)
    carry_out(plan, name, INSTALLS)
    stored = spark.table(name).first()
    assert stored.event_date == DAY and stored.device_model == "phone"
    known = replace(INSTALLS, known_columns=("install_time",))
    assert "unknown columns" in by_app(plan_of(spark, tmp_path, ["a"], spec=known))["a"].error


@pytest.mark.parametrize("broken", [0, 1, 2])
@pytest.mark.parametrize("body, text", [("", "empty"), ("Plan limit reached", "missing columns")])
def test_one_broken_file_fails_its_window(spark, tmp_path, broken, body, text):
    for n in range(3):
        good = csv_text({"Device ID": str(n)})
        put_report(tmp_path, "a", "non_organic", DAY, DAY, body if n == broken else good, f"part-{n}.csv")
    put_report(tmp_path, "b", "non_organic", DAY, DAY, csv_text({}))
    plan = plan_of(spark, tmp_path, ["a", "b"])
    got = by_app(plan)
    assert text in got["a"].error and f"part-{broken}.csv" in got["a"].error
    assert (got["a"].loaded_rows, got["b"].loaded_rows, got["b"].error) == (0, 1, None)
    assert [r.app_id for r in plan.good.df.collect()] == ["b"]


def test_hundreds_of_error_texts_disturb_nothing(spark, tmp_path):
    put_report(tmp_path, "good", "non_organic", DAY, DAY, csv_text({}))
    for n in range(600):
        put_report(tmp_path, "bad", "non_organic", DAY, DAY, f"request {n} refused", f"{n:03}.csv")
    got = by_app(plan_of(spark, tmp_path, ["good", "bad"]))
    assert got["good"].loaded_rows == 1 and "request" not in (got["good"].error or "")
    assert "missing columns" in got["bad"].error


def test_columns_that_differ_in_case_fail_their_window_only(spark, tmp_path):
    doubled = csv_text({"region": "x"}, headers=[*BASE_ROW, "region"])
    put_report(tmp_path, "a", "non_organic", DAY, DAY, doubled)
    put_report(tmp_path, "b", "non_organic", DAY, DAY, csv_text({}))
    got = by_app(plan_of(spark, tmp_path, ["a", "b"]))
    assert "repeats columns" in got["a"].error and got["b"].error is None


def test_installs_with_two_spellings_of_a_header(spark, tmp_path):
    row = {"Install Time": "2023-03-04 01:02:03"}
    put_report(tmp_path, "a", "non_organic", DAY, DAY, csv_text(row))
    other = csv_text(row).replace("Customer User ID", "customer_user_id").replace("Region", "region")
    put_report(tmp_path, "b", "non_organic", DAY, DAY, other)
    both = csv_text({**row, "region": "x"}, headers=[*BASE_ROW, "region"])
    put_report(tmp_path, "c", "non_organic", DAY, DAY, both)
    plan = plan_of(spark, tmp_path, ["a", "b", "c"], spec=INSTALLS)
    got = by_app(plan)
    assert got["a"].error is None and got["b"].error is None and "repeats" in got["c"].error
    rows = {r.app_id: r for r in plan.rows.collect()}
    assert rows["a"].customer_user_id == rows["b"].customer_user_id == BASE_ROW["Customer User ID"]
    assert rows["a"].region == rows["b"].region
    summary = plan.summary.first()
    assert (summary.windows, summary.failed) == (3, 1)


def test_a_missing_landing_zone_has_no_reports(spark, tmp_path):
    got = by_app(plan_of(spark, tmp_path / "nowhere", ["a"]))
    assert got["a"].error == "no report has landed"


def test_other_windows_and_other_endings_are_not_opened(spark, tmp_path, monkeypatch):
    from windrow.sources import landing

    opened = []
    text_files = landing._text_files

    def watched(session, folders, *names):
        df = text_files(session, folders, *names)
        opened.extend(df.inputFiles())
        return df

    monkeypatch.setattr(landing, "_text_files", watched)
    put_report(tmp_path, "a", "non_organic", DAY, DAY, csv_text({}))
    put_report(tmp_path, "a", "non_organic", DAY, DAY, "junk", "report.csv.bak")
    put_report(tmp_path, "a", "non_organic", DAY, DAY, "junk", "report.csv._COPYING_")
    put_report(tmp_path, "a", "non_organic", "2023-03-03", "2023-03-03", "old error")
    put_report(tmp_path, "other app", "non_organic", DAY, DAY, csv_text({}))
    assert by_app(plan_of(spark, tmp_path, ["a"]))["a"].loaded_rows == 1
    assert opened and all(f.endswith(f"end_date={DAY}/report.csv") for f in opened)


def test_any_number_of_header_orders_is_one_scan(spark, tmp_path):
    """Files of one width are one scan, however their columns are ordered."""
    headers = list(BASE_ROW)
    for n in range(300):
        turned = headers[n % len(headers):] + headers[: n % len(headers)]
        swapped = [turned[0], *reversed(turned[1:])] if n % 2 else turned
        body = csv_text({"Device ID": f"device {n}", "Channel": f"channel {n}"}, headers=swapped)
        put_report(tmp_path, f"app{n % 3}", "non_organic", DAY, DAY, body, f"{n:03}.csv")
    put_report(tmp_path, "app3", "non_organic", DAY, DAY, csv_text({"More": "x"}, headers=[*headers, "More"]))
    raw = scan_landing(spark, str(tmp_path)).raw
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2  # one per width
    got = {r["Device ID"]: (r["Channel"], r["Campaign"], r.corrupt) for r in raw.collect()}
    campaign = BASE_ROW["Campaign"]
    assert got == {f"device {n}": (f"channel {n}", campaign, False) for n in range(300)} | {
        BASE_ROW["Device ID"]: (BASE_ROW["Channel"], campaign, False)
    }


@pytest.mark.parametrize("app", ["it's/odd=50% +x", "a,b{c}", "[x]*?^", "back\\slash"])
def test_odd_app_names_are_found_by_pattern(spark, tmp_path, app):
    rows = spark.createDataFrame([(",".join(BASE_ROW),), (csv_text({}).splitlines()[1],)], "line string")
    rows = rows.coalesce(1)
    tags = {"app_id": F.lit(app), "attribution_type": F.lit("non_organic"),
            "start_date": F.lit(DAY), "end_date": F.lit(DAY)}
    rows.withColumns(tags).write.partitionBy(*tags).option("sep", "\x01").option("quote", "").csv(f"{tmp_path}/z")
    assert by_app(plan_of(spark, tmp_path / "z", [app, "z"]))[app].loaded_rows == 1


def test_rewrite_keeps_the_twin_of_the_later_window(spark, tmp_path, name):
    """The report order starts anew in every window, so the window comes first."""
    from windrow.plans.rewrite_run import rewrite_table

    first = csv_text({"Device ID": "other"}, {"Channel": "first window"})
    put_report(tmp_path, "a", "non_organic", DAY, DAY, first)
    put_report(tmp_path, "a", "retargeting", DAY, DAY, csv_text({"Channel": "second window"}))
    create_table(spark, name)
    items = work_items(spark, ["a"], DAY, DAY)
    carry_out(plan_load(spark, str(tmp_path), items), name)
    rewrite_table(spark, name, f"{name}_bak")
    kept = {r.device_id: r.channel for r in spark.table(name).collect()}
    assert kept[BASE_ROW["Device ID"]] == "second window" and len(kept) == 2
