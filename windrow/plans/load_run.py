"""A scheduled run: scan the landing zone, judge each window, replace the good ones.

One scan covers all windows.  A bad window becomes a row with an error in the
result and keeps its old table rows, while the others load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions.dates import backfill_window, daily_window
from windrow.operators.dedup import collapse_counters, resolve
from windrow.operators.filters import report_predicate
from windrow.operators.replace import tag_windows
from windrow.operators.validate import (
    at_table_scale,
    drop_invalid,
    fetched_rows,
    first_errors,
    quarantine,
    run_summary,
    type_report,
    window_results,
)
from windrow.operators.work_items import WorkItems, work_items
from windrow.plans.journal import record_run
from windrow.runtime import stage
from windrow.sinks.table import next_load_seq, replace_in_table, require_table
from windrow.sources.landing import LandingScan, scan_landing
from windrow.spec import ATTRIBUTION_TYPES, EVENTS, ReportSpec, WINDOW_COLS


@dataclass(frozen=True)
class LoadPlan:
    """``rows`` to load with their ``seq``; ``good`` windows; ``results`` per window.

    ``counters`` says what deduplication collapsed; ``dropped`` what the lenient
    policy left out; ``summary`` adds the results up in one row.  ``metrics`` is set
    once the plan has been carried out.
    """

    rows: DataFrame
    good: WorkItems
    results: DataFrame
    counters: DataFrame
    dropped: DataFrame | None
    metrics: DataFrame | None = None
    summary: DataFrame | None = None


def file_errors(scan: LandingScan, items: WorkItems, typed: DataFrame, row_cap: int) -> DataFrame:
    """Window errors that come before any row is looked at, one per window.

    In order: no report, empty body, wrong header, ragged row, row cap.  One broken file fails
    its window, whatever the others are; where there are several, the text names it.
    """
    keys = list(WINDOW_COLS)
    name = F.concat(F.lit(" ("), F.element_at(F.split("file_path", "/"), -1), F.lit(")"))
    files = scan.files.groupBy(*keys).agg(
        F.min(
            F.when(F.col("problem").isNotNull(), F.struct("file_no", "problem", name.alias("name")))
        ).alias("broken"),
        (F.count("*") > 1).alias("several"),
    )
    named = F.concat("broken.problem", F.when(F.col("several"), F.col("broken.name")).otherwise(""))
    files = files.select(*keys, named.alias("file_problem"))
    rows = typed.groupBy(*keys).agg(
        F.max("corrupt").alias("ragged"), (F.count("*") >= row_cap).alias("capped")
    )
    absent = items.df.select(*keys).join(
        scan.files.select(*keys, F.lit(True).alias("landed")).distinct(), keys, "left"
    )
    problem = (
        F.when(F.col("landed").isNull(), F.lit("no report has landed"))
        .when(F.col("file_problem").isNotNull(), F.col("file_problem"))
        .when(F.col("ragged"), F.lit("report has a row of the wrong width"))
        .when(F.col("capped"), F.lit(f"report reached {row_cap} rows and is likely truncated"))
    )
    joined = absent.join(files, keys, "left").join(rows, keys, "left")
    return joined.select(*keys, problem.alias("error")).filter(F.col("error").isNotNull())


def plan_load(
    spark: SparkSession,
    root: str,
    items: WorkItems,
    media_source: str | None = None,
    event_names: Sequence[str] | None = None,
    spec: ReportSpec = EVENTS,
    on_conflict: str = "latest",
    on_invalid: str = "fail",
) -> LoadPlan:
    """Everything a run does except writing the table, which is a dry run.

    The scan is typed and staged once; every count and the rows themselves come
    from the stage.
    """
    if on_invalid not in ("fail", "drop"):
        raise ValueError(f"unknown policy for invalid rows: {on_invalid}")
    keys = list(WINDOW_COLS)
    scan = scan_landing(spark, root, spec, items)
    wanted = report_predicate(scan.raw.columns, media_source, event_names, spec)
    flagged = scan.raw.withColumn("kept", wanted)
    flags = ("corrupt", "kept")
    tags = {*keys, "row_ord", *flags}
    # Rows the filter drops are only counted: without their text, parsing and
    # staging them costs next to nothing.
    emptied = flagged.select(
        *[
            F.col(f"`{c}`") if c in tags else F.when(F.col("kept"), F.col(f"`{c}`")).alias(c)
            for c in flagged.columns
        ]
    )
    staged = stage(type_report(emptied, spec, extra=flags), "typed")
    of_file = file_errors(scan, items, staged, spec.row_cap)
    kept = staged.filter("kept").drop(*flags)
    dropped = None
    if on_invalid == "drop":
        kept, dropped = drop_invalid(kept)
        kept = kept.withColumn("error", F.lit(None).cast("string"))
    of_rows = first_errors(kept).select(*keys, "error")
    ahead = of_rows.join(of_file.select(*keys), keys, "left_anti")
    errors = stage(of_file.unionByName(ahead), "errors")

    valid = quarantine(kept, errors, items.count)
    resolved, bad = resolve(
        valid, on_conflict, keys, spec.key, spec.rank_column, windows_bound=items.count
    )
    if bad is not None:
        clash = bad.select(*keys, F.lit("rows of one key disagree").alias("error"))
        errors = stage(errors.unionByName(clash), "errors")
    money = [c for c in spec.decimals if c in resolved.columns]
    rows = stage(tag_windows(at_table_scale(resolved, money), items), "rows")

    loaded = rows.groupBy(*keys).agg(F.count("*").alias("loaded_rows"))
    results = window_results(items, fetched_rows(staged, spec.row_cap), loaded, errors)
    good = WorkItems(
        items.df.join(errors.select(*keys), keys, "left_anti"), items.count, items.days
    )
    nullable = [c for c in spec.key if c not in spec.required]
    counters = collapse_counters(
        valid, keys, spec.key, spec.rank_column, nullable_key=nullable
    )
    results = stage(results, "results")
    return LoadPlan(
        rows, good, results, stage(counters, "counters"), dropped, summary=run_summary(results)
    )


def carry_out(
    plan: LoadPlan,
    table: str,
    spec: ReportSpec = EVENTS,
    load_seq: int | None = None,
    skip_unchanged: bool = False,
) -> LoadPlan:
    """Replace the plan's good windows in ``table`` and enter the run in its journal."""
    spark = plan.rows.sparkSession
    load_seq = next_load_seq() if load_seq is None else load_seq
    metrics = replace_in_table(spark, table, plan.rows, plan.good, load_seq, spec, skip_unchanged)
    record_run(spark, table, plan.rows, plan.good, load_seq)
    return replace(plan, metrics=metrics)


def run_window(
    spark: SparkSession,
    root: str,
    table: str,
    apps: Sequence[str],
    start: dt.date,
    end: dt.date,
    today: dt.date,
    dry_run: bool = False,
    spec: ReportSpec = EVENTS,
    attribution_types: Sequence[str] = ATTRIBUTION_TYPES,
    skip_unchanged: bool = False,
    **options,
) -> LoadPlan:
    """Load [start, end] for every app and type; a dry run needs no table."""
    if not dry_run:
        require_table(spark, table)
    items = work_items(spark, apps, start, end, spec, attribution_types, today)
    plan = plan_load(spark, root, items, spec=spec, **options)
    return plan if dry_run else carry_out(plan, table, spec, skip_unchanged=skip_unchanged)


def run_backfill(
    spark: SparkSession,
    root: str,
    table: str,
    apps: Sequence[str],
    today: dt.date,
    start: dt.date | None = None,
    end: dt.date | None = None,
    spec: ReportSpec = EVENTS,
    **options,
) -> LoadPlan:
    first, last = backfill_window(today, start, end, spec.retention_days)
    return run_window(spark, root, table, apps, first, last, today, spec=spec, **options)


def run_daily(
    spark: SparkSession,
    root: str,
    table: str,
    apps: Sequence[str],
    today: dt.date,
    date: dt.date | None = None,
    from_date: dt.date | None = None,
    to_date: dt.date | None = None,
    lookback_days: int = 1,
    spec: ReportSpec = EVENTS,
    **options,
) -> LoadPlan:
    """Yesterday by default; a deeper lookback replaces the last days again, so late
    events are picked up without any state."""
    first, last = daily_window(
        today, date, from_date, to_date, lookback_days, spec.retention_days
    )
    return run_window(spark, root, table, apps, first, last, today, spec=spec, **options)
