"""Typing a report with errors as data, and the status of each window.

A bad row fails its window, never the job and never another window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.text import (
    clean,
    is_damaged_id,
    normalise_headers,
    repair_id,
)
from windrow.functions.typed import MONEY, failed, overflows, parse_decimal, parse_timestamp
from windrow.operators.work_items import WorkItems
from windrow.runtime import counted_bound, join_small
from windrow.spec import (
    APPEND_ID_COLUMNS,
    APPEND_REQUIRED,
    APPEND_TIMESTAMPS,
    EVENTS,
    ReportSpec,
    TABLE_COLUMNS,
    WINDOW_COLS,
)


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _quoted(raw: Column) -> Column:
    return F.concat(F.lit(": '"), raw, F.lit("'"))


def _missing(name: str, parsed: Sequence[str]) -> Column:
    """NULL, or empty text.  White space alone counts as a value in a report."""
    return F.col(name).isNull() if name in parsed else F.coalesce(name, F.lit("")) == ""


def missing_headers(columns: Sequence[str], spec: ReportSpec = EVENTS) -> list[str]:
    """Required headers a report lacks.  Extra headers are fine."""
    return [h for h in spec.required_headers if h not in columns]


def type_report(
    raw: DataFrame, spec: ReportSpec = EVENTS, extra: Sequence[str] = ()
) -> DataFrame:
    """Select, rename and type a raw report; tag it with its window.

    Input: raw headers, the four window columns and ``row_ord``.  Output: the
    typed columns, the window columns, ``row_ord`` and ``error``, which is NULL
    for a good row and else describes its first problem: timestamps first, then
    numbers, then required fields.  Numbers stay unrounded until the table.
    ``extra`` columns are passed through.
    """
    tags = (*WINDOW_COLS, "row_ord", *extra)
    if spec.columns is not None:
        text = {to: _q(raw_name) for raw_name, to in spec.columns.items()}
    else:
        headers = [c for c in raw.columns if c not in tags]
        alias = {v: k for k, v in spec.raw_names.items()}
        named = dict(zip(headers, normalise_headers(headers)))
        text = {alias.get(h, named[h]): _q(h) for h in headers}
    text = {to: c for to, c in text.items() if to not in tags}

    times = [c for c in spec.timestamps if c in text]
    numbers = [c for c in spec.decimals if c in text]
    parsed = _parse(raw, text, times, numbers, tags)
    problems = _parse_problems(times, numbers)
    problems += [
        F.when(_missing(c, (*times, *numbers)), F.lit(f"{c} is missing")) for c in spec.required
    ]
    return parsed.select(*text, *tags, F.coalesce(*problems).alias("error"))


def _raw(name: str) -> str:
    return f"_raw_{name}"


def _parse(
    raw: DataFrame,
    text: dict[str, Column],
    times: Sequence[str],
    numbers: Sequence[str],
    tags: Sequence[str],
) -> DataFrame:
    """Parsed columns under their names, and the text they came from as ``_raw_…``.

    A projection of its own: the parsers are costly and both the value and its
    check need the result, which Spark then computes once per row.
    """
    parsers = dict.fromkeys(times, parse_timestamp) | dict.fromkeys(numbers, parse_decimal)
    out = [(parsers[c](x) if c in parsers else x).alias(c) for c, x in text.items()]
    return raw.select(*out, *[text[c].alias(_raw(c)) for c in parsers], *tags)


def _parse_problems(times: Sequence[str], numbers: Sequence[str]) -> list[Column]:
    problems = []
    for c in times:
        told = F.concat(F.lit(f"{c} is not a timestamp"), _quoted(F.col(_raw(c))))
        problems.append(F.when(failed(F.col(_raw(c)), F.col(c)), told))
    for c in numbers:
        told = F.concat(F.lit(f"{c} is not a storable number"), _quoted(F.col(_raw(c))))
        bad = failed(F.col(_raw(c)), F.col(c)) | overflows(F.col(c))
        problems.append(F.when(bad, told))
    return problems


def type_append_rows(raw: DataFrame) -> DataFrame:
    """Type rows of a file that already has the table's columns.

    Unlike a report, text is trimmed and blank text becomes NULL, so a required
    field may not be blank.  ``ids_nulled`` counts damaged ids of the row.
    """
    typed = (*APPEND_TIMESTAMPS, "event_revenue")
    text = {c: F.col(c) if c in typed else clean(F.col(c)) for c in TABLE_COLUMNS}
    parsed = _parse(raw, text, APPEND_TIMESTAMPS, ["event_revenue"], ["row_ord"])
    problems = _parse_problems(APPEND_TIMESTAMPS, ["event_revenue"])
    problems += [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in APPEND_REQUIRED]
    nulled = sum((is_damaged_id(F.col(c)).cast("int") for c in APPEND_ID_COLUMNS), F.lit(0))
    out = {c: repair_id(F.col(c)) if c in APPEND_ID_COLUMNS else F.col(c) for c in TABLE_COLUMNS}
    return parsed.select(
        *[x.alias(c) for c, x in out.items()],
        "row_ord",
        nulled.alias("ids_nulled"),
        F.coalesce(*problems).alias("error"),
    )


def parse_stats(typed: DataFrame) -> DataFrame:
    """Rows read and damaged ids nulled, over the whole file."""
    return typed.agg(
        F.count("*").alias("total_rows"),
        F.coalesce(F.sum("ids_nulled"), F.lit(0)).cast("long").alias("ids_nulled"),
    )


def at_table_scale(df: DataFrame, money: Sequence[str] = ("event_revenue",)) -> DataFrame:
    """Round money to the table's scale; call after deduplication."""
    return df.withColumns({c: F.col(c).try_cast(MONEY) for c in money})


def fetched_rows(raw: DataFrame, row_cap: int = EVENTS.row_cap) -> DataFrame:
    """Rows per window, before any filter, and whether the report hit the cap."""
    return raw.groupBy(*WINDOW_COLS).agg(
        F.count("*").alias("fetched_rows"),
        (F.count("*") >= row_cap).alias("truncated"),
    )


def first_errors(typed: DataFrame) -> DataFrame:
    """The first bad row's problem per window, in report order."""
    return (
        typed.filter(F.col("error").isNotNull())
        .groupBy(*WINDOW_COLS)
        .agg(F.min_by("error", "row_ord").alias("error"), F.count("*").alias("bad_rows"))
    )


def quarantine(
    typed: DataFrame, errors: DataFrame, windows_bound: int | None = None
) -> DataFrame:
    """Drop every row of a window that has an error.

    ``windows_bound`` is the number of windows where the caller knows it.
    """
    bound = counted_bound(errors) if windows_bound is None else windows_bound
    bad = errors.select(*WINDOW_COLS).distinct()
    return join_small(typed, bad, WINDOW_COLS, "left_anti", bound).drop("error")


def drop_invalid(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lenient policy: drop bad rows alone, and count them per window."""
    good = typed.filter(F.col("error").isNull()).drop("error")
    dropped = (
        typed.filter(F.col("error").isNotNull())
        .groupBy(*WINDOW_COLS)
        .agg(F.count("*").alias("dropped_rows"))
    )
    return good, dropped


def window_results(
    items: WorkItems, fetched: DataFrame, loaded: DataFrame, errors: DataFrame
) -> DataFrame:
    """One row per window: rows fetched (before filters), loaded (after dedup), error.

    A failed window shows zero for both counts.  Where the run knows its day, ``before_floor``
    warns of windows that start before the retention floor.
    """
    keys = list(WINDOW_COLS)
    warned = [c for c in ("before_floor",) if c in items.df.columns]
    joined = (
        items.df.join(fetched.select(*keys, "fetched_rows"), keys, "left")
        .join(loaded.select(*keys, "loaded_rows"), keys, "left")
        .join(errors.select(*keys, "error"), keys, "left")
    )
    ok = F.col("error").isNull()
    return joined.select(
        "seq",
        *keys,
        F.when(ok, F.coalesce("fetched_rows", F.lit(0))).otherwise(0).alias("fetched_rows"),
        F.when(ok, F.coalesce("loaded_rows", F.lit(0))).otherwise(0).alias("loaded_rows"),
        "error",
        *warned,
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of a run, one row."""
    failed_windows = F.count_if(F.col("error").isNotNull())
    return results.agg(
        F.count("*").alias("windows"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        failed_windows.alias("failed"),
        F.coalesce(F.sum("fetched_rows"), F.lit(0)).alias("total_fetched"),
        F.coalesce(F.sum("loaded_rows"), F.lit(0)).alias("total_loaded"),
        (failed_windows == 0).alias("all_succeeded"),
    )
