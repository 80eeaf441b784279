"""The windows of a run: every app x attribution type x date chunk."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions.dates import (
    before_floor,
    chunk_count,
    chunk_end,
    chunk_starts,
    clamped_start,
)
from windrow.spec import ATTRIBUTION_TYPES, EVENTS, ReportSpec, WINDOW_COLS


@dataclass(frozen=True)
class WorkItems:
    """Windows in load order, with bounds on their number and on the days they own."""

    df: DataFrame
    count: int | None = None
    days: int | None = None


def expand_windows(
    spans: DataFrame,
    max_days: int = EVENTS.max_chunk_days,
    attribution_types: Sequence[str] = ATTRIBUTION_TYPES,
) -> DataFrame:
    """One row per window from one ``(app_id, start_date, end_date)`` span per app.

    Arrays are exploded in place, so there is no join and no shuffle.  ``chunk``
    and ``type_no`` number the windows of a span in load order.
    """
    types = F.array(*[F.lit(t) for t in attribution_types])
    per_type = spans.select("*", F.posexplode(types).alias("type_no", "attribution_type"))
    starts = chunk_starts(F.col("start_date"), F.col("end_date"), max_days)
    per_chunk = per_type.select("*", F.posexplode(starts).alias("chunk", "chunk_start"))
    return per_chunk.withColumn(
        "end_date", chunk_end(F.col("chunk_start"), F.col("end_date"), max_days)
    ).withColumn("start_date", F.col("chunk_start")).drop("chunk_start")


def work_items(
    spark: SparkSession,
    apps: Sequence[str],
    start: dt.date,
    end: dt.date,
    spec: ReportSpec = EVENTS,
    attribution_types: Sequence[str] = ATTRIBUTION_TYPES,
    today: dt.date | None = None,
) -> WorkItems:
    """The run's windows, numbered by ``seq`` in load order.

    ``today`` adds ``before_floor``; a spec that clamps also moves starts up to
    the retention floor, and yields nothing when the whole span is older.
    """
    if not apps:
        raise ValueError("a run needs at least one app")
    if not attribution_types:
        raise ValueError("a run needs at least one attribution type")
    flagged = today is not None and start < today - dt.timedelta(days=spec.retention_days)
    if flagged and spec.clamp_to_retention:
        start = today - dt.timedelta(days=spec.retention_days)
        if start > end:
            return WorkItems(_seq(_spans(spark, apps, start, end), spec, attribution_types), 0, 0)
    chunks = chunk_count(start, end, spec.max_chunk_days)
    items = _seq(_spans(spark, apps, start, end), spec, attribution_types, chunks)
    if today is not None:
        items = items.withColumn(
            "before_floor", before_floor(F.col("start_date"), F.lit(today), spec.retention_days)
        )
    series = len(apps) * len(attribution_types)
    return WorkItems(items, series * chunks, series * ((end - start).days + 1))


def _spans(spark: SparkSession, apps: Sequence[str], start: dt.date, end: dt.date) -> DataFrame:
    rows = [(no, app, start, end) for no, app in enumerate(apps)]
    return spark.createDataFrame(
        rows, "app_no int, app_id string, start_date date, end_date date"
    )


def _seq(
    spans: DataFrame, spec: ReportSpec, attribution_types: Sequence[str], chunks: int = 0
) -> DataFrame:
    """Number windows app by app, type by type, chunk by chunk."""
    per_app = len(attribution_types) * chunks
    seq = F.col("app_no") * per_app + F.col("type_no") * chunks + F.col("chunk")
    expanded = expand_windows(spans, spec.max_chunk_days, attribution_types)
    return expanded.select(seq.cast("long").alias("seq"), *WINDOW_COLS)


def flag_before_floor(items: DataFrame, today: Column, retention_days: int) -> DataFrame:
    return items.withColumn(
        "before_floor", before_floor(F.col("start_date"), today, retention_days)
    )


def clamp_to_floor(spans: DataFrame, today: Column, retention_days: int) -> DataFrame:
    """Move span starts up to the retention floor; drop spans wholly before it."""
    clamped = spans.withColumn(
        "start_date", clamped_start(F.col("start_date"), today, retention_days)
    )
    return clamped.filter(F.col("start_date") <= F.col("end_date"))


def halve_windows(flagged: DataFrame) -> DataFrame:
    """Two windows for each given one, to fetch again in smaller pieces.

    A one-day window cannot be halved and comes back as it is, marked ``splittable``
    false.
    """
    days = F.date_diff("end_date", "start_date")
    middle = F.date_add("start_date", F.floor(days / 2).cast("int"))
    halves = F.when(
        days > 0,
        F.array(
            F.struct(F.col("start_date"), middle.alias("end_date")),
            F.struct(F.date_add(middle, 1).alias("start_date"), F.col("end_date")),
        ),
    ).otherwise(F.array(F.struct("start_date", "end_date")))
    return flagged.select(
        "app_id",
        "attribution_type",
        (days > 0).alias("splittable"),
        F.explode(halves).alias("half"),
    ).select("app_id", "attribution_type", "half.start_date", "half.end_date", "splittable")


def window_days(items: WorkItems) -> DataFrame:
    """The days every window owns: one row per (app, type, day), windows in load order.

    Windows are whole days, so "event time within the window" is the same as "event
    day is one of the window's days".  That turns a range join into an equi join.
    ``seqs`` lists the windows that own the day, ascending (one, unless windows
    overlap).
    """
    days = items.df.select(
        "app_id",
        "attribution_type",
        "seq",
        F.explode(F.sequence("start_date", "end_date")).alias("day"),
    )
    return days.groupBy("app_id", "attribution_type", "day").agg(
        F.array_sort(F.collect_list("seq")).alias("seqs")
    )
