"""Appending one CSV of table-shaped rows, never deleting anything."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.append import (
    append_counts,
    marked_keys,
    of_the_same_days,
    unseen_rows,
    within_span,
)
from windrow.operators.validate import at_table_scale, parse_stats, type_append_rows
from windrow.runtime import stage
from windrow.sinks.table import PARTITION_COLS, append_rows, next_load_seq, require_table
from windrow.sources.target_csv import read_target_csv


@dataclass(frozen=True)
class AppendPlan:
    """``counts`` per (app, type), ``rows`` to insert, ``stats`` of parsing."""

    counts: DataFrame
    rows: DataFrame
    stats: DataFrame


def plan_append(spark: SparkSession, path: str, table: str) -> AppendPlan:
    """Parse, check and compare with the table.  One bad row rejects the whole file."""
    require_table(spark, table)
    typed = stage(type_append_rows(read_target_csv(spark, path)), "append")
    bad = typed.filter(F.col("error").isNotNull())
    first = bad.agg(F.min_by("error", "row_ord").alias("error")).first()
    if first is not None and first.error is not None:
        raise ValueError(f"{path}: {first.error}")
    existing = within_span(spark.table(table), typed, "event_date")
    existing = of_the_same_days(existing, typed, PARTITION_COLS)
    # One look at the table: counts and rows both come from what it said of the file's keys.
    marked = stage(marked_keys(typed, existing), "marked")
    rows = stage(at_table_scale(unseen_rows(typed, marked)), "to-insert")
    return AppendPlan(append_counts(marked), rows, parse_stats(typed))


def carry_out(plan: AppendPlan, table: str, load_seq: int | None = None) -> int:
    """Insert the plan's rows; returns how many."""
    spark = plan.rows.sparkSession
    n = plan.rows.count()
    if n:
        append_rows(spark, table, plan.rows, load_seq or next_load_seq())
    return n
