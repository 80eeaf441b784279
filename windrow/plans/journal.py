"""The journal of a table's runs: what every window brought, run by run.

It lies with the table.  Stability between two runs of a window, and what an extract of the
same windows says, are read from it without reading the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.work_items import WorkItems
from windrow.runtime import staging
from windrow.sinks.table import fingerprint, table_location
from windrow.spec import WINDOW_COLS

# Hidden from readers of the table's folder.
JOURNAL = "_journal"

ENTRY = (
    "load_seq long, seq long, app_id string, attribution_type string, start_date date,"
    " end_date date, rows long, revenue decimal(38,4), prints array<decimal(38,0)>"
)


def window_entries(rows: DataFrame, items: WorkItems, load_seq: int) -> DataFrame:
    """One entry per window of a run; a window without rows has an entry, too."""
    prints = fingerprint(rows, ["seq"]).withColumnRenamed("n", "rows")
    money = rows.groupBy("seq").agg(F.sum("event_revenue").alias("revenue"))
    met = items.df.select("seq", *WINDOW_COLS).join(prints, "seq", "left").join(money, "seq", "left")
    zero = F.lit(0)
    told = met.select(
        F.lit(load_seq).cast("long").alias("load_seq"),
        "seq",
        *WINDOW_COLS,
        F.coalesce("rows", zero).cast("long").alias("rows"),
        F.coalesce("revenue", zero).cast("decimal(38,4)").alias("revenue"),
        F.col("prints").cast("array<decimal(38,0)>").alias("prints"),
    )
    return told


def record_run(
    spark: SparkSession, table: str, rows: DataFrame, items: WorkItems, load_seq: int
) -> None:
    """Add a run to the table's journal; a run recorded again counts once, by its last entry."""
    path = f"{table_location(spark, table)}/{JOURNAL}"
    with staging(spark):
        entries = window_entries(rows, items, load_seq)
        entries.coalesce(1).write.mode("append").parquet(path)


def journal(spark: SparkSession, table: str) -> DataFrame:
    """All entries, equal ones once."""
    path = f"{table_location(spark, table)}/{JOURNAL}"
    found = spark.read.schema(ENTRY).parquet(path)
    return found.dropDuplicates(["load_seq", "seq", *WINDOW_COLS, "rows", "revenue", "prints"])


def stability(entries: DataFrame, earlier: int, later: int) -> DataFrame:
    """Windows of two runs side by side: rows and revenue, and whether they are the same rows.

    A window that only one of the runs had has NULL for the other.  ``lost`` says that rows
    are fewer than they were, which a report that only grows never shows.
    """
    keys = list(WINDOW_COLS)
    side = lambda run, tag: entries.filter(F.col("load_seq") == run).select(
        *keys, *[F.col(c).alias(f"{c}_{tag}") for c in ("rows", "revenue", "prints")]
    )
    met = side(earlier, "before").join(side(later, "after"), keys, "full_outer")
    return met.select(
        *keys,
        "rows_before",
        "rows_after",
        "revenue_before",
        "revenue_after",
        (F.col("rows_after") < F.col("rows_before")).alias("lost"),
        F.col("prints_before").eqNullSafe(F.col("prints_after")).alias("same"),
    )
