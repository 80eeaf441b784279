"""Replacing windows: delete what a window owns, insert what its report holds.

Windows are loaded in ``seq`` order, each as delete-then-insert.  A report may
hold rows outside its window: they are inserted as they are, survive the next
load of their own window, and are deleted by a later window that owns their day.
All of this is set-based: one row is deleted by the first window after its own
that owns its day, and lives if there is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.dates import in_window
from windrow.operators.work_items import WorkItems, window_days
from windrow.runtime import join_small
from windrow.spec import EVENTS, ReportSpec, WINDOW_COLS

# Sequence number of rows that were in the table before the run.
BEFORE_RUN = -1

# A window owns whole days of one app and type.
OWNER = ("app_id", "attribution_type", "day")


def with_deleter(
    rows: DataFrame, items: WorkItems, loaded_by: Column, window_column: str, keep_day: bool = False
) -> DataFrame:
    """Add ``deleted_by``: the window that deletes the row, or NULL if it stays."""
    day = F.col(window_column).cast("date")
    tagged = rows.withColumn("_seq", loaded_by).withColumn("day", day)
    joined = join_small(tagged, window_days(items), OWNER, "left", items.days)
    later = F.filter("seqs", lambda s: s > F.col("_seq"))
    out = joined.withColumn("deleted_by", F.get(later, 0)).drop("seqs", "_seq")
    return out if keep_day else out.drop("day")


def tag_windows(incoming: DataFrame, items: WorkItems) -> DataFrame:
    """Give each row of a report its window's sequence number; other windows drop out."""
    keys = list(WINDOW_COLS)
    return join_small(incoming, items.df.select("seq", *keys), keys, "inner", items.count)


def replace_windows(
    existing: DataFrame, incoming: DataFrame, items: WorkItems, spec: ReportSpec = EVENTS
) -> DataFrame:
    """The table after the run.  ``incoming`` carries ``seq``; both have the table's columns.

    Only windows in ``items`` are replaced, so a failed window must not be in it:
    leaving it out keeps its old rows.  A window without incoming rows is wiped.
    """
    columns = existing.columns
    # Any window that owns the day deletes an old row, so which one is not asked.
    owned = window_days(items).drop("seqs")
    dated = existing.withColumn("day", F.col(spec.window_column).cast("date"))
    kept = join_small(dated, owned, OWNER, "left_anti", items.days)
    added = with_deleter(incoming, items, F.col("seq"), spec.window_column)
    alive = added.filter(F.col("deleted_by").isNull())
    return kept.select(*columns).unionByName(alive.select(*columns))


def out_of_window(incoming: DataFrame, items: WorkItems, spec: ReportSpec = EVENTS) -> DataFrame:
    """Incoming rows whose event lies outside their own window."""
    bounds = items.df.select(
        "seq", F.col("start_date").alias("_s"), F.col("end_date").alias("_e")
    )
    joined = join_small(incoming, bounds, ["seq"], "inner", items.count)
    inside = in_window(F.col(spec.window_column), F.col("_s"), F.col("_e"))
    return joined.filter(~inside).drop("_s", "_e")


def replace_metrics(
    existing: DataFrame, incoming: DataFrame, items: WorkItems, spec: ReportSpec = EVENTS
) -> DataFrame:
    """Rows deleted and inserted per window, and whether it was wiped.

    Wiped: rows were deleted and nothing came back, which is legitimate but must
    be seen.
    """
    day = F.col(spec.window_column).cast("date").alias("day")
    parts = ("app_id", "attribution_type")
    rows = existing.select(*parts, day, F.lit(BEFORE_RUN).cast("long").alias("seq")).unionByName(
        incoming.select(*parts, day, F.col("seq").cast("long").alias("seq"))
    )
    # One pass over table and reports; from here on it is a row per day and window.
    daily = rows.groupBy(*parts, "day", "seq").agg(F.count("*").alias("n"))
    daily = with_deleter(daily, items, F.col("seq"), "day", keep_day=True)
    zero = F.lit(0).cast("long")
    told = daily.select(
        "day",
        F.explode(
            F.array(
                F.struct(F.col("deleted_by").alias("seq"), F.col("n").alias("deleted"), zero.alias("inserted")),
                F.struct(F.col("seq").alias("seq"), zero.alias("deleted"), F.col("n").alias("inserted")),
            )
        ).alias("t"),
    ).select("day", "t.*")
    counts = told.groupBy("seq", "day").agg(F.sum("deleted").alias("deleted"), F.sum("inserted").alias("inserted"))
    windows = items.df.select("seq", *WINDOW_COLS)
    outside = (F.col("day") < F.col("start_date")) | (F.col("day") > F.col("end_date"))
    sums = {
        "deleted": F.col("deleted"),
        "inserted": F.col("inserted"),
        "out_of_window": F.when(outside, F.col("inserted")),
    }
    out = (
        windows.join(counts, "seq", "left")
        .groupBy("seq", *WINDOW_COLS)
        .agg(*[F.coalesce(F.sum(c), zero).alias(k) for k, c in sums.items()])
    )
    return out.withColumn("wiped", (F.col("deleted") > 0) & (F.col("inserted") == 0))
