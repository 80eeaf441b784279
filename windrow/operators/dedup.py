"""Duplicate events: which row of a key survives, and what was lost.

Two scopes are kept apart on purpose.  Within a report, rows are compared inside
one window only (``scope`` = the window columns), so an event present under both
attribution types keeps both rows.  A whole-table rewrite compares across
windows, and with the 3-column key across apps and types as well.

Skew: ``row_number() = 1`` is trimmed to one row per key in every map task before
the shuffle, so a key that holds a third of all rows costs each reducer one row
per map task.  The counters need the order of rows inside a key; there a hot key is
cut into blocks of the row order and the blocks are chained, see
``incumbents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.runtime import counted_bound, join_small, stage, within_broadcast
from windrow.spec import EVENTS, LOAD_ORDER, WINDOW_COLS

# Keys with more rows than this are cut into blocks of this many row ordinals.
HOT_KEY_ROWS = 1_000_000


def first_of(df: DataFrame, group: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group under a total order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def keep_latest(
    rows: DataFrame,
    scope: Sequence[str] = WINDOW_COLS,
    key: Sequence[str] = EVENTS.key,
    rank: str = EVENTS.rank_column,
    order: str = "row_ord",
) -> DataFrame:
    """Keep the row with the latest ``rank`` per key; NULL loses to any value.

    Ties go to the last row in report order.
    """
    return first_of(rows, [*scope, *key], [F.col(rank).desc_nulls_last(), F.col(order).desc()])


def collapse_exact(
    rows: DataFrame, scope: Sequence[str] = WINDOW_COLS, order: str = "row_ord"
) -> DataFrame:
    """Collapse rows equal in every typed column, keeping the first position.

    Plain hash aggregation on the columns themselves, combined before the shuffle.
    """
    columns = [c for c in rows.columns if c != order]
    group = [*scope, *(c for c in columns if c not in scope)]
    return rows.groupBy(*group).agg(F.min(order).alias(order)).select(*rows.columns)


def conflicting_windows(
    rows: DataFrame,
    scope: Sequence[str] = WINDOW_COLS,
    key: Sequence[str] = EVENTS.key,
    order: str = "row_ord",
) -> DataFrame:
    """Windows holding a key with two different rows, with the first such key's position."""
    distinct_rows = collapse_exact(rows, scope, order)
    per_key = distinct_rows.groupBy(*scope, *key).agg(
        F.count("*").alias("variants"), F.min(order).alias("first_ord")
    )
    return (
        per_key.filter("variants > 1")
        .groupBy(*scope)
        .agg(F.count("*").alias("conflicting_keys"), F.min("first_ord").alias("first_ord"))
    )


def resolve(
    rows: DataFrame,
    on_conflict: str = "latest",
    scope: Sequence[str] = WINDOW_COLS,
    key: Sequence[str] = EVENTS.key,
    rank: str = EVENTS.rank_column,
    order: str = "row_ord",
    windows_bound: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Apply a conflict policy: rows kept, and the windows it fails (if it can fail any).

    ``latest`` keeps one row per key; ``keep_all`` collapses exact duplicates only;
    ``fail`` does the same but gives up every window with a conflict.
    """
    if on_conflict == "latest":
        return keep_latest(rows, scope, key, rank, order), None
    if on_conflict == "keep_all":
        return collapse_exact(rows, scope, order), None
    if on_conflict == "fail":
        bad = conflicting_windows(rows, scope, key, order)
        bound = counted_bound(bad) if windows_bound is None else windows_bound
        whole = collapse_exact(rows, scope, order)
        return join_small(whole, bad.select(*scope), scope, "left_anti", bound), bad
    raise ValueError(f"unknown conflict policy: {on_conflict}")


def rewrite(
    table: DataFrame,
    key: Sequence[str] = EVENTS.key,
    tie: str = "last_loaded",
    rank: str = EVENTS.rank_column,
    revenue: str = "event_revenue",
    ordinals: Sequence[str] = LOAD_ORDER,
    collation: str | None = None,
) -> DataFrame:
    """Whole-table rewrite: one row per key, latest ``rank`` first.

    ``tie`` decides between equal ranks: ``last_loaded`` by the row ordinals,
    ``revenue_desc`` / ``revenue_asc`` by money and then by all other columns so
    that the result does not depend on the file layout.  Add ``app_id`` and
    ``attribution_type`` to ``key`` to keep events present under both types.
    ``collation`` compares text keys the way a database column would.
    """
    return first_of(table, *rewrite_order(table, key, tie, rank, revenue, ordinals, collation))


def rewrite_order(
    table: DataFrame,
    key: Sequence[str] = EVENTS.key,
    tie: str = "last_loaded",
    rank: str = EVENTS.rank_column,
    revenue: str = "event_revenue",
    ordinals: Sequence[str] = LOAD_ORDER,
    collation: str | None = None,
) -> tuple[list[Column], list[Column]]:
    """What groups the rows of a rewrite, and the order in which the first one stays."""
    order = [F.col(rank).desc_nulls_last()]
    if tie == "last_loaded":
        order += [F.col(c).desc() for c in ordinals]
    elif tie in ("revenue_desc", "revenue_asc"):
        money = F.col(revenue)
        order.append(money.desc_nulls_last() if tie == "revenue_desc" else money.asc_nulls_first())
        used = {*key, rank, revenue}
        order += [F.col(c).asc_nulls_first() for c in table.columns if c not in used]
        # Under a collation equal keys can differ in bytes, so they take part too.
        order += [F.col(c).asc_nulls_first() for c in key] if collation else []
    else:
        raise ValueError(f"unknown tie rule: {tie}")
    return [folded(table, c, collation) for c in key], order


def folded(table: DataFrame, column: str, collation: str | None) -> Column:
    """A key column as a rewrite compares it."""
    text = dict(table.dtypes)[column] == "string"
    return F.collate(F.col(column), collation) if collation and text else F.col(column)


def incumbents(
    rows: DataFrame,
    scope: Sequence[str],
    key: Sequence[str],
    rank: str,
    order: str,
    hot_key_rows: int,
    nullable_key: Sequence[str],
) -> DataFrame:
    """For each row, the row of its key that would be kept just before it.

    Adds ``_me`` and ``_inc``, structs of position and row; ``_inc`` is NULL for a
    key's first row.  The row kept so far is a running maximum of (rank, order),
    and a running maximum can be chained: a key above ``hot_key_rows`` is cut into
    blocks of the row order, each block is scanned on its own, and the maximum of
    the blocks before it is handed in.  No task sees more than ``hot_key_rows``
    rows of one key, plus one row per block.
    """
    group = [*scope, *key]
    columns = [c for c in rows.columns if c != order]
    repeated = stage(_of_repeated_keys(rows, group, nullable_key), "repeated")
    position = F.struct(F.col(rank).isNotNull().alias("has"), F.col(rank).alias("rank"), order)
    is_hot = F.col("_n") > hot_key_rows
    block = F.when(is_hot, F.expr(f"`{order}` div {hot_key_rows}")).otherwise(0)
    placed = repeated.select(
        *group,
        F.col(order),
        is_hot.alias("_hot"),
        block.cast("long").alias("_block"),
        F.struct(position.alias("pos"), F.struct(*columns).alias("row")).alias("_me"),
    )
    before = (Window.unboundedPreceding, -1)
    in_block = Window.partitionBy(*group, "_block").orderBy(order).rowsBetween(*before)
    local = placed.withColumn("_local", F.max_by("_me", "_me.pos").over(in_block))

    tops = placed.filter("_hot").groupBy(*group, "_block").agg(
        F.max_by("_me", "_me.pos").alias("_top")
    )
    over_blocks = Window.partitionBy(*group).orderBy("_block").rowsBetween(*before)
    carry = tops.select(
        *group, "_block", F.max_by("_top", "_top.pos").over(over_blocks).alias("_carry")
    ).filter(F.col("_carry").isNotNull())

    # Positions come first in the structs and are unique within a key.
    return _join(local, carry, [*group, "_block"], nullable_key, "left").withColumn(
        "_inc", F.greatest("_local", "_carry")
    )


def _of_repeated_keys(
    rows: DataFrame, group: Sequence[str], nullable: Sequence[str]
) -> DataFrame:
    """Rows whose key occurs more than once, with the number of its rows as ``_n``.

    Keys are counted before the shuffle.  Their counts are a table of their own, so that
    adaptive execution can split a hot key where they are too many to broadcast.
    """
    counts = rows.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    counts = stage(counts, "counts")
    if within_broadcast(counted_bound(counts)):
        counts = F.broadcast(counts)
    return _join(rows, counts, group, nullable, "inner")


def _join(
    left: DataFrame, right: DataFrame, on: Sequence[str], nullable: Sequence[str], how: str
) -> DataFrame:
    """Equi join on shared columns; those in ``nullable`` match NULL with NULL."""
    if not any(c in nullable for c in on):
        return left.join(right, list(on), how)
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    match = [
        F.col(c).eqNullSafe(F.col(f"_r_{c}")) if c in nullable else F.col(c) == F.col(f"_r_{c}")
        for c in on
    ]
    return left.join(renamed, match, how).drop(*[f"_r_{c}" for c in on])


def collapse_counters(
    rows: DataFrame,
    scope: Sequence[str] = WINDOW_COLS,
    key: Sequence[str] = EVENTS.key,
    rank: str = EVENTS.rank_column,
    revenue: str = "event_revenue",
    order: str = "row_ord",
    hot_key_rows: int = HOT_KEY_ROWS,
    nullable_key: Sequence[str] = (),
) -> DataFrame:
    """What ``keep_latest`` collapsed, per scope that has a repeated key.

    Rows are compared in report order with the row kept so far: an equal one is an
    exact duplicate, any other is a conflict, and a conflict of equal rank is a
    tie.  ``discarded_revenue`` adds up the losers of conflicts, NULL as zero, and
    ``first_conflict`` is the key of the first conflict.
    """
    judged = incumbents(rows, scope, key, rank, order, hot_key_rows, nullable_key)
    # The first row of a key meets none before it.
    judged = judged.filter(F.col("_inc").isNotNull())
    same = F.col("_me.row").eqNullSafe(F.col("_inc.row"))
    same_rank = F.col("_me.pos.rank").eqNullSafe(F.col("_inc.pos.rank"))
    conflict = ~same
    # The later of two equal ranks wins, so a challenger loses only to a higher one.
    loser = F.when(F.col("_me.pos") > F.col("_inc.pos"), F.col("_inc.row")).otherwise(
        F.col("_me.row")
    )
    # Reports that keep every column need not have money in them.
    lost = F.coalesce(loser[revenue], F.lit(0)) if revenue in rows.columns else F.lit(0)
    flagged = judged.select(
        *scope,
        order,
        F.struct(*key).alias("_key"),
        same.alias("_dup"),
        conflict.alias("_conflict"),
        (conflict & same_rank).alias("_tie"),
        F.when(conflict, lost).alias("_lost"),
    )
    return flagged.groupBy(*scope).agg(
        F.count_if("_dup").alias("exact_duplicates"),
        F.count_if("_conflict").alias("conflicts"),
        F.count_if("_tie").alias("ties"),
        F.coalesce(F.sum("_lost"), F.lit(0)).alias("discarded_revenue"),
        F.min_by(F.when(F.col("_conflict"), F.col("_key")), F.when(F.col("_conflict"), F.col(order)))
        .alias("first_conflict"),
    )
