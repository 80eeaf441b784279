"""Rewriting the table to one row per key: the whole of it with a swap, or what repeats alone."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.audit import (
    baseline,
    conflict_report,
    dedup_impact,
    grouped_baseline,
    uniqueness_violations,
)
from windrow.operators.dedup import first_of, folded, rewrite, rewrite_order
from windrow.runtime import counted_bound, join_small, stage, staging, within_broadcast
from windrow.sinks.table import (
    PARTITION_COLS,
    build_replacement,
    create_table,
    finish_switches,
    next_load_seq,
    swap_tables,
    switch_partitions,
    table_location,
)
from windrow.spec import EVENTS, LOAD_ORDER


def review(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """What to look at before a rewrite."""
    df = spark.table(table)
    return {
        "baseline": baseline(df),
        "grouped": grouped_baseline(df),
        "impact": dedup_impact(df),
        "conflicts": conflict_report(df),
    }


def rewrite_table(
    spark: SparkSession,
    table: str,
    backup: str,
    key: Sequence[str] = EVENTS.key,
    tie: str = "last_loaded",
    collation: str | None = None,
) -> DataFrame:
    """Rewrite ``table`` and return the new baseline.  The old rows stay in ``backup``.

    Nothing is swapped unless every key of the new table is unique and no key was
    lost; ``roll_back`` in the sink undoes the swap.
    """
    old = spark.table(table)
    keys_before = old.select(*[folded(old, c, collation) for c in key]).distinct().count()
    new = build_replacement(spark, table, rewrite(old, key, tie, collation=collation))
    fresh = spark.table(new)
    as_compared = fresh.withColumns({c: folded(fresh, c, collation) for c in key})
    violations = uniqueness_violations(as_compared, key).first()["violations"]
    kept = fresh.count()
    if violations or kept != keys_before:
        raise RuntimeError(
            f"rewrite of {table} not swapped in: {violations} repeated keys, "
            f"{kept} rows for {keys_before} keys; see {new}"
        )
    swap_tables(spark, table, new, backup)
    return baseline(spark.table(table))


def rewrite_repeats(
    spark: SparkSession,
    table: str,
    backup: str,
    key: Sequence[str] = EVENTS.key,
    tie: str = "last_loaded",
    collation: str | None = None,
) -> DataFrame:
    """Bring the table to one row per key by writing only the partitions that lose a row.

    Keys that repeat are counted first; they lead to their rows, and these to the partitions
    that lose any of them.  Rows that go are put into ``backup``, a table like this one:
    appending them undoes the rewrite.  All other partitions keep their files.  What was
    written is counted per partition before the catalog learns of it.  Returns one row:
    ``repeated_keys, dropped_rows, partitions_written, partitions_emptied``.
    """
    finish_switches(spark, table)
    old = spark.table(table)
    parts = list(PARTITION_COLS)
    group, order = rewrite_order(old, key, tie, collation=collation)
    names = [f"_key{i}" for i in range(len(group))]
    keyed = old.withColumns(dict(zip(names, group)))
    with staging(spark) as result:
        repeated = keyed.groupBy(*names).agg(F.count("*").alias("_n")).filter("_n > 1")
        repeated = stage(repeated, "repeated")
        bound = counted_bound(repeated)
        twins = join_null_safe(keyed, repeated.select(*names), names, bound)
        twins = stage(twins.withColumn("_id", F.monotonically_increasing_id()), "twins")
        # The first of each key is found with a trim in every task, the others as what is left
        # of the staged rows, so a key of any size is spread.
        winners = stage(first_of(twins, names, [*order, F.col("_id").asc()]), "winners")
        losers = twins.join(winners.select("_id"), "_id", "left_anti")
        touched = losers.groupBy(*parts).agg(F.count("*").alias("_lost"))
        touched = stage(touched, "touched")
        n_touched = counted_bound(touched)

        whole = join_small(keyed, touched, parts, "inner", n_touched)
        before = whole.groupBy(*parts).agg(F.count("*").alias("_n"), F.first("_lost").alias("_lost"))
        before = stage(before.withColumn("_left", F.col("_n") - F.col("_lost")), "before")
        others = join_null_safe(whole, repeated.select(*names), names, bound, "left_anti")
        winners = join_small(winners, touched, parts, "left_semi", n_touched)
        written = others.select(*old.columns).union(winners.select(*old.columns))
        stale = before.filter("_left = 0").select(*parts)

        expected = repeated.select(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n")).first().n

        def check(fresh: DataFrame) -> None:
            lost = before.select(F.coalesce(F.sum("_lost"), F.lit(0)).alias("n")).first().n
            if lost != expected:
                raise RuntimeError(f"rewrite of {table} not switched in: {lost} rows go, not {expected}")
            now = fresh.groupBy(*parts).agg(F.count("*").alias("_now"))
            met = before.filter("_left > 0").join(now, parts, "full_outer")
            wrong = met.filter(~F.col("_left").eqNullSafe(F.col("_now"))).count()
            if wrong:
                raise RuntimeError(f"rewrite of {table} not switched in: {wrong} partitions miscounted")

        if n_touched:
            create_table(spark, backup, f"{table_location(spark, table)}_{uuid.uuid4().hex[:12]}",
                         {c: t for c, t in old.dtypes if c not in (*LOAD_ORDER, "event_date")})
            losers.select(*old.columns).write.insertInto(backup)
            switch_partitions(spark, table, written, stale, next_load_seq(), check)
        told = before.agg(
            F.coalesce(F.sum("_lost"), F.lit(0)).alias("dropped_rows"),
            F.count_if(F.col("_left") > 0).alias("partitions_written"),
            F.count_if(F.col("_left") == 0).alias("partitions_emptied"),
        )
        return result(told.withColumn("repeated_keys", F.lit(repeated.count())), "rewritten")


def join_null_safe(
    big: DataFrame, keys: DataFrame, names: list[str], bound: int, how: str = "left_semi"
) -> DataFrame:
    """Rows with (or without) one of some distinct keys, of which NULL may be a part.

    Keys too many for a broadcast are shuffled: each has few rows, or a rewrite would not
    have the time to drop them either.
    """
    other = keys.toDF(*[f"{n}_k" for n in names])
    if within_broadcast(bound):
        other = F.broadcast(other)
    same = [F.col(n).eqNullSafe(F.col(f"{n}_k")) for n in names]
    return big.join(other, reduce(lambda a, b: a & b, same), how)
