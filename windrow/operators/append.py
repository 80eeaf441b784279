"""Appending a file of table-shaped rows without ever deleting.

A row goes in only if its natural key is not in the table for the same app and
attribution type and did not appear earlier in the file.  The rule on repeats is
the opposite of report deduplication: here the first row wins.

Skew: the file is reduced to one row per key first, in every map task before the
shuffle, and so are the table's keys, so a hot key meets the join as one row.  A Bloom filter of
the file's keys drops nearly all others where the table is scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.runtime import counted_bound, join_small, stage
from windrow.spec import EVENTS, TABLE_COLUMNS

GROUP = ("app_id", "attribution_type")
NATURAL_KEY = (*GROUP, *EVENTS.key)


def group_bounds(rows: DataFrame) -> DataFrame:
    """First and last event time per (app, type) of the file."""
    return rows.groupBy(*GROUP).agg(
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time")
    )


def lookup_keys(existing: DataFrame, bounds: DataFrame) -> DataFrame:
    """Distinct table keys within each group's closed time span."""
    keys = existing.select(*NATURAL_KEY)
    joined = join_small(keys, bounds, GROUP, "inner", counted_bound(bounds))
    inside = F.col("event_time").between(F.col("first_time"), F.col("last_time"))
    return joined.filter(inside).select(*NATURAL_KEY).distinct()


def within_span(existing: DataFrame, rows: DataFrame, day_column: str) -> DataFrame:
    """Prune the table to the file's overall day span.

    The bounds are scalar subqueries, so a table partitioned by ``day_column``
    lists and reads only the partitions in the span.
    """
    day = F.col("event_time").cast("date")
    first = rows.select(F.min(day).alias("d")).scalar()
    last = rows.select(F.max(day).alias("d")).scalar()
    return existing.filter((F.col(day_column) >= first) & (F.col(day_column) <= last))


def of_the_same_days(existing: DataFrame, rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of the table's (app, type, day) partitions that the file has rows for.

    A list within the broadcast bound prunes the partitions before they are read.
    """
    day = F.col("event_time").cast("date").alias("event_date")
    days = stage(rows.select(*GROUP, day).distinct(), "days")
    return join_small(existing, days, partitions, "left_semi", counted_bound(days))


# A filter has a word of 64 bits for every four keys, up to so many words: some 30 MB to send.
MAX_FILTER_WORDS = 1 << 20


def filter_words(n_keys: int) -> int:
    return min(MAX_FILTER_WORDS, 1 << max(0, (n_keys // 4).bit_length()))


def key_filter(keys: DataFrame, n_keys: int) -> DataFrame:
    """A Bloom filter of natural keys as rows ``(word, bits)``: three bits in one word a key."""
    return (
        _hashed(keys, filter_words(n_keys))
        .groupBy("_word")
        .agg(F.bit_or("_bits").alias("_filter"))
    )


def _hashed(rows: DataFrame, words: int) -> DataFrame:
    more = F.xxhash64(F.lit(1), *NATURAL_KEY)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), _six_bits(more, at)) for at in (0, 6, 12)]
    return rows.withColumns(
        {
            "_word": F.pmod(F.xxhash64(*NATURAL_KEY), F.lit(words)),
            "_bits": bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]),
        }
    )


def _six_bits(value: Column, at: int) -> Column:
    return F.shiftright(value, at).bitwiseAND(F.lit(63)).cast("int")


def known_keys(existing: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """Distinct keys of the table that the file may have: all that it has, and few others.

    The filter is looked up where the table is scanned, so what is shuffled follows the size
    of the file, not of the table.
    """
    words = filter_words(n_keys)
    probed = _hashed(existing.select(*NATURAL_KEY), words)
    met = probed.join(F.broadcast(key_filter(keys, n_keys)), "_word")
    met = met.filter(F.col("_filter").bitwiseAND(F.col("_bits")) == F.col("_bits"))
    return met.select(*NATURAL_KEY).distinct()


def marked_keys(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """One row per natural key of the file: ``copies``, the first one's ``row_ord``, ``known``."""
    per_key = rows.groupBy(*NATURAL_KEY).agg(
        F.count("*").alias("copies"), F.min("row_ord").alias("row_ord")
    )
    per_key = stage(per_key, "file-keys")
    known = known_keys(existing, per_key, per_key.count()).withColumn("known", F.lit(True))
    marked = per_key.join(known, list(NATURAL_KEY), "left")
    return marked.withColumn("known", F.coalesce("known", F.lit(False)))


def unseen_rows(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """First row per key that the table does not have yet; rows are told by their place."""
    first = marked.filter(~F.col("known")).select("row_ord")
    return rows.join(first, "row_ord", "left_semi").select(*TABLE_COLUMNS, "row_ord")


def rows_to_append(rows: DataFrame, existing: DataFrame) -> DataFrame:
    return unseen_rows(rows, marked_keys(rows, existing))


def append_plan(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """What an append would do, per (app, type)."""
    return append_counts(marked_keys(rows, existing))


def append_counts(marked: DataFrame) -> DataFrame:
    """Being in the table is tested before being a repeat, so every copy of a known
    key counts as ``already_in_table``.
    """
    is_known, zero = F.col("known"), F.lit(0)
    return (
        marked.groupBy(*GROUP)
        .agg(
            F.sum("copies").alias("total"),
            F.sum(F.when(is_known, F.col("copies")).otherwise(zero)).alias("already_in_table"),
            F.sum(F.when(is_known, zero).otherwise(F.col("copies") - 1)).alias("intra_csv_dup"),
            F.count_if(~is_known).alias("to_insert"),
        )
        .orderBy(*GROUP)
    )
