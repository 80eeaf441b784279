"""Exact dedup by sorting contents: equal texts become neighbours and one of them stays.

Sampled splitters deal the normalised texts out by range, each range is sorted (to disk
where it must), and a window compares every text in full with its neighbours.  The splitters
cover the head of a text and its digest rather than the text itself: equal texts agree on
both, a sampled splitter stays small, and texts that merely begin alike still spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import SPACE, hot_counts
from windrow.runtime import stage

HEAD_CHARS = 32


def normalised(text: Column) -> Column:
    """Runs of white space become one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = 1000
) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are equal when their normalised texts are; the smallest id of each group stays.
    A NULL text counts as empty, and all empty texts are one group.  A NULL id is larger
    than any other; a group of NULL ids has a NULL ``keep_id`` and keeps one row.  Of rows
    that repeat an id and its text one is kept.  An empty table gives no rows, and other
    columns are not read.

    A group of more than ``hot_rows`` rows is sorted in several parts, and the parts' minima
    and sizes are put together afterwards by digest, so no task sees a whole hot group.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("_text"))
    rows = rows.withColumn("_sha", F.sha2("_text", 256))
    hot = F.broadcast(hot_counts(rows, "_sha", hot_rows))  # at most MAX_HOT_KEYS rows
    parts = F.ceil(F.col("_n") / F.lit(hot_rows))
    dealt = (
        rows.join(hot, "_sha", "left")
        .withColumn("_part", F.coalesce(F.pmod(F.xxhash64("doc_id"), parts), F.lit(-1)))
        .withColumn("_head", F.substring("_text", 1, HEAD_CHARS))
        .repartitionByRange("_head", "_sha", "_part")
    )
    # The range partitioning already clusters these keys, so nothing is shuffled again.
    equal = Window.partitionBy("_head", "_sha", "_part", "_text").orderBy(
        F.col("doc_id").asc_nulls_last()
    )
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = stage(
        dealt.select(
            "doc_id",
            F.col("_sha").alias("text_sha256"),
            "_part",
            F.first("doc_id").over(whole).alias("_least"),
            F.count("*").over(whole).alias("_rows"),
            (F.row_number().over(equal) == 1).alias("_first"),
        ),
        "exact",
    )
    merged = (
        compared.filter(F.col("_part") >= 0)
        .groupBy("text_sha256")
        .agg(F.min("_least").alias("_all_least"), F.count("*").alias("_all_rows"))
    )
    split = F.col("_part") >= 0
    keep_id = F.when(split, F.col("_all_least")).otherwise(F.col("_least"))
    return compared.join(F.broadcast(merged), "text_sha256", "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.when(split, F.col("_all_rows")).otherwise(F.col("_rows")).alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep_id) & F.col("_first")).alias("kept"),
        "text_sha256",
    )
