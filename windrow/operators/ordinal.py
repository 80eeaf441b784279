"""Row ordinals: a surrogate id in a stable order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.runtime import stage

# monotonically_increasing_id() keeps the row's position in its partition in the
# lower 33 bits.
POSITION_BITS = (1 << 33) - 1


def position_in_task() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_BITS))


def add_ordinal(df: DataFrame, order: Sequence[Column | str], name: str = "id") -> DataFrame:
    """Number rows 1, 2, 3, ... in a total order, without one task seeing them all.

    The global sort splits rows into ranges; a row's number is its position in its
    range plus the sizes of the ranges before it.  The sorted rows are staged, so
    positions and sizes come from the same files.
    """
    ordered = df.orderBy(*order).withColumns(
        {"_range": F.spark_partition_id(), "_pos": position_in_task()}
    )
    staged = stage(ordered, "ordinal")
    sizes = staged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: as many as the sort had output partitions.
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    numbered = staged.join(F.broadcast(offsets), "_range", "inner")
    return numbered.withColumn(name, F.col("_before") + F.col("_pos") + 1).select(
        name, *df.columns
    )
