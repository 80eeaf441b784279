"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.runtime import ship_package

# The white space of the contracts, as characters of a regular expression.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Keys with more rows than the threshold below are split; a list of so many is broadcast.
MAX_HOT_KEYS = 100_000

# Rows and bytes of one batch handed to Python, so that long texts cannot pile up there.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def hot_counts(rows: DataFrame, key: str, at_least: int) -> DataFrame:
    """Keys with more than ``at_least`` rows and their counts, never too many to broadcast.

    Of N rows fewer than ``MAX_HOT_KEYS`` keys can hold more than N / MAX_HOT_KEYS rows
    each, so the threshold is raised to that where ``at_least`` is lower.
    """
    total = rows.select(F.count("*").alias("n")).scalar()
    threshold = F.greatest(F.lit(at_least), F.ceil(total / F.lit(MAX_HOT_KEYS)))
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    return counts.filter(F.col("_n") > threshold)


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to what the Python workers are sized for, and see
    that they have this package."""
    ship_package(spark)
    for name, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = spark.conf.get(name, None)
        if now is None or not 0 < _as_int(now) <= most:
            spark.conf.set(name, str(most))


def _as_int(value: str) -> int:
    return int(value) if value.lstrip("-").isdigit() else 0


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % folds


def null_key(c: Column) -> Column:
    """A text that joins like ``c`` does, with NULL equal to itself."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def by_bytes(batch: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Slices of a batch that hold about ``most`` bytes, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch), 0).to_pylist()
    lo = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(lengths):
        yield lo, len(lengths)
