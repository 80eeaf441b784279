"""Mixing sources to target weights: shuffle each source, then cut it at its budget.

Every row gets a key that is a hash of its id.  Within a source the keys are sorted range by
range, the sizes are summed up as prefix sums (inside a range, plus the sum of the ranges
before it), and the prefix sum says how much of a row falls inside the source's budget.  A
budget above the source's size goes round again, whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import SPACE, WORD, null_key
from windrow.operators.ordinal import add_ordinal
from windrow.runtime import counted_bound, join_small, stage

WEIGHTS = (3, 1, 2)
# Rows one sorted range has on average.  A range is sorted to disk if it must be.
RANGE_ROWS = 1000
HASH_SPAN = 1 << 32


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)))


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, epochs: int
) -> DataFrame:
    """Add ``target`` to (source, source_size, ...): shares by weight, each at most ``epochs``
    times its source, the excess dealt again by weight until none is above.

    A source is capped where its share exceeds its cap.  Capping raises the share of a weight
    unit, never lowers it, so the capped ones follow from the last pair (rest, weight) alone
    and a round is one small aggregate.
    """
    ranked = add_ordinal(sizes, [F.col("source").asc_nulls_last()], "_rank")
    table = F.array(*[F.lit(int(w)) for w in weights])
    ranked = stage(
        ranked.withColumn(
            "_weight", F.element_at(table, ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
        ).withColumn("_cap", F.col("source_size") * F.lit(epochs)),
        "sources",
    )
    rest, weight, n_capped = None, None, -1
    while True:
        above = F.lit(False) if rest is None else F.col("_weight") * rest / weight > F.col("_cap")
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("_cap"))).alias("capped"),
            F.sum(F.when(~above, F.col("_weight"))).alias("open"),
            F.count_if(above).alias("n"),
        ).first()
        if row.n == n_capped or not row.open:
            break
        n_capped = row.n
        rest = F.lit(share * (row["all"] or 0) - (row.capped or 0))
        weight = F.lit(float(row.open))
    if rest is None:
        return ranked.withColumn("target", F.lit(0.0))
    fair = F.col("_weight") * rest / weight
    return ranked.withColumn("target", F.least(fair, F.col("_cap").cast("double")))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, size, source_size, target, taken, source``.

    ``size`` is the number of words, 0 for a NULL or empty text; such rows are never taken.
    Sources in code point order, NULL last and a source of its own, take ``weights`` in turn.
    The words taken of a source are exactly its target, rounded down: the row in which the
    budget ends is taken up to there.  Rows of one id share a key; the smaller one comes
    first, equal ones in any order, which changes nothing.  The same rows give the same mix,
    however they are dealt out.  An empty table gives no rows; other columns are not read.
    """
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            words(F.col(text_col)).alias("size"),
        ),
        "sizes",
    )
    rows = rows.withColumn("_source", null_key(F.col("source")))
    sizes = rows.groupBy("source", "_source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows")
    )
    targets = source_targets(sizes, weights, share, epochs).drop("source", "_cap", "_weight", "_rank")
    bound = counted_bound(targets)
    key = hash_key(F.col("doc_id"), seed)
    spread = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    ranges = F.ceil(F.col("_rows") / F.lit(RANGE_ROWS))
    dealt = join_small(rows, targets, ["_source"], "inner", bound).withColumn("_key", key)
    dealt = dealt.withColumn("_range", F.floor(spread * ranges / F.lit(HASH_SPAN)))
    by_range = Window.partitionBy("_source", "_range").orderBy("_key", "doc_id", "size")
    inside = dealt.withColumn(
        "_until", F.sum("size").over(by_range.rowsBetween(Window.unboundedPreceding, 0))
    )
    by_source = Window.partitionBy("_source").orderBy("_range")
    before = (
        dealt.groupBy("_source", "_range")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_offset", F.sum("_sum").over(by_source) - F.col("_sum"))
        .drop("_sum")
    )
    budget = F.floor("target")
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    start = F.col("_offset") + F.col("_until") - F.col("size")
    left = budget - rounds * F.col("source_size") - start
    taken = rounds * F.col("size") + F.least("size", F.greatest(F.lit(0), left))
    return inside.join(before, ["_source", "_range"]).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source"
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as taken, with all their columns.

    A row that the budget cuts keeps the words before the cut, joined by single spaces.
    Rows are matched with their share by id (NULL is an id like others); should an id repeat,
    its rows are all taken as often as the one with the smallest size.
    """
    shares = mix(docs, **options).groupBy(F.col("doc_id").alias("_id")).agg(
        F.min(F.struct(F.col("size").alias("n"), "taken")).alias("_share")
    )
    shares = shares.filter(F.col("_share.taken") > 0)
    joined = docs.join(shares, docs["doc_id"].eqNullSafe(shares["_id"]))
    size, taken = F.col("_share.n"), F.col("_share.taken")
    rounds = F.sequence(F.lit(1), F.ceil(taken / size).cast("int"))
    joined = joined.withColumn("_round", F.explode(rounds))
    here = F.least(size, taken - (F.col("_round") - 1) * size)
    parts = F.filter(F.split(F.col("text"), SPACE), lambda w: w != "")
    cut = F.array_join(F.slice(parts, F.lit(1), here.cast("int")), " ")
    text = F.when(here < size, cut).otherwise(F.col("text"))
    return joined.withColumn("text", text).select(docs.columns)
