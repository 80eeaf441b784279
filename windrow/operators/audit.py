"""Read-only audits of the table: baselines, duplicates, profiles, differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.text import NULL_LITERALS
from windrow.spec import EVENTS

GROUP = ("app_id", "attribution_type")
KEY = EVENTS.key
TYPED_KEY = (*KEY, "attribution_type")

# Column widths to suggest, the row budget in bytes and the cost of
# a column of width n (4n + 2).
WIDTHS = (16, 32, 64, 128, 255)
ROW_BUDGET = 65_535


def baseline(df: DataFrame) -> DataFrame:
    """Rows, apps, time span and revenue of the whole table."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("app_id").alias("apps"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.sum("event_revenue").alias("total_revenue"),
    )


def grouped_baseline(df: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    return (
        df.groupBy(*by)
        .agg(F.count("*").alias("rows"), F.sum("event_revenue").alias("revenue"))
        .orderBy(*by)
    )


def dedup_impact(df: DataFrame) -> DataFrame:
    """Rows a rewrite would drop under the 3-column and the 5-column key.

    As COUNT(DISTINCT a, b, c) has it, a key with a NULL part is not counted as a
    key.  Rolled up key by key: each level is combined before its shuffle, and no
    row is expanded per distinct count.
    """
    complete = ~F.greatest(*[F.col(c).isNull() for c in KEY])
    five = df.groupBy(*KEY, *GROUP).agg(F.count("*").alias("n"))
    five_ok = complete & ~F.greatest(*[F.col(c).isNull() for c in GROUP])
    three = five.groupBy(*KEY).agg(F.sum("n").alias("n"), F.count_if(five_ok).alias("n5"))
    return three.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("n") - F.count_if(complete), F.lit(0)).alias("dropped_3col"),
        F.coalesce(F.sum("n") - F.sum("n5"), F.lit(0)).alias("dropped_5col"),
    )


def duplicate_groups(df: DataFrame, key: Sequence[str] = TYPED_KEY) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def conflict_report(df: DataFrame, key: Sequence[str] = TYPED_KEY) -> DataFrame:
    """Per duplicated key: rows, distinct install times and revenues, revenue.

    Rows are first collapsed to one per combination of values, in every map task
    before the shuffle, so the two distinct counts expand combinations, not rows,
    and a hot key arrives already collapsed.
    """
    combos = df.groupBy(*key, "install_time", "event_revenue").agg(
        F.count("*").alias("n"), F.sum("event_revenue").alias("s")
    )
    per_key = combos.groupBy(*key).agg(
        F.sum("n").alias("rows_in_key"),
        F.count_distinct("install_time").alias("distinct_install_times"),
        F.count_distinct("event_revenue").alias("distinct_revenues"),
        F.sum("s").alias("revenue_in_key"),
    )
    return per_key.filter("rows_in_key > 1").orderBy(
        F.col("event_time").desc(), *[c for c in key if c != "event_time"]
    )


def exact_duplicate_audit(df: DataFrame, key: Sequence[str] = TYPED_KEY) -> DataFrame:
    """Groups equal in key and revenue: how many, extra rows, overcounted revenue."""
    groups = duplicate_groups(df, (*key, "event_revenue"))
    extra = F.col("n_rows") - 1
    return groups.agg(
        F.count("*").alias("dup_groups"),
        F.coalesce(F.sum(extra), F.lit(0)).alias("extra_rows"),
        F.coalesce(F.sum(extra * F.col("event_revenue")), F.lit(0)).alias("overcounted_revenue"),
    )


def conflict_audit(df: DataFrame, key: Sequence[str] = TYPED_KEY) -> DataFrame:
    """Groups of one key with more than one revenue: how many, and their rows.

    Unequal minimum and maximum is the same as more than one distinct value, and
    needs no distinct count.
    """
    groups = df.groupBy(*key).agg(
        F.count("*").alias("n_rows"),
        F.min("event_revenue").alias("lo"),
        F.max("event_revenue").alias("hi"),
    )
    return groups.filter("lo < hi").agg(
        F.count("*").alias("conflict_groups"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("conflict_rows"),
    )


def sample_duplicates(df: DataFrame, groups: int = 10, key: Sequence[str] = TYPED_KEY) -> DataFrame:
    """All rows of the first few duplicated keys, for reading by eye."""
    few = duplicate_groups(df, key).select(*key).orderBy(*key).limit(groups)
    return (
        df.join(F.broadcast(few), list(key), "inner")
        .select(*key, "event_revenue", "app_id")
        .orderBy("event_time", "device_id")
    )


def twins(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Events present under more than one attribution type."""
    return (
        df.groupBy(*key)
        .agg(
            F.count_distinct("attribution_type").alias("n_types"), F.count("*").alias("n_rows")
        )
        .filter("n_types > 1")
    )


def uniqueness_violations(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """One row: keys held more than once.  Must be zero after a rewrite."""
    return duplicate_groups(df, key).agg(F.count("*").alias("violations"))


def _unpivot(one_row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn ``c__field`` columns of a one-row frame into one row per column."""
    entries = [
        F.struct(
            F.lit(c).alias("column_name"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields]
        )
        for c in columns
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def suggested_type(max_len: Column, long_text: Column) -> Column:
    """Smallest width of at least twice the longest value; ``?`` when there is none."""
    out = F.when(long_text, F.lit("TEXT")).when(max_len.isNull(), F.lit("?"))
    for width in WIDTHS:
        out = out.when(max_len * 2 <= width, F.lit(f"VARCHAR({width})"))
    return out.otherwise(F.lit("TEXT"))


def column_profile(df: DataFrame, long_text: Sequence[str] = ()) -> DataFrame:
    """Per text column: non-empty values, longest value, suggested type.

    All columns in one pass; one row leaves each task.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]
    aggs = []
    for c in texts:
        filled = ~(F.col(f"`{c}`").isNull() | (F.col(f"`{c}`") == ""))
        aggs.append(F.count_if(filled).alias(f"{c}__non_empty"))
        aggs.append(F.max(F.when(filled, F.length(f"`{c}`"))).alias(f"{c}__max_len"))
    profile = _unpivot(df.agg(*aggs), texts, ["non_empty", "max_len"])
    is_long = F.col("column_name").isin(list(long_text)) if long_text else F.lit(False)
    return profile.withColumn("suggested", suggested_type(F.col("max_len"), is_long))


def row_width(profile: DataFrame) -> DataFrame:
    """Bytes a row of the suggested columns takes, against the budget."""
    width = F.regexp_extract("suggested", r"VARCHAR\((\d+)\)", 1)
    cost = F.when(width != "", width.try_cast("int") * 4 + 2).otherwise(0)
    total = F.coalesce(F.sum(cost), F.lit(0))
    return profile.agg(
        total.alias("row_bytes"), (total <= ROW_BUDGET).alias("fits")
    )


def mix(df: DataFrame, *by: str) -> DataFrame:
    """Rows per group and their share of all rows.

    The total is a scalar subquery, not a window over everything, so groups stay
    spread over tasks however many there are.
    """
    total = df.select(F.count("*").alias("n")).scalar()
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / total)


def null_literals(df: DataFrame) -> DataFrame:
    """Per text column: values such as "NA" that some tools would read as NULL."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    aggs = [
        F.count_if(F.col(f"`{c}`").isin(list(NULL_LITERALS))).alias(f"{c}__literals")
        for c in texts
    ]
    return _unpivot(df.agg(*aggs), texts, ["literals"])


def compare_tables(
    left: DataFrame,
    right: DataFrame,
    by: Mapping[str, Column],
    revenue: str = "event_revenue",
) -> DataFrame:
    """Rows and revenue of two tables per group, and their differences (right - left).

    Both sides are aggregated before they meet, so the join sees groups, not rows.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*[c.alias(name) for name, c in by.items()]).agg(
            F.count("*").alias(f"{tag}_rows"), F.sum(revenue).alias(f"{tag}_revenue")
        )

    both = side(left, "left").join(side(right, "right"), list(by), "full_outer")
    zero = F.lit(0)
    rows_l, rows_r = F.coalesce("left_rows", zero), F.coalesce("right_rows", zero)
    money_l, money_r = F.coalesce("left_revenue", zero), F.coalesce("right_revenue", zero)
    return both.select(
        *by,
        rows_l.alias("left_rows"),
        rows_r.alias("right_rows"),
        (rows_r - rows_l).alias("row_diff"),
        (money_r - money_l).alias("revenue_diff"),
    )


def fewer_rows(compared: DataFrame) -> DataFrame:
    """Groups that lost rows: must be empty when ``right`` should hold at least ``left``."""
    return compared.filter("row_diff < 0")
