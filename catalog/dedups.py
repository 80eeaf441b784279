"""Queries on duplicate events and whole-table rewrites."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from windrow.operators.audit import uniqueness_violations
from windrow.operators.dedup import (
    collapse_counters,
    collapse_exact,
    keep_latest,
    resolve,
    rewrite,
)
from windrow.operators.ordinal import add_ordinal
from windrow.plans.rewrite_run import rewrite_table
from windrow.runtime import scratch_path
from windrow.sinks.table import append_rows, create_table, table_location
from windrow.spec import EVENTS

SERIES = ("app_id", "attribution_type")
KEY = "event_time, event_name, device_id"
FIVE = f"app_id, attribution_type, {KEY}"


def ranked(source: str, partition: str, order: str, out: str) -> str:
    return f"""SELECT {out} FROM (SELECT *, row_number() OVER (
  PARTITION BY {partition} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


LATEST = "install_time DESC NULLS LAST, row_ord DESC"


@query("q14_keep_latest", v.VIEWS + ranked("e", FIVE, LATEST, f"row_ord, {v.TABLE_LIST}"))
def q14(spark, sf_dir):
    return keep_latest(v.e(spark, sf_dir), SERIES).select("row_ord", *v.COLUMNS)


@query("q15_rewrite_three_columns", v.VIEWS + ranked("e", KEY, LATEST, f"row_ord, {v.TABLE_LIST}"))
def q15(spark, sf_dir):
    kept = rewrite(v.e(spark, sf_dir), ordinals=("row_ord",))
    return kept.select("row_ord", *v.COLUMNS)


@query("q15_rewrite_and_swap", v.VIEWS + ranked("e", KEY, LATEST, f"row_ord, {v.TABLE_LIST}"))
def q15_swap(spark, sf_dir):
    """The same through the table: built aside, verified, swapped in, old rows kept."""
    location = scratch_path(spark, "q15")
    name = f"windrow_{location.rsplit('-', 1)[-1]}"
    create_table(spark, name, location)
    append_rows(spark, name, v.e(spark, sf_dir), 1)
    rewrite_table(spark, name, f"{name}_bak")
    schema, home = spark.table(name).schema, table_location(spark, name)
    for entry in (name, f"{name}_bak"):  # only the entries: the tables are external
        spark.sql(f"DROP TABLE {entry}")
    return spark.read.schema(schema).parquet(home).select("row_ord", *v.COLUMNS)


LINE_REST = (
    "l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"
)


def _line_order(direction: str) -> str:
    rest = ", ".join(f"{c} ASC NULLS FIRST" for c in LINE_REST.split(", "))
    nulls = "LAST" if direction == "DESC" else "FIRST"
    return f"l_shipdate DESC NULLS LAST, l_extendedprice {direction} NULLS {nulls}, {rest}"


LINE_COLUMNS = f"l_orderkey, l_linenumber, l_shipdate, l_extendedprice, {LINE_REST}"


def _lines(spark, sf_dir, tie):
    return rewrite(
        v.table(spark, sf_dir, "lineitem"),
        key=("l_orderkey", "l_linenumber"),
        tie=tie,
        rank="l_shipdate",
        revenue="l_extendedprice",
    )


@query(
    "q16_rewrite_revenue_tie",
    ranked("lineitem", "l_orderkey, l_linenumber", _line_order("DESC"), LINE_COLUMNS),
)
def q16(spark, sf_dir):
    return _lines(spark, sf_dir, "revenue_desc")


@query(
    "q16_rewrite_revenue_tie_down",
    ranked("lineitem", "l_orderkey, l_linenumber", _line_order("ASC"), LINE_COLUMNS),
)
def q16_down(spark, sf_dir):
    return _lines(spark, sf_dir, "revenue_asc")


FOLD = """, f AS (
  SELECT app_id, attribution_type, event_time, event_name, device_id, event_revenue, row_ord,
    {rank: install_time IS NOT NULL, t: install_time} AS rk,
    {a: attributed_touch_time, b: media_source, c: channel, d: campaign, e: campaign_id,
     f: adset, g: adset_id, h: ad, i: ad_id, j: customer_user_id, k: install_time,
     l: event_revenue} AS body
  FROM e2
), g AS (
  SELECT *, arg_max({rk: rk, body: body, rev: event_revenue, n: row_ord}, {r: rk, n: row_ord})
    OVER (PARTITION BY app_id, attribution_type, event_time, event_name, device_id
      ORDER BY row_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inc
  FROM f
), h AS (
  SELECT *, body IS NOT DISTINCT FROM inc.body AS same,
    rk IS NOT DISTINCT FROM inc.rk AS same_rank,
    CASE WHEN rk >= inc.rk THEN inc.rev ELSE event_revenue END AS lost
  FROM g WHERE inc IS NOT NULL
), k AS (
  SELECT app_id, attribution_type,
    count(*) FILTER (same) AS exact_duplicates,
    count(*) FILTER (NOT same) AS conflicts,
    count(*) FILTER (NOT same AND same_rank) AS ties,
    CAST(coalesce(sum(lost) FILTER (NOT same), 0) AS DECIMAL(28,4)) AS discarded_revenue,
    arg_min({t: event_time, n: event_name, d: device_id}, row_ord) FILTER (NOT same) AS fc
  FROM h GROUP BY ALL
)
SELECT app_id, attribution_type, exact_duplicates, conflicts, ties, discarded_revenue,
  fc.t AS first_event_time, fc.n AS first_event_name, fc.d AS first_device_id FROM k"""


def _counters(spark, sf_dir, **options):
    counted = collapse_counters(v.e2(spark, sf_dir), SERIES, **options)
    first = "first_conflict"
    return counted.select(
        *SERIES,
        "exact_duplicates",
        "conflicts",
        "ties",
        F.col("discarded_revenue").cast("decimal(28,4)").alias("discarded_revenue"),
        F.col(f"{first}.event_time").alias("first_event_time"),
        F.col(f"{first}.event_name").alias("first_event_name"),
        F.col(f"{first}.device_id").alias("first_device_id"),
    )


@query("q17_collapse_counters", v.VIEWS + FOLD)
def q17(spark, sf_dir):
    return _counters(spark, sf_dir)


@query("q17_collapse_counters_split_keys", v.VIEWS + FOLD)
def q17_split(spark, sf_dir):
    """The same with every repeated key treated as hot and cut into blocks."""
    return _counters(spark, sf_dir, hot_key_rows=1)


@query("q18_rewrite_keeps_twins", v.VIEWS + ranked("e", FIVE, LATEST, f"row_ord, {v.TABLE_LIST}"))
def q18(spark, sf_dir):
    kept = rewrite(v.e(spark, sf_dir), key=(*SERIES, *EVENTS.key), ordinals=("row_ord",))
    return kept.select("row_ord", *v.COLUMNS)


@query(
    "q19_exact_duplicates",
    v.VIEWS + f"SELECT min(row_ord) AS row_ord, {v.TABLE_LIST} FROM e2 GROUP BY {v.TABLE_LIST}",
)
def q19(spark, sf_dir):
    return collapse_exact(v.e2(spark, sf_dir), SERIES).select("row_ord", *v.COLUMNS)


@query(
    "q20_keep_all",
    v.VIEWS + f"""SELECT {FIVE}, count(*) AS n, sum(event_revenue) AS revenue FROM (
  SELECT DISTINCT {v.TABLE_LIST} FROM e2) GROUP BY {FIVE}""",
)
def q20_keep_all(spark, sf_dir):
    kept, _ = resolve(v.e2(spark, sf_dir), "keep_all", SERIES)
    return kept.groupBy(*SERIES, *EVENTS.key).agg(
        F.count("*").alias("n"), F.sum("event_revenue").cast("decimal(38,4)").alias("revenue")
    )


DEVICE_WEEK = ("app_id", "attribution_type", "start_date", "device_id")
WEEKS2 = """, w2 AS (
  SELECT * FROM w UNION ALL
  SELECT * REPLACE (row_ord + 1000000000000000 AS row_ord) FROM w WHERE row_ord % 11 = 0
), u AS (
  SELECT * EXCLUDE (row_ord), min(row_ord) AS row_ord FROM w2 GROUP BY ALL
), kk AS (
  SELECT app_id, attribution_type, start_date, device_id, event_time, event_name,
    count(*) AS n, min(row_ord) AS first_ord FROM u GROUP BY ALL HAVING count(*) > 1
), bad AS (
  SELECT app_id, attribution_type, start_date, device_id,
    count(*) AS conflicting_keys, min(first_ord) AS first_ord FROM kk GROUP BY ALL
)
"""


@query("q20_fail_policy_windows", v.VIEWS + WEEKS2 + "SELECT * FROM bad")
def q20_bad(spark, sf_dir):
    rows = v.with_window(v.e2(spark, sf_dir))
    return resolve(rows, "fail", DEVICE_WEEK)[1]


@query(
    "q20_fail_policy_rows",
    v.VIEWS + WEEKS2 + f"SELECT row_ord, {v.TABLE_LIST} FROM u "
    f"ANTI JOIN bad USING ({', '.join(DEVICE_WEEK)})",
)
def q20_rows(spark, sf_dir):
    rows = v.with_window(v.e2(spark, sf_dir))
    return resolve(rows, "fail", DEVICE_WEEK)[0].select("row_ord", *v.COLUMNS)


@query(
    "q37_unique_after_rewrite",
    v.VIEWS + f""", n AS ({ranked('e', KEY, LATEST, KEY)})
SELECT count(*) AS violations FROM (SELECT 1 FROM n GROUP BY {KEY} HAVING count(*) > 1)""",
)
def q37(spark, sf_dir):
    return uniqueness_violations(rewrite(v.e(spark, sf_dir), ordinals=("row_ord",)))


@query(
    "q46_row_ordinal",
    v.VIEWS + """SELECT row_number() OVER (ORDER BY event_time, device_id, row_ord) AS id, row_ord
FROM e""",
)
def q46(spark, sf_dir):
    rows = v.e(spark, sf_dir).select("event_time", "device_id", "row_ord")
    return add_ordinal(rows, ["event_time", "device_id", "row_ord"]).select("id", "row_ord")


@query(
    "q49_extra_key_column",
    ranked(
        """(SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_time,
      event_type, user_id, CASE WHEN event_id % 9 <> 0 THEN props END AS event_value,
      CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS install_time FROM events)""",
        "event_time, event_type, user_id, event_value",
        "install_time DESC NULLS LAST, event_id DESC",
        "event_id, event_time, event_type, user_id, event_value",
    ),
)
def q49(spark, sf_dir):
    """Streams where seconds do not separate events get one more key column."""
    day, n = F.col("ts").cast("date"), F.col("event_id")
    rows = v.table(spark, sf_dir, "events").select(
        "event_id",
        day.cast("timestamp_ntz").alias("event_time"),
        F.col("event_type").alias("event_name"),
        F.col("user_id").alias("device_id"),
        F.when(n % 9 != 0, F.col("props")).alias("event_value"),
        F.when(n % 7 != 0, day).alias("install_time"),
    )
    kept = keep_latest(rows, (), EVENTS.with_key("event_value").key, order="event_id")
    return kept.select(
        "event_id",
        "event_time",
        F.col("event_name").alias("event_type"),
        F.col("device_id").alias("user_id"),
        "event_value",
    )
