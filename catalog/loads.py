"""Queries on windows, replacing, and appending."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from windrow.functions.dates import daily_window, daily_window_columns
from windrow.operators.append import (
    append_plan,
    group_bounds,
    lookup_keys,
    rows_to_append,
    within_span,
)
from windrow.operators.replace import replace_metrics, replace_windows, tag_windows
from windrow.operators.validate import at_table_scale, fetched_rows, type_append_rows
from windrow.operators.work_items import (
    clamp_to_floor,
    expand_windows,
    flag_before_floor,
    halve_windows,
    work_items,
)
from windrow.runtime import scratch_path, stage
from windrow.sinks.table import append_rows, create_table, replace_in_table
from windrow.spec import EVENTS, WINDOW_COLS

WINDOW = ", ".join(WINDOW_COLS)
OUT = f"row_ord, {v.TABLE_LIST}"


def spans(df: DataFrame) -> DataFrame:
    day = F.col("event_time").cast("date")
    return df.groupBy("app_id").agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))


CHUNKS = """SELECT app_id, attribution_type, CAST(s AS DATE) AS start_date,
  CAST(least(s + INTERVAL ({n} - 1) DAY, last) AS DATE) AS end_date
FROM (SELECT *, unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP),
    INTERVAL ({n}) DAY)) AS s FROM b)
  CROSS JOIN (SELECT unnest(['non_organic', 'retargeting']) AS attribution_type)"""


@query(
    "q09_work_items",
    v.VIEWS
    + """, b AS (SELECT app_id, min(event_time)::DATE AS first, max(event_time)::DATE AS last
  FROM e GROUP BY app_id) """
    + CHUNKS.replace("{n}", "7"),
)
def q09(spark, sf_dir):
    items = expand_windows(spans(v.e(spark, sf_dir)), 7)
    return items.select(*WINDOW_COLS)


@query(
    "q09_backfill_items",
    v.VIEWS
    + """, b AS (SELECT app_id, device_id,
    (max(event_time)::DATE - 89) AS first, max(event_time)::DATE AS last
  FROM e GROUP BY app_id, device_id) SELECT device_id, x.* FROM b b2, LATERAL (
  WITH b AS (SELECT b2.app_id, b2.first, b2.last) """
    + CHUNKS.replace("{n}", "31")
    + ") x",
)
def q09_backfill(spark, sf_dir):
    """Each device's default backfill: the 90 days up to its last day."""
    last = F.max(F.col("event_time").cast("date"))
    per_device = v.e(spark, sf_dir).groupBy("app_id", "device_id").agg(last.alias("end_date"))
    span = per_device.withColumn("start_date", F.date_sub("end_date", 89))
    return expand_windows(span).select("device_id", *WINDOW_COLS)


SURVIVORS = """SELECT {out} FROM t0 x WHERE NOT EXISTS (SELECT 1 FROM items i
    WHERE i.app_id = x.app_id AND i.attribution_type = x.attribution_type
      AND x.event_time >= i.start_date AND x.event_time < i.start_date + 7)
UNION ALL
SELECT {out} FROM {inc} x WHERE NOT EXISTS (SELECT 1 FROM items i
    WHERE i.seq > x.seq AND i.app_id = x.app_id AND i.attribution_type = x.attribution_type
      AND x.event_time >= i.start_date AND x.event_time < i.start_date + 7)"""


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_windows(v.delivered(spark, sf_dir), v.middle_weeks(spark))


@query("q21_replace_windows", v.VIEWS + SURVIVORS.format(out=OUT, inc="inc"))
def q21(spark, sf_dir):
    """Two weeks are replaced; some reports hold rows of a neighbouring week."""
    after = replace_windows(
        v.t0(spark, sf_dir), incoming(spark, sf_dir), v.middle_weeks(spark), v.weekly()
    )
    return after.select("row_ord", *v.COLUMNS)


@query("q21_replace_windows_unbounded", v.VIEWS + SURVIVORS.format(out=OUT, inc="inc"))
def q21_unbounded(spark, sf_dir):
    """The same by the salted join, for windows too many to broadcast."""
    items = replace(v.middle_weeks(spark), count=None, days=None)
    rows = tag_windows(v.delivered(spark, sf_dir), items)
    after = replace_windows(v.t0(spark, sf_dir), rows, items, v.weekly())
    return after.select("row_ord", *v.COLUMNS)


def table_of(spark: SparkSession, rows: DataFrame, label: str) -> tuple[str, str]:
    """A catalog table holding ``rows``, and its location in the shared folder."""
    location = scratch_path(spark, label)
    name = f"windrow_{location.rsplit('-', 1)[-1]}"
    create_table(spark, name, location)
    append_rows(spark, name, rows, 1)
    return name, location


def stored(spark: SparkSession, name: str) -> DataFrame:
    """What the table holds, as its catalog entry is dropped."""
    rows = stage(spark.table(name).select("row_ord", *v.COLUMNS), "stored")
    spark.sql(f"DROP TABLE {name}")
    return rows


@query("q21_replace_in_table", v.VIEWS + SURVIVORS.format(out=OUT, inc="inc"))
def q21_table(spark, sf_dir):
    """The same through the partitioned table: only the partitions concerned are written."""
    name, _ = table_of(spark, v.t0(spark, sf_dir), "q21")
    rows = stage(incoming(spark, sf_dir), "q21-incoming")
    replace_in_table(spark, name, rows, v.middle_weeks(spark), 2, v.weekly())
    return stored(spark, name)


@query(
    "q22_empty_reports_wipe",
    v.VIEWS
    + ", inc0 AS (SELECT * FROM inc WHERE attribution_type = 'retargeting') "
    + SURVIVORS.format(out=OUT, inc="inc0"),
)
def q22(spark, sf_dir):
    """Non-organic reports came back empty but valid, so their windows are emptied."""
    rows = incoming(spark, sf_dir).filter("attribution_type = 'retargeting'")
    after = replace_windows(v.t0(spark, sf_dir), rows, v.middle_weeks(spark), v.weekly())
    return after.select("row_ord", *v.COLUMNS)


@query(
    "q23_replace_metrics",
    v.VIEWS
    + f""", inc1 AS (
  SELECT * FROM inc WHERE seq <> 7
), owned AS (
  SELECT i.seq FROM items i JOIN t0 x
    ON i.app_id = x.app_id AND i.attribution_type = x.attribution_type
   AND x.event_time >= i.start_date AND x.event_time < i.start_date + 7
  UNION ALL
  SELECT min(i.seq) FROM items i JOIN inc1 x
    ON i.seq > x.seq AND i.app_id = x.app_id AND i.attribution_type = x.attribution_type
   AND x.event_time >= i.start_date AND x.event_time < i.start_date + 7
  GROUP BY x.row_ord
)
SELECT {WINDOW}, deleted, inserted, out_of_window, deleted > 0 AND inserted = 0 AS wiped FROM (
  SELECT *, (SELECT count(*) FROM owned o WHERE o.seq = i.seq) AS deleted,
    (SELECT count(*) FROM inc1 x WHERE x.seq = i.seq) AS inserted,
    (SELECT count(*) FROM inc1 x WHERE x.seq = i.seq AND NOT (
      x.event_time >= i.start_date AND x.event_time < i.start_date + 7)) AS out_of_window
  FROM items i)""",
)
def q23(spark, sf_dir):
    rows = incoming(spark, sf_dir).filter("seq <> 7")
    counts = replace_metrics(v.t0(spark, sf_dir), rows, v.middle_weeks(spark), v.weekly())
    return counts.drop("seq")


LOOKBACK = 5
TODAY = dt.date(2024, 1, 31)


@query(
    "q44_lookback_rewrite",
    v.VIEWS
    + f"""SELECT {OUT} FROM t0 WHERE event_time < DATE '2024-01-26'
UNION ALL SELECT {OUT} FROM e WHERE event_time >= DATE '2024-01-26'""",
)
def q44(spark, sf_dir):
    """Late events: the last days are fetched again whole and replace what was there."""
    start, end = daily_window(TODAY, lookback_days=LOOKBACK)
    items = work_items(spark, v.APPS, start, end)
    day = F.col("event_time").cast("date")
    fetched = (
        v.e(spark, sf_dir)
        .filter(day.between(F.lit(start), F.lit(end)))
        .withColumns({"start_date": F.lit(start), "end_date": F.lit(end)})
    )
    after = replace_windows(v.t0(spark, sf_dir), tag_windows(fetched, items), items)
    return after.select("row_ord", *v.COLUMNS)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    return (
        v.table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    )


USERS = """WITH u AS (SELECT user_id, min(ts)::DATE AS first_day, max(ts)::DATE AS last_day
  FROM events GROUP BY user_id) """


@query(
    "q43_window_precedence",
    USERS
    + """SELECT user_id,
  CASE WHEN user_id % 4 = 0 THEN first_day WHEN user_id % 4 IN (1, 2) THEN first_day
    ELSE last_day + 1 - CAST(user_id % 30 + 1 AS INTEGER) END AS start_date,
  CASE WHEN user_id % 4 = 0 THEN first_day ELSE last_day END AS end_date
FROM u""",
)
def q43(spark, sf_dir):
    """Explicit date, then from/to with an open end, then the lookback."""
    uid = F.col("user_id")
    u = users(spark, sf_dir).withColumn("today", F.date_add("last_day", 1))
    start, end = daily_window_columns(
        F.col("today"),
        F.when(uid % 4 == 0, F.col("first_day")),
        F.when(uid % 2 == 0, F.col("first_day")).when(uid % 4 == 1, F.col("first_day")),
        F.when(uid % 4 == 1, F.col("last_day")),
        uid % 30 + 1,
    )
    return u.select("user_id", start.alias("start_date"), end.alias("end_date"))


@query(
    "q45_before_retention_floor",
    USERS
    + """SELECT user_id, start_date, start_date < last_day + 1 - 90 AS before_floor FROM (
  SELECT *, last_day - CAST(user_id % 120 AS INTEGER) AS start_date FROM u)""",
)
def q45(spark, sf_dir):
    u = users(spark, sf_dir)
    start = F.date_sub("last_day", (F.col("user_id") % 120).cast("int"))
    items = u.withColumn("start_date", start)
    flagged = flag_before_floor(items, F.date_add("last_day", 1), EVENTS.retention_days)
    return flagged.select("user_id", "start_date", "before_floor")


@query(
    "q47_clamp_to_retention",
    USERS
    + """SELECT user_id, CAST(greatest(start_date, today - 60) AS DATE) AS start_date, end_date
FROM (SELECT user_id, last_day + 1 AS today, last_day - CAST(user_id % 120 AS INTEGER) AS start_date,
    last_day - CAST(user_id % 80 AS INTEGER) AS end_date FROM u)
WHERE start_date <= end_date AND end_date >= today - 60""",
)
def q47(spark, sf_dir):
    uid = F.col("user_id")
    asked = users(spark, sf_dir).select(
        "user_id",
        F.date_add("last_day", 1).alias("today"),
        F.date_sub("last_day", (uid % 120).cast("int")).alias("start_date"),
        F.date_sub("last_day", (uid % 80).cast("int")).alias("end_date"),
    )
    return clamp_to_floor(asked, F.col("today"), 60).drop("today")


@query(
    "q48_halve_capped_windows",
    v.VIEWS
    + """, f AS (SELECT app_id, attribution_type, start_date, end_date FROM r
  GROUP BY ALL HAVING count(*) >= 500)
SELECT app_id, attribution_type, start_date, CAST(start_date + 3 AS DATE) AS end_date,
  true AS splittable FROM f
UNION ALL SELECT app_id, attribution_type, CAST(start_date + 4 AS DATE), end_date, true FROM f""",
)
def q48(spark, sf_dir):
    capped = fetched_rows(v.r(spark, sf_dir), 500).filter("truncated")
    return halve_windows(capped)


APPEND = """, x AS (
  SELECT * REPLACE (
    CASE WHEN row_ord % 31 = 0 THEN NULL ELSE campaign_id END AS campaign_id,
    CASE WHEN row_ord % 41 = 0 THEN NULL ELSE adset_id END AS adset_id,
    CASE WHEN row_ord % 37 = 0 THEN NULL ELSE ad_id END AS ad_id)
  FROM e2 WHERE row_ord % 10 >= 4
), tk AS (
  SELECT DISTINCT app_id, attribution_type, event_time, event_name, device_id FROM t0
), y AS (
  SELECT x.*, tk.app_id IS NOT NULL AS known, row_number() OVER (
    PARTITION BY x.app_id, x.attribution_type, x.event_time, x.event_name, x.device_id
    ORDER BY x.row_ord) AS rn
  FROM x LEFT JOIN tk ON x.app_id = tk.app_id AND x.attribution_type = tk.attribution_type
    AND x.event_time = tk.event_time AND x.event_name = tk.event_name
    AND x.device_id = tk.device_id
)
"""


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_append_rows(v.a(spark, sf_dir))


@query(
    "q25_append_plan",
    v.VIEWS
    + APPEND
    + """SELECT app_id, attribution_type, count(*) AS total,
  count(*) FILTER (known) AS already_in_table,
  count(*) FILTER (NOT known AND rn > 1) AS intra_csv_dup,
  count(*) FILTER (NOT known AND rn = 1) AS to_insert
FROM y GROUP BY app_id, attribution_type""",
)
def q25(spark, sf_dir):
    return append_plan(file_rows(spark, sf_dir), v.t0(spark, sf_dir))


@query("q26_rows_to_append", v.VIEWS + APPEND + f"SELECT {OUT} FROM y WHERE NOT known AND rn = 1")
def q26(spark, sf_dir):
    rows = rows_to_append(file_rows(spark, sf_dir), v.t0(spark, sf_dir))
    return at_table_scale(rows).select("row_ord", *v.COLUMNS)


@query(
    "q26_append_to_table",
    v.VIEWS
    + APPEND
    + f"SELECT {OUT} FROM y WHERE NOT known AND rn = 1 UNION ALL SELECT {OUT} FROM t0",
)
def q26_table(spark, sf_dir):
    """The table after the append, with the lookup pruned to the file's days."""
    name, _ = table_of(spark, v.t0(spark, sf_dir), "q26")
    typed = file_rows(spark, sf_dir)
    unseen = rows_to_append(typed, within_span(spark.table(name), typed, "event_date"))
    append_rows(spark, name, stage(at_table_scale(unseen), "q26-unseen"), 2)
    return stored(spark, name)


@query(
    "q27_bounded_key_lookup",
    v.VIEWS
    + """SELECT DISTINCT app_id, attribution_type, event_time, event_name, device_id
FROM t0 x JOIN (SELECT app_id, attribution_type, min(event_time) AS lo, max(event_time) AS hi
  FROM e2 GROUP BY ALL) b USING (app_id, attribution_type)
WHERE event_time BETWEEN lo AND hi""",
)
def q27(spark, sf_dir):
    rows = type_append_rows(v.all_of_a(spark, sf_dir))
    return lookup_keys(v.t0(spark, sf_dir), group_bounds(rows))
