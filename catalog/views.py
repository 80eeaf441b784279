"""The test tables shaped as event reports, in Spark and in SQL.

``e``     typed events, one row per row of ``events``; ``row_ord`` is its id
``e2``    ``e`` and a second delivery of every eleventh row
``r``     ``e`` as raw report text with injected dirt, under raw headers
``a``     ``e2`` as text of a table-shaped file with injected dirt
``t0``    the part of ``e`` taken to be in the table already
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.work_items import WorkItems, work_items
from windrow.spec import EVENT_COLUMNS, EVENTS, ReportSpec, TABLE_COLUMNS

FIRST_DAY = dt.date(2024, 1, 1)
APPS = ("app0", "app1")
REDELIVERED = 1_000_000_000_000_000

COLUMNS = list(TABLE_COLUMNS)
TABLE_LIST = ", ".join(COLUMNS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def week_start(day: Column) -> Column:
    weeks = F.floor(F.date_diff(day, F.lit(FIRST_DAY)) / 7)
    return F.date_add(F.lit(FIRST_DAY), (weeks * 7).cast("int"))


def e(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    uid, eid = F.col("user_id"), F.col("event_id")
    day = F.col("ts").cast("date")
    age = (eid % 5).cast("int")
    has_install = eid % 7 != 0
    has_ad = uid % 6 != 0
    return df.select(
        day.cast("timestamp_ntz").alias("event_time"),
        F.when(has_install, F.date_sub(day, age).cast("timestamp_ntz")).alias("install_time"),
        F.when(has_install, F.date_sub(day, age + 1).cast("timestamp_ntz")).alias(
            "attributed_touch_time"
        ),
        F.col("event_type").alias("event_name"),
        F.col("value").cast("decimal(18,4)").alias("event_revenue"),
        F.when(uid % 4 == 0, F.lit(None))
        .when(uid % 4 == 1, F.lit("Email"))
        .otherwise(F.lit("Social"))
        .alias("media_source"),
        F.concat(F.lit("channel"), _text(uid % 3)).alias("channel"),
        F.concat(F.lit("campaign "), _text(uid % 5)).alias("campaign"),
        _text(uid % 5 + 120000000000000000).alias("campaign_id"),
        F.concat(F.lit("adset "), _text(uid % 11)).alias("adset"),
        _text(uid % 11 + 230000000000000000).alias("adset_id"),
        F.when(has_ad, F.concat(F.lit("ad "), _text(uid % 13))).alias("ad"),
        F.when(has_ad, _text(uid % 13 + 340000000000000000)).alias("ad_id"),
        _text(uid).alias("device_id"),
        F.when(uid % 10 != 0, F.concat(F.lit("customer"), _text(uid))).alias("customer_user_id"),
        F.when(eid % 3 == 0, F.lit("retargeting"))
        .otherwise(F.lit("non_organic"))
        .alias("attribution_type"),
        F.concat(F.lit("app"), _text(uid % 2)).alias("app_id"),
        eid.alias("row_ord"),
    )


def with_window(df: DataFrame) -> DataFrame:
    """Tag rows with the weekly window of their day."""
    start = week_start(F.col("event_time").cast("date"))
    return df.withColumn("start_date", start).withColumn(
        "end_date", F.date_add("start_date", 6)
    )


def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explode keeps it to one scan; the second copy differs in ``row_ord`` only."""
    df = e(spark, sf_dir)
    copies = F.when(F.col("row_ord") % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    both = df.withColumn("copy", F.explode(copies))
    return both.withColumn(
        "row_ord", F.col("row_ord") + F.col("copy") * F.lit(REDELIVERED)
    ).drop("copy")


def t0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e(spark, sf_dir).filter(F.col("row_ord") % 10 < 6)


def r(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirt sits in chosen weeks only, so that some windows fail and some do not."""
    df = with_window(e(spark, sf_dir))
    n = F.col("row_ord")
    week = F.floor(F.date_diff("start_date", F.lit(FIRST_DAY)) / 7)
    time, money = _text(F.col("event_time")), _text(F.col("event_revenue"))
    dirty_time = (
        F.when((week == 1) & (n % 211 == 0), F.lit("not a time"))
        .when(n % 13 == 0, F.replace(time, F.lit(" 00:00:00"), F.lit("  0:0:0")))
        .otherwise(time)
    )
    dirty_money = (
        F.when((week == 2) & F.col("media_source").isNull() & (n % 5 == 0), F.lit("n/a"))
        .when((week == 3) & (F.col("app_id") == "app0") & (n % 101 == 0), F.lit("n/a"))
        .when(n % 17 == 0, F.concat(F.lit(" "), money, F.lit("\t")))
        .when(n % 19 == 0, F.concat(money, F.lit("e0")))
        .when(n % 23 == 0, F.lit(" "))
        .otherwise(money)
    )
    dirty_device = F.when(
        (week == 3) & (F.col("app_id") == "app1") & (n % 103 == 0), F.lit("")
    ).otherwise(F.col("device_id"))
    text = {c: F.col(c) for c in EVENT_COLUMNS.values()}
    text |= {
        "event_time": dirty_time,
        "install_time": F.coalesce(_text(F.col("install_time")), F.lit("")),
        "attributed_touch_time": _text(F.col("attributed_touch_time")),
        "event_revenue": dirty_money,
        "device_id": dirty_device,
    }
    return df.select(
        *[text[to].alias(raw) for raw, to in EVENT_COLUMNS.items()],
        F.lit("false").alias("Is Primary Attribution"),
        F.concat(F.lit("region "), _text(n % 4)).alias("Region"),
        "app_id",
        "attribution_type",
        "start_date",
        "end_date",
        "row_ord",
    )


def a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_of_a(spark, sf_dir).filter(F.col("row_ord") % 10 >= 4)


def all_of_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``a`` before the rows taken to be in the table alone are left out."""
    df = e2(spark, sf_dir)
    n = F.col("row_ord")
    text = {c: _text(F.col(c)) for c in COLUMNS}
    text |= {
        "event_name": F.concat(F.lit(" "), F.col("event_name"), F.lit("\t")),
        "event_revenue": F.concat(F.lit(" "), text["event_revenue"]),
        "media_source": F.coalesce(text["media_source"], F.lit("  ")),
        "campaign_id": F.when(n % 31 == 0, F.lit("1.20E+17")).otherwise(text["campaign_id"]),
        "adset_id": F.when(n % 41 == 0, F.lit(" 2e+17 ")).otherwise(text["adset_id"]),
        "ad_id": F.when(n % 37 == 0, F.lit("3.4E+17")).otherwise(text["ad_id"]),
    }
    return df.select(*[text[c].alias(c) for c in COLUMNS], "row_ord")


def middle_weeks(spark: SparkSession) -> WorkItems:
    """A run over the second and third week, as weekly windows."""
    spec = weekly()
    return work_items(spark, APPS, dt.date(2024, 1, 8), dt.date(2024, 1, 21), spec)


def weekly() -> ReportSpec:
    return replace(EVENTS, max_chunk_days=7)


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming rows, some in the report of the week before or after their own."""
    df = with_window(e(spark, sf_dir).filter(F.col("row_ord") % 10 >= 4))
    n = F.col("row_ord")
    shift = F.when(n % 50 == 7, 7).when(n % 50 == 9, -7).otherwise(0)
    return df.withColumn("start_date", F.date_add("start_date", shift)).withColumn(
        "end_date", F.date_add("start_date", 6)
    )


# --- the same views in SQL -------------------------------------------------------

_RAW_SELECT = ",\n".join(
    f'    {sql} AS "{raw}"'
    for raw, sql in {
        **{raw: to for raw, to in EVENT_COLUMNS.items()},
        "Event Time": """CASE WHEN week = 1 AND row_ord % 211 = 0 THEN 'not a time'
      WHEN row_ord % 13 = 0 THEN replace(CAST(event_time AS VARCHAR), ' 00:00:00', '  0:0:0')
      ELSE CAST(event_time AS VARCHAR) END""",
        "Install Time": "coalesce(CAST(install_time AS VARCHAR), '')",
        "Attributed Touch Time": "CAST(attributed_touch_time AS VARCHAR)",
        "Event Revenue": """CASE
      WHEN week = 2 AND media_source IS NULL AND row_ord % 5 = 0 THEN 'n/a'
      WHEN week = 3 AND app_id = 'app0' AND row_ord % 101 = 0 THEN 'n/a'
      WHEN row_ord % 17 = 0 THEN ' ' || CAST(event_revenue AS VARCHAR) || chr(9)
      WHEN row_ord % 19 = 0 THEN CAST(event_revenue AS VARCHAR) || 'e0'
      WHEN row_ord % 23 = 0 THEN ' '
      ELSE CAST(event_revenue AS VARCHAR) END""",
        "Device ID": """CASE WHEN week = 3 AND app_id = 'app1' AND row_ord % 103 = 0 THEN ''
      ELSE device_id END""",
    }.items()
)

VIEWS = f"""WITH e AS (
  SELECT
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_time,
    CASE WHEN event_id % 7 <> 0
      THEN CAST(CAST(ts AS DATE) - CAST(event_id % 5 AS INTEGER) AS TIMESTAMP) END AS install_time,
    CASE WHEN event_id % 7 <> 0
      THEN CAST(CAST(ts AS DATE) - CAST(event_id % 5 + 1 AS INTEGER) AS TIMESTAMP) END
      AS attributed_touch_time,
    event_type AS event_name,
    CAST(value AS DECIMAL(18,4)) AS event_revenue,
    CASE WHEN user_id % 4 = 0 THEN NULL WHEN user_id % 4 = 1 THEN 'Email' ELSE 'Social' END
      AS media_source,
    'channel' || CAST(user_id % 3 AS VARCHAR) AS channel,
    'campaign ' || CAST(user_id % 5 AS VARCHAR) AS campaign,
    CAST(user_id % 5 + 120000000000000000 AS VARCHAR) AS campaign_id,
    'adset ' || CAST(user_id % 11 AS VARCHAR) AS adset,
    CAST(user_id % 11 + 230000000000000000 AS VARCHAR) AS adset_id,
    CASE WHEN user_id % 6 <> 0 THEN 'ad ' || CAST(user_id % 13 AS VARCHAR) END AS ad,
    CASE WHEN user_id % 6 <> 0 THEN CAST(user_id % 13 + 340000000000000000 AS VARCHAR) END
      AS ad_id,
    CAST(user_id AS VARCHAR) AS device_id,
    CASE WHEN user_id % 10 <> 0 THEN 'customer' || CAST(user_id AS VARCHAR) END
      AS customer_user_id,
    CASE WHEN event_id % 3 = 0 THEN 'retargeting' ELSE 'non_organic' END AS attribution_type,
    'app' || CAST(user_id % 2 AS VARCHAR) AS app_id,
    event_id AS row_ord
  FROM events
), w AS (
  SELECT *,
    CAST((CAST(event_time AS DATE) - DATE '2024-01-01') // 7 AS INTEGER) AS week,
    CAST(DATE '2024-01-01' + 7 * CAST((CAST(event_time AS DATE) - DATE '2024-01-01') // 7
      AS INTEGER) AS DATE) AS start_date,
    CAST(DATE '2024-01-07' + 7 * CAST((CAST(event_time AS DATE) - DATE '2024-01-01') // 7
      AS INTEGER) AS DATE) AS end_date
  FROM e
), e2 AS (
  SELECT * FROM e
  UNION ALL
  SELECT * REPLACE (row_ord + {REDELIVERED} AS row_ord) FROM e WHERE row_ord % 11 = 0
), t0 AS (
  SELECT * FROM e WHERE row_ord % 10 < 6
), r AS (
  SELECT
{_RAW_SELECT},
    'false' AS "Is Primary Attribution",
    'region ' || CAST(row_ord % 4 AS VARCHAR) AS "Region",
    app_id, attribution_type, start_date, end_date, row_ord
  FROM w
), p AS (
  SELECT app_id, attribution_type, start_date, end_date, row_ord,
    "Media Source" AS media_source, "Event Name" AS event_name,
    "Device ID" AS device_id, "Event Time" AS raw_time, "Event Revenue" AS raw_money,
    CAST(try_strptime(regexp_replace("Event Time", ' +', ' ', 'g'), '%Y-%m-%d %H:%M:%S')
      AS TIMESTAMP) AS event_time,
    CAST(nullif("Install Time", '') AS TIMESTAMP) AS install_time,
    TRY_CAST(trim("Event Revenue", ' ' || chr(9)) AS DECIMAL(38,18)) AS event_revenue
  FROM r
), v AS (
  SELECT *, CASE
    WHEN event_time IS NULL AND trim(raw_time) <> ''
      THEN 'event_time is not a timestamp: ''' || raw_time || ''''
    WHEN event_revenue IS NULL AND trim(raw_money, ' ' || chr(9)) <> ''
      THEN 'event_revenue is not a storable number: ''' || raw_money || ''''
    WHEN event_time IS NULL THEN 'event_time is missing'
    WHEN coalesce(event_name, '') = '' THEN 'event_name is missing'
    WHEN coalesce(device_id, '') = '' THEN 'device_id is missing' END AS error
  FROM p
), items AS (
  SELECT app_id, attribution_type, start_date,
    CAST(start_date + 6 AS DATE) AS end_date,
    (CASE app_id WHEN 'app0' THEN 0 ELSE 4 END)
      + (CASE attribution_type WHEN 'non_organic' THEN 0 ELSE 2 END)
      + (CASE start_date WHEN DATE '2024-01-08' THEN 0 ELSE 1 END) AS seq
  FROM (SELECT unnest(['app0', 'app1']) AS app_id)
    CROSS JOIN (SELECT unnest(['non_organic', 'retargeting']) AS attribution_type)
    CROSS JOIN (SELECT unnest([DATE '2024-01-08', DATE '2024-01-15']) AS start_date)
), d AS (
  SELECT * EXCLUDE (week, start_date, end_date),
    CAST(start_date + CASE WHEN row_ord % 50 = 7 THEN 7 WHEN row_ord % 50 = 9 THEN -7 ELSE 0 END
      AS DATE) AS report_start
  FROM w WHERE row_ord % 10 >= 4
), inc AS (
  SELECT d.*, i.seq FROM d JOIN items i
    ON i.app_id = d.app_id AND i.attribution_type = d.attribution_type
   AND i.start_date = d.report_start
)
"""
