"""Queries on raw reports: scanning, filtering, parsing, validating windows."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from windrow.functions.text import clean, is_damaged_id, normalise_headers, split_list
from windrow.functions.typed import failed, parse_decimal, parse_timestamp
from windrow.operators.filters import filter_report
from windrow.operators.validate import (
    at_table_scale,
    drop_invalid,
    fetched_rows,
    first_errors,
    parse_stats,
    quarantine,
    run_summary,
    type_append_rows,
    type_report,
    window_results,
)
from windrow.operators.dedup import keep_latest
from windrow.operators.work_items import WorkItems, work_items
from windrow.plans.load_run import plan_load
from windrow.runtime import scratch_path, stage
from windrow.sources.landing import scan_landing
from windrow.spec import EVENT_COLUMNS, EVENTS, INSTALLS, WINDOW_COLS

WINDOW = ", ".join(WINDOW_COLS)
SOURCE = "Social"
NAMES = ["purchase", "view"]
KEPT = "media_source = 'Social' AND event_name IN ('purchase', 'view')"
ROW_CAP = 500
RAW_NAMES = ", ".join(f'"{raw}" AS {to}' for raw, to in EVENT_COLUMNS.items())
FIVE_WEEKS = 5 * 2 * 2


def land(df: DataFrame, label: str, root: str | None = None) -> str:
    """Write raw rows as a landing zone of CSV reports, text unchanged."""
    root = root or scratch_path(df.sparkSession, label)
    (
        df.hint("rebalance", *WINDOW_COLS)
        .write.mode("append")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy(*WINDOW_COLS)
        .csv(root)
    )
    return root


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_report(v.r(spark, sf_dir), SOURCE, NAMES)


def month(spark: SparkSession) -> WorkItems:
    """Five weekly windows per app and type."""
    return work_items(spark, v.APPS, v.FIRST_DAY, dt.date(2024, 2, 4), v.weekly())


@query(
    "q01_landing_round_trip",
    v.VIEWS
    + f"""SELECT {WINDOW}, event_name, device_id, media_source, event_time, install_time,
  CAST(event_revenue AS DECIMAL(18,4)) AS event_revenue, error FROM v""",
)
def q01(spark, sf_dir):
    root = land(v.r(spark, sf_dir).drop("row_ord"), "q01")
    typed = type_report(scan_landing(spark, root).raw)
    return at_table_scale(typed).select(
        *WINDOW_COLS,
        "event_name",
        F.coalesce("device_id", F.lit("")).alias("device_id"),
        "media_source",
        "event_time",
        "install_time",
        "event_revenue",
        "error",
    )


@query(
    "q02_text_scan_mixed_headers",
    v.VIEWS
    + f"""SELECT {WINDOW}, "Event Time" AS event_time, "Event Revenue" AS event_revenue,
  "Campaign ID" AS campaign_id, "Ad ID" AS ad_id FROM r""",
)
def q02(spark, sf_dir):
    """Retargeting reports list their columns in reverse order; all stay text."""
    raw = v.r(spark, sf_dir).drop("row_ord")
    headers = [c for c in raw.columns if c not in WINDOW_COLS]
    root = land(raw.filter("attribution_type = 'non_organic'"), "q02")
    reverse = raw.filter("attribution_type = 'retargeting'").select(
        *reversed(headers), *WINDOW_COLS
    )
    land(reverse, "q02", root)
    return scan_landing(spark, root).raw.select(
        *WINDOW_COLS,
        F.col("Event Time").alias("event_time"),
        F.col("Event Revenue").alias("event_revenue"),
        F.col("Campaign ID").alias("campaign_id"),
        F.col("Ad ID").alias("ad_id"),
    )


@query(
    "q03_row_cap",
    v.VIEWS
    + f"""SELECT {WINDOW}, count(*) AS fetched_rows, count(*) >= {ROW_CAP} AS truncated
FROM r GROUP BY {WINDOW}""",
)
def q03(spark, sf_dir):
    return fetched_rows(v.r(spark, sf_dir), ROW_CAP)


@query(
    "q04_source_and_event_filter",
    v.VIEWS + f"SELECT row_ord, {RAW_NAMES} FROM r WHERE \"Media Source\" = 'Social' "
    "AND \"Event Name\" IN ('purchase', 'view')",
)
def q04(spark, sf_dir):
    rows = filtered(spark, sf_dir)
    return rows.select("row_ord", *[F.col(raw).alias(to) for raw, to in EVENT_COLUMNS.items()])


@query(
    "q05_clean_text",
    r"""SELECT event_id, nullif(trim(CASE event_id % 4
    WHEN 0 THEN '  ' || event_type || chr(9) || ' '
    WHEN 1 THEN chr(10) || props || chr(160)
    WHEN 2 THEN ' ' || chr(8195) ELSE event_type END,
    ' ' || chr(9) || chr(10) || chr(160) || chr(8195)), '') AS cleaned FROM events""",
)
def q05(spark, sf_dir):
    kind, n = F.col("event_type"), F.col("event_id") % 4
    messy = (
        F.when(n == 0, F.concat(F.lit("  "), kind, F.lit("\t ")))
        .when(n == 1, F.concat(F.lit("\n"), F.col("props"), F.lit("\xa0")))
        .when(n == 2, F.lit("  "))
        .otherwise(kind)
    )
    return v.table(spark, sf_dir, "events").select("event_id", clean(messy).alias("cleaned"))


@query(
    "q06_damaged_ids",
    v.VIEWS
    + """SELECT count(*) AS total_rows,
  CAST(sum((row_ord % 31 = 0)::INT + (row_ord % 41 = 0)::INT + (row_ord % 37 = 0)::INT) AS BIGINT)
    AS ids_nulled
FROM e2""",
)
def q06(spark, sf_dir):
    return parse_stats(type_append_rows(v.all_of_a(spark, sf_dir)))


@query(
    "q06_damaged_id_cells",
    r"""SELECT l_orderkey, l_linenumber, l_partkey, id,
  regexp_matches(id, '^[0-9]+(\.[0-9]+)?[eE]\+[0-9]+$') AS damaged
FROM (SELECT *, CASE l_partkey % 5
    WHEN 0 THEN CAST(l_partkey AS VARCHAR) || 'E+17'
    WHEN 1 THEN CAST(l_partkey AS VARCHAR) || '.25e+9'
    WHEN 2 THEN CAST(l_partkey AS VARCHAR) || 'E17'
    WHEN 3 THEN '-' || CAST(l_partkey AS VARCHAR) || 'E+17'
    ELSE CAST(l_partkey AS VARCHAR) END AS id FROM lineitem)""",
)
def q06_cells(spark, sf_dir):
    part, n = F.col("l_partkey").cast("string"), F.col("l_partkey") % 5
    made = (
        F.when(n == 0, F.concat(part, F.lit("E+17")))
        .when(n == 1, F.concat(part, F.lit(".25e+9")))
        .when(n == 2, F.concat(part, F.lit("E17")))
        .when(n == 3, F.concat(F.lit("-"), part, F.lit("E+17")))
        .otherwise(part)
    )
    rows = v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", made.alias("id")
    )
    return rows.withColumn("damaged", is_damaged_id(F.col("id")))


GOOD = f"""good AS (
  SELECT * FROM v WHERE {KEPT} AND NOT EXISTS (
    SELECT 1 FROM v b WHERE b.error IS NOT NULL AND b.{KEPT.replace(' AND ', ' AND b.')}
      AND b.app_id = v.app_id AND b.attribution_type = v.attribution_type
      AND b.start_date = v.start_date)
)"""


@query(
    "q07_quarantine",
    v.VIEWS + f""", {GOOD} SELECT {WINDOW}, row_ord, event_time, install_time, event_name,
  CAST(event_revenue AS DECIMAL(18,4)) AS event_revenue, device_id FROM good""",
)
def q07(spark, sf_dir):
    """The filter comes first: rows it drops are never validated."""
    typed = stage(type_report(filtered(spark, sf_dir)), "typed")
    good = at_table_scale(quarantine(typed, first_errors(typed), FIVE_WEEKS))
    return good.select(
        *WINDOW_COLS,
        "row_ord",
        "event_time",
        "install_time",
        "event_name",
        "event_revenue",
        "device_id",
    )


@query(
    "q08_first_error",
    v.VIEWS
    + f"""SELECT {WINDOW}, arg_min(error, row_ord) AS error, count(*) AS bad_rows
FROM v WHERE error IS NOT NULL GROUP BY {WINDOW}""",
)
def q08(spark, sf_dir):
    return first_errors(type_report(v.r(spark, sf_dir)))


@query(
    "q10_union_of_report_types",
    v.VIEWS
    + f"""SELECT row_ord, {v.TABLE_LIST} FROM e WHERE attribution_type = 'non_organic'
UNION ALL SELECT row_ord, {v.TABLE_LIST} FROM e WHERE attribution_type = 'retargeting'""",
)
def q10(spark, sf_dir):
    """Two reports without a type column of their own, tagged and put together."""
    df = v.e(spark, sf_dir)
    parts = [
        df.filter(F.col("attribution_type") == kind)
        .drop("attribution_type")
        .withColumn("attribution_type", F.lit(kind))
        for kind in ("non_organic", "retargeting")
    ]
    return parts[0].unionByName(parts[1]).select("row_ord", *v.COLUMNS)


@query(
    "q11_strict_timestamps",
    r"""WITH x AS (SELECT event_id, CASE event_id % 15
    WHEN 0 THEN t WHEN 1 THEN replace(t, ' ', '   ') WHEN 2 THEN replace(t, ' ', 'T')
    WHEN 3 THEN t || '.5' WHEN 4 THEN ' ' || t WHEN 5 THEN t || ' '
    WHEN 6 THEN '2024-02-30 10:00:00' WHEN 7 THEN '2024-1-5 1:2:3' WHEN 8 THEN ''
    WHEN 9 THEN NULL WHEN 10 THEN t || chr(10) WHEN 11 THEN substr(t, 1, 16)
    WHEN 12 THEN '0000' || substr(t, 5) WHEN 13 THEN replace(t, ' ', chr(9))
    ELSE '2024-01-05 25:00:00' END AS raw
  FROM (SELECT event_id, substr(CAST(ts AS VARCHAR), 1, 19) AS t FROM events)),
y AS (SELECT *, CASE WHEN regexp_full_match(raw,
      '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}')
      AND raw NOT LIKE '0000%'
    THEN CAST(try_strptime(regexp_replace(raw, '\s+', ' ', 'g'), '%Y-%m-%d %H:%M:%S')
      AS TIMESTAMP) END AS parsed FROM x)
SELECT event_id, parsed, coalesce(trim(raw), '') <> '' AND parsed IS NULL AS bad FROM y""",
)
def q11(spark, sf_dir):
    n, t = F.col("event_id") % 15, F.substring(F.col("ts").cast("string"), 1, 19)
    shapes = [
        t,
        F.replace(t, F.lit(" "), F.lit("   ")),
        F.replace(t, F.lit(" "), F.lit("T")),
        F.concat(t, F.lit(".5")),
        F.concat(F.lit(" "), t),
        F.concat(t, F.lit(" ")),
        F.lit("2024-02-30 10:00:00"),
        F.lit("2024-1-5 1:2:3"),
        F.lit(""),
        F.lit(None).cast("string"),
        F.concat(t, F.lit("\n")),
        F.substring(t, 1, 16),
        F.concat(F.lit("0000"), F.substring(t, 5, 15)),
        F.replace(t, F.lit(" "), F.lit("\t")),
        F.lit("2024-01-05 25:00:00"),
    ]
    raw = F.get(F.array(*shapes), n.cast("int"))
    rows = v.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    parsed = parse_timestamp(F.col("raw"))
    return rows.select(
        "event_id", parsed.alias("parsed"), failed(F.col("raw"), parsed).alias("bad")
    )


@query(
    "q12_strict_decimals",
    r"""WITH x AS (SELECT event_id, CASE event_id % 12
    WHEN 0 THEN t WHEN 1 THEN ' ' || t || ' ' WHEN 2 THEN '+' || t WHEN 3 THEN '-' || t
    WHEN 4 THEN t || 'e2' WHEN 5 THEN 'NaN' WHEN 6 THEN 'Infinity' WHEN 7 THEN '1_0' || t
    WHEN 8 THEN t || 'x' WHEN 9 THEN '  ' WHEN 10 THEN NULL ELSE t || '5E-3' END AS raw
  FROM (SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS t FROM events)),
y AS (SELECT event_id, raw,
    CAST(CASE WHEN trim(raw) IN ('NaN', 'Infinity') THEN NULL
      ELSE TRY_CAST(replace(trim(raw), '_', '') AS DECIMAL(38,18)) END AS DECIMAL(38,18)) AS parsed
  FROM x)
SELECT event_id, CAST(parsed AS DECIMAL(28,8)) AS parsed,
  coalesce(trim(raw), '') <> '' AND parsed IS NULL AS bad FROM y""",
)
def q12(spark, sf_dir):
    n, t = F.col("event_id") % 12, F.col("value").cast("decimal(18,2)").cast("string")
    shapes = [
        t,
        F.concat(F.lit(" "), t, F.lit(" ")),
        F.concat(F.lit("+"), t),
        F.concat(F.lit("-"), t),
        F.concat(t, F.lit("e2")),
        F.lit("NaN"),
        F.lit("Infinity"),
        F.concat(F.lit("1_0"), t),
        F.concat(t, F.lit("x")),
        F.lit("  "),
        F.lit(None).cast("string"),
        F.concat(t, F.lit("5E-3")),
    ]
    raw = F.get(F.array(*shapes), n.cast("int"))
    rows = v.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    parsed = parse_decimal(F.col("raw"))
    return rows.select(
        "event_id",
        parsed.cast("decimal(28,8)").alias("parsed"),
        failed(F.col("raw"), parsed).alias("bad"),
    )


@query(
    "q13_list_split",
    """SELECT event_id, array_to_string(items, '|') AS joined, len(items) AS n FROM (
  SELECT event_id, list_filter(list_transform(string_split(
    ' ' || event_type || ' ,, ' || CAST(user_id AS VARCHAR) || ', ,' || props, ','),
    lambda x: trim(x)), lambda x: x <> '') AS items FROM events)""",
)
def q13(spark, sf_dir):
    text = F.concat(
        F.lit(" "),
        "event_type",
        F.lit(" ,, "),
        F.col("user_id").cast("string"),
        F.lit(", ,"),
        "props",
    )
    rows = v.table(spark, sf_dir, "events").select("event_id", split_list(text).alias("items"))
    return rows.select(
        "event_id",
        F.array_join("items", "|").alias("joined"),
        F.size("items").cast("long").alias("n"),
    )


RESULTS = f""", {GOOD}, results AS (
  SELECT r.app_id, r.attribution_type, r.start_date, r.end_date, f.error,
    CASE WHEN f.error IS NULL THEN count(*) ELSE 0 END AS fetched_rows,
    CASE WHEN f.error IS NULL THEN coalesce(max(l.n), 0) ELSE 0 END AS loaded_rows
  FROM r
  LEFT JOIN (SELECT app_id, attribution_type, start_date, arg_min(error, row_ord) AS error
      FROM v WHERE {KEPT} AND error IS NOT NULL GROUP BY ALL) f
    ON f.app_id = r.app_id AND f.attribution_type = r.attribution_type
   AND f.start_date = r.start_date
  LEFT JOIN (SELECT app_id, attribution_type, start_date,
        count(DISTINCT (event_time, event_name, device_id)) AS n FROM good GROUP BY ALL) l
    ON l.app_id = r.app_id AND l.attribution_type = r.attribution_type
   AND l.start_date = r.start_date
  GROUP BY r.app_id, r.attribution_type, r.start_date, r.end_date, f.error
)
"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = stage(type_report(filtered(spark, sf_dir)), "typed")  # parsed once
    errors = first_errors(typed)
    rows = keep_latest(quarantine(typed, errors, FIVE_WEEKS))
    loaded = rows.groupBy(*WINDOW_COLS).agg(F.count("*").alias("loaded_rows"))
    fetched = fetched_rows(v.r(spark, sf_dir))
    return window_results(month(spark), fetched, loaded, errors)


@query(
    "q24_window_results",
    v.VIEWS + RESULTS + f"SELECT {WINDOW}, fetched_rows, loaded_rows, error FROM results",
)
def q24(spark, sf_dir):
    return results(spark, sf_dir).drop("seq")


@query(
    "q24_results_from_landing",
    v.VIEWS
    + RESULTS
    + f"SELECT {WINDOW}, fetched_rows, loaded_rows, error IS NOT NULL AS failed FROM results",
)
def q24_landing(spark, sf_dir):
    """The dry run of a whole load: landing zone, scan, checks, dedup, results."""
    root = land(v.r(spark, sf_dir).drop("row_ord"), "q24")
    plan = plan_load(spark, root, month(spark), SOURCE, NAMES, v.weekly())
    return plan.results.select(
        *WINDOW_COLS, "fetched_rows", "loaded_rows", F.col("error").isNotNull().alias("failed")
    )


@query(
    "q24_run_summary",
    v.VIEWS + RESULTS + """SELECT count(*) AS windows,
  count(*) FILTER (error IS NULL) AS succeeded, count(*) FILTER (error IS NOT NULL) AS failed,
  CAST(sum(fetched_rows) AS BIGINT) AS total_fetched,
  CAST(sum(loaded_rows) AS BIGINT) AS total_loaded,
  count(*) FILTER (error IS NOT NULL) = 0 AS all_succeeded FROM results""",
)
def q24_summary(spark, sf_dir):
    return run_summary(results(spark, sf_dir))


@query(
    "q42_all_fields",
    v.VIEWS
    + """SELECT p.row_ord, p.event_time, p.install_time, p.event_name, p.device_id,
  CAST(p.event_revenue AS DECIMAL(18,4)) AS event_revenue, r."Campaign ID" AS campaign_id,
  r."Is Primary Attribution" AS is_primary_attribution, r."Region" AS region
FROM p JOIN r USING (row_ord)""",
)
def q42(spark, sf_dir):
    """Keep every column of the report under its normalised name."""
    typed = at_table_scale(type_report(v.r(spark, sf_dir), replace(EVENTS, columns=None)))
    return typed.select(
        "row_ord",
        "event_time",
        "install_time",
        "event_name",
        "device_id",
        "event_revenue",
        "campaign_id",
        "is_primary_attribution",
        "region",
    )


@query(
    "q42_header_names",
    """SELECT event_id AS "event_id", user_id AS "user_name_id", event_type AS "event_type"
FROM events""",
)
def q42_headers(spark, sf_dir):
    df = v.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return df.toDF(*normalise_headers(["Event ID", " User Name ID", "Event Type"]))


@query(
    "q50_drop_invalid_rows",
    v.VIEWS
    + f"""SELECT {WINDOW}, count(*) FILTER (error IS NULL) AS good_rows,
  count(*) FILTER (error IS NOT NULL) AS dropped_rows FROM v GROUP BY {WINDOW}""",
)
def q50(spark, sf_dir):
    good, dropped = drop_invalid(type_report(v.r(spark, sf_dir)))
    counts = good.groupBy(*WINDOW_COLS).agg(F.count("*").alias("good_rows"))
    both = counts.join(dropped, list(WINDOW_COLS), "full_outer")
    zero = F.lit(0)
    return both.select(
        *WINDOW_COLS,
        F.coalesce("good_rows", zero).alias("good_rows"),
        F.coalesce("dropped_rows", zero).alias("dropped_rows"),
    )


@query(
    "q52_source_filter_alone",
    v.VIEWS + f"""SELECT {WINDOW}, event_name, count(*) AS n FROM v
WHERE media_source = 'Email' GROUP BY ALL""",
)
def q52(spark, sf_dir):
    """A filter that is absent does not filter."""
    rows = filter_report(v.r(spark, sf_dir), media_source="Email")
    return rows.groupBy(*WINDOW_COLS, F.col("Event Name").alias("event_name")).agg(
        F.count("*").alias("n")
    )


@query(
    "q53_installs_report",
    v.VIEWS
    + f"""SELECT {WINDOW}, error, count(*) AS n FROM (
  SELECT * REPLACE (CASE
    WHEN error LIKE '% is not a %' THEN error
    WHEN install_time IS NULL THEN 'install_time is missing'
    WHEN coalesce(device_id, '') = '' THEN 'device_id is missing' END AS error) FROM v)
GROUP BY ALL""",
)
def q53(spark, sf_dir):
    """The second report family: every column kept, install time required."""
    typed = type_report(v.r(spark, sf_dir), INSTALLS)
    return typed.groupBy(*WINDOW_COLS, "error").agg(F.count("*").alias("n"))
