"""Queries on the table as a whole: baselines, duplicates, profiles, differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import query
from windrow.operators import audit
from windrow.operators.dedup import keep_latest
from windrow.spec import EVENT_COLUMNS

TYPED = "event_time, event_name, device_id, attribution_type"


@query(
    "q28_baseline",
    v.VIEWS
    + """SELECT count(*) AS total_rows, count(DISTINCT app_id) AS apps,
  min(event_time) AS first_event, max(event_time) AS last_event,
  CAST(sum(event_revenue) AS DECIMAL(28,4)) AS total_revenue FROM e""",
)
def q28(spark, sf_dir):
    return audit.baseline(v.e(spark, sf_dir))


@query(
    "q29_grouped_baseline",
    v.VIEWS
    + """SELECT app_id, attribution_type, count(*) AS rows,
  CAST(sum(event_revenue) AS DECIMAL(28,4)) AS revenue
FROM e GROUP BY app_id, attribution_type ORDER BY app_id, attribution_type""",
)
def q29(spark, sf_dir):
    return audit.grouped_baseline(v.e(spark, sf_dir))


@query(
    "q30_dedup_impact",
    v.VIEWS
    + """SELECT count(*) AS total,
  count(*) - count(DISTINCT (event_time, event_name, device_id)) AS dropped_3col,
  count(*) - count(DISTINCT (app_id, attribution_type, event_time, event_name, device_id))
    AS dropped_5col FROM e""",
)
def q30(spark, sf_dir):
    return audit.dedup_impact(v.e(spark, sf_dir))


@query(
    "q31_conflict_report",
    v.VIEWS
    + f"""SELECT {TYPED}, count(*) AS rows_in_key,
  count(DISTINCT install_time) AS distinct_install_times,
  count(DISTINCT event_revenue) AS distinct_revenues,
  CAST(sum(event_revenue) AS DECIMAL(38,4)) AS revenue_in_key
FROM e GROUP BY {TYPED} HAVING count(*) > 1 ORDER BY event_time DESC""",
)
def q31(spark, sf_dir):
    return audit.conflict_report(v.e(spark, sf_dir))


@query(
    "q32_exact_duplicate_audit",
    v.VIEWS
    + f"""SELECT count(*) AS dup_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows,
  CAST(coalesce(sum((n - 1) * event_revenue), 0) AS DECIMAL(38,4)) AS overcounted_revenue
FROM (SELECT {TYPED}, event_revenue, count(*) AS n FROM e2
  GROUP BY {TYPED}, event_revenue HAVING count(*) > 1)""",
)
def q32(spark, sf_dir):
    out = audit.exact_duplicate_audit(v.e2(spark, sf_dir))
    return out.withColumn(
        "overcounted_revenue", F.col("overcounted_revenue").cast("decimal(38,4)")
    )


@query(
    "q33_conflict_audit",
    v.VIEWS
    + f"""SELECT count(*) AS conflict_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS conflict_rows
FROM (SELECT count(*) AS n FROM e GROUP BY {TYPED}
  HAVING count(*) > 1 AND count(DISTINCT event_revenue) > 1)""",
)
def q33(spark, sf_dir):
    return audit.conflict_audit(v.e(spark, sf_dir))


@query(
    "q34_sample_duplicate_rows",
    v.VIEWS
    + f"""SELECT {TYPED}, event_revenue, app_id FROM e JOIN (
  SELECT {TYPED} FROM e GROUP BY {TYPED} HAVING count(*) > 1 ORDER BY {TYPED} LIMIT 10)
  USING ({TYPED}) ORDER BY event_time, device_id""",
)
def q34(spark, sf_dir):
    return audit.sample_duplicates(v.e(spark, sf_dir))


@query(
    "q35_twins",
    v.VIEWS
    + """SELECT event_time, event_name, device_id, count(DISTINCT attribution_type) AS n_types,
  count(*) AS n_rows FROM e GROUP BY event_time, event_name, device_id
HAVING count(DISTINCT attribution_type) > 1""",
)
def q35(spark, sf_dir):
    return audit.twins(v.e(spark, sf_dir))


@query(
    "q36_duplicate_groups",
    v.VIEWS + f"SELECT {TYPED}, count(*) AS n_rows FROM e GROUP BY {TYPED} HAVING count(*) > 1",
)
def q36(spark, sf_dir):
    return audit.duplicate_groups(v.e(spark, sf_dir))


def _profile_sql(source: str, columns: list[str]) -> str:
    """Per column: name, non-empty values, longest value, suggested type."""
    one = """SELECT '{c}' AS column_name,
    count(*) FILTER ("{c}" IS NOT NULL AND "{c}" <> '') AS non_empty,
    CAST(max(length("{c}")) FILTER ("{c}" IS NOT NULL AND "{c}" <> '') AS INTEGER) AS max_len
  FROM {s}"""
    rows = "\n  UNION ALL ".join(one.format(c=c, s=source) for c in columns)
    return f"""SELECT *, CASE WHEN column_name = 'text' THEN 'TEXT'
  WHEN max_len IS NULL THEN '?'
  WHEN max_len * 2 <= 16 THEN 'VARCHAR(16)' WHEN max_len * 2 <= 32 THEN 'VARCHAR(32)'
  WHEN max_len * 2 <= 64 THEN 'VARCHAR(64)' WHEN max_len * 2 <= 128 THEN 'VARCHAR(128)'
  WHEN max_len * 2 <= 255 THEN 'VARCHAR(255)' ELSE 'TEXT' END AS suggested FROM ({rows})"""


RAW_TEXT = [
    *EVENT_COLUMNS,
    "Is Primary Attribution",
    "Region",
]


@query("q38_column_profile", v.VIEWS + _profile_sql("r", RAW_TEXT))
def q38(spark, sf_dir):
    return audit.column_profile(v.r(spark, sf_dir).drop("app_id", "attribution_type"))


@query("q38_document_profile", _profile_sql("documents", ["text", "lang", "source"]))
def q38_documents(spark, sf_dir):
    return audit.column_profile(v.table(spark, sf_dir, "documents"), long_text=("text",))


@query(
    "q38_row_width",
    v.VIEWS
    + f"""SELECT CAST(coalesce(sum(w), 0) AS BIGINT) AS row_bytes, coalesce(sum(w), 0) <= 65535 AS fits
FROM (SELECT CASE WHEN suggested LIKE 'VARCHAR%'
    THEN CAST(regexp_extract(suggested, '[0-9]+') AS INTEGER) * 4 + 2 ELSE 0 END AS w
  FROM ({_profile_sql('r', RAW_TEXT)}))""",
)
def q38_width(spark, sf_dir):
    return audit.row_width(q38(spark, sf_dir))


@query(
    "q39_event_mix",
    v.VIEWS
    + """SELECT event_name, media_source, count(*) AS n,
  count(*) / (SELECT count(*) FROM e) AS share FROM e GROUP BY event_name, media_source""",
)
def q39(spark, sf_dir):
    return audit.mix(v.e(spark, sf_dir), "event_name", "media_source")


NULLISH = ["media_source", "channel", "campaign", "customer_user_id"]


@query(
    "q40_null_literals",
    v.VIEWS
    + """, n AS (SELECT
  CASE row_ord % 29 WHEN 0 THEN 'NA' WHEN 1 THEN 'nan' ELSE media_source END AS media_source,
  CASE row_ord % 31 WHEN 0 THEN 'None' WHEN 1 THEN 'none' ELSE channel END AS channel,
  CASE row_ord % 37 WHEN 0 THEN 'N/A' WHEN 1 THEN 'NULL' ELSE campaign END AS campaign,
  customer_user_id FROM e) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IN ('NA', 'NULL', 'None', 'N/A', 'nan'))"
        " AS literals FROM n"
        for c in NULLISH
    ),
)
def q40(spark, sf_dir):
    n = F.col("row_ord")

    def salted(name, every, first, second):
        return (
            F.when(n % every == 0, first).when(n % every == 1, second).otherwise(F.col(name))
        ).alias(name)

    rows = v.e(spark, sf_dir).select(
        salted("media_source", 29, "NA", "nan"),
        salted("channel", 31, "None", "none"),
        salted("campaign", 37, "N/A", "NULL"),
        "customer_user_id",
    )
    return audit.null_literals(rows)


@query(
    "q41_compare_tables",
    v.VIEWS
    + """, l AS (SELECT app_id, attribution_type, CAST(event_time AS DATE) AS day,
    count(*) AS n, sum(event_revenue) AS m FROM t0 GROUP BY ALL),
k AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY app_id, attribution_type, event_time, event_name, device_id
  ORDER BY install_time DESC NULLS LAST, row_ord DESC) AS rn FROM e) WHERE rn = 1),
q AS (SELECT app_id, attribution_type, CAST(event_time AS DATE) AS day,
    count(*) AS n, sum(event_revenue) AS m FROM k GROUP BY ALL)
SELECT app_id, attribution_type, day, coalesce(l.n, 0) AS left_rows, coalesce(q.n, 0) AS right_rows,
  coalesce(q.n, 0) - coalesce(l.n, 0) AS row_diff,
  CAST(coalesce(q.m, 0) - coalesce(l.m, 0) AS DECIMAL(38,4)) AS revenue_diff
FROM l FULL OUTER JOIN q USING (app_id, attribution_type, day)""",
)
def q41(spark, sf_dir):
    before = v.t0(spark, sf_dir)
    after = keep_latest(v.e(spark, sf_dir), ("app_id", "attribution_type"))
    by = {
        "app_id": F.col("app_id"),
        "attribution_type": F.col("attribution_type"),
        "day": F.col("event_time").cast("date"),
    }
    out = audit.compare_tables(before, after, by)
    return out.withColumn("revenue_diff", F.col("revenue_diff").cast("decimal(38,4)"))


@query(
    "q41_groups_that_lost_rows",
    v.VIEWS
    + """, b AS (SELECT app_id, device_id, count(*) AS n FROM e
    WHERE media_source = 'Social' GROUP BY ALL),
k AS (SELECT app_id, device_id, count(*) AS n FROM e WHERE row_ord % 3 <> 0 GROUP BY ALL)
SELECT b.app_id, b.device_id, b.n AS left_rows, coalesce(k.n, 0) AS right_rows
FROM b LEFT JOIN k USING (app_id, device_id) WHERE coalesce(k.n, 0) < b.n""",
)
def q41_lost(spark, sf_dir):
    """A fuller load must hold at least what the filtered one held, group by group."""
    df = v.e(spark, sf_dir)
    before = df.filter("media_source = 'Social'")
    after = df.filter("row_ord % 3 <> 0")
    by = {"app_id": F.col("app_id"), "device_id": F.col("device_id")}
    lost = audit.fewer_rows(audit.compare_tables(before, after, by))
    return lost.select(*by, "left_rows", "right_rows")
