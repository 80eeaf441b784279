"""Whole runs over files: broken reports beside good ones, load then rewrite, append a CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as v
from catalog.dedups import KEY, LATEST, ranked
from catalog.loads import APPEND, OUT, SURVIVORS, incoming, stored, table_of
from catalog.registry import query
from catalog.reports import GOOD, NAMES, RESULTS, SOURCE, WINDOW, land
from windrow.operators.work_items import WorkItems, work_items
from windrow.plans import append_run
from windrow.plans.load_run import carry_out, plan_load
from windrow.plans.journal import journal, record_run, stability
from windrow.plans.rewrite_run import rewrite_repeats, rewrite_table
from windrow.runtime import scratch_path, stage
from windrow.sinks.table import append_rows, create_table, replace_in_table, table_status
from windrow.spec import EVENT_COLUMNS, WINDOW_COLS

LAST_DAY = v.dt.date(2024, 2, 4)
HEADER = ",".join([*EVENT_COLUMNS, "Is Primary Attribution", "Region"])

# Apps whose reports are broken, each in its own way, and the header line they have.
BROKEN = {
    "blank": " ",
    "bom": "﻿",
    "refused": "The request of this app was refused",
    "renamed": HEADER.replace("Event Time", "Time of Event"),
    "doubled": HEADER.replace("Region", "Region,region"),
    "ragged": HEADER,
}


def weeks(spark: SparkSession, apps) -> WorkItems:
    return work_items(spark, apps, v.FIRST_DAY, LAST_DAY, v.weekly())


def land_lines(lines: DataFrame, root: str) -> None:
    """Write (line, n, window) as files as they are, one per window, in the order of ``n``."""
    (
        lines.repartition(*WINDOW_COLS)
        .sortWithinPartitions(*WINDOW_COLS, "n")
        .select("line", *WINDOW_COLS)
        .write.mode("append")
        .option("sep", "\x01")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy(*WINDOW_COLS)
        .csv(root)
    )


def broken_reports(rows: DataFrame) -> DataFrame:
    """Every report of app0's first type again for each broken app, as lines of text."""
    cells = [F.col(f"`{c}`") for c in HEADER.split(",")]
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])
    body = rows.filter("app_id = 'app0' AND attribution_type = 'non_organic'")
    window = [c for c in WINDOW_COLS if c != "app_id"]
    parts = []
    for app, header in BROKEN.items():
        heads = body.select(*window).distinct().select(
            F.lit(header).alias("line"), F.lit(-1).alias("n"), F.lit(app).alias("app_id"), *window
        )
        parts.append(heads)
        if header.startswith(HEADER[:5]) or app == "renamed":
            more = F.lit(",x,y") if app == "ragged" else F.lit("")
            parts.append(
                body.select(
                    F.concat(line, more).alias("line"), F.col("row_ord").alias("n"),
                    F.lit(app).alias("app_id"), *window,
                )
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "q51_bad_reports",
    v.VIEWS
    + RESULTS
    + f"""SELECT {WINDOW}, fetched_rows, loaded_rows,
  CASE WHEN error IS NOT NULL THEN 'row' END AS verdict FROM results
WHERE NOT (app_id = 'app1' AND attribution_type = 'retargeting')
UNION ALL
SELECT {WINDOW}, 0, 0, 'header' FROM results
WHERE app_id = 'app1' AND attribution_type = 'retargeting'
UNION ALL
SELECT app, t, w, CAST(w + 6 AS DATE), 0, 0, CASE WHEN t = 'retargeting' THEN 'absent'
  WHEN app IN ('blank', 'bom') THEN 'empty' WHEN app = 'doubled' THEN 'repeated'
  WHEN app = 'ragged' THEN 'width' ELSE 'header' END
FROM (SELECT unnest(['blank', 'bom', 'refused', 'renamed', 'doubled', 'ragged']) AS app),
  (SELECT unnest(['non_organic', 'retargeting']) AS t),
  (SELECT DISTINCT start_date AS w FROM results)""",
)
def q51(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good reports load beside broken ones; a broken second file fails its window."""
    rows = v.r(spark, sf_dir)
    root = land(rows.drop("row_ord"), "q51")
    land_lines(broken_reports(rows), root)
    seconds = rows.filter("app_id = 'app1' AND attribution_type = 'retargeting'")
    seconds = seconds.select(*WINDOW_COLS).distinct()
    land_lines(seconds.withColumns({"line": F.lit(BROKEN["refused"]), "n": F.lit(0)}), root)
    plan = plan_load(spark, root, weeks(spark, [*v.APPS, *BROKEN]), SOURCE, NAMES, v.weekly())
    told = lambda text: F.col("error").contains(text)
    verdict = (
        F.when(told("no report"), "absent")
        .when(told("empty"), "empty")
        .when(told("missing columns"), "header")
        .when(told("repeats"), "repeated")
        .when(told("wrong width"), "width")
        .when(F.col("error").isNotNull(), "row")
    )
    return plan.results.select(*WINDOW_COLS, "fetched_rows", "loaded_rows", verdict.alias("verdict"))


@query(
    "q15_rewrite_after_load",
    v.VIEWS
    + f""", {GOOD}
SELECT event_time, event_name, device_id, app_id, attribution_type, install_time,
  CAST(event_revenue AS DECIMAL(18,4)) AS event_revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY event_time, event_name, device_id
    ORDER BY install_time DESC NULLS LAST, app_id DESC, attribution_type DESC, start_date DESC,
      row_ord DESC) AS rn FROM good)
WHERE rn = 1""",
)
def q15_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both types are loaded from reports, then a twin in the later window outlives the other,
    whatever their places in their reports."""
    rows = v.r(spark, sf_dir)
    cells = [F.col(f"`{c}`") for c in HEADER.split(",")]
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])
    heads = rows.select(*WINDOW_COLS).distinct().select(
        F.lit(HEADER).alias("line"), F.lit(-1).cast("long").alias("n"), *WINDOW_COLS
    )
    root = scratch_path(spark, "q15")
    land_lines(heads.unionByName(rows.select(line.alias("line"), F.col("row_ord").alias("n"), *WINDOW_COLS)), root)
    name = f"windrow_{root.rsplit('-', 1)[-1]}"
    create_table(spark, name, f"{root}_table")
    plan = plan_load(spark, root, weeks(spark, v.APPS), SOURCE, NAMES, v.weekly())
    carry_out(plan, name, v.weekly())
    rewrite_table(spark, name, f"{name}_bak")
    out = spark.table(name)
    kept = spark.read.schema(out.schema).parquet(_home(spark, name))
    for entry in (name, f"{name}_bak"):  # only the entries: the tables are external
        spark.sql(f"DROP TABLE {entry}")
    return kept.select(
        "event_time", "event_name", "device_id", "app_id", "attribution_type", "install_time", "event_revenue"
    )


def _home(spark: SparkSession, name: str) -> str:
    from windrow.sinks.table import table_location

    return table_location(spark, name)


@query(
    "q54_append_csv",
    v.VIEWS
    + APPEND
    + f"SELECT {v.TABLE_LIST} FROM y WHERE NOT known AND rn = 1 UNION ALL SELECT {v.TABLE_LIST} FROM t0",
)
def q54(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append path from files to the table."""
    folder = scratch_path(spark, "q54")
    (
        v.a(spark, sf_dir)
        .orderBy("row_ord")
        .drop("row_ord")
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    name, _ = table_of(spark, v.t0(spark, sf_dir), "q54")
    append_run.carry_out(append_run.plan_append(spark, folder, name), name, 2)
    return stored(spark, name).drop("row_ord")


@query("q15_rewrite_repeats", v.VIEWS + ranked("e2", KEY, LATEST, OUT))
def q15_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key by writing only the partitions that lose a row."""
    name, _ = table_of(spark, v.e2(spark, sf_dir), "q15-repeats")
    rewrite_repeats(spark, name, f"{name}_bak")
    spark.sql(f"DROP TABLE IF EXISTS {name}_bak")
    return stored(spark, name)


@query("q21_replace_beside_rows_without_load", v.VIEWS + SURVIVORS.format(out=OUT, inc="inc"))
def q21_without_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that were put in without ordinals stay on the days that reports reach over to."""
    name, _ = table_of(spark, v.t0(spark, sf_dir).limit(0), "q21-plain")
    plain = {c: F.lit(None).cast("long") for c in ("load_seq", "window_seq")}
    append_rows(spark, name, v.t0(spark, sf_dir).withColumns(plain), None)
    rows = stage(incoming(spark, sf_dir), "q21-incoming")
    replace_in_table(spark, name, rows, v.middle_weeks(spark), 2, v.weekly())
    return stored(spark, name)


INSIDE = """, own AS (
  SELECT * FROM inc WHERE report_start = CAST('2024-01-01' AS DATE)
    + 7 * CAST((CAST(event_time AS DATE) - DATE '2024-01-01') // 7 AS INTEGER)
) """


def inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incoming(spark, sf_dir)
    return rows.filter(F.col("event_time").cast("date").between(F.col("start_date"), F.col("end_date")))


@query(
    "q23_second_lookback",
    v.VIEWS
    + INSIDE
    + f"""SELECT i.seq, {', '.join(f'i.{c}' for c in WINDOW_COLS)}, count(own.seq) AS deleted,
  count(own.seq) AS inserted, count(DISTINCT CAST(own.event_time AS DATE))
    - CAST(max(CASE WHEN own.row_ord % 97 = 0 AND i.seq = 3 THEN 1 ELSE 0 END) AS BIGINT)
    AS unchanged_days
FROM items i LEFT JOIN own ON own.seq = i.seq GROUP BY ALL""",
)
def q23_second_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows again, in another order and with one day changed: the others keep
    their files."""
    name, _ = table_of(spark, v.t0(spark, sf_dir), "q23-lookback")
    items = v.middle_weeks(spark)
    rows = stage(inside(spark, sf_dir), "q23-incoming")
    replace_in_table(spark, name, rows, items, 2, v.weekly())
    odd = rows.filter((F.col("seq") == 3) & (F.col("row_ord") % 97 == 0))
    day = odd.select(F.min(F.col("event_time").cast("date"))).scalar()
    hit = (F.col("seq") == 3) & (F.col("event_time").cast("date") == day)
    later = rows.withColumn("channel", F.when(hit, F.lit("corrected")).otherwise(F.col("channel")))
    later = later.orderBy(F.desc("row_ord")).withColumn("row_ord", -F.col("row_ord"))
    metrics = replace_in_table(spark, name, later, items, 3, v.weekly(), skip_unchanged=True)
    spark.sql(f"DROP TABLE {name}")
    return metrics.select("seq", *WINDOW_COLS, "deleted", "inserted", "unchanged_days")


@query(
    "q41_run_journal",
    v.VIEWS
    + f"""SELECT {', '.join(f'i.{c}' for c in WINDOW_COLS)},
  count(inc.seq) FILTER (inc.row_ord % 7 <> 0) AS rows_before, count(inc.seq) FILTER (keep) AS rows_after,
  CAST(coalesce(sum(inc.event_revenue) FILTER (inc.row_ord % 7 <> 0), 0) AS DECIMAL(38,4)) AS revenue_before,
  CAST(coalesce(sum(inc.event_revenue) FILTER (keep), 0) AS DECIMAL(38,4)) AS revenue_after,
  count(inc.seq) FILTER (keep) < count(inc.seq) FILTER (inc.row_ord % 7 <> 0) AS lost,
  NOT coalesce(bool_or((inc.row_ord % 7 = 0) = keep), false) AS same
FROM items i LEFT JOIN (SELECT *, seq <> 5 OR row_ord % 3 = 0 AS keep FROM inc) inc ON inc.seq = i.seq
GROUP BY ALL""",
)
def q41_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the same windows, told from the journal: late events came, one lost rows."""
    name, _ = table_of(spark, v.t0(spark, sf_dir), "q41-journal")
    items, rows = v.middle_weeks(spark), stage(incoming(spark, sf_dir), "q41-incoming")
    later = rows.filter((F.col("seq") != 5) | (F.col("row_ord") % 3 == 0))
    for load_seq, some in ((2, rows.filter("row_ord % 7 <> 0")), (3, later)):
        replace_in_table(spark, name, some, items, load_seq, v.weekly())
        record_run(spark, name, some, items, load_seq)
    told = stage(stability(journal(spark, name), 2, 3), "q41-told")
    spark.sql(f"DROP TABLE {name}")
    return told


@query(
    "q55_table_status",
    v.VIEWS + "SELECT false AS table_exists, NULL::BIGINT AS row_count UNION ALL SELECT true, count(*) FROM t0",
)
def q55(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run is told of its target before and after it is there."""
    name, _ = table_of(spark, v.t0(spark, sf_dir), "q55")
    told = [table_status(spark, f"{name}_absent"), table_status(spark, name)]
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(
        [(t.table_exists, t.row_count) for t in told], "table_exists boolean, row_count long"
    )
