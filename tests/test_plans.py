"""The shape of physical plans that matter at scale."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from catalog import views as v
from catalog.loads import file_rows
from windrow.operators.audit import conflict_audit, dedup_impact, grouped_baseline
from windrow.operators.dedup import keep_latest
from windrow.operators.append import NATURAL_KEY, known_keys
from windrow.operators.replace import replace_metrics, replace_windows, tag_windows
from windrow.runtime import MAX_BROADCAST_ROWS, hot_keys, join_small

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|Single)", plan(df)))


def test_scan_reads_only_needed_columns(spark):
    text = plan(grouped_baseline(v.e(spark, SF_DIR)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "user_id", "value"}


def test_dedup_trims_before_its_one_shuffle(spark):
    df = keep_latest(v.e(spark, SF_DIR), ("app_id", "attribution_type"))
    text = plan(df)
    assert exchanges(df) == 1
    assert "WindowGroupLimit" in text and "Partial" in text


def test_replace_moves_no_rows(spark):
    items = v.middle_weeks(spark)
    rows = tag_windows(v.delivered(spark, SF_DIR), items)
    text = plan(replace_windows(v.t0(spark, SF_DIR), rows, items, v.weekly()))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_unbounded_windows_are_salted_not_broadcast(spark):
    items = replace(v.middle_weeks(spark), count=None, days=None)
    for bound in (None, MAX_BROADCAST_ROWS + 1):
        joined = join_small(
            v.e(spark, SF_DIR), items.df.select("app_id", "seq"), ["app_id"], "left", bound
        )
        assert "_salt" in plan(joined)
    narrow = join_small(
        v.e(spark, SF_DIR), items.df.select("app_id", "seq"), ["app_id"], "left", 8
    )
    assert "_salt" not in plan(narrow)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_gives_the_same_rows(spark, how):
    big = spark.range(500).select((F.col("id") % 7).alias("k"), "id").repartition(5)
    small = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k long, t string")
    a = join_small(big, small, ["k"], how, 3)
    b = join_small(big, small, ["k"], how, None)
    assert a.columns == b.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def test_hot_keys_stay_within_the_broadcast_bound(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert hot_keys(df, ["k"], 1).count() == 10
    assert hot_keys(df, ["k"], 1, max_keys=5).count() <= 5
    assert hot_keys(df, ["k"], 100).count() == 0


def test_audits_do_not_expand_rows(spark):
    for audit in (dedup_impact, conflict_audit):
        assert "Expand" not in plan(audit(v.e(spark, SF_DIR)))


def test_table_keys_are_filtered_before_they_are_shuffled(spark):
    """Of a table's keys those the file may have are shuffled, and few others."""
    rows = file_rows(spark, SF_DIR)
    keys = rows.limit(50).select(*NATURAL_KEY).distinct()
    n = keys.count()
    table = v.e(spark, SF_DIR).crossJoin(spark.range(40).toDF("copy"))
    table = table.withColumn("device_id", F.concat("device_id", F.lit("-"), "copy")).drop("copy")
    table = table.unionByName(keys.join(v.e(spark, SF_DIR).drop(*NATURAL_KEY).limit(1)))
    known = known_keys(table, keys, n)
    text = plan(known)
    assert text.index("BroadcastHashJoin") < text.index("FileScan parquet")
    got = known.collect()
    assert n <= len(got) <= n + 0.03 * table.count()
    assert {tuple(r) for r in keys.collect()} <= {tuple(r) for r in got}


def test_replace_counts_scan_table_and_reports_once(spark):
    items = v.middle_weeks(spark)
    rows = tag_windows(v.delivered(spark, SF_DIR), items)
    text = plan(replace_metrics(v.t0(spark, SF_DIR), rows, items, v.weekly()))
    assert text.count("FileScan parquet") == 2
