"""The event table: a catalog table in parquet, partitioned by app, type and day.

A window owns whole days of one app and type, so replacing it means replacing
whole partitions: only those are written, whatever the size of the table.  They are written
to a folder of their own load, beside the data that is there, and a list of what changes is
written after them.  Only then does the catalog learn the new places, partition by partition, and
the old folders go last.  A run that dies before its list is complete has changed nothing;
one that dies later is finished from the list by ``finish_switches``, with which every run
begins.  At no moment is a partition without its old or its new rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.replace import replace_metrics, with_deleter
from windrow.operators.work_items import WorkItems, window_days
from windrow.runtime import counted_bound, delete_folders, join_small, stage, staging
from windrow.sources.landing import folder_of
from windrow.spec import EVENTS, LOAD_ORDER, ReportSpec, TABLE_COLUMNS

PARTITION_COLS = ("app_id", "attribution_type", "event_date")

ORDINALS = dict.fromkeys(LOAD_ORDER, "bigint")


@dataclass(frozen=True)
class TableStatus:
    table_exists: bool
    row_count: int | None


def create_table(
    spark: SparkSession,
    name: str,
    location: str | None = None,
    columns: Mapping[str, str] = TABLE_COLUMNS,
) -> None:
    """Create the table unless it exists.  An existing one is left as it is."""
    data = {c: t for c, t in {**columns, **ORDINALS}.items() if c not in PARTITION_COLS}
    parts = {"app_id": "string", "attribution_type": "string", "event_date": "date"}
    ddl = ", ".join(f"`{c}` {t}" for c, t in {**data, **parts}.items())
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLS)}){where}"
    )


def table_status(spark: SparkSession, name: str) -> TableStatus:
    if not spark.catalog.tableExists(name):
        return TableStatus(False, None)
    return TableStatus(True, spark.table(name).count())


def require_table(spark: SparkSession, name: str) -> None:
    """Stop a real run whose target is not there yet; dry runs skip this."""
    if not spark.catalog.tableExists(name):
        raise RuntimeError(f"table {name} does not exist yet; create it first")


def next_load_seq() -> int:
    """A number that grows from load to load: microseconds since the epoch."""
    return time.time_ns() // 1000


def shaped(
    rows: DataFrame,
    like: DataFrame,
    load_seq: int | None,
    spec: ReportSpec = EVENTS,
    hint: bool = True,
) -> DataFrame:
    """Rows in the table's column order and types, split over files by partition.

    The rebalance hint merges small partitions and splits large ones when the
    shuffle's real sizes are known.
    """
    with_day = rows.withColumn("event_date", F.col(spec.window_column).cast("date"))
    if load_seq is not None:
        window = F.col("seq") if "seq" in rows.columns else F.lit(0)
        with_day = with_day.withColumns(
            {"load_seq": F.lit(load_seq).cast("long"), "window_seq": window.cast("long")}
        )
    out = [F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema]
    out = with_day.select(*out)
    return out.hint("rebalance", *PARTITION_COLS) if hint else out


def append_rows(
    spark: SparkSession, name: str, rows: DataFrame, load_seq: int | None, spec: ReportSpec = EVENTS
) -> None:
    """Insert only; one job, so either all files are committed or none."""
    shaped(rows, spark.table(name), load_seq, spec).write.insertInto(name)


def in_span(existing: DataFrame, items: WorkItems) -> DataFrame:
    """Prune the table to the days between the first and last window."""
    first = items.df.select(F.min("start_date")).scalar()
    last = items.df.select(F.max("end_date")).scalar()
    return existing.filter((F.col("event_date") >= first) & (F.col("event_date") <= last))


def replace_in_table(
    spark: SparkSession,
    name: str,
    incoming: DataFrame,
    items: WorkItems,
    load_seq: int | None = None,
    spec: ReportSpec = EVENTS,
    skip_unchanged: bool = False,
) -> DataFrame:
    """Replace the windows in ``items`` by ``incoming``; returns counts per window.

    ``incoming`` should be staged: it is read several times.  Counts are taken and
    staged before anything is written.  With ``skip_unchanged`` days whose rows are the ones
    the table has, in any order, are left alone and keep the ``load_seq`` they have; the
    counts then say how many days were ``unchanged``.
    """
    finish_switches(spark, name)
    load_seq = next_load_seq() if load_seq is None else load_seq
    table = spark.table(name)
    keys = list(PARTITION_COLS)
    with staging(spark) as result:
        owned = stage(
            window_days(items).select("app_id", "attribution_type", F.col("day").alias("event_date")),
            "owned",
        )
        there = join_small(in_span(table, items), owned, keys, "left_semi", items.days)
        metrics = replace_metrics(there, incoming, items, spec)

        placed = with_deleter(incoming, items, F.col("seq"), spec.window_column)
        alive = placed.filter(F.col("deleted_by").isNull()).drop("deleted_by")
        alive = alive.withColumn("event_date", F.col(spec.window_column).cast("date"))
        written = shaped(alive, table, load_seq, spec, hint=False)
        days = stage(alive.select(*keys).distinct(), "days")
        stale = there.select(*keys).distinct().join(days, keys, "left_anti")

        # Rows of a foreign day join the rows that are there: the day is written anew with
        # both, less what an earlier try of this load has left.
        foreign = stage(days.join(owned, keys, "left_anti"), "foreign")
        if not foreign.isEmpty():
            stays = join_small(table, foreign, keys, "left_semi", counted_bound(foreign))
            stays = stays.filter(~F.col("load_seq").eqNullSafe(F.lit(load_seq)))
            written = written.union(stays.select(*table.columns))
        if skip_unchanged:
            same = stage(unchanged_days(there, written, owned), "same")
            written = join_small(written, same, keys, "left_anti", items.days)
            metrics = metrics.join(_per_window(same, items), "seq", "left")
            metrics = metrics.fillna(0, ["unchanged_days"])
        metrics = result(metrics, "metrics")
        switch_partitions(spark, name, written, stale, load_seq)
    return metrics


def _per_window(days: DataFrame, items: WorkItems) -> DataFrame:
    """Number of ``days`` per window: the first one that owns a day counts it."""
    owned = window_days(items).withColumnRenamed("day", "event_date")
    met = days.join(owned, list(PARTITION_COLS))
    return met.groupBy(F.col("seqs")[0].alias("seq")).agg(F.count("*").alias("unchanged_days"))


def fingerprint(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, prints) of rows in any order, ordinals apart: equal rows in equal numbers have
    equal prints, others by chance once in some 2^128 times."""
    columns = [F.col(c) for c in rows.columns if c not in {*ORDINALS, *by}]
    told = F.struct(*columns)
    high = lambda seed: F.xxhash64(F.lit(seed), told).cast("decimal(20,0)")
    # Sums, not exclusive ors: a row that is there twice must count twice.
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.array(F.sum(high(1)), F.sum(high(2))).alias("prints")
    )


def unchanged_days(there: DataFrame, written: DataFrame, owned: DataFrame) -> DataFrame:
    """Owned days that would be written as they are."""
    keys = list(PARTITION_COLS)
    old = fingerprint(there, keys)
    new = fingerprint(written, keys).join(owned, keys, "left_semi")
    return old.join(new, [*keys, "n", "prints"], "left_semi").select(*keys)


# Names that start with an underline are no data to a reader of the folder.
LOADS, SWITCHES = "_load", "_switch"
CHANGES = (
    "app_id string, attribution_type string, event_date date, place string, old array<string>"
)


def switch_partitions(
    spark: SparkSession,
    name: str,
    written: DataFrame,
    stale: DataFrame,
    load_seq: int,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Put ``written`` in the place of its partitions and take those in ``stale`` away.

    ``check`` gets the rows as they were written, before anything else knows of them; if it
    raises, the table stays as it is.
    """
    keys = list(PARTITION_COLS)
    home = table_location(spark, name)
    attempt = f"{load_seq}-{uuid.uuid4().hex[:12]}"
    load = f"{home}/{LOADS}-{attempt}"
    written.hint("rebalance", *keys).write.partitionBy(*keys).parquet(load)
    schema = spark.table(name).select(*written.columns).schema
    fresh = spark.read.schema(schema).option("basePath", load).parquet(load)
    if check is not None:
        try:
            check(fresh)
        except Exception:
            delete_folders(spark, [load])
            raise
    places = fresh.select(*keys, folder_of("_metadata.file_path").alias("place")).distinct()
    places = places.unionByName(stale.select(*keys).withColumn("place", F.lit(None).cast("string")))
    places = stage(places, "places")
    files = spark.table(name).select(*keys, folder_of("_metadata.file_path").alias("old"))
    files = join_small(files, places.select(*keys), keys, "left_semi", counted_bound(places))
    old = files.groupBy(*keys).agg(F.collect_set("old").alias("old"))
    changes = places.join(old, keys, "left").select(*keys, "place", "old")
    changes.write.parquet(f"{home}/{SWITCHES}-{attempt}")
    finish_switches(spark, name)


def finish_switches(spark: SparkSession, name: str) -> None:
    """Carry out the lists of changes that lie with the table, oldest first.

    Every step may be done again.  A list that was not committed is none: its run changed
    nothing, and what it wrote is deleted.
    """
    home = table_location(spark, name)
    pending = _folders(spark, f"{home}/{SWITCHES}-*")
    for folder in sorted(pending, key=lambda f: int(f.rsplit("-", 2)[1])):
        if not _exists(spark, f"{folder}/_SUCCESS"):
            delete_folders(spark, [folder, folder.replace(f"/{SWITCHES}-", f"/{LOADS}-")])
            continue
        changes = spark.read.schema(CHANGES).parquet(folder).collect()
        _tell_catalog(spark, name, changes)
        now = {c.place for c in changes}
        delete_folders(spark, [f for c in changes for f in c.old or () if f not in now])
        delete_folders(spark, [folder])


def _tell_catalog(spark: SparkSession, name: str, changes: list, batch: int = 500) -> None:
    """New places first, then partitions that go; many to a statement where SQL has that."""
    wanted = spark.createDataFrame(
        [(_partition_folder(spark, c),) for c in changes], "partition string"
    )
    listed = spark.sql(f"SHOW PARTITIONS {name}").join(wanted, "partition", "left_semi")
    known = {r.partition for r in listed.collect()}
    fresh, moved, gone = [], [], []
    for c in changes:
        there = _partition_folder(spark, c) in known
        (gone if c.place is None else moved if there else fresh).append(c)
    for lo in range(0, len(fresh), batch):
        parts = " ".join(
            f"PARTITION ({_spec(c)}) LOCATION {_literal(c.place)}" for c in fresh[lo : lo + batch]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    for c in moved:
        spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(c)}) SET LOCATION {_literal(c.place)}")
    for lo in range(0, len(gone), batch):
        parts = ", ".join(f"PARTITION ({_spec(c)})" for c in gone[lo : lo + batch])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
    spark.catalog.refreshTable(name)


def _spec(row) -> str:
    return (
        f"app_id = {_literal(row.app_id)}, attribution_type = {_literal(row.attribution_type)},"
        f" event_date = DATE'{row.event_date.isoformat()}'"
    )


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [s.getPath().toString() for s in found]


def _exists(spark: SparkSession, file: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def _partition_folder(spark: SparkSession, row) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{c}={escape(str(row[c]))}" for c in PARTITION_COLS)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def build_replacement(spark: SparkSession, name: str, rows: DataFrame) -> str:
    """Write ``rows`` to a new table shaped like ``name``; returns its name.

    It lies next to the table, in a folder of its own, so the swap renames catalog
    entries and moves no data.
    """
    new = f"{name}_new"
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    table = spark.table(name)
    columns = dict(f for f in table.dtypes if f[0] not in ORDINALS and f[0] != "event_date")
    beside = f"{table_location(spark, name)}_{uuid.uuid4().hex[:12]}"
    create_table(spark, new, beside, columns)
    shaped_rows = rows.select(*table.columns).hint("rebalance", *PARTITION_COLS)
    shaped_rows.write.insertInto(new)
    return new


def swap_tables(spark: SparkSession, name: str, new: str, backup: str) -> None:
    """Put ``new`` in the place of ``name``, which stays as ``backup``.

    Two renames: between them, for a moment, nothing has the name.
    """
    spark.sql(f"ALTER TABLE {name} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {backup} RENAME TO {name}")
        raise


def roll_back(spark: SparkSession, name: str, backup: str, aside: str) -> None:
    """Undo a swap: the backup takes the name again, the replacement is kept aside."""
    swap_tables(spark, name, backup, aside)
