"""The landing zone: raw CSV reports, one directory per window.

    <root>/app_id=…/attribution_type=…/start_date=…/end_date=…/*.csv

Every column is read as text.  Reports may differ in the order of their columns.  Spark reads
a set of CSV files by position, so all files of one width are one scan of numbered columns,
and a manifest, a row per file with the place of each wanted column in it, says which of them
a column is.  A bad file is reported in ``files`` and a ragged row is flagged, so neither
disturbs other windows.

A run looks at the folders of its own apps and windows only.  Headers are
judged in tasks; the driver sees folders and widths, and paths only as Spark's file index does.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.text import normalise_header
from windrow.operators.ordinal import position_in_task
from windrow.operators.validate import missing_headers
from windrow.operators.work_items import WorkItems
from windrow.runtime import join_small, ship_package, stage
from windrow.spec import EVENT_COLUMNS, EVENTS, ReportSpec, WINDOW_COLS

CORRUPT = "_corrupt_record"
BOM = "﻿"

# The endings of a report.  Files being written or put aside have others.
REPORT_FILES = "*.{csv,csv.gz,csv.bz2,csv.zst}"

WINDOW_FIELDS = [
    T.StructField("app_id", T.StringType()),
    T.StructField("attribution_type", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
]


@dataclass(frozen=True)
class LandingScan:
    """``raw``: report rows with window columns, ``row_ord`` and ``corrupt``.

    ``files``: one row per file with its window, number within the window, header
    and ``problem`` (NULL for a usable file).  ``file_count`` is known exactly.
    """

    raw: DataFrame
    files: DataFrame
    file_count: int


def csv_reader(spark: SparkSession):
    """Text only, quotes doubled, newlines allowed in quotes, no column pruning.

    Pruning would skip the fields that show a ragged row.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("columnPruning", False)
    )


@contextmanager
def _one_file_per_task(spark: SparkSession) -> Iterator[None]:
    names = ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, str(1 << 40))
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def path_status(spark: SparkSession, pattern: str) -> list:
    """Files and folders of a pattern, in any file system Spark can reach; none if absent."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.globStatus(path) or [])


def window_folders(spark: SparkSession, root: str, items: WorkItems | None) -> list[str]:
    """Folders of windows: all of them, or those of the apps and date ranges of ``items``.

    Only folder names are listed, a pattern per app and date range of the run.
    """
    ends, apps = [("*", "*")], [("*", "*")]
    if items is not None:
        # A run has few date ranges, however many apps it loads.
        ranges = items.df.select("start_date", "end_date").distinct().collect()
        ends = [(r.start_date.isoformat(), r.end_date.isoformat()) for r in ranges]
        found = items.df.select("app_id", "attribution_type").distinct().collect()
        apps = [
            (app, kind)
            for r in found
            for app in _spellings(spark, r.app_id)
            for kind in _spellings(spark, r.attribution_type)
        ]
    patterns = [
        f"{root}/app_id={app}/attribution_type={kind}/start_date={start}/end_date={end}"
        for app, kind in sorted(set(apps))
        for start, end in sorted(ends)
    ]
    with ThreadPoolExecutor(16) as pool:
        listed = list(pool.map(lambda pattern: path_status(spark, pattern), patterns))
    return [s.getPath().toString() for some in listed for s in some if s.isDirectory()]


def _spellings(spark: SparkSession, value: str) -> set[str]:
    """How a value may be written in a folder's name, escaped or plain, as patterns."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    names = {escape(value)} | ({value} if "/" not in value else set())
    return {re.sub(r"([\\*?\[\]{},^])", r"\\\1", n) for n in names}


def _text_files(spark: SparkSession, paths: list[str], names: str = REPORT_FILES) -> DataFrame:
    return spark.read.option("pathGlobFilter", names).text(paths)


def folder_of(file_path: str) -> Column:
    """The folder of a file as it is named; file paths of a scan are escaped once more."""
    folder = F.regexp_replace(file_path, "/[^/]*$", "")
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))


def file_path_of_row() -> Column:
    """The file a row came from, spelled as the file listing spells it."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def first_lines(spark: SparkSession, folders: list[str], names: str = REPORT_FILES) -> DataFrame:
    """(file_path, header) of every file that has text, reading only file heads.

    With one file per task, a task that stops after one line has read one buffer.
    """
    bom = BOM

    # Nested, so it travels by value: executors need not have this package.
    def first_line(rows):
        for row in rows:
            line = row.value.replace(bom, "")
            if line.strip():
                yield row.file_path, line
                return

    with _one_file_per_task(spark):
        text = _text_files(spark, folders, names)
        lines = text.select("value", file_path_of_row().alias("file_path")).rdd
        heads = spark.createDataFrame(
            lines.mapPartitions(first_line), "file_path string, header string"
        )
        return stage(heads, "heads")


def listed_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(file_path) of all report files, empty ones too, which scans leave out.

    The paths are those of the scan's own file index.
    """
    paths = _text_files(spark, folders).inputFiles()
    return spark.createDataFrame([(p,) for p in paths], "file_path string")


def parse_header(line: str) -> list[str]:
    return next(csv.reader([line]), [])


def canonical(name: str, spec: ReportSpec) -> str:
    """One spelling per column of a report that keeps all its columns: the raw header of the
    column a name normalises to, else the normalised name."""
    alias = {raw: to for to, raw in spec.raw_names.items()}
    target = alias.get(name) or normalise_header(name)
    known = {normalise_header(raw): to for raw, to in EVENT_COLUMNS.items()}
    return spec.raw_name(known.get(target, target))


def header_problem(names: Sequence[str], spec: ReportSpec = EVENTS) -> str | None:
    if spec.columns is None:
        names = [canonical(n, spec) for n in names]
    missing = missing_headers(names, spec)
    if missing:
        return f"report is missing columns: {missing}"
    folded = [n.lower() for n in names]  # Spark tells columns apart without case
    repeated = sorted({n for n in names if folded.count(n.lower()) > 1})
    if repeated:
        return f"report repeats columns: {repeated}"
    if spec.columns is None and spec.known_columns is not None:
        unknown = [n for n in names if normalise_header(n) not in spec.known_columns]
        if unknown:
            return f"report has unknown columns: {unknown}"
    return None


def _from_path(name: str) -> Column:
    """A window column from the file path; values are percent-escaped twice over."""
    escaped = F.regexp_extract("file_path", f"/{name}=([^/]+)/", 1)
    once = F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    return F.url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))


FILE_SCHEMA = (
    "file_path string, app_id string, attribution_type string, start_date date,"
    " end_date date, header string, problem string, file_no int"
)


def list_files(
    spark: SparkSession, root: str, spec: ReportSpec = EVENTS, items: WorkItems | None = None
) -> LandingScan:
    """Every report file of the windows with its problem; ``raw`` stays empty."""
    folders = window_folders(spark, root, items)
    if not folders:
        return LandingScan(_no_rows(spark, spec), spark.createDataFrame([], FILE_SCHEMA), 0)
    listed = listed_files(spark, folders)

    # A header is judged in the task that has it, so broken files cost the driver nothing.
    ship_package(spark)
    judge = F.udf(lambda line: header_problem(parse_header(line), spec), "string")
    heads = first_lines(spark, folders).withColumn("problem", judge("header"))
    files = listed.join(heads, "file_path", "left").select(
        "file_path",
        _from_path("app_id").alias("app_id"),
        _from_path("attribution_type").alias("attribution_type"),
        _from_path("start_date").try_cast("date").alias("start_date"),
        _from_path("end_date").try_cast("date").alias("end_date"),
        "header",
        F.when(F.col("header").isNull(), F.lit("report body is empty"))
        .otherwise(F.col("problem"))
        .alias("problem"),
    )
    order = Window.partitionBy(*WINDOW_COLS).orderBy("file_path")
    numbered = stage(files.withColumn("file_no", F.row_number().over(order) - 1), "files")
    return LandingScan(_no_rows(spark, spec), numbered, numbered.count())


def _no_rows(spark: SparkSession, spec: ReportSpec) -> DataFrame:
    names = list(spec.required_headers)
    fields = [T.StructField(n, T.StringType()) for n in names]
    tags = [
        *WINDOW_FIELDS,
        T.StructField("row_ord", T.LongType()),
        T.StructField("corrupt", T.BooleanType()),
    ]
    return spark.createDataFrame([], T.StructType([*fields, *tags]))


def scan_landing(
    spark: SparkSession, root: str, spec: ReportSpec = EVENTS, items: WorkItems | None = None
) -> LandingScan:
    """Read every usable report under ``root``, or only those of the windows in ``items``.

    ``row_ord`` follows file number and position in the file.  A report is never
    split (it may hold newlines in quotes and is capped in size by its source), so
    positions within one task give the order of a file's rows.
    """
    listing = list_files(spark, root, spec, items)
    files = listing.files
    if items is not None:
        wanted = items.df.select(*WINDOW_COLS).distinct()
        files = join_small(files, wanted, WINDOW_COLS, "left_semi", items.count)
    manifest, names = column_places(files.filter(F.col("problem").isNull()), spec)
    widths = manifest.groupBy("width", folder_of("file_path").alias("folder")).count().collect()
    folders: dict[int, list[str]] = {}
    for row in widths:
        folders.setdefault(row.width, []).append(row.folder)
    if not folders:
        return LandingScan(listing.raw, files, listing.file_count)
    parts = [
        _scan_width(spark, root, width, found, manifest, names, listing.file_count)
        for width, found in sorted(folders.items())
    ]
    return LandingScan(reduce(DataFrame.unionByName, parts), files, listing.file_count)


def column_places(usable: DataFrame, spec: ReportSpec) -> tuple[DataFrame, list[str]]:
    """The manifest: per file its ``width`` and the place of each wanted column, -1 if absent.

    A spec that keeps all columns wants every one that some file has; these few names are all
    that comes to the driver.
    """
    ship_package(usable.sparkSession)
    told = F.udf(lambda line: parse_header(line), "array<string>")
    headed = usable.withColumn("_names", told("header"))
    if spec.columns is None:
        spelled = F.udf(lambda line: [canonical(n, spec) for n in parse_header(line)], "array<string>")
        headed = headed.withColumn("_known", spelled("header"))
        found = headed.select(F.posexplode("_known").alias("at", "name"), "file_no", "file_path")
        order = found.groupBy("name").agg(F.min(F.struct("file_path", "at")).alias("first"))
        names = [r.name for r in order.orderBy("first").collect()]
    else:
        headed = headed.withColumn("_known", F.col("_names"))
        names = list(spec.columns)
    places = F.array(*[F.array_position("_known", n).cast("int") - 1 for n in names])
    manifest = headed.select(
        "file_path",
        "file_no",
        F.size("_names").alias("width"),
        (places if names else F.array().cast("array<int>")).alias("places"),
    )
    return stage(manifest, "manifest"), names


def _scan_width(
    spark: SparkSession,
    root: str,
    width: int,
    folders: list[str],
    manifest: DataFrame,
    names: Sequence[str],
    file_count: int,
) -> DataFrame:
    """All reports of one width: numbered columns, named by the manifest's places."""
    columns = [f"_c{i}" for i in range(width)]
    fields = [T.StructField(n, T.StringType()) for n in (*columns, CORRUPT)]
    scanned = (
        csv_reader(spark)
        .schema(T.StructType([*fields, *WINDOW_FIELDS]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", root)
        .option("pathGlobFilter", REPORT_FILES)
        .csv(folders)
        .select(
            F.array(*columns).alias("_cells"),
            *WINDOW_COLS,
            position_in_task().alias("_at"),
            F.col(CORRUPT).isNotNull().alias("corrupt"),
            file_path_of_row().alias("file_path"),
        )
    )
    own = manifest.filter(F.col("width") == width)
    met = join_small(scanned, own, ["file_path"], "inner", file_count)
    cell = lambda i: F.when(F.col("places")[i] >= 0, F.get("_cells", F.col("places")[i]))
    return met.select(
        *[cell(i).alias(n) for i, n in enumerate(names)],
        *WINDOW_COLS,
        (F.shiftleft(F.col("file_no").cast("long"), 33) + F.col("_at")).alias("row_ord"),
        "corrupt",
    )
