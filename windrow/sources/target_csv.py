"""CSV files that already have the table's columns, for the append path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrow.operators.ordinal import position_in_task
from windrow.runtime import join_small, ship_package, stage
from windrow.sources.landing import (
    csv_reader,
    file_path_of_row,
    first_lines,
    parse_header,
    path_status,
)
from windrow.spec import TABLE_COLUMNS


def check_exact_columns(columns: Sequence[str]) -> None:
    """Every column of the table once and nothing else, in any order."""
    odd = [
        f"{name} ({'absent' if name in TABLE_COLUMNS else 'unknown'})"
        for name in dict.fromkeys([*TABLE_COLUMNS, *columns])
        if list(columns).count(name) != 1 or name not in TABLE_COLUMNS
    ]
    if odd:
        raise ValueError(f"the header does not fit the table: {', '.join(odd)}")


def _files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the CSV files of a folder or pattern in the order of their names."""
    found = path_status(spark, path)
    if any(s.isDirectory() for s in found):
        found = [
            f
            for s in found
            for f in (path_status(spark, f"{s.getPath().toString()}/*.csv") if s.isDirectory() else [s])
        ]
    files = sorted(s.getPath().toString() for s in found if s.isFile())
    if not files:
        raise FileNotFoundError(f"no such CSV: {path}")
    return files


def read_target_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read one file, or the files of a folder, as text; a ragged row fails the job.

    Each file is read by its own header, so files may order their columns as they like: one
    job reads the headers, one scan the rows, and a row per file says where its columns are.
    ``row_ord`` goes by file name and then by position in the file.
    """
    files = _files(spark, path)
    ship_package(spark)
    parse = F.udf(lambda line: parse_header(line), "array<string>")
    listed = spark.createDataFrame([(f,) for f in files], "named string")
    paths = listed.select(F.row_number().over(Window.orderBy("named")) - 1, "named").toDF("n", "named")
    heads = first_lines(spark, files, "*").withColumn("names", parse("header"))
    heads = stage(heads.withColumn("named", _plain("file_path")), "append-heads")
    odd = heads.filter(F.array_sort("names") != F.array_sort(F.lit(list(TABLE_COLUMNS)))).first()
    if odd is not None:
        check_exact_columns(odd.names)
    numbered = paths.withColumn("named", _plain("named", decode=False))
    met = numbered.join(heads, "named", "left")
    if met.filter(F.col("names").isNull()).first() is not None:
        check_exact_columns([])
    places = F.array(*[F.array_position("names", c).cast("int") - 1 for c in TABLE_COLUMNS])
    manifest = stage(met.select("file_path", "n", places.alias("places")), "append-manifest")
    columns = [f"_c{i}" for i in range(len(TABLE_COLUMNS))]
    scanned = (
        csv_reader(spark)
        .option("mode", "FAILFAST")
        .schema(", ".join(f"{c} string" for c in columns))
        .csv(files)
        .select(F.array(*columns).alias("cells"), position_in_task().alias("at"),
                file_path_of_row().alias("file_path"))
    )
    rows = join_small(scanned, manifest, ["file_path"], "inner", len(files))
    return rows.select(
        *[F.get("cells", F.col("places")[i]).alias(c) for i, c in enumerate(TABLE_COLUMNS)],
        (F.shiftleft(F.col("n").cast("long"), 33) + F.col("at")).alias("row_ord"),
    )


def _plain(path: str, decode: bool = True) -> Column:
    """A path without its scheme; those of a scan are escaped once more than listed ones."""
    plain = F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
    return F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))) if decode else plain
