"""Session-level helpers: shared scratch space, staging and size-checked broadcasts."""

from __future__ import annotations

import math
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The most rows a side may have to be broadcast.  A window, status or bounds row
# is some 200 bytes, so this keeps a broadcast near 20 MB.
MAX_BROADCAST_ROWS = 100_000


def salts(spark: SparkSession) -> int:
    """Tasks one key is spread over when its small side cannot be broadcast.

    It grows with the size the session is set up for, slower than the shuffle does, as the
    small side is repeated for each.
    """
    return max(2, 4 * math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def local_session(name: str, cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "16g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for code that runs there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="windrow-code-"), "windrow")
    where, name = os.path.split(package)
    context.addPyFile(shutil.make_archive(target, "zip", where, name))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if path and not local and _is_own_temp(spark, path):
        raise RuntimeError(f"spark.checkpoint.dir is a temporary folder of each machine: {path}")
    if path:
        return path.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    return _local_dir(spark.sparkContext.applicationId)


def _is_own_temp(spark: SparkSession, path: str) -> bool:
    """Whether a folder is a temporary one of each machine, as far as its name tells."""
    parts = urlparse(path)
    scheme = parts.scheme or urlparse(spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")).scheme
    folder = os.path.normpath(parts.path)
    return scheme == "file" and any(
        os.path.commonpath([folder, t]) == t for t in ("/tmp", "/var/tmp", tempfile.gettempdir())
    )


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"windrow-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/windrow/{label}-{uuid.uuid4().hex}"


# Spark deletes the shuffle files of a query when it ends, not when the driver happens to
# collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders staged in the blocks of ``staging`` that are open, innermost last.
_OPEN: list[list[str]] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage durably, so a lost executor does not rerun the scan, and fixes
    the values of non-deterministic columns for every later reader.  Inside of a ``staging``
    block the data goes with the block.
    """
    return _staged(df, label, _OPEN[-1] if _OPEN else None)


def _staged(df: DataFrame, label: str, scope: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if scope is not None:
        scope.append(path)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A block after which all data staged in it is deleted, also if it fails.

    It yields the function that stages what outlives the block; that belongs to the block
    around it, if there is one.
    """
    outer = _OPEN[-1] if _OPEN else None
    own: list[str] = []
    _OPEN.append(own)
    try:
        yield lambda df, label: _staged(df, label, outer)
    finally:
        _OPEN.pop()
        delete_folders(spark, own)


def discard(df: DataFrame) -> None:
    """Delete what a staged frame reads, once nothing else will read it."""
    folders = {os.path.dirname(f) for f in df.inputFiles()}
    home = f"{urlparse(shared_dir(df.sparkSession)).path}/windrow/"
    delete_folders(df.sparkSession, [f for f in folders if urlparse(f).path.startswith(home)])


def delete_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete folders of any file system, many at once; absent ones are no error."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    def delete(folder: str) -> None:
        path = hadoop.Path(folder)
        path.getFileSystem(conf).delete(path, True)

    if len(folders) == 1:
        delete(folders[0])
    elif folders:
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(delete, folders))


def within_broadcast(rows_bound: int | None) -> bool:
    return rows_bound is not None and rows_bound <= MAX_BROADCAST_ROWS


def counted_bound(df: DataFrame) -> int:
    """The row count of a small aggregate, counted no further than it matters."""
    return df.limit(MAX_BROADCAST_ROWS + 1).count()


def join_small(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str, rows_bound: int | None
) -> DataFrame:
    """Join a large frame with one that has few rows per key, such as windows.

    Within the broadcast bound the large side is not moved at all.  Beyond it, or
    with no bound known, both sides are shuffled with a salt: a third of the rows
    may share one key, so each key is spread over several tasks and the small
    side is repeated for each.  The salt decides only where a row goes, never
    whether it matches.
    """
    if within_broadcast(rows_bound):
        return big.join(F.broadcast(small), list(on), how)
    n = salts(big.sparkSession)
    salted = big.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(n)))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def hot_keys(
    rows: DataFrame, group: Sequence[str], at_least: int, max_keys: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Keys with so many rows that they must be split, always few enough to broadcast.

    Of N rows, fewer than ``max_keys`` keys can hold more than N / max_keys rows
    each, so the threshold is raised to that where ``at_least`` is lower.
    """
    total = rows.select(F.count("*").alias("n")).scalar()
    threshold = F.greatest(F.lit(at_least), F.ceil(total / F.lit(max_keys)))
    counts = rows.groupBy(*group).agg(F.count("*").alias("_n"))
    return counts.filter(F.col("_n") > threshold).drop("_n")
