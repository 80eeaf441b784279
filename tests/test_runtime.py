"""The shared folder: taken from the session, local only where the session is local."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from windrow.runtime import shared_dir, stage


def fake(path, master):
    known = {"spark.checkpoint.dir": path} if path else {}
    conf = SimpleNamespace(get=known.get)
    context = SimpleNamespace(master=master, applicationId=f"app-{master[:5]}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_dir():
    assert shared_dir(fake("hdfs://nn/ckpt/", "spark://host:7077")) == "hdfs://nn/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake(None, "spark://host:7077"))
    for own in ("file:///tmp/ckpt", "/tmp/ckpt", "file:/var/tmp/x"):
        with pytest.raises(RuntimeError, match="temporary"):
            shared_dir(fake(own, "yarn"))
        assert shared_dir(fake(own, "local[2]")) == own
    assert shared_dir(fake("file:///mnt/shared", "yarn")) == "file:///mnt/shared"
    local = fake(None, "local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_staging_keeps_rows_types_and_order_columns(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-03-08 02:30:00' AS t, 1.10BD AS m, NULL AS n, 'x' s")
    df = df.withColumn("n", df.n.cast("string"))
    staged = stage(df, "test")
    assert staged.dtypes == df.dtypes and staged.collect() == df.collect()
    assert stage(df.filter("s = 'none'"), "test").count() == 0
