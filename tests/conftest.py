from __future__ import annotations

import datetime as dt
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from windrow.runtime import local_session
from windrow.spec import EVENT_COLUMNS

# One plain report row: headers are the report's, values are made up here, numbered by place.
BASE_ROW = {
    header: {"event_time": "2023-03-04 17:42:11", "install_time": "2023-02-27 06:15:09",
             "attributed_touch_time": "2023-02-27 05:58:40", "event_revenue": "12.5"}.get(
        column, f"{column} {place}"
    )
    for place, (header, column) in enumerate(EVENT_COLUMNS.items())
} | {"Is Primary Attribution": "yes", "Region": "north"}

WINDOW = {
    "app_id": "app1",
    "attribution_type": "non_organic",
    "start_date": dt.date(2023, 3, 4),
    "end_date": dt.date(2023, 3, 4),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        4,
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def stages_compiled_for_queries_only(request, spark):
    """Tiny inputs: compiling stages costs more than running them, except for the queries,
    which run as they do in production."""
    compiled = "queries" in request.node.nodeid
    spark.conf.set("spark.sql.codegen.wholeStage", str(compiled).lower())


@pytest.fixture
def name():
    """A table name of its own for each test."""
    return f"t_{uuid.uuid4().hex[:12]}"


@pytest.fixture
def report(spark):
    """Build a raw report frame from overrides of the base row."""

    def build(*rows, window=None, drop=()):
        tags = {**WINDOW, **(window or {})}
        headers = [h for h in BASE_ROW if h not in drop]
        data = [
            tuple({**BASE_ROW, **row}[h] for h in headers) + tuple(tags.values()) + (i,)
            for i, row in enumerate(rows)
        ]
        schema = ", ".join(f"`{h}` string" for h in headers) + (
            ", app_id string, attribution_type string, start_date date, end_date date,"
            " row_ord long"
        )
        return spark.createDataFrame(data, schema)

    return build


def csv_text(*rows, headers=None, bom=False):
    headers = headers or list(BASE_ROW)
    quote = lambda v: '"' + v.replace('"', '""') + '"' if set(v) & set(',"\n') else v
    lines = [",".join(headers)]
    lines += [",".join(quote({**BASE_ROW, **row}[h]) for h in headers) for row in rows]
    return ("﻿" if bom else "") + "\n".join(lines) + "\n"


def put_report(root, app, kind, start, end, body, file="report.csv"):
    folder = root / f"app_id={app}" / f"attribution_type={kind}"
    folder = folder / f"start_date={start}" / f"end_date={end}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_bytes(body.encode() if isinstance(body, str) else body)


def event(**changes):
    """One typed table row as a dict, with optional fields NULL."""
    row = dict.fromkeys([*EVENT_COLUMNS.values(), "attribution_type", "app_id"])
    row |= {
        "event_time": dt.datetime(2020, 1, 1, 12),
        "event_name": "spend",
        "device_id": "tablet seven",
        "attribution_type": "non_organic",
        "app_id": "app1",
    }
    return {**row, **changes}
