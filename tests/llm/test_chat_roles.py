"""Roles that are spelled like names of the template, and what the machine decides."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from windrow.llm.chat import ChatTemplate, format_chat, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string, block string"


def test_roles_like_names_are_read_back(spark):
    roles = ["User", "user", "\\rUser", "System", "Assistant", "assistant", "", "r", "\\", "to#ol:<x"]
    rows = [(1, i, role, f"text {i} \\r# {role}", "x") for i, role in enumerate(roles)]
    out = format_chat(spark.createDataFrame(rows, SCHEMA), block_turns=4)
    told = out.select("block", F.explode(read_turns(F.col("formatted"))).alias("t")).orderBy("block").collect()
    assert sorted((r.t.role, r.t.text) for r in told) == sorted((r[2], r[3]) for r in rows)
    under = [unescape(F.col("s.text")).alias("t")]
    loss = out.select(F.explode("segments").alias("s")).filter("s.loss").select(*under).collect()
    assert [r.t for r in loss] == ["text 5 \\r# assistant"]


def test_turns_out_of_order_are_counted(spark):
    orders = {1: "su", 2: "sua", 3: "uaua", 4: "a", 5: "uu", 6: "ssu", 7: "uxua", 8: "x"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(c, i, names[r], "t", "x") for c, order in orders.items() for i, r in enumerate(order)]
    out = format_chat(spark.createDataFrame(rows, SCHEMA), block_turns=2)
    got = {r.conv_id: r.n for r in out.groupBy("conv_id").agg(F.sum("n_wrong").alias("n")).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1}


def test_a_trained_role_needs_a_state():
    with pytest.raises(ValueError):
        ChatTemplate(trained=("tool",))
