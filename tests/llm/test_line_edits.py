"""The bound of the edit distance of lines, against the distance itself."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windrow.llm.line_edits import (
    GAP_CHARS,
    anchors,
    distance,
    gaps,
    is_within,
    least_edits,
    surely_within,
    within,
)

WORDS = st.lists(st.sampled_from("a bb ccc dd e ff ggg 京都 9".split()), max_size=12)
LINES = st.one_of(WORDS.map(" ".join), st.text("ab é", max_size=20))


def plain_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(LINES, LINES)
def test_distance_in_bits(a, b):
    assert distance(a, b) == plain_distance(a, b)


@settings(max_examples=300, deadline=None)
@given(LINES, LINES, st.integers(0, 20))
def test_gaps_cost_no_less_than_the_lines(a, b, most):
    cost = sum(distance(s, t) for s, t in gaps(a, b))
    assert cost >= plain_distance(a, b)
    if surely_within(a, b, most):
        assert plain_distance(a, b) <= most


@settings(max_examples=300, deadline=None)
@given(LINES, LINES, st.integers(0, 20))
def test_within_by_a_plain_version(a, b, most):
    assert least_edits(a, b) <= plain_distance(a, b)
    assert is_within(a, b, most) == (plain_distance(a, b) <= most)


def test_strangers_are_told_by_their_grams():
    a, b = ("".join(chr(97 + (i * i * k + i) % 23) for i in range(3000)) for k in (5, 7))
    assert least_edits(a, b) > 450


@given(WORDS, WORDS)
def test_anchors_rise_in_both(a, b):
    found = anchors(a, b)
    assert all(a[i] == b[j] and a.count(a[i]) == b.count(b[j]) == 1 for i, j in found)
    assert all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:]))


def test_changed_words_of_long_lines_are_shown():
    words = [f"word{i}" for i in range(2000)]
    other = [w if i % 20 else "x" for i, w in enumerate(words)]
    del other[500:510]
    assert surely_within(" ".join(words), " ".join(other), 1200)
    assert not surely_within(" ".join(words), " ".join(other), 100)


def test_long_gaps_are_left_open_rather_than_measured():
    a, b = "x" * (2 * GAP_CHARS), "x" * (2 * GAP_CHARS - 1)
    assert not surely_within(a, b, 10)


def test_odd_rows(spark):
    rows = [("a b", "a b", 0), ("", "", 0), ("", "abc", 2), ("a  b", "a b", 1), (None, "a", 1), ("a", "a", None)]
    frame = spark.createDataFrame(rows, "a string, b string, most int")
    got = [r[0] for r in frame.select(within("a", "b", "most")).collect()]
    assert got == [True, True, False, True, None, None]
    assert frame.limit(0).select(F.count(within("a", "b", "most"))).first()[0] == 0
