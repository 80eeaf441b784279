"""Distances of many pairs at once, and lines that are listed once, against plain versions."""

from __future__ import annotations

import random
from time import process_time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from windrow.llm import components, line_edits, line_hash, line_places
from windrow.llm.line_distance import banded, distances, groups

TEXT = st.text("abé京 ", min_size=1, max_size=200)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT, st.integers(0, 210)), min_size=1, max_size=12))
def test_distances_within_a_band(rows):
    true = [line_edits.distance(a, b) for a, b, _ in rows]
    many = distances([r[:2] for r in rows], [r[2] for r in rows])
    for told in (many, [banded(*r) for r in rows]):
        assert all(x == t if t <= most else x > most for x, t, (_, _, most) in zip(told, true, rows))
    lengths = np.array([(*sorted((len(a), len(b))), most) for a, b, most in rows])
    assert sorted(np.concatenate(groups(lengths)).tolist()) == list(range(len(rows)))


def _shifted(rng: random.Random) -> tuple[str, str, int]:
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(150)]
    other = words[25:] + ["".join(rng.choices("abcdefgh", k=5)) for _ in range(25)]
    a, b = " ".join(words), " ".join(other)
    return a, b, int(0.15 * max(len(a), len(b)))


def test_lines_that_only_the_distance_tells_apart_are_measured_together(monkeypatch):
    """400 pairs that bounds leave open, and that are more than the edits asked for apart: a small
    part of the time that measuring them one by one takes."""
    rows = [_shifted(random.Random(i)) for i in range(400)]
    began = process_time()
    one_by_one = [line_edits.is_within(*r) for r in rows[:40]]
    single = (process_time() - began) / 40
    began = process_time()
    told = line_edits.all_within(rows)
    assert (process_time() - began) / 400 < single / 2
    assert told[:40] == one_by_one and not any(told)
    monkeypatch.setattr(line_edits, "LONG_CHARS", 0)
    assert line_edits.all_within([*rows[:8], (None, "a", 1), ("", "", 0), ("", "ab", 1)]) == [*told[:8], None, True, False]


def test_equal_lines_have_one_first_place():
    rng = random.Random(4)
    texts = ["\n".join(rng.choice(["A b", "a  B", "", "c d e", "x", "y\tz"]) for _ in range(9)) for _ in range(40)]
    docs = [(i // 2 * 7 % 40, t) for i, t in enumerate(texts)]  # some ids stand there twice
    batch = pa.record_batch([pa.array([i for i, _ in docs]), pa.array(texts)], names=["doc_id", "text"])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(line_places, "DEAL_LINES", 50)
        dealt = pa.Table.from_batches(line_places.deal_lines(iter([batch.slice(0, 17), batch.slice(17)]))).sort_by("part")
    out = pa.Table.from_batches(line_places.find_first(iter(dealt.to_batches(max_chunksize=3))))
    places = {}
    for i, text in docs:
        for n, line in enumerate(text.split("\n")):
            if line_hash.normalise(line):
                places.setdefault(line_hash.normalise(line), set()).add((i, n))
    rows = out.select(["id", "doc_id", "line_no", "first"]).to_pylist()
    got = {}
    for r in rows:
        got.setdefault(r["id"], []).append((r["doc_id"], r["line_no"], r["first"]))
    want = [sorted((*p, p == min(found)) for p in found) for found in places.values()]
    assert sorted(map(sorted, got.values())) == sorted(want)
    packed = b"".join(p for p in out["packed"].to_pylist() if p)
    firsts = np.frombuffer(packed, np.int64).reshape(-1, 2 + line_hash.LONGS)
    assert sorted(firsts[:, 0].tolist()) == sorted(got)


def test_words_of_any_length_have_hashes_of_their_own():
    """Bytes beside a word do not count, at any length of it."""
    words = ["x" * n for n in (*range(1, 20), 63, 64, 65, 4096, 4097, 9000)] + ["x" * 9 + "y", "y" + "x" * 9]
    alone = [line_hash.line_hashes(w.encode()) for w in words]
    beside = line_hash.line_hashes("\n".join(words).encode())
    assert [a[1][0] for a in alone] == beside[1].tolist() and len(set(beside[1].tolist())) == len(words)
    assert [a[3][0] for a in alone] == beside[3].tolist() == [len(w) for w in words]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-30, 30), st.integers(-30, 30)).filter(lambda x: x[0] > x[1]), max_size=40), st.integers(1, 9))
def test_components_of_few_links_in_one_task(links, size):
    batches = [
        pa.record_batch([pa.array(c, pa.int64()) for c in zip(*links[lo : lo + size])], names=["u", "v"])
        for lo in range(0, len(links), size)
    ]
    got = [r for b in components.labels_of(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
    want = {n: n for link in links for n in link}
    for _ in links:
        for u, v in links:
            want[u] = want[v] = min(want[u], want[v])
    assert sorted(got) == sorted(want.items())


def test_components_of_few_and_many_links_are_the_same(spark, monkeypatch):
    rng = random.Random(7)
    links = spark.createDataFrame([(rng.randrange(400), rng.randrange(400)) for _ in range(260)], "a long, b long")
    few = sorted(components.components(links).collect())
    monkeypatch.setattr(components, "FEW_LINKS", 0)
    assert few == sorted(components.components(links).collect()) and len(few) > 200
