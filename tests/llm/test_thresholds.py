"""near_duplicates at other thresholds than the query's."""

from __future__ import annotations

import random

import pytest

from tests.llm.test_pairs_and_copies import component_of, shingle_set
from windrow.llm.minhash import banding, least_agreeing, near_duplicates


def test_bands_and_agreement_follow_the_threshold():
    assert banding(0.75) == (6, 56) and least_agreeing(75, 256) == 150
    for threshold in (0.3, 0.5, 0.6, 0.7):
        rows, bands = banding(threshold)
        assert (1 - threshold**rows) ** bands <= 2e-5
    with pytest.raises(ValueError):
        banding(0)


def test_pairs_at_a_threshold_of_one_half_are_found(docs):
    rng = random.Random(4)
    rows, links = [], []
    for i in range(30):
        words = [f"w{i}x{j}" for j in range(150)]
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(150), 8):
            words[at] = f"n{i}x{at}"
        rows.append((2 * i + 1, " ".join(words)))
        a, b = (shingle_set(text) for _, text in rows[-2:])
        if 2 * len(a & b) >= len(a | b):
            links.append((2 * i, 2 * i + 1))
    assert len(links) > 15
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(*rows), threshold=0.5).collect()}
    assert got == component_of(range(60), links)
