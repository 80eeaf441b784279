"""Where lines meet: the same pairs in any table, and no more of them than go with the lines."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windrow.llm import line_hash, line_meet
from windrow.llm import lines as fuzzy
from windrow.llm.line_hash import LONGS, NAMES


def test_links_do_not_depend_on_other_lines(spark, docs):
    """Pairs of near lines, alone and beside 300,000 strangers."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    rows = []
    for i in range(300):
        words = [word() for _ in range(rng.choice([12, 20, 22, 40, 60]))]
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(len(words)), len(words) // 12):
            words[at] = words[at][:2] + word()[:2]
        rows.append((2 * i + 1, " ".join(words)))
    few = docs(*rows).select("doc_id", "text")
    line = F.concat_ws(" ", *[F.substring(F.sha2(F.concat("id", F.lit(f" {j}")), 256), 1, 9) for j in range(3)])
    others = spark.range(300_000).select(F.floor(F.col("id") / 500).alias("of"), line.alias("line")).groupBy("of").agg(
        F.concat_ws("\n", F.collect_list("line")).alias("text"))
    many = few.union(others.select((F.col("of") + 1000).alias("doc_id"), "text"))
    alone, beside = ({r.doc_id: set(r.dropped) for r in fuzzy.repeated_lines(d).collect() if r.doc_id < 1000} for d in (few, many))
    assert len(alone) > 250 and alone == beside


entry = st.tuples(st.integers(0, 3), st.integers(0, 40), st.integers(0, 7), st.integers(0, 3))


@settings(max_examples=150, deadline=None)
@given(st.lists(entry, min_size=1, max_size=60, unique_by=lambda x: x[:2]))
def test_told_pairs_by_all_pairs(some):
    """A node is told exactly if a near one meets it, and pairs across labels are all told."""
    # Hashes that are near if their numbers differ by no more than one.
    bits = lambda n: ((1 << 15 * n) - 1) & (2**63 - 1)
    rows = np.array(sorted((k, i, 0, bits(s % 4), label) for k, i, s, label in some), np.int64)
    near = lambda x, y: int(x[3] ^ y[3]).bit_count() <= line_meet.MAX_BITS
    met = [(x, y) for x in rows for y in rows if x[0] == y[0] and x[1] != y[1] and near(x, y)]
    told = line_meet.least_leaders(rows[:, :4])
    for x, other in zip(rows, told):
        mates = {y[1] for z, y in met if z[0] == x[0] and z[1] == x[1]}
        assert (other in mates | {x[1]}) if mates else other == line_meet.NONE
    several = [r for r in rows]
    pairs = {tuple(sorted(p)) for p in line_meet.near_across(np.array(several)).T.tolist()}
    assert pairs == {tuple(sorted((x[1], y[1]))) for x, y in met if x[4] != y[4]}


def test_near_copies_are_told_with_one_pair_each(spark):
    """2,000 near copies of a line: pairs go with the copies, not with their square."""
    rng = random.Random(2)
    words = [f"word{i}ly" for i in range(60)]
    texts = [" ".join([*words[:j], f"other{i}", *words[j + 1 :]]) for i in range(2000) for j in [rng.randrange(60)]]
    import pyarrow as pa

    batch = pa.record_batch([pa.array(range(2000)), pa.array(texts)], names=["doc_id", "text"])
    table = pa.Table.from_batches(line_hash.line_rows([batch])).to_pandas()
    nodes = spark.createDataFrame(table[["text_a", "chars", *NAMES[-LONGS:]]].rename(columns={"text_a": "id"}))
    fuzzy.bounded_batches(spark)
    keys = line_hash.key_blocks()[:10]
    for labels in (None, "id"):
        some = nodes if labels is None else nodes.withColumn("label", F.col("id"))
        pairs = line_meet.met(some, keys, 0, fuzzy.SIMILARITY, 2000).distinct().count()
        assert 1500 < pairs < 2 * 20 * 2000


whole = st.tuples(st.integers(0, 2), st.integers(0, 40), st.integers(0, 5), st.integers(0, 5), st.integers(1, 60), st.integers(0, 3))


@settings(max_examples=150, deadline=None)
@given(st.lists(whole, min_size=1, max_size=60, unique_by=lambda x: x[:2]))
def test_pairs_across_that_the_whole_hash_or_the_lengths_rule_out_are_not_told(some):
    bits = lambda n: ((1 << 12 * n) - 1) & (2**63 - 1)
    rows = np.array(sorted((k, i, 0, bits(s % 3), label, bits(t), bits(5 - t), n) for k, i, s, t, n, label in some), np.int64)

    def fits(x, y):
        apart = [int(x[c] ^ y[c]).bit_count() for c in (2, 3, 5, 6)]
        near = apart[1] <= line_meet.MAX_BITS and apart[0] + apart[1] <= line_meet.MAX_HALF
        return near and sum(apart) <= line_meet.MAX_APART and min(x[7], y[7]) >= 0.999 * 0.85 * max(x[7], y[7])

    told = {tuple(sorted(p)) for p in line_meet.near_across(rows, 0.85).T.tolist()}
    want = {tuple(sorted((x[1], y[1]))) for x in rows for y in rows if x[0] == y[0] and x[4] != y[4] and fits(x, y)}
    assert told == want
