"""Near and exact copies, lines and top-k against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from windrow.llm import line_hash
from windrow.llm import lines as fuzzy
from windrow.llm.line_hash import normalise
from windrow.llm.buckets import link_buckets
from windrow.llm.components import components
from windrow.llm.exact import exact_dedup
from windrow.llm.minhash import Shingler, near_duplicates
from windrow.llm import topk
from windrow.llm.topk import search_block, search_shard, top_k


def component_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected_components(rows):
    sets = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            sets[doc_id] = shingle_set(text)
    links = [
        (a, b)
        for (a, x), (b, y) in combinations(sets.items(), 2)
        if x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    return component_of(sets, links), sets


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(1000, i) for i in range(100, 140)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == component_of({n for p in links[:-1] for n in p}, links[:-1])


def test_near_duplicates_odd_rows(docs, odd_rows):
    out = near_duplicates(docs(*odd_rows)).collect()
    want, sets = expected_components(odd_rows)
    assert len(out) == len(odd_rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles) == (want[r.doc_id], len(sets[r.doc_id]))
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_empty_table(docs):
    assert near_duplicates(docs().limit(0)).collect() == []


def test_near_duplicates_of_a_group_with_a_spread_of_edits(docs):
    """Copies of one text with few to many edits, and texts that share a long passage."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(1000 - i, edited(rng, base, rng.randrange(0, 9))) for i in range(150)]
    passage = " ".join(f"p{i}" for i in range(80))
    rows += [(2000 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(40))) for i in range(60)]
    rows += [(3000 + i, edited(rng, base[:100], 4)) for i in range(20)]
    want, _ = expected_components(rows)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(*rows)).collect()}
    assert got == want


def test_shingler_counts_a_short_text_once():
    s = Shingler()
    assert [len(s.shingles(t)) for t in (None, "", " \n", "a", "a b c d", "a b c d e", "A b c d e f")] == [
        0, 0, 0, 1, 1, 1, 2]
    assert (s.shingles("A B c d e") == s.shingles("a b\tc\nd e")).all()


def test_exact_dedup_odd_rows(docs, odd_rows):
    out = exact_dedup(docs(*odd_rows), hot_rows=1).collect()
    groups = {}
    for doc_id, text, *_ in odd_rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    for r in out:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = [i for i in groups[text] if i is not None]
        assert r.keep_id == min(ids, default=None) and r.group_size == len(groups[text])
    assert sum(r.kept for r in out) == len(groups)
    assert len(out) == len(odd_rows)
    plain = exact_dedup(docs(*odd_rows)).collect()
    assert sorted(map(str, plain)) == sorted(map(str, out))
    assert exact_dedup(docs().limit(0)).collect() == []


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def expected_lines(rows):
    """Numbers of dropped lines per document, by the edit similarity of all pairs of lines."""
    places = {}
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            line = normalise(line)
            if doc_id is not None and line:
                places.setdefault(line, []).append((doc_id, n))
    links = [
        (min(places[a]), min(places[b]))
        for a, b in combinations(places, 2)
        if lev(a, b) <= int(round(1 - fuzzy.SIMILARITY, 6) * max(len(a), len(b)))
    ]
    firsts = component_of({min(p) for p in places.values()}, links)
    dropped = {}
    for found in places.values():
        for place in set(found):
            if place != firsts[min(found)]:
                dropped.setdefault(place[0], set()).add(place[1])
    return dropped, len(links)


def test_lines_against_all_pairs(docs):
    rng = random.Random(3)
    base = [" ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + j % 26)}x" for j in range(60)) for _ in range(3)]
    rows = []
    for i in range(40):
        words = base[i % 3].split(" ")
        words[rng.randrange(60)] += rng.choice(["", "", "s", "es"])
        rows.append((i, " ".join(words) + "\nshort line\n" + base[i % 2].upper() + "!\n\n" + str(i)))
    want, n_links = expected_lines(rows)
    assert n_links > 3
    got = {r.doc_id: set(r.dropped) for r in fuzzy.repeated_lines(docs(*rows)).collect()}
    assert got == want


def test_lines_with_changed_words_are_found(docs):
    """One word in twelve is another one, in lines of 12 to 60 words: nearly all are found, and
    nothing else."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    rows = []
    for i in range(60):
        words = [word() for _ in range(rng.choice([12, 20, 22, 40, 60]))]
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(len(words)), len(words) // 12):
            words[at] = words[at][:2] + word()[:2]
        rows.append((2 * i + 1, " ".join(words)))
    want, n_links = expected_lines(rows)
    assert n_links > 50
    got = {r.doc_id: set(r.dropped) for r in fuzzy.repeated_lines(docs(*rows)).collect()}
    assert all(want.get(i) == d for i, d in got.items()) and len(got) >= 0.9 * len(want)


def test_short_lines_and_lines_without_letters(docs):
    """Every line that is not blank takes part; digits and signs count."""
    chinese = "".join(chr(0x4E00 + 7 * i) for i in range(120))
    first = ["Terms of use", "12345 67890", "x" * 50, chinese, "Page 3", "}", "", "   "]
    again = ["terms  of use", "12345 67890", "X" * 50, chinese, "Page 4", "{", "", "   "]
    rows = [(1, "\n".join(first)), (2, "\n".join(again)), (3, "Page 4\n}\n99999 11111")]
    got = {r.doc_id: set(r.dropped) for r in fuzzy.repeated_lines(docs(*rows)).collect()}
    assert got == {2: {0, 1, 2, 3}, 3: {0, 1}}
    text = {r.doc_id: r.text for r in fuzzy.line_dedup(docs(*rows)).collect()}
    assert text[2] == "Page 4\n{\n\n   " and text[3] == "99999 11111"


def test_lines_of_odd_rows(docs, odd_rows):
    source = docs(*odd_rows)
    out = fuzzy.line_dedup(source)
    assert out.columns == source.columns
    texts = {}
    for r in out.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[1] == ["the cat sat on the mat today"] and texts[2] == ["", ""]
    assert texts[3] == [None] and texts[4] == [""] and texts[5] == [" \n\t "]
    assert texts[8] == ["12345 67890 --- !!!"]
    assert sorted(map(str, texts[None])) == ["None", "the cat sat on the mat today"]
    assert len(texts[6][0]) > 100_000 and texts[7] == [""]
    assert fuzzy.line_dedup(docs().limit(0)).collect() == []


def test_hashes_of_lines_by_a_plain_version():
    """Places, lengths and hashes do not depend on what stands beside a line, nor on chunks."""
    rng = random.Random(5)
    words = ["été", "a", "zwölf", "日本語", "the", "x" * 300, "1.5", "--"]
    texts = [
        "\n".join(" ".join(rng.choices(words, k=rng.choice([0, 1, 3, 400]))) + rng.choice(["", " \t"]) for _ in range(6))
        for _ in range(9)
    ]
    def told(some):
        batch = pa.record_batch([pa.array(range(len(some))), pa.array(some)], names=["doc_id", "text"])
        return [tuple(r.values()) for b in line_hash.line_rows([batch]) for r in b.to_pylist()]

    whole = told(texts)
    lines = [(i, n, " ".join(x.lower().split())) for i, t in enumerate(texts) for n, x in enumerate(t.split("\n")) if x.split()]
    assert [r[:2] for r in whole] == [x[:2] for x in lines]
    assert [r[4] for r in whole] == [len(x[2]) for x in lines]
    single = [told([x])[0][2:] for _, _, x in lines]
    assert [r[2:] for r in whole] == single
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(line_hash, "CHUNK_BYTES", 50)
        patch.setattr(line_hash, "CHUNK_WORDS", 7)
        assert told(texts) == whole
    assert len({r[2:4] for r in whole}) == len({x[2] for x in lines})


def test_bits_of_a_hash_are_those_of_most_words():
    rng = np.random.default_rng(1)
    words, lengths = rng.integers(0, 1 << 64, 3000, dtype=np.uint64), np.array([1, 255, 256, 1488, 1000])
    got, at = line_hash.simhashes(words, lengths), 0
    for row, n in zip(got, lengths):
        wide = line_hash.mixed(words[at : at + n, None] * line_hash._odd[None, 2:])
        counts = np.unpackbits(wide.view(np.uint8), axis=1).astype(int).sum(axis=0)
        assert (row == np.packbits(2 * counts > n).view(np.int64)).all()
        at += n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 60)), max_size=120), st.integers(1, 40))
def test_buckets_over_batches(rows, size):
    """Small buckets give all their pairs, large ones their members, however they are cut."""
    rows = sorted((k, i, 0) for k, i in set(rows))
    parts = [rows[lo : lo + size] for lo in range(0, len(rows), size)]
    batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*p)], names=["key", "id", "sim"]) for p in parts]
    out = [tuple(r.values()) for b in fuzzy.bucket_rows(iter(batches)) for r in b.to_pylist()]
    by_key = {k: [i for q, i, _ in rows if q == k] for k, *_ in rows}
    want = []
    for k, ids in by_key.items():
        want += combinations(ids, 2) if len(ids) <= fuzzy.SMALL_BUCKET else [(k, i) for i in ids]
    assert sorted((a, b) if k is None else (k, a) for k, a, b in out) == sorted(want)


def test_bucket_rounds_lose_no_link(spark):
    """A large bucket in which links form chains that no hub sees."""
    members = [(1, i, 0) for i in range(40)]
    links = {(i, i + 7) for i in range(33)}

    def links_of(pairs):
        rows = [(a, b) for a, b in pairs.collect() if (min(a, b), max(a, b)) in links]
        return spark.createDataFrame(rows, "a long, b long")

    def across(m):
        x, y = (m.select("key", m.node.alias(n), m.label.alias("l" + n)) for n in "ab")
        return x.join(y, "key").filter("la < lb").select("a", "b")

    frame = spark.createDataFrame(members, "key long, node long, degree long")
    got = dict(link_buckets(frame, links_of, across, 2).collect())
    want = component_of(range(40), links)
    assert {n: got.get(n, n) for n in range(40)} == want


def expected_top(vectors, k, every):
    rows = {(i, tuple(int(np.floor(256.0 * float(x))) for x in v)) for i, v in vectors
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q, a in rows:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_top_k_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(40)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 40) for i in range(8)]  # ties
    rows += [(i, rows[i][1]) for i in (0, 1, 2)]  # repeated rows
    rows += [(300, None), (301, [None, 1.0]), (302, [float("nan")]), (303, [float("inf")]), (None, [1.0]),
             (310, []), (311, [0.25, -0.25]), (320, [1e12] * 40)]
    frame = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<double>, ids string, rows int, block int")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame, query_every=10).collect()}
    assert got == expected_top(rows, 5, 10)
    assert top_k(frame.limit(0)).collect() == []


def test_top_k_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = random.Random(4)
    # Copies under many ids, and one id that holds a third of the rows.
    copy = [rng.uniform(-1, 1) for _ in range(24)]
    rows = [(i, [rng.uniform(-1, 1) for _ in range(24)]) for i in range(200)]
    rows += [(1000 + i, copy) for i in range(60)]
    rows += [(5000, [rng.uniform(-1, 1) for _ in range(24)]) for _ in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {(r.query_id, r.vec_id, r.score) for r in top_k(frame, query_every=20).collect()}
    numbers = {(i, tuple(int(np.floor(256.0 * x)) for x in v)) for i, v in rows}
    for q, v in ((i, v) for i, v in numbers if i % 20 == 0 and i != 5000):
        order = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, w in numbers if i != q)[:5]
        assert sorted((-s, i) for a, i, s in got if a == q) == order
    assert {q for q, _, _ in got} == {i for i, _ in numbers if i % 20 == 0}


def test_each_candidate_moves_once(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 32)
    rows = spark.range(400).selectExpr("id AS vec_id", "transform(sequence(1, 8), x -> x * id % 97) AS vector")
    met, n_shards = topk.meetings(rows, 50)
    assert n_shards > 4
    met = met.cache()
    moved = met.filter("NOT asks").selectExpr("sum(length(ids)) AS ids", "sum(length(matrix)) AS bytes").first()
    assert (moved.ids, moved.bytes) == (400 * 8, 400 * 8 * 2)
    assert met.filter("NOT asks").select("shard").distinct().count() == n_shards
    asks = met.filter("asks").selectExpr("sum(length(ids)) AS ids").first()
    assert asks.ids == 8 * 8 * n_shards
    met.unpersist()


def test_search_shard_carries_its_floor():
    rng = np.random.default_rng(8)
    q = rng.integers(-200, 200, (40, 9))
    slices = [(rng.permutation(90) + 100 * n, rng.integers(-200, 200, (40, 90))) for n in range(4)]
    ids, every = np.concatenate([i for i, _ in slices]), np.concatenate([c for _, c in slices], axis=1)
    got = list(search_shard(np.arange(1000, 1009), q, slices, 5))
    assert got == list(search_block(np.arange(1000, 1009), q, ids, every, 5))


def test_search_block_prunes_without_loss():
    rng = np.random.default_rng(7)
    c, q = rng.integers(-200, 200, (64, 500)), rng.integers(-200, 200, (64, 20))
    ids = rng.permutation(500)
    got = list(search_block(np.arange(1000, 1020), q, ids, c, 5))
    want = []
    for i, scores in enumerate(q.T @ c):
        order = sorted(range(500), key=lambda j: (-scores[j], ids[j]))[:5]
        want += [(1000 + i, int(ids[j]), int(scores[j])) for j in order]
    assert got == want
