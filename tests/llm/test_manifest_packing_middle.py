"""op11, op12 and op13: odd rows, against plain versions; op12 on the whole smallest table."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.test_llm_queries import SF_DIR
from windrow.llm import queries as llm
from windrow.llm.manifest import merkle_manifest
from windrow.llm.middle import Frames, compress, decompress, fill_in_middle
from windrow.llm.packing import CAPACITY, Pool, SegmentEncoder, closest, pack


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    told = [row[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))


def climb(nodes):
    """The root of some nodes and the siblings of each, bottom up."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            lo = place - place % 16
            proofs[i] += [*nodes[lo:place], *nodes[place + 1 : lo + 16]]
            at[i] = place // 16
        nodes = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], proofs


def plain_manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for source in order:
        own = sorted(by_source[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        inner[source] = (own, *climb([leaf_of(r) for r in own]))
    root, tops = climb([inner[s][1] for s in order])
    out = []
    for source, top in zip(order, tops):
        own, subroot, proofs = inner[source]
        out += [(r["doc_id"], leaf_of(r), subroot, root, h("".join([*p, *top]))) for r, p in zip(own, proofs)]
    return sorted(out, key=str)


def manifest(docs):
    return merkle_manifest(docs).collect()


def told(rows):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in rows), key=str)


def test_odd_rows_make_the_same_manifest(docs, odd_rows):
    frame = docs(*odd_rows)
    got = manifest(frame)
    assert told(got) == plain_manifest([r.asDict() for r in frame.collect()])
    for r in got:
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        text = {i[0]: i[1] for i in odd_rows}.get(r.doc_id) or ""
        assert r.verified == (not changed or text == text.lower())
        assert r.verified == (r.folded_root == r.root)


@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (257, 1, 2), (4097, 20), (1,) * 18])
def test_trees_of_any_height(docs, sizes):
    rows = [(100 * i + 7 * n, f"Text {i}", "en", f"s{n}") for n, size in enumerate(sizes) for i in range(size)]
    frame = docs(*rows)
    got = manifest(frame)
    assert told(got) == plain_manifest([r.asDict() for r in frame.collect()])
    hit = [zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got]
    assert [r.verified for r in got] == [not x for x in hit]


def test_empty_tables(docs):
    import public_tokenizers

    empty = docs((1, "x")).limit(0)
    assert manifest(empty) == []
    assert fill_in_middle(empty).collect() == []
    assert pack(empty, public_tokenizers.path("byte_bpe_50k.json")).collect() == []


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers

    return SegmentEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(pieces, ids_of):
    """``ids_of``: the ids of every document, as often as it is there."""
    documents, sequences = {}, {}
    for p in pieces:
        documents.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    assert {i: sum(p.length for p in ps) for i, ps in documents.items()} == {
        i: sum(map(len, all_ids)) for i, all_ids in ids_of.items()
    }
    for doc_id, ps in documents.items():
        if len(ids_of[doc_id]) > 1:
            continue
        at, ids = 0, np.array(ids_of[doc_id][0], "<u4")
        for p in sorted(ps, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
    padding = 0
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= CAPACITY
        padding += CAPACITY - at if at & (at - 1) else 0
    return padding, sum(p.length for p in pieces)


def test_packing_of_the_table(spark, library):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    ids = {r.doc_id: [[*library.encode(r.text or "", add_special_tokens=False).ids, 1]] for r in rows}
    padding, total = check_pieces(llm.QUERIES["op12_packing"](spark, SF_DIR).collect(), ids)
    assert padding == 0 and total == sum(len(x[0]) for x in ids.values())


def test_packing_of_odd_rows(docs, odd_rows, library):
    import public_tokenizers

    ids = {}
    for doc_id, text, *_ in odd_rows:
        ids.setdefault(doc_id, []).append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    got = pack(docs(*odd_rows).repartition(3), public_tokenizers.path("byte_bpe_50k.json"))
    padding, _ = check_pieces(got.withColumn("ids_crc32", F.crc32("ids")).collect(), ids)
    assert padding == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB9é日'.! \n\t\r\x1c\x1f\x85\xa0 　") | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_segments_do_not_change_ids(library, encoder, text):
    for t in (text, f"a<|endoftext|> {text}<|endoftext|>\n{text}"):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([t])[0], "<u4").tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 5), max_size=6), st.integers(0, 60))
def test_closest_sum_by_brute_force(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    best, chosen = closest(counts, sorted(counts), room)
    assert best == max(s for s in sums if s <= room)
    assert best == sum(length * n for length, n in chosen)
    assert all(n <= counts[length] for length, n in chosen)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=60), st.integers(1, 3))
def test_every_rest_is_packed_once(lengths, rounds):
    pool, found = Pool(64), []
    for i, length in enumerate(lengths):
        pool.put(i, 0, length)
        if i % (10 * rounds) == 9:
            found += pool.sequences(last=False)
    found += pool.sequences(last=True)
    sizes = [sum(p[2] for p in s) for s in found]
    assert all(n == 64 or n & (n - 1) == 0 for n in sizes) and sum(n < 64 for n in sizes) <= 6
    for i, length in enumerate(lengths):
        spans = sorted((s, n) for q in found for o, s, n in q if o == i)
        assert sum(n for _, n in spans) == length
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]


def plain_middle(doc_id, text, frame_rate=100):
    import re

    digest = h(f"7:{'' if doc_id is None else doc_id}")
    hs = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((hs[0] % (n + 1), hs[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if hs[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("frame_bytes", [3, 64, 64 << 10])
def test_middles_of_odd_rows(docs, odd_rows, frame_bytes):
    rows = [r if len(r[1] or "") < 1000 or frame_bytes > 3 else (r[0], r[1][:500]) for r in odd_rows]
    rows += [(20 + i, t) for i, t in enumerate(
        ["<S> is here", "a\nb<", "P>\n<P", "\n", "\n\n\n", "é\n日本\n\nend", "one\r\ntwo\n" * 40, "<" * 9 + "\n<P\n<"]
    )]
    got = fill_in_middle(docs(*rows), frame_bytes=frame_bytes).collect()
    assert len(got) == len(rows)
    want = sorted((plain_middle(r[0], r[1] or "") + (r[0], r[1] or "") for r in rows), key=str)
    have = []
    for r in got:
        output = b"".join(decompress(f) for f in r.output).decode()
        assert r.output_sha256 == h(output)
        have.append((r.n, r.form, r.prefix_chars, r.middle_chars, output, r.doc_id))
    assert sorted(have, key=str) == sorted((w[:6] for w in want), key=str)
    assert sorted(r.restored_sha256 for r in got) == sorted(h(w[6]) for w in want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("<PSM>ab\n", max_size=7), max_size=8))
def test_marks_are_found_over_frames(parts):
    text = "".join(parts).encode()
    frames, at, want = Frames([compress(p.encode()) for p in parts if p]), 0, []
    for mark in (b"<P>", b"<S>", b"<M>"):
        at = text.find(mark, at)
        if at < 0:
            break
        want.append(at)
        at += 3
    assert frames.find((b"<P>", b"<S>", b"<M>")) == want
