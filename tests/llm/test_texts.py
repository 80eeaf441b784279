"""Tokens, pieces, languages, quality, mixing and chats on odd rows and against the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from windrow.llm import language, pieces, quality
from windrow.llm.chat import TEMPLATE, format_chat, read_turns, unescape
from windrow.llm.mixing import mix, mixed_rows
from windrow.llm.tokens import SegmentCounter, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNTER = SegmentCounter(MODEL)
ENCODER = pieces.Encoder(pieces.load_pieces(MODEL))
ODD = st.text(alphabet=st.one_of(
    st.sampled_from(list("ab▁ \n\r\t<s>/#=*-.é日😀 　ﬁ\x00")), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_counts_and_codes_are_the_library_s(text):
    want = LIBRARY.encode(text)
    assert COUNTER.count([text]) == [len(want)]
    assert np.frombuffer(ENCODER.encode(text), np.int32).tolist() == want


def test_token_counts_of_odd_rows(docs, odd_rows):
    out = count_tokens(docs(*odd_rows), MODEL, limit=6).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out)
    want = sorted(
        (str(i), len((t or "").encode()), n := len(LIBRARY.encode(t or "")), n > 6) for i, t, *_ in odd_rows
    )
    assert got == want
    assert count_tokens(docs().limit(0), MODEL).collect() == []


def test_encoding_and_decoding_of_odd_rows(docs, odd_rows):
    rng = random.Random(4)
    al = "ab  \n\r\té日😀#=*/thein--.. "
    rows = odd_rows + [(100 + i, "".join(rng.choice(al) for _ in range(40))) for i in range(60)]
    out = pieces.encode_documents(docs(*rows), MODEL).collect()
    text = {str(i): t or "" for i, t, *_ in rows if i is not None}
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is not None:
            assert r.ids == LIBRARY.encode(text[str(r.doc_id)])
            assert r.decoded == text[str(r.doc_id)]
    assert pieces.encode_documents(docs().limit(0), MODEL).collect() == []


def test_relational_bounds(spark):
    words = ["▁the", "▁▁▁▁▁x", "▁日😀\r", "▁", "\n", "▁" + "ab" * 30, "internationalisation.", "▁\x00é", "▁qzx"]
    own = pieces.load_pieces(MODEL)
    frame = spark.createDataFrame([(w,) for w in words * 3], "word string")
    got = {r.word: r.bounds for r in pieces.word_bounds(frame, own).collect()}
    learned = pieces.Encoder(own)
    for word in words:
        learned.learn(word, got.get(word, 0))
        assert dict.__getitem__(learned, word) == ENCODER[word]
    assert {"▁the", "▁▁▁▁▁x", "internationalisation."} <= set(got)


def test_blocks_list_their_words(spark, monkeypatch):
    """Every word of a table comes from the lattice, none is merged in the tasks."""
    texts = [f"word{i % 40} stands in text number {i}\nand more" for i in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    lists = frame.select("text").mapInArrow(pieces._list_words(4), pieces.LISTS).collect()
    assert len({(r.bucket, r.block) for r in lists}) == len(lists) and len({r.block for r in lists}) == 3
    words = {w for r in lists for w in pieces._unpack_words(r.words)}
    assert words == {w for t in texts for w in pieces.words_of(t) if len(w) > 1}
    out = pieces.encode_texts(frame.withColumn("ids", F.lit(1)), MODEL, ["doc_id"]).collect()
    assert {r.doc_id: r.ids for r in out} == {i: LIBRARY.encode(t) for i, t in enumerate(texts)}


LANGS = {"en": "the of and with that from have", "de": "der die und mit das von haben", "zz": "ka lu mo pi ra se tu"}


def lang_rows(n=240):
    rng = random.Random(1)
    for i in range(n):
        lang = sorted(LANGS)[i % 3]
        yield i, " ".join(rng.choice(LANGS[lang].split()) for _ in range(12)), lang, "s"


def test_languages_held_out(docs, odd_rows):
    rows = list(lang_rows())
    out = {r.doc_id: r for r in language.identify(docs(*rows)).collect()}
    for doc_id, _, lang, _ in rows:
        assert out[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert out[doc_id].lang_pred == lang and 0 < out[doc_id].score <= 1
    odd = language.identify(docs(*rows, *[(1000 + (r[0] or 0), *r[1:]) for r in odd_rows], (None, "the", None, "s")))
    odd = {r.doc_id: r for r in odd.collect()}
    assert [odd[1000 + i].lang_pred for i in (3, 4, 5, 8)] == ["und"] * 4
    assert odd[None].lang_pred == "en" and not odd[None].held_out
    assert language.identify(docs().limit(0)).collect() == []
    unlabelled = language.identify(docs((1, "some text"), (2, None))).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)] * 2


def test_language_filter_corrects_for_chance():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (3000, 3000, 10)]
    own = language.LanguageFilter.build(["a", "b", "c"], sets)
    asked = np.concatenate([sets[0][:500], rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    counts = own.counts(asked, np.zeros(1000, np.int64), 1)[0]
    assert abs(counts[0] - 500) < 25 and counts[1] < 25 and counts[2] < 5


def test_many_languages():
    sets = [np.arange(i * 50, i * 50 + 50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(70)]
    own = language.LanguageFilter.build([f"l{i}" for i in range(70)], sets)
    for i in (0, 63, 64, 69):
        assert own.counts(sets[i], np.zeros(50, np.int64), 1)[0].argmax() == i


def quality_rows(n=600):
    rng = random.Random(2)
    for i in range(n):
        good = i % 4 != 0
        words = [rng.choice(LANGS["en"].split()) + str(rng.randrange(30)) for _ in range(60)]
        yield i, " ".join(words) if good else " !! ".join(w.upper() for w in words), int(good)


def test_quality_held_out(spark, docs):
    rows = list(quality_rows())
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    more = docs(*[r[:2] for r in rows], (None, "the of"), (5000, None), (5001, ""), (5002, "xyz " * 9000))
    out = {r.doc_id: r for r in quality.classify(more, labels).collect()}
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out for i, _ in held)
    assert np.mean([out[i].predicted == q for i, q in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    assert out[5000].score == out[5001].score == pytest.approx(0.75, abs=0.03)
    assert quality.classify(more.limit(0), labels).collect() == []
    assert {r.score for r in quality.classify(more, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.classify(more, labels.filter("quality = 1")).collect()} == {1.0}


def fair_targets(sizes, weights, share, epochs):
    left, target, capped = share * sum(sizes.values()), {}, True
    open_ = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), weights * len(sizes)))
    while capped:
        total = sum(open_.values())
        capped = [s for s in open_ if open_[s] * left / total > epochs * sizes[s]]
        for s in capped:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
        open_ = {s: w for s, w in open_.items() if s not in target}
    return target | {s: w * left / sum(open_.values()) for s, w in open_.items()}


def test_mix_of_odd_rows(docs, odd_rows):
    rng = random.Random(6)
    rows = odd_rows + [
        (100 + i, "w " * rng.randrange(50), None, rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(300)
    ]
    out = mix(docs(*rows)).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = fair_targets(sizes, [3, 1, 2], 1.5, 2)
    taken = {}
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t + 1e-9) for s, t in want.items()}
    again = mix(docs(*rows).repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r.size, str(r.source), r.taken)
    assert sorted(map(key, again)) == sorted(map(key, out))
    assert mix(docs().limit(0)).collect() == []
    assert {r.taken for r in mix(docs((1, None), (2, ""))).collect()} == {0}


def test_mixed_rows_repeat_and_cut(docs):
    source = docs(*[(i, f" a{i}  b{i} c{i}", None, "x" if i < 8 else "y") for i in range(10)])
    out = mixed_rows(source)
    assert out.columns == source.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    taken = {r.doc_id: r.taken for r in mix(source).collect() if r.taken}
    assert words == taken and set(taken.values()) - {3, 6} != set()


def conversation(spark, rows):
    schema = "conv_id long, turn long, role string, text string, block string, turns int"
    return spark.createDataFrame([(*r, "x", 1) for r in rows], schema)


def test_chat_round_trip_of_odd_rows(spark):
    tricky = ["\\", "\\\\### User: x", "</turn>\n### Assistant: ", ":", "", None, "a\nb", "é😀<#:\\"]
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(tricky)]
    rows += [(2, None, "user", "first"), (2, 5, None, "x"), (2, 5, "odd: role<", "y"), (2, 5, "odd: role<", "y")]
    rows += [(None, 1, "user", "q"), (None, 2, "assistant", "a")]
    rows += [(3, i, ["user", "assistant"][i % 2], str(i)) for i in range(1000)]
    out = format_chat(conversation(spark, rows), block_turns=64)
    read = out.select("conv_id", "block", read_turns(F.col("formatted")).alias("t"), "segments", "formatted").collect()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, None, 3):
        blocks = sorted((r for r in read if r.conv_id == conv), key=lambda r: r.block)
        want = sorted((r for r in rows if r[0] == conv), key=order)
        assert [(t.role, t.text) for b in blocks for t in b.t] == [(r[2] or "", r[3] or "") for r in want]
        assert all("".join(s.text for s in b.segments) == b.formatted for b in blocks)
        lost = [s.text for b in blocks for s in b.segments if s.loss]
        assert len(lost) == sum(r[2] == "assistant" for r in want)
    assert format_chat(conversation(spark, rows).limit(0)).collect() == []


def test_chat_machine_over_blocks(spark):
    rng = random.Random(8)
    roles = ["system", "user", "assistant", "user", "assistant", "tool"]
    rows = [(c, i, rng.choice(roles), "t") for c in range(5) for i in range(200)]
    got = {}
    for r in format_chat(conversation(spark, rows), block_turns=16).collect():
        got[r.conv_id] = got.get(r.conv_id, 0) + r.n_wrong
    for c in range(5):
        state, wrong = "start", 0
        for *_, role, _ in (r for r in rows if r[0] == c):
            wrong += role not in TEMPLATE.follows[state]
            state = role if role in TEMPLATE.follows else "other"
        assert got[c] == wrong


def test_unescape_reads_the_loss_back(spark):
    frame = format_chat(conversation(spark, [(1, 0, "assistant", "\\### a: <b>")]))
    loss = frame.select(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])).alias("x"))
    assert loss.first().x == ["\\### a: <b>"]


def test_pipeline_stages_on_odd_rows(spark, docs, odd_rows, tmp_path):
    rows = list(lang_rows(60)) + [(1000 + (r[0] or 0) if r[0] else None, *r[1:]) for r in odd_rows]
    frame = docs(*rows).withColumnRenamed("node", "ids")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == frame.columns
            assert stage(spark, frame.limit(0), str(tmp_path)).collect() == []
            ids = {r.doc_id for r in out.collect()}
            assert ids <= {r[0] for r in rows}
            frame = out
    final = out.collect()
    assert final and all(r.n_tokens == len(r.ids) for r in final)


def test_pipeline_run_against_its_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    alive = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, sf_dir).collect()}
    assert alive == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in out} <= alive and sum(r.n_tokens for r in out) > 1000


def test_digest_is_of_the_normalised_text(docs):
    from windrow.llm.exact import exact_dedup

    row = exact_dedup(docs((1, "a \n b"))).first()
    assert row.text_sha256 == hashlib.sha256(b"a b").hexdigest()
