"""Words as arrays: cut, coded and decoded as one by one, and nothing left on the disk for them."""

from __future__ import annotations

import os
import random
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece

from windrow import runtime
from windrow.llm import pieces, word_arrays

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _texts(n):
    rng = random.Random(3)
    letters = list("abth▁▁  \n\r\t<s>é日😀　ﬁ\x00")
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)] + [None, "", " ", "\n", "▁"]


def test_words_are_cut_as_one_by_one():
    texts = _texts(500)
    words, before = word_arrays.cut_words(pa.array(["not read", *texts]).slice(1))
    words = [w.replace(" ", word_arrays.MARK) for w in words.to_pylist()]
    assert [words[i:j] for i, j in zip(before, before[1:])] == [pieces.words_of(t) if t else [] for t in texts]
    assert word_arrays.cut_words(pa.array([], pa.string()))[1].tolist() == [0]


def test_pieces_of_words_by_their_boundaries():
    words = word_arrays.unpacked("▁añb\nxy\n▁▁日c".encode())
    assert words.to_pylist() == [" añb", "xy", "  日c"]
    parts, counts = word_arrays.parts_of(words, np.array([0b10101, 0, 0b11011]))
    assert parts.to_pylist() == [" a", "ñb", "x", "y", " ", "  日"[1:], "c"] and counts.tolist() == [2, 2, 3]


def test_a_block_without_lists_and_words_that_no_list_has(monkeypatch):
    """Lists that another order of rows made do not change the ids."""
    texts = ["the cat sat " + "x" * 70, None, "zwölf 日本\n\n▁a"]
    rows = pa.record_batch({"kept": pa.array([{"i": i} for i in range(3)]), "text": pa.array(texts)})
    monkeypatch.setattr(pieces, "_blocks", lambda batches: ((b, np.zeros(b.num_rows, np.int64)) for b in batches))
    packed = [(r["block"], None, None, r["rows"]) for out in pieces._pack_texts([rows]) for r in out.to_pylist()]
    lists = [(0, "▁other\n▁cat".encode(), np.array([0, 0b10011], np.int64).tobytes(), None)]
    for some in ([], lists):
        some = [(b, pieces._compressed(w), pieces._compressed(a), None) for b, w, a, _ in some]
        batch = pa.Table.from_pylist(
            [dict(zip(("block", "words", "bounds", "rows"), r)) for r in some + packed],
            pa.schema({"block": pa.int64(), "words": pa.binary(), "bounds": pa.binary(), "rows": pa.binary()}),
        ).to_batches()
        (out,) = pieces._block_encoder(MODEL, True)(iter(batch))
        assert [r["decoded"] for r in out.to_pylist()] == [(t or "").replace("▁", " ") for t in texts]
        if not some:
            assert out.column("ids").to_pylist() == [LIBRARY.encode(t or "") for t in texts]


def test_what_answers_were_made_of_is_deleted_before_texts_move(docs):
    spark = docs((1, "a")).sparkSession
    home = urlparse(f"{runtime.shared_dir(spark)}/windrow").path
    before = set(os.listdir(home)) if os.path.isdir(home) else set()
    out = pieces.encode_documents(docs((1, "a text"), (2, None)), MODEL)
    assert {name.split("-")[0] for name in set(os.listdir(home)) - before} == {"answers"}
    assert {r.doc_id: r.ids for r in out.collect()} == {1: LIBRARY.encode("a text"), 2: []}
