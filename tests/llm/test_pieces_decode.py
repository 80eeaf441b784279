"""Decoding where texts are encoded, a bounded number of ids at a time."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
import pytest

from windrow.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_ids_are_decoded_in_the_worker_that_made_them(docs):
    out = pieces.encode_documents(docs((1, "a text"), (2, None)), MODEL)
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.decoded for r in out.collect()} == {1: "a text", 2: ""}


@pytest.mark.parametrize("most", [1, 3, 1 << 18])
def test_decoding_a_few_ids_at_a_time(most, monkeypatch):
    monkeypatch.setattr(pieces, "DECODE_IDS", most)
    known = pieces.load_pieces(MODEL)
    texts = ["the cat sat", "", "x", "zwölf 日本 \n a", "", "end"]
    ids = [[i for w in pieces.words_of(t) for p in pieces.Encoder(known).fold(w) for i in
            memoryview(known.codes[p]).cast("i").tolist()] if t else [] for t in texts]
    assert pieces._decoded(pa.array(ids, pa.list_(pa.int32())), known.spelled).to_pylist() == texts
