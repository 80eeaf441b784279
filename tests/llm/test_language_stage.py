"""The pipeline's language stage rejects what the filter could not decide."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.test_texts import lang_rows


def test_a_script_nobody_learned_goes(spark, docs):
    rows = list(lang_rows(60))
    unknown = "".join(chr(0x4E00 + 7 * i) for i in range(200))
    frame = docs(*rows, (9001, unknown, None, "a"), (9002, rows[0][1], None, "a"))
    alive = {r.doc_id for r in corpus_pipeline.identify_language(spark, frame, "").collect()}
    assert 9001 not in alive and 9002 in alive


def test_n_grams_of_a_batch_are_counted_a_slice_at_a_time(monkeypatch):
    import pyarrow as pa

    from windrow.llm import language

    texts = [f"word{i % 7} and others {i}" for i in range(400)]
    batch = pa.record_batch({"lang": pa.array(["a", "b"] * 200), "text": pa.array(texts)})
    sizes, whole = [], language.grams
    count = lambda: [(r["lang"], r["gram"], r["n"]) for o in language._count_grams([batch]) for r in o.to_pylist()]
    monkeypatch.setattr(language, "SLICE_BYTES", 1 << 30)
    want = count()
    monkeypatch.setattr(language, "SLICE_BYTES", 500)
    monkeypatch.setattr(language, "grams", lambda some: sizes.append(sum(map(len, some))) or whole(some))
    assert count() == want and max(sizes) <= 500
