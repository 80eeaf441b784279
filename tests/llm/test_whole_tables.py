"""op1, op3, op5 and op10 on the whole smallest table, against brute force and the library."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm_queries import SF_DIR, pytestmark  # noqa: F401
from tests.llm.test_pairs_and_copies import component_of, expected_components
from windrow.llm import queries as llm
from windrow.llm.line_hash import normalise
from windrow.llm.pieces import MARK


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


@pytest.fixture(scope="module")
def ids(table):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    return {i: model.encode(text or "") for i, text in table}


def test_components_of_the_table(spark, table):
    want, sets = expected_components(table)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in llm.QUERIES["op1_minhash_near_dedup"](spark, SF_DIR).collect()}
    assert got == {i: (want[i], len(sets[i])) for i, _ in table}


def test_token_counts_of_the_table(spark, ids):
    got = {r.doc_id: r.n_tokens for r in llm.QUERIES["op5_token_counts"](spark, SF_DIR).collect()}
    assert got == {i: len(x) for i, x in ids.items()}


def test_ids_of_the_table(spark, table, ids):
    frame = spark.createDataFrame(list(ids.items()), "doc_id long, ids array<int>")
    hashes = dict(frame.select("doc_id", F.xxhash64("ids")).collect())
    out = llm.QUERIES["op10_sentencepiece"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_hash) for r in out} == {
        i: (len(x), hashes[i]) for i, x in ids.items()
    }
    assert {r.doc_id: r.decoded_sha256 for r in out} == {
        r[0]: r[1] for r in spark.createDataFrame(
            [(i, (t or "").replace(MARK, " ")) for i, t in table], "doc_id long, t string"
        ).select("doc_id", F.sha2("t", 256)).collect()
    }


def test_lines_of_the_table(spark, table):
    """All pairs of lines, by the edit distance of Spark: no other line goes, and of those that
    are near but not equal to one before at least nine in ten do."""
    places = {}
    for doc_id, text in table:
        for n, line in enumerate((text or "").split("\n")):
            if normalise(line):
                places.setdefault(normalise(line), []).append((doc_id, n))
    side = spark.createDataFrame(list(enumerate(places)), "i long, t string").repartition(8)
    longest = F.greatest(F.char_length("t"), F.char_length("u"))
    most = F.floor(longest * F.lit(0.15)).cast("int")
    pairs = side.join(F.broadcast(side.toDF("j", "u")), F.col("i") < F.col("j"))
    pairs = pairs.filter(F.abs(F.char_length("t") - F.char_length("u")) <= most)
    near = F.call_function("levenshtein", "t", "u", most) >= 0
    names = list(places.values())
    links = [(min(names[i]), min(names[j])) for i, j in pairs.filter(near).select("i", "j").collect()]
    firsts = component_of({min(p) for p in names}, links)
    want = {}
    for found in names:
        for place in found:
            if place != firsts[min(found)]:
                want[place[0]] = want.get(place[0], 0) + 1
    equal = sum(len(found) - 1 for found in places.values())
    out = llm.QUERIES["op3_line_dedup"](spark, SF_DIR).collect()
    got = {r.doc_id: r.n_dropped for r in out if r.n_dropped}
    assert links and all(n <= want.get(i, 0) for i, n in got.items())
    assert sum(got.values()) - equal >= 0.9 * (sum(want.values()) - equal) > 0
