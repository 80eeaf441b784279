"""Token counts of whole texts, by the library of the vocabulary, returning lengths only.

No piece of a sentencepiece vocabulary holds a space after another character, and none but
the byte fallback holds a newline.  So a text may be cut before a run of spaces and around a
newline without changing its tokens.  Texts are cut there into segments, the segments of a
batch that were not met before are encoded together, in calls of bounded bytes, and a text's
count is the sum of its segments' counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from windrow.llm.common import bounded_batches, by_bytes

# What sentencepiece writes for a space, and what may be cut around.
MARK = "▁"
SEGMENT = re.compile(f"\n|[ {MARK}]+[^ {MARK}\n]*|[^ {MARK}\n]+")

CALL_BYTES = 1 << 20
MEMO_SEGMENTS = 300_000
MEMO_CHARS = 48


class SegmentCounter:
    """Counts the tokens of texts; remembers short segments within a bound."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.safe = not any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)
        # A segment is counted behind a newline, which stays apart from it and from the
        # space that the library puts before every text.
        self.before = len(self.library.encode("\n"))
        self.memo: dict[str, int] = {}

    def count(self, texts: Iterable[str]) -> list[int]:
        texts = list(texts)
        if not self.safe:
            return [n for call in self._calls(texts) for n in map(len, self._encode(call))]
        cut = [SEGMENT.findall(" " + t) if t else [] for t in texts]
        memo = self.memo
        new = list(set(chain.from_iterable(cut)).difference(memo))
        for call in self._calls(new):
            for segment, ids in zip(call, self._encode(["\n" + s for s in call])):
                memo[segment] = len(ids) - self.before
        counts = [sum(map(memo.__getitem__, segments)) for segments in cut]
        if len(memo) > MEMO_SEGMENTS:
            memo.clear()
        else:
            for segment in new:
                if len(segment) > MEMO_CHARS:
                    del memo[segment]
        return counts

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    def _calls(self, texts: list[str]) -> Iterator[list[str]]:
        call, held = [], 0
        for text in texts:
            call.append(text)
            held += 4 * len(text)
            if held >= CALL_BYTES:
                yield call
                call, held = [], 0
        if call:
            yield call


@cache
def _counter(model_path: str) -> SegmentCounter:
    return SegmentCounter(model_path)


@lru_cache(maxsize=None)
def token_counter(model_path: str):
    """An Arrow function from texts to their numbers of tokens; NULL counts as empty."""

    @F.arrow_udf(LongType())
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(model_path)
        for batch in batches:
            counts = []
            for lo, hi in by_bytes(batch):
                counts += counter.count(t or "" for t in batch.slice(lo, hi - lo).to_pylist())
            yield pa.array(counts, pa.int64())

    return n_tokens


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit``.

    Whole texts, as the library encodes them without begin, end or other added tokens.  A NULL
    text counts as empty and has no tokens.  Every row gives one row, repeated ids and NULL ids
    too; an empty table gives none; other columns are not read.  ``model_path`` must exist on
    the executors, as the library is there.
    """
    bounded_batches(docs.sparkSession)
    text: Column = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_counter(model_path)(text).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
