"""Packing into sequences by minimum bin slack: subset sums in bits, counts traced back.

A document's full windows are sequences of their own.  The rests go to a pool; the longest one
opens a sequence, and of the multiset of remaining lengths those are chosen that come closest
to filling it: reachable sums are the bits of a number, one shifted or per length, and the
number of pieces of each length is traced back through them.  Where the best sum leaves room,
one more rest is cut to fill it.  Documents are encoded and packed where they are read, so
nothing is shuffled, and a task holds one bounded pool.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from windrow.llm.common import bounded_batches, by_bytes

CAPACITY = 2048
END_ID = 1
# A pool of rests is packed once it holds so many tokens; they take 4 bytes each.
POOL_TOKENS = 1 << 21
OUT_BYTES = 4 << 20
CALL_BYTES = 1 << 20
SEQUENCE_SHIFT = 40

# Byte-level splitting never has white space behind another character in one word, nor letters
# before a stop.  So a text may be cut before a blank or line end that follows a character that
# is no white space, and between a letter (Latin ones are enough) and a stop.
SEGMENT = re.compile(
    r"\s*+[A-Za-zÀ-ÖØ-öø-ɏ]++(?=[.,;:!?])|\s*+\S++(?:(?![ \t\r\n])\s++\S*+)*+|\s+"
)
MEMO_SEGMENTS = 800_000
MEMO_CHARS = 32


class SegmentEncoder:
    """Ids of texts as the library gives them, little-endian 32-bit; remembers short segments."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        words = told["pre_tokenizer"] or {}
        self.safe = (
            told["normalizer"] is None
            and words.get("type") == "ByteLevel"
            and not words.get("add_prefix_space")
            and words.get("use_regex", True)
            and not any(
                t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"[\s.,;:!?]", t["content"])
                for t in told["added_tokens"]
            )
        )
        self.memo: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [SEGMENT.findall(t) for t in texts] if self.safe else [[t] for t in texts]
        memo, new = self.memo, set()
        met = [list(map(memo.get, segments)) for segments in cut]
        for segments, known in zip(cut, met):
            if None in known:
                new.update([s for s, ids in zip(segments, known) if ids is None])
        new = list(new)
        lo = held = 0
        for i, segment in enumerate(new, 1):
            held += 4 * len(segment)
            if held >= CALL_BYTES or i == len(new):
                found = self.library.encode_batch_fast(new[lo:i], add_special_tokens=False)
                ids = [e.ids for e in found]
                flat = np.array(list(chain.from_iterable(ids)), "<u4").tobytes()
                at = 0
                for one, key in zip(ids, new[lo:i]):
                    memo[key] = flat[at : at + 4 * len(one)]
                    at += 4 * len(one)
                lo, held = i, 0
        out = [
            b"".join([memo[s] if ids is None else ids for s, ids in zip(segments, known)])
            if None in known
            else b"".join(known)
            for segments, known in zip(cut, met)
        ]
        if len(memo) > MEMO_SEGMENTS:
            memo.clear()
        else:
            for segment in new:
                if len(segment) > MEMO_CHARS:
                    del memo[segment]
        return out


@cache
def _encoder(path: str) -> SegmentEncoder:
    return SegmentEncoder(path)


def closest(counts: dict[int, int], lengths: list[int], room: int) -> tuple[int, list[tuple[int, int]]]:
    """The largest sum up to ``room`` of a multiset of lengths, and its (length, count)s.

    Bit s of ``reach`` says that some choice sums to s.  Lengths come from the longest down,
    each as often as there are pieces of it, in counts of 1, 2, 4 ... and a rest; the search
    ends where the room is filled.
    """
    within, reach = (1 << (room + 1)) - 1, [1]
    used = lengths[: bisect_right(lengths, room)][::-1]
    for length in used:
        bits, left, step = reach[-1], min(counts[length], room // length), 1
        while left:
            take = min(step, left)
            bits |= (bits << (take * length)) & within
            left -= take
            step *= 2
        reach.append(bits)
        if bits >> room:
            break
    best = at = reach[-1].bit_length() - 1
    chosen = []
    for i in range(len(reach) - 1, 0, -1):
        length, n = used[i - 1], 0
        while not reach[i - 1] >> at & 1:
            at -= length
            n += 1
        if n:
            chosen.append((length, n))
    return best, chosen


class Pool:
    """Rests by length; ``sequences`` packs them as far as they fill whole sequences."""

    def __init__(self, capacity: int):
        self.capacity, self.tokens = capacity, 0
        self.rests: dict[int, list] = {}
        self.counts: dict[int, int] = {}
        self.lengths: list[int] = []

    def put(self, owner, start: int, length: int) -> None:
        if length not in self.rests:
            self.rests[length] = []
            insort(self.lengths, length)
        self.rests[length].append((owner, start, length))
        self.counts[length] = len(self.rests[length])
        self.tokens += length

    def take(self, length: int):
        found = self.rests[length].pop()
        self.counts[length] = len(self.rests[length])
        if not self.rests[length]:
            del self.rests[length], self.counts[length]
            self.lengths.remove(length)
        self.tokens -= length
        return found

    def sequences(self, last: bool) -> Iterator[list]:
        """Lists of (owner, start, length), full ones; with ``last`` what is left, too.

        What is left is less than a sequence.  It is cut into sequences of powers of two,
        which need no padding.
        """
        while self.tokens >= self.capacity:
            pieces = [self.take(self.lengths[-1])]
            room = self.capacity - pieces[0][2]
            best, chosen = closest(self.counts, self.lengths, room)
            pieces += [self.take(length) for length, n in chosen for _ in range(n)]
            if best < room:  # every rest is longer than the room that is left
                owner, start, length = self.take(self.lengths[-1])
                pieces.append((owner, start, room - best))
                self.put(owner, start + room - best, length - room + best)
            yield pieces
        if not last:
            return
        rests = [self.take(self.lengths[-1]) for _ in range(sum(self.counts.values()))]
        total, at = sum(r[2] for r in rests), 0
        for power in reversed(range(total.bit_length())):
            room = total & (1 << power)
            pieces = []
            while room:
                owner, start, length = rests[at]
                cut = min(room, length)
                pieces.append((owner, start, cut))
                room -= cut
                if cut < length:
                    rests[at] = (owner, start + cut, length - cut)
                else:
                    at += 1
            if pieces:
                yield pieces


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


class _Pieces:
    """Collects pieces in batches of bounded bytes."""

    def __init__(self, id_type: pa.DataType, partition: int):
        self.id_type, self.next_id = id_type, partition << SEQUENCE_SHIFT
        self.clear()

    def clear(self) -> None:
        self.columns, self.held = [[] for _ in NAMES], 0

    def add(self, pieces: list) -> Iterator[pa.RecordBatch]:
        offset = 0
        for (doc_id, ids), start, length in pieces:
            told = ids[4 * start : 4 * (start + length)]
            row = (doc_id, start, length, told, len(ids) // 4, self.next_id, offset)
            for column, value in zip(self.columns, row):
                column.append(value)
            offset += length
            self.held += 4 * length + 64
        self.next_id += 1
        if self.held >= OUT_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        kinds = [self.id_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
        if self.columns[0]:
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(self.columns, kinds)], names=NAMES
            )
        self.clear()


def _pack_rows(vocabulary: str, capacity: int, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(vocabulary), end_id.to_bytes(4, "little")
        pool, out = Pool(capacity), None
        for batch in batches:
            if out is None:
                out = _Pieces(batch.column(0).type, TaskContext.get().partitionId())
            for lo, hi in by_bytes(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                encoded = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                for doc_id, ids in zip(part.column(0).to_pylist(), encoded):
                    owner, n = (doc_id, ids + end), len(ids) // 4 + 1
                    for start in range(0, n - n % capacity, capacity):
                        yield from out.add([(owner, start, capacity)])
                    if n % capacity:
                        pool.put((doc_id, owner[1]), n - n % capacity, n % capacity)
                if pool.tokens >= POOL_TOKENS:
                    for pieces in pool.sequences(last=False):
                        yield from out.add(pieces)
        if out is not None:
            for pieces in pool.sequences(last=True):
                yield from out.add(pieces)
            yield from out.flush()

    return rows


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens.

    Columns: ``doc_id``, ``start`` and ``length`` of the piece in its document's ids, ``ids``
    themselves (little-endian, 32 bits each), ``doc_tokens``, ``sequence_id`` and ``offset`` of
    the piece in its sequence.  A document's ids are the library's, without added special
    tokens, and ``end_id``.  Every id is in exactly one piece.  All sequences are full but the
    last ones of each task, which are powers of two, at most one of each.  A NULL text counts
    as empty and is one id; rows of one id or a NULL id are packed each for itself.  An empty table
    gives no rows; other columns are not read.  ``vocabulary`` must exist on the executors.
    """
    bounded_batches(docs.sparkSession)
    schema = StructType(
        [StructField("doc_id", docs.schema[id_col].dataType)]
        + [StructField(c, BinaryType() if c == "ids" else LongType()) for c in NAMES[1:]]
    )
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(_pack_rows(vocabulary, capacity, end_id), schema)
