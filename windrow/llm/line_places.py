"""The lines of all texts, each different one once, and the texts of some of them.

Lines are dealt out by their digests, packed, to parts that are sorted in a task: of equal lines
the one of the smallest (doc_id, line number) comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from windrow.llm.line_hash import LONGS, NAMES, line_rows, normalise

# Parts that lines are dealt out to, and lines of a task that are dealt at a time.
PARTS = 1024
DEAL_LINES = 1 << 17

SIMS = [f"sim_{i}" for i in range(LONGS)]
PLACES = "id long, doc_id long, line_no int, chars int, " + ", ".join(f"{c} long" for c in SIMS) + ", first boolean, packed binary"
WIDTH = len(NAMES)
DOC, LINE, ID, OTHER, CHARS = range(5)  # of an entry; then the hash


def deal_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (part, data): the lines that are not blank, as rows of longs."""

    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        entries = np.concatenate(held)
        part = (entries[:, ID].view(np.uint64) % np.uint64(PARTS)).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        entries, part = entries.take(order, 0), part[order].astype(np.int32)
        begin = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(begin[1:], len(part))
        data = [entries[lo:hi].tobytes() for lo, hi in zip(begin, ends)]
        return pa.record_batch([pa.array(part[begin], pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])

    held, n = [], 0
    for rows in line_rows(batches):
        held.append(np.stack([c.to_numpy().astype(np.int64) for c in rows.columns], axis=1))
        n += rows.num_rows
        if n >= DEAL_LINES:
            yield dealt(held)
            held, n = [], 0
    if n:
        yield dealt(held)


def told_places(entries: np.ndarray) -> pa.RecordBatch:
    """``PLACES`` of the lines of a part; a place that is listed again is left out."""
    order = np.lexsort([entries[:, c] for c in (LINE, DOC, OTHER, ID)])
    entries = entries.take(order, 0)
    new = np.diff(entries[:, [ID, OTHER]], axis=0, prepend=~entries[:1, [ID, OTHER]]).any(axis=1)
    other = new | np.diff(entries[:, [DOC, LINE]], axis=0, prepend=~entries[:1, [DOC, LINE]]).any(axis=1)
    entries, new = entries[other], new[other]
    columns = [entries[:, c] for c in (ID, DOC, LINE, CHARS, *range(WIDTH - LONGS, WIDTH))]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * LONGS]
    arrays = [pa.array(np.ascontiguousarray(c)).cast(k) for c, k in zip(columns, kinds)]
    # What is first once more, as rows of longs in one value: id, length and hash.
    packed = entries[new][:, [ID, *range(CHARS, WIDTH)]].tobytes()
    packed = pa.concat_arrays([pa.array([packed], pa.binary()), pa.nulls(len(new) - 1, pa.binary())])
    names = ["id", "doc_id", "line_no", "chars", *SIMS, "first", "packed"]
    return pa.record_batch([*arrays, pa.array(new), packed], names=names)


def find_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, data) in the order of parts to ``PLACES``."""
    current, held = None, []
    for batch in batches:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
            if part != current and held:
                yield told_places(np.frombuffer(b"".join(held), np.int64).reshape(-1, WIDTH))
                held = []
            current = part
            held.append(data)
    if held:
        yield told_places(np.frombuffer(b"".join(held), np.int64).reshape(-1, WIDTH))


def line_places(docs: DataFrame) -> DataFrame:
    """``PLACES`` of all lines of (doc_id, text) that are not blank; ``first`` of equal ones is one.

    ``packed`` has those of a part in one value, for tasks that go through all of them.
    """
    dealt = docs.mapInArrow(deal_lines, "part int, data binary")
    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(find_first, PLACES)


def pick_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, places (id, line_no)) to (id, text): those lines, normalised; a line that is not there is left out."""
    for batch in batches:
        ids, texts = [], []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
            lines = text.split("\n")
            for place in places:
                if place["line_no"] < len(lines):
                    ids.append(place["id"])
                    texts.append(normalise(lines[place["line_no"]]))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])
