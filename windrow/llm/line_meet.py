"""Where lines meet: nodes dealt out under their keys, packed, and each with one of its near ones.

A task deals its nodes under a few keys at a time and packs what goes to one part of the keys
as 28 bytes a node: key, id and half of the hash.  The task that has a part sorts it by key.
Of the near pairs of a bucket only so many are told as go with its nodes: at first each node with
the least leader near it, later, when most of a group is connected, each with its least and its
greatest near one in other components.  A node that has any near one at all is always told, so
what is left, all pairs across components, can be looked for among those alone.  There an entry
has all of the hash and the length, so that pairs that these rule out are not told.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.line_hash import LONGS, class_of, key_hashes

# Of the last 64 bits of two hashes, and of the last 128, so many may differ in near lines: similar
# ones differ in some 6 and 12, 99 in 100 of them in no more than 16 and 30; strangers in 32 and 64.
MAX_BITS = 20
MAX_HALF = 34
# Of all 256 bits so many may differ in lines whose texts are compared: similar ones differ in some 25, in 45 at
# the most of 19 in 20 pairs, strangers in 124 and hardly ever in fewer than 90.
MAX_APART = 60
# Entries that a task deals out before it passes them on, and entries of a part.  Sorting a part
# takes some five times its size, beside a JVM that takes two thirds of an executor.
DEAL_ENTRIES = 1 << 16
PART_ENTRIES = 1 << 18

MET = "id long, other long"
SIGN = np.uint64(1 << 63)
NONE = np.iinfo(np.int64).max


def dealer(keys: list[list[int]], first: int, similarity: float, n_parts: int):
    """Nodes (id, chars, sim_*[, label]), or such as ``line_places`` packs them, to packed entries
    (part, data) under the keys."""

    def pack(columns: list[np.ndarray]) -> pa.RecordBatch:
        ids, chars, sims = columns[0], columns[1], np.stack(columns[2 : 2 + LONGS], axis=1)
        own, above = class_of(chars, similarity)
        at = np.concatenate([np.arange(len(ids)), np.flatnonzero(above)])
        size = np.concatenate([own, own[above] + 1])
        some = sims.view(np.uint64).take(at, 0)
        told = [key_hashes(some, size, blocks, i) for i, blocks in enumerate(keys, first)]
        key = np.concatenate(told)
        part = part_of(key, n_parts)
        order = np.argsort(part, kind="stable")
        part, of = part[order], np.tile(at, len(keys))[order]
        begin = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
        ends = np.append(begin[1:], len(part))
        kept = [key[order], ids.take(of), *(np.ascontiguousarray(c).take(of) for c in sims.T[-2:])]
        if len(columns) > 2 + LONGS:  # a label, and then what else tells two nodes apart
            kept += [c.take(of) for c in (columns[-1], *columns[2 : LONGS], chars)]
        data = [b"".join([c[lo:hi].tobytes() for c in kept]) for lo, hi in zip(begin.tolist(), ends.tolist())]
        return pa.record_batch([pa.array(part[begin], pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_columns == 1:
                rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 2 + LONGS)
                held.append([np.ascontiguousarray(c) for c in rows.T])
            else:
                held.append([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            n += len(held[-1][0])
            if n * len(keys) >= DEAL_ENTRIES:
                yield pack([np.concatenate(c) for c in zip(*held)])
                held, n = [], 0
        if n:
            yield pack([np.concatenate(c) for c in zip(*held)])

    return deal


def part_of(key: np.ndarray, n_parts: int) -> np.ndarray:
    """The part of each key; so small a type, where it will do, is sorted by its digits."""
    part = (key.astype(np.uint64) * np.uint64(n_parts)) >> np.uint64(32)
    return part.astype(np.uint16 if n_parts <= 1 << 16 else np.int32)


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The entries of each part that are in a bucket of several, in the order of key and id.

    An entry is a key of 32 bits and ``width`` - 1 longs; data has its columns one after another.
    """

    def sorted_part(held: list[bytes]) -> np.ndarray:
        counts = [len(x) // (8 * width - 4) for x in held]
        key = np.concatenate([np.frombuffer(x, np.uint32, n) for x, n in zip(held, counts)]).astype(np.uint64)

        def column(c: int) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, np.int64, n, 4 * n + 8 * (c - 1) * n) for x, n in zip(held, counts)])

        ids = column(1)
        # By key and, nearly always, by id: its upper half will do to have the same nodes lead.
        by = key << np.uint64(32) | (ids.view(np.uint64) ^ SIGN) >> np.uint64(32)
        order = np.argsort(by)
        key = key[order]
        same = key[1:] == key[:-1]
        several = np.append(same, False) | np.append(False, same)
        order = order[several]
        columns = [key[several].view(np.int64), ids[order], *(column(c)[order] for c in range(2, width))]
        return np.stack(columns, axis=1)

    current, held = None, []
    for batch in batches:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
            if part != current and held:
                yield sorted_part(held)
                held = []
            current = part
            held.append(data)
    if held:
        yield sorted_part(held)


def _near(sims: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = np.bitwise_count((sims[a] ^ sims[b]).view(np.uint64))
    return (apart[:, 1] <= MAX_BITS) & (apart.sum(axis=1) <= MAX_HALF)


def least_leaders(rows: np.ndarray) -> np.ndarray:
    """Of each node the least leader near it; NONE without, a leader that has near ones itself.

    The first node of a bucket leads it, then the first that is near no leader, and so on; a
    leader is compared with all that do not lead.  So near copies cost one comparison each.
    """
    key, ids, sims = rows[:, 0], rows[:, 1], np.ascontiguousarray(rows[:, 2:4])
    bucket = np.cumsum(np.diff(key, prepend=~key[:1]) != 0) - 1
    free, leads = np.ones(len(key), bool), np.zeros(len(key), bool)
    other, at = np.arange(len(key)), np.full(len(key), -1)
    found = np.full(len(key), NONE)
    while len(other):
        left = other[free[other]]
        lead = left[np.diff(bucket[left], prepend=-1) != 0]
        at[:] = -1
        at[bucket[lead]] = lead
        free[lead], leads[lead] = False, True
        other = other[(at[bucket[other]] >= 0) & ~leads[other]]
        by = at[bucket[other]]
        near = _near(sims, other, by)
        some, by = other[near], by[near]
        found[some] = np.minimum(found[some], ids[by])
        found[by] = ids[by]
        free[some] = False
    return found


def _may_be_similar(rows: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether neither all of the hashes nor the lengths rule two near nodes out."""
    apart = np.zeros(len(a), np.int16)
    for c in (2, 3, 5, 6):  # a column at a time, so that rows are not copied
        apart += np.bitwise_count((rows[a, c] ^ rows[b, c]).view(np.uint64))
    chars = rows[a, 7], rows[b, 7]
    return (apart <= MAX_APART) & (np.minimum(*chars) >= similarity * 0.999 * np.maximum(*chars))


def near_across(rows: np.ndarray, similarity: float = 0.0) -> np.ndarray:
    """All near pairs, each once or twice, of the nodes of a bucket that have different labels;
    where entries have all of the hash and the length, less those that these rule out.

    All but the nodes of a bucket's most frequent label are compared with all of the bucket.
    """
    rows = rows[np.lexsort((rows[:, 4], rows[:, 0]))]
    key, ids, sims, label = rows[:, 0], rows[:, 1], np.ascontiguousarray(rows[:, 2:4]), rows[:, 4]
    starts = np.diff(key, prepend=~key[:1]) != 0
    bucket = np.cumsum(starts) - 1
    run = np.cumsum(starts | (np.diff(label, prepend=~label[:1]) != 0)) - 1
    n_run = np.bincount(run)
    of_run = bucket[np.flatnonzero(np.diff(run, prepend=-1))]
    most = np.zeros(bucket[-1] + 1, np.int64)
    order = np.argsort(n_run, kind="stable")
    most[of_run[order]] = order  # the last one written is the largest
    leaders = np.flatnonzero(most[bucket] != run)
    first = np.flatnonzero(np.diff(bucket[leaders], prepend=-1))
    turn = np.arange(len(leaders)) - np.repeat(first, np.diff(np.append(first, len(leaders))))
    found, at = [np.zeros((2, 0), np.int64)], np.full(len(most), -1)
    rest, whole = np.arange(len(key)), rows.shape[1] > 5
    by_turn = np.argsort(turn, kind="stable")
    for some in np.split(leaders[by_turn], np.flatnonzero(np.diff(turn[by_turn])) + 1):
        at[:] = -1
        at[bucket[some]] = some
        rest = rest[at[bucket[rest]] >= 0]
        by = at[bucket[rest]]
        near = (label[rest] != label[by]) & _near(sims, rest, by)
        a, b = rest[near], by[near]
        if whole:
            fits = _may_be_similar(rows, a, b, similarity)
            a, b = a[fits], b[fits]
        found.append(np.stack([ids[a], ids[b]]))
    return np.concatenate(found, axis=1)


def _first(ids: np.ndarray, others: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each id the row that is the first in an order by id."""
    ids, others = ids[order], others[order]
    first = np.diff(ids, prepend=~ids[:1]) != 0
    return np.stack([ids[first], others[first]])


def _meeter(labelled: bool, every: bool, similarity: float):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(batches, 4 + LONGS if labelled else 4):
            if not len(rows):
                continue
            if labelled:
                pairs = near_across(rows, similarity)
                if not every:
                    ids, others = np.concatenate([pairs, pairs[::-1]], axis=1)
                    least = _first(ids, others, np.lexsort((others, ids)))
                    pairs = np.concatenate([least, _first(ids, others, np.lexsort((~others, ids)))], axis=1)
            else:
                ids, others = rows[:, 1], least_leaders(rows)
                ids, others = ids[others != NONE], others[others != NONE]
                pairs = _first(ids, others, np.lexsort((others, ids)))
            yield pa.record_batch([pa.array(c, pa.int64()) for c in pairs], names=["id", "other"])

    return meet


def met(
    nodes: DataFrame, keys: list[list[int]], first: int, similarity: float, n_nodes: int, every: bool = False
) -> DataFrame:
    """(id, other) of nodes that have a near one under the keys: the least leader near it, or with
    a column ``label`` the least and the greatest, or every one, of another label.  Pairs may be
    told more than once."""
    labelled = "label" in nodes.columns
    columns = ["id", "chars", *(f"sim_{i}" for i in range(LONGS)), *(["label"] if labelled else [])]
    columns = ["packed"] if nodes.columns == ["packed"] else columns
    n_entries = n_nodes * len(keys) * 4 // 3
    n_parts = max(nodes.sparkSession.sparkContext.defaultParallelism, 1 + n_entries // PART_ENTRIES)
    dealt = nodes.select(*columns).mapInArrow(dealer(keys, first, similarity, n_parts), "part int, data binary")
    dealt = dealt.repartition(F.col("part")).sortWithinPartitions("part")
    return dealt.mapInArrow(_meeter(labelled, every, similarity), MET)
