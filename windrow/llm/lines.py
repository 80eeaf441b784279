"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity.

A line is normalised to lower case and single blanks.  Equal normalised lines are one node,
which stands for its first occurrence.  A node's SimHash is cut into blocks of four bits; nodes
meet where all blocks of a key agree, and near ones are compared by edit similarity.  The keys
are the same for every table, so the links of two lines do not depend on other lines.  Of each
connected group the first occurrence stays.

Pairs are told in three rounds, so that their number goes with the nodes and not with the square
of a group: each node with one that leads its bucket, then each with two of other components,
then all pairs across components that are left.  A node that met nothing near is in none of
them.  In between a node goes by 64 bits of its digest; texts are looked up before a link is
made, so that ids that are equal by chance only cost a comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import bounded_batches
from windrow.llm.components import components
from windrow.llm.line_edits import within
from windrow.llm.line_hash import LONGS, key_blocks
from windrow.llm.line_meet import MAX_APART, MAX_BITS, met
from windrow.llm.line_places import SIMS, line_places, pick_lines
from windrow.runtime import stage, staging

SIMILARITY = 0.85
# So many keys of every line are dealt out at a time.
KEYS_AT_ONCE = 12
# Buckets of up to so many nodes are told by ``bucket_rows`` pair by pair, larger ones by node.
SMALL_BUCKET = 16
# Lists of line numbers are broadcast up to this size, some 20 MB.
MAX_BROADCAST_DOCS = 100_000
MAX_BROADCAST_ENTRIES = 300_000

BUCKETS = "key long, a long, b long"


def bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What met, of (key, id, sim) in the order of keys: pairs of small buckets as (NULL, a, b),
    members of large ones as (key, id, sim)."""
    held, hot = np.zeros((3, 0), np.int64), None
    for batch in batches:
        now = np.stack([c.to_numpy() for c in batch.columns])
        if hot is not None:  # a bucket known to be large is passed on as it comes
            until = int(np.searchsorted(now[0] != hot, True))
            yield _told(now[:, :until])
            if until == now.shape[1]:
                continue
            hot, now = None, now[:, until:]
        now = np.concatenate([held, now], axis=1)
        last = int(np.flatnonzero(np.diff(now[0], prepend=~now[0, 0]))[-1])
        yield from _met_pairs(now[:, :last])
        held = now[:, last:]
        if held.shape[1] > SMALL_BUCKET:
            hot = held[0, 0]
            yield _told(held)
            held = held[:, :0]
    yield from _met_pairs(held)


def _told(members: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in members], names=["key", "a", "b"])


def _met_pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys, ids, sims = rows
    if len(keys) < 2:
        return
    first = np.flatnonzero(np.diff(keys, prepend=~keys[0]))
    size = np.diff(np.append(first, len(keys)))
    of = np.repeat(size, size)
    if (of > SMALL_BUCKET).any():
        yield _told(rows[:, of > SMALL_BUCKET])
    found = []
    for apart in range(1, min(SMALL_BUCKET, int(size.max()))):
        at = np.flatnonzero((keys[apart:] == keys[:-apart]) & (of[apart:] <= SMALL_BUCKET))
        near = np.bitwise_count((sims[at] ^ sims[at + apart]).view(np.uint64)) <= MAX_BITS
        at = at[near & (ids[at] != ids[at + apart])]
        found.append(np.sort(np.stack([ids[at], ids[at + apart]]), axis=0))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    if pairs.shape[1]:
        a, b = (pa.array(x, pa.int64()) for x in pairs)
        yield pa.record_batch([pa.nulls(len(a), pa.int64()), a, b], names=["key", "a", "b"])


def _node_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(id, sims, text) of some nodes, looked up where they occur first."""
    wanted = members.groupBy("doc_id").agg(F.collect_list(F.struct("id", "line_no")).alias("places"))
    lines = _join_bounded(docs, stage(wanted, "wanted"), F.size("places"), "inner")
    texts = lines.select("text", "places").mapInArrow(pick_lines, "id long, text string")
    sims = members.select("id", F.array(*SIMS).alias("sims"))
    return stage(texts.join(sims, "id").dropDuplicates(["id"]), "texts")


def _join_bounded(docs: DataFrame, small: DataFrame, entries: Column, how: str) -> DataFrame:
    """Join per-document lists to the documents, by broadcast while they are within a bound."""
    size = small.agg(F.count("*").alias("rows"), F.sum(entries).alias("n")).first()
    if size.rows <= MAX_BROADCAST_DOCS and (size.n or 0) <= MAX_BROADCAST_ENTRIES:
        small = F.broadcast(small)
    return docs.join(small, "doc_id", how)


def _similar(similarity: float) -> Column:
    """Whether two texts are similar; only those are compared whose hashes and lengths are near."""
    chars = [F.char_length(f"end_{x}.text") for x in "ab"]
    shorter, longer = F.least(*chars), F.greatest(*chars)
    most = _most(longer, similarity)
    sims = [[F.col(f"end_{x}.sims")[i] for x in "ab"] for i in range(LONGS)]
    apart = [F.bit_count(a.bitwiseXOR(b)) for a, b in sims]
    near = (longer - shorter <= most) & (sum(apart[1:], apart[0]) <= MAX_APART)
    return near & within("end_a.text", "end_b.text", most)


def _met(nodes: DataFrame, n: int, similarity: float, n_nodes: int, every: bool = False) -> DataFrame:
    """(id, other): what met of ``n`` nodes under any key, see ``line_meet.met``.

    The fewer of the ``n_nodes`` nodes of the table there are, the more keys are dealt at a time.
    """
    keys, found = key_blocks(), None
    at_once = KEYS_AT_ONCE * max(1, n_nodes // max(1, n))
    for lo in range(0, len(keys), at_once):
        some = stage(met(nodes, keys[lo : lo + at_once], lo, similarity, n, every), "met")
        found = some if found is None else found.union(some)
    return found


def _labelled(members: DataFrame, told: DataFrame, labels: DataFrame) -> DataFrame:
    """The members that are told, with the label of their component."""
    some = members.join(told.select("id").distinct(), "id").join(labels.withColumnRenamed("node", "id"), "id", "left")
    return stage(some.withColumn("label", F.coalesce("label", "id")), "labelled")


def _pairs_of(told: DataFrame) -> DataFrame:
    pairs = told.filter(F.col("id") != F.col("other"))
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, dropped): the numbers, from 0, of lines that are a later occurrence."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    )
    with staging(docs.sparkSession) as result:
        places = stage(line_places(docs), "places")
        nodes = places.filter("first").drop("first", "packed")
        n = nodes.count()
        told = _met(places.filter("packed IS NOT NULL").select("packed"), n, similarity, n).groupBy("id").agg(F.min("other").alias("other"))
        told = stage(told, "told")
        members = stage(nodes.join(told.select("id"), "id"), "members")  # no other node has a near one
        texts = _node_texts(docs, members)

        def links_of(pairs: DataFrame) -> DataFrame:
            for x in ("a", "b"):
                ends = texts.select(F.col("id").alias(x), F.struct("sims", "text").alias(f"end_{x}"))
                pairs = pairs.join(ends, x)
            return stage(pairs.filter(_similar(similarity)).select("a", "b").distinct(), "links")

        tried = stage(_pairs_of(told), "pairs")
        links = links_of(tried)
        labels = components(links)
        for every in (False, True):
            labelled = _labelled(members, told, labels)
            told = _met(labelled, labelled.count(), similarity, n, every)
            if not every:
                ends = told.groupBy("id").agg(F.min("other").alias("lo"), F.max("other").alias("hi"))
                told = stage(ends.select("id", F.explode(F.array("lo", "hi")).alias("other")), "told")
            pairs = stage(_pairs_of(told).join(tried, ["a", "b"], "left_anti"), "pairs")
            tried = tried.union(pairs)
            found = links_of(pairs)
            if not found.isEmpty():
                links = links.union(found)
                labels = components(links)
        # Of equal lines all but the first, and of the first ones of a component all but one.
        grouped = members.join(labels.withColumnRenamed("node", "id"), "id")
        place = F.struct("doc_id", "line_no")
        kept = grouped.groupBy("label").agg(F.min(place).alias("kept"))
        later = grouped.join(kept, "label").filter(place != F.col("kept")).select("doc_id", "line_no")
        repeats = places.filter(~F.col("first")).select("doc_id", "line_no")
        dropped = repeats.unionAll(later).groupBy("doc_id").agg(F.collect_set("line_no").alias("dropped"))
        return result(dropped, "dropped")


def _most(longest: Column, similarity: float) -> Column:
    return F.floor(longest * F.lit(round(1 - similarity, 6))).cast("int")


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` with all their columns, ``text`` less its repeated lines.

    Of each group of lines that similarity connects, over all documents, the occurrence of the
    smallest (doc_id, line number) stays.  Every line takes part that is not blank, the shorter
    the more it must be alike: one edit in seven characters.  All rows stay, also one whose text
    becomes empty.  A NULL text stays NULL; rows with a NULL id are neither changed nor compared.  Ids are taken to be
    unique; rows that repeat an id lose the same line numbers.  An empty table gives no rows.
    """
    repeated = repeated_lines(docs, **options).withColumnRenamed("dropped", "_line_dropped")
    joined = _join_bounded(docs, repeated, F.size("_line_dropped"), "left")
    dropped = F.col("_line_dropped")
    left = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(dropped, i))
    text = F.when(dropped.isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.withColumn("text", text).select(docs.columns)
