"""MinHash near-dedup: hash minima in bands, signature check, full check, components.

1. A task turns each text into its set of word shingles, takes the minima of many universal
   hash functions over the set and folds them into one key per band.  Texts with equal sets
   become one node.
2. A bucket is a band key that several nodes share.  Two sets of similarity 0.75 share none
   of the bands with a probability of 2e-5.
3. Within a bucket nodes are compared with a hub, not with each other: the node that shares
   the most buckets, as the original of a group of copies does.  A pair is dropped if
   its short signatures differ too much, else its full sets are compared.
4. Linked nodes are joined into components.  Buckets that still hold several components get
   another hub.
5. What is left are mostly texts that share a long passage and no more.  A shingle that only
   one component has cannot count towards a link between components, so a node with more
   than a quarter of such shingles has no link to find and goes, as often as that drops
   nodes.  Pairs across components that the rest leaves are ruled out by their sizes and bit
   maps or else compared outright.  So no link between components is lost, however large a
   bucket is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, floor, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from windrow.llm.buckets import link_buckets, shared_buckets
from windrow.llm.common import MAX_HOT_KEYS, bounded_batches
from windrow.runtime import stage

SHINGLE_WORDS = 5
THRESHOLD = 0.75
BAND_ROWS = 6
BANDS = 56
HUB_ROUNDS = 2
PEEL_ROUNDS = 4
MAP_BITS = 1024
HOT_ROWS = 1000

# Lower thresholds get bands of their own: as many as leave a pair at the threshold this
# chance of sharing none, of as many rows as keep the minima within the bound.
MISSED = 2e-5
MAX_MINIMA = 512

# A signature is the low byte of the first minima.  Sets of similarity 0.75 agree in 192 of
# 256 on average; fewer than 150 are six standard deviations off.
SIGNATURE = 256
DEVIATIONS = 6

MEMO_WORDS = 100_000
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class _Words(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Turns texts into sets of 64-bit shingle hashes."""

    def __init__(self, k: int = SHINGLE_WORDS):
        self.k, self.memo = k, _Words()

    def shingles(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        hashes = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        k = min(self.k, len(words))
        n = len(words) - k + 1 if words else 0
        mixed = np.full(n, k, np.uint64)
        for i in range(k):
            mixed ^= hashes[i : i + n]
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


@lru_cache(maxsize=1)
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def minima(shingles: np.ndarray, n: int) -> np.ndarray:
    """The minima of ``n`` universal hash functions over a set of 64-bit values."""
    a, b = _functions(n)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 2048):
        np.minimum(least, (a * x[lo : lo + 2048] + b).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, rows: int) -> np.ndarray:
    bands = least.reshape(-1, rows).astype(np.uint64)
    keys = np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(rows):
        keys ^= bands[:, i]
        keys *= np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, sig binary, keys array<long>"


def _sketcher(k: int, rows: int, bands: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                s = shingler.shingles(text)
                if not len(s):
                    out.append((0, 0, 0, None, None))
                    continue
                least = minima(s, rows * bands)
                a = int(np.bitwise_xor.reduce(s * np.uint64(0xD6E8FEB86659FD93)).view(np.int64))
                b = int((s ^ (s >> np.uint64(17))).sum(dtype=np.uint64).view(np.int64))
                sig = (least[:SIGNATURE] & 255).astype(np.uint8).tobytes()
                out.append((len(s), a, b, sig, band_keys(least, rows)))
            n, a, b, sig, keys = zip(*out) if out else ((),) * 5
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array(sig, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sig", "keys"],
            )

    return sketch


def least_agreeing(percent: int, minima: int) -> int:
    """How many of so many minima agree at least where two sets are that similar."""
    share = percent / 100
    return floor(minima * share - DEVIATIONS * sqrt(minima * share * (1 - share)))


def banding(threshold: float) -> tuple[int, int]:
    """Rows and bands that find pairs from a threshold on."""
    if not 0 < threshold <= 1:
        raise ValueError(f"a threshold above 0 and up to 1 is needed: {threshold}")
    if threshold >= THRESHOLD:
        return BAND_ROWS, BANDS
    for rows in range(BAND_ROWS, 0, -1):
        bands = ceil(log(MISSED) / log(1 - threshold**rows))
        if rows * bands <= MAX_MINIMA:
            break
    return rows, bands


@lru_cache(maxsize=None)
def _signatures_agree(percent: int):
    @F.arrow_udf(BooleanType())
    def agree(a: pa.Array, b: pa.Array) -> pa.Array:
        left = np.frombuffer(b"".join(a.to_pylist()), np.uint8).reshape(len(a), -1)
        right = np.frombuffer(b"".join(b.to_pylist()), np.uint8).reshape(len(a), -1)
        return pa.array((left == right).sum(axis=1) >= least_agreeing(percent, left.shape[1]))

    return agree


@lru_cache(maxsize=None)
def _set_check(k: int, percent: int):
    """Whether 100 * |A and B| >= percent * |A or B| for the full sets of two texts."""

    @F.arrow_udf(BooleanType())
    def similar(left: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        shingler = Shingler(k)
        hub, hub_set = None, None
        for a, b in left:
            out = []
            for x, y in zip(a.to_pylist(), b.to_pylist()):
                if x != hub:
                    hub, hub_set = x, shingler.shingles(x)
                other = shingler.shingles(y)
                both = len(np.intersect1d(hub_set, other, assume_unique=True))
                out.append(100 * both >= percent * (len(hub_set) + len(other) - both))
            yield pa.array(out, pa.bool_())

    return similar


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar; ``a`` is the hub where there is one."""
    sigs = nodes.select("node", "sig")
    near = (
        pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        .filter(_signatures_agree(percent)("sig_a", "sig_b"))
        .select("a", "b")
    )
    near = stage(near, "near")
    with_text = near.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    with_text = with_text.join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
    )
    return stage(with_text.filter(_set_check(k, percent)("text_a", "text_b")).select("a", "b"), "links")


def near_duplicates(
    docs: DataFrame,
    k: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    rows: int | None = None,
    bands: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of other than white space, A-Z in lower case; a shorter text is one
    shingle.  A text without words, or NULL, has no shingles and no links.  Documents are
    linked from a set similarity of ``threshold`` on; ``component_id`` is the least id that
    links lead to.  ``rows`` and ``bands`` follow from the threshold where they are not given.
    Rows that repeat an id are one document to links; each gives a row.  A row
    with a NULL id takes no part: its component is NULL and it is kept.  An empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    percent = round(100 * threshold)
    own_rows, own_bands = banding(threshold)
    rows, bands = rows or own_rows, bands or own_bands
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = stage(texts.mapInArrow(_sketcher(k, rows, bands), SKETCH), "sketches")
    full = sketches.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes = stage(
        full.groupBy("set_a", "set_b", "n_shingles").agg(
            F.min("doc_id").alias("node"),
            F.count("*").alias("n_rows"),
            F.min_by(F.struct("sig", "keys"), "doc_id").alias("s"),
        ).select("set_a", "set_b", "node", "n_rows", "s.sig", "s.keys"),
        "nodes",
    )
    node_texts = texts.select(F.col("doc_id").alias("node"), "text")
    members = shared_buckets(nodes.select("node", F.explode("keys").alias("key")))
    labels = link_buckets(
        members,
        lambda pairs: _links(pairs, nodes, node_texts, k, percent),
        lambda across: _pairs_across(
            across.join(_able_to_link(across, node_texts, k, percent), "node"), percent
        ),
        HUB_ROUNDS,
    )
    return _with_components(sketches, nodes, labels)


def _shingle_lists(k: int):
    """Sets as lists, and as a map of bits in which a shingle sets the one its hash names."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            sets = [shingler.shingles(t) for t in batch.column("text").to_pylist()]
            bits = np.zeros((len(sets), MAP_BITS), np.uint8)
            for row, found in zip(bits, sets):
                row[(found >> np.uint64(20)) % np.uint64(MAP_BITS)] = 1
            maps = np.packbits(bits, axis=1).view(np.int64)
            columns = [
                batch.column("node"),
                batch.column("label"),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array(list(maps), pa.list_(pa.int64())),
                pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
            ]
            yield pa.record_batch(columns, names=["node", "label", "size", "bits", "shingles"])

    return lists


LISTS = "node long, label long, size long, bits array<long>, shingles array<long>"


def _able_to_link(across: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, size, shared, bits): nodes with enough shingles that another component has too.

    A link to another component needs ``percent`` of a node's shingles to be in a node of
    another component.  Dropping nodes makes more shingles private, hence the rounds.
    """
    nodes = across.select("node", "label").distinct()
    lists = texts.join(nodes, "node").select("node", "label", "text")
    lists = stage(lists.mapInArrow(_shingle_lists(k), LISTS), "shingles")
    left = lists.select("node", "label", "size", F.explode("shingles").alias("x"))
    before = None
    for _ in range(PEEL_ROUNDS):
        spread = left.groupBy("x").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        spread = spread.filter(F.col("lo") != F.col("hi")).select("x")
        able = left.join(spread, "x").groupBy("node", "size").agg(F.count("*").alias("shared"))
        able = able.filter(F.col("shared") * 100 >= F.col("size") * percent)
        able = stage(able, "able")
        n = able.count()
        if n == before or not n:
            break
        before = n
        left = left.join(able.select("node"), "node", "left_semi")
    return able.join(lists.select("node", "bits"), "node")


def _pairs_across(across: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket and two components that cannot be ruled out by what is known of each.

    In both sets are at most the lesser number of shared shingles, and of either set at most
    those that are not seen to be missing in the other: a bit set in one map alone is one
    shingle or more that the other set lacks.
    """
    side = lambda x: across.select(
        "key",
        F.col("node").alias(x),
        *[F.col(c).alias(f"{c}_{x}") for c in ("label", "size", "shared")],
        *[F.get("bits", F.lit(i)).alias(f"bits_{x}{i}") for i in range(MAP_BITS // 64)],
    )

    def lacking(x: str, y: str) -> Column:
        words = [
            F.bit_count(F.col(f"bits_{x}{i}").bitwiseAND(F.bitwise_not(f"bits_{y}{i}")))
            for i in range(MAP_BITS // 64)
        ]
        return sum(words[1:], words[0])

    least = (F.col("size_a") + F.col("size_b")) * percent

    def in_reach(most: Column) -> Column:
        return most * (100 + percent) >= least

    met = side("a").join(side("b"), "key").filter(
        (F.col("label_a") < F.col("label_b"))
        & in_reach(F.least("shared_a", "shared_b"))
        & in_reach(F.col("size_a") - lacking("a", "b"))
        & in_reach(F.col("size_b") - lacking("b", "a"))
    )
    return met.select("a", "b").distinct()


def _with_components(
    sketches: DataFrame, nodes: DataFrame, labels: DataFrame | None
) -> DataFrame:
    """Every row with the component of its set; sets of very many rows are joined by broadcast."""
    component = nodes.select("set_a", "set_b", "node", "n_rows")
    if labels is None:
        component = component.withColumn("component_id", F.col("node"))
    else:
        component = component.join(labels, "node", "left").withColumn(
            "component_id", F.coalesce("label", "node")
        )
    component = stage(
        component.filter((F.col("n_rows") > 1) | (F.col("component_id") != F.col("node"))).select(
            "set_a", "set_b", "n_rows", "component_id"
        ),
        "moved",
    )
    rows = sketches.select("doc_id", "n_shingles", "set_a", "set_b")
    most = max(HOT_ROWS, -(-rows.count() // MAX_HOT_KEYS))
    # Fewer than MAX_HOT_KEYS sets can have so many rows.
    hot = F.broadcast(component.filter(F.col("n_rows") > most).drop("n_rows"))
    rest = component.filter(F.col("n_rows") <= most).drop("n_rows")
    takes_part = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    on = ["set_a", "set_b"]
    joined = (
        rows.filter(takes_part).join(hot, on)
        .unionByName(rows.filter(takes_part).join(hot, on, "left_anti").join(rest, on, "left"))
        .unionByName(rows.filter(~takes_part).withColumn("component_id", F.col("doc_id")))
    )
    component_id = F.coalesce("component_id", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
    )
