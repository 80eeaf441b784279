"""Merkle manifest of a dataset: every row a leaf, proofs joined and folded block by block.

Leaves are digests of whole rows, so that everything after the first pass is small.  They are
put in order per source by ranges, and 256 neighbours of one source, two levels of the tree,
make a superblock.  The upper tree is built from the tops of superblocks, a level at a time.
Then leaves and the nodes they need from outside of their superblock are cogrouped by it: a
task finishes the local levels, joins the proofs and folds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import bounded_batches, null_key
from windrow.runtime import counted_bound, join_small, stage

FAN = 16
BLOCK_LEVELS = 2
BLOCK = FAN**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels above the subroots come after all levels below them.
ABOVE = 1000
# Runs hold up to 16 digests, about 1 KB: so many are a broadcast of some 5 MB.
MAX_BROADCAST_RUNS = 5_000


def digest_of(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as ``-`` or its length in bytes, ``:`` and its text."""
    told = []
    for field in fields:
        text = field.cast("string")
        length = F.octet_length(text).cast("string")
        told.append(F.coalesce(F.concat(length, F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*told), 256)


def placed(rows: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``rows`` with ``place``, from 0 in the order of their ``tree``, and the tree's ``size``.

    Rows are dealt by ranges of (tree, order) and numbered inside of each range; a table of
    one row per range and tree holds what comes before.  A tree of any size is spread.
    """
    keys = [F.col("tree"), *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), label)
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    parts = ranged.groupBy("tree", "_part").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    tree = Window.partitionBy("tree")
    parts = stage(
        parts.select(
            "tree",
            "_part",
            (F.sum("_n").over(tree.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_add"),
            F.sum("_n").over(tree).alias("size"),
        ),
        f"{label}_parts",
    )
    joined = join_small(ranged, parts, ["tree", "_part"], "inner", counted_bound(parts))
    return joined.withColumn("place", F.col("_at") + F.col("_add")).drop("_at", "_part", "_add")


def _joined(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def _up(size: Column) -> Column:
    return F.ceil(size / F.lit(FAN)).cast("long")


def _level(nodes: DataFrame, run: Column) -> DataFrame:
    """Runs of neighbouring nodes: (tree, run, size, digests in order)."""
    found = F.sort_array(F.collect_list(F.struct("place", "digest")))
    return (
        nodes.groupBy("tree", run.alias("run"))
        .agg(F.first("size").alias("size"), found.alias("found"))
        .select("tree", "run", "size", F.col("found.digest").alias("digests"))
    )


def _block_tops(leaves: DataFrame) -> DataFrame:
    """The node that each superblock comes to: (tree, place, digest, size), levels below done."""
    blocks = _level(leaves.withColumnRenamed("leaf", "digest"), F.col("block"))
    for _ in range(BLOCK_LEVELS):
        runs = F.sequence(F.lit(0), F.ceil(F.size("digests") / F.lit(FAN)).cast("int") - 1)
        within = F.transform(runs, lambda i: _joined(F.slice("digests", i * FAN + 1, FAN)))
        digests = F.when(F.col("size") > 1, within).otherwise(F.col("digests"))
        blocks = blocks.withColumns({"digests": digests, "size": _up(F.col("size"))})
    return blocks.select("tree", F.col("run").alias("place"), F.col("digests")[0].alias("digest"), "size")


def _tree(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, lowest first, and the roots (tree, digest).

    A level has a sixteenth of the rows of the one below, so the loop is as long as the tree
    is high.
    """
    levels, roots = [], []
    while True:
        roots.append(nodes.filter(F.col("size") == 1).select("tree", "digest"))
        rest = nodes.filter(F.col("size") > 1)
        if rest.isEmpty():
            break
        runs = stage(_level(rest, F.floor(F.col("place") / FAN)), label)
        levels.append(runs)
        nodes = runs.select(
            "tree", F.col("run").alias("place"), _joined(F.col("digests")).alias("digest"),
            _up(F.col("size")).alias("size"),
        )
    found = roots[0]
    for more in roots[1:]:
        found = found.union(more)
    return levels, stage(found, f"{label}_roots")


def _outside(nodes: DataFrame, levels: list[DataFrame], base: int) -> DataFrame | None:
    """Per node (tree, place) and level above it: the run it is in and where it is there."""
    found = None
    for i, runs in enumerate(levels):
        place = F.floor(F.col("place") / F.lit(FAN**i))
        mine = nodes.withColumn("mine", (place % FAN).cast("int")).withColumn(
            "run", F.floor(place / FAN)
        )
        n = runs.limit(MAX_BROADCAST_RUNS + 1).count()
        bound = n if n <= MAX_BROADCAST_RUNS else None
        met = join_small(mine, runs.drop("size"), ["tree", "run"], "inner", bound)
        met = met.withColumn("level", F.lit(base + i)).drop("run")
        found = met if found is None else found.union(met)
    return found


PROOFS = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _fold(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proofs of one superblock's leaves, and the roots that they fold to."""
    leaves, outer = leaves.sort_values("place"), outer.sort_values("level")
    levels, size = [leaves["leaf"].tolist()], int(leaves["size"].iloc[0]) if len(leaves) else 1
    while len(levels) <= BLOCK_LEVELS and size > 1:
        below = levels[-1]
        levels.append([_h("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
        size = -(-size // FAN)
    local, subroot = levels[:-1], levels[-1][0]
    above = []
    for level, mine, digests in zip(outer["level"], outer["mine"], outer["digests"]):
        digests = list(digests)
        above.append((level, "".join(digests[:mine]), "".join(digests[mine + 1 :])))
    tail = "".join(a + b for _, a, b in above)
    root = subroot
    for level, a, b in above:
        root = _h(a + root + b)
        if level < ABOVE:
            subroot = root
    rows = []
    start = int(leaves["place"].iloc[0]) if len(leaves) else 0
    for place, row_id, leaf, tampered in zip(*(leaves[c] for c in ("place", "id", "leaf", "tampered"))):
        at, siblings, folded = int(place) - start, [], tampered or leaf
        for nodes in local:
            lo = at - at % FAN
            a, b = "".join(nodes[lo:at]), "".join(nodes[at + 1 : lo + FAN])
            siblings += [a, b]
            folded = _h(a + folded + b)
            at //= FAN
        for _, a, b in above:
            folded = _h(a + folded + b)
        rows.append((row_id, leaf, subroot, root, _h("".join(siblings) + tail), folded))
    return pd.DataFrame(rows, columns=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def tampered_text(row_id: Column, text: Column, every: int = 5) -> Column:
    """What a tamperer makes of a text: A-Z in lower case where ``every`` divides the id's
    crc32, NULL where it is left alone."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    hit = F.coalesce(F.crc32(row_id.cast("string")) % every == 0, F.lit(False))
    return F.when(hit & text.rlike("[A-Z]"), F.translate(text, upper, upper.lower()))


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    tampered=tampered_text,
) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Leaves of one source ascend by id (NULL first), rows of one id by their digest, so that
    equal rows may stand in any order without changing a digest.  A NULL source is a source of
    its own and comes first.  NULL fields are told apart from empty ones.  ``tampered`` gives
    the text that a row is verified with instead of its own, NULL for its own; ``root`` and
    the proof are of the rows as they are.  A single row is its own subroot and root, with
    the digest of nothing as proof.  An empty table gives no rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    changed = tampered(F.col(id_col), F.col(text_col))
    as_is = [F.col(c) for c in fields]
    instead = [F.col("_changed") if c == text_col else F.col(c) for c in fields]
    rows = docs.withColumn("_changed", changed).select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        null_key(F.col(source_col)).alias("tree"),
        digest_of(as_is).alias("leaf"),
        F.when(F.col("_changed").isNotNull(), digest_of(instead)).alias("tampered"),
    )
    rows = stage(rows, "leaves")
    leaves = placed(rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "ordered")
    leaves = leaves.withColumn("block", F.floor(F.col("place") / BLOCK))
    blocks = stage(_block_tops(leaves), "blocks")
    levels, subroots = _tree(blocks, "runs")

    named = rows.groupBy("tree").agg(F.first("source").alias("source"))
    named = named.join(subroots, "tree").select(
        F.lit("").alias("tree"), F.col("tree").alias("of"), "source", "digest"
    )
    sources = placed(named, [F.col("source").asc_nulls_first()], "subroots")
    sources = stage(sources, "sources")
    tops, _ = _tree(sources.select("tree", "place", "digest", "size"), "tops")

    outer = blocks.select("tree", F.col("place").alias("block"), "place")
    inside = _outside(outer, levels, 0)
    above = _outside(sources.select("tree", "of", "place"), tops, ABOVE)
    needed = outer.select("tree", "block", F.lit(-1).alias("level"), F.lit(0).alias("mine"),
                          F.array(F.lit("")).alias("digests")).limit(0)
    columns = ["tree", "block", "level", "mine", "digests"]
    if inside is not None:
        needed = needed.union(inside.select(columns))
    if above is not None:
        above = stage(above.select(F.col("of").alias("tree"), "level", "mine", "digests"), "above")
        n = above.limit(MAX_BROADCAST_RUNS + 1).count()
        bound = n if n <= MAX_BROADCAST_RUNS else None
        met = join_small(outer.select("tree", "block"), above, ["tree"], "inner", bound)
        needed = needed.union(met.select(columns))
    proofs = (
        leaves.select("tree", "block", "place", "size", F.col("doc_id").cast("string").alias("id"),
                      "leaf", "tampered")
        .groupBy("tree", "block")
        .cogroup(needed.groupBy("tree", "block"))
        .applyInPandas(_fold, PROOFS)
    )
    return proofs.select(
        F.col("id").cast(id_type).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
