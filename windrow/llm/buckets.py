"""Links inside buckets of candidates without all their pairs: hubs, then what hubs leave."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.components import components
from windrow.runtime import stage


def shared_buckets(keys: DataFrame) -> DataFrame:
    """(key, node, degree) of the keys that several nodes have; ``degree`` counts a node's
    fellows over all its buckets.  ``keys`` holds a node once per key."""
    counted = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    counted = stage(counted, "counted")  # joins of plain tables are split where a key is hot
    members = stage(keys.join(counted, "key"), "buckets")
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    return stage(members.drop("n").join(degree, "node"), "members")


def link_buckets(
    members: DataFrame,
    links_of: Callable[[DataFrame], DataFrame],
    pairs_across: Callable[[DataFrame], DataFrame],
    hub_rounds: int,
    near: Callable[[str, str], Column] | None = None,
    found: DataFrame | None = None,
) -> DataFrame | None:
    """(node, label) of the components that links inside buckets make; None without any bucket.

    In every round the members of a bucket that are not in its hub's component are compared
    with the hub (``links_of`` keeps the pairs (a, b) that are links).  The first hub is the
    member of the highest degree, as the original of a group of copies is; later ones are
    drawn.  In the last round ``pairs_across`` gives the pairs across components that may
    still be links, so that none between components is lost.  ``near`` tells from the hashes
    ``sim`` of two members whether they are to be compared at all; ``found`` are links known
    before.
    """
    labels, tried = None if found is None else components(found), None
    for hub_round in range(hub_rounds + 1):
        across = _several_components(members, labels)
        if across.isEmpty():
            break
        pairs = (
            _hub_pairs(across, hub_round, near)
            if hub_round < hub_rounds
            else pairs_across(across)
        )
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.union(pairs)
        links = links_of(pairs)
        if links.isEmpty():
            continue  # the components are what they were
        found = links if found is None else found.union(links)
        labels = components(found)
    return labels


def _several_components(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold more than one component, with their label."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    labelled = members.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    labelled = stage(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = stage(mixed.filter(F.col("lo") != F.col("hi")).select("key"), "mixed_keys")
    return stage(labelled.join(mixed, "key"), "mixed")


def _hub_pairs(across: DataFrame, hub_round: int, near) -> DataFrame:
    """Each member with its bucket's hub, where their components differ: (a, b), ``a`` the hub."""
    first = F.col("degree") if not hub_round else F.xxhash64("node", F.lit(hub_round))
    sim = ["sim"] if near else []
    hubs = across.groupBy("key").agg(
        F.max(F.struct(first.alias("by"), "node", "label", *sim)).alias("h")
    )
    hubs = stage(hubs, "hubs")
    hubs = hubs.select(
        "key",
        F.col("h.node").alias("a"),
        F.col("h.label").alias("hub_label"),
        *[F.col("h.sim").alias("hub_sim") for _ in sim],
    )
    joined = across.join(hubs, "key").filter(F.col("label") != F.col("hub_label"))
    if near:
        joined = joined.filter(near("sim", "hub_sim"))
    return joined.select("a", F.col("node").alias("b")).distinct()
