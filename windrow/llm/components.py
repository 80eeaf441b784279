"""Connected components: in one task while links are few, else by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.runtime import ship_package, stage, staging

# Up to so many links, 4 MB, one task finds the components; it holds some ten times that.
FEW_LINKS = 1 << 18
LABELS = "node long, label long"


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links (a, b)``; the label is the component's least node.

    The large star joins a node's larger neighbours to its least one, the small star its
    smaller ones; together they end in stars around the least nodes after about log(n)
    rounds.  Each round is written to the shared folder.  Minima are taken before the
    shuffle, so a node with very many links costs one row per task; the joins back are left
    to the skew handling of adaptive execution.  No links give no rows.
    """
    with staging(links.sparkSession) as result:
        edges = stage(
            links.filter(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .distinct(),
            "links",
        )
        state = _state(edges)
        if state.n <= FEW_LINKS and edges.schema["u"].dataType.simpleString() == "bigint":
            ship_package(links.sparkSession)
            return result(edges.repartition(1).mapInArrow(labels_of, LABELS), "components")
        edges = _stars(edges, state)
        roots = edges.select(F.col("v").alias("node")).distinct()
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        return result(ends.union(roots.select("node", F.col("node").alias("label"))), "components")


def labels_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All of the links (u, v) to (node, label)."""
    ends = [np.stack([c.to_numpy() for c in batch.columns]) for batch in batches]
    ends = np.concatenate([np.zeros((2, 0), np.int64), *ends], axis=1)
    nodes, at = np.unique(ends, return_inverse=True)
    x, y = at.reshape(2, -1)
    label = np.arange(len(nodes))
    while len(x):
        # The greater label of a link's ends takes the least one it meets; then labels are followed to their ends.
        of_x, of_y = label[x], label[y]
        apart = of_x != of_y
        if not apart.any():
            break
        x, y, of_x, of_y = x[apart], y[apart], of_x[apart], of_y[apart]
        np.minimum.at(label, np.maximum(of_x, of_y), np.minimum(of_x, of_y))
        while (label[label] != label).any():
            label = label[label]
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(nodes[label], pa.int64())], names=["node", "label"])


def _stars(edges: DataFrame, before) -> DataFrame:
    while before.n:
        edges = stage(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges


def _state(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def _large_star(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")),
                   F.struct(F.col("v").alias("x"), F.col("u").alias("y")))
    both = edges.select(F.explode(ends).alias("e")).select("e.x", "e.y")
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    joined = both.filter(F.col("y") > F.col("x")).join(least, "x")
    return joined.select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").filter(F.col("v") != F.col("m"))
    return (
        rest.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
