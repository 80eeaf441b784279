"""Exact top-k by inner product: columnar branch and bound.

Vectors lie in blocks, dimension by dimension.  A query adds up its products with all
candidates of a block over one group of dimensions after another.  What the dimensions to
come can still add is bounded by the product of the two remaining lengths (Cauchy-Schwarz);
candidates whose best case is below the k-th best worst case go, and the next group is added
up for the compacted rest alone.  The bound never cuts a tie, so the result is exact.

Queries are a part of the rows and grow with them, so neither side is broadcast: candidates
are packed where they are read and sent once, to one of the shards, whose size is bounded in
bytes.  Queries are packed into blocks, and each block follows to every shard.  A task holds one
shard at a time, lets the blocks stream by, and answers with k rows per query.  Packed
components take the fewest of 2, 4 or 8 bytes that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import bounded_batches
from windrow.runtime import stage

SCALE = 256
# A shard's components at two bytes each; a task works on four times that.
SHARD_BYTES = 16 << 20
# Fewer rows than this are not worth a shard of their own.
SHARD_ROWS = 4096
# Most rows and components of a packed piece, and of what is multiplied at once.
CHUNK_ROWS, CHUNK_ITEMS = 1024, 1 << 20
SLICE_ROWS, SLICE_ITEMS = 20_000, 1 << 22
QUERY_ROWS = 512
GROUP_DIMS = 16
# Products and sums up to here are exact in a double.
EXACT = 1 << 53
LONG = (1 << 63) - 1


def quantised(vector: Column) -> Column:
    """floor(256 * x) per component; NULL unless all components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    parts = F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    return F.when(F.forall(vector, finite), parts)


def _matrix(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Flat components and lengths of vectors as one matrix, a row per dimension.

    Shorter vectors are filled up with zeros, which add nothing to a product.
    """
    lengths = np.concatenate([n for _, n in parts])
    dims = int(lengths.max(initial=0))
    matrix = np.zeros((len(lengths), dims), np.int64)
    matrix[np.arange(dims) < lengths[:, None]] = np.concatenate([flat for flat, _ in parts])
    return np.ascontiguousarray(matrix.T)


def _packed(part: int, ids: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    low, high = int(matrix.min(initial=0)), int(matrix.max(initial=0))
    fits = lambda t: np.iinfo(t).min <= low and high <= np.iinfo(t).max
    dtype = next(t for t in (np.int16, np.int32, np.int64) if fits(t))
    return pa.record_batch(
        [pa.array([part], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
         pa.array([dtype().itemsize], pa.int32()),
         pa.array([matrix.astype(dtype).tobytes()], pa.binary())],
        names=["part", "ids", "width", "matrix"],
    )


PACKED = "part long, ids binary, width int, matrix binary"


def _packer(most_rows: int):
    """Rows (id, vector) as pieces of at most ``most_rows`` rows, numbered from the task's own."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, vectors, rows, items = [], [], 0, 0
        for batch in batches:
            lists = batch.column("vector")
            starts = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            numbers = batch.column("vec_id").to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                # As many more rows as the piece has room for, at least one if it is empty.
                room = CHUNK_ITEMS - items
                end = int(np.searchsorted(starts, starts[at] + room, "right")) - 1
                end = min(max(end, at + (rows == 0)), at + most_rows - rows, batch.num_rows)
                if end > at:
                    ids.append(numbers[at:end])
                    vectors.append((flat[starts[at] : starts[end]], np.diff(starts[at : end + 1])))
                    rows, items = rows + end - at, items + int(starts[end] - starts[at])
                    at = end
                if at < batch.num_rows:
                    yield _packed(part, np.concatenate(ids), _matrix(vectors))
                    part += 1
                    ids, vectors, rows, items = [], [], 0, 0
        if rows:
            yield _packed(part, np.concatenate(ids), _matrix(vectors))

    return pack


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    matrix = np.frombuffer(row["matrix"], np.dtype(f"i{row['width']}"))
    return ids, matrix.reshape(-1, len(ids)).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = at[scores >= np.partition(scores, -k)[-k]]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search_block(qids, queries, cids, candidates, k: int):
    """(query id, candidate id, score) of the k best candidates of each query.

    ``queries`` and ``candidates`` are integer matrices with a row per dimension.
    """
    for i, cid, score in _search(qids, queries, cids, candidates, k, [-np.inf] * len(qids)):
        yield int(qids[i]), cid, score


def _search(qids, queries, cids, candidates, k: int, floors):
    """(place of the query, candidate id, score); of candidates below a query's floor, none need come."""
    dims = min(len(queries), len(candidates))
    queries, candidates = queries[:dims], candidates[:dims]
    largest = [int(np.abs(m.astype(np.float64)).max(initial=0)) for m in (queries, candidates)]
    if largest[0] * largest[1] * max(dims, 1) >= EXACT:
        yield from _search_large(qids, queries, cids, candidates, k)
        return
    q, c = queries.T.astype(np.float64), candidates.astype(np.float64)
    cuts = list(range(0, dims, GROUP_DIMS)) or [0]
    rest = lambda m, lo: np.sqrt(np.square(m[lo:]).sum(axis=0))
    q_rest = [rest(q.T, lo) for lo in cuts]
    c_rest = [rest(c, lo) for lo in cuts]
    first = q[:, :GROUP_DIMS] @ c[:GROUP_DIMS]
    for i, qid in enumerate(qids):
        alive = np.flatnonzero(cids != qid)
        sums = first[i, alive]
        for n, lo in enumerate(cuts[1:], 1):
            if len(alive) > k:
                # A little more than the bound, for the rounding of the square roots.
                reach = q_rest[n][i] * c_rest[n][alive] * (1 + 1e-9) + 1e-6
                worst = max(np.partition(sums - reach, -k)[-k], floors[i])
                keep = sums + reach >= worst
                alive, sums = alive[keep], sums[keep]
            sums = sums + q[i, lo : lo + GROUP_DIMS] @ c[lo : lo + GROUP_DIMS, alive]
        for at in _best(sums, cids[alive], k):
            yield i, int(cids[alive[at]]), int(sums[at])


def _search_large(qids, queries, cids, candidates, k: int):
    """The same in whole numbers of any size; a score beyond 64 bits is cut to them."""
    q, c = queries.T.astype(object), candidates.T.astype(object)
    for i, (qid, query) in enumerate(zip(qids, q)):
        scored = sorted(
            (-int(sum(x * y for x, y in zip(query, row))), int(cid))
            for cid, row in zip(cids, c)
            if cid != qid
        )
        for score, cid in scored[:k]:
            yield i, cid, max(-LONG - 1, min(LONG, -score))


def _slices(pieces: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pieces put together to matrices of bounded size."""
    groups, rows, dims = [], 0, 0
    for ids, matrix in pieces:
        rows, dims = rows + len(ids), max(dims, len(matrix))
        if not groups or rows > SLICE_ROWS or rows * dims > SLICE_ITEMS:
            groups.append([])
            rows, dims = len(ids), len(matrix)
        groups[-1].append((ids, matrix))
    slices = []
    for group in groups:
        dims = max(len(m) for _, m in group)
        filled = [np.pad(m, ((0, dims - len(m)), (0, 0))) for _, m in group]
        slices.append((np.concatenate([ids for ids, _ in group]), np.concatenate(filled, axis=1)))
    return slices


def search_shard(qids, queries, slices, k: int):
    """(query id, candidate id, score) of the k best of each query in all slices of a shard.

    What is found in one slice is the floor for the next.
    """
    best = [[] for _ in qids]
    for cids, candidates in slices:
        floors = [-found[k - 1][0] if len(found) == k else -np.inf for found in best]
        for i, cid, score in _search(qids, queries, cids, candidates, k, floors):
            best[i].append((-score, cid))
        best = [sorted(found)[:k] for found in best]
    for qid, found in zip(qids, best):
        for score, cid in found:
            yield int(qid), cid, -score


def _searcher(k: int):
    """Rows of a shard, candidates before queries: one shard is held at a time."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, pieces, slices = None, [], []
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                if row["shard"] != shard:
                    shard, pieces, slices = row["shard"], [], []
                if not row["asks"]:
                    pieces.append(_unpack(row))
                    continue
                if pieces:
                    pieces, slices = [], _slices(pieces)
                found = list(search_shard(*_unpack(row), slices, k))
                columns = zip(*found) if found else ((), (), ())
                yield pa.record_batch(
                    [pa.array(x, pa.int64()) for x in columns],
                    names=["query_id", "vec_id", "score"],
                )

    return search


def meetings(rows: DataFrame, query_every: int) -> tuple[DataFrame, int]:
    """Packed candidates, each in one shard, and query blocks, each in all; and the shards' number."""
    spark = rows.sparkSession
    n, dims = rows.select(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    # Small tables are dealt to all cores, large ones by the bytes a task may hold.
    by_cores = min(2 * spark.sparkContext.defaultParallelism, -(-n // SHARD_ROWS))
    n_shards = max(1, by_cores, -(-n * dims * 2 // SHARD_BYTES))
    # A piece is never more than a fair part of a shard.
    piece = max(1, min(CHUNK_ROWS, -(-n // (4 * n_shards))))
    packed = ["ids", "width", "matrix"]
    candidates = rows.mapInArrow(_packer(piece), PACKED).select(
        F.pmod("part", F.lit(n_shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), *packed
    )
    asked = rows.filter(F.col("vec_id") % query_every == 0)
    queries = asked.mapInArrow(_packer(QUERY_ROWS), PACKED).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), F.lit(True).alias("asks"), *packed
    )
    return candidates.unionAll(queries), n_shards


def top_k(
    vectors: DataFrame,
    k: int = 5,
    query_every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per query its k best: ``query_id, rank, vec_id, score``.

    Queries are the rows whose id is divisible by ``query_every``, candidates all rows but
    those of the query's id.  Vectors that are NULL or hold a NULL or non-finite component, and
    rows with a NULL id, take no part.  Rows that repeat id and vector count once.  Vectors of
    other lengths are compared as if filled up with zeros; an empty vector scores 0.  With
    fewer candidates than k, all are returned; an empty table gives no rows.  Other columns are
    not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("vector")
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).distinct()
    rows = stage(rows, "vectors")
    met, n_shards = meetings(rows, query_every)
    n_tasks = min(n_shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                8 * spark.sparkContext.defaultParallelism))
    by_shard = met.repartitionById(n_tasks, "shard").sortWithinPartitions("shard", "asks")
    found = by_shard.mapInArrow(_searcher(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
