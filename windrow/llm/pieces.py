"""SentencePiece encoding and decoding on a relational lattice.

No piece reaches over a word's end, so a text is encoded word by word and equal words alike.
Texts are cut into blocks of bounded size where they are read, and each block lists its
different words.  All words are encoded relationally, each once: their substrings up to the
longest piece's length are exploded, joined to the piece table, and the edges found are
grouped by word and folded with a higher-order aggregate to the boundaries of its pieces.
The boundaries go back to the blocks' lists, and each block's lists go to the task that
encodes its texts, before them.  Lists travel packed: a row holds the words that a block and
a bucket of words (by a hash) share.  No table of words is broadcast.

The fold follows the model's kind.  Merging by rank is what a BPE model does: edges are taken
in the order of their rank, leftmost first, and an edge is merged if its two halves are
whole at that time.  The boundaries that are left are bits of a number, which holds words of
up to 62 characters; longer ones are merged in the tasks.  A path of the best sum of scores
(Viterbi) gives other codes than the library for such a model.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from windrow.llm.common import bounded_batches
from windrow.llm.word_arrays import MARK, coded, cut_words, lists_of, parts_of, regrouped, unpacked
from windrow.runtime import discard, stage

WORDS = f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+"
SEGMENT = re.compile(WORDS)
_ZSTD = zstandard.ZstdCompressor(level=3)

# The text of a block, in bytes, and the words that one task folds.
BLOCK_BYTES = 16 << 20
LATTICE_WORDS = 50_000
# A bucket of words for so many bytes of text, and the most buckets; words grow slower than text.
BUCKET_BYTES, MAX_BUCKETS = 4 << 20, 4096
# Lists of words whose ids are looked up at a time, and ids that are decoded at a time.
LISTS_AT_ONCE = 16
DECODE_IDS = 1 << 18
# Boundaries of a word are bits of a long.
FOLD_CHARS = 62


@dataclass
class Pieces:
    """The piece table: text, id and rank (equal scores share one), and the ids of bytes."""

    ids: dict[str, int]
    ranks: dict[str, int]
    byte_ids: list[int]
    spelled: list[bytes] = field(repr=False)
    codes: "Codes" = field(init=False, repr=False)
    # The pieces with a space for the mark, and the list of each one's id.
    texts: pa.Array = field(init=False, repr=False)
    lists: pa.ListArray = field(init=False, repr=False)

    def __post_init__(self):
        self.codes = Codes(self)
        self.texts = pa.array([p.replace(MARK, " ") for p in self.ids], pa.string())
        self.lists = lists_of([np.int32(i).tobytes() for i in self.ids.values()])

    @property
    def longest(self) -> int:
        return max(map(len, self.ids))


class Codes(dict):
    """Pieces to their ids as bytes of 32-bit numbers; other texts to the ids of their bytes."""

    def __init__(self, pieces: Pieces):
        super().__init__({p: np.int32(i).tobytes() for p, i in pieces.ids.items()})
        self.byte_ids = pieces.byte_ids

    def __missing__(self, part: str) -> bytes:
        return np.array([self.byte_ids[b] for b in part.encode()], np.int32).tobytes()


@cache
def load_pieces(model_path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids, scores, byte_ids, spelled = {}, {}, {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        spelled.append(b"")
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelled[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[piece], scores[piece] = i, model.get_score(i)
            spelled[i] = piece.replace(MARK, " ").encode()
    if len(byte_ids) < 256 or any("\n" in p or MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("pieces for all bytes, and none across words, are needed")
    order = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
    ranks = {p: order[s] for p, s in scores.items()}
    return Pieces(ids, ranks, [byte_ids[b] for b in range(256)], spelled)


# --- the relational part ---------------------------------------------------------


def _edge(packed: Column) -> tuple[Column, Column]:
    """Start and end of an edge packed as rank, start, end."""
    bits = lambda shift: F.shiftright(packed, shift).bitwiseAND(F.lit(63)).cast("int")
    return bits(6), bits(0)


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, edges): the pieces of two characters and more inside each word that has any, as
    packed edges, best rank first.

    ``words`` are different and partitioned by word, so grouping them again moves nothing.
    """
    rows = [(p, pieces.ranks[p] << 12) for p in pieces.ids if len(p) > 1]
    table = words.sparkSession.createDataFrame(rows, "piece string, code long")
    length = F.char_length("word")
    starts = words.filter(length > 1).select(
        "word", F.explode(F.sequence(F.lit(0), length - 2)).alias("start")
    )
    room = F.least(F.lit(pieces.longest), length - F.col("start"))
    spans = starts.select("word", "start", F.explode(F.sequence(F.lit(2), room)).alias("chars"))
    spans = spans.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("chars")))
    # As many rows as the vocabulary has pieces.
    found = spans.join(F.broadcast(table), "piece")
    place = F.col("start") * 64 + F.col("start") + F.col("chars")
    found = found.select("word", F.col("code").bitwiseOR(place.cast("long")).alias("edge"))
    return found.groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges"))


def _power(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def merged(word: Column, edges: Column) -> Column:
    """The boundaries that merging leaves, as the bits of a long."""

    def merge(left: Column, packed: Column) -> Column:
        start, end = _edge(packed)
        inner = _power(end) - _power(start + 1)
        halves = left.bitwiseAND(inner)
        ends = _power(start).bitwiseOR(_power(end))
        whole = (
            (left.bitwiseAND(ends) == ends)
            & (halves != 0)
            & (halves.bitwiseAND(halves - 1) == 0)
        )
        return F.when(whole, left.bitwiseAND(F.bitwise_not(inner))).otherwise(left)

    return F.aggregate(edges, _power(F.char_length(word) + 1) - 1, merge)


# Words a task may group before Spark falls back to sorting their edges.
GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


def word_bounds(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, bounds) of the words in which anything merges; each word may be listed often."""
    spark = words.sparkSession
    words = stage(words.select("word"), "words")
    n = max(spark.sparkContext.defaultParallelism, -(-words.count() // LATTICE_WORDS))
    dealt = words.repartition(n, "word").distinct()
    word, edges = F.col("word"), F.col("edges")
    before = spark.conf.get(GROUPS)
    spark.conf.set(GROUPS, str(2 * LATTICE_WORDS))
    try:
        return stage(lattice(dealt, pieces).select("word", merged(word, edges).alias("bounds")), "bounds")
    finally:
        spark.conf.set(GROUPS, before)
        discard(words)


# --- in the tasks ----------------------------------------------------------------


class Encoder(dict):
    """Words to their ids as bytes of 32-bit numbers, by the boundaries known of the words.

    A word without, longer than a number has bits, is merged here.
    """

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        code = self.coded(self.fold(word))
        if len(word) <= FOLD_CHARS:
            self[word] = code
        return code

    def learn(self, word: str, bounds: int) -> None:
        """Bit n is set if a piece ends before character n; 0 where nothing merges."""
        parts, at = [], 0
        bounds = bounds or (2 << len(word)) - 1
        for end in range(1, len(word) + 1):
            if bounds >> end & 1:
                parts.append(word[at:end])
                at = end
        self[word] = self.coded(parts)

    def coded(self, parts: list[str]) -> bytes:
        codes = self.pieces.codes
        return b"".join([codes[p] for p in parts])

    def fold(self, word: str) -> list[str]:
        """Merge by rank, leftmost first.  A long word keeps its candidates in a heap."""
        ranks = self.pieces.ranks
        if len(word) > FOLD_CHARS:
            parts = self._merged_long(word)
        else:
            parts = list(word)
            found = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            while True:
                best = at = None
                for i, rank in enumerate(found):
                    if rank is not None and (best is None or rank < best):
                        best, at = rank, i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                del found[at]
                if at:
                    found[at - 1] = ranks.get(parts[at - 1] + parts[at])
                if at < len(found):
                    found[at] = ranks.get(parts[at] + parts[at + 1])
        return parts

    def _merged_long(self, word: str) -> list[str]:
        from heapq import heapify, heappop, heappush

        ranks = self.pieces.ranks
        parts: list[str | None] = list(word)
        left = list(range(-1, len(parts) - 1))
        right = [*range(1, len(parts)), -1]
        heap = [
            (ranks[a + b], i, a + b)
            for i, (a, b) in enumerate(zip(parts, parts[1:]))
            if a + b in ranks
        ]
        heapify(heap)
        while heap:
            _, i, joined = heappop(heap)
            j = right[i]
            if parts[i] is None or j < 0 or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for a in (left[i], i):
                if a >= 0 and right[a] >= 0:
                    near = parts[a] + parts[right[a]]
                    if near in ranks:
                        heappush(heap, (ranks[near], a, near))
        return [p for p in parts if p is not None]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.__getitem__, words_of(text)))


def words_of(text: str) -> list[str]:
    """The words of a text that is not empty, each with the marks before it."""
    return SEGMENT.findall(MARK + text.replace(" ", MARK))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches and the block of each row: the task's own numbers, a new one every so many bytes.

    It goes by the order of rows alone, so reading the rows again numbers them alike.  Where
    their order changes, a block lists words that it has not, and merges others itself.
    """
    first, total = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = total + np.cumsum(sizes, dtype=np.int64)
        yield batch, first + (ends - sizes) // BLOCK_BYTES
        total = int(ends[-1]) if len(ends) else total


def _runs(blocks: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each block of the rows of a batch, with its first row and the one behind its last."""
    cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
    return ((int(blocks[lo]), lo, hi) for lo, hi in zip(cuts, cuts[1:]) if lo < hi)


def _compressed(data: bytes) -> bytes:
    return _ZSTD.compress(data)


def _unpack_words(data: bytes) -> list[str]:
    """Only a word that is not packed, a line's end, holds a line's end."""
    return zstandard.decompress(data).decode().split("\n")


LISTS = "bucket int, block long, words binary"


def _list_words(n_buckets: int):
    """The different words of each block that the lattice folds, by bucket.

    A word of one character has nothing to merge.
    """

    def listed(block, words):
        words = pa.chunked_array(words, pa.string()).unique()
        size = pc.utf8_length(words)
        words = words.filter(pc.and_(pc.greater(size, 1), pc.less_equal(size, FOLD_CHARS)))
        words = pc.replace_substring(words.take(pc.array_sort_indices(words)), " ", MARK)
        if len(words):
            numbers = np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()]) % n_buckets
            order = np.argsort(numbers, kind="stable")
            begins = np.flatnonzero(np.diff(numbers[order], prepend=-1))
            ends = pa.array(np.append(begins, len(order)), pa.int32())
            texts = pc.binary_join(pa.ListArray.from_arrays(ends, words.take(pa.array(order))), "\n")
            data = [_compressed(t) for t in texts.cast(pa.binary()).to_pylist()]
            yield pa.record_batch(
                [pa.array(numbers[order[begins]], pa.int32()), pa.array([block] * len(data), pa.int64()),
                 pa.array(data, pa.binary())],
                names=["bucket", "block", "words"],
            )

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, []
        for batch, blocks in _blocks(batches):
            for block, lo, hi in _runs(blocks):
                if block != current:
                    yield from listed(current, seen)
                    current, seen = block, []
                seen.append(cut_words(batch.column("text").slice(lo, hi - lo))[0].unique())
        yield from listed(current, seen)

    return list_words


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists in the order of their buckets to (word), each of a bucket once."""
    current, seen = None, set()
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist()):
            if bucket != current:
                current, seen = bucket, set()
            new = [w for w in _unpack_words(data) if w not in seen]
            seen.update(new)
            yield pa.record_batch([pa.array(new, pa.string())], names=["word"])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The boundaries of a bucket's words, then its lists, to each list and its words' boundaries.

    A word without an answer, 0, has nothing to merge.  One bucket is held at a time.
    """
    current, known = None, {}
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("bucket", "word", "bounds", "block", "words")]
        blocks, words, answers = [], [], []
        for bucket, word, bounds, block, listed in zip(*columns):
            if bucket != current:
                current, known = bucket, {}
            if word is not None:
                known[word] = bounds
                continue
            found = np.array([known.get(w, 0) for w in _unpack_words(listed)], np.int64)
            blocks.append(block)
            words.append(listed)
            answers.append(_compressed(found.tobytes()))
        yield pa.record_batch(
            [pa.array(blocks, pa.int64()), pa.array(words, pa.binary()), pa.array(answers, pa.binary())],
            names=["block", "words", "bounds"],
        )


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, rows): rows of one block, packed as a compressed Arrow stream."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch, blocks in _blocks(batches):
        for block, lo, hi in _runs(blocks):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
                stream.write_batch(batch.slice(lo, hi - lo))
            yield pa.record_batch(
                [pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["block", "rows"],
            )


def _block_encoder(model_path: str, decode: bool):
    """Rows of a block, its words before its texts: one block's words and texts are held at a time."""

    def listed(pieces: Pieces, lists: list[tuple[bytes, bytes]]) -> tuple[pa.Array, pa.ListArray]:
        """The words of some lists, and their ids."""
        words = pa.concat_arrays([unpacked(zstandard.decompress(w)) for w, _ in lists])
        bounds = np.frombuffer(b"".join(zstandard.decompress(b) for _, b in lists), np.int64)
        parts, counts = parts_of(words, bounds)
        at = pc.index_in(parts, value_set=pieces.texts)
        return words, regrouped(coded(parts, at, pieces.lists, pieces.codes.__getitem__), counts)

    def encoded(pieces: Pieces, lists: list[tuple[bytes, bytes]], packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        told = [listed(pieces, lists[lo : lo + LISTS_AT_ONCE]) for lo in range(0, len(lists), LISTS_AT_ONCE)]
        known = pa.concat_arrays([pa.array([], pa.string()), *(w for w, _ in told)])
        codes = pa.concat_arrays([lists_of([]), *(c for _, c in told)])
        rows = [r for p in packed for r in pa.ipc.open_stream(p)]
        cut = [cut_words(r.column("text")) for r in rows]
        kept = [r.column("kept") for r in rows]
        del told, rows
        # All at once, since the words that are known are hashed anew for each call.
        places = pc.index_in(pa.chunked_array([w for w, _ in cut], pa.string()), value_set=known)
        places = pa.concat_arrays([pa.array([], pa.int32()), *places.chunks])
        code_of, done = Encoder(pieces).__getitem__, 0
        for own, (words, before) in zip(kept, cut):
            at = places.slice(done, len(words))
            done += len(words)
            ids = regrouped(coded(words, at, codes, code_of), np.diff(before))
            out = {"kept": own, "ids": ids}
            if decode:
                out["decoded"] = _decoded(ids, pieces.spelled)
            yield pa.record_batch(list(out.values()), names=list(out))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, current, lists, texts = load_pieces(model_path), None, [], []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("block", "words", "bounds", "rows")]
            for block, words, bounds, packed in zip(*columns):
                if block != current and texts:
                    yield from encoded(pieces, lists, texts)
                if block != current:
                    current, lists, texts = block, [], []
                if packed is None:
                    lists.append((words, bounds))
                else:
                    texts.append(packed)
        if texts:
            yield from encoded(pieces, lists, texts)

    return encode


def encode_texts(
    docs: DataFrame, model_path: str, columns: list[str], text_col: str = "text", decode: bool = False
) -> DataFrame:
    """The given columns of all rows, and ``ids``: the piece ids of each whole text.

    With ``decode`` also ``decoded``, the text that the ids spell, without another Python worker.
    """
    bounded_batches(docs.sparkSession)
    pieces = load_pieces(model_path)
    rows = docs.select(F.struct(*columns).alias("kept"), F.col(text_col).alias("text"))
    kept = rows.schema["kept"].dataType
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = min(MAX_BUCKETS, 1 + size // BUCKET_BYTES)
    lists = stage(rows.select("text").mapInArrow(_list_words(n_buckets), LISTS), "lists")
    by_bucket = lists.repartition("bucket").sortWithinPartitions("bucket")
    bounds = word_bounds(by_bucket.mapInArrow(_different, "word string"), pieces)
    null = lambda kind: F.lit(None).cast(kind)
    of_word = F.crc32(F.col("word").cast("binary")) % n_buckets
    asked = bounds.select(of_word.cast("int").alias("bucket"), F.lit(False).alias("asks"), "word", "bounds",
                          null("long").alias("block"), null("binary").alias("words"))
    asked = asked.unionAll(lists.select(
        "bucket", F.lit(True).alias("asks"), null("string").alias("word"), null("long").alias("bounds"),
        "block", "words"))
    answers = asked.repartition("bucket").sortWithinPartitions("bucket", "asks").mapInArrow(
        _answer, "block long, words binary, bounds binary"
    )
    # Staged, so that neither the shuffle of the questions nor what they were made of stands on
    # the disk beside the shuffle of the texts.
    answers = stage(answers, "answers")
    discard(lists)
    discard(bounds)
    lists = answers.select("block", F.lit(False).alias("is_text"), "words", "bounds", null("binary").alias("rows"))
    texts = rows.mapInArrow(_pack_texts, "block long, rows binary").select(
        "block", F.lit(True).alias("is_text"), null("binary").alias("words"), null("binary").alias("bounds"), "rows")
    met = lists.unionAll(texts).repartition("block").sortWithinPartitions("block", "is_text")
    out = StructType().add("kept", kept).add("ids", ArrayType(IntegerType()))
    if decode:
        out = out.add("decoded", "string")
    return met.mapInArrow(_block_encoder(model_path, decode), out).select("kept.*", *out.names[1:])


def _decoded(batch: pa.Array, spelled: list[bytes]) -> pa.Array:
    """The text of each list of ids, so many ids at a time."""
    lengths = np.array([len(x) for x in spelled])
    begins = np.cumsum(lengths) - lengths
    letters = np.frombuffer(b"".join(spelled), np.uint8)
    counts = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
    step = np.cumsum(counts, dtype=np.int64) // DECODE_IDS
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(batch)]
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        ids = batch[lo:hi].flatten().to_numpy(zero_copy_only=False)
        data, ends = _spell(ids, lengths, begins, letters)
        bounds = ends[np.append(0, np.cumsum(counts[lo:hi]))].tolist()
        texts = (data[i:j] for i, j in zip(bounds, bounds[1:]))
        out += [t[t[:1] == b" " :].decode("utf-8", "replace") for t in texts]
    return pa.array(out, pa.string())


def _spell(ids, lengths, begins, letters) -> tuple[bytes, np.ndarray]:
    """The bytes of pieces one after another, and where each piece ends, from 0 on."""
    n = lengths[ids]
    ends = np.append(0, np.cumsum(n))
    at = np.arange(ends[-1]) + np.repeat(begins[ids] - ends[:-1], n)
    return letters[at].tobytes(), ends


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """Rows (doc_id, ids, decoded): the piece ids of each whole text, and the text they spell.

    The ids are those of the library without begin, end or other added ids.  A NULL text
    counts as empty and has no ids.  Decoding gives the text back, but for a U+2581, which is
    a space to the vocabulary.  Every row gives a row, repeated ids and NULL ids too; an empty
    table gives none; other columns are not read.
    """
    return encode_texts(docs, model_path, ["doc_id"], decode=True)
