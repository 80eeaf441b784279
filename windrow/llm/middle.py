"""Fill-in-middle over seekable compressed frames.

``store_frames`` writes each text as independent zstandard frames with the numbers of units
(lines) and characters before each.  To cut a text, only the frame in which a cut lies is
decompressed; all others go into the output as they are.  Digests are taken of the frames in
order, one at a time, so that no whole text is ever held beside its frames.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import bounded_batches
from windrow.runtime import stage

FRAME_BYTES = 64 << 10
LEVEL = 1
# Texts up to so many bytes keep their decompressed frames while they are worked on.
KEPT_BYTES = 256 << 10
OUT_BYTES = 4 << 20

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# The order of the parts in the output, by form.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

CONTINUED = bytes(range(0x80, 0xC0))


def n_chars(data: bytes) -> int:
    return len(data.translate(None, CONTINUED))


@cache
def _codec():
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()


def compress(data: bytes) -> bytes:
    return _codec()[0].compress(data)


def decompress(frame: bytes) -> bytes:
    return _codec()[1].decompress(frame)


STORED = (
    "doc_id {id}, n_units long, n_chars long, marked boolean,"
    " frames array<struct<units: long, chars: long, data: binary>>"
)


def frames_of(text: bytes, frame_bytes: int) -> Iterator[tuple[int, int, bytes]]:
    """(lines ended before, characters before, frame) of a text, cut between characters."""
    units = chars = lo = 0
    while lo < len(text):
        hi = min(lo + frame_bytes, len(text))
        while hi < len(text) and hi > lo + 1 and 0x80 <= text[hi] < 0xC0:
            hi -= 1
        part = text[lo:hi]
        yield units, chars, compress(part)
        units += part.count(b"\n")
        chars += n_chars(part)
        lo = hi


def _batched(rows: Iterator[tuple[tuple, int]], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row, n in rows:
        held.append(row)
        size += n
        if size >= OUT_BYTES or len(held) == 1000:
            yield _batch(held, arrow)
            held, size = [], 0
    if held:
        yield _batch(held, arrow)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
    return pa.record_batch(columns, schema=arrow)


FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])


def _store_rows(frame_bytes: int):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                frames = [
                    {"units": u, "chars": c, "data": d} for u, c, d in frames_of(text, frame_bytes)
                ]
                lines = text.count(b"\n") + (not text.endswith(b"\n") and text != b"")
                marked = any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
                row = (doc_id.as_py(), lines, n_chars(text), marked, frames)
                yield row, sum(len(f["data"]) for f in frames)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        arrow = pa.schema([
            ("doc_id", first.column(0).type), ("n_units", pa.int64()), ("n_chars", pa.int64()),
            ("marked", pa.bool_()), ("frames", pa.list_(FRAME)),
        ])
        yield from _batched(texts(_chained(first, batches)), arrow)

    return rows


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def store_frames(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """One row per text, with its frames: ``doc_id, n_units, n_chars, marked, frames``.

    ``units`` of a frame are the lines that end before it, ``chars`` the characters before
    it; ``marked`` says that the text holds a marker itself.  A NULL text counts as empty and has no
    frames; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    read = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    schema = STORED.format(id=docs.schema[id_col].dataType.simpleString())
    return read.mapInArrow(_store_rows(frame_bytes), schema)


class Frames:
    """Frames in order; short texts keep what was decompressed."""

    def __init__(self, frames: list[bytes]):
        import zstandard

        self.frames = frames
        self.sizes = [zstandard.frame_content_size(f) for f in frames]
        self.kept: dict[int, bytes] | None = {} if sum(self.sizes) <= KEPT_BYTES else None

    def read(self, i: int) -> bytes:
        if self.kept is None:
            return decompress(self.frames[i])
        if i not in self.kept:
            self.kept[i] = decompress(self.frames[i])
        return self.kept[i]

    def digest(self) -> str:
        sha = hashlib.sha256()
        for i in range(len(self.frames)):
            sha.update(self.read(i))
        return sha.hexdigest()

    def find(self, marks: tuple[bytes, ...]) -> list[int]:
        """Where each mark first stands behind the one before it, in bytes from the start."""
        found, carry, at = [], b"", 0  # ``at``: where the bytes in ``carry`` begin
        for i in range(len(self.frames)):
            window, lo = carry + self.read(i), 0
            while len(found) < len(marks):
                hit = window.find(marks[len(found)], lo)
                if hit < 0:
                    break
                found.append(at + hit)
                lo = hit + len(marks[len(found) - 1])
            if len(found) == len(marks):
                break
            carry = window[max(lo, len(window) - 2) :]
            at += len(window) - len(carry)
        return found

    def digest_of(self, spans: list[tuple[int, int]]) -> str:
        """Of spans of bytes, in the order given; frames outside of them are not read."""
        sha = hashlib.sha256()
        for lo, hi in spans:
            at = 0
            for i, size in enumerate(self.sizes):
                if at < hi and at + size > lo:
                    sha.update(self.read(i)[max(0, lo - at) : hi - at])
                at += size
        return sha.hexdigest()


def restored_digest(output: Frames, form: str) -> str:
    """The digest of the text that an output was made of, from the output and its form alone."""
    if form not in ORDERS:
        return output.digest()
    order, end = ORDERS[form], sum(output.sizes)
    starts = output.find(order)
    spans = {
        mark: (at + len(mark), until)
        for mark, at, until in zip(order, starts, [*starts[1:], end])
    }
    return output.digest_of([spans[m] for m in (PREFIX, MIDDLE, SUFFIX)])


def cut_at(stored: list[dict], source: Frames, n_units: int, total: int, k: int) -> tuple[int, int, int]:
    """(frame, byte in it, characters before) of the cut behind ``k`` units."""
    if k == 0:
        return 0, 0, 0
    if k == n_units:
        return len(stored), 0, total
    i = bisect_left(stored, k, key=lambda f: f["units"]) - 1
    data = source.read(i)
    at = len(data) - len(data.split(b"\n", k - stored[i]["units"])[-1])
    return i, at, stored[i]["chars"] + n_chars(data[:at])


def part_of(source: Frames, lo: tuple[int, int], hi: tuple[int, int]) -> list[bytes]:
    """Frames of the text between two cuts; those without a cut are taken as they are."""
    (i, a), (j, b) = lo, hi
    if i == j:
        return [compress(source.read(i)[a:b])] if b > a else []
    out = [compress(source.read(i)[a:])] if a else source.frames[i : i + 1]
    out = [*out, *source.frames[i + 1 : j]]
    return [*out, compress(source.read(j)[:b])] if b else out


MADE = (
    "doc_id {id}, n long, form string, prefix_chars long, middle_chars long,"
    " output array<binary>, output_sha256 string, restored_sha256 string"
)


def _middle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = {m: compress(m) for m in (PREFIX, SUFFIX, MIDDLE)}

    def rows(batches):
        for batch in batches:
            for row in zip(*batch.columns):
                doc_id, n, total, form, first, last, stored = (c.as_py() for c in row)
                source = Frames([f["data"] for f in stored])
                out, chars = source.frames, (None, None)
                if form in ORDERS:
                    i, a, before = cut_at(stored, source, n, total, first)
                    j, b, until = cut_at(stored, source, n, total, last)
                    end = (len(stored), 0)
                    parts = {
                        PREFIX: part_of(source, (0, 0), (i, a)),
                        MIDDLE: part_of(source, (i, a), (j, b)),
                        SUFFIX: part_of(source, (j, b), end),
                    }
                    out = [f for m in ORDERS[form] for f in (marks[m], *parts[m])]
                    chars = before, until - before
                made = Frames(out)
                done = (doc_id, n, form, *chars, out, made.digest(), restored_digest(made, form))
                yield done, sum(map(len, out))

    first = next(batches, None)
    if first is None:
        return
    arrow = pa.schema([
        ("doc_id", first.column(0).type), ("n", pa.int64()), ("form", pa.string()),
        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
        ("output", pa.list_(pa.binary())), ("output_sha256", pa.string()),
        ("restored_sha256", pa.string()),
    ])
    yield from _batched(rows(_chained(first, batches)), arrow)


def _drawn(doc_id: Column, seed: str, i: int) -> Column:
    """The i-th group of 8 hex digits of the digest of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * i - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    seed: str = "7",
    rate: int = 100,
    spm_rate: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Per text: ``doc_id, n, form, prefix_chars, middle_chars, output, output_sha256,
    restored_sha256``.

    ``n`` lines, cut at two places drawn from the id; ``output`` are frames whose contents, one
    after the other, are the rearranged text (``decompress`` reads one).  ``form`` is ``psm``,
    ``spm`` or ``plain``: the last for empty and NULL texts, texts that hold a marker, and all
    but ``rate`` percent of the others.  Rows of one id are cut at places drawn alike; a NULL id
    is drawn as an empty one.  An empty table gives no rows; other columns are not read.
    """
    stored = stage(store_frames(docs, id_col, text_col, frame_bytes), "frames")
    places = F.col("n_units") + 1
    one, two = (_drawn(F.col("doc_id"), seed, i) % places for i in (1, 2))
    plain = (F.col("n_chars") == 0) | F.col("marked") | (_drawn(F.col("doc_id"), seed, 3) % 100 >= rate)
    spm = _drawn(F.col("doc_id"), seed, 4) % 100 < spm_rate
    chosen = stored.select(
        "doc_id",
        "n_units",
        "n_chars",
        F.when(plain, "plain").when(spm, "spm").otherwise("psm").alias("form"),
        F.least(one, two).alias("first"),
        F.greatest(one, two).alias("last"),
        "frames",
    )
    schema = MADE.format(id=docs.schema[id_col].dataType.simpleString())
    return chosen.mapInArrow(_middle_rows, schema)
