"""SimHashes of normalised lines, and keys under which near ones meet.

A line's features are its words, short ones left out where there are others: they stand in all
lines and make strangers alike.  A hash has 256 bits in blocks of four; a key is a few blocks
that must agree and a class of the line's length.  Words are never cut out of a text: their
hashes are sums over its bytes, taken for many lines at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa

from windrow.llm.common import SPACE

HASH_BITS = 256
LONGS = HASH_BITS // 64
BLOCK_BITS = 4
BLOCK = np.uint64((1 << BLOCK_BITS) - 1)
# Words of fewer bytes are no features of lines that have longer ones.
FEATURE_BYTES = 4
CHUNK_WORDS = 1 << 14
CHUNK_BYTES = 1 << 19
# A class of length spans so much of its logarithm; lines near its end are in the next one, too.
CLASS_WIDTH = 0.8
# Blocks of a key and number of keys.  Fewer blocks find as much with fewer keys, but let more strangers meet.
KEY_BLOCKS = 5
N_KEYS = 48

LINES = "doc_id long, line_no int, text_a long, text_b long, chars int, " + ", ".join(
    f"sim_{i} long" for i in range(LONGS)
)
NAMES = [f.split(" ")[0] for f in LINES.split(", ")]

_odd = np.random.default_rng(20240607).integers(0, 1 << 62, 2 + LONGS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Bytes of words that are hashed eight at a time, all words at once, and what is left of a long by the word's end.
SHORT_BYTES = 64
ENDS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# Powers of two odd numbers: what a byte of a longer word counts by its place in a run of so many.
PLACES = 4096
POWERS = np.cumprod(np.repeat(_odd[:2, None], PLACES, axis=1), axis=1, dtype=np.uint64)
ONE, GOLDEN = np.uint64(1), np.uint64(0x9E3779B97F4A7C15)


def normalise(line: str) -> str:
    """In lower case, with single blanks.  Digits and signs count: an amount is not another."""
    return re.sub(SPACE, " ", line.lower()).strip(" ")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, and its length."""
    white = (codes == 32) | ((codes >= 9) & (codes <= 13))
    gaps = np.concatenate([[-1], np.flatnonzero(white), [len(codes)]])
    lengths = np.diff(gaps) - 1
    some = np.flatnonzero(lengths)
    return gaps[some] + 1, lengths[some]


def _word_hashes(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each word, from its bytes, eight at a time."""
    # What begins at each byte, as a long; the bytes behind a word's end are cleared.
    longs = np.ndarray(len(data) + 1, np.dtype("<u8"), data + bytes(8), 0, (1,))
    short = np.where(lengths <= SHORT_BYTES, lengths, 0)
    hashes = [lengths.astype(np.uint64) * GOLDEN for _ in range(2)]
    at = np.arange(len(starts))
    for done in range(0, int(short.max()), 8):
        at = at[short[at] > done]
        told = longs[starts[at] + done] & ENDS[np.minimum(short[at] - done, 8)]
        for h, odd in zip(hashes, _odd):
            h[at] = mixed(h[at] ^ told * odd)
    for i in np.flatnonzero(lengths > SHORT_BYTES):
        for k, h in enumerate(hashes):
            h[i] ^= _long_hash(data[starts[i] : starts[i] + lengths[i]], k)
    return hashes


def _long_hash(word: bytes, k: int) -> np.uint64:
    letters = np.frombuffer(word, np.uint8).astype(np.uint64) + ONE
    begin = np.arange(0, len(letters), PLACES)
    told = np.add.reduceat(letters * np.resize(POWERS[k], len(letters)), begin)
    return np.bitwise_xor.reduce(mixed(told + begin.astype(np.uint64) * GOLDEN))


def line_hashes(data: bytes) -> tuple[np.ndarray, ...]:
    """(line, digest a, digest b, characters, hashes) of the lines that have a word.

    ``data`` are lines of lower case in UTF-8; words are what stands between white space.
    """
    codes = np.frombuffer(data, np.uint8)
    starts, lengths = _words(codes)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros((0, LONGS), np.int64)
    one, two = _word_hashes(data, starts, lengths)
    characters = lengths
    if (codes >= 0x80).any():
        more = np.append(0, np.cumsum((codes & 0xC0) == 0x80))  # bytes that begin no character
        characters = lengths - (more[starts + lengths] - more[starts])

    newlines = np.flatnonzero(codes == 10)
    line_of = np.searchsorted(newlines, starts)
    first = np.flatnonzero(np.diff(line_of, prepend=-1))
    n = np.diff(np.append(first, len(line_of)))
    nth = (np.arange(len(line_of)) - np.repeat(first, n)).astype(np.uint64) * GOLDEN
    a, b = (np.add.reduceat(mixed(h ^ nth), first).view(np.int64) for h in (one, two))
    chars = np.add.reduceat(characters, first) + n - 1

    longer = lengths >= FEATURE_BYTES
    n_longer = np.add.reduceat(longer.astype(np.int64), first)
    used = longer | np.repeat(n_longer == 0, n)
    sims = simhashes(one[used], np.where(n_longer == 0, n, n_longer))
    return line_of[first], a, b, chars, sims


def simhashes(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The hash of each line, a run of word hashes: a bit is set if most of its words have it."""
    out = np.zeros((len(lengths), LONGS), np.int64)
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(lengths):
        begin = ends[lo] - lengths[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, begin + CHUNK_WORDS, "right")))
        planes = _counts(mixed(words[begin : ends[hi - 1], None] * _odd[None, 2:]), lengths[lo:hi])
        # More than half: the counts, bit by bit from the highest, against half of the words.
        half = lengths[lo:hi, None] // 2
        above, equal = np.zeros_like(planes[0]), ~np.zeros_like(planes[0])
        for k in reversed(range(len(planes))):
            bit = np.where(half >> k & 1, ~np.uint64(0), np.uint64(0))
            above |= equal & planes[k] & ~bit
            equal &= ~(planes[k] ^ bit)
        out[lo:hi] = above.view(np.int64)
        lo = hi
    return out


def _counts(wide: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """How many words of each line have each bit: plane k has bit k of all counts.

    Counts of neighbours are added up, two and two, until a line has one left.
    """
    planes, left = [wide], lengths
    while len(planes[0]) > len(lengths):
        pairs = (left + 1) // 2
        nth = 2 * (np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs))
        at = np.repeat(np.cumsum(left) - left, pairs) + nth
        alone = np.flatnonzero(nth + 1 == np.repeat(left, pairs))
        beside = at + 1
        beside[alone] = 0
        carry, added = None, []
        for plane in planes:
            x, y = plane.take(at, 0), plane.take(beside, 0)
            y[alone] = 0
            both, either = x & y, x ^ y
            added.append(either if carry is None else either ^ carry)
            carry = both if carry is None else both | (either & carry)
        planes, left = [*added, carry], pairs
    return planes


def _pieces(ids: list, texts: list[str]) -> Iterator[tuple[list, list, list[str]]]:
    """Runs of (ids, number of the first line, text), cut between lines, of bounded bytes."""
    owners, numbers, parts, held = [], [], [], 0
    for doc_id, text in zip(ids, texts):
        number = lo = 0
        while True:
            hi = len(text) if len(text) - lo <= CHUNK_BYTES else text.find("\n", lo + CHUNK_BYTES)
            hi = len(text) if hi < 0 else hi
            part = text[lo:hi]
            owners.append(doc_id)
            numbers.append(number)
            parts.append(part)
            held += len(part)
            if held >= CHUNK_BYTES:
                yield owners, numbers, parts
                owners, numbers, parts, held = [], [], [], 0
            if hi == len(text):
                break
            number += part.count("\n") + 1
            lo = hi + 1
    if parts:
        yield owners, numbers, parts


def line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per line that is not blank: where it stands, its digest, length and hash."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * LONGS]
    for batch in batches:
        for owners, numbers, parts in _pieces(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
            n_lines = np.array([p.count("\n") + 1 for p in parts])
            begin = np.cumsum(n_lines) - n_lines
            # One lower-casing for all: it neither makes nor takes line ends.
            data = "\n".join(parts).lower().encode("utf-8", "surrogatepass")
            line, a, b, chars, sims = line_hashes(data)
            part = np.searchsorted(begin, line, "right") - 1
            number = line - begin[part] + np.array(numbers, np.int64)[part]
            columns = [np.array(owners, np.int64)[part], number, a, b, chars, *sims.T]
            yield pa.record_batch(
                [pa.array(np.ascontiguousarray(c)).cast(k) for c, k in zip(columns, kinds)], names=NAMES
            )


def key_blocks() -> list[list[int]]:
    """The blocks of each key, the same for every table: whether two lines meet is told by the
    two alone."""
    rng, keys = np.random.default_rng(11), []
    while len(keys) < N_KEYS:  # every round uses every block once
        order = rng.permutation(HASH_BITS // BLOCK_BITS).tolist()
        keys += [sorted(order[i : i + KEY_BLOCKS]) for i in range(0, len(order) - KEY_BLOCKS + 1, KEY_BLOCKS)]
    return keys[:N_KEYS]


def class_of(chars: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The class of length of each line, and whether it is in the next one, too."""
    size = np.log(chars) / CLASS_WIDTH
    own = np.floor(size)
    return own.astype(np.int64), size - own > 1 + log(similarity * 0.999) / CLASS_WIDTH


def key_hashes(sims: np.ndarray, size: np.ndarray, blocks: list[int], number: int) -> np.ndarray:
    """One key of many lines, from their hashes and classes of length, as 32 bits."""
    told = (size * N_KEYS + number).astype(np.uint64)
    for b in blocks:
        per_long = 64 // BLOCK_BITS
        told = told << np.uint64(BLOCK_BITS) | sims[:, b // per_long] >> np.uint64(BLOCK_BITS * (b % per_long)) & BLOCK
    return (mixed(told * GOLDEN) >> np.uint64(32)).astype(np.uint32)
