"""Words of many texts as Arrow arrays: cut, listed by bucket, and coded through tables of ids.

Words of a text follow each other without a gap, so they are offsets into its bytes.  A space
stands for the model's mark, which has three bytes; texts that have the mark itself mean the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: what sentencepiece writes for a space.
MARK = "▁"


def _slices(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Texts that follow each other in ``data`` from each of ``begins`` on."""
    ends = np.append(begins, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(begins), pa.py_buffer(ends), pa.py_buffer(data))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without NULLs, and where each begins, the end included."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and the number of words before each text, the end included.

    A word begins at the first of some spaces, at a line's end, after one, and where a text does.
    A text that is not empty gets a space in front; NULL counts as empty.
    """
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), MARK, " ")
    texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pa.scalar(" "), texts, ""))
    data, ends = _bytes_of(texts)
    space, line = data == 32, data == 10
    begins = line | space
    begins[1:] &= line[1:] | ~space[:-1]
    begins[1:] |= line[:-1]
    begins[ends[:-1][np.diff(ends) > 0]] = True
    places = np.flatnonzero(begins)
    return _slices(data, places), np.searchsorted(places, ends)


def unpacked(data: bytes) -> pa.Array:
    """Words that are packed with a line's end between them."""
    codes = np.frombuffer(data.replace(MARK.encode(), b" "), np.uint8)
    gaps = codes == 10
    begins = np.append(0, np.flatnonzero(gaps) + 1 - np.arange(1, gaps.sum() + 1))
    return _slices(codes[~gaps], begins)


def parts_of(words: pa.Array, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The pieces of words, and how many each has, by the boundaries as bits of a number: bit n
    is set if a piece ends before character n; 0 where every character is a piece."""
    data, ends = _bytes_of(words)
    places = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
    first = np.searchsorted(places, ends)
    counts = np.diff(first)
    nth = np.arange(len(places)) - np.repeat(first[:-1], counts)
    bits = np.repeat(np.where(bounds == 0, -1, bounds), counts)
    begins = (nth == 0) | ((bits >> nth) & 1).astype(bool)
    n_before = np.append(0, np.cumsum(begins))[first]
    return _slices(data, places[begins]), np.diff(n_before)


def lists_of(codes: list[bytes]) -> pa.ListArray:
    """Ids as bytes of 32-bit numbers to lists of them."""
    ends = np.cumsum([0, *(len(c) // 4 for c in codes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), np.int32)))


def regrouped(lists: pa.ListArray, counts: np.ndarray) -> pa.ListArray:
    """One list for each run of so many lists."""
    ends = lists.offsets.to_numpy()[np.append(0, np.cumsum(counts))]
    return pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), lists.flatten())


def coded(
    texts: pa.Array, at: pa.Array, codes: pa.ListArray, code_of: Callable[[str], bytes]
) -> pa.ListArray:
    """The ids of each text: those at a place in ``codes``, without a place those by ``code_of``."""
    if at.null_count:
        others = texts.filter(pc.is_null(at)).dictionary_encode()
        more = lists_of([code_of(x.replace(" ", MARK)) for x in others.dictionary.to_pylist()])
        n = pa.scalar(len(codes), pa.int32())
        codes = pa.concat_arrays([codes, more])
        at = pc.replace_with_mask(at, pc.is_null(at), pc.add(others.indices, n))
    return codes.take(at)
