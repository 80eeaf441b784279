"""Edit distances of many pairs of texts at once.

The table of a pair is kept by its columns, as differences of neighbouring cells in bits (Myers,
Hyyrö): 64 rows are a word of the machine.  At step t word number b of a pair works on column
t - b, so that all words of all pairs take a step together and get from the word above what it
passed down at the step before.  Only words near the diagonal take steps: a path leaves it by no
more rows or columns than it can come back from within the edits asked for.
"""

from __future__ import annotations

import numpy as np

ZERO, ONE, TOP = np.uint64(0), np.uint64(1), np.uint64(63)
# Words that take a step at a time, and pairs that are worth it.
GROUP_WORDS, GROUP_PAIRS = 1 << 12, 6
# Pairs of a group have texts of so many times the shortest one's characters, at the most; of more where few have.
GROUP_SPREADS = 1.2, 1.7


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _reach(m: int, n: int, most: int) -> tuple[int, int]:
    """By how many rows, and columns, a path of ``most`` edits through m rows and n columns, which
    are no fewer, is before the diagonal."""
    return max(0, most - n + m) // 2, (most + n - m) // 2


def banded(a: str, b: str, most: int) -> int:
    """The edit distance of two texts if it is ``most`` at the highest, else any higher number.

    Bit j of a column's number c is row c + j less the columns that a path may be before the
    diagonal, so what is kept moves down the diagonal.
    """
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > most or not m or most >= m:
        return n if n - m > most or not m else int(distances([(a, b)], [n])[0])
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    below, above = _reach(m, n, most)
    width = above + below + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    up, down, score = full ^ ((1 << above) - 1), 0, below
    for column, c in enumerate(b):
        same = where.get(c, 0)
        same = (same >> (column - above) if column >= above else same << (above - column)) & full
        across = ((((same & up) + up) ^ up) | same | down) & full
        rise, fall = down | (full & ~(across | up)), across & up
        if column < m - below:
            score += not across & top
            if score > most + below + n - m:  # too many to come back from
                return score
        else:
            top >>= 1
            score += bool(rise & top) - bool(fall & top)
        across >>= 1
        up, down = fall | (full & ~(across | rise)), across & rise
    return score


def groups(lengths: np.ndarray) -> list[np.ndarray]:
    """Numbers of pairs of like size, by their (shorter length, longer length, edits asked for)."""
    order = np.lexsort((lengths[:, 0], lengths[:, 1]))
    out, lo = [], 0
    while lo < len(order):
        n = lengths[order[lo:], 1]
        for spread in GROUP_SPREADS:
            most = int(np.searchsorted(n, spread * n[0], "right"))
            some = np.maximum.accumulate(lengths[order[lo : lo + most]])
            words = np.minimum(some[:, 0], some[:, 2] + 128) // 64 + 1
            if most * words[-1] >= GROUP_WORDS // 4:
                break
        fit = int(np.searchsorted(words * np.arange(1, most + 1), GROUP_WORDS, "right"))
        out.append(order[lo : lo + max(1, fit)])
        lo += len(out[-1])
    return out


def distances(pairs: list[tuple[str, str]], most: list[int]) -> np.ndarray:
    """The edit distance of each pair if it is its ``most`` at the highest, else any higher number.
    No text is empty.

    Both texts of a pair get as many equal characters in front as fill the last word with rows,
    which costs no edit.  So the last row is the last bit of the last word in all pairs.
    """
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    n_rows, n_columns = (np.array([len(p[i]) for p in pairs]) for i in (0, 1))
    n, words = len(pairs), int(n_rows.max() + 63) // 64
    front = 64 * words - n_rows
    columns = int((front + n_columns).max())
    # Characters by their numbers within the group; 0 is none of any row, 1 what stands in front.
    rows, texts = (np.concatenate([_codes(p[i]) for p in pairs]) for i in (0, 1))
    number = np.zeros(1 + max(int(rows.max()), int(texts.max())), np.int64)
    number[rows] = 1
    n_kinds = 2 + int(number.sum())
    number[number > 0] = np.arange(2, n_kinds)
    row_of = np.arange(len(rows)) - np.repeat(np.cumsum(n_rows) - n_rows - front, n_rows)
    same = np.zeros((words, n_kinds, n), np.uint64)
    places = (row_of // 64 * n_kinds + number[rows]) * n + np.repeat(np.arange(n), n_rows)
    np.bitwise_or.at(same.reshape(-1), places, ONE << (row_of % 64).astype(np.uint64))
    in_front = np.clip(front - 64 * np.arange(words)[:, None], 0, 64)
    same[:, 1] = np.where(in_front > 63, ~np.uint64(0), (ONE << (in_front % 64).astype(np.uint64)) - ONE)
    column_kind, counts = np.zeros((columns, n), np.int64), np.zeros((columns, n), np.uint64)
    ends = np.cumsum(n_columns)
    for i, (first, end, m) in enumerate(zip(front.tolist(), ends.tolist(), n_columns.tolist())):
        column_kind[:first, i] = 1
        column_kind[first : first + m, i] = number[texts[end - m : end]]
        counts[: first + m, i] = ~ZERO
    column_kind = column_kind * n + np.arange(n)
    of_word = (np.arange(words) * n_kinds * n)[:, None]

    reach_rows, reach_columns = (max(r) for r in zip(*map(_reach, n_rows.tolist(), n_columns.tolist(), most)))
    hi, seen, change = 0, None, np.zeros(n, np.uint64)
    score = np.zeros(n, np.uint64)
    up, down = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    # What each word gets from above, a row more than there are words; the first one's is given.
    rise_in, fall_in = np.zeros((words + 1, n), np.uint64), np.zeros((words + 1, n), np.uint64)
    rise_in[0] = ONE
    buffers, index = np.zeros((5, words, n), np.uint64), np.zeros((words, n), np.int64)
    same = same.ravel()
    for t in range(columns + words - 1):
        # Behind a pair's last column nothing counts.
        lo = max(0, t - columns + 1, -(-(t - 63 - reach_columns) // 65))
        if hi < min(words, t + 1, (t + reach_rows) // 65 + 1):
            # The next word's last row, a column before its first one, by the word above there.
            hi += 1
            score += np.uint64(64) - change
        if (lo, hi) != seen:  # views of the words that take a step
            seen = lo, hi
            u, d, (eq, x, across, rise, fall) = up[lo:hi], down[lo:hi], buffers[:, lo:hi]
            above, below, at, shift = rise_in[lo:hi], fall_in[lo:hi], index[lo:hi], of_word[lo:hi]
            rise_out, fall_out = rise_in[lo + 1 : hi + 1], fall_in[lo + 1 : hi + 1]
        np.add(column_kind[t - hi + 1 : t - lo + 1][::-1], shift, out=at)
        same.take(at, out=eq, mode="clip")
        np.bitwise_or(eq, d, out=x)
        np.bitwise_or(eq, below, out=eq)
        np.bitwise_and(eq, u, out=across)
        np.add(across, u, out=across)
        np.bitwise_xor(across, u, out=across)
        np.bitwise_or(across, eq, out=across)
        np.bitwise_or(across, u, out=rise)
        np.invert(rise, out=rise)
        np.bitwise_or(rise, d, out=rise)
        np.bitwise_and(u, across, out=fall)
        np.left_shift(rise, ONE, out=eq)
        np.bitwise_or(eq, above, out=eq)
        np.left_shift(fall, ONE, out=across)
        np.bitwise_or(across, below, out=across)
        np.right_shift(rise, TOP, out=rise_out)
        np.right_shift(fall, TOP, out=fall_out)
        np.bitwise_or(x, eq, out=rise)
        np.invert(rise, out=rise)
        np.bitwise_or(rise, across, out=u)
        np.bitwise_and(eq, x, out=d)
        if lo:  # the word above takes no more steps; its last row may rise at each column
            rise_in[lo], fall_in[lo] = ONE, ZERO
        change = (rise_in[hi] - fall_in[hi]) & counts[t - hi + 1]
        score += change
    return score.view(np.int64)
