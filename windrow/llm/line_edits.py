"""Whether the edit distance of two lines is within a limit, by bounds first.

From above: words that both lines have once, in the longest run of them that keeps its order
in both, are anchors.  What lies between two anchors costs no more than the longer side has
characters, so the sum over all gaps is never below the distance.  From below: an edit changes
at most so many n-grams on either side as these have characters.  The time of both goes with the
lines' length; the distance itself, whose time goes with its square, is left for the pairs
between them, of which many are measured at once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from windrow.llm.line_distance import GROUP_PAIRS, banded, distances, groups

# Gaps of up to so many characters on both sides are measured exactly, where that is needed.
GAP_CHARS = 256
# Characters of the n-grams counted for the bound from below, and what they are hashed by.
GRAM_CHARS = 4
GRAM_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Pairs and characters that are held to be measured together.
HELD_PAIRS, HELD_CHARS = 16_000, 8 << 20
# Shorter lines are measured, unless they differ in a few words; the bounds cost more.
LONG_CHARS = 5000


def anchors(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of words that stand once in each list, rising in both, as many as can be."""
    n_a, n_b = Counter(a), Counter(b)
    at = {w: j for j, w in enumerate(b) if n_b[w] == 1}
    pairs = [(i, at[w]) for i, w in enumerate(a) if n_a[w] == 1 and w in at]
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        before.append(ends[p - 1] if p else -1)
        tops[p : p + 1] = [j]
        ends[p : p + 1] = [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def gaps(a: str, b: str) -> list[tuple[str, str]]:
    """What two lines differ in, between words that they share."""
    x, y = a.split(" "), b.split(" ")
    out: list[tuple[str, str]] = []
    i = j = 0
    for s, t in [*anchors(x, y), (len(x), len(y))]:
        # Words next to an anchor that are alike, though they stand in the lines more than once.
        while i < s and j < t and x[i] == y[j]:
            i, j = i + 1, j + 1
        u, v = s, t
        while u > i and v > j and x[u - 1] == y[v - 1]:
            u, v = u - 1, v - 1
        if u > i or v > j:
            # One side may have no word here; then a blank goes as well.
            ends = (" ",) if u == i or v == j else ()
            out.append((" ".join((*x[i:u], *ends)), " ".join((*y[j:v], *ends))))
        i, j = s + 1, t + 1
    return out


def distance(a: str, b: str) -> int:
    """The edit distance of two texts, a column of the table at a time as bits of a number."""
    if not a:
        return len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        same = where.get(c, 0)
        across = (((same & up) + up) ^ up) | same | down
        rise = (down | ~(across | up)) & full
        fall = up & across
        score += bool(rise & top) - bool(fall & top)
        rise = (rise << 1 | 1) & full
        fall = fall << 1 & full
        up = (fall | ~(across | rise)) & full
        down = rise & across
    return score


def surely_within(a: str, b: str, most: int) -> bool:
    """Whether the distance is shown to be ``most`` at the highest; False leaves it open."""
    if _equal_but_for_words(a, b, most):
        return True
    between = gaps(a, b)
    if sum(max(len(s), len(t)) for s, t in between) <= most:
        return True
    if sum(abs(len(s) - len(t)) for s, t in between) > most:
        return False
    cost = 0
    for s, t in between:
        short = max(len(s), len(t)) <= GAP_CHARS
        cost += distance(s, t) if short else max(len(s), len(t))
        if cost > most:
            return False
    return True


def _grams(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(0, len(codes) - GRAM_CHARS + 1)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM_CHARS):
        out = (out + codes[k : k + n]) * GRAM_FACTOR
    return out


def least_edits(a: str, b: str) -> int:
    """No more than the distance; n-grams equal by chance only lower it."""
    x, y = _grams(a), _grams(b)
    kinds, which = np.unique(np.concatenate([x, y]), return_inverse=True)
    n_a, n_b = (np.bincount(w, minlength=len(kinds)) for w in (which[: len(x)], which[len(x) :]))
    apart = int(np.abs(n_a - n_b).sum())
    return max(abs(len(a) - len(b)), -(-apart // (2 * GRAM_CHARS)))


def is_within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is ``most`` at the highest."""
    if surely_within(a, b, most):
        return True
    return least_edits(a, b) <= most and distance(a, b) <= most


def _equal_but_for_words(a: str, b: str, most: int) -> bool:
    """Whether words that differ, one for one, cost ``most`` at the highest."""
    x, y = a.split(" "), b.split(" ")
    return len(x) == len(y) and sum(max(len(s), len(t)) for s, t in zip(x, y) if s != t) <= most


def _told(a: str | None, b: str | None, most: int | None) -> bool | None:
    """``is_within`` where bounds tell it at less cost than the distance; None leaves it open."""
    if _equal_but_for_words(a, b, most):
        return True
    if max(len(a), len(b)) < LONG_CHARS and a and b:
        return None
    return surely_within(a, b, most) or (None if least_edits(a, b) <= most else False)


def all_within(rows: list[tuple[str | None, str | None, int | None]]) -> list[bool | None]:
    """``is_within`` of each row; None if one of its values is."""
    told = [None if None in row else _told(*row) for row in rows]
    left = [i for i, row in enumerate(rows) if told[i] is None and None not in row]
    lengths = np.array([(*sorted(map(len, rows[i][:2])), rows[i][2]) for i in left]).reshape(-1, 3)
    for group in groups(lengths):
        some = [left[i] for i in group]
        if len(some) < GROUP_PAIRS:
            edits = [banded(*rows[i]) for i in some]
        else:
            edits = distances([rows[i][:2] for i in some], [rows[i][2] for i in some])
        for i, n in zip(some, edits):
            told[i] = bool(n <= rows[i][2])
    return told


@F.arrow_udf(BooleanType())
def within(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """``is_within`` of two columns of lines and one of edits; NULL if one of them is."""

    def told(held: list[list[tuple]]) -> Iterator[pa.Array]:
        answers = iter(all_within([row for rows in held for row in rows]))
        return (pa.array([next(answers) for _ in rows], pa.bool_()) for rows in held)

    held, n, chars = [], 0, 0
    for batch in batches:
        held.append(list(zip(*(c.to_pylist() for c in batch))))
        n += len(held[-1])
        chars += sum(len(a or "") + len(b or "") for a, b, _ in held[-1])
        if n >= HELD_PAIRS or chars >= HELD_CHARS:
            yield from told(held)
            held, n, chars = [], 0, 0
    yield from told(held)
