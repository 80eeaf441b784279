"""Language ID with one bit-sliced Bloom filter over the n-grams of all languages.

A slot of the filter is a mask with a bit per language.  An n-gram's slots and-ed together
are all languages that have it, in as many look-ups as for one language.  A text's matches
are counted per language and corrected for false positives: of n look-ups a language whose
slots are full to a share f is hit by chance n * f^k times.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import bounded_batches, by_bytes, fold_of
from windrow.runtime import counted_bound, join_small

UNDETERMINED = "und"
GRAM_SIZES = (3, 4)

# Bounds of the fit: labelled documents per language, and n-grams per language.
SAMPLE_DOCS = 5000
LANGUAGE_GRAMS = 12_000
# A language has an n-gram if its rate there is at least this share of its rate elsewhere.
RATE_SHARE = 0.3

# Texts looked up at a time; the arrays of n-grams take some fifty times as much.
SLICE_BYTES = 1 << 16

HASHES = 3
SLOTS_PER_GRAM = 10
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


@cache
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the text each is of, and whether a text has a letter.

    Texts are in lower case, with a space for each run of other than letters.
    """
    # A space on both sides, then one more that n-grams must not reach over.
    padded = [f" {(t or '').lower()} \n" for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([len(p) for p in padded], dtype=np.int64) - 1
    letter = _letters()[codes]
    wall = np.zeros(len(codes), bool)
    wall[ends] = True
    keep = letter | wall
    keep[1:] |= letter[:-1]
    keep[0:1] = True
    keep[1:] |= wall[:-1]
    owner = np.repeat(np.arange(len(padded)), np.diff(ends, prepend=-1))
    has_letter = np.zeros(len(padded), bool)
    has_letter[owner[letter]] = True
    codes = np.where(letter, codes, 32).astype(np.uint64)[keep]
    wall, owner, letter = wall[keep], owner[keep], letter[keep]
    found, owners = [], []
    for n in GRAM_SIZES:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        mixed = np.full(m, n, np.uint64)
        inside, some = np.ones(m, bool), np.zeros(m, bool)
        for i in range(n):
            mixed += codes[i : m + i] * np.uint64(MULTIPLIERS[i])
            mixed ^= mixed >> np.uint64(29)
            inside &= ~wall[i : m + i]
            some |= letter[i : m + i]
        inside &= some
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        found.append(mixed[inside])
        owners.append(owner[:m][inside])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has_letter
    return np.concatenate(found), np.concatenate(owners), has_letter


@dataclass
class LanguageFilter:
    """``slots``: a row of masks per 64 languages; ``fill``: the full share per language."""

    languages: list[str]
    slots: np.ndarray
    fill: np.ndarray

    @classmethod
    def build(cls, languages: Sequence[str], by_language: Sequence[np.ndarray]) -> LanguageFilter:
        most = max([len(g) for g in by_language], default=1)
        size = 1 << max(10, (most * SLOTS_PER_GRAM - 1).bit_length())
        slots = np.zeros((-(-len(languages) // 64) or 1, size), np.uint64)
        fill = np.zeros(len(languages))
        for i, found in enumerate(by_language):
            at = np.unique(np.concatenate(cls._places(found.astype(np.uint64), size)))
            slots[i // 64, at] |= np.uint64(1) << np.uint64(i % 64)
            fill[i] = len(at) / size
        if len(languages) <= 8:  # masks as narrow as the languages allow stay in cache
            slots = slots.astype(np.uint8)
        return cls(list(languages), slots, fill)

    @staticmethod
    def _places(found: np.ndarray, size: int) -> list[np.ndarray]:
        step = (found >> np.uint64(40)) | np.uint64(1)
        mask = np.uint64(size - 1)
        return [((found + np.uint64(i) * step) & mask).astype(np.int64) for i in range(HASHES)]

    def counts(self, found: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
        """Matches per text and language, less what chance gives."""
        places = self._places(found, self.slots.shape[1])
        total = np.bincount(owner, minlength=n_texts).astype(float)
        out = np.zeros((n_texts, len(self.languages)))
        for word, slots in enumerate(self.slots):
            masks = slots[places[0]]
            for at in places[1:]:
                masks = masks & slots[at]
            for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                hit = (masks >> masks.dtype.type(i % 64)) & masks.dtype.type(1)
                matches = np.bincount(owner, hit, n_texts)
                chance = self.fill[i] ** HASHES
                out[:, i] = np.maximum(0, (matches - total * chance) / max(1 - chance, 1e-9))
        return out

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        found, owner, has_letter = grams(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        counts = self.counts(found, owner, len(texts))
        best, total = counts.argmax(axis=1), counts.sum(axis=1)
        share = np.divide(counts.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has_letter)]
        return names, np.where(has_letter, share, 0.0)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of each language in a batch."""
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for lang in sorted(set(langs.to_pylist())):
            own = texts.filter(pc.equal(langs, lang))
            slices = [own.slice(lo, hi - lo).to_pylist() for lo, hi in by_bytes(own, SLICE_BYTES)]
            found, n = np.unique(np.concatenate([grams(some)[0] for some in slices]), return_counts=True)
            yield pa.record_batch(
                [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)),
                 pa.array(n, pa.int64())],
                names=["lang", "gram", "n"],
            )


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageFilter:
    """Learn from (doc_id, text, lang); rows without any of them are not learned from.

    At most about ``sample_docs`` documents per language, drawn by a hash of the id, make the
    filter.  Languages stand in the order of their numbers of documents.
    """
    bounded_batches(labelled.sparkSession)
    known = labelled.filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    per_lang = known.groupBy("lang").agg(F.count("*").alias("_docs"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000))
    sampled = join_small(known, per_lang, ["lang"], "inner", counted_bound(per_lang))
    sampled = sampled.filter(draw * F.col("_docs") < F.lit(1_000_000 * sample_docs))
    counts = (
        sampled.select("lang", "text")
        .mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # All n-grams of a language: one row per language.
    rated = counts.join(counts.groupBy("lang").agg(F.sum("n").alias("all")), "lang").withColumn(
        "rate", F.col("n") / F.col("all")
    )
    elsewhere = F.max("rate").over(Window.partitionBy("gram"))
    most = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    chosen = (
        rated.withColumn("top", elsewhere)
        .filter((F.col("rate") >= RATE_SHARE * F.col("top")) & (F.col("n") > 1))
        .withColumn("place", F.row_number().over(most))
        .filter(F.col("place") <= LANGUAGE_GRAMS)
        .select("lang", "gram")
        .toPandas()
    )
    names = [r.lang for r in per_lang.orderBy(F.col("_docs").desc(), "lang").collect()]
    by_language = [chosen.gram[chosen.lang == x].to_numpy(np.int64).view(np.uint64) for x in names]
    return LanguageFilter.build(names, by_language)


def _predictor(model: LanguageFilter):
    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = [], []
            for lo, hi in by_bytes(batch, SLICE_BYTES):
                part, shares = model.predict(batch.slice(lo, hi - lo).to_pylist())
                names += part
                scores += shares.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["lang_pred", "score"],
            )

    return predict


def predicted(model: LanguageFilter, text: Column) -> Column:
    """A struct (lang_pred, score) of a text."""
    return _predictor(model)(text)


def learned_on(doc_id: Column, folds: int = 4, held_out: int = 2) -> Column:
    return F.coalesce(fold_of(doc_id, folds) != held_out, F.lit(False))


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score``, learned from three folds of four.

    A text that is NULL or has no letter is ``und`` with score 0, and so is every text where
    nothing is labelled.  A text of letters that no language has goes to the most frequent
    one with score 0.  The score is the winner's share of the corrected matches.  Rows with
    a NULL id are predicted but not learned from, nor held out; repeated rows each count.  An
    empty table gives no rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.filter(learned_on(F.col("doc_id"))), sample_docs)
    return rows.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        predicted(model, F.col("text")).alias("p"),
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
