"""Quality by compression: which of two dictionaries makes a text smaller.

One zstandard dictionary is built from text labelled good and one from text labelled bad.  A
text is compressed piece by piece with either (in pieces, so that a long text leans on the
dictionary and not on itself).  The difference of the two sizes over the text's length,
together with how far the text compresses at all, is turned into a probability by a logistic
curve fitted on labelled documents the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windrow.llm.common import bounded_batches, fold_of

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

# Bounds of the fit: labelled documents per class, and pieces per class in a dictionary.
SAMPLE_DOCS = 6000
SAMPLE_PIECES = 6000
PIECE_BYTES = 2048
DICTIONARY_BYTES = 128 << 10
LEVEL = 3
RIDGE = 0.1


@dataclass
class QualityModel:
    """Two dictionaries and the curve; without dictionaries every text gets ``prior``."""

    good: bytes
    bad: bytes
    prior: float
    weights: np.ndarray | None = None
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    @cached_property
    def compressors(self):
        import zstandard

        made = []
        for content in (self.good, self.bad):
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False))
        return made

    def features(self, texts: list[str | None]) -> np.ndarray:
        """(size difference, size, both over the length) of each text; NaN for an empty one."""
        good, bad = self.compressors
        out = np.full((len(texts), 2), np.nan)
        for i, text in enumerate(texts):
            data = (text or "").encode("utf-8", "replace")
            if not data:
                continue
            pieces = [data[lo : lo + PIECE_BYTES] for lo in range(0, len(data), PIECE_BYTES)]
            g = sum(len(good.compress(p)) for p in pieces)
            b = sum(len(bad.compress(p)) for p in pieces)
            out[i] = (b - g) / len(data), (g + b) / len(data)
        return out

    @staticmethod
    def _basis(z: np.ndarray) -> np.ndarray:
        """Both features, their squares and their product, and one."""
        d, s = z[:, 0], z[:, 1]
        return np.column_stack([d, s, d * d, s * s, d * s, np.ones(len(z))])

    def calibrate(self, features: np.ndarray, labels: np.ndarray) -> None:
        """Fit the curve by damped Newton steps; a ridge keeps separable classes finite."""
        seen = ~np.isnan(features).any(axis=1)
        x, y = features[seen], labels[seen].astype(float)
        if not len(x) or y.min() == y.max():
            return
        self.shift, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        basis = self._basis(np.clip((x - self.shift) / self.scale, -6, 6))
        w = np.zeros(basis.shape[1])
        loss = lambda v: (
            np.logaddexp(0, basis @ v).sum() - y @ (basis @ v) + RIDGE / 2 * (v @ v)
        )
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(basis @ w, -30, 30)))
            hessian = basis.T @ (basis * (p * (1 - p))[:, None]) + RIDGE * np.eye(len(w))
            step = np.linalg.solve(hessian, basis.T @ (p - y) + RIDGE * w)
            size, now = 1.0, loss(w)
            while size > 1e-6 and loss(w - size * step) > now:
                size /= 2
            w = w - size * step
            if np.abs(size * step).max() < 1e-8:
                break
        self.weights = w

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        x = self.features(texts)
        empty = np.isnan(x).any(axis=1)
        z = np.clip((np.where(empty[:, None], 0, x) - self.shift) / self.scale, -6, 6)
        p = 1 / (1 + np.exp(-np.clip(self._basis(z) @ self.weights, -30, 30)))
        return np.where(empty, self.prior, p)


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary, or the pieces themselves where there are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:] or b"\0" * 8


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    sample_pieces: int = SAMPLE_PIECES,
) -> QualityModel:
    """Learn from the texts of (doc_id, text) by the labels (doc_id, quality).

    A sample of at most about ``sample_docs`` labelled ids per class, drawn by a hash of the
    id, is joined to the texts; half of it makes the dictionaries (at most
    ``sample_pieces`` pieces per class), half the curve.  Ids labelled both ways, and labels
    other than 0 and 1, are not learned from.
    """
    bounded_batches(docs.sparkSession)
    one = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    one = one.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("hi"))
    one = one.filter(F.col("label") == F.col("hi")).select("doc_id", "label")
    n = {r.label: r.n for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    prior = n.get(1, 0) / total if total else 0.5
    if len(n) < 2:
        return QualityModel(b"", b"", prior)
    share = F.when(F.col("label") == 1, min(1.0, sample_docs / n[1])).otherwise(
        min(1.0, sample_docs / n[0])
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) / F.lit(1 << 20)
    chosen = one.filter(draw < share)  # about 2 * sample_docs rows: small enough to broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length(text), F.lit(1)), F.lit(PIECE_BYTES))
    pieces = (
        sample.filter(half == 0)
        .select("label", "doc_id", text.alias("data"), F.explode(starts).alias("at"))
        .select("label", "doc_id", "at", F.substring("data", F.col("at"), F.lit(PIECE_BYTES)).alias("piece"))
    )
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at")
    pieces = pieces.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_pieces)
    by_label: dict[int, list[bytes]] = {0: [], 1: []}
    for row in pieces.select("label", "piece").collect():
        by_label[row.label].append(bytes(row.piece))
    model = QualityModel(_dictionary(by_label[1]), _dictionary(by_label[0]), prior)
    measured = sample.filter(half == 1).select("label", _features(model)("text").alias("x")).collect()
    model.calibrate(
        np.array([[np.nan if v is None else v for v in r.x] for r in measured]).reshape(-1, 2),
        np.array([r.label for r in measured]),
    )
    return model


def _features(model: QualityModel):
    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.features(batch.to_pylist()).tolist(), pa.list_(pa.float64()))

    return features


def _scorer(model: QualityModel):
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.score(batch.to_pylist()), pa.float64())

    return score


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``, learned from four folds of five.

    The score is the probability of label 1, from the text alone.  A NULL or empty text scores
    the share of label 1 among the labels learned from, and so does every text where one of
    the classes has no label (0.5 with no labels at all).  Rows with a NULL id are scored but
    not learned from, nor held out; repeated rows each count.  An empty table gives no rows;
    other columns are not read.
    """
    learned = F.coalesce(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT, F.lit(False))
    rows = docs.select("doc_id", "text")
    model = fit(rows.filter(learned), labels.select("doc_id", "quality").filter(learned))
    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    scored = rows.select("doc_id", held_out.alias("held_out"), _scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
