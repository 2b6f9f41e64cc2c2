"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text becomes a vector of statistics (sizes, shares of kinds of characters, repetition, entropy), transformed to
be closer to normal: logarithms of sizes, square roots of shares. Per class a mean and a covariance are fitted; the
covariance is shrunk towards the pooled one and towards its diagonal, so it can be factored even where a statistic
never varies within a class. The Cholesky factor of each class is inverted once and kept; a score is the logistic
function of the difference of the two log densities (Mahalanobis distance and log determinant) and log priors.

The fit takes a bounded sample: of the rows that `labels` marks and that are not held out, the `MAX_FIT` first in the
order of a hash of doc_id (all of them if they are fewer). Only doc_id picks rows; labels, lang, source and doc_id
are never inputs of a score. Scoring covers every row, in Arrow batches.

Defined cases: a null or empty text has all statistics 0 and is scored like any other; rows without doc_id are
neither held out nor learned from; without two rows of each class every score is the share of class 1 (a half
without any row); labels that are null are left out, repeated ones each count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import sliced

MAX_FIT = 20_000
#: Weight of the pooled covariance, and of the diagonal, in each class's.
POOLED, DIAGONAL = 0.5, 0.3
CUT = 0.3
STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "longest_word", "short_words", "symbols", "upper", "digits",
    "exclamations", "stops", "spaces", "high", "entropy", "distinct_words", "distinct_pairs", "distinct_lines",
)
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a text, in the order of STATISTICS."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(len(STATISTICS))
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, words, lines = len(raw), raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    m, share = max(1, len(words)), seen / n
    p = share[share > 0]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return np.array([
        np.log1p(n),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        np.sqrt(sizes.sum() / m),
        np.log1p(sizes.max(initial=0)),
        np.sqrt((sizes <= 3).sum() / m),
        np.sqrt(share[_SYMBOLS].sum()),
        np.sqrt(share[65:91].sum()),
        np.sqrt(share[48:58].sum()),
        np.sqrt(share[33]),
        np.sqrt(share[[44, 46, 58, 59]].sum()),
        np.sqrt(share[32]),
        np.sqrt(share[128:].sum()),
        -(p * np.log2(p)).sum(),
        np.sqrt(len(set(words)) / m),
        np.sqrt(pairs / max(1, len(words) - 1)),
        np.sqrt(len(set(lines)) / max(1, len(lines))),
    ])


@dataclass
class Discriminant:
    """Class densities over standardised statistics; `whiten` are the inverted Cholesky factors."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    whiten: np.ndarray
    offsets: np.ndarray
    share: float | None = None

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Discriminant:
        counts = np.bincount(y, minlength=2)
        if counts.min() < 2:
            share = float(y.mean()) if len(y) else 0.5
            return cls(*[np.empty(0)] * 5, share=share)
        center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = (x - center) / scale
        means = np.stack([z[y == k].mean(axis=0) for k in (0, 1)])
        own = [np.cov(z[y == k], rowvar=False, bias=True) for k in (0, 1)]
        common = sum(c * n for c, n in zip(own, counts, strict=True)) / counts.sum()
        whiten, offsets = [], []
        for k in (0, 1):
            cov = (1 - pooled) * own[k] + pooled * common
            cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-6 * np.eye(len(cov))
            lower = np.linalg.cholesky(cov)
            whiten.append(np.linalg.inv(lower))
            offsets.append(np.log(counts[k] / counts.sum()) - np.log(np.diag(lower)).sum())
        return cls(center, scale, means, np.stack(whiten), np.array(offsets))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 of each row of statistics."""
        if self.share is not None:
            return np.full(len(x), self.share)
        z = (x - self.center) / self.scale
        log = [
            self.offsets[k] - 0.5 * (((z - self.means[k]) @ self.whiten[k].T) ** 2).sum(axis=1) for k in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def _statistics_udf():
    @F.arrow_udf("array<double>")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches):
            yield pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return measured


def _scores_udf(model):
    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches):
            x = np.array([statistics(t.as_py()) for t in texts]).reshape(-1, len(STATISTICS))
            yield pa.array(model.value.score(x), pa.float64())

    return scored


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> Discriminant:
    """The model of the labelled rows that are not held out, `max_fit` at most."""
    marks = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.select(F.col("doc_id").alias("of"), F.col("quality").cast("int").alias("y"))
    marks = marks.orderBy(F.xxhash64("of"), "of", "y").limit(max_fit)
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("of"))
    rows = rows.select("of", "y", _statistics_udf()(F.col("text")).alias("x")).orderBy("of", "y").limit(max_fit)
    found = rows.select("x", "y").collect()
    x = np.array([r.x for r in found]).reshape(-1, len(STATISTICS))
    return Discriminant.fit(x, np.array([r.y for r in found], np.int64))


def scored(docs: DataFrame, model: Discriminant, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    udf = _scores_udf(docs.sparkSession.sparkContext.broadcast(model))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), udf(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fit(docs, labels))
