"""Quality by ordinal regression with cumulative links.

A rating is one of some ordered grades. All grades share one weight vector over hashed
text, and ordered thresholds cut the score into grades: P(grade <= k) =
logistic(threshold k - score). The weights say how much better a word makes a text, the
thresholds where one grade turns into the next; both are fitted together. A document
gets its expected grade and the probability of at least a given grade, by which
documents are selected.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from siltworks.llm.common import col, map_text, slices

FEATURE_BITS = 18
#: rated texts that the fit uses at most, a random choice of all different ones
SAMPLE_ROWS = 12_000
#: features of all sampled texts together, which bounds the driver's memory; texts beyond it, the last ones of the
#: random order, are not used
SAMPLE_FEATURES = 10_000_000

#: letters of the word beginnings that are features too
PREFIXES = (4, 5)
#: a feature counts if the grades of documents with it differ from the mean by so many standard errors
LEAST_SIGNAL, FULL_SIGNAL = 4.0, 20.0
#: and if so many sampled documents have it
LEAST_DOCUMENTS = 3
STEPS = 150
LEARNING_RATE = 0.1
RIDGE, LASSO = 1e-4, 1e-3

_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+")


@lru_cache(maxsize=1 << 19)
def _bucket(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) & ((1 << FEATURE_BITS) - 1)


def features(text: str | None) -> dict[int, float]:
    """Hashed words, marks and word beginnings of a whole text with weights, and its length.

    A feature weighs 1 + log of its count; a beginning counts the different words that
    share it, and so stands for all forms of a stem, of which a sample sees only some.
    """
    words = Counter(_TOKEN.findall((text or "").lower()))
    starts = Counter(w[:n] + "~" for n in PREFIXES for w in words if len(w) >= n)
    found: dict[int, float] = {}
    for counted in (words, starts):
        for token, n in counted.items():
            k = _bucket(token)
            found[k] = found.get(k, 0.0) + (1.0 + math.log(n) if n > 1 else 1.0)
    found[_bucket(f"length {sum(words.values()).bit_length()}")] = 1.0
    return found


def _logistic(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class OrdinalModel:
    """Grades from 0 to the number of thresholds; features without a weight are left out."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def at_least(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        weights = self.weights
        score = sum(weights[k] * v for k, v in features(text).items() if k in weights)
        return _logistic(score - np.array(self.thresholds))


class _Adam:
    """Steps along a gradient, scaled by its own size so far."""

    def __init__(self, shape, rate: float):
        self.rate, self.mean, self.square, self.n = rate, np.zeros(shape), np.zeros(shape), 0

    def step(self, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.n += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.99 * self.square + 0.01 * gradient**2
        size = self.rate / (np.sqrt(self.square / (1 - 0.99**self.n)) + 1e-8)
        return size * self.mean / (1 - 0.9**self.n), size


def train(rows: Sequence[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int) -> OrdinalModel:
    """Weights and thresholds that make ``grades`` most likely, with ridge and lasso penalties.

    ``rows`` are the different features of a text and their weights. A feature enters in proportion to how far the
    mean grade of its documents lies from the overall one, in standard errors.
    """
    size, n = 1 << FEATURE_BITS, len(rows)
    if n == 0 or grades.std() == 0:  # nothing to tell grades apart by
        usual = int(grades[0]) if n else n_grades - 1
        return OrdinalModel({}, tuple(-4.0 if k <= usual else 4.0 for k in range(1, n_grades)))
    seen, above = np.zeros(size, dtype=np.int64), np.zeros(size)
    apart = grades - grades.mean()
    for (k, _), d in zip(rows, apart.tolist()):  # a text has each feature once
        seen[k] += 1
        above[k] += d
    signal = np.abs(above) / np.sqrt(np.maximum(seen, 1)) / grades.std()
    scale = np.where((seen >= LEAST_DOCUMENTS) & (signal >= LEAST_SIGNAL), np.minimum(signal / FULL_SIGNAL, 1.0), 0.0)
    # features without a signal are left out text by text, so that the whole sample is never copied
    used = [scale[k] > 0 for k, _ in rows]
    owner = np.repeat(np.arange(n), [int(u.sum()) for u in used])
    at = np.concatenate([k[u] for (k, _), u in zip(rows, used)]).astype(np.int64)
    value = np.concatenate([v[u] for (_, v), u in zip(rows, used)]) * scale[at]

    # thresholds are a first one and positive gaps, so that they stay in order
    share = np.array([(grades >= k).mean() for k in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
    cut = -np.log(share / (1 - share))
    first, gaps = cut[0], np.log(np.maximum(np.diff(cut), 1e-3))
    counts = np.bincount(grades, minlength=n_grades)
    rarity = np.sqrt(n / (n_grades * np.maximum(counts, 1)))[grades]  # rare grades count for more
    weights = np.zeros(size)
    on_weights, on_cuts = _Adam(size, LEARNING_RATE), _Adam(n_grades - 1, LEARNING_RATE)
    for _ in range(STEPS):
        thresholds = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
        edge = np.concatenate([[-np.inf], thresholds, [np.inf]])
        score = np.bincount(owner, weights[at] * value, minlength=n)
        low, high = _logistic(edge[grades] - score), _logistic(edge[grades + 1] - score)
        p, d_low, d_high = np.maximum(high - low, 1e-12), low * (1 - low), high * (1 - high)
        d_score = rarity * (d_high - d_low) / p  # of the negative log-likelihood
        move, rate = on_weights.step(np.bincount(at, d_score[owner] * value, minlength=size) + RIDGE * n * weights)
        weights -= move
        weights = np.sign(weights) * np.maximum(np.abs(weights) - np.minimum(rate * LASSO * n, 0.05), 0.0)
        d_edge = np.bincount(grades, rarity * d_low / p, minlength=n_grades + 1)
        d_edge -= np.bincount(grades + 1, rarity * d_high / p, minlength=n_grades + 1)
        after = np.cumsum(d_edge[1:-1][::-1])[::-1]  # a gap moves all thresholds after it
        move, _ = on_cuts.step(np.concatenate([[after[0]], np.exp(gaps) * after[1:]]))
        first, gaps = first - move[0], gaps - move[1:]
    thresholds = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
    kept = np.flatnonzero(weights * scale)
    return OrdinalModel({int(k): float(weights[k] * scale[k]) for k in kept}, tuple(thresholds.tolist()))


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 for low quality, 1 for good but toxic, 2 for good; a row without a quality or toxic rating has none."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when((quality == 1) & (toxic == 0), 2)


def fit(
    rated: DataFrame,
    n_grades: int,
    text_column: str = "text",
    grade_column: str = "grade",
    sample_rows: int = SAMPLE_ROWS,
    sample_features: int = SAMPLE_FEATURES,
    hash_column: str | None = None,
) -> OrdinalModel:
    """The model of a bounded random sample of ``rated``.

    Rows without a text, or with a grade that is null or unknown, are left out. A text with several
    grades is used once with each, copies with one grade are used once. Very long texts count
    whole. Without rows the highest grade is expected of every text. ``hash_column`` may hold a hash of
    the text; made before ratings are joined to texts, it spares the shuffle of texts that are not drawn.
    """
    own_hash = F.xxhash64(col(text_column)) if hash_column is None else col(hash_column)
    rows = rated.select(col(text_column).alias("t"), col(grade_column).cast("int").alias("g"), own_hash.alias("h")).filter(
        (F.col("t").isNotNull()) & F.col("g").between(0, n_grades - 1)
    )
    # a hash of the text decides, the same for every order of rows
    total = rows.select("h").distinct().count()
    # more than enough pass, so that the limit decides and not chance
    draw = F.pmod(F.xxhash64("h"), F.lit(1 << 30)).alias("draw")
    passing = rows.filter(draw < F.lit(int(min(1.0, 1.1 * (sample_rows + 100) / max(total, 1)) * (1 << 30))))
    # copies become one in their tasks, before anything is shuffled
    different = passing.groupBy("h", "g").agg(F.min("t").alias("t")).select("t", "g", draw)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([list(f) for f in found], pa.list_(pa.int32())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.float32())),
                    batch.column(1),
                    batch.column(2),
                ],
                names=["k", "v", "g", "draw"],
            )

    sample = different.mapInArrow(extract, "k array<int>, v array<float>, g int, draw long")
    taken, grades, left = [], [], sample_features
    for batch in sample.orderBy("draw", "g").limit(sample_rows).select("k", "v", "g").toArrow().to_batches():
        for k, v, g in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
            k = k.values.to_numpy()
            left -= len(k)
            if left < 0:
                break
            taken.append((k, v.values.to_numpy()))
            grades.append(g)
    return train(taken, np.array(grades, dtype=np.int64), n_grades)


def score(
    docs: DataFrame, model: OrdinalModel, selected_grade: int, text_column: str = "text", least_probability: float = 0.5
) -> DataFrame:
    """All rows with expected_grade, tail_probability (of ``selected_grade`` or more), grade and selected.

    Null and empty texts have no words and get what the length alone says. Extra columns
    stay; a column that has one of the four names is replaced.
    """

    def judge(texts: list[str | None]) -> list[pa.Array]:
        tails = np.array([model.at_least(t) for t in texts])
        tail = tails[:, selected_grade - 1]
        return [
            pa.array(tails.sum(axis=1)),
            pa.array(tail),
            pa.array((tails >= 0.5).sum(axis=1).astype(np.int32)),
            pa.array(tail >= least_probability),
        ]

    return map_text(docs, text_column, "expected_grade double, tail_probability double, grade int, selected boolean", judge)
