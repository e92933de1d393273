"""Quality: ordinal cumulative-link regression on graded ratings.

All grades share one weight vector over hashed features of the text; ordered thresholds cut the score
into grades: P(grade > k) = logistic(score - threshold k). The result is the expected grade and the
tail probabilities P(grade >= k), on which a selection can be made.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import annotate


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    sample: int = 12_000  # rated rows the model is fitted on (about as many; never over twice that)
    epochs: int = 12
    rate: float = 0.3
    decay: float = 1e-5
    prefix: int = 5  # bytes of a word's beginning that are a feature of their own
    certain: float = 2.5  # standard errors by which a bucket must tell grades apart to get a weight
    seed: int = 11
    calibration: float = 0.2  # share of the sample that sets the selection's cut only


@dataclass(frozen=True)
class Model:
    grades: int
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades
    cut: float  # least P(grade >= 1) of a selected document
    settings: Settings

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_WORDS = bytes.maketrans(_MARKS, b" " * len(_MARKS))
_ONLY_MARKS = bytes(b if b in _MARKS else 32 for b in range(256))


def features(text: str | None, settings: Settings) -> np.ndarray:
    """Buckets of the distinct words and beginnings of words, runs of marks, length class, share of distinct words."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    words = raw.translate(_WORDS).split()
    found = set(words)
    share = 10 * len(found) // max(1, len(words))
    found.update([b" " + w[: settings.prefix] for w in found if len(w) > settings.prefix])
    found.update(raw.translate(_ONLY_MARKS).split())
    found.update((b" length %d" % len(words).bit_length(), b" distinct %d" % share))
    return np.unique(np.fromiter(map(zlib.crc32, found), np.int64, len(found)) % settings.buckets)


def train(rows: list[tuple[str | None, int]], grades: int, settings: Settings = Settings()) -> Model:
    """Fit on (text, grade) rows by AdaGrad; no rows give a model for which all grades are alike."""
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(rows))
    data = [(features(rows[i][0], settings), rows[i][1]) for i in order]
    held = int(settings.calibration * len(data))
    learn, check = data[held:], data[:held] or data
    scale = _evidence(learn, grades, settings)
    learn = [(ids[scale[ids] > 0], g) for ids, g in learn]
    weights, seen = np.zeros(settings.buckets), np.full(settings.buckets, 1e-6)
    # thresholds are the first and the logarithms of the gaps, so that they stay ordered
    share = np.array([sum(g <= k for _, g in learn) for k in range(grades - 1)], float)
    share = np.clip((share + 0.5) / (len(learn) + 1), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs) + 1e-3
        for i in rng.permutation(len(learn)):
            ids, grade = learn[i]
            x = scale[ids]
            s = weights[ids] @ x
            t = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
            high = 1.0 if grade == grades - 1 else _logistic(t[grade] - s)
            low = 0.0 if grade == 0 else _logistic(t[grade - 1] - s)
            p = max(high - low, 1e-9)
            dh, dl = high * (1 - high) / p, low * (1 - low) / p
            g = (dh - dl) * x + settings.decay * weights[ids]
            seen[ids] += g * g
            weights[ids] -= rate * g / np.sqrt(seen[ids])
            dt = np.zeros(grades - 1)
            if grade < grades - 1:
                dt[grade] -= dh
            if grade > 0:
                dt[grade - 1] += dl
            back = np.cumsum(dt[::-1])[::-1]  # a gap moves every threshold above it
            first -= 0.05 * rate * back[0]
            gaps -= 0.05 * rate * np.clip(back[1:] * np.exp(gaps), -1, 1)
    thresholds = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
    model = Model(grades, (weights * scale).astype(np.float32), thresholds, 0.5, settings)
    if not check:
        return model
    tail = model.tails(np.array([score(ids, model) for ids, _ in check]))[:, 0]
    lowest = np.array([g == 0 for _, g in check])
    return Model(grades, model.weights, thresholds, _cut(tail, lowest), settings)


def _evidence(data: list[tuple[np.ndarray, int]], grades: int, settings: Settings) -> np.ndarray:
    """How well each bucket alone tells grades up to k from those above, for the best k: the log ratio
    of its shares among either, less `certain` standard errors; 0 for most buckets."""
    count = np.zeros((grades, settings.buckets))
    rows = np.zeros(grades)
    for ids, g in data:
        count[g, ids] += 1
        rows[g] += 1
    best = np.zeros(settings.buckets)
    for k in range(1, grades):
        a, b = count[:k].sum(axis=0) + 0.5, count[k:].sum(axis=0) + 0.5
        n, m = rows[:k].sum() + 1, rows[k:].sum() + 1
        ratio, error = np.log(a / n) - np.log(b / m), np.sqrt(1 / a + 1 / b)
        best = np.maximum(best, np.abs(ratio) - settings.certain * error)
    return best


def _cut(tail: np.ndarray, lowest: np.ndarray) -> float:
    """The cut with the fewest misjudged calibration rows, the middle of the best stretch; 0.5 if one side is empty."""
    if lowest.all() or not lowest.any():
        return 0.5
    at = np.unique(np.r_[0.0, tail, 1.0])
    middle = (at[1:] + at[:-1]) / 2
    wrong = (np.searchsorted(np.sort(tail[~lowest]), middle) + lowest.sum() - np.searchsorted(np.sort(tail[lowest]), middle))
    best = np.flatnonzero(wrong == wrong.min())
    return float(middle[best[len(best) // 2]])


def _logistic(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def score(ids: np.ndarray, model: Model) -> float:
    return float(model.weights[ids].sum())


def fit(docs: DataFrame, ratings: DataFrame, grade: Column, grades: int, doc_id: str = "doc_id", text: str = "text",
        settings: Settings = Settings()) -> Model:
    """Train on about `settings.sample` rated documents, drawn by a hash of the rating's id.

    `grade` is an integer expression over `ratings` from 0 to grades - 1; null or other values leave
    the row out. Ratings are drawn before the join, so only the drawn texts move.
    """
    rated = ratings.select(F.col(doc_id).alias("_id"), grade.cast("int").alias("_grade")).filter(
        (F.col("_grade") >= 0) & (F.col("_grade") < grades) & F.col("_id").isNotNull())
    n, scale = rated.count(), 1 << 40
    if n > settings.sample:
        rated = rated.filter(F.pmod(F.xxhash64("_id"), F.lit(scale)) < scale * settings.sample // n)
    rated = rated.limit(2 * settings.sample)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(rated), "_id").limit(2 * settings.sample)
    return train(sorted((r["_text"] or "", r["_grade"]) for r in rows.select("_text", "_grade").collect()), grades, settings)


def rate(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`row` (all columns of docs, or those in `carry`), expected_grade, tails, grade and keep.

    tails holds P(grade >= k) for k from 1; grade is the likeliest one; keep says whether the first
    tail reaches the model's cut. Whole texts are read; a null text is rated as an empty one.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = broadcast.value

        def work(texts):
            scores = np.array([score(features(t, m.settings), m) for t in texts.to_pylist()])
            tails = m.tails(scores)
            each = -np.diff(np.c_[np.ones(len(scores)), tails, np.zeros(len(scores))], axis=1)
            return [tails.sum(axis=1), tails.tolist(), each.argmax(axis=1).astype(np.int32), tails[:, 0] >= m.cut]

        return work

    return annotate(docs, [F.col(text)], make, "expected_grade double, tails array<double>, grade int, keep boolean", carry)
