"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of all subwords of all its words. Subwords are hashed over whole
texts at once rather than word by word, since most words of a large corpus are new. Training is plain stochastic
gradient descent in numpy over a bounded sample of labelled rows; part of the sample is held back to
set the temperature of the scores and the score below which a text is rejected.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import annotate

UNKNOWN = "und"
# Positions of a text that are hashed at a time, so that memory stays bounded for very long texts.
BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15
    width: int = 16
    grams: tuple[int, ...] = (2, 3, 4)
    epochs: int = 12
    rate: float = 0.5
    sample: int = 2400  # labelled rows the model is fitted on (about as many; never over twice that)
    calibration: float = 0.25  # share of the sample that sets temperature and rejection only
    rejected: float = 0.001  # share of rightly labelled calibration rows that may be rejected
    certain: float = 0.5  # a score of this or more is never rejected
    seed: int = 7


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    table: np.ndarray  # bucket -> evidence for each label: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float
    settings: Settings


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(text: str | None, settings: Settings) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams of all words, each word with a mark at either end.

    Whatever is no letter is a mark; an n-gram may begin and end with a mark but hold none inside,
    and holds a letter. Nothing is yielded for a text without letters.
    """
    if not text:
        return
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 1).astype(np.uint64)
    for n in settings.grams:
        for a in range(0, len(codes) - n + 1, BLOCK):
            b = min(a + BLOCK, len(codes) - n + 1)
            good = letter[a:b] | letter[a + 1 : b + 1] if n == 2 else letter[a + 1 : b + 1]
            h = codes[a:b]
            for i in range(1, n):
                h = h * _ODD + codes[a + i : b + i]
                if 1 < i < n - 1:
                    good = good & letter[a + i : b + i]
            h = h[good] * _MIX
            if len(h):
                yield ((h >> np.uint64(32)) * np.uint64(settings.buckets) >> np.uint64(32)).astype(np.int64)


def _bag(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray] | None:
    n = np.zeros(settings.buckets)
    for ids in subwords(text, settings):
        n += np.bincount(ids, minlength=settings.buckets)
    ids = np.flatnonzero(n)
    return (ids, n[ids] / n.sum()) if len(ids) else None


def train(rows: list[tuple[str, str]], settings: Settings = Settings()) -> Model:
    """Fit on (text, label) rows. No rows, or no letters in any: a model that knows no label."""
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(rows))
    bags: list[tuple] = []
    for at, i in enumerate(order):
        if (bag := _bag(rows[i][0], settings)) is not None:
            bags.append((*bag, rows[i][1], at < settings.calibration * len(rows)))
    labels = tuple(sorted({b[2] for b in bags}))
    if not labels:
        return Model((), np.zeros((settings.buckets, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0, settings)
    at = {label: i for i, label in enumerate(labels)}
    embed = rng.normal(0, 1 / settings.width, (settings.buckets, settings.width))
    out, bias = np.zeros((settings.width, len(labels))), np.zeros(len(labels))
    learn = [b for b in bags if not b[3]] or bags
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        for i in rng.permutation(len(learn)):
            ids, w, label, _ = learn[i]
            mean = w @ embed[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[at[label]] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            embed[ids] -= rate * w[:, None] * back[None, :] * min(len(ids), 50)
    table, bias = (embed @ out).astype(np.float32), bias.astype(np.float32)
    check = [b for b in bags if b[3]] or bags
    z = np.array([w @ table[ids] + bias for ids, w, _, _ in check])
    y = np.array([at[label] for _, _, label, _ in check])
    steps = np.geomspace(0.05, 20, 60)
    temperature = float(min(steps, key=lambda t: _loss(z / t, y)))
    score = _softmax(z / temperature)
    right = score.max(axis=1)[score.argmax(axis=1) == y]
    threshold = min(settings.certain, float(np.quantile(right, settings.rejected))) if len(right) else settings.certain
    return Model(labels, table, bias, temperature, threshold, settings)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(y)), y] + 1e-12).mean())


def fit(docs: DataFrame, label: str = "lang", doc_id: str = "doc_id", text: str = "text",
        settings: Settings = Settings()) -> Model:
    """Train on about `settings.sample` rows with a label, drawn by a hash of id and text.

    One task trains on the sample, whose size is bounded; only the model comes to the driver.
    """
    known = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    n, scale = known.count(), 1 << 40
    if n > settings.sample:
        lot = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(scale))
        known = known.filter(lot < scale * settings.sample // n).limit(2 * settings.sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(sorted(rows), settings))], pa.binary())], names=["model"])

    made = known.select(F.col(text), F.col(label)).coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0].model) if made else train([], settings)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`row` (all columns of docs), lang_pred, score (0 to 1) and accepted.

    A null text, a text without a letter, or a model that knows no label gives `und`, score 0 and
    accepted false. Otherwise lang_pred is the likeliest label; accepted says whether its calibrated
    score reaches the model's threshold. The whole text is read.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = broadcast.value

        def work(texts):
            names, scores, sure = [], [], []
            for value in texts.to_pylist():
                total, n = np.zeros(len(m.labels)), 0
                for ids in subwords(value, m.settings) if m.labels else ():
                    total, n = total + np.ones(len(ids), np.float32) @ m.table.take(ids, axis=0), n + len(ids)
                if not n:
                    names.append(UNKNOWN), scores.append(0.0), sure.append(False)
                    continue
                p = _softmax((total / n + m.bias)[None, :] / m.temperature)[0]
                best = int(p.argmax())
                names.append(m.labels[best]), scores.append(float(p[best])), sure.append(bool(p[best] >= m.threshold))
            return [names, scores, sure]

        return work

    return annotate(docs, [F.col(text)], make, "lang_pred string, score double, accepted boolean")


def keep_identified(docs: DataFrame, label: str = "lang", doc_id: str = "doc_id", text: str = "text",
                    settings: Settings = Settings()) -> DataFrame:
    """The rows of docs whose language the model accepts; it learns from the rows that have a label."""
    return predict(docs, fit(docs, label, doc_id, text, settings), text).filter("accepted").select("row.*")
