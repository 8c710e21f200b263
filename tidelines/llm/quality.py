"""Quality scores by Bradley-Terry pairwise ranking (operator 9).

A document's features say how its text is written, never what it is about. Preference pairs put a good labelled
document before a bad one; the weights are those of the logistic loss on feature differences. The raw score is turned
into [0, 1] so that the quantile of raw scores at the share of bad documents becomes the threshold.

Learning uses at most ``max_labels`` labelled documents (those of the smallest hashed ids) and ``max_pairs`` pairs, so
what reaches the driver is bounded: one short vector for each. Scoring is one pass over all documents, no shuffle.

Edge cases: a null or empty text gets the vector of zero words; labels without a document or with a null are left out;
repeated rows are scored alike; without both labels in the sample every score is 0.5; other columns are dropped.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import keep_rows, map_slices, texts

MAX_LABELS = 20_000
MAX_PAIRS = 200_000
THRESHOLD = 0.3

_UPPER = [*range(65, 91)]
_LOWER = [*range(97, 123)]
_DIGIT = [*range(48, 58)]
_MARKS = {c: ord(c) for c in "!|.,?#$%&*@=<>{}[]()/\\\"'-:;_+~^"}
NAMES = [
    *("upper", "digits", "high_bytes", "lines", "marks"),
    *(f"mark {c}" for c in _MARKS),
    *("repeats", "distinct", "distinct_windows", "distinct_least", "repeated_lines", "word_length", "longest_word", "capitalised", "mark_ends", "packed", "log_words", "short", "empty"),
]


def window_shares(words: list[str], size: int = 200) -> list[float]:
    """The share of different words in each window of ``size`` words, one after the other; the last ends with the text."""
    starts = [*range(0, len(words) - size, size), max(0, len(words) - size)]
    return [len(set(words[a : a + size])) / max(1, len(words[a : a + size])) for a in starts]


def features(text: str) -> list[float]:
    """A fixed set of figures about one text; shares are spread by a square root."""
    raw = text.encode()
    words = text.split()
    n, size = max(1, len(words)), max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [line for line in text.split("\n") if line.strip()]
    letters = counts[_UPPER].sum() + counts[_LOWER].sum() + counts[128:].sum()
    marks = [counts[b] / n for b in _MARKS.values()]
    distinct = window_shares(words)
    shares = [
        counts[_UPPER].sum() / max(1, letters),
        counts[_DIGIT].sum() / size,
        counts[128:].sum() / size,
        len(lines) / n,
        sum(marks),
        *marks,
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        sum(distinct) / len(distinct),
        min(distinct),
        1 - len(set(lines)) / max(1, len(lines)),
        (len(raw) - len(words)) / n / 10,
        max(map(len, words), default=0) / 100,
        sum(w[:1].isupper() for w in words) / n,
        sum(not w[-1:].isalnum() for w in words) / n,
        min(2.0, len(zlib.compress(raw, 1)) / size),
    ]
    return [min(3.0, float(x) ** 0.5) for x in shares] + [np.log1p(len(words)) / 10, float(len(words) < 20), float(not words)]


def feature_frame(docs: DataFrame) -> DataFrame:
    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [features(t) for t in part.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])

        return step

    return map_slices(texts(docs), make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, features array<double>")


def in_fold(doc_id: str, parts: int, held_out: int) -> Column:
    """True for the rows held out: those whose crc32 of the id, as text, leaves ``held_out``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == held_out, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """doc_id, text and label of at most ``most`` labelled documents (the smallest hashed ids). The sample of labels
    is broadcast, which its row limit bounds, so no text is shuffled."""
    known = labels.filter(train & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    chosen = known.groupBy("doc_id").agg(F.max(label).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return texts(docs).join(F.broadcast(chosen), "doc_id")


@dataclass
class Ranking:
    """Weights of the ranking, and how its scores map to [0, 1]."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        odds = self.slope * (self.raw(x) - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD))
        return np.where(self.slope > 0, 1 / (1 + np.exp(-np.clip(odds, -30, 30))), 0.5)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic loss with an L2 penalty, by Newton steps that are halved until the loss falls."""

    def loss(w):
        odds = x @ w
        return np.logaddexp(0, odds).sum() - y @ odds + penalty * (w @ w) / 2

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), slope)
        while (new := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w, was, now = w - step, now, new
        if was - now < 1e-9 * (1 + abs(now)):
            break
    return w


def rank(x: np.ndarray, label: np.ndarray, max_pairs: int = MAX_PAIRS, seed: int = 7) -> Ranking:
    """Fit a ranking to feature rows and their 0/1 labels."""
    nothing = Ranking(np.zeros(len(NAMES)), np.ones(len(NAMES)), np.zeros(len(NAMES)), 0.0, 0.0)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return nothing
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.clip((x - mean) / scale, -6, 6)
    draw = np.random.default_rng(seed)
    pairs = min(max_pairs, 40 * max(len(good), len(bad)))
    difference = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    # Every pair once in each direction keeps the loss symmetric, so no intercept is needed.
    weights = logistic(difference, np.ones(pairs), penalty=pairs / 2000)
    raw = z @ weights
    cut = float(np.quantile(raw, len(bad) / len(label)))
    base = np.stack([raw - cut, np.ones(len(raw))], axis=1)
    slope = float(max(1e-3, logistic(base, label, penalty=1e-3)[0]))
    return Ranking(mean, scale, weights, cut, slope)


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (5, 0), max_labels: int = MAX_LABELS) -> Ranking:
    """Learn from the labelled documents outside the fold ``held_out`` (parts, remainder)."""
    sample = labelled_sample(docs, labels, "quality", ~in_fold("doc_id", *held_out), max_labels)
    known = feature_frame(sample).join(F.broadcast(sample.select("doc_id", "label").distinct()), "doc_id").toArrow()
    x = np.array(known.column("features").to_pylist(), float).reshape(-1, len(NAMES))
    return rank(x, known.column("label").to_numpy())


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id and ``score`` of every document."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([features(t) for t in part.column(1).to_pylist()], float)
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(x))], names=["doc_id", "score"])

        return step

    return map_slices(texts(docs), make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Ranking) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold."""
    return keep_rows(docs, lambda: lambda found: (model.scores(np.array([features(t) for t in found], float)) >= THRESHOLD).tolist())
