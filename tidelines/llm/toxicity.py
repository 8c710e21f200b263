"""Toxicity by compression distance (operator 7).

Two zstandard dictionaries are learned from labelled documents: one of ordinary text, one of toxic text. A text is cut
into windows of some words, and each window is compressed with both. Toxic documents are ordinary text but for some
words, so the toxic dictionary is the ordinary one preceded by the strings that toxic documents have and ordinary ones
have not: a window without any of them has the same length under both, and the gain of a window is what the toxic
dictionary saves. A document's gains are turned into a score by thresholds that are calibrated on labelled documents.

Dictionary content is chosen as in cover training: word beginnings of 4 to 10 characters, by the number of their
different uses in either class (copies of a document add none), counted by Spark over the sample (at most ``max_labels`` labelled documents, those of
the smallest hashed ids). What reaches the driver is bounded by ``TOXIC_STRINGS`` and ``ORDINARY_STRINGS``.

Edge cases: a null or empty text has no window and the score of a text without gain; words longer than a window make
a window of their own; repeated rows are scored alike; without both labels every score is 0; other columns are dropped.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import keep_rows, map_slices, slices, staged, texts
from tidelines.llm.quality import in_fold, labelled_sample, logistic

MAX_LABELS = 16_000
THRESHOLD = 0.7
#: Characters of a window; a window ends with the word that reaches it.
WINDOW = 96
#: Ends every window: the compressor looks for no match in its last bytes.
TAIL = "\n" * 12
TOXIC_STRINGS = 500
#: A toxic string is so many times as common in toxic documents, and so surprising (chi-square of one degree).
CONTRAST = 10
LEAST_SURPRISE = 40
ORDINARY_STRINGS = 4_000
PREFIXES = range(4, 11)
#: Longer words are cut for counting; no string of a dictionary is longer.
LONGEST = 16


def uses(text: str) -> set[tuple[str, int]]:
    """A text's words, each with a hash of the words beside it. Copies of a text add no new pair."""
    found = text.lower().split()
    around = zip(["", *found], found, [*found[1:], ""])
    return {(w[:LONGEST], zlib.crc32(f"{a} {b}".encode())) for a, w, b in around if len(w) >= PREFIXES[0]}


def windows(text: str) -> list[bytes]:
    """The lower-cased words of a whole text in windows, joined and led by single blanks."""
    out, held, size = [], [], 0
    for w in text.lower().split():
        held.append(w)
        size += len(w) + 1
        if size >= WINDOW:
            out.append((" " + " ".join(held) + TAIL).encode())
            held, size = [], 0
    if held:
        out.append((" " + " ".join(held) + TAIL).encode())
    return out


@dataclass(frozen=True)
class Model:
    """Both dictionaries, and the calibrated weights of a document's largest gain, its gains' sum and a constant."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...] = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))


@cache
def compressors(toxic: bytes, ordinary: bytes):
    found = []
    for content in (toxic, ordinary):
        settings = zstandard.ZstdCompressionParameters(
            window_log=19, hash_log=17, chain_log=17, search_log=6, min_match=5, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=settings)
        found.append(zstandard.ZstdCompressor(dict_data=content, compression_params=settings).compress)
    return found


def gains(model: Model, text: str) -> list[float]:
    """The figures of one text that the calibration weighs: its largest gain, the sum of gains, the windows of clear
    gain, gains per window, the number of windows, a constant."""
    toxic, ordinary = compressors(model.toxic, model.ordinary)
    cut = windows(text)
    found = [g for w in cut if (g := len(ordinary(w)) - len(toxic(w))) > 0]
    clear = sum(g >= 3 for g in found)
    return [min(max(found, default=0), 12) / 4, math.log1p(sum(found)), math.log1p(clear), sum(found) / (len(cut) + 1), math.log1p(len(cut)), 1.0]


def surprise(t: int, o: int, n_toxic: int, n_ordinary: int) -> float:
    """Likelihood ratio of a string's share of toxic documents against its share of all, 0 if it is not higher."""
    share = (t + o) / (n_toxic + n_ordinary)
    if not t or not share < 1 or t / n_toxic <= share:
        return 0.0
    out = 0.0
    for k, n in ((t, n_toxic), (o, n_ordinary)):
        out += k * math.log(max(k, 1e-9) / n / share) + (n - k) * math.log(max(n - k, 1e-9) / n / (1 - share))
    return 2 * out


def choose(counts: list[tuple[str, int, int]], n_toxic: int, n_ordinary: int) -> tuple[bytes, bytes]:
    """Dictionary contents from (string, uses in toxic documents, uses in ordinary ones): toxic strings by their surprise, where
    neither a beginning nor a continuation of a chosen string is chosen again, and the most common ordinary strings."""
    if not n_toxic or not n_ordinary:
        return b"", b""
    rated = ((surprise(t, o, n_toxic, n_ordinary), s) for s, t, o in counts if t / n_toxic > CONTRAST * o / n_ordinary)
    rated = [(score * (1 + len(s) / 20), s) for score, s in rated if score >= LEAST_SURPRISE]  # of equals the longer
    picked: list[str] = []
    for _, s in sorted(rated, key=lambda x: (-x[0], x[1])):
        if len(picked) >= TOXIC_STRINGS:
            break
        if not any(s.startswith(p) or p.startswith(s) for p in picked):
            picked.append(s)
    common = [s for s, _, o in sorted(counts, key=lambda x: (-x[2], x[0])) if o > 0][:ORDINARY_STRINGS]
    base = "".join(reversed(common)).encode()
    return "".join(picked).encode() + base, base


def calibrate(model: Model, x: np.ndarray, label: np.ndarray) -> Model:
    if not (label == 1).any() or not (label == 0).any():
        return model
    return Model(model.toxic, model.ordinary, tuple(logistic(x, label.astype(float), penalty=0.1).tolist()))


def string_counts(sample: DataFrame) -> DataFrame:
    """string, toxic and ordinary: different uses (word and its neighbours) of each word beginning in either class."""

    def run(batches):
        for part in slices(batches):
            found, kinds = [], []
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = uses(text)
                found.extend(own)
                kinds.extend([label] * len(own))
            words, around = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(around, pa.int64()), pa.array(kinds, pa.int32())], names=["word", "around", "label"])

    spread = sample.select("text", F.col("label").cast("int")).mapInArrow(run, "word string, around long, label int").distinct()
    per_word = spread.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary"))
    cuts = F.array(*[F.when(F.length("word") >= k, F.concat(F.lit(" "), F.substring("word", 1, k))) for k in PREFIXES])
    strings = per_word.select(F.explode(F.array_compact(cuts)).alias("string"), "toxic", "ordinary")
    return strings.groupBy("string").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).filter("toxic + ordinary >= 3")


def gain_frame(docs: DataFrame, model: Model) -> DataFrame:
    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [gains(model, t) for t in part.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "gains"])

        return step

    return map_slices(texts(docs), make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, gains array<double>")


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1), max_labels: int = MAX_LABELS) -> Model:
    """Learn from the labelled documents outside the fold ``held_out`` (parts, remainder). Two thirds of the sample make
    the dictionaries and the rest the calibration, which must not see strings of its own choice."""
    sample = labelled_sample(docs, labels, "toxic", ~in_fold("doc_id", *held_out), max_labels)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) > 0
    source = sample.filter(part)
    counts = staged(string_counts(source), "strings")
    # The shortest beginnings are one for each use, so their sums are the numbers of uses.
    sums = counts.filter(F.length("string") == PREFIXES[0] + 1).agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")).first()
    n_toxic, n_ordinary = sums["t"] or 0, sums["o"] or 0
    toxic = counts.filter("toxic >= 3").orderBy(F.expr("toxic / (ordinary + 1.0)").desc(), F.desc("toxic"), "string").limit(10 * TOXIC_STRINGS)
    common = counts.orderBy(F.desc("ordinary"), "string").limit(ORDINARY_STRINGS)
    held = {(r["string"], r["toxic"], r["ordinary"]) for r in toxic.union(common).toArrow().to_pylist()}
    model = Model(*choose(sorted(held), n_toxic, n_ordinary))
    if not model.ordinary:
        return model
    other = sample.filter(~part)
    known = gain_frame(other, model).join(F.broadcast(other.select("doc_id", "label").distinct()), "doc_id").toArrow()
    x = np.array(known.column("gains").to_pylist(), float).reshape(-1, 6)
    return calibrate(model, x, known.column("label").to_numpy())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` of every document."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = part.column(1).to_pylist()
            found = np.array([gains(model, t) for t in rows], float) if model.weights else np.zeros((len(rows), 6))
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(found))], names=["doc_id", "score"])

        return step

    return map_slices(texts(docs), make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_civil(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, whose score stays below the threshold."""
    if not model.weights:
        return docs
    return keep_rows(docs, lambda: lambda found: (model.scores(np.array([gains(model, t) for t in found], float)) < THRESHOLD).tolist())
