"""Whitening of embeddings by covariances from squares alone (polarisation).

The variance of a sum of two dimensions is the sum of their variances and twice their covariance. So squares are all
that is added up: of every centred dimension and of every sum of two. Centred values are n*x - S, whole numbers, so every
sum is exact, in whatever order tasks deliver; one division per entry turns it into a covariance, correct to the last
bit. The matrix (dimensions squared, the one thing that comes to the driver) goes to ``eigh``.

Rows whose vector is null or holds a null, NaN or infinite entry are left out. Shorter vectors count as filled up with
zeros to the longest. Repeated rows stay in the result and count once in the fit, as do different rows of equal vectors.
Without rows there is no result. A component without variance has a null ``whitened`` and takes no part in
``identity_error``; ``explained`` is 0 if nothing varies. A null or repeated id is carried through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import staged
from tidelines.llm.vectors import DIGIT, SUMS, decimals, exact_sums, matrix, sums_batch, whole

#: Rows whose squares are added at once; with digits of 21 bits their sum is exact as a double.
BLOCK = 2048


@dataclass(frozen=True)
class Whitening:
    """n, sums S and largest size of the fit list, its components (dimension, component) and what they explain."""

    scale: int
    width: int
    n: int
    sums: list[int]
    largest: int
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray


def _codes(column: pa.Array, scale: int) -> tuple[pa.Array, pa.Array]:
    """Equal vectors get equal bytes, whatever else is in their batch: little-endian integers of the least width that
    holds them (text from 2**52 on), without trailing zeros."""
    values, _, lengths = matrix(column)
    x = whole(values, scale)
    most = np.abs(x).max(axis=1, initial=0)
    rows = []
    for row, size in zip(x, most):
        if size >= 1 << 52:
            rows.append(b"t" + b",".join(b"%d" % v for v in _trimmed(row)))
        else:
            width = 1 if size < 1 << 7 else 2 if size < 1 << 15 else 4 if size < 1 << 31 else 8
            rows.append(b"%d" % width + _trimmed(row).astype(f"<i{width}").tobytes())
    return pa.array(rows, pa.binary()), pa.array(lengths, pa.int32())


def _trimmed(row):
    last = len(row)
    while last and row[last - 1] == 0:
        last -= 1
    return row[:last]


def _vectors(codes: pa.Array, width: int) -> np.ndarray:
    """The whole numbers of codes, as doubles if they are all below 2**52, else as Python integers."""
    raw = codes.to_pylist()
    if any(c[:1] == b"t" for c in raw):
        out = np.zeros((len(raw), width), object)
    else:
        out = np.zeros((len(raw), width))
    for i, code in enumerate(raw):
        if code[:1] == b"t":
            row = [int(v) for v in code[1:].split(b",") if v]
        else:
            row = np.frombuffer(code, f"<i{code[:1].decode()}", offset=1)
            row = [int(v) for v in row] if out.dtype == object else row
        out[i, : len(row)] = row
    return out


def fit_list(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """code (each distinct whole-number vector once) and size (the longest vector of that code)."""

    def run(batches):
        for batch in batches:
            code, size = _codes(batch.column(0), scale)
            yield pa.RecordBatch.from_arrays([code, size], names=["code", "size"])

    codes = vectors.select(column).mapInArrow(run, "code binary, size int")
    return codes.groupBy("code").agg(F.max("size").alias("size"))


def _totals(codes: DataFrame, width: int) -> DataFrame:
    """Partial sums of the fit list: each dimension (keys from 0), then n."""

    def run(batches):
        sums, n = [0] * width, 0
        for batch in batches:
            x = _vectors(batch.column(0), width)
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0))]
        yield sums_batch([*enumerate(sums), (width, n)])

    return codes.select("code").mapInArrow(run, SUMS)


def _largest(codes: DataFrame, width: int) -> int:
    """A power of two above every entry's size."""

    def run(batches):
        bits = 0
        for batch in batches:
            x = _vectors(batch.column(0), width)
            bits = max(bits, max((int(v) for v in np.abs(x).max(axis=1, initial=0)), default=0).bit_length())
        yield pa.RecordBatch.from_arrays([pa.array([bits], pa.int32())], names=["bits"])

    return 1 << (codes.select("code").mapInArrow(run, "bits int").agg(F.max("bits")).first()[0] or 0)


def _squares(codes: DataFrame, width: int, n: int, sums: list[int], largest: int) -> DataFrame:
    """Partial sums of squares: of dimension i under key i * width + i, of the sum of i and j > i under i * width + j."""
    keys = [i * width + j for i in range(width) for j in range(i, width)]
    starts = [0, *np.cumsum(np.arange(width, 0, -1)).tolist()]
    # A centred value is below 2 * n * largest; a sum of two must split into two digits.
    small = 4 * n * largest < 1 << (2 * DIGIT)

    def run(batches):
        held = np.zeros((4, len(keys)), np.int64) if small else np.zeros(len(keys), object)
        for batch in batches:
            x = _vectors(batch.column(0), width)
            if not small:
                z = x.astype(object) if x.dtype == object else _integers(x)
                z = z * n - np.array(sums, object)
                for i in range(width):
                    y = z[:, i:] + z[:, i : i + 1]
                    y[:, :1] = z[:, i : i + 1]
                    held[starts[i] : starts[i + 1]] += (y * y).sum(axis=0)
                continue
            for start in range(0, len(x), BLOCK):
                # Down the columns, so that a sum runs over neighbouring values.
                z = np.ascontiguousarray((x[start : start + BLOCK] * n - np.array(sums, float)).T)
                for i in range(width):
                    y = z[i:] + z[i]
                    y[0] = z[i]
                    np.abs(y, out=y)
                    high = np.floor(y * 2.0**-DIGIT)
                    y -= high * 2.0**DIGIT
                    at = slice(starts[i], starts[i + 1])
                    held[0, at] += np.einsum("ij,ij->i", y, y).astype(np.int64)
                    held[1, at] += 2 * np.einsum("ij,ij->i", high, y).astype(np.int64)
                    held[2, at] += np.einsum("ij,ij->i", high, high).astype(np.int64)
            for digit in range(3):
                held[digit + 1] += held[digit] >> DIGIT
                held[digit] &= (1 << DIGIT) - 1
        if small:
            held = [sum(int(v) << (DIGIT * k) for k, v in enumerate(column)) for column in held.T.tolist()]
        yield sums_batch(zip(keys, held))

    return codes.select("code").mapInArrow(run, SUMS)


def _integers(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, object)
    out.flat = [int(v) for v in x.ravel().tolist()]
    return out


def fit(vectors: DataFrame, column: str = "embedding", components: int = 4, scale: int = 256) -> tuple[Whitening, float] | None:
    """The whitening of a column of vectors and its ``identity_error``; None without any row."""
    codes = staged(fit_list(vectors, column, scale), "fit-list")
    width = codes.agg(F.max("size")).first()[0]
    if width is None:
        return None
    total = exact_sums(_totals(codes, width))
    n, sums = total[width], [total.get(i, 0) for i in range(width)]
    largest = _largest(codes, width)
    squares = exact_sums(_squares(codes, width, n, sums, largest))
    square = lambda i, j: squares.get(i * width + j, 0)
    covariance = np.zeros((width, width))
    for i in range(width):
        covariance[i, i] = square(i, i) / n**3
        for j in range(i + 1, width):
            covariance[i, j] = covariance[j, i] = (square(i, j) - square(i, i) - square(j, j)) / (2 * n**3)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    # The largest entry of a component is positive, which fixes the sign.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]) if width else axes
    trace = sum(square(i, i) for i in range(width)) / n**3
    varies = values > trace * width * np.finfo(float).eps
    deviations = np.where(varies, np.sqrt(np.maximum(values, 0)), 0.0)
    explained = np.maximum(values, 0) / trace if trace else np.zeros(len(values))
    model = Whitening(scale, width, n, sums, largest, axes, deviations, explained)
    return model, _identity_error(codes, model)


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """x - S/n on each component over its deviation; NaN where nothing varies."""
    z = _centred(x, model)
    centred = (z if z.dtype != object else np.array([[float(v) for v in r] for r in z.tolist()]).reshape(z.shape)) / model.n
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(model.deviations > 0, centred @ model.components / model.deviations, np.nan)


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n*x - S, exactly."""
    if x.dtype != object and 2 * model.n * model.largest < 1 << 52:
        return x * model.n - np.array(model.sums, float)
    return (x if x.dtype == object else _integers(x)) * model.n - np.array(model.sums, object)


def _identity_error(codes: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list less the identity."""
    live = np.flatnonzero(model.deviations > 0)
    k = len(live)

    def run(batches):
        mean, outer = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _project(_vectors(batch.column(0), model.width), model)[:, live]
            mean += w.sum(axis=0)
            outer += w.T @ w
        values = [*mean, *outer.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values, pa.float64())], names=["key", "value"])

    parts = codes.select("code").mapInArrow(run, "key int, value double")
    total = {r["key"]: r["value"] for r in parts.groupBy("key").agg(F.sum("value").alias("value")).collect()}
    if not k:
        return 0.0
    mean = np.array([total[i] for i in range(k)]) / model.n
    outer = np.array([total[k + i] for i in range(k * k)]).reshape(k, k) / model.n
    return float(np.abs(outer - np.outer(mean, mean) - np.eye(k)).max())


def _deviation(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over dimensions of (n*x - S) squared."""
    z = _centred(x, model)
    if z.dtype != object and model.width * (2 * model.n * model.largest) ** 2 < 1 << 62:
        z = z.astype(np.int64)
        return decimals((z * z).sum(axis=1))
    if z.dtype != object and 2 * model.n * model.largest < 1 << (2 * DIGIT):
        z = np.abs(z).astype(np.int64)
        high, low = z >> DIGIT, z & ((1 << DIGIT) - 1)
        parts = [(low * low).sum(axis=1), 2 * (high * low).sum(axis=1), (high * high).sum(axis=1)]
        return decimals([a + (b << DIGIT) + (c << 2 * DIGIT) for a, b, c in zip(*(p.tolist() for p in parts))])
    z = z if z.dtype == object else _integers(z)
    return decimals((z * z).sum(axis=1).tolist() if model.width else [0] * len(z))


def whiten(vectors: DataFrame, id: str = "vec_id", column: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """One row for each kept row and component: id, component (from 1), n, deviation (decimal), whitened, explained and
    identity_error."""
    kind = vectors.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    fitted = fit(vectors, column, components, scale)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    model, error = fitted
    count = len(model.explained)

    def run(batches):
        for batch in batches:
            values, keep, _ = matrix(batch.column(1), model.width)
            if not len(values) or not count:
                continue
            x = whole(values, model.scale)
            w = _project(x, model).ravel()
            rows = pa.array(np.repeat(np.arange(len(x)), count))
            numbers = np.tile(np.arange(count), len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(pa.array(keep)).take(rows),
                    pa.array(numbers + 1, pa.int32()),
                    pa.array(np.full(len(w), model.n), pa.int64()),
                    _deviation(x, model).take(rows),
                    pa.array([None if math.isnan(v) else v for v in w.tolist()], pa.float64()),
                    pa.array(model.explained[numbers]),
                    pa.array(np.full(len(w), error)),
                ],
                names=[id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select(id, column).mapInArrow(run, schema)
