"""Vectors of Arrow batches as NumPy matrices, and exact sums of whole numbers over all tasks."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whole numbers travel in digits of this many bits, so that Spark can add them up as longs without overflow.
DIGIT = 21
_MASK = (1 << DIGIT) - 1
SUMS = "key int, digit int, value long"


def matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Doubles (rows, dimensions), which rows are kept, and their lengths.

    A row is kept unless its vector is null or holds a null, NaN or infinite entry. Shorter vectors are filled up with
    zeros to ``width`` (the longest kept one if not given)."""
    lengths = np.asarray(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    keep = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
    of = np.repeat(np.arange(len(lengths)), lengths)
    keep[of[~np.isfinite(flat)]] = False
    if width is None:
        width = int(lengths[keep].max(initial=0))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)[keep], keep, lengths[keep]
    out = np.zeros((len(lengths), width))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    wanted = keep[of]
    out[of[wanted], at[wanted]] = flat[wanted]
    return out[keep], keep, lengths[keep]


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value), exactly: doubles where they hold it, else Python integers. ``scale`` is a power of two."""
    if np.abs(values).max(initial=0.0) * scale < 2.0**52:
        return np.floor(values * scale) + 0.0
    exact = np.empty(values.shape, object)
    exact.flat = [math.floor(Fraction(v) * scale) for v in values.ravel().tolist()]
    return exact


def digits(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a whole number, the digits with its sign."""
    sign, rest, place = (-1 if value < 0 else 1), abs(int(value)), 0
    while rest:
        if rest & _MASK:
            yield place, sign * (rest & _MASK)
        rest >>= DIGIT
        place += 1


def sums_batch(pairs: Iterable[tuple[int, int]]) -> pa.RecordBatch:
    """Rows of SUMS for (key, whole number) pairs."""
    rows = [(key, place, digit) for key, value in pairs for place, digit in digits(value)]
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = [pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "digit", "value"])


def exact_sums(parts: DataFrame) -> dict[int, int]:
    """The sum of each key. What comes back is a few rows a key, so the number of keys must have a bound."""
    total: dict[int, int] = {}
    for row in parts.groupBy("key", "digit").agg(F.sum("value").alias("value")).collect():
        total[row["key"]] = total.get(row["key"], 0) + (row["value"] << (DIGIT * row["digit"]))
    return total


def decimals(values: Iterable[int]) -> pa.Array:
    """decimal(38, 0); null beyond 38 digits."""
    if isinstance(values, np.ndarray) and values.dtype == np.int64:
        return pa.array(values).cast(pa.decimal128(38, 0))
    from decimal import Decimal

    return pa.array([Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in values], pa.decimal128(38, 0))
