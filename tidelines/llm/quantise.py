"""Product quantisation of vectors, nearest entries found by their component sums (equal-average search).

By Cauchy and Schwarz the squared distance of two points is at least the square of the difference of their component
sums over their dimension. A codebook is sorted by sum, and a part looks at entries outward from its own sum, next
nearest sum first; it stops as soon as the squared gap over the dimension strictly exceeds the best distance. No entry
left out can be nearer, or as near with a lower index, so results are those of comparing all.

Entries begin as the parts of the vectors with the smallest ids; each round assigns all parts and moves every used entry
to the floored mean of its parts. Rounds send exact partial sums, a number of rows that depends on the codebooks alone,
so neither the size of the table nor a vector held by a third of its rows matters. Input is read once a round: stage an
expensive one.

Rows whose vector is null or holds a null, NaN or infinite entry are left out. Shorter vectors count as filled up with
zeros to the longest, and the dimension as filled up to a multiple of the number of parts. Repeated rows all count.
Equal ids are ordered by vector, null ids come last. With fewer rows than entries there are as many entries as rows;
without rows there is no result. ``error`` and ``label_error`` are decimals, null beyond 38 digits. Null labels form one
label.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import staged
from tidelines.llm.vectors import SUMS, decimals, exact_sums, matrix, sums_batch, whole

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Sums of labels travel to all tasks up to this many labels (some 20 MB), and are joined by shuffle beyond.
LABELS = 200_000


def kept_rows(vectors: DataFrame, id: str, column: str) -> DataFrame:
    """id, vector, size and bits (a bound on the size of entries, as a power of two) of the rows that are not left out."""
    kind, vector = (vectors.schema[c].dataType.simpleString() for c in (id, column))

    def run(batches):
        for batch in batches:
            values, keep, lengths = matrix(batch.column(1))
            bits = np.frexp(np.abs(values).max(axis=1, initial=0.0))[1]
            kept = [c.filter(pa.array(keep)) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lengths, pa.int32()), pa.array(bits, pa.int32())], names=["id", "vector", "size", "bits"])

    return vectors.select(F.col(id).alias("id"), F.col(column).alias("vector")).mapInArrow(run, f"id {kind}, vector {vector}, size int, bits int")


def cut(values: np.ndarray, scale: int, parts: int, exact: bool) -> np.ndarray:
    """Whole numbers by (part, position, row): doubles, or Python integers if ``exact`` asks for them."""
    x = whole(values, scale)
    if exact and x.dtype != object:
        wide = np.empty(x.shape, object)
        wide.flat = [int(v) for v in x.ravel().tolist()]
        x = wide
    return np.ascontiguousarray(x.T).reshape(parts, -1, len(x))


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry, the lower index of equal ones, for each column of ``part``
    (position, row). ``entries`` is (entry, position)."""
    width, n = part.shape
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    # Beyond either end there is no entry: an infinite gap, which exceeds every distance.
    ranked = np.concatenate([[-np.inf], sums[order], [np.inf]]).astype(part.dtype)
    across = np.ascontiguousarray(entries.T)
    label, distance = np.full(n, len(entries)), np.full(n, np.inf).astype(part.dtype)
    rows, own = np.arange(n), part.sum(axis=0)
    right = np.searchsorted(ranked[1:-1], own) + 1
    left = right - 1
    best, chosen = distance.copy(), label.copy()
    while True:
        below, above = own - ranked[left], ranked[right] - own
        down = below <= above
        gap = np.where(down, below, above)
        go = (gap * gap <= best * width) & (gap < np.inf)
        if not go.all():
            done = ~go
            label[rows[done]], distance[rows[done]] = chosen[done], best[done]
            rows, own, left, right, down, best, chosen = (a[go] for a in (rows, own, left, right, down, best, chosen))
            if not len(rows):
                return label, distance
        entry = order[np.where(down, left, right) - 1]
        difference = part[:, rows] - across[:, entry]
        found = (difference * difference).sum(axis=0)
        better = (found < best) | ((found == best) & (entry < chosen))
        best, chosen = np.where(better, found, best), np.where(better, entry, chosen)
        left, right = left - down, right + ~down


def _assigned(values: np.ndarray, scale: int, books: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    cells = cut(values, scale, len(books), books.dtype == object)
    return cells, [nearest(cell, book) for cell, book in zip(cells, books)]


def _round(vectors: DataFrame, column: str, scale: int, books: np.ndarray, width: int) -> DataFrame:
    """Partial sums: under key (part * entries + entry) * (positions + 1), positions first, then the number of parts."""
    parts, entries, k = books.shape
    exact = books.dtype == object

    def run(batches):
        sums = np.zeros((parts, entries, k + 1), object if exact else np.int64)
        for batch in batches:
            values, _, _ = matrix(batch.column(0), width)
            cells, found = _assigned(values, scale, books)
            for p, (label, _) in enumerate(found):
                sums[p, :, k] += np.bincount(label, minlength=entries)
                for j in range(k):
                    if exact:
                        np.add.at(sums[p, :, j], label, cells[p, j])
                    else:
                        sums[p, :, j] += np.bincount(label, cells[p, j], minlength=entries).astype(np.int64)
        yield sums_batch(enumerate(int(v) for v in sums.ravel()))

    return vectors.select(column).mapInArrow(run, SUMS)


def train(vectors: DataFrame, id: str, column: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (part, entry, position); None without any row."""
    rows = kept_rows(vectors, id, column)
    size, bits, n = rows.agg(F.max("size"), F.max("bits"), F.count(F.lit(1))).first()
    if not n:
        return None
    width = max(1, -(-size // parts)) * parts
    k = width // parts
    # Doubles hold squared distances, and sums over a batch, below 2**52.
    high = max(bits, -20) + scale.bit_length()
    exact = 2 * (high + 1) + k.bit_length() > 52 or high + n.bit_length() > 62
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    values, _, _ = matrix(first.column(0).combine_chunks(), width)
    books = np.ascontiguousarray(cut(values, scale, parts, exact).transpose(0, 2, 1))
    for _ in range(rounds):
        total = exact_sums(_round(vectors, column, scale, books, width))
        for p in range(parts):
            for e in range(books.shape[1]):
                at = (p * books.shape[1] + e) * (k + 1)
                count = total.get(at + k, 0)
                if count:
                    books[p, e] = [total.get(at + j, 0) // count for j in range(k)]
    return books


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and position, joined by commas."""
    return ",".join(str(int(v)) for v in books.ravel())


def encode(vectors: DataFrame, books: np.ndarray, id: str, column: str, label: str, scale: int = SCALE) -> DataFrame:
    """id, label, code (two hexadecimal digits a part) and error of each kept row."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in (id, label)]
    width = books.shape[0] * books.shape[2]

    def run(batches):
        for batch in batches:
            values, keep, _ = matrix(batch.column(2), width)
            _, found = _assigned(values, scale, books)
            labels = np.stack([label for label, _ in found], axis=1)
            error = sum(distance for _, distance in found)
            codes = pa.array([r.tobytes().hex() for r in labels.astype(np.uint8)], pa.string())
            errors = decimals(error if error.dtype == object else error.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(c.filter(pa.array(keep)) for c in batch.columns[:2]), codes, errors], names=["id", "label", "code", "error"])

    chosen = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(column).alias("vector"))
    return chosen.mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, code string, error decimal(38,0)")


def compress(vectors: DataFrame, id: str = "vec_id", column: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """id (under its name), code, error, label_error (the error of all rows of the same label) and codebooks_sha256.
    At most 256 entries a part."""
    books = train(vectors, id, column, parts, entries, rounds, scale)
    out = [F.col("id").alias(id), "code", "error", "label_error", "codebooks_sha256"]
    if books is None:
        kind = vectors.schema[id].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"`{id}` {kind}, code string, error decimal(38,0), label_error decimal(38,0), codebooks_sha256 string")
    coded = staged(encode(vectors, books, id, column, label, scale), "codes")
    sums = staged(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").cast("decimal(38,0)").alias("label_error")), "label-errors")
    # Counted, so the broadcast has a bound; beyond it AQE splits the rows of a frequent label.
    sums = F.broadcast(sums) if sums.count() <= LABELS else sums
    joined = coded.join(sums, coded["label"].eqNullSafe(sums["of"]))
    return joined.withColumn("codebooks_sha256", F.lit(hashlib.sha256(books_text(books).encode()).hexdigest())).select(*out)
