"""Document fingerprints from improbable features (operator 8).

A feature is a window of 64 bytes of the UTF-8 text. Windows are ranked by how rare their entropy is in the corpus (a
histogram of 1001 levels, counted over all documents), the rarest first. In every run of 64 windows the leftmost of
the best rank scores a point, and windows of enough points are selected. Selected features set five bits each of a
Bloom filter of 256 bytes; after 160 features the next filter of the chain begins. Two fingerprints are compared
filter by filter: each filter of the shorter chain takes its best partner, common bits count beyond those expected by
chance, and the result is averaged by the bits set.

Edge cases: a null or empty text has the empty fingerprint, which is like itself (1) and unlike all others (0); a text
shorter than a window is one feature; equal texts have equal fingerprints; rows of one doc_id are put in order by
text digest; a row without doc_id comes after all others; a single row is its own next document; other columns are
dropped. Long texts are gone through in pieces, with the same result. Rows of one doc_id, or without one, are dealt over
tasks by their text hashes; only equal rows stay together.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import slices, texts
from tidelines.panel import count_not_above

SIZE = 64
POINTS = 16
FILTER_BITS = 2048
PER_FILTER = 160
LEVELS = 1001
#: Windows of lower entropy (in thousandths of six bits) come last whatever their rarity: runs and rulers.
LEAST_ENTROPY = 100
BLOCK = 1 << 17
#: Bytes of a longer text that are looked at at once, but for what its windows overlap.
PIECE = 1 << 20
ROWS_PER_RANGE = 2_000
MOST_RANGES = 20_000

_UNIT = 1 << 16
_GROWTH = np.array([0 if c == 0 else round(_UNIT * c * math.log2(c)) for c in range(SIZE + 1)], np.int64)
_STEP = np.diff(_GROWTH).astype(np.int32)
_MULTIPLIERS = np.frombuffer(b"".join(xxhash.xxh64_digest(bytes([k])) for k in range(SIZE)), np.uint64) | np.uint64(1)


def levels(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy level of the window at each byte of concatenated texts, and whether it lies in one text.

    The sum of c log c over a window's byte counts changes by one step in and one step out when the window moves, and
    the steps depend on how often the moving byte occurs in the 63 bytes before and after it."""
    n = len(raw)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for start in range(0, n, BLOCK):
        stop = min(n, start + BLOCK)
        for k in range(1, SIZE):
            low = max(start, k)
            if low >= stop:
                break
            same = raw[low:stop] == raw[low - k : stop - k]
            before[low:stop] += same
            after[low - k : stop - k] += same
    starts = np.cumsum(sizes) - sizes
    long = np.flatnonzero(sizes >= SIZE)
    valid = np.zeros(n, bool)
    change = np.zeros(n + 1, np.int64)
    if n > SIZE:
        change[1 : n - SIZE + 1] = _STEP[before[SIZE:]]
        change[1 : n - SIZE + 1] -= _STEP[after[: n - SIZE]]
    total = np.cumsum(change[:n])
    index = np.repeat(np.arange(len(sizes)), sizes)
    first = np.zeros(len(sizes), np.int64)
    for d in long:
        first[d] = _GROWTH[np.bincount(raw[starts[d] : starts[d] + SIZE])].sum() - total[starts[d]]
    place = np.arange(n) - starts[index]
    valid = place <= (sizes - SIZE)[index]
    sums = total + first[index]
    level = np.where(valid, (LEVELS - 1) - sums * (LEVELS - 1) // (6 * SIZE * _UNIT), 0)
    return level, valid


def ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of each level, rarest first; levels that never occur are as rare as can be, low ones come last."""
    order = np.lexsort((np.arange(LEVELS), histogram, np.arange(LEVELS) < LEAST_ENTROPY))
    out = np.empty(LEVELS, np.int64)
    out[order] = np.arange(LEVELS)
    return out


def joined(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(found), np.uint8), np.array([*map(len, found)], np.int64)


def features(raw: np.ndarray, sizes: np.ndarray, rank: np.ndarray, points_needed: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The selected windows of concatenated texts: their text, their place in it and their hash, in order. By default the
    points that select a window are fewer in short texts."""
    level, valid = levels(raw, sizes)
    n, starts = len(raw), np.cumsum(sizes) - sizes
    index = np.repeat(np.arange(len(sizes)), sizes)
    shift = int(n).bit_length()
    worst = np.int64(1) << 62
    best = np.where(valid, (rank[level] << shift) + np.arange(n), worst)
    # Windows of windows: the minimum over 64 places, by doubling. Short texts have one, over all they have.
    reach = best
    for step in (1, 2, 4, 8, 16, 32):
        reach = np.minimum(reach, np.concatenate([reach[step:], np.full(min(step, n), worst)])[:n])
    windows = np.maximum(sizes - SIZE + 1, 0)
    runs = np.where(windows > SIZE, windows - SIZE + 1, (windows > 0).astype(np.int64))
    place = np.arange(n) - starts[index]
    inside = place < runs[index]
    # A text of less than 64 windows must not look beyond its end.
    few = np.flatnonzero((windows > 0) & (windows < SIZE))
    for d in few:
        reach[starts[d]] = best[starts[d] : starts[d] + windows[d]].min()
    points = np.bincount(reach[inside] & ((np.int64(1) << shift) - 1), minlength=n)
    needed = np.minimum(POINTS, np.maximum(1, runs // 8)) if points_needed is None else np.full(len(sizes), points_needed)
    chosen = np.flatnonzero(points >= np.maximum(needed[index], 1))
    view = np.lib.stride_tricks.sliding_window_view(raw, SIZE) if n >= SIZE else np.empty((0, SIZE), np.uint8)
    value = np.empty(len(chosen), np.uint64)
    for start in range(0, len(chosen), 4096):
        part = view[chosen[start : start + 4096]].astype(np.uint64)
        part += np.uint64(1)
        value[start : start + 4096] = (part * _MULTIPLIERS).sum(axis=1)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(29)
    return index[chosen], place[chosen], value


def long_features(text: bytes, rank: np.ndarray) -> np.ndarray:
    """Hashes of the selected windows of one text of more than PIECE bytes, piece by piece. Points of a window come from
    runs that begin up to 63 windows before it and end up to 63 windows after it."""
    raw, windows, found = np.frombuffer(text, np.uint8), len(text) - SIZE + 1, []
    for start in range(0, windows, PIECE):
        stop, first = min(windows, start + PIECE), max(0, start - SIZE + 1)
        part = raw[first : stop + 2 * SIZE - 2]
        _, place, value = features(part, np.array([len(part)]), rank, POINTS)
        found.append(value[(place >= start - first) & (place < stop - first)])
    return np.concatenate(found)


def fingerprints(found: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of each text, as rows of bytes."""
    if not any(found):
        return [np.empty((0, FILTER_BITS // 8), np.uint8) for _ in found]
    # Texts shorter than a window are features of their own.
    short = [d for d, t in enumerate(found) if 0 < len(t) < SIZE]
    owners, values = [np.array(short, np.int64)], [np.array([xxhash.xxh64_intdigest(found[d]) for d in short], np.uint64)]
    rest = np.array([d for d, t in enumerate(found) if SIZE <= len(t) <= PIECE], np.int64)
    if len(rest):
        owner, _, value = features(*joined([found[d] for d in rest]), rank)
        owners.append(rest[owner])
        values.append(value)
    for d, t in enumerate(found):
        if len(t) > PIECE:
            values.append(long_features(t, rank))
            owners.append(np.full(len(values[-1]), d))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.argsort(owner, kind="stable")
    owner, value = owner[order], value[order]
    counts = np.bincount(owner, minlength=len(found))
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    chain = -(-counts // PER_FILTER)
    row = (np.cumsum(chain) - chain)[owner] + nth // PER_FILTER
    bits = np.zeros((chain.sum(), FILTER_BITS), bool)
    for k in range(5):
        bits[row, (value >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)] = True
    filters = np.packbits(bits, axis=1)
    return np.split(filters, np.cumsum(chain)[:-1])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised overlap of two chains, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    one, two = a.view(np.uint64), b.view(np.uint64)
    bits_a, bits_b = (np.bitwise_count(x).sum(axis=1).astype(float) for x in (one, two))
    best = np.empty(len(a))
    for k in range(len(a)):
        common = np.bitwise_count(one[k] & two).sum(axis=1)
        chance = bits_a[k] * bits_b / FILTER_BITS
        most = np.minimum(bits_a[k], bits_b)
        floor = chance + 0.2 * (most - chance)
        best[k] = np.max(np.where(most > floor, (common - floor) / np.maximum(most - floor, 1e-9), common >= most))
    return float(min(1.0, max(0.0, (np.clip(best, 0, 1) * bits_a).sum() / bits_a.sum())))


def text_of(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def level_histogram(docs: DataFrame) -> np.ndarray:
    """How often each entropy level occurs, over all windows of all documents."""

    def run(batches):
        total = np.zeros(LEVELS, np.int64)
        for part in slices(batches):
            found = [t.encode() for t in part.column(0).to_pylist()]
            pieces = [[t[k : k + PIECE + SIZE - 1]] for t in found if len(t) > PIECE for k in range(0, len(t) - SIZE + 1, PIECE)]
            for some in [[t for t in found if len(t) <= PIECE], *pieces]:
                raw, sizes = joined(some)
                if len(raw):
                    level, valid = levels(raw, sizes)
                    total += np.bincount(level[valid], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["level", "n"])

    counted = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(LEVELS, np.int64)
    for row in counted:
        out[row["level"]] = row["n"]
    return out


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (range, doc_id, guest, text), sorted within partitions so that every row is followed by its next document
    in descending order of doc_id. A range's last row needs the first of the range below, which comes as a guest."""
    rows = texts(docs).select("doc_id", "text", F.xxhash64("text").alias("h"))
    n, known = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    cells = int(min(MOST_RANGES, max(1, known // ROWS_PER_RANGE)))
    shares = [k / cells for k in range(1, cells)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, max(1000, 4 * cells))).first()[0] or [0]
    # A doc_id that is the cut of several ranges has rows for several: they are dealt by their text hashes, in order.
    cuts, repeats = np.unique(np.array(cuts), return_counts=True)
    without = int(min(MOST_RANGES, max(1, (n - known) // ROWS_PER_RANGE)))
    borders, shared = F.lit(cuts), F.lit(repeats)
    rows = rows.withColumn("below", count_not_above(borders, F.col("doc_id"), int(len(cuts)).bit_length() + 1))
    rows = rows.withColumn("cut", F.coalesce(F.get(borders, F.col("below") - 1) == F.col("doc_id"), F.lit(False)))
    parts = F.when(F.col("doc_id").isNull(), F.lit(without)).when(F.col("cut"), F.get(shared, F.col("below") - 1)).otherwise(1)
    rows = rows.withColumn("parts", parts.cast("long"))
    # Ranges in the order of doc_id, those without one lowest; within a doc_id the smaller hashes come first.
    range_ = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(2 * (1 + F.col("below") - F.col("cut").cast("int")) + (F.col("parts") > 1).cast("int"))
    part = F.least(F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * F.col("parts")), F.col("parts") - 1)
    cell = range_.cast("long") * (2 * MOST_RANGES) + F.col("parts") - 1 - part
    placed = rows.select(cell.alias("cell"), "doc_id", "text", "h")
    # One row per range, so at most a few tens of thousands.
    first = F.max(F.struct("doc_id", F.bitwise_not("h").alias("h"))).alias("first")
    heads = placed.groupBy("cell").agg(first).orderBy("cell").select("cell", "first.*").collect()
    home = placed.select("cell", "doc_id", F.lit(False).alias("guest"), "text")
    if not heads:
        return home
    targets = [(r["cell"], r["doc_id"], ~r["h"], heads[(k + 1) % len(heads)]["cell"]) for k, r in enumerate(heads)]
    at = docs.sparkSession.createDataFrame(targets, f"at long, head {docs.schema['doc_id'].dataType.simpleString()}, hash long, target long")
    is_head = (F.col("cell") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("h") == F.col("hash"))
    # Repeated rows are one guest.
    guests = placed.join(F.broadcast(at), is_head).groupBy("target", "doc_id").agg(F.min("text").alias("text"))
    both = home.union(guests.select("target", "doc_id", F.lit(True), "text"))
    order = [F.col("cell"), F.col("guest"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    return both.repartition(len(heads), "cell").sortWithinPartitions(*order)


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next."""
    rank = ranks(level_histogram(docs))
    rows = with_next(docs)

    def run(batches):
        pending = None  # the last row that still waits for its next document: cell, doc_id, text, filters
        for part in slices(batches, "text"):
            cells, ids, guests, found = (part.column(k).to_pylist() for k in range(4))
            prints = fingerprints([t.encode() for t in found], rank)
            done = []
            for c, i, g, t, p in zip(cells, ids, guests, found, prints):
                if pending is not None and pending[0] == c:
                    done.append((*pending[1:], t, p))
                    pending = None
                elif pending is not None:
                    raise ValueError("a range came without its guest")
                if not g:
                    pending = (c, i, t, p)
            changed = [edited(t, t2) for _, t, _, t2, _ in done]
            for start in range(0, len(done), 1000):
                some, new = done[start : start + 1000], changed[start : start + 1000]
                new_prints = fingerprints([t.encode() for t in new], rank)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d[0] for d in some], part.column(1).type),
                        pa.array([len(d[1]) for d in some], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                        pa.array([text_of(d[2]) for d in some], pa.string()),
                        pa.array([text_of(p) for p in new_prints], pa.string()),
                        pa.array([likeness(d[2], p) for d, p in zip(some, new_prints)], pa.float64()),
                        pa.array([likeness(d[2], d[4]) for d in some], pa.float64()),
                    ],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
