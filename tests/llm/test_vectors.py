"""Whitening and vector codes against plain exact arithmetic."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tidelines.llm import quantise, vectors, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, code binary, size int, id string, vector int, error double"


def _table(spark, rows):
    """(vec_id, vector, label) rows, with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, k, b"x", 1, "y", 2, 0.5) for i, v, k in rows], SCHEMA).repartition(3)


def _odd(width=16, n=80, scale=1.0):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, scale) for _ in range(width)], i % 3 if i % 5 else None) for i in range(n)]
    hot = [draw.gauss(0, scale) for _ in range(width)]
    rows += [(1000 + i, hot, 1) for i in range(40)]  # a vector that many rows hold
    rows += [rows[0], rows[1], (None, [0.25 * scale] * width, 2), (None, None, 0), (7, None, None)]
    rows += [(2000, [math.nan] * width, 1), (2001, [math.inf] + [0.0] * (width - 1), 1), (2002, [None] + [0.0] * (width - 1), 1)]
    rows += [(3000, [-0.0] * width, 0), (3001, [scale] * (width - 3), 2), (3002, [], 2), (3003, [0.5 * scale] + [0.0] * (width - 1), 2), (3004, [0.5 * scale], 2)]
    return rows


def _kept(rows, scale):
    good = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in good), default=0)
    return [(i, tuple(math.floor(Fraction(x) * scale) for x in v) + (0,) * (width - len(v)), k) for i, v, k in good], width


def _plain_whitening(rows):
    kept, width = _kept(rows, 256)
    fit = sorted({v for _, v, _ in kept})
    n, sums = len(fit), [sum(v[j] for v in fit) for j in range(width)]
    z = [[n * v[j] - sums[j] for j in range(width)] for v in fit]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in z), n**3)) for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for i, v, _ in kept:
        c = [n * v[j] - sums[j] for j in range(width)]
        for k in range(min(4, width)):
            white = float(np.array([float(Fraction(x, n)) for x in c]) @ axes[:, k]) / math.sqrt(values[k])
            out.append((i, k + 1, n, sum(x * x for x in c), abs(white), values[k] / np.trace(cov)))
    return out


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e20])
def test_whitening_is_that_of_exact_covariances(spark, scale):
    rows = _odd(scale=scale)
    got = whitening.whiten(_table(spark, rows)).collect()
    want = _plain_whitening(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3] or 0, r[4])
    mine = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got), key=key)
    assert len(mine) == len(want)
    for a, b in zip(mine, sorted(want, key=key)):
        assert a[:3] == b[:3] and (a[3] == b[3] or b[3] >= 10**38)
        assert a[4:] == pytest.approx(b[4:], rel=1e-6, abs=1e-9)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    signs = defaultdict(set)
    for r in got:
        signs[r["vec_id"], r["component"]].add(r["whitened"])
    assert all(len(v) == 1 for (i, _), v in signs.items() if i is not None)


def test_whitening_without_rows_or_variance(spark):
    assert whitening.whiten(_table(spark, [(1, None, 0)])).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    got = whitening.whiten(_table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in sorted(got, key=lambda r: (r["vec_id"], r["component"]))] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)] * 2
    assert whitening.whiten(_table(spark, [(1, [], 0)])).count() == 0


def test_equal_vectors_have_one_code_whatever_is_beside_them(spark):
    rows = [(i, [1.0, 2.0, 0.0], 0) for i in range(6)] + [(9, [1e25, 1.0], 0), (10, [1.0, 2.0], 0)]
    assert whitening.fit_list(_table(spark, rows), "embedding", 256).count() == 2


def test_exact_sums_of_numbers_of_any_size(spark):
    draw = random.Random(1)
    numbers = [(k, draw.choice([-1, 1]) * draw.getrandbits(bits)) for k in range(5) for bits in (3, 40, 90, 200)]
    batch = vectors.sums_batch(numbers)
    total = vectors.exact_sums(spark.createDataFrame(batch.to_pylist() * 3, vectors.SUMS))
    assert total == {k: 3 * sum(v for j, v in numbers if j == k) for k in range(5)}


def _plain_codes(rows, parts=8, entries=16, rounds=6):
    kept, width = _kept(rows, 4096)
    step = max(1, -(-width // parts))
    cut = [tuple((v + (0,) * (parts * step - width))[p * step : (p + 1) * step] for p in range(parts)) for _, v, _ in kept]
    raw = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, raw[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min(range(len(first)), key=lambda e: (far(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        chosen = assign()
        for p in range(parts):
            for e in range(len(first)):
                mine = [c[p] for c, a in zip(cut, chosen) if a[p] == e]
                if mine:
                    books[p][e] = tuple(sum(x) // len(mine) for x in zip(*mine))
    chosen = assign()
    errors = [sum(far(c[p], books[p][a[p]]) for p in range(parts)) for c, a in zip(cut, chosen)]
    by_label = defaultdict(int)
    for (_, _, k), e in zip(kept, errors):
        by_label[k] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, bytes(a).hex(), e, by_label[k], digest) for (i, _, k), a, e in zip(kept, chosen, errors))


@pytest.mark.parametrize("width,scale", [(16, 1.0), (13, 0.02), (16, 1e12)])
def test_codes_are_those_of_comparing_all_entries(spark, width, scale):
    rows = _odd(width=width, scale=scale)
    got = quantise.compress(_table(spark, rows)).collect()
    mine = Counter((r["vec_id"], r["code"], int(r["error"]), int(r["label_error"]), r["codebooks_sha256"]) for r in got)
    assert mine == _plain_codes(rows)


def test_codes_of_few_rows_and_of_none(spark):
    rows = [(2, [1.0] * 8, 1), (1, [2.0] * 8, None), (1, [2.0] * 8, None)]
    got = quantise.compress(_table(spark, rows)).collect()
    assert Counter((r["vec_id"], r["code"], int(r["error"]), int(r["label_error"]), r["codebooks_sha256"]) for r in got) == _plain_codes(rows)
    for empty in (spark.createDataFrame([], SCHEMA), _table(spark, [(1, None, 1), (2, [math.nan], 1)])):
        assert quantise.compress(empty).count() == 0


def test_label_sums_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantise, "LABELS", 0)
    rows = _odd()
    got = quantise.compress(_table(spark, rows)).collect()
    assert Counter((r["vec_id"], r["label_error"]) for r in got) == Counter((i, e) for (i, _, _, e, _), c in _plain_codes(rows).items() for _ in range(c))


def test_nearest_entry_with_ties_and_equal_sums():
    draw = np.random.default_rng(2)
    for width, entries in ((1, 3), (2, 16), (8, 16)):
        part = draw.integers(-3, 4, (width, 500)).astype(float)
        book = draw.integers(-3, 4, (entries, width)).astype(float)
        all_pairs = ((part.T[:, None, :] - book[None]) ** 2).sum(axis=2)
        label, distance = quantise.nearest(part, book)
        assert (label == all_pairs.argmin(axis=1)).all() and (distance == all_pairs.min(axis=1)).all()
