"""Byte-pair encoding, token counts and packing against the libraries."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import prose
from tidelines.llm import bpe, packing, token_counts
from tidelines.llm.queries import packed

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
library = tokenizers.Tokenizer.from_file(PATH)


def want_ids(text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs", "Cn")), max_size=60))
def test_encode_like_library(text):
    codec = bpe.codec(PATH)
    ids = codec.encode(text)
    assert ids == want_ids(text)
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_decode_of_broken_sequences():
    draw, codec = random.Random(3), bpe.codec(PATH)
    for _ in range(300):
        ids = [draw.randrange(50_257) for _ in range(draw.randrange(6))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_single_and_many_merges_agree():
    codec = bpe.codec(PATH)
    for n in (1, 2, 3, 7, 31, 64):
        raw = [codec.byte_ids[b] for b in prose(n, 40).replace(" ", "").encode()[:n]]
        grid = np.full((2, 64), -1)
        grid[:, : len(raw)] = raw
        many = codec.merge_many(grid)[0]
        assert codec.merge([int(x) for x in raw]) == many[many >= 0].tolist()


def test_round_trip_of_odd_rows(table, odd_pairs):
    both = bpe.decode(bpe.encode(table(odd_pairs), PATH), PATH)
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in both.collect())
    assert got == Counter((i, tuple(want_ids(t)), t or "") for i, t in odd_pairs)


def test_id_outside_vocabulary(spark):
    with pytest.raises(Exception, match="vocabulary|out of bounds|ndex"):
        bpe.codec(PATH).decode([60_000])


@pytest.mark.parametrize("frequent", [0, 3, 10_000])
def test_token_counts_of_odd_rows(table, odd_pairs, frequent):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = Counter(tuple(r) for r in token_counts.count_tokens(table(odd_pairs), PIECES, frequent).collect())
    assert got == Counter((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in odd_pairs)


def check_packing(rows, pairs, window=1024):
    ids = {}
    for i, t in pairs:
        ids.setdefault(i, []).append(np.array([*want_ids(t), 0], "<u4"))
    pieces, sequences = Counter(), {}
    for r in rows:
        assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(x) == r.doc_tokens for x in ids[r.doc_id])
        pieces[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces == Counter({i: sum(map(len, x)) for i, x in ids.items()})
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0  # full, or another power of two: no padding anywhere


def test_packing_of_odd_rows(table, odd_pairs):
    check_packing(packed(table(odd_pairs)).collect(), odd_pairs)


def test_packing_over_shards():
    packer, pairs = packing.Packer(64, 16, 0), []
    draw = np.random.default_rng(5)
    for row in range(300):
        ids = draw.integers(0, 50, draw.integers(1, 150)).astype("<u4")
        pairs.append((row, ids))
        packer.add(row, ids)
    packer.finish()
    for row, ids in pairs:
        own = sorted((start, x) for r, start, x, _, _, _ in packer.out if r == row)
        assert np.concatenate([x for _, x in own]).tolist() == ids.tolist()
    sizes = Counter()
    for _, _, x, _, sequence, offset in packer.out:
        assert offset == sizes[sequence]
        sizes[sequence] += len(x)
    assert all(n & (n - 1) == 0 and n <= 64 for n in sizes.values())


def test_neighbours_share_words():
    one, two = np.arange(10, dtype="<u4"), np.arange(100, 110, dtype="<u4")
    scores = packing.Index([one, two, one[:7], two[:4]]).scores(one)
    assert scores.argsort()[::-1][:2].tolist() == [0, 2] and scores[1] == scores[3] == 0


def test_empty_table(table):
    none = table([])
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0
    assert token_counts.count_tokens(none, PIECES).count() == 0
    assert packed(none).count() == 0


def test_query_on_table(spark, sf_dir):
    from tidelines.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op1_bpe_round_trip"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = want_ids(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_packing_encodes_as_the_codec(odd_pairs, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t or "" for _, t in odd_pairs] + ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 300_000, " " * 1000 + "\n\n\u2003z"]
    for long in (packing.LONG, 10):
        monkeypatch.setattr(packing, "LONG", long)
        for text in texts:
            assert packing.encoder(path).encode(text).tolist() == bpe.codec(path).encode(text)


def test_packing_takes_the_nearest_by_plain_bm25():
    """Whole remainders go to the seed in the order of BM25 over the shard, computed here from its definition."""
    draw = np.random.default_rng(5)
    documents = [draw.integers(0, 60, draw.integers(20, 60)).astype("<u4") for _ in range(40)]
    n, mean = len(documents), np.mean([len(d) for d in documents])
    df = {t: sum(t in d for d in documents) for t in range(60)}

    def bm25(query, d):
        tf = {t: int((d == t).sum()) for t in set(query.tolist())}
        weight = lambda t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (packing.K1 + 1)
        norm = packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
        return sum(weight(t) / (tf[t] + norm) for t in tf if tf[t])

    index = packing.Index(documents)
    for seed in (0, 7, 39):
        want = [bm25(documents[seed], d) for d in documents]
        assert index.scores(documents[seed], seed) == pytest.approx(want) and index.scores(documents[seed]) == pytest.approx(want)
    packer = packing.Packer(256, 100, 0)
    packer.left = [(i, 0, d, len(d)) for i, d in enumerate(documents)]
    packer.fill()
    first = [row for row, _, _, _, sequence, _ in packer.out if sequence == 0]
    order = [j for j in np.argsort([-bm25(documents[0], d) for d in documents], kind="stable") if j != 0]
    space, chosen, cut = 256 - len(documents[0]), [0], None
    for j in order[: packing.NEIGHBOURS]:
        if len(documents[j]) <= space:
            chosen.append(int(j))
            space -= len(documents[j])
        elif cut is None:
            cut = int(j)
    assert first == chosen + ([cut] if space else [])
