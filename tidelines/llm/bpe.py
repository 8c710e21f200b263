"""Byte-level BPE encoding and decoding (operator 1).

A pre-token's symbols form the leaves of a segment tree. A leaf holds the key of the pair that starts there, rank first
and position second, so the root is the leftmost pair of the lowest rank. Each merge changes three leaves, and each
change climbs one path. A pre-token of n bytes takes O(n log n), however long it is.

Edge cases: a null or empty text has no ids and decodes to the empty text; the special strings of the file are matched
first, as the tokenizers library does by default; repeated rows are each encoded; other columns are dropped, except
the key columns asked for.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import map_slices

#: The pre-token pattern of the byte-level vocabulary (a fixed value of the file format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts without the characters of ``ODD``, in the syntax of the faster standard module.
PLAIN = re.compile(r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Pre-tokens whose ids a worker keeps; beyond it the memory is emptied, which costs time only.
KEPT = 400_000
#: Pre-tokens of up to so many bytes are merged many at a time.
SHORT = 64
END = np.int64(1 << 62)


@cache
def odd() -> frozenset[str]:
    """Characters that the two patterns class differently: number letters, and what the modules call a space."""
    space = regex.compile(r"\s")
    every = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    return frozenset(c for c in every if (c.isalnum() or unicodedata.category(c)[0] in "LN") and (unicodedata.category(c)[0] != "L" or not c.isalnum()) and not c.isdecimal() or c.isspace() != bool(space.match(c)))


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte: itself if visible in Latin-1, else the next letter from U+0100."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in visible}
    letters.update((b, chr(256 + i)) for i, b in enumerate(b for b in range(256) if b not in letters))
    return letters


class Pairs:
    """Ranks of pairs of ids, looked up for whole arrays: sparse tables by multiplicative hash, one after the other."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        left = np.array([(a << 32) + b for a, b in pairs], np.int64)
        rank = np.array([r for r, _ in pairs.values()], np.int64)
        self.tables = []
        while len(left):
            factor = np.uint64((0x9E3779B97F4A7C15 + 2 * len(self.tables) * 0x632BE59BD9B4E019) & (1 << 64) - 1)
            keys, ranks = np.full(1 << 19, END), np.zeros(1 << 19, np.int64)
            at = (left.view(np.uint64) * factor >> np.uint64(45)).view(np.int64)
            _, first = np.unique(at, return_index=True)
            keys[at[first]], ranks[at[first]] = left[first], rank[first]
            self.tables.append((factor, keys, ranks))
            left, rank = np.delete(left, first), np.delete(rank, first)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, END where the pair does not merge."""
        key = (a.astype(np.int64) << 32) + b  # b = -1 gives a key that no pair has
        out = np.full(len(key), END)
        for factor, keys, ranks in self.tables:
            at = (key.view(np.uint64) * factor >> np.uint64(45)).view(np.int64)
            out = np.where(keys[at] == key, ranks[at], out)
        return out


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.lookup = Pairs(self.pairs)
        self.merged = np.array([new for _, new in self.pairs.values()], np.int64)
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)])
        bytes_of = {letter: b for b, letter in letters.items()}
        self.bytes = {i: bytes(bytes_of[c] for c in piece) for piece, i in vocab.items() if all(c in bytes_of for c in piece)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes.update((i, s.encode()) for s, i in self.special.items())
        self.pieces = pa.array([self.bytes.get(i) for i in range(max(self.bytes) + 1)], pa.binary())
        self.split = regex.compile(PATTERN)
        self.mark = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.kept: dict[str, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges to one pre-token of any length."""
        n = len(ids)
        if n < 2:
            return ids
        pairs, end = self.pairs, 1 << 62
        half = 1 << (n - 1).bit_length()
        tree = [end] * (2 * half)
        for i in range(n - 1):
            if found := pairs.get((ids[i], ids[i + 1])):
                tree[half + i] = found[0] * n + i
        for k in range(half - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]

        def put(i: int) -> None:
            j = after[i]
            found = pairs.get((ids[i], ids[j])) if j < n else None
            k = half + i
            tree[k] = found[0] * n + i if found else end
            while k := k >> 1:
                tree[k] = min(tree[2 * k], tree[2 * k + 1])

        while tree[1] != end:
            i = tree[1] % n
            j = after[i]
            ids[i] = pairs[ids[i], ids[j]][1]
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            ids[j], after[j] = -1, n
            put(j)
            put(i)
            if before[i] >= 0:
                put(before[i])
        return [x for x in ids if x >= 0]

    def merge_many(self, ids: np.ndarray) -> np.ndarray:
        """Apply the merges to many short pre-tokens, the rows of ``ids`` (-1 fills up); each row has its own segment
        tree and all trees take a step together. Merged symbols become -1."""
        m, n = ids.shape
        half = 1 << (n - 1).bit_length()
        ids = np.concatenate([ids, np.full((m, 1), -1)], axis=1)  # column n takes writes that go nowhere
        tree = np.full((m, 2 * half), END)
        rank = self.lookup.ranks(ids[:, : n - 1].ravel(), ids[:, 1:n].ravel()).reshape(m, n - 1)
        tree[:, half : half + n - 1] = np.where(rank < END, rank * n + np.arange(n - 1), END)
        for k in range(half - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        after = np.tile(np.arange(1, n + 2), (m, 1))
        before = np.tile(np.r_[n, np.arange(n)], (m, 1))
        rows = np.flatnonzero(tree[:, 1] < END)
        flat, size = tree.ravel(), 2 * half
        while len(rows):
            root = tree[rows, 1]
            i = root % n
            j = after[rows, i]
            k, h = after[rows, j], before[rows, i]
            k = np.minimum(k, n)
            new = self.merged[root // n]
            ids[rows, i], ids[rows, j] = new, -1
            after[rows, i], before[rows, k] = k, i
            before[rows, n] = n
            right = self.lookup.ranks(new, ids[rows, k])
            left = self.lookup.ranks(ids[rows, h], new)
            base = rows * size + half
            flat[base + j] = END
            flat[base + i] = np.where(right < END, right * n + i, END)
            has = h < n
            flat[(base + h)[has]] = np.where(left < END, left * n + h, END)[has]
            base = rows * size
            nodes = [half + i, half + j, np.where(has, half + h, half + i)]
            for _ in range(half.bit_length() - 1):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    two = base + 2 * x
                    flat[base + x] = np.minimum(flat[two], flat[two + 1])
            rows = rows[flat[base + 1] < END]
        return ids[:, :n]

    def learn(self, tokens: list[str]) -> dict[str, bytes]:
        """The ids of distinct pre-tokens, as 32-bit integers."""
        raw = [t.encode() for t in tokens]
        sizes = np.array([*map(len, raw)])
        out: dict[str, bytes] = {}
        low = 0
        for high in (4, 8, 12, 16, 32, SHORT):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in np.array_split(chosen, len(chosen) // 4096 + 1):
                if not len(part):
                    continue
                n = sizes[part]
                grid = np.zeros((len(part), high), np.uint8)
                inside = np.arange(high) < n[:, None]
                grid[inside] = np.frombuffer(b"".join([raw[i] for i in part]), np.uint8)
                ids = self.merge_many(np.where(inside, self.byte_ids[grid], -1))
                data, ends = ids[ids >= 0].astype(np.int32).tobytes(), 4 * np.cumsum((ids >= 0).sum(axis=1))
                start = 0
                for i, end in zip(part.tolist(), ends.tolist()):
                    out[tokens[i]] = data[start:end]
                    start = end
            low = high
        for i in np.flatnonzero(sizes > SHORT):
            out[tokens[i]] = np.array(self.merge(self.byte_ids[np.frombuffer(raw[i], np.uint8)].tolist()), np.int32).tobytes()
        return out

    def cut(self, text: str, split) -> list[str]:
        """Pre-tokens of a text; special strings stand alone, after a mark no pre-token can start with."""
        if self.mark is None or not any(s in text for s in self.special):
            return split(text)
        parts = self.mark.split(text)
        return [t for i, part in enumerate(parts) for t in (["\ud800" + part] if i % 2 else split(part))]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text."""
        kept = self.kept
        if len(kept) > KEPT:
            kept.clear()
        if not kept:
            kept.update(("\ud800" + s, np.int32(i).tobytes()) for s, i in self.special.items())
        cuts = [self.cut(t, PLAIN.findall) for t in texts]
        missing = set(chain.from_iterable(cuts)).difference(kept)
        # One look at all new characters: odd ones are rare. A pre-token with one is never kept, so it is always new.
        strange = set() if odd().isdisjoint("".join(missing)) else {t for t in missing if not odd().isdisjoint(t)}
        if strange:
            cuts = [c if strange.isdisjoint(c) else self.cut(t, self.split.findall) for t, c in zip(texts, cuts)]
            missing = set(chain.from_iterable(cuts)).difference(kept)
        kept.update(self.learn([*missing]))
        parts = [b"".join([*map(kept.__getitem__, c)]) for c in cuts]
        odd_ones = set() if odd().isdisjoint("".join(missing)) else {t for t in missing if not odd().isdisjoint(t)}
        for t in [t for t in missing if len(t) > SHORT or t in odd_ones]:  # long ones cost memory
            del kept[t]
        return np.frombuffer(b"".join(parts), np.int32), np.array([len(p) // 4 for p in parts], np.int64)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: pa.Array, ends: list[int]) -> list[str]:
        """Texts of consecutive runs of ids; ``ends`` are the runs' ends."""
        data = self.pieces.take(ids)
        if data.null_count:
            raise ValueError("an id lies outside the vocabulary")
        if not len(data):
            return [""] * len(ends)
        offsets = np.frombuffer(data.buffers()[1], np.int32)
        joined, out, start = memoryview(data.buffers()[2]) if data.buffers()[2] else memoryview(b""), [], 0
        for end in ends:
            out.append(bytes(joined[offsets[start] : offsets[end]]).decode("utf-8", "replace"))
            start = end
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array(ids, pa.int32()), [len(ids)])[0]


@cache
def codec(path: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ``ids`` (array of int) of every text."""

    def make():
        encoder = codec(path)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            flat, counts = encoder.encode_all(part.column(1).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(flat, pa.int32()))
            return pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

        return step

    source = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return map_slices(source, make, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """key, ``ids`` and the ``decoded`` text of ``ids``; ids outside the vocabulary raise an error."""

    def run(batches):
        table = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column(1)
                ends = ids.offsets.to_numpy() - ids.offsets[0].as_py()
                out = table.decode_all(ids.flatten(), ends[1:].tolist())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(out, pa.string())], names=[key, "ids", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(run, f"{key} {kind}, ids array<int>, decoded string")
