"""Packing documents into sequences by lexical retrieval (operator 10).

Each document becomes its ids and one end id. Full windows of a document are sequences of their own; what is left over
goes into a shard of ``SHARD`` remainders of the same task, over whose tokens a BM25 inverted index is built. A seed
takes its best unused neighbours into its window, whole ones first, and the best of the rest is cut to fill it; the cut
one stays in the shard with what is left of it. What a shard cannot fill moves on to the task's next shard, and what
remains at the task's end is cut at powers of two, so no sequence needs padding.

There is no shuffle: a shard never leaves its task, and memory is bounded by a shard.

Edge cases: a null or empty text is the end id alone; repeated rows are each packed; an empty table gives no piece;
other columns are dropped. Sequence ids are unique, not dense: task in the high bits, number within it in the low.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidelines.llm.bpe import PATTERN, codec
from tidelines.llm.common import slices, texts

WINDOW = 1024
SHARD = 2048
END_ID = 0
#: Characters up to which a text is given to the library at once.
LONG = 200_000
#: Neighbours that a seed looks at before one is cut.
NEIGHBOURS = 24
K1, B = 1.2, 0.75


class Index:
    """BM25 inverted index over the tokens of a shard."""

    def __init__(self, documents: list[np.ndarray]):
        sizes = np.array([len(d) for d in documents])
        n = len(documents)
        key = np.concatenate(documents).astype(np.int64) * n + np.repeat(np.arange(n), sizes)
        key, tf = np.unique(key, return_counts=True)
        term, self.docs = key // n, key % n
        self.terms, self.starts, df = np.unique(term, return_index=True, return_counts=True)
        self.ends = self.starts + df
        # The same postings by document: which terms a seed has need not be found again.
        by_document = np.argsort(self.docs, kind="stable")
        self.held = np.repeat(np.arange(len(df)), df)[by_document]
        self.first = np.searchsorted(self.docs[by_document], np.arange(n + 1))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / sizes.mean())
        self.weights = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.docs])
        self.n = n

    def keep(self, wanted: np.ndarray) -> None:
        """Drop the postings of all documents but the ``wanted`` ones; weights stay as they are."""
        held = wanted[self.docs]
        before = np.r_[0, np.cumsum(held)]
        self.starts, self.ends = before[self.starts], before[self.ends]
        self.docs, self.weights = self.docs[held], self.weights[held]

    def scores(self, document: np.ndarray, number: int | None = None) -> np.ndarray:
        """BM25 of every document of the shard for the distinct tokens of one; ``number`` says which, if it is whole."""
        if number is not None:
            at = self.held[self.first[number] : self.first[number + 1]]
        else:
            at = np.searchsorted(self.terms, np.unique(document))
        starts, ends = self.starts[at], self.ends[at]
        sizes = ends - starts
        where = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.bincount(self.docs[where], self.weights[where], self.n)


class Packer:
    """Fills windows of one task; a remainder is (row, start, ids, document's number of ids)."""

    def __init__(self, window: int, shard: int, first_id: int):
        self.window, self.shard, self.next_id = window, shard, first_id
        self.left: list[tuple] = []
        self.out: list[tuple] = []

    def sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for row, start, ids, total in pieces:
            self.out.append((row, start, ids, total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, row, ids: np.ndarray) -> None:
        full = len(ids) // self.window * self.window
        for start in range(0, full, self.window):
            self.sequence([(row, start, ids[start : start + self.window], len(ids))])
        if full < len(ids):
            self.left.append((row, full, ids[full:], len(ids)))
            if len(self.left) >= self.shard:
                self.fill()

    def fill(self) -> None:
        """Pack the shard; at most one window's pieces are left."""
        items = self.left
        index = Index([x[2] for x in items])
        unused, whole = np.ones(len(items), bool), np.ones(len(items), bool)
        indexed = len(items)
        for seed in range(len(items)):
            if not unused[seed]:
                continue
            unused[seed] = False
            pieces, space = [items[seed]], self.window - len(items[seed][2])
            if space:
                if (still := int(unused.sum())) < 0.8 * indexed:
                    index.keep(unused)
                    indexed = still
                scores = np.where(unused, index.scores(items[seed][2], seed if whole[seed] else None), -1.0)
                open_slots = int(unused.sum())
                while space and open_slots:
                    k = min(NEIGHBOURS, open_slots)
                    best = np.argpartition(-scores, k - 1)[:k]
                    best = best[np.lexsort((best, -scores[best]))]
                    cut = None
                    for j in best:
                        size = len(items[j][2])
                        if size <= space:
                            pieces.append(items[j])
                            unused[j], scores[j], space, open_slots = False, -1.0, space - size, open_slots - 1
                        elif cut is None:
                            cut = j
                        if not space:
                            break
                    if space and cut is not None:
                        row, start, ids, total = items[cut]
                        pieces.append((row, start, ids[:space], total))
                        items[cut] = (row, start + space, ids[space:], total)
                        whole[cut] = False
                        space = 0
            if space:
                self.left = pieces
                return
            self.sequence(pieces)
        self.left = []

    def finish(self) -> None:
        """Fill what is left and cut the last window at powers of two."""
        if self.left:
            self.fill()
        room, pieces = 0, []
        rest = sum(len(x[2]) for x in self.left)
        for row, start, ids, total in self.left:
            while len(ids):
                if not room:
                    room = 1 << (rest.bit_length() - 1)
                taken = ids[:room]
                pieces.append((row, start, taken, total))
                ids, start, room, rest = ids[room:], start + len(taken), room - len(taken), rest - len(taken)
                if not room:
                    self.sequence(pieces)
                    pieces = []
        self.left = []


class Encoder:
    """Ids of whole texts by the tiktoken library, whose merges by rank give what the file's merges by pair give. Special
    strings are cut out first. Texts of more than ``LONG`` characters, on which its pattern matching could run out of
    stack, take the codec of operator 1, with the same ids."""

    def __init__(self, path: str):
        self.codec = codec(path)
        bytes_of = self.codec.bytes
        order = [*self.codec.byte_ids.tolist(), *self.codec.merged.tolist()]
        self.ids = np.array(order, np.uint32)
        ranks = {bytes_of[i]: rank for rank, i in enumerate(order)}
        self.library = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> np.ndarray:
        return self.ids[np.array(self.library.encode_ordinary(text), np.int64)]

    def encode(self, text: str) -> np.ndarray:
        if len(text) > LONG:
            return self.codec.encode_all([text])[0].astype(np.uint32)
        special, mark = self.codec.special, self.codec.mark
        if mark is None or not any(s in text for s in special):
            return self.plain(text)
        parts = mark.split(text)
        return np.concatenate([np.array([special[p]], np.uint32) if i % 2 else self.plain(p) for i, p in enumerate(parts)])


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)


def pack(docs: DataFrame, path: str, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """doc_id, start, ``ids`` (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset of every piece."""

    def run(batches):
        encode = encoder(path).encode
        packer = Packer(window, shard, TaskContext.get().partitionId() << 40)

        def out():
            found, packer.out = packer.out, []
            for i in range(0, len(found), 2000):
                rows, starts, ids, totals, sequences, offsets = zip(*found[i : i + 2000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, kind), pa.array(starts, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(totals, pa.int64()), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                    names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"],
                )

        kind = None
        for part in slices(batches):
            kind = part.column(0).type
            for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                packer.add(row, np.append(encode(text), np.uint32(END_ID)).astype("<u4"))
            yield from out()
        packer.finish()
        yield from out()

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(run, f"doc_id {id_kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long")
