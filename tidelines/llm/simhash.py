"""SimHash near-duplicates by a binary-trie self-join (operator 6).

A fingerprint has a bit set if more than half of a text's shingle hashes have it. Fingerprints within ``budget``
differing bits link texts, and links form components.

Join. Two fingerprints that differ in at most ``budget`` bits agree on one of ``budget + 1`` blocks of bits, so each
distinct fingerprint goes to one group per block, keyed by the block's value. Inside a group the sorted fingerprints
are a binary trie, a node being a range of them. Pairs of nodes are followed down together, adding up the bits in
which they differ; a pair above the budget is dropped with all below it. Many groups go down level by level at once.

Copies. Only distinct fingerprints are joined, and a task hands on a spanning forest of the links it found, never all
pairs of a group. Components of those forests are found by Spark joins with checkpoints in the shared folder.

Edge cases: a text without words has fingerprint zero, linked like any other; a text shorter than a shingle is one
shingle; repeated rows and equal texts share fingerprint and component; a null doc_id never names a component but is
given one if the fingerprint has another; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import map_slices, staged, whole_rows
from tidelines.llm.components import components

SEED = 42
BUDGET = 3
#: For near-duplicates of whole texts: their least Jaccard similarity, fingerprints of a text, shingles in each, words of
#: the long fingerprint, bits in which a pair worth an exact look may differ there, and bits of pairs tied at sight.
SIMILAR, SERIES, LEAST, PROOF, AGREE, CLOSE = 0.8, 8, 3, 8, 104, 60
#: Words of the longer fingerprint of texts whose groups are searched again, and standard deviations beyond the mean of a
#: pair of least similarity up to which a pair is worth an exact look there.
LONG_PROOF, SPARE = 40, 3.5
#: Odd factors that make several hashes of one (arbitrary fixed values).
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], np.uint64)
#: Node pairs of the trie that are followed at once, and products of their sizes that are compared directly.
FRONTIER = 1 << 20
DIRECT = 16


def words(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs of non-blanks, as UTF-8; blanks are space and U+0009 to U+000D."""
    return text.encode().lower().split()


def shingle_hashes(parts: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle, as rows of 8 bytes, most significant first."""
    if not parts:
        return np.empty((0, 8), np.uint8)
    digest = xxhash.xxh64_digest
    if len(parts) <= size:
        found = [digest(b" ".join(parts), seed)]
    else:
        joined = b" ".join(parts)
        ends = (np.cumsum([*map(len, parts)]) + np.arange(len(parts))).tolist()
        starts = [0, *[e + 1 for e in ends]]
        found = [digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :])]
    return np.frombuffer(b"".join(found), np.uint8).reshape(-1, 8)


def majority(hashes: np.ndarray) -> bytes:
    """The bits that more than half of the rows have."""
    counts = np.zeros(8 * hashes.shape[1], np.int64)
    for start in range(0, len(hashes), 1 << 15):
        counts += np.unpackbits(hashes[start : start + (1 << 15)], axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and ``fingerprint`` (long, the 64 bits in two's complement) of every text."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            bits = b"".join([majority(shingle_hashes(words(t), size)) for t in part.column(1).to_pylist()])
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(np.frombuffer(bits, ">i8").astype(np.int64))], names=["doc_id", "fingerprint"])

        return step

    source = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return map_slices(source, make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint long")


def trie_pairs(prints: np.ndarray, starts: np.ndarray, ends: np.ndarray, first_bit: int, budget: int):
    """Yield index arrays (i, j) of all pairs within one of the ranges that differ in at most ``budget`` bits.
    ``prints`` are unsigned and sorted within each range; bits before ``first_bit`` are equal there."""
    ones = {}

    def counted(depth: int) -> np.ndarray:
        if depth not in ones:
            bit = (prints >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        return ones[depth]

    def direct(a, a_end, b, b_end):
        """Compare all members of small pairs of nodes."""
        many = (a_end - a) * (b_end - b)
        at = np.repeat(np.arange(len(a)), many)
        k = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        width = (b_end - b)[at]
        i, j = a[at] + k // width, b[at] + k % width
        near = (np.bitwise_count(prints[i] ^ prints[j]) <= budget) & (i < j)
        return i[near], j[near]

    todo = [(first_bit, np.stack([starts, ends, starts, ends, np.zeros_like(starts)]))]
    while todo:
        depth, pairs = todo.pop()
        a, a_end, b, b_end, _ = pairs
        small = (a_end - a) * (b_end - b) <= DIRECT if depth < 64 else np.ones(len(a), bool)
        if small.any():
            for cut in np.array_split(np.flatnonzero(small), small.sum() // FRONTIER + 1):
                yield direct(a[cut], a_end[cut], b[cut], b_end[cut])
            pairs = pairs[:, ~small]
        if not pairs.shape[1]:
            continue
        if pairs.shape[1] > FRONTIER:
            todo += [(depth, half) for half in np.array_split(pairs, 2, axis=1)]
            continue
        a, a_end, b, b_end, bits = pairs
        c = counted(depth)
        a_mid, b_mid = a_end - (c[a_end] - c[a]), b_end - (c[b_end] - c[b])
        below = [
            np.stack([a, a_mid, b, b_mid, bits]),
            np.stack([a_mid, a_end, b_mid, b_end, bits]),
            np.stack([a, a_mid, b_mid, b_end, bits + 1]),
            np.stack([a_mid, a_end, b, b_mid, bits + 1])[:, a != b],
        ]
        below = np.concatenate(below, axis=1)
        x, x_end, y, y_end, n = below
        todo.append((depth + 1, below[:, (x < x_end) & (y < y_end) & (n <= budget) & ~((x == y) & (x_end - x == 1))]))


def forest(n: int, i: np.ndarray, j: np.ndarray, root: np.ndarray) -> None:
    """Join the trees of ``root`` (an array of n parents, all stars) along the links (i, j)."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j = i[apart], j[apart]
        low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root[:] = root[root]


def groups(batches, keys: int):
    """Cut sorted Arrow batches at changes of the first ``keys`` columns into tables of whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for c in range(keys):
            v = batch.column(c).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change) + 1
        if held and any(batch.column(c)[0] != held[-1].column(c)[-1] for c in range(keys)):
            if sum(b.num_rows for b in held) >= 20_000:
                yield pa.Table.from_batches(held)
                held = []
        if len(cuts) and sum(b.num_rows for b in held) + cuts[-1] >= 20_000:
            yield pa.Table.from_batches([*held, batch.slice(0, int(cuts[-1]))])
            held = [batch.slice(int(cuts[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(nodes: DataFrame, budget: int, *more: str) -> DataFrame:
    """A row of ``nodes`` for each block of bits: part, value, turned, node and the columns ``more``, whole groups (of
    part and value) side by side."""
    blocks = budget + 1
    edges = block_edges(budget)
    turned = F.array(
        *[
            F.struct(
                F.lit(k).alias("block"),
                (F.shiftleft("print", edges[k]).bitwiseOR(F.shiftrightunsigned("print", 64 - edges[k])) if k else F.col("print")).alias("turned"),
                F.lit(edges[k + 1] - edges[k]).alias("width"),
            )
            for k in range(blocks)
        ]
    )
    spread = nodes.select("node", "series", F.explode(turned).alias("t"), *more)
    spread = spread.select(
        (F.col("series") * blocks + F.col("t.block")).alias("part"),
        F.expr("shiftrightunsigned(t.turned, 64 - t.width)").alias("value"),
        F.col("t.turned").alias("turned"),
        "node",
        *more,
    )
    return spread.repartition("part", "value").sortWithinPartitions("part", "value")


def block_edges(budget: int) -> list[int]:
    return [64 * k // (budget + 1) for k in range(budget + 2)]


def open_bit(budget: int) -> int:
    """Only the bits that all blocks leave open are walked; the walk starts after the narrowest block."""
    edges = block_edges(budget)
    return max(b - a for a, b in zip(edges, edges[1:])) - (64 % (budget + 1) > 0)


def sorted_group(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order of a table by group and print, the prints in it, and where its groups start and end."""
    part, value = table.column(0).to_numpy(), table.column(1).to_numpy()
    prints = table.column(2).to_numpy().view(np.uint64)
    change = np.r_[True, (part[1:] != part[:-1]) | (value[1:] != value[:-1])]
    order = np.lexsort((prints, np.cumsum(change)))
    starts = np.flatnonzero(change)
    return order, np.ascontiguousarray(prints[order]), starts, np.r_[starts[1:], len(prints)]


def links(nodes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """A spanning forest (``src``, ``dst``) of the links between ``nodes`` (node long, print long, series int).

    Rows are compared within a series."""
    kind = nodes.schema["node"].dataType.simpleString()

    def run(batches):
        for table in groups(batches, 2):
            order, prints, starts, ends = sorted_group(table)
            large = ends - starts > 1
            root = np.arange(len(prints))
            for i, j in trie_pairs(prints, starts[large], ends[large], open_bit(budget), budget):
                forest(len(prints), i, j, root)
            # A tree hangs on its smallest node: trees of one group found in many blocks then share their links.
            ids = table.column(3).to_numpy()[order]
            least = ids.copy()
            np.minimum.at(least, root, ids)
            least = least[root]
            linked = np.flatnonzero(ids != least)
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(least[linked])], names=["src", "dst"])

    return in_blocks(nodes, budget).mapInArrow(run, f"src {kind}, dst {kind}").distinct()


def lightest_forest(root: np.ndarray, i: np.ndarray, j: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of the links (i, j) of a lightest spanning forest over the trees of ``root`` (stars), by Boruvka's rounds."""
    order = np.lexsort((j, i, weight))
    i, j, root, n = i[order], j[order], root.copy(), len(root)
    alive, chosen = np.arange(len(i)), [np.empty(0, np.int64)]
    while True:
        a, b = root[i[alive]], root[j[alive]]
        apart = a != b
        alive, a, b = alive[apart], a[apart], b[apart]
        if not len(alive):
            return order[np.concatenate(chosen)]
        best = np.full(n, -1)
        ranked = np.argsort(np.r_[alive, alive], kind="stable")[::-1]  # the lightest link is written last
        best[np.r_[a, b][ranked]] = np.r_[alive, alive][ranked]
        tips = np.flatnonzero(best >= 0)
        pick = best[tips]
        chosen.append(np.unique(pick))
        parent = np.arange(n)
        u, v = root[i[pick]], root[j[pick]]
        parent[tips] = np.where(u == tips, v, u)
        both = (parent[parent[tips]] == tips) & (tips < parent[tips])
        parent[tips[both]] = tips[both]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        root = parent[root]


def products(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray):
    """Yield index arrays (i, j) of all members of pairs of ranges, i < j, about FRONTIER or one row at a time."""
    many = a_end - a
    at = np.repeat(np.arange(len(a)), many)
    i = a[at] + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    start = np.where((a == b)[at], i + 1, b[at])
    width = b_end[at] - start
    total = np.cumsum(width)
    cuts = np.unique(np.r_[0, np.searchsorted(total, np.arange(FRONTIER, total[-1] if len(total) else 0, FRONTIER)) + 1, len(i)])
    for x, y in zip(cuts, cuts[1:]):
        w = width[x:y]
        k = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        yield np.repeat(i[x:y], w), np.repeat(start[x:y], w) + k


def lightest_each(i: np.ndarray, j: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    """Places of the links (i, j) that are among the ``most`` lightest of one of their ends."""
    ends, place = np.r_[i, j], np.r_[np.arange(len(i)), np.arange(len(j))]
    order = np.lexsort((place, np.r_[weight, weight], ends))
    first = np.r_[True, ends[order][1:] != ends[order][:-1]]
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return np.unique(place[order[rank < most]])


class Search:
    """The closest links of a table of groups: a spanning forest of them and the ``extra`` closest of each row."""

    def __init__(self, table: pa.Table, agree: int, extra: int):
        self.order, self.prints, self.starts, self.ends = sorted_group(table)
        self.n, self.agree = len(self.order), agree
        self.first_block = (table.column(0).to_numpy() % (BUDGET + 1) == 0)[self.order]
        self.ids = table.column(3).to_numpy()[self.order]
        proof = table.column(4).combine_chunks()
        self.proofs = np.frombuffer(b"".join(proof.to_pylist()), np.uint8).reshape(self.n, -1)[self.order].view(np.uint64)
        # Rows of one component found before (in one group) are one tree from the start.
        group = np.repeat(np.arange(len(self.starts)), self.ends - self.starts)
        label = np.unique(table.column(5).to_numpy()[self.order], return_inverse=True)[1]
        _, first, tree = np.unique(group * self.n + label, return_index=True, return_inverse=True)
        self.root = first[tree]
        self.names, self.place = np.unique(self.ids, return_inverse=True)
        failed = [(self.place[r], x) for r, o in enumerate(self.order.tolist()) for x in table.column(6)[o].as_py() or ()] if table.column(6).null_count < self.n else []
        known = np.array(failed, np.int64).reshape(-1, 2)
        other = np.minimum(np.searchsorted(self.names, known[:, 1]), len(self.names) - 1)
        here = self.names[other] == known[:, 1]
        self.failed = np.unique(known[here, 0] * len(self.names) + other[here])
        self.held, self.extra, self.waiting = [], extra, 0

    def look(self, i: np.ndarray, j: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the pairs that are of two trees, not known to fail and within ``most`` bits, and their distance."""
        apart = self.root[i] != self.root[j]
        i, j = i[apart], j[apart]
        bits = np.zeros(len(i), np.int64)
        for at in range(0, len(i), 1 << 18):
            bits[at : at + (1 << 18)] = np.bitwise_count(self.proofs[i[at : at + (1 << 18)]] ^ self.proofs[j[at : at + (1 << 18)]]).sum(axis=1)
        near = bits <= most
        if len(self.failed):
            near &= ~np.isin(self.place[i] * len(self.names) + self.place[j], self.failed)
        return i[near], j[near], bits[near]

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        found = self.look(i, j, self.agree)
        self.held.append(found)
        self.waiting += len(found[0])
        if self.waiting > FRONTIER + (self.extra + 1) * self.n:
            self.shrink()

    def shrink(self) -> None:
        i, j, bits = (np.concatenate(x) for x in zip(*self.held))
        chosen = lightest_forest(self.root, i, j, bits)
        if self.extra:
            chosen = np.union1d(chosen, lightest_each(i, j, bits, self.extra))
        self.held, self.waiting = [(i[chosen], j[chosen], bits[chosen])], len(chosen)

    def leaf(self, start: int, end: int) -> list[np.ndarray]:
        """Large sets of equal prints: rows close to a leader are tied to it, so that only the others meet all."""
        tied, rows = [], np.arange(start, end)
        rest = rows
        while len(rest) > 1:
            i, j, _ = self.look(np.full(len(rest) - 1, rest[0]), rest[1:], CLOSE * self.proofs.shape[1] // PROOF)
            forest(self.n, i, j, self.root)
            tied.append(np.stack([i, j]))
            few = 16 * len(i) < len(rest)
            rest = rest[1:][self.root[rest[1:]] != self.root[rest[0]]]
            if few:  # leaders only save work: all that they do not tie is compared below
                break
        names, counts = np.unique(self.root[rows], return_counts=True)
        few = self.root[rows] != names[counts.argmax()]
        few, lot = rows[few], rows[~few]
        both = np.r_[few, lot]
        for x, y in products(np.array([0]), np.array([len(few)]), np.array([0]), np.array([len(both)])):
            self.add(both[x], both[y])
        return tied

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        change = np.r_[True, self.prints[1:] != self.prints[:-1]]
        change[self.starts] = True
        run_start = np.flatnonzero(change)
        run_end = np.r_[run_start[1:], self.n]
        # Equal prints are in the same group in every block, so they are paired in the first alone.
        several = (run_end - run_start > 1) & self.first_block[run_start]
        large = several & (run_end - run_start > 64)
        tied = [x for a, b in zip(run_start[large], run_end[large]) for x in self.leaf(int(a), int(b))]
        small = several & ~large
        for i, j in products(run_start[small], run_end[small], run_start[small], run_end[small]):
            self.add(i, j)
        first, last = np.searchsorted(run_start, self.starts), np.searchsorted(run_start, self.ends)
        wide = last - first > 1
        for u, v in trie_pairs(self.prints[run_start], first[wide], last[wide], open_bit(BUDGET), BUDGET):
            for i, j in products(run_start[u], run_end[u], run_start[v], run_end[v]):
                self.add(i, j)
        if self.held:
            self.shrink()
        every = [*tied, *[np.stack(x[:2]) for x in self.held]]
        both = self.ids[np.concatenate([np.empty((2, 0), np.int64), *every], axis=1)]
        return both.min(axis=0), both.max(axis=0)


def candidates(nodes: DataFrame, agree: int, extra: int) -> DataFrame:
    """Links (``src`` < ``dst``) worth an exact look between ``nodes`` (node, print, series, proof, component, failed):
    each is a pair within the budget in one series and within ``agree`` bits of ``proof``, of two components, and not
    among the ``failed`` of its nodes. They span all such pairs, the closest first."""

    def run(batches):
        for table in groups(batches, 2):
            src, dst = Search(table, agree, extra).run()
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

    return in_blocks(nodes, BUDGET, "proof", "component", "failed").mapInArrow(run, "src long, dst long").distinct()


def components_of(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest doc_id reachable) of rows of doc_id and fingerprint."""
    distinct = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprints")
    found = links(distinct.select(F.col("fingerprint").alias("node"), F.col("fingerprint").alias("print"), F.lit(0).alias("series")), budget)
    classes = components(found)  # node, component: fingerprints, linked ones only
    member = distinct.join(classes, distinct["fingerprint"] == classes["node"], "left")
    member = member.select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    smallest = member.groupBy("component").agg(F.min("first").alias("component_id"))
    of_print = member.join(smallest, "component").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def shingle_set(text: str, size: int) -> np.ndarray:
    """The different shingle hashes of a text, in order."""
    return np.unique(shingle_hashes(words(text), size).view(">u8").astype(np.uint64))


def spread(x: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A hash for each factor from each 64-bit hash, by multiplication and folding."""
    x = x[:, None] * factors
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def odd_factors(n: int) -> np.ndarray:
    """n odd 64-bit numbers, from the digits of a counter mixed by a fixed hash."""
    return np.array([xxhash.xxh64_intdigest(k.to_bytes(4, "little"), SEED) | 1 for k in range(n)], np.uint64)


def agreement(words_: int, similar: float) -> int:
    """Bits in which fingerprints of ``words_`` words may differ for a pair worth an exact look: the mean for sets of
    that similarity, and SPARE standard deviations."""
    share = math.acos(2 * similar / (1 + similar)) / math.pi
    return int(64 * words_ * share + SPARE * math.sqrt(64 * words_ * share * (1 - share)))


def long_proofs(sets: DataFrame, words_: int = LONG_PROOF) -> DataFrame:
    """node and ``proof`` (fingerprints of ``words_`` words over the set) of (node, shingles)."""

    def run(batches):
        factors = odd_factors(words_)
        for batch in batches:
            out = []
            for row in batch.column(1):
                found = row.values.to_numpy().view(np.uint64)
                # Eight words at a time bound the memory that a very long text takes.
                parts = [majority(np.ascontiguousarray(spread(found, factors[k : k + 8])).astype(">u8").view(np.uint8)) for k in range(0, words_, 8)]
                out.append(b"".join(parts) if len(found) else bytes(8 * words_))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["node", "proof"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, proof binary")


def wide_prints(keyed: DataFrame, series: int, size: int) -> DataFrame:
    """doc_id, own, ``key`` (the digest of the set of shingles of ``size`` words), ``prints`` (array of ``series``
    fingerprints over the LEAST shingles that come first in an order of the series' own) and ``proof`` (``PROOF``
    fingerprints over all different shingles, in one value)."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            keys, short, long = [], [], []
            for t in part.column(2).to_pylist():
                found = shingle_set(t, size)
                keys.append(hashlib.sha256(found.tobytes()).digest())
                if not len(found):
                    short.append(bytes(8 * series))
                    long.append(bytes(8 * PROOF))
                    continue
                mixed = spread(found, FACTORS[: max(series, PROOF)])
                first = np.argpartition(mixed[:, :series], LEAST - 1, axis=0)[:LEAST] if len(found) > LEAST else np.repeat(np.arange(len(found))[:, None], series, axis=1)
                short.append(majority(found[first].astype(">u8").view(np.uint8).reshape(len(first), 8 * series)))
                long.append(majority(np.ascontiguousarray(mixed[:, :PROOF]).astype(">u8").view(np.uint8)))
            flat = np.frombuffer(b"".join(short), ">i8").astype(np.int64)
            prints = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, series), pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys, pa.binary()), prints, pa.array(long, pa.binary())], names=["doc_id", "own", "key", "prints", "proof"])

        return step

    return map_slices(keyed, make, f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, own binary, key binary, prints array<long>, proof binary")


def shingle_sets(keyed: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """node and ``shingles`` (array of long) of the texts named by ``reps`` (node, own, first)."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingle_set(t, size).view(np.int64) for t in part.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, found)])
            shingles = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
            return pa.RecordBatch.from_arrays([part.column(0), shingles], names=["node", "shingles"])

        return step

    texts = keyed.join(reps, (keyed["own"] == reps["_own"]) & keyed["doc_id"].eqNullSafe(reps["_first"])).select("node", "text")
    return map_slices(texts, make, "node long, shingles array<long>").dropDuplicates(["node"])


def judged(edges: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """src, dst and ``near``: whether the Jaccard similarity of the two sets of shingles is at least ``least``."""
    a, b = sets.select(F.col("node").alias("src"), F.col("shingles").alias("a")), sets.select(F.col("node").alias("dst"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    near = both >= F.lit(least) * (F.size("a") + F.size("b") - both)
    return edges.join(a, "src").join(b, "dst").select("src", "dst", near.alias("near"))


def near_components(nodes: DataFrame, sets_of, agree: int, least: float) -> DataFrame:
    """node and component of the nodes that have links. Candidates span all pairs worth a look; one that fails the
    exact test may have stood for others, so its group is searched again without the pairs already tested, for the
    closest pairs of each node, more of them each round, until no pair of two components is left. Those groups compare
    longer fingerprints, by which few pairs are close and yet fail, so the pairs tested follow the nodes."""
    active = nodes.withColumn("component", F.col("node")).withColumn("failed", F.lit(None).cast("array<long>"))
    seen, sets, extra = None, None, 0
    while True:
        edges = staged(candidates(active, agree if not extra else agreement(LONG_PROOF, least), extra), "candidates")
        if seen is not None and edges.isEmpty():
            break
        if sets is None:
            sets = staged(sets_of(edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()), "shingle-sets")
        tested = staged(judged(edges, sets, least), "judged")
        seen = tested if seen is None else seen.union(tested)
        bad = seen.filter("not near")
        if bad.isEmpty():
            break
        whole = components(seen.select("src", "dst")).select("node", F.col("component").alias("cluster"))
        own = components(seen.filter("near").select("src", "dst"))
        label = staged(whole.join(own, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("component")), "components")
        split = label.groupBy("cluster").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("cluster")
        lost = bad.select(F.col("src").alias("node"), F.col("dst").alias("o")).union(bad.select(F.col("dst"), F.col("src"))).groupBy("node").agg(F.collect_set("o").alias("failed"))
        again = staged(label.join(split, "cluster", "left_semi").select("node", "component"), "again")
        if again.isEmpty():
            break
        proofs = long_proofs(sets.join(again, "node", "left_semi"))
        active = nodes.drop("proof").join(again.join(proofs, "node"), "node").join(lost, "node", "left")
        active = staged(active.select(*nodes.columns, "component", "failed"), "active")
        extra = 8 * extra if extra else 4
    return components(seen.filter("near").select("src", "dst"))


def one_of_each(docs: DataFrame, series: int = SERIES, size: int = 5, agree: int = AGREE, least: float = SIMILAR) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates (the smallest doc_id; equal rows count once).

    Texts of one set of shingles of ``size`` words (they may differ in case, blanks and repeats) are one class. Two
    classes are linked if the Jaccard similarity of their sets is at least ``least``, by an exact test of the pairs that
    agree in one of the ``series`` fingerprints within the budget. A fingerprint is made of the three shingles that come
    first in one random order, so a pair of similarity 0.8 has the same one with chance 0.5, and none of 8 with 0.005.
    Long fingerprints of shingles must differ in at most ``agree`` of 512 bits; 77 are the mean of a pair at 0.8, and 8
    the standard deviation.

    A null or empty text, like all texts without a word, has the empty set: such texts are one class, linked to no other.
    Texts of fewer words than a shingle are their own single shingle. A null doc_id comes after all others, so it is kept
    only where its group has no other; rows equal in doc_id and text count once, rows of one doc_id and several texts are
    judged by text. An empty table stays empty."""
    keyed = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).select("doc_id", F.unhex(F.sha2("text", 256)).alias("own"), "text")
    prints = wide_prints(keyed, series, size)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "own")).alias("least")
    classes = prints.groupBy("key").agg(first, F.first("prints").alias("prints"), F.first("proof").alias("proof"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = classes.select("node", F.posexplode("prints").alias("series", "print"), "proof")
    rep = classes.select("node", F.col("least.own").alias("_own"), F.col("least.doc_id").alias("_first"))
    found = near_components(nodes, lambda wanted: shingle_sets(keyed, rep.join(wanted, "node", "left_semi"), size), agree, least)
    member = classes.select("node", "least").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = member.groupBy("component").agg(F.min("least").alias("least"))
    kept = kept.select(F.col("least.doc_id").alias("_first"), F.col("least.own").alias("_key"))
    joined = whole_rows(docs).join(kept, (F.col("own") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_first")))
    return joined.dropDuplicates(["own", "id"]).select("row.*")
