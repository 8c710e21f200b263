"""Exact top-k search by BM25, shard by shard (operator 5).

Documents are indexed in shards of at most ``SHARD`` within their task: postings sorted by term.
Document frequencies, the number of documents and their mean length are summed over all shards before any query runs,
so scores do not depend on shards. A query is the set of a text's distinct lower-cased words.

In a shard every document gets a score of known precision: the few terms that many documents have by a product of
matrices in single precision, for many queries at once, and all others by their postings. Only documents that may reach
the k-th best score found so far are then scored in full, term by term in one order. That score comes from the task's
earlier shards; in its first shard, the k-th largest of the blocks' best scores stands for it. Tasks hand on the k best
of all their shards, which are merged exactly. The work grows with queries times documents, but what a pair costs is
little more than a multiplication for each frequent term and one addition for each rare word that both have.

Queries go to the shards in blocks of about ``QUERY_TERMS`` terms, which bounds what is broadcast. Terms are known by
64-bit hashes.

Edge cases: a text without words is never found and finds nothing; equal scores are put in order of doc_id; repeated
rows are found once each; rows without doc_id are neither queries nor found; other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import slices, staged, texts

#: A shard ends with so many documents or words, whichever come first.
SHARD, WORDS = 16384, 8 << 20
BLOCK = 16
#: Terms that this part of a shard's documents have are scored by matrix product, for so many queries at once.
FREQUENT, TOGETHER = 1 / 16, 256
QUERY_TERMS = 4_000_000
#: A block has no fewer terms than this for the sake of more tasks.
LEAST_TERMS = 250_000
#: Shards of a task, as long as that leaves so many tasks to a core; rows of its result in a batch.
SHARDS_PER_TASK, TASKS_PER_CORE, ROWS = 4, 3, 5_000
#: Postings whose impacts are computed at once.
PIECE = 1 << 18
K1, B = 1.2, 0.75


def terms(text: str) -> np.ndarray:
    """Hashes of a text's words, repeats included."""
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in text.lower().encode().split()]), np.int64)


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard: ids and lengths of its documents, its terms, where their postings end, and the postings;
    ``over`` has the places and values of term frequencies beyond 16 bits."""

    def pack(ids: list, found: list[np.ndarray], kind):
        sizes = np.array([*map(len, found)], np.int64)
        names, place = np.unique(np.concatenate(found), return_inverse=True)
        key, tf = np.unique(place * SHARD + np.repeat(np.arange(len(found)), sizes), return_counts=True)
        ends = np.cumsum(np.bincount(key // SHARD, minlength=len(names)))
        over = np.flatnonzero(tf > 65535)
        high = np.stack([over, tf[over]]).astype(np.int64)
        values = [ids, sizes.astype(np.int32), names, ends.astype(np.int32), (key % SHARD).astype(np.uint16), np.minimum(tf, 65535).astype(np.uint16), high]
        blobs = [pa.array([v.tobytes()], pa.binary()) for v in values[1:]]
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(kind)), *blobs], names=["ids", "lengths", "terms", "ends", "docs", "tf", "over"])

    def run(batches):
        ids, found, words, kind = [], [], 0, None
        for part in slices(batches):
            kind = part.column(0).type
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids.append(i)
                found.append(terms(t))
                words += len(found[-1])
                if len(ids) == SHARD or words >= WORDS:
                    yield pack(ids, found, kind)
                    ids, found, words = [], [], 0
        if ids:
            yield pack(ids, found, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = texts(docs).filter(F.col("doc_id").isNotNull())
    return known.mapInArrow(run, f"ids array<{kind}>, lengths binary, terms binary, ends binary, docs binary, tf binary, over binary")


def frequencies(index: DataFrame) -> DataFrame:
    """term and df over all shards."""

    def run(batches):
        for batch in batches:
            for t, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                df = np.diff(np.frombuffer(e, np.int32), prepend=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(t, np.int64)), pa.array(df, pa.int64())], names=["term", "df"])

    return index.select("terms", "ends").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id and term, one row for each distinct word."""

    def run(batches):
        for part in slices(batches):
            found = [np.unique(terms(t)) for t in part.column(1).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(found)), [*map(len, found)]))
            yield pa.RecordBatch.from_arrays([part.column(0).take(row), pa.array(np.concatenate(found))], names=["query_id", "term"])

    kind = queries.schema["doc_id"].dataType.simpleString()
    return texts(queries).mapInArrow(run, f"query_id {kind}, term long")


def saturated(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Impacts of term frequencies in documents of such norms."""
    tf = tf.astype(float)
    return tf * (K1 + 1) / (tf + norm)


class Shard:
    """Postings of one shard, by term and by document. In a search, the terms that a good part of the documents
    have become a matrix."""

    def __init__(self, row: dict, mean: float):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, lengths = np.array(row["ids"]), read("lengths", np.int32)
        self.terms, self.ends = read("terms", np.int64), read("ends", np.int32).astype(np.int64)
        self.sizes = np.diff(self.ends, prepend=0)
        self.docs, self.tf = read("docs", np.uint16), read("tf", np.uint16)
        if row.get("over"):
            place, count = read("over", np.int64).reshape(2, -1)
            self.tf = self.tf.astype(np.int32)
            self.tf[place] = count
        self.n, self.norm = len(lengths), K1 * (1 - B + B * lengths / mean)
        frequent = self.sizes >= max(1, self.n * FREQUENT)
        self.column, self.frequent = np.where(frequent, np.cumsum(frequent) - 1, -1), np.flatnonzero(frequent)
        # By document, the terms of each in order.
        order = np.argsort(self.docs, kind="stable")
        self.doc_terms, self.doc_tf = np.repeat(np.arange(len(self.ends), dtype=np.int32), self.sizes)[order], self.tf[order]
        self.doc_starts = np.r_[0, np.cumsum(np.bincount(self.docs, minlength=self.n))]

    @property
    def impact(self) -> np.ndarray:
        """What each posting adds to a score, before its term's weight."""
        return saturated(self.tf, self.norm[self.docs])

    def search(self, cuts: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray | None = None):
        """Yield, for each query, places and scores of the k best documents, all ties of the last one included.

        ``at``: places of the queries' terms in the shard, -1 for those it lacks; ``cuts``: where queries start and end;
        ``weights``: of the queries' terms, the same for a term in all queries."""
        weight_of = np.zeros(len(self.terms))
        weight_of[at[at >= 0]] = weights[at >= 0]
        yield from self.scan(cuts, at, weight_of, k, np.zeros(len(cuts) - 1) if least is None else least)

    def scan(self, cuts: np.ndarray, at: np.ndarray, weight_of: np.ndarray, k: int, least: np.ndarray):
        """``search`` with a weight for each term of the shard. Documents that score less than ``least`` of the query are
        left out; it is read query by query, so the caller may raise it meanwhile."""
        # A posting is one number: its document below, its weighted impact in single precision above.
        postings = np.empty((len(self.docs), 2), np.int32)
        postings[:, 0] = self.docs
        values, weight = postings.view(np.float32)[:, 1], np.repeat(weight_of.astype(np.float32), self.sizes)
        for a in range(0, len(values), PIECE):
            values[a : a + PIECE] = saturated(self.tf[a : a + PIECE], self.norm[self.docs[a : a + PIECE]])
        values *= weight
        del weight
        matrix = np.zeros((len(self.frequent), self.n), np.float32)
        for row, a, b in zip(matrix, (self.ends - self.sizes)[self.frequent].tolist(), self.ends[self.frequent].tolist()):
            row[self.docs[a:b]] = values[a:b]
        postings = postings.reshape(-1).view(np.int64)
        starts, asked = self.ends - self.sizes, np.zeros(len(self.terms), bool)
        places = taken = np.empty(0, np.int64)
        for first in range(0, len(cuts) - 1, TOGETHER):
            own = cuts[first : first + TOGETHER + 1]
            here = at[own[0] : own[-1]]
            row, here = np.repeat(np.arange(len(own) - 1), np.diff(own))[here >= 0], here[here >= 0]
            column = self.column[here]
            table = np.zeros((len(own) - 1, len(matrix)), np.float32)
            table[row[column >= 0], column[column >= 0]] = 1
            about = table @ matrix
            rows, rare = np.arange(len(own)), here[column < 0]
            ends, rare_ends = np.searchsorted(row, rows), np.searchsorted(row[column < 0], rows)
            sizes, begin = self.sizes[rare], starts[rare]
            found = np.add.reduceat(np.append(sizes, 0), rare_ends[:-1]) * (np.diff(rare_ends) > 0)
            at_most = int(found.max(initial=0))
            if at_most > len(places):
                places, taken = np.empty(at_most, np.int64), np.empty(at_most, np.int64)
            for q in range(len(own) - 1):
                a, b, m = rare_ends[q], rare_ends[q + 1], found[q]
                if m:
                    _ranges(begin[a:b], sizes[a:b], places[:m])
                    postings.take(places[:m], out=taken[:m], mode="clip")
                    np.bitwise_and(taken[:m], 0xFFFF, out=places[:m])
                    np.add.at(about[q], places[:m], taken[:m].view(np.float32)[1::2])
                terms = here[ends[q] : ends[q + 1]]
                yield self.exact(asked, terms, weight_of, self.promising(about[q], k, float(least[first + q]), len(terms)), k)

    def places(self, names: np.ndarray) -> np.ndarray:
        """Places of terms in the shard, -1 for those it lacks."""
        at = np.searchsorted(self.terms, names)
        at[(at == len(self.terms)) | (np.append(self.terms, 0)[at] != names)] = -1
        return at

    def best(self, query: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``search`` for one query."""
        return next(self.search(np.array([0, len(query)]), self.places(query), weight, k))

    def promising(self, scores: np.ndarray, k: int, least: float = 0.0, terms: int = 0) -> np.ndarray:
        """Documents that may be among the k best and have ``least``, by sums in single precision over so many terms."""
        # Sums of numbers that are not negative: no score is further off than this share of it.
        slack = 1 - 4 * (terms + 8) * 2.0**-24
        if least <= 0 and len(scores) > k * BLOCK:
            whole = self.n - self.n % BLOCK
            best = np.r_[scores[:whole].reshape(BLOCK, -1).max(axis=0), scores[whole:]]
            # So many blocks have a document as good as that.
            least = float(np.partition(best, len(best) - k)[len(best) - k])
        found = np.flatnonzero(scores >= least * slack) if least > 0 else np.flatnonzero(scores > 0)
        if len(found) > k:
            least = float(np.partition(scores[found], len(found) - k)[len(found) - k])
            found = found[scores[found] >= least * slack]
        return found

    def exact(self, asked: np.ndarray, terms: np.ndarray, weight_of: np.ndarray, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of some documents with their scores, added up term by term in one order, so that equal texts tie.
        ``asked``: a flag for each term, none of them set."""
        if not len(found):
            return found, np.zeros(0)
        starts, ends = self.doc_starts[found], self.doc_starts[found + 1]
        names = np.concatenate([self.doc_terms[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
        asked[terms] = True
        hit = np.flatnonzero(asked[names])
        asked[terms] = False
        here = np.cumsum(ends - starts)
        doc = np.searchsorted(here, hit, side="right")
        values = weight_of[names[hit]] * saturated(self.doc_tf[hit + (ends - here)[doc]], self.norm[found[doc]])
        scores = np.bincount(doc, values, len(found))
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else 0.0
        good = (scores >= least) & (scores > 0)
        return found[good], scores[good]


def _ranges(starts: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
    """All places of several ranges, none of them empty, one range after the other."""
    out.fill(1)
    out[0] = starts[0]
    out[np.cumsum(sizes[:-1])] = np.diff(starts) - sizes[:-1] + 1
    np.cumsum(out, out=out)


def query_block(weighted: DataFrame) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some queries: ids, where their words start and end, the words' places in a sorted list, that list, and the
    weights of its words."""
    table = weighted.toArrow().combine_chunks()
    ids = table.column("query_id").combine_chunks()
    ids = (ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids).dictionary_encode() if len(ids) else pa.array([], ids.type).dictionary_encode()
    query = ids.indices.to_numpy()
    names, first, place = np.unique(table.column("term").to_numpy(), return_index=True, return_inverse=True)
    place = place.astype(np.int32)[np.lexsort((place, query))]
    cuts = np.r_[0, np.cumsum(np.bincount(query, minlength=len(ids.dictionary)))]
    return ids.dictionary.to_pylist(), cuts, place, names, table.column("weight").to_numpy()[first]


def search(docs: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, doc_id, score and rank of the k best documents for each row that ``is_query`` chooses."""
    spark = docs.sparkSession
    index = staged(build_index(docs), "bm25-index", rows_per_file=1)

    def sizes(batches):
        for batch in batches:
            lengths = [np.frombuffer(x, np.int32) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in lengths], pa.int64()), pa.array([int(x.sum()) for x in lengths], pa.int64())], names=["n", "words"])

    total = index.select("lengths").mapInArrow(sizes, "n long, words long").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    n, mean = total["n"] or 0, max(1.0, (total["words"] or 0) / max(1, total["n"] or 0))
    asked = query_terms(docs.filter(is_query & F.col("doc_id").isNotNull())).distinct()
    known = frequencies(index).join(asked.select("term").distinct(), "term", "left_semi")
    weight = F.log1p((F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = staged(asked.join(known, "term").select("query_id", "term", weight.alias("weight")), "query-terms")
    kind = docs.schema["doc_id"].dataType.simpleString()
    # A task goes through several shards, the later ones with what the earlier ones have found. Where files of the index
    # come in few partitions, more blocks of queries make the tasks.
    tasks, pieces, words = TASKS_PER_CORE * spark.sparkContext.defaultParallelism, index.rdd.getNumPartitions(), weighted.count()
    spread = index.coalesce(max(tasks, n // (SHARDS_PER_TASK * SHARD)))
    blocks = max(words // QUERY_TERMS, min(tasks // max(1, pieces), words // LEAST_TERMS)) + 1
    parts = []
    for block in range(blocks):
        own = weighted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block) if blocks > 1 else weighted
        sent = spark.sparkContext.broadcast(query_block(own))

        def run(batches, sent=sent):
            asked_ids, cuts, place, names, weights = sent.value
            best, least = [[] for _ in asked_ids], np.zeros(len(asked_ids))
            for batch in batches:
                kind = batch.schema.field("ids").type.value_type
                for row in range(batch.num_rows):
                    shard = Shard({name: x[row].as_py() if name == "ids" else x[row].as_buffer() for name, x in zip(batch.schema.names, batch.columns)}, mean)
                    # Of the block's words, those that the shard has.
                    at = np.searchsorted(names, shard.terms)
                    own = np.flatnonzero(np.append(names, 0)[at] == shard.terms) if len(names) else at[:0]
                    weight_of, there = np.zeros(len(shard.terms)), np.full(len(names), -1, np.int32)
                    weight_of[own], there[at[own]] = weights[at[own]], own
                    for q, (found, scores) in enumerate(shard.scan(cuts, there[place], weight_of, k, least)):
                        if len(found):
                            # Of ties no more than k can be among the k best of all.
                            best[q] = sorted(best[q] + list(zip((-scores).tolist(), shard.ids[found].tolist())))[:k]
                            if len(best[q]) == k:
                                least[q] = -best[q][-1][0]
                    del shard
            had = [q for q, x in enumerate(best) if x]
            if had:
                entry = pa.struct([("minus", pa.float64()), ("doc_id", kind)])
                for first in range(0, len(had), ROWS):
                    rows = had[first : first + ROWS]
                    lists = [[{"minus": m, "doc_id": d} for m, d in best[q]] for q in rows]
                    yield pa.RecordBatch.from_arrays([pa.array([asked_ids[q] for q in rows], kind), pa.array(lists, pa.list_(entry))], names=["query_id", "best"])

        parts.append(spread.mapInArrow(run, f"query_id {kind}, best array<struct<minus: double, doc_id: {kind}>>"))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    # A query has a row of at most k entries from each task.
    merged = found.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    ranked = merged.select("query_id", F.posexplode("best").alias("place", "entry"))
    return ranked.select("query_id", "entry.doc_id", (-F.col("entry.minus")).alias("score"), (F.col("place") + 1).alias("rank"))
