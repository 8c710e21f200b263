"""Removal of long repeated passages by suffix automata (operator 4).

A window is ``WINDOW`` consecutive words. A word goes if a window over it also starts in a document with a smaller id.

1. Equal texts fall together: of a class only the smallest id is searched; the others lose all words, if they have a
   window at all.
2. Candidates. Every window has one anchor, the smallest hash among its ``ANCHOR``-word runs, so equal windows have
   equal anchors and neighbouring windows mostly share theirs. Windows go on only if their anchor is in two documents.
3. Owners. Each candidate window's hash (128 bits) gets the smallest id that has it; sums are made in tasks first.
4. Decision. Each owner is a reference shard. Its suffix automaton is built once and the passages that name it are
   streamed through for matching statistics on the words themselves; spans matched over WINDOW words or more go.
   An owner named by very many passages is rebuilt in several tasks (``SHARE`` passages each), so no task holds more
   than one document's automaton and a stream.

Hashes only choose what is compared; words decide. Every step is a Spark join or aggregate on keys that spread, and
copies are summed up in tasks before each shuffle.

Edge cases: a null or empty text has no words; texts below WINDOW words keep all; rows with one doc_id are judged by
their own texts, and never against each other; rows without doc_id neither lose words nor count as earlier; equal
rows get equal results; other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelines.llm.automaton import SuffixAutomaton
from tidelines.llm.common import map_slices, slices, staged, texts, whole_rows

WINDOW = 50
ANCHOR = 25
SHARE = 2_000
#: An anchor of so many uses is hot, or of more if the table has more than MOST_HOT such anchors' worth of uses: what
#: is sent to all tasks is at most MOST_HOT numbers.
HOT_USES, MOST_HOT = 1_000, 10_000
#: Odd factors of the polynomial hashes (arbitrary fixed values).
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def text_key(text: str = "text") -> Column:
    """Names a text: its digest, in 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def words(text: str) -> list[bytes]:
    return text.encode().split()


def word_hashes(parts: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in parts]), np.uint64)


def rolled(hashes: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, f = np.zeros(n, np.uint64), np.uint64(factor)
    for k in range(size):
        out *= f
        out += hashes[k : n + k]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def anchors(hashes: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: the anchor's hash, the first window and their number."""
    if len(hashes) < window:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    grams = rolled(hashes, size, FACTORS[0])
    width = window - size + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(len(grams) - width + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return grams[at[first]].view(np.int64), first, np.diff(np.r_[first, len(at)])


def _anchor_frame(keyed: DataFrame, window: int, size: int) -> DataFrame:
    """doc_id, key, n_words and ``runs`` (anchor, start, n) of each text."""
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]))

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            found, counts, ends = [], [], [0]
            for t in part.column(2).to_pylist():
                parts = words(t)
                counts.append(len(parts))
                found.append(anchors(word_hashes(parts), window, size) if len(parts) >= window else anchors(np.empty(0), window, size))
                ends.append(ends[-1] + len(found[-1][0]))
            columns = [np.concatenate([f[k] for f in found]) for k in range(3)]
            flat = pa.StructArray.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], fields=list(kind.value_type))
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int32()), runs], names=["doc_id", "key", "n_words", "runs"])

        return step

    id_kind = keyed.schema["doc_id"].dataType.simpleString()
    return map_slices(keyed, make, f"doc_id {id_kind}, key binary, n_words int, runs array<struct<anchor:bigint,start:int,n:int>>")


def _window_frame(candidates: DataFrame, window: int) -> DataFrame:
    """text_no, doc_id, at (first word) and two hashes of each candidate window."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows, at, one, two = [], [], [], []
            for i, (t, runs) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                h = word_hashes(words(t))
                where = np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in runs])
                at.append(where)
                rows.append(np.full(len(where), i))
                one.append(rolled(h, window, FACTORS[0])[where])
                two.append(rolled(h ^ (h >> np.uint64(32)), window, FACTORS[1])[where])
            row = pa.array(np.concatenate(rows))
            longs = [pa.array(np.concatenate(x).view(np.int64)) for x in (one, two)]
            return pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), pa.array(np.concatenate(at), pa.int32()), *longs], names=["text_no", "doc_id", "at", "one", "two"])

        return step

    id_kind = candidates.schema["doc_id"].dataType.simpleString()
    return map_slices(candidates.select("text_no", "doc_id", "text", "runs"), make, f"text_no long, doc_id {id_kind}, at int, one long, two long")


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _passages(claimed: DataFrame, window: int) -> DataFrame:
    """owner, text_no, start and the text of each run of neighbouring windows that name one owner."""

    id_kind = claimed.schema["claims"].dataType.elementType["owner"].dataType.simpleString()

    def run(batches):
        for part in slices(batches):
            kind = part.column(2).type.value_type.field("owner").type
            out = {"owner": [], "row": [], "start": [], "passage": []}
            for i, (t, claims) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                parts = words(t)
                claims = sorted((c["at"], c["owner"]) for c in claims)
                first = 0
                for k in range(1, len(claims) + 1):
                    if k == len(claims) or claims[k] != (claims[k - 1][0] + 1, claims[first][1]):
                        a, b = claims[first][0], claims[k - 1][0] + window
                        out["owner"].append(claims[first][1])
                        out["row"].append(i)
                        out["start"].append(a)
                        out["passage"].append(b" ".join(parts[a:b]).decode())
                        first = k
            row = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["owner"], kind), part.column(0).take(row), pa.array(out["start"], pa.int32()), pa.array(out["passage"], pa.string())],
                names=["owner", "text_no", "start", "passage"],
            )

    return claimed.mapInArrow(run, f"owner {id_kind}, text_no long, start int, passage string")


def _verified(passages: DataFrame, candidates: DataFrame, window: int) -> DataFrame:
    """text_no and the spans (start, stop) of passages that their owner's automaton matches."""
    load = staged(passages.groupBy("owner").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares")), "load")
    share = F.pmod(F.xxhash64("text_no", "start"), F.col("shares")).cast("int")
    asked = passages.join(load, "owner").select("owner", share.alias("share"), F.lit(1).alias("kind"), "text_no", "start", F.col("passage").alias("text"))
    known = candidates.select("doc_id", "text_no", "text").join(load, F.col("doc_id") == F.col("owner"))
    known = known.select("owner", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), "text_no", F.lit(0).alias("start"), "text")
    both = known.union(asked).repartition("owner", "share").sortWithinPartitions("owner", "share", "kind")

    def run(batches):
        owner, shards = None, []
        for part in slices(batches):
            rows, starts, stops = [], [], []
            columns = (part.column(k).to_pylist() for k in (0, 1, 2, 4, 5))
            for i, (o, s, kind, start, text) in enumerate(zip(*columns)):
                if (o, s) != owner:
                    owner, shards = (o, s), []
                if kind == 0:
                    shards.append(SuffixAutomaton(words(text)))  # several rows may have the owner's id
                    continue
                for a, b in _merge([x for shard in shards for x in shard.spans(words(text), window)]):
                    rows.append(i)
                    starts.append(start + a)
                    stops.append(start + b)
            row = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(3).take(row), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], names=["text_no", "start", "stop"])

    return both.mapInArrow(run, "text_no long, start int, stop int")


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, key (of the text) and ``spans`` (array of start and stop, in words) of what goes."""
    keyed = texts(docs).filter(F.col("doc_id").isNotNull()).select("doc_id", text_key().alias("key"), "text")
    # Written rows keep their number, which stands for a text in what follows.
    found = staged(_anchor_frame(keyed, window, anchor).withColumn("text_no", F.monotonically_increasing_id()), "anchors")
    classes = found.groupBy("key").agg(F.min(F.struct("doc_id", "text_no")).alias("first"))
    classes = staged(classes.select("key", F.col("first.doc_id").alias("first"), F.col("first.text_no").alias("text_no")), "classes")
    long = found.filter(F.col("n_words") >= window).select("doc_id", "key", "n_words")
    copies = long.join(classes, "key").filter(F.col("doc_id") > F.col("first")).dropDuplicates(["doc_id", "key"])
    whole = copies.select("doc_id", "key", F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("stop"))).alias("spans"))

    own = found.select("text_no", "doc_id", "runs").join(classes.select("text_no"), "text_no").select("text_no", "doc_id", F.explode("runs").alias("run"))
    own = staged(own.select("text_no", "doc_id", "run.*"), "runs")
    # What a join adds to rows of a hot key is written first: Spark splits a hot join whose sides are only read.
    shared = own.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("uses"))
    shared = staged(shared.filter("low < high").select("anchor", "uses"), "shared-anchors")
    # The most used anchors are few, so their rows stay where they are; the others meet their rows in a join.
    many = max(HOT_USES, own.count() // MOST_HOT)
    hot = [r["anchor"] for r in shared.filter(F.col("uses") >= many).select("anchor").toArrow().to_pylist()]
    runs = own.select("anchor", "text_no", "start", "n")
    cold = runs.join(shared.filter(F.col("uses") < many), "anchor").select("text_no", "start", "n")
    every = cold.union(runs.filter(F.col("anchor").isin(hot)).select("text_no", "start", "n"))
    chosen = every.groupBy("text_no").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    chosen = chosen.join(classes, "text_no").select("text_no", F.col("first").alias("doc_id"), "key", "runs")
    # Texts come by id and digest; rows that repeat both are one.
    candidates = keyed.join(chosen, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]).select("text_no", "doc_id", "key", "text", "runs")
    candidates = staged(candidates, "candidates")

    windows = staged(_window_frame(candidates, window), "windows")
    owners = windows.groupBy("one", "two").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last")
    owners = staged(owners.select("one", "two", "owner"), "owners")
    claims = windows.join(owners, ["one", "two"]).filter("doc_id > owner")
    claims = claims.groupBy("text_no").agg(F.collect_list(F.struct("at", "owner")).alias("claims"))
    claimed = candidates.select("text_no", "text").join(claims, "text_no").select("text_no", "text", "claims")
    passages = staged(_passages(claimed, window), "passages")
    spans = _verified(passages, candidates, window).groupBy("text_no").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    decided = spans.join(candidates.select("text_no", "doc_id", "key"), "text_no").select("doc_id", "key", "spans")
    return staged(decided.union(whole), "spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, the ``spans`` that went and the ``kept`` words, joined by single blanks."""
    spans = repeated_spans(docs, window)
    joined = texts(docs).withColumn("key", text_key()).join(spans, ["doc_id", "key"], "left").select("doc_id", "text", "spans")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            counts, removed, kept, merged = [], [], [], []
            for t, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                parts = words(t)
                cut = _merge([(s["start"], s["stop"]) for s in found or ()])
                edges = [0, *(x for s in cut for x in s), len(parts)]
                left = [w for a, b in zip(edges[::2], edges[1::2]) for w in parts[a:b]]
                counts.append(len(parts))
                removed.append(len(parts) - len(left))
                kept.append(b" ".join(left).decode())
                merged.append([{"start": a, "stop": b} for a, b in cut])
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(merged, kind), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

        return step

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(joined, make, f"doc_id {id_kind}, n_words long, n_removed long, spans array<struct<start:int,stop:int>>, kept string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns. A text with repeats becomes its kept words, joined by single blanks, and
    ``n_chars`` (if there) its new length; other texts stay as they are, blanks included."""
    spans = repeated_spans(docs, window)
    joined = whole_rows(docs).join(spans, (F.col("id") == F.col("doc_id")) & (F.col("own") == F.col("key")), "left")
    joined = joined.select("row", F.col("row.text").alias("text"), "spans")
    place, names = docs.columns.index("text"), docs.columns

    def run(batches):
        for part in slices(batches):
            out = []
            for t, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                if found:
                    parts = words(t)
                    edges = [0, *(x for s in _merge([(s["start"], s["stop"]) for s in found]) for x in s), len(parts)]
                    t = b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in parts[a:b]).decode()
                out.append(t)
            columns = part.column(0).flatten()
            columns[place] = pa.array(out, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    cut = joined.mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
