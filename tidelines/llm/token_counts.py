"""Token counts without ids (operator 3).

Pieces of this vocabulary never cross from a letter to the white-space mark that follows it, so a text falls into
independent pre-tokens, each a run of marks and the characters up to the next run. Pieces are counted once for each
distinct pre-token of the corpus; documents only hold frequencies of pre-tokens, which are joined to those counts and
summed. No ids are ever made for a document.

The most frequent pre-tokens (``frequent``, a fixed bound) travel to all tasks as one small dictionary, so only the
rest of a document's pre-tokens is shuffled. Both parts are joined, so results do not depend on the bound.

Edge cases: a null or empty text has no tokens; repeated rows are each counted (rows are told apart by a row number
that the operator makes); other columns are dropped. ``supported`` tells whether a vocabulary has the needed property.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.llm.common import slices, staged

MARK = "▁"
PRE_TOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
FREQUENT = 600_000
#: Pre-tokens longer than this are counted where they stand and not shuffled.
LONGEST = 256
#: Distinct pre-tokens that a task gathers before it hands them on.
GATHERED = 300_000


@cache
def model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def supported(path: str) -> bool:
    """True if no piece has a mark after another character, and normalisation leaves texts as they are."""
    pieces = model(path)
    names = (pieces.id_to_piece(i) for i in range(len(pieces)))
    probe = " ﬁ  Ａ\n\tb "
    return not any(re.search(f"[^{MARK}]{MARK}", p) for p in names) and pieces.normalize(probe) == MARK + probe.replace(" ", MARK)


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text, with the mark that the library puts before it."""
    return PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


def count_pieces(path: str, tokens: list[str]) -> list[int]:
    """Number of pieces of each pre-token. The library puts a mark before every text, so one is taken away first;
    a single mark, which would leave nothing, is one piece."""
    encoded = model(path).encode([t[1:].replace(MARK, " ") for t in tokens], num_threads=1)
    return [len(ids) if len(t) > 1 else 1 for t, ids in zip(tokens, encoded)]


def distinct_pre_tokens(docs: DataFrame) -> DataFrame:
    """pre_token, n_documents: tasks sum up first, so what is shuffled is at most one row per task and pre-token."""

    def run(batches):
        held: Counter[str] = Counter()

        def out():
            got = [(t, n) for t, n in held.items() if len(t) <= LONGEST]
            held.clear()
            for i in range(0, len(got), 50_000):
                names, counts = zip(*got[i : i + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["pre_token", "n"])

        for part in slices(batches):
            for text in part.column(0).to_pylist():
                held.update(set(pre_tokens(text)))
            if len(held) > GATHERED:
                yield from out()
        yield from out()

    found = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, "pre_token string, n long")
    return found.groupBy("pre_token").agg(F.sum("n").alias("n_documents"))


def piece_counts(distinct: DataFrame, path: str) -> DataFrame:
    """Adds ``n_pieces`` to distinct pre-tokens; each is encoded once."""

    def run(batches):
        for batch in batches:
            counts = count_pieces(path, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int32())], names=["pre_token", "n_documents", "n_pieces"])

    return distinct.mapInArrow(run, "pre_token string, n_documents long, n_pieces int")


def _most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """About the ``most`` pre-tokens of the highest document frequency, and no more than a few hundredths above.

    A histogram of a thousand cells gives the frequency down to which all are taken; of the next cell a share is
    taken, by hash."""
    cell = F.floor(F.log2("n_documents") * 16).alias("cell")
    cells = counted.groupBy(cell).agg(F.count("*").alias("n"), F.min("n_documents").alias("low")).collect()
    least, taken, share = 1 << 62, 0, 0.0
    for row in sorted(cells, key=lambda r: -r["cell"]):
        if taken + row["n"] > most:
            share = (most - taken) / row["n"]
            break
        least, taken = row["low"], taken + row["n"]
    below = sorted((r["low"] for r in cells if r["low"] < least), reverse=True)[:1] or [least]
    some = (F.col("n_documents") >= below[0]) & (F.pmod(F.xxhash64("pre_token"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return counted.filter((F.col("n_documents") >= least) | some)


def count_tokens(docs: DataFrame, path: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs``."""
    if not supported(path):
        raise ValueError(f"pieces of {path} cross pre-token borders; count them by encoding instead")
    spark = docs.sparkSession
    counted = staged(piece_counts(distinct_pre_tokens(docs), path), "piece-counts")
    top = _most_frequent(counted, frequent).select("pre_token", "n_pieces").toArrow()
    known = spark.sparkContext.broadcast(dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist())))

    def run(batches):
        counts = known.value
        for part in slices(batches):
            sums, rows, tokens, times = [], [], [], []
            for row, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                n = 0
                for token, k in Counter(pre_tokens(text)).items():
                    pieces = counts.get(token)
                    if pieces is not None:
                        n += k * pieces
                    elif len(token) > LONGEST:
                        n += k * count_pieces(path, [token])[0]
                    else:
                        rows.append(row)
                        tokens.append(token)
                        times.append(k)
                sums.append(n)
            ids, lengths = part.column(0), pc.binary_length(part.column(2))
            n, m = part.num_rows, len(rows)
            nothing = lambda kind: pa.nulls(m, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([part.column(1), pa.array(rows, pa.int64())]),
                    pa.concat_arrays([ids, nothing(ids.type)]),
                    pa.concat_arrays([lengths.cast(pa.int64()), nothing(pa.int64())]),
                    pa.concat_arrays([pa.array(sums, pa.int64()), pa.array(times, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n, pa.string()), pa.array(tokens, pa.string())]),
                ],
                names=["row", "doc_id", "n_bytes", "n", "pre_token"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = source.mapInArrow(run, f"row long, doc_id {kind}, n_bytes long, n long, pre_token string")
    return _summed(parts, counted)


def _summed(parts: DataFrame, counted: DataFrame) -> DataFrame:
    """Join the rarer pre-tokens to their counts and sum up by row. A row's known sum passes the join unmatched under
    a key of its own (pre-tokens start with the mark), since rows with a null key would all meet in one task."""
    keyed = parts.withColumn("key", F.coalesce("pre_token", F.concat(F.lit("row "), F.col("row")))).drop("pre_token")
    joined = keyed.join(counted.select(F.col("pre_token").alias("key"), "n_pieces"), "key", "left")
    tokens = F.col("n") * F.when(F.col("n_pieces").isNotNull(), F.col("n_pieces")).otherwise(1)
    per_row = joined.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
    return per_row.select("doc_id", "n_bytes", "n_tokens")
