"""The registered queries of the text operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelines.llm import bpe, digests, packing, quality, quantise, search, simhash, substring, token_counts, toxicity, urls, warc, whitening
from tidelines.llm.common import documents, labels, shared_dir, staged

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
URL_RULES = [
    urls.Rule("block", "com", "/en/"),
    urls.Rule("allow", "example.com", "/en/7"),
    urls.Rule("allow", "net", "/de/"),
    urls.Rule("block", "example.net", "/de/8"),
    urls.Rule("block", "org", "/es/"),
]


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    both = bpe.decode(bpe.encode(documents(spark, sf_dir), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labelled = staged(urls.weak_labels(urls.with_parts(pages), URL_RULES), "labelled-urls")
    return urls.judge(pages, URL_RULES, urls.train(labelled))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring.remove_repeats(documents(spark, sf_dir))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), F.col("doc_id") % 50 == 0)


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = staged(simhash.fingerprints(documents(spark, sf_dir)), "prints")
    linked = simhash.components_of(prints)
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, labels(spark, sf_dir), held_out=(3, 1))
    scored = toxicity.score(docs, model)
    held_out = quality.in_fold("doc_id", 3, 1).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.digest(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, labels(spark, sf_dir), held_out=(5, 0))
    scored = quality.score(docs, model)
    held_out = quality.in_fold("doc_id", 5, 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with the length and checksum of their ids instead of the ids."""
    pieces = packing.pack(docs, public_tokenizers.path(BYTE_BPE))
    length = (F.octet_length("ids") / 4).cast("long").alias("length")
    return pieces.select("doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(embeddings(spark, sf_dir))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = quantise.compress(embeddings(spark, sf_dir))
    return coded.withColumns({c: F.expr(f"try_cast({c} AS bigint)") for c in ("error", "label_error")})


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(warc.with_types(pages), path)
    read = warc.read_archives(spark, path)
    page, refers_to = F.col("page").cast("bigint").alias("page_id"), F.col("refers_to_page").cast("bigint").alias("refers_to")
    return read.select(page, "payload_bytes", "payload_digest", F.col("type").alias("record_type"), refers_to)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_url_filter": op2_url_filter,
    "op3_token_counts": op3_token_counts,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_top_k_search": op5_top_k_search,
    "op6_simhash_components": op6_simhash_components,
    "op7_toxicity": op7_toxicity,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_warc": op13_warc,
}


def _vector_codes_sql() -> str:
    """Six rounds of all parts against all entries, then the last assignment."""
    text = r"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT r, (i - 1) // (len(embedding) // 8) AS p, (i - 1) % (len(embedding) // 8) AS j,
         CAST(floor(4096 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
  FROM kept, unnest(range(1, len(embedding) + 1)) AS t(i)
), firsts AS (
  SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 16
), c0 AS MATERIALIZED (
  SELECT p, e, j, v FROM x JOIN firsts USING (r)
)"""
    for k in range(7):
        text += f""", d{k} AS (
  SELECT x.r, x.p, c.e, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{k} c ON x.p = c.p AND x.j = c.j GROUP BY ALL
), a{k} AS MATERIALIZED (
  SELECT r, p, e, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1
)"""
        if k < 6:
            text += f""", m{k} AS (
  SELECT x.p, a.e, x.j, CAST(floor(CAST(sum(x.v) AS DOUBLE) / count(*)) AS BIGINT) AS v
  FROM x JOIN a{k} a ON x.r = a.r AND x.p = a.p GROUP BY ALL
), c{k + 1} AS MATERIALIZED (
  SELECT c.p, c.e, c.j, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m ON c.p = m.p AND c.e = m.e AND c.j = m.j
)"""
    return text + """, coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY r
), books AS (
  SELECT sha256(string_agg(v, ',' ORDER BY p, e, j)) AS h FROM c6
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), books
"""

ORACLES: dict[str, str] = {
    "op4_substring_dedup": r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
  FROM w, unnest(range(1, greatest(len(ws) - 48, 1))) AS t(i)
), hits AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY k) AS earliest FROM windows)
  WHERE earliest < doc_id
), gone AS (
  SELECT DISTINCT r, j FROM hits, unnest(range(i, i + 50)) AS u(j)
), kept AS (
  SELECT p.r, string_agg(p.word, ' ' ORDER BY p.j) AS kept
  FROM (SELECT r, j, ws[j] AS word FROM w, unnest(range(1, len(ws) + 1)) AS v(j)) p
  ANTI JOIN gone ON p.r = gone.r AND p.j = gone.j
  GROUP BY p.r
), removed AS (
  SELECT r, count(*) AS n FROM gone GROUP BY r
)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)
""",
    "op12_vector_codes": _vector_codes_sql(),
    "op13_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS k,
         first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS earliest
  FROM pages
)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN k > 1 AND strlen(h) >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k > 1 AND strlen(h) >= 100 THEN earliest END AS refers_to
FROM p
""",
}
