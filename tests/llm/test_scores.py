"""Quality, toxicity, URL filters, fingerprints, search and the pipeline."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidelines.llm import digests, quality, search, toxicity, urls
from tidelines.llm.queries import QUERIES, URL_RULES

SMALL = "/root/testdata/sf0.01"


def area_under_curve(score, label):
    order = np.argsort(np.argsort(score))
    good, bad = (label == 1).sum(), (label == 0).sum()
    return (order[label == 1].sum() - good * (good - 1) / 2) / (good * bad)


@pytest.mark.parametrize(("name", "label", "parts", "rest", "least"), [("op9_quality", "quality", 5, 0, 0.97), ("op7_toxicity", "toxic", 3, 1, 0.6)])
def test_held_out_scores(spark, name, label, parts, rest, least):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % parts == rest for i in got.doc_id]).all()
    known = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().merge(got[got.held_out], on="doc_id")
    assert area_under_curve(known.score.to_numpy(), known[label].to_numpy()) >= least
    assert (got.predicted == (got.score >= (0.3 if label == "quality" else 0.7)).astype(int)).all()


def test_ranking_prefers_better_features():
    draw = np.random.default_rng(0)
    x = draw.random((400, len(quality.NAMES)))
    label = (x[:, 3] + 0.2 * draw.random(400) > 0.4).astype(int)
    model = quality.rank(x, label)
    assert area_under_curve(model.scores(x), label) > 0.98
    assert ((model.scores(x) >= quality.THRESHOLD) == (label == 1)).mean() > 0.9
    assert (quality.rank(x, np.ones(400)).scores(x) == 0.5).all()


def test_quality_and_toxicity_of_odd_rows(spark, table, odd_pairs):
    docs = table(odd_pairs)
    labels = spark.createDataFrame([(3, 1, 0), (9, 0, 1), (10, 0, None), (None, 1, 1), (777, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(odd_pairs) and all(0 <= r.score <= 1 for r in scored)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in scored if r.score >= quality.THRESHOLD)
    rude = toxicity.train(docs, labels)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, rude).collect())
    assert toxicity.keep_civil(docs, rude).columns == docs.columns
    none = labels.limit(0)
    assert {r.score for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    untrained = toxicity.train(docs, none)
    assert {r.score for r in toxicity.score(docs, untrained).collect()} == {0.0}
    assert toxicity.keep_civil(docs, untrained).count() == len(odd_pairs)
    assert quality.score(table([]), model).count() == toxicity.score(table([]), rude).count() == 0


def test_toxic_words_are_learned(spark, table):
    rude = ["blockhead", "numbskull", "nitwit"]
    pairs = [(i, prose(i, 60) + (f" {rude[i % 3]} {prose(i + 999, 20)}" if i % 4 == 0 else "")) for i in range(900)]
    pairs += [(5000 + k, pairs[0][1]) for k in range(60)]  # copies of one toxic text teach its words only once
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 or i >= 5000 else 0) for i, _ in pairs], "doc_id long, toxic int")
    model = toxicity.train(table(pairs), labels)
    tests = [(10_000 + i, prose(7_000 + i, 80) + (f" {rude[i % 3]} so" if i % 2 else "")) for i in range(60)]
    got = {r.doc_id: r.score for r in toxicity.score(table(tests), model).collect()}
    caught = sum(got[i] >= toxicity.THRESHOLD for i, _ in tests if i % 2)
    flagged = sum(got[i] >= toxicity.THRESHOLD for i, _ in tests if not i % 2)
    assert caught >= 28 and flagged <= 1


def test_urls(spark):
    given = [
        "https://Blog.Example.COM/en/7?x#y",
        "http://example.com/en/",
        "http://notexample.com/en/9",
        "ftp://a.example.net/de/81",
        "http://a.example.net/de/71",
        "http://x.org#/es/",
        "http://x.org/es/1#a",
        "http://com/en/://x",
        "no scheme",
        "",
        None,
        "http://",
        "http://x.com?/en/",
        "http://x.com/EN/",
    ]
    pages = spark.createDataFrame([(k, u, None, 1) for k, u in enumerate([*given, *given])], "page_id long, url string, html string, host int")
    got = urls.judge(pages, URL_RULES, None).collect()
    assert len(got) == 2 * len(given)
    for r in got:
        url, host, path = given[r.page_id % len(given)], "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path = re.match("[^?#]*", rest[len(host) :])[0]
            host = host.lower()
        fit = [u for u in URL_RULES if (host == u.host or host.endswith("." + u.host)) and path.startswith(u.path)]
        best = max(fit, key=lambda u: len(u.text), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best.text, best.verdict if best else "allow")


def test_url_model_learns_and_is_native(spark):
    rows = [(k, f"http://{'bad' if k % 2 else 'good'}{k % 7}.example.org/{k}/page", "") for k in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    parts = urls.with_parts(pages)
    labelled = parts.filter("page_id < 200").select("host", "path", F.when(F.col("page_id") % 2 == 1, "block").otherwise("allow").alias("verdict"))
    judged = urls.judge(pages, [], urls.train(labelled))
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in judged.collect())
    assert not re.search("Python|Pandas|Arrow", judged._jdf.queryExecution().toString())
    assert urls.train(labelled.filter("verdict = 'allow'")) is None
    assert urls.judge(pages.limit(0), URL_RULES, None).count() == 0


def test_entropy_levels():
    found = [b"hello world " * 20, b"short", bytes(range(256)), "áéí öäü ß".encode() * 30, b"", b"a" * 64]
    raw, sizes = digests.joined(found)
    level, valid = digests.levels(raw, sizes)
    assert valid.sum() == sum(max(0, len(f) - 63) for f in found)
    for i in np.flatnonzero(valid):
        counts = Counter(raw[i : i + 64].tolist())
        entropy = 6 - sum(c * math.log2(c) for c in counts.values()) / 64
        assert abs(level[i] - entropy / 6 * 1000) <= 1.01


def test_fingerprints_do_not_depend_on_neighbours():
    rank = digests.ranks(np.arange(digests.LEVELS)[::-1])
    found = [prose(k, n).encode() for k, n in enumerate((0, 1, 5, 11, 14, 40, 300, 3000))] + [b"x" * 500]
    alone = [digests.fingerprints([f], rank)[0] for f in found]
    together = digests.fingerprints(found, rank)
    assert all(np.array_equal(a, b) for a, b in zip(alone, together))
    assert all(digests.likeness(a, a) == 1 for a in alone)
    assert digests.likeness(alone[0], alone[5]) == 0 and digests.likeness(alone[6], alone[5]) < 0.1
    half = digests.fingerprints([found[7][: len(found[7]) // 2]], rank)[0]
    assert digests.likeness(half, alone[7]) > 0.5


def plain_filters(text, rank):
    """The same fingerprint window by window."""
    if len(text) < 64:
        picked = [xxhash.xxh64_intdigest(text)] if text else []
    else:
        level, _ = digests.levels(np.frombuffer(text, np.uint8), np.array([len(text)]))
        windows = len(text) - 63
        runs = [range(r, r + 64) for r in range(windows - 63)] or [range(windows)]
        points = Counter(min(run, key=lambda w: (rank[level[w]], w)) for run in runs)
        needed = min(16, max(1, len(runs) // 8))
        picked = []
        for w in sorted(w for w, n in points.items() if n >= needed):
            value = sum((b + 1) * (int.from_bytes(xxhash.xxh64_digest(bytes([k])), "little") | 1) for k, b in enumerate(text[w : w + 64])) % 2**64
            value = (value ^ value >> 32) * 0xD6E8FEB86659FD93 % 2**64
            picked.append(value ^ value >> 29)
    chain = []
    for start in range(0, len(picked), 160):
        bits = {value >> 11 * k & 2047 for value in picked[start : start + 160] for k in range(5)}
        chain.append(bits)
    return chain


def plain_likeness(a, b):
    a, b = sorted((a, b), key=len)
    if not a:
        return float(not b)
    total = 0.0
    for one in a:
        best = 0.0
        for two in b:
            most, chance = min(len(one), len(two)), len(one) * len(two) / 2048
            floor = chance + 0.2 * (most - chance)
            common = len(one & two)
            best = max(best, (common - floor) / (most - floor) if most > floor else float(common >= most))
        total += min(best, 1) * len(one)
    return total / sum(map(len, a))


@pytest.mark.parametrize("piece", [digests.PIECE, 300])
def test_fingerprints_against_plain_ones(monkeypatch, piece):
    monkeypatch.setattr(digests, "PIECE", piece)
    rank = digests.ranks(np.random.default_rng(2).integers(0, 50, digests.LEVELS))
    found = [prose(k, n).encode() for k, n in enumerate((0, 1, 9, 12, 16, 22, 30, 60, 300, 4000))] + [b"ab" * 900]
    found.append(found[8][:700] + found[9][:900])
    got = digests.fingerprints(found, rank)
    want = [plain_filters(f, rank) for f in found]
    for g, w in zip(got, want):
        assert [set(np.flatnonzero(bits)) for bits in np.unpackbits(g, axis=1)] == w
    for i in range(len(found)):
        for j in range(len(found)):
            assert digests.likeness(got[i], got[j]) == pytest.approx(plain_likeness(want[i], want[j]))


def test_fingerprints_of_rows_that_share_an_id(table, monkeypatch):
    """Most rows have one doc_id, or none; each is followed by the next in the order of doc_id, text hash and text."""
    monkeypatch.setattr(digests, "ROWS_PER_RANGE", 4)
    pairs = [(k, prose(k, 30)) for k in range(20)] + [(7, prose(100 + k, 30)) for k in range(40)] + [(None, prose(200 + k, 30)) for k in range(30)]
    pairs += [(7, prose(101, 30))] * 5 + [(None, None)] * 3
    rows = digests.with_next(table(pairs)).withColumn("p", F.spark_partition_id()).collect()
    assert Counter((r.doc_id, r.text) for r in rows if not r.guest) == Counter((i, t or "") for i, t in pairs)
    assert max(Counter(r.cell for r in rows).values()) <= 20 and len({r.cell for r in rows if r.doc_id == 7 and not r.guest}) > 3
    by_cell = defaultdict(list)
    for r in rows:
        by_cell[r.cell].append(r)
    # Cells follow each other; the guest of one is the first row of the next.
    order = sorted(by_cell, reverse=True)
    first = {c: by_cell[c][0] for c in order}
    joined = [r for c in order for r in by_cell[c] if not r.guest]
    keys = [(r.doc_id is None, -(r.doc_id or 0)) for r in joined]
    assert keys == sorted(keys)
    for k, c in enumerate(order):
        guest = by_cell[c][-1]
        after = first[order[(k + 1) % len(order)]]
        assert guest.guest and (guest.doc_id, guest.text) == (after.doc_id, after.text)
    assert digests.digest(table(pairs)).count() == len(pairs)


@pytest.mark.parametrize("rows", [2_000, 3])
def test_digest_of_odd_rows(table, odd_pairs, rows, monkeypatch):
    monkeypatch.setattr(digests, "ROWS_PER_RANGE", rows)
    pairs = [(i, t) for i, t in odd_pairs if i is not None]
    pairs = list(dict(pairs).items())  # the order of rows with one id is the operator's own
    got = {r.doc_id: r for r in digests.digest(table(pairs)).collect()}
    order = sorted(pairs, reverse=True)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    texts = defaultdict(set)
    for i, t in pairs:
        texts[t or ""].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in texts.values())
    assert digests.digest(table(odd_pairs)).count() == len(odd_pairs)
    assert digests.digest(table([])).count() == 0
    assert digests.digest(table([(1, "alone")])).first().near_next == 1


def test_search_by_brute_force(table, odd_pairs):
    pairs = odd_pairs + [(50 * k, prose(k, 40 + k)) for k in range(20, 30)] + [(2000 + k, prose(k, 30)) for k in range(60)]
    got = defaultdict(list)
    for r in search.search(table(pairs), F.col("doc_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.doc_id))
    docs = [(i, Counter((t or "").lower().encode().split())) for i, t in pairs if i is not None]
    n, sizes = len(docs), [sum(c.values()) for _, c in docs]
    mean, df = sum(sizes) / n, Counter(w for _, c in docs for w in c)
    for q, words in docs:
        if q % 50:
            continue
        scores = []
        for (i, c), size in zip(docs, sizes):
            s = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w in words if w in c)
            if s > 0:
                scores.append((s, i))
        want = sorted(scores, key=lambda x: (-round(x[0], 9), x[1]))[:5]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in want])
        assert [i for _, i in got[q]] == [i for _, i in want]


def test_shard_skips_blocks_but_not_results():
    draw = np.random.default_rng(2)
    lengths = draw.integers(5, 40, 600)
    docs = [draw.zipf(1.5, n) % 90 for n in lengths]
    names = np.arange(90)
    place = [np.unique(d, return_counts=True) for d in docs]
    rows = sorted((int(t), k, int(c)) for k, (ts, cs) in enumerate(place) for t, c in zip(ts, cs))
    ends = np.searchsorted([r[0] for r in rows], names, side="right")
    blob = {
        "ids": list(range(600)),
        "lengths": lengths.astype(np.int32).tobytes(),
        "terms": names.astype(np.int64).tobytes(),
        "ends": ends.astype(np.int32).tobytes(),
        "docs": np.array([r[1] for r in rows], np.uint16).tobytes(),
        "tf": np.array([r[2] for r in rows], np.uint16).tobytes(),
    }
    shard = search.Shard(blob, float(lengths.mean()))
    for _ in range(40):
        query = np.unique(draw.integers(0, 100, 6))
        weight = draw.random(len(query)) + 0.1
        every = np.zeros(600)
        for (t, k, _), impact in zip(rows, shard.impact):
            hit = np.flatnonzero(query == t)
            if len(hit):
                every[k] += weight[hit[0]] * impact
        found, scores = shard.best(query, weight, 10)
        want = np.sort(every)[::-1][:10]
        assert np.allclose(np.sort(scores)[::-1][:10], want[want > 0])


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    from tidelines.llm.common import documents, staged

    docs = documents(spark, sf_dir)
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns and 0 < docs.count() <= n, name
        n = docs.count()
    texts = [r.text for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.select("doc_id").distinct().count() == n
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert all(r.n <= 1024 and r.n & (r.n - 1) == 0 for r in sizes)


def test_distinct_words_count_in_the_whole_text():
    words = [f"w{k}" for k in range(200)]
    junk = ["junk", "words"] * 400
    assert quality.window_shares([]) == [0.0] and quality.window_shares(words[:3]) == [1.0]
    assert quality.window_shares(words + junk[:100]) == [1.0, (100 + 2) / 200]
    assert quality.window_shares(words + words) == [1.0, 1.0]
    assert quality.window_shares(words + junk) == quality.window_shares(junk + words)[::-1] == [1.0, *[0.01] * 4]
    clean, spoiled = (dict(zip(quality.NAMES, quality.features(" ".join(x)))) for x in (words, words + junk))
    windows = [n for n in quality.NAMES if n.startswith("distinct_")]
    assert all(spoiled[n] < 0.6 * clean[n] for n in windows)


def test_search_counts_words_beyond_16_bits(spark):
    texts = ["often " * 70_000 + "other", "often " * 1_000_000, "often other words", "often often", "rare words"] + [f"w{k} x y" for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.doc_id, r.score) for r in search.search(docs, F.col("doc_id") == 3).orderBy("rank").collect()]
    found = [Counter(t.split()) for t in texts]
    n, mean = len(texts), sum(c.total() for c in found) / len(texts)
    df = sum(c["often"] > 0 for c in found)
    want = {i: math.log1p((n - df + 0.5) / (df + 0.5)) * c["often"] * 2.2 / (c["often"] + 1.2 * (0.25 + 0.75 * c.total() / mean)) for i, c in enumerate(found) if c["often"]}
    assert [i for i, _ in got] == sorted(want, key=lambda i: (-want[i], i))
    assert [s for _, s in got] == pytest.approx([want[i] for i, _ in got], rel=1e-12)


def test_rare_blocked_urls_are_in_the_sample(spark):
    rows = [(k, f"http://a.com/{'en' if k % 500 == 0 else 'fr'}/{k}", "") for k in range(2_000)]
    parts = urls.with_parts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = Counter(r.verdict for r in urls.weak_labels(parts, [urls.Rule("block", "com", "/en/")], most=20).collect())
    assert got == {"block": 4, "allow": 10}


def test_equal_texts_tie_across_matrix_and_postings(spark):
    """More copies than places, with frequent and rare words: all score alike, so the smallest ids are found, whole."""
    texts = [" ".join(f"w{(7 * i + j * j) % 60}" for j in range(30)) + f" own{i // 3}" for i in range(90)]
    docs = spark.createDataFrame([(i, texts[i] if i % 4 else "alpha beta gamma w1 w2 w3") for i in range(90)], "doc_id long, text string")
    got = search.search(docs, F.col("doc_id").isin(0, 50), k=5).orderBy("query_id", "rank").collect()
    first = [r for r in got if r.query_id == 0]
    assert [r.doc_id for r in first] == [0, 4, 8, 12, 16] and len({r.score for r in first}) == 1
    assert [r.doc_id for r in got if r.query_id == 50][0] == 50


def test_search_of_many_queries_in_a_shard_is_fast():
    """A pair of query and document costs little: the shard is walked by matrix products, not by sorted blocks."""
    import time

    draw = np.random.default_rng(3)
    n, vocabulary = 8192, 20_000
    found = [np.unique(draw.zipf(1.2, 400) % vocabulary) for _ in range(n)]
    term, doc = np.concatenate(found), np.repeat(np.arange(n), [*map(len, found)])
    order = np.lexsort((doc, term))
    names, counts = np.unique(term, return_counts=True)
    blob = {
        "ids": list(range(n)),
        "lengths": np.full(n, 400, np.int32).tobytes(),
        "terms": names.astype(np.int64).tobytes(),
        "ends": np.cumsum(counts).astype(np.int32).tobytes(),
        "docs": doc[order].astype(np.uint16).tobytes(),
        "tf": np.ones(len(doc), np.uint16).tobytes(),
    }
    shard = search.Shard(blob, 400.0)
    asked = found[:256]
    cuts = np.cumsum([0, *map(len, asked)])
    weight_of = dict(zip(names.tolist(), np.log1p((n - counts + 0.5) / (counts + 0.5)).tolist()))
    weights = np.array([weight_of[t] for q in asked for t in q.tolist()])
    start = time.process_time()
    best = list(shard.search(cuts, shard.places(np.concatenate(asked)), weights, 10))
    assert time.process_time() - start < 3
    assert all(q in ids for q, (ids, _) in enumerate(best))


def test_search_leaves_the_index_where_it_is_for_every_block_of_queries(table, monkeypatch):
    """Many blocks of queries find what one finds, each from the stored index, which is never exchanged."""
    docs = table([(k, prose(k % 70, 30 + k % 7)) for k in range(300)])
    rows = lambda found: sorted(tuple(r) for r in found.collect())
    want = rows(search.search(docs, F.col("doc_id") % 20 == 0, k=4))
    monkeypatch.setattr(search, "QUERY_TERMS", 60)
    found = search.search(docs, F.col("doc_id") % 20 == 0, k=4)
    plan = found._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") > 8 and "REPARTITION" not in plan
    assert rows(found) == want and len(want) == 15 * 4


def test_later_shards_score_few_documents_in_full(table):
    """What earlier shards have found keeps other documents from being scored in full, and loses none of the k best."""
    parts = [[(k, prose(k, 40)) for k in range(1200)], [(k, prose(k, 40)) for k in range(1200, 1500)]]
    shards = [search.Shard(search.build_index(table(p).coalesce(1)).first().asDict(), 40.0) for p in parts]
    asked = [np.unique(search.terms(prose(k, 40))) for k in range(1190, 1220)]
    cuts, names = np.cumsum([0, *map(len, asked)]), np.concatenate(asked)
    weights = 1 + (names % 7) / 3
    first, whole = (list(s.search(cuts, s.places(names), weights, 5)) for s in shards)
    least, counts, inner = np.array([np.sort(x)[-5] for _, x in first]), [], shards[1].exact
    shards[1].exact = lambda *a: (counts.append(len(a[3])), inner(*a))[1]
    later = list(shards[1].search(cuts, shards[1].places(names), weights, 5, least))
    assert 0 < sum(counts) < 5 * len(asked) / 2
    for (_, x), (found, y), (every, z) in zip(first, later, whole):
        best = lambda *a: np.sort(np.concatenate(a))[::-1][:5].tolist()
        assert set(found) <= set(every) and best(x, y) == best(x, z)


def test_shard_ends_with_its_words(table):
    """Long texts make smaller shards, so that memory does not follow the length of texts."""
    docs = table([(k, "alpha beta " * 1_100_000) for k in range(9)]).coalesce(1)
    sizes = [len(r.ids) for r in search.build_index(docs).collect()]
    assert sizes == [4, 4, 1]


def test_search_of_no_rows_no_queries_and_text_ids(table, spark):
    assert search.search(table([]), F.col("doc_id") % 50 == 0).count() == 0
    docs = table([(k, prose(k, 20)) for k in range(1, 30)])
    assert search.search(docs, F.col("doc_id") < 0).count() == 0
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    got = search.search(named, F.col("doc_id").isin("d3", "d7"), k=2).collect()
    assert {(r.query_id, r.doc_id) for r in got if r["rank"] == 1} == {("d3", "d3"), ("d7", "d7")} and len(got) == 4
