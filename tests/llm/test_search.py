"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from stormspan.llm import queries, search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERMS.findall(lower)


def plain_search(docs, items, best=20):
    counted = [(k, Counter(plain_terms(t))) for k, t in docs]
    counted = [(k, c) for k, c in counted if c]
    n_docs, n_words = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for place, (k, c) in enumerate(counted):
            m = 75 + (25 * sum(c.values()) * n_docs) // n_words
            score = 0
            for t in plain_terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score:
                scores.append((-score, k is None, k or 0, k))
        out += [(item, r + 1, k, -s) for r, (s, _, _, k) in enumerate(sorted(scores, key=lambda x: x[:3])[:best])]
    return out


def made(rng, docs, words):
    vocabulary = [f"w{k}" for k in range(300)]
    share = [1 / (k + 1) for k in range(300)]
    return [(d, " ".join(rng.choices(vocabulary, share, k=rng.randrange(words)))) for d in range(docs)]


def shown(frame):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect()), key=repr)


def test_every_rank_equals_plain_scoring(spark, rng):
    docs = made(rng, 300, 60) + [(900 + k, "w250 w251 W252 w5.w5-w5") for k in range(40)]
    items = made(rng, 25, 25) + [(500, "w250 w250 w251 w252 w5"), (501, "unknown"), (502, "w0 w0 w0")]
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(plain_search(docs, items), key=repr)
    assert shown(search.search(a, b, shard=700)) == want
    assert shown(search.search(a, b, queries=4)) == want


def test_edges(spark):
    docs = [(1, None, "x"), (2, "", "x"), (3, " .,;", "x"), (4, "Äb äb ÄB q", "x"), (5, "q q", "x"), (5, "q q", "x"),
            (None, "q q", "x"), (6, "q" * 100_000 + " q", "x"), (7, "\x00q\x7fq\u0080q", "x"), (8, "long " * 50_000, "x")]
    items = [(1, "Q", "d"), (1, "Q", "d"), (2, None, "d"), (3, "", "d"), (4, "ÄB äb", "d"), (None, "long", "d"), (6, "q\u0080q Q", "d")]
    a = spark.createDataFrame(docs, "doc_id long, text string, rank string")
    b = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    got = shown(search.search(a, b))
    assert got == sorted(plain_search([d[:2] for d in docs], [i[:2] for i in items]), key=repr)
    assert search.search(a.limit(0), b).count() == 0
    assert search.search(a, b.limit(0)).count() == 0
    strings = search.search(a.withColumn("doc_id", a.doc_id.cast("string")), b)
    assert [r for r in shown(strings) if r[0] == 4] == [(4, 1, "4", next(r[3] for r in got if r[0] == 4))]


def test_pair_bounds_touch_less(spark, folder):
    """The same ranks from fewer list entries than independent maxima need."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = spark.read.parquet(f"{folder}/benchmark.parquet").limit(40).collect()
    index = search.build(documents)
    asked = [Counter(search.terms(r["text"].encode())) for r in rows]
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*asked)))}
    holding = {bytes(r["term"]): r["holding"] for r in index.dictionary.collect()}
    weights = [search.weight(index.documents, holding.get(t, 0)) for t in vocabulary]
    asked = [search.Query(n, sorted(((vocabulary[t], c) for t, c in a.items()), key=lambda x: (-weights[x[0]], x[0]))) for n, a in enumerate(asked)]
    prepared = search.prepare(index, vocabulary, weights, search.neighbours(asked)).toArrow().to_batches()
    read = {True: [], False: []}
    for batch in prepared:
        for k in range(batch.num_rows):
            shard = search.lists_of([c[k].values for c in batch.columns])
            for query in asked:
                tight, loose = (search.combined(query, shard, paired)[1] for paired in (True, False))
                assert all(a <= b for a, b in zip(tight, loose)) and len(tight) == len(loose)
                found = []
                for paired in (True, False):
                    scores, at = search.best_of(query, shard, 3, 1, paired, read[paired])
                    found.append(sorted(zip(scores.tolist(), at.tolist()), reverse=True))
                assert found[0] == found[1]
    assert 0 < sum(read[True]) < sum(read[False])


def test_bounds_hold_for_every_document(spark, rng):
    """No document scores more than the bounds of the units whose terms it holds."""
    docs = made(rng, 200, 40)
    index = search.build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    query = search.Query(0, [(0, 1), (1, 3), (2, 2), (3, 1)])
    row = search.prepare(index, {b"w3": 0, b"w9": 1, b"w1": 2, b"w40": 3}, [700, 500, 300, 900], search.neighbours([query])).toArrow().to_batches()[0]
    shard = search.lists_of([c[0].values for c in row.columns])
    made_units = search.units(search.combined(query, shard)[2], 4)
    assert sorted(t for u in made_units for t in u.terms) == query.terms
    for unit in made_units:
        scores = np.zeros(len(shard.keys), np.int64)
        for term, times in unit.terms:
            scores[shard.lists[term][0]] += times * shard.lists[term][1]
        assert scores.max() <= unit.bound
        if unit.both is not None:
            scores[unit.both] = 0
            assert scores.max() <= unit.alone


def test_packed_lists_come_back():
    for values in ([], [0], [255, 0], [256, 1], [65536], [1 << 32], [-3, 70000]):
        parts = [np.array(values, np.int64), np.array([], np.int32), np.array(values[:1], np.int64)]
        row = search.packed(parts)
        assert len(row) == 1
        assert search.unpacked(row[0].values, "i8").tolist() == values + values[:1]
    assert search.unpacked(search.packed([])[0].values, "i4").tolist() == []


def test_shards_travel_small(spark, rng):
    """Executors hold whole shards; their rows take less than half the bytes of plain numbers."""
    index = search.build(spark.createDataFrame(made(rng, 2000, 120), "doc_id long, text string").coalesce(1))
    row = index.shards.select("holding", "docs", "times").toArrow().to_batches()[0]
    entries = sum(row["holding"].to_pylist()[0])
    assert entries > 30_000
    assert row["docs"].nbytes + row["times"].nbytes < 3 * entries
    vocabulary = {f"w{k}".encode(): k for k in range(60)}
    pairs = [(k, k + 1) for k in range(59)]
    row = search.prepare(index, vocabulary, [1000 + k for k in range(60)], pairs).toArrow().to_batches()[0]
    lists = search.lists_of([c[0].values for c in row.columns])
    listed, met = sum(len(d) for d, _ in lists.lists.values()), sum(len(d) for d, _ in lists.pairs.values())
    assert listed > 20_000 and met > 5_000
    assert sum(row[c].nbytes for c in ("docs", "impacts", "both")) < 0.5 * (12 * listed + 4 * met)


def test_query_equals_plain_scoring(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert shown(queries.op11_lexical_search(spark, folder)) == sorted(plain_search(docs, items), key=repr)
