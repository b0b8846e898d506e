"""SimHash and embedding near-duplicates against brute force."""

import math
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stormspan.llm import embeddings, shared, simhash


def plain_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(keys, linked):
    """{key: smallest key reachable}, by plain search."""
    out = {}
    for key in sorted(keys):
        if key in out:
            continue
        todo = [key]
        while todo:
            at = todo.pop()
            if at not in out:
                out[at] = key
                todo += linked.get(at, ())
    return out


def by_hand(rows):
    prints = {}
    for key, text in rows:
        prints.setdefault(key, set()).add(plain_fingerprint(text))
    links = {a: [b for b in prints if any((x ^ y).bit_count() <= 2 for x in prints[a] for y in prints[b])] for a in prints}
    return {k: next(iter(v)) for k, v in prints.items()}, closed(prints, links)


def test_documents_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints, roots = by_hand(rows)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == roots[r["doc_id"]]


def test_odd_texts(spark):
    rows = [(9, None), (4, ""), (7, " \t\n"), (1, "one"), (2, "ONE"), (3, "one two"), (3, "one two"), (5, "É é"), (None, "one"), (8, "x " * 50_000)]
    frame = spark.createDataFrame([(k, t, "c", 0) for k, t in rows], "doc_id long, text string, fingerprint string, fp int")
    got = simhash.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: r for r in got}
    assert of[9]["component_id"] == of[7]["component_id"] == 4 and of[9]["fingerprint"] == "0" * 16
    assert of[2]["component_id"] == of[None]["component_id"] == 1
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted({r["doc_id"] for r in got if r["doc_id"] == r["component_id"]} | {-1})


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    rows = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(rows).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_anchors_miss_no_near_pair(rng, distance):
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), distance):
            b ^= 1 << bit
        one, two = (set(simhash.anchors(np.array([v], np.uint64), distance // 2)[0].tolist()) for v in (a, b))
        assert one & two


def test_chains_and_hot_anchors(spark, rng):
    """A long chain, each link two bits on, and a cloud, in blocks much smaller than an anchor."""
    values, at = [], 0
    for k in range(0, 60, 2):
        at ^= 3 << k
        values.append(at)
    centre = 0xDEADBEEF12345678
    values += [centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.linked(frame, block=16)
    roots = {r["node"]: r["root"] for r in shared.components(edges, "a", "b").collect()}
    mask = (1 << 64) - 1
    links = {a: [b for b in values if ((a ^ b) & mask).bit_count() <= 2] for a in values}
    assert {v: roots.get(v, v) for v in values} == closed(values, links)


def test_components_of_random_graphs(spark, rng):
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + k, 1001 + k) for k in range(60)]
    links = {}
    for a, b in edges:
        links.setdefault(a, []).append(b)
        links.setdefault(b, []).append(a)
    want = closed(links, links)
    got = shared.components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert {r["node"]: r["root"] for r in got} == {k: v for k, v in want.items() if k != v}


def brute(rows):
    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))

    good = [(k, [float(x) for x in v]) for k, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: [m for m, w in good if m != k and len(v) == len(w) and cosine(v, w) >= 0.95] for k, v in good}
    roots = closed([k for k, _ in rows], links)
    return {k: (len(links.get(k, ())), roots[k]) for k, _ in rows}


def test_embeddings_equal_brute_force(spark, rng):
    points = np.random.default_rng(3)
    rows = []
    for k in range(120):
        base = points.normal(size=32)
        for m in range(rng.choice([1, 1, 2, 6])):
            rows.append((len(rows) * 3, [float(x) for x in base + 0.1 * m * points.normal(size=32)]))
    rows += [(5000 + k, rows[7][1]) for k in range(40)]
    rows += [(6000, None), (6001, [0.0] * 32), (6002, [float("nan")] * 32), (6003, [None] + [1.0] * 31), (6004, []), (6005, [1.0, 2.0]), (6006, [2.0, 4.0]), (6007, [float("inf")] * 32)]
    frame = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, links int")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame, block=8).collect()}
    want = brute(rows)
    found = sum(r["n_links"] for r in got.values())
    assert set(got) == set(want)
    assert found >= 0.98 * sum(n for n, _ in want.values())
    assert all(got[k]["n_links"] <= n for k, (n, _) in want.items())
    same = sum(got[k]["component_id"] == c for k, (_, c) in want.items())
    assert same >= 0.98 * len(rows)
    assert all(got[k]["kept"] == (k == got[k]["component_id"]) for k in got)
    for k in (6000, 6001, 6002, 6003, 6004, 6007):
        assert (got[k]["n_links"], got[k]["component_id"]) == (0, k)
    assert got[6006]["component_id"] == 6005


def test_recall_on_given_vectors(spark, folder):
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    want = brute(rows)
    got = embeddings.near_duplicates(frame).agg(F.sum("n_links")).first()[0]
    assert got >= 0.9 * sum(n for n, _ in want.values())


def test_repeated_ids_of_vectors(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = embeddings.near_duplicates(frame).collect()
    assert [(r["n_links"], r["component_id"]) for r in rows] == [(2, 1)] * 3


def test_scratch_folders_are_shared_on_a_cluster(spark):
    from types import SimpleNamespace

    from stormspan.llm import shared

    def session(master, given=None, checkpoints=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoints)
        return SimpleNamespace(conf={"spark.checkpoint.dir": given} if given else {}, sparkContext=context)

    assert shared.scratch(session("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/stormspan-")
    assert shared.scratch(session("yarn", None, "hdfs:///kept/x")).startswith("hdfs:///kept/x/stormspan-")
    assert shared.scratch(session("local[4]")).startswith("file:///")
    for master in ("yarn", "local-cluster[2,1,1024]", "k8s://host", "spark://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared.scratch(session(master))
