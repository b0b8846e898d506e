"""Periodic runs against a brute-force search over all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from stormspan.llm import periodic, queries


def plain_runs(words):
    """Every maximal stretch per lag, then those whose lag is their smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        start = None
        for i in range(n - q + 1):
            same = i + q < n and words[i] == words[i + q]
            if same and start is None:
                start = i
            elif not same and start is not None:
                place = (start, i + q)
                if i + q - start >= max(24, 3 * q) and place not in best:
                    best[place] = q
                start = None
    return sorted((s, e - s, q) for (s, e), q in best.items())


def sequences(seed, count, longest):
    rng = random.Random(seed)
    for k in range(count):
        letters = rng.choice([1, 2, 3, 5, 40, 5000])
        words = []
        while len(words) < rng.randrange(longest):
            period = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 31, 33, 63, 64, 65, 100, 128, 200]))]
            if rng.random() < 0.4 and len(period) > 8:  # a period with a run inside
                period[2 : len(period) // 2] = [7] * (len(period) // 2 - 2)
            if rng.random() < 0.3 and len(period) > 20:  # a period nearly a power
                period[len(period) // 2 :] = period[: len(period) - len(period) // 2]
                period[-1] = -5 + k
            words += period * rng.randrange(1, 6) + period[: rng.randrange(len(period) + 1)]
            if rng.random() < 0.3:
                words += [rng.randrange(letters) for _ in range(rng.randrange(40))]
        yield words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    made = list(sequences(seed, 40, 900))
    got = periodic.find_runs([np.array(w, np.int64) + 10 for w in made])
    for words, runs in zip(made, got):
        assert runs == plain_runs(words)


def test_long_periods_and_one_word():
    rng = random.Random(9)
    body = [rng.randrange(50) for _ in range(3000)]
    inner = body[:1500] + [3] * 400 + body[1500:]
    for words in (body * 3 + body[:17], inner * 4, [1] * 5000, ([1] * 99 + [2]) * 40, [1, 2] * 3000 + body * 3):
        runs = periodic.find_runs([np.array(words)])[0]
        assert all(words[s + q : s + n] == words[s : s + n - q] for s, n, q in runs)
    assert (0, 9017, 3000) in periodic.find_runs([np.array(body * 3 + body[:17])])[0]
    assert (0, 13600, 3400) in periodic.find_runs([np.array(inner * 4)])[0]
    assert periodic.find_runs([np.array([1] * 5000)]) == [[(0, 5000, 1)]]
    assert (0, 4000, 100) in periodic.find_runs([np.array(([1] * 99 + [2]) * 40)])[0]


def test_hash_collisions_do_not_decide(monkeypatch):
    """With hashes of few bits the word by word comparison still gives the exact runs."""
    whole = periodic.mixed
    monkeypatch.setattr(periodic, "mixed", lambda values: whole(values) & np.uint64(3))
    for words in sequences(5, 10, 500):
        assert periodic.find_runs([np.array(words, np.int64) + 10])[0] == plain_runs(words)


def test_edges(spark):
    long = " ".join(["x y z"] * 20_000)
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", "c"), (4, "a " * 24, "d"), (4, "a " * 24, "d"), (None, "a " * 23, "e"), (6, long, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {(r["doc_id"], r["n_words"]): r for r in periodic.find(docs).collect()}
    assert periodic.find(docs).count() == 7
    assert got[1, 0]["runs"] == [] and got[1, 0]["strongest"] is None and got[1, 0]["collapsed"] == ""
    assert got[3, 0]["collapsed"] == ""
    assert tuple(got[4, 24]["strongest"]) == (0, 24, 1) and got[4, 24]["collapsed"] == "a"
    assert got[None, 23]["runs"] == []
    assert tuple(got[6, 60_000]["strongest"]) == (0, 60_000, 3) and got[6, 60_000]["collapsed"] == "x y z"
    assert periodic.find(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in queries.op13_periodic_runs(spark, folder).collect():
        words = (texts[row["doc_id"]] or "").encode().split()
        h = zlib.crc32(str(row["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 1500:
            continue  # too slow for the plain search
        runs = plain_runs(words)
        assert row["n_runs"] == len(runs)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
        left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row["collapsed_sha256"] == hashlib.sha256(left).hexdigest()
        if runs:
            s, k, q = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (s, k, q, 1000 * k // q)
        else:
            assert row["start"] is row["length"] is row["period"] is row["exponent_milli"] is None
