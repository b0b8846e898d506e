"""Quality rules, classifier, language models, personal data."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stormspan.llm import language, passages, personal, rules


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    twice = [k for k, w in enumerate(windows) if windows.count(w) > 1] if len(words) < 3000 else None
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    repeat = len({p for k in twice for p in (k, k + 1, k + 2)}) if twice is not None else None
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeat


def test_counts_equal_plain_ones(spark, folder):
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    texts += [None, "", " \n\t", "a", "é ß\x0bx\x1cy z", "a a a a a", "x\n\nx\n \n \nx", "a b c a b c", "日本 語\n日本 語"]
    for text in texts:
        want, got = base_counts(text), rules.counts(text)[:5]
        assert got[:4] == want[:4]
        assert want[4] is None or got[4] == want[4]


def test_binomial_bound():
    def plain(k, n, p):
        return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))

    for k, n, p in [(0, 10, 0.1), (3, 200, 0.02), (5, 50, 0.3), (50, 50, 0.2)]:
        assert rules.at_most(k, n, p) == pytest.approx(plain(k, n, p), rel=1e-9)
    assert rules.p_value(0, 100, 0.01) > 0.01 >= rules.p_value(0, 1000, 0.01)
    assert rules.p_value(0, 0, 0.5) == 1 and rules.p_value(2, 100, 0.02) == 1


def test_step_down_correction():
    assert rules.holm({0: 0.012, 1: 0.001, 2: 0.024, 3: 0.05}, 0.05) == {0, 1, 2, 3}
    assert rules.holm({0: 0.013, 1: 0.026, 2: 0.04, 3: 0.5}, 0.05) == set()
    assert rules.holm({0: 0.012, 1: 0.02, 2: 0.0001}, 0.05) == {0, 1, 2}
    assert rules.holm({1: 0.03, 0: 0.02}, 0.05) == {0, 1} and rules.holm({}, 0.05) == set()


def test_a_band_loses_no_more_than_the_risk_with_confidence():
    """Shares drawn for good texts: how often a proposed and certified cutoff rejects more than the risk of them."""
    rng = np.random.default_rng(5)
    wrong, used = 0, 0
    for _ in range(400):
        good, bad = rng.gamma(1.0, 8.0, 700).astype(int), rng.integers(30, 200, 150)
        first = Counter([(min(x, 200), 1) for x in good[:60].tolist()] + [(x, 0) for x in bad.tolist()])
        cutoff = rules.propose(first, 0.02)
        lost = int((good[60:] > cutoff).sum())
        if rules.holm({0: rules.p_value(lost, 640, 0.02)}, 0.05):
            used += 1
            true_loss = float(np.mean(rng.gamma(1.0, 8.0, 20_000).astype(int) > cutoff))
            wrong += true_loss > 0.02
    assert used > 40 and wrong <= 0.05 * 400


def test_rules_that_add_nothing_are_left_out():
    patterns = {(0b01, 0): 100, (0b11, 0): 50, (0b10, 0): 5, (0b10, 1): 1, (0, 1): 300}
    assert rules.useful(patterns, 2) == 0b01
    assert rules.useful({(0b1, 0): 10, (0, 1): 5}, 1) == 0 and rules.useful({}, 3) == 0


def test_kept_against_a_plain_choice(spark):
    """On given documents: cutoffs worked out anew in plain Python, and every verdict."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    made = {r["doc_id"]: r for r in rules.apply(docs, labels).collect()}
    marks = {}
    for r in labels.select("doc_id", "quality").collect():
        if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            marks[r["doc_id"]] = max(marks.get(r["doc_id"], 0), int(r["quality"] == 1))
    rows = defaultdict(list)
    for key, r in made.items():
        if not r["base_failed"]:
            words, lines = max(r["n_words"], 1), max(r["n_lines"], 1)
            values = (
                r["n_symbols"] / words, r["n_dup_lines"] / lines, r["n_repeat_words"] / words,
                r["n_loud"] / words, r["n_odd_end"] / words, r["word_chars"] / words / 20,
            )
            steps = [min(math.ceil(v / 0.01), 200) for v in values]
            length = sum(r["n_words"] >= end for end in (100, 300, 1000))
            rows[length].append((key, steps, marks.get(key), zlib.crc32(f"tune{key}".encode()) % 5 == 0))
    plans, tests = {}, {}
    for length, members in rows.items():
        bad = [s for _, s, good, _ in members if good == 0]
        tune = [s for _, s, good, first in members if good == 1 and first]
        rest = [s for _, s, good, first in members if good == 1 and not first]
        if not tune:
            continue
        allowed = int(len(tune) * 0.02 / 12)
        limits = [math.ceil(sorted((s[k] for s in tune), reverse=True)[allowed] * 1.1) + 1 for k in range(6)]
        taken = []
        while True:
            left = [[s for s in side if not any(s[k] > limits[k] for k in taken)] for side in (bad, tune)]
            worth = [sum(s[k] > limits[k] for s in left[0]) - 10 * (sum(s[k] > limits[k] for s in left[1]) + 1) for k in range(6)]
            if max(worth) <= 0:
                break
            taken.append(worth.index(max(worth)))
        if taken:
            plans[length] = [(k, limits[k]) for k in taken]
            lost, size = sum(any(s[k] > limits[k] for k in taken) for s in rest), len(rest)
            tests[length] = sum(math.comb(size, i) * 0.02**i * 0.98 ** (size - i) for i in range(lost + 1))
    held = set()
    for place, (p, length) in enumerate(sorted((p, n) for n, p in tests.items())):
        if p > 0.05 / (len(tests) - place):
            break
        held.add(length)
    assert held
    for length, members in rows.items():
        for key, steps, _, _ in members:
            out = length in held and any(steps[k] > limit for k, limit in plans[length])
            assert made[key]["kept"] == (not out), key
        good = [made[key]["kept"] for key, _, mark, _ in members if mark == 1]
        assert np.mean(good) > 0.98
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    unseen = [(truth[k], made[k]["kept"]) for k in truth if k in made and not made[k]["base_failed"] and truth[k] is not None]
    assert sum(not kept for mark, kept in unseen if mark == 0) > 0.5 * sum(mark == 0 for mark, _ in unseen)
    assert np.mean([kept for mark, kept in unseen if mark == 1]) > 0.98


def labelled(spark, count, seed=1):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "the", "of", "on"]
    docs, labels = [], []
    for k in range(count):
        bad = k % 5 == 0
        text = [rng.choice(words) + str(rng.randrange(10_000)) for _ in range(60 + k % 40)]
        if bad:
            text = [w + "%%%" for w in text]
        docs.append((k, " ".join(text), "x"))
        labels.append((k, 0 if bad else 1))
    return spark.createDataFrame(docs, "doc_id long, text string, n_words string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_reject_the_bad_and_keep_the_good(spark):
    docs, labels = labelled(spark, 4000)
    rows = rules.apply(docs.drop("n_words"), labels, risk=0.05).collect()
    assert all(r["kept"] == (r["doc_id"] % 5 != 0) for r in rows)
    without = rules.apply(docs.drop("n_words"), labels.limit(0)).collect()
    assert all(r["kept"] for r in without)
    few = rules.choose(rules.measured(docs, "doc_id", "text"), labels.filter("doc_id < 40"))
    assert few == {}


def test_rules_of_odd_rows(spark):
    frame = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "w " * 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    rows = rules.apply(frame, labels).collect()
    assert len(rows) == 4 and all(r["base_failed"] and not r["kept"] for r in rows)


def test_classifier(spark):
    docs, labels = labelled(spark, 1500)
    model = passages.fit(docs, labels)
    rows = passages.score(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 200
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] % 5 != 0) for r in held]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_classifier_gradient():
    rng = np.random.default_rng(0)
    model = passages.Attention(np.zeros(5), np.ones(5))
    x, sizes, y = rng.normal(size=(9, 5)), np.array([2, 4, 3]), np.array([0.0, 1.0, 1.0])

    def loss():
        starts = np.cumsum(sizes) - sizes
        out = model.forward(x, starts, np.repeat(np.arange(3), sizes))[-1]
        return -np.mean(y * np.log(out) + (1 - y) * np.log(1 - out))

    grads = model.step(x, sizes, y)
    for name, grad in grads.items():
        value = model.p[name]
        at = tuple(0 for _ in value.shape)
        kept = value[at]
        value[at] = kept + 1e-5
        up = loss()
        value[at] = kept - 1e-5
        down = loss()
        value[at] = kept
        assert grad[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_passages_are_whole_texts():
    text = " ".join(f"w{k}" for k in range(1000))
    x, of = passages.encode([b"", text.encode(), b"one", b" \n"])
    assert list(of) == [1] * 16 + [2]
    alone, _ = passages.encode([text.encode()])
    assert np.allclose(x[:16], alone)
    assert passages.encode([])[0].shape == (0, passages.FEATURES)


def test_classifier_of_odd_rows(spark):
    frame = spark.createDataFrame([(None, None, 1), (1, "", 2), (2, "a b", 3)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = passages.score(frame, passages.fit(frame, none)).collect()
    assert [r["score_"] for r in rows] == [0.0, 0.0, 1.0] and [r["score"] for r in rows] == [1, 2, 3]
    assert passages.score(frame.limit(0), passages.fit(frame.limit(0), none)).count() == 0


def modelled(spark, texts, rare=0.0):
    frame = spark.createDataFrame([(0, t, "x") for t in texts], "doc_id int, text string, lang string")
    assert zlib.crc32(b"0") % 4 != 2
    return language.fit(frame, rare=rare).models["x"]


def plain_model(texts):
    """Kneser-Ney from the definition, over strings: probability of the last character of a string."""
    counts = Counter()
    for text in texts:
        signs = "   " + re.sub(r"[^a-z]+", " ", text).lstrip() + " "
        signs = re.sub(r"(?<=\S) +$", " ", signs)
        counts.update(signs[k : k + 4] for k in range(len(signs) - 3))
    levels = {4: counts}
    for order in (3, 2, 1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])

    def prob(gram):
        order = len(gram)
        if not order:
            return 1 / (len(levels[1]) + 1)
        once, twice = (sum(n == k for n in levels[order].values()) for k in (1, 2))
        cut = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
        same = {g: n for g, n in levels[order].items() if g[:-1] == gram[:-1]}
        if not same:
            return prob(gram[1:])
        total = sum(same.values())
        return max(same.get(gram, 0) - cut, 0) / total + cut * len(same) / total * prob(gram[1:])

    return prob


def as_key(gram):
    return sum(ord(c) << 16 * (len(gram) - 1 - k) for k, c in enumerate(gram))


SENTENCES = ["the cat sat on the mat", "a hat that the rat had", "the end  of, the, tale", "that that is is"]


def test_language_probabilities_equal_plain_ones(spark):
    model, plain = modelled(spark, SENTENCES), plain_model(SENTENCES)
    rng = random.Random(2)
    grams = {"".join(rng.choice("  aehtsxq") for _ in range(4)) for _ in range(300)}
    grams |= {"   t", " the", "hat ", "that", "zzzz"}
    got = model.score(np.array([as_key(g) for g in sorted(grams)], np.uint64))
    assert got == pytest.approx([plain(g) for g in sorted(grams)], rel=1e-6)


@pytest.mark.parametrize("rare", [0.0, 0.03, 0.06, 2.0])
def test_language_probabilities_sum_to_one(spark, rare):
    model, whole = modelled(spark, SENTENCES, rare), modelled(spark, SENTENCES)
    letters = np.unique([ord(c) for c in " ".join(SENTENCES) if c == " " or c.isalpha()]).astype(np.uint64)
    for word in (" th", "zzz", "t t", "  q", "hat"):
        history = np.uint64(as_key(word + "\0"))
        seen = model.score(history | letters).sum()
        assert seen + model.score(np.array([history | np.uint64(ord("@"))]))[0] == pytest.approx(1.0)
    for order in range(1, 5):  # what stays has the probability of the whole model
        kept, all_ = model.prob[order], dict(zip(*map(list, whole.prob[order])))
        assert [all_[h] for h in kept[0]] == pytest.approx(list(kept[1]))
    assert (len(model.prob[4][0]) < len(whole.prob[4][0])) == (rare > 0)


def test_language_discounts_do_not_change_with_pruning(spark):
    """Ten times the text: every n-gram is as frequent, the counts of counts are those of the whole text."""
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("aeionst") for _ in range(rng.randrange(2, 7))) for _ in range(30)) for _ in range(40)]
    few, many = modelled(spark, texts[:4], 1e-3), modelled(spark, texts, 1e-3)
    plain = {4: plain_model(texts[:4]), 40: plain_model(texts)}
    for model, size in ((few, 4), (many, 40)):
        kept = [g for g in (" aei", "nost", "seat", " ton") if language.mix(np.array([as_key(g)], np.uint64))[0] in model.prob[4][0]]
        got = model.score(np.array([as_key(g) for g in kept], np.uint64))
        assert got == pytest.approx([plain[size](g) for g in kept], rel=1e-6)


def test_long_texts_go_in_pieces(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab  .é") for _ in range(n)) for n in (0, 1, 3, 40, 64, 65, 128, 500, 7, 31, 33)] + [" " * 200, "." * 64]
    want = [np.sort(language.ngrams([t])[0]) for t in texts]
    monkeypatch.setattr(language, "CHUNK", 32)
    found = [[] for _ in texts]
    for grams, of in language.pieces(texts):
        for k in set(of.tolist()):
            found[k].append(grams[of == k])
    for got, plain in zip(found, want):
        assert np.array_equal(np.sort(np.concatenate([np.empty(0, np.uint64), *got])), plain)


def test_language_held_out(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet")
    model = language.fit(docs)
    rows = [r for r in language.identify(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
    assert np.mean([r["rejected"] for r in rows]) < 0.02


def test_language_of_odd_rows(spark):
    frame = spark.createDataFrame(
        [(0, "der hund und die katze", "de", 1), (1, "the dog and the cat", "en", 2), (2, None, None, 3), (3, "123 ..", "en", 4), (4, "", "de", 5), (5, "a", None, 6)] * 2,
        "doc_id long, text string, lang string, score int",
    )
    got = language.identify(frame, language.fit(frame.withColumn("doc_id", frame.doc_id * 0))).collect()
    assert [r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 4)] == ["und"] * 6
    assert all(r["rejected"] and r["score_"] == 0 for r in got if r["doc_id"] in (2, 3, 4))
    empty = frame.limit(0)
    assert language.identify(empty, language.fit(empty)).count() == 0
    unlearned = language.identify(frame, language.fit(empty)).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    twice = [int(c) * 2 for c in number[-2::-2]]
    return (sum(int(c) for c in number[::-2]) + sum(t - 9 if t > 9 else t for t in twice)) % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(number) <= 19 and luhn(number) if kind == "card" else False,
                "phone": 9 <= len(number) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def check_spans(spark, texts):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in personal.find(frame).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        want = plain_spans(text)
        assert got[k]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, want, got[k])
        kept = [s for s in got[k]["spans"].split(",") if s and not s.startswith("other")]
        assert kept == want
        for kind in PLAIN:
            assert got[k][f"n_{kind}"] == sum(s.startswith(kind) for s in want)


def test_spans_of_documents(spark, folder):
    check_spans(spark, [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])


def test_spans_of_random_texts(spark, rng):
    signs = ["a", "B.", "é", "@", "@x.", ".", "-", "_", " ", "+", "+1", "1", "23", "255", "256", ".1", "4111 1111 1111 1111", "(", ")", "\n", "🙂", "x@y.z", "1.2.3.4"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += [None, "", "a@b.c_d@e.f", "a@b..c", "a@b.c.", "000.001.02.3", "1.2.3.4.5.6.7.8", "4111-1111-1111-1111 4111111111111112", "+1 (755) 555-9729", "+1+23456789012"]
    check_spans(spark, texts)


def test_long_runs_end(spark):
    """Texts on which a pattern with nested repeats would take quadratic time or overflow."""
    size = 100_000
    texts = ["1" * size, "a" * size, "a@" + "b." * size + "c", "1." * size, "4 " * size, "+1" * size, "x " * size + "a@b.cc"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in personal.find(frame).collect()}
    assert [got[k]["n_email"] for k in range(7)] == [0, 0, 1, 0, 0, 0, 1]
    assert [got[k]["n_ip"] for k in range(7)] == [0, 0, 0, size // 4, 0, 0, 0]
    assert not any(got[k][n] for k in range(7) for n in ("n_card", "n_phone"))
    long = spark.createDataFrame([("é 1.2.3.4 " * 20_000 + "x",)], "text string")
    assert personal.mask(long).first()["text"] == "é [IP] " * 20_000 + "x"


def test_added_spans_and_masks(spark):
    rng = random.Random(3)
    number = lambda: f"{rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    texts = [f"please call phone: {number()} now" for _ in range(60)] + [f"version {rng.randrange(10**7, 10**8)} of it" for _ in range(60)]
    texts += ["mail é a.b@c.de, then +49 30 1234567.", "no data", None, "", "4111111111111111a@b.cd"]
    frame = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id int, text string, spans string")
    got = [r["n_other"] for r in personal.find(frame.drop("spans")).orderBy("doc_id").collect()]
    assert sum(got[:60]) >= 55 and sum(got[60:120]) == 0
    out = personal.mask(frame).orderBy("doc_id").collect()
    assert out[120]["text"] == "mail é [EMAIL], then [PHONE]." and out[121]["text"] == "no data"
    assert out[122]["text"] is None and out[123]["text"] == "" and out[124]["text"] == "[EMAIL]"
    assert [len(out), *out[0].asDict()] == [len(texts), "doc_id", "text", "spans"]
    assert personal.find(frame.limit(0).drop("spans")).count() == 0


def test_secrets_are_added_and_names_of_files_are_not(spark):
    """Planted tokens, handles and look-alikes: precision and recall of the added spans."""
    rng = random.Random(8)
    token = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    leads = ["token = \"", "my secret: ", "password is ", "Bearer ", "api_key=", "access-key: '"]
    good = [f"é und {rng.choice(leads)}{token()}\" so on" for _ in range(80)]
    bad = [f"see chapter-{k}-of-the-long-book and commit {token()} there" for k in range(60)]
    bad += [f"in the file quarterly_report_final_{k} we @param said" for k in range(60)]
    frame = spark.createDataFrame(list(enumerate(good + bad)), "doc_id int, text string")
    rows = {r["doc_id"]: r for r in personal.find(frame).collect()}
    caught = [rows[k]["n_other"] for k in range(len(good))]
    wrong = [rows[k]["n_other"] for k in range(len(good), len(good + bad))]
    assert np.mean([n == 1 for n in caught]) >= 0.95 and sum(wrong) <= 0.05 * sum(caught)
    for k in range(len(good)):
        for start, end in (map(int, s.split(":")[1:]) for s in rows[k]["spans"].split(",") if s.startswith("other")):
            assert re.fullmatch("[0-9a-f]{40}", good[k][start:end])


def test_tokens_do_not_vouch_for_numbers(spark):
    """Many tokens beside numbers that fail their check digit: the numbers stay."""
    rng = random.Random(12)
    texts = [f'x token = "{rng.getrandbits(160):040x}" y' for _ in range(100)]
    numbers = [str(rng.randrange(10**15, 10**16)) for _ in range(80)]
    texts += [f"the {n} of" for n in numbers if not luhn(n)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r["n_other"] for r in personal.find(frame).orderBy("doc_id").collect()]
    assert sum(got[:100]) >= 97 and sum(got[100:]) == 0


def test_masking_keeps_columns_of_any_name(spark):
    frame = spark.createDataFrame([("a@b.cd", 1, 2, 3, 4)], "text string, __spans int, __wide int, __ends int, __every int")
    assert tuple(personal.mask(frame).first()) == ("[EMAIL]", 1, 2, 3, 4)


def test_agreement_finds_a_labeler_worse_than_chance():
    rng = random.Random(1)
    counts = {}
    for _ in range(5000):
        truth = rng.random() < 0.5
        vote = [0] * len(personal.LABELERS)
        for k, right in enumerate((0.9, 0.9, 0.9, 0.25)):
            vote[k] = (1 if truth else -1) * (1 if rng.random() < right else -1)
        counts[tuple(vote)] = counts.get(tuple(vote), 0) + 1
    likely = personal.agreement(counts)
    pad = (0,) * (len(personal.LABELERS) - 4)
    assert likely[(1, 1, -1, -1, *pad)] > likely[(1, 1, -1, 1, *pad)] > 0.5


def test_agreement_finds_the_unreliable_labeler():
    rng = random.Random(0)
    counts = {}
    for _ in range(5000):
        truth = rng.random() < 0.4
        vote = [0] * len(personal.LABELERS)
        for k, right in enumerate((0.9, 0.9, 0.85, 0.6)):
            vote[k] = (1 if truth else -1) * (1 if rng.random() < right else -1)
        counts[tuple(vote)] = counts.get(tuple(vote), 0) + 1
    likely = personal.agreement(counts)
    pad = (0,) * (len(personal.LABELERS) - 4)
    assert likely[(1, 1, 1, -1, *pad)] > 0.9 and likely[(-1, -1, -1, 1, *pad)] < 0.1
