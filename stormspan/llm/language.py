"""Language identification with interpolated Kneser-Ney character models.

Texts become lower-case letters with single spaces between words.  N-grams of the highest order
are counted over all rows that may be learned from; the continuation counts of the lower orders,
the counts of counts that set the discounts, and the interpolated probabilities are made of all
of them, as joins and windows over the n-grams.  Each language keeps its probabilities in arrays
sorted by a hash of the n-gram.

Only then may n-grams go: those that make up less than ``rare`` of a language's text are left
out of its arrays, so an order never has more than 1 / ``rare`` of them, and their probability
goes to the back-off weight of their history, which makes every distribution sum to one again.
The probabilities that stay are those of the whole model, whatever the size of the corpus.  With
``rare`` 0 every n-gram stays, and the arrays grow with the number of different ones.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import fold as key_fold
from .shared import free_name, held_out, spill

ORDER = 4
#: Least share of a language's characters that an n-gram in its arrays ends.
RARE = 2.0**-21
#: A document is rejected above this multiple of what all but one in a thousand documents
#: of its language and length cost.
SLACK = 1.15
QUANTILE = 0.999
UNKNOWN = "und"
#: Characters handled at once, of one long text or of several; a character takes about a hundred
#: bytes meanwhile.
CHUNK = 1 << 18
#: N-grams that a counting task holds per language before it hands them on.
HELD = 1_000_000
#: Least share of a distribution that is left to what it does not hold.
TINY = 1e-12
SHARPNESS = (0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0)


@lru_cache
def folding() -> np.ndarray:
    """Per code point: 32, or its lower-case letter or mark in 16 bits.  Letters beyond 16 bits
    share the 2048 values of the surrogates, which no text holds."""
    out = np.full(0x110000, 32, np.uint16)
    for point in range(0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        sign = chr(point)
        if sign.isalpha() or unicodedata.category(sign)[0] == "M":
            low = ord(sign.lower()[0])
            out[point] = low if low < 0x10000 else 0xD800 + (low & 0x7FF)
    return out


def mix(keys: np.ndarray) -> np.ndarray:
    """An invertible hash of 64 bits, so that equal hashes are equal n-grams."""
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return keys ^ (keys >> np.uint64(33))


def single(signs: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Where to keep signs: not a blank behind a blank, unless ``kept`` says so."""
    blank = signs == 32
    keep = np.ones(len(signs), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return keep | kept


def packed(signs: np.ndarray) -> np.ndarray:
    """Four signs of 16 bits each, from every place on that has four."""
    signs = signs.astype(np.uint64)
    return (signs[:-3] << np.uint64(48)) | (signs[1:-2] << np.uint64(32)) | (signs[2:-1] << np.uint64(16)) | signs[3:]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of the texts (four characters of 16 bits) and the text of each."""
    lengths = np.array([len(t) + 4 for t in texts], np.int64)
    of = np.repeat(np.arange(len(texts)), lengths)
    starts = np.cumsum(lengths) - lengths
    signs = folding()[points("".join(f"   {t} " for t in texts))]
    lead = np.zeros(len(signs), bool)
    for k in range(3):
        lead[starts + k] = True
    keep = single(signs, lead)
    signs, of = signs[keep], of[keep]
    if len(signs) < ORDER:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    whole = of[:-3] == of[3:]
    return packed(signs)[whole], of[3:][whole]


def long_ngrams(text: str) -> Iterator[np.ndarray]:
    """N-grams of one text, CHUNK characters at a time; the last signs of a piece lead the next."""
    carry = np.full(ORDER - 1, 32, np.uint16)
    lead = np.arange(CHUNK + ORDER) < ORDER - 1
    for start in range(0, len(text) + 1, CHUNK):
        piece = text[start : start + CHUNK] + (" " if start + CHUNK > len(text) else "")
        signs = np.concatenate([carry, folding()[points(piece)]])
        signs = signs[single(signs, lead[: len(signs)])]
        if len(signs) >= ORDER:
            yield packed(signs)
        carry = signs[-(ORDER - 1) :]


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams of the texts and the text of each, in pieces of about CHUNK characters.  A text
    longer than that is several pieces, of itself alone."""
    start, size = 0, 0
    for k, text in enumerate([*texts, None]):
        alone = text is not None and len(text) > CHUNK
        if (text is None or alone or size >= CHUNK) and start < k:
            grams, of = ngrams(texts[start:k])
            yield grams, start + of
        if text is None or alone or size >= CHUNK:
            start, size = k, 0
        if alone:
            for grams in long_ngrams(text):
                yield grams, np.full(len(grams), k)
            start = k + 1
        elif text is not None:
            size += len(text)


def counted(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): n-grams of the highest order, summed over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for lang_ in set(langs):
                own = [texts[k] for k in np.flatnonzero(langs == lang_)]
                for found, _ in pieces(own):
                    grams, many = np.unique(found, return_counts=True)
                    if lang_ in held:
                        keys = np.concatenate([held[lang_][0], grams])
                        sums = np.concatenate([held[lang_][1], many])
                        grams, where = np.unique(keys, return_inverse=True)
                        many = np.bincount(where, sums).astype(np.int64)
                    if len(grams) > HELD:
                        yield out(lang_, grams, many)
                        grams, many = grams[:0], many[:0]
                    held[lang_] = (grams, many)
        for lang_, (grams, many) in held.items():
            yield out(lang_, grams, many)

    def out(lang_: str, grams: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        names = pa.array([lang_] * len(grams), pa.string())
        return pa.RecordBatch.from_arrays([names, pa.array(grams.view(np.int64)), pa.array(many)], ["lang", "gram", "n"])

    sums = docs.select(text, lang).mapInArrow(run, "lang string, gram long, n long")
    return sums.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def suffix(order: int) -> int:
    """The bits of the last ``order`` characters."""
    return (1 << 16 * order) - 1


def probabilities(sums: DataFrame) -> DataFrame:
    """(lang, order, gram, prob, raw): interpolated Kneser-Ney probabilities of every n-gram of
    every order, and how often it ends at a place of the text.

    The highest order has its own counts; a lower one counts the different characters before an
    n-gram.  A discount is once / (once + 2 twice) of a language's counts of an order, between
    0.05 and 0.95.  Only those counts of counts (one row per language and order) are collected.
    The n-grams of one history are at most as many as there are characters, so a window holds
    them.
    """
    spark = sums.sparkSession
    level = {ORDER: sums.select("lang", "gram", "n", F.col("n").alias("raw"))}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit(suffix(order))).alias("gram")
        counted_ = level[order + 1].select("lang", shorter, "raw").groupBy("lang", "gram")
        level[order] = spill(counted_.agg(F.count("*").alias("n"), F.sum("raw").alias("raw")))
    made: list[DataFrame] = []
    for order in range(1, ORDER + 1):
        counts = level[order].groupBy("lang").agg(
            F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"), F.count("*").alias("size")
        )
        cuts = [
            (r["lang"], min(0.95, max(0.05, r["once"] / max(1.0, r["once"] + 2.0 * r["twice"]))), 1.0 / (r["size"] + 1))
            for r in counts.collect()
        ]
        cut = spark.createDataFrame(cuts, "lang string, cut double, least double")
        same = Window.partitionBy("lang", F.shiftrightunsigned("gram", 16))
        here = level[order].withColumn("total", F.sum("n").over(same)).withColumn("kinds", F.count("*").over(same))
        here = here.join(cut, "lang")
        if order > 1:
            lower = made[-1].select("lang", F.col("gram").alias("short"), F.col("prob").alias("least"))
            here = here.drop("least").withColumn("short", F.col("gram").bitwiseAND(F.lit(suffix(order - 1))))
            here = here.join(lower, ["lang", "short"])
        own = F.greatest(F.col("n") - F.col("cut"), F.lit(0.0)) / F.col("total")
        weight = F.col("cut") * F.col("kinds") / F.col("total")
        here = here.select("lang", F.lit(order).alias("order"), "gram", (own + weight * F.col("least")).alias("prob"), "raw")
        made.append(spill(here) if order < ORDER else here)
    return reduce(DataFrame.union, made)


class KneserNey:
    """One language: per order, hashes in sorted order with probabilities, and per history the
    weight of the next lower order, which is what the n-grams at hand leave to the others."""

    def __init__(self, tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.prob: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.back: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.floor = max(TINY, 1.0 - float(tables[1][1].sum()))
        for order in range(1, ORDER + 1):
            keys, prob = tables.get(order, (np.empty(0, np.uint64), np.empty(0)))
            if order > 1:
                history, index = np.unique(keys >> np.uint64(16), return_inverse=True)
                lower = self.score(keys & np.uint64(suffix(order - 1)), order - 1)
                left, below = (np.maximum(TINY, 1.0 - np.bincount(index, p, len(history))) for p in (prob, lower))
                self.back[order] = self.laid(history, left / below)
            self.prob[order] = self.laid(keys, prob)

    @staticmethod
    def laid(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = mix(keys)
        by = np.argsort(hashes)
        return hashes[by], values[by]

    @staticmethod
    def found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, other: float) -> np.ndarray:
        if not len(table[0]):
            return np.full(len(keys), other)
        hashes = mix(keys)
        at = np.minimum(np.searchsorted(table[0], hashes), len(table[0]) - 1)
        return np.where(table[0][at] == hashes, table[1][at], other)

    def score(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Probability of each n-gram's last character after the others."""
        prob = self.found(self.prob[order], keys, -1.0)
        miss = np.flatnonzero(prob < 0)
        if len(miss):
            left = keys[miss]
            if order == 1:
                prob[miss] = self.floor
            else:
                weight = self.found(self.back[order], left >> np.uint64(16), 1.0)
                prob[miss] = weight * self.score(left & np.uint64(suffix(order - 1)), order - 1)
        return prob


class Languages:
    """All languages, and the calibration of score and rejection."""

    def __init__(self, models: dict[str, KneserNey]):
        self.names, self.models = sorted(models), models
        self.sharpness, self.limits = 10.0, {}

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character (texts x languages), and the number of characters.  A piece's
        different n-grams are looked up once per language."""
        bits, sizes = np.zeros((len(texts), len(self.names))), np.zeros(len(texts), np.int64)
        for grams, of in pieces(texts):
            if not len(grams):
                continue
            kinds, where = np.unique(grams, return_inverse=True)
            first = np.flatnonzero(np.diff(of, prepend=-1))
            for k, name in enumerate(self.names):
                bits[of[first], k] -= np.add.reduceat(np.log2(self.models[name].score(kinds))[where], first)
            sizes[of[first]] += np.diff(first, append=len(of))
        return bits / np.maximum(sizes, 1)[:, None], sizes

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: language, score, least cost, n-grams, rejected."""
        count = len(texts)
        letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        if not self.names:
            return [UNKNOWN] * count, np.zeros(count), np.zeros(count), np.zeros(count, np.int64), np.ones(count, bool)
        cost, sizes = self.costs(texts)
        best = cost.argmin(axis=1)
        least = cost[np.arange(count), best]
        share = np.exp(-self.sharpness * (cost - least[:, None]))
        score = np.where(letters, 1.0 / share.sum(axis=1), 0.0)
        names = [self.names[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
        band = bands(sizes)
        limit = np.array([self.limits.get((n, int(b)), self.limits.get((n, -1), np.inf)) for n, b in zip(names, band)])
        return names, score, least, sizes, ~letters | (least > limit)


def bands(sizes: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(sizes, 1)).astype(np.int64)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rare: float = RARE) -> Languages:
    """Models from the rows with a text, a language and a key whose fold is not 2; folds 0 and
    1 are counted, fold 3 calibrates the score and the rejection (all of it, as aggregates).
    The arrays hold at most 1 / ``rare`` n-grams per language and order (16 bytes each); no
    learnable row, no language."""
    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(F.col(key)))
    sums = spill(counted(known.filter(key_fold(F.col(key)) != 3), text, lang))
    total = sums.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = probabilities(sums).join(total, "lang").filter((F.col("order") == 1) | (F.col("raw") >= rare * F.col("total")))
    table = kept.select("lang", "order", "gram", "prob").toArrow()
    names = table.column("lang").to_numpy(zero_copy_only=False)
    orders, grams = table.column("order").to_numpy(), table.column("gram").to_numpy().view(np.uint64)
    prob = table.column("prob").to_numpy()
    by = {(n, k): np.flatnonzero((names == n) & (orders == k)) for n in sorted(set(names)) for k in range(1, ORDER + 1)}
    models = {n: KneserNey({k: (grams[by[n, k]], prob[by[n, k]]) for k in range(1, ORDER + 1)}) for n in sorted(set(names))}
    made = Languages(models)
    if models:
        calibrate(made, known.filter(key_fold(F.col(key)) == 3), text, lang)
    return made


def calibrate(model: Languages, docs: DataFrame, text: str, lang: str) -> None:
    """The sharpness under which the true languages are likeliest, and per language and length
    band the cost that all but one in a thousand documents stay under."""
    names = {n: k for k, n in enumerate(model.names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost, sizes = model.costs(batch.column(0).to_pylist())
            true = np.array([names.get(n, -1) for n in batch.column(1).to_pylist()])
            good = np.flatnonzero((sizes > 0) & (true >= 0))
            if not len(good):
                continue
            cost, own = cost[good], cost[good, true[good]]
            loss = [np.log(np.exp(-s * (cost - own[:, None])).sum(axis=1)) for s in SHARPNESS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(true[good]), pa.array(bands(sizes[good])), pa.array(own), pa.array(list(np.stack(loss, 1)))],
                ["lang", "band", "cost", "loss"],
            )

    rows = docs.select(text, lang).mapInArrow(run, "lang long, band long, cost double, loss array<double>")
    losses = [F.sum(F.col("loss")[k]).alias(f"l{k}") for k in range(len(SHARPNESS))]
    high = F.percentile_approx("cost", QUANTILE, 10_000).alias("high")
    for row in rows.groupBy("lang", "band").agg(high, *losses).collect():  # languages x 64 bands at most
        model.limits[model.names[row["lang"]], row["band"]] = SLACK * row["high"]
        sums = model.limits.setdefault("losses", np.zeros(len(SHARPNESS)))
        sums += [row[f"l{k}"] for k in range(len(SHARPNESS))]
        most = model.limits.get((model.names[row["lang"]], -1), 0.0)
        model.limits[model.names[row["lang"]], -1] = max(most, SLACK * row["high"])
    sums = model.limits.pop("losses", None)
    if sums is not None:
        model.sharpness = SHARPNESS[int(np.argmin(sums))]


def identify(docs: DataFrame, model: Languages, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, bits and rejected (names get underscores on a clash).

    ``und`` with score 0, and rejected, where the text is null or has no letter, or where
    nothing could be learned.  Ties go to the language first in order.  Every row is judged by
    its own whole text, so repeated rows agree.
    """
    names = []
    for name in ("lang_pred", "score", "bits", "rejected"):
        names.append(free_name(docs, name))
    kinds = ("string", "double", "double", "boolean")
    at = docs.columns.index(text)
    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, kinds):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, bits, _, rejected = model.judge([t or "" for t in batch.column(at).to_pylist()])
            more = [pa.array(lang, pa.string()), pa.array(score), pa.array(bits), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
