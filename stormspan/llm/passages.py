"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words.  Every passage is encoded (style features,
then a learned layer); gated attention weighs the passages; a document's score comes from the
weighted sum of its passages.  Only documents carry labels, so the attention learns which
passages decide.  Fitted on a bounded sample of labelled rows, applied to all passages of all
documents.  The features look at no word by itself, so they hold for any language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import free_name, held_out

PASSAGE = 64
#: Labelled documents the model is fitted on, per label, at most.
SAMPLE = 3000
#: Passages of one document that take part in the fit, at most, spread evenly.  Scores take all.
SAMPLE_PASSAGES = 64
THRESHOLD = 0.7
HIDDEN, ATTENTION = 24, 12
ROUNDS, BATCH, RATE = 40, 128, 0.01
#: Bytes handled at once.
CHUNK = 1 << 21

SPACE, UPPER, LOWER, DIGIT, SYMBOL, SHOUT, STOP, COMMA, OTHER, LEAD, INNER = range(11)


def byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[128:192], table[192:] = INNER, LEAD
    for signs, kind in (
        (b" \t\n\r\f\v", SPACE),
        (bytes(range(65, 91)), UPPER),
        (bytes(range(97, 123)), LOWER),
        (b"0123456789", DIGIT),
        (b"#*$%&|<>", SYMBOL),
        (b"!?", SHOUT),
        (b".", STOP),
        (b",;:", COMMA),
    ):
        table[list(signs)] = kind
    return table


CLASSES = byte_classes()
WEIGHTS = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
FEATURES = 20


def distinct(of: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Number of distinct values in each group."""
    if not len(of):
        return np.zeros(size)
    by = np.lexsort((values, of))
    of, values = of[by], values[by]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (values[1:] != values[:-1])
    return np.bincount(of[new], minlength=size).astype(np.float64)


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the index of its text.  A text without words has none."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    kind = CLASSES[raw]
    blank = kind == SPACE
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(begins):
        return np.empty((0, FEATURES)), np.empty(0, np.int64)
    ends = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
    edges = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(edges, begins, side="right")
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    opens = np.flatnonzero(rank % PASSAGE == 0)  # first words of passages
    of = doc[opens]
    passage = np.repeat(np.arange(len(opens)), np.diff(opens, append=len(doc)))
    words = np.bincount(passage, minlength=len(opens)).astype(np.float64)
    size = len(opens)
    length = (ends - begins).astype(np.float64)

    inside = np.flatnonzero(~blank)
    word_of = np.repeat(np.arange(len(begins)), ends - begins)
    kinds = kind[inside]
    share = np.bincount(passage[word_of] * 11 + kinds, minlength=size * 11).reshape(size, 11).astype(np.float64)
    signs = np.maximum(share.sum(axis=1) - share[:, INNER], 1)
    letters = np.maximum(share[:, UPPER] + share[:, LOWER] + share[:, LEAD], 1)
    per_word = np.bincount(word_of * 2 + (kinds == UPPER), weights=(kinds == UPPER) | (kinds == LOWER), minlength=2 * len(begins)).reshape(-1, 2)
    loud = (per_word[:, 1] >= 2) & (per_word[:, 0] == 0)
    place = (inside - begins[word_of]) & 63
    hashed = np.zeros(len(begins), np.uint64)
    mixed = (raw[inside].astype(np.uint64) + np.uint64(1)) * WEIGHTS[place]
    hashed = np.add.reduceat(mixed, np.concatenate([[0], np.cumsum(ends - begins)[:-1]]))
    same = np.zeros(len(begins))
    same[1:] = (hashed[1:] == hashed[:-1]) & (passage[1:] == passage[:-1])
    triple = hashed[:-2] * np.uint64(3) + hashed[1:-1] * np.uint64(5) + hashed[2:] * np.uint64(7)
    own = passage[:-2] == passage[2:]
    triples = np.bincount(passage[:-2][own], minlength=size)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, weights=values, minlength=size) / words

    first, last = kind[begins], kind[ends - 1]
    lines = np.bincount(passage[np.searchsorted(begins, np.flatnonzero(raw == 10), side="right").clip(1) - 1], minlength=size)
    columns = [
        share[:, UPPER] / letters,
        share[:, DIGIT] / signs,
        share[:, SYMBOL] / signs,
        share[:, SHOUT] / signs,
        share[:, STOP] / words,
        share[:, COMMA] / words,
        share[:, OTHER] / signs,
        share[:, LEAD] / letters,
        lines / words,
        mean(length) / 10,
        np.sqrt(mean(length * length)) / 10,
        distinct(passage, hashed, size) / words,
        mean(same),
        np.where(triples > 0, distinct(passage[:-2][own], triple[own], size) / np.maximum(triples, 1), 1.0),
        mean(length <= 3),
        mean(loud),
        mean(first == UPPER),
        mean((first != UPPER) & (first != LOWER) & (first != LEAD) & (first != DIGIT)),
        mean((last == SYMBOL) | (last == SHOUT)),
        np.log(words) / 4,
    ]
    return np.stack(columns, axis=1), of


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Attention:
    """Encoder, gated attention and classifier; parameters in one dictionary."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(scale=1 / np.sqrt(a), size=(a, b))
        self.mean, self.spread = mean, spread
        self.p = {
            "w": draw(len(mean), HIDDEN), "b": np.zeros(HIDDEN),
            "v": draw(HIDDEN, ATTENTION), "u": draw(HIDDEN, ATTENTION), "a": draw(ATTENTION, 1)[:, 0],
            "c": draw(HIDDEN, 1)[:, 0], "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, starts: np.ndarray, of: np.ndarray):
        p = self.p
        x = np.clip((x - self.mean) / self.spread, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * g) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[of])
        alpha = e / np.add.reduceat(e, starts)[of]
        z = np.add.reduceat(alpha[:, None] * h, starts)
        return x, h, t, g, alpha, z, sigmoid(z @ p["c"] + p["d"])

    def step(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over a batch of bags."""
        p, starts = self.p, np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(sizes)), sizes)
        x, h, t, g, alpha, z, out = self.forward(x, starts, of)
        err = (out - y) / len(y)
        dz = err[:, None] * p["c"]
        dh = alpha[:, None] * dz[of]
        dot = (h * dz[of]).sum(axis=1)
        de = alpha * (dot - np.add.reduceat(alpha * dot, starts)[of])
        dt, dg = de[:, None] * g * p["a"] * (1 - t * t), de[:, None] * t * p["a"] * g * (1 - g)
        dh += dt @ p["v"].T + dg @ p["u"].T
        dx = dh * (1 - h * h)
        return {
            "w": x.T @ dx, "b": dx.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg,
            "a": (t * g).T @ de, "c": z.T @ err, "d": err.sum(keepdims=True),
        }

    def fit(self, bags: list[np.ndarray], y: np.ndarray, seed: int = 0) -> None:
        """Adam over shuffled batches, with a little weight decay."""
        rng, n = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for round_ in range(ROUNDS):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                own = order[at : at + BATCH]
                sizes = np.array([len(bags[k]) for k in own])
                grads = self.step(np.concatenate([bags[k] for k in own]), sizes, y[own])
                n += 1
                rate = RATE * (1 - round_ / ROUNDS)
                for k, grad in grads.items():
                    grad = grad + 1e-4 * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad * grad
                    self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Per text, from all its passages; 0 where there is no word."""
        out = np.zeros(len(texts))
        start = size = 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= CHUNK or k + 1 == len(texts):
                x, of = encode(texts[start : k + 1])
                if len(of):
                    at = np.flatnonzero(np.diff(of, prepend=-1))
                    bag = np.repeat(np.arange(len(at)), np.diff(at, append=len(of)))
                    out[start + of[at]] = self.forward(x, at, bag)[-1]
                start, size = k + 1, 0
        return out


class Always:
    """Where nothing can be learned: every text with a word gets the same score."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return np.array([self.score if t.split() else 0.0 for t in texts])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> Attention | Always:
    """A model from labelled rows outside the held-out fold: per label the ``sample`` keys of
    least hash, at most SAMPLE_PASSAGES passages of each.  Null labels are left out; a key with
    unequal labels counts by their mean, a tie as 1.  Without rows of both labels every text
    scores the share of ones (1 where there are no labels at all)."""
    table = (
        labels.filter(F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("key"))
        .agg((F.avg(label) >= 0.5).cast("double").alias("y"))
        .join(docs.select(F.col(key).alias("key")).distinct(), "key", "left_semi")
    )
    chosen = None
    for value in (0.0, 1.0):
        part = table.filter(F.col("y") == value).orderBy(F.xxhash64("key"), "key").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 * sample rows of two numbers.
    rows = docs.select(F.col(key).alias("key"), text).join(F.broadcast(chosen), "key").select("key", text, "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, value, y in zip(*(c.to_pylist() for c in batch.columns)):
                x, _ = encode([(value or "").encode("utf-8", "surrogatepass")])
                if len(x):
                    x = x[np.unique(np.linspace(0, len(x) - 1, SAMPLE_PASSAGES).astype(int))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name], batch.schema.field(0).type), pa.array([y]), pa.array([x.astype(np.float32).ravel()])],
                        ["key", "y", "x"],
                    )

    kind = docs.schema[key].dataType.simpleString()
    bags = rows.mapInArrow(run, f"key {kind}, y double, x array<float>").orderBy("key").toArrow()
    y = bags.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return Always(float(y.mean()) if len(y) else 1.0)
    passages = [np.array(x.values, np.float64).reshape(-1, FEATURES) for x in bags.column("x")]
    every = np.concatenate(passages)
    model = Attention(every.mean(axis=0), every.std(axis=0) + 1e-3)
    model.fit(passages, y)
    return model


def score(docs: DataFrame, model: Attention | Always, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1; 0 for a text without words, null texts too) in column
    ``name``, underscores added on a clash.  Every row is scored by its whole text alone."""
    name = free_name(docs, name)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(texts))], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType(list(docs.schema.fields)).add(name, "double"))
