"""Periodic runs of words: stretches that repeat one period three times or more.

A run is a stretch whose words q apart are identical, q its smallest period, at least
``max(SHORTEST, 3 q)`` words long, and not extendable with that period.  They are found by
multi-scale minimizers.  At scale h (a power of two) every stretch of h words has a hash, and a
position is a minimizer if its hash is the least of some h neighbours.  Inside a run the windows
repeat at period distance, so their minima do too: each run with a period from 2 h to below 4 h
holds two equal minimizers one period apart.  Such pairs are seeds; a seed is extended to both
sides by binary search over prefix hashes and then compared word by word, so hashes never decide
a result.  Periods below twice the first scale are too short for that and are looked for by
direct scans of each lag, one look every few words.

Stretches inside a run of a shorter period (half a scale or less) would be minimal everywhere;
they are left out of the minima at that scale.  What is left with equal words is over half a
scale apart, so a position has a bounded number of partners and the work is linear per scale.
A run of a longer period always keeps a minimum outside of them: were all its windows left out,
its period would not be its smallest.

Documents are laid end to end, with a separator that equals nothing, so that one array
operation serves many of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a run, at least.
SHORTEST = 24
#: Periods that fit into a run, at least.
TIMES = 3
#: The first scale; periods below twice as many words are scanned directly.
FIRST = 32
#: Words of a direct look.
LOOK = 4
#: Words of documents that are searched together; a longer document is searched by itself.
BLOCK = 200_000

BASE = 0x9E3779B97F4A7C15
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finalizer."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Prefixes:
    """Hashes of any stretch of an array of word numbers."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        with np.errstate(over="ignore"):
            values = mixed(words.astype(np.uint64) * np.uint64(BASE) + np.uint64(1))
            steps = np.full(n + 1, np.uint64(BASE))
            steps[0] = 1
            power = np.cumprod(steps)
            steps[1:] = pow(BASE, -1, 1 << 64)
            self.back = np.cumprod(steps)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[:-1])])

    def of(self, at: np.ndarray, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def all(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length]

    def agreement(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, side: int) -> np.ndarray:
        """How many words agree from ``a`` and ``b`` on (side 1) or before them (side -1)."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            back = middle if side < 0 else 0
            same = self.of(a - back, middle) == self.of(b - back, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """``pick`` over each window; ``width`` is a power of two."""
    size = 1
    while size < width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return values


def lag_seeds(prefixes: Prefixes, size: int) -> Iterator[tuple[np.ndarray, int]]:
    """Positions and lags below twice the first scale at which a few words agree: one look in
    every stretch as long as the agreement within the shortest run of that period."""
    if size < LOOK:
        return
    looks = prefixes.all(LOOK)
    for lag in range(1, min(2 * FIRST, size - LOOK)):
        step = max(SHORTEST, TIMES * lag) - lag - LOOK + 1
        later = looks[lag::step]
        yield np.flatnonzero(looks[::step][: len(later)] == later) * step, lag


def minimizer_seeds(prefixes: Prefixes, scale: int, hidden: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Equal minimizers from 2 to below 4 scales apart.  ``hidden`` positions have no part."""
    hashes = mixed(prefixes.all(scale))
    hashes[hidden[: len(hashes)]] = NEVER
    if len(hashes) < scale:
        return
    least = sliding(hashes, scale, np.minimum)
    edge = np.zeros(scale - 1, np.uint64)
    highest = sliding(np.concatenate([edge, least, edge]), scale, np.maximum)
    at = np.flatnonzero((hashes == highest) & (hashes != NEVER))
    at = at[np.argsort(hashes[at], kind="stable")]
    found = hashes[at]
    for apart in range(1, len(at)):
        distance = np.where(found[apart:] == found[:-apart], at[apart:] - at[:-apart], 4 * scale)
        near = distance < 4 * scale
        if not near.any():
            return
        wanted = near & (distance >= 2 * scale)
        yield at[:-apart][wanted], distance[wanted]


def extended(words: np.ndarray, prefixes: Prefixes, first: np.ndarray, last: np.ndarray, at, lag) -> set:
    """(start, end, lag) of the stretches through the seeds that are long enough.  ``first``
    and ``last`` bound the document of each position."""
    left = prefixes.agreement(at, at + lag, at - first[at], -1)
    right = prefixes.agreement(at, at + lag, last[at] - at - lag, 1)
    start, end = at - left, at + lag + right
    long = end - start >= np.maximum(SHORTEST, TIMES * lag)
    out = set()
    for s, e, q, p in {(s, e, q): (s, e, q, p) for s, e, q, p in zip(*(v[long].tolist() for v in (start, end, lag, at)))}.values():
        if not np.array_equal(words[s : e - q], words[s + q : e]):  # hashes of unequal words met
            apart = np.flatnonzero(words[s : e - q] != words[s + q : e]) + s
            before, after = apart[apart < p], apart[apart >= p]
            s = int(before[-1]) + 1 if len(before) else s
            e = int(after[0]) + q if len(after) else e
            if e - s < max(SHORTEST, TIMES * q):
                continue
        out.add((s, e, q))
    return out


def find_runs(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each document, by start, then period."""
    sizes = np.array([len(d) for d in documents], np.int64)
    found: list[dict[tuple[int, int], int]] = [{} for _ in documents]

    def search(which: np.ndarray, scale: int) -> None:
        ends = np.cumsum(sizes[which] + 1)
        starts = ends - sizes[which] - 1
        words = np.empty(ends[-1], np.int64)
        for d, s, e in zip(which, starts, ends):
            words[s : e - 1] = documents[d]
            words[e - 1] = -1 - d
        prefixes = Prefixes(words)
        of = np.repeat(np.arange(len(which)), sizes[which] + 1)
        first, last = starts[of], ends[of] - 1
        if scale:
            marks = np.zeros(len(words) + 1, np.int64)
            for d, s in zip(which, starts):
                for (begin, end), period in found[d].items():
                    if 2 * period <= scale and end - begin >= scale + period:
                        marks[s + begin] += 1
                        marks[s + end - scale - period + 1] -= 1
            seeds = list(minimizer_seeds(prefixes, scale, np.cumsum(marks[:-1]) > 0))
        else:
            seeds = [(at, np.full(len(at), lag)) for at, lag in lag_seeds(prefixes, len(words))]
        seeds = [s for s in seeds if len(s[0])]
        if seeds:
            at, lag = (np.concatenate(part) for part in zip(*seeds))
            inside = at + lag < last[at]
            for s, e, q in extended(words, prefixes, first, last, at[inside], lag[inside]):
                d, base = which[of[s]], first[s]
                place = (int(s - base), int(e - base))
                found[d][place] = min(q, found[d].get(place, q))

    which, scale = np.flatnonzero(sizes >= SHORTEST), 0
    while len(which):
        search(which, scale)
        scale = 2 * scale or FIRST
        which = np.flatnonzero(sizes >= 2 * TIMES * scale)
    return [sorted((s, e - s, q) for (s, e), q in f.items()) for f in found]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Without what any run holds after its first period."""
    if not runs:
        return words
    stay = np.ones(len(words), bool)
    for start, length, period in runs:
        stay[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(stay)]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; of equals the first, then that of the shortest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def find(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, ``runs`` (start, length, period; by start,
    then period), ``strongest`` (most periods; null without runs) and ``collapsed``, the words
    left when each run keeps its first period only, joined by one space.

    Words are what white space (U+0020, U+0009 to U+000D) parts; ``edit`` may replace a row's
    words, given its key, before the search.  A null or empty text has no words, no runs and an
    empty collapsed text.  Equal rows, repeated keys and null keys are rows like any other;
    other columns are not looked at.  A document is searched whole, however long, by one task.
    An empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    names = ["key", "n_words", "runs", "strongest", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, numbers, read, key_type = [], [], [], 0, None
        known: dict[bytes, int] = defaultdict(count().__next__)

        def flush() -> pa.RecordBatch:
            runs = find_runs(numbers)
            best = [strongest(r) for r in runs]
            columns = [
                pa.array(keys, key_type),
                pa.array([len(w) for w in texts], pa.int64()),
                pa.array([[dict(zip(run_type.names, r)) for r in rs] for rs in runs], pa.list_(run_type)),
                pa.array([b and dict(zip(run_type.names, b)) for b in best], run_type),
                pa.array([b" ".join(kept_words(w, r)) for w, r in zip(texts, runs)], pa.binary()),
            ]
            for held in (keys, texts, numbers, known):
                held.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (value.as_py() or b"").split()
                if edit is not None:
                    words = edit(name, words)
                if read and read + len(words) > block:
                    yield flush()
                    read = 0
                keys.append(name)
                texts.append(words)
                numbers.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                read += len(words) + 1
        if keys:
            yield flush()

    struct = "struct<start: long, length: long, period: long>"
    made = docs.select(key, F.col(text).cast("binary")).mapInArrow(
        run, f"key {kind}, n_words long, runs array<{struct}>, strongest {struct}, collapsed binary"
    )
    return made.select(F.col("key").alias(key), "n_words", "runs", "strongest", F.col("collapsed").cast("string").alias("collapsed"))
