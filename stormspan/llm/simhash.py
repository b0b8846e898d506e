"""SimHash near-duplicate detection by anchor-point covering.

A fingerprint of 64 bits is read as two halves.  If two fingerprints differ in at most t bits,
they differ in at most t // 2 of one half.  The anchors of a half are the words of a product
of two perfect codes: the [23,12] Golay code (covering radius 3) over 23 of its bits and the
[7,4] Hamming code (covering radius 1) over 7 more.  A fingerprint is replicated to every
anchor within the covering radii plus the threshold, so that two near fingerprints meet at the
anchor nearest to either.  Only distinct fingerprints are replicated (about eight times per
half at t = 2), and each anchor compares its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, grouped, in_blocks, spill

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Fingerprints of one anchor that are compared in one block.
BLOCK = 4096
#: Length, generator polynomial and covering radius of the two perfect codes.
GOLAY = (23, 0b101011100011, 3)
HAMMING = (7, 0b1011, 1)


def fingerprint(text: str | None, width: int) -> int:
    """A bit is 1 if it is set in over half of the hashes of the word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)))) if len(words) > width else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        part = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little")
        ones += part.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str, text: str, width: int = SHINGLE) -> DataFrame:
    """(key, fp) per row, fp as a signed long.  No words or a null text: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp long")


def remainders(length: int, divisor: int) -> np.ndarray:
    """Of each word of ``length`` bits, as a polynomial, divided by ``divisor``."""
    degree = divisor.bit_length() - 1
    out = np.zeros(1 << length, np.int32)
    for bit in range(length):
        value = 1 << bit
        for k in range(bit, degree - 1, -1):
            if value >> k & 1:
                value ^= divisor << (k - degree)
        out[1 << bit : 2 << bit] = out[: 1 << bit] ^ value
    return out


@lru_cache
def covering(threshold: int):
    """Per pair of syndromes, the errors (Golay | Hamming << 23) that lead to all anchors
    within radii plus threshold: offsets into a flat array, the array, and the syndromes."""
    by_syndrome = []
    syndromes = []
    for length, divisor, radius in (GOLAY, HAMMING):
        syndrome = remainders(length, divisor)
        lists: list[list[tuple[int, int]]] = [[] for _ in range(1 << (divisor.bit_length() - 1))]
        for weight in range(min(length, radius + threshold) + 1):
            for bits in combinations(range(length), weight):
                error = sum(1 << b for b in bits)
                lists[syndrome[error]].append((error, max(0, weight - radius)))
        by_syndrome.append(lists)
        syndromes.append(syndrome)
    flat, starts = [], [0]
    for first in by_syndrome[0]:
        for second in by_syndrome[1]:
            flat += [e | f << GOLAY[0] for e, over in first for f, more in second if over + more <= threshold]
            starts.append(len(flat))
    return np.array(starts), np.array(flat, np.int64), syndromes


def anchors(values: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of fingerprints (uint64) and, for each, the fingerprint's index."""
    starts, flat, (golay, hamming) = covering(threshold)
    found, of = [], []
    for half in (0, 1):
        bits = (values >> np.uint64(32 * half)).astype(np.int64) & ((1 << 30) - 1)
        pair = golay[bits & ((1 << 23) - 1)].astype(np.int64) * 8 + hamming[bits >> 23]
        many = starts[pair + 1] - starts[pair]
        index = np.repeat(np.arange(len(values)), many)
        at = np.arange(len(index)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(starts[pair], many)
        found.append((bits[index] ^ flat[at]) | half << 30)
        of.append(index)
    return np.concatenate(found), np.concatenate(of)


def forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (index, root index) that connect all values linked within the group."""
    size = len(values)
    if size <= 512:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
        if near.sum() == size:
            return np.empty(0, np.int64), np.empty(0, np.int64)
    left, roots, nodes = np.arange(size), [], []
    while len(left):
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for at in range(0, len(front), 64):
                part = values[front[at : at + 64]]
                hit |= (np.bitwise_count(values[left][:, None] ^ part[None, :]) <= distance).any(axis=1)
            front, left = left[hit], left[~hit]
            nodes.append(front)
            roots.append(np.full(len(front), root))
    return (np.concatenate(nodes), np.concatenate(roots)) if nodes else (np.empty(0, np.int64),) * 2


def linked(values: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp``; their components are those of all
    links at ``distance`` or fewer bits.  Each anchor gives a spanning forest, never all pairs."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                fp = batch.column(0).slice(at, 10_000).to_numpy(zero_copy_only=False)
                anchor, index = anchors(fp.view(np.uint64), distance // 2)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[index])], ["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in grouped(batches, ["anchor", "i", "j"]):
            fp = table.column("fp").to_numpy()
            unsigned = fp.view(np.uint64)
            out_a, out_b = [], []
            for start, end in zip(bounds[:-1], bounds[1:]):
                if end - start > 1:
                    nodes, roots = forest(unsigned[start:end], distance)
                    if len(nodes):
                        out_a.append(fp[start + nodes])
                        out_b.append(fp[start + roots])
            if out_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"]
                )

    replicas = spill(values.select("fp").mapInArrow(replicate, "anchor long, fp long"))
    dealt = in_blocks(replicas, ["anchor"], F.col("fp"), block)
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    distance: int = DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """(key, fingerprint, component_id) per row of ``docs``.

    ``component_id`` is the smallest key reachable over links, the row's own included; other
    columns of ``docs`` are not looked at.  Rows without words (null texts too) have fingerprint
    zero and are linked like any other.  Repeated rows and keys come out as often as they came
    in.  A null key is never the smallest unless all keys of its component are null.
    """
    made = spill(fingerprints(docs, key, text, width))
    values = made.groupBy("fp").agg(F.min(key).alias("least"))
    values = spill(values)
    roots = components(linked(values, distance, block), "a", "b")
    placed = values.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.select("fp", "root").join(smallest.repartition("component_id", "root"), "root")
    classes = placed.select(F.col("fp").alias("value"), "component_id")
    return made.join(classes, F.col("fp") == F.col("value")).select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose key is its component's smallest, one row a key.  Rows without
    a key belong to no group and stay."""
    groups = near_duplicates(docs, key, text, **how)
    stay = groups.filter(F.col(key) == F.col("component_id")).select(key).distinct()
    kept = docs.join(stay.repartition(F.xxhash64(key)), key, "left_semi").dropDuplicates([key])
    return kept.select(docs.columns).unionByName(docs.filter(F.col(key).isNull()))
