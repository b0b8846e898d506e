"""Ranked lexical search with MaxScore over pair bounds.

The index is a table of shards, each the inverted lists of a bounded number of words, and a
dictionary of document frequencies.  Queries come in blocks.  For a block, every shard gets the
impact lists of the block's terms and, for terms that stand next to each other in the order of
weight within a query, the list of the documents that hold both, with the greatest impact that
both reach together in one document.  Written once, these lists serve all queries of the block.
Long lists travel packed (narrow numbers, compressed), as whole shards pass through the memory of
the executors side by side.

A pair adds at most its joint maximum where both meet, and at most the larger of the two maxima
elsewhere; independent maxima would add up to more.  For every number of terms, in ascending
order of their maxima, the least bound that disjoint pairs and single terms give is combined.
Lists are scored from the highest maximum down until the bound of the rest stays below the score
of the last wanted rank; only documents met so far can still get there.  The rest is added to
those only, and each of them is dropped as soon as its score and what its own pairs leave open
fall short.  A task carries the wanted score from shard to shard.  Results are exact.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .shared import spill

BEST = 20
#: Words of one shard; a longer document is a shard by itself.
SHARD = 2_000_000
#: Queries, and bytes of their texts, answered in one pass over the index.
QUERIES, QUERY_BYTES = 1000, 4 << 20

LETTERS = bytes(b for b in range(128) if chr(b).isalnum()) + bytes(range(128, 256))
#: Everything but letters, digits and what is not ASCII parts terms; A-Z become a-z.
TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b in LETTERS else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights, times, lengths, documents: int, words: int):
    """Of occurrences in documents, in whole numbers; arrays or numbers."""
    norm = 100 - 25 + (25 * lengths * documents) // words
    return weights * ((1_000_000_000 * times) // (1000 * times + 12 * norm))


class Index(NamedTuple):
    shards: DataFrame
    dictionary: DataFrame
    documents: int
    words: int


def listed(values, kind: pa.DataType) -> pa.Array:
    """One row that holds all values."""
    values = pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


#: Of packed numbers; the first that holds all of them is taken.
WIDTHS = [np.dtype(k) for k in ("u1", "u2", "u4", "i8")]


def packed(parts: list[np.ndarray]) -> pa.Array:
    """One row that holds all values of the parts, compressed."""
    most = max((int(p.max(initial=0)) for p in parts), default=0)
    least = min((int(p.min(initial=0)) for p in parts), default=0)
    kind = next(k for k in WIDTHS if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
    values = np.empty(sum(map(len, parts)), kind)
    at = 0
    for part in parts:
        values[at : at + len(part)] = part
        at += len(part)
    head = kind.itemsize.to_bytes(1, "little") + values.nbytes.to_bytes(8, "little")
    return listed([head + pa.compress(values.data, "zstd", asbytes=True)], pa.binary())


def unpacked(row: pa.Array, kind: str) -> np.ndarray:
    """The values of a packed row, as ``kind``."""
    held = row[0].as_buffer()
    width, size = held[0], int.from_bytes(held[1:9], "little")
    narrow = next(k for k in WIDTHS if k.itemsize == width)
    return np.frombuffer(pa.decompress(held.slice(9), size, "zstd"), narrow).astype(kind)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", shard: int = SHARD) -> Index:
    """Index every row of ``docs`` that has a term."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        known: dict[bytes, int] = defaultdict(count().__next__)
        keys, lengths, held, read, key_type = [], [], [], 0, None

        def flush() -> pa.RecordBatch:
            codes = np.concatenate(held, dtype=np.int64)
            held.clear()
            codes *= len(keys)
            codes += np.repeat(np.arange(len(keys), dtype=np.int32), lengths)
            codes.sort()
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            times = np.diff(first, append=len(codes))
            codes = codes[first]
            holding = np.bincount(codes // len(keys), minlength=len(known))
            codes %= len(keys)
            row = [
                pa.array([number]),
                pa.array([len(keys)]),
                pa.array([read]),
                listed(keys, key_type),
                listed(lengths, pa.int64()),
                listed(list(known), pa.binary()),
                listed(holding, pa.int64()),
                packed([codes]),
                packed([times]),
            ]
            return pa.RecordBatch.from_arrays(row, names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(value.as_py())
                if not found:
                    continue
                if read and read + len(found) > shard:
                    yield flush()
                    keys, lengths, held, read, number = [], [], [], 0, number + 1
                    known = defaultdict(count().__next__)
                keys.append(doc)
                lengths.append(len(found))
                held.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                read += len(found)
        batch = value = None  # the texts go before the last lists are made
        if keys:
            yield flush()

    names = ["shard", "documents", "words", "keys", "lengths", "terms", "holding", "docs", "times"]
    shards = spill(
        docs.select(key, F.col(text).cast("binary")).mapInArrow(
            run,
            f"shard long, documents long, words long, keys array<{kind}>, lengths array<long>, "
            "terms array<binary>, holding array<long>, docs array<binary>, times array<binary>",
        )
    )
    dictionary = spill(
        # Not a zip: its structs would all stand in memory, one per term of a shard.
        shards.select(F.posexplode("terms").alias("place", "term"), "holding")
        .select("term", F.get("holding", "place").alias("holding"))
        .groupBy("term")
        .agg(F.sum("holding").alias("holding"))
    )
    total = shards.agg(F.sum("documents"), F.sum("words")).first()
    return Index(shards, dictionary, total[0] or 0, total[1] or 0)


class Query(NamedTuple):
    number: int
    #: (term number, occurrences), the heaviest first
    terms: list[tuple[int, int]]


class Lists(NamedTuple):
    """A shard's impact lists and pair lists, by term number and pair."""

    keys: list
    lists: dict[int, tuple[np.ndarray, np.ndarray]]
    greatest: dict[int, int]
    pairs: dict[tuple[int, int], tuple[np.ndarray, int]]


def neighbours(queries: list[Query]) -> list[tuple[int, int]]:
    """Pairs of terms next to each other, or one apart, in the order of weight of a query."""
    found = set()
    for query in queries:
        order = [t for t, _ in query.terms]
        found |= {(min(p), max(p)) for far in (1, 2) for p in zip(order, order[far:])}
    return sorted(found)


def prepare(index: Index, vocabulary: dict[bytes, int], weights: list[int], pairs: list[tuple[int, int]]) -> DataFrame:
    """Per shard, the impact lists of the vocabulary and the lists of the pairs."""
    documents, words = index.documents, index.words
    kind = index.shards.schema["keys"].dataType.simpleString()
    partners: dict[int, list[int]] = defaultdict(list)
    for a, b in pairs:
        partners[a].append(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, lengths, found, holding, docs, times = (c[k].values for c in batch.columns)
                lengths, holding = np.asarray(lengths), np.asarray(holding)
                docs, times = unpacked(docs, "i4"), unpacked(times, "i4")
                ends = np.cumsum(holding)
                lists = {}
                for place, term in enumerate(found.to_pylist()):
                    number = vocabulary.get(term)
                    if number is not None:
                        part = slice(ends[place] - holding[place], ends[place])
                        made = impacts(weights[number], times[part].astype(np.int64), lengths[docs[part]], documents, words)
                        lists[number] = (docs[part], made)
                dense = np.zeros(len(lengths), np.int64)
                here = np.zeros(len(lengths), bool)
                first, second, both, joint = [], [], [], []
                for a, others in partners.items():
                    if a not in lists:
                        continue
                    at, worth = lists[a]
                    dense[at], here[at] = worth, True
                    for b in others:
                        if b in lists:
                            met = here[lists[b][0]]
                            shared = lists[b][0][met]
                            first.append(a)
                            second.append(b)
                            both.append(shared)
                            joint.append(int((dense[shared] + lists[b][1][met]).max(initial=0)))
                    here[at] = False
                order = sorted(lists)
                row = [
                    listed(keys, keys.type),
                    listed(order, pa.int32()),
                    listed([len(lists[t][0]) for t in order], pa.int32()),
                    packed([lists[t][0] for t in order]),
                    packed([lists[t][1] for t in order]),
                    listed(first, pa.int32()),
                    listed(second, pa.int32()),
                    listed([len(d) for d in both], pa.int32()),
                    packed(both),
                    listed(joint, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(row, names)
                del docs, times, lists, both, row  # before the next shard is unpacked

    names = ["keys", "terms", "holding", "docs", "impacts", "first", "second", "shared", "both", "joint"]
    return spill(
        index.shards.select("keys", "lengths", "terms", "holding", "docs", "times").mapInArrow(
            run,
            f"keys {kind}, terms array<int>, holding array<int>, docs array<binary>, impacts array<binary>, "
            "first array<int>, second array<int>, shared array<int>, both array<binary>, joint array<long>",
        )
    )


def lists_of(columns: list) -> Lists:
    """Read one prepared row."""
    keys, found, holding, docs, worth, first, second, shared, both, joint = columns
    found, holding, shared, joint = map(np.asarray, (found, holding, shared, joint))
    docs, worth, both = unpacked(docs, "i4"), unpacked(worth, "i8"), unpacked(both, "i4")
    cuts = np.cumsum(holding)[:-1]
    lists = dict(zip(found.tolist(), zip(np.split(docs, cuts), np.split(worth, cuts)))) if len(found) else {}
    greatest = {t: int(w.max(initial=0)) for t, (_, w) in lists.items()}
    met = np.split(both, np.cumsum(shared)[:-1]) if len(shared) else []
    pairs = dict(zip(zip(first.to_pylist(), second.to_pylist()), zip(met, joint.tolist())))
    return Lists(keys.to_pylist(), lists, greatest, pairs)


class Unit(NamedTuple):
    """One term, or two whose impacts are bounded together."""

    bound: int
    #: Bound outside of ``both``.
    alone: int
    terms: tuple[tuple[int, int], ...]
    both: np.ndarray | None


def pair(shard: Lists, a: tuple[int, int], b: tuple[int, int]) -> Unit | None:
    """Two terms, with their occurrences in the query, as a unit where the shard lists the pair."""
    (one, often), (other, more) = sorted((a, b))
    if (one, other) not in shard.pairs:
        return None
    both, joint = shard.pairs[one, other]
    first, second, least = shard.greatest[one], shard.greatest[other], min(often, more)
    alone = max(often * first, more * second)
    # Each impact is counted as often as its term occurs in the query.
    met = least * joint + (often - least) * first + (more - least) * second
    return Unit(max(alone, met) if len(both) else alone, alone, (a, b), both)


def combined(query: Query, shard: Lists, paired: bool = True) -> tuple[list[tuple[int, int]], list[int], list[list[Unit]]]:
    """The query's terms in the shard by ascending maximum; and for each number of them, from
    none to all, the least bound that units of neighbours give, and these units' steps."""
    found = sorted(((c * shard.greatest[t], t, c) for t, c in query.terms if shard.greatest.get(t)))
    bounds, steps = [0], [[]]
    for p, (most, term, times) in enumerate(found):
        single = Unit(most, most, ((term, times),), None)
        bound, last = bounds[p] + most, [single]
        if p and paired:
            unit = pair(shard, found[p - 1][1:], (term, times))
            if unit is not None and bounds[p - 1] + unit.bound < bound:
                bound, last = bounds[p - 1] + unit.bound, [unit]
        bounds.append(bound)
        steps.append(last)
    return [(t, c) for _, t, c in found], bounds, steps


def units(steps: list[list[Unit]], size: int) -> list[Unit]:
    """The units that bound the first ``size`` terms, the last ones first."""
    out = []
    while size:
        out += steps[size]
        size -= len(out[-1].terms)
    return out


def best_of(query: Query, shard: Lists, best: int, wanted: int, paired: bool = True, touched: list | None = None):
    """(scores, document places) in the shard that reach ``wanted``, the ``best`` and ties."""
    found, bounds, steps = combined(query, shard, paired)
    scores = np.zeros(len(shard.keys), np.int64)
    left = len(found)
    while left and bounds[left] >= wanted:
        left -= 1
        term, times = found[left]
        docs, worth = shard.lists[term]
        scores[docs] += times * worth
        if touched is not None:
            touched.append(len(docs))
        if len(scores) >= best and left:
            wanted = max(wanted, int(np.partition(scores, -best)[-best]))
    near = np.flatnonzero(scores)
    if left and len(near):
        parts = units(steps, left)
        open_ = np.full(len(scores), sum(u.alone for u in parts), np.int64)
        for unit in parts:
            if unit.both is not None:
                open_[unit.both] += unit.bound - unit.alone
        for unit in parts:
            near = near[scores[near] + open_[near] >= wanted]
            if not len(near):
                break
            for term, times in unit.terms:
                docs, worth = shard.lists[term]
                at = np.minimum(np.searchsorted(docs, near), len(docs) - 1)
                scores[near] += np.where(docs[at] == near, times * worth[at], 0)
                if touched is not None:
                    touched.append(min(len(near), len(docs)))
            open_ -= unit.alone
            if unit.both is not None:
                open_[unit.both] -= unit.bound - unit.alone
    near = near[scores[near] >= max(wanted, 1)]
    if len(near) > best:
        near = near[scores[near] >= np.partition(scores[near], -best)[-best]]
    return scores[near], near


def ordered(row: tuple) -> tuple:
    """Higher scores first, then smaller keys, then rows without a key."""
    return -row[0], row[1] is None, row[1] if row[1] is not None else 0


def answered(prepared: DataFrame, queries: list[Query], best: int, paired: bool = True) -> DataFrame:
    """(query, doc, score): what each task's shards can offer to the best."""
    kind = prepared.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {q.number: [] for q in queries}
        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type.value_type
            for k in range(batch.num_rows):
                shard = lists_of([c[k].values for c in batch.columns])
                for query in queries:
                    have = held[query.number]
                    wanted = have[-1][0] if len(have) == best else 1
                    scores, at = best_of(query, shard, best, wanted, paired)
                    if len(at):
                        have += zip(scores.tolist(), [shard.keys[d] for d in at.tolist()])
                        have.sort(key=ordered)
                        del have[best:]
                del shard  # before the next one is unpacked
        rows = [(number, doc, score) for number, have in held.items() for score, doc in have]
        if rows:
            number, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(doc, key_type), pa.array(score, pa.int64())], ["query", "doc", "score"]
            )

    return prepared.mapInArrow(run, f"query long, doc {kind}, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    best: int = BEST,
    shard: int = SHARD,
    queries: int = QUERIES,
) -> DataFrame:
    """One row per item and rank: item, rank (from 1), key, score; the ``best`` documents.

    Rows without a term, null texts among them, count nowhere and are never found; an item
    without a term, or whose terms no document holds, has no row.  Equal scores rank by
    ascending key, null keys last; rows with equal keys are documents of their own, and so are
    repeated items, each with its own ranks.  Other columns are not looked at, their names may
    clash.  A document is indexed whole.  Empty tables give no rows.

    Items are answered in blocks of about ``queries``, one pass over the index each; only a
    block and its vocabulary are held by the driver.
    """
    spark = docs.sparkSession
    index = build(docs, key, text, shard)
    asked = spill(items.select(F.col(item).alias("item"), F.coalesce(F.col(item_text).cast("binary"), F.lit(b"")).alias("text")))
    size = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-size[0] // queries), -(-size[1] // QUERY_BYTES))
    numbered = StructType([StructField("query", LongType()), StructField("item", items.schema[item].dataType)])
    found = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        part = answered_block(index, rows, best)
        numbers = spark.createDataFrame([(n, r["item"]) for n, r in enumerate(rows)], numbered)
        ranked = part.withColumn(
            "rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
        ).filter(F.col("rank") <= best)
        made = ranked.join(numbers, "query").select(
            F.col("item").alias(item), "rank", F.col("doc").alias(key), "score"
        )
        found = made if found is None else found.unionByName(made)
    return found


def answered_block(index: Index, rows: list, best: int) -> DataFrame:
    """Offers of all tasks for a block of items."""
    spark = index.shards.sparkSession
    asked = [Counter(terms(bytes(r["text"]))) for r in rows]
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*asked)))}
    wanted = spark.createDataFrame([(bytearray(t), n) for t, n in vocabulary.items()], "term binary, number long")
    holding = [0] * len(vocabulary)
    for r in index.dictionary.join(wanted, "term").select("number", "holding").collect():
        holding[r["number"]] = r["holding"]
    weights = [weight(index.documents, h) for h in holding]
    queries = [
        Query(n, sorted(((vocabulary[t], c) for t, c in a.items()), key=lambda x: (-weights[x[0]], x[0])))
        for n, a in enumerate(asked)
    ]
    return answered(prepare(index, vocabulary, weights, neighbours(queries)), queries, best)
