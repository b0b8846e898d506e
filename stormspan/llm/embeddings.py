"""Embedding near-duplicates by iterative quantisation.

A rotation of the principal directions is learned so that its signs are balanced binary codes
(fitted on a bounded sample of distinct vectors).  The code is cut into chunks; each chunk is
the key of one Hamming table, so two vectors are compared if any chunk is equal.  Candidates
are reranked with the original vectors in double precision, where they meet; only link counts
and a spanning forest leave the task, never all pairs.

With chunks of 8 bits, two vectors at cosine 0.95 (a tenth of the bits differ) meet with
probability 0.99; at 0.98 with 0.999.  ``chunk_bits`` sets the size of the tables: longer
chunks compare less and meet less often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import components, grouped, in_blocks, spill

COSINE = 0.95
BITS = 64
CHUNK_BITS = 8
#: Distinct vectors the rotation is fitted on, at most.
SAMPLE = 20_000
#: Vectors of one bucket that are compared in one block.
BLOCK = 2048


def usable(vector: Column) -> Column:
    """No null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision at length one; the largest component first becomes one."""
    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_rotation(rows: np.ndarray, bits: int = BITS, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimensions x bits) whose signs are the code."""
    rows = unit(rows)
    mean = rows.mean(axis=0)
    _, vectors = np.linalg.eigh((rows - mean).T @ (rows - mean))
    top = vectors[:, ::-1][:, :bits]
    flat = (rows - mean) @ top
    rotation = np.linalg.qr(np.random.default_rng(0).normal(size=(top.shape[1],) * 2))[0]
    for _ in range(rounds):
        code = np.where(flat @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(code.T @ flat)
        rotation = (left @ right).T
    return mean, top @ rotation


def chunks_of(rows: np.ndarray, mean: np.ndarray, projection: np.ndarray, chunk: int) -> np.ndarray:
    """Integer keys (rows x tables).  Rows of another length are cut or filled with zeros."""
    flat = np.zeros((len(rows), len(mean)))
    width = min(rows.shape[1], len(mean))
    flat[:, :width] = unit(rows)[:, :width]
    bits = (flat - mean) @ projection >= 0
    tables = max(1, bits.shape[1] // chunk)
    return np.stack([part @ (1 << np.arange(part.shape[1])) for part in np.array_split(bits, tables, axis=1)], axis=1)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def spanning(size: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest index of each row's component over the links (p, q)."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[p], label[q])
        new = label.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(classes: DataFrame, cosine: float, bits: int, chunk: int, block: int, sample: int) -> DataFrame:
    """(id, links, root) in parts, from distinct vectors (id, vector, many).  The sum of
    ``links`` counts linked vectors of other classes; (id, root) are edges."""
    fitted = classes.orderBy(F.xxhash64("vector"), "id").limit(sample).select("vector").toArrow().column(0)
    by_length: dict[int, list] = {}
    for row in fitted:
        by_length.setdefault(len(row), []).append(row.as_py())
    most = max(by_length.values(), key=len, default=[[1.0]])
    mean, projection = fit_rotation(np.array(most, np.float64), bits)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(1)])
            for length in np.unique(lengths):
                own = batch.take(pa.array(np.flatnonzero(lengths == length)))
                keys = chunks_of(matrix(own.column(1)), mean, projection, chunk)
                for table in range(keys.shape[1]):
                    bucket = (np.int64(length) << 40) | (np.int64(table) << 32) | keys[:, table]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket, pa.int64()), *own.columns, pa.array(list(keys), pa.list_(pa.int64()))],
                        ["bucket", "id", "vector", "many", "keys"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in grouped(batches, ["bucket", "i", "j"]):
            plain = {k: table.column(k).to_numpy() for k in ("bucket", "id", "many", "own", "i", "j")}
            for start, end in zip(bounds[:-1], bounds[1:]):
                if end - start < 2:
                    continue
                rows = unit(matrix(table.column("vector").slice(start, end - start)))
                keys = matrix(table.column("keys").slice(start, end - start))
                here = (int(plain["bucket"][start]) >> 32) & 0xFF
                own, many, ids = (plain[k][start:end] for k in ("own", "many", "id"))
                crossing = plain["i"][start] != plain["j"][start]
                p_all, q_all = [], []
                for at in range(0, len(rows), 512):
                    near = rows[at : at + 512] @ rows.T >= cosine
                    p, q = np.nonzero(near)
                    p += at
                    fit = (p < q) & (own[p] != own[q]) if crossing else p < q
                    p_all.append(p[fit])
                    q_all.append(q[fit])
                p, q = np.concatenate(p_all), np.concatenate(q_all)
                if not len(p):
                    continue
                first = (keys[p, :here] != keys[q, :here]).all(axis=1)
                found = np.zeros(len(rows), np.int64)
                np.add.at(found, p[first], many[q[first]])
                np.add.at(found, q[first], many[p[first]])
                root = spanning(len(rows), p, q)
                touched = np.unique(np.concatenate([p, q]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[touched]), pa.array(found[touched]), pa.array(ids[root[touched]])],
                    ["id", "links", "root"],
                )

    kind = classes.schema["vector"].dataType.simpleString()
    spread_out = classes.select("id", "vector", "many").mapInArrow(
        spread, f"bucket long, id long, vector {kind}, many long, keys array<long>"
    )
    dealt = in_blocks(spread_out, ["bucket"], F.col("id"), block)
    return dealt.mapInArrow(compare, "id long, links long, root long")


def near_duplicates(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    bits: int = BITS,
    chunk_bits: int = CHUNK_BITS,
    block: int = BLOCK,
    sample: int = SAMPLE,
) -> DataFrame:
    """(key, n_links, component_id, kept) per row; other columns are not looked at.

    Equal vectors are one class and are compared once; they count in ``n_links``.  Vectors that
    are null, zero or hold null or non-finite components link with nothing and are their own
    component; vectors of different lengths never link.  Repeated rows count as rows.  A row
    with a null key takes part, but is never a component's smallest unless alone, and is
    not ``kept``.
    """
    table = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    good = usable(F.col("vector"))
    classes = table.filter(good).groupBy("vector").agg(F.min("key").alias("least"), F.count("*").alias("many"))
    classes = spill(classes.withColumn("id", F.monotonically_increasing_id()))
    found = spill(links(classes, cosine, bits, chunk_bits, block, sample))
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.filter("id != root").select("id", "root").distinct()
    roots = components(edges, "id", "root")
    placed = (
        classes.join(counted, "id", "left")
        .join(roots, F.col("id") == F.col("node"), "left")
        .select("vector", "many", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root"))
    )
    placed = spill(placed)
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(smallest.repartition("component_id", "root"), "root").select(
        F.col("vector").alias("twin"), (F.col("links") + F.col("many") - 1).alias("n_links"), "component_id"
    )
    joined = table.join(placed, (F.col("vector") == F.col("twin")) & good, "left")
    component = F.coalesce("component_id", "key")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
