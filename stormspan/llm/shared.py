"""Helpers of the operators: shared scratch tables, grouped Arrow streams, blocks of hot
groups, connected components."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.  Where that is unset, the session's
    checkpoint folder or, in a single process as in tests, a local temporary one takes its
    place; on a cluster, whose executors would each write to a folder of their own, it is an
    error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not single_process(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stormspan-")
        base = f"file://{base}"
    return f"{base.rstrip('/')}/stormspan-{uuid.uuid4().hex}"


def single_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def spill(frame: DataFrame) -> DataFrame:
    """Write a frame to a scratch table and read it again: one computation, short lineage,
    and nothing to lose with an executor."""
    spark = frame.sparkSession
    path = scratch(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the files of a spilled frame that nothing reads any more."""
    spark = frame.sparkSession
    for name in frame.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Recent(dict):
    """A bounded table of results by key, made by ``make`` where they are missing.  A full
    generation becomes the old one, from which what is asked for again comes back."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > 64:
                return found
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Bounded(dict):
    """A table of results by key, made by ``make`` where they are missing, of at most ``most``
    bytes by its own count; a full one starts anew.  Whoever fills it in a task clears it when
    the task ends, as workers live on."""

    #: Of an entry, besides what its key and result hold.
    ENTRY = 100

    def __init__(self, make: Callable, most: int):
        self.make, self.most, self.held = make, most, 0

    def __missing__(self, key):
        found = self.make(key)
        size = sys.getsizeof(key) + sys.getsizeof(found) + self.ENTRY
        if self.held + size > self.most:
            self.clear()
        if size <= self.most:
            self.held += size
            self[key] = found
        return found

    def clear(self):
        super().clear()
        self.held = 0


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 4; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % 4


def held_out(key: Column) -> Column:
    """True where nothing may be learned from the row: remainder 2, or no key."""
    return F.coalesce(fold(key) == 2, F.lit(True))


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From a stream sorted by integer ``keys``: tables of whole groups and the bounds of the
    groups in them.  Only the last, unfinished group is carried over."""
    carry: list[pa.Table] = []

    def edges(table: pa.Table) -> np.ndarray:
        new = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
        for key in keys:
            column = table.column(key).to_numpy()
            new |= column[1:] != column[:-1]
        return np.flatnonzero(new) + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        carry.append(pa.Table.from_batches([batch]))
        table = pa.concat_tables(carry)
        inner = edges(table)
        if len(inner):
            yield table.slice(0, inner[-1]), np.concatenate([[0], inner])
            table = table.slice(inner[-1])
        carry = [table.combine_chunks()]
    if carry and carry[0].num_rows:
        table = pa.concat_tables(carry)
        yield table, np.concatenate([[0], edges(table), [table.num_rows]])


def in_blocks(frame: DataFrame, keys: list[str], by: Column, block: int) -> DataFrame:
    """Deal the rows of each group out for comparing all with all in bounded tasks.

    A group of n rows gets g = ceil(n / block) blocks; a row of block b goes to the g pairs of
    blocks (i <= j) that hold b.  Any two rows meet in exactly one pair.  Adds ``own`` (b),
    ``i`` and ``j``, repartitions and sorts by (keys, i, j).
    """
    hot = (
        frame.groupBy(*keys)
        .count()
        .filter(F.col("count") > block)
        .select(*keys, F.ceil(F.col("count") / block).cast("int").alias("g"))
    )
    dealt = frame.join(hot, keys, "left").withColumn("g", F.coalesce("g", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.hash(by), F.col("g")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    return dealt.drop("g", "other").repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges`` that is not its component's smallest.

    Alternating large-star and small-star steps until nothing changes.  Minima are taken with
    map-side combine; they then join the edges through an exchange of their own, so that
    adaptive execution can split the edges of a hub.
    """
    spark = edges.sparkSession

    def lowest(frame: DataFrame) -> DataFrame:
        return frame.groupBy("u").agg(F.min("v").alias("m")).repartition(F.col("m"), F.col("u"))

    def digest(frame: DataFrame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()

    now = spill(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    )
    before = digest(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(lowest(both).withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        large = spill(large)
        small = large.join(lowest(large).withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
            F.when(F.col("v") != F.col("m"), F.col("u")).alias("also"),
        )
        small = small.select(F.explode(F.array_compact(F.array("u", "also"))).alias("u"), "v")
        after = spill(small.filter("u > v").distinct())
        seen = digest(after)
        discard(now)
        discard(large)
        now = after
        if seen == before:
            break
        before = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores until no column has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name
