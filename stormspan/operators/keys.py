"""Joins and set operations on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Inner-join dimensions one after another on named keys.

    No broadcast hints: adaptive execution broadcasts a dimension once its size
    is measured to be under the session's limit, and sort-merges it otherwise.
    """
    for dimension, key in dimensions:
        fact = fact.join(dimension, key)
    return fact


def align_left(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Bring the right table's columns to the left rows (index-aligned assignment)."""
    return left.join(right, key, "left")


def keep_all_right(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return left.join(right, key, "right")


def in_both(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present on both sides."""
    return left.select(key).intersect(right.select(key))


def only_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys missing on the right."""
    return left.select(key).subtract(right.select(key))


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys on both sides, only left and only right, in one shuffle.

    Keys are marked by side and reduced map-side, so a hot key costs one row per
    task.
    """
    sides = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    seen = sides.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.agg(
        F.count_if((F.col("_l") == 1) & (F.col("_r") == 1)).alias("in_both"),
        F.count_if(F.col("_r") == 0).alias("only_left"),
        F.count_if(F.col("_l") == 0).alias("only_right"),
    )


def first_known(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str | Column) -> DataFrame:
    """Per group the first non-null value of each column, by an explicit order."""
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    )


def sum_duplicates(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key, so that a lookup with repeated keys does not fan out a join."""
    return df.groupBy(key).agg(F.sum(value).alias(value))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows in the given order; each task keeps only its own k."""
    return df.orderBy(*order).limit(k)


def rank_slice(df: DataFrame, first: int, last: int, *order: Column) -> DataFrame:
    """Rows ranked ``first`` to ``last`` in the given order.

    Ranks above ``last`` never matter, so the rows are reduced to the top
    ``last`` before they are numbered; the single-task window sees only those.
    """
    from pyspark.sql import Window

    best = top_k(df, last, *order)
    numbered = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return numbered.filter(F.col("rank") >= first)
