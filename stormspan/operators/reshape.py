"""Wide and long tables, count grids, row-wise totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide_to_long(
    wide: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per (id, column) with a value; null cells are dropped."""
    return wide.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull())


def long_to_wide(
    long: DataFrame, ids: Sequence[str], name: str, names: Sequence, aggregate: Column
) -> DataFrame:
    """Pivot with a given list of columns, which saves the pass that would find them."""
    return long.groupBy(*ids).pivot(name, list(names)).agg(aggregate)


def transpose(wide: DataFrame, row_key: str, rows: Sequence, columns: Sequence[str], name: str) -> DataFrame:
    """Swap rows and columns of a small table whose row keys are known; cells of a repeated row key add up."""
    long = wide_to_long(wide, [row_key], columns, name, "_cell")
    return long.groupBy(name).pivot(row_key, list(rows)).agg(F.sum("_cell"))


def column_totals(wide: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Total of every column as one row per column; one aggregation, then a 1-row unpivot."""
    return wide.agg(*[F.sum(c).alias(c) for c in columns]).unpivot([], list(columns), name, value)


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns, nulls skipped; null when all are null."""
    return _row_total(columns)[0]


def row_mean(columns: Sequence[str]) -> Column:
    """Mean across columns over the non-null ones."""
    total, count = _row_total(columns)
    return total / count


def _row_total(columns: Sequence[str]) -> tuple[Column, Column]:
    total, count = None, None
    for c in columns:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        one = F.when(F.col(c).isNotNull(), 1).otherwise(0)
        total = value if total is None else total + value
        count = one if count is None else count + one
    return F.when(count > 0, total), F.nullif(count, F.lit(0))


def count_grid(
    df: DataFrame, row: str, first: int, last: int, column: str, columns: Sequence
) -> DataFrame:
    """Counts per (row number, column value), zeros included, one column per value.

    Rows are reduced to the grid's size before the spine of row numbers is
    joined, so the join handles at most ``last - first + 1`` rows a side.
    """
    spark = df.sparkSession
    counts = (
        df.filter(F.col(row).between(first, last))
        .groupBy(F.col(row).cast("int").alias(row))
        .pivot(column, list(columns))
        .agg(F.count(F.lit(1)))
    )
    spine = spark.range(first, last + 1).select(F.col("id").cast("int").alias(row))
    return spine.join(counts, row, "left").fillna(0, [str(c) for c in columns])


def over_full_range(df: DataFrame, row: str, first: int, last: int) -> DataFrame:
    """Reindex a per-number table to a full range of numbers, filling counts with 0."""
    spine = df.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(row))
    return spine.join(df, row, "left").fillna(0)
