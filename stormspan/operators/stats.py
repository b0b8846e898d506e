"""Statistics: description, exact percentiles, correlation, regression, histogram."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import finite

#: Steps of the first look, rows per wrong place that it may be off, and ordered pieces per bracket.
GRID, ACCURACY, PIECES = 1000, 10_000, 256


def describe(df: DataFrame, column: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row: count, mean, sample deviation, min, percentiles, max; NaN counts as missing.

    The table is scanned twice: once for the plain figures and the percentiles'
    brackets together, once to count within the brackets.
    """
    value = F.col("value")
    known = _known_rows(df, column)
    first = _first_look(
        known,
        probabilities,
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quantiles = _within_brackets(known, first, probabilities)
    names = [f"p{round(p * 100)}" for p in probabilities]
    picked = quantiles.agg(*[
        F.max(F.when(F.col("probability") == F.lit(p), F.col("value"))).alias(name)
        for name, p in zip(names, probabilities)
    ]).withColumn("_first", first)
    plain = {c: F.col("_first")[c].alias(c) for c in ("count", "mean", "std", "min", "max")}
    return picked.select(*[plain[c] for c in ("count", "mean", "std", "min")], *names, plain["max"])


def exact_percentiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact, linearly interpolated percentiles: (probability, value).

    The built-in exact ``percentile`` keeps every distinct value in one task.
    Here a quantile sketch with a bounded rank error gives each wanted rank a
    bracket of values that must hold it, a few thousandths of the rows whatever
    their spread.  Then rows are counted: one by one inside the brackets, in one
    sum between them, so that little is shuffled.  A second sketch cuts each
    bracket into ``PIECES`` of about equal numbers of distinct values; running
    totals of the pieces tell which hold the wanted ranks, and only those few are
    ordered, each in a task of its own.  The table is scanned twice.
    """
    known = _known_rows(df, column)
    return _within_brackets(known, _first_look(known, probabilities), probabilities)


def _known_rows(df: DataFrame, column: str) -> DataFrame:
    """The values; a generator keeps what made them from being computed in every comparison."""
    return df.select(F.explode(F.array(_known(column))).alias("value")).filter(F.col("value").isNotNull())


def _sketch(steps: Sequence[int], whole: int) -> Column:
    """Values near the given shares of the rows; written as one text, as each literal costs a call."""
    shares = ", ".join(f"{step / whole!r}D" for step in steps)
    return F.expr(f"percentile_approx(value, array({shares}), {ACCURACY})")


def _first_look(known: DataFrame, probabilities: Sequence[float], *more: Column) -> Column:
    """One row as a scalar: ``total``, ``low`` and ``high`` per probability, and ``more``."""
    grid = _sketch(range(GRID + 1), GRID)
    looked = known.agg(F.count("value").alias("total"), grid.alias("_grid"), *more)
    slack = 2 / ACCURACY

    def at(place: Column) -> Column:
        step = F.greatest(F.least(place, F.lit(GRID)), F.lit(0))
        return F.get("_grid", step.cast("int"))

    total = F.col("total")
    ranks = [F.lit(p) * (total - 1) for p in probabilities]
    low = [at(F.floor(((F.floor(r) - 1) / total - slack) * GRID)) for r in ranks]
    high = [at(F.ceil(((F.ceil(r) + 2) / total + slack) * GRID)) for r in ranks]
    kept = [c for c in looked.columns if c not in ("_grid", "total")]
    return looked.select(F.struct("total", F.array(*low).alias("low"), F.array(*high).alias("high"), *kept)).scalar()


def _within_brackets(known: DataFrame, first: Column, probabilities: Sequence[float]) -> DataFrame:
    value = F.col("value")
    lows = [F.get("_first.low", F.lit(i)) for i in range(len(probabilities))]
    highs = [F.get("_first.high", F.lit(i)) for i in range(len(probabilities))]
    held, gap = F.lit(False), F.lit(0)
    for low, high in zip(lows, highs):
        held = held | value.between(low, high)
        gap = gap + (value > high).cast("int")
    # Between brackets only the number of rows matters; a gap's rows come before its bracket's.
    counts = (
        known.withColumn("_first", first)
        .select(gap.alias("gap"), F.when(held, value).alias("value"))
        .groupBy("gap", "value")
        .agg(F.count("*").alias("copies"))
    )
    cuts = counts.filter(value.isNotNull()).groupBy("gap").agg(
        _sketch(range(1, PIECES), PIECES).alias("cuts")
    )
    piece = F.when(value.isNull(), F.lit(-1)).otherwise(F.size(F.filter("cuts", lambda c: c < value)))
    # At most one row per bracket, and one of cut points.
    counts = counts.join(F.broadcast(cuts), "gap", "left").select("gap", "value", "copies", piece.alias("piece"))
    ordered = Window.orderBy("gap", "piece").rowsBetween(Window.unboundedPreceding, 0)
    pieces = counts.groupBy("gap", "piece").agg(F.sum("copies").alias("copies")).select(
        "gap",
        "piece",
        (F.sum("copies").over(ordered) - F.col("copies")).alias("before"),
        F.sum("copies").over(ordered).alias("through"),
        first.alias("_first"),
    )
    # Two ranks per probability: the rows below and above the interpolated place.
    wanted = F.array(*[_rank_struct(p, side, F.col("_first.total")) for p in probabilities for side in (0, 1)])
    hit = pieces.select("gap", "piece", "before", "through", F.inline(wanted)).filter(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("through"))
    )
    # At most two rows per probability; a piece is ordered once for each rank that it holds.
    inside = Window.partitionBy("probability", "side").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    through = F.col("before") + F.sum("copies").over(inside)
    fine = counts.join(F.broadcast(hit), ["gap", "piece"]).withColumn("_hi", through)
    found = fine.filter((F.col("rank") >= F.col("_hi") - F.col("copies")) & (F.col("rank") < F.col("_hi")))
    # The sketch's error is bounded; should a rank lie outside all the same, the job ends.
    sure = F.coalesce("value", F.raise_error(F.lit("a rank lies outside of its bracket")).cast("double"))
    ends = found.groupBy("probability").agg(
        F.max(F.when(F.col("side") == 0, sure)).alias("_below"),
        F.max(F.when(F.col("side") == 1, sure)).alias("_above"),
        F.max("weight").alias("_weight"),
    )
    return ends.select(
        "probability",
        (F.col("_below") + (F.col("_above") - F.col("_below")) * F.col("_weight")).alias("value"),
    )


def _known(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _rank_struct(probability: float, side: int, total: Column) -> Column:
    place = F.lit(probability) * (total - 1)
    rank = F.floor(place) if side == 0 else F.ceil(place)
    return F.struct(
        F.lit(probability).alias("probability"),
        F.lit(side).alias("side"),
        rank.cast("bigint").alias("rank"),
        (place - F.floor(place)).alias("weight"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair: (column_a, column_b, r).

    All pairs share one aggregation; rows with a null in a pair are left out of
    that pair only.
    """
    pairs = list(combinations(columns, 2))
    measured = df.agg(
        *[
            F.corr(F.when(F.col(b).isNotNull(), F.col(a)).cast("double"), F.when(F.col(a).isNotNull(), F.col(b)).cast("double")).alias(f"r{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ])
    return measured.select(F.inline(rows))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of many columns: (column_a, column_b, r).

    For dozens of columns and more, where an aggregate expression per pair would not compile.
    Each task multiplies blocks of rows with masks of what is known, and what leaves it is one
    row of sums per pair; a task holds four square matrices of the number of columns.  Values
    are taken relative to a median of their column, so that large offsets cancel nothing.

    A row counts for the pairs whose two values it has; NaN and infinite values are missing.
    r is null for fewer than two such rows and where a column does not vary over them.
    """
    columns = list(columns)
    size = len(columns)
    rows = df.select(*[finite(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    middle = rows.agg(*[F.percentile_approx(f"c{i}", 0.5, 100).alias(f"c{i}") for i in range(size)]).first()
    offsets = [value or 0.0 for value in middle]
    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")

    def products(batches):
        import numpy as np
        import pyarrow as pa

        known, first, second, cross = (np.zeros((size, size)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - offsets
            there = np.isfinite(x)
            x[~there] = 0.0
            mask = there.astype(float)
            known += mask.T @ mask
            first += x.T @ mask
            second += (x * x).T @ mask
            cross += x.T @ x
        a, b = np.triu_indices(size, 1)
        values = (known[a, b], first[a, b], first[b, a], second[a, b], second[b, a], cross[a, b])
        arrays = [pa.array(i.astype("int32")) for i in (a, b)] + [pa.array(v) for v in values]
        yield pa.RecordBatch.from_arrays(arrays, ["a", "b", *sums])

    parts = rows.mapInArrow(products, "a int, b int, " + ", ".join(f"{c} double" for c in sums))
    whole = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in sums])

    def spread(of: str) -> Column:
        total = F.col("n") * F.col(f"s{of}{of}")
        left = total - F.col(f"s{of}") * F.col(f"s{of}")
        return F.when(left > total * 1e-13, left)

    r = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.sqrt(spread("x")) * F.sqrt(spread("y")))
    names = F.array(*[F.lit(c) for c in columns])
    return whole.select(
        F.get(names, "a").alias("column_a"),
        F.get(names, "b").alias("column_b"),
        F.when((F.col("n") >= 2) & r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"),
    )


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares of y on x: (slope, intercept, r2), one row."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def with_prediction(df: DataFrame, x: str, y: str, out: str = "predicted") -> DataFrame:
    """Fitted value for every row; the one-row model enters as a scalar subquery."""
    model = linear_fit(df, x, y).select(F.struct("slope", "intercept")).scalar()
    fitted = df.withColumn("_model", model)
    return fitted.withColumn(out, F.col("_model.intercept") + F.col("_model.slope") * F.col(x)).drop("_model")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the column's range, empty bins included; the last bin is closed."""
    limits = df.agg(
        F.struct(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")).alias("limits")
    ).scalar()
    low, high = F.col("_limits.low"), F.col("_limits.high")
    share = F.coalesce(F.try_divide(F.col(column).cast("double") - low, high - low), F.lit(0.0))
    bin_no = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    placed = df.filter(F.col(column).isNotNull()).select(column).withColumn("_limits", limits)
    counts = placed.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("rows"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = spine.join(counts, "bin", "left").fillna(0, ["rows"]).withColumn("_limits", limits)
    width = (high - low) / F.lit(float(bins))
    return filled.select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        "rows",
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))
