"""Frequency reports over order dates: years, seasons, buckets, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import (
    NINE_BUCKETS,
    THREE_BUCKETS,
    fixed_bucket,
    minutes_between,
    season,
    whole_units_between,
    year_bucket,
)
from ..operators import reshape, series, stats
from .registry import query, table

# The priorities that occur, under names that need no quoting; a null or any other goes to OTHER.
PRIORITY = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "not_specified",
    "5-LOW": "low",
}
OTHER = "other"
NAMES = [*PRIORITY.values(), OTHER]
PRIORITY_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY.items()) + f" ELSE '{OTHER}' END"
NAMES_SQL = "(VALUES " + ", ".join(f"('{n}')" for n in NAMES) + ") n(priority)"
CELLS_SQL = ", ".join(f"count(*) FILTER ({PRIORITY_SQL} = '{n}') AS {n}" for n in NAMES)


def priority_name(column="o_orderpriority"):
    pairs = [F.lit(x) for item in PRIORITY.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(OTHER))


def dated_orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.year("o_orderdate").alias("year"), priority_name().alias("priority")
    )


_GRID = f"""
SELECT CAST(y AS INTEGER) AS year, {', '.join(f'coalesce({n}, 0) AS {n}' for n in NAMES)}
FROM (SELECT unnest(generate_series(1993, 2003)) AS y) s
LEFT JOIN (SELECT year(o_orderdate) AS oy, {CELLS_SQL} FROM orders GROUP BY 1) o ON oy = y
"""


@query(_GRID)
def year_grid(spark, folder):
    """Orders per year and priority, with zeros for years without any."""
    return reshape.count_grid(dated_orders(spark, folder), "year", 1993, 2003, "priority", NAMES)


@query(f"WITH g AS ({_GRID}) SELECT {', '.join(f'CAST(sum({n}) AS BIGINT) AS {n}' for n in NAMES)}, "
       f"CAST(sum({' + '.join(NAMES)}) AS BIGINT) AS total, (SELECT count(*) FROM orders) AS orders FROM g")
def grid_control_totals(spark, folder):
    """Control sums of the grid beside the raw count: every order must be counted once."""
    grid = year_grid(spark, folder)
    total = sum((F.col(n) for n in NAMES[1:]), F.col(NAMES[0]))
    raw = table(spark, folder, "orders").agg(F.count("*").alias("orders"))
    sums = grid.agg(*[F.sum(n).alias(n) for n in NAMES], F.sum(total).alias("total"))
    return sums.withColumn("orders", raw.scalar())


_YEARS = [f"y{y}" for y in range(1995, 2002)]


@query("SELECT n.priority, " + ", ".join(f"count(*) FILTER (y = {c[1:]}) AS {c}" for c in _YEARS) +
       f" FROM {NAMES_SQL} LEFT JOIN (SELECT {PRIORITY_SQL} AS priority, year(o_orderdate) AS y FROM orders) o"
       " ON o.priority = n.priority GROUP BY 1")
def transpose_grid(spark, folder):
    """The year grid turned so that priorities are rows and years are columns."""
    grid = reshape.count_grid(dated_orders(spark, folder), "year", 1995, 2001, "priority", NAMES)
    named = grid.withColumn("year", F.concat(F.lit("y"), F.col("year").cast("string")))
    return reshape.transpose(named, "year", _YEARS, NAMES, "priority")


_SEASON_SQL = """CASE WHEN md <= 320 OR md > 1220 THEN 'winter' WHEN md <= 620 THEN 'spring'
  WHEN md <= 922 THEN 'summer' ELSE 'autumn' END"""


@query(f"""
SELECT {_SEASON_SQL} AS season, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows
FROM (SELECT *, month(o_orderdate) * 100 + day(o_orderdate) AS md FROM orders) GROUP BY 1, 2
""")
def season_counts(spark, folder):
    orders = dated_orders(spark, folder).withColumn("season", season("o_orderdate"))
    return stats.value_counts(orders, "season", "year")


@query("""
SELECT CASE WHEN y < 1986 THEN '1970-1985' WHEN y <= 2000 THEN '1986-2000' ELSE '2001-2015' END AS bucket3,
  CASE WHEN y <= 1995 THEN '1991-1995' WHEN y <= 2000 THEN '1996-2000' ELSE '2001-2005' END AS bucket9,
  CAST(1970 + 15 * ((y - 1970) // 15) AS INTEGER) AS bucket15, count(*) AS rows
FROM (SELECT year(o_orderdate) AS y FROM orders) GROUP BY ALL
""")
def year_buckets(spark, folder):
    orders = dated_orders(spark, folder).select(
        year_bucket("year", THREE_BUCKETS).alias("bucket3"),
        year_bucket("year", NINE_BUCKETS).alias("bucket9"),
        fixed_bucket("year", 1970, 15).alias("bucket15"),
    )
    return stats.value_counts(orders, "bucket3", "bucket9", "bucket15")


@query(f"""
WITH g AS ({_GRID.replace('1993, 2003', '1990, 2005')})
SELECT year, urgent, high, CAST(sum(urgent) OVER (ORDER BY year) AS BIGINT) AS urgent_so_far,
  CAST(sum(high) OVER (ORDER BY year) AS BIGINT) AS high_so_far FROM g
""")
def cumulative_small(spark, folder):
    """Cumulative events of two classes over a full range of years."""
    orders = dated_orders(spark, folder).filter(F.col("priority").isin("urgent", "high"))
    counts = reshape.long_to_wide(orders, ["year"], "priority", ["urgent", "high"], F.count(F.lit(1)))
    years = reshape.over_full_range(counts, "year", 1990, 2005)
    years = series.running_total(years, [], ["year"], "urgent", "urgent_so_far")
    return series.running_total(years, [], ["year"], "high", "high_so_far")


@query(f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, {CELLS_SQL}
FROM orders GROUP BY 1, 2
""")
def month_totals(spark, folder):
    orders = dated_orders(spark, folder).withColumn("month", F.month("o_orderdate"))
    counted = orders.groupBy("year", "month").pivot("priority", NAMES).agg(F.count(F.lit(1)))
    return counted.fillna(0, NAMES)


@query(f"SELECT n.priority, count(o.priority) AS calls FROM {NAMES_SQL} "
       f"LEFT JOIN (SELECT {PRIORITY_SQL} AS priority FROM orders) o ON o.priority = n.priority GROUP BY 1")
def column_totals(spark, folder):
    """Totals of every column of the monthly matrix, one row per column."""
    return reshape.column_totals(month_totals(spark, folder), NAMES, "priority", "calls")


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS rows, count(l_shipdate) AS dated,
  CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price,
  round(CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 6) AS mean_quantity,
  max(l_extendedprice) AS largest, min(l_extendedprice) AS smallest
FROM lineitem GROUP BY 1, 2
""")
def group_basics(spark, folder):
    """Sums, means, counts and extremes per group."""
    quantity = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("rows"),
        F.count("l_shipdate").alias("dated"),
        quantity.alias("quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
        F.round(quantity / F.count("*"), 6).alias("mean_quantity"),
        F.max("l_extendedprice").alias("largest"),
        F.min("l_extendedprice").alias("smallest"),
    )


_TRIPS_SQL = """trips AS (SELECT l_returnflag, o_custkey % 25 AS from_place, l_suppkey % 25 AS to_place,
    date_diff('minute', o_orderdate, l_shipdate) AS minutes, l_shipdate
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def _trips(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_returnflag",
        (F.col("o_custkey") % 25).alias("from_place"),
        (F.col("l_suppkey") % 25).alias("to_place"),
        whole_units_between("o_orderdate", "l_shipdate", "minute").alias("minutes"),
        "l_shipdate",
    )


@query(f"""WITH {_TRIPS_SQL}
SELECT l_returnflag, count(*) AS trips, count(l_shipdate) AS ended, count(minutes) AS timed,
  count(*) FILTER (from_place = to_place AND minutes < 500000) AS short_round,
  count(*) FILTER (from_place <> to_place AND minutes < 500000) AS short_moved,
  count(*) FILTER (minutes > 1000000) AS long
FROM trips GROUP BY 1""")
def trips(spark, folder):
    """Trip counts by kind: same place or not, short or long."""
    short = F.col("minutes") < 500_000
    same = F.col("from_place") == F.col("to_place")
    return _trips(spark, folder).groupBy("l_returnflag").agg(
        F.count("*").alias("trips"),
        F.count("l_shipdate").alias("ended"),
        F.count("minutes").alias("timed"),
        F.count_if(same & short).alias("short_round"),
        F.count_if(~same & short).alias("short_moved"),
        F.count_if(F.col("minutes") > 1_000_000).alias("long"),
    )


@query(f"""WITH {_TRIPS_SQL}
SELECT count(minutes) AS count, round(avg(minutes), 4) AS mean, round(stddev_samp(minutes), 4) AS std,
  CAST(min(minutes) AS DOUBLE) AS min, quantile_cont(minutes::DOUBLE, 0.25) AS p25, quantile_cont(minutes::DOUBLE, 0.5) AS p50,
  quantile_cont(minutes::DOUBLE, 0.75) AS p75, CAST(max(minutes) AS DOUBLE) AS max
FROM trips""")
def describe(spark, folder):
    summary = stats.describe(_trips(spark, folder), "minutes")
    return summary.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query(" UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS probability, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem"
    for p in (0.1, 0.25, 0.5, 0.75, 0.9)))
def price_percentiles(spark, folder):
    """Exact percentiles of a column with many distinct values."""
    found = stats.exact_percentiles(table(spark, folder, "lineitem"), "l_extendedprice", (0.1, 0.25, 0.5, 0.75, 0.9))
    return found.withColumn("value", F.round("value", 6))


@query("""
WITH lim AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin, count(*) AS rows FROM lineitem, lim GROUP BY 1)
SELECT CAST(s.bin AS INTEGER) AS bin, lo + s.bin * ((hi - lo) / 10) AS low, lo + (s.bin + 1) * ((hi - lo) / 10) AS high, coalesce(c.rows, 0) AS rows
FROM (SELECT unnest(generate_series(0, 9)) AS bin) s LEFT JOIN c ON c.bin = s.bin, lim
""")
def histogram(spark, folder):
    return stats.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 10)


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1:]))
def correlations(spark, folder):
    return stats.correlations(table(spark, folder, "lineitem"), _MEASURES).withColumn("r", F.round("r", 6))


_MONTHS = tuple(f"m{k}" for k in range(1, 13))


@query("""WITH areas AS (SELECT o_custkey % 97 AS area, """ + ", ".join(
    f"sum(o_totalprice) FILTER (month(o_orderdate) = {k + 1}) AS {m}" for k, m in enumerate(_MONTHS)
) + " FROM orders GROUP BY 1) " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM areas"
    for i, a in enumerate(_MONTHS) for b in _MONTHS[i + 1:]
))
def month_correlations(spark, folder):
    """How the totals of an area's months go together, over areas; a month without orders is unknown."""
    months = [
        F.sum(F.when(F.month("o_orderdate") == k + 1, F.col("o_totalprice"))).alias(m) for k, m in enumerate(_MONTHS)
    ]
    areas = table(spark, folder, "orders").groupBy((F.col("o_custkey") % 97).alias("area")).agg(*months)
    return stats.correlation_matrix(areas, _MONTHS).withColumn("r", F.round("r", 6))


_POINTS = """points AS (SELECT o_custkey % 97 AS area, count(*)::DOUBLE AS calls,
    (count(*) FILTER (o_orderstatus = 'F'))::DOUBLE AS approved FROM orders GROUP BY 1)"""


def _points(spark, folder):
    return table(spark, folder, "orders").groupBy((F.col("o_custkey") % 97).alias("area")).agg(
        F.count("*").cast("double").alias("calls"),
        F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("approved"),
    )


@query(f"""WITH {_POINTS}
SELECT area, calls, approved, round((SELECT regr_intercept(approved, calls) FROM points)
  + (SELECT regr_slope(approved, calls) FROM points) * calls, 6) AS predicted FROM points""")
def regression(spark, folder):
    """Approved claims predicted from the number of calls per area."""
    fitted = stats.with_prediction(_points(spark, folder), "calls", "approved")
    return fitted.withColumn("predicted", F.round("predicted", 6))


@query(f"""WITH {_POINTS}
SELECT round(regr_slope(approved, calls), 6) AS slope, round(regr_intercept(approved, calls), 6) AS intercept,
  round(regr_r2(approved, calls), 6) AS r2 FROM points""")
def regression_fit(spark, folder):
    fit = stats.linear_fit(_points(spark, folder), "calls", "approved")
    return fit.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")])


@query("""
SELECT o_orderkey, round(date_diff('minute', o_orderdate, TIMESTAMP '2001-12-31') / 60.0::DOUBLE, 6) AS hours FROM orders
""")
def order_age(spark, folder):
    """Fractional durations between two timestamps."""
    end = F.lit("2001-12-31 00:00:00").cast("timestamp_ntz")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate").withColumn("_end", end)
    return orders.select("o_orderkey", F.round(minutes_between("o_orderdate", "_end") / 60, 6).alias("hours"))
