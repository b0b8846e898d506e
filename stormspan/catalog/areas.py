"""Wide and long area matrices; orders per day and priority stand for calls per area."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import within_days
from ..operators import keys, reshape
from .registry import query, table
from .reports import NAMES, PRIORITY_SQL, dated_orders

_NULL_CELLS = ", ".join(f"nullif(count(*) FILTER ({PRIORITY_SQL} = '{n}'), 0) AS {n}" for n in NAMES)
_WIDE = f"wide AS (SELECT o_orderdate AS day, {_NULL_CELLS} FROM orders GROUP BY 1)"


def _wide(spark, folder):
    """One row per day, one column per priority, null where there was none."""
    return reshape.long_to_wide(
        dated_orders(spark, folder).withColumnRenamed("o_orderdate", "day"), ["day"], "priority", NAMES, F.count(F.lit(1))
    )


@query(f"WITH {_WIDE} SELECT * FROM wide")
def long_to_wide(spark, folder):
    return _wide(spark, folder)


@query(f"WITH {_WIDE} " + " UNION ALL ".join(
    f"SELECT day, '{n}' AS priority, {n} AS calls FROM wide WHERE {n} IS NOT NULL" for n in NAMES))
def wide_to_long(spark, folder):
    return reshape.wide_to_long(_wide(spark, folder), ["day"], NAMES, "priority", "calls")


_SUM = " + ".join(f"coalesce({n}, 0)" for n in NAMES)
_COUNT = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE 1 END" for n in NAMES)


@query(f"""WITH {_WIDE}
SELECT day, CAST({_SUM} AS DOUBLE) AS total, CAST({_SUM} AS DOUBLE) / ({_COUNT}) AS mean FROM wide""")
def row_means(spark, folder):
    """Sum and mean across the columns of a row, missing cells skipped."""
    return _wide(spark, folder).select(
        "day", reshape.row_sum(NAMES).alias("total"), reshape.row_mean(NAMES).alias("mean")
    )


@query(f"""WITH {_WIDE}
SELECT 'urgent' AS priority, CAST(sum(urgent) AS BIGINT) AS calls FROM wide WHERE day BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-30 23:59:59'
UNION ALL SELECT 'low', CAST(sum(low) AS BIGINT) FROM wide WHERE day BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-30 23:59:59'""")
def range_totals(spark, folder):
    """Totals of two columns inside a closed range of dates."""
    wide = _wide(spark, folder).filter(within_days("day", "1996-01-01", "1998-12-30"))
    return reshape.column_totals(wide, ["urgent", "low"], "priority", "calls")


_RATIO = f"""areas AS (SELECT c_nationkey AS area, count(*) FILTER ({PRIORITY_SQL} = 'urgent') AS basement,
    count(*) FILTER ({PRIORITY_SQL} = 'low') AS street FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
rated AS (SELECT *, CAST(basement AS DOUBLE) / nullif(street, 0) AS ratio FROM areas)"""


def _rated(spark, folder):
    """Calls per area and kind.

    Orders are counted per customer before they meet the customers, so a busy
    customer enters the join once.
    """
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    counted = orders.groupBy("c_custkey").agg(
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("basement"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("street"),
    )
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("area"))
    areas = counted.join(customers, "c_custkey").groupBy("area").agg(
        F.sum("basement").alias("basement"), F.sum("street").alias("street")
    )
    return areas.withColumn("ratio", F.try_divide(F.col("basement").cast("double"), F.col("street").cast("double")))


@query(f"""WITH {_RATIO}
SELECT * FROM (SELECT *, 'most' AS side FROM rated ORDER BY ratio DESC NULLS LAST, area LIMIT 15)
UNION ALL SELECT * FROM (SELECT *, 'least' AS side FROM rated ORDER BY ratio ASC NULLS FIRST, area LIMIT 15)""")
def ratio_topk(spark, folder):
    """Areas with the highest and the lowest ratio of two kinds of calls."""
    rated = _rated(spark, folder)
    most = keys.top_k(rated, 15, F.desc_nulls_last("ratio"), F.asc("area")).withColumn("side", F.lit("most"))
    least = keys.top_k(rated, 15, F.asc_nulls_first("ratio"), F.asc("area")).withColumn("side", F.lit("least"))
    return most.unionByName(least)


@query(f"""WITH {_RATIO}
SELECT area, basement, street, basement * 12.5::DOUBLE AS estimated FROM rated WHERE area NOT IN (3, 5, 7)""")
def estimated_counts(spark, folder):
    """A rate times a parcel count, outlier areas left out."""
    rated = _rated(spark, folder).filter(~F.col("area").isin(3, 5, 7))
    return rated.select("area", "basement", "street", (F.col("basement") * F.lit(12.5)).alias("estimated"))


@query("""
WITH z AS (SELECT c_nationkey AS zip, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS area FROM customer GROUP BY 1),
p AS (SELECT s_nationkey AS zip, count(*) AS suppliers FROM supplier GROUP BY 1)
SELECT zip, area, suppliers FROM z JOIN p USING (zip)
""")
def areas_without_fan_out(spark, folder):
    """A lookup with repeated keys is summed per key before it is joined."""
    lookup = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("zip"), F.col("c_acctbal").cast("decimal(18,2)").alias("area")
    )
    suppliers = table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("zip")).agg(
        F.count("*").alias("suppliers")
    )
    return keys.sum_duplicates(lookup, "zip", "area").withColumn("area", F.col("area").cast("double")).join(
        suppliers, "zip"
    )
