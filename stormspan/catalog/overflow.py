"""Overflow feeds and totals; line items and orders stand for two event feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import add_minutes
from ..functions.lookups import (
    OWNER_CITY_SPELLINGS,
    REGISTRATION_CITY_SPELLINGS,
    RENTER_CITY_SPELLINGS,
    WATERWAY_OF_SEGMENT,
)
from ..functions.clean import canonical_city
from ..operators import keys, overflows
from .registry import query, table

_SEGMENTS = list(WATERWAY_OF_SEGMENT)
_SEGMENT_SQL = "CASE segment " + " ".join(
    "WHEN {} THEN '{}'".format(k, v.replace("'", "''")) for k, v in WATERWAY_OF_SEGMENT.items()
) + " END"


def _open_minutes():
    return (F.col("l_quantity") * 20).cast("int")


def _gate_times():
    """When a line item's gate opens and closes."""
    opened = add_minutes("l_shipdate", (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1440)
    return opened, add_minutes(opened, _open_minutes())


def _current_text_feed(spark, folder):
    """Line items rendered the way the current feed is published."""
    lines = table(spark, folder, "lineitem")
    opened, closed = _gate_times()
    minutes = _open_minutes()
    us = "M/d/yyyy h:mm:ss a"
    period = F.format_string(
        ":%02d:%02d:00", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int")
    )
    return lines.select(
        F.concat(F.lit("S-"), F.col("l_suppkey").cast("string")).alias("outfall_structure"),
        F.concat(F.lit("P-"), F.col("l_partkey").cast("string")).alias("outfall_location"),
        F.lit("All").alias("tide_gate"),
        F.col("l_returnflag").alias("waterway_reach"),
        F.col("l_linestatus").alias("plant"),
        F.date_format(opened, us).alias("open_text"),
        F.date_format(closed, us).alias("close_text"),
        period.alias("period_text"),
    )


def _archive_text_feed(spark, folder):
    """Orders rendered the way the archive is stored."""
    orders = table(spark, folder, "orders")
    start = add_minutes("o_orderdate", (F.col("o_orderkey") * 11) % 1440)
    segment = F.element_at(
        F.array(*[F.lit(s) for s in _SEGMENTS]), (F.col("o_orderkey") % len(_SEGMENTS)).cast("int") + 1
    )
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("location"),
        segment.alias("segment"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.date_format(start, "HH:mm").alias("starttime"),
        (F.col("o_orderkey") % 600).cast("int").alias("duration"),
    )


_UNIFIED = f"""
unified AS (
  SELECT 'S-' || l_suppkey AS outfall_structure, 'P-' || l_partkey AS outfall_location, 'All' AS tide_gate,
    l_returnflag AS waterway_reach, l_linestatus AS plant, opened AS open_time,
    opened + to_minutes(CAST(l_quantity * 20 AS BIGINT)) AS close_time, CAST(l_quantity * 20 AS BIGINT) * 60 AS open_seconds
  FROM (SELECT *, l_shipdate + to_minutes((l_orderkey * 7 + l_linenumber * 13) % 1440) AS opened FROM lineitem)
  UNION ALL
  SELECT 'C-' || o_custkey, 'C-' || o_custkey, '', {_SEGMENT_SQL}, '', opened,
    opened + to_minutes(o_orderkey % 600), (o_orderkey % 600) * 60
  FROM (SELECT *, o_orderdate + to_minutes((o_orderkey * 11) % 1440) AS opened,
    ([{', '.join(map(str, _SEGMENTS))}])[(o_orderkey % {len(_SEGMENTS)}) + 1] AS segment FROM orders))
"""


def _unified(spark, folder):
    return overflows.unify_feeds(_current_text_feed(spark, folder), _archive_text_feed(spark, folder))


@query(f"WITH {_UNIFIED} SELECT * FROM unified")
def unify_feeds(spark, folder):
    """Two text feeds parsed, brought to one layout and put together."""
    return _unified(spark, folder)


@query(f"""WITH {_UNIFIED}
SELECT waterway_reach, count(open_seconds) AS events, CAST(sum(open_seconds) AS BIGINT) AS open_seconds FROM unified GROUP BY 1""")
def waterway_report(spark, folder):
    """Events and total open time per waterway."""
    return _unified(spark, folder).groupBy("waterway_reach").agg(
        F.count("open_seconds").alias("events"), F.sum("open_seconds").alias("open_seconds")
    )


@query(f"""WITH {_UNIFIED},
by_structure AS (SELECT outfall_structure, CAST(sum(open_seconds) AS BIGINT) AS open_seconds FROM unified GROUP BY 1)
SELECT * FROM by_structure ORDER BY open_seconds DESC, outfall_structure LIMIT 10""")
def top_outfalls(spark, folder):
    """The ten structures with the longest total open time."""
    totals = _unified(spark, folder).groupBy("outfall_structure").agg(F.sum("open_seconds").alias("open_seconds"))
    return keys.top_k(totals, 10, F.desc("open_seconds"), F.asc("outfall_structure"))


_EVENTS = """events_of AS (SELECT l_suppkey, opened, closed, date_diff('minute', opened, closed)::DOUBLE AS minutes
  FROM (SELECT l_suppkey, opened, opened + to_minutes(CAST(l_quantity * 20 AS BIGINT)) AS closed
    FROM (SELECT *, l_shipdate + to_minutes((l_orderkey * 7 + l_linenumber * 13) % 1440) AS opened FROM lineitem)))"""
_TOTALS = """totals AS (SELECT l_suppkey, sum(minutes) AS total_minutes, any_value(s_name) AS s_name, any_value(s_nationkey) AS s_nationkey
    FROM chosen JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0 GROUP BY 1)
SELECT l_suppkey, total_minutes, s_name, s_nationkey,
  CASE WHEN row_number() OVER (ORDER BY total_minutes DESC, l_suppkey) <= 10 THEN 'red' ELSE 'blue' END AS color FROM totals"""


def _outfall_events(spark, folder):
    """One event per line item: a gate that opens on the shipping day and closes minutes later."""
    opened, closed = _gate_times()
    events = table(spark, folder, "lineitem").select("l_suppkey", opened.alias("opened"), closed.alias("closed"))
    return overflows.with_open_minutes(events, "opened", "closed")


def _locations(spark, folder):
    return table(spark, folder, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
    )


@query(f"WITH {_EVENTS}, chosen AS (SELECT * FROM events_of), {_TOTALS}")
def outfall_totals(spark, folder):
    """Minutes per located outfall, the ten largest flagged."""
    return overflows.outfall_totals(
        _outfall_events(spark, folder), _locations(spark, folder), "l_suppkey", "open_minutes"
    )


@query(f"""WITH {_EVENTS}, chosen AS (SELECT * FROM events_of
  WHERE CAST(opened AS DATE) >= DATE '1996-03-01' AND CAST(closed AS DATE) <= DATE '1999-06-30'), {_TOTALS}""")
def outfall_range(spark, folder):
    """The same for the events inside a range of days."""
    events = _outfall_events(spark, folder)
    chosen = events.filter(overflows.covered_by_range("opened", "closed", "1996-03-01", "1999-06-30"))
    return overflows.outfall_totals(chosen, _locations(spark, folder), "l_suppkey", "open_minutes")


_SIDES = """used AS (SELECT DISTINCT l_partkey AS k FROM lineitem),
known AS (SELECT DISTINCT o_custkey * 2 AS k FROM orders)"""


def _sides(spark, folder):
    """Part keys and even keys made from customers: each side has some that the other lacks."""
    used = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("k"))
    known = table(spark, folder, "orders").select((F.col("o_custkey") * 2).alias("k"))
    return used, known


@query(f"""WITH {_SIDES}
SELECT (SELECT count(*) FROM used WHERE k IN (SELECT k FROM known)) AS in_both,
  (SELECT count(*) FROM used WHERE k NOT IN (SELECT k FROM known)) AS only_left,
  (SELECT count(*) FROM known WHERE k NOT IN (SELECT k FROM used)) AS only_right""")
def semi_anti_keys(spark, folder):
    """How many keys two tables share and how many each has alone."""
    return keys.key_overlap(*_sides(spark, folder), "k")


@query(f"""WITH {_SIDES}
SELECT k, 'both' AS side FROM used WHERE k IN (SELECT k FROM known)
UNION ALL SELECT k, 'used' FROM used WHERE k NOT IN (SELECT k FROM known)""")
def set_keys(spark, folder):
    """The keys themselves: intersection and difference."""
    used, known = _sides(spark, folder)
    both = keys.in_both(used, known, "k").withColumn("side", F.lit("both"))
    return both.unionByName(keys.only_left(used, known, "k").withColumn("side", F.lit("used")))


_CITY = ["CHICAGO", "CHGO", "CHICATO", "EVANSTON", "CHICAGO IL", "OAK PARK", "CHICAGO APT B", "CHG"]
_SPELLED_SQL = f"""owners AS (SELECT c_custkey, c_acctbal,
    ([{', '.join(f"'{c}'" for c in _CITY)}])[(c_custkey % {len(_CITY)}) + 1] AS spelled FROM customer)"""


def _spelled(spark, folder):
    """Customers with a city the way people type it."""
    city = F.element_at(F.array(*[F.lit(c) for c in _CITY]), (F.col("c_custkey") % len(_CITY)).cast("int") + 1)
    return table(spark, folder, "customer").select("c_custkey", "c_acctbal", city.alias("city"))


@query(f"""WITH {_SPELLED_SQL},
chicago AS (SELECT c_custkey, c_acctbal, 'Chicago' AS city FROM owners WHERE spelled IN ('CHICAGO', 'CHGO', 'CHICATO', 'CHICAGO IL'))
SELECT o.o_orderkey, o.o_custkey AS c_custkey, c.c_acctbal, c.city FROM chicago c RIGHT JOIN orders o ON o.o_custkey = c.c_custkey""")
def right_disasters(spark, folder):
    """Claims under one city name, joined so that every disaster is kept."""
    claims = canonical_city(_spelled(spark, folder), "city", OWNER_CITY_SPELLINGS)
    declared = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return keys.keep_all_right(claims, declared, "c_custkey")


@query(f"""WITH {_SPELLED_SQL}
SELECT 'owner' AS list, c_custkey, c_acctbal, 'Chicago' AS city FROM owners WHERE spelled IN ('CHICAGO', 'CHGO', 'CHICATO', 'CHICAGO IL')
UNION ALL SELECT 'renter', c_custkey, c_acctbal, 'Chicago' FROM owners WHERE spelled IN ('CHICAGO', 'CHGO', 'CHICAGO IL', 'CHICAGO APT B')
UNION ALL SELECT 'registration', c_custkey, c_acctbal, 'Chicago' FROM owners
  WHERE spelled IN ('CHICAGO', 'CHGO', 'CHICATO', 'CHICAGO IL', 'CHICAGO APT B', 'CHG')""")
def city_spellings(spark, folder):
    """Rows under the city's name by the spellings each assistance table accepts."""
    lists = {"owner": OWNER_CITY_SPELLINGS, "renter": RENTER_CITY_SPELLINGS, "registration": REGISTRATION_CITY_SPELLINGS}
    owners = _spelled(spark, folder)
    parts = [canonical_city(owners, "city", known).withColumn("list", F.lit(name)) for name, known in lists.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
WITH o AS (SELECT o_orderdate AS day, count(*) AS orders FROM orders GROUP BY 1),
s AS (SELECT l_shipdate AS day, count(*) AS shipments FROM lineitem GROUP BY 1)
SELECT o.day, o.orders, s.shipments FROM o LEFT JOIN s ON s.day = o.day
""")
def align_by_date(spark, folder):
    """Daily shipments brought next to daily orders; both are counted before the join."""
    orders = table(spark, folder, "orders").groupBy(F.col("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    shipped = table(spark, folder, "lineitem").groupBy(F.col("l_shipdate").alias("day")).agg(
        F.count("*").alias("shipments")
    )
    return keys.align_left(orders, shipped, "day")


@query("""
SELECT r_name, n_name, c_mktsegment, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3
""")
def star_join(spark, folder):
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = keys.star_join(table(spark, folder, "customer"), [(nation, "c_nationkey"), (region, "n_regionkey")])
    return joined.groupBy("r_name", "n_name", "c_mktsegment").agg(
        F.count("*").alias("customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
    )


@query("""
WITH i AS (SELECT o_orderkey, o_custkey, o_orderdate AS opened, o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) AS closed FROM orders)
SELECT a.o_orderkey, a.o_custkey, a.opened, a.closed, count(b.o_orderkey) - 1 AS overlaps
FROM i a JOIN i b ON a.o_custkey = b.o_custkey AND a.opened <= b.closed AND b.opened <= a.closed GROUP BY 1, 2, 3, 4
""")
def overlap_counts(spark, folder):
    """With how many other open orders of its customer each order overlaps."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").alias("opened"),
        (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 90).cast("int"))).alias("closed"),
    )
    return overflows.overlap_counts(orders, ["o_custkey"], "opened", "closed")


@query("""
SELECT source, arg_min(lang, doc_id) FILTER (lang IS NOT NULL AND doc_id % 3 <> 0) AS lang,
  arg_min(n_chars, doc_id) FILTER (doc_id % 7 <> 0) AS n_chars, min(doc_id) AS doc_id
FROM documents GROUP BY source
""")
def first_nonnull(spark, folder):
    """First known value of each column per group, in document order."""
    documents = table(spark, folder, "documents").select(
        "source",
        "doc_id",
        F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"),
        F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")).alias("n_chars"),
    )
    return keys.first_known(documents, ["source"], ["lang", "n_chars", "doc_id"], F.col("doc_id") + 0)


@query("""
SELECT c_custkey, c_nationkey, c_acctbal, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r BETWEEN 6 AND 100
""")
def outlier_trim(spark, folder):
    """The hundred largest without the top five."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return keys.rank_slice(customers, 6, 100, F.desc("c_acctbal"), F.asc("c_custkey"))
