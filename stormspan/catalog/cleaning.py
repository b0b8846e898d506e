"""Cleaning of dirty texts; the texts are rendered from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..functions.calendar import hour_number, hour_start, on_day, within_days
from ..functions.lookups import WATERWAY_OF_SEGMENT, waterway_name
from ..functions.radar import CITY_BOX
from ..sources.readers import html_elements as elements_of_html
from ..sources.readers import html_rows as rows_of_html
from ..sources.readers import is_product, time_from_name
from ..sources.readers import text_blocks as blocks_of_text
from ..sources.writers import feature, point_geometry
from .registry import query, table

_DIRTY = """dirty AS (SELECT event_id, user_id, date_trunc('hour', ts) AS ts, value,
    CASE WHEN event_id % 13 = 0 THEN 'null' WHEN event_id % 7 = 0 THEN 'trace' WHEN event_id % 11 = 0 THEN 'flagged' ELSE 'plain' END AS kind
  FROM events)"""


def _dirty(spark, folder):
    """Readings as text with traces ('T'), flags ('0.05s') and gaps, stamped by the hour."""
    number = F.col("value").cast("string")
    text = (
        F.when(F.col("event_id") % 13 == 0, F.lit(None))
        .when(F.col("event_id") % 7 == 0, F.lit("T"))
        .when(F.col("event_id") % 11 == 0, F.concat(number, F.lit("s")))
        .otherwise(number)
    )
    return table(spark, folder, "events").select(
        "event_id", "user_id", hour_start(hour_number("ts")).alias("ts"), text.alias("precip")
    )


@query(f"""WITH {_DIRTY}
SELECT event_id, user_id, ts,
  CASE WHEN bool_or(kind IN ('trace', 'flagged')) OVER (PARTITION BY user_id, ts) THEN 0.0::DOUBLE WHEN kind = 'plain' THEN value END AS precip
FROM dirty""")
def clean_strict(spark, folder):
    """Unreadable readings and all others of their instant become 0."""
    return clean.strict_precip(_dirty(spark, folder), "precip", "ts", ["user_id"])


@query(f"""WITH {_DIRTY}
SELECT event_id, user_id, ts, CASE WHEN kind IN ('plain', 'flagged') THEN value ELSE 0.0::DOUBLE END AS precip FROM dirty""")
def clean_lenient(spark, folder):
    """Digits are kept from a flagged reading; the rest becomes 0."""
    return _dirty(spark, folder).withColumn("precip", clean.lenient_precip("precip"))


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) + 0.5 AS share, CAST(1000 + p_size AS DOUBLE) AS filings, "
       "CASE WHEN p_partkey % 5 > 0 THEN CAST(p_size AS DOUBLE) END AS maybe FROM part")
def clean_percent(spark, folder):
    """Percent texts and numbers with thousands commas."""
    size = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        "p_partkey",
        clean.percent(F.concat(size, F.lit(".50%"))).alias("share"),
        clean.number(F.concat(F.lit("1,"), F.lpad(size, 3, "0"))).alias("filings"),
        clean.percent(F.when(F.col("p_partkey") % 5 > 0, F.concat(size, F.lit("%"))).otherwise("")).alias("maybe"),
    )


@query("SELECT p_partkey, regexp_replace(upper(p_name || '''' || p_brand), '[^A-Z ]+', '', 'g') AS area FROM part")
def clean_key(spark, folder):
    """Names brought to upper case letters and blanks."""
    name = F.concat("p_name", F.lit("'"), "p_brand")
    return table(spark, folder, "part").select("p_partkey", clean.area_key(name).alias("area"))


@query("""
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 3 AS form,
    least(CAST(o_orderdate AS DATE) + 2, last_day(CAST(o_orderdate AS DATE))) AS near, CAST(o_orderdate AS DATE) + 20 AS far FROM orders)
SELECT o_orderkey, d AS start_date,
  CASE WHEN form = 1 THEN near WHEN form = 2 AND year(far) = year(d) THEN far END AS end_date, CAST(year(d) AS INTEGER) AS year FROM r
""")
def parse_ranges(spark, folder):
    """Order dates written as irregular ranges and read back."""
    start = F.to_date("o_orderdate")
    near = F.least(F.date_add(start, 2), F.last_day(start))
    far = F.date_add(start, 20)
    form = F.col("o_orderkey") % 3
    text = (
        F.when(form == 1, F.concat(F.date_format(start, "M/d"), F.lit("-"), F.date_format(near, "d/yyyy ")))
        .when(
            (form == 2) & (F.year(far) == F.year(start)),
            F.concat(F.date_format(start, "M/d"), F.lit("-"), F.date_format(far, "M/d/yy")),
        )
        .otherwise(F.date_format(start, "M/d/yy"))
    )
    written = table(spark, folder, "orders").select("o_orderkey", text.alias("text"))
    return clean.with_date_range(written, "text").drop("text")


@query("""
WITH l AS (SELECT conv_id, turn, string_split(replace(text, chr(13), ''), chr(10)) AS lines FROM conversations),
b AS (SELECT *, unnest(generate_series(0, (len(lines) - 1) // 5)) AS block FROM l)
SELECT conv_id, turn, CAST(block AS INTEGER) AS block, lines[block * 5 + 1] AS first, lines[block * 5 + 2] AS second,
  lines[block * 5 + 3] AS third, lines[block * 5 + 4] AS fourth, lines[block * 5 + 5] AS fifth FROM b
""")
def text_blocks(spark, folder):
    """Conversation texts cut into blocks of five lines."""
    texts = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return blocks_of_text(texts, "text", 5, ["first", "second", "third", "fourth", "fifth"]).drop("text")


@query(r"""
WITH i AS (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS items FROM pages),
r AS (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS row_no FROM i)
SELECT page_id, CAST(row_no AS INTEGER) AS row_no, CAST(len(regexp_extract_all(item, '<a[^>]*>(.*?)</a>', 1)) AS INTEGER) AS cell_count,
  coalesce(array_to_string(list_transform(regexp_extract_all(item, '<a[^>]*>(.*?)</a>', 1), lambda c:
    regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(c, '<[^>]*>', '', 'g'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '^\s+|\s+$', '', 'g')), ' | '), '') AS cells
FROM r
""")
def html_rows(spark, folder):
    """List items of pages as table rows, their links as cells."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    found = rows_of_html(pages, "html", "<li>(.*?)</li>", "<a[^>]*>(.*?)</a>")
    return found.select(
        "page_id", "row_no", F.size("cells").alias("cell_count"), F.array_join("cells", " | ").alias("cells")
    )


@query(r"""
WITH i AS (SELECT page_id, regexp_extract_all(html, '(?s)<div class="ad">.*?</div>') AS items FROM pages)
SELECT page_id, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS element_no, unnest(items) AS element FROM i
""")
def html_elements(spark, folder):
    """Elements of pages chosen by tag and attribute."""
    return elements_of_html(table(spark, folder, "pages").select("page_id", "html"), "html", "div", "class", "ad").drop("html")


@query("""
SELECT event_id, CASE WHEN user_id % 9 = 0 THEN '0' ELSE CAST(60600 + user_id AS VARCHAR) END AS zip,
  CAST(user_id AS INTEGER) AS ward, event_id % 90000 AS open_seconds,
  ts - INTERVAL 5 HOUR AS local_ts, CAST(1 + event_id % 30 AS DOUBLE) * 24 AS day_hours, CAST(1 + event_id % 30 AS DOUBLE) AS hr_hours,
  CAST(1 + event_id % 30 AS DOUBLE) / 60 AS min_hours, CAST(event_id % 100 AS INTEGER) AS n FROM events
""")
def keys_and_durations(spark, folder):
    """Zip and ward keys, gate periods, epoch times and duration labels as text."""
    from ..functions.calendar import epoch_micros

    seconds = F.col("event_id") % 90000
    period = F.format_string(
        ":%02d:%02d:%02d",
        F.floor(seconds / 3600).cast("int"),
        (F.floor(seconds / 60) % 60).cast("int"),
        (seconds % 60).cast("int"),
    )
    zip_code = F.when(F.col("user_id") % 9 != 0, (F.col("user_id") + 60600).cast("double"))
    amount = (F.col("event_id") % 30 + 1).cast("string")
    return table(spark, folder, "events").select(
        "event_id",
        clean.zip_key(zip_code).alias("zip"),
        F.col("user_id").cast("string").try_cast("int").alias("ward"),
        clean.period_seconds(period).alias("open_seconds"),
        clean.shifted_micros(epoch_micros("ts")).alias("local_ts"),
        clean.duration_hours(F.concat(amount, F.lit("-day"))).alias("day_hours"),
        clean.duration_hours(F.concat(amount, F.lit("-hr"))).alias("hr_hours"),
        clean.duration_hours(F.concat(amount, F.lit("-min"))).alias("min_hours"),
        clean.return_period_number(F.concat((F.col("event_id") % 100).cast("string"), F.lit("-year"))).alias("n"),
    )


@query("""
SELECT o_orderkey AS id, 'Chicago' AS city, upper(o_orderpriority) AS priority, abs(o_totalprice - 200000) AS distance,
  pow(CAST(o_orderkey % 10 AS DOUBLE), 2) AS squared, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(o_orderdate AS DATE) AS day, o_totalprice / 25.4::DOUBLE AS inches, contains(o_orderpriority, 'LOW') AS is_low,
  year(o_orderdate) BETWEEN 2009 AND 2016 OR year(o_orderdate) = 1999 AS valid_date
FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-07-01' AND o_orderstatus IN ('F', 'O')
  AND o_orderpriority NOT IN ('2-HIGH') AND (o_totalprice > 100000 OR o_orderpriority = '1-URGENT')
""")
def row_basics(spark, folder):
    """Projection, renaming, constants, ranges, membership, string and date functions."""
    orders = table(spark, folder, "orders")
    chosen = orders.filter(
        within_days("o_orderdate", "1996-01-01", "1999-06-30")
        & F.col("o_orderstatus").isin("F", "O")
        & ~F.col("o_orderpriority").isin("2-HIGH")
        & ((F.col("o_totalprice") > 100_000) | (F.col("o_orderpriority") == "1-URGENT"))
    )
    us_date = F.date_format("o_orderdate", "M/d/yyyy")
    return chosen.withColumnsRenamed({"o_orderkey": "id"}).select(
        "id",
        F.lit("Chicago").alias("city"),
        F.upper("o_orderpriority").alias("priority"),
        F.abs(F.col("o_totalprice") - 200_000).alias("distance"),
        F.pow((F.col("id") % 10).cast("double"), F.lit(2.0)).alias("squared"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.to_date("o_orderdate").alias("day"),
        (F.col("o_totalprice") / F.lit(25.4)).alias("inches"),
        F.contains("o_orderpriority", F.lit("LOW")).alias("is_low"),
        (clean.valid_us_date(us_date) | clean.valid_us_date(us_date, 1999, 1999)).alias("valid_date"),
    )


@query("SELECT event_id, user_id, ts, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12'")
def one_day(spark, folder):
    """Rows of one calendar day."""
    return table(spark, folder, "events").select("event_id", "user_id", "ts", "value").filter(on_day("ts", "2024-01-12"))


_WATERWAYS = " ".join("WHEN {} THEN '{}'".format(k, v.replace("'", "''")) for k, v in WATERWAY_OF_SEGMENT.items())
_SEGMENTS = list(WATERWAY_OF_SEGMENT)


@query(f"SELECT segment, CASE segment {_WATERWAYS} END AS waterway FROM (SELECT DISTINCT "
       f"CAST(([{', '.join(map(str, _SEGMENTS))}])[(o_orderkey % {len(_SEGMENTS)}) + 1] AS INTEGER) AS segment FROM orders)")
def segment_names(spark, folder):
    """Waterway names of the segment numbers in use."""
    place = (F.col("o_orderkey") % len(_SEGMENTS)).cast("int") + 1
    segment = F.element_at(F.array(*[F.lit(s) for s in _SEGMENTS]), place)
    segments = table(spark, folder, "orders").select(segment.cast("int").alias("segment")).distinct()
    return segments.withColumn("waterway", waterway_name("segment"))


_HOLES = """holes AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN n_chars END AS n_chars, CASE WHEN doc_id % 6 <> 0 THEN lang END AS lang,
    CASE WHEN doc_id % 5 = 0 THEN 0.0::DOUBLE WHEN doc_id % 7 = 0 THEN 'nan'::DOUBLE ELSE CAST(doc_id AS DOUBLE) END AS dbz,
    41.5::DOUBLE + CAST(doc_id % 7 AS DOUBLE) / 10 AS lat, -88::DOUBLE + CAST(doc_id % 6 AS DOUBLE) / 10 AS lon FROM documents)"""


@query(f"""WITH {_HOLES}
SELECT 'complete' AS rule, count(*) FILTER (n_chars IS NOT NULL AND lang IS NOT NULL) AS rows FROM holes
UNION ALL SELECT 'filled', CAST(sum(CASE WHEN coalesce(n_chars, 0) = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM holes
UNION ALL SELECT 'null_only', count(*) FILTER (lang IS NULL) FROM holes
UNION ALL SELECT 'echo', count(*) FILTER (dbz <> 0 AND NOT isnan(dbz)) FROM holes
UNION ALL SELECT 'above_floor', count(*) FILTER (dbz > 20 AND NOT isnan(dbz)) FROM holes
UNION ALL SELECT 'in_box', count(*) FILTER (lat BETWEEN 41.644335 AND 42.0231311 AND lon BETWEEN -87.940267 AND -87.524044) FROM holes""")
def null_rules(spark, folder):
    """Row counts left by each rule on missing values."""
    holes = table(spark, folder, "documents").select(
        F.when(F.col("doc_id") % 4 != 0, F.col("n_chars")).alias("n_chars"),
        F.when(F.col("doc_id") % 6 != 0, F.col("lang")).alias("lang"),
        F.when(F.col("doc_id") % 5 == 0, F.lit(0.0))
        .when(F.col("doc_id") % 7 == 0, F.lit(float("nan")))
        .otherwise(F.col("doc_id").cast("double"))
        .alias("dbz"),
        (F.lit(41.5) + (F.col("doc_id") % 7).cast("double") / 10).alias("lat"),
        (F.lit(-88.0) + (F.col("doc_id") % 6).cast("double") / 10).alias("lon"),
    )
    echo = clean.present_or_missing("dbz")
    counted = holes.agg(
        F.count_if(F.col("n_chars").isNotNull() & F.col("lang").isNotNull()).alias("complete"),
        F.count_if(F.coalesce("n_chars", F.lit(0)) == 0).alias("filled"),
        F.count_if(F.col("lang").isNull()).alias("null_only"),
        F.count(echo).alias("echo"),
        F.count_if(echo > 20).alias("above_floor"),
        F.count_if(CITY_BOX.holds("lat", "lon")).alias("in_box"),
    )
    return counted.unpivot([], counted.columns, "rule", "rows")


@query("""
SELECT event_id, 'DAALOT' AS product, date_trunc('second', ts) AS scanned FROM events WHERE event_id % 3 = 0
""")
def product_times(spark, folder):
    """Files of one product by their names, and the times written there; events stand for files."""
    product = F.when(F.col("event_id") % 3 == 0, "DAALOT").otherwise("N0RLOT")
    name = F.concat(F.lit("radar/"), product, F.lit("_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".gz"))
    files = table(spark, folder, "events").select("event_id", name.alias("path"))
    return files.filter(is_product("path", "DAALOT")).select(
        "event_id", F.lit("DAALOT").alias("product"), time_from_name("path").alias("scanned")
    )


@query("""
SELECT c_custkey, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (c_custkey % 360 - 180) || ','
  || (c_custkey % 180 - 90) || ']},"properties":{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}}' AS feature
FROM customer
""")
def point_features(spark, folder):
    """Customers as GeoJSON point features, one text per row."""
    customers = table(spark, folder, "customer").withColumns({
        "lon": F.col("c_custkey") % 360 - 180, "lat": F.col("c_custkey") % 180 - 90,
    })
    return customers.select("c_custkey", feature(point_geometry(), ["c_custkey", "c_mktsegment"]).alias("feature"))
