"""Return-period classes and storms per user; limits are scaled to the event values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.thresholds import INCHES, RETURN_PERIODS, HOURS, bands, hours_to_class, threshold
from ..operators import series, storms
from ..operators.bands import windows_in_bands
from .rain import hourly_cte
from .registry import query, table

SCALE = 100.0
BANDS = bands(scale=SCALE)
ONE_YEAR = {band.hours: band.lowest for band in BANDS}


def _user_series(spark, folder):
    return series.hourly_max(table(spark, folder, "events"), ["user_id"])


def _frame(k: int, part: str) -> str:
    return f"OVER (PARTITION BY {part} ORDER BY ts ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def _class_sql(band, column: str) -> str:
    cases = " ".join(f"WHEN {column} >= {limit}::DOUBLE THEN {n}" for n, limit in reversed(band.limits))
    return f"CAST(CASE {cases} END AS INTEGER)"


def candidate_cte(source: str = "hourly", part: str = "user_id", full: bool = False, kept: str = "") -> str:
    """SQL of all classified windows: (part, n, duration_hrs, start_time, end_time, inches)."""
    pieces = []
    for band in BANDS:
        total = f"CAST(sum(CAST(value AS DECIMAL(18, 4))) {_frame(band.hours, part)} AS DOUBLE)"
        whole = f"count(value) {_frame(band.hours, part)} = {band.hours}" if full else "true"
        pieces.append(f"""
        SELECT {part}, {_class_sql(band, 'x')} AS n, CAST({band.hours} AS INTEGER) AS duration_hrs,
          ts - INTERVAL {band.hours} HOUR AS start_time, ts AS end_time, x AS inches
        FROM (SELECT {part}, ts, {total} AS x, {whole} AS ok FROM {source})
        WHERE ok AND x >= {band.lowest}::DOUBLE""")
    return f"candidates AS ({' UNION ALL '.join(pieces)})"


@query(f"""WITH {hourly_cte('user_id')}, {candidate_cte(full=True)}
SELECT duration_hrs, n, count(*) AS windows FROM candidates GROUP BY 1, 2""")
def band_counts(spark, folder):
    """Window ends per duration and return-period class."""
    return storms.band_counts(_user_series(spark, folder), ["user_id"], "ts", "value", BANDS)


@query(" UNION ALL ".join(f"""SELECT '{duration}' AS duration, CAST({n} AS INTEGER) AS n, count(DISTINCT user_id) AS users, count(*) AS readings
FROM events WHERE value >= {INCHES[duration][i] * SCALE}::DOUBLE""" for duration in ("1-hr", "24-hr") for i, n in enumerate(RETURN_PERIODS)))
def readings_over_threshold(spark, folder):
    """Readings that alone reach a named duration's n-year threshold."""
    named = [(duration, n) for duration in ("1-hr", "24-hr") for n in RETURN_PERIODS]
    limits = F.array(*[
        F.struct(F.lit(d).alias("duration"), F.lit(n).alias("n"), F.lit(threshold(d, n) * SCALE).alias("low")) for d, n in named
    ])
    spread = table(spark, folder, "events").select("user_id", "value", F.inline(limits))
    over = F.col("value") >= F.col("low")
    return spread.groupBy("duration", "n").agg(
        F.count_distinct(F.when(over, F.col("user_id"))).alias("users"), F.count_if(over).alias("readings")
    )


_TABLE_HOURS = (1, 6, 24)
_TABLE_LIMITS = """limits AS (SELECT CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 6 ELSE 24 END AS duration_hrs,
  abs(s_acctbal) / 10 AS low, max(s_suppkey) AS n FROM supplier GROUP BY 1, 2)"""
_TABLE_WINDOWS = " UNION ALL ".join(
    f"""SELECT {k} AS duration_hrs, CAST(sum(CAST(value AS DECIMAL(18, 4))) {_frame(k, 'user_id')} AS DOUBLE) AS x FROM hourly"""
    for k in _TABLE_HOURS
)


@query(f"""WITH {hourly_cte('user_id')}, {_TABLE_LIMITS}, totals AS ({_TABLE_WINDOWS})
SELECT CAST(t.duration_hrs AS INTEGER) AS duration_hrs, l.n, count(*) AS windows
FROM totals t ASOF JOIN limits l ON t.duration_hrs = l.duration_hrs AND t.x >= l.low GROUP BY 1, 2""")
def table_band_counts(spark, folder):
    """Window ends per duration and class, the limits read from a table."""
    limits = table(spark, folder, "supplier").select(
        F.when(F.col("s_suppkey") % 3 == 0, 1).when(F.col("s_suppkey") % 3 == 1, 6).otherwise(24).alias("duration_hrs"),
        F.col("s_suppkey").alias("n"),
        (F.abs("s_acctbal") / 10).alias("limit"),
    )
    found = windows_in_bands(_user_series(spark, folder), ["user_id"], "ts", "value", _TABLE_HOURS, limits)
    return found.groupBy("duration_hrs", "n").agg(F.count("*").alias("windows"))


def _greedy_sql(part: str, rank: str, touch: str) -> str:
    """SQL that keeps the best candidate left of every part, round by round, and drops what it touches."""
    best = f"""min(r) OVER (PARTITION BY {part}) AS best, first_value(start_time) OVER (PARTITION BY {part} ORDER BY r) AS s,
      first_value(end_time) OVER (PARTITION BY {part} ORDER BY r) AS e"""
    return f"""
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {rank}) AS r FROM candidates),
    walk AS (
      SELECT *, {best} FROM ranked
      UNION ALL
      SELECT * EXCLUDE (best, s, e), {best} FROM walk
      WHERE NOT (s {touch} end_time AND start_time {touch} e))"""


@query(f"""WITH RECURSIVE {hourly_cte('user_id')}, {candidate_cte()},
{_greedy_sql('user_id', 'n DESC, duration_hrs DESC, inches DESC, end_time', '<=')}
SELECT user_id, n, duration_hrs, start_time, end_time, inches FROM walk WHERE r = best""")
def unique_storms(spark, folder):
    return storms.unique_storms(_user_series(spark, folder), ["user_id"], "ts", "value", BANDS)


def _limit_cte() -> str:
    pieces = [
        f"""SELECT user_id, CAST({k} AS INTEGER) AS duration_hrs, ts - INTERVAL {k} HOUR AS start_time, ts AS end_time, x AS inches
        FROM (SELECT user_id, ts, CAST(sum(CAST(value AS DECIMAL(18, 4))) {_frame(k, 'user_id')} AS DOUBLE) AS x,
          count(value) {_frame(k, 'user_id')} AS rows FROM hourly) WHERE rows = {k} AND x >= {limit}::DOUBLE"""
        for k, limit in ONE_YEAR.items()
    ]
    return f"candidates AS ({' UNION ALL '.join(pieces)})"


@query(f"""WITH RECURSIVE {hourly_cte('user_id')}, {_limit_cte()},
{_greedy_sql('user_id, duration_hrs', 'inches DESC, end_time', '<')}
SELECT user_id, duration_hrs, start_time, end_time, inches FROM walk WHERE r = best""")
def storms_per_duration(spark, folder):
    hourly = _user_series(spark, folder)
    return storms.storms_per_duration(hourly, ["user_id"], "ts", "value", ONE_YEAR)


_FIRST, _LAST = "2024-01-08 00:00:00", "2024-01-15 00:00:00"


@query(f"""WITH {hourly_cte('user_id', name='all_hours')},
hourly AS (SELECT * FROM all_hours WHERE ts BETWEEN TIMESTAMP '{_FIRST}' AND TIMESTAMP '{_LAST}'),
{candidate_cte()}
SELECT * FROM candidates WHERE start_time >= TIMESTAMP '{_FIRST}'""")
def sub_period_storms(spark, folder):
    """Storms inside one week, with rolling totals that see only that week."""
    first, last = (F.lit(t).cast("timestamp_ntz") for t in (_FIRST, _LAST))
    return storms.storms_within(_user_series(spark, folder), ["user_id"], "ts", "value", BANDS, first, last)


@query(f"""WITH {hourly_cte('user_id', name='all_hours')},
ends AS (SELECT DISTINCT user_id AS u, date_trunc('day', ts) + INTERVAL 1 DAY AS day_end FROM events WHERE event_type = 'error'),
hourly AS (SELECT row_number() OVER () AS ignored, u, day_end, ts, value, CAST(u AS VARCHAR) || ' ' || CAST(day_end AS VARCHAR) AS slice
  FROM ends JOIN all_hours ON all_hours.user_id = u AND ts BETWEEN day_end - INTERVAL 10 DAY AND day_end),
{candidate_cte(part='slice')},
best AS (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY n DESC, duration_hrs DESC, inches DESC, end_time) AS r FROM candidates)
SELECT e.event_id, e.user_id, e.ts, b.n, b.duration_hrs, b.inches, b.end_time AS storm_end
FROM events e LEFT JOIN best b ON b.r = 1
  AND b.slice = CAST(e.user_id AS VARCHAR) || ' ' || CAST(date_trunc('day', e.ts) + INTERVAL 1 DAY AS VARCHAR)
WHERE e.event_type = 'error'""")
def lookback_storm(spark, folder):
    """Highest storm class in the ten days up to the end of each error event's day."""
    errors = table(spark, folder, "events").filter(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    return storms.highest_storm_before(
        errors, ["user_id"], "ts", _user_series(spark, folder), "ts", "value", BANDS
    )


_RAIN_EVENTS = f"""WITH {hourly_cte('user_id')},
rolled AS (SELECT user_id, ts, value,
    CAST(sum(CAST(value AS DECIMAL(18, 4))) {_frame(12, 'user_id')} AS DOUBLE) AS roll FROM hourly),
marked AS (SELECT *, coalesce(lag(roll) OVER (PARTITION BY user_id ORDER BY ts), 0) AS roll_prev,
    min(CASE WHEN roll < 4.0 THEN ts END) OVER (PARTITION BY user_id ORDER BY ts
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - INTERVAL 12 HOUR AS end_time FROM rolled)"""


@query(f"""{_RAIN_EVENTS},
starts AS (SELECT user_id, ts - INTERVAL 1 HOUR AS start_time, end_time FROM marked WHERE value > 4.0 AND roll_prev < 4.0)
SELECT s.user_id, s.start_time, s.end_time, date_diff('hour', s.start_time, s.end_time) AS duration_hrs,
  CASE WHEN s.end_time IS NOT NULL THEN CAST(sum(CAST(h.value AS DECIMAL(18, 4))) AS DOUBLE) END AS total_precip
FROM starts s LEFT JOIN hourly h ON h.user_id = s.user_id AND h.ts BETWEEN s.start_time AND s.end_time
GROUP BY s.user_id, s.start_time, s.end_time""")
def rain_events(spark, folder):
    return storms.rain_events(_user_series(spark, folder), ["user_id"], "ts", "value", floor=4.0)


@query(f"""{_RAIN_EVENTS},
runs AS (SELECT *, sum(CASE WHEN roll >= 4.0 AND coalesce(roll_before, 0) < 4.0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts) AS run
  FROM (SELECT *, lag(roll) OVER (PARTITION BY user_id ORDER BY ts) AS roll_before FROM rolled))
SELECT user_id, min(ts) AS first_label, max(ts) AS last_label, CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS total_precip
FROM runs WHERE roll >= 4.0 GROUP BY user_id, run""")
def rain_runs(spark, folder):
    return storms.rain_runs(_user_series(spark, folder), ["user_id"], "ts", "value", floor=4.0)


def _hours_to_class_sql() -> str:
    points = ", ".join(
        f"({n}, {HOURS[label]}::DOUBLE, {round(limits[i] * SCALE, 6)}::DOUBLE)"
        for label, limits in INCHES.items()
        for i, n in enumerate(RETURN_PERIODS)
    )
    return f"""
WITH limits(n, hours, inches) AS (VALUES {points}),
days AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS value FROM events GROUP BY 1, 2),
ends AS (SELECT user_id, day, value, n,
    arg_min(hours, hours) FILTER (inches >= value) AS high_hours, arg_min(inches, hours) FILTER (inches >= value) AS high_inches,
    coalesce(arg_max(hours, hours) FILTER (inches < value), 0) AS low_hours,
    coalesce(arg_max(inches, hours) FILTER (inches < value), 0) AS low_inches, max(inches) AS top
  FROM days CROSS JOIN limits GROUP BY ALL)
SELECT user_id, day, value, CAST(n AS INTEGER) AS n,
  low_hours + (high_hours - low_hours) * ((value - low_inches) / (high_inches - low_inches)) AS hours
FROM ends WHERE value < top"""


@query(_hours_to_class_sql())
def hours_to_class_per_day(spark, folder):
    """How fast each user's largest daily value must fall to make an n-year storm."""
    days = table(spark, folder, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))
    rows = F.array(*[
        F.struct(F.lit(n).alias("n"), hours_to_class("value", n, SCALE).alias("hours"))
        for n in RETURN_PERIODS
    ])
    return days.select("user_id", "day", "value", F.inline(rows)).filter("hours is not null")
