"""Hourly and daily series over the event log; an event's value stands for rain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import end_of_day, minutes_between, whole_units_between
from ..operators import neighbours, overflows, series
from .registry import query, table


def hourly_cte(key: str, where: str = "true", fill: str = "0.0", name: str = "hourly") -> str:
    """SQL of the right-labelled hourly maximum with its gaps filled: (key, ts, value)."""
    return f"""
    {name}_seen AS (
      SELECT {key}, date_trunc('hour', ts) AS h, max(value) AS v FROM events WHERE {where} GROUP BY 1, 2),
    {name}_hours AS (
      SELECT {key}, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h
      FROM {name}_seen GROUP BY {key}),
    {name} AS (
      SELECT s.{key}, s.h + INTERVAL 1 HOUR AS ts, coalesce(d.v, {fill}) AS value
      FROM {name}_hours s LEFT JOIN {name}_seen d ON s.{key} = d.{key} AND s.h = d.h)"""


@query(f"WITH {hourly_cte('event_type')} SELECT * FROM hourly")
def hourly_max(spark, folder):
    return series.hourly_max(table(spark, folder, "events"), ["event_type"])


@query("""
WITH seen AS (SELECT event_type, date_trunc('hour', ts) AS h, avg(value) AS v FROM events GROUP BY 1, 2),
hours AS (SELECT event_type, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM seen GROUP BY 1)
SELECT hours.event_type, hours.h AS ts, round(seen.v, 9) AS value
FROM hours LEFT JOIN seen ON hours.event_type = seen.event_type AND hours.h = seen.h
""")
def hourly_mean(spark, folder):
    means = series.resample(table(spark, folder, "events"), ["event_type"], "ts", "value", how="mean")
    return means.withColumn("value", F.round("value", 9))


DAILY = """
daily_seen AS (SELECT event_type, date_trunc('day', ts) AS d, sum(CAST(value AS DECIMAL(18, 4))) AS v
  FROM events GROUP BY 1, 2),
days AS (SELECT event_type, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM daily_seen GROUP BY 1),
daily AS (SELECT days.event_type, CAST(days.d AS TIMESTAMP) AS ts, round(CAST(coalesce(v, 0) AS DOUBLE), 4) AS value
  FROM days LEFT JOIN daily_seen s ON s.event_type = days.event_type AND s.d = days.d)
"""


@query(f"WITH {DAILY} SELECT * FROM daily")
def daily_sum(spark, folder):
    daily = series.daily_sum(table(spark, folder, "events"), ["event_type"])
    return daily.withColumn("value", F.round("value", 4))


def _rolling(k: int, key: str, full: bool) -> str:
    frame = f"OVER (PARTITION BY {key} ORDER BY ts ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    total = f"CAST(coalesce(sum(CAST(value AS DECIMAL(18, 4))) {frame}, 0) AS DOUBLE)"
    if full:
        total = f"CASE WHEN count(value) {frame} = {k} THEN {total} END"
    return f"{total} AS roll_{k}"


@query(f"""WITH {hourly_cte('user_id')}
SELECT user_id, ts, value, {_rolling(6, 'user_id', False)}, {_rolling(24, 'user_id', False)} FROM hourly""")
def rolling_partial(spark, folder):
    hourly = series.hourly_max(table(spark, folder, "events"), ["user_id"])
    return series.rolling_totals(hourly, ["user_id"], "ts", "value", [6, 24])


@query(f"""WITH {hourly_cte('event_type', fill='NULL')}
SELECT event_type, ts, value, {_rolling(6, 'event_type', True)}, {_rolling(24, 'event_type', True)} FROM hourly""")
def rolling_full(spark, folder):
    hourly = series.hourly_max(table(spark, folder, "events"), ["event_type"], fill=None)
    return series.rolling_totals(hourly, ["event_type"], "ts", "value", [6, 24], full=True)


@query(f"""WITH {hourly_cte('user_id')}
SELECT user_id, ts, value, {_rolling(6, 'user_id', False)}, {_rolling(24, 'user_id', False)} FROM hourly""")
def rolling_chunked(spark, folder):
    """Rolling totals with long histories cut into ten-day chunks."""
    hourly = series.hourly_max(table(spark, folder, "events"), ["user_id"])
    return series.rolling_totals(hourly, ["user_id"], "ts", "value", [6, 24], chunk_hours=240)


@query(f"""WITH {DAILY}
SELECT event_type, ts, value, {_rolling(14, 'event_type', True)}, {_rolling(30, 'event_type', True)} FROM daily""")
def rolling_daily14(spark, folder):
    daily = series.daily_sum(table(spark, folder, "events"), ["event_type"])
    daily = daily.withColumn("value", F.round("value", 4))
    return series.rolling_totals(daily, ["event_type"], "ts", "value", [14, 30], full=True)


_GAP = "epoch_us(ts) - epoch_us(lag(ts) OVER w) > 86400000000"
_GAP_NEXT = "epoch_us(lead(ts) OVER w) - epoch_us(ts) > 86400000000"


@query(f"""
WITH near AS (SELECT event_id, user_id, ts, coalesce({_GAP}, false) AS after_gap, coalesce({_GAP_NEXT}, false) AS before_gap
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, ts,
  CASE WHEN after_gap AND before_gap THEN 'both' WHEN after_gap THEN 'after_gap' ELSE 'before_gap' END AS edge
FROM near WHERE after_gap OR before_gap
""")
def rain_gaps(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return neighbours.gap_edges(events, ["user_id"], "ts", "event_id", 86_400, chunk_hours=24)


@query("""
WITH near AS (SELECT event_id, user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT event_id, user_id, ts, value,
  (epoch_us(ts) - epoch_us(p)) / 3600000000.0::DOUBLE AS hours,
  value * ((epoch_us(ts) - epoch_us(p)) / 3600000000.0::DOUBLE) / 25.4::DOUBLE AS depth
FROM near WHERE p IS NOT NULL
""")
def rate_to_depth(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return neighbours.rate_to_depth(events, ["user_id"], "ts", "event_id", "value")


@query("""
SELECT event_id, user_id, ts, lag(ts) OVER w AS prev_ts, lag(event_id) OVER w AS prev_event_id,
  lag(value) OVER w AS prev_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def previous_reading(spark, folder):
    """Each reading with the one before it."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    found = neighbours.with_neighbours(events, ["user_id"], "ts", "event_id", ["event_id", "value"])
    return found.drop("value")


@query("""
SELECT event_id, user_id, ts, prev_ts FROM (
  SELECT event_id, user_id, ts, lag(ts) OVER w AS prev_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE prev_ts IS NOT NULL
""")
def drop_first(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return neighbours.without_first(events, ["user_id"], "ts", "event_id")


@query("""
WITH seen AS (SELECT event_type, date_trunc('hour', ts) AS h, max(value) AS v FROM events GROUP BY 1, 2),
hours AS (SELECT event_type, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM seen GROUP BY 1),
filled AS (SELECT hours.event_type, hours.h AS ts, CAST(hours.h AS DATE) AS day, coalesce(seen.v, 0.0) AS value,
    CAST(round(coalesce(seen.v, 0.0) * 10000) AS BIGINT) AS units
  FROM hours LEFT JOIN seen ON hours.event_type = seen.event_type AND hours.h = seen.h)
SELECT event_type, ts, value, day,
  CAST(sum(units) OVER so_far AS DOUBLE) / 10000 AS cumulative,
  CAST(sum(units) OVER so_far AS DOUBLE) / nullif(CAST(sum(units) OVER whole AS DOUBLE), 0) AS share,
  min(CASE WHEN value > 0 THEN ts END) OVER whole AS first_wet
FROM filled
WINDOW whole AS (PARTITION BY event_type, day), so_far AS (PARTITION BY event_type, day ORDER BY ts)
""")
def storm_share(spark, folder):
    hourly = series.hourly_max(table(spark, folder, "events"), ["event_type"], label="left")
    hourly = hourly.withColumn("day", F.to_date("ts"))
    return series.cumulative_share(hourly, ["event_type", "day"], "ts", "value")


@query("""
SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days FROM events WHERE value > 150 GROUP BY user_id
""")
def distinct_days(spark, folder):
    return series.count_days(table(spark, folder, "events"), ["user_id"], "ts", F.col("value") > 150)


@query("""
SELECT event_id, date_trunc('day', ts) + INTERVAL 1 DAY AS day_end,
  (epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) - epoch_us(ts)) / 60000000.0::DOUBLE AS minutes_left,
  (epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) - epoch_us(ts)) // 3600000000 AS whole_hours_left,
  date_trunc('hour', ts) + INTERVAL 1 HOUR AS next_hour
FROM events
""")
def elapsed(spark, folder):
    from ..functions.calendar import top_of_next_hour

    return table(spark, folder, "events").select(
        "event_id",
        end_of_day("ts").alias("day_end"),
        minutes_between("ts", end_of_day("ts")).alias("minutes_left"),
        whole_units_between("ts", end_of_day("ts"), "hour").alias("whole_hours_left"),
        top_of_next_hour("ts").alias("next_hour"),
    )


def _prior_sql(label: str, hours: int, out: str) -> str:
    return f"""WITH {hourly_cte('user_id', "event_type = 'view'")}
SELECT e.event_id, e.user_id, e.ts,
  CAST(coalesce(sum(CAST(h.value AS DECIMAL(18, 4))), 0) AS DOUBLE) AS {out}
FROM (SELECT *, {label} AS label FROM events WHERE event_type = 'purchase') e
LEFT JOIN hourly h ON h.user_id = e.user_id AND h.ts BETWEEN e.label - INTERVAL {hours - 1} HOUR AND e.label
GROUP BY e.event_id, e.user_id, e.ts"""


def _prior(spark, folder, out, **how):
    events = table(spark, folder, "events")
    rain = events.filter(F.col("event_type") == "view")
    overflow = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return overflows.rain_before(overflow, ["user_id"], "ts", rain, "ts", "value", out=out, **how)


@query(_prior_sql("date_trunc('hour', ts) + INTERVAL 1 HOUR", 24, "rain_24h"))
def prior_rain(spark, folder):
    """Rain in the 24 hours before an overflow, to the top of the next hour."""
    return _prior(spark, folder, "rain_24h", hours=24)


@query(_prior_sql("date_trunc('day', ts) + INTERVAL 1 DAY", 240, "ten_day_rain"))
def prior_rain_days(spark, folder):
    """Rain in the ten days that end with the day of the event."""
    return _prior(spark, folder, "ten_day_rain", hours=240, until="day")
