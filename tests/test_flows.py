import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stormspan.functions import clean
from stormspan.functions.calendar import season, year_bucket
from stormspan.functions.lookups import waterway_name
from stormspan.operators import keys, overflows, stats
from stormspan.plans.flooding import calls_per_area, combine_housing
from stormspan.plans.overflow import cumulative_by_outfall, outfall_points, reversals

# A part of the published reversal list, and the rows it must give.
REVERSAL_TEXT = "\n".join([
    "6/15-16/2015", "0", "997.5 ", "167.2 ", "1164.7",
    "6/30-7/1/14", "0", "362.0 ", "163.0 ", "525.0",
    "4/18-19/13 ", "3185.6 ", "6104.7", "1429.2", "10719.5",
    "7/24/2011 ", "0", "1716.2", "504.3", "2220.5",
    "12/27-28/08", "0", "0", "460.8", "460.8",
])
REVERSAL_ROWS = [
    (997.5, "6/15-16/2015", date(2015, 6, 16), 0.0, date(2015, 6, 15), 1164.7, 167.2, 2015),
    (362.0, "6/30-7/1/14", date(2014, 7, 1), 0.0, date(2014, 6, 30), 525.0, 163.0, 2014),
    (6104.7, "4/18-19/13 ", date(2013, 4, 19), 3185.6, date(2013, 4, 18), 10719.5, 1429.2, 2013),
    (1716.2, "7/24/2011 ", None, 0.0, date(2011, 7, 24), 2220.5, 504.3, 2011),
    (0.0, "12/27-28/08", date(2008, 12, 28), 0.0, date(2008, 12, 27), 460.8, 460.8, 2008),
]


def test_reversals(spark):
    texts = spark.createDataFrame([(REVERSAL_TEXT,)], "value string")
    assert [tuple(r) for r in reversals(texts).collect()] == REVERSAL_ROWS


@pytest.mark.parametrize("text, start, end", [
    ("4/18-5/1/13", date(2013, 4, 18), date(2013, 5, 1)),
    ("8/13/87", date(1987, 8, 13), None),
    ("3/8/2009", date(2009, 3, 8), None),
    ("2/26-27/9", date(2009, 2, 26), date(2009, 2, 27)),
    ("none", None, None),
    ("2/30/2009", None, None),
])
def test_date_ranges(spark, text, start, end):
    row = clean.with_date_range(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert (row.start_date, row.end_date) == (start, end)


def test_strict_and_lenient(spark):
    t = datetime(2016, 1, 1)
    rows = [("a", t, "T"), ("a", t, "0.5"), ("b", t, "0.5"), ("a", t.replace(hour=1), "0.05s"), ("a", t.replace(hour=2), None)]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, p string")
    strict = sorted((r.s, r.ts.hour, r.p) for r in clean.strict_precip(df, "p", "ts", ["s"]).collect() if r.p is not None)
    assert strict == [("a", 0, 0.0), ("a", 0, 0.0), ("a", 1, 0.0), ("b", 0, 0.5)]
    assert [r[0] for r in df.select(clean.lenient_precip("p")).collect()] == [0.0, 0.5, 0.5, 0.05, 0.0]


def test_text_values(spark):
    row = spark.range(1).select(
        clean.percent(F.lit("19.60%")).alias("a"),
        clean.number(F.lit("1,090")).alias("b"),
        clean.area_key(F.lit("O'Hare Park")).alias("c"),
        clean.period_seconds(F.lit(":02:50:00")).alias("d"),
        clean.us_timestamp(F.lit("8/20/2016 8:25:00 PM")).alias("e"),
        clean.us_timestamp(F.lit("soon")).alias("f"),
        clean.zip_key(F.lit(None).cast("double")).alias("g"),
        clean.valid_us_date(F.lit("2/31/2016")).alias("h"),
        clean.valid_us_date(F.lit("2/3/1999")).alias("i"),
        clean.shifted_micros(F.lit(1152421561000000)).alias("j"),
        clean.duration_hours(F.lit("10-day")).alias("k"),
    ).first()
    assert tuple(row) == (
        19.6, 1090.0, "OHARE PARK", 10200, datetime(2016, 8, 20, 20, 25), None, "0", True, False,
        datetime(2006, 7, 9, 0, 6, 1), 240.0,
    )


def test_clock_texts_in_a_zone_with_daylight_saving(spark):
    texts = ["3/13/2016 2:30:00 AM", "8/20/2016 12:05:09 PM", "8/20/2016 12:05:09 AM", "8/20/2016 13:00:00 PM", "2/30/2016 1:00:00 AM", "x|y|z|P", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        read = [r[0] for r in df.select(clean.us_timestamp("t")).collect()]
        joined = df.limit(1).select(clean.date_and_time(F.lit("2016-03-13"), F.lit("02:30")), clean.wall_clock(F.lit("2016-03-13 02:30:15"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert read == [datetime(2016, 3, 13, 2, 30), datetime(2016, 8, 20, 12, 5, 9), datetime(2016, 8, 20, 0, 5, 9), None, None, None, None]
    assert tuple(joined) == (datetime(2016, 3, 13, 2, 30), datetime(2016, 3, 13, 2, 30, 15))


def test_seasons_and_buckets(spark):
    days = ["2001-01-01", "2001-03-20", "2001-03-21", "2001-06-21", "2001-09-22", "2001-09-23", "2001-12-20", "2001-12-21", "2004-02-29"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    assert [r[0] for r in df.select(season("d")).collect()] == [
        "winter", "winter", "spring", "summer", "summer", "autumn", "autumn", "winter", "winter"]
    years = spark.createDataFrame([(1970,), (1985,), (1986,), (2000,), (2016,)], "y int")
    assert [r[0] for r in years.select(year_bucket("y")).collect()] == [
        "1970-1985", "1970-1985", "1986-2000", "1986-2000", "2001-2015"]


def test_unknown_segment_stops_the_job(spark):
    known = spark.createDataFrame([(23,), (30,), (None,)], "s int").select(waterway_name("s"))
    assert [r[0] for r in known.collect()] == ["Addison Cr", "", None]
    with pytest.raises(Exception, match="unknown waterway segment 99"):
        spark.createDataFrame([(99,)], "s int").select(waterway_name("s")).collect()


def test_feeds_and_cumulative_totals(spark):
    current = spark.createDataFrame(
        [("DS-1", "West", "All", "Addison Cr", "P", "8/20/2016 8:40:00 AM", "8/20/2016 11:30:00 AM", ":02:50:00")],
        "outfall_structure string, outfall_location string, tide_gate string, waterway_reach string, plant string, open_text string, close_text string, period_text string")
    archive = spark.createDataFrame([(1, "DS-2", 23, "2014-05-01", "23:30", 45)], "id int, location string, segment int, date string, starttime string, duration int")
    events = overflows.unify_feeds(current, archive)
    by_name = {r.outfall_structure: r for r in events.collect()}
    assert by_name["DS-2"].close_time == datetime(2014, 5, 2, 0, 15) and by_name["DS-2"].waterway_reach == "Addison Cr"
    assert by_name["DS-1"].open_seconds == 10200
    features = spark.createDataFrame(
        [(0, "DS-1", None, 1.0, 2.0, "Addison Cr"), (1, "DS-1", "plant", 9.0, 9.0, "x"), (2, "DS-9", "p", 1.0, 1.0, "y")],
        "pos int, tarp_connection string, associated_plant string, lat double, lon double, waterway_reach string")
    out = cumulative_by_outfall(events, outfall_points(features, "pos")).collect()
    assert [(r.name, r.duration_mins, r.duration_ms, r.associated_plant, r.lat) for r in out] == [("DS-1", 170.0, 10_200_000, "plant", 1.0)]


def test_equal_totals_both_keep_their_place(spark):
    events = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 1.0), ("x", 99.0)], "o string, m double")
    places = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "o string, p int")
    out = {r.o: r.color for r in overflows.outfall_totals(events, places, "o", "m", top=2).collect()}
    assert out == {"a": "red", "b": "red", "c": "blue"}


def test_key_overlap(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    assert tuple(keys.key_overlap(left, right, "k").first()) == (1, 1, 2)


def test_percentiles_are_exact_under_skew(spark):
    values = [0.0] * 500 + [float(i) for i in range(101)] + [1e9, 1e9 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.probability: r.value for r in stats.exact_percentiles(df, "v", (0.25, 0.9, 0.99, 1.0)).collect()}
    import numpy as np

    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p))
    same = spark.createDataFrame([(4.0,)] * 3, "v double")
    assert [r.value for r in stats.exact_percentiles(same, "v", (0.5,)).collect()] == [4.0]


def test_housing_join_reads_commas_and_drops_the_city_total(spark):
    years = range(2005, 2016)
    columns = ", ".join(f"All_Res_{y} string" for y in years)
    area = "Community_Area string"
    acc = spark.createDataFrame([("Austin", "19.60%"), ("City of Chicago Total", "9%")], f"{area}, Percentage_Foreclosed_Parcels string")
    filings = spark.createDataFrame([("Austin", *["10"] * 3, "1,090", *["10"] * 6, None)], f"{area}, {columns}")
    parcel = spark.createDataFrame([("Austin", *["2.0"] * 11)], f"{area}, {columns}")
    low = spark.createDataFrame([("Austin", *["10%"] * 10, None)], f"{area}, {columns}")
    vacant = spark.createDataFrame([("Austin", "4%", "6%")], f"{area}, All_Res_2010_1 string, All_Res_2010_2 string")
    row = combine_housing(acc, filings, parcel, low, vacant).collect()
    assert [tuple(r) for r in row] == [("Austin", 19.6, 1180.0, 2.0, pytest.approx(100 / 11), 5.0)]
    without = combine_housing(acc, filings, parcel, low, vacant, filing_years=[y for y in years if y != 2008])
    assert without.first()["Foreclosure_Filings_05_15"] == 90.0


def test_calls_per_area(spark):
    wide = spark.createDataFrame([("d1", 1, None), ("d2", 2, 5)], "date string, AUSTIN int, CHATHAM int")
    assert {r.area: r.calls for r in calls_per_area(wide, "date").collect()} == {"AUSTIN": 3, "CHATHAM": 5}
