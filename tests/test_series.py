from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from stormspan.operators import neighbours, overflows, series


def at(text):
    return datetime.fromisoformat(text)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def noisy_series(spark, hours=400, seed=3):
    rng = np.random.default_rng(seed)
    start = at("2020-02-27 00:00:00")
    rows = []
    for station in ("a", "b"):
        for h in range(hours):
            wet = rng.random() < 0.3
            rows.append((station, start + timedelta(hours=h), float(round(rng.random(), 2)) if wet else None))
    return frame(spark, rows, "station string, ts timestamp_ntz, value double")


def test_hourly_max_fills_gaps_and_labels_the_end(spark):
    rows = [("a", at("2020-01-01 00:10:00"), 0.1), ("a", at("2020-01-01 00:50:00"), 0.3), ("a", at("2020-01-01 03:00:00"), 0.2)]
    out = series.hourly_max(frame(spark, rows, "s string, ts timestamp_ntz, value double"), ["s"]).orderBy("ts").collect()
    assert [(r.ts.hour, r.value) for r in out] == [(1, 0.3), (2, 0.0), (3, 0.0), (4, 0.2)]


def test_hours_before_1970_and_across_zones(spark):
    rows = [("a", at("1946-07-01 23:59:59"), 1.0)]
    df = frame(spark, rows, "s string, ts timestamp_ntz, value double")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        out = series.hourly_max(df, ["s"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out[0].ts == at("1946-07-02 00:00:00")


def test_worked_example_of_full_windows(spark):
    rows = [("a", at(f"2020-01-01 {13 + i}:00:00"), v) for i, v in enumerate([2.0, 3.0, 1.0, 5.0])]
    df = frame(spark, rows, "s string, ts timestamp_ntz, value double")
    out = series.rolling_totals(df, ["s"], "ts", "value", [2], full=True).orderBy("ts").collect()
    assert [r.roll_2 for r in out] == [None, 5.0, 4.0, 6.0]


def test_running_sum_form_equals_frames_and_chunks(spark):
    df = noisy_series(spark)
    fast = series.rolling_totals(df, ["station"], "ts", "value", [6, 24, 48], full=False)
    chunked = series.rolling_totals(df, ["station"], "ts", "value", [6, 24, 48], full=False, chunk_hours=72)
    assert fast.exceptAll(chunked).count() == 0 and chunked.count() == fast.count()
    for k in (6, 24, 48):
        naive = series.rolling_frame(df, ["station"], "ts", "value", k, out="naive").join(
            fast.select("station", "ts", f"roll_{k}"), ["station", "ts"]
        )
        assert naive.filter(F.abs(F.col("naive") - F.col(f"roll_{k}")) > 1e-9).count() == 0
    full = series.rolling_totals(df, ["station"], "ts", "value", [3], full=True, chunk_hours=24)
    naive = series.rolling_frame(df, ["station"], "ts", "value", 3, full=True, out="naive").join(
        full.select("station", "ts", "roll_3"), ["station", "ts"]
    )
    assert naive.filter(~F.round("naive", 6).eqNullSafe(F.round("roll_3", 6))).count() == 0


def test_neighbours_match_a_plain_lag_for_a_hot_key(spark):
    from pyspark.sql import Window

    rng = np.random.default_rng(5)
    start = at("2021-03-01 00:00:00")
    rows = [
        ("hot" if rng.random() < 0.7 else f"k{i % 5}", start + timedelta(seconds=int(rng.integers(0, 900_000))), i)
        for i in range(600)
    ]
    df = frame(spark, rows, "k string, ts timestamp_ntz, id long")
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.select("k", "ts", "id", F.lag("id").over(w).alias("prev_id"), F.lead("id").over(w).alias("next_id"))
    mine = neighbours.with_neighbours(df, ["k"], "ts", "id", ["id"], previous=True, following=True, chunk_hours=7)
    mine = mine.select("k", "ts", "id", "prev_id", "next_id")
    assert plain.exceptAll(mine).count() == 0 and mine.count() == 600


def test_gap_edges(spark):
    rows = [("a", at("2020-01-01 00:00:00"), 1), ("a", at("2020-01-01 02:00:00"), 2), ("a", at("2020-01-01 02:30:00"), 3)]
    df = frame(spark, rows, "k string, ts timestamp_ntz, id long")
    out = {r.id: r.edge for r in neighbours.gap_edges(df, ["k"], "ts", "id", 3601).collect()}
    assert out == {1: "before_gap", 2: "after_gap"}


def test_rain_before_counts_the_closed_window(spark):
    rain = [("a", at("2020-01-01 00:30:00"), 1.0), ("a", at("2020-01-02 00:30:00"), 2.0)]
    rain = frame(spark, rain, "s string, ts timestamp_ntz, value double")
    events = [("a", at(t), i) for i, t in enumerate(["2020-01-01 23:00:00", "2020-01-02 00:59:00", "2020-01-02 12:00:00", "2020-01-05 00:00:00"])]
    events = frame(spark, events, "s string, ts timestamp_ntz, id int")
    out = overflows.rain_before(events, ["s"], "ts", rain, "ts", "value", hours=24)
    assert {r.id: r.prior_rain for r in out.collect()} == {0: 1.0, 1: 2.0, 2: 2.0, 3: 0.0}


def test_overlap_counts_against_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", i, int(s), int(s + rng.integers(0, 9))) for i, s in enumerate(rng.integers(0, 60, 80))]
    df = frame(spark, rows, "k string, id int, s int, e int")
    got = {r.id: r.overlaps for r in overflows.overlap_counts(df, ["k"], "s", "e").collect()}
    want = {i: sum(1 for _, j, s2, e2 in rows if j != i and s <= e2 and s2 <= e) for _, i, s, e in rows}
    assert got == want
    for chunk in (1, 7):
        pieces = overflows.overlap_counts(df, ["k"], "s", "e", chunk=chunk).collect()
        assert {r.id: r.overlaps for r in pieces} == want
    assert overflows.overlap_counts(df.limit(0), ["k"], "s", "e").count() == 0


def test_a_far_off_time_is_filled_in_pieces(spark):
    rows = [("a", at("1820-01-01 00:10:00"), 1.0), ("a", at("2020-01-01 00:10:00"), 2.0)]
    out = series.hourly_max(frame(spark, rows, "s string, ts timestamp_ntz, value double"), ["s"], label="left")
    got = out.agg(F.count("*"), F.countDistinct("ts"), F.sum("value"), F.min("ts"), F.max("ts")).first()
    hours = int((at("2020-01-01 00:00:00") - at("1820-01-01 00:00:00")).total_seconds() // 3600) + 1
    assert tuple(got) == (hours, hours, 3.0, at("1820-01-01 00:00:00"), at("2020-01-01 00:00:00"))


def test_rows_with_a_null_key_keep_their_neighbours(spark):
    rows = [(None, at("2020-01-01 00:10:00"), 1), (None, at("2020-01-01 05:10:00"), 2), ("a", at("2020-01-01 03:00:00"), 3)]
    df = frame(spark, rows, "s string, ts timestamp_ntz, id int")
    out = {r.id: r.prev_ts for r in neighbours.with_neighbours(df, ["s"], "ts", "id").collect()}
    assert out == {1: None, 2: at("2020-01-01 00:10:00"), 3: None}


def test_overlaps_of_open_unkeyed_and_undated_intervals(spark):
    day = lambda d: at(f"2020-01-{d:02d} 00:00:00")
    rows = [
        (1, "a", day(1), None), (2, "a", day(5), day(6)), (3, "a", day(6), day(9)), (4, "a", None, day(5)),
        (5, None, day(1), day(3)), (6, None, day(2), None), (7, None, day(4), day(4)),
    ]
    df = frame(spark, rows, "id int, k string, s timestamp_ntz, e timestamp_ntz")
    out = {r.id: r.overlaps for r in overflows.overlap_counts(df, ["k"], "s", "e").collect()}

    def meet(a, b):
        return a[1] == b[1] and a[2] and b[2] and a[2] <= (b[3] or datetime.max) and b[2] <= (a[3] or datetime.max)

    want = {a[0]: sum(bool(meet(a, b)) for b in rows if b is not a) if a[2] else None for a in rows}
    assert out == want


def test_nan_and_infinite_readings_count_as_missing(spark):
    values = [1.0, float("nan"), float("inf"), 2.0]
    rows = [("a", at("2020-01-01 00:00:00") + timedelta(hours=h), v) for h, v in enumerate(values)]
    df = frame(spark, rows, "s string, ts timestamp_ntz, value double")
    assert [r.value for r in series.hourly_max(df, ["s"]).orderBy("ts").collect()] == [1.0, 0.0, 0.0, 2.0]
    rolled = series.rolling_totals(df, ["s"], "ts", "value", [3], full=False).orderBy("ts").collect()
    assert [r.roll_3 for r in rolled] == [1.0, 1.0, 1.0, 2.0]
    from stormspan.functions.clean import strict_precip
    from stormspan.operators.stats import describe

    described = describe(spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (3.0,)], "v double"), "v").first()
    assert (described["count"], described.p50, described.max) == (3, 2.0, 3.0)
    texts = [("a", 1, "NaN"), ("a", 2, "0.5"), (None, 3, "T"), (None, 3, "0.7"), ("b", None, "0.1s"), ("b", None, "1"), ("b", 4, None)]
    cleaned = strict_precip(frame(spark, texts, "s string, ts int, v string"), "v", "ts", ["s"]).collect()
    assert sorted((str(r.s), str(r.ts), str(r.v)) for r in cleaned) == sorted(
        [("a", "1", "None"), ("a", "2", "0.5"), ("None", "3", "0.0"), ("None", "3", "0.0"), ("b", "None", "0.0"), ("b", "None", "0.0"), ("b", "4", "None")]
    )
