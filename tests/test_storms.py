from datetime import datetime, timedelta

import numpy as np
import pytest

from stormspan.functions.thresholds import Band, INCHES, bands, hours_to_class, threshold
from stormspan.operators import storms
from stormspan.operators.bands import in_bands
from stormspan.plans.n_year import clean_readings, station_storms, storms_by_year
from pyspark.sql import functions as F

START = datetime(2020, 1, 1)


def brute_choice(rows, key, closed):
    kept = []
    for row in sorted(rows, key=key):
        s, e = row["start_time"], row["end_time"]
        clash = any(
            (s <= k["end_time"] and k["start_time"] <= e) if closed else (s < k["end_time"] and k["start_time"] < e)
            for k in kept
            if k["station"] == row["station"]
        )
        if not clash:
            kept.append(row)
    return kept


@pytest.mark.parametrize("hold", [1, 30, 20_000])
@pytest.mark.parametrize("closed", [True, False])
def test_choice_equals_a_plain_walk(spark, closed, hold):
    rng = np.random.default_rng(11)
    rows = []
    for station in ("a", "b", "c"):
        seen = set()
        for _ in range(150 if station == "a" else 40):
            e, d = int(rng.integers(0, 700)), int(rng.choice([1, 6, 24]))
            if (e, d) in seen:
                continue
            seen.add((e, d))
            rows.append((station, int(rng.choice([1, 2, 5])), d, START + timedelta(hours=e - d), START + timedelta(hours=e), round(float(rng.random()), 2)))
    df = spark.createDataFrame(rows, "station string, n int, duration_hrs int, start_time timestamp_ntz, end_time timestamp_ntz, inches double")
    rank = [("n", True), ("duration_hrs", True), ("inches", True), ("end_time", False)]
    got = storms.choose_without_overlap(df, ["station"], rank, closed=closed, hold=hold).collect()
    want = brute_choice(
        [r.asDict() for r in df.collect()],
        lambda r: (-r["n"], -r["duration_hrs"], -r["inches"], r["end_time"]),
        closed,
    )
    assert sorted(tuple(r) for r in got) == sorted(tuple(r.values()) for r in want)


def candidate_batches(rng, hours, per_batch, longest, chained=False):
    """One station's candidates by start, as the chooser gets them, and as plain tuples."""
    import pyarrow as pa

    made = []
    for at in range(hours):
        for _ in range(int(rng.integers(0, 3)) if not chained else 1):
            size = int(rng.integers(0, longest)) if not chained else 2
            made.append((at, at + size, hours - at if chained else int(rng.integers(0, 50))))
    made.sort()
    starts = [m[0] for m in made]
    table = pa.table({
        "_from": pa.array(starts, pa.int64()), "_to": pa.array([m[1] for m in made], pa.int64()),
        "_next": pa.array([*starts[1:], None], pa.int64()), "inches": pa.array([m[2] for m in made], pa.int64()),
    })
    return made, table.to_batches(max_chunksize=per_batch)


def plain_kept(made, closed):
    kept = []
    for s, e, x in sorted(made, key=lambda m: (-m[2], m[0], m[1])):
        reach = e + 1 if closed else e
        if s < reach and all(reach <= a or b <= s for a, b in kept):
            kept.append((s, reach))
    return sorted((s, r - 1 if closed else r) for s, r in kept)


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("rounds", [0, 1, 40])
@pytest.mark.parametrize("seed", range(3))
def test_settling_a_stream_equals_a_plain_walk(closed, rounds, seed):
    rng = np.random.default_rng(seed)
    rank = (("inches", True), ("_from", False), ("_to", False))
    made, batches = candidate_batches(rng, 400, 16, [3, 12, 60][seed])
    choose = storms._settled(rank, closed, 20, rounds)
    got = sorted((f, t) for b in choose(iter(batches)) for f, t in zip(b["_from"].to_pylist(), b["_to"].to_pylist()))
    want = plain_kept(made, closed)
    if not closed:  # spans of no hour take nothing and all stay
        assert sum(s == e for s, e in got) == sum(s == e for s, e, _ in made)
        got = [x for x in got if x[0] < x[1]]
    assert got == want


def test_long_chains_and_bounded_holding():
    """Ranks that fall along a chain settle one by one; a long history is given out as it comes."""
    rng = np.random.default_rng(1)
    rank = (("inches", True), ("_from", False))
    made, batches = candidate_batches(rng, 3000, 64, 0, chained=True)
    got = sorted(f for b in storms._settled(rank, True, 100)(iter(batches)) for f in b["_from"].to_pylist())
    assert got == [s for s, _ in plain_kept(made, True)]

    made, batches = candidate_batches(rng, 20_000, 64, 12)
    read = 0

    def reading():
        nonlocal read
        for batch in batches:
            read += batch.num_rows
            yield batch

    behind = [made[read - 1][0] - b["_from"].to_pylist()[-1] for b in storms._settled(rank, True, 500)(reading())]
    assert len(behind) > 20 and max(behind) < 1500  # of 20,000 hours


def test_islands_longer_than_an_arrow_batch(spark):
    rows = [("a", 1, 6, START + timedelta(hours=h - 6), START + timedelta(hours=h), float(h % 17)) for h in range(300)]
    df = spark.createDataFrame(rows, "station string, n int, duration_hrs int, start_time timestamp_ntz, end_time timestamp_ntz, inches double")
    rank = [("inches", True), ("end_time", False)]
    whole = storms.choose_without_overlap(df, ["station"], rank, closed=False).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        pieces = storms.choose_without_overlap(df, ["station"], rank, closed=False).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(whole) == sorted(pieces) and len(whole) > 10


def test_bands_are_half_open_and_open_at_the_top(spark):
    band = next(b for b in bands() if b.hours == 6)
    df = spark.createDataFrame([(1.87,), (1.88,), (2.28,), (5.68,), (50.0,)], "x double")
    assert [r[0] for r in df.select(band.classify("x")).collect()] == [None, 1, 2, 100, 100]
    assert [b.hours for b in bands()] == [1, 2, 3, 6, 12, 18, 24, 48, 72, 120, 240]
    assert threshold("48-hr", 100) == 8.16 and len(INCHES) == 15


def test_hours_to_class(spark):
    df = spark.createDataFrame([(3.2,), (0.15,), (4.12,)], "x double")
    one, hundred = [[r[0] for r in df.select(hours_to_class("x", n)).collect()] for n in (1, 100)]
    assert one[0] == pytest.approx(72 + 48 * (3.2 - 2.93) / (3.25 - 2.93))
    assert one[1] == pytest.approx(0.0833 * 0.5)
    assert one[2] is None
    assert hundred[0] == pytest.approx(0.5 + 0.5 * (3.2 - 2.80) / (3.56 - 2.80))


def series_of(spark, values, station="a"):
    rows = [(station, START + timedelta(hours=h), float(v)) for h, v in enumerate(values)]
    return spark.createDataFrame(rows, "station string, ts timestamp_ntz, value double")


def test_rain_event_spans(spark):
    values = [0, 0, 0.5, 0.2, 0] + [0] * 13 + [0.3] + [0] * 5
    out = storms.rain_events(series_of(spark, values), ["station"], "ts", "value").orderBy("start_time").collect()
    assert out[0].start_time == START + timedelta(hours=1)
    assert out[0].end_time == START + timedelta(hours=3)
    assert (out[0].duration_hrs, out[0].total_precip) == (2, 0.7)
    assert out[1].end_time is None and out[1].total_precip is None


def walked_events(values, dry_hours=12, floor=400):
    """Events of one series in whole units, by a plain walk: (start, end, units), hours from the first label."""
    roll = [sum(values[max(0, i + 1 - dry_hours) : i + 1]) for i in range(len(values))]
    found = []
    for i, amount in enumerate(values):
        if amount > floor and (i == 0 or roll[i - 1] < floor):
            dry = next((j for j in range(i, len(values)) if roll[j] < floor), None)
            end = None if dry is None else dry - dry_hours
            found.append((i - 1, end, None if end is None else sum(values[max(0, i - 1) : end + 1])))
    return found


def walked_runs(values, dry_hours=12, floor=400):
    roll = [sum(values[max(0, i + 1 - dry_hours) : i + 1]) for i in range(len(values))]
    found = []
    for i, total in enumerate(roll):
        if total >= floor:
            if i and roll[i - 1] >= floor:
                first, _, units = found.pop()
                found.append((first, i, units + values[i]))
            else:
                found.append((i, i, values[i]))
    return found


@pytest.mark.parametrize("chunk_hours", [13, 24, 100, 10_000])
def test_rain_events_and_runs_do_not_depend_on_chunks(spark, chunk_hours):
    rng = np.random.default_rng(11)
    series, kept = [], {}
    for station, wet in (("a", 0.05), ("b", 0.3), (None, 0.02), ("soaked", 0.9)):
        units = np.where(rng.random(900) < wet, rng.integers(1, 900, 900), 0)
        units[400:640] = np.where(units[400:640] > 0, units[400:640], 50) if station == "b" else units[400:640]
        kept[station] = units.tolist()
        series += [(station, START + timedelta(hours=h), float(u) / 10_000) for h, u in enumerate(kept[station])]
    df = spark.createDataFrame(series, "station string, ts timestamp_ntz, value double")
    hour = lambda t: None if t is None else int((t - START).total_seconds() // 3600)
    units = lambda x: None if x is None else round(x * 10_000)
    events = storms.rain_events(df, ["station"], "ts", "value", chunk_hours=chunk_hours).collect()
    runs = storms.rain_runs(df, ["station"], "ts", "value", chunk_hours=chunk_hours).collect()
    for station, values in kept.items():
        got = [(hour(r.start_time), hour(r.end_time), units(r.total_precip)) for r in events if r.station == station]
        assert sorted(got) == sorted(walked_events(values))
        got = [(hour(r.first_label), hour(r.last_label), units(r.total_precip)) for r in runs if r.station == station]
        assert sorted(got) == walked_runs(values)
    assert storms.rain_events(df.limit(0), ["station"], "ts", "value").count() == 0


def test_one_station_is_scanned_by_several_tasks(spark):
    values = np.where(np.random.default_rng(4).random(6_000) < 0.1, 0.3, 0.0)
    df = series_of(spark, values)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rolled = storms._rolled(df, ["station"], "ts", "value", 12, 4, 500)
        busy = rolled.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert busy > 1 and rolled.count() == 6_000


def test_downpour_after_drizzle_is_only_a_run(spark):
    values = [0, 0.03, 0.03, 0.5] + [0] * 14
    df = series_of(spark, values)
    assert storms.rain_events(df, ["station"], "ts", "value").count() == 0
    runs = storms.rain_runs(df, ["station"], "ts", "value").collect()
    assert len(runs) == 1 and runs[0].total_precip == 0.53


def test_look_back_against_slices(spark):
    rng = np.random.default_rng(2)
    values = np.where(rng.random(24 * 25) < 0.1, np.round(rng.random(24 * 25), 2), 0)
    df = series_of(spark, values)
    limits = [Band(k, ((1, 0.6 + k / 40), (2, 0.9 + k / 40), (5, 1.3 + k / 40))) for k in (1, 6, 24, 72, 240)]
    events = [("a", START + timedelta(hours=int(h)), i) for i, h in enumerate(range(3, 24 * 25, 17))]
    events_df = spark.createDataFrame(events, "station string, at timestamp_ntz, id int")
    got = {r.id: (r.n, r.duration_hrs, r.inches, r.storm_end) for r in storms.highest_storm_before(events_df, ["station"], "at", df, "ts", "value", limits).collect()}
    for _, when, i in events:
        end = when.replace(hour=0, minute=0) + timedelta(days=1)
        low = int(((end - timedelta(days=10)) - START).total_seconds() // 3600)
        high = int((end - START).total_seconds() // 3600)
        low, high = max(low, 0), min(high, len(values) - 1)
        best = None
        for band in limits:
            for t in range(low, high + 1):
                total = round(float(np.sum(values[max(low, t - band.hours + 1) : t + 1])), 4)
                classes = [n for n, limit in band.limits if total >= limit]
                if classes:
                    found = (classes[-1], band.hours, total, -t)
                    best = found if best is None or found > best else best
        want = (None,) * 4 if best is None else (*best[:3], START + timedelta(hours=-best[3]))
        assert got[i] == want


def test_storms_from_raw_readings(spark):
    start = datetime(1987, 8, 13, 20)
    text = {0: "0.5", 1: "T", 2: "3.0", 3: "3.5", 4: "1.0s"}
    rows = [("S", "n", (start + timedelta(hours=h)).strftime("%Y-%m-%d %H:%M"), v) for h, v in text.items()]
    rows.append(("S", "n", "1960-01-01 00:00", "9.0"))
    raw = spark.createDataFrame(rows, "STATION string, STATION_NAME string, DATE string, HOURLYPrecip string")
    found = station_storms(clean_readings(raw)).collect()
    assert [(r.n, r.duration_hrs, r.inches, r.year) for r in found] == [(100, 18, 7.0, 1987)]
    grid = {r.year: r.asDict() for r in storms_by_year(station_storms(clean_readings(raw)), 1986, 1988).collect()}
    assert sum(v for y in grid for k, v in grid[y].items() if k != "year") == 1 and sum(grid[1986].values()) == 1986


def test_look_back_with_many_days_digits_and_long_durations(spark):
    from datetime import datetime, timedelta

    from stormspan.functions.thresholds import Band

    first = datetime(2020, 1, 1, 1)
    rain = {1200: 60.0, 1210: 3.0, 300: 45.5}
    rows = [("a", first + timedelta(hours=h), rain.get(h, 0.0)) for h in range(1500)]
    hourly = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    bands = [Band(1, ((1, 2.0), (2, 50.0))), Band(1000, ((1, 20.0), (2, 100.0)))]
    when = first + timedelta(hours=1300)
    events = spark.createDataFrame([("a", when)], "k string, at timestamp_ntz")
    got = storms.highest_storm_before(events, ["k"], "at", hourly, "ts", "v", bands, days=60, digits=10).first()
    end = datetime(when.year, when.month, when.day) + timedelta(days=1)
    seen = [r for r in rows if end - timedelta(days=60) <= r[1] <= end]
    best = None
    for band in bands:
        for i in range(len(seen)):
            inches = sum(r[2] for r in seen[max(0, i + 1 - band.hours) : i + 1])
            n = max((n for n, limit in band.limits if inches >= limit), default=None)
            if n and (best is None or (n, band.hours, inches, -i) > best[0]):
                best = ((n, band.hours, inches, -i), seen[i][1])
    assert (got.n, got.duration_hrs, got.storm_end) == (best[0][0], best[0][1], best[1])
    assert got.inches == best[0][2]


def test_bands_from_a_table_against_a_search(spark):
    rng = np.random.default_rng(8)
    limits = [(k, float(x), i) for i, (k, x) in enumerate(
        [("a", v) for v in np.round(rng.random(300) * 50, 1)] + [(None, 2.0), (None, 2.0), ("far", 1e12), ("far", 1.0)]
        + [("far", v) for v in np.round(rng.random(40), 3)] + [("a", float("nan"))]
    )]
    values = [(i, k, float(v)) for i, (k, v) in enumerate(
        [("a", v) for v in np.round(rng.random(500) * 60 - 3, 1)]
        + [(k, v) for k in (None, "far", "none") for v in (1.0, 2.0, 0.5, 1e13, float("nan"))] + [(None, 2.0)] * 3
    )]
    limits_df = spark.createDataFrame(limits, "k string, lim double, n int")
    rows = spark.createDataFrame(values, "id int, k string, v double")

    def band(k, v):
        reached = [(x, n) for key, x, n in limits if key == k and x <= v]
        return max(reached)[1] if reached else None

    want = {i: band(k, v) for i, k, v in values}
    for more in ({}, {"per_band": 4}, {"scale": lambda x: F.log(x + 4)}):
        found = in_bands(rows, ["k"], "v", limits_df, "lim", "n", **more).collect()
        assert len(found) == len(values) and {r.id: r.n for r in found} == want
    assert {r.n for r in in_bands(rows, ["k"], "v", limits_df.limit(0), "lim", "n").collect()} == {None}
    plan = in_bands(rows, ["k"], "v", limits_df, "lim", "n")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rain_scan_grows_with_wet_hours_and_not_with_filled_ones(spark):
    """Long dry gaps are shuffled and sorted as a row or two per chunk, with the same events and runs."""
    values = np.zeros(3_000)
    values[[5, 6, 900, 911, 912, 1_000, 2_990]] = [0.5, 0.2, 0.3, 0.3, 0.01, 0.001, 0.7]
    df = series_of(spark, values)
    turns = storms._rolled_turns(df, ["station"], "ts", "value", 12, 4, 500)
    hours = [int((r.ts - START).total_seconds() // 3600) for r in turns.select("ts").collect()]
    assert len(hours) == len(set(hours)) < 30 and max(hours) == 2_999
    units = [round(v * 10_000) for v in values]
    at = lambda t: None if t is None else int((t - START).total_seconds() // 3600)
    events = storms.rain_events(df, ["station"], "ts", "value", chunk_hours=500)
    got = [(at(r.start_time), at(r.end_time), None if r.total_precip is None else round(r.total_precip * 10_000)) for r in events.collect()]
    assert sorted(got, key=lambda e: e[0]) == walked_events(units)
    assert "SortAggregate" not in plan_of(events)
    runs = storms.rain_runs(df, ["station"], "ts", "value", chunk_hours=500).collect()
    assert sorted((at(r.first_label), at(r.last_label), round(r.total_precip * 10_000)) for r in runs) == walked_runs(units)


@pytest.mark.parametrize("floor", [0.0, 0.04])
def test_runs_without_turning_rows_at_their_ends(spark, floor):
    """A run that stops with the series in a chunk without rain, a dry series, and amounts below zero."""
    for units in ([0] * 20 + [500] + [0] * 8, [0] * 40, [0, 600, -700, 0, 900] + [0] * 30, [0] * 27 + [300, 300]):
        df = series_of(spark, [u / 10_000 for u in units])
        runs = storms.rain_runs(df, ["station"], "ts", "value", floor=floor, chunk_hours=13).collect()
        at = lambda t: int((t - START).total_seconds() // 3600)
        got = sorted((at(r.first_label), at(r.last_label), round(r.total_precip * 10_000)) for r in runs)
        if floor or min(units) >= 0:
            assert got == walked_runs(units, floor=round(floor * 10_000))


@pytest.mark.parametrize("hold", [7, 20_000])
@pytest.mark.parametrize("apart", [True, False])
def test_windows_are_chosen_like_candidates_without_sorting_them(spark, apart, hold):
    rng = np.random.default_rng(5)
    limits = [Band(k, ((1, 0.3 + k / 20), (2, 0.5 + k / 20), (5, 0.8 + k / 20))) for k in (1, 3, 12, 48)]
    rows = []
    for station, wet in (("a", 0.5), (None, 0.2), ("c", 0.05), ("dry", 0.0)):
        values = np.where(rng.random(500) < wet, np.round(rng.random(500), 1), 0)
        rows += [(station, START + timedelta(hours=h), float(v)) for h, v in enumerate(values)]
    df = spark.createDataFrame(rows, "station string, ts timestamp_ntz, value double")
    rank = [("n", True), ("duration_hrs", True), ("inches", True), ("end_time", False)]
    by = ["station", "duration_hrs"] if apart else ["station"]
    candidates = storms.storm_candidates(df, ["station"], "ts", "value", limits)
    want = storms.choose_without_overlap(candidates, by, rank, closed=not apart, hold=hold)
    rolled = storms.rolling_totals(df, ["station"], "ts", "value", [b.hours for b in limits])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        chosen = storms.choose_windows(rolled, ["station"], "ts", limits, rank, apart=apart, closed=not apart, hold=hold)
        got = chosen.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert chosen.schema.simpleString() == want.schema.simpleString()
    assert {tuple(r) for r in got} == {tuple(r) for r in want.collect()} and len(got) == want.count() > 30


def test_storms_sort_the_series_once(spark):
    df = series_of(spark, [0.5] * 50)
    for found in (
        storms.storms_per_duration(df, ["station"], "ts", "value", {1: 0.1, 6: 1.0}),
        storms.unique_storms(df, ["station"], "ts", "value", bands()),
    ):
        assert found.count() > 0
        assert plan_of(found).split("== Initial Plan ==")[-1].count("Sort [") == 1
        assert "Generate" not in plan_of(found)
