"""N-year storms: candidates, non-overlapping choice, look-back, rain events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_number, hour_number, hour_start
from ..functions.thresholds import Band
from .scan import fold_segments
from .series import rolling_column, rolling_totals, whole_units, with_halo


def classified_windows(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, bands: Sequence[Band], *, full: bool = False, **more
) -> DataFrame:
    """Every window end whose rolling total reaches a return-period class.

    One pass: all durations share one window, rows below every limit are dropped
    before the durations are spread over rows, and the class is a CASE
    expression on literals rather than a join.
    """
    keys = list(keys)
    rolled = rolling_totals(series, keys, ts, value, [b.hours for b in bands], full=full, **more)
    reached = _any(F.col(rolling_column(b.hours)) >= F.lit(b.lowest) for b in bands)
    spread = _per_duration(bands, inches=lambda b: F.col(rolling_column(b.hours)))
    return (
        rolled.filter(reached)
        .select(*keys, F.col(ts).alias("end_time"), F.inline(spread))
        .filter(F.col("inches") >= F.col("limit_0"))
        .select(*keys, "end_time", "duration_hrs", _class_of("inches", bands).alias("n"), "inches")
    )


def _any(conditions) -> Column:
    found = None
    for condition in conditions:
        found = condition if found is None else found | condition
    return found


def _per_duration(bands: Sequence[Band], **fields) -> Column:
    """An array with one struct per duration: its limits and the given fields.

    Spreading durations over rows before classifying keeps one CASE in the
    generated code instead of one per duration, small enough to be compiled.
    """
    return F.array(*[
        F.struct(
            F.lit(band.hours).alias("duration_hrs"),
            *[field(band).alias(name) for name, field in fields.items()],
            *[F.lit(float(limit)).alias(f"limit_{i}") for i, (_, limit) in enumerate(band.limits)],
        )
        for band in bands
    ])


def _class_of(inches: str, bands: Sequence[Band]) -> Column:
    """Largest n whose limit, carried by the row, is reached."""
    periods = _common_periods(bands)
    chain = F
    for i, n in reversed(list(enumerate(periods))):
        chain = chain.when(F.col(inches) >= F.col(f"limit_{i}"), F.lit(n))
    return chain.otherwise(F.lit(None).cast("int"))


def _common_periods(bands: Sequence[Band]) -> list[int]:
    periods = [n for n, _ in bands[0].limits]
    if any([n for n, _ in band.limits] != periods for band in bands):
        raise ValueError("all durations need the same return periods")
    return periods


def storm_candidates(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, bands: Sequence[Band], **more
) -> DataFrame:
    """Candidates: keys, n, duration_hrs, start_time, end_time, inches."""
    found = classified_windows(series, keys, ts, value, bands, **more)
    hours = F.make_dt_interval(F.lit(0), F.col("duration_hrs"))
    return found.select(
        *keys, "n", "duration_hrs", (F.col("end_time") - hours).alias("start_time"), "end_time", "inches"
    )


def band_counts(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, bands: Sequence[Band], *, full: bool = True, **more
) -> DataFrame:
    """Number of window ends per duration and return period."""
    found = classified_windows(series, keys, ts, value, bands, full=full, **more)
    return found.groupBy("duration_hrs", "n").agg(F.count("*").alias("windows"))


#: Candidates gathered before the next settling, and rounds of it before walking the rest.
HOLD, ROUNDS = 20_000, 40


def choose_without_overlap(
    candidates: DataFrame,
    keys: Sequence[str],
    rank: Sequence[tuple[str, bool]],
    *,
    closed: bool = True,
    hold: int = HOLD,
) -> DataFrame:
    """Walk candidates in rank order, keeping each that overlaps none kept before.

    ``rank`` lists (column, descending).  ``closed`` counts touching intervals as
    overlapping; otherwise an interval owns its hours and may touch another.
    ``start_time`` and ``end_time`` must lie on whole hours.

    The walk is not needed as such.  A candidate that is the best in all of its
    hours is kept whatever happens elsewhere, and what it touches goes; that is
    repeated.  Candidates arrive by start, so one that ends before the next start
    has met all it can meet: it can be settled at once, for all stations and
    hours held, by sliding maxima.  Only what still waits for a better,
    unfinished neighbour is held on, so a task holds about ``hold`` candidates
    and a few storms more, however long a station's history is.
    """
    keys = list(keys)
    ordered = Window.partitionBy(*keys).orderBy("_from", "_to")
    marked = (
        candidates.withColumns({"_from": hour_number("start_time"), "_to": hour_number("end_time")})
        .withColumn("_next", F.lead("_from").over(ordered))
        .sortWithinPartitions(*keys, "_from", "_to")
    )
    kept = marked.mapInArrow(_settled(tuple(rank), closed, hold), marked.schema)
    return kept.select(*candidates.columns)


def choose_windows(
    rolled: DataFrame,
    keys: Sequence[str],
    ts: str,
    bands: Sequence[Band],
    rank: Sequence[tuple[str, bool]],
    *,
    apart: bool,
    closed: bool = True,
    hold: int = HOLD,
) -> DataFrame:
    """:func:`choose_without_overlap` over the candidates among rolling totals.

    Gives keys, n, duration_hrs, start_time, end_time, inches; ``apart`` chooses per
    duration.  ``rolled`` comes from :func:`rolling_totals`, which leaves the rows of a key
    in order.  They go to the chooser as they are, one per window end, and become a row per
    duration only there: candidates are neither sorted nor spilled.  One of ``k`` hours that
    ends at the next window end or later starts at most ``k`` hours before it.
    """
    keys, periods = list(keys), _common_periods(bands)
    ordered = Window.partitionBy(*keys).orderBy("end_time")
    totals = [rolling_column(b.hours) for b in bands]
    ends = (
        rolled.filter(_any(F.col(total) >= F.lit(b.lowest) for total, b in zip(totals, bands)))
        .select(*keys, F.col(ts).alias("end_time"), hour_number(ts).alias("_hour"), *totals)
        .withColumn("_next", F.lead("_hour").over(ordered))
        .sortWithinPartitions(*keys, "end_time")
    )
    durations = [(b.hours, rolling_column(b.hours), [float(limit) for _, limit in b.limits]) for b in bands]
    spread = _spread_windows(keys, durations, periods, apart)
    out = rolled.select(
        *keys,
        F.lit(periods[0]).alias("n"),
        F.lit(0).alias("duration_hrs"),
        F.col(ts).alias("start_time"),
        F.col(ts).alias("end_time"),
        F.col(totals[0]).alias("inches"),
    )
    return ends.mapInArrow(_settled(tuple(rank), closed, hold, spread=spread), out.schema)


def _spread_windows(keys: list[str], durations: list[tuple[int, str, list[float]]], periods: list[int], apart: bool):
    """Arrow rows of window ends, with their key numbers, to a table of their candidates."""
    longest = max(hours for hours, _, _ in durations)
    hour_us = 3_600_000_000

    def spread(batch, key):
        import numpy as np
        import pyarrow as pa

        hour = batch.column("_hour").to_numpy()
        tables = []
        for at, (hours, total, limits) in enumerate(durations):
            inches = batch.column(total).to_numpy(zero_copy_only=False)
            own = np.flatnonzero(inches >= limits[0])
            ends, inches = batch.column("end_time").take(pa.array(own)), inches[own]
            reached = np.zeros(len(own), np.int64)
            for i, limit in enumerate(limits):
                reached[inches >= limit] = i
            starts = pa.array(ends.cast(pa.int64()).to_numpy(zero_copy_only=False) - hours * hour_us).cast(ends.type)
            tables.append(pa.table({
                **{name: batch.column(name).take(pa.array(own)) for name in keys},
                "n": np.array(periods, np.int32)[reached],
                "duration_hrs": np.full(len(own), hours, np.int32),
                "start_time": starts,
                "end_time": ends,
                "inches": inches,
                "_from": hour[own] - hours,
                "_to": hour[own],
                "_key": key[own] * len(durations) + at if apart else key[own],
                "_last": key[own],
                "_reach": np.full(len(own), hours if apart else longest, np.int64),
            }))
        return pa.concat_tables(tables)

    return spread


def _settled(rank: tuple[tuple[str, bool], ...], closed: bool, hold: int, rounds: int = ROUNDS, spread=None):
    """Chooser over a stream ordered by key and start; ``_next`` is the key's next start.

    With ``spread`` the stream is one of window ends in order, ``_next`` the key's next
    end, and ``spread`` gives the candidates that end there.  A nested function travels to the workers by value, so they need no copy of
    this package.
    """

    def choose(batches):
        import numpy as np
        import pyarrow as pa

        def best_in_all(first, last, worth, size):
            """Whether each interval (cells first to last - 1) has the highest worth of all its cells."""
            level = np.frexp(last - first)[1] - 1
            most = level.max(initial=0)
            tables = [np.zeros(size, np.int64) for _ in range(most + 1)]
            by_level = [np.flatnonzero(level == k) for k in range(most + 1)]
            for k, own in enumerate(by_level):
                np.maximum.at(tables[k], first[own], worth[own])
                np.maximum.at(tables[k], last[own] - (1 << k), worth[own])
            for k in range(most, 0, -1):  # an interval of 2^k cells is two of half the size
                half = 1 << (k - 1)
                np.maximum(tables[k - 1], tables[k], out=tables[k - 1])
                np.maximum(tables[k - 1][half:], tables[k][:-half], out=tables[k - 1][half:])
            highest = tables[0]
            found = np.empty(len(first), np.int64)
            for k, own in enumerate(by_level):
                found[own] = np.maximum(highest[first[own]], highest[last[own] - (1 << k)])
                if k < most:
                    highest = np.maximum(highest[: -(1 << k)], highest[1 << k :])
            return found == worth

        def settle(rows, last, following):
            """Row numbers kept, and of the last key, if it goes on, those that still wait."""
            start = rows.column("_from").to_numpy()
            stop = rows.column("_to").to_numpy() + (1 if closed else 0)
            key = rows.column("_key").to_numpy()
            waits = np.zeros(len(start), bool)
            if following is not None:
                frontier = following - rows.column("_reach").to_numpy()
                waits = (rows.column("_last").to_numpy() == last) & (stop > frontier)
            # All keys on one axis of cells between the ends that occur.
            low = min(start.min(), stop.min())
            axis = (key - key.min()) * (max(start.max(), stop.max()) - low + 1) - low
            points = np.unique(np.concatenate([start + axis, stop + axis]))
            first, last = np.searchsorted(points, start + axis), np.searchsorted(points, stop + axis)
            columns = []
            for name, descending in reversed(rank):
                column = rows.column(name)
                if pa.types.is_timestamp(column.type):
                    column = column.cast(pa.int64())
                values = column.to_numpy()
                columns.append(-values if descending else values)
            order = np.lexsort(columns)
            worth = np.empty(len(start), np.int64)
            worth[order] = np.arange(len(start), 0, -1)
            keep = last <= first
            alive = np.flatnonzero(~keep)
            size = len(points)
            for _ in range(rounds):
                if not len(alive):
                    break
                a, b = first[alive], last[alive]
                wins = best_in_all(a, b, worth[alive], size) & ~waits[alive]
                if not wins.any():
                    break
                keep[alive[wins]] = True
                edges = np.zeros(size + 1, np.int64)
                edges[a[wins]] += 1
                edges[b[wins]] -= 1
                taken = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]))])
                alive = alive[taken[b] == taken[a]]
            else:  # a long chain: walk it, the unsettled marking what they may take
                taken, open_ = np.zeros(size, bool), np.zeros(size, bool)
                left = []
                for i in alive[np.argsort(-worth[alive])]:
                    cells = slice(first[i], last[i])
                    if taken[cells].any():
                        continue
                    if waits[i] or open_[cells].any():
                        open_[cells] = True
                        left.append(i)
                    else:
                        taken[cells] = keep[i] = True
                alive = np.sort(np.array(left, np.int64))
            return np.flatnonzero(keep), alive

        helpers = ("_key", "_last", "_reach") if spread is None else ("_from", "_to", "_key", "_last", "_reach")

        def numbered(batch, key):
            """Candidates as they come: a key is settled by itself, the next start is the frontier."""
            rows = pa.Table.from_batches([batch])
            for name, values in zip(helpers, (key, key, np.zeros(len(key), np.int64))):
                rows = rows.append_column(name, pa.array(values))
            return rows

        waiting, held, gathered, last, following = [], 0, 0, 0, None

        def flush():
            nonlocal waiting, held, gathered
            rows = pa.concat_tables(waiting)
            kept, left = settle(rows, last, following)
            waiting = [rows.take(left)] if len(left) else []
            held, gathered = len(left), 0
            return rows.take(kept).drop_columns(list(helpers)).to_batches()

        ended = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(batch.column("_next").is_null().to_numpy(zero_copy_only=False))
            key = ended + np.concatenate([[0], ends[:-1]])
            last, following, ended = key[-1], batch.column("_next")[-1].as_py(), ended + ends[-1]
            rows = (spread or numbered)(batch, key)
            if not rows.num_rows:
                continue
            waiting.append(rows)
            gathered += rows.num_rows
            if gathered >= max(hold, held):
                yield from flush()
        if gathered or held:
            following = None
            yield from flush()

    return choose


def unique_storms(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, bands: Sequence[Band], **more
) -> DataFrame:
    """Storms of the highest class over their period, no two overlapping.

    Rank: n, duration and inches descending, then the earlier end.
    """
    rolled = rolling_totals(series, keys, ts, value, [b.hours for b in bands], **more)
    rank = [("n", True), ("duration_hrs", True), ("inches", True), ("end_time", False)]
    return choose_windows(rolled, keys, ts, bands, rank, apart=False, closed=True)


def storms_per_duration(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, limits: dict[int, float], **more
) -> DataFrame:
    """Heaviest storms of each duration at or above its limit, sharing no hour.

    ``limits`` maps hours to inches; windows must be full.
    """
    bands = [Band(hours, ((0, limit),)) for hours, limit in sorted(limits.items())]
    rolled = rolling_totals(series, keys, ts, value, [b.hours for b in bands], full=True, **more)
    rank = [("inches", True), ("end_time", False)]
    return choose_windows(rolled, keys, ts, bands, rank, apart=True, closed=False).drop("n")


def storms_within(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, bands: Sequence[Band], first: Column, last: Column
) -> DataFrame:
    """Candidates inside a sub-period; rolling totals see the sub-period only."""
    part = series.filter(F.col(ts).between(first, last))
    return storm_candidates(part, keys, ts, value, bands).filter(F.col("start_time") >= first)


def highest_storm_before(
    events: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    series: DataFrame,
    ts: str,
    value: str,
    bands: Sequence[Band],
    *,
    days: int = 10,
    digits: int = 4,
) -> DataFrame:
    """For each event the highest storm class in the days before it, or nulls.

    The look-back is [end of day - days, end of day], rolling totals computed on
    that slice only; order n, then duration, then inches (then the earlier end).

    Events of one day share a slice, so slices are per (keys, day) and a wet
    hour is copied into the ``days + 1`` slices that see it.  A rolling total
    peaks on a wet hour, so dry hours are dropped first.  The total that a slice
    must not see, everything before its first label, is the running sum at a
    midnight: one carried column and its lags, all on the series' own window.
    ``series`` must have a row for every hour, as ``resample`` gives.
    """
    keys = list(keys)
    unit = 10**digits
    window = Window.partitionBy(*keys).orderBy(ts)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("bigint")
    hours = [b.hours for b in bands]
    rows = series.withColumn("_units", F.coalesce(whole_units(value, unit), zero))
    rows = rows.withColumns({"_sum": F.sum("_units").over(so_far), "_hour": hour_number(ts)})
    at_midnight = F.when(F.col("_hour") % 24 == 0, F.col("_sum") - F.col("_units"))
    rows = rows.withColumn("_before", F.coalesce(F.last(at_midnight, ignorenulls=True).over(so_far), zero))
    rows = rows.withColumns({
        **{f"_past_{k}": F.coalesce(F.lag("_sum", k).over(window), zero) for k in hours},
        **{f"_before_{j}": F.coalesce(F.lag("_before", 24 * j).over(window), zero) for j in range(days + 1)},
    })
    # A label at midnight closes the day before, so it is the last one of the
    # slice ending there and the first one of the slice starting there.
    last_midnight = F.floor(F.col("_hour") / 24)
    copies = F.array(*[
        F.struct((last_midnight - j + days).alias("_slice"), F.col(f"_before_{j}").alias("_unseen"))
        for j in range(days + 1)
    ])
    durations = _per_duration(bands, _past=lambda b: F.col(f"_past_{b.hours}"))
    amount = F.lit(float(unit))
    # A total cut at the slice's start is at most the uncut one, so a duration
    # whose uncut total misses its lowest limit is dropped before the copies.
    reached = _any((F.col("_sum") - F.col(f"_past_{b.hours}")) / amount >= F.lit(b.lowest) for b in bands)
    rows = (
        rows.filter((F.col("_units") > 0) & reached)
        .withColumn("_copies", copies)
        .select(*keys, "_hour", "_sum", "_copies", F.inline(durations))
        .filter((F.col("_sum") - F.col("_past")) / amount >= F.col("limit_0"))
        .select("*", F.inline("_copies"))
        .filter(F.col("_hour") <= F.col("_slice") * 24)
        .withColumn("_units", F.col("_sum") - F.greatest("_past", "_unseen"))
        .withColumn("_inches", F.col("_units") / amount)
        .filter(F.col("_inches") >= F.col("limit_0"))
    )
    # The preference order is the order of the struct's fields; any number of
    # days, digits and hours fits.
    best = F.max(
        F.struct(
            _class_of("_inches", bands).alias("n"), "duration_hrs", "_units", (-F.col("_hour")).alias("_ahead")
        )
    )
    storms = rows.groupBy(*keys, "_slice").agg(best.alias("_best"))
    found = events.withColumn("_slice", day_number(event_ts) + 1).join(
        storms, [*keys, "_slice"], "left"
    )
    return found.select(
        *events.columns,
        F.col("_best.n").alias("n"),
        F.col("_best.duration_hrs").alias("duration_hrs"),
        (F.col("_best._units") / amount).alias("inches"),
        hour_start(-F.col("_best._ahead")).alias("storm_end"),
    )


#: Hours of a station's history that one task scans by itself: a year.
CHUNK_HOURS = 366 * 24


def _turning_rows(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, hours: int, digits: int, chunk_hours: int
) -> DataFrame:
    """The rows of a series without gaps at which a total over ``hours`` rows can change.

    These are the wet rows and those ``hours`` after one.  In between totals stay as they are,
    so what is shuffled and sorted grows with the readings and not with the hours that were
    filled in.  Rows added after a wet row may lie beyond the series: ``_end`` is its last row in
    their time chunk, null if it has none there.  Dry rows leave the first and last of each
    chunk, flagged ``_edge``.
    """
    keys = list(keys)
    at, none = F.col(ts), F.lit(None)
    kind = series.schema[ts].dataType
    wet = F.coalesce(whole_units(value, 10**digits), F.lit(0).cast("bigint")) != 0

    def row(label: Column, amount: Column, seen: Column) -> Column:
        place = F.floor(hour_number(F.coalesce(label, seen)) / chunk_hours)
        return F.struct(
            place.alias("_place"), label.cast(kind).alias("_label"),
            amount.cast("double").alias("_amount"), seen.cast(kind).alias("_seen"),
        )

    later = at + F.make_dt_interval(F.lit(0), F.lit(hours))
    spread = F.when(wet, F.array(row(at, F.col(value), at), row(later, none, none.cast(kind))))
    spread = spread.otherwise(F.array(row(none.cast(kind), none, at)))
    rows = (
        series.filter(at.isNotNull())
        .select(*keys, F.inline(spread))
        .groupBy(*keys, "_place", "_label")
        .agg(F.max("_amount").alias(value), F.min("_seen").alias("_first"), F.max("_seen").alias("_end"))
    )
    edges = F.array_distinct(F.array("_first", "_end"))
    edge = F.col("_label").isNull()
    labels = F.when(edge, edges).otherwise(F.array("_label"))
    return rows.select(*keys, value, "_end", edge.alias("_edge"), F.explode(labels).alias(ts))


def _rolled(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, hours: int, digits: int, chunk_hours: int
) -> DataFrame:
    """Whole units, their total over ``hours`` hours, and both of the hour before, per time chunk.

    Hours without a row count as dry.  Every chunk sees the ``hours`` + 1 hours before it, so
    no total needs another chunk.
    """
    window = Window.partitionBy(*keys, "_chunk").orderBy("_hour")
    zero = F.lit(0).cast("bigint")
    # Rows that come partitioned by the keys alone would stay so without being asked.
    rows = with_halo(series, ts, chunk_hours, hours + 1).repartition(*keys, "_chunk")
    rows = rows.withColumns({
        "_hour": hour_number(ts), "_units": F.coalesce(whole_units(value, 10**digits), zero)
    }).drop(value)
    spans = {
        "_roll": (1 - hours, 0), "_units_before": (-1, -1), "_roll_before": (-hours, -1)
    }
    totals = {
        out: F.coalesce(F.sum("_units").over(window.rangeBetween(*span)), zero) for out, span in spans.items()
    }
    return rows.withColumns(totals).filter(~F.col("_halo"))


def _rolled_turns(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, hours: int, digits: int, chunk_hours: int
) -> DataFrame:
    """:func:`_rolled` at the turning rows that the series has, one per hour."""
    turns = _turning_rows(series, keys, ts, value, hours, digits, chunk_hours)
    rows = _rolled(turns, keys, ts, value, hours, digits, chunk_hours)
    window = Window.partitionBy(*keys, "_chunk").orderBy("_hour")
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "_end": F.max("_end").over(whole), "_alike": F.count("*").over(window.rangeBetween(0, 0))
    })
    return rows.filter((F.col(ts) <= F.col("_end")) & ~(F.col("_edge") & (F.col("_alike") > 1)))


def rain_events(
    series: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    *,
    dry_hours: int = 12,
    floor: float = 0.04,
    digits: int = 4,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Rain events between dry spells of ``dry_hours``, over a series without gaps.

    An event starts in an hour with more than ``floor`` of rain whose previous
    row's rolling total is below ``floor``; it ends ``dry_hours`` before the
    first later row whose rolling total is below ``floor``, and is open (null
    end) when the series stops first.  ``total_precip`` covers the labels in the
    closed range [start, end].  Labels are hour ends, so a start is one hour
    before its label.

    A row below the floor closes a segment, so an event is a segment whose first
    row starts one.  Only rows where a rolling total can change are looked at.
    Segments are folded per (key, chunk of hours) and merged over chunks: a
    station's history is scanned by many tasks, once, forwards.
    """
    keys = list(keys)
    unit = 10**digits
    limit = F.lit(round(floor * unit))
    rows = _rolled_turns(series, keys, ts, value, dry_hours, digits, chunk_hours)
    opens, dry = F.col("_roll_before") < limit, F.col("_roll") < limit
    starts = opens & (F.col("_units") > limit)
    # A segment has one starting and one dry row at most: plain columns, which need no sort.
    folds = {
        "_start": ("max", F.when(starts, F.col(ts))),
        "_start_units": ("max", F.when(starts, F.col("_units_before"))),
        "_end": ("max", F.when(dry, F.col(ts))),
        "_end_units": ("max", F.when(dry, F.col("_roll"))),
        "_sum": ("sum", F.col("_units")),
    }
    # A dry row after a dry row is a segment by itself and no event.
    found = fold_segments(rows, keys, "_chunk", ts, opens, ~(opens & dry), folds).filter("_start is not null")
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    end = F.col("_end") - F.make_dt_interval(F.lit(0), F.lit(dry_hours))
    found = found.withColumns({"start_time": F.col("_start") - hour, "end_time": end})
    units = F.col("_start_units") + F.col("_sum") - F.col("_end_units")
    return found.select(
        *keys,
        "start_time",
        "end_time",
        (hour_number("end_time") - hour_number("start_time")).alias("duration_hrs"),
        (units / F.lit(float(unit))).alias("total_precip"),
    )


def rain_runs(
    series: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    *,
    dry_hours: int = 12,
    floor: float = 0.04,
    digits: int = 4,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Events as maximal runs of rows whose rolling total is at least ``floor``.

    Unlike :func:`rain_events` this also catches a downpour that follows drizzle.
    The series has no gaps; it is scanned in chunks like there.
    """
    keys = list(keys)
    unit = F.lit(float(10**digits))
    wet, wet_before = (F.col(c) / unit >= F.lit(floor) for c in ("_roll", "_roll_before"))
    rows = _rolled_turns(series, keys, ts, value, dry_hours, digits, chunk_hours)
    # The row that ends a run tells its last label; the rows before it may be left out.
    hour_before = F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(1))
    folds = {
        "first_label": ("min", F.when(wet, F.col(ts))),
        "last_label": ("max", F.when(wet, F.col(ts)).otherwise(hour_before)),
        "_sum": ("sum", F.when(wet, F.col("_units"))),
    }
    found = fold_segments(rows, keys, "_chunk", ts, wet & ~wet_before, wet | wet_before, folds)
    # With a floor of 0 or less a series starts inside a run, which a first row may only end.
    found = found.filter("first_label is not null")
    return found.select(*keys, "first_label", "last_label", (F.col("_sum") / unit).alias("total_precip"))
