"""Exact percentiles and description under skew."""

import numpy as np
import pytest

from stormspan.operators import stats


def shapes():
    rng = np.random.default_rng(3)
    yield "outlier", np.append(rng.normal(size=200_000).round(4), 1e12)
    yield "copies", np.repeat([1.0, 2.0, 7.0], [100_000, 5, 60_000])
    yield "sorted", np.arange(150_000.0)
    yield "heavy tail", rng.pareto(0.3, 100_000)
    for n in (1, 2, 5, 1001):
        yield f"{n} rows", rng.random(n)


@pytest.mark.parametrize(("name", "values"), list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
def test_percentiles_equal_the_plain_ones(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    wanted = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["probability"]: r["value"] for r in stats.exact_percentiles(df, "v", wanted).collect()}
    assert got == {p: pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12) for p in wanted}


def test_no_ordered_piece_is_large(spark):
    """One far outlier leaves the other values spread over many pieces."""
    values = np.append(np.random.default_rng(3).normal(size=200_000), 1e12)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    known = stats._known_rows(df, "v")
    first = stats._first_look(known, [0.25, 0.5, 0.75])
    held = known.withColumn("f", first).selectExpr("exists(sequence(0, 2), i -> value between f.low[i] and f.high[i]) AS held", "value")
    assert held.filter("held").count() < 0.02 * len(values)
    picture = stats.describe(df, "v").first()
    assert picture["count"] == len(values) and picture["max"] == 1e12
    assert [picture["p25"], picture["p50"], picture["p75"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_two_scans_and_missing_values(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.createDataFrame([(None,), (float("nan"),), (2.0,), (4.0,)], "v double").write.parquet(path)
    df = spark.read.parquet(path)
    made = stats.describe(df, "v")
    row = made.first()
    assert (row["count"], row["p25"], row["p50"], row["p75"], row["max"]) == (2, 2.5, 3.0, 3.5, 4.0)
    empty = stats.describe(df.filter("v > 9"), "v").first()
    assert (empty["count"], empty["p50"], empty["max"]) == (0, None, None)
    assert stats.exact_percentiles(df.filter("v > 9"), "v", [0.5]).count() == 0
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") + final.count("Scan parquet") <= 4  # two, each shown again with its reused exchange
