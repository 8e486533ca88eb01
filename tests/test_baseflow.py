from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnflow.operators import baseflow as bf

FIELDS = "station_id string, datetime timestamp_ntz, constituent string, unit string, value double"


def flows(n, seed=1):
    rng = np.random.default_rng(seed)
    base = 20 + 15 * np.sin(np.arange(n) / 50)
    storm = np.where(rng.random(n) < 0.05, rng.random(n) * 200, 0)
    return np.round(base + np.convolve(storm, 0.8 ** np.arange(30))[:n], 3)


def frame(spark, series, start=datetime(2019, 12, 20), hours=7):
    rows = [
        (station, start + timedelta(hours=hours * i), "Q", "cfs", float(v))
        for station, values in series.items() for i, v in enumerate(values)
    ]
    rows.append(("dry", start, "WT", "degf", 50.0))
    return spark.createDataFrame(rows, FIELDS)


def boughton(q, a, c, share=1.0):
    b = [share * q[0]]
    for x in q[1:]:
        b.append(min(a / (1 + c) * b[-1] + c / (1 + c) * x, x))
    return np.array(b)


def lyne_hollick(q, beta=0.925):
    first = [q[0]]
    for i in range(1, len(q)):
        first.append(min(beta * first[-1] + (1 - beta) / 2 * (q[i - 1] + q[i]), q[i]))
    back = [first[-1]]
    for i in range(len(q) - 2, -1, -1):
        back.append(min(beta * back[-1] + (1 - beta) / 2 * (first[i + 1] + first[i]), first[i]))
    return np.array(back[::-1])


def by_station(df):
    out = {}
    for r in df.orderBy("station_id", "datetime").collect():
        out.setdefault(r["station_id"], []).append(r["value"])
    return {k: np.array(v) for k, v in out.items()}


SERIES = {"A": flows(400), "B": flows(90, 2), "C": np.array([5.0])}


@pytest.mark.parametrize("months", [1, 3, 12])
def test_chunks_equal_step_by_step(spark, months):
    done = bf.baseflow(frame(spark, SERIES), a=0.97, c=0.03, months=months, min_per_year=1)
    got = by_station(done)
    assert set(got) == set(SERIES)
    for station, q in SERIES.items():
        assert np.allclose(got[station], boughton(q, 0.97, 0.03), rtol=1e-12)
        assert (got[station] <= q + 1e-12).all()


@pytest.mark.parametrize("months", [1, 12])
def test_two_pass_filter(spark, months):
    got = by_station(bf.baseflow(frame(spark, SERIES), method="LH", months=months, min_per_year=1))
    for station, q in SERIES.items():
        assert np.allclose(got[station], lyne_hollick(q), rtol=1e-12)


@pytest.mark.parametrize("months", [1, 12])
def test_calibration_equals_brute_force(spark, months):
    series = {k: SERIES[k] for k in ("A", "B")}
    grid = tuple(round(0.01 * i, 2) for i in range(1, 20))
    got = {r["station_id"]: r for r in bf.calibrate(frame(spark, series), months, 1, grid=grid).collect()}
    for station, q in series.items():
        rates = [(q[i - 1] - q[i + 1]) / 2 / q[i] for i in range(1, len(q) - 1) if q[i - 1] > q[i] > q[i + 1]]
        a = np.exp(-np.quantile(rates, 0.05))
        target = np.log1p(lyne_hollick(q))
        losses = [np.sum((np.log1p(boughton(q, a, c)) - target) ** 2) for c in grid]
        assert got[station]["a"] == pytest.approx(a, rel=1e-12)
        assert got[station]["c"] == pytest.approx(grid[int(np.argmin(losses))])


def test_short_years_gaps_and_bad_values(spark):
    q = list(flows(60, 5))
    df = frame(spark, {"A": q}, start=datetime(2019, 12, 30), hours=12)
    # Four values lie in 2019, the rest in 2020.
    done = bf.baseflow(df, a=0.9, c=0.1, min_per_year=10)
    assert np.allclose(by_station(done)["A"], boughton(q[4:], 0.9, 0.1))
    holes = df.withColumn("value", F.when(F.hour("datetime") == 12, F.lit(float("nan"))).otherwise(F.col("value")))
    assert np.allclose(by_station(bf.baseflow(holes, a=0.9, c=0.1, min_per_year=1))["A"], boughton(q[::2], 0.9, 0.1))


def test_parameters_per_station_and_seed(spark):
    params = spark.createDataFrame([("A", 0.9, 0.1), ("B", 0.8, 0.2)], "station_id string, a double, c double")
    got = by_station(bf.baseflow(frame(spark, SERIES), params=params, min_per_year=1, seed_share=0.5))
    assert set(got) == {"A", "B"}
    assert np.allclose(got["B"], boughton(SERIES["B"], 0.8, 0.2, 0.5))


def test_appended_rows_and_errors(spark):
    df = frame(spark, {"B": SERIES["B"]})
    done = bf.with_baseflow(df, a=0.9, c=0.1, min_per_year=1)
    assert done.columns == df.columns and done.count() == df.count() + len(SERIES["B"])
    assert bf.baseflow(df.filter("constituent = 'WT'"), min_per_year=1).count() == 0
    with pytest.raises(ValueError, match="not recognized"):
        bf.baseflow(df, method="Magic")


def test_default_calibration_runs_end_to_end(spark):
    got = by_station(bf.baseflow(frame(spark, {"A": SERIES["A"]}), min_per_year=1))
    assert len(got["A"]) == 400 and (got["A"] <= SERIES["A"] + 1e-9).all() and (got["A"] > 0).all()
