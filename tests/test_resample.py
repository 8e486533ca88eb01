from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from tarnflow.operators import resample as rs

# Today's pandas spelling of each period.
PERIODS = ["h", "6h", "5h", "30min", "D", "3D", "W", "2W", "MS", "2MS", "ME", "2ME", "QS", "QE", "2QE", "YS", "YE", "2YS", "2YE"]


def series(kind):
    rng = np.random.default_rng(7)
    if kind == "gappy":
        start, step = pd.Timestamp("2018-03-11 05:00"), rng.integers(1, 24 * 9, 150).cumsum()
    else:
        start, step = pd.Timestamp("2020-01-31 22:00"), np.arange(150) * 13
    times = start + pd.to_timedelta(step, unit="h")
    values = np.round(rng.random(150) * 50, 2)
    values[rng.random(150) < 0.1] = np.nan
    return pd.DataFrame({"datetime": times, "value": values})


@pytest.mark.parametrize("kind", ["gappy", "steady"])
@pytest.mark.parametrize("agg", ["mean", "sum"])
def test_periods_equal_pandas(spark, kind, agg):
    data = series(kind)
    rows = [(t.to_pydatetime(), None if np.isnan(v) else float(v)) for t, v in data.itertuples(index=False)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, value double").cache()
    for period in PERIODS:
        wanted = data.set_index("datetime")[["value"]].resample(period).agg(agg)["value"].dropna()
        got = rs.resample(df, period, ["value"], agg).filter("value is not null").toPandas().set_index("datetime")["value"].sort_index()
        assert list(got.index) == list(wanted.index), period
        assert np.allclose(got.to_numpy(), wanted.to_numpy()), period


def test_old_letters_and_bad_periods(spark):
    df = spark.createDataFrame([(datetime(2020, 2, 5), 1.0)], "datetime timestamp_ntz, value double")
    assert rs.resample(df, "M", ["value"]).first()["datetime"] == datetime(2020, 2, 29)
    for bad in ("X", "0D", "D2", ""):
        with pytest.raises(ValueError, match="not recognized"):
            rs.resample(df, bad, ["value"])
    with pytest.raises(ValueError, match="not recognized"):
        rs.resample(df, "D", ["value"], "median")
    assert rs.resample(df.filter("false"), "3D", ["value"], "sum").count() == 0


@pytest.mark.parametrize("small", [1, 20, 8192])
def test_exact_percentile(spark, small):
    rng = np.random.default_rng(11)
    near = 1 + np.arange(300) * 2.0**-52
    wide = np.concatenate([rng.normal(0, 1, 200) * 10.0 ** rng.integers(-320, 300, 200), [0.0, -0.0, 2.0**-1074, -1e308, 2.0**1023]])
    groups = {"hot": np.round(rng.normal(50, 20, 3000), 2), "near": near, "wide": wide, "zeros": np.repeat([0.0, -2.0], [500, 20]), "few": np.array([3.0, 1.0]), "one": np.array([4.0]),
              "ties": np.repeat([1.0, 2.0, 3.0], 60), "none": np.array([])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("none", None), ("few", None)]
    df = spark.createDataFrame(rows, "g string, v double").cache()
    for share in (0.5, 0.99) if small == 1 else (0.01, 0.25, 0.9):
        got = {r["g"]: r["v"] for r in rs.exact_percentile(df, ["g"], "v", share, small).collect()}
        assert set(got) == set(groups) and got["none"] is None
        for k, vs in groups.items():
            if len(vs):
                assert got[k] == pytest.approx(np.quantile(vs, share), rel=1e-12), (k, share)


def test_percentile_cells_rise_with_the_value(spark):
    values = [s * m * 2.0**e for e in (-1074, -1022, -3, 0, 1, 52, 1000, 1023) for m in (1, 1 + 2.0**-52, 2 - 2.0**-52) for s in (1, -1)]
    values = sorted({v for v in values + [0.0, float("inf"), -float("inf")]}) + [float("nan")]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    for level in range(7):
        cells = [r[0] for r in df.select(rs._cell(df["v"], level).alias("c"), "k").orderBy("k").collect()]
        assert cells == sorted(cells) and cells[-1] > cells[-2], level


def test_percentile_infinite_and_nan(spark):
    rows = [("a", float("inf")), ("a", 1.0), ("a", -float("inf")), ("b", float("nan")), ("b", 1.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert {r["g"]: r["v"] for r in rs.exact_percentile(df, ["g"], "v", 0.5).collect()} == {"a": 1.0, "b": 2.0}
    assert rs.exact_percentile(df.where("false"), ["g"], "v", 0.5).count() == 0


def test_percentile_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    got = {r["g"]: r["v"] for r in rs.exact_percentile(df, ["g"], "v", 0.5).collect()}
    assert got == {None: 2.0, "a": 2.0}


def test_interval_arguments():
    for good in ("decadal", "yearly", "year", "monthly", "month", "daily", "day", "hourly", "hour", "001500", "235959"):
        rs.check_interval(good)
    for bad in ("week", "240000", "006000", "15", "0015000", "000000"):
        with pytest.raises(ValueError):
            rs.check_interval(bad)
    for good in ("min", "max", "mean", "average", "total", "counts", "perc-1", "perc-99"):
        rs.check_kind(good)
    for bad in ("median", "perc-0", "perc-100", "perc-x"):
        with pytest.raises(ValueError):
            rs.check_kind(bad)


def test_interval_starts(spark):
    t = datetime(1969, 12, 31, 23, 7, 30)
    df = spark.createDataFrame([("s", "Q", t, 1.0)], "station_id string, constituent string, datetime timestamp_ntz, value double")
    starts = {"decadal": datetime(1960, 1, 1), "year": datetime(1969, 1, 1), "month": datetime(1969, 12, 1),
              "day": datetime(1969, 12, 31), "hour": datetime(1969, 12, 31, 23), "000500": datetime(1969, 12, 31, 23, 5)}
    for interval, start in starts.items():
        assert rs.interval_aggregate(df, interval, "mean").first()["datetime"] == start, interval
