from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation, functions as F, types as T

from tarnflow import lookups, schemas
from tarnflow.functions import timing
from tarnflow.operators import filters, lab, portal, sensor
from tarnflow.plans import pipelines

LAB_FIELDS = (
    "SYS_LOC_CODE string, CAS_RN string, SAMPLE_DATE_TIME timestamp_ntz, SAMPLE_DATE_TIMEZONE string, "
    "RESULT_NUMERIC double, RESULT_UNIT string"
)
PORTAL_ROWS = T.StructType(schemas.PORTAL.fields + [T.StructField("station_id", T.StringType())])


def day(hour, minute=0):
    return datetime(2020, 6, 1, hour, minute)


def lab_frame(spark, rows):
    return spark.createDataFrame(rows, LAB_FIELDS)


def sensor_frame(spark, rows):
    """(station, time, value, code, unit, number)"""
    fields = (
        "station_no string, Timestamp timestamp_ntz, Value double, `Quality Code` bigint, ts_unitsymbol string, "
        "stationparameter_no string"
    )
    return spark.createDataFrame(rows, fields)


WORKED = [
    ("S1", "7723-14-0", day(10), "CST", 0.05, "mg/l"),
    ("S1", "7723-14-0", day(10, 30), "CST", float("nan"), "mg/l"),
    ("S1", "TEMP-W", day(10), "CDT", 22.0, "deg c"),
    ("S1", "TEMP-W", day(10), "CST", 20.0, "deg c"),
    ("S1", "7723-14-0", day(11), "CST", 0.08, "ug/l"),
]


def test_lab_worked_example(spark, rows):
    done = pipelines.lab_transform(lab_frame(spark, WORKED))
    assert done.schema.fieldNames() == schemas.OBSERVATION.fieldNames()
    got = rows(done.withColumn("value", F.round("value", 8)), "constituent", "datetime", "value", "unit")
    assert got == [
        ("TP", day(10), 0.025, "mg/l"), ("TP", day(11), 0.00008, "mg/l"),
        ("WT", day(9), 71.6, "degf"), ("WT", day(10), 68.0, "degf"),
    ]
    assert {r[0] for r in done.select("station_origin").collect()} == {"equis"}


def test_lab_normalize(spark):
    done = lab.normalize(lab_frame(spark, WORKED)).toPandas()
    assert "ug/l" not in set(done["unit"]) and done["datetime"].notna().all()
    assert set(done.loc[done["constituent"] == "WT", "unit"]) == {"degf"}


def test_lab_labels_and_unknowns(spark):
    data = [
        ("S1", "BOD", day(10), " utc ", 1.0, "mg/l"), ("S1", "BOD", day(10), "EST", 1.0, "mg/l"),
        ("S1", "BOD", day(10), "edt", 1.0, "mg/l"), ("S1", "BOD", day(10), "MST", 1.0, "mg/l"),
        ("S1", "BOD", day(10), None, 1.0, "mg/l"), ("S1", "FLOW", day(10), "CST", 1.0, "cfs"),
    ]
    seen = Observation()
    times = lab.lab_time(lab_frame(spark, data), seen).toPandas()["datetime"].tolist()
    assert [t.hour for t in times[:3]] == [4, 9, 8] and pd.isna(times[3]) and pd.isna(times[4])
    assert seen.get["unknown_labels"] == 1
    # Neither the unknown zone, the missing zone nor the unmapped analyte reaches the result.
    assert pipelines.lab_transform(lab_frame(spark, data)).count() == 3


def test_empty_inputs(spark):
    empty = lab_frame(spark, [])
    assert pipelines.lab_transform(empty).count() == 0
    rows = sensor_frame(spark, [])
    done = pipelines.sensor_transform(rows, a=0.9, c=0.1)
    assert done.count() == 0 and done.schema.fieldNames() == schemas.OBSERVATION.fieldNames()
    portal_rows = spark.createDataFrame([], PORTAL_ROWS)
    assert pipelines.portal_transform(portal_rows, lookups.parameter_map(spark)).count() == 0
    gauge = spark.createDataFrame([], "tstamp string, var_name string, value double, station_id string")
    assert pipelines.gauge_transform(gauge).count() == 0


@pytest.mark.parametrize("unit,value,new_unit,new_value", [
    ("°C", 0.0, "degf", 32.0), ("°C", 100.0, "degf", 212.0), ("kg", 1.0, "lb", 2.20462),
    ("ft³/s", 42.0, "cfs", 42.0), ("mg/l", 5.0, "mg/l", 5.0), ("degf", 50.0, "degf", 50.0), ("KG", 2.0, "lb", 4.40924),
])
def test_sensor_units(spark, unit, value, new_unit, new_value):
    row = sensor.sensor_units(sensor_frame(spark, [("H1", day(0), value, 1, unit, "x")])).first()
    assert row["ts_unitsymbol"] == new_unit and row["Value"] == pytest.approx(new_value)


def test_sensor_pipeline(spark, rows):
    q, wt = ("ft³/s", "262.1"), ("°C", "450.42")
    data = [
        ("H1", day(0), 100.0, 1, *q), ("H1", day(0, 15), 110.0, 1, *q), ("H1", day(0, 30), 105.0, 1, *q),
        ("H1", day(0, 45), 115.0, 200, *q), ("H1", day(1, 30), 90.0, 1, *q), ("H1", day(0), 20.0, 1, *wt),
        ("H1", day(0), 7.0, 1, "mg/l", "9999"), ("H1", day(5), None, 1, *wt),
    ]
    done = pipelines.sensor_transform(sensor_frame(spark, data), a=0.9, c=0.1, min_per_year=1)
    got = rows(done.filter("constituent != 'QB'"), "constituent", "datetime", "value", "unit", "station_origin")
    assert got == [
        ("9999", day(0), 7.0, "mg/l", "wiski"), ("Q", day(0), 105.0, "cfs", "wiski"), ("Q", day(2), 90.0, "cfs", "wiski"),
        ("WT", day(0), 68.0, "degf", "wiski"), ("WT", day(5), None, "degf", "wiski"),
    ]
    assert done.filter("constituent = 'QB'").count() == 2
    kept = pipelines.sensor_hourly(sensor_frame(spark, data), accepted=[1]).count()
    assert pipelines.sensor_hourly(sensor_frame(spark, data), filter_quality=False).count() >= kept


def test_year_edge_differs_between_orders(spark):
    late = datetime(1995, 12, 31, 23, 45)
    sensors = sensor_frame(spark, [("H1", late, 1.0, 1, "mg/l", "863"), ("H1", datetime(1995, 12, 31, 23, 29), 1.0, 1, "mg/l", "863"),
                                   ("H2", datetime(1995, 12, 31, 23, 30), 1.0, 1, "mg/l", "863")])
    kept = pipelines.sensor_hourly(sensors).collect()
    assert {(r["station_id"], r["datetime"]) for r in kept} == {("H1", datetime(1996, 1, 1)), ("H2", datetime(1996, 1, 1))}
    assert pipelines.lab_transform(lab_frame(spark, [("S1", "BOD", late, "CST", 1.0, "mg/l")])).count() == 0


def test_rounded_year_filter_upper_edge(spark):
    times = [datetime(1999, 12, 31, 23, 29), datetime(1999, 12, 31, 23, 30)]
    df = spark.createDataFrame([(t,) for t in times], "datetime timestamp_ntz")
    kept = filters.rounded_year_filter(df, 1996, 1999).collect()
    assert [r[0] for r in kept] == times[:1]


def test_hour_round_equals_pandas(spark):
    rng = np.random.default_rng(3)
    quarters = pd.Timestamp("1967-01-01") + pd.to_timedelta(rng.integers(0, 4 * 24 * 365 * 70, 4000) * 15, unit="min")
    exact = pd.Timestamp("1990-01-01") + pd.to_timedelta(rng.integers(0, 10**15, 4000), unit="us")
    times = pd.Series(list(quarters) + list(exact) + [pd.Timestamp("2020-01-01 00:30:00.000001")])
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        df = spark.createDataFrame([(t.to_pydatetime(),) for t in times], "t timestamp_ntz")
        done = df.select("t", timing.hour_round(F.col("t")).alias("r"), timing.hour_floor(F.col("t")).alias("f"),
                         timing.from_epoch_seconds(timing.epoch_seconds(F.col("t"))).alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = pd.Series([r["t"] for r in done])
    assert (pd.Series([r["r"] for r in done]) == got.dt.round("h")).all()
    assert (pd.Series([r["f"] for r in done]) == got.dt.floor("h")).all()
    assert (pd.Series([r["s"] for r in done]) == got.dt.floor("s")).all()


def test_portal(spark, rows):
    data = [
        ("Phosphorus as P", "2020-06-01", "10:00", "100", "ug/L", "A", "1"),
        ("Phosphorus as P", "2020-06-01", "10:30", "300", "ug/L", "A", "1"),
        ("Phosphorus as P", "2020-06-01", "10:10", "(null)", "ug/L", "A", "1"),
        ("Phosphorus as P", "2020-06-01", "10:20", "none", "ug/L", "A", "1"),
        ("Temperature, water", "2020-06-01", "10:00", "20", "deg C", "B", "2"),
        ("Temperature, water", "1996-01-01", "00:00", "20", "deg C", "B", "2"),
        ("Colour", "2020-06-01", "10:00", "20", "deg C", "B", "2"),
    ]
    df = spark.createDataFrame(data, PORTAL_ROWS)
    done = pipelines.portal_transform(df, lookups.parameter_map(spark))
    got = rows(done.withColumn("value", F.round("value", 9)), "constituent", "datetime", "value", "unit", "station_name", "station_origin")
    assert got == [("TP", day(10), 0.2, "mg/l", "A", "swd"), ("WT", day(10), 68.0, "degF", "B", "swd")]
    standard = rows(portal.standardize_units(done), "constituent", "unit")
    assert standard == [("TP", "mg/l"), ("WT", "degf")]


def test_scope_arguments(spark):
    df = sensor_frame(spark, [("H1", day(0), 1.0, 1, "kg", "5004")])
    assert filters.parameter_scope(df, "TP").count() == 0
    assert filters.parameter_scope(df, "TP", load_network=True).count() == 1
    with pytest.raises(ValueError, match="Invalid constituent"):
        filters.parameter_scope(df, "INVALID")


def test_defaults():
    assert lookups.defaults_for("Q") == ("cfs", "mean")
    assert lookups.defaults_for("DO") == ("mg/l", "mean")
    assert lookups.defaults_for("TP", agg="sum") == ("mg/l", "sum")
