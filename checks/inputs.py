"""Hydrology inputs as projections of the star-schema tables. Every row of a table is used."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnflow import schemas
from tarnflow.functions import timing
from tarnflow.sources import read_station_registry, type_sensor, with_row_order

LAB_CODES = (
    "479-61-8", "CHLA-CORR", "BOD", "NO2NO3", "14797-55-8", "14797-65-0", "14265-44-2", "N-KJEL",
    "PHOSPHATE-P", "7723-14-0", "SOLIDS-TSS", "TEMP-W", "7664-41-7", "FLOW",
)
PORTAL_TEXTS = (
    "Phosphorus as P", "Orthophosphate as P", "Total suspended solids", "Temperature, water",
    "Nitrate as N", "Color of the water",
)


def scratch(spark: SparkSession) -> str:
    """A new folder for written tables, beside the session's checkpoints where it has a place."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a shared folder.")
        return tempfile.mkdtemp(prefix="tables-")
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _by_type(values: dict[str, str], column: str = "event_type") -> Column:
    expr = F
    for key, value in values.items():
        expr = expr.when(F.col(column) == key, value)
    return expr


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with station number ``s``, code ``k`` and the time snapped to the quarter hour."""
    t = F.col("ts")
    quarter = F.floor(F.minute(t) / 15).cast("int") * 15
    snapped = timing.hour_floor(t) + F.make_dt_interval(F.lit(0), F.lit(0), quarter)
    return table(spark, sf, "events").select(
        "event_type",
        "user_id",
        "event_id",
        snapped.alias("ts15"),
        "value",
        (F.col("user_id") % 5).alias("s"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


def sensor_station(s: Column) -> Column:
    return F.concat(F.when(s % 2 == 0, "E").otherwise("H"), F.lit("0"), s.cast("string"))


def sensor_text(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor rows as landed, the time as text with an offset."""
    k, s, kind = F.col("k"), F.col("s"), F.col("event_type")
    number = _by_type({"view": "262.1", "click": "450.42", "signup": "863", "error": "866", "purchase": "5004"})
    fine = F.when(s % 2 == 0, "08.Provisional.Edited").when(kind == "view", "15.Rated").otherwise("09.Archive")
    series = (
        F.when((kind == "signup") & (k % 2 == 0), "20.Day.Mean")
        .when(kind == "signup", "20.Day.Mean.Archive")
        .when(k % 4 == 0, fine)
        .when(k % 4 == 1, "20.Day.Mean")
        .when(k % 4 == 2, "20.Day.Mean.Archive")
        .otherwise("08.Provisional.Edited")
    )
    station = sensor_station(s)
    return events(spark, sf).select(
        F.date_format("ts15", "yyyy-MM-dd'T'HH:mm:ss.SSS'-06:00'").alias("Timestamp"),
        F.when(k % 25 != 7, F.col("value")).alias("Value"),
        k.cast("bigint").alias("Quality Code"),
        F.concat(F.lit("code "), k).alias("Quality Code Name"),
        _by_type({"view": "ft³/s", "click": "°C", "signup": "mg/L", "error": "mg/l", "purchase": "kg"}).alias("ts_unitsymbol"),
        series.alias("ts_name"),
        F.concat_ws("/", station, number, series).alias("ts_id"),
        station.alias("station_no"),
        F.concat(F.lit("Station "), s).alias("station_name"),
        F.lit("46.5").alias("station_latitude"),
        F.lit("-94.3").alias("station_longitude"),
        _by_type({"view": "11500", "click": "11504", "signup": "11528", "error": "11533", "purchase": "99999"}).alias("parametertype_id"),
        kind.alias("parametertype_name"),
        number.alias("stationparameter_no"),
        kind.alias("stationparameter_name"),
        F.lit(0).cast("bigint").alias("wplmn_flag"),
    )


def sensor(spark: SparkSession, sf: str) -> DataFrame:
    return type_sensor(sensor_text(spark, sf))


def load_members(spark: SparkSession, sf: str) -> DataFrame:
    """Load-network members: the stations of suppliers of odd nations."""
    odd = table(spark, sf, "supplier").filter(F.col("s_nationkey") % 2 == 1)
    return odd.select(sensor_station(F.col("s_suppkey") % 4).alias("station_no")).distinct()


def lab_station(key: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(key.cast("string"), 6, "0"))


def lab_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Laboratory results; the staging columns that have no counterpart are left out."""
    code = _pick(LAB_CODES, F.col("l_partkey") % 14)
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    quarter = (F.col("l_orderkey") % 96 * 15).cast("int")
    unit = (
        F.when(code == "TEMP-W", F.when(flag == "A", "deg C").when(flag == "N", "DegC").otherwise("degF"))
        .when(flag == "A", "ug/L").when(flag == "N", "mg/L").otherwise("mg/g")
    )
    return table(spark, sf, "lineitem").select(
        lab_station(F.col("l_suppkey")).alias("SYS_LOC_CODE"),
        code.alias("CAS_RN"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), quarter)).alias("SAMPLE_DATE_TIME"),
        F.when(line == 1, "CST").when(line == 2, " cdt ").when(line == 3, "UTC").when(line == 4, "EST")
        .when(line == 5, "EDT").when(line == 6, "XYZ").alias("SAMPLE_DATE_TIMEZONE"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("RESULT_NUMERIC"),
        unit.alias("RESULT_UNIT"),
        F.when(F.col("l_linestatus") == "O", "Final").otherwise("Draft").alias("APPROVAL_CODE"),
        F.when(F.col("l_tax") == 0, "N").otherwise("Y").alias("REPORTABLE_RESULT"),
        _facility(F.col("l_partkey")).alias("FACILITY_ID"),
        F.col("l_orderkey").alias("SAMPLE_ID"),
        F.when(F.col("l_suppkey") % 4 == 1, "Lake").otherwise("River/Stream").alias("LOC_TYPE"),
        F.lit(None).cast("double").alias("LATITUDE"),
        F.lit(None).cast("double").alias("LONGITUDE"),
        F.lit(None).cast("string").alias("WID_LIST"),
        F.lit(None).cast("string").alias("SAMPLE_METHOD"),
        F.lit(None).cast("string").alias("SAMPLE_REMARK"),
    )


def _facility(key: Column) -> Column:
    return F.when(key % 3 == 0, 1).when(key % 3 == 1, 33836701).otherwise(7).cast("bigint")


def lab_staging(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows in all staging columns."""
    raw = lab_raw(spark, sf)
    gaps = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.LAB if f.name not in raw.columns]
    return schemas.conform(raw.select("*", *gaps), schemas.LAB)


def lab_stations(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.col("s_nationkey")
    return table(spark, sf, "supplier").select(
        lab_station(F.col("s_suppkey")).alias("SYS_LOC_CODE"),
        _facility(F.col("s_suppkey")).alias("FACILITY_ID"),
        (nation + 40.5).alias("LATITUDE"),
        (nation - 100.25).alias("LONGITUDE"),
        F.concat(F.lit("W"), nation).alias("WID_LIST"),
        F.when(nation % 4 == 0, "Lake").otherwise("River/Stream").alias("LOC_TYPE"),
        F.concat(F.lit("Basin "), nation % 5).alias("LOC_MAJOR_BASIN"),
        F.when(F.col("s_acctbal") < 0, "Y").otherwise("N").alias("NON_PUBLIC_LOCATION_FLAG"),
    )


def lab_samples(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("SAMPLE_ID"),
        F.when(priority == "1", "G-EVT").when(priority == "2", "G").when(priority == "3", "FIELDMSROBS")
        .otherwise("PUMP").alias("SAMPLE_METHOD"),
        F.col("o_orderstatus").alias("SAMPLE_REMARK"),
    )


def portal_raw(spark: SparkSession, sf: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    minutes = key % 96 * 15
    parameter = _pick(PORTAL_TEXTS, customer % 6)
    return table(spark, sf, "orders").select(
        parameter.alias("parameter"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("sampleDate"),
        F.format_string("%02d:%02d", F.floor(minutes / 60), minutes % 60).alias("sampleTime"),
        F.when(key % 20 == 3, "(null)").when(key % 20 == 7, "n/a")
        .when(key % 20 != 9, F.col("o_totalprice").cast("string")).alias("result"),
        F.when(key % 50 == 1, F.lit(None)).when(customer % 6 == 3, "deg C").when(key % 2 == 1, "UG/L")
        .otherwise("mg/L").alias("resultUnit"),
        F.concat(F.lit("Site "), customer % 100).alias("stationName"),
        F.concat(F.lit("P"), customer % 100).alias("station_id"),
    )


def gauge_raw(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        F.date_format("ts15", "yyyy-MM-dd HH:mm:ss").alias("tstamp"),
        _by_type({"view": "Discharge (cfs)", "click": "Water Temp. (C)", "signup": "DO (mg/L)"}).otherwise("Stage (ft)").alias("var_name"),
        F.when(F.col("k") % 10 != 0, F.col("value")).alias("value"),
        F.concat(F.lit("G"), F.col("user_id") % 7).alias("station_id"),
    )


def registry_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Sensor and laboratory station tables."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    places = (
        with_row_order(table(spark, sf, "supplier"))
        .join(table(spark, sf, "nation"), nation == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    opnids = (
        F.when(key % 6 == 0, "").when(key % 6 == 1, "  ")
        .when(key % 6 == 2, F.concat(nation, F.lit(".0")))
        .when(key % 6 == 3, F.concat(nation, F.lit(".0, "), nation + 1))
        .otherwise(F.concat(nation, F.lit(","), nation + 5))
    )
    shared = [
        nation.alias("true_opnid"),
        opnids.alias("opnids"),
        F.col("s_name").alias("comments"),
        F.when(key % 2 == 0, "yes").alias("modeled"),
        F.when(nation != 24, F.col("r_name")).alias("repo_name"),
        "row_order",
    ]
    sensors = places.select(sensor_station(key % 5).alias("station_id"), *shared, (key % 2).cast("int").alias("wplmn_flag"))
    labs = places.select(lab_station(key).alias("station_id"), *shared)
    return sensors, labs


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return read_station_registry(*registry_parts(spark, sf))


def xref(spark: SparkSession, sf: str) -> DataFrame:
    """One line per customer; names repeat on both sides."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    lab = F.concat(F.lit("S"), nation, F.lit("-"), key % 40)
    return table(spark, sf, "customer").select(
        F.when(key % 11 != 0, F.concat(F.lit("H"), F.floor(key / 3))).alias("WISKI_STATION_NO"),
        F.when(key % 13 != 0, lab).alias("EQUIS_STATION_ID"),
        F.when(key % 3 == 0, lab).when(key % 30 == 1, F.concat(lab, F.lit("x"))).alias("WISKI_EQUIS_ID"),
        F.concat(F.lit("W"), nation).alias("WID"),
    )
