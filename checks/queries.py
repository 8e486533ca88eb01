"""One query per operator over the driver's tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks import inputs as I
from checks.oracle_parts import ACCEPTED, hour_round, lab_station, sensor_station, sql
from tarnflow import lookups, schemas
from tarnflow.functions import codes, timing
from tarnflow.operators import baseflow as bf
from tarnflow.operators import crossref, filters, lab, outlets, portal, ranking, resample, sensor, views
from tarnflow.plans import pipelines, query
from tarnflow.plans.warehouse import Warehouse, write_csv, write_parquet
from tarnflow import sources

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Baseflow with given constants, so that SQL can follow it step by step.
FIXED_FILTER = {"a": 0.95, "c": 0.02}
SENSORS = ["E00", "H01", "E02", "H03", "E04"]
MODEL = "ASIA"


def check(name: str, twin: str | None = None):
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if twin is not None:
            ORACLE[name] = twin_sql(twin)
        return function

    return keep


# Means of values with few decimals often lie exactly half-way between two sixth decimals, where the
# order of summation decides. Both sides move off these points before rounding.
NUDGE = 1e-9


def twin_sql(text: str) -> str:
    return sql(text.replace(", 6)", f" + {NUDGE}, 6)"))


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + NUDGE, 6) for c in columns})


# ---- Shared intermediate results --------------------------------------------------------------


def sensor_norm(s, d):
    return sensor.normalize(I.sensor(s, d))


def sensor_hourly(s, d):
    return pipelines.sensor_hourly(I.sensor(s, d))


def sensor_obs(s, d):
    return pipelines.sensor_transform(I.sensor(s, d), **FIXED_FILTER)


def lab_norm(s, d):
    return lab.normalize(I.lab_raw(s, d))


def lab_obs(s, d):
    return pipelines.lab_transform(I.lab_raw(s, d))


def obs(s, d):
    return views.observations(lab_obs(s, d), sensor_obs(s, d))


def mapped(s, d):
    return outlets.assign_outlets(I.registry(s, d), ["comments"])


def outlet_tables(s, d):
    return outlets.build_outlets(mapped(s, d))


def pairs(s, d):
    t = outlet_tables(s, d)
    return outlets.station_reach_pairs(t.stations, t.reaches)


def outlet_obs(s, d):
    return views.outlet_observations(obs(s, d), outlet_tables(s, d).stations)


def texts(s):
    return lookups.parameter_map(s)


def portal_vals(s, d):
    return I.portal_raw(s, d).transform(portal.portal_time).transform(portal.portal_values, texts(s))


# ---- Sources ------------------------------------------------------------------------------------

_LAB_SHOWN = ["SYS_LOC_CODE", "CAS_RN", "SAMPLE_DATE_TIME", "SAMPLE_DATE_TIMEZONE", "RESULT_NUMERIC", "RESULT_UNIT", "FACILITY_ID", "SAMPLE_ID", "LOC_TYPE"]
_SENSOR_SHOWN = ["Timestamp", "Value", "Quality Code", "ts_unitsymbol", "ts_name", "ts_id", "station_no", "station_name", "parametertype_id", "stationparameter_no"]
_SENSOR_SQL = ", ".join(f'"{c}"' for c in _SENSOR_SHOWN)


@check("s1_read_lab_staging", f"SELECT {', '.join(_LAB_SHOWN)} FROM lab")
def _(s, d):
    path = I.scratch(s) + "/lab"
    write_parquet(I.lab_staging(s, d), path)
    return sources.read_lab_staging(s, path).select(*_LAB_SHOWN)


@check("s2_read_sensor_staging", f"SELECT {_SENSOR_SQL} FROM sensor")
def _(s, d):
    path = I.scratch(s) + "/sensor"
    write_parquet(I.sensor_text(s, d), path)
    return sources.read_sensor_staging(s, path).select(*_SENSOR_SHOWN)


@check("s3_load_csv", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(s, d):
    path = I.scratch(s) + "/customer"
    write_csv(I.table(s, d, "customer"), path)
    return sources.load_csv(s, path)


@check("s4_load_parquet", "SELECT * FROM orders")
def _(s, d):
    return sources.load_parquet(s, f"{d}/orders.parquet")


@check("s5_parse_series_json", f"""
    SELECT ts15 AS "Timestamp", value AS "Value", CAST(k AS BIGINT) AS "Quality Code", event_type AS ts_name,
        {sensor_station('s')} AS station_no FROM ev
    UNION ALL
    SELECT ts15 + INTERVAL 15 MINUTE, NULL, 255, event_type, {sensor_station('s')} FROM ev""")
def _(s, d):
    clock = "yyyy-MM-dd'T'HH:mm:ss.SSS'-06:00'"
    later = F.date_format(F.col("ts15") + F.expr("interval 15 minutes"), clock)
    body = F.format_string(
        '[{"ts_name":"%s","station_no":"%s","rows":"2","columns":"Timestamp,Value,Quality Code","data":[["%s",%s,%d],["%s",null,255]]}]',
        "event_type", I.sensor_station(F.col("s")), F.date_format("ts15", clock), F.col("value").cast("string"), "k", later,
    )
    parsed = sources.parse_series_json(I.events(s, d).select(body.alias("body")))
    return sources.type_sensor(parsed).select("Timestamp", "Value", "Quality Code", "ts_name", "station_no")


@check("s6_parse_table_json", """
    SELECT 'H' || s_suppkey AS station_no, s_name AS station_name FROM supplier
    UNION ALL SELECT 'E' || s_suppkey, s_name || ' (old)' FROM supplier""")
def _(s, d):
    body = F.format_string(
        '[["station_name","station_no"],["%s","H%d"],["%s (old)","E%d"]]', "s_name", "s_suppkey", "s_name", "s_suppkey"
    )
    return sources.parse_table_json(I.table(s, d, "supplier").select(body.alias("body")), ["station_no", "station_name"])


_PORTAL_ROWS = """
    SELECT parameter, CAST(datetime AS VARCHAR)[1:10] AS "sampleDate", CAST(datetime AS VARCHAR)[12:16] AS "sampleTime", result,
        resultUnit AS "resultUnit", stationName AS "stationName", station_id FROM portal"""


@check("s7_read_portal_lines", _PORTAL_ROWS)
def _(s, d):
    path = I.scratch(s) + "/portal"
    I.portal_raw(s, d).write.partitionBy("station_id").json(path)
    return sources.read_portal_results(s, path, lines=True)


@check("s7_parse_portal_json", _PORTAL_ROWS)
def _(s, d):
    row = F.struct("parameter", "sampleDate", "sampleTime", "result", "resultUnit", "stationName")
    body = F.to_json(F.struct(F.array(row).alias("data")))
    return sources.parse_portal_json(I.portal_raw(s, d).select("station_id", body.alias("body")))


@check("s8_read_gauge_csv", """
    SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS tstamp, variable AS var_name, value, station_id FROM gauge""")
def _(s, d):
    path = I.scratch(s) + "/gauge"
    I.gauge_raw(s, d).write.partitionBy("station_id").options(header=True).csv(path)
    return sources.read_gauge_csv(s, path)


@check("s9_read_station_registry", "SELECT station_id, true_opnid, opnids, comments, modeled, repo_name, wplmn_flag, source FROM registry")
def _(s, d):
    return I.registry(s, d).drop("row_order")


@check("s10_load_lookups", """
    SELECT cas_rn, constituent, count(*) AS n FROM lab_norm WHERE constituent IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT parametertype_id, CASE parametertype_id WHEN '11500' THEN 'Q' WHEN '11504' THEN 'WT' WHEN '11528' THEN 'OP' ELSE 'DO' END, count(*)
    FROM sensor WHERE parametertype_id <> '99999' GROUP BY ALL""")
def _(s, d):
    tables = sources.load_lookups(s)
    labs = I.lab_raw(s, d).select(F.col("CAS_RN").alias("cas_rn")).join(tables["equis_casrn"], "cas_rn")
    kinds = I.sensor(s, d).select("parametertype_id").join(tables["wiski_parametertype"], "parametertype_id")
    both = labs.unionByName(kinds.withColumnRenamed("parametertype_id", "cas_rn"))
    return both.groupBy("cas_rn", "constituent").agg(F.count("*").alias("n"))


@check("s11_import_outlets", "SELECT outlet_id, station_id, station_origin, reach_id, repository_name FROM pairs")
def _(s, d):
    path, t = I.scratch(s), outlet_tables(s, d)
    for name, df in zip(t._fields, t):
        write_parquet(df, f"{path}/outlet_{name}")
    back = sources.import_outlets(s, path)
    return outlets.station_reach_pairs(back.stations, back.reaches)


# ---- Sinks --------------------------------------------------------------------------------------

_OBS = "datetime, round(value, 6) AS value, station_id, station_origin, constituent, unit"


@check("k1_append_aligned", f"SELECT {_OBS} FROM lab_obs UNION ALL SELECT {_OBS} FROM lab_obs")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8)
    rows = lab_obs(s, d)
    w.append("analytics.equis", rows.withColumn("extra", F.lit(1)).select("extra", *reversed(rows.columns)))
    w.append("analytics.equis", rows)
    return r6(w.read("analytics.equis"), "value")


@check("k2_replace_table", f"SELECT {_OBS} FROM sensor_obs")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8)
    w.replace("analytics.wiski", lab_obs(s, d))
    w.replace("analytics.wiski", sensor_obs(s, d))
    return r6(w.read("analytics.wiski"), "value")


@check("k3_promote", f"SELECT {', '.join(_LAB_SHOWN)} FROM lab")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8)
    w.replace("staging.equis", I.lab_staging(s, d))
    w.promote("staging.equis", "analytics.equis")
    return w.read("analytics.equis").select(*_LAB_SHOWN)


@check("k3_then_process", f"SELECT {_OBS} FROM sensor_obs UNION ALL SELECT {_OBS} FROM lab_obs")
def _(s, d):
    w = _staged(s, d)
    w.promote("staging.equis", "analytics.equis")
    w.process_sensor(**FIXED_FILTER)
    first = w.read("analytics.wiski")
    w.process_lab()
    return r6(first.unionByName(w.read("analytics.equis").select(*first.columns)), "value")


@check("k4_replace_stations", f"""
    SELECT {_OBS} FROM sensor_obs WHERE station_id NOT IN ('E00', 'H01')
    UNION ALL
    SELECT datetime, round(value * 2, 6), station_id, station_origin, constituent, unit FROM sensor_obs WHERE station_id = 'E00'""")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8)
    w.replace("analytics.wiski", sensor_obs(s, d))
    incoming = w.read("analytics.wiski", ["E00"]).withColumn("value", F.col("value") * 2)
    w.replace_stations("analytics.wiski", incoming, ["E00", "H01"])
    return r6(w.read("analytics.wiski"), "value")


@check("k4_unnamed_stations", f"""
    SELECT {_OBS} FROM sensor_obs WHERE station_id <> 'H01'
    UNION ALL
    SELECT datetime, round(value * 2, 6), station_id, station_origin, constituent, unit FROM sensor_obs WHERE station_id IN ('E00', 'H03')""")
def _(s, d):
    # The batch holds stations that are not to be replaced: they keep their rows and gain new ones.
    w = Warehouse(s, I.scratch(s), buckets=2)
    w.replace("analytics.wiski", sensor_obs(s, d))
    incoming = w.read("analytics.wiski", ["E00", "H03"]).withColumn("value", F.col("value") * 2)
    w.replace_stations("analytics.wiski", incoming, ["H01"])
    return r6(w.read("analytics.wiski"), "value")


@check("k4_empty_list", f"""
    SELECT {_OBS} FROM sensor_obs
    UNION ALL
    SELECT datetime, round(value * 2, 6), station_id, station_origin, constituent, unit FROM sensor_obs WHERE station_id = 'E02'""")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=2)
    w.replace("analytics.wiski", sensor_obs(s, d))
    w.replace_stations("analytics.wiski", w.read("analytics.wiski", ["E02"]).withColumn("value", F.col("value") * 2), [])
    return r6(w.read("analytics.wiski"), "value")


@check("k4_reopened", f"SELECT {_OBS} FROM sensor_obs WHERE station_id = 'E02'")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=5)
    w.replace("analytics.wiski", sensor_obs(s, d))
    return r6(Warehouse(s, w.root).read("analytics.wiski", ["E02"]), "value")


@check("k5_write_parquet", f"SELECT {_OBS} FROM lab_obs")
def _(s, d):
    path = I.scratch(s) + "/obs"
    write_parquet(lab_obs(s, d), path, "zstd")
    return r6(sources.load_parquet(s, path), "value")


@check("k6_write_csv", f"SELECT {_OBS} FROM lab_obs")
def _(s, d):
    path = I.scratch(s) + "/obs"
    write_csv(lab_obs(s, d), path, sep=";")
    back = s.read.schema(schemas.OBSERVATION).options(header=True, sep=";").csv(path)
    return r6(back, "value")


@check("k7_export_station", f"SELECT {_OBS} FROM sensor_obs WHERE station_id = 'E02'")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8)
    w.replace("analytics.wiski", sensor_obs(s, d))
    w.replace("analytics.equis", w.template("analytics.equis"))
    w.export_station("E02", "wiski", w.root + "/export")
    return r6(s.read.schema(schemas.OBSERVATION).options(header=True).csv(w.root + "/export"), "value")


@check("k8_templates", f"SELECT {', '.join(_LAB_SHOWN)} FROM lab")
def _(s, d):
    empty = Warehouse(s, I.scratch(s)).template("staging.equis")
    return empty.unionByName(I.lab_staging(s, d)).select(*_LAB_SHOWN)


@check("k7_export_raw", f"SELECT {_SENSOR_SQL} FROM sensor WHERE station_no = 'E02'")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8).init()
    w.append("staging.wiski", I.sensor_text(s, d))
    w.export_raw("E02", "wiski", w.root + "/export")
    back = s.read.schema(schemas.SENSOR).options(header=True).csv(w.root + "/export")
    return sources.type_sensor(back).select(*_SENSOR_SHOWN)


@check("k8_template_sensor", f"SELECT {_SENSOR_SQL} FROM sensor")
def _(s, d):
    empty = Warehouse(s, I.scratch(s)).template("staging.wiski")
    return sources.type_sensor(empty.unionByName(I.sensor_text(s, d))).select(*_SENSOR_SHOWN)


@check("v2_validate_tables", """
    SELECT unnest(['analytics.equis', 'analytics.wiski', 'outlets.outlet_groups', 'outlets.outlet_reaches', 'outlets.outlet_stations', 'staging.equis']) AS missing,
        (SELECT count(*) FROM sensor) AS n_staged""")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8)
    w.append("staging.wiski", I.sensor_text(s, d))
    try:
        w.validate()
    except ValueError as error:
        missing = str(error).removeprefix("Missing tables: ").split(", ")
    staged = w.read("staging.wiski").agg(F.count("*").alias("n_staged"))
    return staged.select(F.explode(F.array(*[F.lit(m) for m in missing])).alias("missing"), "n_staged")


@check("k9_refresh_views", "SELECT station_origin, constituent, count(*) AS n FROM obs GROUP BY ALL")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8).init()
    w.replace("analytics.wiski", sensor_obs(s, d))
    w.replace("analytics.equis", lab_obs(s, d))
    w.refresh_views()
    return s.sql("SELECT station_origin, constituent, count(*) AS n FROM analytics_observations GROUP BY ALL")


# ---- Projections --------------------------------------------------------------------------------


@check("p1_sensor_units", "SELECT ts_id, datetime, round(value, 6) AS value, unit FROM sensor_norm")
def _(s, d):
    done = sensor.sensor_units(I.sensor(s, d))
    return done.select("ts_id", F.col("Timestamp").alias("datetime"), F.round(F.col("Value") + NUDGE, 6).alias("value"), F.col("ts_unitsymbol").alias("unit"))


@check("p2_sensor_constituent", "SELECT stationparameter_no, constituent, count(*) AS n FROM sensor_norm GROUP BY ALL")
def _(s, d):
    done = sensor.sensor_constituent(I.sensor(s, d))
    return done.groupBy("stationparameter_no", "constituent").agg(F.count("*").alias("n"))


@check("p3_sensor_columns", 'SELECT "Timestamp" AS datetime, "Value" AS value, "Quality Code" AS quality_code, station_no AS station_id, ts_unitsymbol AS unit FROM sensor')
def _(s, d):
    return sensor.sensor_columns(I.sensor(s, d)).select("datetime", "value", "quality_code", "station_id", "unit")


_LAB_NORM = "station_id, constituent, cas_rn, datetime, round(value, 6) AS value, unit"


@check("p4_lab_units", "SELECT station_id, cas_rn, round(value, 6) AS value, unit FROM lab_norm")
def _(s, d):
    raw = I.lab_raw(s, d).select(
        F.col("SYS_LOC_CODE").alias("station_id"), F.col("CAS_RN").alias("cas_rn"),
        F.col("RESULT_NUMERIC").alias("value"), F.col("RESULT_UNIT").alias("unit"),
    )
    return r6(lab.lab_units(raw), "value")


@check("p5_lab_constituent", "SELECT cas_rn, constituent, count(*) AS n FROM lab_norm GROUP BY ALL")
def _(s, d):
    done = lab.lab_constituent(I.lab_raw(s, d))
    return done.groupBy(F.col("CAS_RN").alias("cas_rn"), "constituent").agg(F.count("*").alias("n"))


@check("p6_lab_time", "SELECT station_id, cas_rn, datetime FROM lab_norm")
def _(s, d):
    done = lab.lab_time(I.lab_raw(s, d))
    return done.select(F.col("SYS_LOC_CODE").alias("station_id"), F.col("CAS_RN").alias("cas_rn"), "datetime")


@check("p7_lab_columns", f"SELECT {_LAB_NORM} FROM lab_norm")
def _(s, d):
    return r6(lab_norm(s, d), "value")


@check("p8_nondetect_to_zero", "SELECT station_id, datetime, coalesce(round(value, 6), 0) AS value FROM lab_norm")
def _(s, d):
    return r6(lab.nondetect_to_zero(lab_norm(s, d)), "value").select("station_id", "datetime", "value")


@check("p9_portal_values", """
    SELECT datetime, round(value, 6) AS value, variable, unit, station_id, station_name, constituent,
        'instantaneous' AS data_format, 'discrete' AS data_type, 'swd' AS station_origin FROM portal_vals""")
def _(s, d):
    return r6(portal_vals(s, d), "value")


@check("p10_parameter_map", """
    SELECT parameter, CASE parameter WHEN 'Phosphorus as P' THEN 'TP' WHEN 'Orthophosphate as P' THEN 'TP'
        WHEN 'Total suspended solids' THEN 'TSS' WHEN 'Temperature, water' THEN 'WT' WHEN 'Nitrate as N' THEN 'NO3' END AS constituent,
        count(*) AS n FROM portal GROUP BY ALL""")
def _(s, d):
    known = I.portal_raw(s, d).join(texts(s), "parameter", "left")
    return known.groupBy("parameter", "constituent").agg(F.count("*").alias("n"))


@check("p10_last_listed", "SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey")
def _(s, d):
    return lookups.last_listed(I.table(s, d, "orders"), "o_custkey", "o_orderstatus", "o_orderkey")


_GAUGE = """
    SELECT datetime, variable, value, station_id,
        CASE variable WHEN 'Discharge (cfs)' THEN 'cfs' WHEN 'Water Temp. (C)' THEN 'C' WHEN 'DO (mg/L)' THEN 'mg/L' END AS unit,
        CASE variable WHEN 'Discharge (cfs)' THEN 'Q' WHEN 'Water Temp. (C)' THEN 'WT' WHEN 'DO (mg/L)' THEN 'DO' END AS constituent,
        'csg' AS source FROM gauge WHERE value IS NOT NULL"""


@check("p11_gauge_values", _GAUGE)
def _(s, d):
    return portal.gauge_values(I.gauge_raw(s, d))


@check("p12_constituent_by_parametertype", """
    SELECT parametertype_id, CASE parametertype_id WHEN '11500' THEN 'Q' WHEN '11504' THEN 'WT' WHEN '11528' THEN 'OP' WHEN '11533' THEN 'DO' END AS constituent,
        count(*) AS n FROM sensor GROUP BY ALL""")
def _(s, d):
    done = I.sensor(s, d).join(lookups.parameter_types(s), "parametertype_id", "left")
    return done.groupBy("parametertype_id", "constituent").agg(F.count("*").alias("n"))


@check("p13_hour_round", f"SELECT event_id, {hour_round('ts15')} AS snapped, {hour_round('ts')} AS exact FROM (SELECT event_id, ts15 FROM ev) a JOIN (SELECT event_id AS id, ts FROM events) b ON a.event_id = b.id")
def _(s, d):
    raw = I.table(s, d, "events").select("event_id", "ts")
    quarter = F.floor(F.minute("ts") / 15).cast("int") * 15
    snapped = timing.hour_floor(F.col("ts")) + F.make_dt_interval(F.lit(0), F.lit(0), quarter)
    return raw.select("event_id", timing.hour_round(snapped).alias("snapped"), timing.hour_round(F.col("ts")).alias("exact"))


@check("p14_hour_floor", "SELECT event_id, date_trunc('hour', ts) AS hour_start FROM events")
def _(s, d):
    return I.table(s, d, "events").select("event_id", timing.hour_floor(F.col("ts")).alias("hour_start"))


@check("p15_reach_ids", "SELECT station_id, source, reach_id FROM mapped_reaches")
def _(s, d):
    return mapped(s, d).select("station_id", "source", F.explode(codes.reach_numbers(F.col("opnids"))).alias("reach_id"))


@check("p16_defaults_for", """
    SELECT CAST(c.t AS TIMESTAMP) AS datetime, round(coalesce(total, 0), 3) AS observed
    FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(datetime)) FROM lab_obs WHERE constituent = 'TSS'),
        (SELECT max(datetime) FROM lab_obs WHERE constituent = 'TSS'), INTERVAL 1 MONTH)) AS t) c
    LEFT JOIN (SELECT date_trunc('month', datetime) AS t, sum(value) AS total FROM lab_obs WHERE constituent = 'TSS' GROUP BY 1) v ON c.t = v.t""")
def _(s, d):
    rows = lab_obs(s, d).filter(F.col("constituent") == "TSS")
    done = resample.resample(rows, "MS", ["value"], lookups.defaults_for("TSS", agg="sum")[1])
    return done.select("datetime", F.round("value", 3).alias("observed"))


@check("p17_tag_origin", "SELECT ts_id, 'wiski' AS station_origin FROM sensor")
def _(s, d):
    return sensor.tag_origin(I.sensor(s, d), "wiski").select("ts_id", "station_origin")


# ---- Filters ------------------------------------------------------------------------------------


@check("f1_quality_filter", f"SELECT station_id, datetime, quality_code, value FROM (SELECT station_id, datetime, quality_code, round(value, 6) AS value FROM sensor_norm) WHERE quality_code IN {ACCEPTED}")
def _(s, d):
    return r6(filters.quality_filter(sensor_norm(s, d)), "value").select("station_id", "datetime", "quality_code", "value")


@check("f2_year_filter", f"SELECT {_LAB_NORM} FROM lab_norm WHERE year(datetime) >= 1997 AND year(datetime) <= 1999")
def _(s, d):
    return r6(filters.year_filter(lab_norm(s, d), 1997, 1999), "value")


_EXTRACTED = """
    r.FACILITY_ID IN (1, 33836701) AND r.APPROVAL_CODE = 'Final' AND r.REPORTABLE_RESULT = 'Y'"""


@check("f3_lab_extract_filter", f"""
    SELECT SYS_LOC_CODE, CAS_RN, SAMPLE_ID FROM (SELECT r.*, m.SAMPLE_METHOD FROM lab r JOIN lab_samples m ON r.SAMPLE_ID = m.SAMPLE_ID) r
    WHERE {_EXTRACTED} AND LOC_TYPE = 'River/Stream' AND SAMPLE_METHOD IN ('G-EVT','G','FIELDMSROBS')""")
def _(s, d):
    rows = I.lab_raw(s, d).drop("SAMPLE_METHOD", "SAMPLE_REMARK").join(I.lab_samples(s, d), "SAMPLE_ID")
    return filters.lab_extract_filter(rows).select("SYS_LOC_CODE", "CAS_RN", "SAMPLE_ID")


@check("f4_supported_parameters", "SELECT parameter, datetime, station_id FROM portal WHERE parameter <> 'Color of the water'")
def _(s, d):
    done = filters.supported_parameters(I.portal_raw(s, d), texts(s))
    return portal.portal_time(done).select("parameter", "datetime", "station_id")


@check("f5_after_1996", "SELECT parameter, datetime, station_id FROM portal WHERE datetime > TIMESTAMP '1996-01-01'")
def _(s, d):
    done = I.portal_raw(s, d).transform(portal.portal_time).transform(filters.after_1996)
    return done.select("parameter", "datetime", "station_id")


@check("f6_drop_incomplete_keys", f"SELECT {_LAB_NORM} FROM lab_norm WHERE constituent IS NOT NULL AND datetime IS NOT NULL")
def _(s, d):
    return r6(filters.drop_incomplete_keys(lab_norm(s, d), ["station_id", "constituent", "datetime", "unit"]), "value")


@check("f7_hydrologic_unit_filter", "SELECT c_custkey, CAST(c_custkey + 70000 AS VARCHAR) AS \"stn_HUC12\" FROM customer WHERE CAST(c_custkey + 70000 AS VARCHAR) LIKE '700%'")
def _(s, d):
    stations = I.table(s, d, "customer").select("c_custkey", (F.col("c_custkey") + 70000).cast("string").alias("stn_HUC12"))
    return filters.hydrologic_unit_filter(stations, "700")


_RANK = """
    SELECT *, CASE WHEN constituent NOT IN ('Q','WT','OP','DO') THEN NULL
        WHEN ts_name = CASE WHEN station_id LIKE 'E%' THEN '08.Provisional.Edited' WHEN constituent = 'Q' THEN '15.Rated' ELSE '09.Archive' END THEN 0
        WHEN ts_name = CASE WHEN station_id LIKE 'E%' OR constituent <> 'Q' THEN '20.Day.Mean' ELSE '20.Day.Mean.Archive' END THEN 1 END AS resolution
    FROM sensor_norm"""


@check("f8_preferred_series", f"""
    SELECT station_id AS station_no, constituent, ts_name, datetime FROM
        (SELECT *, min(resolution) OVER (PARTITION BY station_id, constituent) AS best FROM ({_RANK})) WHERE resolution = best""")
def _(s, d):
    rows = sensor.sensor_constituent(I.sensor(s, d))
    done = filters.preferred_series(rows)
    return done.select("station_no", "constituent", "ts_name", F.col("Timestamp").alias("datetime"))


@check("f9_clip_to_coverage", """
    SELECT r.station_id, greatest(r.lo, c.lo) AS start_year, least(r.hi, c.hi) AS end_year FROM
        (SELECT DISTINCT station_id, 1997 + CAST(station_id[2:] AS INTEGER) % 3 AS lo, 2000 AS hi FROM lab_norm) r
        JOIN (SELECT station_id, CAST(year(min(datetime)) AS INTEGER) AS lo, CAST(year(max(datetime)) AS INTEGER) AS hi FROM lab_norm GROUP BY 1) c
        ON r.station_id = c.station_id WHERE greatest(r.lo, c.lo) <= least(r.hi, c.hi)""")
def _(s, d):
    rows = lab_norm(s, d).withColumnRenamed("station_id", "ts_id")
    number = F.substring("ts_id", 2, 9).cast("int")
    requests = rows.select("ts_id").distinct().select("ts_id", (number % 3 + 1997).alias("start_year"), F.lit(2000).alias("end_year"))
    return filters.clip_to_coverage(requests, filters.series_coverage(rows)).withColumnRenamed("ts_id", "station_id")


@check("f10_parameter_scope", """
    SELECT stationparameter_no, 'all' AS scope, count(*) AS n FROM sensor WHERE stationparameter_no IN ('262.1','450.42','863','866') GROUP BY ALL
    UNION ALL
    SELECT stationparameter_no, 'TP load', count(*) FROM sensor WHERE stationparameter_no = '5004' GROUP BY ALL""")
def _(s, d):
    rows = I.sensor(s, d)
    normal = filters.parameter_scope(rows).withColumn("scope", F.lit("all"))
    load = filters.parameter_scope(rows, "TP", load_network=True).withColumn("scope", F.lit("TP load"))
    return normal.unionByName(load).groupBy("stationparameter_no", "scope").agg(F.count("*").alias("n"))


# ---- Joins --------------------------------------------------------------------------------------


@check("j1_lab_extract", f"""
    SELECT p.LATITUDE, p.LONGITUDE, p.WID_LIST, m.SAMPLE_METHOD, m.SAMPLE_REMARK, r.SYS_LOC_CODE, r.CAS_RN, r.SAMPLE_ID, r.RESULT_NUMERIC, r.LOC_TYPE
    FROM lab r LEFT JOIN lab_places p ON r.SYS_LOC_CODE = p.SYS_LOC_CODE AND r.FACILITY_ID = p.FACILITY_ID
    LEFT JOIN lab_samples m ON r.SAMPLE_ID = m.SAMPLE_ID
    WHERE {_EXTRACTED} AND p.LOC_TYPE = 'River/Stream' AND m.SAMPLE_METHOD IN ('G-EVT','G','FIELDMSROBS','LKSURF1M','LKSURF2M','LKSURFOTH')""")
def _(s, d):
    done = lab.lab_extract(I.lab_raw(s, d), I.lab_stations(s, d), I.lab_samples(s, d))
    return done.select("LATITUDE", "LONGITUDE", "WID_LIST", "SAMPLE_METHOD", "SAMPLE_REMARK", "SYS_LOC_CODE", "CAS_RN", "SAMPLE_ID", "RESULT_NUMERIC", "LOC_TYPE")


@check("j2_station_locations", """
    SELECT DISTINCT r.SYS_LOC_CODE, p.LONGITUDE, p.LATITUDE, p.LOC_MAJOR_BASIN, p.NON_PUBLIC_LOCATION_FLAG
    FROM lab r LEFT JOIN lab_places p ON r.SYS_LOC_CODE = p.SYS_LOC_CODE WHERE r.LOC_TYPE = 'River/Stream' AND r.CAS_RN <> 'FLOW'""")
def _(s, d):
    return lab.station_locations(I.lab_raw(s, d), I.lab_stations(s, d))


@check("j3_outlet_join", """
    SELECT os.outlet_id, o.station_id, o.station_origin, o.constituent, o.datetime, round(o.value, 6) AS value
    FROM obs o JOIN outlet_stations os ON o.station_id = os.station_id AND o.station_origin = os.station_origin""")
def _(s, d):
    done = views.outlet_join(obs(s, d), outlet_tables(s, d).stations)
    return r6(done, "value").select("outlet_id", "station_id", "station_origin", "constituent", "datetime", "value")


_FLOW_OBS = "outlet_id, constituent, datetime, round(value, 6) AS value, count, round(flow_value, 6) AS flow_value, round(baseflow_value, 6) AS baseflow_value"


@check("j4_with_flow", f"SELECT {_FLOW_OBS} FROM flow_obs")
def _(s, d):
    return r6(views.with_flow(outlet_obs(s, d)), "value", "flow_value", "baseflow_value")


@check("j5_station_reach_pairs", "SELECT * FROM pairs")
def _(s, d):
    return pairs(s, d)


@check("j6_qc_describe", """SELECT station_no, "Quality Code", label AS "Text", "Timestamp" FROM sensor JOIN quality ON "Quality Code" = quality_code""")
def _(s, d):
    return views.qc_describe(I.sensor(s, d), lookups.quality_codes(s)).select("station_no", "Quality Code", "Text", "Timestamp")


def _alias_sql(key: str, value: str) -> str:
    return f"""SELECT {key} AS station_id, CASE WHEN count(DISTINCT {value}) = 1 THEN min({value}) END AS alias,
        count(DISTINCT {value}) > 1 AS ambiguous FROM xref WHERE {key} IS NOT NULL AND {value} IS NOT NULL GROUP BY 1"""


@check("j7_sensor_to_lab_alias", _alias_sql("WISKI_STATION_NO", "WISKI_EQUIS_ID"))
def _(s, d):
    return crossref.sensor_to_lab_alias(I.xref(s, d))


@check("j7_lab_to_sensor_alias", _alias_sql("WISKI_EQUIS_ID", "WISKI_STATION_NO"))
def _(s, d):
    return crossref.lab_to_sensor_alias(I.xref(s, d))


@check("j8_sensor_to_lab_links", "SELECT DISTINCT WISKI_STATION_NO AS station_id, EQUIS_STATION_ID AS linked_id FROM xref WHERE WISKI_STATION_NO IS NOT NULL AND EQUIS_STATION_ID IS NOT NULL")
def _(s, d):
    return crossref.sensor_to_lab_links(I.xref(s, d))


@check("j8_lab_to_sensor_links", "SELECT DISTINCT EQUIS_STATION_ID AS station_id, WISKI_STATION_NO AS linked_id FROM xref WHERE WISKI_STATION_NO IS NOT NULL AND EQUIS_STATION_ID IS NOT NULL")
def _(s, d):
    return crossref.lab_to_sensor_links(I.xref(s, d))


# Laboratory names "<nation>" and "<nation>!" are twins with one common set of sensor stations.
_TWINS = """SELECT DISTINCT 'H' || (c_custkey % 50) AS linked_id FROM customer WHERE c_nationkey = 7"""


@check("j9_shared_links", _TWINS)
def _(s, d):
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    lines = I.table(s, d, "customer").select(F.concat(F.lit("H"), key % 50).alias("WISKI_STATION_NO"), nation.alias("n"))
    both = lines.withColumn("EQUIS_STATION_ID", F.explode(F.array("n", F.concat("n", F.lit("!")))))
    return crossref.shared_links(both, both.filter("n = '7'").select(F.col("EQUIS_STATION_ID").alias("station_id")))


@check("j10_stations_by_watershed", "SELECT DISTINCT EQUIS_STATION_ID AS station_id FROM xref WHERE WID = 'W5'")
def _(s, d):
    return crossref.stations_by_watershed(I.xref(s, d), "W5", "swd")


@check("j11_xref_stations", "SELECT DISTINCT WISKI_STATION_NO AS station_id, 'sensor' AS side FROM xref UNION ALL SELECT DISTINCT EQUIS_STATION_ID, 'lab' FROM xref")
def _(s, d):
    x = I.xref(s, d)
    sides = [crossref.xref_stations(x, side).withColumn("side", F.lit(side)) for side in ("sensor", "lab")]
    return sides[0].unionByName(sides[1])


@check("j12_flag_load_network", """
    SELECT s.ts_id, s."Timestamp", CAST(CASE WHEN m.station_no IS NULL THEN 0 ELSE 1 END AS BIGINT) AS wplmn_flag
    FROM sensor s LEFT JOIN members m ON s.station_no = m.station_no""")
def _(s, d):
    return crossref.flag_load_network(I.sensor(s, d), I.load_members(s, d)).select("ts_id", "Timestamp", "wplmn_flag")


@check("v1_validate_outlets", """
    SELECT 'outlet_groups' AS table_name, 'primary key' AS rule, CAST(outlet_id AS VARCHAR) AS key, 2 AS n_rows
        FROM (SELECT DISTINCT outlet_id FROM mapped WHERE repo_name = 'ASIA')
    UNION ALL SELECT 'outlet_stations', 'unique', station_id || '|' || station_origin, 2 FROM outlet_stations WHERE repository_name = 'EUROPE'
    UNION ALL SELECT 'outlet_stations', 'foreign key', CAST(outlet_id AS VARCHAR), count(*)
        FROM (SELECT * FROM outlet_stations UNION ALL SELECT * FROM outlet_stations WHERE repository_name = 'EUROPE') WHERE repository_name = 'AFRICA' GROUP BY outlet_id
    UNION ALL SELECT 'outlet_reaches', 'foreign key', CAST(outlet_id AS VARCHAR), count(*) FROM reaches WHERE repository_name = 'AFRICA' GROUP BY outlet_id
    UNION ALL SELECT 'outlet_reaches', 'not null', 'repository_name', count(*) FROM reaches HAVING count(*) > 0""")
def _(s, d):
    t = outlet_tables(s, d)
    name = F.col("repository_name")
    broken = outlets.Outlets(
        t.groups.filter(name != "AFRICA").unionByName(t.groups.filter(name == "ASIA")),
        t.stations.unionByName(t.stations.filter(name == "EUROPE")),
        t.reaches.withColumn("repository_name", F.lit(None).cast("string")),
    )
    return outlets.validate_outlets(broken)


# ---- Aggregations -------------------------------------------------------------------------------


@check("a1_sensor_hourly", "SELECT station_id, datetime, constituent, unit, round(value, 6) AS value FROM sensor_hourly")
def _(s, d):
    rows = filters.quality_filter(sensor_norm(s, d))
    return r6(sensor.hourly_mean(rows), "value")


@check("a2_lab_hourly", f"""
    SELECT {hour_round('datetime')} AS datetime, round(avg(value), 6) AS value, station_id, 'equis' AS station_origin, constituent, unit
    FROM lab_norm WHERE datetime IS NOT NULL AND constituent IS NOT NULL AND unit IS NOT NULL GROUP BY ALL""")
def _(s, d):
    return r6(lab.lab_hourly(lab_norm(s, d)), "value")


_PORTAL_HOURLY = f"""
    SELECT {hour_round('datetime')} AS datetime, variable, unit, station_id, station_name, constituent, 'instantaneous' AS data_format,
        'discrete' AS data_type, 'swd' AS station_origin, round(avg(value), 6) AS value, CAST(NULL AS VARCHAR) AS quality_id
    FROM portal_vals WHERE @WHERE AND constituent IS NOT NULL AND unit IS NOT NULL GROUP BY ALL"""


@check("a3_portal_hourly", _PORTAL_HOURLY.replace("@WHERE", "true"))
def _(s, d):
    return r6(portal.portal_hourly(portal_vals(s, d)), "value")


@check("a4_outlet_observations", "SELECT datetime, outlet_id, constituent, round(value, 6) AS value, count FROM outlet_obs")
def _(s, d):
    return r6(outlet_obs(s, d), "value")


def _summary_sql(keys: str, table: str) -> str:
    return f"""SELECT {keys}, count(*) AS sample_count, round(avg(value), 6) AS average_value, round(min(value), 6) AS min_value,
        round(max(value), 6) AS max_value, CAST(year(min(datetime)) AS INTEGER) AS start_date, CAST(year(max(datetime)) AS INTEGER) AS end_date
        FROM {table} GROUP BY ALL"""


_STATS = ("average_value", "min_value", "max_value")


@check("a5_constituent_summary", _summary_sql("station_id, station_origin, constituent", "obs"))
def _(s, d):
    return r6(views.constituent_summary(obs(s, d)), *_STATS)


@check("a6_outlet_summary", _summary_sql("outlet_id, constituent", "outlet_obs"))
def _(s, d):
    return r6(views.outlet_constituent_summary(outlet_obs(s, d)), *_STATS)


_QC = """SELECT station_no, parametertype_name, "Quality Code", count("Quality Code") AS count, label AS "Text", CAST(NULL AS VARCHAR) AS "Description"
    FROM sensor JOIN quality ON "Quality Code" = quality_code GROUP BY ALL"""


@check("a7_qc_counts", _QC)
def _(s, d):
    return views.qc_counts(I.sensor(s, d), lookups.quality_codes(s))


@check("a8_constituent_counts", """
    SELECT station_id, station_origin, constituent, count(*) AS sample_count, CAST(year(min(datetime)) AS INTEGER) AS start_date,
        CAST(year(max(datetime)) AS INTEGER) AS end_date FROM obs GROUP BY ALL""")
def _(s, d):
    return views.constituent_counts(obs(s, d))


@check("a9_hourly_bucket", "SELECT station_id, constituent, date_trunc('hour', datetime) AS hour_start, unit, round(avg(value), 6) AS value FROM sensor_norm GROUP BY ALL")
def _(s, d):
    return r6(sensor.hourly_bucket(sensor_norm(s, d)), "value")


_BINS = {
    "h": "date_trunc('hour', datetime)",
    "D": "date_trunc('day', datetime)",
    "W": "date_trunc('week', datetime) + INTERVAL 6 DAY",
    "MS": "date_trunc('month', datetime)",
    "ME": "CAST(last_day(datetime) AS TIMESTAMP)",
    "QS": "date_trunc('quarter', datetime)",
    "QE": "CAST(last_day(CAST(date_trunc('quarter', datetime) + INTERVAL 2 MONTH AS DATE)) AS TIMESTAMP)",
    "YS": "date_trunc('year', datetime)",
    "YE": "date_trunc('year', datetime) + INTERVAL 1 YEAR - INTERVAL 1 DAY",
    "3D": "(SELECT date_trunc('day', min(datetime)) FROM lab_tp) + to_days(CAST(floor(date_diff('day', (SELECT date_trunc('day', min(datetime)) FROM lab_tp), date_trunc('day', datetime)) / 3) AS INTEGER) * 3)",
    "6h": "(SELECT date_trunc('day', min(datetime)) FROM lab_tp) + to_hours(CAST(floor(date_diff('hour', (SELECT date_trunc('day', min(datetime)) FROM lab_tp), date_trunc('hour', datetime)) / 6) AS INTEGER) * 6)",
    "2MS": "(SELECT date_trunc('month', min(datetime)) FROM lab_tp) + to_months(CAST(floor(date_diff('month', (SELECT min(datetime) FROM lab_tp), datetime) / 2) AS INTEGER) * 2)",
}


def _resample_check(period: str, label: str) -> None:
    twin = f"SELECT {label} AS datetime, round(avg(value), 6) AS value FROM lab_tp WHERE datetime IS NOT NULL GROUP BY 1 HAVING avg(value) IS NOT NULL"

    def run(s, d):
        rows = lab_obs(s, d).filter(F.col("constituent") == "TP")
        return r6(resample.resample(rows, period, ["value"]).filter("value is not null"), "value")

    QUERIES[f"a10_resample_{period.lower()}"] = run
    ORACLE[f"a10_resample_{period.lower()}"] = twin_sql(twin.replace("lab_tp", "(SELECT * FROM lab_obs WHERE constituent = 'TP')"))


for _period, _label in _BINS.items():
    _resample_check(_period, _label)


@check("a10_resample_sum", """
    SELECT CAST(d AS TIMESTAMP) AS datetime, round(coalesce(total, 0), 3) AS value
    FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(datetime)) FROM sensor_hourly), (SELECT date_trunc('day', max(datetime)) FROM sensor_hourly), INTERVAL 1 DAY)) AS d) c
    LEFT JOIN (SELECT date_trunc('day', datetime) AS t, sum(value) AS total FROM sensor_hourly GROUP BY 1) v ON c.d = v.t""")
def _(s, d):
    done = resample.resample(sensor_hourly(s, d), "D", ["value"], "sum")
    return done.select("datetime", F.round("value", 3).alias("value"))


@check("a11_resample_outlet", """
    SELECT date_trunc('day', datetime) AS datetime, round(avg(value), 6) AS value, round(avg(flow_value), 6) AS flow_value,
        round(avg(baseflow_value), 6) AS baseflow_value FROM flow_obs WHERE constituent = 'WT' GROUP BY 1 HAVING avg(value) IS NOT NULL""")
def _(s, d):
    rows = views.with_flow(outlet_obs(s, d)).filter(F.col("constituent") == "WT")
    done = resample.resample(rows, "D", ["value", "flow_value", "baseflow_value"]).filter("value is not null")
    return r6(done, "value", "flow_value", "baseflow_value")


_AGGREGATES = {
    "mean_month": ("month", "mean", "avg(value)", "date_trunc('month', datetime)"),
    "max_day": ("daily", "max", "max(value)", "date_trunc('day', datetime)"),
    "min_hour": ("hourly", "min", "min(value)", "date_trunc('hour', datetime)"),
    "total_year": ("yearly", "total", "sum(value)", "date_trunc('year', datetime)"),
    "counts_decade": ("decadal", "counts", "count(value)", "date_trunc('decade', datetime)"),
    "perc_90_year": ("year", "perc-90", "quantile_cont(value, 0.9)", "date_trunc('year', datetime)"),
    "average_clock": ("003000", "average", "avg(value)", "time_bucket(INTERVAL 30 MINUTE, datetime, TIMESTAMP '1970-01-01')"),
}


def _aggregate_check(name: str, interval: str, kind: str, measure: str, start: str) -> None:
    def run(s, d):
        done = resample.interval_aggregate(sensor_norm(s, d), interval, kind)
        return r6(done, "value") if kind != "counts" else done

    rounded = measure if kind == "counts" else f"round({measure}, 6)"
    QUERIES[f"a12_{name}"] = run
    ORACLE[f"a12_{name}"] = twin_sql(f"SELECT station_id, constituent, {start} AS datetime, {rounded} AS value FROM sensor_norm GROUP BY 1, 2, 3")


for _name, _args in _AGGREGATES.items():
    _aggregate_check(_name, *_args)


@check("a13_station_ids", "SELECT DISTINCT station_id, station_origin FROM obs")
def _(s, d):
    return views.station_ids(obs(s, d))


@check("a13_station_ids_of_origin", "SELECT DISTINCT station_id FROM obs WHERE station_origin = 'equis'")
def _(s, d):
    return views.station_ids(obs(s, d), "equis")


@check("a14_available_lab", """
    SELECT station_id, constituent, datetime, cas_rn, round(value, 6) AS value, unit FROM lab_norm
    QUALIFY row_number() OVER (PARTITION BY station_id, constituent ORDER BY datetime NULLS FIRST, cas_rn, value NULLS FIRST, unit) = 1""")
def _(s, d):
    return r6(lab.available_pairs(I.lab_raw(s, d)), "value")


@check("a14_available_sensor", """
    SELECT station_no AS station_id, ts_name, ts_id, stationparameter_no FROM sensor
    WHERE ts_name IN ('15.Rated','09.Archive','08.Provisional.Edited') AND stationparameter_no IN ('262.1','450.42','863','866')""")
def _(s, d):
    return sensor.available_series(I.sensor(s, d)).select("station_id", "ts_name", "ts_id", "stationparameter_no")


_RENUMBERED = """(SELECT * REPLACE (CASE WHEN stationparameter_no = '5004' AND "Quality Code" % 2 = 0 THEN '811.3' ELSE stationparameter_no END
    AS stationparameter_no) FROM sensor WHERE ts_name IN ('15.Rated','09.Archive','08.Provisional.Edited'))"""


@check("a14_available_sensor_numbers", f"""
    SELECT 'default' AS asked, station_no AS station_id, ts_name, stationparameter_no FROM {_RENUMBERED} WHERE stationparameter_no IN ('262.1','450.42','863','866')
    UNION ALL SELECT 'TRB', station_no, ts_name, stationparameter_no FROM {_RENUMBERED} WHERE stationparameter_no = '811.3'
    UNION ALL SELECT 'TP', station_no, ts_name, stationparameter_no FROM {_RENUMBERED}""")
def _(s, d):
    number = F.col("stationparameter_no")
    rows = I.sensor(s, d).withColumn("stationparameter_no", F.when((number == "5004") & (F.col("Quality Code") % 2 == 0), "811.3").otherwise(number))
    parts = [
        sensor.available_series(rows, asked).select(F.lit(asked or "default").alias("asked"), "station_id", "ts_name", "stationparameter_no")
        for asked in (None, "TRB", "TP")
    ]
    return views.stack(parts)


@check("a14_available_portal", """
    SELECT station_id, "stationName", unit AS "resultUnit" FROM (SELECT DISTINCT station_id, stationName AS "stationName",
        CASE lower(resultUnit) WHEN 'ug/l' THEN 'mg/l' WHEN 'deg c' THEN 'degF' ELSE lower(resultUnit) END AS unit FROM portal)
    QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY unit NULLS FIRST) = 1""")
def _(s, d):
    rows = I.portal_raw(s, d).select("station_id", "stationName", "resultUnit")
    return portal.portal_stations(rows)


@check("a15_model_names", "SELECT DISTINCT repo_name FROM mapped")
def _(s, d):
    return outlets.model_names(mapped(s, d))


# ---- Ordered work -------------------------------------------------------------------------------


@check("w1_assign_outlets", "SELECT station_id, source, opnids, repo_name, outlet_id FROM mapped")
def _(s, d):
    return mapped(s, d).select("station_id", "source", "opnids", "repo_name", "outlet_id")


@check("w1_first_row", """
    SELECT station_id, source, opnids, repo_name FROM registry
    WHERE trim(opnids) <> '' AND repo_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY station_id, source ORDER BY comments DESC) = 1""")
def _(s, d):
    # Landed in falling order of names, against which the order of contents is wrong.
    folder, parts = I.scratch(s), []
    for name, rows in zip(("sensor", "lab"), I.registry_parts(s, d)):
        rows = rows.drop("row_order")
        write_csv(rows.orderBy(F.desc("comments")), f"{folder}/{name}")
        parts.append(s.read.schema(rows.schema).options(header=True).csv(f"{folder}/{name}"))
    done = outlets.assign_outlets(sources.read_station_registry(*parts))
    return done.select("station_id", "source", "opnids", "repo_name")


@check("w2_baseflow", "SELECT station_id, datetime, 'QB' AS constituent, 'cfs' AS unit, round(b, 6) AS value FROM filtered")
def _(s, d):
    return r6(bf.baseflow(sensor_hourly(s, d), **FIXED_FILTER), "value")


#: A short grid, so that its SQL twin can try every value; the default one has 999.
GRID = (0.01, 0.02, 0.03, 0.05, 0.08)


@check("w2_baseflow_calibrated", "SELECT station_id, datetime, 'QB' AS constituent, 'cfs' AS unit, round(b, 6) AS value FROM calibrated")
def _(s, d):
    return r6(bf.baseflow(sensor_hourly(s, d), grid=GRID), "value")


@check("w2_baseflow_default")
def _(s, d):
    return r6(bf.baseflow(sensor_hourly(s, d)), "value")


@check("w2_baseflow_lh", "SELECT station_id, datetime, 'QB' AS constituent, 'cfs' AS unit, round(b, 6) AS value FROM lh_backward")
def _(s, d):
    return r6(bf.baseflow(sensor_hourly(s, d), method="LH"), "value")


@check("w3_keep_first", """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def _(s, d):
    rows = I.table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return ranking.keep_first(rows, ["o_custkey"], ["o_orderkey"])


# ---- Set operations -----------------------------------------------------------------------------


@check("u1_observations", f"SELECT {_OBS} FROM obs")
def _(s, d):
    return r6(obs(s, d), "value")


@check("u2_stack", """
    SELECT station_id, value, ts_name, CAST(NULL AS VARCHAR) AS cas_rn FROM (SELECT station_id, round(value, 6) AS value, ts_name FROM sensor_norm)
    UNION ALL SELECT station_id, round(value, 6), NULL, cas_rn FROM lab_norm""")
def _(s, d):
    frames = [sensor_norm(s, d).select("station_id", "value", "ts_name"), lab_norm(s, d).select("station_id", "value", "cas_rn")]
    return r6(views.stack(frames), "value")


@check("u3_append_derived", f"SELECT {_OBS} FROM sensor_obs")
def _(s, d):
    hourly = sensor_hourly(s, d)
    derived = bf.baseflow(hourly, origin=lookups.SENSOR_ORIGIN, **FIXED_FILTER)
    return r6(views.append_derived(hourly, derived), "value")


@check("k9_sensor_hourly", "SELECT station_id, constituent, date_trunc('hour', datetime) AS hour_start, unit, round(avg(value), 6) AS value FROM sensor_norm GROUP BY ALL")
def _(s, d):
    _staged(s, d).refresh_views()
    return r6(s.table("analytics_wiski_hourly"), "value")


@check("k9_sensor_filtered", f"SELECT station_id, datetime, quality_code, value FROM (SELECT station_id, datetime, quality_code, round(value, 6) AS value FROM sensor_norm) WHERE quality_code IN {ACCEPTED}")
def _(s, d):
    _staged(s, d).refresh_views()
    return r6(s.table("analytics_wiski_filtered"), "value").select("station_id", "datetime", "quality_code", "value")


# ---- Query API ----------------------------------------------------------------------------------

_IN = ", ".join(f"'{x}'" for x in SENSORS)


@check("q1_observation_data", f"""
    SELECT date_trunc('day', datetime) AS datetime, round(avg(value), 6) AS observed FROM obs
    WHERE station_id IN ({_IN}) AND constituent = 'Q' GROUP BY 1 HAVING avg(value) IS NOT NULL""")
def _(s, d):
    return r6(query.observation_data(obs(s, d), SENSORS, "Q", "D"), "observed")


@check("q1_observation_rows", f"SELECT {_OBS.replace('AS value', 'AS observed')} FROM obs WHERE station_id IN ({_IN}) AND constituent = 'WT' AND value IS NOT NULL")
def _(s, d):
    return r6(query.observation_data(obs(s, d), SENSORS, "WT"), "observed")


@check("q2_outlet_data", """
    SELECT date_trunc('day', datetime) AS datetime, round(avg(value), 6) AS observed, round(avg(flow_value), 6) AS observed_flow,
        round(avg(baseflow_value), 6) AS observed_baseflow FROM flow_obs
    WHERE constituent = 'DO' AND outlet_id = (SELECT min(outlet_id) FROM outlet_stations WHERE station_id = 'E02') GROUP BY 1 HAVING avg(value) IS NOT NULL""")
def _(s, d):
    flow_obs = views.with_flow(outlet_obs(s, d))
    number = mapped(s, d).filter("station_id = 'E02' and source = 'wiski'").agg(F.min("outlet_id")).scalar()
    done = query.outlet_data(flow_obs, number, "DO", "D")
    return r6(done, "observed", "observed_flow", "observed_baseflow")


@check("q2_outlet_data_warehouse", """
    SELECT date_trunc('day', datetime) AS datetime, round(avg(value), 6) AS observed, round(avg(flow_value), 6) AS observed_flow,
        round(avg(baseflow_value), 6) AS observed_baseflow FROM flow_obs
    WHERE constituent = 'DO' AND outlet_id = (SELECT min(outlet_id) FROM outlet_stations WHERE station_id = 'E02') GROUP BY 1 HAVING avg(value) IS NOT NULL""")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8).init()
    w.load_outlets(outlet_tables(s, d))
    w.replace("analytics.wiski", sensor_obs(s, d))
    w.replace("analytics.equis", lab_obs(s, d))
    number = w.read("outlets.outlet_stations").filter("station_id = 'E02'").agg(F.min("outlet_id")).first()[0]
    return r6(w.outlet_data(number, "DO", "D"), "observed", "observed_flow", "observed_baseflow")


@check("q3_station_data", f"SELECT {_OBS} FROM obs WHERE station_id = 'H03' AND station_origin = 'wiski'")
def _(s, d):
    return r6(query.station_data(obs(s, d), "H03", "wiski"), "value")


@check("q4_raw_data", f"SELECT {', '.join(_LAB_SHOWN)} FROM lab WHERE SYS_LOC_CODE = 'S000003'")
def _(s, d):
    return query.raw_data(I.lab_raw(s, d), I.sensor(s, d), "S000003", "equis").select(*_LAB_SHOWN)


@check("q4_raw_data_sensor", f"SELECT {_SENSOR_SQL} FROM sensor WHERE station_no = 'E02'")
def _(s, d):
    return query.raw_data(I.lab_raw(s, d), I.sensor(s, d), "E02", "wiski").select(*_SENSOR_SHOWN)


@check("q5_outlets", f"SELECT * FROM pairs WHERE repository_name = '{MODEL}'")
def _(s, d):
    return query.outlets_of_model(pairs(s, d), MODEL)


@check("q6_station_summary", _summary_sql("station_id, station_origin, constituent", "(SELECT * FROM obs WHERE constituent = 'OP')"))
def _(s, d):
    return r6(query.station_summary(obs(s, d), "OP"), *_STATS)


@check("q7_outlet_summary", _summary_sql("outlet_id, constituent", "outlet_obs"))
def _(s, d):
    return r6(query.outlet_summary(outlet_obs(s, d)), *_STATS)


@check("q7_qc_counts", _QC)
def _(s, d):
    return query.qc_counts(I.sensor(s, d), lookups.quality_codes(s))


@check("q7_station_reach_pairs", "SELECT * FROM pairs")
def _(s, d):
    return query.station_reach_pairs(pairs(s, d))


def _written_order(df, report: str, keys: list[str]):
    """Key columns ``a`` to ``c`` of a written report with each row's position in its files."""
    path = I.scratch(df.sparkSession) + "/report"
    write_parquet(df.select(*[F.col(k).cast("string").alias(n) for k, n in zip(keys, "abc")]), path)
    back = sources.with_row_order(df.sparkSession.read.schema("a string, b string, c string").parquet(path))
    place = F.row_number().over(Window.orderBy("row_order")).cast("bigint")
    return back.select(F.lit(report).alias("report"), place.alias("position"), "a", "b", "c")


@check("o1_report_order", f"""
    SELECT 'counts' AS report, row_number() OVER (ORDER BY n, station_id, station_origin, constituent NULLS FIRST) AS position, station_id AS a, station_origin AS b, constituent AS c
    FROM (SELECT station_id, station_origin, constituent, count(*) AS n FROM obs GROUP BY ALL)
    UNION ALL SELECT 'stations', row_number() OVER (ORDER BY station_id, station_origin, constituent NULLS FIRST), station_id, station_origin, constituent
    FROM (SELECT DISTINCT station_id, station_origin, constituent FROM obs)
    UNION ALL SELECT 'outlets', row_number() OVER (ORDER BY outlet_id, constituent NULLS FIRST), CAST(outlet_id AS VARCHAR), constituent, CAST(sample_count AS VARCHAR)
    FROM (SELECT outlet_id, constituent, count(*) AS sample_count FROM outlet_obs GROUP BY ALL)
    UNION ALL SELECT 'quality', row_number() OVER (ORDER BY station_no, parametertype_name, "Quality Code"), station_no, parametertype_name, CAST("Quality Code" AS VARCHAR)
    FROM (SELECT DISTINCT station_no, parametertype_name, "Quality Code" FROM ({_QC}))
    UNION ALL SELECT 'pairs', row_number() OVER (ORDER BY outlet_id, station_id, station_origin, reach_id, repository_name), CAST(outlet_id AS VARCHAR), station_id, CAST(reach_id AS VARCHAR) FROM pairs
    UNION ALL SELECT 'model', row_number() OVER (ORDER BY outlet_id, station_id, station_origin, reach_id), CAST(outlet_id AS VARCHAR), station_id, CAST(reach_id AS VARCHAR)
    FROM pairs WHERE repository_name = '{MODEL}'""")
def _(s, d):
    o, p, key = obs(s, d), pairs(s, d), ["station_id", "station_origin", "constituent"]
    return views.stack([
        _written_order(views.constituent_counts(o), "counts", key),
        _written_order(query.station_summary(o), "stations", key),
        _written_order(query.outlet_summary(outlet_obs(s, d)), "outlets", ["outlet_id", "constituent", "sample_count"]),
        _written_order(query.qc_counts(I.sensor(s, d), lookups.quality_codes(s)), "quality", ["station_no", "parametertype_name", "Quality Code"]),
        _written_order(query.station_reach_pairs(p), "pairs", ["outlet_id", "station_id", "reach_id"]),
        _written_order(query.outlets_of_model(p, MODEL), "model", ["outlet_id", "station_id", "reach_id"]),
    ])


# ---- Outlet mapping -----------------------------------------------------------------------------


@check("m1_build_outlets", """
    SELECT DISTINCT 'group' AS part, outlet_id, repo_name AS repository_name, CAST(NULL AS VARCHAR) AS member FROM mapped
    UNION ALL SELECT 'station', outlet_id, repository_name, station_origin || '/' || station_id FROM outlet_stations
    UNION ALL SELECT 'reach', outlet_id, repository_name, CAST(reach_id AS VARCHAR) FROM reaches""")
def _(s, d):
    t = outlet_tables(s, d)
    shown = ["outlet_id", "repository_name"]
    return (
        t.groups.select(F.lit("group").alias("part"), *shown, F.lit(None).cast("string").alias("member"))
        .unionByName(t.stations.select(F.lit("station").alias("part"), *shown, F.concat_ws("/", "station_origin", "station_id").alias("member")))
        .unionByName(t.reaches.select(F.lit("reach").alias("part"), *shown, F.col("reach_id").cast("string").alias("member")))
    )


_MAPPED = ["station_id", "source", "opnids", "outlet_id", "comments"]


@check("m2_model_registry", f"SELECT {', '.join(_MAPPED)} FROM mapped WHERE repo_name = '{MODEL}'")
def _(s, d):
    return outlets.model_registry(mapped(s, d), MODEL).select(*_MAPPED)


@check("m3_registered_stations", f"SELECT station_id FROM registry WHERE repo_name = '{MODEL}' AND source = 'equis'")
def _(s, d):
    return outlets.registered_stations(I.registry(s, d), MODEL, "equis")


@check("m4_mapped_stations", f"SELECT station_id FROM mapped WHERE repo_name = '{MODEL}' AND source = 'equis'")
def _(s, d):
    return outlets.mapped_stations(mapped(s, d), MODEL, "equis")


_NETWORK = "(SELECT min(repo_name) FROM mapped WHERE wplmn_flag = 1 AND source = 'wiski')"


def _network_model(s, d):
    return mapped(s, d).filter("wplmn_flag = 1 and source = 'wiski'").agg(F.min("repo_name")).scalar()


@check("m5_load_network_stations", f"SELECT station_id FROM mapped WHERE wplmn_flag = 1 AND source = 'wiski' AND repo_name = {_NETWORK}")
def _(s, d):
    return outlets.load_network_stations(mapped(s, d), _network_model(s, d))


@check("m6_scope_reaches", f"""
    SELECT 'load' AS scope, reach_id FROM mapped_reaches WHERE wplmn_flag = 1 AND source = 'wiski' AND repo_name = {_NETWORK}
    UNION ALL SELECT 'sensor', reach_id FROM mapped_reaches WHERE source = 'wiski' AND repo_name = {_NETWORK}
    UNION ALL SELECT 'lab', reach_id FROM mapped_reaches WHERE source = 'equis' AND repo_name = {_NETWORK}
    UNION ALL SELECT 'station', reach_id FROM mapped_reaches WHERE source = 'wiski' AND station_id = 'E04'""")
def _(s, d):
    m, model = mapped(s, d), _network_model(s, d)
    parts = [outlets.scope_reaches(m, x, model).select(F.lit(x).alias("scope"), "reach_id") for x in ("load", "sensor", "lab")]
    parts.append(outlets.scope_reaches(m, "station", station=("E04", "wiski")).select(F.lit("station").alias("scope"), "reach_id"))
    return views.stack(parts)


@check("m6_model_reaches", f"SELECT DISTINCT reach_id FROM mapped_reaches WHERE repo_name = '{MODEL}'")
def _(s, d):
    return outlets.model_reaches(mapped(s, d), MODEL)


@check("m7_outlet_members", f"SELECT outlet_id, opnids, station_id, source FROM mapped WHERE repo_name = '{MODEL}'")
def _(s, d):
    return outlets.outlet_members(mapped(s, d), MODEL)


@check("m8_pairs_by_reach", f"SELECT * FROM pairs WHERE repository_name = '{MODEL}' AND reach_id = 12")
def _(s, d):
    return outlets.pairs_by_reach(pairs(s, d), 12, MODEL)


@check("m9_pairs_by_station", "SELECT * FROM pairs WHERE station_id = 'E02' AND station_origin = 'wiski'")
def _(s, d):
    members = I.registry(s, d).filter("source = 'wiski'")
    return outlets.pairs_by_station(pairs(s, d), "E02", "wiski", members)


@check("m10_reaches", """
    SELECT 'station' AS kind, reach_id FROM pairs WHERE station_id = 'E02' AND station_origin = 'wiski'
    UNION ALL SELECT DISTINCT 'outlet', reach_id FROM pairs WHERE outlet_id = 3""")
def _(s, d):
    p = pairs(s, d)
    station = outlets.station_reaches(p, "E02", "wiski").select(F.lit("station").alias("kind"), "reach_id")
    return station.unionByName(outlets.outlet_reaches(p, 3).select(F.lit("outlet").alias("kind"), "reach_id"))


@check("m11_outlet_stations", "SELECT DISTINCT station_id, station_origin FROM pairs WHERE outlet_id = 3")
def _(s, d):
    return outlets.outlet_stations(pairs(s, d), 3)


# ---- Compositions -------------------------------------------------------------------------------


@check("x1_sensor_transform", f"SELECT {_OBS} FROM sensor_obs")
def _(s, d):
    return r6(sensor_obs(s, d), "value")


@check("x2_lab_transform", f"SELECT {_OBS} FROM lab_obs")
def _(s, d):
    return r6(lab_obs(s, d), "value")


@check("x3_portal_transform", _PORTAL_HOURLY.replace("@WHERE", "datetime > TIMESTAMP '1996-01-01'"))
def _(s, d):
    return r6(pipelines.portal_transform(I.portal_raw(s, d), texts(s)), "value")


@check("x4_gauge_transform", _GAUGE.replace("value,", "round(CASE variable WHEN 'Water Temp. (C)' THEN value * 9 / 5 + 32 ELSE value END, 6) AS value,").replace("THEN 'C'", "THEN 'degf'").replace("THEN 'mg/L'", "THEN 'mg/l'"))
def _(s, d):
    return r6(portal.standardize_units(pipelines.gauge_transform(I.gauge_raw(s, d))), "value")


def _staged(s, d) -> Warehouse:
    w = Warehouse(s, I.scratch(s), buckets=8).init()
    w.append("staging.wiski", I.sensor_text(s, d))
    w.append("staging.equis", I.lab_staging(s, d))
    return w


@check("x5_process_all", f"SELECT {_OBS} FROM obs")
def _(s, d):
    w = _staged(s, d)
    w.process_all(**FIXED_FILTER)
    return r6(w.observations(), "value")


@check("x6_load_batches", f"SELECT {_OBS} FROM obs")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8).init()
    for _again in range(2):
        w.load_sensor(I.sensor_text(s, d), SENSORS, **FIXED_FILTER)
    w.load_lab(I.lab_staging(s, d), [], overwrite=False)
    return r6(w.observations(), "value")


@check("x6_failed_load", f"""
    SELECT 'analytics' AS part, station_id, datetime, round(value, 6) AS value FROM sensor_obs
    UNION ALL SELECT 'staging', station_no, "Timestamp", round("Value", 6) FROM sensor""")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8).init()
    w.load_sensor(I.sensor_text(s, d), SENSORS, **FIXED_FILTER)
    # Half of the rows again; staging is written, then analytics fail.
    raw = I.sensor_text(s, d).filter(F.col("Quality Code") % 2 == 0)
    broken = w.read("analytics.wiski").withColumn("value", F.when(F.col("station_id") == SENSORS[0], F.raise_error(F.lit("lost on the way")).cast("double")))
    for overwrite in (True, False):
        try:
            w._load("wiski", raw, broken, SENSORS, overwrite)
        except Exception as error:
            if "lost on the way" not in str(error):
                raise
    kept = w.read("analytics.wiski").select(F.lit("analytics").alias("part"), "station_id", "datetime", "value")
    staged = sources.type_sensor(w.read("staging.wiski"))
    return r6(kept.unionByName(staged.select(F.lit("staging").alias("part"), F.col("station_no").alias("station_id"), F.col("Timestamp").alias("datetime"), F.col("Value").alias("value"))), "value")


@check("x7_init_warehouse", "SELECT * FROM pairs")
def _(s, d):
    w = Warehouse(s, I.scratch(s), buckets=8)
    # Landed in the order of the suppliers' names, so the first row of a station is the smallest name's.
    parts = []
    for name, rows in zip(("sensor", "lab"), I.registry_parts(s, d)):
        rows = rows.drop("row_order")
        write_csv(rows.orderBy("comments"), f"{w.root}/landed/{name}")
        parts.append(s.read.schema(rows.schema).options(header=True).csv(f"{w.root}/landed/{name}"))
    w.init(sources.read_station_registry(*parts))
    w.validate()
    return w.pairs()


@check("x8_load_network_pull", """
    SELECT s.ts_id, s."Timestamp", s."Value" FROM sensor s JOIN members m ON s.station_no = m.station_no
    WHERE stationparameter_no IN ('5004','262') AND ts_name = '20.Day.Mean'""")
def _(s, d):
    return pipelines.load_network_pull(I.sensor(s, d), I.load_members(s, d)).select("ts_id", "Timestamp", "Value")
