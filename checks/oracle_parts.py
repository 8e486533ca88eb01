"""SQL twins of the inputs and shared intermediate results, as named parts of a WITH clause."""

from __future__ import annotations

import re

LAB_CODES = (
    "'479-61-8','CHLA-CORR','BOD','NO2NO3','14797-55-8','14797-65-0','14265-44-2','N-KJEL',"
    "'PHOSPHATE-P','7723-14-0','SOLIDS-TSS','TEMP-W','7664-41-7','FLOW'"
)
ACCEPTED = "(1,3,10,12,15,20,29,30,31,32,34,45,46,47,48,49)"


def sensor_station(s: str) -> str:
    return f"(CASE WHEN ({s}) % 2 = 0 THEN 'E' ELSE 'H' END || '0' || CAST({s} AS VARCHAR))"


def lab_station(k: str) -> str:
    return f"('S' || lpad(CAST({k} AS VARCHAR), 6, '0'))"


def facility(k: str) -> str:
    return f"CAST(CASE {k} % 3 WHEN 0 THEN 1 WHEN 1 THEN 33836701 ELSE 7 END AS BIGINT)"


def hour_round(t: str) -> str:
    return (
        f"(date_trunc('hour', {t}) + CASE WHEN {t} > date_trunc('hour', {t}) + INTERVAL 30 MINUTE "
        f"OR ({t} = date_trunc('hour', {t}) + INTERVAL 30 MINUTE AND hour({t}) % 2 = 1) "
        f"THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END)"
    )


NUMBER = "CASE event_type WHEN 'view' THEN '262.1' WHEN 'click' THEN '450.42' WHEN 'signup' THEN '863' WHEN 'error' THEN '866' WHEN 'purchase' THEN '5004' END"
SERIES = """CASE WHEN event_type = 'signup' AND k % 2 = 0 THEN '20.Day.Mean'
    WHEN event_type = 'signup' THEN '20.Day.Mean.Archive'
    WHEN k % 4 = 0 THEN CASE WHEN s % 2 = 0 THEN '08.Provisional.Edited' WHEN event_type = 'view' THEN '15.Rated' ELSE '09.Archive' END
    WHEN k % 4 = 1 THEN '20.Day.Mean' WHEN k % 4 = 2 THEN '20.Day.Mean.Archive' ELSE '08.Provisional.Edited' END"""

ACTIVE = (
    "(0,'Unchecked'),(3,'Instantaneous'),(5,'Excellent'),(8,'Reliable Interpolation'),(10,'Good'),(15,'Fair'),"
    "(20,'Poor'),(27,'Questionable'),(28,'Unknown data quality'),(29,'Modeled'),(34,'Estimated'),(35,'Unreliable'),"
    "(36,'Threshold Exceedance'),(40,'Default import code'),(45,'Approved Ext Data'),(48,'Unknown Ext Data'),"
    "(49,'Estimated Ext Data'),(50,'Provisional Ext Data'),(80,'Ice - Estimated'),(199,'199-Logger Unknown'),"
    "(200,'200'),(228,'Info Parameter'),(255,'---')"
)

PARTS = {
    "ev": """
        SELECT event_type, user_id, event_id, value, user_id % 5 AS s,
            CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
            date_trunc('hour', ts) + to_minutes(CAST(floor(minute(ts) / 15) AS INTEGER) * 15) AS ts15
        FROM events""",
    "sensor": f"""
        SELECT ts15 AS "Timestamp", CASE WHEN k % 25 <> 7 THEN value END AS "Value",
            CAST(k AS BIGINT) AS "Quality Code", 'code ' || k AS "Quality Code Name",
            CASE event_type WHEN 'view' THEN 'ft³/s' WHEN 'click' THEN '°C' WHEN 'signup' THEN 'mg/L'
                WHEN 'error' THEN 'mg/l' WHEN 'purchase' THEN 'kg' END AS ts_unitsymbol,
            {SERIES} AS ts_name, {sensor_station('s')} || '/' || {NUMBER} || '/' || ({SERIES}) AS ts_id,
            {sensor_station('s')} AS station_no, 'Station ' || s AS station_name,
            CASE event_type WHEN 'view' THEN '11500' WHEN 'click' THEN '11504' WHEN 'signup' THEN '11528'
                WHEN 'error' THEN '11533' WHEN 'purchase' THEN '99999' END AS parametertype_id,
            event_type AS parametertype_name, {NUMBER} AS stationparameter_no
        FROM ev""",
    "sensor_norm": """
        SELECT "Timestamp" AS datetime, "Quality Code" AS quality_code, station_no AS station_id, ts_name, ts_id,
            CASE lower(ts_unitsymbol) WHEN '°c' THEN "Value" * 9 / 5 + 32 WHEN 'kg' THEN "Value" * 2.20462 ELSE "Value" END AS value,
            CASE lower(ts_unitsymbol) WHEN '°c' THEN 'degf' WHEN 'kg' THEN 'lb' WHEN 'ft³/s' THEN 'cfs' ELSE lower(ts_unitsymbol) END AS unit,
            CASE WHEN stationparameter_no LIKE '262%' THEN 'Q' WHEN stationparameter_no LIKE '450%' THEN 'WT'
                WHEN stationparameter_no LIKE '451%' THEN 'WT' WHEN stationparameter_no LIKE '863%' THEN 'OP'
                WHEN stationparameter_no LIKE '866%' THEN 'DO' WHEN stationparameter_no LIKE '811%' THEN 'TRB'
                ELSE stationparameter_no END AS constituent,
            stationparameter_no, parametertype_id
        FROM sensor""",
    "sensor_hourly": f"""
        SELECT * FROM (
            SELECT station_id, {hour_round('datetime')} AS datetime, constituent, unit, avg(value) AS value
            FROM sensor_norm
            WHERE quality_code IN {ACCEPTED} AND station_id IS NOT NULL AND datetime IS NOT NULL
                AND constituent IS NOT NULL AND unit IS NOT NULL
            GROUP BY ALL)
        WHERE year(datetime) >= 1996""",
    "flow_years": """
        SELECT station_id, datetime, unit, abs(value) AS q, count(*) OVER (PARTITION BY station_id, year(datetime)) AS held
        FROM sensor_hourly WHERE constituent = 'Q' AND value IS NOT NULL""",
    "flow": """
        SELECT station_id, datetime, q, row_number() OVER (PARTITION BY station_id ORDER BY datetime, unit) AS n
        FROM flow_years WHERE held >= 1""",
    "filtered": """
        SELECT station_id, n, datetime, q AS b FROM flow WHERE n = 1
        UNION ALL
        SELECT f.station_id, f.n, f.datetime, least(0.95 / 1.02 * p.b + 0.02 / 1.02 * f.q, f.q)
        FROM filtered p JOIN flow f ON f.station_id = p.station_id AND f.n = p.n + 1""",
    "lh_forward": """
        SELECT station_id, n, datetime, q AS b, q FROM flow WHERE n = 1
        UNION ALL
        SELECT f.station_id, f.n, f.datetime, least(0.925 * p.b + (1 - 0.925) / 2 * (f.q + p.q), f.q), f.q
        FROM lh_forward p JOIN flow f ON f.station_id = p.station_id AND f.n = p.n + 1""",
    "lh_ends": "SELECT station_id, max(n) AS n FROM flow GROUP BY 1",
    "lh_backward": """
        SELECT l.station_id, l.n, l.datetime, l.b, l.b AS q FROM lh_forward l JOIN lh_ends e ON l.station_id = e.station_id AND l.n = e.n
        UNION ALL
        SELECT f.station_id, f.n, f.datetime, least(0.925 * p.b + (1 - 0.925) / 2 * (f.b + p.q), f.b), f.b
        FROM lh_backward p JOIN lh_forward f ON f.station_id = p.station_id AND f.n = p.n - 1""",
    "neighbours": """
        SELECT station_id, q, lag(q) OVER series AS before, lead(q) OVER series AS after
        FROM flow WINDOW series AS (PARTITION BY station_id ORDER BY n)""",
    "recession": """
        SELECT station_id, coalesce(exp(-quantile_cont((before - after) / 2 / q, 0.05) FILTER (WHERE before > q AND q > after)), 0.95) AS a
        FROM neighbours GROUP BY 1""",
    "grid": "SELECT unnest([0.01, 0.02, 0.03, 0.05, 0.08]::DOUBLE[]) AS c",
    "tried": """
        SELECT f.station_id, g.c, f.n, f.q AS b FROM flow f CROSS JOIN grid g WHERE f.n = 1
        UNION ALL
        SELECT f.station_id, p.c, f.n, least(r.a / (1 + p.c) * p.b + p.c / (1 + p.c) * f.q, f.q)
        FROM tried p JOIN flow f ON f.station_id = p.station_id AND f.n = p.n + 1 JOIN recession r ON r.station_id = f.station_id""",
    "tried_all": "SELECT * FROM tried",
    "misfit": """
        SELECT t.station_id, t.c, sum((ln(1 + t.b) - ln(1 + l.b)) ** 2) AS loss
        FROM tried_all t JOIN lh_backward l ON l.station_id = t.station_id AND l.n = t.n GROUP BY 1, 2""",
    "calibrated": """
        SELECT t.station_id, f.datetime, t.b
        FROM (SELECT station_id, c FROM misfit QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY loss, c) = 1) m
        JOIN tried_all t ON t.station_id = m.station_id AND t.c = m.c JOIN flow f ON f.station_id = t.station_id AND f.n = t.n""",
    "sensor_obs": """
        SELECT datetime, value, station_id, 'wiski' AS station_origin, constituent, unit FROM sensor_hourly
        UNION ALL
        SELECT datetime, b, station_id, 'wiski', 'QB', 'cfs' FROM filtered""",
    "lab": f"""
        SELECT {lab_station('l_suppkey')} AS SYS_LOC_CODE, list_value({LAB_CODES})[l_partkey % 14 + 1] AS CAS_RN,
            l_shipdate + to_minutes(CAST(l_orderkey % 96 * 15 AS INTEGER)) AS SAMPLE_DATE_TIME,
            CASE l_linenumber WHEN 1 THEN 'CST' WHEN 2 THEN ' cdt ' WHEN 3 THEN 'UTC' WHEN 4 THEN 'EST'
                WHEN 5 THEN 'EDT' WHEN 6 THEN 'XYZ' END AS SAMPLE_DATE_TIMEZONE,
            CASE WHEN l_discount <> 0 THEN l_quantity END AS RESULT_NUMERIC,
            CASE WHEN list_value({LAB_CODES})[l_partkey % 14 + 1] = 'TEMP-W'
                THEN CASE l_returnflag WHEN 'A' THEN 'deg C' WHEN 'N' THEN 'DegC' ELSE 'degF' END
                ELSE CASE l_returnflag WHEN 'A' THEN 'ug/L' WHEN 'N' THEN 'mg/L' ELSE 'mg/g' END END AS RESULT_UNIT,
            CASE l_linestatus WHEN 'O' THEN 'Final' ELSE 'Draft' END AS APPROVAL_CODE,
            CASE WHEN l_tax = 0 THEN 'N' ELSE 'Y' END AS REPORTABLE_RESULT,
            {facility('l_partkey')} AS FACILITY_ID, l_orderkey AS SAMPLE_ID,
            CASE WHEN l_suppkey % 4 = 1 THEN 'Lake' ELSE 'River/Stream' END AS LOC_TYPE
        FROM lineitem""",
    "lab_norm": """
        SELECT SYS_LOC_CODE AS station_id, CAS_RN AS cas_rn,
            CASE CAS_RN WHEN '479-61-8' THEN 'CHLA' WHEN 'CHLA-CORR' THEN 'CHLA' WHEN 'BOD' THEN 'BOD' WHEN 'NO2NO3' THEN 'N'
                WHEN '14797-55-8' THEN 'NO3' WHEN '14797-65-0' THEN 'NO2' WHEN '14265-44-2' THEN 'OP' WHEN 'N-KJEL' THEN 'TKN'
                WHEN 'PHOSPHATE-P' THEN 'TP' WHEN '7723-14-0' THEN 'TP' WHEN 'SOLIDS-TSS' THEN 'TSS' WHEN 'TEMP-W' THEN 'WT'
                WHEN '7664-41-7' THEN 'NH3' END AS constituent,
            SAMPLE_DATE_TIME - to_hours(CASE upper(trim(SAMPLE_DATE_TIMEZONE)) WHEN 'CST' THEN -6 WHEN 'CDT' THEN -5
                WHEN 'UTC' THEN 0 WHEN 'EST' THEN -5 WHEN 'EDT' THEN -4 END + 6) AS datetime,
            CASE lower(RESULT_UNIT) WHEN 'ug/l' THEN RESULT_NUMERIC / 1000 WHEN 'mg/g' THEN RESULT_NUMERIC * 1000
                WHEN 'deg c' THEN RESULT_NUMERIC * 9 / 5 + 32 WHEN 'degc' THEN RESULT_NUMERIC * 9 / 5 + 32
                ELSE RESULT_NUMERIC END AS value,
            CASE lower(RESULT_UNIT) WHEN 'ug/l' THEN 'mg/l' WHEN 'mg/g' THEN 'mg/l' WHEN 'deg c' THEN 'degf'
                WHEN 'degc' THEN 'degf' ELSE lower(RESULT_UNIT) END AS unit
        FROM lab""",
    "lab_obs": f"""
        SELECT {hour_round('datetime')} AS datetime, avg(coalesce(value, 0)) AS value, station_id,
            'equis' AS station_origin, constituent, unit
        FROM lab_norm
        WHERE datetime >= TIMESTAMP '1996-01-01' AND station_id IS NOT NULL AND constituent IS NOT NULL AND unit IS NOT NULL
        GROUP BY ALL""",
    "obs": "SELECT * FROM lab_obs UNION ALL SELECT * FROM sensor_obs",
    "lab_places": f"""
        SELECT {lab_station('s_suppkey')} AS SYS_LOC_CODE, {facility('s_suppkey')} AS FACILITY_ID,
            CAST(s_nationkey + 40.5 AS DOUBLE) AS LATITUDE, CAST(s_nationkey - 100.25 AS DOUBLE) AS LONGITUDE,
            'W' || s_nationkey AS WID_LIST, CASE WHEN s_nationkey % 4 = 0 THEN 'Lake' ELSE 'River/Stream' END AS LOC_TYPE,
            'Basin ' || (s_nationkey % 5) AS LOC_MAJOR_BASIN, CASE WHEN s_acctbal < 0 THEN 'Y' ELSE 'N' END AS NON_PUBLIC_LOCATION_FLAG
        FROM supplier""",
    "lab_samples": """
        SELECT o_orderkey AS SAMPLE_ID, CASE o_orderpriority[1] WHEN '1' THEN 'G-EVT' WHEN '2' THEN 'G'
            WHEN '3' THEN 'FIELDMSROBS' ELSE 'PUMP' END AS SAMPLE_METHOD, o_orderstatus AS SAMPLE_REMARK
        FROM orders""",
    "portal": """
        SELECT list_value('Phosphorus as P','Orthophosphate as P','Total suspended solids','Temperature, water','Nitrate as N',
                'Color of the water')[o_custkey % 6 + 1] AS parameter,
            date_trunc('day', o_orderdate) + to_minutes(CAST(o_orderkey % 96 * 15 AS INTEGER)) AS datetime,
            CASE WHEN o_orderkey % 20 = 3 THEN '(null)' WHEN o_orderkey % 20 = 7 THEN 'n/a'
                WHEN o_orderkey % 20 <> 9 THEN CAST(o_totalprice AS VARCHAR) END AS result,
            CASE WHEN o_orderkey % 50 = 1 THEN NULL WHEN o_custkey % 6 = 3 THEN 'deg C' WHEN o_orderkey % 2 = 1 THEN 'UG/L' ELSE 'mg/L' END AS resultUnit,
            'Site ' || (o_custkey % 100) AS stationName, 'P' || (o_custkey % 100) AS station_id
        FROM orders""",
    "portal_vals": """
        SELECT datetime, parameter AS variable, station_id, stationName AS station_name,
            CASE WHEN lower(resultUnit) = 'ug/l' THEN TRY_CAST(result AS DOUBLE) * 0.001
                WHEN lower(resultUnit) = 'deg c' THEN TRY_CAST(result AS DOUBLE) * 9 / 5 + 32
                ELSE TRY_CAST(result AS DOUBLE) END AS value,
            CASE lower(resultUnit) WHEN 'ug/l' THEN 'mg/l' WHEN 'deg c' THEN 'degF' ELSE lower(resultUnit) END AS unit,
            CASE parameter WHEN 'Phosphorus as P' THEN 'TP' WHEN 'Orthophosphate as P' THEN 'TP' WHEN 'Total suspended solids' THEN 'TSS'
                WHEN 'Temperature, water' THEN 'WT' WHEN 'Nitrate as N' THEN 'NO3' END AS constituent
        FROM portal WHERE (result IS NULL OR result <> '(null)')""",
    "gauge": """
        SELECT ts15 AS datetime, CASE event_type WHEN 'view' THEN 'Discharge (cfs)' WHEN 'click' THEN 'Water Temp. (C)'
                WHEN 'signup' THEN 'DO (mg/L)' ELSE 'Stage (ft)' END AS variable,
            CASE WHEN k % 10 <> 0 THEN value END AS value, 'G' || (user_id % 7) AS station_id
        FROM ev""",
    "places": """
        SELECT s_suppkey, s_nationkey AS true_opnid,
            CASE s_suppkey % 6 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN s_nationkey || '.0'
                WHEN 3 THEN s_nationkey || '.0, ' || (s_nationkey + 1) ELSE s_nationkey || ',' || (s_nationkey + 5) END AS opnids,
            s_name AS comments, CASE WHEN s_suppkey % 2 = 0 THEN 'yes' END AS modeled,
            CASE WHEN s_nationkey <> 24 THEN r_name END AS repo_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "registry": f"""
        SELECT {sensor_station('s_suppkey % 5')} AS station_id, true_opnid, opnids, comments, modeled, repo_name,
            CAST(s_suppkey % 2 AS INTEGER) AS wplmn_flag, 'wiski' AS source FROM places
        UNION ALL
        SELECT {lab_station('s_suppkey')}, true_opnid, opnids, comments, modeled, repo_name, 0, 'equis' FROM places""",
    "kept": """
        SELECT station_id, true_opnid, trim(opnids) AS opnids, comments, modeled, repo_name, wplmn_flag, source
        FROM registry WHERE trim(opnids) <> '' AND repo_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY station_id, source ORDER BY comments) = 1""",
    "mapped": "SELECT *, CAST(dense_rank() OVER (ORDER BY opnids, repo_name) - 1 AS INTEGER) AS outlet_id FROM kept",
    "mapped_reaches": "SELECT *, CAST(CAST(trim(unnest(string_split(opnids, ','))) AS DOUBLE) AS INTEGER) AS reach_id FROM mapped",
    "reaches": "SELECT DISTINCT outlet_id, reach_id, repo_name AS repository_name FROM mapped_reaches",
    "outlet_stations": "SELECT outlet_id, station_id, source AS station_origin, repo_name AS repository_name, true_opnid, comments FROM mapped",
    "pairs": """
        SELECT s.outlet_id, s.station_id, s.station_origin, r.reach_id, r.repository_name
        FROM outlet_stations s JOIN reaches r ON s.outlet_id = r.outlet_id""",
    "outlet_obs": """
        SELECT o.datetime, os.outlet_id, o.constituent, avg(o.value) AS value, count(o.value) AS count
        FROM obs o JOIN outlet_stations os ON o.station_id = os.station_id AND o.station_origin = os.station_origin
        GROUP BY os.outlet_id, o.constituent, o.datetime""",
    "flow_obs": """
        SELECT c.outlet_id, c.constituent, c.datetime, c.value, c.count, f.value AS flow_value, b.value AS baseflow_value
        FROM (SELECT * FROM outlet_obs WHERE constituent NOT IN ('Q', 'QB')) c
        LEFT JOIN (SELECT * FROM outlet_obs WHERE constituent = 'Q') f ON c.outlet_id = f.outlet_id AND c.datetime = f.datetime
        LEFT JOIN (SELECT * FROM outlet_obs WHERE constituent = 'QB') b ON c.outlet_id = b.outlet_id AND c.datetime = b.datetime""",
    "quality": f"SELECT quality_code, label FROM (VALUES {ACTIVE}) AS v(quality_code, label)",
    "xref": """
        SELECT CASE WHEN c_custkey % 11 <> 0 THEN 'H' || (c_custkey // 3) END AS WISKI_STATION_NO,
            CASE WHEN c_custkey % 13 <> 0 THEN 'S' || c_nationkey || '-' || (c_custkey % 40) END AS EQUIS_STATION_ID,
            CASE WHEN c_custkey % 3 = 0 THEN 'S' || c_nationkey || '-' || (c_custkey % 40)
                WHEN c_custkey % 30 = 1 THEN 'S' || c_nationkey || '-' || (c_custkey % 40) || 'x' END AS WISKI_EQUIS_ID,
            'W' || c_nationkey AS WID
        FROM customer""",
    "members": f"SELECT DISTINCT {sensor_station('s_suppkey % 4')} AS station_no FROM supplier WHERE s_nationkey % 2 = 1",
}


RECURSIVE = ("filtered", "lh_forward", "lh_backward", "tried")


def sql(body: str) -> str:
    """The body with the parts it needs, in order."""
    needed: set[str] = set()
    waiting = [body]
    while waiting:
        text = waiting.pop()
        for name in PARTS:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                waiting.append(PARTS[name])
    parts = [f"{name} AS MATERIALIZED ({text})" if name not in RECURSIVE else f"{name} AS ({text})"
             for name, text in PARTS.items() if name in needed]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body
