import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarnflow import lookups, schemas, sources
from tarnflow.operators import views
from tarnflow.plans import query
from tarnflow.plans.warehouse import Warehouse, write_csv, write_parquet

T0 = datetime(2020, 6, 1)


def observation(spark, rows):
    return spark.createDataFrame(rows, schemas.OBSERVATION)


def sensor_batch(spark, stations, hours=48, factor=1.0):
    """Flow and temperature rows in staging columns."""
    rows = []
    for n, s in enumerate(stations):
        for h in range(hours):
            stamp = (T0 + timedelta(hours=h)).isoformat() + ".000-06:00"
            for unit, number, kind, value in (("ft³/s", "262.1", "Discharge", (50 + h % 7 + n) * factor), ("°C", "450.42", "Temp", 10.0 + h % 5)):
                rows.append((stamp, float(value), 1 if h % 10 else 3, "x", unit, "15.Rated", s, s, s, "0", "0", "11500", kind, number, kind, 0))
    return spark.createDataFrame(rows, schemas.SENSOR)


def lab_batch(spark, stations):
    data = [{"SYS_LOC_CODE": s, "CAS_RN": "7723-14-0", "SAMPLE_DATE_TIME": T0 + timedelta(hours=h), "SAMPLE_DATE_TIMEZONE": "CST",
             "RESULT_NUMERIC": 0.1 * (h + 1), "RESULT_UNIT": "mg/l"} for s in stations for h in range(5)]
    return spark.createDataFrame(data, schemas.LAB)


@pytest.fixture
def warehouse(spark, tmp_path):
    registry = spark.createDataFrame([
        ("H1", 1, "1,2", None, None, "Clearwater", 1, "wiski"), ("S1", 1, "1,2", None, None, "Clearwater", 0, "equis"),
        ("H2", 3, "3", None, None, "Buffalo", 0, "wiski"),
    ], schemas.REGISTRY)
    return Warehouse(spark, str(tmp_path / "w"), buckets=4).init(registry)


def test_loads_questions_and_replacement(spark, warehouse, tmp_path, rows):
    w = warehouse
    options = {"a": 0.95, "c": 0.02, "min_per_year": 1}
    w.load_sensor(sensor_batch(spark, ["H1", "H2"]), ["H1", "H2"], **options)
    w.load_lab(lab_batch(spark, ["S1"]), ["S1"])
    assert rows(w.station_ids()) == [("H1", "wiski"), ("H2", "wiski"), ("S1", "equis")]
    assert rows(w.station_ids("equis")) == [("S1",)]
    assert w.observations().count() == 2 * 48 * 3 + 5

    daily = w.observation_data(["H1"], "Q", "D").orderBy("datetime").collect()
    assert [r["datetime"] for r in daily] == [T0, T0 + timedelta(days=1)]
    raw = w.observation_data(["H1", "H2"], "WT")
    assert raw.count() == 96 and "observed" in raw.columns and "unit" in raw.columns

    outlet = w.read("outlets.outlet_stations").filter("station_id = 'S1'").first()["outlet_id"]
    hourly = w.outlet_data(outlet, "TP", None).orderBy("datetime").collect()
    assert len(hourly) == 5 and all(r["observed_flow"] is not None and r["observed_baseflow"] is not None for r in hourly)
    assert w.outlet_data(outlet, "TP").count() == 1
    assert w.outlet_data(outlet, "Q").count() == 0

    # A second load of one station replaces it in staging and analytics and leaves the other alone.
    before = rows(w.station_data("H2", "wiski"))
    w.load_sensor(sensor_batch(spark, ["H1"], hours=10, factor=2.0), ["H1"], **options)
    assert w.raw_data("H1", "WISKI").count() == 20 and w.raw_data("H2", "wiski").count() == 96
    assert w.station_data("H1", "wiski").count() == 30 and rows(w.station_data("H2", "wiski")) == before

    # Reprocessing staging gives the same observations as the loads.
    loaded = rows(w.observations().withColumn("value", F.round("value", 9)))
    w.process_all(**options)
    assert rows(w.observations().withColumn("value", F.round("value", 9))) == loaded

    w.export_station("S1", "equis", str(tmp_path / "s1"))
    assert sources.load_csv(spark, str(tmp_path / "s1")).count() == 5
    w.export_raw("H1", "wiski", str(tmp_path / "h1"))
    assert sources.load_csv(spark, str(tmp_path / "h1")).count() == 20
    with pytest.raises(ValueError, match="not recognized"):
        w.raw_data("S1", "swd")

    assert spark.table("analytics_outlet_observations_with_flow").filter("flow_value is not null").count() > 0
    assert {r["repository_name"] for r in w.outlets("Clearwater").collect()} == {"Clearwater"}
    assert {r["Text"] for r in w.qc_counts().collect()} == {"Instantaneous"}
    summary = w.station_summary("TP").collect()
    assert len(summary) == 1 and summary[0]["sample_count"] == 5 and summary[0]["start_date"] == 2020
    counts = [r["sample_count"] for r in w.constituent_counts().collect()]
    assert counts == sorted(counts)
    assert w.outlet_summary().count() == 7 and w.station_reach_pairs().count() == 5


def test_replacing_with_nothing_empties_the_bucket(spark, warehouse):
    w = warehouse
    w.append("analytics.wiski", observation(spark, [(T0, 1.0, f"H{i}", "wiski", "Q", "cfs") for i in range(8)]))
    for i in range(8):
        w.replace_stations("analytics.wiski", w.template("analytics.wiski"), [f"H{i}"])
        assert w.read("analytics.wiski").count() == 7 - i
    assert w.read("analytics.wiski", ["H3"]).count() == 0


def test_a_failed_load_leaves_staging_and_analytics(spark, warehouse, rows):
    w = warehouse
    options = {"a": 0.95, "c": 0.02, "min_per_year": 1}
    w.load_sensor(sensor_batch(spark, ["H1", "H2"]), ["H1", "H2"], **options)
    before = [rows(w.read(f"{part}.wiski")) for part in ("staging", "analytics")]
    state = w.states.latest()
    raw = sensor_batch(spark, ["H1"], hours=5)
    broken = w.template("analytics.wiski").unionByName(
        observation(spark, [(T0, 1.0, "H1", "wiski", "Q", "cfs")]).withColumn("value", F.raise_error(F.lit("lost on the way")).cast("double")))
    for overwrite in (True, False):
        with pytest.raises(Exception, match="lost on the way"):
            w._load("wiski", raw, broken, ["H1"], overwrite)
    assert [rows(w.read(f"{part}.wiski")) for part in ("staging", "analytics")] == before and w.states.latest() == state
    # What the failed loads had written is no part of any state, and goes when asked.
    assert w.vacuum() and w.vacuum() == []
    assert [rows(w.read(f"{part}.wiski")) for part in ("staging", "analytics")] == before


def test_two_writers_and_readers_of_one_state(spark, warehouse, rows):
    from tarnflow.plans.versions import Change

    w = warehouse
    w.append("analytics.wiski", observation(spark, [(T0, 1.0, "H1", "wiski", "Q", "cfs")]))
    reader = w.read("analytics.wiski")
    mine, other = Change(w.states), Change(w.states)
    w._add(mine, "analytics.wiski", observation(spark, [(T0, 2.0, "H1", "wiski", "Q", "cfs")]))
    w._replace_stations(other, "analytics.wiski", observation(spark, [(T0, 3.0, "H1", "wiski", "Q", "cfs")]), ["H1"])
    other.publish()
    with pytest.raises(RuntimeError, match="another change"):
        mine.publish()
    assert rows(w.read("analytics.wiski"), "value") == [(3.0,)] and rows(reader, "value") == [(1.0,)]


def test_many_appends_stay_in_few_versions(spark, warehouse, rows):
    from tarnflow.plans.warehouse import MOST_VERSIONS

    w = warehouse
    for k in range(2 * MOST_VERSIONS + 3):
        w.append("analytics.wiski", observation(spark, [(T0, float(k), "H1", "wiski", "Q", "cfs"), (T0, float(k), f"H{k}", "wiski", "WT", "degf")]))
    held = w.states.latest()[1]["tables"]["analytics.wiski"]["versions"]
    for bucket in range(w.buckets):
        assert sum(bucket in v["buckets"] for v in held.values()) <= MOST_VERSIONS
    assert w.read("analytics.wiski").count() == 2 * (2 * MOST_VERSIONS + 3)
    assert rows(w.read("analytics.wiski", ["H1"]).filter("constituent = 'Q'"), "value") == sorted([(float(k),) for k in range(2 * MOST_VERSIONS + 3)], key=lambda r: f"{r[0]}")


def test_views_after_a_promoted_table(spark, warehouse):
    w = warehouse
    w.load_lab(lab_batch(spark, ["S1"]), ["S1"])
    w.promote("staging.equis", "analytics.equis")
    w.append("staging.wiski", sensor_batch(spark, ["H1"]))
    w.process_sensor(a=0.95, c=0.02, min_per_year=1)
    assert "SYS_LOC_CODE" in w.read("analytics.equis").columns and w.read("analytics.wiski").count() == 48 * 3
    assert spark.catalog.tableExists("analytics_wiski_hourly") and not spark.catalog.tableExists("analytics_observations")
    w.process_lab()
    assert spark.table("analytics_observations").count() == 48 * 3 + 5


def test_station_question_reads_one_bucket(spark, warehouse):
    w = warehouse
    w.append("analytics.wiski", observation(spark, [(T0, 1.0, f"H{i}", "wiski", "Q", "cfs") for i in range(40)]))
    plan = w.station_data("H7", "wiski")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station_bucket" in plan or "PartitionFilters: [(station_bucket" in plan
    assert w.station_data("H7", "wiski").count() == 1


def test_append_aligned(spark, warehouse):
    w = warehouse
    df = observation(spark, [(T0, 1.0, "S1", "equis", "TP", "mg/l")])
    w.append("analytics.equis", df.withColumn("more", F.lit(1)).select("more", *reversed(df.columns)))
    assert tuple(w.read("analytics.equis").first()) == tuple(df.first())
    with pytest.raises(Exception, match="unit"):
        w.append("analytics.equis", df.drop("unit"))


def test_init_keeps_and_resets(spark, warehouse, tmp_path):
    w = warehouse
    w.append("analytics.equis", observation(spark, [(T0, 1.0, "S1", "equis", "TP", "mg/l")]))
    w.init()
    assert w.read("analytics.equis").count() == 1
    w.init(reset=True)
    assert w.read("analytics.equis").count() == 0
    w.validate()
    with pytest.raises(ValueError, match="Missing tables: staging.equis"):
        Warehouse(spark, str(tmp_path / "nowhere")).validate()
    with pytest.raises(ValueError, match="not a string"):
        w.load_sensor(sensor_batch(spark, ["H1"]), [12345])


def test_untimed_rows_pair_with_nothing(spark, rows):
    obs = spark.createDataFrame(
        [(None, 1, "TP", 1.0, 1), (None, 1, "Q", 5.0, 1), (T0, 1, "TP", 2.0, 1), (T0, 1, "Q", 6.0, 1), (T0, 2, "TP", 3.0, 1), (T0, 2, "QB", 4.0, 1)],
        "datetime timestamp_ntz, outlet_id int, constituent string, value double, count bigint")
    got = rows(views.with_flow(obs), "outlet_id", "value", "flow_value", "baseflow_value")
    assert got == [(1, 1.0, None, None), (1, 2.0, 6.0, None), (2, 3.0, None, 4.0)]


def test_outlet_means_and_counts(spark, rows):
    obs = observation(spark, [(T0, 1.0, "H1", "wiski", "DO", "mg/l"), (T0, 3.0, "S1", "equis", "DO", "mg/l"), (T0, None, "S1", "equis", "TP", "mg/l"), (T0, 9.0, "S1", "wiski", "DO", "mg/l")])
    stations = spark.createDataFrame([(1, "H1", "wiski"), (1, "S1", "equis")], "outlet_id int, station_id string, station_origin string")
    assert rows(views.outlet_observations(obs, stations), "constituent", "value", "count") == [("DO", 2.0, 2), ("TP", None, 0)]


def test_pairing_with_flow_needs_one_exchange(spark):
    obs = observation(spark, [(T0, 1.0, "H1", "wiski", "Q", "cfs"), (T0, 2.0, "H1", "wiski", "DO", "mg/l")])
    stations = spark.createDataFrame([(1, "H1", "wiski")], "outlet_id int, station_id string, station_origin string")
    paired = views.with_flow(views.outlet_observations(obs, F.broadcast(stations)))
    plan = paired._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(outlet_id") == plan.count("Exchange hashpartitioning") == 1
    assert paired.first()["flow_value"] == 1.0


def test_numbers_of_keys_follow_their_order(spark, rows):
    from tarnflow.operators.ranking import number_keys

    keys = spark.range(3000).select((F.col("id") * 7919 % 3001).cast("string").alias("a"), (F.col("id") % 3).alias("b"))
    got = rows(number_keys(keys, ["a", "b"], "n", ranges=16), "n", "a", "b")
    order = sorted((a, b) for _, a, b in got)
    assert {(n, a, b) for n, a, b in got} == {(n, a, b) for n, (a, b) in enumerate(order)} and len(got) == 3000
    assert number_keys(keys.limit(0), ["a", "b"], "n").count() == 0


def test_row_order_is_carried_or_refused(spark, tmp_path, rows):
    columns = "station_id string, true_opnid int, opnids string, comments string, modeled string, repo_name string, wplmn_flag int"
    table = spark.createDataFrame([(f"H{k}", 1, "1", "", None, "M", 0) for k in range(50)], columns)
    with pytest.raises(ValueError, match="row order"):
        sources.read_station_registry(table, table)
    table.coalesce(1).write.parquet(str(tmp_path / "stations"))
    read = spark.read.parquet(str(tmp_path / "stations"))
    carried = sources.with_row_order(read).repartition(7, "station_id").join(read.select("station_id"), "station_id")
    a, b = (sources.read_station_registry(df, df).filter("source = 'wiski'").orderBy("row_order").select("station_id") for df in (read, carried))
    assert [r[0] for r in a.collect()] == [r[0] for r in b.collect()] == [f"H{k}" for k in range(50)]
    with pytest.raises(ValueError, match="row order"):
        sources.read_station_registry(read.join(read.select("station_id"), "station_id"), read)
    with pytest.raises(ValueError, match="Repartition"):
        sources.read_station_registry(read.repartition(5), read)


def test_writers(spark, tmp_path):
    df = observation(spark, [(T0, 1.0, "S1", "equis", "TP", "mg/l")])
    write_parquet(df, str(tmp_path / "p"), "gzip")
    assert [p.name for p in (tmp_path / "p").glob("*.gz.parquet")]
    write_csv(df, str(tmp_path / "c"), header=False, sep="|")
    assert "".join(part.read_text() for part in (tmp_path / "c").glob("*.csv")).count("|") == 5


def test_landed_files(spark, tmp_path, rows):
    portal = tmp_path / "portal"
    portal.mkdir()
    for s, n in (("S001-1", 2), ("S002", 1)):
        row = {"parameter": "Phosphorus as P", "sampleDate": "2020-06-01", "sampleTime": "10:00", "result": "1", "resultUnit": "ug/L", "stationName": s, "other": 5}
        (portal / f"{s}.json").write_text(json.dumps({"data": [row] * n, "total": n}, indent=1))
    assert rows(sources.read_portal_results(spark, str(portal)).groupBy("station_id").count()) == [("S001-1", 2), ("S002", 1)]
    gauge = tmp_path / "gauge"
    gauge.mkdir()
    (gauge / "E66050001.csv").write_text("tstamp,site,var_name,value\n2020-06-01 10:00:00,1,Discharge (cfs),4.5\n2020-06-01 10:15:00,1,Discharge (cfs),\n")
    got = sources.read_gauge_csv(spark, str(gauge))
    assert rows(got, "station_id", "tstamp", "value") == [("E66050001", "2020-06-01 10:00:00", 4.5), ("E66050001", "2020-06-01 10:15:00", None)]
    from tarnflow.plans.pipelines import gauge_transform

    assert rows(gauge_transform(got), "constituent", "unit", "value", "source") == [("Q", "cfs", 4.5, "csg")]


def test_series_json_finds_columns_by_name(spark, rows):
    records = [
        {"ts_id": "1", "station_no": "H1", "ts_unitsymbol": "°C", "columns": "Value,Timestamp", "rows": "2", "data": [[1.5, "2020-06-01T00:15:00.000-06:00"], [None, "2020-06-01T00:30:00.000-06:00"]]},
        {"ts_id": "2", "station_no": "H2", "columns": "Timestamp,Value,Quality Code,Quality Code Name", "data": [["2020-06-01T01:00:00.000-05:00", "2", 45, "ok"]]},
        {"ts_id": "3", "station_no": "H3", "columns": "Timestamp,Value", "data": []},
    ]
    df = spark.createDataFrame([(json.dumps(records[:1]),), (json.dumps(records[1:]),)], "body string")
    got = rows(sources.type_sensor(sources.parse_series_json(df)), "ts_id", "Timestamp", "Value", "Quality Code")
    assert got == [("1", T0 + timedelta(minutes=15), 1.5, None), ("1", T0 + timedelta(minutes=30), None, None), ("2", T0 + timedelta(hours=1), 2.0, 45)]
    table = spark.createDataFrame([('[["b","a"],["1","2"],["3",null]]',), ('[["a","b"]]',), ('[["a"],[7]]',)], "body string")
    assert rows(sources.parse_table_json(table, ["a", "b"])) == sorted([("2", "1"), (None, "3"), ("7", None)], key=lambda r: (str(r[0]), str(r[1])))


def test_lookup_files(spark, tmp_path, rows):
    (tmp_path / "quality.csv").write_text('﻿quality_code,Text,Description,Active\n10,Good,"Tracks well, ""mostly""",1\n10,Old,x,0\n', encoding="utf-8")
    got = sources.read_quality_codes(spark, str(tmp_path / "quality.csv"))
    assert rows(got) == [(10, "Good", 'Tracks well, "mostly"', 1), (10, "Old", "x", 0)]
    (tmp_path / "texts.csv").write_text('CAS_RN,CHEMICAL_NAME,PARAMETER,constituent\na,b,Phosphorus as P,OP\na,b,"Solids, Suspended",TSS\na,b,Phosphorus as P,TP\n')
    assert rows(sources.read_parameter_map(spark, str(tmp_path / "texts.csv"))) == [("Phosphorus as P", "TP"), ("Solids, Suspended", "TSS")]
    (tmp_path / "xref.csv").write_text("WID,WISKI_STATION_NO,EQUIS_STATION_ID,WISKI_EQUIS_ID\nW1,H1,S1,\n")
    assert rows(sources.read_xref(spark, str(tmp_path / "xref.csv"))) == [("H1", "S1", None, "W1")]
    tables = sources.load_lookups(spark, str(tmp_path / "xref.csv"), str(tmp_path / "quality.csv"))
    assert {k: v.count() for k, v in tables.items()} == {"wiski_parametertype": 14, "equis_casrn": 13, "wiski_quality_codes": 2, "station_xref": 1}


def test_built_in_lookups(spark):
    codes = lookups.quality_codes(spark)
    assert {r["Active"]: r["count"] for r in codes.groupBy("Active").count().collect()} == {1: 23, 0: 47}
    texts = {r[0]: r[1] for r in lookups.parameter_map(spark).collect()}
    assert texts["Phosphorus as P"] == texts["Orthophosphate as P"] == "TP" and texts["Field Temperature"] == "WT"


def test_summary_filter_runs_below_the_aggregate(spark):
    obs = observation(spark, [(T0, 1.0, "S1", "equis", "TP", "mg/l")])
    assert query.station_summary(obs, "TP").count() == 1 and query.station_summary(obs, "WT").count() == 0


def test_a_promoted_table_shares_folders_and_stays_apart(spark, warehouse, rows):
    w = warehouse
    w.load_lab(lab_batch(spark, ["S1", "S2"]), ["S1", "S2"])
    was = rows(w.read("staging.equis"))
    before = set(w.states.listed("analytics/equis"))
    w.promote("staging.equis", "analytics.equis")
    assert set(w.states.listed("analytics/equis")) == before and rows(w.read("analytics.equis")) == was
    # Neither table follows the other, and folders go when no table names them.
    w.append("analytics.equis", lab_batch(spark, ["S3"]))
    w.replace_stations("analytics.equis", w.template("staging.equis"), ["S2"])
    w.replace_stations("staging.equis", lab_batch(spark, ["S1"]).limit(2), ["S1"])
    assert rows(w.read("staging.equis").groupBy("SYS_LOC_CODE").count()) == [("S1", 2), ("S2", 5)]
    w.promote("staging.equis", "analytics.equis")
    w.replace("staging.equis", w.template("staging.equis"))
    w.vacuum()
    assert w.read("staging.equis").count() == 0 and w.vacuum() == []
    assert rows(w.read("analytics.equis").groupBy("SYS_LOC_CODE").count()) == [("S1", 2), ("S2", 5)]
    assert w.read("analytics.equis", ["S2"]).count() == 5
    w.append("analytics.equis", lab_batch(spark, ["S2"]))
    w.replace_stations("analytics.equis", w.template("staging.equis"), ["S1"])
    assert rows(w.read("analytics.equis").groupBy("SYS_LOC_CODE").count()) == [("S2", 10)]
    w.promote("analytics.equis", "staging.equis")
    w.process_lab()
    assert rows(w.read("analytics.equis").groupBy("station_id").count()) == [("S2", 5)]
    assert w.vacuum() and w.read("staging.equis").count() == 10
    with pytest.raises(ValueError, match="Missing tables"):
        Warehouse(spark, w.root + "-new").promote("staging.equis", "analytics.equis")


def test_a_load_computes_its_batch_once(spark, warehouse, tmp_path, monkeypatch):
    from tarnflow.plans import pipelines

    w, read = warehouse, {}
    for name, make in (("lab_transform", pipelines.lab_transform), ("sensor_transform", pipelines.sensor_transform)):
        monkeypatch.setattr(pipelines, name, lambda df, name=name, make=make, **options: read.setdefault(name, df.inputFiles()) and make(df, **options))
    write_parquet(lab_batch(spark, ["S1"]), str(tmp_path / "lab"))
    write_parquet(sensor_batch(spark, ["H1"]), str(tmp_path / "sensor"))
    w.append("staging.equis", lab_batch(spark, ["S9"]))
    w.load_lab(spark.read.parquet(str(tmp_path / "lab")), ["S1"])
    w.load_sensor(spark.read.parquet(str(tmp_path / "sensor")), ["H1"], a=0.95, c=0.02, min_per_year=1)
    for name, table in (("lab_transform", "equis"), ("sensor_transform", "wiski")):
        assert read[name] and all(f"/staging/{table}/version=" in file for file in read[name])
    assert w.station_ids().count() == 2 and w.read("analytics.wiski").count() == 48 * 3
