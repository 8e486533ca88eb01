import random

import pytest
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.operators import crossref, outlets, ranking


def registry(spark):
    rows = [
        # station, true_opnid, opnids, comments, modeled, repo, flag, source
        ("E1", 650, "650.0, 651", "a", None, "Clearwater", 1, "wiski"),
        ("E1", 9, "9", "b", None, "Clearwater", 0, "wiski"),
        ("E2", 3, " ", "c", None, "Clearwater", 1, "wiski"),
        ("E3", 3, "3", "d", None, None, 1, "wiski"),
        ("S1", 650, "650.0, 651", "e", None, "Clearwater", 0, "equis"),
        ("E1", 20, "20", "f", None, "Buffalo", 0, "equis"),
        ("S2", 20, " 20\t", "g", None, "Buffalo", 0, "equis"),
        ("S3", 651, "651", "h", None, "Clearwater", 0, "equis"),
        ("S4", 5, None, "i", None, "Clearwater", 0, "equis"),
    ]
    return spark.createDataFrame(rows, schemas.REGISTRY)


@pytest.fixture
def mapped(spark):
    return outlets.assign_outlets(registry(spark), ["comments"]).cache()


def test_assign_outlets(mapped, rows):
    assert rows(mapped, "station_id", "source", "opnids", "outlet_id") == [
        ("E1", "equis", "20", 0), ("E1", "wiski", "650.0, 651", 1), ("S1", "equis", "650.0, 651", 1),
        ("S2", "equis", "20", 0), ("S3", "equis", "651", 2),
    ]


def test_build_outlets_and_pairs(mapped, rows):
    t = outlets.build_outlets(mapped)
    assert rows(t.groups, "outlet_id", "repository_name") == [(0, "Buffalo"), (1, "Clearwater"), (2, "Clearwater")]
    assert rows(t.reaches, "outlet_id", "reach_id") == [(0, 20), (1, 650), (1, 651), (2, 651)]
    pairs = outlets.station_reach_pairs(t.stations, t.reaches)
    assert pairs.count() == 2 + 4 + 1
    assert outlets.pairs_by_reach(pairs, 651, "Clearwater").count() == 3
    assert rows(outlets.outlet_reaches(pairs, 1)) == [(650,), (651,)]
    assert rows(outlets.station_reaches(pairs, "E1", "wiski")) == [(650,), (651,)]
    assert rows(outlets.outlet_stations(pairs, 0)) == [("E1", "equis"), ("S2", "equis")]
    members = outlets.registered_stations(registry(mapped.sparkSession), "Buffalo", "equis")
    assert outlets.pairs_by_station(pairs, "S1", "equis", members).count() == 0
    assert outlets.pairs_by_station(pairs, "S2", "equis", members).count() == 1
    assert outlets.validate_outlets(t).count() == 0
    one = outlets.build_outlets(mapped, "Buffalo")
    assert rows(one.groups, "outlet_id") == [(0,)]


def test_registry_questions(spark, mapped, rows):
    assert rows(outlets.registered_stations(registry(spark), "Clearwater", "wiski")) == [("E1",), ("E1",), ("E2",)]
    assert rows(outlets.mapped_stations(mapped, "Clearwater", "wiski")) == [("E1",)]
    assert rows(outlets.load_network_stations(mapped, "Clearwater")) == [("E1",)]
    assert rows(outlets.scope_reaches(mapped, "lab", "Clearwater")) == [(650,), (651,), (651,)]
    assert rows(outlets.scope_reaches(mapped, "station", station=("E1", "equis"))) == [(20,)]
    assert rows(outlets.model_reaches(mapped, "Clearwater")) == [(650,), (651,)]
    with pytest.raises(ValueError):
        outlets.mapped_stations(mapped, "Clearwater", "swd")
    with pytest.raises(ValueError):
        outlets.scope_reaches(mapped, "everything", "Clearwater")


def test_number_keys_equals_sorting(spark):
    rng = random.Random(5)
    keys = {("".join(rng.choice("0123456789,. ") for _ in range(rng.randint(1, 7))), rng.choice("ab")) for _ in range(500)}
    keys |= {("7", "a"), ("7", "b"), ("700000", "a"), ("7,", "a")}
    df = spark.createDataFrame(list(keys), "opnids string, repo_name string")
    got = {(r[0], r[1]): r[2] for r in ranking.number_keys(df, ["opnids", "repo_name"], "n").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_keep_first_settles_ties(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("b", 2, None), ("b", 2, "z")], "k string, o int, v string")
    assert sorted(map(tuple, ranking.keep_first(df.repartition(4), ["k"], ["o"]).collect())) == [("a", 1, "x"), ("b", 2, None)]


def xref(spark):
    rows = [
        ("H1", "S1", "S1", "W1"), ("H1", "S2", None, "W1"), ("H1", "S1", "S1", "W2"), ("H2", "S1", None, "W1"),
        ("H2", "S2", "S2", "W1"), ("H3", "S4", "S4", "W3"), ("H3", "S4", "S5", "W3"), ("H4", None, None, "W3"), (None, "S6", "S6", "W3"),
        ("H5", "S7", "S1", "W4"),
    ]
    return spark.createDataFrame(rows, schemas.XREF)


def test_aliases(spark, rows):
    x = xref(spark)
    assert rows(crossref.sensor_to_lab_alias(x)) == [
        ("H1", "S1", False), ("H2", "S2", False), ("H3", None, True), ("H5", "S1", False)]
    assert ("S1", None, True) in rows(crossref.lab_to_sensor_alias(x))
    assert crossref.alias_of(x, "H1") == "S1" and crossref.alias_of(x, "H4") is None
    for call in (lambda: crossref.alias_of(x, "H3"), lambda: crossref.alias_of(x, "S1", "lab_to_sensor")):
        with pytest.raises(ValueError, match="Several aliases"):
            call()
    with pytest.raises(Exception, match="Several aliases for H3"):
        crossref.sensor_to_lab_alias(x, strict=True).collect()


@pytest.mark.parametrize("ids,wanted", [
    (["S1", "S2"], ["H1", "H2"]), (["S1"], ["H1", "H2"]), (["S1", "S4"], []), (["S1", "S9"], []), (["S9"], []), (["S4", "S4"], ["H3"]),
])
def test_shared_links(spark, rows, ids, wanted):
    frame = spark.createDataFrame([(i,) for i in ids], "station_id string")
    assert rows(crossref.shared_links(xref(spark), frame)) == [(w,) for w in wanted]


def test_watersheds_and_flags(spark, rows):
    x = xref(spark)
    assert rows(crossref.stations_by_watershed(x, "W1", "wplmn")) == [("H1",), ("H2",)]
    assert rows(crossref.stations_by_watershed(x, "W1", "equis")) == [("S1",), ("S2",)]
    with pytest.raises(ValueError):
        crossref.stations_by_watershed(x, "W1", "csg")
    assert rows(crossref.lab_to_sensor_links(x.filter("EQUIS_STATION_ID = 'S1'"))) == [("S1", "H1"), ("S1", "H2")]
    df = spark.createDataFrame([("H1", 9), ("H2", 9)], "station_no string, wplmn_flag bigint")
    members = spark.createDataFrame([("H2",), ("H2",)], "station_no string")
    assert rows(crossref.flag_load_network(df, members), "station_no", "wplmn_flag") == [("H1", 0), ("H2", 1)]


def test_validation_finds_everything(spark, rows):
    groups = spark.createDataFrame([(1, "a", None, None), (1, "a", None, None), (2, None, None, None)], "outlet_id int, repository_name string, outlet_name string, notes string")
    stations = spark.createDataFrame([(1, "s", "wiski", "a", None, None), (3, "s", "wiski", "a", 1, None)], "outlet_id int, station_id string, station_origin string, repository_name string, true_opnid int, comments string")
    reaches = spark.createDataFrame([(None, 1, "a"), (4, 1, "a")], "outlet_id int, reach_id int, repository_name string")
    got = rows(outlets.validate_outlets(outlets.Outlets(groups, stations, reaches)))
    assert got == sorted([
        ("outlet_groups", "primary key", "1", 2), ("outlet_groups", "not null", "repository_name", 1),
        ("outlet_stations", "unique", "s|wiski", 2), ("outlet_stations", "foreign key", "3", 1),
        ("outlet_stations", "not null", "true_opnid", 1), ("outlet_reaches", "foreign key", "4", 1),
        ("outlet_reaches", "not null", "outlet_id", 1),
    ])
