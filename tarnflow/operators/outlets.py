"""Stations, outlets and model reaches."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tarnflow import lookups, schemas
from tarnflow.functions import codes
from tarnflow.functions.timing import BLANKS
from tarnflow.operators.ranking import keep_first, number_keys


class Outlets(NamedTuple):
    """The three outlet tables."""

    groups: DataFrame
    stations: DataFrame
    reaches: DataFrame


def assign_outlets(registry: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Mapped stations with ``outlet_id``.

    Blank reach lists and missing models are dropped, the first row per (station, source) is kept
    - first by ``order``; without one by the registry's ``row_order``, if it has that column, else by
    the row's own content - and the distinct (reach list, model) pairs
    are numbered from 0 in sorted order.
    """
    trimmed = registry.withColumn("opnids", F.trim("opnids", F.lit(BLANKS))).filter(
        (F.col("opnids") != "") & F.col("repo_name").isNotNull()
    )
    if order is None:
        order = ["row_order"] if "row_order" in registry.columns else []
    mapped = keep_first(trimmed, ["station_id", "source"], order).drop("row_order")
    pair = ["opnids", "repo_name"]
    numbered = number_keys(mapped.select(*pair).distinct(), pair, "outlet_id")
    return mapped.join(numbered, pair)


def build_outlets(mapped: DataFrame, model: str | None = None) -> Outlets:
    """The three outlet tables from :func:`assign_outlets` (M1), for one model or all."""
    rows = mapped if model is None else mapped.filter(F.col("repo_name") == model)
    groups = rows.select(
        "outlet_id",
        F.col("repo_name").alias("repository_name"),
        F.lit(None).cast("string").alias("outlet_name"),
        F.lit(None).cast("string").alias("notes"),
    ).distinct()
    reaches = (
        rows.select("outlet_id", F.col("repo_name").alias("repository_name"), "opnids")
        .distinct()
        .select("outlet_id", F.explode(codes.reach_numbers(F.col("opnids"))).alias("reach_id"), "repository_name")
        .distinct()
    )
    stations = rows.select(
        "outlet_id",
        "station_id",
        F.col("source").alias("station_origin"),
        F.col("repo_name").alias("repository_name"),
        F.col("true_opnid").cast("int").alias("true_opnid"),
        "comments",
    )
    return Outlets(groups, stations, reaches)


def station_reach_pairs(stations: DataFrame, reaches: DataFrame) -> DataFrame:
    """Stations with every reach of their outlet."""
    return stations.select("outlet_id", "station_id", "station_origin").join(reaches, "outlet_id").select(
        "outlet_id", "station_id", "station_origin", "reach_id", "repository_name"
    )


def validate_outlets(outlets: Outlets) -> DataFrame:
    """Broken constraints, one row each: table, rule, key and number of rows (V1)."""

    def found(df: DataFrame, table: str, rule: str, key) -> DataFrame:
        return df.select(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), key.alias("key"), F.col("n").alias("n_rows")
        )

    def repeated(df: DataFrame, table: str, rule: str, keys: list[str]) -> DataFrame:
        many = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
        return found(many, table, rule, F.concat_ws("|", *keys))

    def orphans(df: DataFrame, table: str) -> DataFrame:
        lost = df.filter("outlet_id is not null").join(outlets.groups, "outlet_id", "left_anti")
        counted = lost.groupBy("outlet_id").agg(F.count("*").alias("n"))
        return found(counted, table, "foreign key", F.col("outlet_id").cast("string"))

    def missing(df: DataFrame, table: str, schema) -> DataFrame:
        required = [f.name for f in schema if not f.nullable]
        gaps = df.select(
            F.explode(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])).alias("column_name")
        ).filter("column_name is not null")
        counted = gaps.groupBy("column_name").agg(F.count("*").alias("n"))
        return found(counted, table, "not null", F.col("column_name"))

    parts = [
        repeated(outlets.groups, "outlet_groups", "primary key", ["outlet_id"]),
        repeated(outlets.stations, "outlet_stations", "unique", ["station_id", "station_origin"]),
        orphans(outlets.stations, "outlet_stations"),
        orphans(outlets.reaches, "outlet_reaches"),
        missing(outlets.groups, "outlet_groups", schemas.OUTLET_GROUPS),
        missing(outlets.stations, "outlet_stations", schemas.OUTLET_STATIONS),
        missing(outlets.reaches, "outlet_reaches", schemas.OUTLET_REACHES),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---- Registry questions -------------------------------------------------------------------


def _check_origin(origin: str) -> None:
    if origin not in (lookups.SENSOR_ORIGIN, lookups.LAB_ORIGIN):
        raise ValueError(f"Station origin {origin} not recognized.")


def model_registry(mapped: DataFrame, model: str) -> DataFrame:
    """Mapped stations of one model (M2)."""
    return mapped.filter(F.col("repo_name") == model)


def model_names(mapped: DataFrame) -> DataFrame:
    """Distinct models."""
    return mapped.select("repo_name").distinct()


def registered_stations(registry: DataFrame, model: str, origin: str) -> DataFrame:
    """Stations of a model and origin in the raw registry, mapped or not (M3)."""
    _check_origin(origin)
    return registry.filter((F.col("repo_name") == model) & (F.col("source") == origin)).select("station_id")


def mapped_stations(mapped: DataFrame, model: str, origin: str) -> DataFrame:
    """Mapped stations of a model and origin (M4)."""
    _check_origin(origin)
    return model_registry(mapped, model).filter(F.col("source") == origin).select("station_id")


def load_network_stations(mapped: DataFrame, model: str) -> DataFrame:
    """Sensor stations of the load network in a model (M5)."""
    return (
        model_registry(mapped, model)
        .filter((F.col("wplmn_flag") == 1) & (F.col("source") == lookups.SENSOR_ORIGIN))
        .select("station_id")
    )


def scope_reaches(mapped: DataFrame, scope: str, model: str | None = None, station: tuple[str, str] | None = None) -> DataFrame:
    """Reach numbers by scope, repeats kept (M6).

    ``scope`` is ``load``, ``sensor`` or ``lab`` with a ``model``, or ``station`` with a
    (station, origin) pair.
    """
    source = F.col("source")
    if scope == "station":
        kept = mapped.filter((F.col("station_id") == station[0]) & (source == station[1]))
    elif scope == "load":
        kept = model_registry(mapped, model).filter((F.col("wplmn_flag") == 1) & (source == lookups.SENSOR_ORIGIN))
    elif scope == "sensor":
        kept = model_registry(mapped, model).filter(source == lookups.SENSOR_ORIGIN)
    elif scope == "lab":
        kept = model_registry(mapped, model).filter(source == lookups.LAB_ORIGIN)
    else:
        raise ValueError(f"Scope {scope} not recognized.")
    return kept.select(F.explode(codes.reach_numbers(F.col("opnids"))).alias("reach_id"))


def model_reaches(mapped: DataFrame, model: str) -> DataFrame:
    """Distinct reaches of all mapped stations of a model (the union of the scopes, D11)."""
    return scope_reaches(mapped, "sensor", model).unionByName(scope_reaches(mapped, "lab", model)).distinct()


def outlet_members(mapped: DataFrame, model: str) -> DataFrame:
    """Stations per outlet of a model, one row per station (M7).

    The list form of an outlet is its rows; they are not packed into one array so that an outlet of
    any size stays spread over tasks.
    """
    return model_registry(mapped, model).select("outlet_id", "opnids", "station_id", "source")


# ---- Pair questions -----------------------------------------------------------------------


def pairs_by_model(pairs: DataFrame, model: str) -> DataFrame:
    """Pairs of a model (Q5 without the order)."""
    return pairs.filter(F.col("repository_name") == model)


def pairs_by_reach(pairs: DataFrame, reach: int, model: str) -> DataFrame:
    """Pairs of a reach in a model (M8)."""
    return pairs_by_model(pairs, model).filter(F.col("reach_id") == reach)


def pairs_by_station(
    pairs: DataFrame, station: str, origin: str, members: DataFrame | None = None
) -> DataFrame:
    """Pairs of a station (M9); with ``members`` only if the station is one of them."""
    found = pairs.filter((F.col("station_id") == station) & (F.col("station_origin") == origin))
    return found if members is None else found.join(members.select("station_id"), "station_id", "left_semi").select(*pairs.columns)


def station_reaches(pairs: DataFrame, station: str, origin: str) -> DataFrame:
    """Reaches of a station, repeats kept."""
    return pairs_by_station(pairs, station, origin).select("reach_id")


def outlet_reaches(pairs: DataFrame, outlet: int) -> DataFrame:
    """Distinct reaches of an outlet."""
    return pairs.filter(F.col("outlet_id") == outlet).select("reach_id").distinct()


def outlet_stations(pairs: DataFrame, outlet: int) -> DataFrame:
    """Distinct stations of an outlet."""
    return pairs.filter(F.col("outlet_id") == outlet).select("station_id", "station_origin").distinct()
