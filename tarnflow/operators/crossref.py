"""Station cross-reference between sensor and laboratory names.

Nothing here gathers a station's partners into an array: ambiguity is seen from the smallest and
largest partner, and set equality from counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarnflow import lookups

SENSOR, LAB, ALIAS = "WISKI_STATION_NO", "EQUIS_STATION_ID", "WISKI_EQUIS_ID"


def _alias(xref: DataFrame, key: str, value: str, strict: bool) -> DataFrame:
    found = (
        xref.dropna(subset=[key, value])
        .groupBy(F.col(key).alias("station_id"))
        .agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    )
    ambiguous = F.col("_low") != F.col("_high")
    alias = F.when(~ambiguous, F.col("_low"))
    if strict:
        message = F.concat(F.lit("Several aliases for "), F.col("station_id"))
        alias = F.when(ambiguous, F.raise_error(message)).otherwise(F.col("_low"))
    return found.select("station_id", alias.alias("alias"), ambiguous.alias("ambiguous"))


def sensor_to_lab_alias(xref: DataFrame, stations: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """The one laboratory alias of each sensor station.

    A station without an alias gives no row; one with several has ``ambiguous`` set and no alias,
    or fails the query when ``strict``.
    """
    result = _alias(xref, SENSOR, ALIAS, strict)
    return result if stations is None else result.join(stations.select("station_id"), "station_id", "left_semi")


def lab_to_sensor_alias(xref: DataFrame, stations: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """The one sensor station of each alias."""
    result = _alias(xref, ALIAS, SENSOR, strict)
    return result if stations is None else result.join(stations.select("station_id"), "station_id", "left_semi")


def alias_of(xref: DataFrame, station: str, direction: str = "sensor_to_lab") -> str | None:
    """Alias of one station, ``None`` without one, ``ValueError`` with several."""
    key, value = (SENSOR, ALIAS) if direction == "sensor_to_lab" else (ALIAS, SENSOR)
    row = _alias(xref.filter(F.col(key) == station), key, value, strict=False).first()
    if row is None:
        return None
    if row["ambiguous"]:
        raise ValueError(f"Several aliases for {station}")
    return row["alias"]


def _links(xref: DataFrame, key: str, value: str, stations: DataFrame | None) -> DataFrame:
    pairs = xref.dropna(subset=[key, value]).select(F.col(key).alias("station_id"), F.col(value).alias("linked_id"))
    if stations is not None:
        pairs = pairs.join(stations.select("station_id"), "station_id", "left_semi")
    return pairs.distinct()


def sensor_to_lab_links(xref: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """All laboratory stations linked to each sensor station."""
    return _links(xref, SENSOR, LAB, stations)


def lab_to_sensor_links(xref: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """All sensor stations linked to each laboratory station."""
    return _links(xref, LAB, SENSOR, stations)


def shared_links(xref: DataFrame, ids: DataFrame) -> DataFrame:
    """Sensor stations common to all given laboratory stations, if all have the same set.

    The sets are equal exactly when every linked sensor station is linked to every given id; then
    all of them are returned, otherwise none. ``ids`` has a ``station_id`` column.
    """
    wanted = ids.select("station_id").distinct()
    per_sensor = lab_to_sensor_links(xref, wanted).groupBy("linked_id").agg(F.count("*").alias("n"))
    verdict = per_sensor.agg(F.min("n").alias("fewest"))
    total = wanted.agg(F.count("*").alias("total"))
    return per_sensor.filter(verdict.scalar() == total.scalar()).select("linked_id")


def stations_by_watershed(xref: DataFrame, watershed: str, origin: str) -> DataFrame:
    """Distinct stations of a watershed on the side of the origin."""
    if origin not in lookups.XREF_COLUMN:
        raise ValueError(f"Station origin {origin} not recognized.")
    column = lookups.XREF_COLUMN[origin]
    return xref.filter(F.col("WID") == watershed).select(F.col(column).alias("station_id")).distinct()


def xref_stations(xref: DataFrame, side: str) -> DataFrame:
    """Distinct stations named on one side (J11): ``sensor`` or ``lab``."""
    return xref.select(F.col({"sensor": SENSOR, "lab": LAB}[side]).alias("station_id")).distinct()


def flag_load_network(df: DataFrame, members: DataFrame) -> DataFrame:
    """``wplmn_flag`` 1 for stations of the load network, else 0 (J12), station by station."""
    listed = members.select(F.col("station_no"), F.lit(1).cast("bigint").alias("_member")).distinct()
    flagged = df.drop("wplmn_flag").join(listed, "station_no", "left")
    return flagged.withColumn("wplmn_flag", F.coalesce("_member", F.lit(0).cast("bigint"))).drop("_member")
