"""Sensor series: normalise, hourly mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarnflow import lookups
from tarnflow.functions import codes, measures, timing
from tarnflow.operators.filters import drop_incomplete_keys

RENAMES = {
    "station_no": "station_id",
    "Timestamp": "datetime",
    "Value": "value",
    "ts_unitsymbol": "unit",
    "Quality Code": "quality_code",
    "Quality Code Name": "quality_code_name",
}
HOURLY_KEYS = ("station_id", "datetime", "constituent", "unit")


def sensor_units(df: DataFrame) -> DataFrame:
    """Standard units for ``Value`` and ``ts_unitsymbol``."""
    value, unit = measures.sensor_measure(F.col("Value"), F.col("ts_unitsymbol"))
    return df.withColumns({"Value": value, "ts_unitsymbol": unit})


def sensor_constituent(df: DataFrame) -> DataFrame:
    """Add ``constituent``."""
    return df.withColumn("constituent", codes.sensor_constituent(F.col("stationparameter_no")))


def sensor_columns(df: DataFrame) -> DataFrame:
    """Constituent, then the standard column names."""
    return sensor_constituent(df).withColumnsRenamed(RENAMES)


def normalize(df: DataFrame) -> DataFrame:
    """Units, constituents and names; no filtering, no averaging (first half of X1)."""
    return df.transform(sensor_units).transform(sensor_columns)


def hourly_mean(df: DataFrame, keys: tuple[str, ...] = HOURLY_KEYS) -> DataFrame:
    """Mean per rounded hour and key (A1). The average is combined on the map side.

    Incomplete keys are dropped before rounding: a condition on the rounded time would be pushed
    below it and repeat the whole expression there.
    """
    return (
        df.transform(drop_incomplete_keys, keys)
        .withColumn("datetime", timing.hour_round(F.col("datetime")))
        .groupBy(*keys)
        .agg(F.avg("value").alias("value"))
    )


def hourly_bucket(df: DataFrame) -> DataFrame:
    """Mean per started hour (A9). NULL keys form groups, as in SQL."""
    return df.groupBy(
        "station_id", "constituent", timing.hour_floor(F.col("datetime")).alias("hour_start"), "unit"
    ).agg(F.avg("value").alias("value"))


def tag_origin(df: DataFrame, origin: str) -> DataFrame:
    """Literal ``station_origin``."""
    return df.withColumn("station_origin", F.lit(origin))


def available_series(df: DataFrame, constituent: str | None = None) -> DataFrame:
    """Series on offer with their constituent (A14, sensor): unit-value series, repeats kept.

    Without a constituent those of the parameter numbers offered by default; with one those of its own numbers,
    and all numbers for a constituent that has none.
    """
    if constituent is not None and constituent not in lookups.CONSTITUENTS:
        raise ValueError(f"Invalid constituent: {constituent}; known: {', '.join(lookups.CONSTITUENTS)}")
    patterns = lookups.OFFERED_NUMBERS if constituent is None else lookups.PARAMETER_SCOPE[constituent]
    rows = df.filter(F.col("ts_name").isin(*lookups.UNIT_SERIES))
    if patterns:
        rows = rows.filter(codes.matches(F.col("stationparameter_no"), patterns))
    return rows.transform(sensor_columns)
