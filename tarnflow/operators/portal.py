"""Portal results and cooperative gauges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarnflow import lookups
from tarnflow.functions import codes, measures, timing
from tarnflow.operators.filters import after_1996, drop_incomplete_keys, supported_parameters
from tarnflow.operators.sensor import tag_origin

PORTAL_KEYS = (
    "datetime", "variable", "unit", "station_id", "station_name", "constituent",
    "data_format", "data_type", "station_origin",
)


def portal_time(df: DataFrame) -> DataFrame:
    """``datetime`` from the date and time texts."""
    text = F.concat(F.col("sampleDate"), F.lit(" "), F.col("sampleTime"))
    return df.withColumn("datetime", F.to_timestamp_ntz(text))


def portal_values(df: DataFrame, texts: DataFrame) -> DataFrame:
    """Numbers, units, constituents and fixed tags (P9). ``texts`` is the fixed parameter map."""
    number = F.col("result").try_cast("double")
    value, unit = measures.portal_measure(measures.without_nan(number), F.col("resultUnit"))
    return (
        df.filter(F.col("result").isNull() | (F.col("result") != "(null)"))
        .join(texts, "parameter", "left")
        .select(
            "datetime",
            value.alias("value"),
            F.col("parameter").alias("variable"),
            unit.alias("unit"),
            "station_id",
            F.col("stationName").alias("station_name"),
            "constituent",
            F.lit("instantaneous").alias("data_format"),
            F.lit("discrete").alias("data_type"),
        )
        .transform(tag_origin, lookups.PORTAL_ORIGIN)
    )


def portal_hourly(df: DataFrame) -> DataFrame:
    """Mean per rounded hour and the descriptive columns (A3); each station keeps its own name."""
    return (
        df.transform(drop_incomplete_keys, PORTAL_KEYS)
        .withColumn("datetime", timing.hour_round(F.col("datetime")))
        .groupBy(*PORTAL_KEYS)
        .agg(F.avg("value").alias("value"))
        .withColumn("quality_id", F.lit(None).cast("string"))
    )


def portal_transform(df: DataFrame, texts: DataFrame) -> DataFrame:
    """Known parameters, time, after 1996, values, hourly mean."""
    return (
        df.transform(supported_parameters, texts)
        .transform(portal_time)
        .transform(after_1996)
        .transform(portal_values, texts)
        .transform(portal_hourly)
    )


def portal_stations(df: DataFrame) -> DataFrame:
    """One row per station, units relabelled (A14, portal).

    Which row stands for a station is fixed by ordering on all its columns; the choice is a
    map-side combined minimum.
    """
    relabelled = df.withColumn("resultUnit", measures.portal_unit(F.col("resultUnit")))
    rest = [c for c in relabelled.columns if c != "station_id"]
    kept = relabelled.groupBy("station_id").agg(F.min(F.struct(*rest)).alias("row"))
    return kept.select("station_id", "row.*")


def gauge_values(df: DataFrame) -> DataFrame:
    """Names, constituent and unit by variable text, missing values dropped."""
    constituent = {text: pair[0] for text, pair in lookups.GAUGE_VARIABLES.items()}
    unit = {text: pair[1] for text, pair in lookups.GAUGE_VARIABLES.items()}
    variable = F.col("var_name")
    value = measures.without_nan(F.col("value"))
    return (
        df.select(
            F.to_timestamp_ntz("tstamp").alias("datetime"),
            variable.alias("variable"),
            value.alias("value"),
            "station_id",
            codes.literal_map(unit, variable).alias("unit"),
            codes.literal_map(constituent, variable).alias("constituent"),
            F.lit(lookups.GAUGE_ORIGIN).alias("source"),
        )
        .dropna(subset=["value"])
    )


def standardize_units(df: DataFrame) -> DataFrame:
    """Unit spelling of the main sources, for a union with them."""
    value, unit = measures.standard_unit(F.col("value"), F.col("unit"))
    return df.withColumns({"value": value, "unit": unit})
