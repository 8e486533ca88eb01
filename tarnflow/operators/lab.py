"""Laboratory results: extract, normalise, hourly mean."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F

from tarnflow import lookups
from tarnflow.functions import codes, measures, timing
from tarnflow.operators.filters import lab_extract_filter
from tarnflow.operators.sensor import HOURLY_KEYS, hourly_mean, tag_origin


def lab_constituent(df: DataFrame) -> DataFrame:
    """Add ``constituent`` by analyte code (P5)."""
    return df.withColumn("constituent", codes.lab_constituent(F.col("CAS_RN")))


def lab_time(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Add ``datetime`` at UTC-6 (P6); an unknown or missing zone label gives NULL.

    Pass an ``Observation`` to get ``unknown_labels``, the number of rows with a label that is not
    known, counted while the data flows.
    """
    label = F.col("SAMPLE_DATE_TIMEZONE")
    if observation is not None:
        unknown = label.isNotNull() & timing.zone_hours(label).isNull()
        df = df.observe(observation, F.count(F.when(unknown, True)).alias("unknown_labels"))
    return df.withColumn("datetime", timing.to_fixed_zone(F.col("SAMPLE_DATE_TIME"), label))


def lab_columns(df: DataFrame) -> DataFrame:
    """Keep and rename six columns."""
    return df.select(
        F.col("SYS_LOC_CODE").alias("station_id"),
        "constituent",
        F.col("CAS_RN").alias("cas_rn"),
        "datetime",
        F.col("RESULT_NUMERIC").alias("value"),
        F.col("RESULT_UNIT").alias("unit"),
    )


def lab_units(df: DataFrame) -> DataFrame:
    """Standard units for ``value`` and ``unit``."""
    value, unit = measures.lab_measure(F.col("value"), F.col("unit"))
    return df.withColumns({"value": value, "unit": unit})


def normalize(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Constituent, time, columns, units (first half of X2)."""
    return df.transform(lab_constituent).transform(lab_time, observation).transform(lab_columns).transform(lab_units)


def nondetect_to_zero(df: DataFrame) -> DataFrame:
    """A missing result is below detection: zero."""
    return df.withColumn("value", F.coalesce(measures.without_nan(F.col("value")), F.lit(0.0)))


def lab_hourly(df: DataFrame) -> DataFrame:
    """Mean per rounded hour, tagged with the laboratory origin (A2)."""
    return df.transform(hourly_mean, HOURLY_KEYS).transform(tag_origin, lookups.LAB_ORIGIN)


def available_pairs(df: DataFrame) -> DataFrame:
    """One normalised row per station and constituent (A14, laboratory).

    The row kept is the smallest by its other columns, found with a map-side combined minimum.
    """
    kept = normalize(df).groupBy("station_id", "constituent").agg(
        F.min(F.struct("datetime", "cas_rn", "value", "unit")).alias("row")
    )
    return kept.select("station_id", "constituent", "row.*")


def lab_extract(results: DataFrame, stations: DataFrame, samples: DataFrame, ids: Iterable[str] | None = None) -> DataFrame:
    """Results with station and sample attributes, restricted to what the library uses.

    The restriction names columns of both right sides, so the outer joins reduce to inner joins,
    and each part of it reaches its own scan. No join is hinted: the optimizer broadcasts a side
    only when its measured size allows, and splits hot keys of a shuffled join at run time.
    """
    added = ["LATITUDE", "LONGITUDE", "WID_LIST", "SAMPLE_METHOD", "SAMPLE_REMARK"]
    station = stations.select(
        "SYS_LOC_CODE", "FACILITY_ID", "LATITUDE", "LONGITUDE", "WID_LIST",
        F.col("LOC_TYPE").alias("station_loc_type"),
    )
    sample = samples.select("SAMPLE_ID", "SAMPLE_METHOD", "SAMPLE_REMARK")
    base = results.drop(*added)
    joined = base.join(station, ["SYS_LOC_CODE", "FACILITY_ID"], "left").join(sample, "SAMPLE_ID", "left")
    return lab_extract_filter(joined, ids, location_type="station_loc_type").select(*added, *base.columns)


def station_locations(results: DataFrame, stations: DataFrame) -> DataFrame:
    """Places of river stations that hold any supported analyte.

    The result keys are made distinct before the join, so the join moves one row per station
    rather than one per result.
    """
    wanted = (
        results.filter(
            (F.col("LOC_TYPE") == lookups.LAB_LOCATION_TYPE) & F.col("CAS_RN").isin(*lookups.LAB_ANALYTES)
        )
        .select("SYS_LOC_CODE")
        .distinct()
    )
    place = stations.select("SYS_LOC_CODE", "LONGITUDE", "LATITUDE", "LOC_MAJOR_BASIN", "NON_PUBLIC_LOCATION_FLAG")
    return wanted.join(place, "SYS_LOC_CODE", "left").distinct()
