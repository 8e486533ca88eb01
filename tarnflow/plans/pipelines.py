"""Compositions; the order of steps matters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F

from tarnflow import lookups, schemas
from tarnflow.operators import crossref, filters, lab, portal, sensor
from tarnflow.operators.baseflow import with_baseflow


def sensor_hourly(df: DataFrame, filter_quality: bool = True, accepted: Iterable[int] | None = None) -> DataFrame:
    """Sensor rows -> hourly observations from 1996 on; the rounded hour decides on the year."""
    rows = sensor.normalize(df)
    if filter_quality:
        rows = filters.quality_filter(rows, accepted)
    hourly = rows.transform(filters.rounded_year_filter).transform(sensor.hourly_mean)
    return schemas.conform(hourly.transform(sensor.tag_origin, lookups.SENSOR_ORIGIN), schemas.OBSERVATION)


def sensor_transform(
    df: DataFrame, filter_quality: bool = True, accepted: Iterable[int] | None = None, **baseflow_options
) -> DataFrame:
    """Sensor rows -> hourly observations with baseflow.

    ``baseflow_options`` go to :func:`tarnflow.operators.baseflow.baseflow`.
    """
    hourly = sensor_hourly(df, filter_quality, accepted)
    return with_baseflow(hourly, origin=lookups.SENSOR_ORIGIN, **baseflow_options)


def lab_transform(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Laboratory rows -> hourly observations from 1996 on (X2); the years are cut before rounding."""
    hourly = (
        lab.normalize(df, observation)
        .transform(lab.nondetect_to_zero)
        .transform(filters.year_filter)
        .transform(lab.lab_hourly)
    )
    return schemas.conform(hourly, schemas.OBSERVATION)


portal_transform = portal.portal_transform
gauge_transform = portal.gauge_values


def load_network_pull(df: DataFrame, members: DataFrame) -> DataFrame:
    """Load-network rows of landed sensor data (X8): parameters, daily means, member stations."""
    return crossref.flag_load_network(filters.load_network_series(df), members).filter(F.col("wplmn_flag") == 1)
