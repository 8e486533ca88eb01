"""Query API (Q1-Q7): each answer is one lazy plan over the tables it is given.

Reports are ordered by their whole key, so that equal rows of a leading column have one order (O1).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tarnflow import lookups
from tarnflow.operators import outlets, views
from tarnflow.operators.resample import resample

PAIR_ORDER = ("outlet_id", "station_id", "station_origin", "reach_id", "repository_name")


def observation_data(
    obs: DataFrame, stations: Iterable[str], constituent: str, period: str | None = None, agg: str | None = None
) -> DataFrame:
    """Observations of stations and a constituent, pooled per period when one is given (Q1)."""
    rows = obs.filter(F.col("station_id").isin(*stations) & (F.col("constituent") == constituent))
    if period is not None:
        rows = resample(rows, period, ["value"], lookups.defaults_for(constituent, agg)[1])
    return rows.withColumnRenamed("value", "observed").filter(F.col("observed").isNotNull())


def outlet_data(
    flow_obs: DataFrame, outlet: int, constituent: str, period: str | None = "D", agg: str | None = None
) -> DataFrame:
    """A constituent at an outlet beside flow and baseflow (Q2).

    ``flow_obs`` comes from ``views.with_flow``. The outlet filter passes through its window; the
    constituent filter stays above it, since the window needs the flow rows.
    """
    rows = flow_obs.filter((F.col("outlet_id") == outlet) & (F.col("constituent") == constituent))
    if period is not None:
        measures = ["value", "flow_value", "baseflow_value"]
        rows = resample(rows, period, measures, lookups.defaults_for(constituent, agg)[1])
    return rows.withColumnsRenamed(
        {"value": "observed", "flow_value": "observed_flow", "baseflow_value": "observed_baseflow"}
    ).filter(F.col("observed").isNotNull())


def station_data(obs: DataFrame, station: str, origin: str) -> DataFrame:
    """All observations of a station (Q3)."""
    return obs.filter((F.col("station_id") == station) & (F.col("station_origin") == origin))


def raw_data(lab_staging: DataFrame, sensor_staging: DataFrame, station: str, origin: str) -> DataFrame:
    """Staging rows of a station (Q4)."""
    if origin.lower() == lookups.LAB_ORIGIN:
        return lab_staging.filter(F.col("SYS_LOC_CODE") == station)
    if origin.lower() == lookups.SENSOR_ORIGIN:
        return sensor_staging.filter(F.col("station_no") == station)
    raise ValueError(f"Station origin {origin} not recognized.")


def outlets_of_model(pairs: DataFrame, model: str) -> DataFrame:
    """Station-reach pairs of a model in outlet order (Q5)."""
    return outlets.pairs_by_model(pairs, model).orderBy(*PAIR_ORDER)


def station_summary(obs: DataFrame, constituent: str | None = None) -> DataFrame:
    """Station report (Q6); the constituent filter runs before the aggregate."""
    rows = obs if constituent is None else obs.filter(F.col("constituent") == constituent)
    return views.constituent_summary(rows).orderBy("station_id", "station_origin", "constituent")


def outlet_summary(outlet_obs: DataFrame) -> DataFrame:
    """Outlet report (Q7)."""
    return views.outlet_constituent_summary(outlet_obs).orderBy("outlet_id", "constituent")


def qc_counts(sensor_staging: DataFrame, quality: DataFrame) -> DataFrame:
    """Quality-code report (Q7)."""
    return views.qc_counts(sensor_staging, quality).orderBy("station_no", "parametertype_name", "Quality Code", "Text", "Description")


def station_reach_pairs(pairs: DataFrame) -> DataFrame:
    """Station-reach report (Q7)."""
    return pairs.orderBy(*PAIR_ORDER)
