"""Row selection."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from tarnflow import lookups
from tarnflow.functions import codes, timing


def quality_filter(df: DataFrame, accepted: Iterable[int] | None = None, column: str = "quality_code") -> DataFrame:
    """Keep rows with an accepted quality code (F1)."""
    wanted = lookups.ACCEPTED_QUALITY if accepted is None else tuple(accepted)
    return df.filter(F.col(f"`{column}`").isin(*wanted))


def year_filter(df: DataFrame, start: int | None = 1996, end: int | None = None, column: str = "datetime") -> DataFrame:
    """Keep rows inside the inclusive years; rows without a time go (F2)."""
    return df.filter(timing.years_between(F.col(column), start, end))


def rounded_year_filter(df: DataFrame, start: int | None = 1996, end: int | None = None, column: str = "datetime") -> DataFrame:
    """F2 on the rounded hour, asked of the time before rounding.

    A year begins at an even hour, so 23:30 still rounds into it: its rows are those half an hour
    earlier. Asking the unrounded time keeps the rounding out of the pushed-down condition.
    """
    return df.filter(timing.years_between(F.col(column), start, end, lead="30 minutes"))


def lab_extract_filter(
    df: DataFrame, stations: Iterable[str] | None = None, location_type: str = "LOC_TYPE"
) -> DataFrame:
    """Rows wanted from the laboratory store."""
    kept = (
        F.col("CAS_RN").isin(*lookups.LAB_EXTRACT_ANALYTES)
        & (F.col(location_type) == lookups.LAB_LOCATION_TYPE)
        & (F.col("APPROVAL_CODE") == "Final")
        & (F.col("REPORTABLE_RESULT") == "Y")
        & F.col("FACILITY_ID").isin(*lookups.LAB_FACILITIES)
        & F.col("SAMPLE_METHOD").isin(*lookups.LAB_SAMPLE_METHODS)
    )
    if stations is not None:
        kept = kept & F.col("SYS_LOC_CODE").isin(*stations)
    return df.filter(kept)


def supported_parameters(df: DataFrame, texts: DataFrame) -> DataFrame:
    """Portal rows whose parameter text is known (F4). ``texts`` is the fixed parameter map."""
    return df.join(texts.select("parameter"), "parameter", "left_semi")


def after_1996(df: DataFrame, column: str = "datetime") -> DataFrame:
    """Strictly after the first moment of 1996."""
    return df.filter(F.col(column) > timing.year_start(1996))


def drop_incomplete_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows with a NULL key take no part in grouping (F6); one condition per key, so each can be pushed down."""
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def hydrologic_unit_filter(df: DataFrame, prefix: str, column: str = "stn_HUC12") -> DataFrame:
    """Stations whose hydrologic unit code starts with the prefix."""
    return df.filter(F.col(column).startswith(prefix))


def preferred_series(df: DataFrame) -> DataFrame:
    """Per station and constituent the unit-value series if there is one, else the daily series (F8).

    The choice is made on the table of different series, a map-side combined aggregate of a few
    rows a station; the rows are then kept by a semi-join with the series chosen.
    """
    names = lookups.series_resolutions(df.sparkSession)
    keys = ["station_no", "constituent"]
    series = df.select(*keys, "ts_name").distinct().withColumn("external", codes.is_external(F.col("station_no")))
    ranked = series.join(names, ["constituent", "external", "ts_name"])
    best = ranked.groupBy(*keys).agg(F.min("resolution").alias("resolution"))
    chosen = ranked.join(best, [*keys, "resolution"]).select(*keys, "ts_name")
    return df.join(chosen, [*keys, "ts_name"], "left_semi").select(*df.columns)


def series_coverage(df: DataFrame, time: str = "datetime") -> DataFrame:
    """First and last year held per series."""
    return df.groupBy("ts_id").agg(F.year(F.min(time)).alias("first_year"), F.year(F.max(time)).alias("last_year"))


def clip_to_coverage(requests: DataFrame, coverage: DataFrame) -> DataFrame:
    """Narrow requested years per series to what the series holds.

    ``coverage`` gives ``first_year``/``last_year`` per ``ts_id``; NULL means not stated. Series
    with nothing left are dropped. Both inputs are one row per series.
    """
    clipped = (
        requests.join(coverage, "ts_id", "left")
        .withColumn("start_year", F.greatest("start_year", "first_year"))
        .withColumn("end_year", F.least("end_year", "last_year"))
    )
    return clipped.filter(F.col("start_year") <= F.col("end_year")).drop("first_year", "last_year")


def parameter_scope(df: DataFrame, constituent: str | None = None, load_network: bool = False) -> DataFrame:
    """Sensor rows whose parameter number belongs to the constituent, or to any of them."""
    scope = lookups.PARAMETER_SCOPE_LOAD if load_network else lookups.PARAMETER_SCOPE
    if constituent is None:
        patterns = tuple(p for group in scope.values() for p in group)
    elif constituent in lookups.CONSTITUENTS:
        patterns = scope.get(constituent, ())
    else:
        raise ValueError(f"Invalid constituent: {constituent}; known: {', '.join(lookups.CONSTITUENTS)}")
    return df.filter(codes.matches(F.col("stationparameter_no"), patterns))


def load_network_series(df: DataFrame) -> DataFrame:
    """Daily-mean series of the load-network parameter numbers (X8's selection)."""
    return df.filter(
        F.col("stationparameter_no").isin(*lookups.LOAD_PARAMETERS) & (F.col("ts_name") == lookups.LOAD_SERIES)
    )
