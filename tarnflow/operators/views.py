"""Analytics and report views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tarnflow import schemas

FLOW, BASEFLOW = "Q", "QB"


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def observations(lab: DataFrame, sensor: DataFrame) -> DataFrame:
    """All observations of both origins."""
    columns = schemas.OBSERVATION.fieldNames()
    return lab.select(*columns).unionByName(sensor.select(*columns))


def append_derived(df: DataFrame, derived: DataFrame) -> DataFrame:
    """Derived rows after the measured ones, in the measured columns."""
    return df.unionByName(derived.select(*df.columns))


STATION_KEYS = ("station_id", "station_origin")


def outlet_join(obs: DataFrame, stations: DataFrame, keys: tuple[str, ...] = STATION_KEYS) -> DataFrame:
    """Observations with the outlet of their station (J3); ``keys`` may add a column both are stored by.

    No hint: the station table is broadcast when its measured size allows; otherwise the shuffled
    join has its hot stations split by the adaptive planner.
    """
    link = stations.filter(F.col("outlet_id").isNotNull()).select(*keys, "outlet_id")
    return obs.join(link, list(keys))


def outlet_observations(obs: DataFrame, stations: DataFrame, keys: tuple[str, ...] = STATION_KEYS) -> DataFrame:
    """Mean and count per outlet, constituent and time (A4).

    Rows are dealt out by outlet and time, which serves this aggregate and what comes after it alike:
    pairing with flow (J4) needs no other exchange. An outlet and time hold few rows, one per station and
    constituent, so there would be little to combine before the shuffle.
    """
    return (
        outlet_join(obs, stations, keys)
        .repartition("outlet_id", "datetime")
        .groupBy("datetime", "outlet_id", "constituent")
        .agg(F.avg("value").alias("value"), F.count("value").alias("count"))
    )


def with_flow(outlet_obs: DataFrame) -> DataFrame:
    """Each constituent row with flow and baseflow of the same outlet and time.

    One pass instead of a three-way join: after A4 an outlet and time hold one row per
    constituent, so the window groups stay small whatever the size of the outlet. Rows without a
    time match nothing; all those of an outlet would be one group, so they are spread by
    constituent, which leaves each of them alone.
    """
    timed = F.col("datetime").isNotNull()
    apart = F.when(~timed, F.col("constituent"))
    here = Window.partitionBy("outlet_id", "datetime", "_apart")

    def measured(code: str):
        return F.max(F.when(timed & (F.col("constituent") == code), F.col("value"))).over(here)

    return (
        outlet_obs.withColumn("_apart", apart)
        .withColumns({"flow_value": measured(FLOW), "baseflow_value": measured(BASEFLOW)})
        .filter(~F.col("constituent").isin(FLOW, BASEFLOW))
        .select("outlet_id", "constituent", "datetime", "value", "count", "flow_value", "baseflow_value")
    )


def _summary(df: DataFrame, keys: list[str], stats: bool = True) -> DataFrame:
    measures = [F.count("*").alias("sample_count")]
    if stats:
        measures += [
            F.avg("value").alias("average_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        ]
    measures += [F.year(F.min("datetime")).alias("start_date"), F.year(F.max("datetime")).alias("end_date")]
    return df.groupBy(*keys).agg(*measures)


def constituent_summary(obs: DataFrame) -> DataFrame:
    """Counts, statistics and years per station and constituent (A5)."""
    return _summary(obs, ["station_id", "station_origin", "constituent"])


def outlet_constituent_summary(outlet_obs: DataFrame) -> DataFrame:
    """The same per outlet and constituent."""
    return _summary(outlet_obs, ["outlet_id", "constituent"])


def constituent_counts(obs: DataFrame) -> DataFrame:
    """Counts and years per station and constituent, smallest count first, then by key."""
    keys = ["station_id", "station_origin", "constituent"]
    return _summary(obs, keys, stats=False).orderBy("sample_count", *keys)


def _active_codes(quality: DataFrame) -> DataFrame:
    return quality.filter(F.col("Active") == 1).select(
        F.col("quality_code").cast("bigint").alias("Quality Code"), "Text", "Description"
    )


def qc_describe(sensor: DataFrame, quality: DataFrame) -> DataFrame:
    """Sensor rows with the text of their active quality code (J6); other rows drop out.

    ``quality`` is the agency's code list; the optimizer broadcasts it by its measured size.
    """
    return sensor.join(_active_codes(quality), "Quality Code")


def qc_counts(sensor: DataFrame, quality: DataFrame) -> DataFrame:
    """Rows per station, parameter type and quality code.

    Rows are counted per code in one aggregate, and the groups described by the code list, whose repeated
    lines are counted there, so that no second aggregate of the groups is needed.
    """
    keys = ["station_no", "parametertype_name", "Quality Code"]
    counted = sensor.filter(F.col("Quality Code").isNotNull()).groupBy(*keys).agg(F.count("*").alias("_rows"))
    texts = _active_codes(quality).groupBy("Quality Code", "Text", "Description").agg(F.count("*").alias("_lines"))
    described = counted.join(texts, "Quality Code")
    return described.select(*keys, (F.col("_rows") * F.col("_lines")).alias("count"), "Text", "Description")


def station_ids(obs: DataFrame, origin: str | None = None) -> DataFrame:
    """Stations with observations (A13); without an origin one row per (station, origin)."""
    if origin is None:
        return obs.select("station_id", "station_origin").distinct()
    return obs.filter(F.col("station_origin") == origin).select("station_id").distinct()
