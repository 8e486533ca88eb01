"""Warehouse: Parquet folders under one root, temp views on top.

Station tables are partitioned by ``station_bucket``, a hash of the station's name, so that a
question about a station reads one bucket and replacing a station rewrites one bucket. Writers are
rebalanced by bucket with the adaptive planner splitting a bucket that has grown too big for one
task. Every write makes a new version folder, and a load shows in all its tables at once, see
:mod:`tarnflow.plans.versions`. A bucket spread over too many versions is written together again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tarnflow import lookups, schemas
from tarnflow.operators import outlets as outlet_ops, sensor, views
from tarnflow.operators.baseflow import baseflow
from tarnflow.operators.filters import quality_filter
from tarnflow.operators.outlets import Outlets
from tarnflow.plans import pipelines, query
from tarnflow.plans.versions import Change, States
from tarnflow.sources.tables import clean_lab, load_lookups, type_sensor

BUCKET = "station_bucket"
#: Versions a bucket may lie in before it is written together.
MOST_VERSIONS = 8


class Table(NamedTuple):
    schema: T.StructType
    station: str | None = None


TABLES = {
    "staging.equis": Table(schemas.LAB, "SYS_LOC_CODE"),
    "staging.wiski": Table(schemas.SENSOR, "station_no"),
    "analytics.equis": Table(schemas.OBSERVATION, "station_id"),
    "analytics.wiski": Table(schemas.OBSERVATION, "station_id"),
    "outlets.outlet_groups": Table(schemas.OUTLET_GROUPS),
    "outlets.outlet_stations": Table(schemas.OUTLET_STATIONS),
    "outlets.outlet_reaches": Table(schemas.OUTLET_REACHES),
}


OBSERVATION_VIEWS = (
    "analytics_observations", "analytics_outlet_observations", "analytics_outlet_observations_with_flow",
    "reports_constituent_summary", "reports_outlet_constituent_summary",
)


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", mode: str = "error") -> None:
    """Parquet folder (K5)."""
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "error", **options) -> None:
    """CSV folder (K6)."""
    df.write.mode(mode).options(header=header, sep=sep, **options).csv(path)


def replace_station_rows(
    existing: DataFrame, incoming: DataFrame, stations: Iterable[str], column: str = "station_id", origin: str | None = None
) -> DataFrame:
    """Existing rows without these stations (of this origin, where the table has one), then the incoming ones (K4)."""
    gone = F.col(column).isin(*stations) if stations else F.lit(False)
    if origin is not None and "station_origin" in existing.columns:
        gone = gone & (F.col("station_origin") == origin)
    return existing.filter(~F.coalesce(gone, F.lit(False))).unionByName(incoming.select(*existing.columns))


class Warehouse:
    """Tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """Open or start a warehouse. ``buckets`` (64 if not given) is stored with it when it is started;
        an existing one is opened with its own number, and any other is refused.
        """
        self.spark, self.root = spark, root.rstrip("/")
        self.states = States(spark, self.root)
        held = self.states.latest()[1].get("buckets")
        if None not in (held, buckets) and held != buckets:
            raise ValueError(f"{root} is kept in {held} buckets, not {buckets}")
        self.buckets = held or buckets or 64
        if held is None:
            self.states.publish(0, {"buckets": self.buckets, "tables": {}})

    # ---- Tables ---------------------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _bucket(self, station) -> F.Column:
        return F.pmod(F.hash(station), F.lit(self.buckets))

    def exists(self, name: str) -> bool:
        return name in self.states.latest()[1]["tables"] or (name not in TABLES and self.states.files().exists(self.states.path(name.replace(".", "/"))))

    def validate(self, expected: Iterable[str] = tuple(TABLES)) -> None:
        """Error naming the tables that are missing (V2)."""
        missing = [name for name in expected if not self.exists(name)]
        if missing:
            raise ValueError(f"Missing tables: {', '.join(missing)}")

    def _own_columns(self, name: str) -> bool:
        """Whether a table has its own columns, not those of a staging table promoted to its place."""
        return self.states.latest()[1]["tables"].get(name, {"kind": name})["kind"] == name

    def read(self, name: str, stations: Iterable[str] | None = None, with_bucket: bool = False) -> DataFrame:
        """A table, or its rows of some stations (reading only their buckets)."""
        if name not in TABLES:
            return self.spark.read.parquet(self.path(name))
        held = self.states.latest()[1]["tables"].get(name)
        if held is None:
            raise ValueError(f"Missing tables: {name}")
        table, rows = TABLES[held["kind"]], self._rows(name, held["kind"], held["versions"])
        if table.station is None:
            return rows
        if stations is not None:
            stations = list(stations)
            buckets = [self._bucket(F.lit(s)) for s in stations]
            rows = rows.filter(F.col(BUCKET).isin(*buckets) & F.col(table.station).isin(*stations))
        return rows if with_bucket else rows.drop(BUCKET)

    def _rows(self, name: str, kind: str, versions: dict[str, dict]) -> DataFrame:
        """Rows of version folders, with the bucket if the table has one."""
        table = TABLES[kind]
        fields = table.schema.fields + ([T.StructField(BUCKET, T.IntegerType())] if table.station else [])
        if not versions:
            return self.spark.createDataFrame([], T.StructType(fields))
        owners: dict[str, dict[str, dict]] = {}
        for v, held in versions.items():
            owners.setdefault(held.get("of", name), {})[v] = held
        return reduce(DataFrame.unionByName, [self._owned(owner, fields, held) for owner, held in owners.items()])

    def _owned(self, owner: str, fields: list[T.StructField], versions: dict[str, dict]) -> DataFrame:
        """Rows of version folders that lie in the folder of one table."""
        stored = T.StructType(fields + [T.StructField("version", T.StringType())])
        paths = [f"{self.path(owner)}/version={v}" for v in versions]
        rows = self.spark.read.schema(stored).option("basePath", self.path(owner)).parquet(*paths)
        if not all(held["whole"] for held in versions.values()):
            counts = [F.col("version").isin(*[v for v, held in versions.items() if held["whole"]])]
            counts += [(F.col("version") == v) & F.col(BUCKET).isin(*held["buckets"]) for v, held in versions.items() if not held["whole"]]
            rows = rows.filter(reduce(lambda a, b: a | b, counts))
        return rows.drop("version")

    def _stage(self, name: str, kind: str, df: DataFrame) -> tuple[str, list[int] | None]:
        """Rows into a new version folder, which no state names yet: its name and its buckets."""
        table, version = TABLES[kind], "v" + uuid.uuid4().hex
        rows, folder = schemas.conform(df, table.schema), f"{self.path(name)}/version={version}"
        if table.station is None:
            rows.write.parquet(folder)
            return version, None
        spread = rows.withColumn(BUCKET, self._bucket(F.col(table.station))).hint("rebalance", BUCKET)
        spread.write.partitionBy(BUCKET).parquet(folder)
        made = self.states.listed(folder.removeprefix(f"{self.root}/"))
        return version, [int(n.partition("=")[2]) for n in made if n.startswith(f"{BUCKET}=")]

    def _add(self, change: Change, name: str, df: DataFrame) -> DataFrame:
        """Rows after those a table holds; buckets in too many versions are written together. Returns the rows as written."""
        if name not in change.tables:
            change.replace(name, name)
        kind = change.tables[name]["kind"]
        version, buckets = self._stage(name, kind, df)
        change.add(name, version, buckets)
        added = self._rows(name, kind, {version: {"buckets": buckets, "whole": True}})
        if TABLES[kind].station is None:
            return added
        spread: dict[int, int] = {}
        for held in change.versions(name).values():
            for bucket in held["buckets"]:
                spread[bucket] = spread.get(bucket, 0) + 1
        wide = {bucket for bucket, n in spread.items() if n > MOST_VERSIONS}
        if wide:
            rows = self._rows(name, kind, change.versions(name)).filter(F.col(BUCKET).isin(*sorted(wide)))
            together = self._stage(name, kind, rows.drop(BUCKET))
            change.without(name, wide)
            change.add(name, *together)
        return added.drop(BUCKET)

    def _replace_stations(self, change: Change, name: str, df: DataFrame, stations: list[str]) -> DataFrame:
        """The buckets of these stations are written without them, then ``df`` is added. Returns its rows as written."""
        if name not in change.tables:
            change.replace(name, name)
        kind = change.tables[name]["kind"]
        if stations:
            touched = self.spark.range(1).select(F.explode(F.array(*[self._bucket(F.lit(s)) for s in stations])).alias("b")).distinct()
            buckets = {r[0] for r in touched.collect()}
            held = self._rows(name, kind, change.versions(name)).filter(F.col(BUCKET).isin(*sorted(buckets))).drop(BUCKET)
            left = self._stage(name, kind, replace_station_rows(held, held.limit(0), stations, TABLES[kind].station))
            change.without(name, buckets)
            change.add(name, *left)
        return self._add(change, name, df)

    def append(self, name: str, df: DataFrame) -> None:
        """Rows in the table's own columns and order (K1)."""
        change = Change(self.states)
        self._add(change, name, df)
        change.publish()

    def replace(self, name: str, df: DataFrame, kind: str | None = None) -> None:
        """The whole table (K2), which ``df`` may read. With ``kind``, in the columns of that table."""
        change = Change(self.states)
        made = self._stage(name, kind or name, df)
        change.replace(name, kind or name)
        change.add(name, *made)
        change.publish()

    def promote(self, staging: str, target: str) -> None:
        """A staging table copied as it is under another name, columns included (K3).

        A table of the warehouse then has the staging table's columns until it is replaced. Version folders never
        change, so the copy names those of the staging table; what becomes of either table later leaves the other as it is.
        """
        if target in TABLES and staging in TABLES:
            self.read(staging)  # an error if it is missing
            change = Change(self.states)
            change.copy(staging, target)
            change.publish()
        elif target in TABLES:
            self.replace(target, self.read(staging), staging)
        else:
            self.read(staging).write.mode("overwrite").parquet(self.path(target))

    def replace_stations(self, name: str, df: DataFrame, stations: Iterable[str]) -> None:
        """Drop these stations' rows, then add ``df`` (K4), in one step.

        Only the buckets of these stations are read and written again; other stations in them stay.
        """
        change = Change(self.states)
        self._replace_stations(change, name, df, list(stations))
        change.publish()

    def vacuum(self) -> list[str]:
        """Delete version folders and states that the newest state does not name; returns the versions deleted.

        Not to be run beside a load or a reader of an earlier state.
        """
        number, content = self.states.latest()
        named = {(held.get("of", name), v) for name, table in content["tables"].items() for v, held in table["versions"].items()}
        gone = []
        for name in TABLES:
            folder = name.replace(".", "/")
            for version in self.states.listed(folder):
                if (name, version.removeprefix("version=")) not in named:
                    self.states.remove(f"{folder}/{version}")
                    gone.append(f"{name}/{version}")
        for old in self.states.numbers():
            if old < number:
                self.states.remove(f"_states/{old:012d}.json")
        return gone

    def template(self, name: str) -> DataFrame:
        """No rows in a table's columns (K8)."""
        return self.spark.createDataFrame([], TABLES[name].schema)

    # ---- Set-up and processing ------------------------------------------------------------

    def init(
        self,
        registry: DataFrame | None = None,
        model: str | None = None,
        xref_path: str | None = None,
        quality_path: str | None = None,
        reset: bool = False,
    ) -> "Warehouse":
        """Lookups, outlets and empty tables (X7). Existing tables stay unless ``reset``."""
        for name, table in load_lookups(self.spark, xref_path, quality_path).items():
            table.write.mode("overwrite").parquet(self.path(f"mappings.{name}"))
        change = Change(self.states)
        for name in TABLES:
            if reset or name not in change.tables:
                change.replace(name, name)
        change.publish()
        if registry is not None:
            self.load_outlets(outlet_ops.build_outlets(outlet_ops.assign_outlets(registry), model))
        self.refresh_views()
        return self

    def load_outlets(self, tables: Outlets) -> None:
        """Outlet tables into the warehouse (S11's target); broken constraints are an error."""
        problems = outlet_ops.validate_outlets(tables)
        counts = problems.groupBy("table_name", "rule").agg(F.count("*").alias("n_keys"), F.sum("n_rows").alias("n_rows"))
        broken = [tuple(r) for r in counts.orderBy("table_name", "rule").collect()]  # a row per table and rule
        if broken:
            problems.write.mode("overwrite").parquet(self.path("outlets.broken"))
            raise ValueError(f"Outlet tables break constraints, listed in {self.path('outlets.broken')}: {broken}")
        change = Change(self.states)
        for part, df in zip(Outlets._fields, tables):
            name = f"outlets.outlet_{part}"
            made = self._stage(name, name, df)
            change.replace(name, name)
            change.add(name, *made)
        change.publish()

    def process_sensor(
        self, filter_quality: bool = True, accepted: Iterable[int] | None = None, **baseflow_options
    ) -> None:
        """Staging -> hourly observations -> baseflow.

        The hourly rows are written first and baseflow reads its flow rows back, so staging is scanned
        once; both show together.
        """
        name, change = "analytics.wiski", Change(self.states)
        staged = type_sensor(self.read("staging.wiski"))
        hourly = self._stage(name, name, pipelines.sensor_hourly(staged, filter_quality, accepted))
        change.replace(name, name)
        change.add(name, *hourly)
        flow = self._rows(name, name, change.versions(name)).drop(BUCKET).filter(F.col("constituent") == views.FLOW)
        change.add(name, *self._stage(name, name, baseflow(flow, origin=lookups.SENSOR_ORIGIN, **baseflow_options)))
        change.publish()
        self.refresh_views()

    def process_lab(self) -> None:
        """Staging -> hourly observations."""
        self.replace("analytics.equis", pipelines.lab_transform(clean_lab(self.read("staging.equis"))))
        self.refresh_views()

    def process_all(self, **options) -> None:
        """Both of the above."""
        self.process_sensor(**options)
        self.process_lab()

    def _load(
        self, source: str, raw: DataFrame, done: DataFrame | Callable[[DataFrame], DataFrame], stations: list[str], overwrite: bool
    ) -> None:
        """Staging and analytics in one step: a load that fails anywhere leaves both as they were.

        ``done`` are the observations, or makes them of the staged rows of the batch, which are then read back in the
        columns it needs; ``raw`` is computed once.
        """
        change = Change(self.states)

        def put(name: str, rows: DataFrame) -> DataFrame:
            return self._replace_stations(change, name, rows, stations) if overwrite else self._add(change, name, rows)

        staged = put(f"staging.{source}", raw)
        put(f"analytics.{source}", done(staged) if callable(done) else done)
        change.publish()
        self.refresh_views()

    def load_sensor(self, raw: DataFrame, stations: Iterable[str], overwrite: bool = True, **options) -> None:
        """A landed batch of sensor rows into staging and analytics."""
        stations = list(stations)
        for station in stations:
            if not isinstance(station, str):
                raise ValueError(f"Station {station} is not a string")
        if raw.isEmpty():
            return
        self._load("wiski", raw, lambda staged: pipelines.sensor_transform(type_sensor(staged), **options), stations, overwrite)

    def load_lab(self, raw: DataFrame, stations: Iterable[str], overwrite: bool = True) -> None:
        """A landed batch of laboratory rows into staging and analytics."""
        if raw.isEmpty():
            return
        self._load("equis", raw, lambda staged: pipelines.lab_transform(clean_lab(staged)), list(stations), overwrite)

    # ---- Views and questions --------------------------------------------------------------

    def observations(self, stations: Iterable[str] | None = None) -> DataFrame:
        return views.observations(self.read("analytics.equis", stations), self.read("analytics.wiski", stations))

    def observations_of_outlet(self, outlet: int) -> DataFrame:
        """A4 of one outlet. The bucket is joined on as well, so that only its stations' buckets are read."""
        stations = self.read("outlets.outlet_stations").filter(F.col("outlet_id") == outlet)
        stations = stations.withColumn(BUCKET, self._bucket(F.col("station_id")))
        columns = [*schemas.OBSERVATION.fieldNames(), BUCKET]
        lab, wiski = (self.read(f"analytics.{name}", with_bucket=True).select(*columns) for name in ("equis", "wiski"))
        return views.outlet_observations(lab.unionByName(wiski), stations, (BUCKET, *views.STATION_KEYS))

    def outlet_observations(self) -> DataFrame:
        return views.outlet_observations(self.observations(), self.read("outlets.outlet_stations"))

    def sensor_filtered(self, accepted: Iterable[int] | None = None) -> DataFrame:
        """Staged sensor rows, normalised, with an accepted quality code (F1)."""
        rows = sensor.normalize(type_sensor(self.read("staging.wiski")))
        return quality_filter(rows, accepted) if accepted is not None else quality_filter(rows)

    def sensor_hourly_view(self) -> DataFrame:
        """Means per started hour of all staged sensor rows, normalised."""
        return sensor.hourly_bucket(sensor.normalize(type_sensor(self.read("staging.wiski"))))

    def pairs(self) -> DataFrame:
        return outlet_ops.station_reach_pairs(
            self.read("outlets.outlet_stations"), self.read("outlets.outlet_reaches")
        )

    def views(self) -> dict[str, DataFrame]:
        """All views that the tables allow: those over observations need tables with the columns of observations."""
        found = {
            "outlets_station_reach_pairs": self.pairs(),
            "reports_wiski_qc_count": views.qc_counts(
                self.read("staging.wiski"), self.read("mappings.wiski_quality_codes")
            ),
            "analytics_wiski_hourly": self.sensor_hourly_view(),
            "analytics_wiski_filtered": self.sensor_filtered(),
        }
        if self._own_columns("analytics.equis") and self._own_columns("analytics.wiski"):
            obs, outlet_obs = self.observations(), self.outlet_observations()
            found |= {
                "analytics_observations": obs,
                "analytics_outlet_observations": outlet_obs,
                "analytics_outlet_observations_with_flow": views.with_flow(outlet_obs),
                "reports_constituent_summary": views.constituent_summary(obs),
                "reports_outlet_constituent_summary": views.outlet_constituent_summary(outlet_obs),
            }
        return found

    def refresh_views(self) -> None:
        """Register all analytics and report views for SQL; nothing is computed (K9).

        A view that a promoted table leaves without its columns is dropped until the table is replaced.
        """
        found = self.views()
        for name in OBSERVATION_VIEWS:
            if name not in found:
                self.spark.catalog.dropTempView(name)
        for name, df in found.items():
            df.createOrReplaceTempView(name)

    def observation_data(self, stations: Iterable[str], constituent: str, period: str | None = None, agg: str | None = None) -> DataFrame:
        stations = list(stations)
        return query.observation_data(self.observations(stations), stations, constituent, period, agg)

    def outlet_data(self, outlet: int, constituent: str, period: str | None = "D", agg: str | None = None) -> DataFrame:
        return query.outlet_data(views.with_flow(self.observations_of_outlet(outlet)), outlet, constituent, period, agg)

    def station_data(self, station: str, origin: str) -> DataFrame:
        return query.station_data(self.observations([station]), station, origin)

    def raw_data(self, station: str, origin: str) -> DataFrame:
        return query.raw_data(
            self.read("staging.equis", [station]), self.read("staging.wiski", [station]), station, origin
        )

    def outlets(self, model: str) -> DataFrame:
        return query.outlets_of_model(self.pairs(), model)

    def station_ids(self, origin: str | None = None) -> DataFrame:
        return views.station_ids(self.observations(), origin)

    def constituent_counts(self) -> DataFrame:
        return views.constituent_counts(self.observations())

    def station_summary(self, constituent: str | None = None) -> DataFrame:
        return query.station_summary(self.observations(), constituent)

    def outlet_summary(self) -> DataFrame:
        return query.outlet_summary(self.outlet_observations())

    def qc_counts(self) -> DataFrame:
        return query.qc_counts(self.read("staging.wiski"), self.read("mappings.wiski_quality_codes"))

    def station_reach_pairs(self) -> DataFrame:
        return query.station_reach_pairs(self.pairs())

    def export_station(self, station: str, origin: str, path: str) -> None:
        """A station's observations as CSV (K7)."""
        write_csv(self.station_data(station, origin), path)

    def export_raw(self, station: str, origin: str, path: str) -> None:
        """A station's staging rows as CSV (K7)."""
        write_csv(self.raw_data(station, origin), path)
