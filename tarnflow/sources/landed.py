"""Landed answers of the web services: JSON documents and gauge CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tarnflow import schemas

# Metadata fields of a series record.
SERIES_FIELDS = (
    "ts_unitsymbol", "ts_name", "ts_id", "station_no", "station_name", "station_latitude",
    "station_longitude", "parametertype_id", "parametertype_name", "stationparameter_no",
    "stationparameter_name",
)
VALUE_FIELDS = ("Timestamp", "Value", "Quality Code", "Quality Code Name")

_CELLS = T.ArrayType(T.ArrayType(T.StringType()))


def _cell(row: Column, names: Column, wanted: str) -> Column:
    """The cell under a column name, NULL when the document has no such column."""
    place = F.array_position(names, wanted).cast("int")
    return F.when(place > 0, F.get(row, place - 1))


def parse_series_json(df: DataFrame, body: str = "body") -> DataFrame:
    """Series documents -> one row per value with the series metadata on it.

    A document is a list of records; ``columns`` names the cells of every row of ``data``, in any
    order. The result has the sensor staging columns except the load-network flag.
    """
    record = T.StructType([T.StructField("columns", T.StringType()), T.StructField("data", _CELLS)])
    for field in SERIES_FIELDS:
        record = record.add(field, T.StringType())
    records = df.select(F.explode(F.from_json(body, T.ArrayType(record))).alias("r"))
    rows = records.select(
        F.split("r.columns", ",").alias("names"), *[F.col(f"r.{f}") for f in SERIES_FIELDS],
        F.explode("r.data").alias("row"),
    )
    row, names = F.col("row"), F.col("names")
    kinds = {f.name: f.dataType for f in schemas.SENSOR}
    return rows.select(
        *[_cell(row, names, f).cast(kinds[f]).alias(f) for f in VALUE_FIELDS], *SERIES_FIELDS
    )


def parse_table_json(df: DataFrame, columns: list[str], body: str = "body") -> DataFrame:
    """Table documents, a header row and data rows, -> the named columns as text."""
    tables = df.select(F.from_json(body, _CELLS).alias("t"))
    rows = tables.select(
        F.col("t")[0].alias("names"), F.explode(F.expr("slice(t, 2, greatest(size(t) - 1, 0))")).alias("row")
    )
    return rows.select(*[_cell(F.col("row"), F.col("names"), c).alias(c) for c in columns])


def parse_portal_json(df: DataFrame, body: str = "body") -> DataFrame:
    """Portal documents, ``{"data": [...]}``, with ``station_id`` beside them -> result rows."""
    document = T.StructType([T.StructField("data", T.ArrayType(schemas.PORTAL))])
    parsed = df.select("station_id", F.from_json(body, document).alias("d"))
    return parsed.select("station_id", F.explode("d.data").alias("r")).select("r.*", "station_id")


def read_portal_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Portal JSON files (S7): the station is the folder (``station_id=...``) or else the name of the file.

    A file is one document, which one task holds whole, or with ``lines`` one result row a line: such files
    are split between tasks, so that a station's file may have any size.
    """
    if lines:
        rows = spark.read.json(path, schema=schemas.PORTAL)
        return rows.select(*schemas.PORTAL.fieldNames(), _station(rows, ".json").alias("station_id"))
    files = spark.read.text(path, wholetext=True)
    return parse_portal_json(files.select(F.col("value").alias("body"), _station(files, ".json").alias("station_id")))


def read_gauge_csv(spark: SparkSession, path: str) -> DataFrame:
    """Unpacked gauge CSV files with one header.

    The station is the folder (``station_id=...``) or else the name of the file.
    """
    rows = spark.read.options(header=True).csv(path)
    station = _station(rows, ".csv")
    return rows.select("tstamp", "var_name", F.col("value").cast("double").alias("value"), station.alias("station_id"))


def _station(rows: DataFrame, ending: str) -> Column:
    """The folder's station, else the file's name without its ending."""
    if "station_id" in rows.columns:
        return F.col("station_id")
    return F.regexp_replace(F.col("_metadata.file_name"), ending.replace(".", r"\.") + "$", "")
