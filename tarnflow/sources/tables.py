"""Tabular inputs with fixed schemas."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tarnflow import lookups, schemas
from tarnflow.functions.measures import without_nan
from tarnflow.functions.timing import NTZ
from tarnflow.operators.outlets import Outlets
from tarnflow.operators.views import stack


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.options(header=True).csv(path)
    return reader.format(fmt).load(path)


def clean_lab(df: DataFrame) -> DataFrame:
    """Laboratory rows in the declared columns, NaN results as NULL."""
    return schemas.conform(df, schemas.LAB).withColumn("RESULT_NUMERIC", without_nan(F.col("RESULT_NUMERIC")))


def type_sensor(df: DataFrame) -> DataFrame:
    """Time text -> zone-free time (an offset in the text is dropped), NaN values -> NULL."""
    time = F.col("Timestamp")
    if isinstance(df.schema["Timestamp"].dataType, T.StringType):
        time = F.to_timestamp_ntz(time)
    return df.withColumns({"Timestamp": time.cast(NTZ), "Value": without_nan(F.col("Value"))})


def read_lab_staging(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Laboratory results."""
    return clean_lab(_read(spark, path, fmt, schemas.LAB))


def read_sensor_staging(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Sensor rows with a real time column."""
    return type_sensor(_read(spark, path, fmt, schemas.SENSOR))


def load_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV with a header and inferred types (S3); ``options`` go to Spark's reader."""
    return spark.read.options(**{"header": True, "inferSchema": True, **options}).csv(path)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet as it is."""
    return spark.read.parquet(path)


def read_station_registry(sensor: DataFrame, lab: DataFrame) -> DataFrame:
    """Sensor and laboratory station tables as one registry.

    ``row_order`` is each row's place in its files. It is carried from the read: tables that were joined or
    shuffled since must have got it before, from :func:`with_row_order`, and tables straight from files
    get it here. Any other table is an error, since its first rows could not be told.
    """
    shared = ["station_id", "true_opnid", "opnids", "comments", "modeled", "repo_name"]
    schema = T.StructType([*schemas.REGISTRY.fields, T.StructField("row_order", ROW_ORDER)])
    sensor, lab = (df if "row_order" in df.columns else with_row_order(df) for df in (sensor, lab))
    sensor = sensor.select(*shared, "wplmn_flag", F.lit(lookups.SENSOR_ORIGIN).alias("source"), "row_order")
    lab = lab.select(*shared, F.lit(0).alias("wplmn_flag"), F.lit(lookups.LAB_ORIGIN).alias("source"), "row_order")
    return stack([schemas.conform(sensor, schema), schemas.conform(lab, schema)])


#: The name of a step at the start of a line of a plan.
_STEP = re.compile(r"[\s:+-]*([A-Z]\w+)")
ROW_ORDER = T.StructType().add("file", "string").add("block", "long").add("row", "long")


def with_row_order(df: DataFrame) -> DataFrame:
    """A table just read from files with each row's place: file, block of the file, running number inside.

    Compares as the files are read. ValueError for a table that isn't read from one set of files, or that has
    been joined, sorted or dealt out since: the running number would be that of its new partitions.
    """
    steps = {step[1] for step in map(_STEP.match, df._jdf.queryExecution().analyzed().toString().splitlines()) if step}
    if not steps <= {"Project", "Filter", "Relation", "SubqueryAlias"}:
        raise ValueError(f"row order is known only where a table is read from files: take it there, with with_row_order ({', '.join(sorted(steps))})")
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    place = F.struct(file.alias("file"), block.cast("bigint").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.withColumn("row_order", place)


def read_xref(spark: SparkSession, path: str) -> DataFrame:
    """Station cross-reference CSV with at least the four known columns, in any order."""
    return schemas.conform(spark.read.options(header=True).csv(path), schemas.XREF)


def read_quality_codes(spark: SparkSession, path: str) -> DataFrame:
    """Quality-code CSV with texts and descriptions."""
    return spark.read.schema(schemas.QUALITY).options(header=True, escape='"', multiLine=True).csv(path)


def read_parameter_map(spark: SparkSession, path: str) -> DataFrame:
    """Parameter-text CSV -> one constituent per text, the last line of the file deciding (P10).

    The position inside the file orders the lines; the file is read as one unsplit piece.
    """
    columns = "CAS_RN string, CHEMICAL_NAME string, PARAMETER string, constituent string"
    lines = spark.read.schema(columns).options(header=True, escape='"', multiLine=True).csv(path)
    numbered = lines.select(
        F.col("PARAMETER").alias("parameter"), "constituent", F.monotonically_increasing_id().alias("ordinal")
    )
    return lookups.last_listed(numbered, "parameter", "constituent", "ordinal")


def load_lookups(spark: SparkSession, xref_path: str | None = None, quality_path: str | None = None) -> dict[str, DataFrame]:
    """The lookup tables by name (S10); a table without a file is left out or built in."""
    tables = {
        "wiski_parametertype": lookups.parameter_types(spark),
        "equis_casrn": lookups.lab_analytes(spark),
        "wiski_quality_codes": (
            read_quality_codes(spark, quality_path) if quality_path else lookups.quality_codes(spark)
        ),
    }
    if xref_path:
        tables["station_xref"] = read_xref(spark, xref_path)
    return tables


def import_outlets(spark: SparkSession, root: str) -> Outlets:
    """Outlet tables kept elsewhere as Parquet folders."""
    return Outlets(
        schemas.conform(spark.read.parquet(f"{root}/outlet_groups"), schemas.OUTLET_GROUPS),
        schemas.conform(spark.read.parquet(f"{root}/outlet_stations"), schemas.OUTLET_STATIONS),
        schemas.conform(spark.read.parquet(f"{root}/outlet_reaches"), schemas.OUTLET_REACHES),
    )
