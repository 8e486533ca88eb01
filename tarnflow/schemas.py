"""Fixed schemas of the staging, analytics, outlet and lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_TYPES = {
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "time": T.TimestampNTZType(),
}


def _struct(text: str, required: tuple[str, ...] = ()) -> T.StructType:
    """``name type`` per comma; names may hold blanks, the type is the last word."""
    fields = []
    for item in text.split(","):
        name, kind = item.strip().rsplit(" ", 1)
        fields.append(T.StructField(name, _TYPES[kind], name not in required))
    return T.StructType(fields)


# Staging columns of laboratory results.
LAB = _struct("""
    LATITUDE double, LONGITUDE double, WID_LIST string, SAMPLE_METHOD string,
    SAMPLE_REMARK string, FACILITY_ID bigint, FACILITY_NAME string, FACILITY_TYPE string,
    SYS_LOC_CODE string, LOC_NAME string, LOC_TYPE string, LOC_TYPE_2 string,
    TASK_CODE string, SAMPLE_ID bigint, SYS_SAMPLE_CODE string, TEST_ID bigint,
    ANALYTE_TYPE string, ANALYTE_TYPE_DESC string, ANALYTIC_METHOD string,
    PREFERRED_NAME string, PARAMETER string, CAS_RN string, CHEMICAL_NAME string,
    GTLT string, RESULT_TEXT string, RESULT_NUMERIC double, RESULT_UNIT string,
    STAT_TYPE int, VALUE_TYPE string, DETECT_FLAG string, DETECT_DESC string,
    RESULT_REMARK string, RESULT_TYPE_CODE string, METHOD_DETECTION_LIMIT string,
    REPORTING_DETECTION_LIMIT string, QUANTITATION_LIMIT int, LAB_QUALIFIERS string,
    INTERPRETED_QUALIFIERS string, REPORTABLE_RESULT string, APPROVAL_CODE string,
    SENSITIVE_NOTPUBLIC string, TEST_TYPE string, DILUTION_FACTOR double, FRACTION string,
    BASIS string, TEMP_BASIS string, TEST_REMARK string, ANALYSIS_DATE_TIME time,
    ANALYSIS_DATE string, ANALYSIS_TIME string, ANALYSIS_DATE_TIMEZONE string,
    COMPANY_NAME string, LAB_NAME_CODE string, LAB_SAMPLE_ID string,
    SAMPLE_TYPE_GROUP string, SAMPLE_TYPE_CODE string, SAMPLE_TYPE_DESC string,
    MEDIUM_CODE string, MATRIX_CODE string, START_DEPTH double, DEPTH_UNIT string,
    SAMPLE_DATE_TIME time, SAMPLE_DATE string, SAMPLE_TIME string,
    SAMPLE_DATE_TIMEZONE string, EBATCH double
""")

# Staging columns of sensor series. The time is text as delivered.
SENSOR = _struct("""
    Timestamp string, Value double, Quality Code bigint, Quality Code Name string,
    ts_unitsymbol string, ts_name string, ts_id string, station_no string,
    station_name string, station_latitude string, station_longitude string,
    parametertype_id string, parametertype_name string, stationparameter_no string,
    stationparameter_name string, wplmn_flag bigint
""")

OBSERVATION = _struct("""
    datetime time, value double, station_id string, station_origin string,
    constituent string, unit string
""")

OUTLET_GROUPS = _struct(
    "outlet_id int, repository_name string, outlet_name string, notes string",
    required=("outlet_id", "repository_name"),
)
OUTLET_STATIONS = _struct(
    "outlet_id int, station_id string, station_origin string, repository_name string, "
    "true_opnid int, comments string",
    required=("outlet_id", "station_id", "station_origin", "repository_name", "true_opnid"),
)
OUTLET_REACHES = _struct(
    "outlet_id int, reach_id int, repository_name string",
    required=("outlet_id", "reach_id", "repository_name"),
)
REGISTRY = _struct("""
    station_id string, true_opnid int, opnids string, comments string, modeled string,
    repo_name string, wplmn_flag int, source string
""")
XREF = _struct("WISKI_STATION_NO string, EQUIS_STATION_ID string, WISKI_EQUIS_ID string, WID string")
QUALITY = _struct("quality_code int, Text string, Description string, Active int")
PORTAL = _struct("""
    parameter string, sampleDate string, sampleTime string, result string,
    resultUnit string, stationName string
""")
GAUGE = _struct("tstamp string, var_name string, value double")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema's columns, order and types.

    A missing column is an error (Spark's own unresolved-column error), an extra one is dropped.
    """
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
