"""Code lists and lookup tables.

All of these are fixed and small; the optimizer broadcasts them by their measured size.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tarnflow import schemas

# ---- Fixed values -------------------------------------------------------------------------

SENSOR_ORIGIN = "wiski"
LAB_ORIGIN = "equis"
PORTAL_ORIGIN = "swd"
GAUGE_ORIGIN = "csg"

# Sensor quality codes accepted by default.
ACCEPTED_QUALITY = (1, 3, 10, 12, 15, 20, 29, 30, 31, 32, 34, 45, 46, 47, 48, 49)

# Sensor parameter number prefix -> constituent.
PARAMETER_PREFIXES = {"262": "Q", "450": "WT", "451": "WT", "863": "OP", "866": "DO", "811": "TRB"}

# Sensor parameter type -> constituent.
PARAMETER_TYPES = {
    "11522": "TP", "11531": "TP", "11532": "TSS", "11523": "TSS", "11526": "N",
    "11519": "N", "11520": "OP", "11528": "OP", "11530": "TKN", "11521": "TKN",
    "11500": "Q", "11504": "WT", "11533": "DO", "11507": "WL",
}

CONSTITUENTS = ("Q", "WT", "OP", "DO", "TP", "TSS", "N", "TKN", "TRB")

# Constituent -> parameter numbers asked for; a trailing star is a prefix.
PARAMETER_SCOPE = {
    "Q": ("262*",), "WT": ("450*", "451*"), "OP": ("863*",), "DO": ("866*",), "TRB": ("811*",),
    "TP": (), "TSS": (), "N": (), "TKN": (),
}
# Parameter numbers offered when no constituent is asked for.
OFFERED_NUMBERS = ("262*", "450*", "451*", "863*", "866*")
PARAMETER_SCOPE_LOAD = {
    "Q": ("262*",), "WT": ("450*", "451*"), "OP": ("863*", "5034", "5035"), "DO": ("866*",),
    "TP": ("5005", "5004"), "TSS": ("5014", "5015"), "N": ("5024", "5025"), "TKN": ("5044", "5045"),
}

# Load network: station group and the parameter numbers of its pull.
LOAD_GROUP = "1319204"
LOAD_PARAMETERS = ("5004", "5005", "5014", "5015", "5024", "5025", "5034", "5035", "5044", "5045", "262")
LOAD_SERIES = "20.Day.Mean"

# Series names by constituent: (internal unit, internal daily, external unit, external daily).
_COMMON_SERIES = ("09.Archive", "20.Day.Mean", "08.Provisional.Edited", "20.Day.Mean")
SERIES_NAMES = {c: _COMMON_SERIES for c in CONSTITUENTS}
SERIES_NAMES["Q"] = ("15.Rated", "20.Day.Mean.Archive", "08.Provisional.Edited", "20.Day.Mean")
UNIT_SERIES = ("15.Rated", "09.Archive", "08.Provisional.Edited")

# Laboratory analyte code -> constituent.
LAB_ANALYTES = {
    "479-61-8": "CHLA", "CHLA-CORR": "CHLA", "BOD": "BOD", "NO2NO3": "N",
    "14797-55-8": "NO3", "14797-65-0": "NO2", "14265-44-2": "OP", "N-KJEL": "TKN",
    "PHOSPHATE-P": "TP", "7723-14-0": "TP", "SOLIDS-TSS": "TSS", "TEMP-W": "WT",
    "7664-41-7": "NH3",
}
LAB_EXTRACT_ANALYTES = (*LAB_ANALYTES, "FLOW")
LAB_LOCATION_TYPE = "River/Stream"
LAB_FACILITIES = (1, 33836701)
LAB_SAMPLE_METHODS = ("G-EVT", "G", "FIELDMSROBS", "LKSURF1M", "LKSURF2M", "LKSURFOTH")

# Time zone label -> hours from UTC; observations are kept at UTC-6.
ZONE_HOURS = {"CST": -6, "CDT": -5, "UTC": 0, "EST": -5, "EDT": -4}
TARGET_HOURS = -6

# Default unit and aggregate.
UNIT_OF = {
    "Q": "cfs", "QB": "cfs", "TSS": "mg/l", "TP": "mg/l", "OP": "mg/l", "TKN": "mg/l",
    "N": "mg/l", "WT": "degf", "WL": "ft",
}
AGGREGATE_OF_UNIT = {"cfs": "mean", "mg/l": "mean", "degf": "mean", "lb": "sum"}

# Gauge variable text -> (constituent, unit).
GAUGE_VARIABLES = {
    "Water Temp. (C)": ("WT", "C"),
    "Discharge (cfs)": ("Q", "cfs"),
    "DO (mg/L)": ("DO", "mg/L"),
}

# Origin -> column of the station cross-reference.
XREF_COLUMN = {
    "wiski": "WISKI_STATION_NO", "wplmn": "WISKI_STATION_NO",
    "equis": "EQUIS_STATION_ID", "swd": "EQUIS_STATION_ID",
}

# Portal parameter texts per constituent, in file order; where a text is listed twice the later
# line decides.
PARAMETER_TEXTS = (
    ("BOD", ("Biochemical Oxygen Demand", "Biochemical Oxygen Demand (BOD)",
             "Biochemical oxygen demand, standard conditions")),
    ("CHLA", ("Chlorophyll a", "Chlorophyll A", "Chlorophyll-A", "Chlorophyll",
              "Chlorophyll a, pheophytin-adjusted", "Chlorophyll a, corrected for pheophytin",
              "Chlorophyll-a, Pheophytin Corrected",
              "Chlorophyll a, corrected for pheophytin - Periphyton (attached)")),
    ("ECOLI", ("Fecal Coliform",)),
    ("N", ("Nitrate/Nitrite as N (N+N) as N", "Nitrate + Nitrite Nitrogen, Dissolved as N",
           "Nitrate/Nitrite as N as N", "Nitrogen, NO2 plus NO3 as N", "N+N as N",
           "Nitrate/Nitrite as N", "Inorganic nitrogen (nitrate and nitrite) as N",
           "Nitrate + Nitrite Nitrogen, Total", "Nitrate + Nitrite Nitrogen, Total as N",
           "Nitrate+Nitrite Nitrogen as N", "Inorganic nitrogen (nitrate and nitrate) as N",
           "Nitrate+Nitrite as N")),
    ("NO3", ("Nitrogen, nitrate, as NO3 as N", "Nitrate as N as N", "Nitrate-N as N",
             "Nitrogen, nitrate, as N as N", "Nitrate as N")),
    ("NO2", ("Nitrogen, nitrite, as N as N", "Nitrite as N", "Nitrite as N as N",
             "Nitrite-N as N", "Nitrogen, nitrite, as NO2 as N")),
    ("OP", ("Orthophosphate, as P as P", "Orthophosphate as P as P",
            "Orthophosphate as P, Dissolved as P", "Orthophosphate as P (LF) as P",
            "phosphate-P as P", "Orthophosphate Phosphorus, Total as P",
            "Orthophosphate Phosphorus, Dissolved as P", "Ortho Phosphorus, Dissolved as P",
            "Orthophosphate as P", "Ortho Phosphorus as P", "Phosphorus, Soluble Ortho as P",
            "Orthophosphate as P (FF) as P", "Phosphorus as P")),
    ("SSC", ("Suspended Sediment Concentration (SSC)",)),
    ("TDS", ("Residue - filterable (TDS)", "Total dissolved solids (TDS)",
             "Solids, Total Dissolved", "Total dissolved solids", "Total Dissolved Solids")),
    ("TKN", ("Kjeldahl Nitrogen, Total as N", "Total Kjeldahl Nitrogen as N", "TKN as N",
             "Nitrogen, Total Kjeldahl (TKN) as N", "Nitrogen, Total Kjeldahl as N",
             "Kjeldahl nitrogen as N")),
    ("TP", ("Phosphate-phosphorus as P", "Orthophosphate as P", "Phosphorus, Total as P",
            "Phosphorus, Total as P as P", "Phosphorus, Total Dissolved, as P (FF) as P",
            "Total Diss Phosphorus as P", "Phosphorus, Dissolved as P",
            "Phosphorus, Total Dissolved, as P (LF) as P", "Total Phosphorus as P",
            "total phosphorus as P", "Phosphorus as P", "Phosphorus, Total")),
    ("TS", ("Total solids", "Total Solids")),
    ("TSS", ("Solids, Total Suspended", "Total Suspended Solids in Water",
             "Total suspended solids", "Residue - nonfilterable (TSS)",
             "total suspended solids", "Solids, Suspended", "Total Suspended Solids")),
    ("WT", ("Temperature, water", "Temperature, field", "Temperature, Water",
            "Field Temperature")),
)

# Sensor quality codes: active ones, then retired ones. The long descriptions come from the
# agency's own file (see ``sources.read_quality_codes``).
ACTIVE_QUALITY = (
    (0, "Unchecked"), (3, "Instantaneous"), (5, "Excellent"), (8, "Reliable Interpolation"),
    (10, "Good"), (15, "Fair"), (20, "Poor"), (27, "Questionable"),
    (28, "Unknown data quality"), (29, "Modeled"), (34, "Estimated"), (35, "Unreliable"),
    (36, "Threshold Exceedance"), (40, "Default import code"), (45, "Approved Ext Data"),
    (48, "Unknown Ext Data"), (49, "Estimated Ext Data"), (50, "Provisional Ext Data"),
    (80, "Ice - Estimated"), (199, "199-Logger Unknown"), (200, "200"),
    (228, "Info Parameter"), (255, "---"),
)
RETIRED_QUALITY = (
    1, 2, 3, 4, 5, 10, 12, 15, 20, 25, 27, 30, 31, 32, 33, 34, 35, 45, 46, 47, 48, 49, 50, 51,
    60, 70, 76, 80, 82, 103, 130, 131, 132, 133, 134, 135, 140, 141, 148, 149, 150, 151, 160,
    169, 170, 180, 255,
)

# ---- Lookup tables as DataFrames ----------------------------------------------------------


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A fixed table as a local relation: the plan holds its rows, no Python worker reads it."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrow = to_arrow_schema(schema)
    data = pa.table([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(data, schema=schema)


def _pairs(spark: SparkSession, mapping: dict[str, str], key: str) -> DataFrame:
    schema = T.StructType().add(key, "string").add("constituent", "string")
    return local_table(spark, list(mapping.items()), schema)


def parameter_types(spark: SparkSession) -> DataFrame:
    """Parameter type -> constituent."""
    return _pairs(spark, PARAMETER_TYPES, "parametertype_id")


def lab_analytes(spark: SparkSession) -> DataFrame:
    """Laboratory analyte code -> constituent."""
    return _pairs(spark, LAB_ANALYTES, "cas_rn")


def series_resolutions(spark: SparkSession) -> DataFrame:
    """Series name -> resolution (0 unit values, 1 daily) per constituent and kind of station."""
    rows = []
    for code, (unit_in, daily_in, unit_ex, daily_ex) in SERIES_NAMES.items():
        rows += [(code, False, unit_in, 0), (code, False, daily_in, 1), (code, True, unit_ex, 0), (code, True, daily_ex, 1)]
    schema = T.StructType().add("constituent", "string").add("external", "boolean").add("ts_name", "string").add("resolution", T.IntegerType())
    return local_table(spark, rows, schema)


def quality_codes(spark: SparkSession) -> DataFrame:
    """Quality codes with text and active flag; descriptions and retired texts are left NULL."""
    rows = [(code, text, None, 1) for code, text in ACTIVE_QUALITY]
    rows += [(code, None, None, 0) for code in RETIRED_QUALITY]
    return local_table(spark, rows, schemas.QUALITY)


def parameter_map(spark: SparkSession) -> DataFrame:
    """Portal parameter text -> constituent; of repeated texts the last listed decides."""
    texts = {text: constituent for constituent, listed in PARAMETER_TEXTS for text in listed}
    return _pairs(spark, texts, "parameter")


def last_listed(df: DataFrame, key: str, value: str, ordinal: str) -> DataFrame:
    """The same rule for a map read from a file: per key the value with the highest ordinal."""
    return df.groupBy(key).agg(F.max_by(value, ordinal).alias(value))


def defaults_for(constituent: str, agg: str | None = None) -> tuple[str, str]:
    """Unit and aggregate of a constituent; ``agg`` overrides the aggregate."""
    unit = UNIT_OF.get(constituent, "mg/l")
    return unit, agg or AGGREGATE_OF_UNIT.get(unit, "mean")
