"""Readers and parsers of landed data."""

from tarnflow.sources.landed import (
    parse_portal_json,
    parse_series_json,
    parse_table_json,
    read_gauge_csv,
    read_portal_results,
)
from tarnflow.sources.tables import (
    import_outlets,
    load_csv,
    load_lookups,
    load_parquet,
    read_lab_staging,
    read_parameter_map,
    read_quality_codes,
    read_sensor_staging,
    read_station_registry,
    read_xref,
    type_sensor,
    with_row_order,
)

__all__ = [
    "import_outlets", "load_csv", "load_lookups", "load_parquet", "parse_portal_json",
    "parse_series_json", "parse_table_json", "read_gauge_csv", "read_lab_staging",
    "read_parameter_map", "read_portal_results", "read_quality_codes", "read_sensor_staging",
    "read_station_registry", "read_xref", "type_sensor", "with_row_order",
]
