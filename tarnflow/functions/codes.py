"""Code -> constituent expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tarnflow import lookups


def literal_map(mapping: dict, key: Column) -> Column:
    """Lookup in a small fixed map; NULL when the key is absent."""
    return F.create_map(*[F.lit(x) for item in mapping.items() for x in item])[key]


def sensor_constituent(parameter_no: Column) -> Column:
    """Constituent by parameter number prefix; the number itself when none matches."""
    expr = None
    for prefix, constituent in lookups.PARAMETER_PREFIXES.items():
        hit = parameter_no.startswith(prefix)
        expr = F.when(hit, constituent) if expr is None else expr.when(hit, constituent)
    return expr.otherwise(parameter_no)


def lab_constituent(analyte: Column) -> Column:
    """Constituent by analyte code; NULL when unknown (P5)."""
    return literal_map(lookups.LAB_ANALYTES, analyte)


def matches(parameter_no: Column, patterns: tuple[str, ...]) -> Column:
    """True when the number equals one of the patterns or starts with a starred one."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | (parameter_no.startswith(pattern[:-1]) if pattern.endswith("*") else parameter_no == pattern)
    return hit


def reach_numbers(opnids: Column) -> Column:
    """Comma list of reach numbers -> array<int>; "650.0" reads as 650."""
    return F.transform(F.split(opnids, ","), lambda x: F.trim(x).cast("double").cast("int"))


def is_external(station: Column) -> Column:
    """Stations of other agencies start with E."""
    return station.startswith("E")
