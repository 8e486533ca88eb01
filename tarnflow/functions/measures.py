"""Unit conversions and value clean-up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

POUNDS_PER_KG = 2.20462


def without_nan(v: Column) -> Column:
    """NaN -> NULL. Spark counts and averages NaN, pandas and SQL tables skip it."""
    return F.when(~F.isnan(v), v)


def celsius_to_fahrenheit(v: Column) -> Column:
    return v * 9 / 5 + 32


def sensor_measure(value: Column, unit: Column) -> tuple[Column, Column]:
    """Sensor value and unit in standard units (P1). Rows already in degf stay as they are."""
    low = F.lower(unit)
    new_value = (
        F.when(low == "°c", celsius_to_fahrenheit(value))
        .when(low == "kg", value * POUNDS_PER_KG)
        .otherwise(value)
    )
    new_unit = (
        F.when(low == "°c", "degf").when(low == "kg", "lb").when(low == "ft³/s", "cfs").otherwise(low)
    )
    return new_value, new_unit


def lab_measure(value: Column, unit: Column) -> tuple[Column, Column]:
    """Laboratory value and unit in standard units."""
    low = F.lower(unit)
    celsius = low.isin("deg c", "degc")
    new_value = (
        F.when(low == "ug/l", value / 1000)
        .when(low == "mg/g", value * 1000)
        .when(celsius, celsius_to_fahrenheit(value))
        .otherwise(value)
    )
    new_unit = F.when(low.isin("ug/l", "mg/g"), "mg/l").when(celsius, "degf").otherwise(low)
    return new_value, new_unit


def portal_measure(value: Column, unit: Column) -> tuple[Column, Column]:
    """Portal value and unit (P9). The portal's own spelling of the degree unit is kept."""
    low = F.lower(unit)
    new_value = (
        F.when(low == "ug/l", value * 0.001)
        .when(low == "kg", value * POUNDS_PER_KG)
        .when(low == "deg c", celsius_to_fahrenheit(value))
        .otherwise(value)
    )
    return new_value, portal_unit(unit)


def portal_unit(unit: Column) -> Column:
    low = F.lower(unit)
    return F.when(low == "kg", "lb").when(low == "ug/l", "mg/l").when(low == "deg c", "degF").otherwise(low)


def standard_unit(value: Column, unit: Column) -> tuple[Column, Column]:
    """Bring portal and gauge units to the spelling of the other sources (decision D7)."""
    low = F.lower(unit)
    return F.when(low == "c", celsius_to_fahrenheit(value)).otherwise(value), F.when(low == "c", "degf").otherwise(low)
