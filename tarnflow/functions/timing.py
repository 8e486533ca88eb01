"""Time expressions on TIMESTAMP_NTZ.

``date_trunc`` turns a zone-free time into a zoned one and so depends on the session zone. These
expressions work on the interval since a fixed moment instead, which keeps the type and the zone
out. Each names its argument once: conditions on a computed time are pushed down as copies of its
expression, and one that repeats its argument grows with every level.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from tarnflow.lookups import TARGET_HOURS, ZONE_HOURS

NTZ = "timestamp_ntz"
# From the start of the year 1 to the start of 1970.
SECONDS_TO_1970 = 719162 * 86400
BLANKS = " \t\n\r\f\v"


def _interval(days=0, hours=0, minutes=0, seconds=0) -> Column:
    part = [p if isinstance(p, Column) else F.lit(p) for p in (days, hours, minutes, seconds)]
    return F.make_dt_interval(*part)


def _at(text: str) -> Column:
    return F.lit(text).cast(NTZ)


def _whole_seconds(t: Column) -> Column:
    """Whole seconds since the year 1, so that cutting off the fraction is rounding down."""
    return (t - _at("0001-01-01 00:00:00")).cast("interval second").cast("bigint")


def hour_floor(t: Column) -> Column:
    """Start of the hour."""
    hours = F.floor(_whole_seconds(t) / 3600).cast("int")
    return _at("0001-01-01 00:00:00") + _interval(hours=hours)


def day_floor(t: Column) -> Column:
    """Midnight of the day."""
    return t.cast("date").cast(NTZ)


def hour_round(t: Column) -> Column:
    """Nearest hour; an exact half goes to the even hour.

    ``rint`` rounds halves to even, and hours since a midnight are even when the hour of day is. A
    double tells microseconds apart from the half hour for 250 years around 1970.
    """
    seconds = (t - _at("1970-01-01 00:00:00")).cast("interval second").cast("decimal(18,6)")
    hours = F.rint(seconds.cast("double") / 3600).cast("int")
    return _at("1970-01-01 00:00:00") + _interval(hours=hours)


def zone_label(label: Column) -> Column:
    return F.upper(F.trim(label, F.lit(BLANKS)))


def zone_hours(label: Column) -> Column:
    """Hours from UTC of a zone label, NULL when the label is unknown."""
    pairs = [F.lit(x) for item in ZONE_HOURS.items() for x in item]
    return F.create_map(*pairs)[zone_label(label)]


def to_fixed_zone(t: Column, label: Column) -> Column:
    """Local clock with a fixed-offset label -> clock at UTC-6 (P6's arithmetic)."""
    return t - _interval(hours=zone_hours(label) - F.lit(TARGET_HOURS))


def year_start(year: int) -> Column:
    return F.lit(f"{year:04d}-01-01 00:00:00").cast(NTZ)


def years_between(t: Column, start: int | None, end: int | None, lead: str = "0 minutes") -> Column:
    """Inclusive years as a range on the time itself, so that Parquet statistics can prune.

    With a ``lead`` every year begins and ends that much earlier.
    """
    earlier = F.expr(f"interval {lead}")
    bounds = []
    if start is not None:
        bounds.append(t >= year_start(start) - earlier)
    if end is not None:
        bounds.append(t < year_start(end + 1) - earlier)
    # A bound is never true of a missing time.
    return reduce(and_, bounds) if bounds else t.isNotNull()


def epoch_seconds(t: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the same clock."""
    return _whole_seconds(t) - SECONDS_TO_1970


def from_epoch_seconds(s: Column) -> Column:
    """Inverse of :func:`epoch_seconds`."""
    return _at("1970-01-01 00:00:00") + _interval(seconds=s.cast("decimal(18,6)"))
