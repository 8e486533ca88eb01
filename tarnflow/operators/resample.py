"""Calendar resampling (A10, A11) and interval aggregates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.functions import timing
from tarnflow.shared import cut

_SPEC = re.compile(r"^(\d*)(min|h|D|W|MS|ME|M|QS|QE|Q|YS|YE|Y|A)$")
_SECONDS = {"min": 60, "h": 3600, "D": 86400}
_MONTHS = {"MS": 1, "ME": 1, "M": 1, "QS": 3, "QE": 3, "Q": 3, "YS": 12, "YE": 12, "Y": 12, "A": 12}


class Calendar:
    """Bins of a pandas-style period such as ``h``, ``D``, ``2W``, ``MS``, ``ME``, ``QE``, ``YS``.

    Every time has a whole-numbered base period (an hour, a week, a month, ...). ``n`` base periods
    make a bin. Fixed-length and start-labelled bins run from their first base period on and carry
    its start; end-labelled bins (W and ...E) close with their last base period and carry its last
    day. Bins of several periods are counted from the first observation (for fixed lengths: from
    midnight of its day), as pandas does.
    """

    def __init__(self, period: str):
        match = _SPEC.match(period)
        if not match or match.group(1) == "0":
            raise ValueError(f"Period {period} not recognized.")
        self.n = int(match.group(1) or 1)
        self.unit = match.group(2)
        self.ends = self.unit == "W" or self.unit in ("ME", "M", "QE", "Q", "YE", "Y", "A")

    def base(self, t: Column) -> Column:
        """Number of the base period of a time."""
        if self.unit in _SECONDS:
            return F.floor(timing.epoch_seconds(t) / _SECONDS[self.unit])
        if self.unit == "W":
            # 1970-01-05 is a Monday: weeks run Monday to Sunday.
            days = F.datediff(t.cast("date"), F.lit("1970-01-05").cast("date"))
            return F.floor(days / 7).cast("bigint")
        months = (F.year(t) - 1970) * 12 + F.month(t) - 1
        return F.floor(months / _MONTHS[self.unit]).cast("bigint")

    def anchor(self, first: Column) -> Column:
        """Base period the multiples are counted from, given the first observation's time."""
        return self.base(timing.day_floor(first) if self.unit in _SECONDS else first)

    def bin(self, base: Column, anchor: Column) -> Column:
        """Bin number of a base period."""
        step = (base - anchor) / self.n
        return (F.ceil(step) if self.ends else F.floor(step)).cast("bigint")

    def label(self, number: Column, anchor: Column) -> Column:
        """Time shown for a bin."""
        base = anchor + number * self.n
        if self.unit in _SECONDS:
            return timing.from_epoch_seconds(base * _SECONDS[self.unit])
        if self.unit == "W":
            return F.date_add(F.lit("1970-01-05").cast("date"), (base * 7 + 6).cast("int")).cast(timing.NTZ)
        span = _MONTHS[self.unit]
        month = base * span + (span - 1 if self.ends else 0)
        start = F.add_months(F.lit("1970-01-01").cast("date"), month.cast("int"))
        return (F.last_day(start) if self.ends else start).cast(timing.NTZ)


def resample(df: DataFrame, period: str, columns: list[str], agg: str = "mean") -> DataFrame:
    """Pool all rows into one series per calendar bin.

    Rows are first reduced to one row per base period (with map-side combining); everything after
    that works on at most one row per hour, day or month of the calendar. ``mean`` leaves empty
    bins out, ``sum`` reports them as 0.
    """
    if agg not in ("mean", "sum"):
        raise ValueError(f"Aggregate {agg} not recognized.")
    calendar = Calendar(period)
    parts = [F.sum(c).alias(f"_s_{c}") for c in columns] + [F.count(c).alias(f"_n_{c}") for c in columns]
    base = df.groupBy(calendar.base(F.col("datetime")).alias("_base")).agg(F.min("datetime").alias("_first"), *parts)
    # Rows without a time are left out here: asked of the rows, the condition would be pushed below
    # the aggregates that made them and repeat their time expressions there.
    base = base.filter(F.col("_first").isNotNull())

    if calendar.n == 1 and agg == "mean":
        binned = base.withColumn("_label", calendar.label(F.col("_base"), F.lit(0)))
    else:
        span = base.agg(F.min("_first").alias("_first"), F.max("_base").alias("_last"))
        anchor = span.select(calendar.anchor(F.col("_first"))).scalar()
        numbered = base.withColumn("_bin", calendar.bin(F.col("_base"), anchor))
        if agg == "sum":
            own = calendar.anchor(F.col("_first"))
            start, stop = calendar.bin(calendar.base(F.col("_first")), own), calendar.bin(F.col("_last"), own)
            # In blocks that are dealt out before they are filled, so that no task makes the whole calendar.
            blocks = span.filter("_first is not null").select(
                stop.alias("_stop"), F.explode(F.sequence(start.cast("bigint"), stop.cast("bigint"), F.lit(4096))).alias("_block")
            ).repartition("_block")
            every = blocks.select(F.explode(F.sequence("_block", F.least(F.col("_block") + 4095, F.col("_stop")))).alias("_bin"))
            numbered = every.join(numbered, "_bin", "left")
        binned = numbered.withColumn("_label", calendar.label(F.col("_bin"), anchor))

    def measure(c: str) -> Column:
        total, count = F.sum(f"_s_{c}"), F.sum(f"_n_{c}")
        value = F.when(count > 0, total / count) if agg == "mean" else F.coalesce(total, F.lit(0.0))
        return value.alias(c)

    return binned.groupBy(F.col("_label").alias("datetime")).agg(*[measure(c) for c in columns])


# ---- Interval aggregates ------------------------------------------------------------------

KINDS = ("min", "max", "mean", "average", "total", "counts")
_INTERVALS = {
    "decadal": "decade", "yearly": "year", "year": "year", "monthly": "month", "month": "month",
    "daily": "day", "day": "day", "hourly": "hour", "hour": "hour",
}


def check_interval(interval: str) -> None:
    """A named interval, or HHMMSS."""
    if interval in _INTERVALS:
        return
    clock = re.match(r"^(\d\d)(\d\d)(\d\d)$", interval)
    if not clock or int(clock[1]) > 23 or int(clock[2]) > 59 or int(clock[3]) > 59 or interval == "000000":
        raise ValueError(f"Interval {interval} not recognized.")


def check_kind(kind: str) -> None:
    """A named kind, or perc-N with 0 < N < 100."""
    percent = re.match(r"^perc-(\d+)$", kind)
    if kind not in KINDS and not (percent and 0 < int(percent[1]) < 100):
        raise ValueError(f"Aggregation {kind} not recognized.")


def interval_start(t: Column, interval: str) -> Column:
    """Start of the interval a time falls in; HHMMSS intervals are counted from 1970-01-01."""
    check_interval(interval)
    name = _INTERVALS.get(interval)
    if name == "hour":
        return timing.hour_floor(t)
    if name == "day":
        return timing.day_floor(t)
    if name == "month":
        return F.make_date(F.year(t), F.month(t), F.lit(1)).cast(timing.NTZ)
    if name == "year":
        return F.make_date(F.year(t), F.lit(1), F.lit(1)).cast(timing.NTZ)
    if name == "decade":
        return F.make_date((F.floor(F.year(t) / 10) * 10).cast("int"), F.lit(1), F.lit(1)).cast(timing.NTZ)
    seconds = int(interval[:2]) * 3600 + int(interval[2:4]) * 60 + int(interval[4:])
    return timing.from_epoch_seconds(F.floor(timing.epoch_seconds(t) / seconds) * seconds)


def interval_aggregate(
    df: DataFrame, interval: str, kind: str, keys: tuple[str, ...] = ("station_id", "constituent")
) -> DataFrame:
    """One value per key and interval (A12); ``perc-N`` interpolates between neighbours."""
    check_kind(kind)
    start = interval_start(F.col("datetime"), interval)
    rows = df.filter(F.col("datetime").isNotNull()).select(*keys, start.alias("datetime"), "value")
    group = [*keys, "datetime"]
    if kind.startswith("perc-"):
        return exact_percentile(rows, group, "value", int(kind[5:]) / 100)
    measure = {
        "min": F.min, "max": F.max, "mean": F.avg, "average": F.avg, "total": F.sum, "counts": F.count,
    }[kind]
    return rows.groupBy(*group).agg(measure("value").alias("value"))


#: Each level of cells divides those before it into 256; six of them are finer than any two doubles far apart.
_STEP, _LAST = 256, 6


def _cell(value: Column, level: int) -> Column:
    """Number of a double's cell: its power of two, divided into ``256^level`` equal parts; rises with the value."""
    size = F.abs(value)
    power = F.floor(F.log2(size))
    # Beside a power of two the logarithm may round to the other side; the order is kept by staying in the octave.
    part = F.least(F.greatest(size / F.pow(F.lit(2.0), power) - 1, F.lit(0.0)), F.lit(1 - 2.0**-52))
    fine = _STEP**level
    number = (power.cast("bigint") + 1100) * fine + F.floor(part * fine).cast("bigint")
    number = F.when(size == float("inf"), F.lit(3000 * fine)).otherwise(number)
    return (
        F.when(F.isnan(value), F.lit(3001 * fine)).when(value == 0, F.lit(0)).when(value < 0, -number).otherwise(number)
    ).cast("bigint")


def exact_percentile(df: DataFrame, keys: list[str], column: str, share: float, small: int = 8192) -> DataFrame:
    """Exact interpolated percentile per group, as double, without holding a group in one task.

    Equal values are counted together on the map side and spread by value; that table is checkpointed, so the
    input is read once. Each group gets a histogram of it over cells that depend on the value alone, and the
    cell that holds the wanted rank is divided again until it has at most ``small`` rows or one value;
    ranks are sums over cells. After at most six divisions a cell has no more than some hundred different
    values. Only the values of the chosen cells are put in order. NaN is the largest value, nulls don't
    count, a group of nulls has a null.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(column).cast("double").alias("_v"))
    rows = cut(rows.groupBy(*names, "_v").agg(F.count("_v").alias("_n")))
    measures = [F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]

    def inside(cells: DataFrame, chosen: DataFrame) -> DataFrame:
        # Cells meet the chosen one they divide: at most 256 of them, or the values of one small cell.
        told = chosen.select(*[F.col(n).alias(f"{n}_") for n in names], F.col("_cell").alias("_parent_"), "_rank", "_next")
        on = [F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names] + [F.col("_parent") == F.col("_parent_")]
        return cells.join(told, on).drop("_parent_", *[f"{n}_" for n in names])

    def holding(cells: DataFrame, order: str) -> DataFrame:
        """The cell with the rank in it, the rank inside it and the smallest value after it."""
        by = Window.partitionBy(*names).orderBy(order)
        cells = cells.withColumns({
            "_below": F.coalesce(F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_next": F.coalesce(F.lead("_lo").over(by), F.col("_next")),
        })
        place = F.floor("_rank")
        found = cells.where(((F.col("_below") <= place) & (place < F.col("_below") + F.col("_n"))) | F.col("_cell").isNull())
        return found.withColumn("_rank", F.col("_rank") - F.col("_below"))

    first = rows.groupBy(*names, _cell(F.col("_v"), 0).alias("_cell")).agg(*measures)
    totals = Window.partitionBy(*names)
    first = first.withColumn("_all", F.sum("_n").over(totals)).where("_n > 0 or _all = 0")  # nulls have no cell
    first = first.withColumns({"_rank": F.lit(share) * F.greatest(F.col("_all") - 1, F.lit(0)), "_next": F.lit(None).cast("double")})
    kept = [*names, "_cell", "_n", "_lo", "_hi", "_rank", "_next"]
    chosen = cut(holding(first, "_cell").select(*kept))
    done = [chosen.where("_n = 0").select(*names, F.lit(None).cast("double").alias(column))]
    for level in range(_LAST + 1):
        # One value fills the cell, or the rank is looked up among the values of a small one.
        single = F.col("_lo") == F.col("_hi")
        done.append(_between(chosen.where(single), names, column))
        several = chosen.where(~single)
        ready = several.where(F.col("_n") <= small) if level < _LAST else several
        values = rows.select(*names, "_n", _cell(F.col("_v"), level).alias("_parent"), *[F.col("_v").alias(c) for c in ("_cell", "_lo", "_hi")])
        done.append(_between(holding(inside(values, ready), "_cell"), names, column))
        large = several.where(F.col("_n") > small)
        if level == _LAST or large.isEmpty():
            break
        finer = rows.where("_v is not null").groupBy(
            *names, _cell(F.col("_v"), level).alias("_parent"), _cell(F.col("_v"), level + 1).alias("_cell")
        ).agg(*measures)
        chosen = cut(holding(inside(finer, large), "_cell").select(*kept))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], column)


def _between(found: DataFrame, names: list[str], column: str) -> DataFrame:
    """The value at a rank from the one value of its cell and the next larger one."""
    place = F.floor("_rank")
    part = F.col("_rank") - place
    upper = F.when(place + 1 < F.col("_n"), F.col("_lo")).otherwise(F.coalesce("_next", "_lo"))
    value = F.when(part == 0, F.col("_lo")).otherwise(F.col("_lo") + (upper - F.col("_lo")) * part)
    return found.select(*names, value.alias(column))
