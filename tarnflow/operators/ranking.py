"""First-per-key and global numbering without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key (W3), as a map-side combined minimum instead of a window.

    Equal ``order`` values are settled by the remaining columns, so the result is always the same.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def number_keys(keys: DataFrame, order: list[str], name: str, ranges: int = 256) -> DataFrame:
    """Number distinct rows, without nulls in ``order``, from 0 in the order of ``order``.

    A ranking window without a partition would put every key in one task. Here the keys of smallest hash,
    one fewer than there are ranges, part the order into ranges; a key is numbered inside its range, and each
    range is moved up by the sizes of those before it. Only the one-row-per-range tables meet in one place.
    Nothing runs until the result is asked for, and since a key's range follows from the keys
    alone, recomputed parts agree.
    """
    key = F.struct(*order)
    bounds = keys.orderBy(F.xxhash64(*order), *order).limit(ranges - 1).agg(F.sort_array(F.collect_list(key))).scalar()
    placed = keys.withColumn("_bounds", bounds).withColumn("_range", F.size(F.filter("_bounds", lambda bound: bound <= key))).drop("_bounds")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    numbered = placed.withColumn("_inside", inside).join(starts, "_range")
    return numbered.withColumn(name, (F.col("_start") + F.col("_inside")).cast("int")).drop("_range", "_inside", "_start")
