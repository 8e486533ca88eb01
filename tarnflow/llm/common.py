"""Helpers the operators share: tables, written steps, text columns, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder for written steps, inside the folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder. On a cluster a missing
    setting is an error, since a machine-local folder is lost with its machine.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a shared folder.")
        base = tempfile.mkdtemp(prefix="steps-")
    return f"{base.rstrip('/')}/step-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut lineage: write to a new shared folder and read again."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(df: DataFrame) -> None:
    """Delete the folder behind a frame made by :func:`written`."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps.

    Spark deletes them once the driver's garbage collector has found that nothing refers to them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key`` and ``_text`` alone. Keys travel as strings: pandas turns nullable integers to floats."""
    return docs.select(docs[key].cast("string").alias("_key"), docs[text].cast("string").alias("_text"))


def unkeyed(df: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """``_key`` back to name and type of the key of ``docs``, as the first column."""
    rest = [c for c in df.columns if c != "_key"]
    return df.select(df["_key"].cast(docs.schema[key].dataType).alias(key), *rest)


def sampled(rows: DataFrame, n_rows, wanted: int, *by) -> DataFrame:
    """About ``wanted`` of ``n_rows`` rows (a number or a column), those of smallest hash of ``by``.

    A row is in by its own hash alone, so nothing is sorted or gathered, and retries agree.
    """
    share = F.xxhash64(*by).cast("double") / 2.0**64 + 0.5
    return rows.where(share < F.lit(float(wanted)) / n_rows)


def numbered(rows: DataFrame, by: list[str], order: list, name: str) -> DataFrame:
    """``rows``, written, with their place ``name`` (from 0) in this order inside each group of the columns ``by``.

    The rows are range-sorted, so a group of any size lies over many tasks; a place is the number of the
    group's rows in earlier partitions plus those before it in its own. Equal rows get different places.
    ``by`` must not hold nulls. ``rows`` are read twice and should be written.
    """
    keys = [*by, *order, F.col("_tie")]
    told = rows.withColumn("_tie", F.monotonically_increasing_id())
    told = told.repartitionByRange(parts(rows.sparkSession), *keys).sortWithinPartitions(*keys).drop("_tie")
    told = written(told.withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    counts = told.groupBy(*by, part.alias("_part")).agg(F.min("_row").alias("_least"), F.count("*").alias("_n"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_shift"))
    return told.withColumn("_part", part).join(offsets, [*by, "_part"]).withColumn(name, F.col("_row") + F.col("_shift")).drop(
        "_row", "_part", "_shift"
    )


SALTS = 16  # tasks that share the rows of one value in a salted join


def salted_join(rows: DataFrame, once: DataFrame, on: list[str], deal: Column) -> DataFrame:
    """``rows`` joined on the columns ``on`` with a table that has each of their values once.

    Any value may hold any share of ``rows``: these are dealt out by ``deal``, a long, over ``SALTS`` tasks a value,
    and ``once`` is repeated as often. Both sides are shuffled as they are, so that adaptive skew handling can split further.
    """
    salts = F.array(*[F.lit(k).cast("bigint") for k in range(SALTS)])
    left, right = rows.withColumn("_salt", F.pmod(deal, F.lit(SALTS))), once.withColumn("_salt", F.explode(salts))
    return left.join(right, [*on, "_salt"]).drop("_salt")


def parts(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: columns ``node`` and ``component``.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type; nulls and loops join nothing.
    ``component`` is the smallest node reachable. Nodes without an edge to another node are not
    returned. An empty graph gives an empty frame.

    Alternating star contraction: a *large star* hangs every larger neighbour of a node on the
    smallest neighbour, a *small star* hangs the node and its smaller neighbours there. Only
    minima per node and salted equality joins are used, so a node of any degree stays distributed. Every
    round is written, and the loop ends when a round changes no edge, after O(log^2 n) rounds.
    """
    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            pairs = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = pairs.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        joined = salted_join(pairs, least, ["a"], F.xxhash64("b"))
        if large:
            joined = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            return joined.where("a <> b").distinct()
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    def mark(pairs: DataFrame):
        sums = pairs.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(sums)

    pairs = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = mark(pairs)
    for _ in range(rounds):
        after = written(stars(stars(pairs, True), False))
        remove(pairs)
        pairs, before, seen = after, seen, mark(after)
        if before == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))
            ).distinct()
    raise RuntimeError(f"components not settled after {rounds} rounds")
