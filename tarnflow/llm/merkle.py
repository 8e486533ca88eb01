"""Merkle manifest of a table: a tree per run, a tree over the runs, and a witness for every row.

Rows of a run (such as a language) are numbered in key order and dealt into aligned blocks of 2^12.
A block is grown leaf by leaf: complete subtrees that still lack a sibling stay open, every leaf in
them holds a partial witness, and the completion of a sibling extends the witnesses on both sides. The
root of a block is then appended, as one more leaf, to the tree of the block roots, which is dealt into
blocks in turn, until a run has one root. Roots of runs are appended to the last tree the same way.

A later batch comes after the rows a manifest holds: full blocks stay as they are, only the open block
of each run and the blocks above it are grown on (:func:`append`).

A witness is an array with one step a level, from the leaf up: ``L`` or ``R`` and the sibling that stands
to the left or right, or ``-`` where a node of odd number goes up alone.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tarnflow.llm.common import numbered, written

HEIGHT = 12
ALONE = "-"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of strings put together."""
    return F.sha2(F.concat(*values).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """The leaf of a row: of each value its UTF-8 byte count, ``:`` and itself, or ``-`` where it is null."""
    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), ALONE).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(*[told(value) for value in values])


def _joined(left: str, right: str = "") -> str:
    return hashlib.sha256((left + right).encode()).hexdigest()


def grown(digests: list[str], height: int | None = None) -> tuple[str, list[list[str]]]:
    """Root of the tree over these leaves and the witness of each.

    With ``height`` lone nodes go up until the root stands that high, as the root of an open block
    beside full ones does.
    """
    steps: list[list[str]] = [[] for _ in digests]
    open_: list[tuple[int, int, str]] = []  # (height, first leaf, digest), heights falling

    def met(level: int, first: int, node: str, end: int) -> None:
        """A subtree over leaves first..end is complete: its siblings complete with it, as far as they go."""
        while open_ and open_[-1][0] == level:
            _, start, left = open_.pop()
            for k in range(start, first):
                steps[k].append("R" + node)
            for k in range(first, end):
                steps[k].append("L" + left)
            level, first, node = level + 1, start, _joined(left, node)
        open_.append((level, first, node))

    for at, node in enumerate(digests):
        met(0, at, node, at + 1)
    while len(open_) > 1 or height is not None and open_[0][0] < height:
        level, first, node = open_.pop()
        for k in range(first, len(digests)):
            steps[k].append(ALONE)
        met(level + 1, first, _joined(node), len(digests))
    return open_[0][2], steps


class Manifest(NamedTuple):
    """``levels[0]`` has the rows, each further level the block roots of the one below.

    Columns: ``run``, ``at`` (place in the run), ``digest``, ``item`` (the row's own columns, at level 0),
    ``total`` (nodes of the run when the block was grown), ``steps`` (witness inside the block) and
    ``top`` (root of the block).
    """

    levels: list[DataFrame]
    height: int


def _grow(nodes: DataFrame, height: int) -> DataFrame:
    """Every block of ``nodes`` grown as far as its block root."""
    width = 1 << height

    def grow(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        top, steps = grown(block["digest"].to_pylist(), height if block["total"][0].as_py() > width else None)
        block = block.append_column("steps", pa.array(steps, pa.list_(pa.string())))
        return block.append_column("top", pa.array([top] * len(block), pa.string())).drop_columns(["_block"])

    schema = T.StructType([f for f in nodes.schema.fields if f.name != "_block"]).add("steps", T.ArrayType(T.StringType())).add("top", T.StringType())
    return nodes.groupBy("run", "_block").applyInArrow(grow, schema)


def _append(old: list[DataFrame], fresh: DataFrame, height: int) -> list[DataFrame]:
    """Levels after ``fresh`` nodes (run, at, digest, item), which follow or replace the last of the old ones."""
    levels, depth = [], 0
    while True:
        spans = fresh.groupBy("run", F.shiftright("at", height).alias("_block")).agg(F.min("at").alias("_first"), F.max("at").alias("_last"))
        totals = spans.groupBy("run").agg(F.min("_first").alias("_first"), (F.max("_last") + 1).alias("total"))
        kept = None
        if depth < len(old):
            held = old[depth].join(totals.withColumnRenamed("total", "_total"), "run", "left")
            first = F.col("_first")
            # Blocks before the one where the first fresh node stands are full and stay, unless a run
            # has had one block only, whose root is not yet a node of the level above.
            earlier = F.shiftright("at", height) < F.shiftright(first, height)
            shut = first.isNull() | (earlier & (F.col("total") > (1 << height)))
            kept = held.where(shut).select(*old[depth].columns)
            fresh = fresh.unionByName(held.where(~shut & (F.col("at") < first)).select(*fresh.columns))
            again = held.where(~shut).select("run", F.shiftright("at", height).alias("_block")).distinct()
            spans = spans.select("run", "_block").unionByName(again).distinct()
        # A run's total reaches its rows by way of the blocks, which are few, so no run meets in one task.
        blocks = spans.select("run", "_block").join(totals.select("run", "total"), "run")
        placed = fresh.withColumn("_block", F.shiftright("at", height)).join(blocks, ["run", "_block"])
        after = written(_grow(placed.select("run", "_block", "at", "digest", "item", "total"), height))
        roots = after.where(F.col("total") > (1 << height)).select(
            "run", F.shiftright("at", height).alias("at"), F.col("top").alias("digest"), F.lit(None).cast("string").alias("item")
        ).distinct()
        levels.append(after if kept is None else written(kept.unionByName(after)))
        depth += 1
        if roots.isEmpty():
            # Levels above are there only for runs without fresh nodes.
            return levels + old[depth:]
        fresh = roots


def append(manifest: Manifest | None, docs: DataFrame, run: str, key: str, leaf_of: Column, keep: dict[str, Column] | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest with one more batch, or a first one if there is none.

    Rows are ordered by key inside their run, nulls first, rows of one key by their leaf; every repeated row
    is a leaf of its own. A null run is a run. Keys of the batch must not come before those held in
    their run; otherwise ValueError. ``leaf_of`` and ``keep`` are columns of ``docs``; what is kept is
    carried beside the key. An empty batch changes nothing, an empty manifest has no rows.
    """
    if manifest is not None:
        height = manifest.height
    name = F.when(docs[run].isNull(), ALONE).otherwise(F.concat(F.lit("="), docs[run].cast("string")))
    item = F.struct(docs[key].alias("key"), docs[run].alias("run"), *[c.alias(n) for n, c in (keep or {}).items()])
    rows = written(docs.select(name.alias("run"), leaf_of.alias("digest"), item.alias("item")))
    placed = numbered(rows, ["run"], [F.col("item.key").asc_nulls_first(), F.col("digest")], "at")
    if manifest is None or not manifest.levels:
        return Manifest(_append([], placed, height), height)
    held = manifest.levels[0].groupBy("run").agg(F.count("*").alias("_n"), F.max("item.key").alias("_last"))
    placed = placed.join(held, "run", "left")
    if not placed.where(F.col("_last").isNotNull() & (F.col("item.key").isNull() | (F.col("item.key") < F.col("_last")))).isEmpty():
        raise ValueError("keys of the batch come before those the manifest holds")
    placed = placed.withColumn("at", F.col("at") + F.coalesce("_n", F.lit(0))).drop("_n", "_last")
    return Manifest(_append(manifest.levels, placed, height), height)


def _to_root(levels: list[DataFrame], height: int) -> DataFrame:
    """Rows of the lowest level with the witness up to the root of their run."""
    rows = levels[0].select("run", "at", "digest", "item", "steps", "top", F.shiftright("at", height).alias("_up"))
    for level in levels[1:]:
        above = level.select("run", F.col("at").alias("_up"), F.col("steps").alias("_more"), F.col("top").alias("_top"))
        rows = rows.join(above, ["run", "_up"], "left").select(
            "run", "at", "digest", "item", F.concat("steps", F.coalesce("_more", F.array().cast("array<string>"))).alias("steps"),
            F.coalesce("_top", "top").alias("top"), F.shiftright("_up", height).alias("_up"),
        )
    return rows.drop("_up")


def proofs(manifest: Manifest) -> DataFrame:
    """One row per row of the table: ``item``, ``at``, ``leaf``, ``subroot``, ``root`` and ``steps``, leaf to root."""
    rows = _to_root(manifest.levels, manifest.height)
    runs = written(rows.where("at = 0").select("run", F.col("top").alias("digest")))
    placed = numbered(runs, [], [F.col("run")], "at").select(
        F.lit("").alias("run"), "at", "digest", F.col("run").alias("item")
    )
    over = _to_root(_append([], placed, manifest.height), manifest.height)
    over = over.select(F.col("item").alias("run"), F.col("steps").alias("_more"), F.col("top").alias("root"))
    return rows.join(over, "run").select(
        "item", "at", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root", F.concat("steps", "_more").alias("steps")
    )


def folded(leaf_: Column, steps: Column) -> Column:
    """The root that a leaf and a witness give."""
    def up(node: Column, step: Column) -> Column:
        sibling, side = F.substring(step, 2, 64), F.substring(step, 1, 1)
        return F.when(side == "L", digest(sibling, node)).when(side == "R", digest(node, sibling)).otherwise(digest(node))

    return F.aggregate(steps, leaf_, up)


def siblings(steps: Column) -> Column:
    """The siblings of a witness put together, leaf to root."""
    return F.array_join(F.transform(F.filter(steps, lambda s: s != ALONE), lambda s: F.substring(s, 2, 64)), "")


def documents_manifest(docs: DataFrame, tampered: dict[str, Column], height: int = HEIGHT) -> DataFrame:
    """Manifest of ``documents`` by language, and what becomes of its proofs when columns are replaced as in ``tampered``.

    Columns ``doc_id``, ``leaf``, ``subroot``, ``root`` and ``proof_sha256`` of the table as it is, ``folded_root`` from
    the leaf of the replaced columns and the siblings as they were, and ``verified`` (it equals the root).
    Null ids, texts and languages, empty texts, repeated ids and rows: each row is a leaf; see :func:`append`.
    """
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    other = leaf(*[tampered.get(n, docs[n]) for n in names])
    made = append(None, docs, "lang", "doc_id", leaf(*[docs[n] for n in names]), {"other": other}, height)
    out = proofs(made).withColumn("folded_root", folded(F.col("item.other"), F.col("steps")))
    return out.select(
        F.col("item.key").alias("doc_id"), "leaf", "subroot", "root", digest(siblings(F.col("steps"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
