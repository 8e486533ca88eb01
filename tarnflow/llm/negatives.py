"""Hard negatives by spanning trees of anchors.

Anchors are ordered by their nearest pivot and cut into blocks; each block gets a minimum spanning tree
by distance. For a candidate x the score at an anchor lies within (edge length) * |x| of its score at the
parent, so bounds run down the tree: where they miss the window that is asked for, nothing is computed and
the child passes wider bounds on; where they overlap it, the candidate is scored exactly there.

Blocks go out in rounds of bounded bytes, and each round is one pass over the candidates, which are
neither shuffled nor copied per block. A first pass finds positives (the best of an anchor's own label), a
second one the best of other labels inside a window of each positive's score. Every task starts from the
thresholds that a bounded sample of candidates gives, so it hands on few rows that a better one beats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.llm.common import numbered, sampled, shared_folder, written

#: Anchors in one tree, and bytes of anchors in one round.
BLOCK, ROUND_BYTES = 1024, 32 << 20
#: Candidates compared with a tree at once, pivots for the order of the anchors, sampled rows for first thresholds.
CHUNK, PIVOTS, SEEDS = 2048, 64, 2048


def prepared(vectors: DataFrame, key: str, vector: str, label: str, factor: int | None) -> DataFrame:
    """``id``, ``label``, ``v`` (array of double) and ``size``, one row per key.

    Null keys and labels, null and empty vectors and vectors with null or non-finite components are left
    out; of rows with one key the smallest (vector, label) counts. With ``factor`` components become
    floor(factor * x); scores are exact as long as they stay below 2^53.
    """
    rows = vectors.select(
        vectors[key].cast("bigint").alias("id"), vectors[label].cast("bigint").alias("label"), vectors[vector].cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    rows = rows.groupBy("id").agg(F.min(F.struct("v", "label")).alias("row")).select("id", "row.label", "row.v")
    if factor is not None:
        rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(factor))).cast("double")))
    return rows.withColumn("size", F.size("v"))


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parents (places in the order) and edge lengths of a minimum spanning tree from the first point."""
    n = len(points)
    squares = (points**2).sum(axis=1)
    order, parent, edge = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    near, by = np.full(n, np.inf), np.zeros(n, np.int64)
    left, at = np.ones(n, dtype=bool), 0
    for place in range(n):
        order[place], parent[place], left[at] = at, by[at], False
        # From the difference itself, so that close points have a true length.
        edge[place] = 0.0 if place == 0 else np.sqrt(((points[at] - points[order[by[at]]]) ** 2).sum())
        far = squares + squares[at] - 2 * (points @ points[at])
        closer = left & (far < near)
        near[closer], by[closer] = far[closer], place
        at = int(np.where(left, near, np.inf).argmin())
    return order, parent, edge


class Block:
    """Anchors of one block in tree order, level by level."""

    def __init__(self, row):
        size = int(row["size"])
        self.size = size
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.points = np.frombuffer(row["points"]).reshape(-1, size)
        self.parent, self.edge = np.frombuffer(row["parent"], np.int64), np.frombuffer(row["edge"])
        depth = np.zeros(len(self.ids), np.int64)
        for k in range(1, len(depth)):
            depth[k] = depth[self.parent[k]] + 1
        self.levels = [np.flatnonzero(depth == d) for d in range(depth.max() + 1)]


class Search:
    """The ``k`` best candidates of each anchor of a block inside each of its windows.

    ``low`` and ``high`` have a row per window and a column per anchor. ``same``: candidates of the anchor's
    label, else those of others. The anchor itself is no candidate. ``scored`` counts exact scores.
    """

    def __init__(self, block: Block, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.block, self.low, self.high, self.k, self.same, self.scored = block, low.copy(), high, k, same, 0
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)) for _ in low]

    def inside(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (anchor, candidate) and where they are exact and may be inside a window."""
        block, norms = self.block, np.sqrt((points**2).sum(axis=1))
        least, most = self.low.min(axis=0), self.high.max(axis=0)
        low = np.empty((len(block.ids), len(points)))
        high, hit = np.empty_like(low), np.zeros(low.shape, dtype=bool)
        for level in block.levels:
            if level[0] == 0:
                overlap = np.ones((1, len(points)), dtype=bool)
            else:
                spread = block.edge[level][:, None] * norms[None, :] * (1 + 1e-9) + 1e-6
                low[level], high[level] = low[block.parent[level]] - spread, high[block.parent[level]] + spread
                overlap = (high[level] >= least[level][:, None]) & (low[level] <= most[level][:, None])
            dense = overlap.mean(axis=1) > 0.2
            if dense.any():
                some = level[dense]
                low[some] = high[some] = block.points[some] @ points.T
                self.scored += len(some) * len(points)
            for anchor, here in zip(level[~dense], overlap[~dense]):
                at = np.flatnonzero(here)
                low[anchor, at] = high[anchor, at] = points[at] @ block.points[anchor]
                self.scored += len(at)
            hit[level] = overlap
        return low, hit

    def feed(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> None:
        """Compare candidates; what is kept are the best so far."""
        for start in range(0, len(ids), CHUNK):
            here = slice(start, start + CHUNK)
            score, hit = self.inside(points[here])
            alike = self.block.labels[:, None] == labels[here][None, :]
            hit &= (alike if self.same else ~alike) & (self.block.ids[:, None] != ids[here][None, :])
            for w in range(len(self.low)):
                anchor, at = np.nonzero(hit & (score >= self.low[w][:, None]) & (score <= self.high[w][:, None]))
                self._keep(w, anchor, score[anchor, at], ids[here][at])

    def _keep(self, w: int, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(anchor):
            return
        anchor, score, ids = (np.concatenate(x) for x in zip(self.best[w], (anchor, score, ids)))
        order = np.lexsort((ids, -score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        place = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
        full = anchor[place == self.k - 1]
        self.low[w][full] = np.maximum(self.low[w][full], score[place == self.k - 1])
        top = place < self.k
        self.best[w] = anchor[top], score[top], ids[top]

    def found(self) -> pd.DataFrame:
        rows = [pd.DataFrame({"anchor_id": self.block.ids[a], "slot": np.int32(w), "id": i, "score": s.astype(np.int64)}) for w, (a, s, i) in enumerate(self.best)]
        return pd.concat(rows, ignore_index=True)


def _arrays(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return part["id"].to_numpy(np.int64), part["label"].to_numpy(np.int64), np.stack(part["v"].to_numpy()).astype(np.float64)


def trees(anchors: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """One row per block of anchors: ids, labels, points, parents and edges as binary, in tree order."""
    pivots = {}
    for size, part in sampled(anchors, max(1, anchors.count()), PIVOTS, F.lit("pivot"), F.col("id")).toPandas().groupby("size"):
        pivots[int(size)] = _arrays(part.sort_values("id"))[2]

    def nearest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            pivot = np.zeros(len(part), np.int32)
            for size, rows in part.reset_index(drop=True).groupby("size"):
                if size in pivots:
                    own = _arrays(rows)[2]
                    pivot[rows.index] = ((pivots[size] ** 2).sum(axis=1)[None, :] - 2 * own @ pivots[size].T).argmin(axis=1)
            yield part.assign(pivot=pivot)

    def tree(part: pd.DataFrame) -> pd.DataFrame:
        ids, labels, points = _arrays(part.sort_values("id"))
        order, parent, edge = spanning_tree(points)
        return pd.DataFrame({
            "size": [int(part["size"].iloc[0])], "block": [int(part["block"].iloc[0])], "ids": [ids[order].tobytes()], "labels": [labels[order].tobytes()],
            "points": [points[order].tobytes()], "parent": [parent.tobytes()], "edge": [edge.tobytes()],
        })

    near = written(anchors.mapInPandas(nearest, "id bigint, label bigint, v array<double>, size int, pivot int"))
    placed = numbered(near, ["size"], [F.col("pivot"), F.col("id")], "at")
    blocks = placed.withColumn("block", F.floor(F.col("at") / block_rows).cast("int")).groupBy("size", "block")
    return written(blocks.applyInPandas(tree, "size int, block int, ids binary, labels binary, points binary, parent binary, edge binary"))


def _windows(block: Block, positives: dict[int, dict[int, int]] | None, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Limits of each window and anchor: one without limits, or one per rank of ``positives`` (rank: anchor: score)."""
    n = len(block.ids)
    if positives is None:
        return np.full((1, n), -np.inf), np.full((1, n), np.inf)
    ranks = max(positives, default=1)
    low, high = np.full((ranks, n), np.inf), np.full((ranks, n), -np.inf)
    for rank, scores in positives.items():
        for at, name in enumerate(block.ids.tolist()):
            if name in scores:
                low[rank - 1, at], high[rank - 1, at] = -(-least * scores[name] // 100), most * scores[name] // 100
    return low, high


def _pass(rows: DataFrame, blocks: list, seeds: pd.DataFrame, k: int, positives: dict | None = None, least: int = 0, most: int = 0) -> DataFrame:
    """The ``k`` best of every anchor and window over all rows: ``anchor_id``, ``slot``, ``id``, ``score``, ``rank``.

    Of the anchor's own label without ``positives``, else of others, a window for each rank of them.
    """
    sent = rows.sparkSession.sparkContext.broadcast(([r.asDict() for r in blocks], seeds, positives))
    same = positives is None

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows_, first, scores = sent.value
        searches: list[Search] = []
        for block in map(Block, rows_):
            low, high = _windows(block, scores, least, most)
            search = Search(block, low, high, k, same)
            here = first[first["size"] == block.size]
            if len(here):
                search.feed(*_arrays(here))
                # Thresholds stay; the rows are met again where they belong.
                search = Search(block, search.low, high, k, same)
            searches.append(search)
        for part in parts:
            for size, own in part.groupby("size"):
                arrays = _arrays(own)
                for search in searches:
                    if search.block.size == size:
                        search.feed(*arrays)
        for search in searches:
            yield search.found()

    met = rows.mapInPandas(compare, "anchor_id bigint, slot int, id bigint, score bigint")
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return met.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, factor: int | None = None,
    key: str = "vec_id", vector: str = "embedding", label: str = "label", block_rows: int = BLOCK, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """For each anchor and positive the best rows of another label inside a window of the positive's score.

    Anchors are the rows where ``anchor(id)`` holds. Scores are inner products; with ``factor`` of components made
    integers. An anchor's positives are its best other rows of the same label, its negatives for one
    of them the first rows of other labels with least/100 * p <= score <= most/100 * p (window limits in integers). Ties
    go to the smaller key; fewer rows if there are fewer. Vectors are compared within one number of components.
    Rows that take no part: see :func:`prepared`. An empty table and a table without anchors give no rows.
    Columns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.
    """
    spark = vectors.sparkSession
    rows = written(prepared(vectors, key, vector, label, factor))
    n_rows, widest = rows.agg(F.count("*"), F.max("size")).first()
    folder = shared_folder(spark)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], schema).write.parquet(folder)
    made = trees(rows.where(anchor), block_rows)
    seeds = sampled(rows, max(1, n_rows), SEEDS, F.lit("seed"), F.col("id")).toPandas()
    # Names of the blocks only: their content comes to the driver a round at a time.
    names = [(r["size"], r["block"]) for r in made.select("size", "block").sort("size", "block").toLocalIterator()]
    together = max(1, round_bytes // (8 * block_rows * (widest or 1)))
    for start in range(0, len(names), together):
        of = names[start:start + together]
        blocks = made.where(F.struct("size", "block").between(F.struct(*map(F.lit, of[0])), F.struct(*map(F.lit, of[-1])))).collect()

        own = written(_pass(rows, blocks, seeds, positives))
        told = own.select("anchor_id", "rank", "score").toPandas()  # a few rows for each anchor of the round
        by_rank = {int(r): dict(zip(p["anchor_id"].tolist(), p["score"].tolist())) for r, p in told.groupby("rank")}
        others = _pass(rows, blocks, seeds, negatives, by_rank, least, most).select(
            "anchor_id", (F.col("slot") + 1).alias("of"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
        )
        own = own.select("anchor_id", F.col("rank").alias("of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        others.join(own, ["anchor_id", "of"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode(
            "append"
        ).parquet(folder)
    return spark.read.schema(schema).parquet(folder)
