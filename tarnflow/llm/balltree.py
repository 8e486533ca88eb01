"""Exact top-k by inner product: ball trees with branch and bound, one per shard.

Vectors are dealt into shards of bounded size by a hash, queries into blocks that go out in rounds of
bounded bytes; a task builds the tree of a shard once a round, for all queries of the round. A node holds
centre c and radius r, so no vector in it scores more than q c + |q| r. Every query starts with its k-th
best score among a bounded set of long vectors, the likeliest winners; all shards share that score, and a
task hands its k-th scores on from shard to shard.
Levels are descended for all queries at once, leaves are visited by decreasing bound, and the k-th
score rises on the way. A node is left out only where its bound is below the k-th score, so ties
are kept, and the result is exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.llm.common import release, remove, written
from tarnflow.llm.vectors import ROUND_BYTES, Block, blobs, dealt, few, searched, usable

LEAF = 64


def scaled(value: Column, factor: int = 64) -> Column:
    """Components as integers, floor(factor * x), kept as doubles."""
    return F.transform(value, lambda x: F.floor(x * F.lit(float(factor))).cast("double"))


class BallTree:
    """Median splits along the direction of widest spread, level by level; leaves are equally full."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(ids) / LEAF)))))
        order, bounds = np.arange(len(ids)), [(0, len(ids))]
        self.levels = []
        for level in range(self.depth + 1):
            centres, radii, halves = [], [], []
            for a, b in bounds:
                here = vectors[order[a:b]]
                centre = here.mean(axis=0) if b > a else np.zeros(vectors.shape[1])
                centres.append(centre)
                radii.append(np.sqrt(((here - centre) ** 2).sum(axis=1).max()) if b > a else 0.0)
                if level < self.depth:
                    middle = (a + b) // 2
                    if b - a > 1:
                        far = here[((here - centre) ** 2).sum(axis=1).argmax()]
                        order[a:b] = order[a:b][np.argsort(here @ (far - centre), kind="stable")]
                    halves += [(a, middle), (middle, b)]
            self.levels.append((np.array(centres), np.array(radii), bounds))
            bounds = halves
        self.ids, self.vectors = ids[order], vectors[order]

    def search(self, names: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, score) of all that may be among the k best; ``known``: k-th scores so far."""
        kth, length = known.copy(), np.sqrt((queries**2).sum(axis=1))
        top = np.full((len(queries), k), -np.inf)
        alive = np.ones((len(queries), 1), dtype=bool)
        slack = 1e-9 * (1 + length * np.sqrt((self.vectors**2).sum(axis=1).max(initial=0)))[:, None]
        for centres, radii, bounds in self.levels:
            bound = queries @ centres.T + length[:, None] * radii[None, :] + slack
            if alive.shape[1] < len(bounds):
                alive = np.repeat(alive, 2, axis=1)
            alive &= bound >= kth[:, None]
        out = []
        for leaf in np.argsort(-np.where(alive, bound, -np.inf).max(axis=0), kind="stable"):
            rows = np.flatnonzero(alive[:, leaf] & (bound[:, leaf] >= kth))
            a, b = bounds[leaf]
            if not len(rows) or a == b:
                continue
            score = queries[rows] @ self.vectors[a:b].T
            score[names[rows][:, None] == self.ids[a:b][None, :]] = -np.inf
            hit_row, hit = np.nonzero((score >= kth[rows][:, None]) & np.isfinite(score))
            out.append((rows[hit_row], self.ids[a:b][hit], score[hit_row, hit]))
            both = np.concatenate([top[rows], score], axis=1)
            top[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            kth[rows] = np.maximum(kth[rows], top[rows].min(axis=1))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row, ids, score = (np.concatenate(x) for x in zip(*out))
        keep = score >= kth[row]
        row, ids, score = row[keep], ids[keep], score[keep]
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        return row[place < k], ids[place < k], score[place < k]


def top_k(
    vectors: DataFrame, query: Column, k: int = 20, factor: int | None = None, key: str = "vec_id", vector: str = "embedding",
    shard_rows: int = 8192, block_rows: int = 1024, seeds: int = 1024, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """For every row where ``query(id)`` holds, the ``k`` other rows of highest inner product.

    Columns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` (double); ties go to the smaller
    id; fewer rows if there are fewer. ``query`` is a condition on ``id``. With ``factor`` components
    are first made integers, floor(factor * x), whose sums are exact. Rows are compared within one
    number of components. Unusable rows: see :func:`usable`; an empty table gives no rows.
    """
    rows = usable(vectors, key, vector)
    if factor is not None:
        rows = rows.withColumn("v", scaled(F.col("v"), factor))
    rows = written(rows)
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    long = few(rows, seeds, F.desc(length))
    shards, n_shards = dealt(rows, "shard", rows.count(), shard_rows)
    asked, _ = dealt(rows.where(query), "block", rows.where(query).count(), block_rows)
    shards, asked = blobs(shards, "shard"), blobs(asked, "block")
    remove(rows)
    release(rows.sparkSession)

    def start(block: Block, by_size: dict) -> None:
        if block.size in by_size and len(by_size[block.size][0]) > k:
            ids, values = by_size[block.size]
            score = block.questions @ values.T
            score[block.names[:, None] == ids[None, :]] = -np.inf
            block.limit = -np.partition(score, len(ids) - k, axis=1)[:, -k]

    def search(ids: np.ndarray, values: np.ndarray, blocks: list[Block], by_size: dict) -> None:
        tree = BallTree(ids, values)
        for block in blocks:
            row, found, score = tree.search(block.names, block.questions, k, -block.limit)
            block.keep(row, found, -score)

    return searched(shards, asked, n_shards, k, search, long, start, sign=-1, round_bytes=round_bytes)
