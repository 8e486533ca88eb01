"""Approximate nearest neighbours by a permutation index.

A bounded sample of vectors are pivots. A vector is represented by the ``prefix`` pivots nearest to
it, in order, and posted with its place in that order in the inverted file of each of them. A query
reads the files of its own nearest pivots and ranks vectors by the footrule distance of the two
orders, where a pivot missing in one of them counts as standing at its end. The best ``share`` of
each shard are measured against the original vectors.

Every vector is indexed. Files are kept by shard of bounded size, queries come in blocks and go out in
rounds of bounded bytes; a task builds the files of a shard once a round, for all queries of the round, so
nothing is gathered. The parameters are set for vectors without
structure, the hardest case: on 10,000 to 50,000 random unit vectors of 64 components recall at 10
is about 0.95 to 0.98; tests measure it against brute force.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.llm.common import release, remove, written
from tarnflow.llm.vectors import ROUND_BYTES, Block, blobs, dealt, few, searched, usable


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first, ties to the smaller number."""
    return np.argsort(squared(vectors, pivots), axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """Per pivot its file: how far from the end of each row's order the pivot stands, 0 for rows it is not near to."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        self.rows, self.prefix = order.shape
        self.whole = self.prefix * (self.prefix + 1) // 2
        self.files = np.zeros((n_pivots, self.rows), np.min_scalar_type(self.whole))
        for place in range(self.prefix):
            self.files[order[:, place], np.arange(self.rows)] = self.prefix - place

    def footrule(self, asked: np.ndarray) -> np.ndarray:
        """Footrule distance of every row to one order, missing pivots at place ``prefix``."""
        left = (self.prefix - np.arange(len(asked))).astype(self.files.dtype)
        # |a - b| = a + b - 2 min(a, b) of distances to the end, where a missing pivot has 0.
        both = np.minimum(self.files[asked], left[:, None]).sum(axis=0, dtype=self.files.dtype)
        return self.whole + int(left.sum(dtype=np.int64)) - 2 * both.astype(np.int64)


def nearest(
    vectors: DataFrame, query: Column, k: int = 10, pivots: int = 256, prefix: int = 128, share: float = 0.15, least: int = 1024,
    key: str = "vec_id", vector: str = "embedding", shard_rows: int = 8192, block_rows: int = 256, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """For every row where ``query`` (a condition on ``id``) holds, the ``k`` nearest other rows found.

    Columns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the Euclidean distance of the original
    vectors. Ties go to the smaller id, all others are returned if there are fewer. Zero vectors and
    those :func:`usable` leaves out take no part; rows are compared within one number of components.
    Of each shard ``share`` of the rows, but at least ``least``, are measured: a small table wholly.
    An empty table gives no rows, repeated rows count once.
    """
    rows = usable(vectors, key, vector).where(F.exists("v", lambda x: x != 0))
    rows = written(rows)
    chosen = {size: np.unique(values, axis=0) for size, (_, values) in few(rows, pivots, F.xxhash64("id", F.lit("pivot"))).items()}
    parts, n_shards = dealt(rows, "shard", rows.count(), shard_rows)
    asked, _ = dealt(rows.where(query), "block", rows.where(query).count(), block_rows)
    parts, asked = blobs(parts, "shard"), blobs(asked, "block")
    remove(rows)
    release(rows.sparkSession)

    def search(ids: np.ndarray, values: np.ndarray, blocks: list[Block], by_size: dict) -> None:
        count, files, size = len(ids), None, values.shape[1]
        take = min(count, max(least, int(np.ceil(share * count))))
        if size in by_size and take < count:
            files = InvertedFiles(orders(values, by_size[size], min(prefix, len(by_size[size]))), len(by_size[size]))
        for block in blocks:
            wanted = None if files is None else orders(block.questions, by_size[size], files.prefix)
            out = []
            for k_row, (name, question) in enumerate(zip(block.names, block.questions)):
                some = np.arange(count)
                if files is not None:
                    far = files.footrule(wanted[k_row]) * count + some  # ties to the smaller id
                    some = np.sort(np.argpartition(far, take - 1)[:take])
                some = some[ids[some] != name]
                distance = np.sqrt(((values[some] - question) ** 2).sum(axis=1))
                first = np.lexsort((ids[some], distance))[:k]
                out.append((np.full(len(first), k_row), ids[some][first], distance[first]))
            block.keep(*(np.concatenate(x) for x in zip(*out)))

    return searched(parts, asked, n_shards, k, search, chosen, round_bytes=round_bytes)
