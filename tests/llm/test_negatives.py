"""Hard negatives against brute force, on clustered, tied and awkward vectors."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnflow.llm import negatives


def brute(ids, labels, values, anchors, positives=5, wanted=3):
    out, score = [], (values @ values.T).astype(int)
    for a in anchors:
        order = sorted((k for k in range(len(ids)) if k != a), key=lambda k: (-score[a, k], ids[k]))
        for p in [k for k in order if labels[k] == labels[a]][:positives]:
            inside = [n for n in order if labels[n] != labels[a] and 50 * score[a, p] <= 100 * score[a, n] <= 95 * score[a, p]]
            out += [(ids[a], ids[p], r + 1, ids[n], score[a, p], score[a, n]) for r, n in enumerate(inside[:wanted])]
    return sorted(out)


def frame(spark, ids, labels, values):
    rows = [(int(i), int(b), [float(x) for x in v]) for i, b, v in zip(ids, labels, values)]
    return spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").withColumns(
        {n: F.lit(1) for n in ("id", "v", "size", "block", "at", "rank", "score", "pivot")}
    )


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_equals_brute_force(spark, spread):
    r = np.random.default_rng(1)
    values = (r.normal(size=(9, 12))[r.integers(0, 9, 400)] + spread * r.normal(size=(400, 12))).round(2)
    values[100:160] = values[7]  # a hot vector: ties
    labels, ids = r.integers(0, 4, 400), r.permutation(1000)[:400]
    whole = np.floor(values * 256)
    df = frame(spark, ids, labels, values)
    awkward = [(2000, None, [1.0] * 12), (2050, 1, None), (2100, 1, [float("nan")] * 12), (None, 1, [1.0] * 12), (2150, 1, []), (2200, 1, [None, 1.0])]
    df = df.unionByName(df.where(f"vec_id = {ids[3]}")).unionByName(
        spark.createDataFrame(awkward, "vec_id bigint, label int, embedding array<double>"), allowMissingColumns=True
    )
    got = negatives.hard_negatives(df, F.col("id") % 10 == 0, factor=256, block_rows=16, round_bytes=16 * 12 * 8 * 2)
    want = brute(ids.tolist(), labels, whole, [k for k in range(400) if ids[k] % 10 == 0])
    assert sorted(tuple(x) for x in got.collect()) == want


def test_sizes_apart_and_nothing_at_all(spark):
    df = frame(spark, [0, 1, 2, 3], [1, 1, 2, 2], [[4, 0], [4, 1], [3, 0], [9, 0, 0]])
    got = [tuple(x) for x in negatives.hard_negatives(df, F.col("id") % 1 == 0).collect()]
    assert (0, 1, 1, 2, 16, 12) in got and all(3 not in (x[0], x[3]) for x in got)
    assert negatives.hard_negatives(df.limit(0), F.col("id") >= 0).count() == 0
    assert negatives.hard_negatives(df, F.col("id") < 0).count() == 0


def test_tree_bounds_hold_and_save_scores():
    r = np.random.default_rng(2)
    centres = 20 * r.normal(size=(6, 16))
    anchors = np.floor(centres[r.integers(0, 6, 60)] + 0.1 * r.normal(size=(60, 16)))
    points = np.floor(centres[r.integers(0, 6, 1000)] + r.normal(size=(1000, 16)))
    order, parent, edge = negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(60)) and (parent[1:] < np.arange(1, 60)).all()
    row = {"size": 16, "ids": order.tobytes(), "labels": np.zeros(60, np.int64).tobytes(), "points": anchors[order].tobytes(), "parent": parent.tobytes(), "edge": edge.tobytes()}
    block = negatives.Block(row)
    exact = anchors[order] @ points.T
    low, high = np.sort(exact, axis=1)[:, 980][None, :], np.full((1, 60), np.inf)
    search = negatives.Search(block, low, high, 20, True)
    search.feed(np.arange(100, 1100), np.zeros(1000, np.int64), points)
    found = search.found()
    assert search.scored < 0.7 * exact.size
    want = {(int(order[a]), 100 + int(k)) for a in range(60) for k in np.lexsort((np.arange(1000), -exact[a]))[:20]}
    assert set(map(tuple, found[["anchor_id", "id"]].to_numpy().tolist())) == want


def test_first_rows_of_a_query_by_pandas(spark):
    from tarnflow.llm.queries import op11_negatives

    folder = "/root/testdata/sf0.001"
    df = pd.read_parquet(f"{folder}/embeddings.parquet")
    label = np.where(df.vec_id % 7 == 0, (df.label + 1) % 10, df.label)
    values = np.floor(np.stack(df.embedding.to_numpy()).astype(np.float64) * 256)
    got = sorted(tuple(r) for r in op11_negatives(spark, folder).collect())
    assert got == brute(df.vec_id.tolist(), label, values, np.flatnonzero(df.vec_id % 50 == 0).tolist()) and len(got) > 50
