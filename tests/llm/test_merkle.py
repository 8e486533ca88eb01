"""The Merkle manifest against a tree built in one go, in batches, and on awkward tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tarnflow.llm import merkle


def h(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def whole(nodes):
    """Root and, for each leaf, its siblings from the leaf up as (side, digest)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, place in zip(paths, places):
            if place ^ 1 < len(nodes):
                path.append(("L" if place & 1 else "R") + nodes[place ^ 1])
            else:
                path.append("-")
        places = [p // 2 for p in places]
        nodes = [h(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
    return nodes[0], paths


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 11, 16, 29])
def test_grown_leaf_by_leaf(n):
    leaves = [h(str(k)) for k in range(n)]
    assert merkle.grown(leaves) == whole(leaves)


def test_lone_nodes_go_up_to_a_height():
    root, steps = merkle.grown(["a"], 2)
    assert root == h(h("a")) and steps == [["-", "-"]]


def told(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def expected(rows, change):
    """doc_id, leaf, subroot, root, proof, folded root per row (id, text, lang, source, n_chars)."""
    runs = {}
    for i, text, lang, source, n in rows:
        runs.setdefault(lang, []).append((i is not None, i or 0, told(i, source, lang, n, text), told(i, source, lang, change(i, n), text), i))
    names = sorted(runs, key=lambda r: (r is not None, (r or "").encode()))
    trees = {lang: whole([x[2] for x in sorted(rows)]) for lang, rows in runs.items()}
    root, over = whole([trees[lang][0] for lang in names])
    out = []
    for lang, up in zip(names, over):
        for (_, _, leaf, other, i), path in zip(sorted(runs[lang]), trees[lang][1]):
            node = other
            for step in path + up:
                node = h(node) if step == "-" else h(step[1:], node) if step[0] == "L" else h(node, step[1:])
            out.append((i, leaf, trees[lang][0], root, h(*[s[1:] for s in path + up if s != "-"]), node, node == root))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns(
        {n: F.lit(1) for n in ("at", "run", "digest", "item", "steps", "top", "total")}
    )


ROWS = [(k, f"text {k} é", "abc"[k % 3] if k % 5 else None, f"s{k}", k) for k in range(40)]
ROWS += [(None, "x", "a", None, None), (None, "x", "a", None, None), (None, None, "a", "s", 0), (7, "again", "b", "s", 3), (7, "again", "b", "s", 3), (99, "", "É", "", None)]


@pytest.mark.parametrize("height", [2, 12])
def test_manifest_equals_a_tree_built_in_one_go(spark, rows, height):
    change = {"n_chars": F.when(F.col("doc_id") % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    got = merkle.documents_manifest(table(spark, ROWS), change, height)
    want = expected(ROWS, lambda i, n: n + 1 if i is not None and i % 7 == 0 and n is not None else n)
    assert rows(got) == sorted(want, key=lambda r: tuple(f"{x}" for x in r))
    assert {r["verified"] for r in got.collect()} == {True, False}


def test_batches_give_the_same_manifest(spark, rows):
    height = 2
    every = sorted((r for r in ROWS if r[0] is not None), key=lambda r: r[0])
    made = None
    for a, b in ((0, 5), (5, 5), (5, 31), (31, len(every))):
        made = merkle.append(made, table(spark, every[a:b]), "lang", "doc_id", merkle.leaf(F.col("doc_id"), F.col("text")), height=height)
    at_once = merkle.append(None, table(spark, every), "lang", "doc_id", merkle.leaf(F.col("doc_id"), F.col("text")), height=height)
    a, b = merkle.proofs(made), merkle.proofs(at_once)
    assert rows(a) == rows(b) and a.count() == len(every)
    assert a.where(merkle.folded(F.col("leaf"), F.col("steps")) != F.col("root")).count() == 0
    with pytest.raises(ValueError):
        merkle.append(made, table(spark, every[:1]), "lang", "doc_id", merkle.leaf(F.col("doc_id")), height=height)


def test_empty_and_lone(spark):
    assert merkle.documents_manifest(table(spark, ROWS).limit(0), {}).count() == 0
    row = merkle.documents_manifest(table(spark, ROWS[:1]), {}).collect()[0]
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == h("") and row["verified"]
