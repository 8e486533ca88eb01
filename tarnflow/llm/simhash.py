"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into ``distance // 2 + 1`` segments, so that of two fingerprints within the
distance one segment differs in at most one bit. Each segment is indexed once per bit position
with that bit left out: segments that differ in at most one bit agree on one of these variants.
Equal variants are joined and the pairs verified.

Only different fingerprints are indexed; copies share one. Where many fingerprints share a variant,
they aren't compared all with all: two of them in a distance of two bits or less are both in a distance of one
of some third value, so they are joined on all values one bit away, of which no more than 65 fingerprints share one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.llm.common import components, keyed, parts, salted_join, unkeyed, written

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BATCH = 1 << 18  # shingles whose bits are counted at once


def shingle_hashes(text: str, words: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of each run of ``words`` words, joined by spaces; of all of them if there are fewer."""
    found = WORD.findall(text.translate(UPPER))
    if not found:
        return []
    runs = zip(*(found[k:] for k in range(words))) if len(found) > words else [found]
    one = xxhash.xxh64_intdigest
    return [one(s, seed) for s in map(" ".join, runs)]


def majority(hashes: list[int]) -> int:
    """Bit k is set if it is set in over half of the hashes; no hashes give zero."""
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), BATCH):
        block = np.array(hashes[begin : begin + BATCH], dtype="<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, with_code: bool = False) -> DataFrame:
    """``key`` and ``fp``, the 64-bit fingerprint as a signed long, of every row; ``code``, a hash of the text, if asked for.

    A null text counts as empty; a text without words has fingerprint zero. Whole texts are used.
    Repeated rows and ties need no rule: each row is taken for itself. Other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.pop("_text").fillna("").tolist()
            found = [majority(shingle_hashes(t, words)) for t in texts]
            yield batch.assign(fp=np.array(found, dtype=np.int64))

    rows = keyed(docs, key, text)
    if with_code:
        rows = rows.withColumn("code", text_code(F.col("_text")))
    return unkeyed(rows.mapInPandas(run, "_key string, " + "code bigint, " * with_code + "fp bigint"), docs, key)


def text_code(text: Column) -> Column:
    """64-bit hash of a text; a null text counts as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def signed(bits: int) -> Column:
    """The lowest 64 bits of an integer as a long."""
    return F.lit((bits + (1 << 63)) % (1 << 64) - (1 << 63)).cast("bigint")


def masked(value: Column, low: int, size: int) -> Column:
    """``size`` bits of a long from bit ``low`` on."""
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1))


def variants(value: Column, segments: list[tuple[int, int]]) -> Column:
    """All one-bit deletions of all segments: array of struct(place, rest).

    ``place`` numbers segment and deleted bit, ``rest`` is the segment with that bit cleared.
    """
    out = []
    for low, size in segments:
        segment = masked(value, low, size)
        for bit in range(size):
            out.append(F.struct(F.lit(low * 64 + bit).alias("place"), segment.bitwiseAND(signed(~(1 << bit))).alias("rest")))
    return F.array(*out)


def cut_bits(low: int, size: int, pieces: int) -> list[tuple[int, int]]:
    """A range of bits in ``pieces`` nearly equal segments."""
    bounds = [low + size * k // pieces for k in range(pieces + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def links(nodes: DataFrame, distance: int = 2, hot: int = 64) -> DataFrame:
    """All pairs ``a > b`` of nodes whose fingerprints ``fp`` differ in at most ``distance`` bits.

    ``nodes`` has different longs ``node`` with different longs ``fp``. Nodes that share a variant are counted first. Groups of at
    most ``hot`` members are compared pair by pair in a join; the members of larger ones meet in groups of at
    most 65 instead (:func:`around`), or, for a distance of more than two, by a further piece of the fingerprint.
    """
    first = cut_bits(0, 64, distance // 2 + 1)
    nodes = nodes.repartition(parts(nodes.sparkSession), "node")  # every node becomes 64 rows
    indexed = nodes.select("node", "fp", F.explode(variants(F.col("fp"), first)).alias("v")).select(
        "node", "fp", F.xxhash64("v.place", "v.rest").alias("code"), F.col("v.place").alias("place"),
    )
    counts = written(indexed.groupBy("code").agg(F.count("*").alias("n")).where("n > 1"))
    # The counts grow with the nodes, so they aren't broadcast, whatever their size.
    shared = written(salted_join(indexed, counts.hint("merge"), ["code"], F.xxhash64("node")))
    if distance <= 2:
        rows = shared.where(f"n <= {hot}").select("node", "fp", "code").union(around(shared.where(f"n > {hot}")))
    else:
        rows = refined(shared, first, distance, hot, ["node", "fp"])
    close = f"a.code = b.code and a.node > b.node and bit_count(a.fp ^ b.fp) <= {distance}"
    found = rows.alias("a").join(rows.alias("b"), F.expr(close))
    return found.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def around(rows: DataFrame) -> DataFrame:
    """Each different node of ``rows`` by a ``code`` of its fingerprint and of the 64 values one bit away from it.

    Fingerprints that differ in at most two bits share one of these values; no more than 65 different ones share the same.
    """
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(signed(1 << k)) for k in range(64)])
    return rows.select("node", "fp").distinct().select("node", "fp", F.explode(near).alias("value")).select(
        "node", "fp", F.xxhash64(F.lit(-1), "value").alias("code")
    )


def refined(shared: DataFrame, first: list[tuple[int, int]], distance: int, hot: int, carried: list[str]) -> DataFrame:
    """Rows by ``code``; in groups of over ``hot`` members (column ``n``), by code and one further piece."""
    # Members of a large group agree on one segment but for one bit: refine by the other bits.
    rows = shared.where(f"n <= {hot}").select(*carried, "code")
    for low, size in first:
        other = [s for s in (*cut_bits(0, low, 1), *cut_bits(low + size, 64 - low - size, 1)) if s[1]]
        here = shared.where(f"n > {hot}").where(F.col("place").between(low * 64, low * 64 + size - 1))
        parts = F.array(*[masked_with(F.col("fp"), m) for m in spread(other, distance + 1)])
        here = here.select(*carried, "code", F.posexplode(parts).alias("k", "part"))
        rows = rows.union(here.select(*carried, F.xxhash64("code", "k", "part").alias("code")))
    return rows


def spread(ranges: list[tuple[int, int]], pieces: int) -> list[int]:
    """Masks that deal the bits of some ranges into ``pieces`` runs of nearly equal size."""
    bits = [low + k for low, size in ranges for k in range(size)]
    bounds = [len(bits) * k // pieces for k in range(pieces + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(bounds, bounds[1:])]


def masked_with(value: Column, mask: int) -> Column:
    return value.bitwiseAND(signed(mask))


def near_duplicates(docs: DataFrame, distance: int = 2, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in at most ``distance`` bits are linked; the component is
    the smallest key reachable. A null key is kept with its fingerprint's component.
    """
    prints = written(fingerprints(docs, key, text, words)).withColumnRenamed("fp", "node")
    named = classes(prints, connected(prints, distance), key)
    return salted_join(prints, named, ["node"], F.monotonically_increasing_id()).select(
        key, F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id"
    )


def connected(prints: DataFrame, distance: int) -> DataFrame:
    """Components (``node``, ``component``) of the different fingerprints ``node`` of some rows, as far as they have links."""
    return components(links(prints.select("node", F.col("node").alias("fp")).distinct(), distance))


def classes(members: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``node`` and ``component_id``, the smallest key of any member of the node's component."""
    least = members.groupBy("node").agg(F.min(key).alias("_least"))
    rooted = least.join(found, "node", "left").select("node", "_least", F.coalesce("component", "node").alias("_root"))
    roots = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return salted_join(rooted, roots, ["_root"], F.xxhash64("node")).select("node", "component_id")


def keep_first(docs: DataFrame, distance: int = 2, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document, that of smallest key, of each component of :func:`near_duplicates`; all columns.

    Texts without words are alike. Rows with a null key stay and decide nothing. A row is known by key and text: of a
    component the row of smallest key stays, of equal keys the one of smallest hash of the text, and of rows equal in
    both the one whose columns are smallest as JSON. So a key may stand for several texts, and columns may have any type.
    """
    code = "_code"
    while code.lower() in map(str.lower, docs.columns):
        code += "_"
    prints = written(fingerprints(docs, key, text, words, with_code=True)).withColumnRenamed("fp", "node")
    prints = prints.where(F.col(key).isNotNull())
    least = prints.groupBy("node").agg(F.min(F.struct(F.col(key).alias("k"), F.col("code").alias("c"))).alias("first"))
    rooted = least.join(connected(prints, distance), "node", "left")
    firsts = rooted.groupBy(F.coalesce("component", "node")).agg(F.min("first").alias("first"))
    firsts = written(firsts.select(F.col("first.k").alias(key), F.col("first.c").alias(code)))
    kept = docs.withColumn(code, text_code(docs[text])).join(firsts, [key, code], "left_semi").select(*docs.columns, code)
    copies = prints.groupBy(key, F.col("code").alias(code)).count().where("count > 1")
    copies = written(copies.join(firsts, [key, code], "left_semi").select(key, code))
    if not copies.isEmpty():
        # Only rows that repeat key and text are grouped.
        row = F.struct(*docs.columns)
        again = kept.join(copies, [key, code], "left_semi").groupBy(key, code)
        one = again.agg(F.min_by(row, F.to_json(row, {"ignoreNullFields": "false"})).alias("_row"))
        rest = kept.join(copies, [key, code], "left_anti").select(*docs.columns)
        kept = rest.union(one.select("_row.*").select(*docs.columns))
    return kept.select(*docs.columns).union(docs.where(F.col(key).isNull()))
