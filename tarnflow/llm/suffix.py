"""Repeated passages by a logarithmic family of sparse suffix arrays.

A byte is repeated if a string of ``length`` bytes that covers it also starts earlier (smaller
key, or same key and earlier start). Strings are taken from the input and never cross documents.

*Sampling.* Of the ``length - GRAM + 1`` grams inside a string the one of least hash is its anchor, so
equal strings have equal anchors at equal places. Consecutive strings share an anchor: a document
of n bytes has about n / 40 anchors, each with the stretch of text its strings cover together.

*Arrays.* Of each batch the suffixes that start at anchors are sorted by (code of the gram they
begin with, code of their stretch, place). That is the batch's array, in an order of hash codes
rather than letters, which finds equal starts just as well and spreads evenly over partitions.

*Levels.* A new batch is merge-scanned against all existing levels in one sorted pass. A suffix
whose gram and stretch both stand earlier in the scan is repeated whole. Suffixes that share their
gram only are borders: some of their strings may be repeated. A level keeps the first suffix of
each stretch. Where a level of the batch's size exists, both are merged to one of twice the size.
Batches come in the order of keys, so existing levels are always earlier.

*Borders.* At the end the stretches of all borders, and of no other suffix, are cut out of the texts
and the first starts of their strings found by equality of 128 bits of hash.

Repeats are first looked for inside each block of documents. So a passage that a third of all rows
share reaches a shuffle once a block, not once a row, and no step gathers a group.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tarnflow.llm.common import release, remove, written

GRAM = 40
ROUNDS = 4  # in which borders are compared, by gram; only one round's shuffle is on disk
BLOCK = 1 << 20  # bytes worked on at once
SEGMENT = 1 << 19  # longer texts are worked on in overlapping segments
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0x9FB21C651E98DF25)
    return x ^ (x >> U(32))


@lru_cache(maxsize=4)
def tables(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte value, powers of an odd base and their inverses, modulo 2^64."""
    base = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[seed]
    size = BLOCK + SEGMENT + 512
    out = [mixed(np.arange(256, dtype=U) + U(1000 * seed + 1))]
    for b in (base, pow(base, -1, 1 << 64)):
        powers = np.full(size, b, dtype=U)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return tuple(out)


class Codes:
    """Hash of any stretch of a buffer in constant time."""

    def __init__(self, buffer: bytes, seed: int):
        numbers, powers, self.inverse = tables(seed)
        values = numbers[np.frombuffer(buffer, dtype=np.uint8)] * powers[: len(buffer)]
        self.sums = np.zeros(len(buffer) + 1, dtype=U)
        np.cumsum(values, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    padded = np.full(-(-len(values) // width) * width, np.iinfo(U).max, dtype=U)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: len(values) - width + 1], ahead[width - 1 : len(values)])


def blocks(names: list[int], texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about BLOCK bytes: (buffer, key, first byte's place in its text, end in the buffer) per part.

    Parts are whole texts, or segments that overlap in ``length - 1`` bytes. Shorter texts than
    ``length`` hold no string and are left out.
    """
    parts, size = [], 0
    for name, text in zip(names, texts):
        for begin in range(0, max(1, len(text) - length + 1), SEGMENT) if len(text) >= length else ():
            part = text[begin : begin + SEGMENT + length - 1]
            parts.append((part, name, begin))
            size += len(part)
            if size >= BLOCK:
                yield _block(parts)
                parts, size = [], 0
    if parts:
        yield _block(parts)


def _block(parts):
    text, name, begin = zip(*parts)
    return b"".join(text), np.array(name, dtype=np.int64), np.array(begin, dtype=np.int64), np.cumsum([len(t) for t in text])


def anchors(buffer: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first string, last string, part) of each run of strings with one anchor, in the buffer."""
    width, n = length - GRAM + 1, len(buffer)
    padded = buffer + bytes(GRAM)
    code = np.zeros(n, dtype=U)
    for k in range(0, GRAM, 8):
        code = mixed(code + np.ndarray((n,), dtype="<u8", buffer=padded, strides=(1,), offset=k))
    place = (least((code >> U(24) << U(24)) | np.arange(n, dtype=U), width) & U(0xFFFFFF)).astype(np.int64)
    part = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(place)]
    start = np.flatnonzero(np.arange(len(place)) + length <= ends[part])
    place, part = place[start], part[start]
    first = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(start) != 1)]) if len(start) else start
    last = np.r_[first[1:], len(start)] - 1
    return place[first], start[first], start[last], part[first]


def packed(anchor: np.ndarray, low: np.ndarray, high: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place in one number: anchor, distances back to its first and last string, known to be repeated."""
    return (anchor << 17) | ((anchor - low) << 9) | ((anchor - high) << 1) | known


ROW = "gram bigint, stretch bigint, id bigint, at bigint"
_LOW, _HIGH = "shiftright(at, 17) - (shiftright(at, 9) & 255)", "shiftright(at, 17) - (shiftright(at, 1) & 255)"


def suffixes(docs: DataFrame, length: int) -> DataFrame:
    """Sampled suffixes of ``docs(id, text)``. Repeats inside a block are marked and get a random gram."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode() for t in batch["text"].fillna("")]
            for buffer, names, begins, ends in blocks(batch["id"].tolist(), raw, length):
                anchor, low, high, part = anchors(buffer, ends, length)
                if not len(anchor):
                    continue
                codes, shift = Codes(buffer, 0), begins[part] - np.r_[0, ends[:-1]][part]
                gram = codes.of(anchor, anchor + GRAM)
                stretch = mixed(codes.of(low, high + length) + (anchor - low).astype(U) * U(257))
                name, anchor, low, high = names[part], anchor + shift, low + shift, high + shift
                order = np.lexsort((anchor, name, stretch, gram))
                same = np.zeros(len(order), dtype=bool)
                same[order[1:]] = (gram[order][1:] == gram[order][:-1]) & (stretch[order][1:] == stretch[order][:-1])
                gram = np.where(same, mixed(gram + mixed(name.astype(U)) + anchor.astype(U)), gram)
                yield pd.DataFrame({
                    "gram": gram.view(np.int64), "stretch": np.where(same, U(0), stretch).view(np.int64),
                    "id": name, "at": packed(anchor, low, high, same.astype(np.int64)),
                })

    return docs.select("id", "text").mapInPandas(run, ROW)


REPEATED, ALONE, BORDER = 0, 1, 2


def scan(arrays: DataFrame) -> DataFrame:
    """Merge-scan of sorted arrays: adds ``kind``, one of REPEATED, ALONE and BORDER.

    One pass over each partition in the order of (gram, stretch, id, place); between Arrow batches
    only the last key and at most one row are kept.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = stretch = None
        held, many = None, False  # the only first suffix of the last gram so far; whether it has more
        for batch in batches:
            known = (batch["at"].to_numpy() & 1).astype(bool)
            if known.any():
                yield batch[known].assign(kind=REPEATED)
                batch = batch[~known]
            if not len(batch):
                continue
            g, s = batch["gram"].to_numpy(), batch["stretch"].to_numpy()
            new_gram = np.r_[g[0] != gram if gram is not None else True, g[1:] != g[:-1]]
            new = new_gram | np.r_[s[0] != stretch if stretch is not None else True, s[1:] != s[:-1]]
            if (~new).any():
                yield batch[~new].assign(kind=REPEATED)
            firsts, starts = batch[new], new_gram[new]
            if len(firsts):
                group = np.cumsum(starts)  # 0: goes on with the last batch's gram
                size = np.bincount(group, minlength=group[-1] + 1)
                if held is not None and (starts[0] or size[0]):
                    yield held.assign(kind=BORDER if size[0] else ALONE)
                    many, held = bool(size[0]), None
                border = size[group] > 1
                border |= group == 0
                tail = size[-1] == 1 and group[-1] > 0
                if tail:
                    held, many = firsts.iloc[-1:], False
                elif group[-1] > 0:
                    many = True
                out = firsts.assign(kind=np.where(border, BORDER, ALONE))
                yield out.iloc[:-1] if tail else out
            gram, stretch = g[-1], s[-1]
        if held is not None:
            yield held.assign(kind=ALONE)

    ordered = arrays.repartition("gram").sortWithinPartitions("gram", "stretch", "id", "at")
    return ordered.mapInPandas(run, ROW + ", kind int")


class SuffixFamily:
    """Levels of sampled suffix arrays, and the repeats found while batches were added."""

    def __init__(self, length: int = 100):
        if not 2 * GRAM <= length <= 255 + GRAM:
            raise ValueError(f"length must lie between {2 * GRAM} and {255 + GRAM}")
        self.length = length
        self.levels: list[tuple[int, int, DataFrame]] = []  # (batches in it, least id, suffixes), oldest first
        self.found: list[DataFrame] = []

    def add(self, batch: DataFrame, last: bool = False) -> None:
        """Index ``batch(id, text)``, whose ids are larger than all before.

        With ``last`` nothing will be added any more, and no level is made of the batch.
        """
        arrays = suffixes(batch, self.length)
        for _, _, level in self.levels:
            arrays = arrays.union(level)
        result, spark = scan(arrays), batch.sparkSession
        if last:
            self.found.append(written(result.where(F.col("kind") != ALONE).select("id", "at", "kind")))
            for _, _, level in self.levels:
                remove(level)
            self.levels = []
            return release(spark)
        low = batch.agg(F.min("id")).first()[0]
        if low is None:
            return None
        # The scan holds the firsts of the batch and of all levels it ran against.
        result, size, kept, old = written(result), 1, self.levels[:], []
        while kept and kept[-1][0] == size:
            size += kept[-1][0]
            old.append(kept.pop())
        low = min([low, *(level[1] for level in old)])
        self.found.append(written(result.where(F.col("kind") != ALONE).select("id", "at", "kind")))
        level = written(result.where((F.col("kind") != REPEATED) & (F.col("id") >= low)).drop("kind"))
        for gone in (result, *(level for _, _, level in old)):
            remove(gone)
        self.levels = [*kept, (size, low, level)]
        return release(spark)

    def spans(self, docs: DataFrame) -> DataFrame:
        """``id``, ``text`` and ``codes`` of ``docs(id, text)``: start << 32 | end of what is repeated, or null.

        Borders' stretches are cut out of the texts, their strings compared, and what is repeated
        joined to the texts: three written steps, so that only one of them has its shuffle on disk.
        """
        length, found = self.length, self.found[0]
        for more in self.found[1:]:
            found = found.union(more)
        borders = found.where(F.col("kind") == BORDER).groupBy("id").agg(F.collect_set("at").alias("codes"))

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                batch = batch[batch["text"].notna()]
                out = []
                for name, text, at in zip(batch["id"].tolist(), batch["text"], batch["codes"]):
                    raw, at = text.encode(), np.asarray(at, dtype=np.int64)
                    low, high = (at >> 17) - ((at >> 9) & 255), (at >> 17) - ((at >> 1) & 255) + length
                    out += [
                        (name, a, raw[a:b], zlib.crc32(raw[c : c + GRAM]) % ROUNDS)
                        for a, b, c in zip(low.tolist(), high.tolist(), (at >> 17).tolist())
                    ]
                yield pd.DataFrame(out, columns=["id", "start", "stretch", "round"])

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ends = batch["stretch"].map(len).cumsum().to_numpy()
                for rows in _split(batch, ends):
                    yield from strings(rows["id"].to_numpy(), rows["start"].to_numpy(), rows["stretch"].tolist(), length)

        stretches = written(docs.join(borders, "id").mapInPandas(cut, "id bigint, start bigint, stretch binary, round int"))
        release(docs.sparkSession)
        first = Window.partitionBy("h1", "h2").orderBy("id", "at")
        repeated = None
        for k in range(ROUNDS):  # equal strings have equal grams
            rows = stretches.where(F.col("round") == k).mapInPandas(compare, "h1 bigint, h2 bigint, id bigint, at bigint, size bigint")
            rows = rows.withColumn("n", F.row_number().over(first)).where("n > 1 or at & 1 = 1")
            part = written(rows.selectExpr("id", "shiftleft(shiftright(at, 1), 32) | (shiftright(at, 1) + size) AS code"))
            repeated = part if repeated is None else repeated.union(part)
            release(docs.sparkSession)
        remove(stretches)
        known = found.where(F.col("kind") == REPEATED).selectExpr(
            "id", f"shiftleft({_LOW}, 32) | ({_HIGH} + {length}) AS code"
        )
        codes = known.union(repeated).groupBy("id").agg(F.collect_list("code").alias("codes"))
        return docs.join(codes, "id", "left")


def _split(batch: pd.DataFrame, ends: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows in runs of about BLOCK bytes, given the cumulated sizes."""
    bounds = np.searchsorted(ends, np.arange(BLOCK, ends[-1], BLOCK)) if len(ends) else []
    bounds = [0, *bounds, len(batch)]
    for low, high in zip(bounds, bounds[1:]):
        if high > low:
            yield batch.iloc[low:high]


def strings(names: np.ndarray, starts: np.ndarray, stretches: list[bytes], length: int) -> Iterator[pd.DataFrame]:
    """All strings of some stretches: two hashes, key, place and size. The last bit of the place
    tells a run that is repeated among these stretches; it has hashes of its own."""
    sizes = np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches))
    begin = np.cumsum(sizes) - sizes
    count = np.maximum(sizes - length + 1, 0)
    part = np.repeat(np.arange(len(sizes)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    position, name, place = begin[part] + inside, names[part], starts[part] + inside
    buffer = b"".join(stretches)
    h1, h2 = (Codes(buffer, seed).of(position, position + length) for seed in (0, 1))
    order = np.lexsort((place, name, h2, h1))
    same = np.zeros(len(order), dtype=bool)
    same[order[1:]] = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    alone = ~same
    yield pd.DataFrame({
        "h1": h1[alone].view(np.int64), "h2": h2[alone].view(np.int64), "id": name[alone], "at": place[alone] << 1,
        "size": np.full(int(alone.sum()), length),
    })
    name, place, h1 = name[same], place[same], h1[same]
    if len(name):
        first = np.flatnonzero(np.r_[True, (np.diff(name) != 0) | (np.diff(place) != 1)])
        last = np.r_[first[1:], len(name)] - 1
        yield pd.DataFrame({
            "h1": mixed(h1[first] + place[first].astype(U)).view(np.int64), "h2": mixed(name[first].astype(U)).view(np.int64),
            "id": name[first], "at": (place[first] << 1) | 1, "size": place[last] - place[first] + length,
        })


def plain_keys(docs: DataFrame, key: str) -> bool:
    """Whether keys are integers without nulls and repeats."""
    if docs.schema[key].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        return False
    odd = docs.groupBy(docs[key].alias("key")).agg(F.count("*").alias("n")).where("n > 1 or key is null")
    return odd.isEmpty()


def numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs(id, text)`` with unique ids in the order of keys, and ``(id, key)`` if ids are not the keys.

    Integer keys without nulls and repeats are ids themselves. Otherwise rows are numbered in the
    order of (key, text), nulls first: of repeated rows one counts as earlier, whichever.
    """
    plain = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    if plain_keys(docs, key):
        return plain.select(F.col("key").cast("bigint").alias("id"), "text"), None
    rows = written(plain.orderBy("key", "text").withColumn("id", F.monotonically_increasing_id()))
    return rows.select("id", "text"), rows.select("id", "key")


def dedup(
    docs: DataFrame, length: int = 100, batches: int = 3, key: str = "doc_id", text: str = "text", with_text: bool = False,
) -> DataFrame:
    """Remove every repeated byte from every text.

    One row per document: ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256`` (of the remaining bytes) and, with ``with_text``, ``kept``: the remaining bytes as
    text, where a character of which only some bytes remain is left out. A null text counts as
    empty (``kept`` stays null). Texts shorter than ``length`` are never touched. Repeated rows and
    null keys are described at :func:`numbered`; an empty table gives an empty frame.
    """
    rows, keys = numbered(docs, key, text)
    bounds = rows.stat.approxQuantile("id", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    family = SuffixFamily(length)
    edges = [None, *sorted({int(b) for b in bounds}), None]
    for low, high in zip(edges, edges[1:]):
        batch = rows
        if low is not None:
            batch = batch.where(F.col("id") > low)
        if high is not None:
            batch = batch.where(F.col("id") <= high)
        family.add(batch, last=high is None)
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for name, body, codes in zip(part["id"], part["text"], part["codes"]):
                raw = (body or "").encode()
                removed = spans = 0
                kept = raw
                if codes is not None:
                    codes = np.asarray(codes, dtype=np.int64)
                    depth = np.zeros(len(raw) + 1, dtype=np.int64)
                    np.add.at(depth, codes >> 32, 1)
                    np.add.at(depth, codes & 0xFFFFFFFF, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    removed, spans = int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                row = (name, len(raw), removed, spans, hashlib.sha256(kept).hexdigest())
                out.append(row + ((None if body is None else kept.decode(errors="ignore"),) if with_text else ()))
            yield pd.DataFrame(out, columns=columns)

    columns = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    kinds = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept string" * with_text
    found = family.spans(rows).mapInPandas(run, kinds)
    if keys is None:
        return found.select(F.col("id").cast(docs.schema[key].dataType).alias(key), *columns[1:])
    return found.join(keys, "id").select(F.col("key").alias(key), *columns[1:])


def remove_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with every repeated byte removed from ``text``; all rows and columns, see :func:`dedup`.

    Null and repeated keys are allowed: such rows are numbered first, as :func:`numbered` does.
    """
    if not plain_keys(docs, key):
        number = next(f"_row{k}" for k in range(len(docs.columns) + 1) if f"_row{k}" not in docs.columns)
        rows = written(docs.orderBy(key, text).withColumn(number, F.monotonically_increasing_id()))
        return remove_repeats(rows, length, number, text, **options).select(*docs.columns)
    found = dedup(docs, length, key=key, text=text, with_text=True, **options)
    return docs.drop(text).join(found.select(key, F.col("kept").alias(text)), key).select(*docs.columns)
