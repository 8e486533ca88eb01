"""Packing token sequences: best-fit decreasing over a segment tree of remaining capacities.

A document is its token ids and a closing id. Full windows are cut off first and stand alone; the
rest, shorter than a window, goes to the tightest open window that still holds it. Documents are
dealt into groups of bounded size by a hash, each group is packed by one task, and a sequence is
numbered by its group and its place there, so the result doesn't depend on tasks or retries.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tarnflow.llm.common import keyed, unkeyed
from tarnflow.llm.wordbpe import byte_letters

GROUP = 8192  # pieces packed together; padding is below 0.1 % from a few thousand on


class ByteBpe:
    """Encoder of a byte-level vocabulary file, with its own pattern and special tokens."""

    #: The pattern that goes with byte-level vocabularies.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(back[c] for c in token): number for token, number in spec["model"]["vocab"].items() if token not in special}
        self.path, self.fast = path, tiktoken.Encoding("own", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        try:
            return np.array(self.fast.encode(text, allowed_special="all"), dtype="<u4")
        except Exception:  # its pattern engine gives up on very long runs of white space
            from tokenizers import Tokenizer

            return np.array(Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def pieces(
    docs: DataFrame, path: str, window: int = 1024, closing: int = 0,
    key: str = "doc_id", text: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Pieces of every document: key, start, length, ids_crc32, doc_tokens and, if asked for, ids.

    ``ids`` are 32-bit little-endian integers in one binary value. All pieces but a document's last
    are full windows. A null text is empty: one piece of one id. Repeated rows are packed as often
    as they occur, an empty table gives no pieces, other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            for begin in range(0, len(batch), 500):
                some = batch.iloc[begin : begin + 500]
                rows = []
                for name, body in zip(some["_key"], some["_text"].fillna("")):
                    ids = np.append(bpe.encode(body), np.uint32(closing)).astype("<u4")
                    for s in range(0, len(ids), window):
                        raw = ids[s : s + window].tobytes()
                        rows.append((name, s, len(raw) // 4, zlib.crc32(raw), len(ids)) + ((raw,) if with_ids else ()))
                yield pd.DataFrame(rows, columns=["_key", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)

    kinds = "_key string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * with_ids
    return unkeyed(keyed(docs, key, text).mapInPandas(run, kinds), docs, key)


class Capacities:
    """Segment tree over remaining capacities 0..window: how many open windows have each."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        at = self.base + capacity
        while at:
            self.count[at] += 1
            at >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take the open window of least capacity that holds ``need``: (capacity, window)."""
        at = self.base + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.base:
                at *= 2
                if not self.count[at]:
                    at += 1
        capacity = at - self.base
        while at:
            self.count[at] -= 1
            at >>= 1
        return capacity, self.open[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length; the lengths come in decreasing order."""
    tree, place, offset, used = Capacities(window), [], [], 0
    for length in lengths:
        found = tree.tightest(length)
        if found is None:
            found = window, used
            used += 1
        capacity, at = found
        place.append(at)
        offset.append(window - capacity)
        if capacity > length:
            tree.add(capacity - length, at)
    return place, offset


def pack(cut: DataFrame, n_rows: int, window: int = 1024, key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces; needs ``key``, start, length, ids_crc32, doc_tokens.

    ``n_rows`` is the number of pieces or an estimate; it sets the number of groups only. Pieces
    of a group are taken by length, key and start, so ties and repeated rows are settled alike
    in every run. Columns besides these are not handed on.
    """
    groups = max(1, -(-n_rows // group))
    frame = cut.select(cut[key].cast("string").alias("_key"), "start", "length", "ids_crc32", "doc_tokens").withColumn(
        "_group", F.pmod(F.xxhash64("_key", "start", "ids_crc32"), F.lit(groups))
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = int(rows["_group"].iloc[0]) << 32
        rows = rows.drop(columns="_group").sort_values(["length", "_key", "start", "ids_crc32"], ascending=[False, True, True, True])
        place, offset = best_fit(rows["length"].tolist(), window)
        return rows.assign(sequence_id=np.array(place, dtype=np.int64) + first, offset=np.array(offset, dtype=np.int64))

    out = frame.groupBy("_group").applyInPandas(
        run,
        "_key string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
    return unkeyed(out, cut, key)


def packed(docs: DataFrame, path: str, window: int = 1024, key: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Encode and pack whole documents; ids are handed on as their CRC-32 only."""
    cut = pieces(docs, path, window, 0, key, text, with_ids=False)
    return pack(cut, 2 * docs.count(), window, key, group)
