"""BPE encoding and decoding with word ends, by batched numpy merge rounds.

The symbols of many different words stand in one flat array. A round finds every adjacent pair by
binary search over the sorted pair keys, takes the lowest rank of each word and merges all its
occurrences in that word, left to right. Words without a known pair leave the array, so the rounds
end when the longest merge history has been replayed. Merging all occurrences at once equals
merging one by one, since a pair's result only takes part in merges of higher rank; that property
of the vocabulary is checked when it is loaded.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tarnflow.llm.common import keyed, unkeyed

CHUNK = 1 << 22  # characters whose words are encoded together


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """One vocabulary file: lower case, white space dropped, ``</w>`` at the end of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.tokens = [b""] * self.size
        for token, number in vocab.items():
            self.tokens[number] = token.encode()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, number in self.special.items():
            self.tokens[number] = token.encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split).findall
        self.path = path
        # All characters below U+0300 are assigned, and none of them combines.
        self.high = re.compile("[\u0300-\U0010ffff]+")
        self.unsure = frozenset(
            c for c in map(chr, range(0x300, sys.maxunicode + 1)) if unicodedata.category(c) == "Cn" or unicodedata.combining(c)
        )
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        born = np.full(self.size, -1, dtype=np.int64)
        born[made[::-1]] = np.arange(len(made))[::-1]
        if not (np.maximum(born[left], born[right]) < np.arange(len(made))).all():
            raise ValueError("a merge uses a symbol that only a later merge makes")
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made

    def ranked(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each pair key; the number of merges where there is no such merge."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys))

    def merged(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(raw)), sizes)
        none = len(self.keys)
        out_owner, out_symbols = [], []
        while len(symbols):
            rank = np.full(len(symbols), none, dtype=np.int64)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same] = self.ranked(symbols[same] * self.size + symbols[same + 1])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(owner)])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            done = lowest == none
            if done.any():
                out_owner.append(owner[done])
                out_symbols.append(symbols[done])
                keep = ~done
                symbols, owner, rank, lowest = symbols[keep], owner[keep], rank[keep], lowest[keep]
            hits = np.flatnonzero(rank == lowest)
            if not len(hits):
                continue
            run = np.r_[True, (np.diff(hits) > 1) | (owner[hits[1:]] != owner[hits[:-1]])]
            first = np.flatnonzero(run)
            inside = np.arange(len(hits)) - np.repeat(first, np.diff(np.r_[first, len(hits)]))
            hits = hits[inside % 2 == 0]
            symbols[hits] = self.made[rank[hits]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owner, symbols = np.concatenate(out_owner), np.concatenate(out_symbols)
        symbols = symbols[np.argsort(owner, kind="stable")].astype("<u4")
        counts = np.bincount(owner, minlength=len(raw))
        return np.split(symbols, np.cumsum(counts)[:-1])

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _pieces(self, text: str) -> list[str | tuple[str]]:
        """Runs between white space of a normalised text, to be parted into words, or words as they are in tuples.

        Python and ``regex`` know other versions of Unicode than the tokenizers library. Where a text has a
        character that Python's tables lack, or a combining one, whose order may differ, the library is
        asked for its normal form and its words.
        """
        if not text.isascii() and not self.unsure.isdisjoint(set("".join(self.high.findall(text)))):
            normal = self.library.normalizer.normalize_str(text)
            return [(w,) for w, _ in self.library.pre_tokenizer[0].pre_tokenize_str(normal)]
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: no rule for the sigma at a word's end.
        text = text.replace("Σ", "σ").lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # separators for split(), but no white space
            return [p for p in regex.split(r"\s+", text) if p]
        return text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        flat: list[str | tuple[str]] = []
        ends = []
        for text in texts:
            for k, part in enumerate(self.cut.split(text)):
                if k % 2:
                    flat.append(part)
                else:
                    flat.extend(self._pieces(part))
            ends.append(len(flat))
        if not flat:
            return [np.zeros(0, dtype="<u4") for _ in texts]
        different: dict[str | tuple[str], int] = {}
        codes = np.fromiter((different.setdefault(piece, len(different)) for piece in flat), dtype=np.int64, count=len(flat))
        words: dict[str, int] = {}
        owned = []
        for piece in different:
            found = list(piece) if isinstance(piece, tuple) else [piece] if piece in self.special else self.words(piece)
            owned.append([words.setdefault(w, len(words)) for w in found])
        plain = [w for w in words if w not in self.special]
        ids = dict(zip(plain, self.merged(plain)))
        by_word = [ids[w] if w in ids else np.array([self.special[w]], dtype="<u4") for w in words]
        by_piece = [by_word[o[0]] if len(o) == 1 else np.concatenate([by_word[k] for k in o]) for o in owned]
        sizes = np.fromiter(map(len, by_piece), dtype=np.int64, count=len(by_piece))
        pool, begin = np.concatenate(by_piece), np.cumsum(sizes) - sizes
        counts = sizes[codes]
        stop = np.cumsum(counts)
        spread = np.arange(stop[-1]) - np.repeat(stop - counts, counts) + np.repeat(begin[codes], counts)
        bounds = np.r_[0, stop][np.array(ends[:-1], dtype=np.int64)] if len(ends) > 1 else []
        return np.split(pool[spread], bounds)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' strings joined by a space, in UTF-8: the file names no decoder."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def chunks(texts: list[str], limit: int = CHUNK) -> Iterator[slice]:
    """Slices of about ``limit`` characters; a longer text stands alone."""
    begin = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (array of long) and ``decoded`` of every row; a null text counts as empty.

    Rows are independent: repeated rows give repeated results, an empty table gives none, columns
    other than the two named are left out. Special tokens written out in a text are matched as such.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            texts = batch["_text"].fillna("").tolist()
            for part in chunks(texts):
                ids = bpe.encode(texts[part])
                yield pd.DataFrame({
                    "_key": batch["_key"].iloc[part].array,
                    "ids": [x.astype(np.int64) for x in ids],
                    "decoded": [bpe.decode(x).decode() for x in ids],
                })

    found = keyed(docs, key, text).mapInPandas(run, "_key string, ids array<bigint>, decoded string")
    return unkeyed(found, docs, key)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`encode`, but the number of ids and SHA-256 of ids and decoded text only.

    Digests are taken in the same task, so that neither ids nor texts are handed on.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            texts = batch["_text"].fillna("").tolist()
            for part in chunks(texts):
                ids = bpe.encode(texts[part])
                yield pd.DataFrame({
                    "_key": batch["_key"].iloc[part].array,
                    "n_tokens": [len(x) for x in ids],
                    "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
                })

    found = keyed(docs, key, text).mapInPandas(run, "_key string, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return unkeyed(found, docs, key)
