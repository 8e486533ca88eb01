"""Language identification by prediction by partial matching (PPM).

For every language the bytes of its training texts form a context tree of order 0 to ``order``.
A byte b after context c costs

    -log2 n(c b) / (n(c) + d(c))                     where b was seen after c,
    -log2 d(c) / (n(c) + d(c))  +  cost after c[1:]  where it was not (escape, d different successors),

contexts never seen are skipped at no cost, and below order 0 all symbols are equally likely. With
frozen counts the cost of (context, byte) is a constant, so whole code lengths are sums of table
entries: two gathers per byte for all languages together.

Symbols are bytes after lower-casing A-Z; the ``SYMBOLS - 1`` commonest of the sample have a symbol
of their own, all others share the last. The sample is bounded: about ``per_language`` whole
documents of each language, those of smallest hash. Scoring covers every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.llm.common import keyed, sampled, unkeyed

SYMBOLS = 64
BLOCK = 1 << 21  # bytes scored at once
UNKNOWN = "und"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class ContextTrees:
    """Frozen code lengths of all languages for symbols after contexts of up to three symbols."""

    ORDER = 3

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        lowered = {k: [t.translate(LOWER) for t in samples[k]] for k in self.languages}
        seen = np.zeros(256, dtype=np.int64)
        for texts in lowered.values():
            for text in texts:
                seen += np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        self.symbol = np.full(256, SYMBOLS - 1, dtype=np.uint8)
        order = np.lexsort((np.arange(256), -seen))[: SYMBOLS - 1]
        self.symbol[order] = np.arange(SYMBOLS - 1)
        found = {k: [self.grams(texts, n) for n in range(1, self.ORDER + 2)] for k, texts in lowered.items()}
        single = np.ones((len(found), SYMBOLS))
        for k, name in enumerate(self.languages):
            single[k, found[name][0][0]] += found[name][0][1]
        self.single = -np.log2(single / single.sum(axis=1, keepdims=True))
        deep = np.unique(np.concatenate([f[-1][0] // SYMBOLS for f in found.values()] + [np.zeros(0, np.int64)]))
        two = SYMBOLS ** 2
        # Row of each context of three symbols: its own if any language has seen it, else the one
        # of its last two symbols, at which the longer context is skipped.
        self.row = (np.arange(SYMBOLS ** 3) % two + len(deep)).astype(np.int32)
        self.row[deep] = np.arange(len(deep))
        self.cost = np.stack([self.code_lengths(found[k], deep) for k in self.languages], axis=1) if samples else None

    def codes(self, text: bytes, n: int) -> np.ndarray:
        """Numbers of all runs of ``n`` symbols, first symbol highest; the text is preceded by blanks."""
        s = self.symbol[np.frombuffer(b"   " + text, dtype=np.uint8)].astype(np.int64)
        out = np.zeros(len(text), dtype=np.int64)
        for k in range(4 - n, 4):
            out = out * SYMBOLS + s[k : k + len(text)]
        return out

    def grams(self, texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([self.codes(t, n) for t in texts] + [np.zeros(0, np.int64)])
        return np.unique(every, return_counts=True)

    def code_lengths(self, found: list[tuple[np.ndarray, np.ndarray]], deep: np.ndarray) -> np.ndarray:
        """Bits of each (row, symbol) for one language, rows as in ``self.row``."""
        table = np.full((1, SYMBOLS), np.log2(SYMBOLS))
        for n, (gram, count) in enumerate(found, start=1):
            context, symbol = gram // SYMBOLS, gram % SYMBOLS
            if n <= self.ORDER:  # every context of this order
                size, at = SYMBOLS ** (n - 1), context
                below = table[np.arange(size) % len(table)]
            else:  # seen contexts of the highest order, then every context one shorter
                size, at = len(deep), np.searchsorted(deep, context)
                below = table[deep % len(table)]
            total = np.bincount(at, weights=count, minlength=size)
            kinds = np.bincount(at, minlength=size)
            escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
            here = below + escape[:, None]
            here[at, symbol] = -np.log2(count / (total + kinds)[at])
            table = np.concatenate([here, table]) if n > self.ORDER else here
        return table.reshape(-1).astype(np.float32)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= BLOCK):
                size += len(texts[end]) + 3
                end += 1
            out[begin:end] = self._bits([t.translate(LOWER) for t in texts[begin:end]])
            begin = end
        return out

    def plain_bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language by the frequencies of its symbols alone."""
        counts = [np.bincount(self.symbol[np.frombuffer(t.translate(LOWER), dtype=np.uint8)], minlength=SYMBOLS) for t in texts]
        return np.array(counts, dtype=float).reshape(len(texts), SYMBOLS) @ self.single.T

    def _bits(self, texts: list[bytes]) -> np.ndarray:
        # Every text is preceded by three blanks, which are contexts only.
        flat = b"".join(b"   " + t for t in texts)
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        out = np.zeros((len(texts), len(self.languages)))
        symbols = self.symbol[np.frombuffer(flat, dtype=np.uint8)]
        owner_end = np.cumsum(sizes + 3)
        for begin in range(3, len(symbols), BLOCK):  # one very long text is scored in blocks
            end = min(begin + BLOCK, len(symbols))
            s = symbols[begin - 3 : end].astype(np.int32)
            context = (s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]
            at = self.row[context] * SYMBOLS + s[3:]
            position = np.arange(begin, end)
            owner = np.searchsorted(owner_end, position, side="right")
            real = position >= (owner_end - sizes)[owner]
            for k in range(len(self.languages)):
                cost = np.where(real, self.cost[at, k], 0)
                out[:, k] += np.bincount(owner, weights=cost, minlength=len(texts))
        return out


def training(docs: DataFrame, key: str, text: str, lang: str, condition: Column, per_language: int) -> dict[str, list[bytes]]:
    """Bounded sample: per language about ``per_language`` rows of smallest hash, whole texts.

    Counts per language come first, so each row tells by its own hash whether it is in.
    """
    rows = docs.where(condition & F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0))
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).cast("string").alias("key"))
    counts = rows.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return {}
    held = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], float(r["count"]))])[F.col("lang")]
    chosen = sampled(rows, held, per_language, "key", "text").select("lang", "text").toPandas()
    return {name: [t.encode() for t in sorted(part["text"])] for name, part in chosen.groupby("lang")}


def predict(
    docs: DataFrame, train_on: Column | None = None, per_language: int = 1000,
    key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``bits_per_byte`` of every row.

    Trees are learned from rows where ``train_on`` holds and the language is known; about
    ``per_language`` documents a language are sent to the driver (about 4 MB a language at 4 KB a
    document), since a context tree of order 3 is settled long before. A prediction looks at the
    text alone. The prediction is the language of shortest code, ties to the first in order; the
    score is its share of the likelihoods per byte, sharpened by 8, so 0 to 1 and independent of the
    text's length. A text that is null or without letters, or any text if nothing could be
    learned, is ``und`` with score 0. Repeated rows are predicted alike; other columns are not read.
    """
    samples = training(docs, key, text, lang, F.lit(True) if train_on is None else train_on, per_language)
    shared = docs.sparkSession.sparkContext.broadcast(ContextTrees(samples)) if samples else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, score, rate = judged(shared.value if shared else None, batch["_text"].fillna("").tolist())
            yield pd.DataFrame({"_key": batch["_key"].array, "lang_pred": names, "score": score, "bits_per_byte": rate})

    found = keyed(docs, key, text).mapInPandas(run, "_key string, lang_pred string, score double, bits_per_byte double")
    return unkeyed(found, docs, key)


def judged(trees: ContextTrees | None, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and bits per byte of each text."""
    lettered = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
    if trees is None:
        lettered[:] = False
    names, score, rate = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts)), np.zeros(len(texts))
    if lettered.any():
        raw = [t.encode() for t, k in zip(texts, lettered) if k]
        per = trees.bits(raw) / np.array([max(1, len(r)) for r in raw])[:, None]
        low = per.min(axis=1)
        names[lettered] = np.array(trees.languages, dtype=object)[per.argmin(axis=1)]
        score[lettered] = 1 / np.exp2(8 * (low[:, None] - per)).sum(axis=1)
        rate[lettered] = low
    return names, score, rate


def calibrated(samples: dict[str, list[bytes]], enough: int = 20) -> tuple[ContextTrees, np.ndarray]:
    """Trees of three quarters of the sample, and what their contexts save a byte on the rest.

    The saving, against the frequencies of single symbols, is the median per language; NaN where
    fewer than ``enough`` texts are held out. A language's number depends on its own texts alone.
    """
    trees = ContextTrees({k: [t for n, t in enumerate(texts) if n % 4] for k, texts in samples.items()})
    usual = np.full(len(trees.languages), np.nan)
    for k, name in enumerate(trees.languages):
        held = samples[name][::4]
        if len(held) >= enough:
            usual[k] = np.median((trees.plain_bits(held) - trees.bits(held))[:, k] / list(map(len, held)))
    return trees, usual


def keep_known(
    docs: DataFrame, least: float = 0.0, per_language: int = 1000, slack: float = 40.0,
    key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """Rows of ``docs`` with a predicted language whose contexts fit the text, all columns.

    They fit if they save at least ``least`` of the bits a byte that they usually save in the language (see
    :func:`calibrated`); a text is rejected only if it falls short by over ``slack`` bits, so that a
    few odd words don't count as evidence. The number of labels, or several labels for one language, don't
    matter. Each row is judged where it stands, so keys may be null or repeated. Languages with too small a
    sample reject nothing, and where no language is known of any row, all texts with letters stay.
    """
    samples = training(docs, key, text, lang, F.lit(True), per_language)
    shared = docs.sparkSession.sparkContext.broadcast(calibrated(samples)) if samples else None

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        bodies = texts.fillna("").tolist()
        lettered = np.array([any(map(str.isalpha, t)) for t in bodies], dtype=bool)
        if shared is not None and lettered.any():
            lettered[lettered] = fitting(*shared.value, [t.encode() for t, k in zip(bodies, lettered) if k], least, slack)
        return pd.Series(lettered)

    return docs.where(known(text))


def fitting(trees: ContextTrees, usual: np.ndarray, texts: list[bytes], least: float, slack: float) -> np.ndarray:
    """Whether each text fits its best language, as in :func:`keep_known`."""
    bits = trees.bits(texts)
    best, row = bits.argmin(axis=1), np.arange(len(texts))
    short = least * usual[best] * list(map(len, texts)) - (trees.plain_bits(texts) - bits)[row, best]
    return ~(short > slack)
