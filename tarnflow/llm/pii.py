"""Personal data: base patterns with checks, and boosted trees over loosely generated candidates.

Base spans are matches of strict patterns that pass their check. They are always reported. Loose
generators propose further, overlapping spans. Gradient-boosted trees score each by its format
and context, and per kind a threshold, calibrated on documents held out from the fit, decides
which of them are reported too.

The trees learn what the base patterns miss: in every text each base span is rewritten
to a form no base pattern matches (an address with "at" in brackets, a phone number with 00 or without its
country, a card number with points or slashes), and a candidate counts as positive where it covers a rewritten
span of its kind. Candidates that meet no such span and no remaining base span of their kind are negative. Network addresses have no other form, so nothing is added to
them. A kind whose threshold can't reach the wanted precision on enough held-out candidates adds nothing.

Every candidate of every text counts, in the half of the texts the trees learn from or in the half that
sets the thresholds; a hash of text and key decides which. Equal features are counted together, and a level
of a tree is one pass that sums gradients by node, feature and bin, so only these sums reach the driver.
All sums are of whole numbers, so that their order never changes a tree.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tarnflow.llm.common import keyed, remove, unkeyed, written

KINDS = ("email", "ip", "card", "phone")

# Base patterns, written so that no text takes more than linear time: a number's or address's
# first character is tried only where its run begins, and runs are never given back.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators: wider than any base pattern, and allowed to overlap.
LOOSE = (
    (0, re.compile(r"(?<![^\s@<>\"',;:()\[\]])[^\s@<>\"',;:()\[\]]++\s?(?:@|[\[(]at[\])])\s?[^\s@<>\"',;:()\[\]]++")),
    (1, re.compile(r"(?<![0-9])[0-9]++(?:[.][0-9]++){2,}")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,}")),
    (3, re.compile(r"[+(]?[0-9](?:[\x20().0-9/-]*[0-9])")),
    (3, re.compile(r"(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]{1,2}[0-9]{3,4}[\x20.-][0-9]{3,4}")),
)
CUES = tuple(re.compile(p, re.I) for p in (
    r"mail|contact|write", r"\bip\b|server|host|addr", r"card|visa|account|pay", r"tel|phone|call|mobile|fax",
    r"version|license|token|sha|key|isbn|=\s*$",
))
DIGITS = re.compile(r"[0-9]+")
#: Features are told apart up to this value, so that each has a bounded number of values.
LARGEST = 99999


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, leftmost without overlap per kind; failures are dropped."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL:
            begin -= 1
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            free = m.end()
            out.append((0, begin, free))
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
                out.append((3, *m.span()))
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all generators; empty at once for a text without digits and at signs."""
    out = set()
    mail, number = "@" in text or "at)" in text or "at]" in text, DIGITS.search(text)
    for kind, pattern in LOOSE:
        if number if kind else mail:
            out.update((kind, *m.span()) for m in pattern.finditer(text))
    return sorted(out)


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span and its surroundings, as numbers."""
    span, before = text[start:end], text[max(0, start - 24) : start]
    groups = DIGITS.findall(span)
    digits = "".join(groups)
    values = [int(g) if len(g) < 6 else 99999 for g in groups]
    host = re.split(r"@|at[\])]", span)[-1]
    return [
        kind, min(end - start, 99), min(len(digits), 40), min(len(groups), 20),
        max(map(len, groups), default=0), min(map(len, groups), default=0),
        max(values, default=0), min(values, default=0), span[0] == "+", "(" in span, span.count("."),
        len(set(re.sub(r"[0-9]", "", span))), len(digits) >= 12 and luhn(digits[:40]),
        int(digits[0]) if digits else -1, text[start - 1 : start].isalnum() if start else False,
        text[end : end + 1].isalnum(), host.count("."), len(host.rpartition(".")[2]),
        "@" in span, "/" in span, digits.startswith("00"), host.rpartition(".")[2].isalpha(), *(bool(c.search(before)) for c in CUES),
    ]


class Trees:
    """Gradient-boosted trees of depth 3 for the logistic loss, on binned features.

    Margins are whole: logits in parts of ``UNIT``. A leaf moves them by at most ``STEP`` logits before the rate.
    """

    DEPTH, UNIT, STEP, RATE, BINS, ROUNDS = 3, 1 << 10, 8.0, 0.3, 32, 40
    FIXED = 1 << 20  # gradients are whole parts of it

    def __init__(self, x: np.ndarray, y: np.ndarray):
        """Learned from arrays; :func:`fit` learns the same way from a table."""
        self._begin([np.quantile(x[:, k], self.borders()) for k in range(x.shape[1])], y.sum(), len(y))
        binned, ones = self.binned(x), np.ones(len(y), dtype=np.int64)
        self.learn(lambda tree, level: self.sums(binned, ones, np.asarray(y, dtype=np.int64), self.margin(binned), tree, level))

    @classmethod
    def begun(cls, quantiles: list, positive: int, total: int) -> Trees:
        """No tree yet, only bins and start, from the features' quantiles at :meth:`borders`."""
        trees = cls.__new__(cls)
        trees._begin(quantiles, positive, total)
        return trees

    @classmethod
    def borders(cls) -> np.ndarray:
        return np.linspace(0, 1, cls.BINS + 1)[1:-1]

    def _begin(self, quantiles: list, positive: int, total: int) -> None:
        self.edges, self.trees = [np.unique(q) for q in quantiles], []
        p = min(max(positive / total, 1e-3), 1 - 1e-3)
        self.start = int(np.rint(np.log(p / (1 - p)) * self.UNIT))

    def learn(self, sums: Callable) -> None:
        """All trees; ``sums(tree, level)`` adds :meth:`sums` over all examples, by the trees so far."""
        for _ in range(self.ROUNDS):
            self.trees.append(self._grow(sums))

    def _grow(self, sums: Callable):
        inner = 2**self.DEPTH - 1
        column, at = np.zeros(inner, dtype=np.int64), np.full(inner, self.BINS, dtype=np.int64)
        leaves = np.zeros(inner + 1, dtype=np.int64)
        for level in range(self.DEPTH):
            left_g, left_h = np.cumsum(sums((column, at), level), axis=3) / self.FIXED
            for node in range(2**level):
                g, h, k = left_g[node], left_h[node], 2**level - 1 + node
                all_g, all_h = g[0, -1], h[0, -1]
                score = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                if score.max() > 1e-6:
                    column[k], at[k] = np.unravel_index(score.argmax(), score.shape)
                if level == self.DEPTH - 1:
                    split = (column[k], min(at[k], self.BINS - 1))
                    for side, (g_in, h_in) in enumerate(((g[split], h[split]), (all_g - g[split], all_h - h[split]))):
                        step = np.clip(-g_in / (h_in + 1), -self.STEP, self.STEP)
                        leaves[2 * node + side] = np.rint(step * self.RATE * self.UNIT)
        return column, at, leaves

    @staticmethod
    def _node(tree, x: np.ndarray, depth: int) -> np.ndarray:
        """Place of each row among the nodes of a level."""
        column, at = tree[:2]
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), column[node]] > at[node])
        return node - (2**depth - 1)

    def sums(self, x, n, positive, margin, tree, level: int) -> np.ndarray:
        """First and second gradients by node of the level, feature and bin, of rows that stand for ``n`` examples."""
        chance = 1 / (1 + np.exp(-margin / self.UNIT))
        g = n * np.rint(chance * self.FIXED) - positive * self.FIXED
        h = n * np.rint(np.maximum(chance * (1 - chance), 1e-6) * self.FIXED)
        shape = (2**level, x.shape[1], self.BINS)
        slot = ((self._node(tree, x, level)[:, None] * shape[1] + np.arange(shape[1])) * self.BINS + x).ravel()
        added = [np.bincount(slot, weights=np.repeat(v, shape[1]), minlength=np.prod(shape)) for v in (g, h)]
        return np.stack(added).astype(np.int64).reshape(2, *shape)

    def binned(self, x: np.ndarray) -> np.ndarray:
        x = np.minimum(x, LARGEST)
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def moved(self, binned: np.ndarray, since: int = 0) -> np.ndarray:
        """What the trees from number ``since`` on add to the margins."""
        added = np.zeros(len(binned), dtype=np.int64)
        for tree in self.trees[since:]:
            added += tree[2][self._node(tree, binned, self.DEPTH)]
        return added

    def margin(self, binned: np.ndarray) -> np.ndarray:
        return self.start + self.moved(binned)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.binned(x)) / self.UNIT))


class Spans:
    """Spans of one kind that don't overlap, in order."""

    def __init__(self, kind: int, spans: list[tuple[int, int, int]]):
        self.starts, self.ends = [a for k, a, _ in spans if k == kind], [b for k, _, b in spans if k == kind]

    def met(self, a: int, b: int) -> Iterator[tuple[int, int]]:
        """Those that overlap the stretch."""
        k = bisect_right(self.ends, a)
        while k < len(self.starts) and self.starts[k] < b:
            yield self.starts[k], self.ends[k]
            k += 1

    def covers(self, a: int, b: int) -> bool:
        """One holds at least four fifths of the stretch and lies in it by as much."""
        return any(5 * (min(b, e) - max(a, s)) >= 4 * max(b - a, e - s) for s, e in self.met(a, b))

    def meets(self, a: int, b: int) -> bool:
        return next(self.met(a, b), None) is not None


def rewritten(text: str, base: list[tuple[int, int, int]], turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its base spans in forms the base patterns don't match, and where these are.

    ``turn`` picks the form of the first span, later ones take turns. Of overlapping spans the first is
    rewritten; network addresses stay.
    """
    out, spans, at, size = [], [], 0, 0
    for a, b, kind in sorted((a, b, k) for k, a, b in base):
        if a < at or kind == 1:
            continue
        span, turn = text[a:b], turn + 1
        if kind == 0:
            name, _, site = span.rpartition("@")
            new = name + (" [at] ", "[at]", "(at)", " (at) ")[turn % 4] + site
        elif kind == 2:
            digits, mark = re.sub("[^0-9]", "", span), "./"[turn % 2]
            new = mark.join(digits[k : k + 4] for k in range(0, len(digits), 4))
        elif turn % 2:
            new = "00" + span[1:]
        else:  # without the country: area in brackets, rest in two groups
            digits = re.sub("[^0-9]", "", span)[-10:]
            new = f"({digits[:-7]}) {digits[-7:-4]}-{digits[-4:]}"
        out += [text[at:a], new]
        size += a - at
        spans.append((kind, size, size + len(new)))
        size, at = size + len(new), b
    return "".join(out) + text[at:], spans


def examples(text: str, turn: int) -> Iterator[tuple[bool, list[float]]]:
    """Label and features of the candidates of a rewritten text."""
    body, rewrites = rewritten(text, base_spans(text), turn)
    left = base_spans(body)
    wanted, base = ([Spans(kind, spans) for kind in range(len(KINDS))] for spans in (rewrites, left))
    for kind, a, b in candidates(body):
        label = wanted[kind].covers(a, b)
        if label or not (wanted[kind].meets(a, b) or base[kind].meets(a, b)):
            yield label, features(body, kind, a, b)


#: Examples a task counts together at a time, and trees between written margins.
TOGETHER, AHEAD = 1 << 14, 8


def counted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """All examples of all texts: whether their text is held out, features ``x``, and how many there are and are positive."""
    # No generator finds anything in a text without these.
    rows = keyed(docs, key, text).where(F.col("_text").rlike(r"[0-9@]|at[\])]")).withColumn("_h", F.xxhash64("_text", "_key"))

    def together(some: list) -> pd.DataFrame:
        found = np.array([(held, *np.clip(x, -1, LARGEST), label) for held, label, x in some], dtype=np.int32)
        kinds, which = np.unique(found[:, :-1], axis=0, return_inverse=True)
        which = which.ravel()
        return pd.DataFrame({
            "held": kinds[:, 0] > 0, "x": list(kinds[:, 1:]), "n": np.bincount(which, minlength=len(kinds)),
            "positive": np.bincount(which, weights=found[:, -1], minlength=len(kinds)).astype(np.int64),
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some: list = []
        for batch in batches:
            for body, mark in zip(batch["_text"], batch["_h"]):
                for label, x in examples(body, mark >> 1 & 3):
                    some.append((mark & 1, label, x))
                    if len(some) == TOGETHER:
                        yield together(some)
                        some = []
        if some:
            yield together(some)

    found = rows.mapInPandas(run, "held boolean, x array<int>, n bigint, positive bigint")
    return written(found.groupBy("held", "x").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), -1)


def fit(docs: DataFrame, precision: float = 0.99, enough: int = 50, key: str = "doc_id", text: str = "text"):
    """Trees and a least margin per kind (infinite where none reaches ``precision``), or None.

    Learned from every candidate of every text; runs jobs. Rows of equal key or text all count.
    """
    found = counted(docs, key, text)
    learned = found.where("not held")
    width = len(features("1", 1, 0, 1))
    borders = F.array(*[F.lit(float(b)) for b in Trees.borders()])
    quantiles = [F.percentile(F.col("x")[k], borders, F.col("n")).alias(f"q{k}") for k in range(width)]
    total, positive, *quantiles = learned.agg(F.sum("n"), F.sum("positive"), *quantiles).first()
    if total is None or positive < enough or total - positive < enough:
        remove(found)
        return None

    trees = Trees.begun(quantiles, positive, total)

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["x"])
            yield batch.assign(kind=x[:, 0], x=[row.tobytes() for row in trees.binned(x)])[["held", "kind", "x", "n", "positive"]]

    binned = found.mapInPandas(bins, "held boolean, kind int, x binary, n bigint, positive bigint")
    binned = written(binned.groupBy("held", "kind", "x").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")))
    remove(found)
    # Rows to learn from, with the margin of the first ``done`` trees.
    state = {"rows": written(binned.where("not held").select("x", "n", "positive", F.lit(trees.start).cast("bigint").alias("margin"))), "done": 0}

    def ahead() -> None:
        done, before = state["done"], state["rows"]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(margin=batch["margin"] + trees.moved(_matrix(batch["x"]), done))

        state.update(rows=written(before.mapInPandas(run, before.schema)), done=len(trees.trees))
        remove(before)

    def sums(tree, level: int) -> np.ndarray:
        if len(trees.trees) - state["done"] == AHEAD:
            ahead()
        done = state["done"]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                x = _matrix(batch["x"])
                margin = batch["margin"].to_numpy() + trees.moved(x, done)
                added = trees.sums(x, batch["n"].to_numpy(), batch["positive"].to_numpy(), margin, tree, level)
                total = added if total is None else total + added
            if total is not None:
                g, h = total.reshape(2, -1)
                slots = np.flatnonzero(h)
                yield pd.DataFrame({"slot": slots.astype(np.int32), "g": g[slots], "h": h[slots]})

        added = state["rows"].mapInPandas(run, "slot int, g bigint, h bigint").groupBy("slot").agg(F.sum("g"), F.sum("h"))
        out = np.zeros((2, 2**level * width * Trees.BINS), dtype=np.int64)
        for slot, g, h in added.collect():
            out[:, slot] = g, h
        return out.reshape(2, 2**level, width, Trees.BINS)

    trees.learn(sums)
    remove(state["rows"])

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(margin=trees.margin(_matrix(batch["x"])))[["kind", "margin", "n", "positive"]]

    # Margins are whole and bounded, so a kind has a bounded number of them.
    scores = binned.where("held").mapInPandas(scored, "kind int, margin bigint, n bigint, positive bigint")
    scores = scores.groupBy("kind", "margin").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    down = Window.partitionBy("kind").orderBy(F.desc("margin")).rowsBetween(Window.unboundedPreceding, 0)
    scores = scores.select("kind", "margin", F.sum("n").over(down).alias("n"), F.sum("positive").over(down).alias("positive"))
    good = scores.where((F.col("positive") >= enough) & (F.col("positive") >= precision * F.col("n")))
    limits = [np.inf] * len(KINDS)
    for kind, least in good.groupBy("kind").agg(F.min("margin")).collect():
        limits[kind] = least
    remove(binned)
    return trees, limits


def chosen(text: str, base: list[tuple[int, int, int]], model) -> list[tuple[int, int, int]]:
    """Candidates of at least their threshold, best first, that overlap neither a base span nor each other."""
    trees, limits = model
    some = [c for c in candidates(text) if limits[c[0]] < np.inf]
    if not some:
        return []
    margin = trees.margin(trees.binned(np.array([features(text, *c) for c in some], dtype=float)))
    taken = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], []
    top = 0
    for _, b in taken:
        top = max(top, b)
        reach.append(top)
    kept: list[tuple[int, int]] = []
    out = []
    for score, (kind, a, b) in sorted(zip(-margin, some)):
        if -score < limits[kind]:
            continue
        k = bisect_left(starts, b)
        if k and reach[k - 1] > a:
            continue
        k = bisect_left(kept, (b, 0))
        if k and kept[k - 1][1] > a:
            continue
        insort(kept, (a, b))
        out.append((kind, a, b))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, model=None, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Spans of every whole text, in code points, ends exclusive.

    Columns: ``key``, ``base`` and ``spans`` as lists ``kind:start:end`` joined by commas, the number
    of base spans per kind, and with ``with_text`` the text with every span replaced by its kind in
    angle brackets (overlapping spans by the first's). A null text is empty (redacted: null). Rows
    are independent, so repeated rows and ties need no rule; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value if shared else None
        for batch in batches:
            rows = []
            for name, body in zip(batch["_key"], batch["_text"]):
                missing, body = body is None, body or ""
                base = base_spans(body)
                spans = base + chosen(body, base, known) if known else base
                counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                row = (name, *counts, listed(base), listed(spans))
                rows.append(row + ((None if missing else redacted(body, spans),) if with_text else ()))
            yield pd.DataFrame(rows, columns=names)

    names = ["_key", *(f"n_{k}" for k in KINDS), "base", "spans"] + ["redacted"] * with_text
    kinds = "_key string, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base string, spans string"
    found = keyed(docs, key, text).mapInPandas(run, kinds + ", redacted string" * with_text)
    return unkeyed(found, docs, key)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model=None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` redacted, in the same row: no join, so keys may be null or repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        known, out = shared.value if shared else None, []
        for body in texts:
            if body:
                base = base_spans(body)
                body = redacted(body, base + chosen(body, base, known) if known else base)
            out.append(body)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, clean(text)).select(*docs.columns)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of base spans, SHA-256 of their list, and the list of all spans."""
    return found.select(key, *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")
