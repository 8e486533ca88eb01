"""Baseflow separation (W2) as a chunked parallel scan.

Digital baseflow filters are step by step in time: ``b[t] = min(A * b[t-1] + B[t], D[t])``. Such
steps compose into one step of the same form (for A >= 0), so a station's series is cut into
calendar chunks, each chunk is reduced to one (A, B, D), the short list of chunks is walked per
station, and all chunks are then replayed in parallel from their known entry state. No task ever
holds more than a chunk of values, or one small row per chunk of a station; the number of chunks is
bounded by the calendar.

Boughton:      ``b[t] = min(a/(1+C) * b[t-1] + C/(1+C) * Q[t], Q[t])``
Lyne-Hollick:  ``b[t] = min(beta * b[t-1] + (1-beta)/2 * (Q[t] + Q[t-1]), Q[t])``, forward, then
               the same backward over the forward result.

The published filters leave some choices open; they are parameters here:

* ``seed_share``: the filter starts at this share of the first flow (default 1).
* ``min_per_year``: years of a station with fewer values are left out (default 1: none).
* ``a``: when not given, the slow recession rate of the station. Of all falling points
  (``Q[t-1] > Q[t] > Q[t+1]``) the rate ``-dQ/Q`` with ``dQ = (Q[t+1] - Q[t-1]) / 2`` is taken, and
  ``a = exp(-rate)`` at its ``recession_share`` quantile (default 0.05).
* ``C``: when not given, the value of ``C_GRID`` whose Boughton baseflow is closest to the
  Lyne-Hollick baseflow, by squared difference of ``log(1 + b)`` over the station's series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.operators.resample import exact_percentile
from tarnflow.operators.views import BASEFLOW, FLOW
from tarnflow.shared import cut

METHODS = ("Boughton", "LH")
BETA = 0.925
C_GRID = tuple(round(0.0001 * i, 4) for i in range(1, 1000))
FALLBACK_A = 0.95
KEYS = ["station_id", "chunk"]

_STEP = "a array<double>, b array<double>, d array<double>"


# ---- Arithmetic of chunks -------------------------------------------------------------------

#: Values of the chunks that are stepped through together, and of one step of theirs.
TOGETHER, WIDE = 1 << 21, 1 << 14


class Stack:
    """Chunks side by side, the longest first, so that a step in time is one operation on the first few rows.

    ``base`` and ``caps`` have a row per chunk, ``factor`` and ``gain`` a row per chunk and a column per variant. The step
    at time t is ``b = min(factor * b + gain * base[t], caps[t])``; a chunk with a seed (not NaN) begins
    with it. ``order`` holds the chunks' places in the batch.
    """

    def __init__(self, order, base: list[np.ndarray], caps: list[np.ndarray], factor: np.ndarray, gain: np.ndarray, seeds: np.ndarray):
        lengths = np.array([len(x) for x in caps])
        self.order, self.lengths, steps = order, lengths, int(lengths.max())
        self.base, self.caps = np.zeros((len(caps), steps)), np.zeros((len(caps), steps))
        for row, (added, cap) in enumerate(zip(base, caps)):
            self.base[row, :len(added)], self.caps[row, :len(cap)] = added, cap
        self.factor, self.gain = factor, gain
        self.seeded = np.flatnonzero(~np.isnan(seeds))
        self.seeds = seeds[self.seeded][:, None]
        self.active = np.searchsorted(-lengths, -np.arange(steps))  # chunks longer than t

    def _added(self, t: int, m: int) -> np.ndarray:
        return self.base[:m, t, None] * self.gain[:m]

    def composed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each chunk's steps as one: (A, B, D), a row per chunk and a column per variant."""
        a, b, d = np.ones(self.factor.shape), np.zeros(self.factor.shape), np.full(self.factor.shape, np.finfo(float).max)
        for t, m in enumerate(self.active):
            factor, added = self.factor[:m], self._added(t, m)
            a[:m] *= factor
            b[:m] = factor * b[:m] + added
            d[:m] = np.minimum(factor * d[:m] + added, self.caps[:m, t, None])
            if t == 0:
                a[self.seeded], b[self.seeded], d[self.seeded] = 0.0, self.seeds, np.finfo(float).max
        return a, b, d

    def replayed(self, entry: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The number of chunks that have a step, and their states after it, step by step."""
        state = entry.copy()
        for t, m in enumerate(self.active):
            state[:m] = np.minimum(self.factor[:m] * state[:m] + self._added(t, m), self.caps[:m, t, None])
            if t == 0:
                state[self.seeded] = self.seeds
            yield m, state[:m]

    def values(self, entry: np.ndarray) -> list[np.ndarray]:
        """States of each chunk, for one variant."""
        out = np.empty(self.caps.shape)
        for t, (m, state) in enumerate(self.replayed(entry)):
            out[:m, t] = state[:, 0]
        return [row[:n] for row, n in zip(out, self.lengths)]


def stacks(base: list[np.ndarray], caps: list[np.ndarray], factor: np.ndarray, gain: np.ndarray, seeds: np.ndarray) -> Iterator[Stack]:
    """The chunks of a batch in stacks of bounded size."""
    order = np.argsort([-len(x) for x in caps], kind="stable")
    begin = 0
    while begin < len(order):
        longest = max(1, len(caps[order[begin]]))
        here = order[begin:begin + max(1, min(TOGETHER // longest, WIDE // factor.shape[1]))]
        yield Stack(here, [base[k] for k in here], [caps[k] for k in here], factor[here], gain[here], seeds[here])
        begin += len(here)


def composed(given) -> pd.DataFrame:
    """(A, B, D) of every chunk of a batch, in its order; ``given`` are the arguments of :func:`stacks`."""
    rows: list = [None] * len(given[1])
    for stack in stacks(*given):
        for k, abd in zip(stack.order, zip(*(x.tolist() for x in stack.composed()))):
            rows[k] = abd
    return pd.DataFrame(rows, columns=["a", "b", "d"])


def replayed(given, entry) -> pd.Series:
    """Filter values of every chunk of a batch, in its order, from the entry states."""
    rows: list = [None] * len(given[1])
    entries = np.stack([np.asarray(e, dtype=float) for e in entry]) if len(rows) else None
    for stack in stacks(*given):
        for k, values in zip(stack.order, stack.values(entries[stack.order])):
            rows[k] = values
    return pd.Series(rows, dtype=object)


def _arrays(column: pd.Series) -> list[np.ndarray]:
    return [np.asarray(x, dtype=float) for x in column]


def _numbers(column: pd.Series) -> np.ndarray:
    """Numbers, NaN for NULL."""
    return pd.to_numeric(column).to_numpy(dtype=float, na_value=np.nan)


# ---- Chunks ---------------------------------------------------------------------------------


def flow_chunks(df: DataFrame, months: int, min_per_year: int, shared: bool = False) -> DataFrame:
    """Flow series in time order, one row of arrays per station and chunk.

    Input is hourly, so a chunk of ``months`` calendar months holds at most 744 rows a month and
    unit; that is the bound of the collected arrays. ``shared`` says that ``df`` is also used as a
    whole in the same plan: flow is then picked inside the aggregate, because a filter would be
    pushed into a second computation of ``df`` instead of reusing its shuffle.
    """
    if 12 % months:
        raise ValueError("Chunks must divide a year.")
    month = F.year("datetime") * 12 + F.month("datetime") - 1
    value = F.col("value")
    usable = (
        (F.col("constituent") == FLOW) & F.col("datetime").isNotNull()
        & value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    )
    row = F.struct("datetime", "unit", F.abs(value).alias("q"))
    # Never NULL, so that joins on it add no condition that would set the two uses of df apart.
    chunk = F.coalesce(F.floor(month / months).cast("int"), F.lit(-1))
    chunks = (
        (df if shared else df.filter(usable))
        .groupBy("station_id", chunk.alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.when(usable, row))).alias("rows"))
    )
    if months == 12:
        chunks = chunks.filter(F.size("rows") >= max(min_per_year, 1))
    else:
        chunks = chunks.filter(F.size("rows") > 0)
        same_year = Window.partitionBy("station_id", F.floor(F.col("chunk") * months / 12))
        held = chunks.select(*KEYS, F.sum(F.size("rows")).over(same_year).alias("_held"))
        chunks = chunks.join(held.filter(F.col("_held") >= min_per_year), KEYS)
    return chunks.select(
        *KEYS, F.transform("rows", lambda r: r["datetime"]).alias("t"), F.transform("rows", lambda r: r["q"]).alias("q")
    )


def _with_neighbours(chunks: DataFrame, column: str) -> DataFrame:
    """Add the value before and after each chunk; NULL at the ends of the series."""
    order = Window.partitionBy("station_id").orderBy("chunk")
    edges = chunks.select(*KEYS, F.col(column)[0].alias("_first"), F.element_at(column, -1).alias("_last")).select(
        *KEYS, F.lag("_last").over(order).alias("before"), F.lead("_first").over(order).alias("after")
    )
    return chunks.drop("before", "after").join(edges, KEYS)


def _entries(steps: DataFrame, backward: bool = False) -> DataFrame:
    """Entry state of every chunk, walking the composed steps of a station in order."""

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk", ascending=not backward)
        state, entries = np.zeros(len(frame["a"].iloc[0])), []
        for a, b, d in zip(frame["a"], frame["b"], frame["d"]):
            entries.append(state.tolist())
            state = np.minimum(a * state + b, d)
        return pd.DataFrame({"station_id": frame["station_id"], "chunk": frame["chunk"], "entry": entries})

    schema = "station_id string, chunk int, entry array<double>"
    return steps.groupBy("station_id").applyInPandas(walk, schema)


def _scan(chunks: DataFrame, step, values, arguments: list[Column], backward: bool = False) -> Column:
    """Chunks with their entry state and the replayed values in ``result``."""
    steps = chunks.select(*KEYS, step(*arguments).alias("s")).select(*KEYS, "s.*")
    entered = chunks.join(_entries(steps, backward), KEYS)
    return entered.withColumn("result", values(*arguments, F.col("entry"))).drop("entry")


# ---- The two filters ------------------------------------------------------------------------


def _lyne_hollick(chunks: DataFrame) -> DataFrame:
    """Add ``lh``, the two-pass Lyne-Hollick baseflow."""

    def inputs(values, before, backward):
        caps, ahead = [v[:: -1 if backward else 1] for v in _arrays(values)], _numbers(before)
        first = np.array([v[0] for v in caps])
        # Added terms of a pass; ``before`` is the value preceding the chunk in the pass's direction.
        base = [v + np.concatenate(([x], v[:-1])) for v, x in zip(caps, np.where(np.isnan(ahead), 0.0, ahead))]
        one = np.ones((len(caps), 1))
        return base, caps, one * BETA, one * (1 - BETA) / 2, np.where(np.isnan(ahead), first, np.nan)

    def make(backward):
        @F.pandas_udf(_STEP)
        def step(values: pd.Series, before: pd.Series) -> pd.DataFrame:
            return composed(inputs(values, before, backward))

        @F.pandas_udf("array<double>")
        def run(values: pd.Series, before: pd.Series, entry: pd.Series) -> pd.Series:
            done = replayed(inputs(values, before, backward), entry)
            return done.map(lambda v: v[::-1]) if backward else done

        return step, run

    forward = _scan(chunks, *make(False), [F.col("q"), F.col("before")]).withColumnRenamed("result", "pass1")
    forward = cut(_with_neighbours(forward, "pass1"))
    both = _scan(forward, *make(True), [F.col("pass1"), F.col("after")], backward=True)
    return both.withColumnRenamed("result", "lh").drop("pass1")


def _boughton_inputs(q: pd.Series, a: pd.Series, c: np.ndarray, before: pd.Series, seed_share: float):
    """``c`` has a row per chunk and a column per variant."""
    flows = _arrays(q)
    seeds = np.where(np.isnan(_numbers(before)), seed_share * np.array([v[0] for v in flows]), np.nan)
    return flows, flows, _numbers(a)[:, None] / (1 + c), c / (1 + c), seeds


def _boughton_udfs(seed_share: float):
    @F.pandas_udf(_STEP)
    def step(q: pd.Series, a: pd.Series, c: pd.Series, before: pd.Series) -> pd.DataFrame:
        return composed(_boughton_inputs(q, a, _numbers(c)[:, None], before, seed_share))

    @F.pandas_udf("array<double>")
    def run(q: pd.Series, a: pd.Series, c: pd.Series, before: pd.Series, entry: pd.Series) -> pd.Series:
        return replayed(_boughton_inputs(q, a, _numbers(c)[:, None], before, seed_share), entry)

    return step, run


# ---- Calibration ----------------------------------------------------------------------------


def recession_constants(chunks: DataFrame, share: float = 0.05) -> DataFrame:
    """``a`` per station from the rates of its falling points."""

    def rate(x, i):
        # ``x`` has one neighbour on each side, so position i is the value before the point.
        q, ahead = F.get("_x", i + 1), F.get("_x", i + 2)
        falling = (x > q) & (q > ahead)
        return F.when(falling, (x - ahead) / 2 / q)

    framed = F.concat(F.array("before"), F.col("q"), F.array("after"))
    rates = (
        chunks.select("station_id", framed.alias("_x"))
        .select("station_id", F.explode(F.transform("_x", rate)).alias("rate"))
        .filter("rate is not null")
    )
    found = exact_percentile(rates, ["station_id"], "rate", share)
    return found.select("station_id", F.exp(-F.col("rate")).alias("a"))


def _fit_c(chunks: DataFrame, seed_share: float, grid: tuple[float, ...]) -> DataFrame:
    """``C`` per station: chunks carry ``q``, ``lh``, ``a`` and ``before``."""
    c = np.asarray(grid)

    def inputs(q, a, before):
        return _boughton_inputs(q, a, np.tile(c, (len(q), 1)), before, seed_share)

    @F.pandas_udf(_STEP)
    def step(q: pd.Series, a: pd.Series, before: pd.Series) -> pd.DataFrame:
        return composed(inputs(q, a, before))

    @F.pandas_udf("array<double>")
    def misfit(q: pd.Series, a: pd.Series, before: pd.Series, lh: pd.Series, entry: pd.Series) -> pd.Series:
        rows: list = [None] * len(q)
        entries, wanted = np.stack(_arrays(entry)) if rows else None, [np.log1p(v) for v in _arrays(lh)]
        for stack in stacks(*inputs(q, a, before)):
            total, target = np.zeros(stack.factor.shape), np.zeros(stack.caps.shape)
            for row, k in enumerate(stack.order):
                target[row, :stack.lengths[row]] = wanted[k]
            for t, (m, state) in enumerate(stack.replayed(entries[stack.order])):
                total[:m] += (np.log1p(state) - target[:m, t, None]) ** 2
            for row, k in enumerate(stack.order):
                rows[k] = total[row]
        return pd.Series(rows, dtype=object)

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(frame["loss"]), axis=0)
        return pd.DataFrame({"station_id": frame["station_id"].iloc[:1], "c": [float(c[int(total.argmin())])]})

    row = [F.col("q"), F.col("a"), F.col("before")]
    entries = _entries(chunks.select(*KEYS, step(*row).alias("s")).select(*KEYS, "s.*"))
    losses = chunks.join(entries, KEYS).select("station_id", misfit(*row, F.col("lh"), F.col("entry")).alias("loss"))
    return losses.groupBy("station_id").applyInPandas(best, "station_id string, c double")


def calibrate(
    df: DataFrame,
    months: int = 12,
    min_per_year: int = 1,
    seed_share: float = 1.0,
    recession_share: float = 0.05,
    grid: tuple[float, ...] = C_GRID,
) -> DataFrame:
    """``a`` and ``c`` per station with flow. Runs jobs: intermediate chunks are checkpointed."""
    chunks = cut(_with_neighbours(flow_chunks(df, months, min_per_year), "q"))
    return _calibrated(chunks, seed_share, recession_share, grid)


def _calibrated(chunks: DataFrame, seed_share: float, recession_share: float, grid: tuple[float, ...]) -> DataFrame:
    """:func:`calibrate` on checkpointed chunks."""
    stations = chunks.select("station_id").distinct()
    slow = stations.join(recession_constants(chunks, recession_share), "station_id", "left").select(
        "station_id", F.coalesce("a", F.lit(FALLBACK_A)).alias("a")
    )
    target = cut(_lyne_hollick(chunks).drop("t", "after").join(slow, "station_id"))
    return cut(slow.join(_fit_c(target, seed_share, grid), "station_id"))


# ---- Operator -------------------------------------------------------------------------------


def baseflow(
    df: DataFrame,
    method: str = "Boughton",
    a: float | None = None,
    c: float | None = None,
    params: DataFrame | None = None,
    months: int = 12,
    min_per_year: int = 1,
    seed_share: float = 1.0,
    origin: str | None = None,
    shared: bool = False,
    recession_share: float = 0.05,
    grid: tuple[float, ...] = C_GRID,
) -> DataFrame:
    """Baseflow rows (constituent QB, unit cfs) of every station with flow.

    ``a`` and ``c`` may be given for all stations, or per station in ``params``; otherwise they are
    calibrated on checkpointed chunks, which runs jobs at once. With given values the result is one
    lazy plan. ``recession_share`` and ``grid`` are passed on to the calibration.
    """
    if method not in METHODS:
        raise ValueError(f"Baseflow method {method} not recognized. Known methods are: {METHODS}")
    chunks = _with_neighbours(flow_chunks(df, months, min_per_year, shared), "q")
    if method == "LH":
        done = _lyne_hollick(chunks).withColumnRenamed("lh", "result")
    else:
        if a is not None and c is not None:
            known = chunks.withColumns({"a": F.lit(float(a)), "c": F.lit(float(c))})
        else:
            if params is None:
                chunks = cut(chunks)  # read for calibration and again for the result; df only once
                params = _calibrated(chunks, seed_share, recession_share, grid)
            known = chunks.join(params.select("station_id", "a", "c"), "station_id")
        arguments = [F.col("q"), F.col("a"), F.col("c"), F.col("before")]
        done = _scan(known, *_boughton_udfs(seed_share), arguments)
    rows = done.select("station_id", F.explode(F.arrays_zip("t", F.col("result").alias("b"))).alias("r"))
    return rows.select(
        "station_id",
        F.col("r.t").alias("datetime"),
        F.lit(BASEFLOW).alias("constituent"),
        F.lit("cfs").alias("unit"),
        F.col("r.b").alias("value"),
        *([F.lit(origin).alias("station_origin")] if origin else []),
    )


def with_baseflow(df: DataFrame, **options) -> DataFrame:
    """Observations and their baseflow rows (U3); stations without flow add nothing."""
    from tarnflow.operators.views import append_derived

    return append_derived(df, baseflow(df, shared=True, **options))
