"""Percentiles with bounded relative rank error from mergeable relative-rank compactors.

A sketch is a list of levels; a value on level h stands for 2^h values. A full level sorts itself and passes every other value of
its *lower* part up, so the upper tail is never thinned until much later: the error of a rank r (counted from 0 to 1) shrinks with
the distance to the top. How much of the lower part is passed up follows the number of trailing ones of the level's counter, as in
the relative-error sketch of Cormode, Karnin, Liberty, Thaler and Veselý (2021).

With section size k the rank of a percentile q is off by at most ``error_bound(k, q)`` = 3 * 0.1307 / k * (1 - q) of the group's size
with probability 99.7 %; groups of at most ``6 k`` values are kept whole and are exact. Sketches of separate partitions, days or files
merge level by level into the sketch of their union with the same bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.session import stored

#: Section size; a level holds 6 sections before its first compaction.
K = 32
SECTIONS = 3
PERCENTILES = (0.5, 0.9, 0.95, 0.99)
#: Partial sketches of one key that a single task merges; more are merged in a tree of as many rounds as they need.
FAN_IN = 512
#: Bit of a level's state that keeps the coin of its last even compaction; the bits below count the compactions.
COIN = 1 << 62

SKETCH = "n bigint, levels array<array<double>>, states array<bigint>"
ANSWERS = ", ".join(f"p{round(100 * q)} double" for q in PERCENTILES)


def error_bound(q: float, k: int = K) -> float:
    """Three standard deviations of the relative rank of percentile ``q``."""
    return 3 * (0.0512 / SECTIONS) ** 0.5 / k * (1 - q)


class Sketch:
    """Levels of values with the number of compactions each has seen."""

    def __init__(self, k: int = K):
        self.k, self.n = k, 0
        self.levels: list[np.ndarray] = [np.empty(0)]
        self.states: list[int] = [0]

    def add(self, values: np.ndarray) -> None:
        self.n += len(values)
        self.levels[0] = np.concatenate([self.levels[0], values])
        self._compress()

    def merge(self, n: int, levels: list[np.ndarray], states: list[int]) -> None:
        self.n += n
        while len(self.levels) < len(levels):
            self.levels.append(np.empty(0))
            self.states.append(0)
        for h, values in enumerate(levels):
            self.levels[h] = np.concatenate([self.levels[h], values])
            self.states[h] |= states[h]
        self._compress()

    def _shape(self, h: int) -> tuple[int, int]:
        """(section size, sections) of a level: more and smaller sections the more often it was compacted."""
        size, sections = float(self.k), SECTIONS
        while self.states[h] & (COIN - 1) >= 1 << (sections - 1) and size > 5.7:
            size, sections = size / 2**0.5, sections * 2
        return max(4, 2 * round(size / 2)), sections

    def _compress(self) -> None:
        h = 0
        while h < len(self.levels):
            size, sections = self._shape(h)
            if len(self.levels[h]) > 2 * size * sections:
                self._compact(h, size, sections)
                h = -1 if len(self.levels[h]) > 2 * size * sections else h
            h += 1

    def _compact(self, h: int, size: int, sections: int) -> None:
        values = np.sort(self.levels[h])
        state, coin = self.states[h] & (COIN - 1), self.states[h] >= COIN
        passed = min(((~state & (state + 1)).bit_length() - 1) + 1, sections)
        keep = size * sections + (sections - passed) * size
        cut = len(values) - keep
        cut -= cut & 1
        # One coin for two compactions: the second takes the other half. The coin is a hash of the content, so a task that runs again
        # gives the same sketch, while values and coin don't depend on each other.
        if state & 1:
            coin = not coin
        else:
            coin = bool(hashlib.blake2b(values[:cut].tobytes() + state.to_bytes(8, "little"), digest_size=1, key=bytes([h])).digest()[0] & 1)
        up = values[int(coin) : cut : 2]
        self.levels[h] = values[cut:]
        self.states[h] = state + 1 | (0 if state & 1 else coin * COIN)
        if h + 1 == len(self.levels):
            self.levels.append(np.empty(0))
            self.states.append(0)
        self.levels[h + 1] = np.concatenate([self.levels[h + 1], up])

    def percentiles(self, at: tuple[float, ...] = PERCENTILES) -> list[float]:
        """The smallest value whose estimated rank reaches q * n."""
        values = np.concatenate(self.levels)
        weights = np.concatenate([np.full(len(v), 1 << h, np.int64) for h, v in enumerate(self.levels)])
        order = np.argsort(values, kind="stable")
        reach = np.cumsum(weights[order])
        spots = np.searchsorted(reach, np.ceil(np.array(at) * reach[-1] - 1e-9))
        return [float(values[order[min(i, len(values) - 1)]]) for i in spots]


def _segments(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Starts of the runs of equal keys (first ``keys`` columns) in a sorted batch, with the end."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for c in batch.columns[:keys]:
        if batch.num_rows > 1:
            a, b = c.slice(1), c.slice(0, batch.num_rows - 1)
            differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
            nulls = pc.not_equal(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
            new[1:] |= differ | nulls
    return np.append(np.flatnonzero(new), batch.num_rows)


def _doubles(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.float64()))


class _Out:
    """Builds output batches: key rows taken from input batches, then n, levels, states and, at the end, answers."""

    def __init__(self, names: list[str], keys: int, answers: bool):
        self.names, self.keys, self.answers = names, keys, answers

    def small(self, batch: pa.RecordBatch, rows: np.ndarray, counts: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        """Sketches of one level: ``values`` holds ``counts`` sorted values for each key row, one key after the other."""
        offsets = np.append(0, np.cumsum(counts))
        ones = np.arange(len(rows) + 1)
        levels = pa.ListArray.from_arrays(pa.array(ones, pa.int32()), _doubles(offsets, values))
        states = pa.ListArray.from_arrays(pa.array(ones, pa.int32()), pa.array(np.zeros(len(rows), np.int64)))
        columns = [c.take(pa.array(rows)) for c in batch.columns[: self.keys]] + [pa.array(counts, pa.int64()), levels, states]
        if self.answers:
            for q in PERCENTILES:
                columns.append(pa.array(values[offsets[:-1] + np.maximum(np.ceil(q * counts - 1e-9).astype(np.int64), 1) - 1]))
        return pa.RecordBatch.from_arrays(columns, self.names)

    def large(self, key: list[pa.Array], s: Sketch) -> pa.RecordBatch:
        columns = [
            *key,
            pa.array([s.n], pa.int64()),
            pa.array([[np.sort(v) for v in s.levels]], pa.list_(pa.list_(pa.float64()))),
            pa.array([s.states], pa.list_(pa.int64())),
        ]
        if self.answers:
            columns += [pa.array([p], pa.float64()) for p in s.percentiles()]
        return pa.RecordBatch.from_arrays(columns, self.names)


def _sketcher(keys: list[str], k: int, merged: bool, answers: bool):
    """An Arrow function over rows sorted by ``keys``: (keys, value) or, where ``merged``, (keys, n, levels, states).

    Runs of a key that fit in one uncompacted level are handled for the whole batch at once; longer ones one by one. A run may
    go on in the next batch, so the last key of each batch stays open.
    """
    out = _Out([*keys, "n", "levels", "states", *([a.split()[0] for a in ANSWERS.split(", ")] if answers else [])], len(keys), answers)
    whole = 2 * k * SECTIONS

    def feed(s: Sketch, batch: pa.RecordBatch, a: int, b: int) -> None:
        if not merged:
            s.add(batch.column(len(keys)).slice(a, b - a).to_numpy(zero_copy_only=False))
            return
        for n, levels, states in zip(*(batch.column(len(keys) + i).slice(a, b - a).to_pylist() for i in range(3))):
            s.merge(n, [np.array(v, float) for v in levels], states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key: list[pa.Array] | None = None
        held = Sketch(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _segments(batch, len(keys))
            first = 0
            if held_key is not None:
                same = all(c.slice(0, 1).equals(h) for c, h in zip(batch.columns, held_key))
                if same:
                    feed(held, batch, 0, starts[1])
                    first = 1
                if not same or len(starts) > 2:
                    yield out.large(held_key, held)
                    held_key = None
            if first >= len(starts) - 1:
                continue
            a, b = starts[first:-2], starts[first + 1 : -1]
            if merged:
                flat = pc.list_flatten(batch.column(len(keys) + 1))
                depth = pc.list_value_length(batch.column(len(keys) + 1)).to_numpy(zero_copy_only=False)
                total = batch.column(len(keys)).to_numpy(zero_copy_only=False)
                upto = np.append(0, np.cumsum(total))
                deep = np.append(0, np.cumsum(depth > 1))
                counts = upto[b] - upto[a]
                fits = (counts <= whole) & (deep[b] == deep[a])
                if fits.any():
                    # Rows of depth 1 hold exactly their n values; find them in the flattened levels.
                    row_level = np.append(0, np.cumsum(depth))[:-1]
                    ends = np.append(0, np.cumsum(pc.list_value_length(flat).to_numpy(zero_copy_only=False)))
                    numbers = pc.list_flatten(flat).to_numpy(zero_copy_only=False)
                    rows = np.concatenate([np.arange(x, y) for x, y in zip(a[fits], b[fits])])
                    each = total[rows]
                    at = np.repeat(ends[row_level[rows]] - np.append(0, np.cumsum(each))[:-1], each) + np.arange(each.sum())
                    values = numbers[at]
                    owner = np.repeat(np.arange(fits.sum()), counts[fits])
                    values = values[np.lexsort((values, owner))]
                    yield out.small(batch, a[fits], counts[fits], values)
            else:
                counts = b - a
                fits = counts <= whole
                if fits.any():
                    numbers = batch.column(len(keys)).to_numpy(zero_copy_only=False)
                    inside = np.repeat(fits, counts)
                    values = numbers[a[0] : b[-1]][inside]
                    owner = np.repeat(np.arange(fits.sum()), counts[fits])
                    values = values[np.lexsort((values, owner))]
                    yield out.small(batch, a[fits], counts[fits], values)
            for x, y in zip(a[~fits], b[~fits]):
                s = Sketch(k)
                feed(s, batch, x, y)
                yield out.large([c.slice(x, 1) for c in batch.columns[: len(keys)]], s)
            held_key, held = [c.slice(starts[-2], 1) for c in batch.columns[: len(keys)]], Sketch(k)
            feed(held, batch, starts[-2], batch.num_rows)
        if held_key is not None:
            yield out.large(held_key, held)

    return run


def sketches(values: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """(keys, n, levels, states): partial sketches, one per key and partition of ``values``; nothing is shuffled.

    Null and NaN values are left out. Key columns may hold nulls, which form a key of their own.
    """
    clean = values.select(*keys, F.col(value).cast("double").alias("value_")).where("value_ is not null and not isnan(value_)")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in clean.select(*keys).schema) + ", " + SKETCH
    return clean.sortWithinPartitions(*keys).mapInArrow(_sketcher(keys, k, False, False), schema)


def merge(partial: DataFrame, keys: list[str], k: int = K, parts: int | None = None) -> DataFrame:
    """The sketches of ``partial`` merged per ``keys``, which may be fewer than those they were made for; with the percentiles.

    ``parts`` is the most sketches that one key can have, where that is known; else ``partial`` is written and counted. They are merged in
    a tree: no task gets more than ``FAN_IN`` or so of one key, however hot it is. Infinite values are values like others.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in partial.select(*keys).schema)
    rows = partial.select(*keys, "n", "levels", "states")
    if parts is None:
        rows = stored(rows, "sketches")
        parts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts_")).agg(F.max("parts_")).first()[0] or 1
    salted = [*keys, "salt_"]
    while parts > FAN_IN:
        # Ids rise by one inside a partition, so every key is spread evenly; the rows come from files or a shuffle in a fixed order.
        parts = -(-parts // FAN_IN)
        rows = stored(
            rows.withColumn("salt_", F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int"))
            .repartition(*salted)
            .sortWithinPartitions(*salted)
            .select(*salted, "n", "levels", "states")
            .mapInArrow(_sketcher(salted, k, True, False), f"{kinds}, salt_ int, {SKETCH}")
            .drop("salt_"),
            "merged",
        )
    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_sketcher(keys, k, True, True), f"{kinds}, {SKETCH}, {ANSWERS}")
    )


def measurements(scores: DataFrame, usage: DataFrame, replies: DataFrame) -> DataFrame:
    """(metric, provider, file, day, value) of page scores, logged requests and provider replies.

    A row delivered more than once under its id counts once. The day is the day of the event, so rows loaded late join the sketch
    of their day. Null values are left out, zeros are values.
    """

    def part(df: DataFrame, metric: str, key: str, value: str, at: str) -> DataFrame:
        return df.where(F.col(value).isNotNull()).select(
            F.lit(metric).alias("metric"),
            F.col(key).cast("bigint").alias("id"),
            "provider",
            "file",
            F.to_date(at).alias("day"),
            F.col(value).cast("double").alias("value"),
        )

    every = (
        part(scores, "overall", "score_id", "overall", "scored_at")
        .unionByName(part(usage, "request_latency", "request_id", "latency_ms", "ts"))
        .unionByName(part(replies, "reply_latency", "result_id", "latency_ms", "requested_at"))
    )
    return every.distinct().drop("id")
