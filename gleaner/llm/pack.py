"""Filling containers of fixed capacity with documents of varying length.

Only the histogram of lengths goes to the driver; it has at most `capacity` entries. There, shallow combinations of
lengths that fill a container up to a small window are enumerated, their repeat counts solved against the histogram by
non-negative least squares and rounded down, and what is left packed greedily, by length and count. The outcome is a plan
of ranges: items number r0 to r1 of a length go to the containers from c on, k at a time. Items are numbered within their
length by offset chunking and find their container in the plan, so no task sees all items of a length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tokens import Tokenizer, with_token_count
from gleaner.operators.chunked import number_rows
from gleaner.runtime import materialise

MAX_CAPACITY = 1 << 20
MAX_PACKS = 1000


@dataclass(frozen=True)
class PackSettings:
    """window: unused part of a container that a combination may leave. partners: second lengths tried for each first,
    as many at every size of the input. steps: of the solver."""

    window: float = 0.005
    partners: int = 24
    steps: int = 300


@dataclass(frozen=True)
class Pattern:
    """A way to fill a container, used `repeats` times: (length, how many) pairs."""

    parts: tuple[tuple[int, int], ...]
    repeats: int

    @property
    def filled(self) -> int:
        return sum(n * k for n, k in self.parts)


@dataclass(frozen=True)
class Combinations:
    """A column for each way to fill a container: up to four lengths, as positions in `lengths`, and how many of each (0
    where there are fewer), the longest first."""

    lengths: np.ndarray
    index: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return self.index.shape[1]

    def __iter__(self) -> Iterator[tuple[tuple[int, int], ...]]:
        return map(self.parts, range(len(self)))

    def filled(self) -> np.ndarray:
        return (self.lengths[self.index] * self.count).sum(0)

    def parts(self, j: int) -> tuple[tuple[int, int], ...]:
        return tuple((int(self.lengths[i]), int(k)) for i, k in zip(self.index[:, j], self.count[:, j], strict=True) if k)


#: Columns of combinations that are worked on at once; it bounds the memory of intermediate arrays only.
BLOCK = 1 << 17


def _merged(index: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal lengths of a column put together, the longest first, unused places last (position and count 0)."""
    place = np.where(count > 0, index, -1)
    for _ in range(2):
        order = np.argsort(-place, axis=0, kind="stable")
        place, count = np.take_along_axis(place, order, 0), np.take_along_axis(count, order, 0)
        for j in range(1, len(place)):
            same = (place[j] == place[j - 1]) & (place[j] >= 0)
            count[j] += np.where(same, count[j - 1], 0)
            count[j - 1], place[j - 1] = np.where(same, 0, count[j - 1]), np.where(same, -1, place[j - 1])
    return np.maximum(place, 0).astype(np.int32), count.astype(np.int32)


def _distinct(index: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.where(count > 0, (index.astype(np.int64) + 1) << 21 | count, 0)
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    first = np.ones(keys.shape[1], bool)
    first[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
    return index[:, order[first]], count[:, order[first]]


def combinations_of(histogram: Mapping[int, int], capacity: int, settings: PackSettings) -> Combinations:
    """Combinations of up to three lengths, each some times over, and one more, that fill all but the window."""
    lengths = np.array(sorted(n for n, c in histogram.items() if c > 0), np.int64)
    slack = int(capacity * settings.window)
    upto = lambda room: np.searchsorted(lengths, room, side="right") - 1
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(*parts: tuple[np.ndarray, np.ndarray]) -> None:
        index, count = np.zeros((4, len(parts[0][0])), np.int64), np.zeros((4, len(parts[0][0])), np.int64)
        for j, (i, k) in enumerate(parts):
            index[j], count[j] = i, k
        fills = (lengths[index] * count).sum(0) >= capacity - slack
        found.append(_distinct(*_merged(index[:, fills], count[:, fills])))

    each = max(1, BLOCK // (8 * (settings.partners + 1)))
    for begin in range(0, len(lengths), each):
        firsts = np.arange(begin, min(begin + each, len(lengths)))
        most = capacity // lengths[firsts]
        a, ka = np.tile(firsts, 4), np.concatenate([most, most - 1, most // 2, np.ones_like(most)])
        a, ka = a[ka > 0], ka[ka > 0]
        rest = capacity - ka * lengths[a]
        at = upto(rest)
        add((a[at < 0], ka[at < 0]))
        a, ka, rest, at = (v[at >= 0] for v in (a, ka, rest, at))
        # the nearest partner, and others spread over the lengths below it
        b = np.concatenate([np.arange(settings.partners)[:, None] * at // max(1, settings.partners - 1), at[None]]).ravel()
        a, ka, rest = (np.tile(v, settings.partners + 1) for v in (a, ka, rest))
        b, kb = np.tile(b, 2), np.concatenate([np.ones_like(b), rest // lengths[b]])
        a, ka, rest = (np.tile(v, 2) for v in (a, ka, rest))
        left = rest - kb * lengths[b]
        c = upto(left)
        alone = c < 0
        add((a[alone], ka[alone]), (b[alone], kb[alone]))
        a, ka, b, kb, left, c = (v[~alone] for v in (a, ka, b, kb, left, c))
        kc = left // lengths[c]
        add((a, ka), (b, kb), (c, kc))
        d = upto(left - kc * lengths[c])
        more = d >= 0
        add((a[more], ka[more]), (b[more], kb[more]), (c[more], kc[more]), (d[more], np.ones_like(d[more])))
    if not found:
        return Combinations(lengths, np.zeros((4, 0), np.int32), np.zeros((4, 0), np.int32))
    return Combinations(lengths, *_distinct(np.concatenate([i for i, _ in found], 1), np.concatenate([k for _, k in found], 1)))


def repeat_counts(histogram: Mapping[int, int], combos: Combinations, steps: int) -> np.ndarray:
    """x >= 0 with least |A x - h|^2, A being how often each combination has each length; by accelerated projected
    gradients. Rows are scaled by the histogram so that rare lengths count too."""
    h = np.array([float(histogram[n]) for n in combos.lengths.tolist()])
    scale = 1 / np.sqrt(np.maximum(h, 1))
    h = h * scale
    m, n = len(h), len(combos)
    blocks = [slice(i, min(i + BLOCK, n)) for i in range(0, n, BLOCK)]

    def times(x: np.ndarray) -> np.ndarray:
        out = np.zeros(m)
        for s in blocks:
            for i, k in zip(combos.index[:, s], combos.count[:, s], strict=True):
                out += np.bincount(i, k * x[s], minlength=m)
        return out * scale

    def back(r: np.ndarray) -> np.ndarray:
        r, out = r * scale, np.empty(n)
        for s in blocks:
            out[s] = sum(k * r[i] for i, k in zip(combos.index[:, s], combos.count[:, s], strict=True))
        return out

    v = np.ones(n)
    for _ in range(20):
        v = back(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / max(norm, 1e-12)
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(times(y) - h))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan_patterns(histogram: Mapping[int, int], capacity: int, settings: PackSettings = PackSettings()) -> list[Pattern]:
    """Patterns that together hold every item of the histogram (length to count, lengths 1 to capacity) exactly once."""
    left = {int(n): int(c) for n, c in histogram.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    out: list[Pattern] = []
    combos = combinations_of(left, capacity, settings)
    if len(combos):
        x = repeat_counts(left, combos, settings.steps)
        used = np.flatnonzero(x >= 1)
        for j in used[np.lexsort((-x[used], capacity - combos.filled()[used]))]:
            parts = combos.parts(j)
            times = min(int(x[j] + 1e-6), *(left[n] // k for n, k in parts))
            if times:
                out.append(Pattern(parts, times))
                for n, k in parts:
                    left[n] -= k * times
    # the rest: the longest first, then always the longest that still fits
    lengths = sorted(n for n, c in left.items() if c > 0)
    while lengths:
        room, parts = capacity, {}
        while room > 0:
            i = bisect_right(lengths, room) - 1
            while i >= 0 and left[lengths[i]] - parts.get(lengths[i], 0) <= 0:
                i -= 1
            if i < 0:
                break
            n = lengths[i]
            k = min(room // n, left[n] - parts.get(n, 0))
            parts[n] = parts.get(n, 0) + k
            room -= n * k
        times = min(left[n] // k for n, k in parts.items())
        out.append(Pattern(tuple(sorted(parts.items(), reverse=True)), times))
        for n, k in parts.items():
            left[n] -= k * times
            if left[n] == 0:
                lengths.pop(bisect_right(lengths, n) - 1)
    return out


@dataclass(frozen=True)
class Ranges:
    """The plan as sorted arrays: from the key (rank of pack and length in `slots`, first number) on, k items a container
    from `start`."""

    slots: np.ndarray
    keys: np.ndarray
    starts: np.ndarray
    ks: np.ndarray

    def containers(self, slot: np.ndarray, number: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.keys, _key(self.slots, slot, number), side="right") - 1
        first = self.keys[i] & ((1 << 40) - 1)
        return self.starts[i] + (number - first) // self.ks[i]


def _key(slots: np.ndarray, slot: np.ndarray, number: np.ndarray) -> np.ndarray:
    return np.searchsorted(slots, slot).astype(np.int64) << 40 | number.astype(np.int64)


def _slot(pack: int, length: int) -> int:
    return pack * (MAX_CAPACITY + 1) + length


def ranges_of(plans: Mapping[int, list[Pattern]], first: Mapping[int, int]) -> Ranges:
    """plans by pack number; first: the first container number of each."""
    rows: list[tuple[int, int, int, int]] = []
    for pack, patterns in plans.items():
        at, used = first[pack], {}
        for p in patterns:
            for n, k in p.parts:
                r0 = used.get(n, 0)
                rows.append((_slot(pack, n), r0, at, k))
                used[n] = r0 + k * p.repeats
            at += p.repeats
    rows.sort()
    a = np.array(rows, dtype=np.int64).reshape(-1, 4)
    slots = np.unique(a[:, 0])
    if len(slots) > 1 << 22:
        raise ValueError(f"packs have up to {1 << 22} lengths in all")
    return Ranges(slots, _key(slots, a[:, 0], a[:, 1]), a[:, 2], a[:, 3])


def pack_documents(documents: DataFrame, packs: DataFrame, tokenizer: Tokenizer = Tokenizer(), settings: PackSettings = PackSettings()) -> DataFrame:
    """pack_name, doc_id, part, n_tokens, container: every document once for each pack, containers numbered from 0.

    A document longer than the capacity is split: whole containers for its full parts (part 0, 1, ...), its rest is an
    item like others. Documents without tokens (null or empty text) take no room and have a null container. Documents of
    equal text are packed each. Packs without name or with a capacity below 1 are left out; more than 1,000 others are an error.
    """
    chosen = [
        (i, r["pack_name"], int(r["capacity_tokens"]))
        for i, r in enumerate(packs.where("pack_name is not null and capacity_tokens >= 1").orderBy("pack_name", "capacity_tokens").limit(MAX_PACKS + 1).collect())
    ]
    if len(chosen) > MAX_PACKS:
        raise ValueError(f"there can be {MAX_PACKS} packs")
    if any(c > MAX_CAPACITY for _, _, c in chosen):
        raise ValueError(f"capacities go up to {MAX_CAPACITY}")
    spark = documents.sparkSession
    sizes = materialise(with_token_count(documents.select("doc_id", "text"), tokenizer=tokenizer).select("doc_id", "n_tokens"), "sizes")
    table = F.broadcast(spark.createDataFrame(chosen, "pack int, pack_name string, capacity int"))
    each = sizes.crossJoin(table)
    whole = each.where(F.col("n_tokens") >= F.col("capacity")).select(
        "pack", "doc_id", F.posexplode(F.array_repeat(F.col("capacity"), F.floor(F.col("n_tokens") / F.col("capacity")).cast("int"))).alias("part", "n"),
    )
    rest = each.select(
        "pack", "doc_id", F.floor(F.col("n_tokens") / F.col("capacity")).cast("int").alias("part"), (F.col("n_tokens") % F.col("capacity")).cast("int").alias("n")
    ).where(F.col("n") > 0)
    items = whole.unionByName(rest).withColumn("slot", F.col("pack").cast("bigint") * (MAX_CAPACITY + 1) + F.col("n"))
    numbered = materialise(number_rows(items, "slot", [F.col("doc_id")]).select("pack", "doc_id", "part", "n", "slot", "number"), "items")
    histogram = materialise(numbered.groupBy("pack", "n").agg((F.max("number") + 1).alias("items")), "histogram")
    # a pack at a time: at most one row for each length up to its capacity
    plans = {}
    for i, _, c in chosen:
        plans[i] = plan_patterns({r["n"]: r["items"] for r in histogram.where(F.col("pack") == i).collect()}, c, settings)
    shared = spark.sparkContext.broadcast(ranges_of(plans, dict.fromkeys(plans, 0)))

    @F.pandas_udf("bigint")
    def container(slot: pd.Series, number: pd.Series) -> pd.Series:
        return pd.Series(shared.value.containers(slot.to_numpy(), number.to_numpy()))

    packed = numbered.withColumn("container", container("slot", "number")).join(table.drop("capacity"), "pack")
    packed = packed.select("pack_name", "doc_id", "part", F.col("n").cast("bigint").alias("n_tokens"), "container")
    empty = each.where("n_tokens = 0").select("pack_name", "doc_id", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("n_tokens"), F.lit(None).cast("bigint").alias("container"))
    return packed.unionByName(empty)


def fill_report(packed: DataFrame, packs: DataFrame) -> DataFrame:
    """Per pack: containers, tokens, and the part of their room that is used."""
    capacity = packs.select("pack_name", F.col("capacity_tokens").cast("bigint").alias("capacity"))
    return (
        packed.where("container is not null").groupBy("pack_name")
        .agg(F.max("container").alias("last"), F.sum("n_tokens").alias("tokens"))
        .join(F.broadcast(capacity), "pack_name")
        .select("pack_name", (F.col("last") + 1).alias("containers"), "tokens", F.round(F.col("tokens") / ((F.col("last") + 1) * F.col("capacity")), 6).alias("filled"))
    )
