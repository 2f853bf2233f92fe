"""First centres of many k-means starts, drawn in shared passes.

Spark's ``KMeans`` draws the first centres of one start in about seven passes (k-means|| of two steps, then a local k-means++). The starts of
all k are independent of each other, so here the same draws, by the same random numbers, go through the rows together. Rows come as blocks of
packed doubles in the partitions and the order of the vectors that Spark would read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

STEPS = 2          # of k-means||, Spark's default
ROWS_AT_ONCE = 1024
LANES, TURNS = 512, 64
WORD, INT = (1 << 64) - 1, (1 << 32) - 1


# --- Java's and Spark's random numbers ------------------------------------------------------------

def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> bits - 1 else x


class JavaRandom:
    """java.util.Random."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def next(self, bits: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.state >> 48 - bits, 32) if bits == 32 else self.state >> 48 - bits

    def integer(self) -> int:
        return _signed(self.next(32), 32)

    def below(self, bound: int) -> int:
        if bound & bound - 1 == 0:
            return bound * self.next(31) >> 31
        while True:
            bits = self.next(31)
            if bits - bits % bound + bound - 1 < 1 << 31:
                return bits % bound

    def long(self) -> int:
        high = self.next(32)
        return _signed((high << 32) + self.next(32), 64)

    def double(self) -> float:
        high = self.next(26)
        return ((high << 27) + self.next(27)) * 2.0 ** -53


def _murmur(data: bytes, seed: int) -> int:
    h = seed & INT
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & INT
        k = (k << 15 | k >> 17) & INT
        h ^= k * 0x1B873593 & INT
        h = (h << 13 | h >> 19) & INT
        h = (h * 5 + 0xE6546B64) & INT
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & INT
    h = (h ^ h >> 13) * 0xC2B2AE35 & INT
    return h ^ h >> 16


def hashed_seed(seed: int) -> int:
    """State of Spark's XORShiftRandom after seeding."""
    data = (seed & WORD).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


class ShiftRandom(JavaRandom):
    """org.apache.spark.util.random.XORShiftRandom."""

    def __init__(self, seed: int):
        self.state = hashed_seed(seed)

    def next(self, bits: int) -> int:
        s = self.state
        s ^= s << 21 & WORD
        s ^= s >> 35
        s ^= s << 4 & WORD
        self.state = s
        return s & ((1 << bits) - 1)


def _turned(s: np.ndarray) -> np.ndarray:
    s = s ^ s << np.uint64(21)
    s = s ^ s >> np.uint64(35)
    return s ^ s << np.uint64(4)


def _jump(columns: np.ndarray, s: np.ndarray) -> np.ndarray:
    """A linear map of 64 bits, given by what becomes of each bit, applied to every state."""
    out = np.zeros_like(s)
    for bit in range(64):
        out ^= columns[bit] * (s >> np.uint64(bit) & np.uint64(1))
    return out


class Uniforms:
    """nextDouble of several XORShiftRandoms, many numbers at once: lanes some turns apart go on side by side."""

    def __init__(self, seeds: Sequence[int]):
        self.state = np.array([[hashed_seed(s)] for s in seeds], np.uint64)
        columns = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for _ in range(TURNS):
            columns = _turned(columns)
        self.jumps = [columns]  # TURNS times 1, 2, 4, … up to all lanes
        while 1 << len(self.jumps) <= LANES:
            self.jumps.append(_jump(self.jumps[-1], self.jumps[-1]))
        self.rest = np.empty((len(seeds), 0))

    def _more(self) -> np.ndarray:
        lanes = self.state
        for jump in self.jumps[:-1]:
            lanes = np.concatenate([lanes, _jump(jump, lanes)], axis=1)
        out = np.empty((*lanes.shape, TURNS), np.uint64)
        for turn in range(TURNS):
            lanes = _turned(lanes)
            out[:, :, turn] = lanes
        self.state = out[:, -1:, -1]
        high, low = out[:, :, ::2] & np.uint64((1 << 26) - 1), out[:, :, 1::2] & np.uint64((1 << 27) - 1)
        return (((high << np.uint64(27)) + low) * 2.0 ** -53).reshape(len(out), -1)

    def take(self, n: int) -> np.ndarray:
        parts, held = [self.rest], self.rest.shape[1]
        while held < n:
            parts.append(self._more())
            held += parts[-1].shape[1]
        every = np.concatenate(parts, axis=1)
        self.rest = every[:, n:]
        return every[:, :n]


def sampled_row(sizes: Sequence[int], seed: int) -> tuple[int, int]:
    """(partition, place) of the row that RDD.takeSample(false, 1, seed) returns."""
    total = sum(sizes)
    rand = JavaRandom(seed)

    def shuffled(rows: list[tuple[int, int]]) -> tuple[int, int]:
        for i in range(len(rows) - 1, 0, -1):
            j = rand.below(i + 1)
            rows[i], rows[j] = rows[j], rows[i]
        return rows[0]

    if total <= 1:
        return shuffled([(p, i) for p, n in enumerate(sizes) for i in range(n)])
    gamma = -math.log(1e-4) / total
    fraction = min(1.0, max(1e-10, 1 / total + gamma + math.sqrt(gamma * gamma + 2 * gamma / total)))
    while True:
        found, seeds = [], JavaRandom(rand.integer())
        for p, n in enumerate(sizes):
            shift, at = ShiftRandom(seeds.long()), 0
            if fraction >= 1:
                found += [(p, i) for i in range(n)]
            elif fraction > 0.4:
                found += [(p, i) for i in range(n) if shift.double() <= fraction]
            else:
                while n and (at := at + int(math.log(max(shift.double(), 5e-11)) / math.log1p(-fraction))) < n:
                    found.append((p, at))
                    at += 1
        if found:
            return shuffled(found)


# --- passes -----------------------------------------------------------------------------------------

def squared(x: np.ndarray, norms: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(centre, row) squared distances; none where they are within the digits of the norms."""
    far = (centres * centres).sum(1)
    apart = norms + far[:, None] - 2 * (centres @ x.T)
    apart[apart <= 1e-13 * (norms + far[:, None])] = 0.0
    return apart


def pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column(0):
            x = np.frombuffer(block.as_buffer()).reshape(-1, width)
            for lo in range(0, len(x), ROWS_AT_ONCE):
                yield x[lo:lo + ROWS_AT_ONCE]


def _flat(name: str, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.float64()))], names=[name])


def _sizes(blocks: DataFrame, width: int) -> list[int]:
    def run(batches):
        n = sum(len(x) for x in pieces(batches, width))
        yield _flat("found", [float(TaskContext.get().partitionId()), float(n)])

    found = {int(p): int(n) for (p, n), in blocks.mapInArrow(run, "found array<double>").collect()}
    return [found.get(p, 0) for p in range(max(found, default=-1) + 1)]


def _rows_at(blocks: DataFrame, width: int, wanted: set[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    def run(batches):
        p, at = TaskContext.get().partitionId(), 0
        mine = sorted(i for q, i in wanted if q == p)
        for x in pieces(batches, width):
            for i in mine:
                if at <= i < at + len(x):
                    yield _flat("found", [float(p), float(i), *x[i - at]])
            at += len(x)

    return {(int(r[0][0]), int(r[0][1])): np.array(r[0][2:]) for r in blocks.mapInArrow(run, "found array<double>").collect()}


def _summed(blocks: DataFrame, width: int, sets: list[np.ndarray], of_row) -> np.ndarray:
    """Sum over the rows of what ``of_row`` makes of the distances to each set of centres."""
    def run(batches):
        total = None
        for x in pieces(batches, width):
            norms = (x * x).sum(1)
            part = np.concatenate([of_row(squared(x, norms, c)) for c in sets])
            total = part if total is None else total + part
        if total is not None:
            yield _flat("found", total.tolist())

    return sum(np.array(r[0]) for r in blocks.mapInArrow(run, "found array<double>").collect())


def _chosen(blocks: DataFrame, width: int, sets: list[np.ndarray], chances: list[list[tuple[int, float]]], seeds: list[int], which: list[int], step: int):
    """(start, row) of the rows that each start draws with a chance that grows with their cost; starts of one seed use the same numbers."""
    def run(batches):
        p = TaskContext.get().partitionId()
        numbers = Uniforms([s ^ (step << 16) ^ p for s in seeds])
        for x in pieces(batches, width):
            norms, drawn = (x * x).sum(1), numbers.take(len(x))
            for centres, starts, seed in zip(sets, chances, which, strict=True):
                cost = squared(x, norms, centres).min(0)
                for start, factor in starts:
                    for i in np.flatnonzero(drawn[seed] < factor * cost):
                        yield _flat("found", [float(start), *x[i]])

    return [(int(r[0][0]), np.array(r[0][1:])) for r in blocks.mapInArrow(run, "found array<double>").collect()]


def _first_of_each(rows: list[np.ndarray]) -> np.ndarray:
    return np.array(list({tuple((r + 0.0).tolist()): r for r in reversed(rows)}.values())[::-1])


def local_centres(points: np.ndarray, weights: np.ndarray, k: int, turns: int = 30) -> np.ndarray:
    """k-means++ over weighted points, as Spark's LocalKMeans with seed 0."""
    rand, norms = JavaRandom(0), (points * points).sum(1)

    def picked(shares: np.ndarray) -> int:
        r, at, held = rand.double() * shares.sum(), 0, 0.0
        while at < len(shares) and held < r:
            held += shares[at]
            at += 1
        return max(at - 1, 0)

    centres = [points[picked(weights)]]
    cost = squared(points, norms, centres[0][None])[0]
    for _ in range(1, k):
        centres.append(points[picked(weights * cost)])
        cost = np.minimum(cost, squared(points, norms, centres[-1][None])[0])
    centres, before = np.array(centres), None
    for _ in range(turns):
        nearest = squared(points, norms, centres).argmin(0)
        sums, counts = np.zeros_like(centres), np.zeros(k)
        np.add.at(sums, nearest, weights[:, None] * points)
        np.add.at(counts, nearest, weights)
        centres = np.array([sums[j] / counts[j] if counts[j] else points[rand.below(len(points))] for j in range(k)])
        if before is not None and (nearest == before).all():
            break
        before = nearest
    return centres


def first_centres(blocks: DataFrame, width: int, turns: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """The first centres of each start (k, seed); fewer than k where rows are alike."""
    sizes = _sizes(blocks, width)
    if not sum(sizes):
        raise ValueError("no rows to draw centres from")
    seeds = list(dict.fromkeys(seed for _, seed in turns))
    drawn = [ShiftRandom(seed).integer() for seed in seeds]
    at = [sampled_row(sizes, s) for s in drawn]
    rows = _rows_at(blocks, width, set(at))
    which = [seeds.index(seed) for _, seed in turns]
    held = [[rows[at[w]]] for w in which]
    for step in range(STEPS):
        # in the first step all starts of a seed have the same centre
        shared = which if step == 0 else list(range(len(turns)))
        keys = list(dict.fromkeys(shared))
        sets = [np.array(held[shared.index(key)]) for key in keys]
        totals = _summed(blocks, width, sets, lambda apart: apart.min(0).sum(keepdims=True))
        starts = [[(i, 2.0 * turns[i][0] / total) for i, of in enumerate(shared) if of == key] if total > 0 else [] for key, total in zip(keys, totals, strict=True)]
        for start, row in _chosen(blocks, width, sets, starts, drawn, [which[shared.index(key)] for key in keys], step):
            held[start].append(row)
    points = [_first_of_each(h) for h in held]
    large = [i for i, p in enumerate(points) if len(p) > turns[i][0]]
    if large:
        counts = _summed(blocks, width, [points[i] for i in large], lambda apart: np.bincount(apart.argmin(0), minlength=len(apart)).astype(float))
        ends = np.cumsum([len(points[i]) for i in large])
        for i, weights in zip(large, np.split(counts, ends[:-1]), strict=True):
            points[i] = local_centres(points[i], weights, turns[i][0])
    return points
