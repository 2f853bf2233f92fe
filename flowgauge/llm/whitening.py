"""Embedding whitening: exact distributed covariance, its eigenvectors in float32, corrected in higher precision.

**Integers.** A vector with a null or non-finite entry is dropped; of the others each entry c becomes x = floor(1024 c) + 100000.
Sums S and centred products are exact: rows are centred by the rounded mean (an integer), products add up as integers, and
the covariance V = (n sum(d d') - D D') / n**2 with D = S - n mean is rounded once, to extended precision.

**Eigenvectors.** ``numpy.linalg.eigh`` in float32 gives a first approximation X. Each Ogita-Aishima step then uses only matrix
products: R = I - X'X, S = X'VX, eigenvalue i = S_ii / (1 - R_ii), E_ij = (S_ij + e_j R_ij) / (e_j - e_i), X += X E. Pairs of
eigenvalues closer than the step can tell apart take R_ij / 2, which keeps them orthonormal. The error squares at each
step; steps run in float64 until it stands still, then in ``numpy.longdouble``. Eigenvalues that stay together are a cluster:
its small matrix X_k'(V - mu I)X_k, shifted and scaled so that differences inside the cluster count, is solved by itself, X_k
is turned by the solution, and the steps go on. A truly multiple eigenvalue keeps any orthonormal basis of its space.

**Rows.** Four passes read the vectors (sums, products, covariance of the result, result); a task holds one Arrow batch and a
few d x d matrices, the driver d x d numbers. No row meets another in a shuffle: only partial sums do.

Cases: null, NaN or infinite entries drop the vector, so do entries of 2**40 and more in magnitude (x is no exact double there).
Shorter vectors count as padded with zero entries to the longest one, an empty vector as all zeros. Null vec_ids and repeated rows are
rows like others. An empty table gives no rows. Where V has rank below k, components without variance have whitened 0 and
explained 0 and take no part in identity_error; vectors with fewer than k entries have that many components. deviation is null where it
exceeds a long; deviation_wide holds it as decimal(38, 0), null beyond that. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
EXACT_DOUBLE, LONG = 1 << 53, 1 << 63
BATCH = 4096
TURNS = 6
RESULT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_wide decimal(38,0)"


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and v (array of double) of the vectors that take part."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    kept = embeddings.where(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return kept.select("vec_id", F.transform(vector, lambda c: c.cast("double")).alias("v"))


def _integers(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch with their x, padded to ``width`` (0: the longest of the part)."""
    for lo in range(0, batch.num_rows, BATCH):
        part = batch.slice(lo, BATCH)
        column = part.column(part.schema.get_field_index("v"))
        lengths = np.asarray(column.value_lengths())
        x = np.zeros((len(lengths), width or int(lengths.max(initial=0))))
        x[np.arange(x.shape[1]) < lengths[:, None]] = np.asarray(column.flatten())
        yield part, np.floor(SCALE * x).astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Fit:
    """What rows need: n, integer centre and rest sums D, the eigenvectors over sqrt(e) as columns, shares of the trace."""

    n: int
    centre: np.ndarray
    rest: tuple[int, ...]
    turn: np.ndarray
    explained: np.ndarray
    live: np.ndarray


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """n and the sum of x in each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _integers(batch, 0):
                lengths = np.asarray(part.column(part.schema.get_field_index("v")).value_lengths())
                inside = np.arange(x.shape[1]) < lengths[:, None]
                at = np.arange(-1, x.shape[1])
                columns = [pa.array(at, pa.int32()), pa.array(np.append(len(x), inside.sum(axis=0))), pa.array(np.append(0, np.where(inside, x, 0).sum(axis=0)))]
                yield pa.RecordBatch.from_arrays(columns, names=["i", "c", "s"])

    got = rows.mapInArrow(run, "i int, c long, s long").groupBy("i").agg(F.sum("c").alias("c"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["i"]: (int(r["c"]), int(r["s"])) for r in got.collect()}
    n = found.pop(-1, (0, 0))[0]
    return n, [s + (n - c) * SHIFT for _, (c, s) in sorted(found.items())]


def products(d: np.ndarray) -> np.ndarray:
    """d'd as exact integers (object entries where they exceed 64 bits)."""
    most = int(np.abs(d).max(initial=0))
    if most * most * max(1, len(d)) < EXACT_DOUBLE:
        f = d.astype(float)
        return (f.T @ f).astype(np.int64)
    if most * most * len(d) < LONG:
        return d.T @ d
    o = d.astype(object)
    return o.T @ o


def _products(rows: DataFrame, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """Upper triangle of the sum of d d' over all rows."""
    width = len(centre)
    up = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None

        def out(m: np.ndarray) -> pa.RecordBatch:
            values = [str(v) for v in m[up].tolist()]
            return pa.RecordBatch.from_arrays([pa.array(up[0], pa.int32()), pa.array(up[1], pa.int32()), pa.array(values, pa.string())], names=["i", "j", "m"])

        for batch in batches:
            for _, x in _integers(batch, width):
                total = products(x - centre).astype(object) + (0 if total is None else total)
        if total is not None:
            yield out(total)

    got = rows.mapInArrow(run, "i int, j int, m string").groupBy("i", "j").agg(F.sum(F.col("m").cast("decimal(38,0)")).alias("m"))
    return {(r["i"], r["j"]): int(r["m"]) for r in got.collect()}


def extended(top: int, bottom: int) -> np.longdouble:
    """top / bottom, rounded to extended precision."""
    sign, top = (-1, -top) if top < 0 else (1, top)
    shift = max(0, 80 - top.bit_length() + bottom.bit_length())
    q = (top << shift) // bottom
    cut = max(0, q.bit_length() - 80)
    q >>= cut
    value = np.ldexp(np.longdouble(q >> 40), 40) + np.longdouble(q & ((1 << 40) - 1))
    return sign * np.ldexp(value, cut - shift)


def refined(v: np.ndarray, x: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors (columns) and eigenvalues of the symmetric ``v``, from approximations ``x``, in the precision of ``v``."""
    kind, eps = v.dtype, float(np.finfo(v.dtype).eps)
    x = x.astype(kind)
    size = max(float(np.abs(v).sum(axis=1).max(initial=0)), np.finfo(float).tiny)
    eye = np.eye(len(v), dtype=kind)
    before, turns = np.inf, 0
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (v @ x)
        e = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        near = 2 * (float(np.sqrt((off * off).sum())) + size * float(np.sqrt((r * r).sum())))
        gap = e[None, :] - e[:, None]
        close = np.abs(gap) <= near
        step = np.where(close, r / 2, (s + e[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ step
        moved = float(np.abs(step).max(initial=0))
        still, done = moved >= before / 2, moved <= 4 * eps
        if done and turns or still and turns == TURNS:
            break
        if (still or done or close.sum() > len(v) and moved < np.sqrt(eps)) and turns < TURNS:
            x, turns, before = _clusters_solved(v, x, size), turns + 1, np.inf
        else:
            before = moved
    for turn in range(8):  # twice, and on where vectors of the smallest eigenvalues are still apart
        r = eye - x.T @ x
        if turn > 1 and np.abs(r).max(initial=0) <= 4 * len(v) * eps:
            break
        x = x + x @ (r / 2)
    e = np.diag(x.T @ (v @ x)) / (x * x).sum(axis=0)
    order = np.argsort(-e, kind="stable")
    return x[:, order], e[order]


def _clusters_solved(v: np.ndarray, x: np.ndarray, size: float) -> np.ndarray:
    """Turns the vectors of each cluster of eigenvalues by the solution of the cluster's own shifted and scaled matrix."""
    e = np.diag(x.T @ (v @ x)) / (x * x).sum(axis=0)
    order = np.argsort(e, kind="stable")
    cuts = np.flatnonzero(np.diff(e[order]) > 1e-4 * size) + 1
    x = x.copy()
    for at in np.split(order, cuts):
        if len(at) < 2:
            continue
        mid = e[at].mean()
        part = x[:, at].T @ (v @ x[:, at] - mid * x[:, at])
        scale = np.abs(part).max()
        if scale > 0:
            turn = np.linalg.eigh(((part + part.T) / (2 * scale)).astype(float))[1]
            x[:, at] = x[:, at] @ turn.astype(v.dtype)
    return x


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvectors and eigenvalues of ``v`` (extended precision), largest eigenvalue first."""
    scale = float(np.abs(v).max(initial=0)) or 1.0
    w = v / np.longdouble(scale)
    x = np.linalg.eigh(w.astype(np.float32))[1]
    x, _ = refined(w.astype(float), x)
    x, e = refined(w, x)
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(x))] < 0, -1, 1)  # one sign: the largest entry is positive
    return x, e * np.longdouble(scale)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit over all rows of ``usable``; None for an empty table."""
    n, sums = _sums(rows)
    if not n:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = tuple(s - n * int(c) for s, c in zip(sums, centre, strict=True))
    width = len(centre)
    m = _products(rows, centre) if width else {}
    v = np.zeros((width, width), np.longdouble)
    for (i, j), s in m.items():
        v[i, j] = v[j, i] = extended(n * s - rest[i] * rest[j], n * n)
    x, e = eigenvectors(v) if width else (np.zeros((0, 0)), np.zeros(0))
    x, e, trace = x[:, :components], e[:components], np.trace(v)
    live = e > width * np.finfo(float).eps * (e[0] if len(e) else 0)
    root = np.sqrt(np.where(live, e, 1))
    explained = np.where(live, e, 0) / (trace if trace > 0 else 1)
    return Fit(n, centre, rest, np.where(live, x / root, 0).astype(float), explained.astype(float), live)


def _projected(x: np.ndarray, f: Fit) -> np.ndarray:
    """Whitened rows: exact integer differences, minus the part of the mean that is no integer."""
    small = np.array([extended(r, f.n) for r in f.rest], float)
    return ((x - f.centre).astype(float) - small) @ f.turn


def identity_error(rows: DataFrame, f: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    width, live = len(f.centre), np.flatnonzero(f.live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _integers(batch, width):
                w = _projected(x, f)[:, live]
                mean = w.mean(axis=0)
                d = w - mean
                i, j = np.triu_indices(len(live))
                n = np.full(len(i), len(w), float)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, (n, mean[i], mean[j], (d.T @ d)[i, j]))], names=["i", "j", "n", "a", "b", "m"])

    parts = rows.mapInArrow(run, "i int, j int, n double, a double, b double, m double")
    total = F.sum("n")
    value = (F.sum(F.expr("m + n * a * b")) - F.sum(F.expr("n * a")) * F.sum(F.expr("n * b")) / total) / total
    found = parts.groupBy("i", "j").agg(value.alias("c")).select(F.max(F.abs(F.expr("c - IF(i = j, 1, 0)"))).alias("worst")).first()
    return float(found["worst"] or 0.0)


def deviations(x: np.ndarray, f: Fit) -> list[int]:
    """Sum over dimensions of (n x - S)**2, exact."""
    d, rest = x - f.centre, np.array(f.rest, object)
    most = f.n * int(np.abs(d).max(initial=0)) + max(map(abs, f.rest), default=0)
    if most * most * max(1, d.shape[1]) < LONG:
        t = f.n * d - rest.astype(np.int64)
        return (t * t).sum(axis=1).tolist()
    t = f.n * d.astype(object) - rest
    return (t * t).sum(axis=1).tolist()


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_wide."""
    rows = usable(embeddings, vector)
    schema = RESULT.format(id=rows.schema["vec_id"].dataType.simpleString())
    f = fit(rows, components)
    if f is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, f)
    width, count = len(f.centre), f.turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _integers(batch, width):
                size = len(x)
                exact = deviations(x, f)
                wide = [v if v < 10**38 else None for v in exact]
                each = np.repeat(np.arange(size), count)
                columns = [
                    part.column(part.schema.get_field_index("vec_id")).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1), size), pa.int32()),
                    pa.array(np.full(size * count, f.n, np.int64)),
                    pa.array([v if v < LONG else None for v in exact], pa.int64()).take(pa.array(each)),
                    pa.array(_projected(x, f).ravel() + 0.0),
                    pa.array(np.tile(f.explained, size)),
                    pa.array(np.full(size * count, error)),
                    pa.array(wide, pa.decimal128(38, 0)).take(pa.array(each)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide"])

    return rows.mapInArrow(run, schema)
