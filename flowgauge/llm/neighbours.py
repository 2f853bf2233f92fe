"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking.

A unit vector, padded to a power of two, goes through a pseudo-rotation: three rounds of random signs and a fast
Hadamard transform. Its hash is the signed axis nearest to the result, so one of 2d values; a table's key
joins ``depth`` such hashes. ``depth`` follows the number of vectors, so that a bucket holds about the same number of rows at every
size. Each query probes, in every table, the buckets of highest summed coordinates (multiprobe). The
candidates' cosines are computed in double precision from the original vectors.

**Plan.** Equal vectors are first reduced to one row with its smallest ids, so a vector that a third of all rows share is
one row of one bucket; nothing is lost, because equal vectors tie and the smaller ids win. Buckets are dealt by a
hash of (table, first axis, part) to cells; a bucket's rows are spread over slices by their id where the bucket is large,
and a probe goes to each slice of its bucket, so a hot bucket becomes many tasks of bounded size. No bucket is capped. A query is sent
once to each cell with all that it probes there, and buckets of one first axis, which it often probes together, share cells. A task holds a cell's
vectors while the queries pass by, and returns the k best for each; what cannot be among the k best of all cells goes before the exact
scores. Queries that found fewer than k candidates are searched exactly.

Vectors that are null, zero, empty, or hold null or non-finite components take no part. Ties: smaller vec_id. Rows with equal vec_id are
one another's own row. Null ids take no part. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from flowgauge.llm import topk
from flowgauge.llm.common import stored
from flowgauge.llm.words import mixed

TABLES = 6
PROBES = 24  # to the power of the depth
BUCKET_ROWS = 400
GROUP_ROWS = 20_000
QUERY_ROWS = 2000      # queries of a cell at once
CELLS_A_TASK = 4
PROBE_SUMS = 1 << 21   # summed coordinates at once while queries choose their buckets
CELL_SCORES = 1 << 21  # cosines at once
TIE = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


@lru_cache(maxsize=64)
def signs(seed: int, table: int, level: int, d: int) -> np.ndarray:
    return np.random.default_rng([seed, table, level]).choice([-1.0, 1.0], (3, d))


def rotated(vectors: np.ndarray, seed: int, table: int, level: int) -> np.ndarray:
    d = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), d))
    x[:, :vectors.shape[1]] = vectors
    for s in signs(seed, table, level, d):
        x = hadamard(x * s)
    return x


def _axes(x: np.ndarray) -> np.ndarray:
    """Coordinates along the signed axes: first the positive ones."""
    return np.concatenate([x, -x], axis=1)


def buckets(vectors: np.ndarray, seed: int, table: int, depth: int) -> np.ndarray:
    key = np.zeros(len(vectors), np.int64)
    for level in range(depth):
        axes = _axes(rotated(vectors, seed, table, level))
        key = key * axes.shape[1] + axes.argmax(axis=1)
    return key


def probes(vectors: np.ndarray, seed: int, table: int, depth: int, count: int) -> np.ndarray:
    """The ``count`` buckets of highest summed coordinates for each query, best first; fewer if there are fewer."""
    keys = np.zeros((len(vectors), 1), np.int64)
    total = np.zeros((len(vectors), 1))
    for level in range(depth):
        axes = _axes(rotated(vectors, seed, table, level))
        width = axes.shape[1]
        sums = (total[:, :, None] + axes[:, None, :]).reshape(len(vectors), -1)
        names = (keys[:, :, None] * width + np.arange(width)).reshape(len(vectors), -1)
        best = np.argsort(-sums, axis=1, kind="stable")[:, :count]
        keys, total = np.take_along_axis(names, best, 1), np.take_along_axis(sums, best, 1)
    return keys


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def packed(matrix: np.ndarray) -> pa.Array:
    """The rows as bytes: of float32 where that holds the very numbers, else of float64."""
    with np.errstate(over="ignore"):
        narrow = matrix.astype("<f4")
    exact = (narrow == matrix).all(axis=1)
    return pa.array([a.tobytes() if small else b.tobytes() for small, a, b in zip(exact, narrow, matrix.astype("<f8"), strict=True)], pa.binary())


def unpacked(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<f4" if len(x) == 4 * dimensions else "<f8").astype(float) for x in column.to_pylist()])


@dataclass
class Deal:
    """Where the rows of a bucket are searched: its slice, if it is large, lies in one of the parts of its first axis, and that in a cell."""

    tables: int
    home: int  # buckets of one first axis
    groups: int
    large: tuple[np.ndarray, np.ndarray]  # names of buckets in more than one slice, ascending, and their slices
    wide: tuple[np.ndarray, np.ndarray]  # names of first axes in more than one part, ascending, and their parts

    @staticmethod
    def _looked_up(pairs: tuple[np.ndarray, np.ndarray], names: np.ndarray) -> np.ndarray:
        known, values = pairs
        if not len(known):
            return np.ones(len(names), np.int64)
        at = np.minimum(np.searchsorted(known, names), len(known) - 1)
        return np.where(known[at] == names, values[at], 1)

    def slices(self, tab: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return self._looked_up(self.large, bucket * self.tables + tab)

    def cells(self, tab: np.ndarray, bucket: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, code of the slice of the bucket). Codes that agree by chance only make a candidate more."""
        code = mixed(mixed((bucket * self.tables + tab).astype(np.uint64)) + piece.astype(np.uint64))
        axis = bucket // self.home * self.tables + tab
        part = code % self._looked_up(self.wide, axis).astype(np.uint64)
        return (mixed(mixed(axis.astype(np.uint64)) + part) % np.uint64(self.groups)).astype(np.int32), code.view(np.int64)


ROW = "cell int, is_query boolean, id long, packed binary, codes array<long>"


def _rows(cell, is_query: bool, ids, vectors: pa.Array, first: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    codes = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(codes))
    return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.full(len(cell), is_query)), pa.array(ids), vectors, codes], names=[x.split()[0] for x in ROW.split(", ")])


def _matrices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of up to ``rows`` rows of (id, vector)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            yield np.asarray(part.column(0)), np.asarray(part.column(1).flatten()).reshape(part.num_rows, -1)


def _hashed(lead: DataFrame, tables: int, depth: int, seed: int) -> DataFrame:
    """(class_id, packed, keys): each vector once, with its bucket in every table."""
    def run(batches):
        for ids, vectors in _matrices(batches, 2000):
            units = unit_rows(vectors)
            keys = np.stack([buckets(units, seed, t, depth) for t in range(tables)], axis=1)
            first = np.arange(len(ids) + 1, dtype=np.int32) * tables
            yield pa.RecordBatch.from_arrays([pa.array(ids), packed(vectors), pa.ListArray.from_arrays(pa.array(first), pa.array(keys.ravel()))], names=["class_id", "packed", "keys"])

    return lead.select("class_id", "vector").mapInArrow(run, "class_id long, packed binary, keys array<long>")


def _dealt_index(index: DataFrame, deal: Deal) -> DataFrame:
    """A row for each class and table, in the cell of its bucket."""
    def run(batches):
        for batch in batches:
            bucket = np.asarray(batch.column(2).flatten())
            row = np.repeat(np.arange(batch.num_rows), deal.tables)
            tab = np.tile(np.arange(deal.tables), batch.num_rows)
            ids = np.asarray(batch.column(0))[row]
            piece = mixed(ids.astype(np.uint64)) % deal.slices(tab, bucket).astype(np.uint64)
            cell, code = deal.cells(tab, bucket, piece)
            yield _rows(cell, False, ids, batch.column(1).take(pa.array(row)), np.arange(len(cell) + 1), code)

    return index.mapInArrow(run, ROW)


def _dealt_queries(queries: DataFrame, deal: Deal, dimensions: int, depth: int, seed: int, probe: int) -> DataFrame:
    """A row for each query and cell that holds any of the buckets it probes, with the codes of these."""
    width = width_of(dimensions)
    rows = max(1, PROBE_SUMS // (width * min(probe, width ** (depth - 1))))

    def run(batches):
        for ids, vectors in _matrices(batches, rows):
            units = unit_rows(vectors)
            keys = [probes(units, seed, t, depth, probe) for t in range(deal.tables)]
            bucket = np.concatenate([k.ravel() for k in keys])
            row = np.concatenate([np.repeat(np.arange(len(ids)), k.shape[1]) for k in keys])
            tab = np.concatenate([np.full(k.size, t) for t, k in enumerate(keys)])
            slices = deal.slices(tab, bucket)
            at = np.repeat(np.arange(len(row)), slices)  # a large bucket is visited in all its slices
            piece = np.arange(len(at)) - np.repeat(np.cumsum(slices) - slices, slices)
            cell, code = deal.cells(tab[at], bucket[at], piece)
            order = np.lexsort((cell, row[at]))
            row, cell, code = row[at][order], cell[order], code[order]
            first = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(cell) != 0)))
            for lo in range(0, len(first), 10_000):
                part, end = first[lo:lo + 10_000], np.append(first, len(row))[min(lo + 10_000, len(first))]
                yield _rows(cell[part], True, ids[row[part]], packed(vectors[row[part]]), np.append(part, end) - part[0], code[part[0]:end])

    return queries.select("vec_id", "vector").mapInArrow(run, ROW)


def _gathered(held: list[pa.RecordBatch], dimensions: int):
    """The classes of a cell: their ids; place among these and unit vector of each row, in the order of the codes; the codes and where the rows of each begin."""
    codes = np.concatenate([np.asarray(b.column(4).flatten()) for b in held])
    order = np.argsort(codes, kind="stable")
    ids = np.concatenate([np.asarray(b.column(2)) for b in held])[order]
    vectors = unit_rows(np.concatenate([unpacked(b.column(3), dimensions) for b in held]))[order]
    names, first = np.unique(codes[order], return_index=True)
    known, place = np.unique(ids, return_inverse=True)
    return known, place, vectors, names, np.append(first, len(ids))


def _best(cell, asked: pa.RecordBatch, dimensions: int, k: int) -> pa.RecordBatch | None:
    """The k nearest of each query among the rows of its buckets in the cell."""
    known, place, vectors, names, first = cell
    codes, owner = np.asarray(asked.column(4).flatten()), np.repeat(np.arange(asked.num_rows), np.asarray(asked.column(4).value_lengths()))
    at = np.minimum(np.searchsorted(names, codes), len(names) - 1)
    held = np.flatnonzero(names[at] == codes)
    if not len(held):
        return None
    held = held[np.argsort(at[held], kind="stable")]
    units, out = unit_rows(unpacked(asked.column(3), dimensions)), []
    for rows in np.split(held, np.flatnonzero(np.diff(at[held])) + 1):
        lo, hi = first[at[rows[0]]], first[at[rows[0]] + 1]
        # all that tie with the last place within the digits of a product, so that the exact score settles them;
        # one place more than k, as the query's own class may hold one
        most, step = min(k + 1, hi - lo), max(1, CELL_SCORES // (hi - lo))
        for i in range(0, len(rows), step):
            q = owner[rows[i:i + step]]
            cosine = units[q] @ vectors[lo:hi].T
            last = -np.partition(-cosine, most - 1, axis=1)[:, most - 1:most]
            row, column = np.nonzero(cosine >= last - TIE)
            out.append((q[row] * len(known) + place[column + lo], cosine[row, column]))
    both, near = (np.concatenate(x) for x in zip(*out, strict=True))
    both, once = np.unique(both, return_index=True)
    q, found = np.divmod(both, len(known))
    order = np.lexsort((-near[once], q))
    q, found, near = q[order], known[found[order]], near[once][order]
    begin, end = np.searchsorted(q, q), np.searchsorted(q, q, side="right")
    keep = near >= near[np.minimum(begin + k, end - 1)] - TIE
    return pa.RecordBatch.from_arrays([asked.column(2).take(pa.array(q[keep])), pa.array(found[keep]), pa.array(near[keep])], names=["query_id", "class_id", "near"])


def _cell(k: int, dimensions: int):
    """Cell after cell: the classes come first and are held, queries pass by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, ready = None, [], None
        for batch in batches:
            at, is_query = np.asarray(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (is_query[1:] != is_query[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if hi == lo:
                    continue
                if at[lo] != cell:
                    cell, held, ready = at[lo], [], None
                part = batch.slice(lo, hi - lo)
                if not is_query[lo]:
                    held.append(part)
                elif held or ready:
                    if ready is None:
                        ready, held = _gathered(held, dimensions), []
                    for i in range(0, part.num_rows, QUERY_ROWS):
                        found = _best(ready, part.slice(i, QUERY_ROWS), dimensions, k)
                        if found is not None:
                            yield found

    return run


def cosine(a: str, b: str):
    """Cosine of two array columns in double precision."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    x, y = F.col(a), F.col(b)
    return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def width_of(dimensions: int) -> int:
    """Values of one hash."""
    return 2 * (1 << max(1, (dimensions - 1).bit_length()))


def depth_for(count: int, dimensions: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return max(1, round(np.log(max(count / bucket_rows, 1)) / np.log(width_of(dimensions))))


def _dealing(index: DataFrame, count: int, tables: int, home: int) -> Deal:
    """A large bucket is dealt in slices, a first axis of many rows in parts; only these are listed, fewer than a row for GROUP_ROWS // 4 rows."""
    keys = index.select(F.posexplode("keys").alias("tab", "bucket")).groupBy("tab", "bucket").agg(F.count("*").alias("n"))
    named = lambda c: (c * tables + F.col("tab")).alias("name")

    def listed(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
        found = sorted((r[0], -(-r[1] // size)) for r in rows.where(F.col("n") > size).collect())
        return np.array([x for x, _ in found], np.int64), np.array([x for _, x in found], np.int64)

    large = listed(keys.select(named(F.col("bucket")), "n"), GROUP_ROWS // 4)
    wide = listed(keys.groupBy(named(F.expr(f"bucket DIV {home}"))).agg(F.sum("n").alias("n")), GROUP_ROWS)
    return Deal(tables, home, max(8, -(-count * tables // GROUP_ROWS)), large, wide)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, tables: int = TABLES, probe: int = PROBES, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest cosines found; both sides are (vec_id, vector array<double>)."""
    nonzero = F.exists("vector", lambda x: x != 0)
    vectors, queries = stored(vectors.where(nonzero), "ann-vectors"), stored(queries.where(nonzero).dropDuplicates(["vec_id"]), "ann-queries")
    # equal vectors are one class, numbered in its stored table; its k + 1 smallest ids are all that can be in a result
    digest = F.sha2(F.to_json(F.struct("vector")), 256).alias("class_key")
    keyed = vectors.select("vec_id", "vector", digest)
    lead = keyed.groupBy("class_key").agg(F.first("vector").alias("vector")).withColumn("class_id", F.monotonically_increasing_id())
    lead = stored(lead.select("class_key", "class_id", "vector"), "ann-classes")
    ranked = keyed.select("class_key", "vec_id").distinct().withColumn("place", F.row_number().over(W.partitionBy("class_key").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    members = ranked.join(lead.select("class_key", "class_id"), "class_key").select("class_id", "vec_id")
    count = lead.count()
    if not count:
        return spark_empty(vectors)
    dimensions = len(lead.select("vector").first()[0])
    depth = depth_for(count, dimensions)
    index = stored(_hashed(lead, tables, depth, seed), "ann-index")
    deal = _dealing(index, count, tables, width_of(dimensions) ** (depth - 1))
    both = _dealt_index(index, deal).unionByName(_dealt_queries(queries, deal, dimensions, depth, seed, probe**depth))
    both = both.repartition(max(8, -(-deal.groups // CELLS_A_TASK)), "cell").sortWithinPartitions("cell", "is_query")
    found = both.mapInArrow(_cell(k, dimensions), "query_id long, class_id long, near double")
    # a class is found once a table at most, so these places hold the k + 1 nearest classes; no other can be in the result
    of_query = W.partitionBy("query_id")
    found = found.withColumn("place", F.row_number().over(of_query.orderBy(F.desc("near"))))
    least = F.min(F.when(F.col("place") <= tables * (k + 1), F.col("near"))).over(of_query)
    found = found.withColumn("least", least).where(F.col("near") >= F.col("least") - TIE).select("query_id", "class_id").distinct()
    # exact scores on the original vectors, then ids
    source = lead.select("class_id", F.col("vector").alias("candidate"))
    pairs = found.join(source, "class_id").join(queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query")), "query_id")
    scored = pairs.select("query_id", "class_id", cosine("query", "candidate").alias("score"))
    # an id with several vectors counts once, with the best of their scores
    named = scored.join(members, "class_id").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    result = stored(named.withColumn("rank", place).where(F.col("rank") <= k), "ann-result")
    # queries with too few candidates are compared with every vector
    enough = result.groupBy("query_id").count().where(F.col("count") >= k)
    short = queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti")
    columns = ["query_id", "rank", "vec_id", "score"]
    if short.isEmpty():
        return result.select(*columns)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))
    unit = lambda df: df.select("vec_id", F.transform("vector", lambda v: v / norm).alias("vector"))
    exact = topk.top_k(unit(vectors), unit(short), k)
    done = result.join(short.select(F.col("vec_id").alias("short_id")), F.col("query_id") == F.col("short_id"), "left_anti")
    return done.select(*columns).unionByName(exact.select(*columns))


def spark_empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
