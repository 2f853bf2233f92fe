"""Exact top-k by integer inner product: blocks of vectors are visited in the order of their bounds, until none can help.

Vectors lie in blocks, ranges of the ids of a shard. A block keeps its rows as one matrix (its forward index) and, for each
dimension, the largest and smallest value. A query's bound for a block is the sum over dimensions of its component
times the block's maximum (minimum, where the component is negative). Blocks are visited from the highest bound down;
a query stops as soon as the bound falls below its k-th best score. At equal bound it goes on, because a
smaller id may win the tie, so the result is exact.

**Plan.** Equal rows are first reduced to one. Vectors are dealt by a hash of id and components into shards of a bounded number of rows, queries into groups of a
bounded number of rows; each pair of shard and group is one task of fixed memory, and returns k rows for each query. These
partial results are ranked by one window over the queries. Shards and groups are counted from the table's
rows, so the work is the stated query set against all rows, in blocks.

Components x become floor(256 * x) in double. Vectors that are null, empty or hold null or non-finite components take no part, nor
do vectors whose length differs from that of most vectors' (counted; ties: the longer). Fewer candidates than k: all. Ties: smaller vec_id.
Rows with equal vec_id are one another's "own row" and never candidates of each other; as candidates they are one, with the best
of their scores, so k different ids are returned wherever there are so many. A repeated query row gives its results once. Null vec_ids take no part. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from flowgauge.llm.common import stored

BLOCK_ROWS = 256
SHARD_ROWS = 8192
GROUP_ROWS = 2048


def usable(vectors: DataFrame, column: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part."""
    doubles = F.transform(F.col(column), lambda x: x.cast("double"))
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(ident).cast("long").alias("vec_id"), doubles.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().agg(F.max(F.struct("count", "size"))["size"]).first()[0]
    return rows.where(F.size("vector") == F.lit(sizes)) if sizes else rows


def quantized(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("vector", F.transform("vector", lambda x: F.floor(x * 256.0).cast("double")))


def _merge(best_s, best_i, rows, scores, ids, k):
    """Keep the k best ids (score, then smaller id) of the present best and new candidates, for the given query rows."""
    s = np.concatenate([best_s[rows], scores], axis=1)
    i = np.concatenate([best_i[rows], np.broadcast_to(ids, scores.shape)], axis=1)
    if np.isin(ids, best_i[rows]).any():  # an id that already has a place keeps its best score only
        order = np.lexsort((-s, i), axis=1)
        s, i = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        s[:, 1:][i[:, 1:] == i[:, :-1]] = -np.inf
    order = np.lexsort((i, -s), axis=1)[:, :k]
    best_s[rows], best_i[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def search(query_ids, queries, ids, matrix, k: int, block_rows: int = BLOCK_ROWS) -> pd.DataFrame:
    """The k best of these vectors for each of these queries, block by block in the order of the bounds."""
    order = np.argsort(ids, kind="stable")
    ids, matrix = ids[order], matrix[order]
    cuts = list(range(0, len(ids), block_rows))
    top = np.stack([matrix[c:c + block_rows].max(axis=0) for c in cuts])
    low = np.stack([matrix[c:c + block_rows].min(axis=0) for c in cuts])
    bounds = np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ low.T
    visits = np.argsort(-bounds, axis=1, kind="stable")
    best_s = np.full((len(queries), k), -np.inf)
    best_i = np.full((len(queries), k), np.iinfo(np.int64).max)
    active = np.arange(len(queries))
    for turn in range(len(cuts)):
        block = visits[active, turn]
        useful = bounds[active, block] >= best_s[active, k - 1]
        active, block = active[useful], block[useful]
        if not len(active):
            break
        for b in np.unique(block):
            rows = active[block == b]
            lo = cuts[b]
            own = ids[lo:lo + block_rows]
            scores = queries[rows] @ matrix[lo:lo + block_rows].T
            scores[query_ids[rows][:, None] == own[None, :]] = -np.inf
            begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            if len(begins) < len(own):  # copies of an id stand side by side: the best of them counts
                scores, own = np.maximum.reduceat(scores, begins, axis=1), own[begins]
            if scores.shape[1] > 4 * k:  # only those that reach the block's k-th score can enter
                kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
                keep = np.flatnonzero(((scores >= kth) & (scores > -np.inf) & (scores >= best_s[rows, k - 1:k])).any(axis=0))
                scores, own = scores[:, keep], own[keep]
            _merge(best_s, best_i, rows, scores, own, k)
    found = np.isfinite(best_s)
    rank = np.broadcast_to(query_ids[:, None], best_s.shape)
    return pd.DataFrame({"query_id": rank[found], "vec_id": best_i[found], "score": best_s[found]})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products; both sides are (vec_id, vector array<double>)."""
    vectors, queries = stored(vectors.select("vec_id", "vector").distinct(), "topk-vectors"), stored(queries.dropDuplicates(["vec_id"]), "topk-queries")
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    groups = max(1, -(-queries.count() // GROUP_ROWS))
    spread = F.struct(F.lit(False).alias("is_query"), "vec_id", "vector")
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    left = vectors.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), spread.alias("row"))
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int")
    right = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), group.alias("part"),
        F.struct(F.lit(True).alias("is_query"), "vec_id", "vector").alias("row"))
    both = left.select("shard", "part", "row.*").unionByName(right.select("shard", "part", "row.*"))

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        is_query = pdf["is_query"].to_numpy(bool)
        out = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if is_query.any() and not is_query.all():
            ids, matrix = pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["vector"].to_numpy()).astype(float)
            out = search(ids[is_query], matrix[is_query], ids[~is_query], matrix[~is_query], k)
        return out

    found = both.groupBy("shard", "part").applyInPandas(cell, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    # equal ids are one row's copies, also in several shards: only the best of them counts
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
