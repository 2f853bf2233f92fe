"""Contributions of features to a forest's score, read off the trees instead of scoring every hybrid row.

While features switch one by one from a background value to the row's own, a tree's leaf changes only where a node on the way splits
on the feature that switches. So each row walks down a tree once for all steps of all orders: at a node whose split sends both values
the same way nothing happens; otherwise the steps before the switch go one way and the others the other way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import SparkSession

from flowgauge.session import work_path

ROWS_AT_ONCE = 4000


@dataclass
class Tree:
    """Nodes as arrays; a leaf has feature -1 and the share of class 1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray


def trees_of(model: RandomForestClassificationModel) -> list[Tree]:
    """The trees of a fitted forest, from its stored form: asking the model node by node would take a call each."""
    spark = SparkSession.active()
    path = work_path(spark, "forests", uuid.uuid4().hex)
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").selectExpr(
        "treeID", "nodeData.id AS id", "nodeData.leftChild AS left", "nodeData.rightChild AS right", "nodeData.split.featureIndex AS feature",
        "nodeData.split.leftCategoriesOrThreshold AS threshold", "nodeData.split.numCategories AS categories", "nodeData.impurityStats AS stats",
    ).toPandas().sort_values(["treeID", "id"])
    inner = rows["left"] >= 0
    if (rows["categories"][inner] != -1).any():
        raise ValueError("splits on categories are not walked")
    rows["threshold"] = [t[0] if go else 0.0 for t, go in zip(rows["threshold"], inner, strict=True)]
    rows["share"] = [s[1] / total if (total := sum(s)) else 0.0 for s in rows["stats"]]
    rows["feature"] = rows["feature"].where(inner, -1)
    found = []
    for _, nodes in rows.groupby("treeID"):
        if (nodes["id"].to_numpy() != np.arange(len(nodes))).any():
            raise ValueError("nodes of a tree are numbered otherwise than from 0")
        found.append(Tree(nodes["feature"].to_numpy(np.int64), *[nodes[c].to_numpy(t) for c, t in (("threshold", float), ("left", np.int64), ("right", np.int64), ("share", float))]))
    return found


def contributions(trees: list[Tree], x: np.ndarray, background: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """(row, feature): mean over the orders of the change of the forest's share when the feature switches to the row's value."""
    n, width = x.shape
    turns = np.arange(len(orders))
    rank = np.empty((width, len(orders)), np.int8 if width < 127 else np.int32)  # step at which a feature switches, from 1
    rank[orders, turns[:, None]] = np.arange(1, width + 1)
    total = np.zeros(n * width)
    for tree in trees:
        stays_left = background[np.maximum(tree.feature, 0)] <= tree.threshold
        row, node = np.arange(n), np.zeros(n, np.int64)
        # steps lo to hi of each order are at the node; rows share these bounds until one of them parts
        lo, hi, at = np.zeros((1, len(orders)), rank.dtype), np.full((1, len(orders)), width, rank.dtype), np.zeros(n, np.int64)
        while len(row):
            feature = tree.feature[node]
            done = feature < 0
            if done.any():
                first, last, share, mine = lo[at[done]], hi[at[done]], tree.share[node[done]], row[done]
                for bound, sign in ((first - 1, 1.0), (last, -1.0)):
                    i, turn = np.nonzero((first <= last) & (bound >= 0) & (bound < width))
                    place = mine[i] * width + orders[turn, bound[i, turn]]
                    total += np.bincount(place, sign * share[i], n * width)
                row, node, at, feature = row[~done], node[~done], at[~done], feature[~done]
            goes_left, stays = x[row, feature] <= tree.threshold[node], stays_left[node]
            own = np.where(goes_left, tree.left[node], tree.right[node])
            parts = np.flatnonzero(goes_left != stays)
            if len(parts):
                switch = rank[feature[parts]]
                before, after = np.minimum(hi[at[parts]], switch - 1), np.maximum(lo[at[parts]], switch)
                had, has = (lo[at[parts]] <= before).any(1), (after <= hi[at[parts]]).any(1)
                other = np.where(stays[parts], tree.left[node[parts]], tree.right[node[parts]])
                kept = np.ones(len(row), bool)
                kept[parts] = False
                size = len(lo)
                lo, hi = np.concatenate([lo, after[has], lo[at[parts[had]]]]), np.concatenate([hi, hi[at[parts[has]]], before[had]])
                new = size + np.arange(has.sum() + had.sum())
                row = np.concatenate([row[kept], row[parts[has]], row[parts[had]]])
                own = np.concatenate([own[kept], own[parts[has]], other[had]])
                at = np.concatenate([at[kept], new])
            node = own
    return total.reshape(n, width) / (len(trees) * len(orders))


def summed(trees: list[Tree], background: np.ndarray, orders: np.ndarray):
    """For ``mapInArrow`` over rows of one array column: (at, n, absolute, signed), the sums of each feature over some rows."""
    width = orders.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                column = batch.column(0).slice(lo, ROWS_AT_ONCE)
                if column.flatten().null_count:
                    raise ValueError("rows with nulls have no score")
                values = contributions(trees, np.asarray(column.flatten()).reshape(-1, width), background, orders)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, len(values))), pa.array(np.abs(values).sum(0)), pa.array(values.sum(0))],
                    names=["at", "n", "absolute", "signed"])

    return run
