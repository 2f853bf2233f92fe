"""Spark ML jobs: regression, classification, clustering, forecasting, attribution."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.constants import (
    CLUSTER_COUNTS, CLUSTER_FEATURES, CLUSTER_RESTARTS, FEATURES, FOREST_TREES, KMEANS_ITERATIONS, SEED, SEQUENCE_CHANNELS,
)
from flowgauge.functions.fields import sample_order
from flowgauge.operators import attribution, starts
from flowgauge.operators.features import standardize, unstandardize
from flowgauge.operators.sequences import lookback_windows, previous_value, row_positions
from flowgauge.session import work_path
from flowgauge.sources.tables import load_model, save_model

FOREST_DEPTH = 10
ROWS_A_TASK = 2_000_000   # cached rows of one task in a fit
ROWS_A_PASS = 100_000     # rows that one task of a cheap pass is worth
SMALL_FIT = 2_000_000     # rows up to which several forests, or the nodes of all rows, are in memory at once
VOLUME, CLASS, PROBABILITY = "predicted_volume", "predicted_class", "congestion_probability"


def before(split: str) -> Column:
    return F.col("date_time") < F.lit(split).cast("timestamp")


def time_split(df: DataFrame, split: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): rows before the split date, rows from it on."""
    return df.where(before(split)), df.where(~before(split))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def _fitted(stages: list, train: DataFrame) -> PipelineModel:
    """A copy without the training summary, whose session reference can make the model unserialisable."""
    return Pipeline(stages=stages).fit(train).copy()


def _forest(rows: int, **extra) -> dict:
    # large node groups per pass: fewer scans of the training data at every tree level
    depth = extra.pop("depth", FOREST_DEPTH)
    return dict(
        numTrees=extra.pop("trees", FOREST_TREES), maxDepth=depth, maxBins=extra.pop("bins", 32), seed=SEED,
        # deep trees and small tables: each row remembers its node instead of walking down from the root at every level
        maxMemoryInMB=512, cacheNodeIds=depth > FOREST_DEPTH or rows <= SMALL_FIT, checkpointInterval=10, **extra,
    )


def fit_tasks(spark: SparkSession, n: int) -> int:
    """Tasks of one pass of a fit over ``n`` rows: one a core, more only where a task would hold over ROWS_A_TASK rows.

    Every task of a forest sends the whole statistics of all nodes at work, so each further task costs as much as the nodes do, however few
    rows it has.
    """
    return max(spark.sparkContext.defaultParallelism, -(-n // ROWS_A_TASK))


def alike_together(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows of each task in the order of these columns: alike rows go the same ways through all trees, whose nodes then stay in the cache."""
    return rows.sortWithinPartitions(*order)


def coarse_first(train: DataFrame, features: Sequence[str]) -> tuple[int, list[str]]:
    """(number of rows, features from few to many distinct values), one pass."""
    found = train.agg(F.count(F.lit(1)), *[F.approx_count_distinct(c) for c in features]).first()
    return found[0], [c for _, c in sorted(zip(found[1:], features))]


def spread(train: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The ``n`` training rows dealt out to ``fit_tasks`` tasks, in whole rounds of the cores, whatever files they came in.

    Rows that agree in ``order`` stand together. Lineage of deep trees is cut in the shared folder.
    """
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "node_ids"))
    keys = [c for c in ("series_id", "date_time") if c in train.columns]
    cores = spark.sparkContext.defaultParallelism
    dealt = train.repartition(-(-fit_tasks(spark, n) // cores) * cores, *keys)
    return alike_together(dealt, [*order, *keys]) if order else dealt


def dealt_out(rows: DataFrame) -> DataFrame:
    """Rows for a forest to score, in two tasks a core, alike ones together.

    Hundreds of trees read a row far longer than it takes to move, and a stored month, one file, would be a single task.
    """
    keys = [c for c in ("series_id", "date_time") if c in rows.columns]
    dealt = rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, *keys)
    return alike_together(dealt, [c for c in reversed(FEATURES) if c in rows.columns])  # flags first, measured values last


def forest_limits(model: PipelineModel) -> dict[str, int]:
    """Which limit a fitted forest has met: trees, nodes, deepest tree, the depth allowed and the trees that reached it."""
    forest = model.stages[-1]
    depths, allowed = [tree.depth for tree in forest.trees], forest.getOrDefault("maxDepth")
    return {"trees": len(depths), "nodes": forest.totalNumNodes, "depth_reached": max(depths), "depth_allowed": allowed, "trees_cut": sum(d >= allowed for d in depths)}


def fit_linear(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "traffic_volume") -> PipelineModel:
    """Least squares by the direct solver: one pass over the rows.

    Constant columns are dropped and a tiny penalty picks one of the equally good solutions of the
    collinear weather columns; otherwise the solver would fall back to an iterative one.
    """
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="all_features"),
        VarianceThresholdSelector(featuresCol="all_features", outputCol="features", varianceThreshold=0.0),
        LinearRegression(labelCol=label, predictionCol=VOLUME, solver="normal", regParam=1e-6),
    ]
    return Pipeline(stages=stages).fit(train)


def fit_forest_regressor(train: DataFrame, features: Sequence[str] = FEATURES, **params) -> PipelineModel:
    n, order = coarse_first(train, features)
    stage = RandomForestRegressor(
        labelCol="traffic_volume", predictionCol=VOLUME, featureSubsetStrategy="all", **_forest(n, **params)
    )
    return Pipeline(stages=[_assembler(features), stage]).fit(spread(train, n, order))


def fit_logistic(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "congestion") -> PipelineModel:
    """Ridge penalty 1/n on standardised inputs: the usual unit-strength penalty on summed loss."""
    stage = LogisticRegression(
        labelCol=label, predictionCol=CLASS, probabilityCol="_probability", rawPredictionCol="_raw",
        regParam=1.0 / max(train.count(), 1), elasticNetParam=0.0, standardization=True, maxIter=1000,
    )
    model = Pipeline(stages=[_assembler(features), stage]).fit(train)
    # unlike a forest, this model keeps its summary in a copy; a stored one has none
    path = work_path(train.sparkSession, "fits", model.uid)
    save_model(model, path)
    return load_model(path)


def fit_forest_classifier(
    train: DataFrame, features: Sequence[str] = FEATURES, label: str = "congestion",
    weight: str | None = None, **params,
) -> PipelineModel:
    extra = {} if weight is None else {"weightCol": weight}
    n, order = coarse_first(train, features)
    stage = RandomForestClassifier(
        labelCol=label, predictionCol=CLASS, probabilityCol="_probability", rawPredictionCol="_raw",
        **extra, **_forest(n, **params),
    )
    return _fitted([_assembler(features), stage], spread(train, n, order))


def balanced_weights(train: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = n / (2 * rows of the class), from the training rows only."""
    y = F.col(label) == 1
    sizes = train.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")).alias("s")
    ).scalar()
    size = F.when(y, sizes["pos"]).otherwise(sizes["neg"])
    return train.withColumn("weight", sizes["n"] / (F.lit(2.0) * size))


def fit_balanced_classifier(train: DataFrame, label: str = "high_risk", **params) -> PipelineModel:
    return fit_forest_classifier(balanced_weights(train, label), label=label, weight="weight", **params)


def predict_volume(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features", "all_features")


def predict_class(model: PipelineModel, df: DataFrame) -> DataFrame:
    scored = model.transform(df).withColumn(PROBABILITY, vector_to_array("_probability")[1])
    return scored.drop("features", "_probability", "_raw")


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance) of a fitted forest."""
    names, forest = model.stages[0].getInputCols(), model.stages[-1]
    rows = [(n, float(v)) for n, v in zip(names, forest.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(importance: DataFrame, n: int = 5, by: str = "importance") -> DataFrame:
    return importance.orderBy(F.desc(by), "feature").limit(n)


# --- clustering -------------------------------------------------------------------------------

def cluster_input(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """Scaled feature vectors next to the untouched columns."""
    scaled = [f"_z_{c}" for c in features]
    copies = df.withColumns({z: F.col(c).cast("double") for z, c in zip(scaled, features)})
    return _assembler(scaled).transform(standardize(copies, scaled)).drop(*scaled)


def _packed(vectors: DataFrame) -> DataFrame:
    """The vectors as blocks of some thousand rows: a pass of many starts reads them as matrices."""
    def pack(batches):
        for batch in filter(len, batches):
            yield pa.record_batch([pa.array([batch.column(0).flatten().to_numpy().tobytes()], pa.binary())], names=["block"])

    return vectors.select(vector_to_array("features").alias("x")).mapInArrow(pack, "block binary")


def _assigned(blocks: DataFrame, live: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One pass for many starts. Per array (start, centre, dimension): sums and counts of the rows nearest to each centre, and the cost a start.

    Centres that are NaN stand for none.
    """
    def step(batches):
        found = [[np.zeros(c.shape), np.zeros(c.shape[:2]), np.zeros(len(c))] for c in live]
        # one product for all centres; those of a k lie centre by centre, so that each pass over the starts is one array
        width, far = live[0].shape[2], [np.where(np.isnan(c).any(2), np.inf, (c * c).sum(2)).T[:, :, None] for c in live]
        centres = np.concatenate([-2 * np.nan_to_num(c).transpose(1, 0, 2).reshape(-1, width) for c in live])
        ends = np.cumsum([c.shape[0] * c.shape[1] for c in live])
        for x in starts.pieces(batches, width):
            norms, counted = (x * x).sum(1), np.concatenate([x, np.ones((len(x), 1))], axis=1)
            for c, apart, away, (sums, counts, cost) in zip(live, np.split(centres @ x.T, ends[:-1]), far, found):
                apart = apart.reshape(c.shape[1], len(c), len(x)) + away
                least = apart.min(0)
                cost += np.maximum(least + norms, 0).sum(1)
                free, mine = np.ones(least.shape, bool), np.empty(apart.shape)
                for j in range(c.shape[1]):  # the first of those that tie
                    nearest = (apart[j] == least) & free
                    free &= ~nearest
                    mine[j] = nearest
                total = (mine.reshape(-1, len(x)) @ counted).reshape(c.shape[1], len(c), -1).transpose(1, 0, 2)
                sums += total[:, :, :-1]
                counts += total[:, :, -1]
        flat = np.concatenate([part.ravel() for parts in found for part in parts])
        yield pa.record_batch([pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["flat"])

    total, out, at = sum(np.array(r["flat"]) for r in blocks.mapInArrow(step, "flat array<double>").collect()), [], 0  # a row a task
    for c in live:
        shapes, parts = (c.shape, c.shape[:2], c.shape[:1]), []
        for shape in shapes:
            parts.append(total[at:at + int(np.prod(shape))].reshape(shape))
            at += int(np.prod(shape))
        out.append(tuple(parts))
    return out


def _costs(blocks: DataFrame, firsts: list[np.ndarray], tol: float) -> list[np.ndarray]:
    """Training cost of every start, all of them iterated in the same passes until their centres rest."""
    centres, costs = [c.copy() for c in firsts], [np.full(len(c), np.inf) for c in firsts]
    moving = [np.arange(len(c)) for c in firsts]
    for _ in range(KMEANS_ITERATIONS):
        now = [i for i, m in enumerate(moving) if len(m)]
        if not now:
            break
        for i, (sums, counts, cost) in zip(now, _assigned(blocks, [centres[i][moving[i]] for i in now])):
            old, full = centres[i][moving[i]], counts[:, :, None] > 0
            new = np.where(full, sums / np.where(full, counts[:, :, None], 1), old)
            centres[i][moving[i]], costs[i][moving[i]] = new, cost
            moving[i] = moving[i][np.nanmax(((new - old) ** 2).sum(2), axis=1) > tol ** 2]
    return costs


def fit_kmeans_counts(
    vectors: DataFrame, counts: Sequence[int], restarts: int = CLUSTER_RESTARTS, seed: int = SEED, parallelism: int = CLUSTER_RESTARTS
) -> dict[int, KMeansModel]:
    """For each k the best of several starts by training cost.

    The first centres are those that Spark would draw for each start. The starts of all k go through the rows in the same passes, for the draws
    and after them, and Spark fits the one of least cost again for the model. The caller keeps the vectors cached.
    """
    session = inheritable_thread_target(vectors.sparkSession)

    def fit(k: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + best[k], predictionCol="cluster", maxIter=KMEANS_ITERATIONS).fit(vectors)

    counts, best = list(dict.fromkeys(counts)), {k: 0 for k in counts}
    if restarts > 1:
        turns = [(k, seed + i) for k in counts for i in range(restarts)]
        blocks = _packed(vectors).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            drawn = starts.first_centres(blocks, vectors.first()[0].size, turns)
            # fewer than k where rows are alike
            padded = [np.pad(c, ((0, k - len(c)), (0, 0)), constant_values=np.nan) for c, (k, _) in zip(drawn, turns)]
            firsts = [np.stack([c for c, (of, _) in zip(padded, turns) if of == k]) for k in counts]
            best = {k: int(c.argmin()) for k, c in zip(counts, _costs(blocks, firsts, KMeans().getTol()))}
        finally:
            blocks.unpersist()
    with ThreadPool(parallelism) as pool:
        return dict(zip(counts, pool.map(session(fit), counts)))


def fit_kmeans(
    vectors: DataFrame, k: int, restarts: int = CLUSTER_RESTARTS, seed: int = SEED, parallelism: int = CLUSTER_RESTARTS
) -> KMeansModel:
    """The best of several starts for one k."""
    return fit_kmeans_counts(vectors, [k], restarts, seed, parallelism)[k]


def squared_silhouette(clustered: DataFrame) -> float:
    """Silhouette on squared distances over every row, one pass: the score that scales."""
    return ClusteringEvaluator(predictionCol="cluster", featuresCol="features").evaluate(clustered)


def sample_silhouette(
    clustered: DataFrame, keys: Sequence[str], n: int, seed: int = SEED, blocks: int = 16
) -> DataFrame:
    """Mean Euclidean silhouette of a sample of n rows, for those who ask for one.

    Each of the ``blocks`` tasks receives the n sampled points and scores its own share against
    them, so distances stay inside NumPy and no pair is ever a row.
    """
    sample = clustered.orderBy(sample_order(seed, *[F.col(k) for k in keys]), *keys).limit(n)
    points = sample.select(
        F.pmod(F.xxhash64(*keys), F.lit(blocks)).alias("home"),
        "cluster",
        vector_to_array("features").alias("x"),
    )
    copies = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy())
        labels, own = pdf["cluster"].to_numpy(), (pdf["home"] == pdf["block"]).to_numpy()
        mine, mine_labels = x[own], labels[own]
        names, sizes = np.unique(labels, return_counts=True)
        if len(names) < 2 or not len(mine):
            return pd.DataFrame({"total": [0.0], "n": [int(own.sum())]})
        squared = (mine ** 2).sum(1)[:, None] + (x ** 2).sum(1)[None, :] - 2 * mine @ x.T
        distance = np.sqrt(np.maximum(squared, 0))
        distance[np.arange(len(mine)), np.flatnonzero(own)] = 0.0
        sums = np.stack([distance[:, labels == c].sum(1) for c in names], axis=1)
        at = np.searchsorted(names, mine_labels)
        rows = np.arange(len(mine))
        inside = sums[rows, at] / np.maximum(sizes[at] - 1, 1)
        outside = sums / sizes
        outside[rows, at] = np.inf
        nearest = outside.min(axis=1)
        width = np.maximum(inside, nearest)
        s = np.where((sizes[at] > 1) & (width > 0), (nearest - inside) / np.where(width > 0, width, 1), 0.0)
        return pd.DataFrame({"total": [float(s.sum())], "n": [len(mine)]})

    parts = copies.groupBy("block").applyInPandas(score, "total double, n long")
    return parts.agg((F.try_divide(F.sum("total"), F.sum("n"))).alias("silhouette"), F.sum("n").alias("sampled"))


def select_clusters(
    df: DataFrame, counts: Sequence[int] = CLUSTER_COUNTS, restarts: int = CLUSTER_RESTARTS
) -> tuple[DataFrame, KMeansModel]:
    """(one row per k with its scores, the model of the best k) by the silhouette over all rows. The smaller k wins a tie."""
    n, spark = df.count(), df.sparkSession
    vectors = cluster_input(df).select("features")
    if n > vectors.rdd.getNumPartitions() * ROWS_A_PASS:  # a few large files would be a few tasks
        vectors = vectors.repartition(fit_tasks(spark, n))
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    rows, best = [], None
    try:
        for k, model in fit_kmeans_counts(vectors, counts, restarts).items():
            score = float(squared_silhouette(model.transform(vectors)))
            rows.append((k, score, float(model.summary.trainingCost), [int(s) for s in model.summary.clusterSizes]))
            if best is None or score > best[0]:
                best = (score, model)
    finally:
        vectors.unpersist()
    scores = df.sparkSession.createDataFrame(rows, "k int, silhouette double, cost double, sizes array<long>")
    return scores.withColumn("chosen", F.col("k") == best[1].summary.k), best[1]


def group_sizes(df: DataFrame, key: str = "cluster") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def cluster_profile(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("hours"),
        F.avg("traffic_volume").alias("avg_traffic"),
        F.avg("congestion").alias("pct_congested"),
        F.avg("is_weekend").alias("pct_weekend"),
        F.avg("temp_c").alias("avg_temp_c"),
    )


# --- forecasting ------------------------------------------------------------------------------

def forecast_rows(df: DataFrame, split: str, channels: Sequence[str] = SEQUENCE_CHANNELS) -> DataFrame:
    """Scaled look-back vectors with the scaled next value, scaled on the training period only."""
    keep = df.select("series_id", "date_time", F.col(channels[0]).alias("actual"), *channels)
    train = keep.where(before(split))
    scaled = standardize(
        keep.withColumns({c: F.col(c).cast("double") for c in channels}), channels, fit_on=train
    )
    windows = lookback_windows(scaled, channels)
    return windows.select(
        "series_id", "date_time", "actual", F.col(channels[0]).alias("target"),
        array_to_vector(F.flatten("window")).alias("features"),
    )


def boosted_forecaster(trees: int = 20, depth: int = 4) -> GBTRegressor:
    """Gradient boosting on the look-back: finds what a linear model can't, such as thresholds and hours that differ in kind."""
    return GBTRegressor(labelCol="target", predictionCol="forecast", maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, seed=SEED)


def lag_forecast(df: DataFrame, split: str, nth: int = 1, estimator=None) -> DataFrame:
    """Test rows with ``forecast`` (a model on the look-back, linear by default) and ``persistence`` (previous row).

    All training windows are used; ``nth`` keeps every nth of them on request. Windows are made once: both sides of the split and every pass of
    the fit read them from a stored table.
    """
    made = forecast_rows(df, split)
    path = work_path(df.sparkSession, "windows", uuid.uuid4().hex)
    made.write.parquet(path)
    rows = df.sparkSession.read.schema(made.schema).parquet(path)
    train = rows.where(before(split))
    if nth > 1:
        train = row_positions(train).where(F.col("position") % nth == 0)
    model = (estimator or LinearRegression(labelCol="target", predictionCol="forecast", regParam=0.01)).fit(train)
    scored = model.transform(rows.where(~before(split))).drop("features", "target")
    back = unstandardize(scored, {"forecast": SEQUENCE_CHANNELS[0]}, fit_on=df.where(before(split)))
    previous = previous_value(df.select("series_id", "date_time", "traffic_volume"), "traffic_volume", "persistence")
    return back.join(previous.where(~before(split)).drop("traffic_volume"), ["series_id", "date_time"])


# --- attribution ------------------------------------------------------------------------------

def shapley_attribution(
    model: PipelineModel, rows: DataFrame, background: DataFrame, keys: Sequence[str],
    n: int | None = None, orders: int = 4, seed: int = SEED,
) -> DataFrame:
    """(feature, mean_abs, mean_signed): sampled Shapley values of P(class 1).

    For each row (all, or a sample of ``n``) and each random feature order, features switch one by one from the
    background mean to the row's value; the change of the score is the feature's contribution.
    Orders come in opposite pairs. A forest's trees are walked once a row for all steps; nothing is made of the hybrid rows.
    """
    names = model.stages[0].getInputCols()
    rng = np.random.default_rng(seed)
    drawn = [rng.permutation(len(names)).tolist() for _ in range(orders)]
    drawn += [p[::-1] for p in drawn]

    values = F.array(*[F.col(c).cast("double") for c in names])
    sample = rows if n is None else rows.orderBy(sample_order(seed, *[F.col(k) for k in keys]), *keys).limit(n)
    means = background.agg(*[F.avg(F.col(c).cast("double")) for c in names]).first()
    step = attribution.summed(attribution.trees_of(model.stages[-1]), np.array(means, float), np.array(drawn))
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism  # a stored month, one file, would be a single task
    sums = sample.repartition(tasks, *keys).select(values).mapInArrow(step, "at int, n long, absolute double, signed double")
    labels = F.array(*[F.lit(c) for c in names])
    return sums.groupBy("at").agg(
        (F.sum("absolute") / F.sum("n")).alias("mean_abs"), (F.sum("signed") / F.sum("n")).alias("mean_signed")
    ).select(labels[F.col("at")].alias("feature"), "mean_abs", "mean_signed")
