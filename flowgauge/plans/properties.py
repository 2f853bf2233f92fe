"""What must hold for fitted models whatever they learned, as queries that SQL can check."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowgauge.constants import CLUSTER_COUNTS, FEATURES, FOREST_TREES
from flowgauge.operators import models, scoring
from flowgauge.plans import modelling, operations, prepared
from flowgauge.plans.checks import CLEAN, FEAT, TEST, TRAIN
from flowgauge.plans.modelling import KEYS
from flowgauge.plans.prepared import SPLIT, feature_rows, place, split_rows
from flowgauge.plans.registry import query
from flowgauge.sources import tables

_TEST_ROWS = f"(SELECT count(*) FROM feat WHERE {TEST})"
_TRAIN_ROWS = f"(SELECT count(*) FROM feat WHERE {TRAIN})"


def counted():
    return F.count(F.lit(1))


@query("linear_regression_holds", f"WITH {FEAT} SELECT {_TRAIN_ROWS} AS n, true AS residuals_sum_to_zero, true AS residuals_orthogonal")
def linear_regression_holds(spark, sf_dir):
    """Least squares: residuals of the training rows are orthogonal to every feature (a correlation below 1e-4)."""
    train = models.predict_volume(prepared.model(spark, sf_dir, "linear"), split_rows(spark, sf_dir)[0])
    r = F.col("traffic_volume") - F.col(models.VOLUME)
    x = {c: F.col(c).cast("double") for c in FEATURES}
    off = [F.abs(F.coalesce(F.try_divide(F.sum(r * v), F.sqrt(F.sum(r * r) * F.sum(v * v))), F.lit(0.0))) for v in x.values()]
    sums = train.agg(counted().alias("n"), F.abs(F.try_divide(F.sum(r), F.sum(F.abs(r)))).alias("s"), F.greatest(*off).alias("o"))
    return sums.select("n", (F.col("s") < 1e-6).alias("residuals_sum_to_zero"), (F.col("o") < 1e-4).alias("residuals_orthogonal"))


def _scored(spark, sf_dir, name, side):
    return models.predict_class(prepared.model(spark, sf_dir, name), modelling._to_score(spark, sf_dir, name, side))


@query("logistic_regression_holds", f"WITH {FEAT} SELECT {_TRAIN_ROWS} AS n, true AS calibrated, true AS in_range, true AS class_fits")
def logistic_regression_holds(spark, sf_dir):
    """The intercept is free, so probabilities of the training rows sum to the number of congested ones."""
    p = F.col(models.PROBABILITY)
    return _scored(spark, sf_dir, "logistic", 0).agg(
        counted().alias("n"), (F.abs(F.sum(p) - F.sum("congestion")) < 1e-3 * counted()).alias("calibrated"),
        F.bool_and(p.between(0, 1)).alias("in_range"), F.bool_and((p > 0.5) == (F.col(models.CLASS) == 1)).alias("class_fits"))


@query("rf_regressor_holds", f"WITH {FEAT} SELECT {_TEST_ROWS} AS n, true AS in_training_range, true AS better_than_mean_on_training, {FOREST_TREES} AS trees, true AS says_its_limit")
def rf_regressor_holds(spark, sf_dir):
    model = prepared.model(spark, sf_dir, "forest_regressor")
    train, test = split_rows(spark, sf_dir)
    lowest, highest = (train.agg(f("traffic_volume")).scalar() for f in (F.min, F.max))
    fitted = models.predict_volume(model, models.dealt_out(train))
    error = F.col("traffic_volume") - F.col(models.VOLUME)
    better = fitted.agg(F.avg(error * error) < F.var_pop("traffic_volume")).scalar()
    found = models.forest_limits(model)
    scored = models.predict_volume(model, models.dealt_out(test)).agg(counted().alias("n"), F.bool_and(F.col(models.VOLUME).between(lowest - 1e-6, highest + 1e-6)).alias("in_training_range"))
    return scored.select(
        "n", "in_training_range", better.alias("better_than_mean_on_training"), F.lit(found["trees"]).alias("trees"),
        F.lit(found["depth_reached"] <= found["depth_allowed"] and (found["trees_cut"] > 0) == (found["depth_reached"] == found["depth_allowed"])).alias("says_its_limit"))


_CLASSIFIERS = {"forest_classifier": "congestion", "balanced_classifier": "high_risk"}


@query("rf_classifiers_hold", f"""WITH {FEAT} SELECT model, {_TEST_ROWS} AS n, true AS in_range, true AS class_fits, {FOREST_TREES} AS trees
FROM (VALUES {', '.join(f"('{m}')" for m in _CLASSIFIERS)}) AS m(model)""")
def rf_classifiers_hold(spark, sf_dir):
    prepared.fitted(spark, sf_dir, list(_CLASSIFIERS))
    rows = []
    for name in _CLASSIFIERS:
        p = F.col(models.PROBABILITY)
        fits = (p == 0.5) | ((p > 0.5) == (F.col(models.CLASS) == 1))
        rows.append(_scored(spark, sf_dir, name, 1).agg(counted().alias("n"), F.bool_and(p.between(0, 1)).alias("in_range"), F.bool_and(fits).alias("class_fits")).select(
            F.lit(name).alias("model"), "*", F.lit(models.forest_limits(prepared.model(spark, sf_dir, name))["trees"]).alias("trees")))
    return rows[0].unionAll(rows[1])


DEEP = {"trees": 10, "depth": 30, "bins": 256}


@query("deep_forests", f"""WITH {FEAT} SELECT model, {_TRAIN_ROWS} AS n, {DEEP['trees']} AS trees, {DEEP['depth']} AS depth_allowed, true AS deeper_than_shallow,
true AS fits_training_better FROM (VALUES ('classifier'), ('regressor')) AS m(model)""")
def deep_forests(spark, sf_dir):
    """Forests of ten trees to depth 30 with 256 bins beside ones of depth 10: depth that was reached, and error on the training rows."""
    train = split_rows(spark, sf_dir)[0]
    fits = {"regressor": (models.fit_forest_regressor, lambda m, d: models.predict_volume(m, d), F.abs(F.col("traffic_volume") - F.col(models.VOLUME))),
            "classifier": (models.fit_forest_classifier, lambda m, d: models.predict_class(m, d), F.abs(F.col("congestion") - F.col(models.PROBABILITY)))}

    def build(path):
        for name, (fit, _, _) in fits.items():
            for kind, params in (("deep", DEEP), ("shallow", {"trees": DEEP["trees"]})):
                tables.save_model(fit(train, **params), f"{path}/{name}/{kind}")

    path, rows, dealt = prepared.once(place(spark, sf_dir, "models/deep"), build), [], models.dealt_out(train)
    for name, (_, predict, error) in fits.items():
        deep, shallow = (tables.load_model(f"{path}/{name}/{kind}") for kind in ("deep", "shallow"))
        a, b = models.forest_limits(deep), models.forest_limits(shallow)
        less = predict(deep, dealt).agg(F.avg(error)).first()[0] < predict(shallow, dealt).agg(F.avg(error)).first()[0]
        rows.append((name, a["trees"], a["depth_allowed"], a["depth_reached"] > b["depth_reached"], bool(less)))
    found = spark.createDataFrame(rows, "model string, trees int, depth_allowed int, deeper_than_shallow boolean, fits_training_better boolean")
    return found.withColumn("n", train.agg(counted()).scalar())


@query("importance_holds", f"SELECT {len(FEATURES)} AS features, true AS sums_to_one, true AS none_negative, true AS top_are_largest")
def importance_holds(spark, sf_dir):
    importance = models.feature_importance(spark, prepared.model(spark, sf_dir, "forest_classifier"))
    top = models.top_features(importance)
    rest = importance.join(top.select("feature"), "feature", "left_anti").agg(F.max("importance")).scalar()
    largest = top.agg((F.count(F.lit(1)) == 5) & (F.min("importance") >= rest)).scalar()
    return importance.agg(counted().alias("features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"), (F.min("importance") >= 0).alias("none_negative")).select(
        "*", largest.alias("top_are_largest"))


@query("clusters_hold", f"""WITH {FEAT} SELECT (SELECT count(*) FROM feat) AS n, {len(CLUSTER_COUNTS)} AS counts_tried, true AS sizes_sum, true AS chosen_is_best,
true AS silhouettes_in_range, true AS nearest_centre, true AS profile_covers, true AS weighted_mean_fits""")
def clusters_hold(spark, sf_dir):
    """Sizes and profiles add up to the table, the chosen k has the best score, every row belongs to its nearest centre."""
    folder = modelling._clusters(spark, sf_dir)
    scores = spark.read.parquet(f"{folder}/scores")
    clustered = modelling._clustered(spark, sf_dir)
    n = clustered.count()
    centres = models.KMeansModel.load(f"{folder}/model").clusterCenters()
    x = vector_to_array("features")
    apart = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b) for c in centres]
    nearest = clustered.agg(F.bool_and(F.array(*apart)[F.col("cluster")] <= F.least(*apart) + 1e-9)).scalar()
    sizes = F.bool_and(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b) == n).alias("sizes_sum")
    tried = scores.agg(
        counted().alias("counts_tried"), sizes, (F.max("silhouette") == F.max(F.when(F.col("chosen"), F.col("silhouette")))).alias("chosen_is_best"),
        F.bool_and(F.col("silhouette").between(-1, 1)).alias("silhouettes_in_range"))
    profile = models.cluster_profile(clustered)
    groups = models.group_sizes(clustered).agg(F.sum("n")).scalar()
    covers = profile.agg((F.sum("hours") == n) & (groups == n)).scalar()
    mean = profile.agg(F.sum(F.col("avg_traffic") * F.col("hours")) / n).scalar()
    all_mean = feature_rows(spark, sf_dir).agg(F.avg("traffic_volume")).scalar()
    return tried.select(F.lit(n).alias("n"), "*", nearest.alias("nearest_centre"), covers.alias("profile_covers"), (F.abs(mean - all_mean) < 1e-6).alias("weighted_mean_fits"))


@query("silhouette_holds", f"WITH {FEAT} SELECT (SELECT count(*) FROM feat) AS n, least((SELECT count(*) FROM feat), 500) AS sampled, true AS squared_in_range, true AS euclidean_in_range")
def silhouette_holds(spark, sf_dir):
    """Both forms: on squared distances over all rows, Euclidean over a sample of 500 (its feature)."""
    clustered = modelling._clustered(spark, sf_dir)
    squared = models.squared_silhouette(clustered)
    sampled = models.sample_silhouette(clustered, KEYS, 500)
    return sampled.select(F.lit(clustered.count()).alias("n"), "sampled", F.lit(-1 <= squared <= 1).alias("squared_in_range"), F.col("silhouette").between(-1, 1).alias("euclidean_in_range"))


_PERSISTED = f"""{CLEAN}, p AS (SELECT *, lag(traffic_volume) OVER w AS before, row_number() OVER w AS place FROM clean
WINDOW w AS (PARTITION BY series_id ORDER BY date_time))"""


@query("lag_forecast_holds", f"""WITH {_PERSISTED} SELECT model, count(*) AS n, avg(abs(traffic_volume - before)) AS mae_persistence, true AS all_forecast
FROM p, (VALUES ('linear'), ('boosted')) AS m(model) WHERE {TEST} AND place > 24 GROUP BY 1""", ["mae_persistence"])
def lag_forecast_holds(spark, sf_dir):
    """Every test hour with a whole look-back has a forecast of either model beside the exact persistence error."""
    rows = []
    for name, estimator in (("linear", None), ("boosted", models.boosted_forecaster(trees=5, depth=3))):
        scored = models.lag_forecast(feature_rows(spark, sf_dir), SPLIT, estimator=estimator)
        rows.append(scored.agg(
            counted().alias("n"), F.avg(F.abs(F.col("actual") - F.col("persistence"))).alias("mae_persistence"),
            F.bool_and(F.col("forecast").isNotNull() & ~F.isnan("forecast")).alias("all_forecast")).select(F.lit(name).alias("model"), "*"))
    return rows[0].unionAll(rows[1])


@query("shapley_holds", f"SELECT {len(FEATURES)} AS features, true AS adds_up, true AS bounded")
def shapley_holds(spark, sf_dir):
    """Contributions add up: the mean score of the explained rows less the score of the background."""
    train, test = split_rows(spark, sf_dir)
    model = prepared.model(spark, sf_dir, "forest_classifier")
    values = modelling.shapley_attribution(spark, sf_dir)
    background = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in FEATURES])
    base = models.predict_class(model, background).select(models.PROBABILITY).scalar()
    mean = models.predict_class(model, models.dealt_out(test)).agg(F.avg(models.PROBABILITY)).scalar()
    total = values.agg(counted().alias("features"), F.sum("mean_signed").alias("s"), F.bool_and(F.abs("mean_signed") <= F.col("mean_abs") + 1e-9).alias("bounded"))
    return total.select("features", (F.abs(F.col("s") - (mean - base)) < 1e-4).alias("adds_up"), "bounded")


@query("experiment_runs_hold", """SELECT run, true AS has_metrics, true AS has_model FROM (VALUES ('linear-regression'), ('random-forest-regressor'), ('random-forest-classifier')) AS r(run)""")
def experiment_runs_hold(spark, sf_dir):
    runs = modelling.experiment_table(spark, sf_dir)
    metric = F.bool_and((F.size("metrics") > 0) & F.forall(F.map_values("metrics"), lambda v: v.isNotNull() & ~F.isnan(v)))
    return runs.groupBy("run").agg(metric.alias("has_metrics"), F.bool_and(F.length("model_path") > 0).alias("has_model"))


@query("stream_score_holds", f"WITH {operations._CHECKED} SELECT count(*) AS n, count(*) AS equal_to_batch FROM checked WHERE errors = ''")
def stream_score_holds(spark, sf_dir):
    """Every valid request of the stream has the very score of the batch."""
    streamed = spark.read.parquet(operations.stream_score_folder(spark, sf_dir))
    batch = scoring.score_requests(scoring.split_requests(operations.score_requests_view(spark, sf_dir))[0], *operations._served(spark, sf_dir))
    same = streamed.select("request_id", F.struct(*sorted(set(batch.columns) - {"request_id"})).alias("s")).join(
        batch.select("request_id", F.struct(*sorted(set(batch.columns) - {"request_id"})).alias("b")), "request_id", "left")
    return same.agg(counted().alias("n"), F.count_if(F.col("s").eqNullSafe(F.col("b"))).alias("equal_to_batch"))
