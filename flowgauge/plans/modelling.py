"""Cleaning steps, features, sequences, metrics and models as queries."""

from pyspark.sql import functions as F

from flowgauge.constants import CONGESTION_QUANTILE, FEATURES, SEQUENCE_CHANNELS, WEATHER
from flowgauge.functions.fields import sample_order
from flowgauge.functions.ordered import quantile_scalar
from flowgauge.operators import cleaning, features, metrics, models, runs, sequences
from flowgauge.plans import prepared
from flowgauge.plans.basics import ALL_COLUMNS, MEASURES
from flowgauge.plans.checks import CLEAN, FEAT, HIST, STAMP, TEST, TRAIN, cleaned
from flowgauge.plans.prepared import SPLIT, clean_rows, feature_rows, place, split_rows
from flowgauge.plans.registry import query
from flowgauge.sources import tables
from flowgauge.sources.views import OBS_COLUMNS, history, observations

FLOAT_FEATURES = ["temp_c", "rain_1h", "snow_1h", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
KEYS = ["series_id", "date_time"]


# --- cleaning ---------------------------------------------------------------------------------

@query("dedup_first", f"WITH {CLEAN} SELECT {ALL_COLUMNS} FROM kept", MEASURES)
def dedup_first(spark, sf_dir):
    return cleaning.keep_first(observations(spark, sf_dir))


@query("month_median_map", f"WITH {HIST}, {cleaned('hist')} SELECT series_id, ordinal, {STAMP}, temp FROM clean", ["temp"])
def month_median_map(spark, sf_dir):
    kept = cleaning.keep_first(history(spark, sf_dir))
    return cleaning.impute_zero_kelvin(kept).select("series_id", "ordinal", "date_time", "temp")


@query("month_medians", f"WITH {HIST}, {cleaned('hist')} SELECT month_no, median_temp FROM medians", ["median_temp"])
def month_medians(spark, sf_dir):
    return cleaning.month_medians(cleaning.keep_first(history(spark, sf_dir)))


@query("clean_table", f"WITH {CLEAN} SELECT {ALL_COLUMNS} FROM clean", MEASURES)
def clean_table(spark, sf_dir):
    return cleaning.clean(observations(spark, sf_dir)).select(*OBS_COLUMNS)


# --- features ---------------------------------------------------------------------------------

@query("time_features", f"""WITH {FEAT} SELECT series_id, {STAMP}, hour, day_of_week, month,
hour_sin, hour_cos, dow_sin, dow_cos, month_sin, month_cos FROM feat""", FLOAT_FEATURES[3:])
def time_features(spark, sf_dir):
    built = features.time_features(clean_rows(spark, sf_dir))
    return built.select(*KEYS, "hour", "day_of_week", "month", *FLOAT_FEATURES[3:])


@query("calendar_flags", f"WITH {FEAT} SELECT series_id, {STAMP}, is_weekend, is_rush_hour, is_holiday FROM feat")
def calendar_flags(spark, sf_dir):
    built = features.calendar_flags(features.time_features(clean_rows(spark, sf_dir)))
    return built.select(*KEYS, "is_weekend", "is_rush_hour", "is_holiday")


@query("holiday_flag", f"WITH {FEAT} SELECT series_id, {STAMP}, is_holiday FROM feat")
def holiday_flag(spark, sf_dir):
    return features.holiday_flag(clean_rows(spark, sf_dir)).select(*KEYS, "is_holiday")


@query("weather_onehot", f"WITH {FEAT} SELECT series_id, {STAMP}, " + ", ".join(f"weather_{w}" for w in WEATHER) + " FROM feat")
def weather_onehot(spark, sf_dir):
    return features.weather_onehot(clean_rows(spark, sf_dir)).select(*KEYS, *[f"weather_{w}" for w in WEATHER])


@query("unknown_weather", f"""WITH {HIST} SELECT series_id, ordinal, weather_main FROM hist
WHERE weather_main IS NULL OR weather_main NOT IN ({", ".join(f"'{w}'" for w in WEATHER)})""")
def unknown_weather(spark, sf_dir):
    return features.unknown_weather(history(spark, sf_dir)).select("series_id", "ordinal", "weather_main")


@query("congestion_target", f"WITH {FEAT} SELECT series_id, {STAMP}, traffic_volume, congestion FROM feat")
def congestion_target(spark, sf_dir):
    return features.congestion_target(clean_rows(spark, sf_dir)).select(*KEYS, "traffic_volume", "congestion")


@query("congestion_target_fit_before", f"""WITH {CLEAN} SELECT series_id, {STAMP},
CAST(traffic_volume >= (SELECT quantile_cont(traffic_volume, 0.75) FROM clean WHERE {TRAIN}) AS BIGINT) AS congestion FROM clean""")
def congestion_target_fit_before(spark, sf_dir):
    """The threshold without a look at the test period."""
    rows = clean_rows(spark, sf_dir)
    return features.congestion_target(rows, fit_on=rows.where(models.before(SPLIT))).select(*KEYS, "congestion")


@query("scalar_broadcast", f"""WITH {CLEAN}, s AS (SELECT quantile_cont(traffic_volume, 0.75) AS q3, avg(traffic_volume) AS m FROM clean)
SELECT series_id, {STAMP}, traffic_volume >= q3 AS above_q3, traffic_volume / m AS ratio FROM clean, s""", ["ratio"])
def scalar_broadcast(spark, sf_dir):
    rows, v = clean_rows(spark, sf_dir), F.col("traffic_volume")
    q3, mean = quantile_scalar(rows, v, CONGESTION_QUANTILE), rows.agg(F.avg(v)).scalar()
    return rows.select(*KEYS, (v >= q3).alias("above_q3"), (v / mean).alias("ratio"))


@query("feature_table", f"""WITH {FEAT} SELECT series_id, ordinal, {STAMP}, traffic_volume, congestion, {", ".join(FEATURES)}
FROM feat""", FLOAT_FEATURES)
def feature_table(spark, sf_dir):
    return features.feature_table(clean_rows(spark, sf_dir))


_RISK = "CAST(congestion = 1 AND (rain_1h > 5 OR weather_Snow + weather_Thunderstorm + weather_Squall + weather_Fog > 0) AS BIGINT)"


@query("high_risk_label", f"WITH {FEAT} SELECT series_id, {STAMP}, {_RISK} AS high_risk FROM feat")
def high_risk_label(spark, sf_dir):
    return features.high_risk_label(feature_rows(spark, sf_dir)).select(*KEYS, "high_risk")


@query("high_risk_share", f"""WITH {FEAT}, r AS (SELECT {_RISK} AS high_risk, CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS p FROM feat)
SELECT coalesce(p, 'all') AS part, count(*) AS n, CAST(sum(high_risk) AS BIGINT) AS positives, avg(high_risk) AS share
FROM r GROUP BY ROLLUP (p)""", ["share"])
def high_risk_share(spark, sf_dir):
    return features.high_risk_share(feature_rows(spark, sf_dir), SPLIT)


_SCALED = ["traffic_volume", "temp_c", "rain_1h", "clouds_all"]


@query("standardize", f"""WITH {FEAT}, s AS (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED) + f""" FROM feat WHERE {TRAIN})
SELECT series_id, {STAMP}, """ + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _SCALED) + " FROM feat, s", _SCALED)
def standardize(spark, sf_dir):
    rows = feature_rows(spark, sf_dir).select(*KEYS, *_SCALED)
    return features.standardize(rows, _SCALED, fit_on=rows.where(models.before(SPLIT)))


@query("unstandardize", f"""WITH {FEAT} SELECT series_id, {STAMP}, traffic_volume, temp_c FROM feat WHERE {TEST}""",
       ["traffic_volume", "temp_c"])
def unstandardize(spark, sf_dir):
    rows = feature_rows(spark, sf_dir).select(*KEYS, "traffic_volume", "temp_c")
    train, test = models.time_split(rows, SPLIT)
    scaled = features.standardize(test, ["traffic_volume", "temp_c"], fit_on=train)
    return features.unstandardize(scaled, {"traffic_volume": "traffic_volume", "temp_c": "temp_c"}, fit_on=train)


# --- sequences --------------------------------------------------------------------------------

_BY_SERIES = "PARTITION BY series_id ORDER BY date_time"


@query("lookback_windows", f"""WITH {FEAT}, w AS (SELECT series_id, date_time, traffic_volume,
list(traffic_volume) OVER h AS v, list(temp_c) OVER h AS t FROM feat WINDOW h AS ({_BY_SERIES} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
SELECT series_id, {STAMP}, traffic_volume, len(v) AS steps, list_sum(v)::DOUBLE AS volume_sum, v[1]::DOUBLE AS first_volume,
v[24]::DOUBLE AS last_volume, list_sum(t) AS temp_sum FROM w WHERE len(v) = 24""",
       ["volume_sum", "first_volume", "last_volume", "temp_sum"])
def lookback_windows(spark, sf_dir):
    rows = feature_rows(spark, sf_dir).select(*KEYS, *SEQUENCE_CHANNELS)
    windows = sequences.lookback_windows(rows, SEQUENCE_CHANNELS, chunk_days=7)

    def total(i):
        return F.aggregate("window", F.lit(0.0), lambda acc, step: acc + step[i])

    return windows.select(
        *KEYS, "traffic_volume", F.size("window").alias("steps"), total(0).alias("volume_sum"),
        F.col("window")[0][0].alias("first_volume"), F.col("window")[23][0].alias("last_volume"), total(1).alias("temp_sum"),
    )


@query("persistence_forecast", f"""WITH {CLEAN} SELECT series_id, {STAMP}, traffic_volume,
CAST(lag(traffic_volume) OVER (PARTITION BY series_id ORDER BY clean.date_time) AS DOUBLE) AS forecast FROM clean""")
def persistence_forecast(spark, sf_dir):
    rows = clean_rows(spark, sf_dir).select(*KEYS, "traffic_volume")
    forecast = sequences.previous_value(rows, "traffic_volume", "forecast", chunk_days=7)
    return forecast.withColumn("forecast", F.col("forecast").cast("double"))


@query("every_nth", f"""WITH {CLEAN}, p AS (SELECT series_id, date_time, row_number() OVER ({_BY_SERIES}) - 1 AS position
FROM clean WHERE {TRAIN}) SELECT series_id, {STAMP}, position FROM p WHERE position >= 24 AND (position - 24) % 3 = 0""")
def every_nth(spark, sf_dir):
    return sequences.every_nth(clean_rows(spark, sf_dir).select(*KEYS), SPLIT, chunk_days=7)


@query("bounded_sample", f"""WITH {CLEAN} SELECT series_id, {STAMP}, traffic_volume FROM clean
ORDER BY md5(concat_ws('|', '42', series_id, strftime(clean.date_time, '%Y-%m-%d %H:%M:%S'))), series_id, clean.date_time LIMIT 1000""")
def bounded_sample(spark, sf_dir):
    rows = clean_rows(spark, sf_dir)
    order = sample_order(42, F.col("series_id"), F.col("date_time"))
    return rows.orderBy(order, *KEYS).limit(1000).select(*KEYS, "traffic_volume")


# --- metrics on columns that need no model ----------------------------------------------------

@query("mean_baseline", f"""WITH {FEAT}, m AS (SELECT avg(traffic_volume) AS train_mean FROM feat WHERE {TRAIN})
SELECT count(*) AS n, max(train_mean) AS train_mean, avg(abs(traffic_volume - train_mean)) AS mae FROM feat, m WHERE {TEST}""",
       ["train_mean", "mae"])
def mean_baseline(spark, sf_dir):
    return metrics.mean_baseline(*split_rows(spark, sf_dir))


@query("regression_metrics", f"""WITH {CLEAN}, p AS (SELECT *, lag(traffic_volume) OVER ({_BY_SERIES}) AS forecast FROM clean),
t AS (SELECT CAST(traffic_volume AS DOUBLE) AS y, CAST(traffic_volume - forecast AS DOUBLE) AS e FROM p WHERE {TEST} AND forecast IS NOT NULL)
SELECT count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - avg(e * e) / var_pop(y) AS r2 FROM t""", ["mae", "rmse", "r2"])
def regression_metrics(spark, sf_dir):
    """The persistence forecast on the test period."""
    rows = clean_rows(spark, sf_dir).select(*KEYS, "traffic_volume")
    forecast = sequences.previous_value(rows, "traffic_volume", "forecast")
    test = forecast.where(~models.before(SPLIT) & F.col("forecast").isNotNull())
    return metrics.regression_metrics(test, "traffic_volume", "forecast")


_SCORED = f"""{FEAT}, s AS (SELECT congestion AS y, clouds_all / 100.0::DOUBLE AS p, CAST(clouds_all >= 50 AS BIGINT) AS z FROM feat),
c AS (SELECT count(*) FILTER (y = 0 AND z = 0) AS tn, count(*) FILTER (y = 0 AND z = 1) AS fp,
count(*) FILTER (y = 1 AND z = 0) AS fn, count(*) FILTER (y = 1 AND z = 1) AS tp FROM s)"""


def _scored(spark, sf_dir):
    """A score that needs no model: the cloud cover."""
    score = F.col("clouds_all") / F.lit(100.0)
    return feature_rows(spark, sf_dir).select("congestion", score.alias("p"), (score >= 0.5).cast("int").alias("z"))


@query("confusion_matrix", f"WITH {_SCORED} SELECT * FROM c")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_scored(spark, sf_dir), "congestion", "z")


@query("classification_metrics", f"""WITH {_SCORED} SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / (tp + fp) AS precision,
tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM c""", ["accuracy", "precision", "recall", "f1"])
def classification_metrics(spark, sf_dir):
    return metrics.classification_metrics(_scored(spark, sf_dir), "congestion", "z")


@query("roc_auc", f"""WITH {_SCORED}, g AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM s GROUP BY p),
b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM b""", ["auc"])
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(_scored(spark, sf_dir), "congestion", "p")


# --- models -----------------------------------------------------------------------------------

def _to_score(spark, sf_dir, name, side=1):
    rows = split_rows(spark, sf_dir)[side]
    return rows if name in ("linear", "logistic") else models.dealt_out(rows)


def _volume_metrics(spark, sf_dir, name):
    scored = models.predict_volume(prepared.model(spark, sf_dir, name), _to_score(spark, sf_dir, name))
    return metrics.regression_metrics(scored, "traffic_volume", models.VOLUME)


def _class_metrics(spark, sf_dir, name, label):
    """Rows are scored once; the counts and the area under the curve read the stored scores."""
    def build(path):
        scored = models.predict_class(prepared.model(spark, sf_dir, name), _to_score(spark, sf_dir, name))
        scored.select(label, models.CLASS, models.PROBABILITY).write.mode("overwrite").parquet(path)

    scored = spark.read.parquet(prepared.once(place(spark, sf_dir, f"scores/{name}"), build))
    auc = metrics.roc_auc(scored, label, models.PROBABILITY).select("auc").scalar()
    return metrics.classification_metrics(scored, label, models.CLASS).withColumn("auc", auc)


@query("linear_regression")
def linear_regression(spark, sf_dir):
    return _volume_metrics(spark, sf_dir, "linear")


@query("rf_regressor")
def rf_regressor(spark, sf_dir):
    return _volume_metrics(spark, sf_dir, "forest_regressor")


@query("logistic_regression")
def logistic_regression(spark, sf_dir):
    return _class_metrics(spark, sf_dir, "logistic", "congestion")


@query("rf_classifier")
def rf_classifier(spark, sf_dir):
    return _class_metrics(spark, sf_dir, "forest_classifier", "congestion")


@query("rf_balanced")
def rf_balanced(spark, sf_dir):
    return _class_metrics(spark, sf_dir, "balanced_classifier", "high_risk")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return models.feature_importance(spark, prepared.model(spark, sf_dir, "forest_classifier"))


@query("top_features")
def top_features(spark, sf_dir):
    return models.top_features(feature_importance(spark, sf_dir))


@query("model_store", f"WITH {FEAT} SELECT count(*) AS n, 0.0::DOUBLE AS max_difference FROM feat WHERE {TEST}")
def model_store(spark, sf_dir):
    """A stored copy must predict what the original predicts: the largest difference over the test rows."""
    original = prepared.model(spark, sf_dir, "linear")
    path = place(spark, sf_dir, "models/linear_copy")
    tables.save_model(original, path)
    test = split_rows(spark, sf_dir)[1]
    both = models.predict_volume(
        tables.load_model(path), models.predict_volume(original, test).withColumnRenamed(models.VOLUME, "first"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("first") - F.col(models.VOLUME))).alias("max_difference"))


def _clusters(spark, sf_dir):
    """(scores per k, path of the stored centres of the best k)."""
    def build(path):
        scores, best = models.select_clusters(feature_rows(spark, sf_dir))
        scores.write.mode("overwrite").parquet(f"{path}/scores")
        best.write().overwrite().save(f"{path}/model")

    return prepared.once(place(spark, sf_dir, "clusters"), build)


def _clustered(spark, sf_dir):
    model = models.KMeansModel.load(f"{_clusters(spark, sf_dir)}/model")
    return model.transform(models.cluster_input(feature_rows(spark, sf_dir)))


@query("kmeans_select")
def kmeans_select(spark, sf_dir):
    scores = spark.read.parquet(f"{_clusters(spark, sf_dir)}/scores")
    return scores.withColumn("sizes", F.array_join("sizes", ","))


@query("silhouette")
def silhouette(spark, sf_dir):
    clustered = _clustered(spark, sf_dir)
    score = models.squared_silhouette(clustered)
    return clustered.agg(F.count(F.lit(1)).alias("n")).withColumn("squared_silhouette", F.lit(score))


@query("cluster_profile")
def cluster_profile(spark, sf_dir):
    return models.cluster_profile(_clustered(spark, sf_dir))


@query("group_sizes")
def group_sizes(spark, sf_dir):
    return models.group_sizes(_clustered(spark, sf_dir))


@query("lag_forecast")
def lag_forecast(spark, sf_dir):
    scored = models.lag_forecast(feature_rows(spark, sf_dir), SPLIT)
    both = scored.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(F.col("actual") - F.col("forecast"))).alias("mae_forecast"),
        F.avg(F.abs(F.col("actual") - F.col("persistence"))).alias("mae_persistence"),
    ).alias("s"))
    return both.select("s.*")


@query("shapley_attribution")
def shapley_attribution(spark, sf_dir):
    train, test = split_rows(spark, sf_dir)
    model = prepared.model(spark, sf_dir, "forest_classifier")
    values = models.shapley_attribution(model, test, train, KEYS)
    return values


def experiment_table(spark, sf_dir):
    """The three tracked runs; row counts are counted, not copied."""
    train, test = split_rows(spark, sf_dir)

    def build(path):
        shared = {
            "split_date": SPLIT, "n_features": str(len(FEATURES)),
            "train_rows": train.agg(F.count(F.lit(1))).scalar(), "test_rows": test.agg(F.count(F.lit(1))).scalar(),
        }
        forest = {"trees": "100", "seed": "42"}
        prepared.fitted(spark, sf_dir, ["linear", "forest_regressor", "forest_classifier"])
        tracked = [
            ("linear-regression", "linear", _volume_metrics(spark, sf_dir, "linear"), {}),
            ("random-forest-regressor", "forest_regressor", _volume_metrics(spark, sf_dir, "forest_regressor"), forest),
            ("random-forest-classifier", "forest_classifier",
             _class_metrics(spark, sf_dir, "forest_classifier", "congestion"), forest),
        ]
        for run, name, scores, extra in tracked:
            row = runs.run_row(scores, run, {**shared, **extra, "model": name}, place(spark, sf_dir, f"models/{name}"))
            runs.log_run(row, path)

    return spark.read.parquet(prepared.once(place(spark, sf_dir, "runs"), build))


@query("experiment_runs")
def experiment_runs(spark, sf_dir):
    return runs.compare_runs(experiment_table(spark, sf_dir))
