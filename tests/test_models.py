import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from flowgauge.constants import FEATURES
from flowgauge.operators import advice, attribution, features, metrics, models, runs, scoring, starts
from flowgauge.plans import prepared
from flowgauge.sources import tables

SPLIT = "2013-01-22"
REQUEST = (
    "request_id int, hour int, day_of_week int, month int, temp_c double, rain_1h double, snow_1h double, "
    "clouds_all double, weather_main string, is_holiday boolean"
)


@pytest.fixture(scope="module")
def signal(spark):
    """Four weeks of two sensors whose volume follows the clock; rush hours are congested."""
    hour, dow = F.hour("date_time"), F.weekday("date_time")
    rush = hour.isin(6, 7, 8, 9, 15, 16, 17, 18) & (dow < 5)
    rows = spark.range(2 * 24 * 28).select(
        (F.col("id") % 2).alias("series_id"), F.col("id").alias("ordinal"), F.lit("None").alias("holiday"),
        (F.lit(270.0) + F.col("id") % 13).alias("temp"), F.lit(0.0).alias("rain_1h"), F.lit(0.0).alias("snow_1h"),
        (F.col("id") % 90).cast("int").alias("clouds_all"),
        F.when(F.col("id") % 5 == 0, "Snow").when(F.col("id") % 3 == 0, "Clear").otherwise("Clouds").alias("weather_main"),
        F.lit("").alias("weather_description"),
        F.timestamp_seconds(F.lit(1356998400) + F.floor(F.col("id") / 2) * 3600).alias("date_time"),
    ).withColumn(
        "traffic_volume",
        (F.when(rush, 5500).otherwise(800 + 60 * F.hour("date_time")) + F.col("ordinal") * 37 % 100).cast("long"),
    )
    table = features.high_risk_label(features.feature_table(rows))
    path_free = table.persist()
    yield path_free
    path_free.unpersist()


@pytest.fixture(scope="module")
def parts(signal):
    return models.time_split(signal, SPLIT)


@pytest.fixture(scope="module")
def fitted(parts):
    train = parts[0]
    return {
        "regressor": models.fit_forest_regressor(train, trees=20, depth=6),
        "classifier": models.fit_forest_classifier(train, trees=20, depth=6),
    }


def test_models_beat_the_mean(parts, fitted):
    train, test = parts
    baseline = metrics.mean_baseline(train, test).first()["mae"]
    for model in (fitted["regressor"], models.fit_linear(train)):
        scored = models.predict_volume(model, test)
        assert metrics.regression_metrics(scored, "traffic_volume", models.VOLUME).first()["mae"] < baseline


def test_classifiers_find_the_signal(parts, fitted):
    train, test = parts
    balanced = models.fit_balanced_classifier(train, trees=20, depth=6)
    for model, label in ((fitted["classifier"], "congestion"), (models.fit_logistic(train), "congestion"), (balanced, "high_risk")):
        assert metrics.roc_auc(models.predict_class(model, test), label, models.PROBABILITY).first()["auc"] > 0.8


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    got = {r["y"]: r["weight"] for r in models.balanced_weights(df, "y").collect()}
    assert got == {1: 2.0, 0: pytest.approx(4 / 6)}


def test_importance_and_attribution_agree(spark, parts, fitted):
    top = models.top_features(models.feature_importance(spark, fitted["classifier"])).collect()
    values = models.shapley_attribution(fitted["classifier"], parts[1], parts[0], ["ordinal"], n=20, orders=2)
    assert len(top) == 5 and values.count() == len(FEATURES)
    named = {r["feature"] for r in models.top_features(values, 8, by="mean_abs").collect()}
    assert "is_rush_hour" in named and any(r["feature"] == "is_rush_hour" for r in top)


def test_attribution_sums_to_the_score(parts, fitted):
    train, test = parts
    one = test.orderBy("ordinal").limit(1)
    values = models.shapley_attribution(fitted["classifier"], one, train, ["ordinal"], n=1, orders=1)
    background = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in FEATURES])
    p = [models.predict_class(fitted["classifier"], df).first()[models.PROBABILITY] for df in (one, background)]
    assert values.agg(F.sum("mean_signed")).first()[0] == pytest.approx(p[0] - p[1])


def test_stored_model_predicts_the_same(spark, parts, fitted, tmp_path):
    path = str(tmp_path / "m")
    tables.save_model(fitted["regressor"], path)
    a, b = (models.predict_volume(m, parts[1]).select("ordinal", models.VOLUME) for m in (fitted["regressor"], tables.load_model(path)))
    assert a.exceptAll(b).isEmpty()


def test_forecast_beats_persistence(signal):
    row = models.lag_forecast(signal, SPLIT, nth=1).agg(
        F.avg(F.abs(F.col("actual") - F.col("forecast"))).alias("f"), F.avg(F.abs(F.col("actual") - F.col("persistence"))).alias("p")
    ).first()
    assert row["f"] < row["p"]


def test_sampled_silhouette_equals_the_definition(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (30, 2)), rng.normal(9, 1, (29, 2)), [[50.0, 50.0]]])
    labels = [0] * 30 + [1] * 29 + [2]
    rows = [(i, Vectors.dense(p), int(c)) for i, (p, c) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, ["id", "features", "cluster"])
    d, y = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), np.array(labels)
    want = []
    for i in range(len(x)):
        own = (y == y[i]) & (np.arange(len(x)) != i)
        if not own.any():
            want.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, y == c].mean() for c in set(labels) - {y[i]})
        want.append((b - a) / max(a, b))
    got = models.sample_silhouette(df, ["id"], n=1000, blocks=5).first()
    assert got["silhouette"] == pytest.approx(np.mean(want)) and got["sampled"] == 60


def test_clusters_are_chosen_by_score(spark, signal):
    scores, best = models.select_clusters(signal, counts=[2, 3], restarts=2)
    rows = scores.orderBy(F.desc("silhouette"), "k").collect()
    assert rows[0]["chosen"] and best.summary.k == rows[0]["k"]
    assert all(sum(r["sizes"]) == signal.count() for r in rows)


def test_requests_are_validated(spark):
    rows = [
        (1, 17, 2, 6, 20.0, None, None, None, "Clear", None), (2, 3, 6, 6, 15.0, 0.0, 0.0, 10.0, "Clear", False),
        (3, 25, 2, 6, 20.0, None, None, None, None, None), (4, 8, 2, 6, 20.0, None, None, None, "banana", None),
        (5, None, 2, 6, None, -1.0, None, 101.0, None, None),
    ]
    valid, quarantined = scoring.split_requests(spark.createDataFrame(rows, REQUEST))
    assert [r["request_id"] for r in valid.orderBy("request_id").collect()] == [1, 2]
    first = valid.orderBy("request_id").first()
    assert (first["clouds_all"], first["rain_1h"], first["is_holiday"]) == (50.0, 0.0, False)
    errors = {r["request_id"]: r["errors"] for r in quarantined.collect()}
    assert errors == {3: ["hour"], 4: ["weather_main"], 5: ["hour", "temp_c", "rain_1h", "clouds_all"]}


def test_rush_hour_scores_high_and_night_low(spark, fitted):
    rows = [(1, 17, 2, 1, 5.0, 0.0, 0.0, 40.0, "Clear", False), (2, 3, 6, 1, 5.0, 0.0, 0.0, 40.0, "Clear", False)]
    valid, _ = scoring.split_requests(spark.createDataFrame(rows, REQUEST))
    rush, night = scoring.score_requests(valid, fitted["regressor"], fitted["classifier"]).orderBy("request_id").collect()
    assert rush["predicted_traffic_volume"] > 4000 and rush["congestion_predicted"] and rush["risk_level"] == "HIGH"
    assert night["predicted_traffic_volume"] < 1500 and not night["congestion_predicted"]


def test_advice_covers_every_combination(spark, signal):
    table = advice.recommend(signal, advice.published_rules(spark)).persist()
    assert table.count() == 24 * 2 * 11
    rate = table.agg(F.sum(F.col("congestion_rate") * F.col("n")) / F.sum("n")).first()[0]
    assert rate == pytest.approx(table.first()["base_rate"])
    unseen = table.where("weather = 'Squall'").first()
    assert (unseen["n"], unseen["congestion_rate"], unseen["level"], unseen["rough_estimate"]) == (0, None, "LOW", True)
    noon = table.where("hour = 13 AND day_type = 'Weekday' AND weather = 'Clouds'").first()
    assert len(noon["rules"]) == 4 and noon["rules"][0] == "Afternoon(12-16) + Clouds + Weekday"
    table.unpersist()


def test_mined_rules_feed_the_advice(spark):
    rules = spark.createDataFrame([(["Afternoon(12-16)", "Weather_Snow", "Weekday"], 0.5, 0.7, 2.0), (["Weekday"], 0.5, 0.6, 1.5)],
                                  "antecedent array<string>, support double, confidence double, lift double")
    from flowgauge.operators.rules import rule_parts

    got = [tuple(r)[:3] for r in rule_parts(rules).orderBy("confidence").collect()]
    assert got == [(None, "Weekday", None), ("Afternoon(12-16)", "Weekday", "Snow")]


def test_runs_are_appended_and_read_back(spark, tmp_path):
    path = str(tmp_path / "runs")
    for mae in (3.0, 2.0):
        runs.log_run(runs.run_row(spark.range(1).select(F.lit(mae).alias("mae")), "demo", {"n": F.lit(7)}, "here"), path)
    table = spark.read.parquet(path)
    assert {r["value"] for r in runs.compare_runs(table).collect()} == {2.0, 3.0}
    assert spark.range(1).select(runs.recorded_metric(table, "demo", "mae").alias("m")).first()["m"] == 2.0
    assert table.first()["params"] == {"n": "7"}


def test_split_opens_only_its_months(spark, sf_dir):
    for side in prepared.split_rows(spark, sf_dir):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "PartitionFilters: [" in plan
        assert not {"year", "month_part"} & set(side.columns)


def test_boosted_forecast_beats_persistence_and_the_line(signal):
    mae = F.avg(F.abs(F.col("actual") - F.col("forecast")))
    boosted = models.lag_forecast(signal, SPLIT, estimator=models.boosted_forecaster()).agg(mae.alias("f"), F.avg(F.abs(F.col("actual") - F.col("persistence"))).alias("p")).first()
    assert boosted["f"] < boosted["p"]
    assert boosted["f"] < models.lag_forecast(signal, SPLIT).agg(mae).first()[0]  # rush hours are no line


def test_deep_trees_say_what_they_reached(parts):
    deep = models.forest_limits(models.fit_forest_regressor(parts[0], trees=3, depth=30, bins=128))
    cut = models.forest_limits(models.fit_forest_regressor(parts[0], trees=3, depth=2))
    assert (cut["depth_reached"], cut["trees_cut"], cut["depth_allowed"]) == (2, 3, 2)
    assert deep["depth_allowed"] == 30 and deep["depth_reached"] > 2 and deep["nodes"] > cut["nodes"]


def test_requests_are_dealt_out_before_scoring(spark, fitted):
    rows = [(i, 17, 2, 1, 5.0, 0.0, 0.0, 40.0, "Clear", False) for i in range(40)]
    valid, _ = scoring.split_requests(spark.createDataFrame(rows, REQUEST).coalesce(1))
    scored = scoring.score_requests(valid, fitted["regressor"], fitted["classifier"])
    assert "Exchange hashpartitioning(request_id" in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.select(F.spark_partition_id()).distinct().count() > 1


def test_scoring_tasks_go_by_cores_with_alike_requests_together(spark, fitted):
    rows = [(i, i % 24, 2, 1, float(i * 7 % 40), 0.0, 0.0, 40.0, "Clear", False) for i in range(2000)]
    valid, _ = scoring.split_requests(spark.createDataFrame(rows, REQUEST))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        scored = scoring.score_requests(valid, fitted["regressor"], fitted["classifier"])
        tasks = scored.rdd.map(lambda r: (r["hour"], r["temp_c"])).glom().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(tasks) == 2 * spark.sparkContext.defaultParallelism and sum(map(len, tasks)) == 2000
    assert all(task == sorted(task) for task in tasks)


def test_listed_days_reach_the_scan(spark, sf_dir):
    from flowgauge.plans.suite import holiday_list, run_named
    from flowgauge.sources.views import history

    rows = history(spark, sf_dir)
    result = run_named("holiday_temps", rows, holiday_list(rows, [("A", "1997-07-04"), ("B", "1997-07-05"), ("C", "1998-12-25")]))
    plan = result._jdf.queryExecution().executedPlan().toString()
    pushed = [part for part in plan.split("PushedFilters: ")[1:]]
    assert any("GreaterThanOrEqual(o_orderdate,1997-07-04" in p and "LessThan(o_orderdate,1997-07-06" in p for p in pushed)
    assert result.count() == 3


def test_forest_rows_go_to_a_task_a_core(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert models.spread(parts[0], parts[0].count()).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert models.fit_tasks(spark, 100 * models.ROWS_A_TASK) == 100


def test_forest_tasks_hold_alike_rows_together_in_whole_rounds(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 7, f"2024-01-01 0{i % 10}:00:00", i * 37 % 101, i % 2) for i in range(700)], "series_id long, date_time string, many int, few int")
    n, order = models.coarse_first(rows, ["many", "few"])
    assert (n, order) == (700, ["few", "many"])
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(models, "ROWS_A_TASK", 700 // (cores + 1))  # a few more tasks than cores would leave cores idle
    assert models.fit_tasks(spark, n) > cores
    dealt = models.spread(rows, n, order)
    assert dealt.rdd.getNumPartitions() == 2 * cores
    tasks = [[(r["few"], r["many"]) for r in task] for task in dealt.rdd.glom().collect()]
    assert sum(map(len, tasks)) == n and all(task == sorted(task) for task in tasks)


def test_fits_get_sorted_rows(spark, parts, monkeypatch):
    orders, spread = [], models.spread
    monkeypatch.setattr(models, "spread", lambda train, n, order=(): orders.append(list(order)) or spread(train, n, order))
    models.fit_forest_regressor(parts[0], trees=2, depth=2)
    models.fit_forest_classifier(parts[0], trees=2, depth=2)
    assert len(orders) == 2 and all(sorted(o) == sorted(models.FEATURES) for o in orders)


def test_starts_share_their_passes(spark, signal, monkeypatch):
    vectors, whole = models.cluster_input(signal).select("features").persist(), []
    costs = [models.KMeans(k=3, seed=7 + i, predictionCol="cluster", maxIter=300).fit(vectors).summary.trainingCost for i in range(4)]

    class Counted(models.KMeans):
        def _fit(self, dataset):
            whole.append(self.getMaxIter() > 0)
            return super()._fit(dataset)

    monkeypatch.setattr(models, "KMeans", Counted)
    model = models.fit_kmeans(vectors, 3, restarts=4, seed=7)
    assert model.summary.trainingCost == pytest.approx(min(costs)) and sum(whole) == 1
    vectors.unpersist()


def test_alike_rows_make_fewer_centres(spark):
    vectors = spark.createDataFrame([(Vectors.dense(float(i % 2), 1.0),) for i in range(20)], ["features"]).persist()
    fitted = models.fit_kmeans_counts(vectors, [2, 4], restarts=2)
    assert {k: len(m.clusterCenters()) for k, m in fitted.items()} == {2: 2, 4: 2}
    vectors.unpersist()


def test_rows_are_dealt_out_before_a_forest_scores_them(spark, parts, fitted):
    one = parts[1].coalesce(1)
    dealt = models.dealt_out(one)
    tasks = [len(t) for t in dealt.rdd.glom().collect()]
    assert len(tasks) == 2 * spark.sparkContext.defaultParallelism and sum(tasks) == one.count() and max(tasks) < sum(tasks) / 2
    columns = ["series_id", "date_time", models.VOLUME]
    a, b = (models.predict_volume(fitted["regressor"], df).select(*columns) for df in (one, dealt))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("name", ["rf_regressor", "rf_classifier", "rf_regressor_holds", "rf_classifiers_hold"])
def test_queries_deal_rows_out_to_their_forests(spark, sf_dir, parts, fitted, monkeypatch, name):
    import __spark_entry__ as entry_point

    sides, dealt_out = [], models.dealt_out
    monkeypatch.setattr(models, "dealt_out", lambda rows: sides.append(rows) or dealt_out(rows))
    monkeypatch.setattr(prepared, "model", lambda spark, sf_dir, name: fitted["regressor" if "regressor" in name else "classifier"])
    monkeypatch.setattr(prepared, "fitted", lambda spark, sf_dir, names: None)
    monkeypatch.setattr(prepared, "_done", set(prepared._done))  # these scores are for no other test
    entry_point.queries()[name](spark, sf_dir)
    assert len(sides) == {"rf_regressor": 1, "rf_classifier": 1}.get(name, 2)


def test_walked_trees_give_the_change_of_every_hybrid_score(spark, parts, fitted):
    """Each step of each order scored by Spark, as the definition says."""
    train, test = parts
    model, few = fitted["classifier"], test.orderBy("ordinal").limit(3)
    mean = np.array(train.agg(*[F.avg(F.col(c).cast("double")) for c in FEATURES]).first(), float)
    x = np.array(few.select(*[F.col(c).cast("double") for c in FEATURES]).collect())
    orders = np.array([np.random.default_rng(5).permutation(len(FEATURES)) for _ in range(2)])
    hybrids = []
    for i, row in enumerate(x):
        for turn in orders:
            now = mean.copy()
            hybrids.append((len(hybrids), Vectors.dense(now.copy())))
            for feature in turn:
                now[feature] = row[feature]
                hybrids.append((len(hybrids), Vectors.dense(now.copy())))
    scored = model.stages[-1].transform(spark.createDataFrame(hybrids, ["i", "features"])).orderBy("i").collect()
    p = np.array([r["_probability"][1] for r in scored]).reshape(3, 2, -1)
    expected = np.zeros((3, len(FEATURES)))
    for o, turn in enumerate(orders):
        expected[:, turn] += (p[:, o, 1:] - p[:, o, :-1]) / 2
    got = attribution.contributions(attribution.trees_of(model.stages[-1]), x, mean, orders)
    assert np.abs(expected).max() > 0.01 and np.abs(got - expected).max() < 1e-12


def test_attribution_makes_no_row_a_step(spark, parts, fitted):
    values = models.shapley_attribution(fitted["classifier"], parts[1], parts[0], ["ordinal"])
    plan = values._jdf.queryExecution().toString()
    assert "Generate" not in plan and "explode" not in plan
    assert models.shapley_attribution(fitted["classifier"], parts[1].where("false"), parts[0], ["ordinal"]).isEmpty()


def test_random_numbers_are_those_of_spark(spark):
    shift = spark._jvm.org.apache.spark.util.random.XORShiftRandom(-7)
    assert [starts.ShiftRandom(-7).integer()] == [shift.nextInt()]
    shift.setSeed(-7)
    assert starts.Uniforms([3, -7]).take(40_000)[1, :500].tolist() == [shift.nextDouble() for _ in range(500)]
    one, every = starts.ShiftRandom(3), starts.Uniforms([3])
    assert [one.double() for _ in range(40_000)] == [x for n in (1, 999, 39_000) for x in every.take(n)[0]]  # lanes and chunks go on where they ended
    java, mine = spark._jvm.java.util.Random(11), starts.JavaRandom(11)
    assert [mine.integer(), mine.long(), mine.double(), mine.below(7), mine.below(8)] == [java.nextInt(), java.nextLong(), java.nextDouble(), java.nextInt(7), java.nextInt(8)]


@pytest.mark.parametrize("rows, tasks", [(3000, 3), (9, 3), (1, 2)])
def test_first_centres_are_those_of_spark(spark, monkeypatch, rows, tasks):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, 3)) + 3 * rng.integers(0, 4, size=(rows, 1))
    vectors = spark.createDataFrame(spark.sparkContext.parallelize([(Vectors.dense(r),) for r in x], tasks), ["features"]).persist()
    turns = [(k, 42 + i) for k in (2, 4) for i in range(2)]
    expected = [np.array(models.KMeans(k=k, seed=seed, maxIter=0).fit(vectors).clusterCenters()) for k, seed in turns]
    monkeypatch.setattr(models.KMeans, "_fit", lambda *_: pytest.fail("a pass of its own"))
    for want, got in zip(expected, starts.first_centres(models._packed(vectors), 3, turns), strict=True):
        assert got == pytest.approx(want)
    vectors.unpersist()


def test_first_centres_take_eight_passes_for_all_starts(spark, signal, monkeypatch):
    vectors = models.cluster_input(signal).select("features").persist()
    passes, collect = [], type(vectors).collect
    monkeypatch.setattr(type(vectors), "collect", lambda df: passes.append(df) or collect(df))
    starts.first_centres(models._packed(vectors), vectors.first()[0].size, [(k, i) for k in (2, 3, 5) for i in range(6)])
    assert len(passes) <= 8
    vectors.unpersist()
