import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowgauge.functions.fields import graded, risk_of_ratio
from flowgauge.functions.ordered import exact_quantiles, running_totals
from flowgauge.operators import metrics, profiles, rules, statistics
from flowgauge.plans.suite import holiday_list, run_named

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_describe(raw_frame):
    row = statistics.describe(raw_frame([{"traffic_volume": v} for v in (0, 1, 1, 2, 10)])).first()
    assert (row["median"], row["q3"], row["min"], row["max"], row["range"]) == (1.0, 2.0, 0, 10, 10)
    assert row["std"] == pytest.approx(4.086563, abs=1e-6)
    assert row["skew"] == pytest.approx(2.070463, abs=1e-6)


@few
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.integers(1, 30))
def test_quantiles_equal_linear_interpolation(spark, values, hot):
    values = values + [values[0]] * hot
    df = spark.createDataFrame([(v,) for v in values], "v double")
    q = exact_quantiles(df, F.col("v"), [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).first()["q"]
    assert q == pytest.approx(np.quantile(values, [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]), rel=1e-9, abs=1e-9)


def test_quantiles_by_key(spark):
    df = spark.createDataFrame([(k, float(v)) for k in "ab" for v in range(5 if k == "a" else 4)], "k string, v double")
    got = {r["k"]: r["q"] for r in exact_quantiles(df, F.col("v"), [0.5], ["k"]).collect()}
    assert got == {"a": [2.0], "b": [1.5]}


def test_running_totals_cross_slots(spark):
    rows = [(float(v), 1) for v in range(-2000, 2000, 7)]
    got = running_totals(spark.createDataFrame(rows, "value double, n long"), ["n"]).orderBy("value").collect()
    assert [r["before_n"] for r in got] == list(range(len(rows)))
    assert {r["all_n"] for r in got} == {len(rows)}


def test_odds_ratio_without_congested_clouds(raw_frame):
    rows = [{"weather_main": "Clear", "traffic_volume": v} for v in (6000, 100)]
    rows += [{"weather_main": "Clouds", "traffic_volume": 100}] * 2
    assert statistics.odds_ratio(raw_frame(rows)).first()["odds_ratio"] is None


def test_two_definitions_of_congestion(raw_frame):
    df = raw_frame([{"traffic_volume": v} for v in (5500, 5501, 1, 2)])
    assert statistics.probabilities(df).first()["n_congested"] == 1  # strictly above 5500


def test_rank_ties_share_a_rank(raw_frame):
    rows = [{"weather_main": w, "traffic_volume": v} for w, v in (("a", 5), ("b", 5), ("c", 3))]
    got = {r["weather_main"]: r["rank"] for r in profiles.weather_compare(raw_frame(rows)).collect()}
    assert got == {"a": 1, "b": 1, "c": 3}


def test_earliest_wins_ties_of_extremes(raw_frame):
    rows = [{"traffic_volume": v, "date_time": f"2024-01-01 0{h}:00:00"} for h, v in enumerate((7, 9, 9, 7))]
    best = profiles.extreme_groups(profiles.hourly_profile(raw_frame(rows)), "hour").first()
    assert (best["busiest_hour"], best["quietest_hour"]) == (1, 0)
    top = profiles.top_hours(raw_frame(rows), 2).orderBy("position").collect()
    assert [r["date_time"].hour for r in top] == [1, 2]


def test_year_average_is_mean_of_month_means(raw_frame):
    rows = [{"traffic_volume": v, "date_time": f"2024-0{m}-01 00:00:00"} for m, v in ((1, 10), (1, 30), (2, 50))]
    assert {r["year_avg"] for r in profiles.monthly_rhythm(raw_frame(rows)).collect()} == {35.0}


def test_year_over_year(raw_frame):
    rows = [{"traffic_volume": v, "date_time": f"{y}-05-01 00:00:00"} for y, v in ((2013, 100), (2014, 150), (2015, 120))]
    got = run_named("yoy_change", raw_frame(rows)).orderBy("year").collect()
    assert [(r["yoy_change"], r["yoy_pct_change"]) for r in got] == [(None, None), (50, 50.0), (-30, -20.0)]


def test_listed_day_without_rows(raw_frame):
    df = raw_frame([{}])
    row = run_named("holiday_temps", df, holiday_list(df, [("New Years Day", "2015-01-01")])).first()
    assert (row["hours_recorded"], row["avg_temp_c"], row["total_traffic"]) == (0, None, None)


def test_confusion_and_scores(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "y int, z int")
    row = metrics.classification_metrics(df, "y", "z").first()
    assert [row[c] for c in ("tn", "fp", "fn", "tp")] == [1, 1, 1, 1]
    assert [row[c] for c in ("accuracy", "precision", "recall", "f1")] == [0.5] * 4


def test_auc_with_ties_and_monotone_change(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.1), (1, 0.9)], "y int, p double")
    assert metrics.roc_auc(df, "y", "p").first()["auc"] == 0.875
    assert metrics.roc_auc(df.withColumn("p", F.exp("p") * 100), "y", "p").first()["auc"] == 0.875
    assert metrics.roc_auc(df.where("y = 1"), "y", "p").first()["auc"] is None


def test_missing_ratio_grades_low(spark):
    row = spark.range(1).select(
        risk_of_ratio(F.lit(None).cast("double")).alias("none"), graded(F.lit(0.8), (1.5, 0.8)).alias("edge"),
        risk_of_ratio(F.lit(1.5)).alias("high"),
    ).first()
    assert (row["none"], row["edge"], row["high"]) == ("LOW", "MODERATE", "HIGH")


def test_itemsets_equal_frequent_pattern_mining(spark, sf_dir):
    from pyspark.ml.fpm import FPGrowth

    from flowgauge.operators.features import transactions, with_items
    from flowgauge.plans.prepared import clean_rows

    trans = transactions(clean_rows(spark, sf_dir))
    ours = {(tuple(r["items"]), r["n"]) for r in rules.itemsets(trans).collect()}
    mined = FPGrowth(itemsCol="items", minSupport=0.05).fit(with_items(trans)).freqItemsets.collect()
    assert ours == {(tuple(sorted(r["items"])), r["freq"]) for r in mined}


def shared_shuffles(df):
    """Branches that read another one's shuffle again when the plan runs."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange")


def test_description_and_summary_share_a_shuffle(spark, raw_frame, tmp_path):
    from flowgauge.operators import profiles

    raw_frame([{"traffic_volume": v, "date_time": f"2024-01-01 {v % 24:02d}:00:00"} for v in (5, 9, 9, 14, 30)]).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert min(shared_shuffles(make(rows)) for make in (statistics.describe, profiles.summary)) >= 5
    got = profiles.summary(rows).first()
    assert (got["n"], got["min"], got["max"], got["mean"], got["median"], got["congested_n"]) == (5, 5, 30, 13.4, 9.0, 2)
    assert profiles.summary(rows.limit(0)).first()["n"] in (0, None)
    assert statistics.describe(rows.limit(0)).first()["n"] == 0
