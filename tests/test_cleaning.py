
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flowgauge.operators import cleaning, features
from flowgauge.sources.views import observations


def values(df, column, order="ordinal"):
    return [r[column] for r in df.orderBy(order).collect()]


def test_keep_first_by_input_order_and_idempotent(raw_frame):
    df = raw_frame([
        {"ordinal": 2, "weather_main": "Rain"}, {"ordinal": 1, "weather_main": "Clear"},
        {"ordinal": 3, "date_time": "2024-01-01 01:00:00"}, {"ordinal": 4, "date_time": "2024-01-01 02:00:00"},
    ])
    once = cleaning.keep_first(df)
    assert values(once, "ordinal") == [1, 3, 4]
    assert values(cleaning.keep_first(once), "weather_main") == values(once, "weather_main")


def test_hot_key_is_cut_before_the_shuffle(raw_frame):
    plan = cleaning.keep_first(raw_frame([{}, {}]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_zero_kelvin_takes_month_median(raw_frame):
    df = raw_frame([
        {"temp": 270.0}, {"temp": 272.0}, {"temp": 0.0},
        {"temp": 280.0, "date_time": "2024-02-01 00:00:00"}, {"temp": 0.0, "date_time": "2024-02-01 01:00:00"},
    ])
    assert values(cleaning.impute_zero_kelvin(df), "temp") == [270.0, 272.0, 271.0, 280.0, 280.0]


def test_rain_spike_bound_is_strict(raw_frame):
    df = raw_frame([{"rain_1h": 100.0}, {"rain_1h": 100.1}, {"rain_1h": 9831.3}])
    assert values(cleaning.reset_rain_spikes(df), "rain_1h") == [100.0, 0.0, 0.0]


def test_none_text_and_null(raw_frame):
    df = raw_frame([{"holiday": "None"}, {"holiday": None}, {"holiday": "Labor Day"}])
    assert df.where(F.col("holiday") != "None").count() == 1
    assert values(cleaning.fill_holiday(df), "holiday") == ["None", "None", "Labor Day"]


def test_zero_volume_is_reported_and_kept(raw_frame):
    df = raw_frame([{"traffic_volume": 0}, {"date_time": "2024-01-01 01:00:00"}])
    assert values(cleaning.zero_volume_rows(df), "ordinal") == [0]
    assert cleaning.clean(df).count() == 2


def test_gate(raw_frame):
    good = raw_frame([{}, {"date_time": "2024-01-01 01:00:00"}])
    assert cleaning.quality_gate(good) is good
    with pytest.raises(ValueError, match="1 repeated keys"):
        cleaning.quality_gate(raw_frame([{}, {}]))
    with pytest.raises(ValueError, match="1 null cells"):
        cleaning.quality_gate(raw_frame([{"temp": None}]))


def test_stage_counts_come_with_the_write(raw_frame, tmp_path):
    watch = Observation()
    df = raw_frame([
        {"rain_1h": 200.0}, {"rain_1h": 300.0}, {"temp": 0.0, "date_time": "2024-01-01 01:00:00"},
        {"holiday": None, "traffic_volume": 0, "date_time": "2024-01-01 02:00:00"},
    ])
    cleaning.clean(df, watch).write.parquet(str(tmp_path / "clean"))
    assert watch.get == {
        "kept": 3, "zero_kelvin": 1, "rain_spikes": 1, "max_rain": 200.0, "zero_volume": 1, "null_holiday": 1,
    }


def test_holiday_covers_the_whole_date(raw_frame):
    rows = [{"date_time": f"2024-01-01 {h:02d}:00:00", "holiday": "New Years Day" if h == 0 else "None"} for h in range(24)]
    rows += [{"date_time": f"2024-01-02 {h:02d}:00:00"} for h in range(2)]
    flagged = features.holiday_flag(raw_frame(rows))
    assert flagged.agg(F.sum("is_holiday")).first()[0] == 24


def test_feature_table_is_complete(raw_frame):
    table = features.feature_table(raw_frame([{"traffic_volume": v, "date_time": f"2024-01-01 0{v}:00:00"} for v in range(8)]))
    nulls = cleaning.null_counts(table).agg(F.sum("nulls")).first()[0]
    assert nulls == 0 and len(table.columns) == 5 + 27
    assert [r["congestion"] for r in table.orderBy("date_time").collect()] == [0] * 6 + [1] * 2  # Q3 = 5.25


def test_monday_is_zero(raw_frame):
    row = features.time_features(raw_frame([{"date_time": "2024-01-01 06:00:00"}])).first()
    assert (row["day_of_week"], row["month"], row["hour"]) == (0, 1, 6)
    assert row["hour_sin"] == pytest.approx(1.0)


def test_standardize_uses_population_deviation_and_inverts(spark):
    df = spark.createDataFrame([(float(v), 3.0) for v in (0, 1, 1, 2, 10)], "v double, c double")
    scaled = features.standardize(df, ["v", "c"])
    spread = scaled.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.max("c").alias("c")).first()
    assert (spread["m"], spread["s"], spread["c"]) == (pytest.approx(0.0), pytest.approx(1.0), 0.0)
    back = features.unstandardize(scaled, {"v": "v"}, fit_on=df)
    assert sorted(r["v"] for r in back.collect()) == pytest.approx([0, 1, 1, 2, 10])


def test_clean_chain_reads_the_raw_table_once(spark, sf_dir):
    chain = cleaning.clean(observations(spark, sf_dir))
    chain.collect()
    final = chain._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
