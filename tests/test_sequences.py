from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowgauge.operators import sequences

START = datetime(2024, 1, 1)


@pytest.fixture
def series(spark):
    """A long series with gaps of many days beside a short one."""
    hours = [h for h in range(900) if not 100 < h < 500 and h % 7]
    rows = [(1, START + timedelta(hours=h), float(h)) for h in hours]
    rows += [(2, START + timedelta(hours=h), float(-h)) for h in range(26)]
    return spark.createDataFrame(rows, "series_id long, date_time timestamp, v double")


def by_time():
    return Window.partitionBy("series_id").orderBy("date_time")


@pytest.mark.parametrize("days", [1, 3, 30])
def test_lookback_equals_the_plain_window(series, days):
    ours = sequences.lookback_windows(series, ["v"], 24, chunk_days=days).select(
        "series_id", "date_time", F.flatten("window").alias("w"))
    plain = series.withColumn("w", F.collect_list("v").over(by_time().rowsBetween(-24, -1))).where("size(w) = 24").drop("v")
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()
    assert ours.where("series_id = 2").count() == 2


@pytest.mark.parametrize("days", [1, 30])
def test_previous_value_and_positions(series, days):
    ours = sequences.previous_value(series, "v", chunk_days=days).drop("v")
    plain = series.withColumn("previous", F.lag("v").over(by_time())).drop("v")
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()
    ours = sequences.row_positions(series, chunk_days=days)
    plain = series.withColumn("position", (F.row_number().over(by_time()) - 1).cast("long"))
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_null_value_is_not_skipped(spark):
    rows = [(1, START, 1.0), (1, START + timedelta(hours=1), None), (1, START + timedelta(days=40), 3.0)]
    df = spark.createDataFrame(rows, "series_id long, date_time timestamp, v double")
    got = sequences.previous_value(df, "v").orderBy("date_time").collect()
    assert [r["previous"] for r in got] == [None, 1.0, None]


def test_every_third_training_row(series):
    # hours 0 to 37 without multiples of 7 are 32 rows: positions 0 to 31
    got = sequences.every_nth(series, "2024-01-02T14:00:00", chunk_days=1).orderBy("date_time").collect()
    assert [r["position"] for r in got if r["series_id"] == 1] == [24, 27, 30]
