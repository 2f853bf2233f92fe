"""Observation views over the star-schema tables (``events``, ``orders``).

Both carry the raw columns plus ``series_id`` and ``ordinal``, with the quirks of real sensor
files: repeated hours, zero-Kelvin readings, rain spikes, holidays marked at midnight only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OBS_COLUMNS = [
    "series_id", "ordinal", "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
    "weather_main", "weather_description", "date_time", "traffic_volume",
]

EVENT_WEATHER = {"view": "Clear", "click": "Clouds", "purchase": "Mist", "signup": "Snow", "error": "Rain"}
EVENT_HOLIDAYS = {"2024-01-01": "New Years Day", "2024-01-15": "Martin Luther King Jr Day"}
HISTORY_HOLIDAYS = {"01-01": "New Years Day", "07-04": "Independence Day", "12-25": "Christmas Day"}


def _mapped(value: Column, names: dict[str, str], otherwise: Column | None = None) -> Column:
    chain = None
    for key, name in names.items():
        chain = F.when(value == key, name) if chain is None else chain.when(value == key, name)
    return chain if otherwise is None else chain.otherwise(otherwise)


def event_columns() -> dict[str, Column]:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    kind = F.col("event_type")
    hour = F.date_trunc("hour", F.col("ts"))
    midnight = F.hour("ts") == 0
    return {
        "series_id": F.col("user_id"),
        "ordinal": F.col("event_id"),
        "holiday": F.when(midnight, _mapped(F.date_format("ts", "yyyy-MM-dd"), EVENT_HOLIDAYS, F.lit("None")))
        .otherwise("None"),
        "temp": F.when(k == 0, 0.0).otherwise(F.lit(250.0) + F.lit(0.5) * k),
        "rain_1h": F.when(kind == "error", F.col("value")).otherwise(0.0),
        "snow_1h": F.when(kind == "signup", (F.col("user_id") % 10) / F.lit(10.0)).otherwise(0.0),
        "clouds_all": k,
        "weather_main": _mapped(kind, EVENT_WEATHER),
        "weather_description": kind,
        "date_time": hour,
        "traffic_volume": F.round(F.col("value") * 100).cast("long"),
    }


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: the raw observation table."""
    columns = event_columns()
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*[columns[c].alias(c) for c in OBS_COLUMNS])


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: a multi-year raw observation table with ten sensors.

    ``date_time`` is the untouched table column, so year ranges reach the Parquet scan.
    """
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        (F.col("o_custkey") % 10).alias("series_id"),
        F.col("o_orderkey").alias("ordinal"),
        _mapped(F.date_format("o_orderdate", "MM-dd"), HISTORY_HOLIDAYS, F.lit("None")).alias("holiday"),
        F.when(F.col("o_orderkey") % 97 == 0, 0.0)
        .otherwise(F.lit(250.0) + (F.col("o_custkey") % 600) / F.lit(10.0))
        .alias("temp"),
        F.lit(0.0).alias("rain_1h"),
        F.lit(0.0).alias("snow_1h"),
        (F.col("o_orderkey") % 101).cast("int").alias("clouds_all"),
        F.col("o_orderpriority").alias("weather_main"),
        F.col("o_orderstatus").alias("weather_description"),
        F.col("o_orderdate").alias("date_time"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("traffic_volume"),
    )


def score_requests_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per event; a share of them breaks each rule."""
    return requests_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def requests_from_events(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    event = F.col("event_id")
    return events.select(
        event.alias("request_id"),
        F.when(event % 53 != 0, (event % 25).cast("int")).alias("hour"),
        (event % 29 % 8).cast("int").alias("day_of_week"),
        (event % 31 % 13).cast("int").alias("month"),
        F.when(event % 41 != 0, k * F.lit(0.5) - F.lit(20.0)).alias("temp_c"),
        F.when(F.col("event_type") == "error", F.col("value") - F.lit(0.5)).alias("rain_1h"),
        F.when(F.col("event_type") == "signup", (F.col("user_id") % 10) / F.lit(10.0)).alias("snow_1h"),
        F.when(event % 7 != 0, (k + event % 4).cast("double")).alias("clouds_all"),
        F.when(event % 37 == 0, "banana").when(event % 5 != 0, _mapped(F.col("event_type"), EVENT_WEATHER))
        .alias("weather_main"),
        F.when(event % 11 == 0, True).when(event % 3 == 0, False).alias("is_holiday"),
    )
