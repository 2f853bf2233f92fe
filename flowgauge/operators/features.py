"""Model features: calendar, cycles, flags, one-hot weather, congestion target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.constants import (
    CONGESTION_QUANTILE, FEATURES, HEAVY_RAIN_MM, HIGH_TRAFFIC, NO_HOLIDAY, NORMAL_TRAFFIC, SEVERE_WEATHER, WEATHER,
)
from flowgauge.functions import fields
from flowgauge.functions.ordered import quantile_scalar


def time_features(df: DataFrame) -> DataFrame:
    """``hour``, ``day_of_week`` (Monday = 0) and ``month`` with their cyclical encodings."""
    dated = df.withColumns({
        "hour": F.hour("date_time"),
        "day_of_week": F.weekday("date_time"),
        "month": F.month("date_time"),
    })
    return cyclic_features(dated)


def cyclic_features(df: DataFrame) -> DataFrame:
    columns = {}
    for prefix, source, period in (("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12)):
        columns[f"{prefix}_sin"], columns[f"{prefix}_cos"] = fields.cyclic(F.col(source), period)
    return df.withColumns(columns)


def holiday_dates(df: DataFrame) -> DataFrame:
    """Distinct dates with a holiday mark: at most one row per calendar day of the data."""
    return df.where(F.col("holiday") != NO_HOLIDAY).select(F.to_date("date_time").alias("holiday_date")).distinct()


def holiday_flag(df: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Every row of a marked date becomes a holiday row, not only the midnight one."""
    dates = holiday_dates(df) if dates is None else dates
    hit = F.broadcast(dates)  # bounded by calendar days, not by rows
    return (
        df.join(hit, F.to_date("date_time") == F.col("holiday_date"), "left")
        .withColumn("is_holiday", F.col("holiday_date").isNotNull().cast("int"))
        .drop("holiday_date")
    )


def simple_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_weekend": fields.is_weekend(F.col("day_of_week")).cast("int"),
        "is_rush_hour": fields.is_rush_hour(F.col("hour")).cast("int"),
    })


def calendar_flags(df: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    return holiday_flag(simple_flags(df), dates)


def weather_onehot(df: DataFrame) -> DataFrame:
    """A fixed set of 0/1 columns; an unknown category is 0 everywhere (see ``unknown_weather``)."""
    hot = {"weather_" + w: F.coalesce(F.col("weather_main") == w, F.lit(False)).cast("int") for w in WEATHER}
    return df.withColumns(hot)


def unknown_weather(df: DataFrame) -> DataFrame:
    """Rows whose category has no one-hot column."""
    return df.where(F.col("weather_main").isNull() | ~F.col("weather_main").isin(WEATHER))


def upper_quartile(df: DataFrame, approximate: bool = False) -> Column:
    return quantile_scalar(df, F.col("traffic_volume"), CONGESTION_QUANTILE, approximate)


def congestion_target(df: DataFrame, fit_on: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """1 for volumes at or above Q3.

    ``fit_on`` takes the threshold from other rows, such as those before a split date.
    """
    q3 = upper_quartile(df if fit_on is None else fit_on, approximate)
    return df.withColumn("congestion", (F.col("traffic_volume") >= q3).cast("int"))


def high_risk_label(df: DataFrame) -> DataFrame:
    severe = F.col("rain_1h") > HEAVY_RAIN_MM
    for w in SEVERE_WEATHER:
        severe = severe | (F.col("weather_" + w) == 1)
    return df.withColumn("high_risk", ((F.col("congestion") == 1) & severe).cast("int"))


def high_risk_share(df: DataFrame, split: str) -> DataFrame:
    """Positives and their share, overall and on each side of the split date."""
    part = F.when(F.col("date_time") < F.lit(split).cast("timestamp"), "train").otherwise("test")
    per_part = high_risk_label(df).groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("high_risk").alias("hits")
    )
    return (
        per_part.rollup("part")
        .agg(F.sum("n").alias("n"), F.sum("hits").alias("positives"))
        .select(
            F.coalesce("part", F.lit("all")).alias("part"), "n", "positives",
            (F.col("positives") / F.col("n")).alias("share"),
        )
    )


def model_features(df: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """The 27 inputs of the models, without the target."""
    return (
        df.withColumn("temp_c", fields.celsius(F.col("temp")))
        .transform(time_features)
        .transform(calendar_flags, dates)
        .transform(weather_onehot)
    )


def feature_table(clean: DataFrame, q3_from: DataFrame | None = None) -> DataFrame:
    """Key, measure, target and the 27 features; the four raw columns are dropped."""
    built = model_features(clean).transform(congestion_target, clean if q3_from is None else q3_from)
    return built.select("series_id", "ordinal", "date_time", "traffic_volume", "congestion", *FEATURES)


def scaling_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct (mean, population deviation) per column."""
    return df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns])


def _stats_struct(stats: DataFrame) -> Column:
    return stats.select(F.struct(*stats.columns)).scalar()


def _sd(stats: Column, name: str) -> Column:
    """A constant column is only centred, never divided by zero."""
    sd = stats[name]["sd"]
    return F.when(sd == 0, F.lit(1.0)).otherwise(sd)


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace columns by (x - mean) / population deviation, fitted on ``fit_on`` (default: all rows)."""
    s = _stats_struct(scaling_stats(df if fit_on is None else fit_on, columns))
    return df.withColumns({c: (F.col(c) - s[c]["mean"]) / _sd(s, c) for c in columns})


def unstandardize(df: DataFrame, columns: dict[str, str], fit_on: DataFrame) -> DataFrame:
    """Inverse of ``standardize``; ``columns`` maps a scaled column to the column it was scaled as."""
    s = _stats_struct(scaling_stats(fit_on, sorted(set(columns.values()))))
    return df.withColumns({c: F.col(c) * _sd(s, src) + s[src]["mean"] for c, src in columns.items()})


def transactions(clean: DataFrame) -> DataFrame:
    """One item per attribute: time of day, day type, weather and traffic level."""
    level = F.when(F.col("traffic_volume") >= upper_quartile(clean), HIGH_TRAFFIC).otherwise(NORMAL_TRAFFIC)
    return clean.select(
        "series_id",
        "date_time",
        fields.time_of_day(F.hour("date_time")).alias("time_of_day"),
        fields.day_type(F.weekday("date_time")).alias("day_type"),
        F.concat(F.lit("Weather_"), "weather_main").alias("weather"),
        level.alias("traffic_level"),
    )


def with_items(trans: DataFrame) -> DataFrame:
    return trans.withColumn("items", F.array("time_of_day", "day_type", "weather", "traffic_level"))
