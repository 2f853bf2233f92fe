"""Cleaning: keep-first, imputation, spike reset, gates. Rows are unique per (series_id, date_time) after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from flowgauge.constants import NO_HOLIDAY, RAIN_SPIKE_MM, ZERO_KELVIN
from flowgauge.functions.fields import celsius
from flowgauge.functions.ordered import exact_quantiles

KEYS = ["series_id", "date_time"]


def keep_first(df: DataFrame, keys: Sequence[str] = KEYS, order: str = "ordinal") -> DataFrame:
    """First record per key in input order.

    Spark limits each key to one row before the shuffle (WindowGroupLimit), so a key repeated
    very often costs one row per map task. Ties in the order are broken by the other columns.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    first = Window.partitionBy(*keys).orderBy(order, *rest)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def _month() -> Column:
    return F.coalesce(F.month("date_time"), F.lit(0))


def month_medians(df: DataFrame) -> DataFrame:
    """Median valid temperature per calendar month: at most 13 rows, month 0 standing for undated rows.

    The month is never NULL, so a join on it adds no filter below keep-first and both readers share its shuffle.
    """
    good = df.where(F.col("temp") != ZERO_KELVIN).withColumn("month_no", _month())
    q = exact_quantiles(good, F.col("temp"), [0.5], ["month_no"])
    return q.select("month_no", F.col("q")[0].alias("median_temp"))


def impute_zero_kelvin(df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Zero-Kelvin readings take the median of their month; other rows keep theirs."""
    medians = month_medians(df) if medians is None else medians
    bad = F.col("temp") == ZERO_KELVIN
    joined = df.withColumn("_month", _month()).join(
        F.broadcast(medians), F.col("_month") == F.col("month_no"), "left"  # <= 13 rows
    )
    median = F.when(F.col("date_time").isNotNull(), F.col("median_temp"))
    return joined.withColumn("temp", F.when(bad, median).otherwise(F.col("temp"))).select(*df.columns)


def is_rain_spike() -> Column:
    return F.col("rain_1h") > RAIN_SPIKE_MM


def reset_rain_spikes(df: DataFrame) -> DataFrame:
    return df.withColumn("rain_1h", F.when(is_rain_spike(), 0.0).otherwise(F.col("rain_1h")))


def fill_holiday(df: DataFrame) -> DataFrame:
    return df.withColumn("holiday", F.coalesce("holiday", F.lit(NO_HOLIDAY)))


def zero_volume_rows(df: DataFrame) -> DataFrame:
    """Rows reported, never removed."""
    return df.where(F.col("traffic_volume") == 0).select("series_id", "date_time", "ordinal")


def cleaning_counts() -> list[Column]:
    """Metrics of the de-duplicated frame, gathered while another job writes it."""
    return [
        F.count(F.lit(1)).alias("kept"),
        F.count_if(F.col("temp") == ZERO_KELVIN).alias("zero_kelvin"),
        F.count_if(is_rain_spike()).alias("rain_spikes"),
        F.max("rain_1h").alias("max_rain"),
        F.count_if(F.col("traffic_volume") == 0).alias("zero_volume"),
        F.count_if(F.col("holiday").isNull()).alias("null_holiday"),
    ]


def clean(raw: DataFrame, watch: Observation | None = None) -> DataFrame:
    """The whole chain. With ``watch`` the stage counts arrive with the first action, at no extra pass."""
    kept = keep_first(raw)
    medians = month_medians(kept)
    if watch is not None:
        kept = kept.observe(watch, *cleaning_counts())
    return kept.transform(impute_zero_kelvin, medians).transform(reset_rain_spikes).transform(fill_holiday)


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column, in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return one.select(F.inline(cells))


def quality_report(df: DataFrame) -> DataFrame:
    """One row: repeated keys, null cells, ranges.

    Grouping by the key first keeps memory flat: no task holds a set of keys.
    """
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    per_key = df.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(nulls).alias("null_cells"),
        F.min("temp").alias("lo"),
        F.max("temp").alias("hi"),
        F.max("rain_1h").alias("rain"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_keys"),
        F.coalesce(F.sum("null_cells"), F.lit(0)).alias("null_cells"),
        celsius(F.min("lo")).alias("min_temp_c"),
        celsius(F.max("hi")).alias("max_temp_c"),
        F.max("rain").alias("max_rain"),
    ).withColumn("passed", (F.col("repeated_keys") == 0) & (F.col("null_cells") == 0))


def quality_gate(df: DataFrame) -> DataFrame:
    """Raise unless keys are unique and no cell is null; otherwise the frame unchanged."""
    report = quality_report(df).first()
    if not report["passed"]:
        raise ValueError(
            f"quality gate failed: {report['repeated_keys']} repeated keys, {report['null_cells']} null cells"
        )
    return df
