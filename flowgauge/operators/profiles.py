"""Hourly, weekly, monthly and weather profiles, rankings and extremes.

Means are reduced to one row per group before any ranking, so the unpartitioned windows below
see at most 24 hours, 12 months or the weather categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.constants import CONGESTION_QUANTILE, SMALL_SAMPLE
from flowgauge.functions.fields import is_weekend, same_text
from flowgauge.functions.ordered import quantiles_of_counts
from flowgauge.operators.statistics import moments



def _mean() -> Column:
    return F.avg("traffic_volume").alias("avg_volume")


def hourly_profile(df: DataFrame) -> DataFrame:
    return df.groupBy(F.hour("date_time").alias("hour")).agg(_mean())


def extreme_groups(means: DataFrame, key: str) -> DataFrame:
    """Busiest and quietest group; the smallest key wins a tie."""
    return means.agg(
        F.max(F.struct("avg_volume", (-F.col(key)).alias("k"))).alias("hi"),
        F.min(F.struct("avg_volume", F.col(key).alias("k"))).alias("lo"),
    ).select(
        (-F.col("hi.k")).alias(f"busiest_{key}"), F.col("hi.avg_volume").alias("busiest_avg"),
        F.col("lo.k").alias(f"quietest_{key}"), F.col("lo.avg_volume").alias("quietest_avg"),
    )


def hourly_by_daytype(df: DataFrame) -> DataFrame:
    """Mean by (weekend, hour), with each day type's peak hour marked."""
    means = df.groupBy(
        is_weekend(F.weekday("date_time")).cast("int").alias("is_weekend"), F.hour("date_time").alias("hour")
    ).agg(_mean())
    first = Window.partitionBy("is_weekend").orderBy(F.desc("avg_volume"), "hour")  # 24 rows
    return means.withColumn("is_peak", F.row_number().over(first) == 1)


def dow_hour_cells(df: DataFrame) -> DataFrame:
    return df.groupBy(F.weekday("date_time").alias("day_of_week"), F.hour("date_time").alias("hour")).agg(_mean())


def dow_hour_pivot(df: DataFrame) -> DataFrame:
    """Seven rows, one column per hour; explicit values, so no extra job to find them."""
    labelled = df.select(
        F.weekday("date_time").alias("day_of_week"),
        F.format_string("h%02d", F.hour("date_time")).alias("_hour"),
        "traffic_volume",
    )
    return labelled.groupBy("day_of_week").pivot("_hour", [f"h{h:02d}" for h in range(24)]).agg(F.avg("traffic_volume"))


def busiest_cell(df: DataFrame) -> DataFrame:
    best = F.max(F.struct("avg_volume", (-F.col("day_of_week")).alias("d"), (-F.col("hour")).alias("h"))).alias("b")
    return dow_hour_cells(df).agg(best).select(
        (-F.col("b.d")).alias("day_of_week"), (-F.col("b.h")).alias("hour"), F.col("b.avg_volume").alias("avg_volume")
    )


def weather_impact(df: DataFrame) -> DataFrame:
    """Mean and rows per condition; ``well_sampled`` marks the groups with more than 100 rows."""
    return df.groupBy("weather_main").agg(_mean(), F.count(F.lit(1)).alias("n")).withColumn(
        "well_sampled", F.col("n") > SMALL_SAMPLE
    )


def lowest_well_sampled(df: DataFrame) -> DataFrame:
    return weather_impact(df).where("well_sampled").orderBy("avg_volume", "weather_main").limit(1)


def monthly_rhythm(df: DataFrame) -> DataFrame:
    """Mean per month beside the mean of the monthly means and the extreme months."""
    monthly = df.groupBy(F.month("date_time").alias("month")).agg(_mean())
    every = Window.partitionBy()  # <= 12 rows
    hi = F.max(F.struct("avg_volume", (-F.col("month")).alias("k"))).over(every)
    lo = F.min(F.struct("avg_volume", F.col("month").alias("k"))).over(every)
    return monthly.select(
        "month", "avg_volume",
        F.avg("avg_volume").over(every).alias("year_avg"),
        (-hi["k"]).alias("highest_month"), lo["k"].alias("lowest_month"),
    )


def summary(df: DataFrame) -> DataFrame:
    """One row: size, span, centre, congestion share and extreme hours.

    The rows are read once, into counts of (hour, volume); volumes and hours are summed from that one shuffle.
    """
    v, n = F.col("traffic_volume"), F.col("n")
    cells = df.groupBy(F.hour("date_time").alias("hour"), "traffic_volume").agg(
        F.count(F.lit(1)).alias("n"), F.min("date_time").alias("first_hour"), F.max("date_time").alias("last_hour")
    )
    counts = cells.where(v.isNotNull()).groupBy(v.cast("double").alias("value")).agg(F.sum("n").alias("n"))
    q = quantiles_of_counts(counts, [0.5, CONGESTION_QUANTILE]).select("q").scalar()
    centre = moments(counts).select(F.struct("mean", "std")).scalar()
    hours = cells.groupBy("hour").agg(
        F.sum("n").alias("n"), F.sum(F.when(v >= q[1], n).otherwise(0)).alias("congested_n"), F.min("first_hour").alias("first_hour"),
        F.max("last_hour").alias("last_hour"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.try_divide(F.sum(v * n), F.sum(F.when(v.isNotNull(), n))).alias("avg_volume"),
    )
    base = hours.agg(  # 24 rows
        F.sum("n").alias("n"), F.min("first_hour").alias("first_hour"), F.max("last_hour").alias("last_hour"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.sum("congested_n").alias("congested_n"),
    )
    extremes = extreme_groups(hours.select("hour", "avg_volume"), "hour")
    best = extremes.select(F.struct("busiest_hour", "busiest_avg", "quietest_hour", "quietest_avg")).scalar()
    return base.withColumns({
        "mean": centre["mean"], "std": centre["std"], "median": q[0], "q3": q[1],
        "congested_pct": F.try_divide(F.lit(100.0) * F.col("congested_n"), F.col("n")), "_x": best,
    }).select("*", "_x.*").drop("_x")


def weather_compare(df: DataFrame, condition: str | None = None) -> DataFrame:
    """Each condition against the overall mean; ``condition`` matches without regard to case."""
    groups = df.groupBy("weather_main").agg(
        F.count(F.lit(1)).alias("n"), F.sum("traffic_volume").alias("_sum"), _mean()
    )
    every = Window.partitionBy()  # one row per weather category
    overall = F.sum("_sum").over(every) / F.sum("n").over(every)
    ranked = groups.select(
        "weather_main", "n", "avg_volume", overall.alias("overall_avg"),
        F.rank().over(Window.orderBy(F.desc("avg_volume"))).alias("rank"),
        F.count(F.lit(1)).over(every).alias("conditions"),
        (F.col("n") < SMALL_SAMPLE).alias("small_sample"),
    ).withColumns({
        "diff": F.col("avg_volume") - F.col("overall_avg"),
        "diff_pct": (F.col("avg_volume") / F.col("overall_avg") - 1) * 100,
    })
    return ranked if condition is None else ranked.where(same_text(F.col("weather_main"), condition))


def weather_choices(df: DataFrame) -> DataFrame:
    """What to offer when a condition is unknown."""
    return df.select("weather_main").distinct().orderBy("weather_main")


def top_hours(df: DataFrame, n: int = 10) -> DataFrame:
    """The n largest volumes, earliest first on ties, numbered."""
    best = df.orderBy(F.desc("traffic_volume"), "date_time", "series_id").limit(n)
    order = Window.orderBy(F.desc("traffic_volume"), "date_time", "series_id")  # n rows
    return best.select(
        F.row_number().over(order).alias("position"), "series_id", "date_time", "traffic_volume", "weather_main"
    )


def quietest_hours(df: DataFrame, weekend: bool, n: int = 3) -> DataFrame:
    days = df.where(is_weekend(F.weekday("date_time")) == F.lit(weekend))
    return hourly_profile(days).orderBy("avg_volume", "hour").limit(n)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.orderBy("date_time", "series_id", "ordinal").limit(n)
