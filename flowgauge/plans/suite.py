"""The catalog of ten named analysis queries over a raw observation table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.sources import tables

# year ranges are half-open on the raw column, so they reach the Parquet scan
SUITE = {
    "row_count": "SELECT count(*) AS rows_loaded FROM {traffic}",
    "date_range": "SELECT min(date_time) AS first_timestamp, max(date_time) AS last_timestamp FROM {traffic}",
    "sample_rows": "SELECT * FROM {traffic} ORDER BY date_time, series_id, ordinal LIMIT 5",
    "dup_check": """
        SELECT sum(n) AS total_rows, count(*) AS distinct_timestamps, sum(n) - count(*) AS duplicate_timestamps
        FROM (SELECT series_id, date_time, count(*) AS n FROM {traffic} GROUP BY series_id, date_time)""",
    "yearly_totals": """
        SELECT date_format(date_time, 'yyyy') AS year, count(*) AS hours_recorded, sum(traffic_volume) AS total_volume
        FROM {traffic}
        WHERE date_time >= make_date(:first_year, 1, 1) AND date_time < make_date(:last_year + 1, 1, 1)
        GROUP BY 1 ORDER BY 1""",
    "yoy_change": """
        WITH yearly AS (
          SELECT date_format(date_time, 'yyyy') AS year, sum(traffic_volume) AS total_volume
          FROM {traffic}
          WHERE date_time >= make_date(:first_year, 1, 1) AND date_time < make_date(:last_year + 1, 1, 1)
          GROUP BY 1),
        paired AS (SELECT *, lag(total_volume) OVER (ORDER BY year) AS previous FROM yearly)
        SELECT year, total_volume, total_volume - previous AS yoy_change,
               round(try_divide(100.0D * (total_volume - previous), previous), 1) AS yoy_pct_change
        FROM paired ORDER BY year""",
    "yearly_hourly_avg": """
        SELECT date_format(date_time, 'yyyy') AS year, count(*) AS hours_recorded,
               round(avg(traffic_volume), 1) AS avg_hourly_volume
        FROM {traffic}
        WHERE date_time >= make_date(:first_year, 1, 1) AND date_time < make_date(:last_year + 1, 1, 1)
        GROUP BY 1 ORDER BY 1""",
    # marked rows are few, and days per holiday fewer: one pass, counts per (holiday, day) first
    "holiday_counts": """
        SELECT holiday, sum(n) AS flagged_hours, count(*) AS distinct_days
        FROM (SELECT holiday, to_date(date_time) AS day, count(*) AS n FROM {traffic}
              WHERE holiday <> 'None' GROUP BY 1, 2)
        GROUP BY holiday ORDER BY holiday""",
    # the fact table is cut to half-open ranges of the listed days on its own column, which reach the scan, and reduced to
    # one row per day before the outer join, whose outer side could not be broadcast
    "holiday_temps": """
        WITH listed AS (SELECT holiday_name, holiday_date FROM {holidays}),
        day_facts AS (
          SELECT to_date(t.date_time) AS day, count(t.date_time) AS hours_recorded,
                 avg(t.temp - 273.15D) AS avg_c, min(t.temp - 273.15D) AS min_c, max(t.temp - 273.15D) AS max_c,
                 sum(t.traffic_volume) AS total_traffic
          FROM {traffic} t
          GROUP BY 1)
        SELECT l.holiday_name, l.holiday_date, coalesce(f.hours_recorded, 0) AS hours_recorded,
               round(f.avg_c, 1) AS avg_temp_c, round(f.min_c, 1) AS min_temp_c, round(f.max_c, 1) AS max_temp_c,
               f.total_traffic
        FROM listed l LEFT JOIN day_facts f ON f.day = l.holiday_date
        ORDER BY l.holiday_name, l.holiday_date""",
    # daily sums and the holiday mark come out of the same aggregation
    "holiday_vs_normal": """
        WITH daily AS (
          SELECT to_date(date_time) AS day, sum(traffic_volume) AS daily_volume,
                 coalesce(bool_or(holiday <> 'None'), false) AS marked
          FROM {traffic} GROUP BY 1)
        SELECT CASE WHEN marked THEN 'Holiday' ELSE 'Non-holiday' END AS day_type, count(*) AS days,
               round(avg(daily_volume), 0) AS avg_daily_volume
        FROM daily GROUP BY 1""",
}


def holiday_list(raw: DataFrame, rows: Sequence[tuple[str, str]]) -> DataFrame:
    """(name, ISO date) literals as a relation."""
    values = ", ".join(f"('{name}', DATE '{day}')" for name, day in rows)
    return raw.sparkSession.sql(f"SELECT * FROM VALUES {values} AS v(holiday_name, holiday_date)")


def on_days(listed: DataFrame) -> Column:
    """Hours of the listed days (a short literal relation) as ranges of date_time; neighbouring days are one range."""
    days = sorted({r["holiday_date"] for r in listed.select("holiday_date").collect()})
    ranges: list[list[date]] = []
    for day in days:
        if ranges and ranges[-1][1] == day:
            ranges[-1][1] = day + timedelta(1)
        else:
            ranges.append([day, day + timedelta(1)])
    inside = [(F.col("date_time") >= F.lit(str(lo))) & (F.col("date_time") < F.lit(str(hi))) for lo, hi in ranges]
    return reduce(Column.__or__, inside) if inside else F.lit(False)


def run_named(
    name: str, raw: DataFrame, holidays: DataFrame | None = None, first_year: int = 2012, last_year: int = 2017
) -> DataFrame:
    text, spark = SUITE[name], raw.sparkSession
    frames = {"traffic": raw}
    if "{holidays}" in text:
        frames = {"traffic": raw.where(on_days(holidays)), "holidays": holidays}
    args = {"first_year": first_year, "last_year": last_year} if ":first_year" in text else None
    return spark.sql(text, args=args, **frames)


def write_suite(results: dict[str, DataFrame], folder: str) -> DataFrame:
    """Store every result as a table of its own; returns (query_name, result_rows) read from them."""
    counts = []
    for name, result in results.items():
        result.write.mode("overwrite").parquet(f"{folder}/{name}")
        stored = result.sparkSession.read.parquet(f"{folder}/{name}")
        counts.append(stored.agg(F.count(F.lit(1)).alias("result_rows")).select(F.lit(name).alias("query_name"), "*"))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionAll(more)
    return out


def verify_load(raw: DataFrame, expected: int | None = None) -> DataFrame:
    """Rows, span and distinct keys in one row; ``as_expected`` is NULL without an expectation."""
    per_key = raw.groupBy("series_id", "date_time").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("row_count"), F.min("date_time").alias("first_timestamp"),
        F.max("date_time").alias("last_timestamp"), F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("as_expected", F.lit(None).cast("boolean") if expected is None else F.col("row_count") == expected)


def store_as_results(stats: DataFrame, analysis: str, metrics: Sequence[str], folder: str, run: str | None = None) -> DataFrame:
    tables.append_results(tables.long_results(stats, analysis, metrics), folder, run)
    return stats.sparkSession.read.parquet(folder)
