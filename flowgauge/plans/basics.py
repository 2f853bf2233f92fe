"""Sources, sinks, projections, filters and field functions as queries."""

from pyspark.sql import functions as F

from flowgauge.constants import CONGESTION_THRESHOLD, HOT_KELVIN, KELVIN_OFFSET
from flowgauge.functions import fields
from flowgauge.operators import cleaning, drift, models, profiles, statistics
from flowgauge.plans import prepared
from flowgauge.plans.checks import CLEAN, FEAT, HIST, OBS, STAMP, TRAIN, cleaned, time_of_day
from flowgauge.plans.prepared import SPLIT, clean_rows, feature_rows, place
from flowgauge.plans.registry import query
from flowgauge.plans.suite import SUITE, holiday_list, run_named, store_as_results, verify_load, write_suite
from flowgauge.sources import raw, tables
from flowgauge.sources.views import OBS_COLUMNS, history, observations

ALL_COLUMNS = ", ".join(c if c != "date_time" else STAMP for c in OBS_COLUMNS)
MEASURES = ["temp", "rain_1h", "snow_1h"]
HOLIDAY_DAYS = [
    ("New Years Day", "2024-01-01"), ("Martin Luther King Jr Day", "2024-01-15"), ("Washingtons Birthday", "2024-02-19"),
    ("New Years Day", "2023-01-01"), ("Labor Day", "2024-09-02"), ("Christmas Day", "2023-12-25"),
]
FIRST_YEAR, LAST_YEAR = 1995, 2000


# --- sources and sinks ------------------------------------------------------------------------

# cells that do not parse, as sensors and hands spoil them: column -> (every n-th row, its text)
SPOILED = {"temp": (41, "n/a"), "date_time": (43, "yesterday"), "traffic_volume": (47, "12x"), "clouds_all": (53, "many")}


def _csv(spark, sf_dir):
    """The observations as CSV files with a header; some cells hold what is no value of their type."""
    def build(path):
        rows = observations(spark, sf_dir).withColumn("date_time", fields.clock(F.col("date_time")))
        cells = {c: F.when(F.col("ordinal") % n == 0, text).otherwise(F.col(c).cast("string")) for c, (n, text) in SPOILED.items()}
        rows.withColumns(cells).write.mode("overwrite").option("header", True).csv(path)

    return prepared.once(place(spark, sf_dir, "csv"), build)


def _split(spark, sf_dir):
    return raw.split_scan(spark, _csv(spark, sf_dir), place(spark, sf_dir, "scanned"))


_BAD = {c: f"ordinal % {n} = 0" for c, (n, _) in SPOILED.items()}
_SPOILED = f"""{OBS}, marked AS (SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {_BAD[c]} THEN '{c}' END" for c in raw.RAW_TYPES if c in _BAD)}) AS rejected FROM obs)"""


@query("scan_raw", f"WITH {_SPOILED} SELECT {ALL_COLUMNS} FROM marked WHERE rejected = ''", MEASURES)
def scan_raw(spark, sf_dir):
    """The side of the scan whose cells all parse."""
    return _split(spark, sf_dir)[0].select(*OBS_COLUMNS)


_CELLS = ", ".join(f"CASE WHEN {_BAD[c]} THEN '{text}' END AS {c}_cell" for c, (_, text) in SPOILED.items())


@query("scan_refused", f"""WITH {_SPOILED} SELECT series_id, ordinal, rejected, weather_description, {_CELLS} FROM marked WHERE rejected <> ''""")
def scan_refused(spark, sf_dir):
    """The other side of the same scan: why each row was refused, and the text that did not parse."""
    cells = [F.when(F.array_contains("rejected", c), F.col("cells")[c]).alias(f"{c}_cell") for c in SPOILED]
    return _split(spark, sf_dir)[1].select("series_id", "ordinal", F.array_join("rejected", ",").alias("rejected"), "weather_description", *cells)


@query("scan_counts", f"""WITH {_SPOILED} SELECT count(*) AS read, count(*) FILTER (rejected = '') AS accepted, count(*) FILTER (rejected <> '') AS refused,
{', '.join(f"count(*) FILTER ({b}) AS {c}_refused" for c, b in _BAD.items())}, 0 AS torn_lines FROM marked""")
def scan_counts(spark, sf_dir):
    """What the write of both sides has counted."""
    counts = _split(spark, sf_dir)[2]
    names = {"read": "read", "accepted": "accepted", "refused": "refused", **{c: f"{c}_refused" for c in SPOILED}, raw.LINE: "torn_lines"}
    return spark.range(1).select(*[F.lit(counts[k]).alias(n) for k, n in names.items()])


@query("schema_check", f"""WITH {OBS} """ + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NOT NULL AND NOT ({_BAD.get(c, 'false')})) AS parsed,
count(*) FILTER ({c} IS NULL AND NOT ({_BAD.get(c, 'false')})) AS empty, count(*) FILTER ({_BAD.get(c, 'false')}) AS rejected FROM obs"""
    for c in raw.RAW_TYPES))
def schema_check(spark, sf_dir):
    return raw.schema_report(raw.read_text(spark, _csv(spark, sf_dir)))


@query("table_replace", "SELECT 'traffic' AS table_name, count(*) AS rows_written, count(*) AS rows_read FROM events")
def table_replace(spark, sf_dir):
    path = place(spark, sf_dir, "traffic")
    source = observations(spark, sf_dir)
    tables.replace_table(source, "flowgauge_traffic", path)
    written = tables.replace_table(source, "flowgauge_traffic", path)  # a reload gives the same table
    return spark.table("flowgauge_traffic").agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit("traffic").alias("table_name"), F.lit(written).cast("long").alias("rows_written"), "rows_read"
    )


@query("verify_load", f"""WITH {OBS}
SELECT count(*) AS row_count, strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS first_timestamp,
       strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS last_timestamp,
       count(DISTINCT (series_id, date_time)) AS distinct_keys, true AS as_expected FROM obs WHERE NOT ({' OR '.join(_BAD.values())})""")
def load_check(spark, sf_dir):
    """The accepted rows read back, held against the number that the scan wrote."""
    accepted, _, counts = _split(spark, sf_dir)
    return verify_load(accepted, expected=counts["accepted"])


@query("write_clean", f"""WITH {CLEAN}
SELECT year(date_time) AS year, month(date_time) AS month, count(*) AS n, CAST(sum(traffic_volume) AS BIGINT) AS volume
FROM clean GROUP BY 1, 2""")
def write_clean(spark, sf_dir):
    path = place(spark, sf_dir, "clean_copy")
    tables.write_by_month(clean_rows(spark, sf_dir), path)
    return tables.read_by_month(spark, path).groupBy("year", F.col("month_part").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("traffic_volume").alias("volume")
    )


@query("write_features", f"""WITH {FEAT}
SELECT congestion, count(*) AS n, CAST(sum(traffic_volume) AS BIGINT) AS volume, CAST(sum(is_holiday) AS BIGINT) AS holiday_rows
FROM feat GROUP BY 1""")
def write_features(spark, sf_dir):
    path = place(spark, sf_dir, "features_copy")
    tables.write_by_month(feature_rows(spark, sf_dir), path)
    return tables.read_by_month(spark, path).groupBy("congestion").agg(
        F.count(F.lit(1)).alias("n"), F.sum("traffic_volume").alias("volume"), F.sum("is_holiday").alias("holiday_rows")
    )


@query("read_processed", f"WITH {CLEAN} SELECT {ALL_COLUMNS} FROM clean", MEASURES)
def read_processed(spark, sf_dir):
    schema = observations(spark, sf_dir).schema
    clean_rows(spark, sf_dir)
    return tables.read_by_month(spark, place(spark, sf_dir, "clean"), schema).select(*OBS_COLUMNS)


def suite_results(spark, sf_dir):
    """Multi-year queries on the long history, the others on the observations."""
    obs, hist = observations(spark, sf_dir), history(spark, sf_dir)
    days = holiday_list(obs, HOLIDAY_DAYS)
    return {
        name: run_named(name, hist if ":first_year" in text else obs, days, FIRST_YEAR, LAST_YEAR)
        for name, text in SUITE.items()
    }


@query("query_suite", f"""WITH {OBS} SELECT * FROM (VALUES ('row_count', 1), ('date_range', 1), ('sample_rows', 5),
  ('dup_check', 1), ('holiday_temps', 6)) AS fixed(query_name, result_rows)
UNION ALL SELECT n, c FROM (VALUES ('yearly_totals'), ('yoy_change'), ('yearly_hourly_avg')) AS v(n),
  (SELECT count(DISTINCT year(o_orderdate)) AS c FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')
UNION ALL SELECT 'holiday_counts', count(DISTINCT holiday) FROM obs WHERE holiday <> 'None'
UNION ALL SELECT 'holiday_vs_normal', 1 + CAST(count(DISTINCT holiday) > 0 AS BIGINT) FROM obs WHERE holiday <> 'None'""")
def query_suite(spark, sf_dir):
    return write_suite(suite_results(spark, sf_dir), place(spark, sf_dir, "suite"))


@query("result_tables", f"""WITH {OBS}, s AS (SELECT avg(traffic_volume) AS mean, stddev_samp(traffic_volume) AS std FROM obs)
SELECT run, 'describe' AS analysis, metric, 'all' AS "group", value FROM (VALUES ('first'), ('second')) AS r(run),
  (SELECT 'mean' AS metric, mean AS value FROM s UNION ALL SELECT 'std', std FROM s)""", ["value"], 3)
def result_tables(spark, sf_dir):
    """Two runs, the second of them written twice: one set of results each."""
    stats = statistics.describe(observations(spark, sf_dir))
    folder = place(spark, sf_dir, "results")
    for run in ("first", "second", "second"):
        store_as_results(stats, "describe", ["mean", "std"], folder, run)
    return spark.read.parquet(folder).select("run", *tables.RESULT_COLUMNS)


# --- filters and projections ------------------------------------------------------------------

@query("year_filter", f"""WITH {HIST} SELECT series_id, ordinal, {STAMP}, traffic_volume FROM hist
WHERE year(date_time) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}""")
def year_filter(spark, sf_dir):
    start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (FIRST_YEAR, LAST_YEAR + 1))
    hist = history(spark, sf_dir)
    inside = (F.col("date_time") >= start) & (F.col("date_time") < end)
    return hist.where(inside).select("series_id", "ordinal", "date_time", "traffic_volume")


@query("holiday_rows", f"WITH {OBS} SELECT series_id, ordinal, holiday, {STAMP} FROM obs WHERE holiday <> 'None'")
def holiday_rows(spark, sf_dir):
    return observations(spark, sf_dir).where(F.col("holiday") != "None").select(
        "series_id", "ordinal", "holiday", "date_time")


@query("case_label", f"""WITH {OBS} SELECT ordinal, CASE WHEN holiday <> 'None' THEN 'Holiday' ELSE 'Non-holiday' END AS day_type
FROM obs""")
def case_label(spark, sf_dir):
    return observations(spark, sf_dir).select(
        "ordinal", F.when(F.col("holiday") != "None", "Holiday").otherwise("Non-holiday").alias("day_type"))


@query("kelvin_to_c", f"WITH {OBS} SELECT ordinal, temp - {KELVIN_OFFSET}::DOUBLE AS temp_c FROM obs", ["temp_c"])
def kelvin_to_c(spark, sf_dir):
    return observations(spark, sf_dir).select("ordinal", fields.celsius(F.col("temp")).alias("temp_c"))


@query("threshold_flags", f"""WITH {OBS} SELECT ordinal, traffic_volume > {CONGESTION_THRESHOLD} AS congested,
temp > {HOT_KELVIN} AS hot, weather_main = 'Clear' AS clear, weather_main = 'Clouds' AS cloudy FROM obs""")
def threshold_flags(spark, sf_dir):
    return statistics.threshold_flags(observations(spark, sf_dir)).select("ordinal", "congested", "hot", "clear", "cloudy")


@query("conjunction_mask", f"""WITH {FEAT}
SELECT series_id, {STAMP}, traffic_volume FROM feat
WHERE congestion = 1 AND (rain_1h > 5 OR weather_Snow = 1) AND day_of_week < 5 AND hour BETWEEN 6 AND 18""")
def conjunction_mask(spark, sf_dir):
    c = F.col
    severe = (c("rain_1h") > 5) | (c("weather_Snow") == 1)
    return feature_rows(spark, sf_dir).where(
        (c("congestion") == 1) & severe & (c("day_of_week") < 5) & c("hour").between(6, 18)
    ).select("series_id", "date_time", "traffic_volume")


@query("category_match", f"""WITH {CLEAN} SELECT series_id, {STAMP}, weather_main, traffic_volume FROM clean
WHERE lower(weather_main) = lower('cLOUDS')""")
def category_match(spark, sf_dir):
    rows = clean_rows(spark, sf_dir).where(fields.same_text(F.col("weather_main"), "cLOUDS"))
    return rows.select("series_id", "date_time", "weather_main", "traffic_volume")


@query("weather_choices", f"WITH {CLEAN} SELECT DISTINCT weather_main FROM clean")
def weather_choices(spark, sf_dir):
    return profiles.weather_choices(clean_rows(spark, sf_dir))


@query("rain_spike_reset", f"""WITH {OBS} SELECT ordinal, CASE WHEN rain_1h > 100 THEN 0.0::DOUBLE ELSE rain_1h END AS rain_1h
FROM obs""", ["rain_1h"])
def rain_spike_reset(spark, sf_dir):
    return cleaning.reset_rain_spikes(observations(spark, sf_dir)).select("ordinal", "rain_1h")


def _unmarked(df):
    """A reader that takes the text 'None' for missing."""
    return df.withColumn("holiday", F.nullif("holiday", F.lit("None")))


@query("fill_none", f"WITH {OBS} SELECT ordinal, holiday FROM obs")
def fill_none(spark, sf_dir):
    return cleaning.fill_holiday(_unmarked(observations(spark, sf_dir))).select("ordinal", "holiday")


@query("keep_zero_report", f"WITH {CLEAN} SELECT series_id, ordinal, {STAMP} FROM clean WHERE traffic_volume = 0")
def keep_zero_report(spark, sf_dir):
    return cleaning.zero_volume_rows(clean_rows(spark, sf_dir))


_ZEROED = f"""{OBS}, zeroed AS (SELECT * REPLACE (CASE WHEN ordinal % 61 = 0 THEN 0 ELSE traffic_volume END AS traffic_volume) FROM obs), {cleaned('zeroed', 'kept_zeros')}"""


@query("zero_volume_report", f"""WITH {_ZEROED} SELECT series_id, ordinal, {STAMP}, (SELECT count(*) FROM kept_zeros) AS rows_kept FROM kept_zeros WHERE traffic_volume = 0""")
def zero_volume_report(spark, sf_dir):
    """Hours without traffic stay in the clean table and are reported."""
    raw_rows = observations(spark, sf_dir)
    zeroed = raw_rows.withColumn("traffic_volume", F.when(F.col("ordinal") % 61 == 0, F.lit(0).cast("long")).otherwise(F.col("traffic_volume")))
    clean = cleaning.clean(zeroed)
    return cleaning.zero_volume_rows(clean).withColumn("rows_kept", clean.agg(F.count(F.lit(1))).scalar())


@query("time_split", f"""WITH {FEAT} SELECT part, count(*) AS n, strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS first_hour,
strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS last_hour
FROM (SELECT *, CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS part FROM feat) GROUP BY part""")
def time_split(spark, sf_dir):
    parts = zip(("train", "test"), prepared.split_rows(spark, sf_dir))
    train, test = (
        df.groupBy(F.lit(name).alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min("date_time").alias("first_hour"), F.max("date_time").alias("last_hour"))
        for name, df in parts
    )
    return train.unionAll(test)


@query("season_filter", f"""WITH {HIST} SELECT ordinal, {STAMP} FROM hist
WHERE date_time < TIMESTAMP '2000-01-01' AND month(date_time) <= 9""")
def season_filter(spark, sf_dir):
    return drift.seasonal_reference(history(spark, sf_dir), "2000-01-01").select("ordinal", "date_time")


@query("min_sample_filter", f"""WITH {CLEAN} SELECT series_id, count(*) AS n, count(*) < 60 AS small_sample FROM clean
GROUP BY series_id HAVING count(*) >= 30""")
def min_sample_filter(spark, sf_dir):
    n = clean_rows(spark, sf_dir).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") >= 30).withColumn("small_sample", F.col("n") < 60)


@query("min_sample_groups", f"""WITH {OBS}, g AS (SELECT holiday, weather_main, count(*) AS n, avg(traffic_volume) AS avg_volume FROM obs GROUP BY 1, 2)
SELECT *, (SELECT count(*) FROM g WHERE n < 30) AS groups_left_out FROM g WHERE n >= 30""", ["avg_volume"])
def min_sample_groups(spark, sf_dir):
    """Holiday and weather: most holidays have too few hours to compare."""
    groups = observations(spark, sf_dir).groupBy("holiday", "weather_main").agg(F.count(F.lit(1)).alias("n"), F.avg("traffic_volume").alias("avg_volume"))
    left_out = groups.agg(F.count_if(F.col("n") < 30)).scalar()
    return groups.where(F.col("n") >= 30).withColumn("groups_left_out", left_out)


@query("drop_columns", f"""WITH {CLEAN} SELECT * EXCLUDE (holiday, temp, weather_main, weather_description, date_time), {STAMP}
FROM clean""", ["rain_1h", "snow_1h"])
def drop_columns(spark, sf_dir):
    return clean_rows(spark, sf_dir).drop("holiday", "temp", "weather_main", "weather_description")


_GATE = """SELECT '{name}' AS stage, count(*) AS rows, count(*) - count(DISTINCT (series_id, date_time)) AS repeated_keys,
CAST(0 AS BIGINT) AS null_cells, min(temp) - 273.15::DOUBLE AS min_temp_c, max(temp) - 273.15::DOUBLE AS max_temp_c,
max(rain_1h) AS max_rain, count(*) = count(DISTINCT (series_id, date_time)) AS passed FROM {source}"""


@query("quality_gate", f"""WITH {CLEAN} {_GATE.format(name='raw', source='obs')}
UNION ALL {_GATE.format(name='clean', source='clean')}""", ["min_temp_c", "max_temp_c", "max_rain"])
def quality_gate(spark, sf_dir):
    """Reports of both stages; only the cleaned rows have to pass."""
    def report(name, df):
        return cleaning.quality_report(df).select(F.lit(name).alias("stage"), "*")

    gated = cleaning.quality_gate(clean_rows(spark, sf_dir))
    return report("raw", observations(spark, sf_dir)).unionAll(report("clean", gated))


@query("null_counts", f"""WITH {OBS}, u AS (SELECT *, nullif(holiday, 'None') AS marked FROM obs)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({'marked' if c == 'holiday' else c}) AS nulls FROM u"
    for c in OBS_COLUMNS))
def null_counts(spark, sf_dir):
    return cleaning.null_counts(_unmarked(observations(spark, sf_dir)))


# --- field functions --------------------------------------------------------------------------

@query("calendar_fields", f"""WITH {OBS}
SELECT ordinal, strftime(date_time, '%Y') AS year_text, strftime(date_time, '%Y-%m-%d') AS day_text,
       hour(date_time) AS hour, isodow(date_time) - 1 AS day_of_week, month(date_time) AS month,
       hour(date_time) IN (6, 7, 8, 9, 15, 16, 17, 18) AS rush, {time_of_day('hour(date_time)')} AS time_of_day,
       CASE WHEN isodow(date_time) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       strftime(strptime(strftime(date_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed
FROM obs""")
def calendar_fields(spark, sf_dir):
    ts = F.col("date_time")
    return observations(spark, sf_dir).select(
        "ordinal", fields.year_text(ts).alias("year_text"), fields.day_text(ts).alias("day_text"),
        F.hour(ts).alias("hour"), F.weekday(ts).alias("day_of_week"), F.month(ts).alias("month"),
        fields.is_rush_hour(F.hour(ts)).alias("rush"), fields.time_of_day(F.hour(ts)).alias("time_of_day"),
        fields.day_type(F.weekday(ts)).alias("day_type"), F.try_to_timestamp(fields.clock(ts)).alias("parsed"),
    )


@query("numeric_fields", f"""WITH {OBS}
SELECT ordinal, round(rain_1h, 1) AS rounded, 100.0::DOUBLE * traffic_volume / nullif(clouds_all, 0) AS per_cloud,
       ln(greatest(rain_1h, 1e-6)) AS log_rain, abs(temp - 273.15::DOUBLE) AS distance, sqrt(traffic_volume) AS root,
       traffic_volume BETWEEN 1000 AND 5500 AS mid_range
FROM obs""", ["rounded", "per_cloud", "log_rain", "distance", "root"])
def numeric_fields(spark, sf_dir):
    volume = F.col("traffic_volume")
    return observations(spark, sf_dir).select(
        "ordinal", F.round("rain_1h", 1).alias("rounded"),
        F.try_divide(F.lit(100.0) * volume, F.col("clouds_all")).alias("per_cloud"),
        F.ln(F.greatest("rain_1h", F.lit(1e-6))).alias("log_rain"),
        F.abs(fields.celsius(F.col("temp"))).alias("distance"), F.sqrt(volume).alias("root"),
        volume.between(1000, 5500).alias("mid_range"),
    )


@query("text_fields", f"""WITH {OBS}, t AS (SELECT ordinal, 'weather_' || weather_main || ' + ' || weather_description AS label FROM obs)
SELECT ordinal, lower(label) AS lowered, replace(label, 'weather_', '') AS plain, starts_with(label, 'weather_S') AS snowy,
       trim(string_split(label, '+')[2]) AS second, replace(label, ' + ', ', ') AS joined FROM t""")
def text_fields(spark, sf_dir):
    label = F.col("label")
    parts = F.transform(F.split(label, "\\+"), lambda p: F.trim(p))
    return observations(spark, sf_dir).select(
        "ordinal", F.concat(F.lit("weather_"), "weather_main", F.lit(" + "), "weather_description").alias("label")
    ).select(
        "ordinal", F.lower(label).alias("lowered"), F.replace(label, F.lit("weather_"), F.lit("")).alias("plain"),
        F.startswith(label, F.lit("weather_S")).alias("snowy"), parts[1].alias("second"),
        F.array_join(parts, ", ").alias("joined"),
    )


@query("risk_labels", f"""WITH {OBS}, s AS (SELECT ordinal, clouds_all / 100.0::DOUBLE AS p, traffic_volume / 4000.0::DOUBLE AS ratio FROM obs)
SELECT ordinal, CASE WHEN p >= 0.75 THEN 'HIGH' WHEN p >= 0.4 THEN 'MODERATE' ELSE 'LOW' END AS by_probability,
       CASE WHEN ratio >= 1.5 THEN 'HIGH' WHEN ratio >= 0.8 THEN 'MODERATE' ELSE 'LOW' END AS by_ratio FROM s""")
def risk_labels(spark, sf_dir):
    return observations(spark, sf_dir).select(
        "ordinal", fields.risk_of_probability(F.col("clouds_all") / F.lit(100.0)).alias("by_probability"),
        fields.risk_of_ratio(F.col("traffic_volume") / F.lit(4000.0)).alias("by_ratio"),
    )
