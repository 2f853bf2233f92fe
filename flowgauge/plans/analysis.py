"""The SQL suite, statistics, profiles, rankings and rules as queries."""

from pyspark.sql import functions as F

from flowgauge.operators import features, profiles, rules, statistics
from flowgauge.plans.basics import ALL_COLUMNS, FIRST_YEAR, HOLIDAY_DAYS, LAST_YEAR, MEASURES
from flowgauge.plans.checks import CLEAN, HIST, OBS, STAMP, time_of_day
from flowgauge.plans.prepared import clean_rows
from flowgauge.plans.registry import query
from flowgauge.plans.suite import holiday_list, run_named
from flowgauge.sources.views import history, observations


def _named(name, sql, view, doubles=(), digits=6):
    def build(spark, sf_dir):
        raw = view(spark, sf_dir)
        result = run_named(name, raw, holiday_list(raw, HOLIDAY_DAYS), FIRST_YEAR, LAST_YEAR)
        # whole numbers that may be NULL are compared as doubles
        return result.withColumns({c: F.col(c).cast("double") for c in ("yoy_change", "total_traffic") if c in result.columns})

    query(name, sql, doubles, digits)(build)


_YEARS = f"FROM hist WHERE year(date_time) BETWEEN {FIRST_YEAR} AND {LAST_YEAR} GROUP BY 1"
_YEAR = "strftime(date_time, '%Y') AS year"

_named("row_count", "SELECT count(*) AS rows_loaded FROM events", observations)
_named("date_range", f"""WITH {OBS} SELECT strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS first_timestamp,
strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS last_timestamp FROM obs""", observations)
_named("sample_rows", f"""WITH {OBS}, five AS (SELECT * FROM obs ORDER BY date_time, series_id, ordinal LIMIT 5)
SELECT {ALL_COLUMNS} FROM five""", observations, MEASURES)
_named("dup_check", f"""WITH {OBS} SELECT count(*) AS total_rows, count(DISTINCT (series_id, date_time)) AS distinct_timestamps,
count(*) - count(DISTINCT (series_id, date_time)) AS duplicate_timestamps FROM obs""", observations)
_named("yearly_totals", f"""WITH {HIST} SELECT {_YEAR}, count(*) AS hours_recorded,
CAST(sum(traffic_volume) AS BIGINT) AS total_volume {_YEARS}""", history)
_named("yoy_change", f"""WITH {HIST}, yearly AS (SELECT {_YEAR}, CAST(sum(traffic_volume) AS BIGINT) AS total_volume {_YEARS})
SELECT a.year, a.total_volume, CAST(a.total_volume - b.total_volume AS DOUBLE) AS yoy_change,
round(100.0::DOUBLE * (a.total_volume - b.total_volume) / b.total_volume, 1) AS yoy_pct_change
FROM yearly a LEFT JOIN yearly b ON b.year = (SELECT max(c.year) FROM yearly c WHERE c.year < a.year)""", history, ["yoy_pct_change"])
_named("yearly_hourly_avg", f"""WITH {HIST} SELECT {_YEAR}, count(*) AS hours_recorded,
round(avg(traffic_volume), 1) AS avg_hourly_volume {_YEARS}""", history, ["avg_hourly_volume"])
_named("holiday_counts", f"""WITH {OBS} SELECT holiday, count(*) AS flagged_hours,
count(DISTINCT CAST(date_time AS DATE)) AS distinct_days FROM obs WHERE holiday <> 'None' GROUP BY 1""", observations)
_LISTED = ", ".join(f"('{n}', DATE '{d}')" for n, d in HOLIDAY_DAYS)
_ON_DAY = "FROM obs WHERE date_time >= CAST(day AS TIMESTAMP) AND date_time < CAST(day + INTERVAL 1 DAY AS TIMESTAMP)"
_named("holiday_temps", f"""WITH {OBS} SELECT name AS holiday_name, strftime(day, '%Y-%m-%d') AS holiday_date, (SELECT count(*) {_ON_DAY}) AS hours_recorded,
(SELECT round(avg(temp - 273.15::DOUBLE), 1) {_ON_DAY}) AS avg_temp_c, (SELECT round(min(temp - 273.15::DOUBLE), 1) {_ON_DAY}) AS min_temp_c,
(SELECT round(max(temp - 273.15::DOUBLE), 1) {_ON_DAY}) AS max_temp_c, (SELECT CAST(sum(traffic_volume) AS DOUBLE) {_ON_DAY}) AS total_traffic
FROM (VALUES {_LISTED}) AS listed(name, day)""", observations, ["avg_temp_c", "min_temp_c", "max_temp_c"])
_named("holiday_vs_normal", f"""WITH {OBS},
per_day AS (SELECT bool_or(holiday <> 'None') AS special, sum(traffic_volume) AS volume FROM obs GROUP BY date_trunc('day', date_time))
SELECT if(coalesce(special, false), 'Holiday', 'Non-holiday') AS day_type, count(*) AS days, round(avg(volume), 0) AS avg_daily_volume
FROM per_day GROUP BY 1""", observations, ["avg_daily_volume"])


@query("daily_totals", f"""WITH {OBS} SELECT strftime(date_time, '%Y-%m-%d') AS day, CAST(sum(traffic_volume) AS BIGINT) AS daily_volume
FROM obs GROUP BY 1""")
def daily_totals(spark, sf_dir):
    return observations(spark, sf_dir).groupBy(F.to_date("date_time").alias("day")).agg(
        F.sum("traffic_volume").alias("daily_volume"))


@query("holiday_days", f"""WITH {OBS} SELECT DISTINCT strftime(date_time, '%Y-%m-%d') AS holiday_date FROM obs
WHERE holiday <> 'None'""")
def holiday_days(spark, sf_dir):
    return features.holiday_dates(observations(spark, sf_dir))


# --- statistics and probability ---------------------------------------------------------------

_DESCRIBE = """SELECT count(*) AS n, avg(traffic_volume) AS mean, quantile_cont(traffic_volume, 0.5) AS median,
stddev_samp(traffic_volume) AS std, var_samp(traffic_volume) AS variance, min(traffic_volume) AS min, max(traffic_volume) AS max,
max(traffic_volume) - min(traffic_volume) AS range, quantile_cont(traffic_volume, 0.25) AS q1,
quantile_cont(traffic_volume, 0.75) AS q3, quantile_cont(traffic_volume, 0.75) - quantile_cont(traffic_volume, 0.25) AS iqr,
skewness(traffic_volume) AS skew FROM """
_DESCRIBED = ["mean", "median", "std", "variance", "q1", "q3", "iqr", "skew"]


@query("descriptive_stats", f"WITH {OBS} {_DESCRIBE} obs", _DESCRIBED, 3)
def descriptive_stats(spark, sf_dir):
    return statistics.describe(observations(spark, sf_dir))


@query("pearson_corr", f"""WITH {OBS} SELECT corr(temp, traffic_volume) AS r, pow(corr(temp, traffic_volume), 2) AS r_squared
FROM obs""", ["r", "r_squared"])
def pearson_corr(spark, sf_dir):
    return statistics.correlation(observations(spark, sf_dir))


_FLAGS = f"""{OBS}, f AS (SELECT *, traffic_volume > 5500 AS g, temp > 292 AS h, weather_main = 'Clear' AS c,
weather_main = 'Clouds' AS d FROM obs),
k AS (SELECT count(*) AS n, count(*) FILTER (g) AS n_congested, count(*) FILTER (c) AS n_clear, count(*) FILTER (d) AS n_cloudy,
count(*) FILTER (g AND c) AS n_congested_clear, count(*) FILTER (g AND d) AS n_congested_cloudy,
count(*) FILTER (g AND h) AS n_congested_hot FROM f)"""


@query("probabilities", f"""WITH {_FLAGS} SELECT n, n_congested, n_clear, n_congested_clear, n_congested_hot,
n_congested / n AS p_congested, n_clear / n AS p_clear, n_congested_clear / n AS p_congested_and_clear,
n_congested_clear / nullif(n_congested, 0) AS p_clear_given_congested,
n_congested_hot / nullif(n_congested, 0) AS p_hot_given_congested FROM k""",
       ["p_congested", "p_clear", "p_congested_and_clear", "p_clear_given_congested", "p_hot_given_congested"])
def probabilities(spark, sf_dir):
    return statistics.probabilities(observations(spark, sf_dir))


@query("independence_test", f"""WITH {_FLAGS} SELECT (n_congested / n) * (n_clear / n) AS p_product, n_congested_clear / n AS p_joint,
CASE WHEN n_congested_clear * n < n_congested * n_clear THEN 'LOWER' WHEN n_congested_clear * n > n_congested * n_clear
THEN 'HIGHER' ELSE 'INDEPENDENT' END AS verdict FROM k""", ["p_product", "p_joint"])
def independence_test(spark, sf_dir):
    return statistics.independence(observations(spark, sf_dir))


@query("odds_ratio", f"""WITH {_FLAGS}, p AS (SELECT n_congested_clear / nullif(n_clear, 0) AS p_clear,
n_congested_cloudy / nullif(n_cloudy, 0) AS p_cloudy FROM k)
SELECT p_clear, p_cloudy, p_clear / (1 - p_clear) AS odds_clear, p_cloudy / (1 - p_cloudy) AS odds_cloudy,
(p_clear / (1 - p_clear)) / (p_cloudy / (1 - p_cloudy)) AS odds_ratio FROM p""",
       ["p_clear", "p_cloudy", "odds_clear", "odds_cloudy", "odds_ratio"])
def odds_ratio(spark, sf_dir):
    return statistics.odds_ratio(observations(spark, sf_dir))


@query("congestion_by_weather", f"""WITH {OBS} SELECT weather_main, count(*) AS n,
count(*) FILTER (traffic_volume > 5500) AS n_congested, count(*) FILTER (traffic_volume > 5500) / count(*) AS p_congested
FROM obs GROUP BY 1""", ["p_congested"])
def congestion_by_weather(spark, sf_dir):
    return statistics.congestion_by_weather(observations(spark, sf_dir))


# --- profiles ---------------------------------------------------------------------------------

_HOUR, _DOW = "hour(date_time)", "isodow(date_time) - 1"


@query("hourly_profile", f"""WITH {CLEAN} SELECT {_HOUR} AS hour, avg(traffic_volume) AS avg_volume FROM clean GROUP BY 1""",
       ["avg_volume"])
def hourly_profile(spark, sf_dir):
    return profiles.hourly_profile(clean_rows(spark, sf_dir))


@query("hourly_by_daytype", f"""WITH {CLEAN}, m AS (SELECT CAST(isodow(date_time) >= 6 AS BIGINT) AS is_weekend, {_HOUR} AS hour,
avg(traffic_volume) AS avg_volume FROM clean GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY is_weekend ORDER BY avg_volume DESC, hour) = 1 AS is_peak FROM m""", ["avg_volume"])
def hourly_by_daytype(spark, sf_dir):
    return profiles.hourly_by_daytype(clean_rows(spark, sf_dir))


@query("dow_hour_pivot", f"WITH {CLEAN} SELECT {_DOW} AS day_of_week, " + ", ".join(
    f"avg(traffic_volume) FILTER ({_HOUR} = {h}) AS h{h:02d}" for h in range(24)) + " FROM clean GROUP BY 1",
       [f"h{h:02d}" for h in range(24)])
def dow_hour_pivot(spark, sf_dir):
    return profiles.dow_hour_pivot(clean_rows(spark, sf_dir))


_CELLS = f"""WITH {CLEAN}, cells AS (SELECT {_DOW} AS day_of_week, {_HOUR} AS hour, avg(traffic_volume) AS avg_volume
FROM clean GROUP BY 1, 2)"""


@query("dow_hour_cells", f"{_CELLS} SELECT * FROM cells", ["avg_volume"])
def dow_hour_cells(spark, sf_dir):
    return profiles.dow_hour_cells(clean_rows(spark, sf_dir))


@query("busiest_cell", f"{_CELLS} SELECT * FROM cells ORDER BY avg_volume DESC, day_of_week, hour LIMIT 1", ["avg_volume"])
def busiest_cell(spark, sf_dir):
    return profiles.busiest_cell(clean_rows(spark, sf_dir))


_IMPACT = f"""WITH {CLEAN}, w AS (SELECT weather_main, avg(traffic_volume) AS avg_volume, count(*) AS n, count(*) > 100 AS well_sampled
FROM clean GROUP BY 1)"""


@query("weather_impact", f"{_IMPACT} SELECT * FROM w", ["avg_volume"])
def weather_impact(spark, sf_dir):
    return profiles.weather_impact(clean_rows(spark, sf_dir)).orderBy("avg_volume")


@query("lowest_well_sampled", f"{_IMPACT} SELECT * FROM w WHERE well_sampled ORDER BY avg_volume, weather_main LIMIT 1", ["avg_volume"])
def lowest_well_sampled(spark, sf_dir):
    return profiles.lowest_well_sampled(clean_rows(spark, sf_dir))


@query("monthly_rhythm", f"""WITH {HIST}, m AS (SELECT month(date_time) AS month, avg(traffic_volume) AS avg_volume FROM hist GROUP BY 1)
SELECT month, avg_volume, avg(avg_volume) OVER () AS year_avg,
first(month) OVER (ORDER BY avg_volume DESC, month ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS highest_month,
first(month) OVER (ORDER BY avg_volume, month ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lowest_month
FROM m""", ["avg_volume", "year_avg"], 3)
def monthly_rhythm(spark, sf_dir):
    return profiles.monthly_rhythm(history(spark, sf_dir))


@query("summary", f"""WITH {CLEAN}, q AS (SELECT quantile_cont(traffic_volume, 0.75) AS q3 FROM clean),
m AS (SELECT {_HOUR} AS hour, avg(traffic_volume) AS a FROM clean GROUP BY 1)
SELECT count(*) AS n, strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS first_hour,
strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS last_hour, avg(traffic_volume) AS mean, stddev_samp(traffic_volume) AS std,
min(traffic_volume) AS min, max(traffic_volume) AS max, count(*) FILTER (traffic_volume >= (SELECT q3 FROM q)) AS congested_n,
median(traffic_volume) AS median, (SELECT q3 FROM q) AS q3,
100.0::DOUBLE * count(*) FILTER (traffic_volume >= (SELECT q3 FROM q)) / count(*) AS congested_pct,
(SELECT hour FROM m ORDER BY a DESC, hour LIMIT 1) AS busiest_hour, (SELECT max(a) FROM m) AS busiest_avg,
(SELECT hour FROM m ORDER BY a, hour LIMIT 1) AS quietest_hour, (SELECT min(a) FROM m) AS quietest_avg
FROM clean""", ["mean", "std", "median", "q3", "congested_pct", "busiest_avg", "quietest_avg"], 3)
def summary(spark, sf_dir):
    return profiles.summary(clean_rows(spark, sf_dir))


@query("weather_compare", f"""WITH {CLEAN}, g AS (SELECT weather_main, count(*) AS n, avg(traffic_volume) AS avg_volume FROM clean GROUP BY 1),
o AS (SELECT avg(traffic_volume) AS overall_avg FROM clean)
SELECT weather_main, n, avg_volume, overall_avg, rank() OVER (ORDER BY avg_volume DESC) AS rank, count(*) OVER () AS conditions,
n < 100 AS small_sample, avg_volume - overall_avg AS diff, (avg_volume / overall_avg - 1) * 100 AS diff_pct FROM g, o""",
       ["avg_volume", "overall_avg", "diff", "diff_pct"])
def weather_compare(spark, sf_dir):
    return profiles.weather_compare(clean_rows(spark, sf_dir))


@query("mean_rank", f"""WITH {HIST}, g AS (SELECT weather_main, avg(traffic_volume) AS avg_volume FROM hist GROUP BY 1)
SELECT weather_main, 1 + (SELECT count(*) FROM g b WHERE b.avg_volume > g.avg_volume) AS rank FROM g""")
def mean_rank(spark, sf_dir):
    return profiles.weather_compare(history(spark, sf_dir)).select("weather_main", "rank")


# --- order and limits -------------------------------------------------------------------------

_TOP = "ORDER BY traffic_volume DESC, date_time, series_id LIMIT 10"


@query("top_hours", f"""WITH {CLEAN}, t AS (SELECT * FROM clean {_TOP})
SELECT row_number() OVER (ORDER BY traffic_volume DESC, t.date_time, series_id) AS position, series_id, {STAMP}, traffic_volume, weather_main
FROM t""")
def top_hours(spark, sf_dir):
    return profiles.top_hours(clean_rows(spark, sf_dir), 10)


@query("quietest_hours", f"""WITH {CLEAN}, m AS (SELECT {_HOUR} AS hour, avg(traffic_volume) AS avg_volume FROM clean
WHERE isodow(date_time) < 6 GROUP BY 1) SELECT * FROM m ORDER BY avg_volume, hour LIMIT 3""", ["avg_volume"])
def quietest_hours(spark, sf_dir):
    return profiles.quietest_hours(clean_rows(spark, sf_dir), weekend=False)


@query("argmax_hour", f"""WITH {CLEAN}, m AS (SELECT {_HOUR} AS hour, avg(traffic_volume) AS a FROM clean GROUP BY 1)
SELECT (SELECT hour FROM m ORDER BY a DESC, hour LIMIT 1) AS busiest_hour, (SELECT max(a) FROM m) AS busiest_avg,
(SELECT hour FROM m ORDER BY a, hour LIMIT 1) AS quietest_hour, (SELECT min(a) FROM m) AS quietest_avg""",
       ["busiest_avg", "quietest_avg"])
def argmax_hour(spark, sf_dir):
    return profiles.extreme_groups(profiles.hourly_profile(clean_rows(spark, sf_dir)), "hour")


# --- item sets and rules ----------------------------------------------------------------------

_TRANSACTIONS = f"""trans AS (SELECT series_id, date_time, {time_of_day(_HOUR)} AS time_of_day,
CASE WHEN isodow(date_time) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, 'Weather_' || weather_main AS weather,
CASE WHEN traffic_volume >= (SELECT quantile_cont(traffic_volume, 0.75) FROM clean) THEN 'High traffic' ELSE 'Normal traffic' END
AS traffic_level FROM clean)"""
_TRANS = f"{CLEAN}, {_TRANSACTIONS}"
_SETS = f"""sets AS (
SELECT array_to_string(list_sort([x FOR x IN [time_of_day, day_type, weather, traffic_level] IF x IS NOT NULL]), ',') AS items,
  time_of_day, day_type, weather, traffic_level, count(*) AS n, count(*) / (SELECT count(*) FROM trans) AS support
FROM trans GROUP BY CUBE (time_of_day, day_type, weather, traffic_level)
HAVING count(*) / (SELECT count(*) FROM trans) >= 0.05 AND items <> '')"""
ITEMS = f"{_TRANS}, {_SETS}"
MINED = f"{_TRANSACTIONS}, {_SETS}"  # after the cleaned rows
RULE_CONFIDENCE = 0.2  # volumes of the test tables are unrelated to time and weather, so rules are weak
_RULES = f"""{ITEMS}, rules AS (
SELECT a.items AS antecedent, b.support, b.n / a.n AS confidence,
       (b.n / a.n) / (SELECT support FROM sets WHERE items = 'High traffic') AS lift
FROM sets b JOIN sets a ON a.traffic_level IS NULL AND a.time_of_day IS NOT DISTINCT FROM b.time_of_day
  AND a.day_type IS NOT DISTINCT FROM b.day_type AND a.weather IS NOT DISTINCT FROM b.weather
WHERE b.traffic_level = 'High traffic' AND b.n / a.n >= {RULE_CONFIDENCE})"""


@query("discretize_transactions", f"""WITH {_TRANS}
SELECT series_id, {STAMP}, concat_ws(',', time_of_day, day_type, weather, traffic_level) AS items FROM trans""")
def discretize_transactions(spark, sf_dir):
    items = features.with_items(features.transactions(clean_rows(spark, sf_dir)))
    return items.select("series_id", "date_time", F.array_join("items", ",").alias("items"))


@query("itemset_supports", f"WITH {ITEMS} SELECT items, n, support FROM sets", ["support"])
def itemset_supports(spark, sf_dir):
    sets = rules.itemsets(features.transactions(clean_rows(spark, sf_dir)))
    return sets.withColumn("items", F.array_join("items", ","))


def _rules(spark, sf_dir):
    found = rules.association_rules(features.transactions(clean_rows(spark, sf_dir)), min_confidence=RULE_CONFIDENCE)
    return found


@query("assoc_rules", f"WITH {_RULES} SELECT * FROM rules", ["support", "confidence", "lift"])
def assoc_rules(spark, sf_dir):
    return _rules(spark, sf_dir).withColumn("antecedent", F.array_join("antecedent", ","))


@query("top_rules", f"WITH {_RULES} SELECT * FROM rules ORDER BY lift DESC, antecedent LIMIT 5", ["support", "confidence", "lift"])
def top_rules(spark, sf_dir):
    return rules.top_rules(_rules(spark, sf_dir)).withColumn("antecedent", F.array_join("antecedent", ","))
