"""Drift, scoring, recommendation and streaming as queries."""

from pyspark.sql import functions as F

from flowgauge.constants import DRIFT_FEATURES, WEATHER
from flowgauge.functions import fields
from flowgauge.operators import advice, cleaning, drift, features, models, rules, runs, scoring, sequences
from flowgauge.plans import prepared
from flowgauge.plans.analysis import MINED, RULE_CONFIDENCE
from flowgauge.plans.basics import ALL_COLUMNS, MEASURES
from flowgauge.plans.checks import CLEAN, FEAT, OBS, STAMP, TEST, TRAIN, time_of_day
from flowgauge.plans.modelling import KEYS, experiment_table
from flowgauge.plans.prepared import SPLIT, clean_rows, feature_rows, place, split_rows
from flowgauge.plans.registry import query
from flowgauge.sources.views import OBS_COLUMNS, event_columns, requests_from_events, score_requests_view
from flowgauge.streaming import jobs

# --- drift ------------------------------------------------------------------------------------

_SAMPLED = f"""drifted AS (SELECT * REPLACE (temp_c + 15.0::DOUBLE AS temp_c, rain_1h * 10.0::DOUBLE AS rain_1h)
FROM feat WHERE {TEST})"""


def _long(source, side):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {side} AS side FROM {source}" for c in DRIFT_FEATURES)


def _psi(current):
    tenths = ", ".join(str(i / 10) for i in range(11))
    return f"""reference AS (SELECT * FROM feat WHERE {TRAIN} AND month <= 9),
long AS ({_long('reference', 0)} UNION ALL {_long(current, 1)}),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{tenths}]))) AS e FROM long WHERE side = 0 GROUP BY 1),
binned AS (SELECT l.feature, len(e) AS k, side, len([x FOR x IN e[2:len(e) - 1] IF value >= x]) AS bucket, count(*) AS n
  FROM long l JOIN edges USING (feature) GROUP BY ALL),
shares AS (SELECT feature, k, bucket,
  greatest(coalesce(sum(n) FILTER (side = 0), 0) / (SELECT count(*) FROM reference), 1e-6) AS r,
  greatest(coalesce(sum(n) FILTER (side = 1), 0) / (SELECT count(*) FROM {current}), 1e-6) AS c FROM binned GROUP BY ALL),
psi AS (SELECT feature, CASE WHEN max(k) < 3 THEN 0.0::DOUBLE ELSE sum((c - r) * ln(c / r)) END AS psi FROM shares GROUP BY 1)"""


_CURRENT = f"current_rows AS (SELECT * FROM feat WHERE {TEST})"
_STATUS = "CASE WHEN {x} > 0.25 THEN 'ALERT' WHEN {x} > 0.10 THEN 'WARN' ELSE 'PASS' END"
_ORDER = f"list_position([{', '.join(repr(c) for c in DRIFT_FEATURES)}], feature)"
_WORST = f"""worst AS (SELECT psi AS worst_psi, CASE WHEN psi > 0 THEN feature ELSE '' END AS worst_feature,
{_STATUS.format(x='psi')} AS data_verdict FROM psi ORDER BY psi DESC, {_ORDER} LIMIT 1)"""


def _sides(spark, sf_dir):
    train, test = split_rows(spark, sf_dir)
    return drift.seasonal_reference(train, SPLIT), test


def _drifted(spark, sf_dir):
    return drift.inject_drift(_sides(spark, sf_dir)[1], KEYS)


@query("psi", f"WITH {FEAT}, {_CURRENT}, {_psi('current_rows')} SELECT * FROM psi", ["psi"])
def psi(spark, sf_dir):
    return drift.psi(*_sides(spark, sf_dir))


@query("psi_injected", f"WITH {FEAT}, {_SAMPLED}, {_psi('drifted')} SELECT feature, psi, {_STATUS.format(x='psi')} AS status FROM psi", ["psi"])
def psi_injected(spark, sf_dir):
    return drift.feature_verdicts(drift.psi(_sides(spark, sf_dir)[0], _drifted(spark, sf_dir)))


@query("drift_verdict", f"WITH {FEAT}, {_CURRENT}, {_psi('current_rows')}, {_WORST} SELECT * FROM worst", ["worst_psi"])
def drift_verdict(spark, sf_dir):
    return drift.overall_verdict(drift.psi(*_sides(spark, sf_dir)))


@query("seasonal_reference", f"WITH {FEAT} SELECT series_id, {STAMP}, temp_c FROM feat WHERE {TRAIN} AND month <= 9", ["temp_c"])
def seasonal_reference(spark, sf_dir):
    return _sides(spark, sf_dir)[0].select(*KEYS, "temp_c")


@query("inject_drift", f"WITH {FEAT}, {_SAMPLED} SELECT series_id, {STAMP}, temp_c, rain_1h FROM drifted", ["temp_c", "rain_1h"])
def inject_drift(spark, sf_dir):
    return _drifted(spark, sf_dir).select(*KEYS, "temp_c", "rain_1h")


# the predictor of the checked queries is the persistence forecast; ``monitoring_report`` uses the stored forest
_FORECAST = f"""p AS (SELECT *, lag(traffic_volume) OVER (PARTITION BY series_id ORDER BY date_time) AS forecast FROM clean),
perf AS (SELECT avg(abs(traffic_volume - forecast)) FILTER ({TEST}) AS mae,
  avg(abs(traffic_volume - forecast)) FILTER ({TRAIN}) AS reference_mae FROM p),
performance AS (SELECT *, CASE WHEN mae > reference_mae * 1.5 THEN 'ALERT' ELSE 'PASS' END AS performance_verdict FROM perf)"""


def _persistence_drift(spark, sf_dir):
    rows = clean_rows(spark, sf_dir).select(*KEYS, "traffic_volume")
    forecast = sequences.previous_value(rows, "traffic_volume", "forecast")
    return drift.performance_drift_within(forecast, "traffic_volume", "forecast", ~models.before(SPLIT))


@query("performance_drift", f"WITH {CLEAN}, {_FORECAST} SELECT * FROM performance", ["mae", "reference_mae"])
def performance_drift(spark, sf_dir):
    return _persistence_drift(spark, sf_dir)


@query("retrain_decision", f"""WITH {FEAT}, {_CURRENT}, {_psi('current_rows')}, {_WORST}, {_FORECAST}
SELECT *, data_verdict = 'ALERT' AND performance_verdict = 'ALERT' AS retrain FROM worst, performance""",
       ["worst_psi", "mae", "reference_mae"])
def retrain_decision(spark, sf_dir):
    return drift.retrain_decision(drift_verdict(spark, sf_dir), _persistence_drift(spark, sf_dir))


@query("monitoring_report")
def monitoring_report(spark, sf_dir):
    """Both scenarios against the MAE that the training run recorded for the stored forest."""
    runs_table = experiment_table(spark, sf_dir)
    recorded = runs.recorded_metric(runs_table, "random-forest-regressor", "mae")
    reference, current = _sides(spark, sf_dir)
    scored = models.predict_volume(prepared.model(spark, sf_dir, "forest_regressor"), models.dealt_out(current))
    performance = drift.performance_drift(scored, "traffic_volume", models.VOLUME, recorded)
    scenarios = {"real": current, "injected": _drifted(spark, sf_dir)}
    reports = [
        drift.retrain_decision(drift.overall_verdict(drift.psi(reference, df)), performance).select(F.lit(n).alias("scenario"), "*")
        for n, df in scenarios.items()
    ]
    return reports[0].unionAll(reports[1])


# --- scoring ----------------------------------------------------------------------------------

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_REQUESTS = f"""requests AS (SELECT event_id AS request_id, CASE WHEN event_id % 53 <> 0 THEN event_id % 25 END AS hour,
event_id % 29 % 8 AS day_of_week, event_id % 31 % 13 AS month,
CASE WHEN event_id % 41 <> 0 THEN {_K} * 0.5::DOUBLE - 20.0::DOUBLE END AS temp_c,
coalesce(CASE WHEN event_type = 'error' THEN value - 0.5::DOUBLE END, 0.0) AS rain_1h,
coalesce(CASE WHEN event_type = 'signup' THEN (user_id % 10) / 10.0::DOUBLE END, 0.0) AS snow_1h,
coalesce(CASE WHEN event_id % 7 <> 0 THEN CAST({_K} + event_id % 4 AS DOUBLE) END, 50.0) AS clouds_all,
coalesce(CASE WHEN event_id % 37 = 0 THEN 'banana' WHEN event_id % 5 <> 0 THEN CASE event_type WHEN 'view' THEN 'Clear'
  WHEN 'click' THEN 'Clouds' WHEN 'purchase' THEN 'Mist' WHEN 'signup' THEN 'Snow' WHEN 'error' THEN 'Rain' END END, 'Clear') AS weather_main,
coalesce(CASE WHEN event_id % 11 = 0 THEN true WHEN event_id % 3 = 0 THEN false END, false) AS is_holiday FROM events)"""


_CHECKED = f"""{_REQUESTS}, checked AS (SELECT * REPLACE (CAST(hour AS DOUBLE) AS hour), concat_ws(',',
CASE WHEN hour IS NULL OR hour NOT BETWEEN 0 AND 23 THEN 'hour' END,
CASE WHEN day_of_week IS NULL OR day_of_week NOT BETWEEN 0 AND 6 THEN 'day_of_week' END,
CASE WHEN month IS NULL OR month NOT BETWEEN 1 AND 12 THEN 'month' END, CASE WHEN temp_c IS NULL THEN 'temp_c' END,
CASE WHEN rain_1h < 0 THEN 'rain_1h' END, CASE WHEN snow_1h < 0 THEN 'snow_1h' END,
CASE WHEN clouds_all NOT BETWEEN 0 AND 100 THEN 'clouds_all' END,
CASE WHEN weather_main NOT IN ({', '.join(f"'{w}'" for w in WEATHER)}) THEN 'weather_main' END) AS errors FROM requests)"""
_REQUEST_NUMBERS = ["temp_c", "rain_1h", "snow_1h", "clouds_all"]


def _listed_errors(checked):
    return checked.withColumns({"errors": F.array_join("errors", ","), "hour": F.col("hour").cast("double")})


@query("request_validation", f"WITH {_CHECKED} SELECT * FROM checked", _REQUEST_NUMBERS)
def request_validation(spark, sf_dir):
    return _listed_errors(scoring.validate_requests(score_requests_view(spark, sf_dir)))


@query("rejected_requests", f"WITH {_CHECKED} SELECT * FROM checked WHERE errors <> ''", _REQUEST_NUMBERS)
def rejected_requests(spark, sf_dir):
    """The requests that scoring leaves out, stored with their reasons."""
    path = place(spark, sf_dir, "rejected_requests")
    scoring.split_requests(score_requests_view(spark, sf_dir))[1].write.mode("overwrite").parquet(path)
    return _listed_errors(spark.read.parquet(path))


def _served(spark, sf_dir):
    return prepared.fitted(spark, sf_dir, ["forest_regressor", "forest_classifier"])


@query("score_requests")
def score_requests(spark, sf_dir):
    valid, _ = scoring.split_requests(score_requests_view(spark, sf_dir))
    return scoring.score_requests(valid, *_served(spark, sf_dir))


@query("scored_requests_hold", f"""WITH {_CHECKED} SELECT request_id, temp_c, rain_1h, snow_1h, clouds_all, weather_main, is_holiday,
true AS probability_in_range, true AS class_fits, true AS risk_fits, true AS volume_in_range FROM checked WHERE errors = ''""", _REQUEST_NUMBERS)
def scored_requests_hold(spark, sf_dir):
    """What must hold for every scored request whatever the forests learned: a mean of training volumes stays among them."""
    p = F.col("congestion_probability")
    train = split_rows(spark, sf_dir)[0]
    lowest, highest = (train.agg(f("traffic_volume")).scalar() for f in (F.min, F.max))
    return score_requests(spark, sf_dir).select(
        "request_id", "temp_c", "rain_1h", "snow_1h", "clouds_all", "weather_main", "is_holiday",
        p.between(0, 1).alias("probability_in_range"),
        # the shown probability is rounded, so the edge itself may belong to either side
        ((p == 0.5) | (F.col("congestion_predicted") == (p > 0.5))).alias("class_fits"),
        (p.isin(0.4, 0.75) | (F.col("risk_level") == fields.risk_of_probability(p))).alias("risk_fits"),
        F.col("predicted_traffic_volume").between(lowest - 0.05, highest + 0.05).alias("volume_in_range"))


# --- recommendation ---------------------------------------------------------------------------

# rules are mined from the same rows, here and in the SQL
_GRID = f"""{MINED}, patterns AS (SELECT a.time_of_day AS tod, a.day_type AS day, replace(a.weather, 'Weather_', '') AS weather, b.n / a.n AS confidence,
  (b.n / a.n) / (SELECT support FROM sets WHERE items = 'High traffic') AS lift
  FROM sets b JOIN sets a ON a.traffic_level IS NULL AND a.time_of_day IS NOT DISTINCT FROM b.time_of_day
  AND a.day_type IS NOT DISTINCT FROM b.day_type AND a.weather IS NOT DISTINCT FROM b.weather
  WHERE b.traffic_level = 'High traffic' AND b.n / a.n >= {RULE_CONFIDENCE}),
grid AS (SELECT h AS hour, d AS day_type, w AS weather FROM range(24) AS a(h), (VALUES ('Weekday'), ('Weekend')) AS b(d),
  (VALUES {', '.join(f"('{w}')" for w in WEATHER)}) AS c(w)),
hist AS (SELECT hour, CASE WHEN day_of_week >= 5 THEN 'Weekend' ELSE 'Weekday' END AS day_type, weather_main AS weather,
  count(*) AS n, avg(congestion) AS congestion_rate, avg(traffic_volume) AS avg_volume FROM feat GROUP BY 1, 2, 3),
means AS (SELECT CASE WHEN day_of_week >= 5 THEN 'Weekend' ELSE 'Weekday' END AS day_type, hour, avg(traffic_volume) AS a
  FROM feat GROUP BY 1, 2),
quiet AS (SELECT day_type, string_agg(hour, ',' ORDER BY a, hour) AS quiet_hours FROM (
  SELECT * FROM means QUALIFY row_number() OVER (PARTITION BY day_type ORDER BY a, hour) <= 3) GROUP BY 1),
matched AS (SELECT g.hour, g.day_type, g.weather, r.confidence, r.lift,
  concat_ws(' + ', r.tod, r.weather, r.day) AS rule FROM grid g JOIN patterns r ON (r.tod IS NULL OR r.tod = {time_of_day('g.hour')})
  AND (r.day IS NULL OR r.day = g.day_type) AND (r.weather IS NULL OR r.weather = g.weather)),
listed AS (SELECT hour, day_type, weather, string_agg(rule, ' | ' ORDER BY round(lift, 9) DESC, rule) AS rules FROM matched GROUP BY 1, 2, 3),
advice AS (SELECT g.*, coalesce(h.n, 0) AS n, congestion_rate, base_rate, congestion_rate / base_rate AS ratio,
  CASE WHEN congestion_rate / base_rate >= 1.5 THEN 'HIGH' WHEN congestion_rate / base_rate >= 0.8 THEN 'MODERATE' ELSE 'LOW' END AS level,
  avg_volume, coalesce(h.n, 0) < 30 AS rough_estimate, quiet_hours, coalesce(rules, '') AS rules
  FROM grid g LEFT JOIN hist h USING (hour, day_type, weather) LEFT JOIN quiet USING (day_type)
  LEFT JOIN listed USING (hour, day_type, weather), (SELECT avg(congestion) AS base_rate FROM feat))"""


def _mined_rules(spark, sf_dir):
    trans = features.transactions(clean_rows(spark, sf_dir))
    return rules.rule_parts(rules.association_rules(trans, min_confidence=RULE_CONFIDENCE))


def _advice(spark, sf_dir):
    table = advice.recommend(feature_rows(spark, sf_dir), _mined_rules(spark, sf_dir))
    return table.withColumns({
        "quiet_hours": F.array_join("quiet_hours", ","), "rules": F.array_join("rules", " | "),
    })


@query("recommend", f"""WITH {FEAT}, {_GRID} SELECT *,
CASE level WHEN 'HIGH' THEN 'AVOID' WHEN 'MODERATE' THEN 'ALLOW_BUFFER' ELSE 'GOOD_TIME' END AS commuter_advice,
CASE level WHEN 'HIGH' THEN 'PREPOSITION' WHEN 'MODERATE' THEN 'MONITOR' ELSE 'ROUTINE' END AS operations_advice FROM advice""",
       ["congestion_rate", "base_rate", "ratio", "avg_volume"])
def recommend(spark, sf_dir):
    return _advice(spark, sf_dir)


@query("rule_match", f"""WITH {FEAT}, {_GRID}, seen AS (SELECT series_id, {STAMP}, hour,
  CASE WHEN day_of_week >= 5 THEN 'Weekend' ELSE 'Weekday' END AS day_type, weather_main AS weather FROM feat)
SELECT series_id, date_time, rule, confidence, lift FROM seen JOIN matched USING (hour, day_type, weather)""", ["confidence", "lift"])
def rule_match(spark, sf_dir):
    """Every observed hour with the rules it satisfies."""
    rows = feature_rows(spark, sf_dir).select(
        *KEYS, fields.time_of_day(F.col("hour")).alias("time_of_day"),
        fields.day_type(F.col("day_of_week")).alias("day_type"), advice.weather_of_onehot().alias("weather"))
    matched = advice.match_rules(rows, _mined_rules(spark, sf_dir))
    return matched.select(*KEYS, "rule", "confidence", "lift")


@query("advise_requests", f"""WITH {FEAT}, {_GRID}, {_REQUESTS}
SELECT request_id, r.hour, a.day_type, a.weather, n, level FROM requests r JOIN advice a ON a.hour = r.hour
AND a.weather = r.weather_main AND a.day_type = CASE WHEN r.day_of_week >= 5 THEN 'Weekend' ELSE 'Weekday' END
WHERE r.day_of_week <= 6 AND r.month BETWEEN 1 AND 12 AND r.temp_c IS NOT NULL AND r.rain_1h >= 0 AND r.clouds_all <= 100""")
def advise_requests(spark, sf_dir):
    valid, _ = scoring.split_requests(score_requests_view(spark, sf_dir))
    asked = valid.select("request_id", "hour", fields.day_type(F.col("day_of_week")).alias("day_type"),
                         F.col("weather_main").alias("weather"))
    table = advice.recommend(feature_rows(spark, sf_dir), _mined_rules(spark, sf_dir))
    return advice.advise_requests(asked, table).select("request_id", "hour", "day_type", "weather", "n", "level")


# --- streaming --------------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    return jobs.file_stream(spark, sf_dir, "events.parquet")


def _raw_stream(spark, sf_dir):
    return _event_stream(spark, sf_dir).select(*[c.alias(n) for n, c in event_columns().items()])


def _drained(spark, sf_dir, name, start):
    """Run a stream over the table once and return the folder of its sink."""
    def build(path):
        start(f"{path}/out", f"{path}/checkpoint").awaitTermination()

    return prepared.once(place(spark, sf_dir, f"streams/{name}"), build) + "/out"


def stream_score_folder(spark, sf_dir):
    served = _served(spark, sf_dir)
    return _drained(spark, sf_dir, "score", lambda o, c: jobs.stream_score(
        requests_from_events(_event_stream(spark, sf_dir)), *served, o, c))


@query("stream_score")
def stream_score(spark, sf_dir):
    return spark.read.parquet(stream_score_folder(spark, sf_dir))


@query("stream_rejected", f"WITH {_CHECKED} SELECT * FROM checked WHERE errors <> ''", _REQUEST_NUMBERS)
def stream_rejected(spark, sf_dir):
    out = _drained(spark, sf_dir, "rejected", lambda o, c: jobs.stream_rejected(
        requests_from_events(_event_stream(spark, sf_dir)), o, c))
    return _listed_errors(spark.read.parquet(out))


def _shuffled_stream(spark, sf_dir):
    """The events as files that hold rows of all times, one to a batch: hours and input order arrive mixed."""
    def build(path):
        spark.read.parquet(f"{sf_dir}/events.parquet").repartition(5, F.hash("event_id")).write.mode("overwrite").parquet(path)

    folder = prepared.once(place(spark, sf_dir, "events_shuffled"), build)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.select(*[c.alias(n) for n, c in event_columns().items()])


ALL_TIME = "60 days"  # nothing is late


def _first_of_stream(spark, sf_dir):
    return _drained(spark, sf_dir, "first", lambda o, c: jobs.stream_first(_shuffled_stream(spark, sf_dir), o, c, ALL_TIME))


@query("stream_first", f"""WITH {OBS} SELECT {ALL_COLUMNS}, count(*) OVER (PARTITION BY series_id, date_time) AS n FROM obs
QUALIFY row_number() OVER (PARTITION BY series_id, date_time ORDER BY ordinal) = 1""", MEASURES)
def stream_first(spark, sf_dir):
    """The first row by input order of every hour, though the rows arrive in another order."""
    return jobs.read_first(spark, _first_of_stream(spark, sf_dir)).select(*OBS_COLUMNS, "n")


@query("stream_clean", f"WITH {CLEAN} SELECT {ALL_COLUMNS} FROM clean", MEASURES)
def stream_clean(spark, sf_dir):
    """What the batch chain gives, all columns."""
    medians = cleaning.month_medians(clean_rows(spark, sf_dir))
    out = _drained(spark, sf_dir, "clean", lambda o, c: jobs.stream_clean(_shuffled_stream(spark, sf_dir), o, c, ALL_TIME))
    return jobs.read_clean(spark, out, medians).select(*OBS_COLUMNS)


def _hours_with_late(spark, sf_dir):
    return _drained(spark, sf_dir, "late", lambda o, c: jobs.stream_hourly(_shuffled_stream(spark, sf_dir), o, c, "10 days"))


@query("stream_late", f"""WITH {OBS} SELECT strftime(date_time, '%Y-%m-%d %H:%M:%S') AS hour_start, weather_main, count(*) AS arrived,
true AS late_only_if_closed FROM obs GROUP BY 1, 2""")
def stream_late(spark, sf_dir):
    """Counted and late rows of every hour and weather are together the rows that came; only closed hours have late ones."""
    out = _hours_with_late(spark, sf_dir)
    key = ["hour_start", "weather_main"]
    late = jobs.read_late(spark, out).groupBy(*key).agg(F.count(F.lit(1)).alias("late"))
    last = spark.read.parquet(f"{out}/progress").agg(F.max("seen")).scalar()
    both = jobs.read_hourly(spark, out).join(late, key, "full_outer")
    past = F.coalesce("closed", F.col("hour_start") < last - F.expr("INTERVAL 10 days"))
    return both.select(*key, (F.coalesce("n", F.lit(0)) + F.coalesce("late", F.lit(0))).alias("arrived"), (F.col("late").isNull() | past).alias("late_only_if_closed"))


@query("stream_late_share", f"WITH {OBS} SELECT count(*) AS arrived, true AS some_late, true AS some_closed, true AS some_open FROM obs")
def stream_late_share(spark, sf_dir):
    out = _hours_with_late(spark, sf_dir)
    hours = jobs.read_hourly(spark, out).agg(F.sum("n").alias("n"), F.bool_or("closed").alias("some_closed"), F.bool_or(~F.col("closed")).alias("some_open"))
    late = jobs.read_late(spark, out).agg(F.count(F.lit(1))).scalar()
    return hours.select((F.col("n") + late).alias("arrived"), (late > 0).alias("some_late"), "some_closed", "some_open")


@query("stream_drift", f"""WITH {FEAT}, {_CURRENT}, {_psi('current_rows')}
SELECT feature, psi, {_STATUS.format(x='psi')} AS status, CAST(0 AS BIGINT) AS batch_id FROM psi""", ["psi"])
def stream_drift(spark, sf_dir):
    reference, _ = _sides(spark, sf_dir)
    feature_rows(spark, sf_dir)

    def start(out, checkpoint):
        counts = drift.value_counts_of(reference, reference.limit(0), DRIFT_FEATURES)
        base = out.rsplit("/", 1)[0]
        drift.psi_edges(counts).write.mode("overwrite").parquet(f"{base}/edges")
        edges = spark.read.parquet(f"{base}/edges")
        drift.bucket_counts(counts, edges).write.mode("overwrite").parquet(f"{base}/reference")
        folder = place(spark, sf_dir, "features")
        stored = spark.read.parquet(folder).schema
        stream = spark.readStream.schema(stored).parquet(folder).where(~models.before(SPLIT))
        return jobs.stream_drift(stream, edges, spark.read.parquet(f"{base}/reference"), out, checkpoint)

    return spark.read.parquet(_drained(spark, sf_dir, "drift", start))


@query("stream_hourly", f"""WITH {OBS} SELECT strftime(date_time, '%Y-%m-%d %H:%M:%S') AS hour_start, weather_main, count(*) AS n,
avg(traffic_volume) AS avg_volume FROM obs GROUP BY 1, 2""", ["avg_volume"])
def stream_hourly(spark, sf_dir):
    """Every hour that arrived, the open ones at the end as well."""
    out = _drained(spark, sf_dir, "hourly", lambda o, c: jobs.stream_hourly(_raw_stream(spark, sf_dir), o, c))
    return jobs.read_hourly(spark, out).drop("closed")
