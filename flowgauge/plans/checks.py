"""SQL building blocks of the checking queries: the same views and tables, in plain SQL."""

from flowgauge.constants import RUSH_HOURS, WEATHER
from flowgauge.plans.prepared import SPLIT
from flowgauge.sources.views import EVENT_HOLIDAYS, EVENT_WEATHER, HISTORY_HOLIDAYS


def _case(value: str, names: dict[str, str], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    return f"CASE {value} {whens} ELSE {otherwise} END"


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
OBS = f"""obs AS (
  SELECT user_id AS series_id, event_id AS ordinal,
         CASE WHEN hour(ts) = 0 THEN {_case("strftime(ts, '%Y-%m-%d')", EVENT_HOLIDAYS, "'None'")} ELSE 'None' END AS holiday,
         CASE WHEN {K} = 0 THEN 0.0::DOUBLE ELSE 250.0::DOUBLE + 0.5::DOUBLE * {K} END AS temp,
         CASE WHEN event_type = 'error' THEN value ELSE 0.0::DOUBLE END AS rain_1h,
         CASE WHEN event_type = 'signup' THEN (user_id % 10) / 10.0::DOUBLE ELSE 0.0::DOUBLE END AS snow_1h,
         {K} AS clouds_all,
         {_case("event_type", EVENT_WEATHER)} AS weather_main,
         event_type AS weather_description,
         date_trunc('hour', ts) AS date_time,
         CAST(round(value * 100) AS BIGINT) AS traffic_volume
  FROM events)"""
HIST = f"""hist AS (
  SELECT o_custkey % 10 AS series_id, o_orderkey AS ordinal,
         {_case("strftime(o_orderdate, '%m-%d')", HISTORY_HOLIDAYS, "'None'")} AS holiday,
         CASE WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE ELSE 250.0::DOUBLE + (o_custkey % 600) / 10.0::DOUBLE END AS temp,
         0.0::DOUBLE AS rain_1h, 0.0::DOUBLE AS snow_1h, o_orderkey % 101 AS clouds_all,
         o_orderpriority AS weather_main, o_orderstatus AS weather_description,
         o_orderdate AS date_time, CAST(round(o_totalprice * 100) AS BIGINT) AS traffic_volume
  FROM orders)"""


def cleaned(source: str, name: str = "clean") -> str:
    """CTEs that clean ``source``."""
    return f"""kept AS (
  SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY series_id, date_time ORDER BY ordinal) = 1),
medians AS (
  SELECT month(date_time) AS month_no, quantile_cont(temp, 0.5) AS median_temp FROM kept WHERE temp <> 0 GROUP BY 1),
{name} AS (
  SELECT series_id, ordinal, coalesce(holiday, 'None') AS holiday,
         CASE WHEN temp = 0 THEN median_temp ELSE temp END AS temp,
         CASE WHEN rain_1h > 100 THEN 0.0::DOUBLE ELSE rain_1h END AS rain_1h,
         snow_1h, clouds_all, weather_main, weather_description, date_time, traffic_volume
  FROM kept LEFT JOIN medians ON month(date_time) = month_no)"""


CLEAN = f"{OBS},\n{cleaned('obs')}"

_hot = ",\n         ".join(
    f"CAST(coalesce(weather_main = '{w}', false) AS BIGINT) AS weather_{w}" for w in WEATHER
)
_cyc = ",\n         ".join(
    f"{f}(2 * pi() * {c} / {n}) AS {p}_{f}" for p, c, n in (("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12))
    for f in ("sin", "cos")
)


def featured(source: str = "clean", name: str = "feat") -> str:
    return f"""marked AS (SELECT DISTINCT CAST(date_time AS DATE) AS d FROM {source} WHERE holiday <> 'None'),
dated AS (
  SELECT *, temp - 273.15::DOUBLE AS temp_c, hour(date_time) AS hour, isodow(date_time) - 1 AS day_of_week,
         month(date_time) AS month
  FROM {source}),
{name} AS (
  SELECT series_id, ordinal, date_time, traffic_volume, weather_main,
         CAST(traffic_volume >= (SELECT quantile_cont(traffic_volume, 0.75) FROM {source}) AS BIGINT) AS congestion,
         temp_c, rain_1h, snow_1h, clouds_all, hour, day_of_week, month,
         {_cyc},
         CAST(day_of_week >= 5 AS BIGINT) AS is_weekend,
         CAST(hour IN ({', '.join(map(str, RUSH_HOURS))}) AS BIGINT) AS is_rush_hour,
         CAST(CAST(date_time AS DATE) IN (SELECT d FROM marked) AS BIGINT) AS is_holiday,
         {_hot}
  FROM dated)"""


FEAT = f"{CLEAN},\n{featured()}"
TRAIN = f"date_time < TIMESTAMP '{SPLIT}'"
TEST = f"date_time >= TIMESTAMP '{SPLIT}'"
STAMP = "strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time"

TIME_OF_DAY = (
    "CASE WHEN {h} BETWEEN 6 AND 11 THEN 'Morning(06-11)' WHEN {h} BETWEEN 12 AND 16 THEN 'Afternoon(12-16)' "
    "WHEN {h} BETWEEN 17 AND 21 THEN 'Evening(17-21)' ELSE 'Night(22-05)' END"
)


def time_of_day(hour: str) -> str:
    return TIME_OF_DAY.format(h=hour)
