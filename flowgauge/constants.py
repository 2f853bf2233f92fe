"""Results only agree with the published study when these are equal."""

RAW_TYPES = {
    "holiday": "string",
    "temp": "double",
    "rain_1h": "double",
    "snow_1h": "double",
    "clouds_all": "int",
    "weather_main": "string",
    "weather_description": "string",
    "date_time": "timestamp",
    "traffic_volume": "bigint",
}

WEATHER = [
    "Clear", "Clouds", "Drizzle", "Fog", "Haze", "Mist",
    "Rain", "Smoke", "Snow", "Squall", "Thunderstorm",
]
SEVERE_WEATHER = ["Snow", "Thunderstorm", "Squall", "Fog"]
RUSH_HOURS = [6, 7, 8, 9, 15, 16, 17, 18]

NO_HOLIDAY = "None"            # text, not NULL
ZERO_KELVIN = 0.0              # sensor error
KELVIN_OFFSET = 273.15
RAIN_SPIKE_MM = 100.0
HEAVY_RAIN_MM = 5.0

CONGESTION_THRESHOLD = 5500    # raw-data definition; the feature table uses Q3 instead
HOT_KELVIN = 292.0
CONGESTION_QUANTILE = 0.75
SMALL_SAMPLE = 100
ROUGH_ESTIMATE = 30

LOOKBACK_ROWS = 24
EVERY_NTH = 3
SEQUENCE_CHANNELS = ["traffic_volume", "temp_c", "rain_1h", "clouds_all"]

MIN_SUPPORT = 0.05
MIN_CONFIDENCE = 0.5
HIGH_TRAFFIC = "High traffic"
NORMAL_TRAFFIC = "Normal traffic"

PSI_BINS = 10
PSI_FLOOR = 1e-6
PSI_WARN, PSI_ALERT = 0.10, 0.25
MAE_DEGRADATION = 1.5
DRIFT_HEAT_C = 15.0
DRIFT_RAIN_FACTOR = 10.0
REFERENCE_LAST_MONTH = 9

RISK_PROBABILITY = (0.75, 0.4)   # HIGH, MODERATE
RISK_RATIO = (1.5, 0.8)          # HIGH, MODERATE, against the base rate

CLUSTER_COUNTS = [2, 3, 4, 5]
CLUSTER_RESTARTS = 10
KMEANS_ITERATIONS = 300
FOREST_TREES = 100
SEED = 42

FEATURES = [
    "temp_c", "rain_1h", "snow_1h", "clouds_all", "hour", "day_of_week", "month",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "is_weekend", "is_rush_hour", "is_holiday",
] + ["weather_" + name for name in WEATHER]

DRIFT_FEATURES = ["temp_c", "rain_1h", "snow_1h", "clouds_all"] + ["weather_" + name for name in WEATHER]

CLUSTER_FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "temp_c", "rain_1h", "snow_1h", "clouds_all",
    "is_weekend", "is_rush_hour", "is_holiday",
]

# (time of day, day type, weather, confidence, lift); None matches anything
TOP_RULES = [
    ("Afternoon(12-16)", "Weekday", "Clouds", 0.741, 2.96),
    ("Afternoon(12-16)", "Weekday", None, 0.716, 2.86),
    ("Morning(06-11)", "Weekday", None, 0.593, 2.37),
    ("Afternoon(12-16)", None, "Clouds", 0.564, 2.25),
    ("Afternoon(12-16)", None, None, 0.545, 2.18),
]
