"""Travel advice for every (hour, day type, weather) combination at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.constants import ROUGH_ESTIMATE, TOP_RULES, WEATHER
from flowgauge.functions.fields import day_type, risk_of_ratio, time_of_day

COMBINATION = ["hour", "day_type", "weather"]
RULE_SCHEMA = "time_of_day string, day_type string, weather string, confidence double, lift double"
DAY_TYPES = ["Weekday", "Weekend"]


def published_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOP_RULES, RULE_SCHEMA)


def combinations(spark: SparkSession) -> DataFrame:
    """The fixed 24 x 2 x 11 grid, numbered rather than joined."""
    i = F.col("id").cast("int")
    weather, days = F.array(*[F.lit(w) for w in WEATHER]), F.array(*[F.lit(d) for d in DAY_TYPES])
    per_hour = len(WEATHER) * len(DAY_TYPES)
    return spark.range(24 * per_hour, numPartitions=1).select(
        F.floor(i / per_hour).cast("int").alias("hour"),
        days[F.floor(i / len(WEATHER)).cast("int") % len(DAY_TYPES)].alias("day_type"),
        weather[i % len(WEATHER)].alias("weather"),
    )


def weather_of_onehot() -> Column:
    return F.coalesce(*[F.when(F.col("weather_" + w) == 1, F.lit(w)) for w in WEATHER])


def combination_history(features: DataFrame) -> DataFrame:
    """Rows, congested rows and volume per combination: the fact table is read once, here."""
    return features.groupBy(
        "hour", day_type(F.col("day_of_week")).alias("day_type"), weather_of_onehot().alias("weather")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum("congestion").alias("congested"), F.sum("traffic_volume").alias("volume")
    )


PARTS = ["time_of_day", "day_type", "weather"]
_MASKS = [[p for i, p in enumerate(PARTS) if m >> i & 1] for m in range(2 ** len(PARTS))]


def _pattern(given: list[str]) -> Column:
    """The key of the pattern that names the given parts and leaves the others open; NULL where a given part is missing."""
    parts = [F.concat(F.lit("="), F.col(p)) if p in given else F.lit("*") for p in PARTS]
    return F.concat(*[F.concat(p, F.lit("\n")) for p in parts])


def rule_name(rule: Column | None = None) -> Column:
    part = F.col if rule is None else rule.__getitem__
    return F.concat_ws(" + ", part("time_of_day"), part("weather"), part("day_type"))


def match_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per (row, matching rule), for rows with time_of_day, day_type and weather.

    A rule's missing part matches anything. Rules are indexed by their pattern: every distinct combination of parts in df asks for the eight
    patterns that fit it, in one equi-join however many rules there are; the matches are then joined back to the rows.
    """
    key = F.coalesce(*[F.when(_only(m), _pattern(m)) for m in _MASKS])
    indexed = rules.select(key.alias("_key"), rule_name().alias("rule"), "confidence", "lift")
    asked = df.select(*PARTS).distinct().withColumn("_key", F.explode(F.array_compact(F.array(*[_pattern(m) for m in _MASKS]))))
    matched = asked.join(indexed, "_key").select(*[F.col(p).alias(f"_{p}") for p in PARTS], "rule", "confidence", "lift")
    same = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in PARTS]
    return df.join(matched, same[0] & same[1] & same[2]).select(*df.columns, "rule", "confidence", "lift")


def _only(given: list[str]) -> Column:
    tests = [F.col(p).isNotNull() if p in given else F.col(p).isNull() for p in PARTS]
    return tests[0] & tests[1] & tests[2]


def recommend(features: DataFrame, rules: DataFrame) -> DataFrame:
    """History, risk, quiet alternatives, matching rules and advice codes of all combinations."""
    spark = features.sparkSession
    seen = combination_history(features)
    base = seen.agg(F.sum("congested") / F.sum("n")).scalar()

    means = seen.groupBy("day_type", "hour").agg((F.sum("volume") / F.sum("n")).alias("avg_volume"))
    calm = Window.partitionBy("day_type").orderBy("avg_volume", "hour")  # 24 rows
    quiet = (
        means.withColumn("_n", F.row_number().over(calm)).where("_n <= 3")
        .groupBy("day_type")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", "hour"))), lambda s: s["hour"]).alias("quiet_hours"))
    )
    grid = combinations(spark).withColumn("time_of_day", time_of_day(F.col("hour")))
    strongest = F.array_sort(F.collect_list(F.struct((-F.round("lift", 9)).alias("k"), "rule")))
    listed = match_rules(grid, rules).groupBy(*COMBINATION).agg(F.transform(strongest, lambda r: r["rule"]).alias("rules"))
    rate = F.try_divide(F.col("congested"), F.col("n"))
    return (
        grid.join(seen, COMBINATION, "left")
        .join(listed, COMBINATION, "left")
        .join(F.broadcast(quiet), "day_type", "left")  # two rows
        .withColumns({
            "n": F.coalesce("n", F.lit(0)),
            "congestion_rate": rate,
            "base_rate": base,
            "avg_volume": F.try_divide(F.col("volume"), F.col("n")),
        })
        # no history leaves the ratio NULL, which grades LOW
        .withColumn("ratio", F.try_divide("congestion_rate", "base_rate"))
        .withColumn("level", risk_of_ratio(F.col("ratio")))
        .select(
            *COMBINATION, "n", "congestion_rate", "base_rate", "ratio", "level", "avg_volume",
            (F.col("n") < ROUGH_ESTIMATE).alias("rough_estimate"), "quiet_hours",
            F.coalesce("rules", F.array().cast("array<string>")).alias("rules"),
            F.when(F.col("level") == "HIGH", "AVOID").when(F.col("level") == "MODERATE", "ALLOW_BUFFER")
            .otherwise("GOOD_TIME").alias("commuter_advice"),
            F.when(F.col("level") == "HIGH", "PREPOSITION").when(F.col("level") == "MODERATE", "MONITOR")
            .otherwise("ROUTINE").alias("operations_advice"),
        )
    )


def advise_requests(requests: DataFrame, advice: DataFrame) -> DataFrame:
    """Advice for a request table with hour, day_type and weather."""
    return requests.join(F.broadcast(advice), COMBINATION)  # 528 rows
