"""Frequent item sets and association rules.

A transaction holds exactly one item per attribute, so every item set is a cell of a cube.
Rows are reduced to distinct attribute tuples first; the cube then expands that small table,
not the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.constants import HIGH_TRAFFIC, MIN_CONFIDENCE, MIN_SUPPORT

ATTRIBUTES = ["time_of_day", "day_type", "weather", "traffic_level"]


def itemsets(trans: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(items, n, support) of all frequent item sets; ``items`` is sorted.

    A missing attribute is in no set; the rows that hold it count where it is rolled up.
    """
    tuples = trans.groupBy(*ATTRIBUTES).agg(F.count(F.lit(1)).alias("n"))
    total = tuples.agg(F.sum("n")).scalar()
    items = F.array_sort(F.array_compact(F.array(*ATTRIBUTES)))
    return (
        tuples.cube(*ATTRIBUTES)
        .agg(F.sum("n").alias("n"), *[F.grouping(c).alias(f"_all_{c}") for c in ATTRIBUTES])
        .where(" AND ".join(f"(({c} IS NULL) = (_all_{c} = 1))" for c in ATTRIBUTES))
        .select(items.alias("items"), "n", (F.col("n") / total).alias("support"))
        .where((F.col("support") >= min_support) & (F.size("items") > 0))
    )


def association_rules(
    trans: DataFrame, consequent: str = HIGH_TRAFFIC,
    min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules ``antecedent -> consequent`` with support, confidence and lift."""
    frequent = itemsets(trans, min_support)
    whole = frequent.where(F.array_contains("items", consequent) & (F.size("items") > 1)).select(
        F.array_remove("items", consequent).alias("antecedent"), F.col("support"), F.col("n").alias("n_both"),
    )
    part = frequent.select(F.col("items").alias("antecedent"), F.col("n").alias("n_if"))
    base = frequent.where(F.col("items") == F.array(F.lit(consequent))).select("support").scalar()
    confidence = F.col("n_both") / F.col("n_if")
    return (
        whole.join(part, "antecedent")
        .select("antecedent", "support", confidence.alias("confidence"), (confidence / base).alias("lift"))
        .where(F.col("confidence") >= min_confidence)
    )


def top_rules(rules: DataFrame, n: int = 5) -> DataFrame:
    return rules.orderBy(F.desc("lift"), F.array_join("antecedent", ",")).limit(n)


def rule_parts(rules: DataFrame) -> DataFrame:
    """Mined rules as the pattern table the recommender reads: a missing part matches anything."""
    def first(pattern: str) -> Column:
        return F.try_element_at(F.filter("antecedent", lambda i: i.rlike(pattern)), F.lit(1))

    return rules.select(
        first("^(Morning|Afternoon|Evening|Night)").alias("time_of_day"),
        first("^Week(day|end)$").alias("day_type"),
        F.replace(first("^Weather_"), F.lit("Weather_"), F.lit("")).alias("weather"),
        "confidence", "lift",
    )
