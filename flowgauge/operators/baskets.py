"""Frequent item sets and rules over baskets of any size, by an FP-tree.

``rules.itemsets`` counts cells of a cube and needs one item per attribute; here a basket is any set of items. The tree
is grown by Spark's distributed FPGrowth: baskets are sent, cut down to frequent items, to the groups of their items, so
no task holds all of them. Rules are joins of the frequent sets with their parts.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def baskets(rows: DataFrame, key: str, item: str) -> DataFrame:
    """One row per key with its distinct items; a key whose items are all null has an empty basket."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias("items"))


def frequent_sets(baskets: DataFrame, min_support: float, items: str = "items", partitions: int | None = None) -> DataFrame:
    """(items, n, support) of all sets held by at least ``min_support`` of the baskets; ``items`` is sorted.

    Repeated and null items of a basket count once and never; null and empty baskets count in the total.
    """
    held = baskets.select(F.array_distinct(F.array_compact(F.coalesce(items, F.array().cast("array<string>")))).alias("items"))
    total = held.agg(F.count(F.lit(1))).scalar()
    tree = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0)
    if partitions:
        tree = tree.setNumPartitions(partitions)
    found = tree.fit(held).freqItemsets
    return found.select(F.array_sort("items").alias("items"), F.col("freq").alias("n"), (F.col("freq") / total).alias("support"))


def rules_of_sets(sets: DataFrame, min_confidence: float) -> DataFrame:
    """(antecedent, consequent, support, confidence, lift): every frequent set of two or more, split at each of its items.

    All parts of a frequent set are frequent, so the joins lose none.
    """
    whole = sets.where(F.size("items") > 1).select("items", "n", "support", F.explode("items").alias("consequent"))
    whole = whole.withColumn("antecedent", F.array_remove("items", F.col("consequent")))
    part = sets.select(F.col("items").alias("antecedent"), F.col("n").alias("n_if"))
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), F.col("support").alias("base"))
    confidence = F.col("n") / F.col("n_if")
    return (
        whole.join(part, "antecedent").join(single, "consequent")
        .select("antecedent", "consequent", "support", confidence.alias("confidence"), (confidence / F.col("base")).alias("lift"))
        .where(F.col("confidence") >= min_confidence)
    )
