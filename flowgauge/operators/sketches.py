"""Mergeable sketches per month: quantiles (KLL) and distinct counts (HLL) that are stored once and merged on read.

A month's rows are read when its sketch is made; reference quantiles over any set of months then read a few kilobytes
a month instead of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 200
#: Rank error of a sketch of that size with 99 % probability (about 2.3 / size**0.9, doubled for both sides).
KLL_RANK_ERROR = 0.027
HLL_BITS = 14
#: Three standard errors of 2**HLL_BITS registers.
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)


def monthly_quantile_sketches(df: DataFrame, columns: Sequence[str], time: str = "date_time") -> DataFrame:
    """(year, month_part, feature, n, sketch): one KLL sketch per month and column."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
    long = df.select(F.year(time).alias("year"), F.month(time).alias("month_part"), pairs).where("value IS NOT NULL")
    return long.groupBy("year", "month_part", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"kll_sketch_agg_double(value, {KLL_SIZE})").alias("sketch")
    )


def quantiles_of(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(feature, share, quantile) of the union of the given sketches."""
    merged = sketches.groupBy("feature").agg(F.expr(f"kll_merge_agg_double(sketch, {KLL_SIZE})").alias("sketch"))
    ranks = F.array(*[F.lit(float(s)) for s in shares])
    found = F.arrays_zip(ranks.alias("share"), F.expr(f"kll_sketch_get_quantile_double(sketch, array({', '.join(f'{float(s)}D' for s in shares)}))").alias("quantile"))
    return merged.select("feature", F.inline(found))


def rank_shares(df: DataFrame, quantiles: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, share, quantile, below, upto): the shares of rows below and up to each approximate quantile.

    A quantile is right within e if below - e <= share <= upto + e. One pass: the few quantiles are broadcast as one array a feature.
    """
    listed = quantiles.groupBy("feature").agg(F.collect_list(F.struct("share", "quantile")).alias("cuts"))  # as many as asked for
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
    values = df.select(pairs).where("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    each = values.join(F.broadcast(listed), "feature").select("feature", "value", "n", F.inline("cuts"))
    total = F.sum("n")
    return each.groupBy("feature", "share", "quantile").agg(
        (F.sum(F.when(F.col("value") < F.col("quantile"), F.col("n")).otherwise(0)) / total).alias("below"),
        (F.sum(F.when(F.col("value") <= F.col("quantile"), F.col("n")).otherwise(0)) / total).alias("upto"),
    )


def monthly_key_sketches(df: DataFrame, key: Column, time: str = "date_time") -> DataFrame:
    """(year, month_part, n, sketch): rows and one HLL sketch of the key per month."""
    keyed = df.select(F.year(time).alias("year"), F.month(time).alias("month_part"), key.alias("key"))
    return keyed.groupBy("year", "month_part").agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("key", F.lit(HLL_BITS)).alias("sketch"))


def distinct_of(sketches: DataFrame) -> DataFrame:
    """(n, estimate) of the union of the given sketches."""
    return sketches.agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
