"""Exact order statistics without bringing a whole group into one task.

Rows are first reduced to (value, count) pairs, which partial aggregation does before
the shuffle, so a value held by a third of all rows is one row per map task. The distinct
values are then cut into many narrow slots by a fixed, increasing function of the value.
Only the slot totals of a group (a few hundred thousand at most) are summed in one window;
the values themselves are summed slot by slot. Every step spills, none needs a hash map
of all distinct values as ``percentile`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS_PER_UNIT = 32768  # slots per e-fold of the value
SMALLEST = 745.0  # minus the logarithm of the smallest double


def slot_of(value: Column) -> Column:
    """Slot number; never decreases when the value grows, and needs no pass for min and max.

    Slots are narrow relative to the value at every size, so very small values are spread like large ones.

    Never NULL, so a join on it adds no filter to one side only and both can read one shuffle.
    """
    value = value.cast("double")
    size = F.floor((F.ln(F.when(value != 0, F.abs(value))) + SMALLEST) * SLOTS_PER_UNIT).cast("long")
    slot = F.when(value < 0, -size).otherwise(size)
    return F.coalesce(slot, F.lit(0).cast("long"))


def value_counts(df: DataFrame, value: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, value, n) over the rows whose value is not null."""
    return (
        df.select(*keys, value.cast("double").alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running_totals(counts: DataFrame, weights: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Add ``before_w`` (sum of w over smaller values) and ``all_w`` (sum over the group).

    ``counts`` holds one row per (keys, value).
    """
    slotted = counts.withColumn("_slot", slot_of(F.col("value")))
    totals = slotted.groupBy(*keys, "_slot").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    by_slot = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "_slot",
        *[F.coalesce(F.sum(f"_sum_{w}").over(by_slot), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(f"_sum_{w}").over(whole).alias(f"all_{w}") for w in weights],
    )
    inside = (
        Window.partitionBy(*keys, "_slot").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    )
    return slotted.join(offsets, [*keys, "_slot"]).select(
        *counts.columns,
        *[
            (F.col(f"_off_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0))).alias(f"before_{w}")
            for w in weights
        ],
        *[f"all_{w}" for w in weights],
    )


def quantiles_of_counts(
    counts: DataFrame, probabilities: Sequence[float], keys: Sequence[str] = (),
    weight: str = "n", totals: Sequence[str] = (),
) -> DataFrame:
    """(keys, q) with the linearly interpolated quantiles as an array, from ``value_counts``.

    Values count ``weight`` times, none when it is 0. ``totals`` names weights whose group sums are
    wanted beside the quantiles, as ``all_<name>``.
    """
    def picked(p: float) -> str:
        rank = f"({float(p)!r}D * (all_{weight} - 1))"
        last = f"before_{weight} + {weight} - 1"
        return f"""named_struct(
            'lo', min(CASE WHEN {last} >= floor({rank}) THEN value END),
            'hi', min(CASE WHEN {last} >= ceil({rank}) THEN value END),
            'part', max({rank} - floor({rank})))"""

    around = F.expr(f"array({', '.join(picked(p) for p in probabilities)})").alias("_around")
    q = F.expr("transform(_around, a -> a.lo + a.part * (a.hi - a.lo))").alias("q")
    # the last running total is the group sum; reading it here keeps every branch on the same columns
    sums = [F.max(F.col(f"before_{t}") + F.col(t)).alias(f"all_{t}") for t in totals]
    ranked = running_totals(counts, list(dict.fromkeys([weight, *totals])), keys)
    return ranked.groupBy(*keys).agg(around, *sums).select(*keys, q, *[f"all_{t}" for t in totals])


def exact_quantiles(
    df: DataFrame, value: Column, probabilities: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    return quantiles_of_counts(value_counts(df, value, keys), probabilities, keys)


def approximate_quantiles(
    df: DataFrame, value: Column, probabilities: Sequence[float], keys: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """One-pass sketch with rank error 1/accuracy, for when exactness is not needed."""
    q = F.percentile_approx(value.cast("double"), [float(p) for p in probabilities], accuracy)
    return df.groupBy(*keys).agg(q.alias("q"))


def quantile_scalar(df: DataFrame, value: Column, probability: float, approximate: bool = False) -> Column:
    """One quantile of the whole frame as an uncorrelated scalar subquery."""
    compute = approximate_quantiles if approximate else exact_quantiles
    return compute(df, value, [probability]).select(F.col("q")[0]).scalar()
