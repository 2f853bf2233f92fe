"""Column expressions shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.constants import KELVIN_OFFSET, RISK_PROBABILITY, RISK_RATIO, RUSH_HOURS


def celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(KELVIN_OFFSET)


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def is_weekend(day_of_week: Column) -> Column:
    return day_of_week >= 5


def is_rush_hour(hour: Column) -> Column:
    return hour.isin(RUSH_HOURS)


def day_type(day_of_week: Column) -> Column:
    return F.when(is_weekend(day_of_week), "Weekend").otherwise("Weekday")


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "Morning(06-11)")
        .when(hour.between(12, 16), "Afternoon(12-16)")
        .when(hour.between(17, 21), "Evening(17-21)")
        .otherwise("Night(22-05)")
    )


def graded(value: Column, bounds: tuple[float, float]) -> Column:
    """HIGH / MODERATE / LOW with inclusive bounds; NULL falls through to LOW."""
    high, moderate = bounds
    return F.when(value >= high, "HIGH").when(value >= moderate, "MODERATE").otherwise("LOW")


def risk_of_probability(probability: Column) -> Column:
    return graded(probability, RISK_PROBABILITY)


def risk_of_ratio(ratio: Column) -> Column:
    return graded(ratio, RISK_RATIO)


def clock(ts: Column) -> Column:
    """Timestamp as text, the form the SQL layer of the study keeps it in."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def year_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy")


def same_text(left: Column, right: str) -> Column:
    return F.lower(left) == right.lower()


def sample_order(seed: int, *keys: Column) -> Column:
    """A reproducible pseudo-random order that does not depend on partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
