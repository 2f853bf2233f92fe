"""Descriptive statistics, correlation and conditional probability on raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.constants import CONGESTION_THRESHOLD, HOT_KELVIN
from flowgauge.functions.ordered import quantiles_of_counts, value_counts


def moments(counts: DataFrame) -> DataFrame:
    """n, mean, std, variance, min, max and population skewness of (value, n) pairs; the pairs are summed about their mean."""
    v, n = F.col("value"), F.col("n")
    mean = counts.agg(F.try_divide(F.sum(v * n), F.sum(n))).scalar()
    d = v - mean
    sums = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.sum(d * d * n).alias("_2"), F.sum(d * d * d * n).alias("_3"), F.min(v).alias("min"), F.max(v).alias("max"),
    )
    spread = F.try_divide(F.col("_2"), F.col("n") - 1)
    return sums.select(
        "n", mean.alias("mean"), F.sqrt(spread).alias("std"), spread.alias("variance"), "min", "max",
        F.try_divide(F.col("_3") / F.col("n"), F.pow(F.col("_2") / F.col("n"), 1.5)).alias("_g1"),
    )


def describe(df: DataFrame, column: str = "traffic_volume") -> DataFrame:
    """Count, mean, quartiles, sample deviation and variance, range and bias-corrected skew in one row.

    The rows are read once, into (value, count) pairs; all figures come from that one shuffle.
    """
    counts = value_counts(df, F.col(column))
    quartiles = quantiles_of_counts(counts, [0.25, 0.5, 0.75]).select("q").scalar()
    n = F.col("n").cast("double")
    kind = df.schema[column].dataType
    return (
        moments(counts).withColumns({c: F.col(c).cast(kind) for c in ("min", "max")})
        .withColumn("_q", quartiles)
        .select(
            "n", "mean", F.col("_q")[1].alias("median"), "std", "variance", "min", "max",
            (F.col("max") - F.col("min")).alias("range"),
            F.col("_q")[0].alias("q1"), F.col("_q")[2].alias("q3"),
            (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"),
            # Spark's skewness is the population form
            F.try_divide(F.col("_g1") * F.sqrt(n * (n - 1)), n - 2).alias("skew"),
        )
    )


def correlation(df: DataFrame, x: str = "temp", y: str = "traffic_volume") -> DataFrame:
    return df.agg(F.corr(x, y).alias("r")).withColumn("r_squared", F.pow("r", F.lit(2.0)))


def threshold_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "congested": F.col("traffic_volume") > CONGESTION_THRESHOLD,
        "hot": F.col("temp") > HOT_KELVIN,
        "clear": F.col("weather_main") == "Clear",
        "cloudy": F.col("weather_main") == "Clouds",
    })


def _counts(df: DataFrame) -> DataFrame:
    cong = F.col("congested")
    return threshold_flags(df).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(cong).alias("n_congested"),
        F.count_if("clear").alias("n_clear"),
        F.count_if("cloudy").alias("n_cloudy"),
        F.count_if(cong & F.col("clear")).alias("n_congested_clear"),
        F.count_if(cong & F.col("cloudy")).alias("n_congested_cloudy"),
        F.count_if(cong & F.col("hot")).alias("n_congested_hot"),
    )


def share(part: str, whole: str) -> Column:
    """NULL, not an error, when the whole is empty."""
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def probabilities(df: DataFrame) -> DataFrame:
    return _counts(df).select(
        "n", "n_congested", "n_clear", "n_congested_clear", "n_congested_hot",
        share("n_congested", "n").alias("p_congested"),
        share("n_clear", "n").alias("p_clear"),
        share("n_congested_clear", "n").alias("p_congested_and_clear"),
        share("n_congested_clear", "n_congested").alias("p_clear_given_congested"),
        share("n_congested_hot", "n_congested").alias("p_hot_given_congested"),
    )


def independence(df: DataFrame) -> DataFrame:
    """Product of the marginals against the joint probability; compared exactly, on counts."""
    observed = F.col("n_congested_clear") * F.col("n")
    expected = F.col("n_congested") * F.col("n_clear")
    return _counts(df).select(
        (share("n_congested", "n") * share("n_clear", "n")).alias("p_product"),
        share("n_congested_clear", "n").alias("p_joint"),
        F.when(observed < expected, "LOWER").when(observed > expected, "HIGHER").otherwise("INDEPENDENT")
        .alias("verdict"),
    )


def odds(p: Column) -> Column:
    return F.try_divide(p, F.lit(1.0) - p)


def odds_ratio(df: DataFrame) -> DataFrame:
    rates = _counts(df).select(
        share("n_congested_clear", "n_clear").alias("p_clear"),
        share("n_congested_cloudy", "n_cloudy").alias("p_cloudy"),
    )
    return rates.withColumns({
        "odds_clear": odds(F.col("p_clear")), "odds_cloudy": odds(F.col("p_cloudy")),
    }).withColumn("odds_ratio", F.try_divide("odds_clear", "odds_cloudy"))


def congestion_by_weather(df: DataFrame) -> DataFrame:
    return threshold_flags(df).groupBy("weather_main").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("congested").alias("n_congested"),
        F.avg(F.col("congested").cast("int")).alias("p_congested"),
    )


def contingency(df: DataFrame, row: Column, column: Column) -> DataFrame:
    """(row_value, column_value, n) of all pairs that occur with neither null: the fact table is read once, here."""
    pairs = df.select(row.alias("row_value"), column.alias("column_value")).where("row_value IS NOT NULL AND column_value IS NOT NULL")
    return pairs.groupBy("row_value", "column_value").agg(F.count(F.lit(1)).alias("n"))


def chi_square(table: DataFrame) -> DataFrame:
    """Test of independence on a contingency table: n, statistic, degrees of freedom, p_value, Cramer's V.

    Cells that don't occur add their expected count: sum(O**2 / E) - n. One row; p_value is 1 without degrees of freedom.
    The upper tail of the distribution is the library's, so p-values below 1e-16 are 0.
    """
    rows = table.groupBy("row_value").agg(F.sum("n").alias("row_n"))
    columns = table.groupBy("column_value").agg(F.sum("n").alias("column_n"))
    share = F.col("n") * F.col("n") / F.col("row_n") / F.col("column_n")
    cells = table.join(rows, "row_value").join(columns, "column_value")
    one = cells.agg(
        F.sum("n").alias("n"), F.sum(share).alias("shares"),
        F.count_distinct("row_value").alias("n_rows"), F.count_distinct("column_value").alias("n_columns"),
    )
    dof = F.greatest(F.col("n_rows") - 1, F.lit(0)) * F.greatest(F.col("n_columns") - 1, F.lit(0))
    least = F.least("n_rows", "n_columns") - 1
    found = one.select(
        F.coalesce("n", F.lit(0)).alias("n"),
        F.greatest(F.lit(0.0), F.coalesce(F.col("n") * (F.col("shares") - 1), F.lit(0.0))).alias("statistic"),
        dof.alias("degrees_of_freedom"), least.alias("_least"),
    )
    v = F.sqrt(F.try_divide("statistic", F.col("n") * F.col("_least")))
    return found.withColumn("p_value", upper_tail(F.col("statistic"), F.col("degrees_of_freedom"))).withColumn("cramers_v", v).drop("_least")


def upper_tail(statistic: Column, dof: Column) -> Column:
    """P(chi-square > statistic) for whole degrees of freedom, by the finite sums of its even and odd cases."""
    half = statistic / 2
    begin = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    # even: exp(-x/2) sum of (x/2)^i / i!, i < dof/2
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(dof / 2).cast("int")))
    even = F.exp(-half) * F.aggregate(
        steps, begin, lambda a, i: F.struct((a["term"] * half / i).alias("term"), (a["total"] + a["term"]).alias("total")), lambda a: a["total"]
    )
    # odd: erfc(sqrt(x/2)) + exp(-x/2) sum of (x/2)^(i - 1/2) / gamma(i + 1/2), i = 1 .. (dof - 1)/2
    first = F.struct((F.sqrt(half) / (0.5 * 3.141592653589793**0.5)).alias("term"), F.lit(0.0).alias("total"))
    odd_steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor((dof - 1) / 2).cast("int")))
    odd = F.aggregate(
        odd_steps, first, lambda a, i: F.struct((a["term"] * half / (i + 0.5)).alias("term"), (a["total"] + a["term"]).alias("total")), lambda a: a["total"]
    )
    odd = normal_tail(F.sqrt(statistic)) * 2 + F.when(dof > 1, F.exp(-half) * odd).otherwise(0.0)
    return F.when(dof < 1, 1.0).when(dof % 2 == 0, even).otherwise(odd)


def normal_tail(z: Column, steps: int = 60) -> Column:
    """P(Z > z) of the normal distribution for z >= 0: a series below 3, a continued fraction above."""
    density = F.exp(-z * z / 2) / (2 * 3.141592653589793) ** 0.5
    term, total = z, z
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), F.struct(term.alias("term"), total.alias("total")),
        lambda a, i: F.struct((a["term"] * z * z / (2 * i + 1)).alias("term"), (a["total"] + a["term"] * z * z / (2 * i + 1)).alias("total")),
        lambda a: a["total"],
    )
    fraction = F.aggregate(F.sequence(F.lit(steps), F.lit(1), F.lit(-1)), z, lambda a, i: z + i / a)
    return F.when(z < 3, F.lit(0.5) - density * series).otherwise(density / F.when(z < 3, F.lit(1.0)).otherwise(fraction))
