"""Baskets, sketches and tests of independence as queries."""

from pyspark.sql import functions as F

from flowgauge.constants import CONGESTION_THRESHOLD, MIN_SUPPORT
from flowgauge.operators import baskets, features, sketches, statistics
from flowgauge.plans import prepared
from flowgauge.plans.analysis import ITEMS
from flowgauge.plans.checks import HIST, OBS
from flowgauge.plans.prepared import clean_rows, place
from flowgauge.plans.registry import query
from flowgauge.sources.views import history, observations

# --- baskets ----------------------------------------------------------------------------------

BASKET_SUPPORT, BASKET_CONFIDENCE = 0.002, 0.14
# every subset of every order, grown brand by brand in ascending order
_SUBSETS = """RECURSIVE held AS (SELECT DISTINCT l_orderkey AS k, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IS NOT NULL),
subsets AS (SELECT k, i AS last, [i] AS items FROM held UNION ALL
  SELECT s.k, h.i, list_append(s.items, h.i) FROM subsets s JOIN held h ON h.k = s.k AND h.i > s.last),
total AS (SELECT count(DISTINCT l_orderkey) AS t FROM lineitem JOIN part ON l_partkey = p_partkey),
sets AS (SELECT items, count(*) AS n, count(*) / any_value(t) AS support FROM subsets, total
  GROUP BY items HAVING count(*) >= ceil({s}::DOUBLE * any_value(t)))""".format(s=BASKET_SUPPORT)


def _brand_sets(spark, sf_dir):
    lines, parts = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part"))
    bought = lines.select("l_orderkey", "l_partkey").join(parts.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return baskets.frequent_sets(baskets.baskets(bought, "l_orderkey", "p_brand"), BASKET_SUPPORT)


@query("basket_sets", f"WITH {_SUBSETS} SELECT array_to_string(items, ',') AS items, len(items) AS size, n, support FROM sets", ["support"])
def basket_sets(spark, sf_dir):
    """Brands bought together, sets of any size."""
    return _brand_sets(spark, sf_dir).select(F.array_join("items", ",").alias("items"), F.size("items").alias("size"), "n", "support")


@query("basket_rules", f"""WITH {_SUBSETS},
split AS (SELECT items, n, support, unnest(items) AS consequent FROM sets WHERE len(items) > 1)
SELECT array_to_string(a.items, ',') AS antecedent, consequent, s.support, s.n / a.n AS confidence, (s.n / a.n) / c.support AS lift
FROM split s JOIN sets a ON a.items = list_filter(s.items, lambda x: x <> consequent) JOIN sets c ON c.items = [consequent]
WHERE s.n / a.n >= {BASKET_CONFIDENCE}""", ["support", "confidence", "lift"])
def basket_rules(spark, sf_dir):
    found = baskets.rules_of_sets(_brand_sets(spark, sf_dir), BASKET_CONFIDENCE)
    return found.withColumn("antecedent", F.array_join("antecedent", ","))


@query("transaction_sets", f"WITH {ITEMS} SELECT items, n, support FROM sets", ["support"])
def transaction_sets(spark, sf_dir):
    """The item sets of the hourly transactions by the tree; the cube of ``itemset_supports`` must find the same."""
    items = features.with_items(features.transactions(clean_rows(spark, sf_dir)))
    return baskets.frequent_sets(items, MIN_SUPPORT).withColumn("items", F.array_join("items", ","))


# --- independence -----------------------------------------------------------------------------

@query("chi_square", f"""WITH {OBS}, cells AS (SELECT weather_main AS r, traffic_volume > {CONGESTION_THRESHOLD} AS c, count(*) AS n
  FROM obs WHERE weather_main IS NOT NULL AND traffic_volume IS NOT NULL GROUP BY ALL),
grid AS (SELECT r.r, c.c, r.n AS rn, c.n AS cn, (SELECT sum(n) FROM cells) AS t, coalesce(x.n, 0) AS n
  FROM (SELECT r, sum(n) AS n FROM cells GROUP BY 1) r CROSS JOIN (SELECT c, sum(n) AS n FROM cells GROUP BY 1) c LEFT JOIN cells x ON x.r = r.r AND x.c = c.c),
s AS (SELECT CAST(any_value(t) AS BIGINT) AS n, sum((n - rn * cn / t) * (n - rn * cn / t) / (rn * cn / t)) AS statistic,
  (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS degrees_of_freedom, least(count(DISTINCT r), count(DISTINCT c)) - 1 AS m FROM grid)
SELECT n, statistic, degrees_of_freedom, exp(-statistic / 2) * (1 + statistic / 2) AS p_value, sqrt(statistic / (n * m)) AS cramers_v FROM s""",
       ["statistic", "p_value", "cramers_v"])
def chi_square(spark, sf_dir):
    """Is congestion independent of the weather? Five kinds by two, so four degrees of freedom (the SQL's tail holds for four)."""
    congested = F.col("traffic_volume") > CONGESTION_THRESHOLD
    return statistics.chi_square(statistics.contingency(observations(spark, sf_dir), F.col("weather_main"), congested))


# --- sketches ---------------------------------------------------------------------------------

SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]
SKETCHED = ["traffic_volume", "temp"]


def _month_sketches(spark, sf_dir, name, make):
    path = prepared.once(place(spark, sf_dir, name), lambda p: make().write.mode("overwrite").partitionBy("year", "month_part").parquet(p))
    return spark.read.parquet(path)


@query("sketch_quantiles", f"""WITH {HIST} SELECT f AS feature, s AS share, true AS within_bound
FROM (VALUES {', '.join(f"('{c}')" for c in SKETCHED)}) AS a(f), (VALUES {', '.join(f"({s}::DOUBLE)" for s in SHARES)}) AS b(s)
WHERE EXISTS (SELECT 1 FROM hist)""", ["share"])
def sketch_quantiles(spark, sf_dir):
    """Quantiles from the stored monthly sketches of several years, their rank held against all rows."""
    rows = history(spark, sf_dir)
    stored = _month_sketches(spark, sf_dir, "sketches/quantiles", lambda: sketches.monthly_quantile_sketches(rows, SKETCHED))
    ranked = sketches.rank_shares(rows, sketches.quantiles_of(stored, SHARES), SKETCHED)
    e = sketches.KLL_RANK_ERROR
    return ranked.select("feature", "share", ((F.col("below") - e <= F.col("share")) & (F.col("share") <= F.col("upto") + e)).alias("within_bound"))


@query("sketch_reference", f"""WITH {HIST} SELECT year(date_time) AS year, count(*) AS n, true AS q3_within_bound FROM hist GROUP BY 1""")
def sketch_reference(spark, sf_dir):
    """The upper quartile of each year's reference, from that year's sketches alone; the rank is checked on the rows."""
    rows = history(spark, sf_dir)
    stored = _month_sketches(spark, sf_dir, "sketches/quantiles", lambda: sketches.monthly_quantile_sketches(rows, SKETCHED))
    yearly = stored.where("feature = 'traffic_volume'").groupBy("year").agg(
        F.sum("n").alias("n"), F.expr(f"kll_sketch_get_quantile_double(kll_merge_agg_double(sketch, {sketches.KLL_SIZE}), 0.75D)").alias("q3")
    )
    by_year = rows.select(F.year("date_time").alias("year"), "traffic_volume").join(yearly, "year")
    e = sketches.KLL_RANK_ERROR
    return by_year.groupBy("year", "n").agg(
        ((F.avg((F.col("traffic_volume") < F.col("q3")).cast("double")) - e <= 0.75) & (F.avg((F.col("traffic_volume") <= F.col("q3")).cast("double")) + e >= 0.75)).alias("q3_within_bound")
    )


@query("sketch_distinct", f"""WITH {HIST} SELECT count(*) AS n, count(DISTINCT (series_id, date_time)) AS distinct_keys, true AS within_bound FROM hist""")
def sketch_distinct(spark, sf_dir):
    """Distinct (series, hour) keys from stored monthly sketches beside the exact count."""
    rows = history(spark, sf_dir)
    key = F.concat_ws("|", "series_id", F.date_format("date_time", "yyyyMMddHHmmss"))
    stored = _month_sketches(spark, sf_dir, "sketches/keys", lambda: sketches.monthly_key_sketches(rows, key))
    exact = rows.agg(F.count_distinct("series_id", "date_time")).scalar()
    off = F.abs(F.col("estimate") - F.col("distinct_keys")) <= F.greatest(F.lit(2.0), sketches.HLL_ERROR * F.col("distinct_keys"))
    return sketches.distinct_of(stored).select("n", exact.alias("distinct_keys"), "estimate").select("n", "distinct_keys", off.alias("within_bound"))
