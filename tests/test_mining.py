"""Baskets, tests of independence, sketches and pattern rules against brute force."""

import math
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from flowgauge.operators import advice, baskets, sketches, statistics


def test_frequent_sets_and_rules_by_hand(spark):
    held = [["a", "b", "c"], ["a", "b"], ["a", "b", "b", None], ["c"], [], None, ["a", "b", "c", "d"], ["d"]]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(held)], "k long, items array<string>")
    sets = baskets.frequent_sets(df, 0.25)
    sizes = [set(x for x in h or [] if x) for h in held]
    expected = {}
    for n in range(1, 5):
        for s in combinations("abcd", n):
            count = sum(set(s) <= h for h in sizes)
            if count >= math.ceil(0.25 * len(held)):
                expected[s] = count
    assert {tuple(r["items"]): r["n"] for r in sets.collect()} == expected
    assert {r["support"] for r in sets.where("items = array('a', 'b')").collect()} == {0.5}
    rules = {(tuple(r["antecedent"]), r["consequent"]): (r["confidence"], r["lift"]) for r in baskets.rules_of_sets(sets, 0.0).collect()}
    assert set(rules) == {(tuple(x for x in s if x != c), c) for s in expected if len(s) > 1 for c in s}
    assert rules[("a", "b"), "c"] == (0.5, pytest.approx(0.5 / 0.375))


def test_baskets_take_distinct_items(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, None), (3, "y")], "k long, item string")
    assert {r["k"]: r["items"] for r in baskets.baskets(df, "k", "item").collect()} == {1: ["x"], 2: [], 3: ["y"]}
    assert baskets.frequent_sets(df.where("k > 9").select(F.array("item").alias("items")), 0.5).count() == 0


@pytest.mark.parametrize("kinds,levels", [(2, 2), (3, 2), (4, 4), (5, 2), (7, 3), (1, 3)])
def test_chi_square_is_the_library_test(spark, kinds, levels):
    rng = np.random.default_rng(kinds * 10 + levels)
    pairs = [(int(a), int((a + rng.integers(levels + 2)) % levels)) for a in rng.integers(0, kinds, 400)]
    df = spark.createDataFrame([*pairs, (None, 1), (1, None)], "a int, b int")
    got = statistics.chi_square(statistics.contingency(df, F.col("a"), F.col("b"))).first()
    whole = VectorAssembler(inputCols=["a"], outputCol="v").transform(df.dropna())
    want = ChiSquareTest.test(whole, "v", "b", flatten=True).first()
    assert got["n"] == len(pairs) and got["degrees_of_freedom"] == want["degreesOfFreedom"]
    assert got["statistic"] == pytest.approx(want["statistic"], abs=1e-9)
    assert got["p_value"] == pytest.approx(want["pValue"], abs=1e-9)


def test_upper_tail_of_known_values(spark):
    cases = [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0), (40.0, 1, 2.539628589470e-10), (24.99579013972863, 15, 0.05)]
    df = spark.createDataFrame([(x, d) for x, d, _ in cases], "x double, d int").select("x", "d", statistics.upper_tail(F.col("x"), F.col("d")).alias("p"))
    got = {(r["x"], r["d"]): r["p"] for r in df.collect()}
    assert all(got[x, d] == pytest.approx(p, rel=1e-6) for x, d, p in cases)


def test_chi_square_of_nothing(spark):
    empty = statistics.contingency(spark.createDataFrame([], "a int, b int"), F.col("a"), F.col("b"))
    assert statistics.chi_square(empty).first().asDict() == {"n": 0, "statistic": 0.0, "degrees_of_freedom": 0, "p_value": 1.0, "cramers_v": None}


def test_merged_quantile_sketches_keep_their_rank(spark):
    rng = np.random.default_rng(5)
    rows = [(f"2024-{m:02d}-01 00:00:00", float(v), float(i % 7)) for m in range(1, 13) for i, v in enumerate(rng.exponential(m, 3000))]
    df = spark.createDataFrame(rows, "t string, v double, w double").withColumn("date_time", F.col("t").cast("timestamp"))
    stored = sketches.monthly_quantile_sketches(df, ["v", "w"])
    assert stored.count() == 24 and stored.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    found = sketches.quantiles_of(stored, [0.1, 0.5, 0.9])
    ranked = sketches.rank_shares(df, found, ["v", "w"]).collect()
    assert len(ranked) == 6
    assert all(r["below"] - sketches.KLL_RANK_ERROR <= r["share"] <= r["upto"] + sketches.KLL_RANK_ERROR for r in ranked)
    some = sketches.quantiles_of(stored.where("month_part <= 3"), [0.5]).where("feature = 'v'").first()["quantile"]
    exact = np.median([v for t, v, _ in rows if t[5:7] <= "03"])
    assert some == pytest.approx(exact, rel=0.1)


def test_merged_key_sketches_count_the_union(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("key"), F.expr("timestamp'2024-01-15' + make_interval(0, id % 4)").alias("date_time"))
    one = sketches.distinct_of(sketches.monthly_key_sketches(df, F.col("key"))).first()
    assert one["n"] == 60_000 and abs(one["estimate"] - 20_000) <= sketches.HLL_ERROR * 20_000


def test_rules_match_by_pattern(spark):
    rng = np.random.default_rng(6)
    parts = [["am", "pm", None], ["wd", "we", None], ["x", "y", "z", None]]
    patterns = [p for p in product(*parts) if any(p) and rng.random() < 0.6]
    rules = [(*p, 0.5, float(i)) for i, p in enumerate(patterns)]
    rows = [(i, *(v[rng.integers(len(v))] for v in parts)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, time_of_day string, day_type string, weather string")
    got = advice.match_rules(df, spark.createDataFrame(rules, advice.RULE_SCHEMA))
    expected = sorted((row[0], lift) for row in rows for *rule, _, lift in rules if all(r is None or r == v for r, v in zip(rule, row[1:], strict=True)))
    assert sorted((r["id"], r["lift"]) for r in got.collect()) == expected
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "collect_list" not in plan
