"""Mixing sources to target weights: token budgets handed down a domain-language-source tree, prefixes of seeded epochs.

**Budgets.** Every leaf (domain, lang, source) can give ``max_epochs`` times its tokens. The total budget is divided from
the root down: a node's children share its budget in proportion to their weights, but none gets more than its subtree
can give; what a short child cannot take goes to its siblings in proportion to their weights, until all are
full or nothing is left. A node never gets more than its subtree holds, so shortages are made good among siblings
first and reach the next level up only when a whole subtree is full. Shares are rounded down to whole tokens.

**Selection.** Epoch e of a leaf is its rows in the order of an MD5 key of (seed, e, doc_id), ties by doc_id and text.
The epochs follow one another; a row is taken if fewer tokens than the budget precede it (so the last row may
cross the budget, and a zero budget takes nothing). Only the last epoch can be partial. It is cut without sorting a
leaf: rows are counted by ranges of the key, about the square root of the leaf's row count many, the range that holds
the cut is found from these sums, and only its rows are ordered. A leaf with a third of all rows is so read by all
tasks, and the ordered part stays small.

Tokens are words. Null text has none; null lang or source is the leaf ''; a missing weight is 1, weights must be
positive. Rows without tokens are taken where they stand before the cut. Repeated rows count each. An empty table
gives an empty result. Input columns named like an output column or starting with ``mix_`` are replaced.
The leaf tables have one row for each source and language; Spark picks the join side by their measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from flowgauge.llm.common import WORD, stored

LEVELS = ("domain", "lang", "source")
#: Weights by level of the registered query; names that are not listed weigh 1.
WEIGHTS = {"domain": {"web": 4, "books": 3, "code": 2}, "lang": {"en": 5, "de": 2, "fr": 2}, "source": {}}
KEY_BITS = 60
DOMAINS = ("web", "books", "code", "forum")


def domain_of(source: str = "source") -> Column:
    """The domain of a source: the number at its end picks one of four; sources without a number are 'web'."""
    number = F.expr(f"coalesce(try_cast(regexp_extract({source}, '([0-9]+)$', 1) AS BIGINT), 0)")
    return F.element_at(F.array(*map(F.lit, DOMAINS)), (number % len(DOMAINS) + 1).cast("int"))


def _weight(level: str, weights: dict[str, int]) -> Column:
    pairs = [F.lit(x) for kv in weights.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.col(level)], F.lit(1)) if pairs else F.lit(1)


def share_out(nodes: DataFrame, parent: list[str], weight: str, capacity: str, budget: str) -> DataFrame:
    """Adds ``share``: each row's part of its parent's budget, by weight, never above its capacity."""
    order = W.partitionBy(*parent).orderBy(F.col(capacity) / F.col(weight), F.col(weight), *[c for c in LEVELS if c in nodes.columns])
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (F.col(budget) - F.coalesce(F.sum(capacity).over(before), F.lit(0))) / F.sum(weight).over(onward)
    ranked = nodes.withColumn("mix_level", level).withColumn("mix_full", F.col(capacity) <= F.col("mix_level") * F.col(weight))
    # rows fill up in the order of capacity per weight; the first that doesn't sets the level for all after it
    rest = F.min(F.when(~F.col("mix_full"), F.struct(F.col(capacity) / F.col(weight), F.col(weight), *[c for c in LEVELS if c in nodes.columns], "mix_level"))).over(W.partitionBy(*parent))
    share = F.when(F.col("mix_full") | rest.isNull(), F.col(capacity)).otherwise(F.least(F.col(capacity), F.floor(rest["mix_level"] * F.col(weight))))
    return ranked.withColumn("share", share.cast("long")).drop("mix_level", "mix_full")


def budgets(leaves: DataFrame, total: Column, weights: dict[str, dict[str, int]] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """Leaves (domain, lang, source, tokens, docs) with ``budget``; ``total`` is an aggregate over leaves."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for level in LEVELS:
        leaves = leaves.withColumn(f"w_{level}", _weight(level, weights.get(level, {})))
    root = leaves.agg(F.least(total, F.coalesce(F.sum("cap"), F.lit(0))).cast("long").alias("budget")).first()["budget"]
    granted, parent = None, []
    for level in LEVELS:
        path = [*parent, level]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first(f"w_{level}").alias("w"))
        nodes = nodes.join(granted, parent) if parent else nodes.withColumn("budget", F.lit(root))
        granted = share_out(nodes, parent or [F.lit(0)], "w", "cap", "budget").select(*path, F.col("share").alias("budget"))
        parent = path
    return leaves.select(*LEVELS, "tokens", "docs").join(granted, list(LEVELS))


def epoch_key(seed: int, epoch: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    fraction: float = 0.6,
    weights: dict[str, dict[str, int]] = WEIGHTS,
    max_epochs: int = 3,
    seed: int = 7,
    domain: Column | None = None,
) -> DataFrame:
    """The selected rows with domain, n_words and epoch (0 first); ``fraction`` of all tokens is the total budget."""
    own = [c for c in docs.columns if c not in ("domain", "n_words", "epoch") and not c.startswith("mix_")]
    docs = docs.select(
        *own,
        F.coalesce(F.col("lang"), F.lit("")).alias("mix_lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("mix_source"),
        (domain_of() if domain is None else domain).alias("domain"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
    ).withColumn("domain", F.coalesce("domain", F.lit(DOMAINS[0])))
    slim = stored(docs.select("doc_id", "domain", "mix_lang", "mix_source", "n_words"), "mix-tokens")
    leaf = ["domain", "mix_lang", "mix_source"]
    leaves = slim.groupBy(*leaf).agg(F.sum("n_words").alias("tokens"), F.count("*").alias("docs"))
    leaves = leaves.withColumnsRenamed({"mix_lang": "lang", "mix_source": "source"})
    total = F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(fraction))
    plan = budgets(leaves, total, weights, max_epochs).withColumnsRenamed({"lang": "mix_lang", "source": "mix_source"})
    plan = plan.select(
        *leaf, "budget", "tokens",
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int").alias("mix_whole"),
        F.ceil(F.log2(F.greatest(F.sqrt(F.col("docs")), F.lit(1.0)))).cast("int").alias("mix_bits"),
    ).withColumn("mix_left", F.col("budget") - F.col("mix_whole") * F.col("tokens"))
    plan = stored(plan.where("budget > 0"), "mix-leaves")
    part = lambda df: df.withColumn("mix_key", epoch_key(seed, F.col("mix_whole"))).withColumn(
        "mix_range", F.expr(f"shiftright(mix_key, {KEY_BITS} - mix_bits)"))
    ranges = part(slim.join(plan, leaf)).where("mix_left > 0").groupBy(*leaf, "mix_range").agg(
        F.sum("n_words").alias("mix_sum"), F.first("mix_left").alias("mix_left"))
    before = F.coalesce(F.sum("mix_sum").over(W.partitionBy(*leaf).orderBy("mix_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cuts = ranges.withColumn("mix_before", before).where("mix_before < mix_left").groupBy(*leaf).agg(
        F.max_by("mix_before", "mix_range").alias("mix_before"), F.max("mix_range").alias("mix_cut"))
    plan = stored(plan.join(cuts, leaf, "left"), "mix-cuts")
    rows = part(docs.join(plan, leaf))
    whole = rows.where("mix_whole > 0").withColumn("epoch", F.explode(F.expr("sequence(0, mix_whole - 1)")))
    last = rows.withColumn("epoch", F.col("mix_whole"))
    below = last.where("mix_range < mix_cut")
    order = W.partitionBy(*leaf).orderBy("mix_key", "doc_id", "text").rowsBetween(W.unboundedPreceding, -1)
    at = last.where("mix_range = mix_cut").withColumn("mix_start", F.col("mix_before") + F.coalesce(F.sum("n_words").over(order), F.lit(0))).where("mix_start < mix_left")
    columns = [*own, "domain", "n_words", F.col("epoch").cast("long").alias("epoch")]
    return whole.select(*columns).unionByName(below.select(*columns)).unionByName(at.select(*columns))


def case(level: str) -> str:
    return " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in WEIGHTS[level].items())


def checking_sql(fraction: float = 0.6, max_epochs: int = 3, seed: int = 7, source: str = "documents") -> str:
    """The same rows from one ordered window over each leaf and epoch, and a share-out written level by level."""
    domains = ", ".join(f"'{d}'" for d in DOMAINS)
    weight = {x: f"CASE {case(x)} ELSE 1 END" if WEIGHTS[x] else "1" for x in LEVELS}

    def level(name: str, up: str, path: str, parent: str, w: str) -> str:
        on = f"PARTITION BY {parent}" if parent else ""
        join = f"JOIN {up} USING ({parent})" if parent else f"CROSS JOIN {up}"
        keys = ", ".join(path.split(", "))
        return f"""
{name}_n AS (SELECT {keys}, SUM(cap) AS cap, MAX({w}) AS w FROM leaf GROUP BY {keys}),
{name}_l AS (SELECT n.*, budget, (budget - COALESCE(SUM(cap) OVER ({on} ORDER BY cap / w, w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / SUM(w) OVER ({on} ORDER BY cap / w, w, {keys} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv,
  ROW_NUMBER() OVER ({on} ORDER BY cap / w, w, {keys}) AS k FROM {name}_n n {join}),
{name}_m AS (SELECT *, cap <= lv * w AS filled, MIN(CASE WHEN NOT cap <= lv * w THEN k END) OVER ({on}) AS k0 FROM {name}_l),
{name}_f AS (SELECT *, MAX(CASE WHEN k = k0 THEN lv END) OVER ({on}) AS top FROM {name}_m),
{name} AS (SELECT {keys}, CAST(CASE WHEN filled OR top IS NULL THEN cap ELSE LEAST(cap, FLOOR(top * w)) END AS BIGINT) AS budget FROM {name}_f)"""

    return f"""
WITH tok AS (SELECT *, COALESCE(len(regexp_extract_all(text, '{WORD}')), 0) AS n_words,
  [{domains}][COALESCE(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT), 0) % {len(DOMAINS)} + 1] AS domain FROM {source}),
doc AS (SELECT doc_id, text, n_words, COALESCE(domain, '{DOMAINS[0]}') AS domain, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source FROM tok),
leaf AS (SELECT domain, lang, source, CAST(SUM(n_words) AS BIGINT) AS tokens, CAST(SUM(n_words) * {max_epochs} AS BIGINT) AS cap FROM doc GROUP BY ALL),
root AS (SELECT LEAST(CAST(FLOOR(SUM(tokens) * CAST({fraction} AS DOUBLE)) AS BIGINT), SUM(cap)) AS budget FROM leaf),{level("g1", "root", "domain", "", weight["domain"])},{level("g2", "g1", "domain, lang", "domain", weight["lang"])},{level("g3", "g2", "domain, lang, source", "domain, lang", weight["source"])},
every AS (SELECT d.*, b.budget, e.epoch, l.tokens FROM doc d JOIN g3 b USING (domain, lang, source) JOIN leaf l USING (domain, lang, source), range({max_epochs}) e(epoch)),
placed AS (SELECT *, epoch * tokens + COALESCE(SUM(n_words) OVER (PARTITION BY domain, lang, source, epoch
  ORDER BY CAST('0x' || substr(md5('{seed}:' || epoch || ':' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, {KEY_BITS // 4}) AS BIGINT), doc_id, text
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM every)
SELECT doc_id, domain, lang, source, CAST(n_words AS BIGINT) AS n_words, CAST(epoch AS BIGINT) AS epoch FROM placed WHERE start < budget"""
