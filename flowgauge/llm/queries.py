"""The registered query of each operator, over its whole table, and the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import alignment, jaccard, main_text, mixing, neighbours, quality, sentencepiece, substrings, suffixes, surrogates, topk, toxicity, whitening
from flowgauge.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@registered
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@registered
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"))


ORACLES["op2_substrings"] = """
WITH w AS (SELECT doc_id, COALESCE(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM w, unnest(range(1, len(w) - 33)) AS u(i) WHERE len(w) >= 35),
d AS (SELECT doc_id, i FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING COUNT(*) > 1)),
g AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 35)))) AS gone FROM d GROUP BY doc_id),
k AS (SELECT w.doc_id, len(w) AS n_words, COALESCE(len(gone), 0) AS n_removed,
  list_filter(list_transform(w, lambda x, i: CASE WHEN list_contains(COALESCE(gone, []), i) THEN NULL ELSE x END), lambda x: x IS NOT NULL) AS kept
  FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""


@registered
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    return quality.score(documents.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


@registered
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.mix(table(spark, sf_dir, "documents"))
    none = F.lit("")
    return chosen.select("doc_id", "domain", F.coalesce("lang", none).alias("lang"), F.coalesce("source", none).alias("source"), "n_words", "epoch")


ORACLES["op4_mixing"] = mixing.checking_sql()


@registered
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encoded_with_check(table(spark, sf_dir, "documents"))


@registered
def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents"))


ORACLES["op6_suffixes"] = """
WITH t AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, i, substr(x, 2 * i - 1, 100) AS h FROM t, unnest(range(1, length(x) // 2 - 48)) AS u(i) WHERE length(x) >= 100),
m AS (SELECT md5_number(h) AS h, MIN(doc_id) AS least FROM s GROUP BY ALL),
d AS (SELECT s.doc_id, i FROM s JOIN m ON md5_number(s.h) = m.h WHERE m.least < s.doc_id),
o AS (SELECT doc_id, i, CASE WHEN i > 50 + LAG(i) OVER w THEN 1 ELSE 0 END AS fresh, LAG(i) OVER w AS prev FROM d WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, run, MIN(i) AS lo, MAX(i) + 50 AS hi FROM (SELECT *, SUM(CASE WHEN prev IS NULL OR i > prev + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o) GROUP BY ALL),
g AS (SELECT *, COALESCE(LAG(hi) OVER (PARTITION BY doc_id ORDER BY lo), 1) AS from_ FROM r),
k AS (SELECT doc_id, CAST(SUM(hi - lo) AS BIGINT) AS n_removed, COUNT(*) AS n_spans, MAX(hi) AS tail, list([from_, lo] ORDER BY lo) AS cuts FROM g GROUP BY doc_id)
SELECT t.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN cuts IS NULL THEN x ELSE array_to_string(list_transform(cuts, lambda c: substr(x, CAST(2 * c[1] - 1 AS BIGINT), CAST(2 * (c[2] - c[1]) AS BIGINT))), '') || substr(x, CAST(2 * tail - 1 AS BIGINT)) END)) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)"""


@registered
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op7_jaccard"] = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS t FROM w WHERE w IS NOT NULL),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, MIN(r.b) AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY ALL"""


@registered
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.usable(table(spark, sf_dir, "embeddings"))
    found = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@registered
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(topk.usable(table(spark, sf_dir, "embeddings")))
    found = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score"))


ORACLES["op9_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@registered
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymized(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


@registered
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


@registered
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))[0]


@registered
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
