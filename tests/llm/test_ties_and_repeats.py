"""Ties, repeated ids with different rows, and streams of sorted rows that are cut anywhere."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowgauge.llm import jaccard, neighbours, quality, words


def test_different_texts_under_one_id_keep_their_links(spark):
    rng = np.random.default_rng(0)
    a, b = ([f"w{i}" for i in rng.integers(500, size=80)] for _ in range(2))
    near = lambda w: " ".join([*w[:40], "x", *w[41:]])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, "alone in the world of words and shingles"), (3, near(b))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1), (4, 4)]


def test_ids_between_texts_are_no_link(spark):
    """Two texts share an id and nothing else: their partners stay apart, each with the smallest id of its own class."""
    rng = np.random.default_rng(1)
    a, b = ([f"w{i}" for i in rng.integers(500, size=80)] for _ in range(2))
    near = lambda w: " ".join([*w[:40], "x", *w[41:]])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (2, near(a)), (3, near(b))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(2, 2), (3, 3), (5, 2), (5, 3)]


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 1000])
def test_tokens_of_two_sets_are_met_wherever_the_stream_is_cut(cut):
    rng = np.random.default_rng(cut)
    rows = sorted((int(t), int(s)) for t, s in zip(rng.integers(0, 40, 300), rng.integers(0, 9, 300), strict=True))
    rows += [(99, s) for s in range(6) for _ in range(4)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in part]), pa.array([s for _, s in part])], names=["token", "set_id"]) for part in (rows[i:i + cut] for i in range(0, len(rows), cut))]
    got = sorted(x for b in jaccard._met(iter(batches)) for x in b.column(0).to_pylist())
    sets = {}
    for t, s in rows:
        sets.setdefault(t, set()).add(s)
    assert got == sorted(s for held in sets.values() if len(held) > 1 for s in held)


def test_collinear_vectors_tie_to_the_smaller_ids(spark):
    base = np.array([0.5, -1.0, 0.25, 2.0])
    rows = [(i, (base * (1 + i % 3)).tolist()) for i in range(60)] + [(100 + i, v) for i, v in enumerate(np.random.default_rng(2).normal(size=(200, 4)).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = neighbours.nearest(vectors, vectors.where("vec_id IN (0, 50)")).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 50] == [0, 1, 2, 3, 4]
    assert [r["vec_id"] for r in got if r["query_id"] == 0] == [1, 2, 3, 4, 5]


def test_word_hashes_do_not_depend_on_the_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    text = " ".join("".join(rng.choice(list("abcdé"), rng.integers(1, 30))) for _ in range(500)).encode()
    whole = words.words_of([text, b"", text]).hashes
    monkeypatch.setattr(words, "HASHED_BYTES", 64)
    assert (words.words_of([text, b"", text]).hashes == whole).all()


def test_scores_of_long_texts_are_those_of_their_chunks(monkeypatch):
    net = quality.Network()
    texts = [b"abc " * n for n in (1, 200, 3000, 40_000)]
    once = net.scores(texts)
    monkeypatch.setattr(quality, "PART_CHUNKS", 3)
    assert net.scores(texts) == pytest.approx(once, abs=1e-6)
    assert once == pytest.approx([net.score(t) for t in texts], abs=1e-6)
