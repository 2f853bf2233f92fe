"""Each stage of the pipeline against a brute-force version of it, on rows with nulls, copies and clashing columns."""

import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from flowgauge.llm import mixing, quality, sentencepiece
from tests.llm.test_operators import shingles, words

#: score, ids and the like clash with what the operators add.
ROWS = "doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, ids string, n_tokens string, epoch string, component_id string"
MAIL = re.compile(r"[\w.]+@[\w.]+\.\w+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def documents():
    rng = np.random.default_rng(12)
    near = words(rng, 120).split(" ")
    texts = [None, "", words(rng, 30), words(rng, 30)]
    for i in range(5):
        texts.append(" ".join([*near[:i * 10], f"x{i}", *near[i * 10 + 1:]]))
    texts += [texts[2], texts[2], f"{words(rng, 20)} ann.lee7@mail.example.com {words(rng, 20)}"]
    texts += [words(rng, int(rng.integers(10, 60))) for _ in range(14)] + [" ".join(w + "%%%" for w in words(rng, 40).split()) for _ in range(4)]
    rows = [(i, t, ("en", "de", None)[i % 3], ("src1", "src2", None)[i % 3], len(t or ""), "s", "p", "i", "n", "e", "c") for i, t in enumerate(texts)]
    return [*rows, rows[13], rows[13], (None, *rows[14][1:]), (None, None, *rows[15][2:])]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    good = [words(rng, int(rng.integers(5, 200))) for _ in range(100)]
    bad = [" ".join(w + "%%%" for w in words(rng, int(rng.integers(5, 200))).split()) for _ in range(100)]
    return quality.train([t.encode() for t in good + bad], [1] * 100 + [0] * 100, steps=100)


def good_ones(rows, model):
    return [r for r in rows if model.score((r[1] or "").encode()) >= quality.THRESHOLD]


def one_of_each(rows):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    label = {a: a for a, _ in sets}
    for _ in sets:
        for a, x in sets:
            for b, y in sets:
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    first = {r[0]: r for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or ""), reverse=True) if r[0] is not None}
    return [r for a, r in first.items() if label[a] == a] + [r for r in rows if r[0] is None]


def mixed(folder):
    """doc_ids that the mixing SQL takes."""
    sql = mixing.checking_sql(fraction=corpus_pipeline.MIX_FRACTION, max_epochs=1)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    return sorted((r[0] for r in con.execute(f"SELECT doc_id FROM ({sql})").fetchall()), key=repr)


def test_stages(spark, documents, model, monkeypatch, tmp_path):
    monkeypatch.setattr(corpus_pipeline.quality, "fit", lambda *_: model)
    spark.createDataFrame(documents, ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "pii", "mixing", "encoding"]

    def after(name, rows):
        """The stage's rows, from these rows."""
        return rows_of(stages[name](spark, spark.createDataFrame(rows, ROWS), str(tmp_path)))

    kept = after("quality", documents)
    assert kept == sorted(good_ones(documents, model), key=repr)
    assert 0 < len(kept) < len(documents)

    # from all documents, so that no row is missing that an earlier stage took
    single = after("near_duplicates", documents)
    assert single == sorted(one_of_each(documents), key=repr)
    assert len(single) < len(documents) - 5

    safe = after("pii", single)
    by_key = {(r[0], r[2:4]): r for r in safe}
    assert len(safe) == len(single) == len(by_key)
    for r in single:
        s = by_key[r[0], r[2:4]]
        assert s[5:] == r[5:] and s[4] == (len(s[1]) if s[1] is not None else r[4])
        if r[1] and MAIL.search(r[1]):
            assert MAIL.sub("@", s[1]) == MAIL.sub("@", r[1]) and "ann.lee7" not in s[1]
        else:
            assert s[1] == r[1]

    spark.createDataFrame(safe, ROWS).write.parquet(str(tmp_path / "safe"))
    chosen = after("mixing", safe)
    assert set(chosen) <= set(safe) and len(set(chosen)) == len(chosen)
    assert sorted((r[0] for r in chosen), key=repr) == mixed(tmp_path / "safe")
    assert 0 < len(chosen) < len(safe)

    encoded = stages["encoding"](spark, spark.createDataFrame(chosen, ROWS), str(tmp_path))
    out = sentencepiece.decode(encoded).collect()
    assert all(r["n_tokens"] == len(r["ids"]) for r in out)
    assert sorted(((r["doc_id"], r["lang"], r["source"], r["decoded"]) for r in out), key=repr) == sorted(((r[0], r[2], r[3], r[1] or "") for r in chosen), key=repr)
