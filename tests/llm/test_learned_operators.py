"""Toxicity, tokenizer alignment and whitening against brute-force versions, on small tables with every odd case."""

import hashlib
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.llm import alignment, queries, toxicity, whitening

SF = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, score string, held_out string, predicted string, n_a string, block string, place string, key string"


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, *"zzzzzzz") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, CLASHING)


# --- tokenizer alignment ---------------------------------------------------------------------------------------------


def aligned_by_hand(texts):
    """Links from all pairs of tokens whose byte ranges overlap; groups from common ends; the tokenizers' own libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(alignment.BYTE_MODEL)
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)
    byte = alignment.byte_of_character()

    def ranges(ids, size):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(size(i))))
            at = out[-1][2]
        return out

    def a_bytes(i):
        return bytes(byte[c] for c in byte_level.id_to_token(i))

    def b_bytes(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    rows, links = [], []
    for text in texts:
        a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        a, b = ranges(a, a_bytes), ranges(b, b_bytes)
        links.append([(x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and s2 < e])
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [
            ",".join(str(x) for x, _, e in a if lo < e <= hi) + "|" + ",".join(str(x) for x, _, e in b if lo < e <= hi)
            for lo, hi in zip([0, *cuts], cuts, strict=False)
        ]
        rows.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(x for each in links for x in each)
    docs = Counter(x for each in links for x in set(each))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = [
        (n_a, n_b, n_groups, len(each), sum(count[x] == most[x[1]] for x in each), sum(count[x] for x in each), sha)
        for (n_a, n_b, n_groups, sha), each in zip(rows, links, strict=True)
    ]
    return out, {(a, b, docs[a, b], n, n == most[b]) for (a, b), n in count.items()}


ODD_TEXTS = [
    None, "", " ", "  two  spaces ", "one", "one", "a ▁ b", "<|endoftext|> and <s> and </s>", "é漢字 \U0001f600\n\ttab\x00nul", "ﬁ½ Å ㎏",
    "don't we'll  \n\n x", "aaaaaaaaaaaaaaaaaaaaaaaa", "1234567 89", "the internationalization of tokenizers",
]


def align_rows(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_alignment_equals_all_overlapping_pairs(spark):
    rng = np.random.default_rng(1)
    words = ["the", "of", "tion", "internation", "straße", "ñandú", "x=1;", "\n", "and", "Zürich"]
    texts = ODD_TEXTS + [" ".join(rng.choice(words, 40)) for _ in range(30)]
    ids = [*range(len(texts) - 2), None, 3]  # a null and a repeated doc_id
    rows, pairs = alignment.align(frame(spark, texts, ids).repartition(5))
    expected, expected_pairs = aligned_by_hand(texts)
    assert align_rows(rows) == sorted(((i, *e) for i, e in zip(ids, expected, strict=True)), key=repr)
    assert {tuple(r) for r in pairs.collect()} == expected_pairs


def test_alignment_with_many_flushes_and_blocks(spark, monkeypatch):
    """Bitmaps of one pair and block that come from several flushes are OR-merged; nothing depends on the limits."""
    texts = [f"the {i % 7} cats of {i % 3} " * (1 + i % 4) for i in range(400)]
    whole, pairs = (x.collect() for x in alignment.align(frame(spark, texts).coalesce(1)))
    for name, value in (("HELD", 200), ("PIECE", 500), ("BLOCK", 1 << 16)):
        monkeypatch.setattr(alignment, name, value)
    documents = frame(spark, texts).coalesce(1)
    model = alignment.models()
    found = list(_local(documents, model))
    assert len({(k, b, p) for k, b, p, _ in found}) < len(found)  # equal keys met
    counted = Counter()
    for key, _, plane, places in found:
        counted[key] += len(places) << plane
    size = len(alignment.Aligner(model).b_bytes)
    assert {(r["a"], r["b"]): r["links"] for r in pairs} == {(k // size, k % size): n for k, n in counted.items()}
    assert sum(r["n_links"] for r in whole) == sum(counted.values())
    merged = alignment.merged(spark.createDataFrame(
        [(k, b, p, int(base), bytes(data)) for k, b, p, base, data in _raw(documents, model)], "key long, block long, plane int, base int, bitmap binary"
    ))
    assert {r["key"]: (r["d"], r["l"]) for r in merged.groupBy("key").agg(F.sum("docs").alias("d"), F.sum("links").alias("l")).collect()} == {
        r["a"] * size + r["b"]: (r["docs"], r["links"]) for r in pairs
    }


def _raw(documents, model):
    """Bitmap rows made with the patched limits, in this process."""
    aligner = alignment.Aligner(model)
    texts = [r["text"].encode() for r in documents.collect()]
    for lo in range(0, len(texts), 20):
        codes, counts, _, _ = alignment.linked(aligner, texts[lo:lo + 20])
        codes = codes + lo
        for plane in range(int(counts.max()).bit_length()):
            code = codes[(counts >> plane) & 1 == 1]
            if len(code):
                first = alignment._starts(code >> 16)
                base, data = alignment.packed(first, code & 0xFFFF)
                yield from ((int(k), 0, plane, int(b), d.as_py()) for k, b, d in zip(code[first] >> 16, base, data, strict=True))


def _local(documents, model):
    import pyarrow as pa

    for key, block, plane, base, data in _raw(documents, model):
        yield key, block, plane, alignment.unpacked(np.array([base]), pa.array([data], pa.binary()))[1]


@pytest.mark.parametrize("dense", [False, True])
def test_bitmaps_return_their_places(dense):
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(65536, n, replace=False)) if not dense else np.arange(17, 17 + 3 * n, 3)[:n] for n in (1, 2, 500, 4000)]
    rows.append(np.array([65535]))
    first = np.cumsum([0, *map(len, rows)])[:-1]
    base, data = alignment.packed(first, np.concatenate(rows))
    row, place = alignment.unpacked(base, data)
    assert [place[row == i].tolist() for i in range(len(rows))] == [r.tolist() for r in rows]
    assert ((base[1:4] >= 0) == dense).all()  # the longer rows are arrays or bitsets, whichever is shorter


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    rng = np.random.default_rng(3)
    words = ["the", "of", "  x", "été", "don't", "42", "a\n", "▁" * 0 + "naïve", "--", "end."]
    text = " ".join(rng.choice(words, 3000))
    aligner = alignment.Aligner(alignment.models())
    whole = aligner.tokens(text.encode())
    monkeypatch.setattr(alignment, "PART", 50)
    assert len(list(aligner.parts(text, 50))) > 50
    cut = aligner.tokens(text.encode())
    assert all((x == y).all() for x, y in zip(whole, cut, strict=True))
    texts = [b"one", text.encode(), b"", (text + " a ▁").encode()]
    once = alignment.linked(aligner, texts)
    monkeypatch.setattr(alignment, "LONG", 100)
    monkeypatch.setattr(alignment, "PIECE", 500)
    parted = alignment.linked(aligner, texts)
    assert all((np.asarray(x) == np.asarray(y)).all() for x, y in zip(once, parted, strict=True))


def test_alignment_of_a_text_of_many_parts(spark):
    rows, _ = alignment.align(frame(spark, ["the cat and the hat " * 250_000, "x"]))
    first = rows.where("doc_id = 0").first()
    assert first["n_links"] == first["n_a"] + first["n_b"] - first["n_groups"] > 1_000_000


def test_alignment_of_nothing(spark):
    rows, pairs = alignment.align(frame(spark, ["x"]).where("doc_id < 0"))
    assert rows.count() == 0 and pairs.count() == 0


# --- whitening -------------------------------------------------------------------------------------------------------


def whitened_by_hand(vectors):
    """Exact sums in integers, eigenvectors by the library, for the contract's columns."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[float(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    e, q = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred @ q[:, ::-1] / np.sqrt(e[::-1]), e[::-1] / e.sum()


EMBEDDED = "vec_id long, embedding array<float>, component string, n string, v string"


def embedded(spark, vectors, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], None if v is None else [None if c is None else float(c) for c in v], "z", "z", "z") for i, v in enumerate(vectors)], EMBEDDED)


def test_whitening_by_hand(spark):
    rng = np.random.default_rng(4)
    good = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))).astype(np.float32).tolist()
    good += [good[0], good[0]]  # repeated rows count
    bad = [None, [None] * 12, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [float("-inf")] * 12]
    ids = [*range(len(good) - 1), None, *range(1000, 1000 + len(bad))]
    got = whitening.whiten(embedded(spark, good + bad, ids).repartition(4)).collect()
    deviation, white, explained = whitened_by_hand(np.array(good, np.float32))
    assert len(got) == 8 * len(good) and {r["n"] for r in got} == {len(good)}
    table = {i: (d, w) for i, d, w in zip(ids, deviation, white, strict=False)}
    sign = {}
    for r in got:
        d, w = table[r["vec_id"]]
        value = w[r["component"] - 1]
        sign.setdefault(r["component"], np.sign(value * r["whitened"]))
        assert r["deviation"] == d == int(r["deviation_wide"])
        assert abs(r["whitened"] - sign[r["component"]] * value) < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-10
        assert r["identity_error"] < 1e-10


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 20), 5 + 1e-9 * np.arange(20), np.r_[5 + 1e-13 * np.arange(10), np.linspace(1, 4, 10)], np.ones(20), np.r_[np.zeros(17), 1, 2, 3], 10.0 ** -np.arange(20),
])
def test_refined_eigenvectors(values):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ ((np.eye(20) - q.T @ q) / 2)
    v = (q * values.astype(np.longdouble)) @ q.T
    v = (v + v.T) / 2
    x, e = whitening.eigenvectors(v)
    assert np.abs(x.T @ x - np.eye(20)).max() < 1e-17
    assert np.abs(v @ x - x * e).max() < 1e-13 * values.max()
    assert np.abs(np.sort(e) - np.sort(values)).max() < 1e-13 * values.max()
    assert (np.diff(e) <= 0).all()


def test_float32_alone_is_not_enough():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(64, 64))
    v = (a @ a.T).astype(np.longdouble)
    rough = np.linalg.eigh(v.astype(np.float32))[1].astype(np.longdouble)
    x, e = whitening.eigenvectors(v)
    assert np.abs(rough.T @ rough - np.eye(64)).max() > 1e-8
    assert np.abs(v @ x - x * e).max() < 1e-17 * float(e[0])


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(embedded(spark, [None])).count() == 0
    one = whitening.whiten(embedded(spark, [[1.0, 2.0, 3.0]])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(c, 0, 0.0, 0.0, 0.0) for c in (1, 2, 3)]
    assert whitening.whiten(embedded(spark, [[], []])).count() == 0
    ragged = whitening.whiten(embedded(spark, [[1.0, 2.0], [1.5], [], [3.0, -1.0]])).collect()
    padded = whitening.whiten(embedded(spark, [[1.0, 2.0], [1.5, 0.0], [0.0, 0.0], [3.0, -1.0]])).collect()
    assert sorted(map(tuple, ragged)) == sorted(map(tuple, padded)) and len(ragged) == 8
    line = whitening.whiten(embedded(spark, [[float(i), 2.0 * i] for i in range(9)])).collect()  # rank one
    assert {r["whitened"] for r in line if r["component"] == 2} == {0.0}
    assert all(abs(r["identity_error"]) < 1e-10 for r in line)
    huge = whitening.whiten(embedded(spark, [[1e9, -1e9], [3e9, 2.0], [5.0, 1e8], [2.0**41, 0.0]])).collect()  # the last takes no part
    assert {r["n"] for r in huge} == {3}
    assert all(r["deviation"] is None for r in huge) and all(r["deviation_wide"] > 2**63 for r in huge)


def test_products_are_exact():
    rng = np.random.default_rng(7)
    for most in (1000, 2**28, 2**45):
        d = rng.integers(-most, most, (50, 3))
        o = d.astype(object)
        assert (whitening.products(d) == o.T @ o).all()


# --- toxicity --------------------------------------------------------------------------------------------------------


def kernel_by_hand(s, t):
    """All subsequences of ORDER letters that begin in the first WINDOW places, span SPAN at most; a gap may only lead."""

    def phi(window):
        out = Counter()
        for at in combinations(range(len(window)), toxicity.ORDER):
            letters = tuple(window[i] for i in at)
            span = at[-1] - at[0] + 1
            if at[0] < toxicity.WINDOW and span <= toxicity.SPAN and toxicity.GAP not in letters[1:]:
                out[letters] += toxicity.DECAY ** (span - toxicity.ORDER)
        return out

    a, b = phi(s), phi(t)
    return sum(v * b[u] for u, v in a.items())


def test_kernel_by_hand():
    rng = np.random.default_rng(8)
    windows = np.where(rng.random((12, toxicity.REACH)) < 0.15, toxicity.GAP, rng.integers(0, 5, (12, toxicity.REACH))).astype(np.uint8)
    machine = toxicity.Machine(windows[:5])
    expected = [[kernel_by_hand(s, t) for t in windows[:5]] for s in windows]
    assert np.allclose(machine.kernel(windows), expected, rtol=1e-5)


def test_folded_weights_decide_as_the_landmarks_do():
    rng = np.random.default_rng(9)
    windows = rng.integers(0, 6, (80, toxicity.REACH)).astype(np.uint8)
    labels = (windows[:, 3] > 2).astype(int)
    machine = toxicity.Machine(windows[:30])
    weights, bias = machine.trained(windows, labels)
    alpha = np.linalg.lstsq(machine.phi.astype(float), weights[machine.strings].astype(float), rcond=None)[0]
    folded = np.array([toxicity.decisions(w, weights)[0] for w in windows])
    assert np.allclose(folded, machine.kernel(windows) @ alpha, atol=1e-3)


def letters_of(text):
    s = toxicity.stream([text])
    return "".join("abcdefghijklmnopqrstuvwxyz12345_"[i] for i in s.letters).strip("_")


def test_letters():
    assert letters_of("You ID-i0t!") == "you_idiot"
    assert letters_of("an i d i o t is") == "an_idiot_is"
    assert letters_of("s.t.u.p.i.d") == "stupid"
    assert letters_of("Éléphant\n\tà") == "elephant_a"
    assert letters_of("a b") == "ab" and letters_of("aa b") == "aa_b"
    assert letters_of("") == letters_of(" .,​") == ""


def test_streams_of_many_texts_are_those_of_each():
    texts = ["", "one. two!", "", "x", "a b c", "", ""]
    s = toxicity.stream(texts)
    bounds = [*s.texts.tolist(), len(s.letters)]
    for i, text in enumerate(texts):
        alone = toxicity.stream([text]).letters
        part = s.letters[bounds[i]:bounds[i + 1]]
        assert part[part < toxicity.GAP].tolist() == alone[alone < toxicity.GAP].tolist()
        assert part[:toxicity.REACH].tolist() == [toxicity.GAP] * toxicity.REACH
    assert set(s.texts) <= set(s.sentences)


@pytest.fixture(scope="module")
def insults():
    """Labelled documents of random syllables; a third holds an insult, one in twenty labels is wrong."""
    rng = np.random.default_rng(10)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]

    def prose(n):
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(n))

    texts, labels = [], []
    for _ in range(600):
        toxic = rng.random() < 0.33
        words = [prose(int(rng.integers(4, 12))) for _ in range(int(rng.integers(1, 12)))]
        if toxic:
            at = int(rng.integers(len(words)))
            words[at] += " " + str(rng.choice(["blockhead", "numpty", "cretin"])) + " " + prose(3)
        texts.append(". ".join(words))
        labels.append(int(toxic != (rng.random() < 0.05)))
    return texts, labels


def test_toxicity_on_rows_not_learned(insults):
    texts, labels = insults
    model = toxicity.train(texts[:400], labels[:400])
    truth = np.array([any(w in t for w in ("blockhead", "numpty", "cretin")) for t in texts[400:]])
    said = model.scores(texts[400:]) >= toxicity.THRESHOLD
    assert said[truth].mean() > 0.9 and said[~truth].mean() < 0.06  # one label in twenty is wrong
    hidden = ["there on block-head inand", "there on n.u.m.p.t.y inand", "there c r e t i n inand", "there on blockxhead inand", "There CR3TIN inand"]
    assert (model.scores(hidden) >= toxicity.THRESHOLD).all()
    assert model.scores(["", "...", "there on in and"]).max() < 0.5
    again = toxicity.train(texts[:400], labels[:400])
    assert (again.weights == model.weights).all()
    long = "there on inand. " * 200_000
    assert model.scores([long + "numpty " + long])[0] > model.scores([long + long])[0]  # no prefix: it is found after three million characters
    assert model.scores([texts[400], "", long, texts[400]]).tolist() == [float(model.scores([t])[0]) for t in (texts[400], "", long, texts[400])]


def test_toxicity_reads_no_held_out_label(spark, insults):
    texts, labels = insults
    documents = frame(spark, texts[:200])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(labels[:200])], "doc_id long, toxic int")
    flipped = table.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit(documents, t) for t in (table, flipped))
    assert (one.weights == two.weights).all() and (one.join == two.join).all()


def test_toxicity_of_odd_tables(spark):
    texts = [None, "", "x", "x", "one two three", "漢字 \U0001f600 é"]
    documents = frame(spark, texts, [0, 1, 2, 2, None, 5])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.score(documents, toxicity.fit(documents, none)).collect()
    assert len(scored) == 6 and {r["score"] for r in scored} == {0.5}
    few = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 0), (3, None), (None, 1), (5, 0), (6, 1)], "doc_id long, toxic int")
    scored = toxicity.score(documents, toxicity.fit(documents, few)).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in scored)
    assert {r["doc_id"]: r["held_out"] for r in scored} == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in (0, 1, 2, None, 5)}
    assert toxicity.score(documents.where("doc_id < 0"), 0.5).count() == 0


@pytest.mark.parametrize("name", ["op11_toxicity", "op12_alignment", "op13_whitening"])
def test_registered_queries_return_every_row(spark, name):
    rows = queries.QUERIES[name](spark, SF)
    ids = "vec_id" if name == "op13_whitening" else "doc_id"
    base = spark.read.parquet(f"{SF}/{'embeddings' if ids == 'vec_id' else 'documents'}.parquet")
    assert rows.count() == base.count() * (8 if ids == "vec_id" else 1)
