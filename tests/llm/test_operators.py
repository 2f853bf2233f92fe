"""Each operator against a brute-force version on a small table with nulls, empty texts, copies and clashing columns."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.llm import jaccard, main_text, mixing, neighbours, quality, sentencepiece, substrings, suffixes, surrogates, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = "doc_id long, text string, lang string, source string, ids string, score string, n_words string, n_entities string, epoch string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.integers(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(3)
    passage, long = words(rng, 60), words(rng, 4000)
    near = words(rng, 120).split(" ")
    texts = [None, "", "   \n", "one", "One TWO", "one two", long, long + " tail", passage, passage, passage]
    texts += [f"{words(rng, 40)} {passage}\t{words(rng, 40)}" for _ in range(6)]
    for i in range(8):
        changed = list(near)
        changed[i * 10] = f"x{i}"
        texts.append(" ".join(changed))
    texts += [words(rng, int(rng.integers(1, 200))) for _ in range(12)] + ["aa " * 90, "aa " * 70 + "b", "é▁x ퟿ 漢字 \U0001f600\n\tz"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("src1", "src2", None, "src6")[i % 4], "z", "z", "z", "z", "z") for i, t in enumerate(texts)]
    return rows + [rows[8], (None, passage, "en", "src1", "z", "z", "z", "z", "z")]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, ODD)


def keyed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sentencepiece_returns_every_text(odd, odd_rows):
    checked = sentencepiece.encoded_with_check(odd).collect()
    assert len(checked) == len(odd_rows)
    assert all(r["round_trip"] for r in checked)


def test_sentencepiece_finds_the_best_path():
    vocab = sentencepiece.vocabulary()
    segmenter = sentencepiece.Segmenter(vocab)
    score = dict(zip(vocab.pieces, vocab.scores, strict=True))
    for text in ("hello", "the theater", "a  b", "Zürich%%%", "internationalization"):
        marked = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-1e18] * len(marked)
        for end in range(1, len(marked) + 1):
            best[end] = max([best[end - 1] + segmenter.unknown] * (marked[end - 1] not in score) + [best[s] + score[marked[s:end]] for s in range(end) if marked[s:end] in score])
        ids = [i for part in segmenter.encode(text) for i in part]
        # the byte pieces of unknown characters have score 0
        unknown = sum(c not in score for c in marked)
        assert sum(vocab.scores[i] for i in ids) + unknown * segmenter.unknown == pytest.approx(best[-1])


def brute_windows(rows, size):
    seen = {}
    for k, row in enumerate(rows):
        w = WORD.findall(row[1] or "")
        for i in range(len(w) - size + 1):
            seen.setdefault(tuple(w[i:i + size]), []).append((k, i))
    out = []
    for k, row in enumerate(rows):
        w = WORD.findall(row[1] or "")
        gone = {j for i in range(len(w) - size + 1) if len(seen[tuple(w[i:i + size])]) > 1 for j in range(i, i + size)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((row[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substrings(odd, odd_rows):
    assert keyed(substrings.deduplicated(odd)) == brute_windows(odd_rows, 35)


def test_bitmaps_bound_what_sets_share(spark):
    """Pairs that share enough always pass, whatever the widths; most others go before a shingle is sent for them."""
    rng = np.random.default_rng(11)
    rows = []
    for n, u in [(1, 1), (7, 30), (100, 90), (100, 1500), (900, 120), (480, 480)]:
        for share in range(0, 101, 10):
            both = min(n, u) * share // 100
            held = rng.integers(-(1 << 63), (1 << 63) - 1, n + u - both)
            rows.append((held[:n].tolist(), held[n - both:].tolist(), both))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, share long").withColumn("n", F.size("a"))
    bits = df.withColumns({"x": jaccard.bitmap("a"), "y": jaccard.bitmap("b")})
    assert bits.where(jaccard.may_share("x", "y", "n", "share")).count() == len(rows)
    none = bits.where("share = 0 AND n >= 100 AND size(b) <= 2 * n").withColumn("y0", F.lit(None).cast("binary"))
    wanted = F.ceil(F.col("n") * 0.75)
    assert none.where(jaccard.may_share("x", "y", "n", wanted)).count() == 0
    assert none.where(jaccard.may_share("x", "y0", "n", wanted)).count() == none.count()


def test_prefix_tokens_met_by_other_sets_travel_packed(spark, monkeypatch):
    """Counts are those of brute force over all parts, copies of a set count once, and no token is a row of its own."""
    rng = np.random.default_rng(12)
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 100)
    pool = rng.integers(-(1 << 63), (1 << 63) - 1, 300)
    sets = [(i, rng.choice(pool, 20, replace=False).tolist()) for i in range(-6, 6)]
    heads = spark.createDataFrame([(i, 60, x) for i, x in [*sets, *sets[:4]]], "set_id long, n_shingles long, prefix array<long>").repartition(3)
    expected = {i: sum(any(t in y for j, y in sets if j != i) for t in x) for i, x in sets}
    assert {r[0]: r[1] for r in jaccard._shared(heads).collect()} == {i: n for i, n in expected.items() if n}
    assert heads.select("set_id", "prefix").coalesce(1).mapInArrow(jaccard._dealt(4), "part int, sets binary, size binary, tokens binary").count() <= 4


def test_suffixes(odd, odd_rows):
    last = 1 << 63
    data = [(row[0] if row[0] is not None else last, (row[1] or "").encode()) for row in odd_rows]
    least = {}
    for doc, text in data:
        for i in range(len(text) - 49):
            s = text[i:i + 50]
            least[s] = min(least.get(s, last), doc)
    expected = []
    for row, (doc, text) in zip(odd_rows, data, strict=True):
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - 49):
            if least[text[i:i + 50]] < doc:
                gone[i:i + 50] = True
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(text, gone, strict=False) if not g)
        expected.append((row[0], len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert keyed(suffixes.deduplicated(odd)) == sorted(expected, key=repr)


def test_suffixes_that_occur_once_are_not_stored(spark, monkeypatch):
    """Stretches of one document only are compared, but leave no rows."""
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 123, 4000, dtype=np.uint8)).decode() for _ in range(30)]
    rows, keep = [], suffixes.stored

    def counted(df, name):
        out = keep(df, name)
        rows.append((name, out.count()))
        return out

    monkeypatch.setattr(suffixes, "stored", counted)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[3][100:200]])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffixes.deduplicated(df).collect()}
    assert sum(n for _, n in rows) < 200, rows
    assert (got[30]["n_bytes"], got[30]["n_removed"], got[30]["n_spans"]) == (100, 100, 1)
    assert all(got[i]["n_removed"] == 0 for i in range(30))


def test_suffixes_of_a_hot_passage_never_meet_in_one_group(spark, monkeypatch):
    """A passage in different surroundings: equal strings of its anchors are reduced before any group is formed."""
    rng = np.random.default_rng(8)
    passage = bytes(rng.integers(97, 123, 70, dtype=np.uint8)).decode()
    texts = ["".join(chr(c) for c in rng.integers(97, 123, 40)) + passage + "".join(chr(c) for c in rng.integers(97, 123, 40)) for _ in range(40)]
    sorter = suffixes._sorter

    def watched(length):
        inner = sorter(length)

        def run(pdf):
            assert not pdf["data"].duplicated().any(), "equal strings in one group"
            return inner(pdf)

        return run

    monkeypatch.setattr(suffixes, "_sorter", watched)
    monkeypatch.setattr(suffixes, "HOT_STRETCHES", 10)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffixes.deduplicated(df).collect()}
    assert got[0]["n_removed"] == 0 and len(got) == 40
    for i in range(1, 40):
        # a byte beside the passage may agree with an earlier document's, which lengthens the repeat
        least = {texts[j][k:k + 50] for j in range(i) for k in range(len(texts[j]) - 49)}
        gone = np.zeros(150, bool)
        for k in range(101):
            if texts[i][k:k + 50] in least:
                gone[k:k + 50] = True
        assert gone[40:110].all()
        kept = "".join(c for c, g in zip(texts[i], gone, strict=True) if not g)
        assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())


def test_difference_cover_names():
    rng = np.random.default_rng(0)
    for _ in range(80):
        x = rng.integers(1, 4, int(rng.integers(1, 150))).astype(np.int64)
        for length in (1, 5, 20):
            names = suffixes.string_names(x, length)
            at = range(len(x) - length + 1)
            strings = [tuple(x[i:i + length]) for i in at]
            assert all((names[i] == names[j]) == (strings[i] == strings[j]) for i in at for j in at)


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_jaccard(odd, odd_rows):
    sets = [(row[0], shingles(row[1])) for row in odd_rows]
    label = {row[0]: row[0] for row in odd_rows}
    for _ in range(len(sets)):
        for a, x in sets:
            for b, y in sets:
                if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    expected = sorted(((a, len(x), label[a]) for a, x in sets), key=repr)
    assert keyed(jaccard.near_duplicates(odd)) == expected


def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 20))
    x[100:220] = x[100]
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(600)]
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 20, 0), (603, [None] + [1.0] * 19, 0), (604, [float("nan")] * 20, 0), (650, [float("inf")] * 20, 0)]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


def test_top_k(spark):
    x, df = vectors(spark)
    x = np.vstack([x, np.zeros((1, 20))])
    ids = np.r_[np.arange(600), 602]
    q = np.floor(256 * x.astype(np.float32).astype(float)).astype(int)
    table = topk.quantized(topk.usable(df))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], int(r["score"])) for r in topk.top_k(table, table.where("vec_id % 50 = 0")).collect()}
    for a in range(0, 600, 50):
        s = q @ q[a]
        best = sorted((-int(v), int(i)) for v, i in zip(s, ids, strict=True) if i != a)[:5]
        assert [got[a, k + 1] for k in range(5)] == [(i, -v) for v, i in best]
    assert len(got) == 60


def test_neighbours_recall(spark):
    x, df = vectors(spark)
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    table = topk.usable(df)
    got = neighbours.nearest(table, table.where("vec_id % 50 = 0")).collect()
    assert len(got) == 60
    hits = 0
    for a in range(0, 600, 50):
        s = u @ u[a]
        best = sorted((-round(float(v), 9), i) for i, v in enumerate(s) if i != a)[:5]
        mine = {r["vec_id"]: r["score"] for r in got if r["query_id"] == a}
        hits += sum(i in mine for _, i in best)
        assert all(v == pytest.approx(float(s[i])) for i, v in mine.items())
    assert hits >= 54
    few = table.where("vec_id < 3")
    assert neighbours.nearest(few, few.where("vec_id = 0")).count() == 2


def repeated_vectors(spark):
    """Sixty ids: each vector six times, every third id with a second vector, six times as well."""
    x = np.random.default_rng(6).normal(size=(60, 8)).astype(np.float32).astype(float)
    y = np.random.default_rng(7).normal(size=(60, 8)).astype(np.float32).astype(float)
    rows = [(i, [float(v) for v in x[i]]) for i in range(60)] + [(i, [float(v) for v in y[i]]) for i in range(1, 60, 3)]
    return x, y, spark.createDataFrame(rows * 6, "vec_id long, embedding array<float>")


def best_ids(score_x, score_y, own):
    s = {i: max([score_x[i]] + [score_y[i]] * (i % 3 == 1)) for i in range(60) if i != own}
    return [(i, s[i]) for i in sorted(s, key=lambda i: (-s[i], i))[:5]]


@pytest.mark.parametrize("shard_rows", [8192, 20])
def test_top_k_of_repeated_ids(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    x, y, df = repeated_vectors(spark)
    q, p = np.floor(256 * x), np.floor(256 * y)
    table = topk.quantized(topk.usable(df))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(table, table.where("vec_id % 30 = 0")).collect()}
    assert got == {(a, k + 1): pair for a in (0, 30) for k, pair in enumerate(best_ids(q @ q[a], p @ q[a], a))}


def test_top_k_of_an_id_across_blocks():
    x = np.random.default_rng(9).normal(size=(90, 4))
    ids = np.arange(90) // 7
    got = topk.search(np.array([3, 99]), x[:2], ids, x, 5, block_rows=4)
    for row, own in ((0, 3), (1, 99)):
        s = {i: (x[ids == i] @ x[row]).max() for i in set(ids.tolist()) - {own}}
        mine = got[got["query_id"] == own]
        assert mine["vec_id"].tolist() == sorted(s, key=lambda i: (-s[i], i))[:5]
        assert mine["score"].tolist() == pytest.approx([s[i] for i in mine["vec_id"]])


def test_neighbours_of_repeated_ids(spark, monkeypatch):
    x, y, df = repeated_vectors(spark)
    u, v = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
    table = topk.usable(df)
    expected = {(a, k + 1): pair for a in (0, 30) for k, pair in enumerate(best_ids(u @ u[a], v @ u[a], a))}
    for probe in (neighbours.PROBES, 1):  # with one bucket and table most candidates come from the exact search
        found = neighbours.nearest(table, table.where("vec_id % 30 = 0"), tables=6 if probe > 1 else 1, probe=probe).collect()
        got = {(r["query_id"], r["rank"]): r for r in found}
        assert sorted(got) == sorted(expected)
        if probe == 1:
            assert {k: r["vec_id"] for k, r in got.items()} == {k: i for k, (i, _) in expected.items()}
            assert [r["score"] for _, r in sorted(got.items())] == pytest.approx([s for _, (_, s) in sorted(expected.items())])


def test_quality_learns_and_reads_whole_texts(spark):
    rng = np.random.default_rng(1)
    good = [words(rng, int(rng.integers(5, 300))) for _ in range(120)]
    bad = [" ".join(w + "%%%" for w in words(rng, int(rng.integers(5, 300))).split()) for _ in range(120)]
    model = quality.train([t.encode() for t in good + bad], [1] * 120 + [0] * 120, steps=150)
    held = [words(rng, 100), " ".join(w + "%%%" for w in words(rng, 100).split()), words(rng, 3000), words(rng, 3000) + " x%%%" * 1500]
    scores = model.scores([t.encode() for t in held])
    assert scores[0] > 0.7 > scores[1]
    assert scores[3] < scores[2]
    assert scores == pytest.approx([model.score(t.encode()) for t in held], abs=1e-5)
    rows = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, good[0], "c")], "doc_id long, text string, predicted string")
    out = quality.score(rows, model).collect()
    assert out[0]["score"] == out[1]["score"] and 0 <= out[0]["score"] <= 1
    assert quality.fit(rows.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")) == 0.5


def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = bytes(np.random.default_rng(n).integers(33, 127, n).astype(np.uint8))
        chunks = quality.chunks_of(text)
        step = quality.CHUNK - quality.OVERLAP
        joined = b"".join(bytes(c[:step]) for c in chunks[:-1]) + bytes(chunks[-1])
        assert joined[:n] == text


def test_main_text():
    model = main_text.trained()
    held = main_text.labelled_pages(60, seed=77)
    hits = total = 0
    for html, labels in held:
        found = main_text.viterbi(main_text.scores(main_text.blocks_of(html), model[0]), model[1])
        hits, total = hits + sum(a == b for a, b in zip(found, labels, strict=True)), total + len(labels)
    assert hits / total > 0.97
    page = "<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>A &amp; B</h1><p>Some  text\nhere.<br>More.</p></article><footer>&copy; x</footer>"
    assert main_text.main_text(page, *model) == "A & B\nSome text here. More."


PARAGRAPHS = [f"Sentence {w} is long enough to be read, and it has a second part. It ends here." for w in ("one", "two", "three")]
ARTICLE = "<article><h1>A title</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "</article>"
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
WANTED = "\n".join(["A title", *PARAGRAPHS])


@pytest.mark.parametrize("page", [
    f"<html><head><title>t</title><meta charset=utf-8><body>{MENU}{ARTICLE}<footer>&copy; x</footer></body></html>",
    f"<html><head><title>t</title><script>var x;</script>{ARTICLE}",
    f"<html><head><noscript><link href=x><body>{MENU}{ARTICLE}",
    f"<html><head><title>t</title></head><body><form method='post' action='/p'>{MENU}{ARTICLE}<footer>&copy; x</footer></form></body></html>",
    f"<html><head></head><body>{MENU}<form action='/s'><input name=q>{ARTICLE}<footer>&copy; x</footer></body></html>",
    f"<html><head></head><body>{MENU}<select><option>one<option>two{ARTICLE}<footer>&copy; x</footer></body></html>",
    f"<html><head></head><body>{MENU}<form action='/q'><label>Search</label><input name=q><button>Go</button></form>{ARTICLE}</body></html>",
])
def test_main_text_keeps_the_article(page):
    assert main_text.main_text(page, *main_text.trained()) == WANTED


def test_nothing_inside_a_block_is_dropped_or_changed():
    inline = {
        "an <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b": "an x=1 b", "a <label>name</label> b": "a name b", "a\u200bb  c": "a\u200bb c",
        "a <svg><title>t</title><desc>d</desc><text>shown</text></svg> b": "a shown b", "a <object data=x>instead</object> b": "a instead b",
        "a <math><semantics><mi>y</mi><annotation>\\y</annotation></semantics></math>": "a y", "a <label>open b": "a open b",
        "a <select><option>no</select> b <button>no</button>": "a b", "a <b hidden>no</b> b <textarea>no</textarea>": "a b",
    }
    for html, text in inline.items():
        assert [t for _, t, _ in main_text.blocks_of(f"<body><p>{html}</p><p>next</p>")] == [text, "next"]


def test_main_text_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "z"), (2, "u", "", "z"), (2, "u", "", "z"), (3, None, "<p", "z")], "page_id long, url string, html string, text string")
    rows = main_text.extract(df).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in rows)[:3] == [(1, "", 0), (2, "", 0), (2, "", 0)]


PRIVATE = [
    "Mr. John Smith wrote to a.b7@mail.example.com and a.b7@mail.example.com.", "Mrs Anna Smith, +1 (212) 555-0100, 10.0.0.1",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and 4539578763621486', "nothing private, pi is 3.14159265358979", None, "", "Иван Петров и госпожа Петрова",
]


def test_surrogates(spark):
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(PRIVATE)] + [(None, PRIVATE[0], "z")], "doc_id long, text string, n_entities string")
    out = {r["doc_id"]: r for r in surrogates.pseudonymized(df).collect()}
    assert out[3]["text"] == PRIVATE[3] and out[3]["n_entities"] == 0
    assert out[4]["text"] is None and out[5]["text"] == ""
    assert out[None]["text"] == out[0]["text"]
    mails = re.findall(r"\S+@\S+?(?=[. ]? |\.$)", out[0]["text"])
    assert len(set(mails)) == 1 and re.fullmatch(r"[a-z]\.[a-z]\d@[a-z]{4}\.[a-z]{7}\.com", mails[0]) and "a.b7" not in out[0]["text"]
    assert out[0]["text"].split()[2] == out[1]["text"].split()[2].rstrip(",") != "Smith"
    assert out[0]["text"].split()[1] in surrogates.FIRST_NAMES["m", "latin"]
    assert re.search(r", \+1 \(\d{3}\) \d{3}-\d{4}, (\d{1,3}\.){3}\d{1,3}$", out[1]["text"])
    assert re.fullmatch(r'token = "[0-9a-f]{40}" and 4\d{15}', out[2]["text"]) and out[2]["text"] != PRIVATE[2]


def test_surrogates_stay_distinct(spark):
    df = spark.createDataFrame([(i, f"Call 10.{i // 250}.{i % 250}.1 or John W{chr(97 + i % 26)}x{chr(97 + i // 26)}") for i in range(400)], "doc_id long, text string")
    out = surrogates.pseudonymized(df).collect()
    addresses = {r["text"].split()[1] for r in out}
    assert len(addresses) == 400
    assert not addresses & {f"10.{i // 250}.{i % 250}.1" for i in range(400)}


def test_mixing_takes_prefixes(spark, odd):
    out = mixing.mix(odd, fraction=0.5, max_epochs=2).collect()
    assert out and {r["epoch"] for r in out} <= {0, 1}
    for leaf in {(r["domain"], r["lang"], r["source"]) for r in out}:
        rows = [r for r in out if (r["domain"], r["lang"], r["source"]) == leaf]
        whole = [r for r in odd.collect() if (r["lang"], r["source"]) == leaf[1:]]
        # a second epoch begins only after every row of the first
        assert all(r["epoch"] == 0 for r in rows) or sum(r["epoch"] == 0 for r in rows) == len(whole)
    assert mixing.mix(odd.limit(0)).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("web", "en", "a", 10, 1), ("web", "en", "b", 1000, 1), ("web", "de", "c", 1000, 1), ("books", "en", "d", 1000, 1)],
        "domain string, lang string, source string, tokens long, docs long")
    got = {r["source"]: r["budget"] for r in mixing.budgets(leaves, F.lit(600), {}, 1).collect()}
    assert got == {"a": 10, "b": 140, "c": 150, "d": 300}


def test_empty_tables(odd):
    none = odd.limit(0)
    for run in (substrings.deduplicated, suffixes.deduplicated, jaccard.near_duplicates, surrogates.pseudonymized, sentencepiece.encoded_with_check):
        assert run(none).count() == 0


def test_empty_vectors(spark):
    none = topk.usable(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(none, none).count() == 0
    assert neighbours.nearest(none, none).count() == 0


def test_a_query_goes_once_to_a_cell_with_all_its_probes(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=64).astype(np.float32).astype(float).tolist()) for i in range(30)]
    queries = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    none = (np.array([], np.int64), np.array([], np.int64))
    large = (np.arange(128 * 128 * 6), np.full(128 * 128 * 6, 2))  # every bucket in two slices
    for pairs, slices in ((none, 1), (large, 2)):
        deal = neighbours.Deal(6, 128, 5000, pairs, none)
        sent = neighbours._dealt_queries(queries, deal, 64, 2, 11, neighbours.PROBES ** 2).collect()
        assert len({(r["id"], r["cell"]) for r in sent}) == len(sent) < 30 * 6 * 128
        assert {len(r["packed"]) for r in sent} == {4 * 64}
        count = {}
        for r in sent:
            count[r["id"]] = count.get(r["id"], 0) + len(set(r["codes"]))
        assert count == {i: 6 * slices * neighbours.PROBES ** 2 for i in range(30)}


@pytest.mark.parametrize("group_rows", [20_000, 40])
def test_neighbours_by_two_hashes(spark, monkeypatch, group_rows):
    monkeypatch.setattr(neighbours, "depth_for", lambda *_: 2)
    monkeypatch.setattr(neighbours, "GROUP_ROWS", group_rows)  # with 40 buckets are cut in slices and axes in parts
    monkeypatch.setattr(neighbours, "PROBE_SUMS", 100)
    x = np.random.default_rng(13).normal(size=(400, 4))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in neighbours.nearest(table, table.where("vec_id % 100 = 0")).collect()}
    for a in range(0, 400, 100):  # 64 buckets of two hashes, all of which are probed
        s = u @ u[a]
        best = sorted((i for i in range(400) if i != a), key=lambda i: -s[i])[:5]
        assert [got[a, k + 1] for k in range(5)] == best


def test_vectors_are_packed_without_loss():
    x = np.array([[1.5, -2.0], [0.1, 1e300], [np.float32(0.1), 0.0]])
    column = neighbours.packed(x)
    assert [len(v) for v in column.to_pylist()] == [8, 16, 8]
    assert (neighbours.unpacked(column, 2) == x).all()
