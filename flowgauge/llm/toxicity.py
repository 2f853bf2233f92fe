"""Toxicity: a support vector machine with a gapped subsequence kernel over Nystroem landmarks.

**Letters.** A text becomes a stream of letter classes: case and accents are folded, digits and signs that pass for letters are read as
such, marks inside a word are left out, white space is one gap, and single letters set apart (``i d i o t``) are joined.

**Kernel.** k(s, t) of two windows is the sum over all strings u of ``ORDER`` letters of phi_u(s) phi_u(t). phi_u(s) adds
DECAY ** (letters skipped) for every way to read u in s as a subsequence that begins in one of the window's ``WINDOW`` first places and spans at
most ``SPAN`` of them; so characters put in between cost a factor each and no match.

**Training**, on the driver, from at most ``TRAIN_ROWS`` labelled documents (a documented bound; those with the smallest hash of their id, half of
each class if there are enough), each with its whole text. A label says that some sentence is toxic, not which. Sentences therefore enter by their strongest
window: those of toxic documents that score above zero and above all but one in a hundred clean sentences (the best one at least), each also with a character put in between, and the hardest of clean
documents with some at random. The first scores are log-odds of letter strings, later ones the machine's. ``LANDMARKS`` windows span
the space (K_nm K_mm^(-1/2)); the machine is linear there, with hinge loss solved by dual coordinate descent. Labels of rows whose crc32(doc_id) mod 3 is 1 are never
read; labels, lang, source and ids are no inputs of a score. Everything is seeded by content: the same tables give the same model.

**Scoring.** Every landmark's kernel value is linear in phi, so the trained machine is one weight a string u, and a window's decision the sum of weights
of what begins in it: each text is read once, row by row, without a shuffle, in parts of ``PIECE`` characters that overlap by
``OVERLAP``. A document's score is a logistic function of its strongest window.

Cases: null and empty texts have no window and score what a decision of 0 gives. Where the labels hold one class only all scores are its share (0.5
without labels). Of rows that repeat a labelled doc_id the smallest text is learned; labels that repeat count as toxic if one says so.
Repeated rows have equal scores. Null doc_ids aren't held out and not learned from. Columns named like an output column are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

ORDER, SPAN, WINDOW, DECAY = 4, 7, 10, 0.5
FIRST, COMMON, COST, EPOCHS = 6, 0.99, 10.0, 10
TRAIN_ROWS, LANDMARKS, HARD, RANDOM, ROUNDS = 3000, 512, 4000, 1500, 3
THRESHOLD = 0.7
PIECE, OVERLAP = 1 << 20, 4096
GAP, SPACE, MARK = 31, 32, 33
REACH = WINDOW + SPAN - 1
PATTERNS = [(0, *rest) for rest in combinations(range(1, SPAN), ORDER - 1)]
READ_AS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
STOPS = [ord(c) for c in ".!?\n"]
STRINGS = 1 << (5 * ORDER)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point below 0x3100: 26 letters, four classes of other letters, other digits, space, mark."""
    out = np.empty(0x3100, np.uint8)
    for cp in range(len(out)):
        char = chr(cp)
        base = unicodedata.normalize("NFKD", READ_AS.get(char, char))[0].lower()
        kind = unicodedata.category(char)
        if "a" <= base <= "z":
            out[cp] = ord(base) - 97
        elif char.isspace() or kind[0] == "Z":
            out[cp] = SPACE
        else:
            out[cp] = 26 + cp % 4 if kind[0] == "L" else 30 if kind[0] == "N" else MARK
    return out


@dataclass
class Stream:
    """Letter classes of several texts, with gaps between them; where texts and their sentences begin."""

    letters: np.ndarray
    texts: np.ndarray
    sentences: np.ndarray


def stream(texts: list[str]) -> Stream:
    """The texts as letter classes. Every text begins with REACH gaps, so that no window reads two of them."""
    points = np.frombuffer("".join(f" {t}" for t in texts).encode("utf-32-le", "replace"), np.uint32)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    table = _classes()
    kind = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], (26 + points % 4).astype(np.uint8))
    at = np.flatnonzero(kind < GAP)
    spaces = np.append(0, np.cumsum(kind == SPACE))
    parted = np.ones(len(at) + 1, bool)  # a gap before letter k
    parted[1:-1] = spaces[at[1:]] > spaces[at[:-1]]
    run = np.cumsum(parted[:-1]) - 1
    single = np.bincount(run, minlength=1) == 1
    text = np.searchsorted(first, at, side="right") - 1
    inner = np.flatnonzero(parted[1:-1]) + 1 if len(at) else np.zeros(0, int)
    joined = inner[single[run[inner]] & single[run[inner] - 1] & (text[inner] == text[inner - 1])]
    parted[joined] = False
    gaps = parted[:-1].astype(np.int64)
    begins = np.searchsorted(text, np.arange(len(texts)))  # first letter of each text
    extra = np.zeros(len(at) + 1, np.int64)
    np.add.at(extra, begins, REACH)
    to = np.arange(len(at)) + np.cumsum(gaps + extra[:-1])
    size = len(at) + int(gaps.sum() + extra.sum()) + REACH
    letters = np.full(size, GAP, np.uint8)
    letters[to] = kind[at]
    place = np.append(to, size - REACH)
    stops = np.append(0, np.cumsum(np.isin(points, STOPS)))[at] if len(at) else np.zeros(0, int)
    fresh = np.flatnonzero(np.diff(stops) > 0) + 1
    # texts without letters have only their own REACH gaps, before those of the next one
    same_after = np.searchsorted(begins, begins, side="right") - 1 - np.arange(len(texts))
    starts = place[begins] - REACH * (1 + same_after)
    return Stream(letters, starts, np.unique(np.concatenate([starts, place[fresh]])))


def strings_at(letters: np.ndarray, pattern: tuple[int, ...], count: int) -> np.ndarray:
    """Code of the letters at the pattern's offsets, for each of the first ``count`` places."""
    code = np.zeros(count, np.int32)
    for offset in pattern:
        code <<= 5
        code |= letters[offset:offset + count]
    return code


def of_words(weights: np.ndarray) -> np.ndarray:
    """The weights with 0 for every string that holds a gap, but in front."""
    code = np.arange(STRINGS)
    for i in range(ORDER - 1):
        weights = np.where((code >> (5 * i)) & 31 == GAP, 0, weights)
    return weights.astype(np.float32)


def decisions(letters: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Decision of the window at each place: the weights of all strings that begin in it."""
    count = len(letters) - REACH + 1
    if count < 1:
        return np.zeros(0, np.float32)
    starting = np.zeros(count + WINDOW - 1, np.float32)
    for pattern in PATTERNS:
        skipped = pattern[-1] + 1 - ORDER
        starting += np.float32(DECAY**skipped) * weights[strings_at(letters, pattern, len(starting))]
    out = np.zeros(count, np.float32)
    for i in range(WINDOW):
        out += starting[i:i + count]
    return out


def features(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """phi of windows of REACH letters as (window, string, value) entries; a gap may stand in front only."""
    rows, codes, values = [], [], []
    for pattern in PATTERNS:
        code = np.zeros((len(windows), WINDOW), np.int64)
        whole = np.ones(code.shape, bool)
        for i, offset in enumerate(pattern):
            x = windows[:, offset:offset + WINDOW]
            code = code << 5 | x
            whole &= (x != GAP) | (i == 0)
        row = np.nonzero(whole)[0]
        rows.append(row)
        codes.append(code[whole])
        values.append(np.full(len(row), DECAY ** (pattern[-1] + 1 - ORDER)))
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


class Machine:
    """Landmark windows with the weights of the linear machine in their space, folded into one weight a string."""

    def __init__(self, landmarks: np.ndarray):
        self.landmarks = landmarks
        row, code, value = features(landmarks)
        self.strings, at = np.unique(code, return_inverse=True)
        self.phi = np.zeros((len(self.strings), len(landmarks)), np.float32)
        np.add.at(self.phi, (at, row), value)
        gram = (self.phi.T @ self.phi).astype(float)
        self.scale = max(float(np.diag(gram).mean()), 1e-9)
        e, q = np.linalg.eigh(gram / self.scale)
        kept = e > 1e-6 * max(e[-1], 1e-9)
        self.root = q[:, kept] / np.sqrt(e[kept])

    def kernel(self, windows: np.ndarray) -> np.ndarray:
        """k(window, landmark) for all pairs."""
        row, code, value = features(windows)
        at = np.minimum(np.searchsorted(self.strings, code), len(self.strings) - 1)
        known = np.flatnonzero(self.strings[at] == code)
        met, column = np.unique(at[known], return_inverse=True)  # only strings of these windows that a landmark holds
        phi = np.bincount(row[known] * len(met) + column, value[known], minlength=len(windows) * len(met)).reshape(len(windows), len(met))
        return phi.astype(np.float32) @ self.phi[met]

    def placed(self, windows: np.ndarray, block: int = 100) -> np.ndarray:
        """The windows in the landmarks' space, and a column of ones for the bias."""
        out = np.ones((len(windows), self.root.shape[1] + 1), np.float32)
        for lo in range(0, len(windows), block):
            out[lo:lo + block, :-1] = self.kernel(windows[lo:lo + block]) / self.scale @ self.root
        return out

    def trained(self, windows: np.ndarray, labels: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
        """Weights of all strings and the bias after dual coordinate descent on the hinge loss; both classes weigh alike."""
        z = self.placed(windows)
        sign = np.where(labels == 1, 1.0, -1.0)
        upper = cost * np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
        square, alpha, w = np.einsum("ij,ij->i", z, z), np.zeros(len(z)), np.zeros(z.shape[1], np.float32)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in rng.permutation(len(z)):
                slope = sign[i] * (z[i] @ w) - 1
                new = min(max(alpha[i] - slope / square[i], 0.0), upper[i])
                if new != alpha[i]:
                    w += (new - alpha[i]) * sign[i] * z[i]
                    alpha[i] = new
        weights = np.zeros(STRINGS)
        weights[self.strings] = self.phi @ (self.root @ w[:-1] / self.scale)
        return weights.astype(np.float32), float(w[-1])


@dataclass(frozen=True)
class Model:
    """One weight a string, and the logistic function of what a document's windows decide."""

    weights: np.ndarray
    bias: float
    join: np.ndarray

    def found(self, texts: list[str]) -> np.ndarray:
        """For each text its strongest decision (0 at least), the mass of all decisions above 0, and its letters."""
        out: list[np.ndarray] = []
        group: list[str] = []

        def flush() -> None:
            if group:
                s = stream(group)
                over = np.maximum(decisions(s.letters, self.weights) + np.float32(self.bias), 0)
                size = np.add.reduceat((s.letters < GAP).astype(np.int64), s.texts)
                out.append(np.stack([np.maximum.reduceat(over, s.texts), np.add.reduceat(over.astype(float), s.texts), size], axis=1))
                group.clear()

        for text in texts:
            if len(text) > PIECE:
                flush()
                parts = np.concatenate([self.found([p]) for p in pieces(text)])
                out.append(np.array([[parts[:, 0].max(), parts[:, 1].sum(), parts[:, 2].sum()]]))
                continue
            if sum(map(len, group)) + len(text) > PIECE:
                flush()
            group.append(text)
        flush()
        return np.concatenate(out) if out else np.zeros((0, 3))

    def inputs(self, texts: list[str]) -> np.ndarray:
        strongest, mass, size = self.found(texts).T
        much, dense = np.log1p(mass), np.log1p(1000 * mass / (size + 200))
        return np.stack([strongest, much, dense, much * dense, np.ones(len(size))], axis=1)

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(texts) @ self.join, -500, 500)))


def pieces(text: str) -> Iterator[str]:
    """Parts of at most PIECE characters, each beginning OVERLAP before the last one's end."""
    for lo in range(0, max(1, len(text) - OVERLAP), PIECE - OVERLAP):
        yield text[lo:lo + PIECE]


def _log_odds(texts: list[str], y: np.ndarray) -> np.ndarray:
    """First weights: how much more often toxic documents than clean ones hold a string of FIRST letters, by its hash, in a table of STRINGS."""
    df = np.zeros((2, STRINGS), np.float32)
    for text, label in zip(texts, y, strict=True):
        for part in pieces(text):
            df[label, np.unique(_plain_strings(stream([part]).letters))] += 1
    odds = np.log((df[1] + 0.5) / (y.sum() + 1)) - np.log((df[0] + 0.5) / ((1 - y).sum() + 1))
    return np.maximum(odds - 2 * np.sqrt(1 / (df[1] + 0.5) + 1 / (df[0] + 0.5)), 0).astype(np.float32)


def _plain_strings(letters: np.ndarray) -> np.ndarray:
    code = np.zeros(len(letters) - FIRST + 1, np.uint64)
    for i in range(FIRST):
        code = code * np.uint64(0x9E3779B97F4A7C15) + letters[i:len(letters) - FIRST + 1 + i]
    return (code >> np.uint64(64 - 5 * ORDER)).astype(np.int64)


def _first_decisions(letters: np.ndarray, weights: np.ndarray) -> np.ndarray:
    starting = weights[_plain_strings(letters)]
    return np.sum([starting[i:i + len(letters) - REACH + 1] for i in range(WINDOW)], axis=0)


def _windows(texts: list[str], weights: np.ndarray, decide=decisions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strongest window of each sentence: text number, decision, letters."""
    owner, value, letters = [], [], []
    for i, text in enumerate(texts):
        for part in pieces(text):
            s = stream([part])
            found = decide(s.letters, weights)
            starts = s.sentences[s.sentences < len(found)]
            best = np.maximum.reduceat(found, starts)
            of = np.searchsorted(starts, np.arange(len(found)), side="right") - 1
            hit = np.flatnonzero(found == best[of])
            hit = hit[np.unique(of[hit], return_index=True)[1]]
            owner.append(np.full(len(hit), i))
            value.append(found[hit])
            letters.append(s.letters[hit[:, None] + np.arange(REACH)])
    return np.concatenate(owner), np.concatenate(value), np.concatenate(letters)


def with_insertions(windows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The windows with one letter put in at a place inside."""
    out = windows.copy()
    at = rng.integers(2, REACH - 3, len(out))
    i = np.arange(REACH)
    out = np.where(i > at[:, None], np.take_along_axis(windows, np.maximum(i[None, :] - 1, 0).repeat(len(out), axis=0), 1), out)
    out[np.arange(len(out)), at] = rng.integers(0, 26, len(out))
    return out


def train(texts: list[str], labels: list[int], seed: int = 0, landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model:
    y = np.array(labels)
    rng = np.random.default_rng(seed)
    toxic, clean = [t for t, v in zip(texts, y, strict=True) if v], [t for t, v in zip(texts, y, strict=True) if not v]
    weights, bias = _log_odds(texts, y), 0.0
    for turn in range(rounds):
        decide = decisions if turn else _first_decisions
        owner, value, windows = _windows(toxic, weights, decide)
        order = np.lexsort((-value, owner))
        best = np.zeros(len(order), bool)
        best[order[np.unique(owner[order], return_index=True)[1]]] = True
        _, clean_value, clean_windows = _windows(clean, weights, decide)
        plus = windows[best | (value > max(-bias, np.quantile(clean_value, COMMON)))]
        plus = plus[(plus != GAP).sum(axis=1) >= ORDER]
        hard = np.argsort(-clean_value, kind="stable")[:HARD]
        some = rng.permutation(len(clean_windows))[:RANDOM]
        minus = clean_windows[np.unique(np.concatenate([hard, some]))]
        if not len(plus) or not len(minus):
            break
        half = landmarks // 2
        chosen = [np.unique(w, axis=0) for w in (plus, minus)]
        chosen = [w[rng.permutation(len(w))[:half]] for w in chosen]
        plus = np.concatenate([plus, with_insertions(plus, rng)])
        machine = Machine(np.concatenate(chosen))
        all_windows = np.concatenate([plus, minus])
        weights, bias = machine.trained(all_windows, np.repeat([1, 0], [len(plus), len(minus)]), seed=seed)
    return Model(weights, bias, logistic(Model(weights, bias, np.zeros(5)).inputs(texts), y))


def logistic(x: np.ndarray, y: np.ndarray, sweeps: int = 300) -> np.ndarray:
    """Weights of the logistic regression of y on x with a small penalty, by Newton steps along each; all but the last (the constant) are 0 at least."""
    w = np.zeros(x.shape[1])
    for _ in range(sweeps):
        for j in range(len(w)):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = (x[:, j] @ (p - y) + 1e-2 * w[j]) / ((x[:, j] ** 2) @ (p * (1 - p)) + 1e-2)
            w[j] = w[j] - np.clip(step, -1, 1)
            if j < len(w) - 1:
                w[j] = max(w[j], 0.0)
    return w


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = 0) -> Model | float:
    """A model, or the share of toxic rows where the labels hold one class only."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    known = known.withColumn("toxic", (F.col("toxic") == 1).cast("int"))
    # the labels of either class with the smallest hashes: one bounded sort for each
    parts = [known.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for v in (1, 0)]
    both = parts[0].unionByName(parts[1])
    turn = F.row_number().over(W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    known = both.withColumn("turn", turn).orderBy("turn", "toxic").limit(rows).select(F.col("doc_id").alias("label_id"), "toxic")
    sample = documents.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    once = sample.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic"))
    got = sorted(once.collect(), key=lambda r: r["doc_id"])
    y = [r["toxic"] for r in got]
    if len(set(y)) < 2:
        return float(np.mean(y)) if y else 0.5
    return train([r["text"] for r in got], y, seed)


def score(documents: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """documents with held_out, score and predicted."""
    new = ("held_out", "score", "predicted")
    kept = documents.drop(*[c for c in documents.columns if c.lower() in new])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [x if isinstance(x, str) else "" for x in frame[text]]
            values = model.scores(texts) if isinstance(model, Model) else np.full(len(texts), model)
            yield frame.assign(score=np.asarray(values, float))

    scored = kept.mapInPandas(run, schema)
    return scored.withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
