"""Quality classifier: a byte-level convolutional network in NumPy over overlapping chunks of the whole text.

**Network.** A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes that overlap by ``OVERLAP``, up to the last byte. The input at
each byte is its learned embedding and, for repetition, whether it equals the byte 1 to ``LAGS`` places before. ``FILTERS`` learned
filters of ``WIDTH`` bytes move by ``STRIDE``; after a rectifier each is pooled over the chunk by its maximum
and its mean. A hidden layer turns a chunk's pooled values into a logit; the document's logit combines the mean and
the smallest of its chunk logits with learned weights, and a sigmoid gives one probability. An empty or null text is one chunk of padding.

**Training.** Adam on the cross-entropy, a fixed number of steps, on the driver, from at most ``TRAIN_ROWS`` labelled rows (a documented bound): those with
the smallest hash of their id. Of each training text up to ``TRAIN_CHUNKS`` chunks, spread evenly over it, are used. Rows whose
crc32(doc_id) mod 4 is 2 are never learned from. Labels, lang, source and ids are no inputs of a score. Initial weights and
order are seeded, so the same table gives the same model.

**Scoring** reads every byte of every text, row by row in Arrow batches, without a shuffle; a long text is scored in bounded parts.
Without any labelled row of both classes all scores are the labelled share of good rows, or 0.5. Repeated rows have equal scores.
Columns of the input named like an output column are replaced. Null doc_ids count as not held out, but are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE = 8, 4
EMBED, LAGS, FILTERS, HIDDEN = 6, 12, 24, 16
TRAIN_ROWS = 3000
TRAIN_CHUNKS = 6
STEPS = 470
THRESHOLD = 0.7
PART_CHUNKS = 256
PAD = 32


def chunks_of(data: bytes) -> np.ndarray:
    """Overlapping chunks that cover every byte; the last one is padded with spaces."""
    step = CHUNK - OVERLAP
    count = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.full(count * step + OVERLAP, PAD, np.uint8)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


class Network:
    """Weights with forward and backward pass; about six thousand numbers in all."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        channels = EMBED + LAGS
        self.w = {
            "embed": rng.normal(0, 0.5, (256, EMBED)),
            "conv": rng.normal(0, (2 / (WIDTH * channels)) ** 0.5, (WIDTH * channels, FILTERS)),
            "conv_b": np.zeros(FILTERS),
            "hidden": rng.normal(0, (1 / FILTERS) ** 0.5, (2 * FILTERS, HIDDEN)),
            "hidden_b": np.zeros(HIDDEN),
            "out": rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
            "out_b": np.zeros(1),
            "join": np.array([0.5, 0.5]),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def columns(self, chunks: np.ndarray) -> np.ndarray:
        """The inputs under each filter position: (chunks, positions, WIDTH * channels)."""
        x = np.empty((*chunks.shape, EMBED + LAGS), np.float32)
        x[..., :EMBED] = self.w["embed"][chunks]
        for lag in range(1, LAGS + 1):
            x[:, :lag, EMBED + lag - 1] = 0
            x[:, lag:, EMBED + lag - 1] = chunks[:, lag:] == chunks[:, :-lag]
        size = x.shape[2]
        flat = np.lib.stride_tricks.sliding_window_view(x.reshape(len(x), -1), WIDTH * size, axis=1)
        return np.ascontiguousarray(flat[:, ::STRIDE * size])

    def logits(self, chunks: np.ndarray, keep: bool = False):
        cols = self.columns(chunks)
        act = np.maximum(cols @ self.w["conv"] + self.w["conv_b"], 0)
        pooled = np.concatenate([act.max(axis=1), act.mean(axis=1)], axis=1)
        hidden = np.maximum(pooled @ self.w["hidden"] + self.w["hidden_b"], 0)
        logit = hidden @ self.w["out"] + self.w["out_b"]
        return (logit, cols, act, pooled, hidden) if keep else logit

    def gradient(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        logit, cols, act, pooled, hidden = self.logits(chunks, keep=True)
        docs = len(labels)
        count = np.bincount(owner, minlength=docs)
        mean = np.bincount(owner, logit, minlength=docs) / count
        order = np.lexsort((logit, owner))
        least = order[np.searchsorted(owner[order], np.arange(docs))]
        doc = self.w["join"][0] * mean + self.w["join"][1] * logit[least]
        error = (1 / (1 + np.exp(-np.clip(doc, -30, 30))) - labels) * weights / docs
        d_logit = (self.w["join"][0] * error / count)[owner]
        np.add.at(d_logit, least, self.w["join"][1] * error)
        g = {"join": np.array([error @ mean, error @ logit[least]]), "out": hidden.T @ d_logit, "out_b": np.array([d_logit.sum()])}
        d_hidden = np.outer(d_logit, self.w["out"]) * (hidden > 0)
        g |= {"hidden": pooled.T @ d_hidden, "hidden_b": d_hidden.sum(axis=0)}
        d_pooled = d_hidden @ self.w["hidden"].T
        d_act = np.repeat(d_pooled[:, None, FILTERS:] / act.shape[1], act.shape[1], axis=1)
        at = act.argmax(axis=1)
        n, f = np.indices(at.shape)
        d_act[n, at, f] += d_pooled[:, :FILTERS]
        d_act = (d_act * (act > 0)).astype(np.float32)
        flat = d_act.reshape(-1, FILTERS)
        g |= {"conv": cols.reshape(len(flat), -1).T @ flat, "conv_b": flat.sum(axis=0)}
        d_cols = (flat @ self.w["conv"].T).reshape(*act.shape[:2], WIDTH, EMBED + LAGS)[..., :EMBED]
        g["embed"] = np.zeros((256, EMBED), np.float32)
        starts = np.arange(act.shape[1]) * STRIDE
        for i in range(WIDTH):
            seen = chunks[:, starts + i].ravel()
            part = d_cols[:, :, i].reshape(-1, EMBED)
            for e in range(EMBED):
                g["embed"][:, e] += np.bincount(seen, part[:, e], minlength=256)
        return g

    def score(self, data: bytes) -> float:
        chunks = chunks_of(data)
        total, least = 0.0, np.inf
        for lo in range(0, len(chunks), PART_CHUNKS):
            logit = self.logits(chunks[lo:lo + PART_CHUNKS])
            total, least = total + float(logit.sum()), min(least, float(logit.min()))
        return self.combined(total / len(chunks), least)

    def combined(self, mean: float, least: float) -> float:
        doc = self.w["join"][0] * mean + self.w["join"][1] * least
        return float(1 / (1 + np.exp(-np.clip(doc, -30, 30))))

    def scores(self, texts: list[bytes]) -> list[float]:
        """Scores of many texts; short ones share a pass of at most PART_CHUNKS chunks."""
        out: list[float] = []
        group: list[np.ndarray] = []

        def flush() -> None:
            if group:
                logit = self.logits(np.concatenate(group))
                for part in np.split(logit, np.cumsum([len(c) for c in group])[:-1]):
                    out.append(self.combined(float(part.mean()), float(part.min())))
                group.clear()

        for data in texts:
            chunks = chunks_of(data)
            if len(chunks) > PART_CHUNKS:
                flush()
                out.append(self.score(data))
                continue
            if sum(map(len, group)) + len(chunks) > PART_CHUNKS:
                flush()
            group.append(chunks)
        flush()
        return out


def train(texts: list[bytes], labels: list[int], seed: int = 0, steps: int = STEPS, batch: int = 32, rate: float = 3e-3) -> Network:
    net = Network(seed)
    rng = np.random.default_rng(seed)
    data = []
    for text in texts:
        chunks = chunks_of(text)
        data.append(chunks[np.unique(np.linspace(0, len(chunks) - 1, min(len(chunks), TRAIN_CHUNKS)).astype(int))])
    y = np.array(labels, float)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))  # both classes count alike
    first = {k: np.zeros_like(v, dtype=float) for k, v in net.w.items()}
    second = {k: np.zeros_like(v, dtype=float) for k, v in net.w.items()}
    turn = 0
    while turn < steps:  # as many steps for a small sample as for a large one
        order = rng.permutation(len(data))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            chunks = np.concatenate([data[i] for i in rows])
            owner = np.repeat(np.arange(len(rows)), [len(data[i]) for i in rows])
            turn += 1
            step = rate * 0.5 ** (2.5 * turn / steps)
            for k, g in net.gradient(chunks, owner, y[rows], weight[rows]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                move = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)
                net.w[k] = (net.w[k] - step * move).astype(np.float32)
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = 0) -> Network | float:
    """A network, or the share of good rows where the labels hold one class only."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = known.withColumnRenamed("doc_id", "label_id")
    sample = documents.join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "quality")
    # what training can use of a text: at most this many evenly spread chunks
    size, most = F.octet_length("text"), 2 * CHUNK * TRAIN_CHUNKS
    part = F.floor(size / F.lit(TRAIN_CHUNKS)).cast("int")
    raw = F.col("text").cast("binary")
    pieces = [F.substr(raw, (part * i + 1).cast("int"), F.lit(CHUNK)) for i in range(TRAIN_CHUNKS)]
    sample = sample.select("doc_id", "quality", F.when(size <= most, raw).otherwise(F.concat(*pieces)).alias("data"))
    got = sorted(sample.collect(), key=lambda r: (r["doc_id"], bytes(r["data"])))
    y = [int(r["quality"] == 1) for r in got]
    if len(set(y)) < 2:
        return float(np.mean(y)) if y else 0.5
    return train([bytes(r["data"]) for r in got], y, seed)


def score(documents: DataFrame, model: Network | float, text: str = "text") -> DataFrame:
    """documents with held_out, score and predicted."""
    new = ("held_out", "score", "predicted")
    kept = documents.drop(*[c for c in documents.columns if c.lower() in new])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [x.encode() if isinstance(x, str) else b"" for x in frame[text]]
            values = model.scores(texts) if isinstance(model, Network) else [model] * len(texts)
            yield frame.assign(score=np.array(values, float))

    scored = kept.mapInPandas(run, schema)
    return scored.withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
