"""Substring dedup by content-defined window hashing, in place of relative Lempel-Ziv parsing: words covered by a window that starts elsewhere too are removed.

The corpus is its own reference. It is cut into *phrases* by its content: of the 12-word grams in each window of 35
words the one with the smallest hash is the window's anchor (leftmost on ties), so equal windows have equal anchors at
equal places. A phrase is the stretch of words of neighbouring windows with the same anchor; every window lies in
exactly one phrase. The reference index, dealt to blocks by a hash of the anchor, holds every distinct phrase of every
document with its number of occurrences.

No document is factored and no match is extended; each phrase is looked up by hash in the blocks of its anchor:

* a phrase found whole in the index at another place: all its windows are repeated;
* a phrase whose anchor is found with other words around it is a border: a repeat may end inside it.
  These are checked window by window: the windows of all distinct phrases of such an anchor are looked up in a second index;
* a phrase whose anchor occurs once holds no repeated window.

Neighbouring repeated windows join to one duplicate span of at least 35 words. All windows are judged on
the input. Hashes have 64 bits; windows are compared only under equal anchors, which adds as many.

**Plan.** Counts are pre-aggregated in the tasks, so a passage that a third of all documents hold is one row per task; the
joins back to the phrases are inner joins whose hot keys Spark can split. Texts are shuffled twice (boundary check
and result) by a key of the row; no list of occurrences is ever built.

Null and empty texts have no words and nothing removed. Repeated rows are copies of each other. Rows are told apart by
doc_id and text; equal rows get equal results. Other columns are ignored. Very long texts are handled whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored
from flowgauge.llm.words import WORD_BASE, Words, run_hashes, slices, words_of

WINDOW = 35
ANCHOR = 12


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the leftmost minimum of every ``size`` neighbours."""
    at = np.arange(len(values))
    have = 1
    while have < size:
        step = min(have, size - have)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def phrases(w: Words, window: int = WINDOW, anchor: int = ANCHOR) -> dict[str, np.ndarray]:
    """Phrases of several texts: text, first window (word within the text), windows, hash of the anchor and of all words."""
    n = np.diff(w.first)
    empty = {k: np.zeros(0, t) for k, t in (("text", np.int64), ("start", np.int64), ("windows", np.int64), ("anchor", np.uint64), ("words", np.uint64))}
    if len(w.hashes) < window:
        return empty
    grams = run_hashes(w.hashes, np.arange(len(w.hashes) - anchor + 1), np.arange(anchor, len(w.hashes) + 1), WORD_BASE)
    at = _least(grams, window - anchor + 1)  # of each window, also of those that cross texts
    last = np.repeat(w.first[1:], n)[:len(at)]
    valid = np.arange(len(at)) + window <= last
    begins = np.flatnonzero(valid & np.r_[True, (at[1:] != at[:-1]) | ~valid[:-1]])
    if not len(begins):
        return empty
    ends = np.flatnonzero(valid & np.r_[(at[1:] != at[:-1]) | ~valid[1:], True]) + 1
    text = np.searchsorted(w.first, begins, side="right") - 1
    whole = run_hashes(w.hashes, begins, ends + window - 1, WORD_BASE)
    # the place of the anchor belongs to the phrase
    whole = whole ^ ((at[begins] - begins).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return {"text": text, "start": begins - w.first[text], "windows": ends - begins, "anchor": grams[at[begins]], "words": whole}


def _row_key(doc: str = "doc_id", text: str = "text"):
    return F.xxhash64(F.col(doc), F.coalesce(F.col(text), F.lit("")))


def _phrase_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                p = phrases(words_of(texts), window, anchor)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(p["text"])), pa.array(p["start"].astype(np.int32)), pa.array(p["windows"].astype(np.int32)),
                    pa.array(p["anchor"].view(np.int64)), pa.array(p["words"].view(np.int64)),
                ], names=["row", "start", "windows", "anchor", "words"])

    return docs.select("row", "text").mapInArrow(run, "row long, start int, windows int, anchor long, words long")


def _boundary_windows(docs: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows of each document's listed phrases (spans: start, windows, anchor, first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                w = words_of(texts)
                spans = part.column(2)
                owner = np.repeat(np.arange(part.num_rows), np.asarray(pa.compute.list_value_length(spans)))
                s = spans.flatten()
                start, windows, anchor, first = (np.asarray(s.field(i)) for i in range(4))
                reps = windows.astype(np.int64)
                within = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
                at = np.repeat(w.first[owner] + start, reps) + within
                hashes = run_hashes(w.hashes, at, at + window, WORD_BASE).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(owner, reps))), pa.array((at - np.repeat(w.first[owner], reps)).astype(np.int32)),
                    pa.array(np.repeat(anchor, reps)), pa.array(hashes), pa.array(np.repeat(first, reps)),
                ], names=["row", "start", "anchor", "window", "counts"])

    return docs.select("row", "text", "spans").mapInArrow(run, "row long, start int, anchor long, window long, counts long")


def _removed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spans: np.ndarray, window: int) -> tuple[int, str]:
    """Words removed and the digest of the words kept; spans are (first window, windows) of repeated windows."""
    change = np.zeros(len(starts) + 1, np.int64)
    for lo, count in spans:
        change[lo] += 1
        change[lo + count + window - 1] -= 1
    gone = np.cumsum(change[:-1]) > 0
    raw = data.tobytes()
    kept = b" ".join(raw[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist(), strict=True))
    return int(gone.sum()), hashlib.sha256(kept).hexdigest()


def deduplicated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    docs = docs.select("doc_id", "text").withColumn("row", _row_key())
    found = stored(_phrase_rows(docs, window, anchor), "rlz-phrases")
    # the reference index: distinct phrases with their occurrences (two are enough to know), and the row that has the first
    index = found.groupBy("anchor", "words").agg(
        F.count("*").alias("times"), F.min(F.struct("row", "start")).alias("first"), F.first("windows").alias("windows"))
    index = stored(index.select("anchor", "words", "times", "first.row", "first.start", "windows"), "rlz-index")
    several = index.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    # equal rows are two occurrences, although they share their key: they are counted by rows of the table
    whole = index.where("times > 1").select("anchor", "words")
    inside = found.join(whole, ["anchor", "words"]).select("row", "start", "windows")
    # boundaries: one occurrence of each distinct phrase; a phrase that is whole elsewhere only lends its windows
    bounds = index.join(several, "anchor").select("row", F.struct("start", "windows", "anchor", F.least("times", F.lit(2)).alias("counts")).alias("span"))
    bounds = stored(bounds.groupBy("row").agg(F.collect_list("span").alias("spans")), "rlz-bounds")
    distinct_rows = docs.select("row", "text").join(bounds, "row").dropDuplicates(["row"])
    windows = stored(_boundary_windows(distinct_rows, window), "rlz-windows")
    again = windows.groupBy("anchor", "window").agg(F.sum("counts").alias("times")).where("times > 1").select("anchor", "window")
    checked = windows.where("counts = 1").join(again, ["anchor", "window"]).select("row", "start", F.lit(1).alias("windows"))
    spans = inside.unionByName(checked).groupBy("row").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    return _results(docs.join(spans, "row", "left"), window)


def _results(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                w = words_of(texts)
                removed, digests = [], []
                for i, spans in enumerate(part.column(2)):
                    lo, hi = w.first[i], w.first[i + 1]
                    pairs = np.zeros((0, 2), np.int64)
                    if spans.is_valid and len(spans):
                        pairs = np.stack([np.asarray(spans.values.field(k)) for k in (0, 1)], axis=1)
                    base = w.starts[lo] if hi > lo else 0
                    top = w.ends[hi - 1] if hi > lo else 0
                    n, digest = _removed(w.data[base:top], w.starts[lo:hi] - base, w.ends[lo:hi] - base, pairs, window)
                    removed.append(n)
                    digests.append(digest)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(w.first).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests)],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
