"""SentencePiece encoding and decoding: best-scoring segmentation by one pass of an Aho-Corasick automaton.

The automaton holds every ordinary piece. While it reads a text once, each state's output links name all pieces that
end at the present position; each of them relaxes the best score there. The best path read backwards gives the ids.
Equal scores: the longest last piece wins. A character that is no piece by itself may become its UTF-8 byte pieces (score: ten
below the worst piece for each character), so ``decode(encode(text)) == text`` holds for every text.

Spaces are written as U+2581 and one is put in front, as the model files expect; a U+2581 that is in the text is
written as bytes. No piece of such vocabularies has U+2581 after another character (checked when the model is
read; otherwise whole texts are segmented), hence the best path breaks before each of them, and the segmentation of
a word is kept for its next occurrence.

Null and empty texts give no ids. Input columns named like an output column are replaced. Rows are independent:
repeated rows, ties and key skew have no effect, and no row meets another in a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.words import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK, OWN_MARK = "▁", "\ud800"  # a lone surrogate is in no text
KEPT_WORDS = 300_000
UNKNOWN_BYTES = " ⁇ ".encode()


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id with scores and kinds; a few hundred kB that travel with the tasks."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    special_ids: frozenset[int]

    @property
    def key(self) -> str:
        return hashlib.sha256(repr((self.pieces, self.scores)).encode()).hexdigest()


def vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    byte_ids = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary needs a piece for each byte")
    return Vocabulary(
        tuple(model.id_to_piece(i) for i in ids),
        tuple(model.get_score(i) for i in ids),
        tuple(byte_ids[f"<0x{b:02X}>"] for b in range(256)),
        frozenset(i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)),
    )


class Segmenter(dict):
    """Ids of a stretch of text; stretches seen before are looked up."""

    def __init__(self, vocab: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        self.byte_ids = vocab.byte_ids
        plain = [i for i in range(len(vocab.pieces)) if i not in vocab.special_ids and i not in set(vocab.byte_ids) and vocab.pieces[i]]
        for i in plain:
            self.automaton.add_word(vocab.pieces[i], (len(vocab.pieces[i]), vocab.scores[i], i))
        self.automaton.make_automaton()
        self.singles = {vocab.pieces[i] for i in plain if len(vocab.pieces[i]) == 1}
        self.unknown = min((vocab.scores[i] for i in plain if vocab.scores[i] > -1e8), default=0.0) - 10.0
        inner = any(SPACE_MARK in vocab.pieces[i].lstrip(SPACE_MARK) for i in plain)
        self.stretch = re.compile(r".+" if inner else f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+", re.DOTALL)
        pieces = [b"" if i in vocab.special_ids else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(vocab.pieces)]
        for b, i in enumerate(vocab.byte_ids):
            pieces[i] = bytes([b])
        self.bytes_of = dict(enumerate(pieces))

    def __missing__(self, text: str) -> tuple[int, ...]:
        n = len(text)
        best = [0.0] + [None] * n
        came: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0  # positions up to here are final

        def finish(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                if text[done - 1] not in self.singles:
                    score = best[done - 1] + self.unknown
                    if best[done] is None or score > best[done]:
                        best[done], came[done] = score, (done - 1, -1)

        for last, (length, value, i) in self.automaton.iter(text):
            finish(last)
            end = last + 1
            score = best[end - length] + value
            if best[end] is None or score > best[end] or (score == best[end] and end - length < came[end][0]):
                best[end], came[end] = score, (end - length, i)
        finish(n)
        ids: list[int] = []
        while n:
            start, i = came[n]
            if i >= 0:
                ids.append(i)
            else:
                char = SPACE_MARK if text[start] == OWN_MARK else " " if text[start] == SPACE_MARK else text[start]
                ids.extend(self.byte_ids[b] for b in reversed(char.encode()))
            n = start
        found = tuple(reversed(ids))
        if len(text) <= 64:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[text] = found
        return found

    def encode(self, text: str) -> Iterator[tuple[int, ...]]:
        if not text:
            return iter(())
        marked = SPACE_MARK + text.replace(SPACE_MARK, OWN_MARK).replace(" ", SPACE_MARK)
        return map(self.__getitem__, self.stretch.findall(marked))

    def decode(self, ids) -> str:
        data = b"".join([self.bytes_of.get(i, UNKNOWN_BYTES) for i in ids])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _segmenter(key: str, vocab: Vocabulary) -> Segmenter:
    return Segmenter(vocab)


def _with_columns(df: DataFrame, new: dict[str, T.DataType], run) -> DataFrame:
    """df with new columns whose Arrow arrays ``run(batch)`` yields, part by part; clashing columns are replaced."""
    kept = df.drop(*[c for c in df.columns if c.lower() in new])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in new.items()]])
    names = kept.columns

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part, arrays in run(batch):
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), *arrays], names=[*names, *new])

    return df.mapInArrow(batches, schema)


def encode(df: DataFrame, text: str = "text", vocab: Vocabulary | None = None) -> DataFrame:
    """df with ``ids`` (array of int) and ``n_tokens`` (long) of a text column."""
    vocab = vocab or vocabulary()
    key = vocab.key

    def run(batch):
        segmenter = _segmenter(key, vocab)
        for part, texts in slices(batch, text):
            values, counts = [], []
            for raw in texts:
                ids = np.fromiter(chain.from_iterable(segmenter.encode(raw.decode())), np.int32)
                values.append(ids)
                counts.append(len(ids))
            offsets = np.concatenate(([0], np.cumsum(counts, dtype=np.int64))).astype(np.int32)
            yield part, [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values))), pa.array(counts, pa.int64())]

    return _with_columns(df, {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType()}, run)


def decode(df: DataFrame, ids: str = "ids", vocab: Vocabulary | None = None) -> DataFrame:
    """df with ``decoded`` (string): the text that the ids stand for; null ids give the empty text."""
    vocab = vocab or vocabulary()
    key = vocab.key

    def run(batch):
        segmenter = _segmenter(key, vocab)
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            column = part.column(part.schema.get_field_index(ids))
            texts = [segmenter.decode(np.asarray(x.values).tolist()) if x.is_valid else "" for x in column]
            yield part, [pa.array(texts, pa.string())]

    return _with_columns(df, {"decoded": T.StringType()}, run)


def encoded_with_check(documents: DataFrame, vocab: Vocabulary | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and whether decoding the ids returns the text (null: the empty text)."""
    vocab = vocab or vocabulary()
    both = decode(encode(documents.select("doc_id", "text"), vocab=vocab), vocab=vocab)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return both.select("doc_id", "n_tokens", "ids", same.alias("round_trip"))
