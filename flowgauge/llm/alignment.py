"""Alignment of two tokenizers over a corpus: which pieces of A and B stand for the same bytes, and how often.

Each text is encoded by a byte-level BPE (A, on space + text) and a SentencePiece model (B, which adds the space itself). Both
token sequences cover the same bytes; the places where a token of either ends cut them into segments, and each segment
is one overlapping pair of tokens, a link. Places where both end close a group.

**Inverted pair bitmaps.** A map task numbers its documents inside blocks of at most 65,536 and turns links into one
compressed bitmap of documents for each pair of ids, block and multiplicity plane (plane p holds the documents in which bit p of the pair's
number of links is set): a sorted array of 16-bit places, or a bitset where that is shorter. Bitmaps of one pair and block
meet in a shuffle by pair, are OR-merged, and counted: the bits of the OR of all planes are documents, the bits of plane p count 2**p
links each. The merged postings, joined with their pair's count, then return scores to documents: each bit of plane p adds 2**p times the
count. Partial sums by document are added before and after that shuffle.

A pair held by every document has one short row a block and plane, so no key is hot; nothing is collected or broadcast, and the only
tables kept are the bitmaps and one row a document. A task holds at most ``HELD`` postings and one piece of text; texts are encoded in parts of about ``PART``
characters, cut before a space between two word characters, where neither tokenizer has a token that crosses; long ones are linked so, too.

Cases: null and empty texts, and texts whose tokens don't give back space + text, have no tokens: zeros and ''. Strings of special tokens inside texts are plain
text. Rows are independent: a repeated row or doc_id counts as often as it occurs, null doc_ids are returned as null. An empty table gives no
rows. Ties for the highest count of a B id: all of them are best. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored
from flowgauge.llm.words import slices

BYTE_MODEL, PIECE_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: The word pattern of the byte-level model family (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PART, PIECE, LONG = 1 << 18, 1 << 20, 1 << 22
HELD, BLOCK = 3_000_000, 1 << 16
SALTS = 8
CUT = re.compile(r"(?<=\w) (?=\w)")
ENDS = (b",", b"|", b";", b"")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass(frozen=True)
class Models:
    """Both models as they travel with the tasks, about two MB."""

    tokens: tuple[bytes, ...]
    model: bytes

    @property
    def key(self) -> str:
        return hashlib.sha256(b"\0".join(self.tokens) + self.model).hexdigest()


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def models(byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> Models:
    with open(byte_model, encoding="utf-8") as file:
        read = json.load(file)
    vocab, byte = read["model"]["vocab"], byte_of_character()
    special = {t["content"] for t in read["added_tokens"]}
    plain = sorted((i, t) for t, i in vocab.items() if t not in special)
    merges = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
    if [i for i, _ in plain] != list(range(len(plain))) or any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        raise ValueError("ids of the byte-level model must follow the order of its merges")
    with open(piece_model, "rb") as file:
        return Models(tuple(bytes(byte[c] for c in t) for _, t in plain), file.read())


class Aligner:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, models: Models):
        import sentencepiece
        import tiktoken

        ranks = {t: i for i, t in enumerate(models.tokens)}
        self.a = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=models.model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = list(models.tokens)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.written = [str(i).encode() + e for i in range(max(len(self.a_bytes), len(self.b_bytes))) for e in ENDS]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def parts(self, text: str, size: int) -> Iterator[str]:
        """The text cut at spaces (which are left out) where tokens of both models begin anew."""
        lo = 0
        while self.cuts and len(text) - lo > size and (cut := CUT.search(text, lo + size)):
            yield text[lo:cut.start()]
            lo = cut.end()
        yield text[lo:]

    def tokens(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B; None where their bytes aren't space + text."""
        if not text:
            return None
        a, b = [], []
        for part in self.parts(text.decode(), PART):
            x, y, data = self.a.encode_ordinary(" " + part), self.b.encode(part), b" " + part.encode()
            if b"".join([self.a_bytes[i] for i in x]) != data or b"".join([self.b_bytes[i] for i in y]) != data:
                return None
            a.append(np.array(x, np.int64))
            b.append(np.array(y, np.int64))
        return np.concatenate(a), np.concatenate(b)


@lru_cache(maxsize=2)
def _aligner(key: str, models: Models) -> Aligner:
    return Aligner(models)


@dataclass
class Links:
    """The links of several texts: pair keys and the text of each; counts and written groups of each text."""

    key: np.ndarray
    text: np.ndarray
    counts: np.ndarray
    written: list[bytes]


def links_of(aligner: Aligner, texts: list[bytes]) -> Links:
    """All links at once: the bytes of the texts in a row, marked where tokens of A and of B end."""
    found = [aligner.tokens(t) for t in texts]
    none = np.zeros(0, np.int64)
    a, b = (np.concatenate([none, *(f[side] for f in found if f)]) for side in (0, 1))
    n_a, n_b = (np.array([len(f[side]) if f else 0 for f in found], np.int64) for side in (0, 1))
    end_a, end_b = np.cumsum(aligner.a_size[a]), np.cumsum(aligner.b_size[b])
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    size = int(end_a[-1]) + 1 if len(a) else 1
    is_a, is_b = np.zeros(size, bool), np.zeros(size, bool)
    is_a[end_a], is_b[end_b] = True, True
    is_both = is_a & is_b
    upto_a, upto_b, upto_both = (np.cumsum(x, dtype=np.int32) for x in (is_a, is_b, is_both))
    of_text = np.bincount(np.append(0, end_a)[last_a], minlength=size)
    before = (np.cumsum(of_text) - of_text).astype(np.int32)  # texts that end before a byte
    ends, common = np.flatnonzero(is_a | is_b), np.flatnonzero(is_both)
    key = a[upto_a[ends] - is_a[ends]] * len(aligner.b_bytes) + b[upto_b[ends] - is_b[ends]]
    n_groups = np.bincount(before[common], minlength=len(texts)).astype(np.int64)
    # the written form: tokens by group, A before B, each with what follows it
    group_a, group_b = upto_both[end_a] - is_both[end_a], upto_both[end_b] - is_both[end_b]
    after_b = np.where(is_both[end_b], 2, 0)
    after_b[last_b[n_b > 0] - 1] = 3
    b_before, a_upto = np.append(0, upto_b[common]), upto_a[common]
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + b_before[group_a]] = a * 4 + is_both[end_a]
    order[np.arange(len(b)) + a_upto[group_b]] = b * 4 + after_b
    table, codes, bounds = aligner.written, order.tolist(), np.append(0, last_a + last_b).tolist()
    written = [b"".join([table[c] for c in codes[lo:hi]]) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    return Links(key, before[ends], np.stack([n_a, n_b, n_groups, n_a + n_b - n_groups], axis=1), written)


def linked(aligner: Aligner, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Pairs with the number of their text as ``key << 16 | number``, ascending, links of each, counts and sha256 of each text.

    A text over LONG bytes is linked part by part."""
    links = links_of(aligner, [t if len(t) <= LONG else b"" for t in texts])
    found = [np.unique(links.key << 16 | links.text, return_counts=True)]
    sha = [hashlib.sha256(w).hexdigest() if w else "" for w in links.written]
    for i in (i for i, t in enumerate(texts) if len(t) > LONG):
        parts = list(aligner.parts(texts[i].decode(), PIECE))
        if not all(aligner.tokens(p.encode()) for p in parts):
            continue
        digest = hashlib.sha256()
        for k, part in enumerate(parts):
            one = links_of(aligner, [part.encode()])
            found.append(np.unique(one.key << 16 | i, return_counts=True))
            links.counts[i] += one.counts[0]
            digest.update(b";" * (k > 0) + one.written[0])
        sha[i] = digest.hexdigest()
    codes, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(found) > 1:
        codes, at = np.unique(codes, return_inverse=True)
        counts = np.bincount(at, counts).astype(np.int64)
    return codes, counts.astype(np.int32), links.counts, sha


def _starts(*sorted_arrays: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins."""
    size = len(sorted_arrays[0])
    new = np.ones(size, bool)
    new[1:] = False
    for x in sorted_arrays:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _or(codes: np.ndarray) -> np.ndarray:
    """The distinct codes, ascending; a stable sort merges the ascending runs that come in."""
    codes.sort(kind="stable")
    return codes[_starts(codes)]


def packed(first: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Bitmaps of rows that begin at ``first`` of the ascending ``places``: the bitset's first place (-1: an array), and the bytes."""
    ends = np.append(first[1:], len(places))
    count = ends - first
    base = places[first] & ~7
    size = (places[ends - 1] >> 3) - (base >> 3) + 1
    dense = size < 2 * count
    at = np.zeros(len(first) + 1, np.int64)
    np.cumsum(np.where(dense, size, 2 * count), out=at[1:])
    data = np.zeros(at[-1], np.uint8)
    row = np.repeat(np.arange(len(first)), count)
    is_dense = dense[row]
    rank = np.arange(len(places)) - first[row]
    flat = ~is_dense
    to = at[row[flat]] + 2 * rank[flat]
    data[to], data[to + 1] = places[flat] & 255, places[flat] >> 8
    r, p = row[is_dense], places[is_dense]
    to = at[r] + (p >> 3) - (base[r] >> 3)
    if len(to):
        begin = _starts(to)
        data[to[begin]] = np.add.reduceat((1 << (p & 7)).astype(np.uint8), begin)
    bytes_ = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(at), pa.py_buffer(data)])
    return np.where(dense, base, -1), bytes_.cast(pa.binary())


def unpacked(base: np.ndarray, bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every bit, ascending by row and place."""
    bitmaps = bitmaps.cast(pa.large_binary())
    at = np.frombuffer(bitmaps.buffers()[1], np.int64)[bitmaps.offset:bitmaps.offset + len(bitmaps) + 1]
    buffer = bitmaps.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[at[0]:at[-1]] if buffer else np.zeros(0, np.uint8)
    at = at - at[0]
    size = np.diff(at)
    row = np.repeat(np.arange(len(size)), size)
    rank = np.arange(len(data)) - at[row]
    flat = base[row] < 0
    low = np.flatnonzero(flat & (rank & 1 == 0))
    bits = np.flatnonzero(np.unpackbits(data[~flat], bitorder="little"))
    byte = np.flatnonzero(~flat)[bits >> 3]
    rows = np.concatenate([row[low], row[byte]])
    places = np.concatenate([data[low] + (data[low + 1].astype(np.int64) << 8), base[row[byte]] + 8 * rank[byte] + (bits & 7)])
    order = np.argsort(rows, kind="stable")
    return rows[order], places[order]


FOUND = "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, place int, key long, plane int, base int, bitmap binary"


def found_links(documents: DataFrame, models: Models) -> DataFrame:
    """Rows of documents (with their block and place) and rows of bitmaps (with key and plane), in one pass."""
    key = models.key
    schema = FOUND.format(id=documents.schema["doc_id"].dataType.simpleString())
    arrow = pa.schema([
        *[(n, pa.int64()) for n in COUNTS], ("groups_sha256", pa.string()), ("block", pa.int64()),
        ("place", pa.int32()), ("key", pa.int64()), ("plane", pa.int32()), ("base", pa.int32()), ("bitmap", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(key, models)
        block, place, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def batch_of(ids: pa.Array, n: int, **columns) -> pa.RecordBatch:
            arrays = [columns.get(f.name, pa.nulls(n, f.type)) for f in arrow]
            return pa.RecordBatch.from_arrays([ids, *arrays], names=["doc_id", *arrow.names])

        def bitmaps() -> Iterator[pa.RecordBatch]:
            codes, counts = np.concatenate([c for c, _ in held]), np.concatenate([c for _, c in held])
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            plane = 0
            while (counts >> plane).any():
                code = codes[(counts >> plane) & 1 == 1]
                if len(code):
                    first = _starts(code >> 16)
                    base, data = packed(first, code & (BLOCK - 1))
                    for lo in range(0, len(first), 10_000):
                        n = len(first[lo:lo + 10_000])
                        yield batch_of(
                            pa.nulls(n, id_type), n, block=pa.array(np.full(n, block)), key=pa.array(code[first[lo:lo + n]] >> 16),
                            plane=pa.array(np.full(n, plane, np.int32)), base=pa.array(base[lo:lo + n].astype(np.int32)), bitmap=data.slice(lo, n),
                        )
                plane += 1

        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            id_type = ids.type
            for part, texts in slices(batch, "text", PIECE):
                for lo in range(0, len(texts), BLOCK):
                    some = texts[lo:lo + BLOCK]
                    if place + len(some) > BLOCK:
                        if held:
                            yield from bitmaps()
                        held, size, place, block = [], 0, 0, block + 1
                    codes, counts, numbers, sha = linked(aligner, some)
                    column = part.column(part.schema.get_field_index("doc_id")).slice(lo, len(some))
                    yield batch_of(
                        column, len(some), **{n: pa.array(numbers[:, i]) for i, n in enumerate(COUNTS)}, groups_sha256=pa.array(sha, pa.string()),
                        block=pa.array(np.full(len(some), block)), place=pa.array(np.arange(place, place + len(some)), pa.int32()),
                    )
                    if len(codes):
                        held.append((codes + place, counts))
                        size += len(codes)
                    place += len(some)
                    if size >= HELD:
                        yield from bitmaps()
                        held, size = [], 0
        if held:
            yield from bitmaps()

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def merged(bitmaps: DataFrame) -> DataFrame:
    """One bitmap for each pair, block and plane, with the documents of its pair and block (on the first plane) and its links."""
    columns = ["key", "block", "plane", "base", "bitmap"]
    dealt = bitmaps.select(*columns).repartition("key").sortWithinPartitions("key", "block", "plane")

    def join(key, block, plane, base, data: pa.Array) -> pa.RecordBatch:
        row, place = unpacked(base, data)
        new_row = _starts(key, block, plane)
        of_row = np.searchsorted(new_row, np.arange(len(key)), side="right") - 1
        code = _or(of_row[row].astype(np.int64) << 16 | place)  # of equal pairs, blocks and planes
        first = _starts(code >> 16)
        out_base, out = packed(first, code & (BLOCK - 1))
        k, b, p = key[new_row], block[new_row], plane[new_row]
        new_pair = _starts(k, b)
        pair = np.searchsorted(new_pair, np.arange(len(k)), side="right") - 1
        docs = np.zeros(len(k), np.int64)
        every = _or(pair[code >> 16].astype(np.int64) << 16 | code & (BLOCK - 1))  # of the planes
        docs[new_pair] = np.bincount(every >> 16, minlength=len(new_pair))
        links = np.diff(np.append(first, len(code))) << p
        arrays = [k, b, p.astype(np.int32), out_base.astype(np.int32), docs, links]
        return pa.RecordBatch.from_arrays([*map(pa.array, arrays), out], names=["key", "block", "plane", "base", "docs", "links", "bitmap"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 10_000):
                part = batch.slice(lo, 10_000)
                table = pa.Table.from_batches([part] if rest is None else [rest, part]).combine_chunks()
                key, block = (np.asarray(table[c]) for c in ("key", "block"))
                cut = _starts(key, block)[-1]  # the last pair and block may go on in the next part
                if cut:
                    yield join(*(np.asarray(table[c])[:cut] for c in columns[:4]), table["bitmap"].combine_chunks().slice(0, cut))
                rest = table.slice(cut).combine_chunks().to_batches()[0]
        if rest is not None and rest.num_rows:
            yield join(*(np.asarray(rest.column(i)) for i in range(4)), rest.column(4))

    return dealt.mapInArrow(run, "key long, block long, plane int, base int, docs long, links long, bitmap binary")


def pair_counts(postings: DataFrame, b_size: int) -> DataFrame:
    """key, a, b, docs, links of each pair and whether its links are the most of its B id."""
    counts = postings.groupBy("key").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    counts = counts.withColumn("b", F.col("key") % b_size)
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    best = counts.join(most, "b").withColumn("best", F.col("links") == F.col("most"))
    return best.select("key", F.expr(f"key DIV {b_size}").alias("a"), "b", "docs", "links", "best")


def returned(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum by block and place."""
    scored = postings.select("key", "block", "plane", "base", "bitmap").join(counts.select("key", F.col("links").alias("count"), "best"), "key")
    dealt = scored.repartition("block", F.pmod("key", F.lit(SALTS))).sortWithinPartitions("block").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 10_000):
                part = batch.slice(lo, 10_000)
                block, plane, base, count, best = (np.asarray(part.column(part.schema.get_field_index(c)).cast(pa.int64())) for c in ("block", "plane", "base", "count", "best"))
                row, place = unpacked(base, part.column(part.schema.get_field_index("bitmap")))
                new = _starts(block)
                of = np.searchsorted(new, np.arange(len(block)), side="right") - 1
                code = of[row].astype(np.int64) << 16 | place
                order = np.argsort(code, kind="stable")
                code, row = code[order], row[order]
                first = _starts(code)
                n_best, total = (np.add.reduceat(v[row] << plane[row], first) for v in (best, count))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[new][code[first] >> 16]), pa.array(code[first] & (BLOCK - 1), pa.int32()), pa.array(n_best), pa.array(total)],
                    names=["block", "place", "n_best", "count_sum"],
                )

    partial = dealt.mapInArrow(run, "block long, place int, n_best long, count_sum long")
    return partial.groupBy("block", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(documents: DataFrame, model: Models | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of documents with their counts and scores, and the table of pairs (a, b, docs, links, best)."""
    model = model or models()
    found = stored(found_links(documents, model), "pair-bitmaps")
    postings = stored(merged(found.where("key IS NOT NULL")), "pair-postings")
    counts = stored(pair_counts(postings, len(Aligner(model).b_bytes)), "pair-counts")
    scores = returned(postings, counts)
    rows = found.where("key IS NULL").drop("key", "plane", "base", "bitmap").join(scores, ["block", "place"], "left")
    zero = F.lit(0).cast("long")
    rows = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
    return rows, counts.select("a", "b", "docs", "links", "best")
