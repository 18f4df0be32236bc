"""Packing of documents into sequences, neighbours along a Hilbert curve together.

A document becomes token ids (and the id 0 at its end), a hashed vector of its tokens, a projection of that to a few
dimensions and the position of this point on a Hilbert curve. Documents are range-partitioned and sorted by that
position, and cut into sequences as they follow each other, so that a sequence holds similar documents and no
sequence but a partition's last is short; that one is cut into pieces whose lengths are powers of two, which need no padding.

Token ids are written once (two bytes each) and sorted from there. A task streams through its partition and holds one
Arrow batch and one open sequence. Sequence ids are unique, and not consecutive between partitions.

Nulls and ties: a null text is the single id 0; equal positions are ordered by id, then by content; repeated rows are
packed each; an empty table gives no pieces. Only the id and the text column are read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import id_text, small_batches
from runlens.llm.secrets import encoder
from runlens.session import scratch_path

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
END_ID = 0
SEQUENCE = 1024
BUCKETS, DIMENSIONS, BITS = 256, 4, 12
CACHED_WORDS = 300_000


class _Words(dict):
    """Token ids, as bytes, of words that were seen before."""

    def __init__(self, encode, prefix: str):
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array("H", self.encode(self.prefix + word)).tobytes()
        return ids


# fixed values: the characters that the pattern's \\s takes beside the blank
SPACES = "\t\n\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def has_run(text: str) -> bool:
    """Some white space stands beside a blank."""
    return "  " in text or any(c in text and (f"{c} " in text or f" {c}" in text) for c in SPACES)


class Tokens:
    """Ids of a text under the vocabulary, two bytes each.

    The vocabulary's pattern lets a blank begin a token and end none, except in a run of white space. A text where no white space
    stands beside a blank is therefore tokenized word by word, with a cache; any other text as a whole, and one that
    spells the special token by the library that knows it.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.encode = encoder(f"{vocabulary}.tiktoken").encode_ordinary
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.first, self.spaced = _Words(self.encode, ""), _Words(self.encode, " ")

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            return array("H", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if has_run(text):
            return array("H", self.encode(text)).tobytes()
        head, *rest = text.split(" ")
        found = b"".join(map(self.spaced.__getitem__, rest))
        return self.first[head] + found if head else found

    def trim(self) -> None:
        for words in (self.first, self.spaced):
            if len(words) > CACHED_WORDS:
                words.clear()


_tokens: dict[str, Tokens] = {}  # one per worker


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points (n, d) of integers below 2**bits, with d * bits < 64."""
    x = [c.copy() for c in points.astype(np.int64).T]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for c in range(len(x)):
            inverted = (x[c] & q) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[c]) & low)
            x[0] ^= np.where(inverted, low, swapped)
            if c:
                x[c] ^= swapped
        q >>= 1
    for c in range(1, len(x)):
        x[c] ^= x[c - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ turn) >> bit) & 1)
    return key


def curve_keys(docs: list[np.ndarray]) -> np.ndarray:
    """Hilbert positions of documents given as arrays of token ids."""
    bucket = (((np.arange(1 << 16, dtype=np.uint64) * np.uint64(2654435761)) >> np.uint64(7)) % np.uint64(BUCKETS)).astype(np.int64)
    vectors = np.stack([np.bincount(bucket[ids], minlength=BUCKETS) for ids in docs]).astype(np.float64)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    projected = vectors @ np.random.default_rng(8).choice([-1.0, 1.0], (BUCKETS, DIMENSIONS))
    return hilbert(np.floor((np.tanh(projected) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64), BITS)


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`_id`, `_key` (position on the curve) and `_ids` (two bytes for each id, the end included), written once."""
    small_batches(docs.sparkSession)
    rows = id_text(docs, id_col, text_col)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _tokens:
            _tokens[vocabulary] = Tokens(vocabulary)
        tokens, end = _tokens[vocabulary], array("H", [END_ID]).tobytes()
        for batch in source:
            if batch.num_rows:
                ids = [tokens.ids(t) + end for t in batch.column(1).to_pylist()]
                keys = curve_keys([np.frombuffer(i, np.uint16) for i in ids])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(ids, pa.binary())],
                                                 names=["_id", "_key", "_ids"])
                tokens.trim()

    out = rows.mapInArrow(batches, f"_id {dict(rows.dtypes)['_id']}, _key long, _ids binary")
    path = scratch_path(docs.sparkSession, "token-ids")
    out.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


class _Open:
    """The sequence that is being filled: pieces (id, start, ids, doc_tokens) in order."""

    def __init__(self, first: int, size: int):
        self.number, self.size, self.pieces, self.filled, self.rows = first, size, [], 0, []

    def close(self) -> None:
        at = 0
        for doc, start, ids, total in self.pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.number, at))
            at += len(ids)
        self.number, self.pieces, self.filled = self.number + 1, [], 0

    def add(self, doc, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            part = ids[at:at + self.size - self.filled]
            self.pieces.append((doc, at, part, len(ids)))
            at, self.filled = at + len(part), self.filled + len(part)
            if self.filled == self.size:
                self.close()

    def finish(self) -> None:
        """What is left goes into sequences whose lengths are powers of two."""
        left, rest = self.pieces, self.filled
        self.pieces = []
        while rest:
            room = 1 << (rest.bit_length() - 1)
            rest -= room
            while room:
                doc, start, ids, total = left.pop(0)
                if len(ids) > room:
                    left.insert(0, (doc, start + room, ids[room:], total))
                    ids = ids[:room]
                self.pieces.append((doc, start, ids, total))
                room -= len(ids)
            self.close()


def packed_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                  size: int = SEQUENCE) -> DataFrame:
    """One row per piece: id, start (in its document), length, ids_crc32, doc_tokens, sequence_id, offset."""
    ids = tokenized(docs, id_col, text_col, vocabulary)
    ordered = ids.repartitionByRange("_key", "_id").sortWithinPartitions("_key", "_id", "_ids")
    kind = dict(ids.dtypes)["_id"]
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        state, id_type = _Open(task.partitionId() << 40, size), None

        def out() -> pa.RecordBatch:
            columns = list(zip(*state.rows, strict=True))
            state.rows = []
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)

        for batch in source:
            id_type = batch.column(0).type
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                state.add(doc, np.frombuffer(raw, np.uint16))
            if state.rows:
                yield out()
        state.finish()
        if state.rows:
            yield out()

    return ordered.mapInArrow(batches, f"`{id_col}` {kind}, " + ", ".join(f"`{n}` long" for n in names[1:]))
