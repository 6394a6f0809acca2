"""Sequence packing along a space-filling curve.

Texts become token ids, and the hashed words of a document are projected to a
few dimensions.  Documents are range-sorted by the Hilbert key of their
direction there, and neighbours along the curve are laid end to end and cut
every 1024 tokens, so a sequence holds documents of a kind and only the end of
a range is not full.  That end is cut into sequences of powers of two, which
need no padding either.

Scale: documents are tokenised once, into a table in the shared folder that
holds 2 bytes an id.  Ranges are bounded by key and document, so equal or
busy keys are split as well, and each is packed by one task in a single pass
that holds one Arrow batch and less than one sequence.

Words are encoded once by each task, which keeps the ids of up to
``MEMO_WORDS`` of them: a text is cut where the byte-level BPE always starts a
new pre-token, before white space that follows anything else and between a
letter and punctuation, so the pieces' ids, laid end to end, are the text's.

Defined results: a null or empty text is the end-of-text id alone; rows with
equal or null ``doc_id`` are packed each on their own; other columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm import words as W
from saleswh.llm.tables import written

#: Tokens of a sequence, and the id that ends a document.
SEQUENCE, END = 1024, 0
#: Dimensions of the projection, and bits of each in the Hilbert key.
DIMENSIONS, KEY_BITS = 4, 10
#: Encoded words that a task keeps.
MEMO_WORDS = 600_000
#: Bytes of tokens in a range.
RANGE_BYTES = 64 << 20


class Encoder:
    """Ids of word pieces by a byte-level BPE of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.tokenizer = Tokenizer.from_file(path)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # words come here once, so the model's own cache would only cost time
        self.tokenizer.model = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
        self.tokenizer.encode_special_tokens = True
        self.sizes = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, np.int64)
        for token, i in model["vocab"].items():
            self.sizes[i] = len(token)  # a byte is a character in the vocabulary
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.pool, self.begins, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        """Encode pieces and keep their ids.  Pieces with white space in front can be encoded in one text."""
        joins = [p for p in new if W.NOT_SPACE[p[-1]] and not W.NOT_SPACE[p[0]]]
        alone = [p for p in new if not (W.NOT_SPACE[p[-1]] and not W.NOT_SPACE[p[0]])]
        lines = [b"".join(joins[i:i + 500]) for i in range(0, len(joins), 500)] + alone
        encoded = self.tokenizer.encode_batch_fast([x.decode() for x in lines], add_special_tokens=False)
        ids = np.array([i for e in encoded for i in e.ids], np.uint32)
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(p) for p in joins + alone])) + 1
        counts = np.diff(ends, prepend=0)
        self.places.update(zip(joins + alone, range(len(self.counts), len(self.counts) + len(counts)), strict=True))
        self.begins = np.concatenate([self.begins, len(self.pool) + ends - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.pool = np.concatenate([self.pool, ids])

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and number of the ids of each of some different pieces in ``pool``."""
        if len(self.places) + len(pieces) > MEMO_WORDS:
            self.forget()
        known = self.places
        self._learn([p for p in pieces if p not in known])
        at = np.fromiter((known[p] for p in pieces), np.int64, len(pieces))
        return self.begins[at], self.counts[at]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_PUNCTUATION = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))
_LETTER = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))


def pieces(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where texts can be cut: at their begins, before ASCII white space after anything that is no white space, and
    before ASCII punctuation but the apostrophe after a letter of a-z or Latin-1.

    White space beyond ASCII and the separators 1C-1F are never cut after.
    """
    space = ~W.NOT_SPACE[raw]
    cut = space | _PUNCTUATION[raw]
    cut[1:] &= ~space[:-1]
    spots = np.flatnonzero(cut)
    spots = spots[spots > 0]
    one = raw[spots - 1]
    two, three = raw[np.maximum(spots - 2, 0)], raw[np.maximum(spots - 3, 0)]
    odd = (one < 0x20) | ((two == 0xC2) & np.isin(one, (0x85, 0xA0))) | (np.isin(three, (0xE1, 0xE2, 0xE3)) & np.isin(two, (0x80, 0x81, 0x9A)))
    letter = _LETTER[one] | ((two == 0xC3) & ~np.isin(one, (0x97, 0xB7)))
    keep = np.zeros(len(raw) + 1, bool)
    keep[spots[np.where(space[spots], ~odd, letter)]] = True
    keep[at] = True
    return np.flatnonzero(keep)


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``x`` (integers of ``bits`` bits) along the Hilbert curve, by Skilling's transposition."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _curve(distinct: pa.Array, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hilbert keys of the directions of texts: sums of their words' vectors, which a word's hash makes up."""
    h = W.mix(W.hashed(distinct))
    shifts = np.arange(DIMENSIONS, dtype=np.uint64) * np.uint64(16)
    vectors = ((h[:, None] >> shifts) & np.uint64(0xFFFF)).astype(np.float64) / 0x7FFF - 1
    sums = np.stack([np.diff(np.concatenate([[0.0], np.cumsum(v[codes])])[first]) for v in vectors.T], axis=1) if len(codes) else np.zeros((len(first) - 1, DIMENSIONS))
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 1e-9)
    top = (1 << KEY_BITS) - 1
    return hilbert(np.clip(np.rint((unit + 1) / 2 * top), 0, top).astype(np.int64), KEY_BITS)


def _tokenize(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        kind = np.dtype("<u2") if len(encode.sizes) <= 1 << 16 else np.dtype("<u4")
        for batch in batches:
            for a, b in W.slices(batch["text"]):
                raw, at = W.text_bytes(batch["text"].slice(a, b - a))
                cuts = pieces(raw, at)
                words = W.Words(raw, cuts, np.searchsorted(cuts, at))
                codes, distinct = words.coded()
                begins, sizes = encode(W.items(distinct))
                ends = np.concatenate([[0], np.cumsum(sizes[codes])])
                tokens = encode.pool[np.repeat(begins[codes] - ends[:-1], sizes[codes]) + np.arange(ends[-1])]
                ends = ends[words.first]  # of texts
                tokens = np.insert(tokens, ends[1:], END).astype(kind)
                ends = ends + np.arange(len(ends))
                held = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(ends * kind.itemsize), pa.py_buffer(tokens)])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), pa.array(_curve(distinct, codes, words.first)), pa.array(np.diff(ends)), held.cast(pa.binary())],
                    names=["doc_id", "curve", "tokens", "ids"])
        encode.forget()  # the worker process goes on to other tasks
    return run


def _pack(width: int):
    kind = np.dtype(f"<u{width}")

    def lay(rows: list[tuple], cuts: np.ndarray, number: int) -> tuple[pa.RecordBatch, list[tuple]]:
        """Pieces up to the last of ``cuts`` (ends of sequences), and the rows beyond; rows: (doc_id, start, doc_tokens, ids)."""
        sizes = np.array([len(r[3]) for r in rows], np.int64)
        ends = np.cumsum(sizes)
        stream = np.concatenate([r[3] for r in rows])
        bounds = np.unique(np.concatenate([[0], ends[ends <= cuts[-1]], cuts]))
        begin, end = bounds[:-1], bounds[1:]
        of = np.searchsorted(ends, begin, side="right")
        sequence = np.searchsorted(cuts, begin, side="right")
        start = np.array([r[1] for r in rows], np.int64)[of] + begin - (ends - sizes)[of]
        wide = stream.astype("<u4")
        rest = [(rows[i][0], rows[i][1] + max(0, cuts[-1] - (ends[i] - sizes[i])), rows[i][2], rows[i][3][max(0, cuts[-1] - (ends[i] - sizes[i])):])
                for i in range(np.searchsorted(ends, cuts[-1], side="right"), len(rows))]
        columns = [pa.array([rows[i][0] for i in of]), pa.array(start), pa.array(end - begin), pa.array(np.array([r[2] for r in rows], np.int64)[of]),
                   pa.array(sequence + number), pa.array(begin - np.concatenate([[0], cuts])[sequence]), pa.array([wide[x:y].tobytes() for x, y in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]), rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rest = TaskContext.get().partitionId() << 33, []
        for batch in batches:
            for a in range(0, len(batch), 1000):
                part = batch.slice(a, 1000)
                rest += [(d, 0, n, np.frombuffer(ids, kind)) for d, n, ids in zip(part["doc_id"].to_pylist(), part["tokens"].to_pylist(), part["ids"].to_pylist(), strict=True)]
                full = sum(len(r[3]) for r in rest) // SEQUENCE
                if full:
                    out, rest = lay(rest, np.arange(1, full + 1) * SEQUENCE, number)
                    number += full
                    yield out
        left = sum(len(r[3]) for r in rest)
        if left:
            yield lay(rest, np.cumsum([1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]), number)[0]
    return run


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, doc_tokens, sequence_id, offset, and ``ids`` (32 bits
    each, little-endian).  ``tokenizer``: path of a byte-level BPE file, the same on all executors."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    tokens = written(docs.select("doc_id", "text").mapInArrow(_tokenize(tokenizer), f"doc_id {kind}, curve long, tokens long, ids binary"), "tokens")
    width = 2 if len(encoder(tokenizer).sizes) <= 1 << 16 else 4
    size = width * (tokens.agg(F.sum("tokens")).first()[0] or 0)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    return tokens.repartitionByRange(ranges, "curve", "doc_id").sortWithinPartitions("curve", "doc_id", "ids") \
        .mapInArrow(_pack(width), f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
