"""Whole texts to words, a batch at a time, on the bytes of an Arrow column.

Helpers that run inside Spark tasks.  A batch of texts is cut into slices of
at most ``SLICE_BYTES`` bytes (a longer text is a slice of its own), so the
numpy temporaries of a task stay bounded whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once.
SLICE_BYTES = 4 << 20

_BYTES = np.arange(256)
#: Words of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Words of lower-cased ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: a-z, 0-9 and everything beyond ASCII.
ALNUM = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, end to end, and ``len(column) + 1`` offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield start, len(sizes)


@dataclass
class Words:
    """All words of some texts: bytes end to end, word offsets, and each text's first word."""

    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def array(self) -> pa.Array:
        return pa.Array.from_buffers(pa.large_binary(), len(self), [
            None, pa.py_buffer(self.offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data))])

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A code for each word and the distinct words that the codes stand for."""
        d = self.array().dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def split(column: pa.Array, word_bytes: np.ndarray, lower: bool = False) -> Words:
    """Words of each text: maximal runs of bytes for which ``word_bytes`` is true."""
    raw, at = text_bytes(column)
    if lower:
        raw = LOWER[raw]
    keep = word_bytes[raw]
    begins, ends = keep.copy(), keep.copy()
    begins[1:] &= ~keep[:-1]
    ends[:-1] &= ~keep[1:]
    full = np.flatnonzero(np.diff(at))
    begins[at[full]] = keep[at[full]]
    ends[at[full + 1] - 1] = keep[at[full + 1] - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.concatenate([[0], np.cumsum(ends - begins)])
    return Words(raw[keep], offsets, np.searchsorted(begins, at))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them evenly (the splitmix64 finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def items(distinct: pa.Array) -> list[bytes]:
    """The values of an array of bytes."""
    raw, at = text_bytes(distinct)
    data, ends = raw.tobytes(), at.tolist()
    return [data[a:z] for a, z in zip(ends, ends[1:])]  # noqa: B905


def hashed(distinct: pa.Array) -> np.ndarray:
    """A 64-bit hash of each value, from its length and its bytes, eight at a time."""
    raw, at = text_bytes(distinct)
    sizes = np.diff(at)
    out = mix(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    active, done = np.flatnonzero(sizes), 0
    while len(active):
        lanes = raw[(at[active] + done)[:, None] + np.arange(8)]
        lanes *= (np.arange(8) < (sizes[active] - done)[:, None]).astype(np.uint8)
        out[active] = mix(out[active] * np.uint64(0xFF51AFD7ED558CCD) + lanes.view("<u8").ravel())
        done += 8
        active = active[sizes[active] > done]
    return out


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive values (the last ``n - 1`` places have none)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i]
    return mix(out)


def gram_hashes_of(rows: np.ndarray) -> np.ndarray:
    """What ``gram_hashes`` gives for each row of hashes as a run of its own."""
    out = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows.shape[1]):
            out = out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i]
    return mix(out)


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """Whether the run of ``n`` words that begins at each place ends in the same text."""
    total = int(first[-1])
    last = np.repeat(first[1:], np.diff(first))
    return (np.arange(total) + n <= last)[:max(0, total - n + 1)]


def covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Of ``len(starts) + n - 1`` places, those in a run of ``n`` that begins where ``starts`` is true."""
    edge = np.zeros(len(starts) + n, np.int64)
    edge[:len(starts)] += starts
    edge[n:n + len(starts)] -= starts
    return np.cumsum(edge)[:-1] > 0


def spans(hit: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each text its runs of hit words, as (first word, words) within the text."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    cut = np.zeros(len(hit) + 1, bool)
    cut[first] = True
    starts = np.flatnonzero((edge[:-1] == 1) | (hit & cut[:-1]))
    ends = np.flatnonzero((edge[1:] == -1) | (hit & cut[1:])) + 1
    row = np.searchsorted(first, starts, side="right") - 1
    values = pa.StructArray.from_arrays([pa.array(starts - first[row], pa.int64()), pa.array(ends - starts, pa.int64())], names=["start", "words"])
    return pa.ListArray.from_arrays(np.searchsorted(row, np.arange(len(first))).astype(np.int32), values)


def without(column: pa.Array, hit: np.ndarray, w: Words, keep: np.ndarray) -> pa.Array:
    """The texts less the words that are hit, each with the white space (all that is not a word) after it."""
    raw, at = text_bytes(column)
    word = keep[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    full = np.flatnonzero(np.diff(at))
    begins[at[full]] = word[at[full]]
    begins = np.flatnonzero(begins)
    # a hit word's bytes go up to the next word or the end of its text
    stops = np.minimum(np.append(begins[1:], len(raw)), at[1:][w.rows()]) if len(begins) else begins
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, begins[hit], 1)
    np.add.at(edge, stops[hit], -1)
    stay = np.cumsum(edge[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(stay)])[at]
    out = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[stay]))]).cast(pa.large_string())
    return pc.if_else(pc.is_valid(column), out, pa.scalar(None, pa.large_string()))
