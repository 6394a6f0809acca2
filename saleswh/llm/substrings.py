"""Exact substring deduplication by relative Lempel-Ziv parsing.

A word is removed if it lies in a window of 13 consecutive words that also
starts in a document with a smaller ``doc_id``.

Every document is parsed against every indexed reference block.  What makes
that affordable is that a factor of 13 words can only be in a block that holds
its *anchor*: of the 6-word runs inside a window, the one with the smallest
hash.  Equal windows have equal anchors, so blocks are hash ranges of anchors,
and a stretch of a document (the windows around one anchor, a *segment*) is
sent to the one block that can hold a factor of it:

1. texts are cut into chunks, written once to the shared folder;
2. the anchors of each chunk meet by hash; those of at least two documents are
   returned to their chunks (two chunks, or two documents of one chunk);
3. a chunk sends the distinct segments of these anchors, each with its first
   ``doc_id`` and its places, to the anchors' blocks;
4. in a block, the segments of an anchor are taken by ascending ``doc_id`` and
   factored greedily against those of smaller ids: a 13-word seed is looked up
   and extended as far as the reference agrees.  The windows that straddle a
   factor's end are looked up too, so nothing is lost at factor boundaries.
   The words themselves are compared; hashes only route;
5. the factors go back to their chunks, where the words they cover go.

Skew: copies in a chunk are sent once.  A busy anchor (in many chunks) may have
any number of different segments, so its windows are sent singly, each to a
block by its own hash; equal windows are one row per chunk then.

Defined results: null, empty and short texts lose nothing; a null ``doc_id``
neither removes nor loses words; rows that share a ``doc_id`` do not remove
words from each other; other columns are passed on (``word_spans`` and
``n_words`` replace input columns of these names).
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.llm import words as W
from saleswh.llm.tables import apart, together, written

#: Words in a window, and in the runs of which a window's anchor is one.
WINDOW, ANCHOR = 13, 6
#: An anchor found in more chunks than this is routed by window.
BUSY_CHUNKS = 32
#: Bytes of text for which there is one reference block.
BLOCK_BYTES = 8 << 20
#: Compression of chunks, which are written once and shuffled twice, and of segments.
CHUNK_LEVEL, SEGMENT_LEVEL = 6, 3

_FLAG = np.uint64(1)


def _pack(table: pa.Table | pa.RecordBatch, level: int) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))) as w:
        w.write(table)
    return out.getvalue()


def _unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, task = 0, TaskContext.get().partitionId()
    for batch in batches:
        for a, b in W.slices(batch["text"]):
            part = batch.slice(a, b - a)
            size = pc.sum(pc.fill_null(pc.binary_length(part["text"]), 0)).as_py() or 0
            yield pa.RecordBatch.from_arrays([pa.array([(task << 33) + n], pa.int64()), pa.array([size], pa.int64()), pa.array([_pack(part, CHUNK_LEVEL)], pa.binary())],
                                             names=["chunk", "bytes", "blob"])
            n += 1


class _Parsed:
    """A chunk's words, documents, window hashes and window anchors."""

    def __init__(self, docs: pa.Table):
        self.words = w = W.split(docs["text"].combine_chunks(), W.NOT_SPACE)
        ids = docs["doc_id"].combine_chunks() if isinstance(docs["doc_id"], pa.ChunkedArray) else docs["doc_id"]
        self.rows = w.rows()
        self.ids = pc.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        codes, distinct = w.coded()
        hashes = W.hashed(distinct)[codes]
        self.ok = W.inside(w.first, WINDOW)
        self.ok &= known[self.rows[:len(self.ok)]]
        n = len(self.ok)
        runs = W.gram_hashes(hashes, ANCHOR)
        self.anchor, self.at = runs[:n].copy(), np.arange(n)
        for i in range(1, WINDOW - ANCHOR + 1):
            less = runs[i:i + n] < self.anchor
            self.anchor[less] = runs[i:i + n][less]
            self.at[less] = np.flatnonzero(less) + i
        self.anchor &= ~_FLAG
        self.hashes = hashes


def _dealt(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of ``keys`` by block and key; the blocks that have keys, and their ends in that order."""
    block = (keys >> np.uint64(16)) % np.uint64(blocks)
    order = np.lexsort((keys, block))
    found, begins = np.unique(block[order], return_index=True)
    return order, found.astype(np.int64), np.append(begins[1:], len(keys))


def _anchors(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch["chunk"].to_pylist(), batch["blob"].to_pylist(), strict=True):
                p = _Parsed(_unpack(blob))
                at = np.flatnonzero(p.ok)
                key, doc = p.anchor[at], p.ids[p.rows[at]]
                step = np.ones(len(at), bool)
                step[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                key, doc = key[step], doc[step]
                if not len(key):
                    continue
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                several = np.minimum.reduceat(doc, begins) < np.maximum.reduceat(doc, begins)
                key = key[begins] | several.astype(np.uint64)
                order, found, ends = _dealt(key, blocks)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), key[order].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), chunk)), lists], names=["block", "chunk", "anchors"])
    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of each chunk's anchors, those that other documents have too; the flag now marks busy ones."""
    lists = table["anchors"].combine_chunks()
    keys = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    _, of, times = np.unique(keys & ~_FLAG, return_inverse=True, return_counts=True)
    several = np.zeros(len(times), bool)
    several[of[(keys & _FLAG) > 0]] = True
    several |= times > 1
    keep = several[of]
    out = ((keys & ~_FLAG) | (times[of] > BUSY_CHUNKS).astype(np.uint64))[keep]
    ends = np.searchsorted(row[keep], np.arange(len(lists) + 1))
    got = pa.ListArray.from_arrays(ends.astype(np.int32), out.view(np.int64))
    return pa.table({"chunk": table["chunk"].combine_chunks(), "anchors": got}).filter(pc.greater(pc.list_value_length(got), 0))


_SEGMENTS = pa.schema([("key", pa.uint64()), ("words", pa.large_binary()), ("first", pa.int64()), ("places", pa.list_(pa.int32()))])


def _segments(blocks: int):
    def run(chunk: pa.Table, anchors: pa.Table) -> pa.Table:
        none = pa.table({"block": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()), "segments": pa.array([], pa.binary())})
        if not len(chunk) or not len(anchors):
            return none
        p = _Parsed(_unpack(chunk["blob"][0].as_py()))
        keys = np.sort(anchors["anchors"].combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64))
        plain = keys & ~_FLAG
        found = np.minimum(np.searchsorted(plain, p.anchor), len(plain) - 1)
        hit = p.ok & (plain[found] == p.anchor)
        at = np.flatnonzero(hit)
        if not len(at):
            return none
        busy = (keys[found[at]] & _FLAG) > 0
        # a segment: windows in a row of one document with one anchor place; a busy anchor's windows stand alone
        new = np.ones(len(at), bool)
        new[1:] = busy[1:] | (at[1:] != at[:-1] + 1) | (p.at[at[1:]] != p.at[at[:-1]]) | (p.rows[at[1:]] != p.rows[at[:-1]])
        begin = np.flatnonzero(new)
        start, last = at[begin], at[np.append(begin[1:], len(at)) - 1]
        windows = W.gram_hashes(p.hashes, WINDOW)
        key = np.where(busy[begin], windows[start] | _FLAG, p.anchor[start])
        # words with one space between them stand for the word sequence; equal ones are sent once
        text, offsets = np.insert(p.words.data, p.words.offsets[1:-1], 0x20).tobytes(), p.words.offsets
        begins, stops = offsets[start] + start, offsets[last + WINDOW] + last + WINDOW - 1
        held: dict[tuple[int, bytes], int] = {}
        of = np.fromiter((held.setdefault((k, text[a:z]), len(held)) for k, a, z in zip(key.tolist(), begins.tolist(), stops.tolist(), strict=True)), np.int64, len(key))
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=len(held)))
        low = np.minimum.reduceat(p.ids[p.rows[start]][order], np.concatenate([[0], ends[:-1]]))
        places = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), start[order].astype(np.int32))
        keys = np.fromiter((k for k, _ in held), np.uint64, len(held))
        rows = pa.table([pa.array(keys), pa.array([x for _, x in held], pa.large_binary()), pa.array(low), places], schema=_SEGMENTS)
        order, dealt, ends = _dealt(keys, blocks)
        rows = rows.take(pa.array(order)).combine_chunks()
        out = [_pack(rows.slice(a, z - a), SEGMENT_LEVEL) for a, z in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        return pa.table({"block": pa.array(dealt), "chunk": pa.array(np.full(len(dealt), chunk["chunk"][0].as_py())), "segments": pa.array(out, pa.binary())})
    return run


def factor(words: list[bytes], index: dict[tuple[bytes, ...], tuple[int, int]], references: list[list[bytes]]) -> list[tuple[int, int, int]]:
    """The greedy parse of ``words`` against the indexed references, as (first word, words, reference).

    Only factors of at least ``WINDOW`` words count; others are literals.
    After a factor the parse goes on with the first window that the factor
    does not hold whole, so that windows across its end are looked up too.
    """
    out, i = [], 0
    while i + WINDOW <= len(words):
        seed = index.get(tuple(words[i:i + WINDOW]))
        if seed is None:
            i += 1
            continue
        ref, at = seed
        source, n = references[ref], WINDOW
        while i + n < len(words) and at + n < len(source) and words[i + n] == source[at + n]:
            n += 1
        out.append((i, n, ref))
        i += n - WINDOW + 1
    return out


def _parse(table: pa.Table) -> pa.Table:
    """Factors of a block's segments by chunk: places, windows from there, and the smallest document that has them."""
    parts = [_unpack(b) for b in table["segments"].to_pylist()]
    chunks = np.repeat(np.array(table["chunk"].to_pylist(), np.int64), [len(p) for p in parts])
    rows = pa.concat_tables(parts).combine_chunks()
    order = np.argsort(rows["key"].to_numpy(), kind="stable")
    rows, chunks = rows.take(pa.array(order)).combine_chunks(), chunks[order].tolist()
    keys, low, lists = rows["key"].to_numpy(), rows["first"].to_pylist(), rows["places"].combine_chunks()
    spots, texts = lists.flatten().to_pylist(), rows["words"].to_pylist()
    upto = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    ends = np.append(begins[1:], len(keys))
    several = upto[ends] - upto[begins] > 1
    upto = upto.tolist()
    found: list[tuple[int, int, int, int]] = []  # chunk, place, windows, document
    for a, z in zip(begins[several].tolist(), ends[several].tolist(), strict=True):
        same: dict[bytes, list[int]] = {}
        for i in range(a, z):
            same.setdefault(texts[i], []).append(i)
        owner = {t: min(low[i] for i in m) for t, m in same.items()}
        index: dict[tuple[bytes, ...], tuple[int, int]] = {}
        references: list[list[bytes]] = []
        owners: list[int] = []
        for first, tied in groupby(sorted(same, key=lambda t: (owner[t], t)), key=owner.__getitem__):
            tied = list(tied)
            for t in tied:
                n = t.count(b" ") + 2 - WINDOW
                if upto[same[t][0] + 1] - upto[same[t][0]] > 1 or len(same[t]) > 1:
                    found += [(chunks[i], at, n, first) for i in same[t] for at in spots[upto[i]:upto[i + 1]]]
                if index:
                    for at, n, ref in factor(t.split(b" "), index, references):
                        found += [(chunks[i], p + at, n - WINDOW + 1, owners[ref]) for i in same[t] if low[i] == first for p in spots[upto[i]:upto[i + 1]]]
            if len(same) > 1:
                for t in tied:
                    ws = t.split(b" ")
                    for at in range(len(ws) - WINDOW + 1):
                        index.setdefault(tuple(ws[at:at + WINDOW]), (len(references), at))
                    references.append(ws)
                    owners.append(first)
    if not found:
        return pa.table({c: pa.array([], t) for c, t in (("chunk", pa.int64()), ("place", pa.list_(pa.int32())), ("windows", pa.list_(pa.int32())), ("owner", pa.list_(pa.int64())))})
    c, p, n, o = (np.array(x, np.int64) for x in zip(*found, strict=True))
    order = np.lexsort((p, c))
    c, p, n, o = c[order], p[order], n[order], o[order]
    of, begins = np.unique(c, return_index=True)
    offsets = np.append(begins, len(c)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((p, pa.int32()), (n, pa.int32()), (o, pa.int64()))]
    return pa.table({"chunk": pa.array(of), "place": lists[0], "windows": lists[1], "owner": lists[2]})


def _clean(chunk: pa.Table, factors: pa.Table) -> pa.Table:
    docs = _unpack(chunk["blob"][0].as_py())
    text = docs["text"].combine_chunks() if isinstance(docs["text"], pa.ChunkedArray) else docs["text"]
    p = W.split(text, W.NOT_SPACE)
    ids = docs["doc_id"].combine_chunks() if isinstance(docs["doc_id"], pa.ChunkedArray) else docs["doc_id"]
    ids, rows = pc.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False), p.rows()
    edge = np.zeros(len(p) + 1, np.int64)
    if len(factors):
        at, n, owner = (factors[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "windows", "owner"))
        mine = owner < ids[rows[at]]
        np.add.at(edge, at[mine], 1)
        np.add.at(edge, at[mine] + n[mine] + WINDOW - 1, -1)
    hit = np.cumsum(edge)[:-1] > 0
    others = [c for c in docs.column_names if c not in ("text", "word_spans", "n_words")]
    return pa.table({**{c: docs[c] for c in others}, "text": W.without(text, hit, p, W.NOT_SPACE).cast(pa.string()), "word_spans": W.spans(hit, p.first), "n_words": pa.array(p.counts(), pa.int64())})


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its duplicate words, ``word_spans`` (start, words: what was removed,
    counted in words of the input) and ``n_words`` of the input."""
    spark = docs.sparkSession
    chunks = written(docs.mapInArrow(_chunk, "chunk long, bytes long, blob binary"), "chunks")
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    shared = chunks.select("chunk", "blob").mapInArrow(_anchors(blocks), "block long, chunk long, anchors array<long>") \
        .groupBy("block").applyInArrow(_shared, "chunk long, anchors array<long>")
    segments = chunks.select("chunk", "blob").groupBy("chunk").cogroup(shared.groupBy("chunk")) \
        .applyInArrow(_segments(blocks), "block long, chunk long, segments binary")
    factors = segments.groupBy("block").applyInArrow(_parse, "chunk long, place array<int>, windows array<int>, owner array<long>")
    names = [c for c in docs.columns if c not in ("text", "word_spans", "n_words")]
    schema = T.StructType([docs.schema[c] for c in names]).add("text", "string").add(
        "word_spans", T.ArrayType(T.StructType().add("start", "long").add("words", "long"))).add("n_words", "long")
    return chunks.select("chunk", "blob").groupBy("chunk").cogroup(factors.groupBy("chunk")).applyInArrow(_clean, schema)


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its duplicate words; all other columns as they were, whatever their names."""
    needs = ("doc_id", "text")
    return together(deduplicated(apart(docs, needs)), docs, needs)
