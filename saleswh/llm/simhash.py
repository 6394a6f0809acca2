"""SimHash near-duplicates found by pigeonring filtering.

``fingerprints`` gives every text 64 bits: each bit is the majority, over the
hashes of the text's word shingles, of that bit.  Texts whose fingerprints
differ in at most three bits are linked, and ``components`` names, for every
row, the smallest ``doc_id`` that can be reached over links.

The 64 bits are a ring of four segments of 16.  If two fingerprints differ in
at most 3 bits, then by the pigeonring principle there is a segment from which
the differences of the first 1, 2, 3 and 4 consecutive segments are at most
0, 1, 2 and 3 (their proportional budgets).  Candidates are found by what such
a chain fixes exactly: its first segment, and of the two next (four bytes with
budgets 1 and 2) either both bytes of the second, or one byte of each.  These
are 5 exact keys of 32 bits for each of the 4 starts.  The budgets of the
chain then prune candidates before the full Hamming check.

Scale: only distinct fingerprints are keyed, so copies cost nothing beyond
one partial aggregation.  Keys with many fingerprints are split further by 20
of the 32 other bits, in all the ways in which three bit differences can spare
them; such a sub-key leaves 12 bits open, so it holds at most 4096
fingerprints whatever the input.  No pair is lost by that: two fingerprints
that share a crowded key and differ in at most 3 bits share one of its
sub-keys.

Defined results: null, empty and wordless texts have fingerprint zero, which
is linked like any other; fewer words than a shingle are one shingle; a null
``doc_id`` gets the component of its fingerprint but never names one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.llm import words as W
from saleswh.llm.graph import reachable_minimum
from saleswh.llm.tables import apart, together, written

SHINGLE_WORDS, SEED, BITS = 3, 42, 3
#: Fingerprints under one key beyond which the key is split.
CROWDED = 256


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(parts: set[int], width: int) -> int:
    return _signed(sum(((1 << width) - 1) << (width * p) for p in parts))


#: (start, bytes fixed): the exact keys of the chains.  Segment ``i`` is the bytes ``2i`` and ``2i + 1``.
KEYS = [(s, {2 * s, 2 * s + 1, *((2 * s + k) % 8 for k in more)}) for s in range(4) for more in ((2, 3), (2, 4), (2, 5), (3, 4), (3, 5))]


def _sums(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text, how many of its hashes have each bit; every text has at least one hash."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, np.concatenate([[0], ends[:-1]]), axis=0, dtype=np.int32)


def majority(texts: list[bytes], n: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprints of lower-cased texts."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    h: list[int] = []
    ends = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        w = text.split()
        if len(w) < n:
            h += [digest(b" ".join(w), seed)] if w else []
        else:
            line = b" ".join(w)
            stops = [*np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20).tolist(), len(line)]
            h += [digest(line[a:b], seed) for a, b in zip([0, *(x + 1 for x in stops[:-n])], stops[n - 1:], strict=True)]
        ends[i] = len(h)
    out = np.zeros(len(texts), np.uint64)
    sizes = np.diff(ends, prepend=0)
    full = np.flatnonzero(sizes)
    if len(full):
        counts = _sums(np.array(h, np.uint64), ends[full])
        bits = (2 * counts > sizes[full][:, None]).astype(np.uint8)
        out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in W.slices(batch["text"]):
            texts = pc.fill_null(batch["text"].slice(a, b - a), "").cast(pa.binary()).to_pylist()
            bits = majority([t.lower() for t in texts])
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns, with ``_bits``."""
    for batch in batches:
        for a, b in W.slices(batch["text"]):
            part = batch.slice(a, b - a)
            texts = pc.fill_null(part["text"], "").cast(pa.binary()).to_pylist()
            bits = majority([t.lower() for t in texts])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bits.view(np.int64))], names=[*batch.schema.names, "_bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``bits``, the fingerprint as a signed 64-bit integer."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprint, f"doc_id {dict(docs.dtypes)['doc_id']}, bits long")


def _ring(d: Column, start: Column, length: int) -> Column:
    """Whether the chain of ``length`` segments from ``start`` keeps its budget; ``d``: the bits that differ."""
    mask = F.element_at(F.array(*(F.lit(_mask({(s + k) % 4 for k in range(length)}, 16)) for s in range(4))), start + 1)
    return F.bit_count(d.bitwiseAND(mask)) <= length * BITS // 4


def _pairs(keyed: DataFrame, on: list[str]) -> DataFrame:
    """Linked pairs (a < b) among fingerprints that share a key."""
    left = keyed.select(*on, F.col("bits").alias("a"))
    right = keyed.select(*on, F.col("bits").alias("b"))
    d = F.col("a").bitwiseXOR(F.col("b"))
    start = F.floor(F.col("key") / 5).cast("int")
    close = _ring(d, start, 2) & _ring(d, start, 3) & (F.bit_count(d) <= BITS)
    return left.join(right, on).where((F.col("a") < F.col("b")) & close).select("a", "b")


def links(bits: DataFrame) -> DataFrame:
    """Pairs of different fingerprints (``a`` < ``b``) that differ in at most three bits; ``bits`` must be distinct."""
    keys = F.array(*(F.struct(F.lit(k).alias("key"), F.col("bits").bitwiseAND(F.lit(_mask(parts, 8))).alias("fixed")) for k, (_, parts) in enumerate(KEYS)))
    keyed = written(bits.select("bits", F.inline(keys)), "simhash-keys")
    crowds = keyed.groupBy("key", "fixed").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).select("key", "fixed")
    crowds = written(crowds, "simhash-crowds")
    found = _pairs(keyed.join(crowds, ["key", "fixed"], "left_anti"), ["key", "fixed"])
    # the 8 half bytes that a key leaves open: 3 differences spare 5 of them
    spared = [[F.lit(_mask(set(x), 4)) for x in combinations([h for h in range(16) if h // 2 not in parts], 5)] for _, parts in KEYS]
    masks = F.element_at(F.array(*(F.array(*x) for x in spared)), F.col("key") + 1)
    split = keyed.join(crowds, ["key", "fixed"], "left_semi").select("*", F.posexplode(masks).alias("sub", "mask"))
    split = split.select("key", "fixed", "sub", F.col("bits").bitwiseAND(F.col("mask")).alias("more"), "bits")
    return found.union(_pairs(split, ["key", "fixed", "sub", "more"])).distinct()


def _named(rows: DataFrame) -> DataFrame:
    """(bits, root, component_id) for every different fingerprint: ``root`` is the smallest fingerprint of its component,
    ``component_id`` the smallest ``doc_id``, null if no row of the component has one."""
    classes = written(rows.groupBy("bits").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    pairs = links(classes.select("bits"))
    reached = reachable_minimum(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = classes.join(reached, classes["bits"] == reached["node"], "left").select("bits", F.coalesce("root", "bits").alias("root"), "least_id")
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(ids, "root").select("bits", "root", "component_id")


def components(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, ``bits`` and ``component_id``."""
    rows = written(fingerprints(docs), "simhash")
    return rows.join(_named(rows), "bits").select("doc_id", "bits", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each group, all columns as they were: the rows whose ``doc_id`` names the component of their own text.

    An id may stand for several texts: each of its rows is judged by the group
    of its text, so no group goes because its name also occurs elsewhere.
    Repeated rows (one id, one group) all stay.  Of a group without any
    ``doc_id`` one row stays, the first by text.
    """
    needs = ("doc_id", "text")
    rows = apart(docs, needs)
    marks = written(fingerprints(rows), "simhash")
    named = written(_named(marks), "simhash-named")
    at_home = F.col("doc_id") == F.col("component_id")
    going = marks.where("doc_id is not null").join(named, "bits").groupBy("doc_id").agg(F.bool_or(~at_home).alias("goes"), F.bool_or(at_home).alias("stays"))
    going = written(going.where("goes"), "simhash-going")
    kept = rows.where("doc_id is not null").join(going, "doc_id", "left_anti").select(rows.columns)

    def fingerprinted(some: DataFrame) -> DataFrame:
        return some.mapInArrow(_fingerprinted, T.StructType([*some.schema.fields, T.StructField("_bits", T.LongType())]))

    if not going.where("stays").isEmpty():  # ids of which some rows stay and others go
        both = fingerprinted(rows.join(going.where("stays").select("doc_id"), "doc_id", "left_semi").select(rows.columns))
        home = named.where("component_id is not null").select(F.col("bits").alias("_bits"), "component_id")
        kept = kept.unionByName(both.join(home, "_bits").where(at_home).select(rows.columns))
    nameless = written(fingerprinted(rows.where("doc_id is null")).withColumn("_row", F.monotonically_increasing_id()), "simhash-nameless")
    free = named.where("component_id is null").select(F.col("bits").alias("_bits"), "root")
    first = nameless.join(free, "_bits").groupBy("root").agg(F.min(F.struct("text", "_row")).alias("first")).select("first._row")
    return together(kept.unionByName(nameless.join(first, "_row", "left_semi").select(rows.columns)), docs, needs)
