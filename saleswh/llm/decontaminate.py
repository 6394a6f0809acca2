"""Benchmark decontamination with a generalised suffix automaton.

All benchmark items, as lower-cased words, go into one suffix automaton.  A
document's words are streamed through it; after each word the automaton knows
the longest stretch ending there that occurs in some item.  Where that reaches
a whole *window* of an item (13 consecutive words; all words of a shorter
item), the window's words are hit, and the items that have it are known from
the automaton's state.  Hit spans (the length limit) are removed; a document
with a twentieth of its words hit (the coverage limit) is contaminated.

Scale: the items are the stated query set, the documents are streamed once
for each block of items, and nothing is shuffled.  Items are dealt by hash
into blocks of about ``BLOCK_WORDS`` words; one block's automaton is broadcast
at a time, so its size does not follow the benchmark's.  Only stretches whose
consecutive words all follow each other in some item can hold a match; numpy
finds these, and just they are walked through the automaton.

Defined results: a null or empty text has no words and is not contaminated;
items without an id or without words match nothing; repeated items count
once; repeated documents are judged alike; ``text`` keeps its name and the
added columns replace input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.llm import words as W
from saleswh.llm.tables import apart, together, written

#: Consecutive words in a window, and the share of hit words from which a document is contaminated: 1 in 20.
WINDOW, COVERAGE = 13, 20
#: Words of items in an automaton.
BLOCK_WORDS = 100_000

#: The columns that are added, and replace those of the same names.
ADDED = {"hit_spans": "array<struct<start:bigint,words:bigint>>", "n_words": "bigint", "n_hit": "bigint", "items": "array<string>", "contaminated": "boolean"}

#: Bytes of words, in texts that are not lower-cased yet.
_WORD = W.ALNUM[W.LOWER]


class Automaton:
    """Suffix automaton of several word sequences, and the items of each of their windows."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocabulary = sorted({w for _, ws in items for w in ws})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.base = len(number) + 1
        self.next: dict[int, int] = {}  # state * base + word -> state
        self.link, self.length = [-1], [0]
        arcs: list[list[int]] = [[]]
        coded = [(item, [number[w] for w in ws]) for item, ws in items if ws]
        for _, ws in coded:
            last = 0
            for c in ws:
                last = self._extend(last, c, arcs)
        #: Windows by state: (words, items); a state has one stretch of each length.
        self.windows: dict[int, dict[int, set[str]]] = {}
        for item, ws in coded:
            n, state, held = min(window, len(ws)), 0, 0
            for c in ws:
                state, held = self.step(state, held, c)
                while self.length[self.link[state]] >= n:
                    state = self.link[state]
                    held = self.length[state]
                if held >= n:
                    self.windows.setdefault(state, {}).setdefault(n, set()).add(item)
        self.shortest = min((n for w in self.windows.values() for n in w), default=0)
        #: The nearest state up the suffix links that ends a window; 0: none.
        self.above = [0] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[s]
            self.above[s] = up if up in self.windows else self.above[up]
        pairs = {a * self.base + b for _, ws in coded for a, b in zip(ws, ws[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)

    def _extend(self, last: int, c: int, arcs: list[list[int]]) -> int:
        nxt, link, length, base = self.next, self.link, self.length, self.base

        def copy(q: int, p: int) -> int:
            clone = len(length)
            length.append(length[p] + 1)
            link.append(link[q])
            arcs.append(list(arcs[q]))
            for w in arcs[q]:
                nxt[clone * base + w] = nxt[q * base + w]
            while p != -1 and nxt.get(p * base + c) == q:
                nxt[p * base + c] = clone
                p = link[p]
            return clone

        q = nxt.get(last * base + c)
        if q is not None:  # an earlier item went this way
            if length[q] == length[last] + 1:
                return q
            clone = copy(q, last)
            link[q] = clone
            return clone
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        arcs.append([])
        p = last
        while p != -1 and p * base + c not in nxt:
            nxt[p * base + c] = new
            arcs[p].append(c)
            p = link[p]
        if p != -1:
            q = nxt[p * base + c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = copy(q, p)
                link[q] = link[new] = clone
        return new

    def step(self, state: int, held: int, c: int) -> tuple[int, int]:
        """The state and the longest matching length after one more word."""
        nxt, base = self.next, self.base
        to = nxt.get(state * base + c)
        while to is None and state:
            state = self.link[state]
            held = self.length[state]
            to = nxt.get(state * base + c)
        return (to, held + 1) if to is not None else (0, 0)

    def walk(self, ws: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(end, words, items) of every window in a stretch of known words."""
        state = held = 0
        for end, c in enumerate(ws, 1):
            state, held = self.step(state, held, c)
            s = state if state in self.windows else self.above[state]
            while s:
                for n, items in self.windows[s].items():
                    if n <= held:
                        yield end, n, items
                s = self.above[s]


def _stretches(codes: np.ndarray, first: np.ndarray, automaton: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches that may hold a window: known words that follow each other in some item."""
    known = codes >= 0
    joined = np.zeros(len(codes) + 1, bool)  # [i]: word i goes on where word i - 1 was
    if len(codes) > 1 and len(automaton.pairs):
        pair = codes[:-1] * automaton.base + codes[1:]
        at = np.minimum(np.searchsorted(automaton.pairs, pair), len(automaton.pairs) - 1)
        joined[1:-1] = known[:-1] & known[1:] & (automaton.pairs[at] == pair)
    joined[first] = False
    begins, ends = np.flatnonzero(known & ~joined[:-1]), np.flatnonzero(known & ~joined[1:]) + 1
    long = ends - begins >= automaton.shortest
    return begins[long], ends[long]


def _match(shared, cut: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        vocabulary = pa.array(automaton.vocabulary, pa.large_binary())
        for batch in batches:
            for a, b in W.slices(batch["text"]):
                part = batch.slice(a, b - a)
                w = W.split(part["text"], W.ALNUM, lower=True)
                codes = pc.fill_null(pc.index_in(w.array(), value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                edge = np.zeros(len(w) + 1, np.int64)
                items: list[set[str]] = [set(x or ()) for x in part["items"].to_pylist()]
                begins, ends = _stretches(codes, w.first, automaton)
                rows = np.searchsorted(w.first, begins, side="right") - 1
                for x, z, row in zip(begins.tolist(), ends.tolist(), rows.tolist(), strict=True):
                    for end, n, found in automaton.walk(codes[x:z].tolist()):
                        edge[x + end - n] += 1
                        edge[x + end] -= 1
                        items[row] |= found
                hit = np.cumsum(edge)[:-1] > 0
                for row, old in enumerate(part["hit_spans"].to_pylist()):  # of earlier blocks
                    for s in old or ():
                        at = w.first[row] + s["start"]
                        hit[at:at + s["words"]] = True
                n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[w.first])
                new = {"hit_spans": W.spans(hit, w.first), "n_words": pa.array(w.counts(), pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
                       "items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
                if cut:
                    new["text"] = W.without(part["text"], hit, w, _WORD).cast(pa.string())
                names = part.schema.names
                yield pa.RecordBatch.from_arrays([new.get(c, part[c]) for c in names], names=names)
    return run


def matched(docs: DataFrame, items: DataFrame, cut: bool = False) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_hit``, ``hit_spans`` (start, words), ``items`` (ids as strings, sorted)
    and ``contaminated``; ``items``: (item_id, text).  With ``cut``, ``text`` comes without its hit spans."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ADDED]
    state = docs.select(*own, *(F.lit(None).cast(kind).alias(c) for c, kind in ADDED.items() if c != "contaminated"))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    known = items.where("item_id is not null and text is not null") \
        .select(F.col("item_id").cast("string").alias("item"), terms.alias("terms")).distinct().where(F.size("terms") > 0)
    known = written(known, "benchmark-items")
    total = known.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_WORDS))
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)) == block).collect()
        automaton = Automaton(sorted((r["item"], [x.encode() for x in r["terms"]]) for r in rows))
        state = state.mapInArrow(_match(spark.sparkContext.broadcast(automaton), cut and block + 1 == blocks), state.schema)
        if block + 1 < blocks:
            state = written(state, "benchmark-hits")
    return state.withColumn("contaminated", (F.col("n_hit") > 0) & (COVERAGE * F.col("n_hit") >= F.col("n_words")))


def cleaned(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, without their hit spans; all other columns as they were, whatever their names."""
    needs = ("doc_id", "text")
    return together(matched(apart(docs, needs), items, cut=True).where("not contaminated"), docs, needs)
