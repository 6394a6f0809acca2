"""Phrase collocations, mined with a HAT-trie in every task.

A HAT-trie is a shallow trie over word ids whose leaves are hash containers: a
container holds the rest of its phrases with their counts and, when it grows
beyond ``Limits.burst`` phrases, bursts into an inner node with a container for each
next word.  A task counts the phrases of its texts in one trie for each
language.  Beyond ``Limits.held`` phrases it spills whole subtrees, the largest first,
as runs sorted by phrase.  A run is cut by prefix partition (a hash of all words
but the last), and the runs of each partition are merged block by block.

Phrases are counted length by length.  No phrase can be frequent whose first or
last ``n - 1`` words are not, so the frequent phrases of one length are a filter
for the next: a bitmap of ``FILTER_BITS`` bits by hash, the same for any input.
It never loses a frequent phrase; where it is crowded it only lets more through,
and these are counted like all others.

Scores, cuts and the test against longer phrases are DataFrame joins on
(lang, phrase), which are unique keys.

Scale: what is shuffled are distinct phrases of a task, not occurrences.
Partitions follow the text's size (``PARTITION_BYTES``).  A prefix that begins
over 1/``HOT`` of all words is dealt by whole phrases instead, so the
successors of a very common word spread over all partitions; there can be no
more than ``HOT`` such prefixes.  Texts beyond ``Limits.slice_bytes`` are cut at
separators.  A language is never gathered in one task: its first phrases are
chosen in each task before they meet.

Defined results: null texts have no words; a null ``lang`` counts as ``und``
and so does ``und`` itself; repeated rows count as often as they are there;
all other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleswh.llm import words as W
from saleswh.llm.tables import written

LEAST, LONGEST, TOP = 30, 4, 2000
#: A phrase goes if a longer one around it has this share of its count, in hundredths.
SHARE = 80
FILTER_BITS, BLOCK_BITS = 1 << 27, 1 << 19
PARTITION_BYTES, HOT = 16 << 20, 4096
#: Bits of a word id, and how many of them tell the first words of a block apart.
ID_BITS, IN_BLOCK = 18, 8
#: Phrases that are taken into the tries at once: their words have ids.
AT_ONCE = (1 << ID_BITS) // LONGEST

_ASCII = np.arange(256)
SEPARATOR = np.isin(_ASCII, [*b".,;:!?", *range(0x0A, 0x0E)])
IN_WORD = ~(SEPARATOR | (_ASCII == 0x20) | (_ASCII == 0x09))


@dataclass(frozen=True)
class Limits:
    """Phrases of a container before it bursts, of a task's tries before they spill, and of a run that are merged at once."""

    burst: int = 4096
    held: int = 400_000
    merged: int = 1 << 16
    slice_bytes: int = W.SLICE_BYTES


RUN = "bucket int, lang string, total long, phrases array<string>, counts array<long>"


# ------------------------------------------------------------------ the trie
class Container:
    """What follows the first ``depth`` words of phrases, packed in one number, with its count; at depth 0 the phrases of a
    block of first words."""

    def __init__(self, depth: int):
        self.depth, self.counts = depth, {}


class Inner:
    """A container or another inner node for each next word."""

    def __init__(self, depth: int):
        self.depth, self.below = depth, {}


def sorted_counts(node: Container) -> tuple[np.ndarray, np.ndarray]:
    keys = np.fromiter(node.counts.keys(), np.int64, len(node.counts))
    counts = np.fromiter(node.counts.values(), np.int64, len(node.counts))
    order = np.argsort(keys)
    return keys[order], counts[order]


class HatTrie:
    """Counts of phrases of ``n`` word ids: a container for each block of first words, which bursts into one for each of
    them, and these by the next word."""

    def __init__(self, n: int, burst: int):
        self.n, self.burst, self.held = n, burst, 0
        self.root: dict[int, Container | Inner] = {}

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Different phrases, a row of word ids each, in order."""
        block, keys = ids[:, 0] >> IN_BLOCK, ids[:, 0] & ((1 << IN_BLOCK) - 1)
        for i in range(1, self.n):
            keys = keys << ID_BITS | ids[:, i]
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):  # noqa: B905
            b = int(block[a])
            self.root[b] = self._put(self.root.get(b) or Container(0), keys[a:z], counts[a:z])

    def _put(self, node: Container | Inner, keys: np.ndarray, counts: np.ndarray) -> Container | Inner:
        if isinstance(node, Container):
            have, before = node.counts, len(node.counts)
            for k, c in zip(keys.tolist(), counts.tolist()):  # noqa: B905
                have[k] = have.get(k, 0) + c
            self.held += len(have) - before
            if len(have) <= self.burst or node.depth >= self.n - 1:
                return node
            self.held -= len(have)
            keys, counts = sorted_counts(node)
            node = Inner(node.depth)
        bits = ID_BITS * (self.n - 1 - node.depth)
        word, tails = keys >> bits, keys & ((1 << bits) - 1)
        edges = np.flatnonzero(np.diff(word, prepend=-1, append=-1))
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):  # noqa: B905
            w = int(word[a])
            node.below[w] = self._put(node.below.get(w) or Container(node.depth + 1), tails[a:z], counts[a:z])
        return node

    def _all(self, node: Container | Inner, prefix: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys as the block's container had them."""
        if isinstance(node, Container):
            keys, counts = sorted_counts(node)
            yield (keys + (prefix << (ID_BITS * (self.n - node.depth))) if node.depth else keys), counts
        else:
            for w, child in node.below.items():
                yield from self._all(child, prefix << ID_BITS | w)

    def spilled(self, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """Whole subtrees, the largest first, until at most ``leave`` phrases are left: their word ids, a row each, and counts."""
        trees = [(b, list(self._all(node))) for b, node in self.root.items()]
        trees.sort(key=lambda t: -sum(len(k) for k, _ in t[1]))
        ids, counts = [np.zeros((0, self.n), np.int64)], [np.zeros(0, np.int64)]
        shifts = ID_BITS * np.arange(self.n - 1, -1, -1)
        for b, parts in trees:
            if self.held <= leave:
                break
            del self.root[b]
            keys = np.concatenate([k for k, _ in parts])
            rows = (keys[:, None] >> shifts) & ((1 << ID_BITS) - 1)
            rows[:, 0] += b << IN_BLOCK
            self.held -= len(keys)
            ids.append(rows)
            counts += [c for _, c in parts]
        return np.concatenate(ids), np.concatenate(counts)


class Vocabulary:
    """Ids of the words that a task's tries hold, with the words and their hashes."""

    def __init__(self):
        self.ids, self.hashes = {}, []

    def of(self, distinct: list[bytes], hashes: np.ndarray) -> np.ndarray:
        ids, out = self.ids, []
        for word, h in zip(distinct, hashes.tolist()):  # noqa: B905
            i = ids.get(word)
            if i is None:
                i = ids[word] = len(ids)
                self.hashes.append(h)
            out.append(i)
        return np.array(out, np.int64)


# ------------------------------------------------------------------ texts
def pieces(column: pa.Array, most: int) -> Iterator[pa.Array]:
    """The texts in slices; one that is longer than a slice is cut after separators."""
    for a, z in W.slices(column, most):
        part = column.slice(a, z - a)
        size = pc.binary_length(part[0]).as_py() if z - a == 1 else 0
        if (size or 0) <= most:
            yield part
            continue
        raw, _ = W.text_bytes(part)
        cuts, start = np.flatnonzero(SEPARATOR[raw]) + 1, 0
        while start < len(raw):
            later = cuts[np.searchsorted(cuts, start + most):][:1]
            end = int(later[0]) if len(later) else len(raw)
            yield pa.array([raw[start:end].tobytes()], pa.large_binary())
            start = end


def tokens(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """A code for each word, the distinct words, and the number of each word's piece."""
    raw, at = W.text_bytes(column)
    w = W.split(column, IN_WORD, lower=True)
    code, distinct = w.coded()
    word = IN_WORD[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    full = np.flatnonzero(np.diff(at))
    begins[at[full]] = word[at[full]]
    new = SEPARATOR[raw].astype(np.int64)
    new[at[full]] += 1  # a text begins a piece
    return code, distinct, np.cumsum(new)[begins]


def seed_of(lang: str) -> np.uint64:
    return W.hashed(pa.array([lang.encode()], pa.large_binary()))[0]


def passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def phrases_of(ids: np.ndarray, words: pa.Array) -> pa.Array:
    columns = [words.take(pa.array(column)) for column in ids.T]
    return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if len(columns) > 1 else columns[0]


def _counter(n: int, buckets: int, bitmap, hot: np.ndarray, limits: Limits):
    """Texts and languages to sorted runs of phrases of ``n`` words; ``bitmap``: what is frequent of length ``n - 1``."""

    def run_rows(lang: str, trie: HatTrie, leave: int, seen: int, vocabulary: Vocabulary) -> pa.RecordBatch:
        ids, counts = trie.spilled(leave)
        h, seed = np.array(vocabulary.hashes, np.uint64), seed_of(lang)
        prefix = whole = W.gram_hashes_of(h[ids]) ^ seed
        if n > 1:
            prefix = W.gram_hashes_of(h[ids[:, :-1]]) ^ seed
            prefix = np.where(np.isin(prefix, hot), whole, prefix)
        bucket = (W.mix(prefix) % np.uint64(buckets)).astype(np.int32)
        text = phrases_of(ids, pa.array(list(vocabulary.ids), pa.large_binary())).cast(pa.large_string())
        order = pc.sort_indices(pa.table({"bucket": bucket, "text": text}), sort_keys=[("bucket", "ascending"), ("text", "ascending")]).to_numpy()
        bucket, counts = bucket[order], counts[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        offsets = np.append(cuts, len(bucket)).astype(np.int32)
        which = bucket[cuts] if len(cuts) else np.zeros(1, np.int32)
        offsets = offsets if len(cuts) else np.zeros(2, np.int32)
        total = np.zeros(len(which), np.int64)
        total[0] = seen
        return pa.RecordBatch.from_arrays([
            pa.array(which), pa.array([lang] * len(which)), pa.array(total),
            pa.ListArray.from_arrays(offsets, text.take(pa.array(order)).cast(pa.string())), pa.ListArray.from_arrays(offsets, pa.array(counts))],
            names=["bucket", "lang", "total", "phrases", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, HatTrie] = {}
        seen: dict[str, int] = {}
        vocabulary = Vocabulary()
        allowed = np.frombuffer(bitmap.value, np.uint8) if bitmap is not None else None

        def spill(leave: int) -> Iterator[pa.RecordBatch]:
            for lang in sorted(tries, key=lambda x: -tries[x].held):
                others = sum(t.held for x, t in tries.items() if x != lang)
                if others + tries[lang].held > leave or not leave:
                    yield run_rows(lang, tries[lang], max(0, leave - others), seen.pop(lang, 0), vocabulary)

        for batch in batches:
            langs = pc.fill_null(batch["lang"], "und")
            for lang in pc.unique(langs).to_pylist():
                texts = batch["text"].filter(pc.equal(langs, lang))
                trie = tries.setdefault(lang, HatTrie(n, limits.burst))
                for part in pieces(texts, limits.slice_bytes):
                    code, distinct, piece = tokens(part)
                    seen[lang] = seen.get(lang, 0) + len(code)
                    if len(code) < n:
                        continue
                    hashes = W.hashed(distinct)
                    start = piece[:len(piece) - n + 1] == piece[n - 1:]
                    if allowed is not None:
                        fits = passes(allowed, W.gram_hashes(hashes[code], n - 1) ^ seed_of(lang))
                        start &= fits[:-1] & fits[1:]
                    starts = np.flatnonzero(start)
                    for some in np.split(starts, np.arange(AT_ONCE, len(starts), AT_ONCE)) if len(starts) else ():
                        used = code[some[:, None] + np.arange(n)]
                        kinds, local = np.unique(used, return_inverse=True)
                        if len(vocabulary.ids) + len(kinds) > 1 << ID_BITS:
                            yield from spill(0)
                            vocabulary = Vocabulary()
                        ids = vocabulary.of(W.items(distinct.take(pa.array(kinds))), hashes[kinds])[local.reshape(used.shape)]
                        ids = ids[np.lexsort(ids.T[::-1])]
                        at = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1)))
                        trie.add(ids[at], np.diff(at, append=len(ids)))
                        if sum(t.held for t in tries.values()) > limits.held:
                            yield from spill(limits.held // 2)
        yield from spill(0)

    return count


def merged(runs: list[tuple[pa.Array, np.ndarray]], most: int) -> Iterator[pa.Table]:
    """The distinct phrases of sorted runs with the sums of their counts, in order, block by block."""
    if runs:
        yield from merged_from(pa.concat_arrays([p for p, _ in runs]), np.concatenate([c for _, c in runs]), np.array([len(p) for p, _ in runs]), most)


def merged_from(phrases: pa.Array, counts: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[pa.Table]:
    """As ``merged``, of runs that lie one after another, with the size of each.

    The blocks end at phrases that are sampled from all runs, so there are as
    many as ``most`` rows each make, however many runs there are; none has more
    than twice that (or a row of each run).  All runs are searched at once.
    """
    ends = np.cumsum(sizes)
    at = ends - sizes
    cuts = []
    if len(phrases) > most:
        step = max(1, most // len(sizes))
        sample = phrases.take(pa.array(np.concatenate([np.arange(a, z, step) for a, z in zip(at.tolist(), ends.tolist())])))  # noqa: B905
        cuts = sample.take(pc.array_sort_indices(sample)[max(1, most // step)::max(1, most // step)]).unique()
    for cut in [*cuts, None]:
        low, high = (at.copy(), ends.copy()) if cut is not None else (ends, ends)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            within = pc.less_equal(phrases.take(pa.array(middle)), cut).to_numpy(zero_copy_only=False)
            low[open_[within]], high[open_[~within]] = middle[within] + 1, middle[~within]
        taken = low - at
        if total := int(taken.sum()):
            rows = np.arange(total) + np.repeat(at - (np.cumsum(taken) - taken), taken)
            yield pa.table({"phrase": phrases.take(pa.array(rows)), "f": counts[rows]}).group_by("phrase").aggregate([("f", "sum")]).rename_columns(["phrase", "f"])
        at = low


def _merger(least: int, limits: Limits):
    def merge(table: pa.Table) -> pa.Table:
        out = []
        for lang in pc.unique(table["lang"]).to_pylist():
            own = table.filter(pc.equal(table["lang"], lang))
            # the word count of a language rides along, as a row without a phrase
            out.append(pa.table({"lang": [lang], "phrase": pa.array([None], pa.large_binary()), "f": [pc.sum(own["total"]).as_py()]}))
            phrases, counts = pc.list_flatten(own["phrases"]).cast(pa.large_binary()), pc.list_flatten(own["counts"])
            whole = [x.chunk(0) if x.num_chunks == 1 else x.combine_chunks() for x in (phrases, counts)]
            for block in merged_from(whole[0], whole[1].to_numpy(), pc.list_value_length(own["phrases"]).to_numpy(), limits.merged):
                block = block.filter(pc.greater_equal(block["f"], least))
                out.append(pa.table({"lang": pa.array([lang] * len(block), pa.string()), "phrase": block["phrase"], "f": block["f"]}))
        found = pa.concat_tables(out)
        return found.set_column(1, "phrase", found["phrase"].cast(pa.string()))

    return merge


def _hashes(batch: pa.RecordBatch, n: int) -> np.ndarray:
    """The hash of each phrase, as ``_counter`` forms it."""
    code, distinct = W.split(batch["phrase"], _ASCII != 0x20).coded()
    langs = batch["lang"].dictionary_encode()
    seeds = np.array([seed_of(x) for x in langs.dictionary.to_pylist()], np.uint64)
    return W.gram_hashes_of(W.hashed(distinct)[code].reshape(-1, n)) ^ seeds[langs.indices.to_numpy(zero_copy_only=False)]


def _bitmap(frequent: DataFrame, n: int) -> bytes:
    """A bit for each frequent phrase of ``n`` words, at its hash; the tasks' bitmaps are united block by block."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for b in batches:
            if len(b):
                at = _hashes(b, n) & np.uint64(FILTER_BITS - 1)
                np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        blocks = bits.reshape(-1, BLOCK_BITS // 8)
        for i in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([blocks[i].tobytes()])], names=["block", "bits"])

    def unite(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, np.uint8) for x in table["bits"].to_pylist()]
        return pa.table({"block": table["block"][:1], "bits": [np.bitwise_or.reduce(rows).tobytes()]})

    out = np.zeros((FILTER_BITS // BLOCK_BITS, BLOCK_BITS // 8), np.uint8)
    made = frequent.mapInArrow(mark, "block int, bits binary").groupBy("block").applyInArrow(unite, "block int, bits binary")
    for block, bits in made.collect():
        out[block] = np.frombuffer(bits, np.uint8)
    return out.tobytes()


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, limits: Limits = Limits()) -> tuple[list[DataFrame], DataFrame]:
    """The phrases of 1, 2, ... ``longest`` words that occur ``least`` times, (lang, phrase, f), and (lang, n): all words."""
    if longest > LONGEST:
        raise ValueError(f"phrases have at most {LONGEST} words")
    spark = docs.sparkSession
    docs = docs.select("text", "lang")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // PARTITION_BYTES))
    out: list[DataFrame] = []
    bitmap, hot, totals = None, np.zeros(0, np.uint64), None
    for n in range(1, longest + 1):
        runs = docs.mapInArrow(_counter(n, buckets, bitmap, hot, limits), RUN)
        both = written(runs.groupBy("bucket").applyInArrow(_merger(least, limits), "lang string, phrase string, f long"), f"phrases-{n}")
        out.append(both.where("phrase is not null"))
        if n == 1:
            totals = written(both.where("phrase is null").groupBy("lang").agg(F.sum("f").alias("n")).where("n > 0"), "phrase-totals")
        if n < longest:
            every = totals.agg(F.sum("n")).first()[0] or 0
            common = out[-1].where(F.col("f") * HOT > every).select("lang", "phrase").toArrow()  # fewer than HOT: their f are part of the sum
            hot = np.concatenate([np.zeros(0, np.uint64), *(_hashes(b, n) for b in common.to_batches() if len(b))])
            bitmap = spark.sparkContext.broadcast(_bitmap(out[-1], n))
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE, limits: Limits = Limits()) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    frequent, totals = counted(docs, least, longest, limits)
    parts = frequent[0]
    for f in frequent[1:]:
        parts = parts.union(f)
    found = parts.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1).withColumnRenamed("f", "a")
    # the largest count of a longer phrase around each phrase
    within = found.where(F.size("words") > 2).select(
        "lang", "a", "words", F.explode(F.expr("sequence(2, size(words) - 1)")).alias("many")).select(
        "lang", "a", F.explode(F.expr("transform(sequence(1, size(words) - many + 1), i -> array_join(slice(words, i, many), ' '))")).alias("phrase"))
    around = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    big = "decimal(38,0)"
    drop = F.col("longer").isNotNull() & (F.col("longer").cast(big) * 100 >= F.col("a").cast(big) * share)
    kept = found.join(around, ["lang", "phrase"], "left").where(~drop).drop("longer")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("first"), F.expr("array_join(slice(words, k + 1, size(words)), ' ')").alias("rest"))
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr("(cast(2000000 as decimal(38,0)) * cast(a as decimal(38,0))) div (cast(l as decimal(38,0)) + cast(r as decimal(38,0)))"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
