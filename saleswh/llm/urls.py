"""URL filters by a bit-parallel wildcard automaton.

Rules are globs over the canonical URL ``.host/path``: ``*`` stands for any
run of characters but ``/``, ``**`` for any run.  All globs are packed, state
by state, into the bits of a few 64-bit words, and a Shift-And step over one
character advances all patterns of a whole batch of URLs at once: the states
move on by one bit where the character is theirs, and those before a wildcard
stay where it accepts the character.

A host rule ``example.org/es/`` is the glob ``*.example.org/es/**``: the
leading dot of the canonical URL lets it fit the host and all its subdomains,
and ``*`` cannot reach into the path.  Of the host rules that fit the longest
wins (of equally long ones that block, then the first); if none fits, the
blocking globs decide, and what they leave is allowed.

Nothing is shuffled; rows are judged where they are read.  Defined results:
host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: then up to ``?``, ``#`` or the end; a null url, and one
without ``://``, has empty host and path, which no rule fits; repeated rows
are judged alike; input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm import words as W

#: Globs that block where no host rule fits: advertising hosts and paths.
BLOCK_GLOBS = ["*.ads-**", "*.ads.**", "*.adserver.**", "**/ads/**"]
#: Bytes of padded URLs that are worked on at once.
PADDED_BYTES = 8 << 20


class WildcardAutomaton:
    """Shift-And masks of several globs; each has a start state and one state for each literal byte."""

    def __init__(self, globs: list[str]):
        parsed = []
        for g in globs:
            literals, stays, raw, i = bytearray(), {}, g.encode(), 0
            while i < len(raw):
                if raw[i] != 0x2A:
                    literals.append(raw[i])
                    i += 1
                    continue
                n = 0
                while i < len(raw) and raw[i] == 0x2A:
                    i, n = i + 1, n + 1
                stays[len(literals)] = n > 1
            parsed.append((bytes(literals), stays))
        self.width = max(1, -(-sum(len(x) + 1 for x, _ in parsed) // 64))
        self.moves = np.zeros((256, self.width), np.uint64)
        self.stays = np.zeros((256, self.width), np.uint64)
        self.starts = np.zeros(self.width, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        at = 0
        for literals, stays in parsed:
            self.starts[at // 64] |= np.uint64(1) << np.uint64(at % 64)
            for i, c in enumerate(literals, at + 1):
                self.moves[c, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            for i, anything in stays.items():
                bit = np.uint64(1) << np.uint64((at + i) % 64)
                self.stays[:, (at + i) // 64] |= bit
                if not anything:
                    self.stays[0x2F, (at + i) // 64] &= ~bit
            at += len(literals) + 1
            self.ends.append(((at - 1) // 64, np.uint64(1) << np.uint64((at - 1) % 64)))

    def _run(self, raw: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Final states of texts, which come by falling size."""
        state = np.tile(self.starts, (len(sizes), 1))
        one, top = np.uint64(1), np.uint64(63)
        active = len(sizes)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[active - 1] <= t:
                active -= 1
            now = state[:active]
            c = raw[begins[:active] + t]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:active] = (moved & self.moves[c]) | (now & self.stays[c])
        return state

    def fits(self, texts: pa.Array) -> np.ndarray:
        """Texts by globs: whether the glob matches the whole text."""
        raw, at = W.text_bytes(texts)
        sizes = np.diff(at)
        order = np.argsort(-sizes, kind="stable")
        out = np.zeros((len(sizes), len(self.ends)), bool)
        a = 0
        while a < len(order):
            z = a + max(1, PADDED_BYTES // max(1, int(sizes[order[a]]) * self.width * 8 // 64 + 1) // 8)
            some = order[a:z]
            state = self._run(raw, at[:-1][some], sizes[some])
            for k, (word, bit) in enumerate(self.ends):
                out[some, k] = (state[:, word] & bit) > 0
            a = z
        return out


def _judge(rules: list[tuple[str, str, str]], block_globs: list[str]):
    #: the last that fits wins: short before long, allow before block, late before early
    ranked = sorted(range(len(rules)), key=lambda i: (len(rules[i][1] + rules[i][2]), rules[i][0] == "block", -i))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = WildcardAutomaton([f"*.{host}{path}**" for _, host, path in rules] + block_globs)
        names = np.array([host + path for _, host, path in rules] + [None], object)
        verdicts = np.array([verdict for verdict, _, _ in rules] + [""], object)
        for batch in batches:
            fits = automaton.fits(batch["_canonical"])
            best = np.full(len(batch), len(rules))
            for i in ranked:
                best[fits[:, i]] = i
            other = np.where(fits[:, len(rules):].any(axis=1), "block", "allow")
            verdict = np.where(best < len(rules), verdicts[best], other)
            own = [c for c in batch.schema.names if c != "_canonical"]
            yield pa.RecordBatch.from_arrays([batch[c] for c in own] + [pa.array(names[best], pa.string()), pa.array(verdict, pa.string())], names=[*own, "rule", "verdict"])
    return run


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], block_globs: list[str] | None = None) -> DataFrame:
    """The rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; ``rules``: (allow or block, host, path)."""
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "_canonical")]
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(url, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = pages.select(*own, host.alias("host"), F.regexp_extract(url, parts, 2).alias("path")) \
        .withColumn("_canonical", F.concat(F.lit("."), "host", "path"))
    schema = rows.drop("_canonical").schema.add("rule", "string").add("verdict", "string")
    return rows.mapInArrow(_judge(rules, BLOCK_GLOBS if block_globs is None else block_globs), schema)
