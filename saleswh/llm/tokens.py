"""Token counts by dynamic programming that shares prefixes in a trie.

A pre-token (a word of ``[^\x20\x09-\x0D]+`` after a word mark) is segmented by
a unigram model: the best sum of piece scores, with fewer pieces on ties.  The
best score of a prefix does not depend on what follows, so the distinct
pre-tokens of a task are inserted in one trie, and the forward score of a node
is computed once, when the first pre-token reaches it.  Where a pre-token
ends, its count is stored, and further occurrences are look-ups.

The pieces are those of a public SentencePiece vocabulary, whose path is a
parameter.  They are in order of frequency, so their scores follow Zipf's law
by rank; nothing is trained.  A character that is no piece is spelled in
bytes, each at the score of one rank beyond the last.

Scale: rows are counted where they are read, without any shuffle; a trie is
dropped when it has ``NODES`` nodes, which bounds its memory whatever the
vocabulary of the corpus.  A pre-token of more than ``LONG`` characters is not
inserted: its forward scores pass through a window as long as the longest piece,
so a word of many megabytes costs little more than its own text.  Defined results: a null or empty text has no
tokens; a word of any length counts whole; repeated rows are counted alike;
input columns of the names added are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from saleswh.llm import words as W

#: Nodes of a task's trie, and characters of a pre-token beyond which it is not inserted.
NODES, LONG = 400_000, 1024
MARK = "▁"

_PIECES: dict[str, tuple[dict[str, float], float]] = {}


def pieces(path: str) -> tuple[dict[str, float], float]:
    """Scores of the pieces of a SentencePiece file, and that of a byte; read once by each worker."""
    if path not in _PIECES:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        total = math.log(sum(1 / r for r in range(1, len(ids) + 2)))
        ranked = sorted(ids, key=lambda i: (-sp.get_score(i), i))
        _PIECES[path] = {sp.id_to_piece(i): -math.log(r) - total for r, i in enumerate(ranked, 1)}, -math.log(len(ids) + 1) - total
    return _PIECES[path]


class Trie:
    """Prefixes of pre-tokens, each with the score and the number of pieces of its best segmentation."""

    def __init__(self, scores: dict[str, float], byte: float):
        self.scores, self.byte, self.longest = scores, byte, max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.pieces = [0.0], [0]
        self.counts: dict[str, int] = {}

    def count(self, token: str) -> int:
        """Pieces of ``token``, which is inserted if it is new."""
        if (known := self.counts.get(token)) is not None:
            return known
        if len(token) > LONG:
            return self.passed(token)
        path, child, score, pieces, scores, longest = [0], self.child, self.score, self.pieces, self.scores, self.longest
        for end, c in enumerate(token, 1):
            node = child.get((path[-1], c))
            if node is None:
                node = child[path[-1], c] = len(score)
                size = len(c.encode())
                best, fewest = score[path[-1]] + size * self.byte, pieces[path[-1]] + size
                for begin in range(max(0, end - longest), end):
                    s = scores.get(token[begin:end])
                    if s is not None:
                        at = path[begin]
                        s += score[at]
                        if s > best or (s == best and pieces[at] + 1 < fewest):
                            best, fewest = s, pieces[at] + 1
                score.append(best)
                pieces.append(fewest)
            path.append(node)
        self.counts[token] = n = pieces[path[-1]]
        return n


    def passed(self, token: str) -> int:
        """Pieces of a long ``token``: the same scores, of which only those that a piece can reach back to are kept."""
        scores, longest = self.scores, self.longest
        score, pieces, gone = [0.0], [0], 0  # of the prefixes from ``gone`` characters on
        for end, c in enumerate(token, 1):
            size = len(c.encode())
            best, fewest = score[-1] + size * self.byte, pieces[-1] + size
            for begin in range(max(0, end - longest), end):
                s = scores.get(token[begin:end])
                if s is not None:
                    s += score[begin - gone]
                    if s > best or (s == best and pieces[begin - gone] + 1 < fewest):
                        best, fewest = s, pieces[begin - gone] + 1
            score.append(best)
            pieces.append(fewest)
            if len(score) > 64 * longest:
                cut = len(score) - longest
                gone += cut
                del score[:cut], pieces[:cut]
        return pieces[-1]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(*pieces(path))
        for batch in batches:
            for a, b in W.slices(batch["text"]):
                part = batch.slice(a, b - a)
                w = W.split(part["text"], W.NOT_SPACE)
                codes, distinct = w.coded()
                counts = np.zeros(len(distinct) + 1, np.int64)
                for i, word in enumerate(W.items(distinct)):
                    counts[i] = trie.count(MARK + word.decode())
                    if len(trie.score) > NODES:
                        trie.clear()
                tokens = np.bincount(w.rows(), weights=counts[codes], minlength=len(part)).astype(np.int64)
                new = {"n_pretokens": pa.array(w.counts(), pa.int64()), "n_tokens": pa.array(tokens, pa.int64())}
                own = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([part[c] for c in own] + list(new.values()), names=[*own, *new])
    return run


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_pretokens`` and ``n_tokens``; ``vocabulary``: path of a
    SentencePiece file, the same on all executors."""
    own = [c for c in docs.columns if c not in ("text", "n_pretokens", "n_tokens")]
    schema = T.StructType([docs.schema[c] for c in own]).add("n_pretokens", "long").add("n_tokens", "long")
    return docs.select(*own, "text").mapInArrow(_count(vocabulary), schema)
