"""Main text of web pages by a recurrent block labeller.

A page is a sequence of blocks (``html_blocks``).  Each has a vector of its
hashed tag path, its hashed words and a few measures; a bidirectional LSTM in
numpy reads the sequence from both ends, so that each block is labelled, text
of the article or not, in the context of the whole page.

The labeller is trained at each run on at most ``SAMPLE`` pages, chosen by a
hash of the page.  Their labels come from markup that says what it is (an
``<article>``, a ``<nav>``, a class ``comments``); blocks without such markup
teach nothing; where no page of the sample has both kinds, small pages of our
own (``examples``) are added.  So that it learns more than the few tags a site uses, each
page is also shown with its containers renamed to others of the same kind,
with foreign boxes inside the article, and with all telling names removed,
when only words, measures and neighbours are left to tell.

Pages are labelled where they are read, without a shuffle; what is broadcast
is the weights, whose size is fixed.  Defined results: a null or empty page,
and one without an article block, has empty text; repeated pages are labelled
alike; input columns of the names added are replaced; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.llm import words as W
from saleswh.llm.html_blocks import PATHS, Block, Node, Path, bit, blocks

#: Pages to train on, the longest of them in bytes, and passes over them.
SAMPLE, SAMPLE_BYTES, STEPS = 48, 200_000, 100
#: Elements around all blocks of a page to train on, together: deeper pages are left out of the sample.
SAMPLE_DEPTH = 200_000
#: Buckets of hashed words; cells of the LSTM in each direction; paths whose vectors are made at once.
WORDS, CELLS, AT_ONCE = 32, 16, 8192
_MEASURES = 4

#: Markup that says what a block is: tags, and words of class, id or role.
ARTICLE = ["article", "main", "content", "post", "entry", "story", "body text", "articlebody"]
OTHER_TAGS = ["nav", "footer", "aside", "form", "menu", "dialog", "button", "header", "title", "figure"]
OTHER_WORDS = ["nav", "navbar", "menu", "footer", "header", "sidebar", "aside", "ad", "ads", "advert", "advertisement", "banner", "promo", "sponsor", "sponsored",
               "comment", "comments", "reply", "discussion", "cookie", "cookies", "notice", "consent", "popup", "modal", "form", "newsletter", "subscribe", "login",
               "search", "share", "social", "related", "recommended", "breadcrumb", "breadcrumbs", "pagination", "widget", "copyright", "legal", "toolbar", "tags"]
_ARTICLE, _OTHER_TAGS, _OTHER_WORDS = {w for a in ARTICLE for w in a.split()} - {"body", "text"}, set(OTHER_TAGS) - {"figure"}, set(OTHER_WORDS)

#: Parts of the pages to train on where no page of the sample says what its blocks are.
BOXES = ["<header><div>The Valley Times</div><ul><li><a href=/>Home</a></li><li><a href=/news>News</a></li><li><a href=/about>About us</a></li></ul></header>",
         "<nav><ul><li><a href=/a>Sport</a></li><li><a href=/b>Weather</a></li><li><a href=/c>Culture</a></li><li><a href=/d>Travel</a></li></ul></nav>",
         "<div class=notice>We use cookies. <a href=/ok>Accept all</a></div>",
         "<aside><h3>Most read</h3><ul><li><a href=/1>Ten recipes for summer</a></li><li><a href=/2>Who won the cup?</a></li></ul></aside>",
         "<div class=ad>Buy two, pay one! <a href=/buy>Order now</a></div>",
         "<section class=comments><h3>2 comments</h3><p>anna: great news!</p><p>tom: at last</p></section>",
         "<form class=newsletter><label>Your mail</label><button>Subscribe</button></form>",
         "<footer><p>© The Valley Times</p><a href=/legal>Legal notice</a> <a href=/contact>Contact</a></footer>"]
PARTS = ["<p>The new bridge across the river was opened on Monday, ten years after the first plans were drawn up, and hundreds of people came to walk over it.</p>",
         "<p>Builders had to stop twice, first because of a flood in the spring, and later because the ground under the northern pier proved too soft.</p>",
         "<p>Until now the way to the hospital took half an hour; it takes five minutes today, says the mayor, who thanked the workers in a short speech.</p>",
         "<h3>What it means for the town</h3>", "<p>It was a long wait.</p>",
         "<ul><li>The bridge is four hundred metres long, and it has two lanes for bicycles.</li><li>Lorries of more than seven tonnes must take the old road.</li></ul>",
         "<p>The council wants to plant trees along the bank next year. Whether there is money for it will be decided in the autumn, when the budget comes up.</p>"]
EXAMPLES = 24


def examples() -> Iterator[list[Block]]:
    """Small pages of our own: an article of some parts, with some boxes before and after it."""
    rng = np.random.default_rng(11)
    for _ in range(EXAMPLES):
        boxes = [BOXES[i] for i in rng.permutation(len(BOXES))[:rng.integers(2, len(BOXES) + 1)]]
        cut = int(rng.integers(len(boxes) + 1))
        level = f"h{rng.integers(1, 3)}"
        title = f"<{level}>A bridge opens after ten years</{level}>" if rng.random() < 0.8 else ""
        parts = "".join(PARTS[i] for i in rng.integers(0, len(PARTS), rng.integers(2, 12)))
        yield blocks(f"<html><body>{''.join(boxes[:cut])}<article>{title}{parts}</article>{''.join(boxes[cut:])}</body></html>")


def marked(path: Path) -> int | None:
    """1: in an article by its markup, 0: in something else, None: the markup doesn't say."""
    told = None
    for tag, *names in path:
        if tag in _OTHER_TAGS and not (tag == "header" and told) or _OTHER_WORDS.intersection(names):
            return 0
        if tag in ("article", "main") or _ARTICLE.intersection(names):
            told = 1
    return told


def _telling(element: tuple[str, ...]) -> bool:
    return marked((element,)) is not None


def _variants(page: list[Block], rng: np.random.Generator) -> Iterator[tuple[list[Path], np.ndarray]]:
    """Paths and labels (-1: none) of a page as it is, with renamed containers, and without telling names."""
    labels = np.array([-1 if (x := marked(b.path)) is None else x for b in page])
    yield [b.path for b in page], labels
    for _ in range(2):
        good = [("main",), ("article",), ("section", "content"), ("div", "post"), ("div", "entry"), ("div", "article", "content"), ("div", "story"), ("article", "post")][rng.integers(8)]
        names: dict[Path, tuple[str, ...]] = {}
        inside = next((b.path for b, y in zip(page, labels, strict=True) if y == 1), ())
        out = []
        for b, y in zip(page, labels, strict=True):
            path = b.path
            if y == 1:
                path = tuple(good if _telling(e) else e for e in path)
            elif y == 0:
                k = next(i for i in range(len(path)) if marked(path[:i + 1]) == 0)
                if path[:k + 1] not in names:
                    names[path[:k + 1]] = (OTHER_TAGS[rng.integers(len(OTHER_TAGS) - 2)],) if rng.random() < 0.3 else \
                        (("div", "section", "ul", "p")[rng.integers(4)], OTHER_WORDS[rng.integers(len(OTHER_WORDS))])
                new = names[path[:k + 1]]
                outer = tuple(good if _telling(e) else e for e in inside[:-1]) if rng.random() < 0.4 else path[:k]
                path = (*outer, new, *path[k + 1:])
            out.append(path)
        yield out, labels
    yield [tuple(("div",) if _telling(e) else e for e in b.path) for b in page], labels


def _node(path: Path) -> Node | None:
    node = None
    for element in path:
        node = Node(element, node)
    return node


def _path_vectors(nodes: list[Node | None]) -> np.ndarray:
    """What the elements of each path say, and the innermost one, as zeros and ones."""
    said = b"".join(((n.said | 1 << bit(f"leaf {n.element[0]}")) if n else 0).to_bytes(PATHS // 8, "little") for n in nodes)
    return np.unpackbits(np.frombuffer(said, np.uint8).reshape(-1, PATHS // 8), axis=1, bitorder="little").astype(np.float32)


def _content_vectors(pages: list[list[Block]]) -> np.ndarray:
    """Hashed words and measures of all blocks of some pages."""
    page = [b for p in pages for b in p]
    text = pa.array([b.text for b in page], pa.large_string())
    w = W.split(text, W.ALNUM, lower=True)
    codes, distinct = w.coded()
    bucket = (W.hashed(distinct) % np.uint64(WORDS)).astype(np.int64)
    counts = np.bincount(w.rows() * WORDS + bucket[codes], minlength=len(page) * WORDS).reshape(-1, WORDS) if len(page) else np.zeros((0, WORDS))
    n = w.counts()
    place = np.concatenate([np.linspace(0, 1, len(p)) for p in pages]) if pages else np.zeros(0)
    stops = np.array([sum(map(b.text.count, ".,;!?")) for b in page], np.float64)
    more = np.stack([np.log1p(n) / 4, np.array([b.linked for b in page]), stops / np.maximum(n, 1), place], axis=1) if len(page) else np.zeros((0, _MEASURES))
    return np.concatenate([counts / np.maximum(n, 1)[:, None], more], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Lstm:
    """One direction over left-aligned sequences that come by falling length."""

    def __init__(self, recurrent: np.ndarray):
        self.u = recurrent

    def forward(self, z: np.ndarray, sizes: np.ndarray, keep: bool = False) -> np.ndarray:
        """Hidden states for the inputs' gates ``z`` (sequences, steps, 4 * cells)."""
        n, steps, width = z.shape
        k = width // 4
        h, c, out, self.kept = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32), np.zeros((n, steps, k), np.float32), []
        for t in range(steps):
            m = int(np.searchsorted(-sizes, -t, side="left"))
            gates = z[:m, t] + h[:m] @ self.u
            i, f, o, g = _sigmoid(gates[:, :k]), _sigmoid(gates[:, k:2 * k]), _sigmoid(gates[:, 2 * k:3 * k]), np.tanh(gates[:, 3 * k:])
            before, h_before = c[:m].copy(), h[:m].copy()
            c[:m] = f * before + i * g
            tc = np.tanh(c[:m])
            h[:m] = o * tc
            out[:m, t] = h[:m]
            if keep:
                self.kept.append((m, i, f, o, g, before, tc, h_before))
        return out

    def backward(self, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``z`` and of the recurrent weights."""
        n, steps, k = d_out.shape
        dz, du = np.zeros((n, steps, 4 * k), np.float32), np.zeros_like(self.u)
        dh, dc = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        for t in range(steps - 1, -1, -1):
            m, i, f, o, g, before, tc, h_before = self.kept[t]
            d = dh[:m] + d_out[:m, t]
            cell = dc[:m] + d * o * (1 - tc * tc)
            gates = np.concatenate([cell * g * i * (1 - i), cell * before * f * (1 - f), d * tc * o * (1 - o), cell * i * (1 - g * g)], axis=1)
            dz[:m, t] = gates
            du += h_before.T @ gates
            dh[:m], dc[:m] = gates @ self.u.T, cell * f
        return dz, du


def _flip(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each sequence reversed, padding left at the end."""
    at = sizes[:, None] - 1 - np.arange(x.shape[1])
    return np.where((at >= 0)[:, :, None], np.take_along_axis(x, np.maximum(at, 0)[:, :, None], axis=1), 0)


class Labeller:
    """The weights: of inputs and states for both directions, and of the final score."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        inputs, self.p = PATHS + WORDS + _MEASURES, {}
        for d in "fb":
            self.p[f"w{d}"] = rng.normal(0, 0.15, (inputs, 4 * CELLS)).astype(np.float32)
            self.p[f"u{d}"] = rng.normal(0, 0.2, (CELLS, 4 * CELLS)).astype(np.float32)
            self.p[f"b{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), CELLS)
        self.p["v"] = rng.normal(0, 0.2, (2 * CELLS + inputs,)).astype(np.float32)
        self.p["v"][2 * CELLS:] = 0
        self.p["a"] = np.zeros(1, np.float32)

    def _score(self, z: dict[str, np.ndarray], direct: np.ndarray, sizes: np.ndarray, keep: bool = False) -> np.ndarray:
        self.runs = {d: Lstm(self.p[f"u{d}"]) for d in "fb"}
        hf = self.runs["f"].forward(z["f"], sizes, keep)
        hb = _flip(self.runs["b"].forward(_flip(z["b"], sizes), sizes, keep), sizes)
        self.h = np.concatenate([hf, hb], axis=2)
        return self.h @ self.p["v"][:2 * CELLS] + direct + self.p["a"]

    def train(self, x: np.ndarray, labels: np.ndarray, sizes: np.ndarray, steps: int = STEPS, rate: float = 0.02, seed: int = 7) -> None:
        """Adam on the logistic loss; ``x``: inputs of the blocks of pages, which come by falling ``sizes``; ``labels``: -1 for none."""
        rng = np.random.default_rng(seed)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in "ms")
        told = (labels >= 0).astype(np.float32)
        rare = max(1.0, float(told.sum()))
        page = np.repeat(np.arange(len(sizes)), sizes)
        spot = page, np.concatenate([np.arange(n) for n in sizes])

        def padded(flat: np.ndarray) -> np.ndarray:
            out = np.zeros((len(sizes), sizes[0], *flat.shape[1:]), np.float32)
            out[spot] = flat
            return out

        for step in range(1, steps + 1):
            shown = x * (rng.random((len(sizes), x.shape[1])) > 0.1)[page]  # some inputs of each page are hidden
            z = {d: padded(shown @ self.p[f"w{d}"] + self.p[f"b{d}"]) for d in "fb"}
            score = self._score(z, padded(shown @ self.p["v"][2 * CELLS:]), sizes, keep=True)[spot]
            d = ((_sigmoid(score) - np.maximum(labels, 0)) * told / rare).astype(np.float32)
            grad = {"a": np.array([d.sum()], np.float32), "v": np.concatenate([d @ self.h[spot], d @ shown])}
            dh = padded(d)[:, :, None] * self.p["v"][:2 * CELLS]
            for name, part in (("f", dh[:, :, :CELLS]), ("b", _flip(dh[:, :, CELLS:], sizes))):
                dz, grad[f"u{name}"] = self.runs[name].backward(part)
                dz = (dz if name == "f" else _flip(dz, sizes))[spot]
                grad[f"b{name}"] = dz.sum(axis=0)
                grad[f"w{name}"] = shown.T @ dz
            for k, g in grad.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        self.runs = self.h = None

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page the score of each block: an article's where above zero."""
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: -len(pages[i]))
        out = [np.zeros(0, np.float32) for _ in pages]
        a = 0
        while a < len(order):
            z = a + max(1, 20_000 // len(pages[order[a]]))  # of bounded padded size
            some = [pages[i] for i in order[a:z]]
            sizes = np.array([len(p) for p in some])
            paths: dict[tuple[int, str], int] = {}
            nodes: list[Node | None] = []
            of = []
            for b in (b for p in some for b in p):
                key = (b.node.said, b.node.element[0]) if b.node else (0, "")
                if key not in paths:
                    paths[key] = len(nodes)
                    nodes.append(b.node)
                of.append(paths[key])
            content = _content_vectors(some)
            spot = np.repeat(np.arange(len(some)), sizes), np.concatenate([np.arange(n) for n in sizes])

            def spread(weights: np.ndarray, bias: np.ndarray | float, nodes=nodes, of=of, content=content, spot=spot, sizes=sizes) -> np.ndarray:
                seen = np.concatenate([_path_vectors(nodes[i:i + AT_ONCE]) @ weights[:PATHS] for i in range(0, len(nodes), AT_ONCE)])
                flat = seen[of] + content @ weights[PATHS:] + bias
                padded = np.zeros((len(sizes), sizes[0], *flat.shape[1:]), np.float32)
                padded[spot] = flat
                return padded

            score = self._score({d: spread(self.p[f"w{d}"], self.p[f"b{d}"]) for d in "fb"}, spread(self.p["v"][2 * CELLS:], 0.0), sizes)
            for i, row, n in zip(order[a:z], score, sizes, strict=True):
                out[i] = row[:n]
            a = z
        self.runs = self.h = None
        return out


def fit(pages: DataFrame) -> Labeller:
    """The labeller of some pages (html).

    A share of the rows by their hash, about four times the sample, is drawn
    where they are read; only these are ordered, so what tasks send to the
    driver does not grow with their number.
    """
    share = min(1.0, 4 * SAMPLE / max(1, pages.count()))
    drawn = pages.withColumn("_draw", F.pmod(F.xxhash64(*pages.columns), F.lit(1 << 40))).where(F.col("_draw") <= int(share * (1 << 40)))
    small = drawn.select("_draw", "html").where(F.col("html").isNotNull() & (F.octet_length("html").between(1, SAMPLE_BYTES)))
    sample = [blocks(r["html"]) for r in small.orderBy("_draw", "html").limit(SAMPLE).collect()]
    sample = [p for p in sample if p and sum(b.node.depth if b.node else 0 for b in p) <= SAMPLE_DEPTH]
    told = {marked(b.path) for p in sample for b in p}
    if not {0, 1} <= told:  # no page says what is what: examples of our own do
        sample += examples()
    rng, shown = np.random.default_rng(7), []
    for page in sample:
        content = _content_vectors([page])
        shown += [(np.concatenate([_path_vectors([_node(p) for p in paths]), content], axis=1), labels) for paths, labels in _variants(page, rng)]
    labeller = Labeller()
    if shown:
        shown.sort(key=lambda s: -len(s[0]))
        labeller.train(np.concatenate([v for v, _ in shown]), np.concatenate([y for _, y in shown]), np.array([len(v) for v, _ in shown]))
    return labeller


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller: Labeller = shared.value
        for batch in batches:
            for a, b in W.slices(batch["html"]):
                part = batch.slice(a, b - a)
                pages = [blocks(x or "") for x in part["html"].to_pylist()]
                texts = ["\n".join(x.text for x, s in zip(p, score.tolist(), strict=True) if s > 0) for p, score in zip(pages, labeller.scores(pages), strict=True)]
                own = [c for c in part.schema.names if c != "html"]
                yield pa.RecordBatch.from_arrays([part[c] for c in own] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*own, "text", "n_chars"])
    return run


def extracted(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """The columns of ``pages`` but the html, with ``text`` and ``n_chars``."""
    own = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    schema = T.StructType([pages.schema[c] for c in own]).add("text", "string").add("n_chars", "long")
    return pages.select(*own, "html").mapInArrow(_extract(pages.sparkSession.sparkContext.broadcast(labeller)), schema)
