"""HTML to blocks: the text runs between block-level tags, in page order, with their tag paths.

A small tolerant scanner for use inside tasks.  Comments, declarations and the
contents of scripts, styles and the like are no text, nor is what stands in
drawings, media and choices (``HIDDEN``) up to their end tag or that of an
element around them; of formulas the text stays.  Unclosed tags close as
browsers close them where that matters for paths (``<p>``, ``<li>``, table
cells); an end tag without a start tag is ignored.

Paths are linked: an open element is one node, whatever the number of blocks
inside, so a page takes memory in proportion to its length, however deep its
elements are nested.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from typing import NamedTuple

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S)
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")

#: Contents that are no markup and never text, up to the end tag whatever stands before it.
RAW = {"script", "style", "textarea", "iframe"}
#: Elements whose text is never text of the page; other elements around them end them.
HIDDEN = {"noscript", "template", "svg", "object", "canvas", "audio", "video", "select"}
#: Elements that a ``/`` before the end of their start tag closes, and that start tags of ``BREAKS`` end, unless one of ``HOSTS`` stands between.
FOREIGN = {"svg", "math"}
BREAKS = {"blockquote", "body", "center", "dd", "div", "dl", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "li", "menu", "meta", "ol", "p", "pre", "table", "ul",
          "b", "big", "br", "code", "em", "embed", "i", "img", "nobr", "ruby", "s", "small", "span", "strike", "strong", "sub", "sup", "tt", "u", "var"}
HOSTS = {"foreignobject", "desc", "title", "mi", "mo", "mn", "ms", "mtext", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "svg", "math"}
#: A start tag closes an open one of these, unless a tag of the second kind stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_SCOPE = {"td", "th", "table", "button", "object", "html", "body", "article", "section", "div", "main", "li", "ul", "ol", "aside", "nav", "header", "footer", "form", "blockquote"}
#: No start tag inside one of these closes an element outside.
_WALLS = {"svg", "math", "template", "noscript", "object", "select"}


#: From the outermost: the tag, then the words of its class, id and role.
Path = tuple[tuple[str, ...], ...]
#: Bits of what a path says.
PATHS = 512


def bit(word: str) -> int:
    return zlib.crc32(word.encode()) % PATHS


class Node:
    """An open element, its place below the elements around it, and the hashed words of all of them as bits."""

    __slots__ = ("element", "above", "depth", "said")

    def __init__(self, element: tuple[str, ...], above: Node | None):
        self.element, self.above = element, above
        self.depth = above.depth + 1 if above else 1
        self.said = above.said if above else 0
        for word in (f"<{element[0]}>", *element[1:]):
            self.said |= 1 << bit(word)

    def path(self) -> Path:
        out, node = [], self
        while node:
            out.append(node.element)
            node = node.above
        return tuple(reversed(out))


class Block(NamedTuple):
    text: str
    node: Node | None
    #: Share of the characters that are inside links.
    linked: float

    @property
    def path(self) -> Path:
        return self.node.path() if self.node else ()


def _element(tag: str, rest: str) -> tuple[str, ...]:
    names = (m[2] or m[3] or m[4] or "" for m in _NAME.finditer(rest)) if "=" in rest else ()
    return (tag, *(p for n in names for p in _PART.findall(n.lower())))


def blocks(page: str) -> list[Block]:
    """All blocks with text."""
    out: list[Block] = []
    stack: list[Node] = []
    open_tags: Counter[str] = Counter()
    runs: list[str] = []
    linked = at = hidden = formulas = 0

    def flush() -> None:
        nonlocal runs, linked
        if runs:
            whole = "".join(runs)
            if text := " ".join(html.unescape(whole).split()):
                out.append(Block(text, stack[-1] if stack else None, min(1.0, linked / len(whole))))
            runs, linked = [], 0

    def cut(i: int) -> None:
        nonlocal hidden, formulas
        for node in stack[i:]:
            open_tags[node.element[0]] -= 1
            hidden -= node.element[0] in HIDDEN
            formulas -= node.element[0] == "math"
        del stack[i:]

    def close(tags: set[str], scope: set[str]) -> None:
        if not any(open_tags[t] for t in tags):
            return
        for i in range(len(stack) - 1, -1, -1):
            tag = stack[i].element[0]
            if tag in tags:
                cut(i)
                return
            if tag in scope or tag in _WALLS:
                return

    def leave_foreign() -> None:
        for i in range(len(stack) - 1, -1, -1):
            tag = stack[i].element[0]
            if tag in FOREIGN:
                cut(i)
                return
            if tag in HOSTS:
                return

    while at < len(page):
        m = _TAG.search(page, at)
        end = m.start() if m else len(page)
        if end > at and not hidden:
            runs.append(page[at:end])
            if open_tags["a"]:
                linked += end - at
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].element[0] == tag), len(stack)) if open_tags[tag] else len(stack)
            # the tags inside formulas and hidden elements part no blocks
            inside = (hidden or formulas) and not any(e.element[0] in HIDDEN or e.element[0] == "math" for e in stack[i:])
        else:
            if (hidden or formulas) and tag in BREAKS:
                leave_foreign()
            inside = (hidden or formulas) and tag not in BREAKS
        if tag in ("br", "img"):
            runs.append(" ")
        elif tag not in INLINE and not inside:
            flush()
        if m[1]:
            cut(i)
        elif tag in RAW:
            closing = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = closing.end() if closing else len(page)
        elif tag not in VOID and (not m[3].endswith("/") or tag in HIDDEN - FOREIGN):
            if tag not in INLINE and tag not in HIDDEN:
                close({"p"}, _SCOPE)
            if tag in CLOSES:
                close(*CLOSES[tag])
            stack.append(Node(_element(tag, m[3]), stack[-1] if stack else None))
            open_tags[tag] += 1
            hidden += tag in HIDDEN
            formulas += tag == "math"
    flush()
    return out
