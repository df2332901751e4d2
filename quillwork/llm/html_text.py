"""HTML extraction: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks in page order. A block knows its word count, its link density,
those of its neighbours, and where it lay (inside page furniture, inside the article). A small decision
tree, trained here on a small labelled table, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks

#: Elements whose content is never text.
SILENT = ("script", "style", "noscript", "template", "svg", "textarea", "select", "iframe", "object", "head", "title", "math", "canvas", "button")
#: Elements that hold page furniture.
FURNITURE = {"nav", "footer", "aside", "form", "header", "menu", "dialog"}
#: Elements that hold main text.
MAIN = {"article", "main"}
#: Elements that begin and end a block.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words in a class, id or role that mark furniture.
MARKS = re.compile(r"(?:^|[\s_\-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|comments?|commentlist|respond|replies|disqus|sidebar|widget|menu|nav\w*|breadcrumbs?|footer|header|masthead|cookies?|consent|notice|gdpr|popup|modal|share|social|related|recommended|newsletter|subscribe|signup|login|search|pagination|pager|toolbar|tags?|copyright|disclaimer|skip|hidden|complementary|navigation|contentinfo|alert)(?:$|[\s_\-])", re.I)

#: A tag; in the second form quotes don't protect a >.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_BEGINS_TAG = re.compile(r"</?[a-zA-Z]")
_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in SILENT}
_MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "main")


def _decoded(text: str) -> str:
    return html.unescape(text) if "&" in text else text


@dataclass
class Block:
    text: str
    words: int
    links: float
    furniture: bool
    main: bool


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order; blocks without text are left out. Markup may be unclosed or badly nested.

    The time is linear in the page. Where a tag never ends, by quotes that never close, quotes of this and all
    later tags don't count; a < behind which no tag ends is text, like one that begins none.
    """
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, furniture, main
    opened: Counter[str] = Counter()  # how many of each element are open
    endless: set[str] = set()  # silent elements whose end tag doesn't come any more
    pattern = _TAG
    state = [0, 0, 0]  # how many open elements are furniture, main, links

    def flush() -> None:
        if not parts:
            return
        words = _decoded("".join(p for p, _ in parts)).split()
        if words:
            text = " ".join(words)
            linked = len(" ".join(_decoded("".join(p for p, is_link in parts if is_link)).split())) if any(is_link for _, is_link in parts) else 0
            out.append(Block(text, len(words), min(1.0, linked / len(text)), state[0] > 0, state[1] > 0))
        parts.clear()

    def close(k: int) -> None:
        while len(stack) > k:
            tag, furniture, main = stack.pop()
            opened[tag] -= 1
            state[0] -= furniture
            state[1] -= main

    at, n = 0, len(page)
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            parts.append((page[at:], state[2] > 0))
            break
        if begin > at:
            parts.append((page[at:begin], state[2] > 0))
        if page.startswith(("<!", "<?"), begin):
            if page.startswith("<!--", begin):
                end = page.find("-->", begin + 4)
                at = end + 3 if end >= 0 else n
            elif page.startswith("<![CDATA[", begin):
                end = page.find("]]>", begin)
                parts.append((html.escape(page[begin + 9 : end if end >= 0 else n]), state[2] > 0))
                at = end + 3 if end >= 0 else n
            else:
                end = page.find(">", begin)
                at = end + 1 if end >= 0 else n
            continue
        if not _BEGINS_TAG.match(page, begin):
            parts.append(("<", state[2] > 0))
            at = begin + 1
            continue
        m = pattern.match(page, begin)
        if m is None and pattern is _TAG:
            pattern = _LOOSE_TAG
            m = pattern.match(page, begin)
        if m is None:
            parts.append((page[begin:], state[2] > 0))
            break
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                state[2] = 0
            elif tag in BLOCKS:
                flush()
                if opened[tag]:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag in _ENDS:
            if not m[3].endswith("/") or tag == "script":
                end = _ENDS[tag].search(page, at) if tag not in endless else None
                if end is None:
                    endless.add(tag)
                # an unclosed head or title must not swallow the page
                at = end.end() if end else (n if tag in ("script", "style", "textarea", "iframe") else at)
            continue
        if tag == "br":
            parts.append((" ", state[2] > 0))
        elif tag == "a":
            state[2] = 1
        elif tag in BLOCKS:
            flush()
            if tag not in VOID and not m[3].endswith("/"):
                if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
                    close(len(stack) - 1)
                named = " ".join(a or b or c for a, b, c in _MARKED.findall(m[3])) if m[3] else ""
                inside_main = state[1] > 0
                furniture = tag in FURNITURE and not (tag == "header" and inside_main) or bool(named and MARKS.search(named)) and tag not in ("body", "html") or bool(_HIDDEN.search(m[3]))
                stack.append((tag, furniture, tag in MAIN))
                opened[tag] += 1
                state[0] += furniture
                state[1] += tag in MAIN
    flush()
    return out


def features(page: list[Block]) -> list[tuple[float, ...]]:
    """FEATURES of every block; beyond the ends lie empty blocks."""
    empty = Block("", 0, 0.0, False, False)
    padded = [empty, *page, empty]
    return [(float(b.words), b.links, float(a.words), a.links, float(c.words), c.links, float(b.furniture), float(b.main)) for a, b, c in zip(padded, padded[1:], padded[2:], strict=False)]


#: Blocks labelled by hand, in the order of FEATURES, then 1 for main text.
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0), (2, 1.0, 1, 1.0, 12, 0.0, 1, 0, 0),
    (14, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0), (40, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0), (8, 0.2, 70, 0.0, 0, 0.0, 1, 0, 0),
    (6, 0.0, 90, 0.0, 5, 0.0, 1, 1, 0), (25, 0.1, 30, 0.0, 22, 0.0, 1, 1, 0), (60, 0.0, 12, 0.0, 45, 0.0, 1, 1, 0),
    (3, 1.0, 3, 1.0, 3, 1.0, 0, 0, 0), (4, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0), (2, 1.0, 50, 0.0, 3, 1.0, 0, 0, 0),
    (5, 0.9, 4, 1.0, 60, 0.0, 0, 0, 0), (7, 0.8, 6, 0.9, 8, 0.8, 0, 0, 0), (12, 0.7, 3, 1.0, 4, 1.0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), (2, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0), (4, 0.5, 3, 1.0, 0, 0.0, 0, 0, 0),
    (9, 0.0, 12, 0.0, 80, 0.0, 0, 1, 1), (1, 0.0, 30, 0.0, 44, 0.0, 0, 1, 1), (2, 0.0, 0, 0.0, 3, 0.0, 0, 1, 1),
    (120, 0.0, 9, 0.0, 60, 0.0, 0, 1, 1), (60, 0.1, 80, 0.0, 8, 0.1, 0, 1, 1), (35, 0.4, 50, 0.0, 20, 0.0, 0, 1, 1),
    (4, 0.0, 1, 1.0, 90, 0.0, 0, 1, 1), (3, 0.0, 44, 0.0, 6, 0.3, 0, 1, 1), (18, 0.0, 2, 0.0, 2, 0.0, 0, 1, 1),
    (5, 1.0, 60, 0.0, 40, 0.0, 0, 1, 1), (9, 0.6, 40, 0.0, 0, 0.0, 0, 1, 1), (4, 0.0, 60, 0.0, 3, 1.0, 0, 1, 1),
    (3, 1.0, 3, 1.0, 3, 1.0, 0, 1, 1), (2, 0.0, 3, 1.0, 3, 1.0, 0, 1, 1), (12, 0.3, 3, 1.0, 2, 1.0, 0, 1, 1),
    (80, 0.0, 5, 0.0, 70, 0.0, 0, 0, 1), (45, 0.1, 30, 0.0, 50, 0.1, 0, 0, 1), (30, 0.0, 2, 1.0, 40, 0.0, 0, 0, 1),
    (8, 0.0, 2, 1.0, 70, 0.0, 0, 0, 1), (12, 0.0, 50, 0.0, 60, 0.0, 0, 0, 1), (4, 0.0, 60, 0.0, 80, 0.0, 0, 0, 1),
    (22, 0.0, 0, 0.0, 30, 0.0, 0, 0, 1), (25, 0.3, 40, 0.1, 3, 1.0, 0, 0, 1), (15, 0.0, 20, 0.0, 9, 0.0, 0, 0, 1),
    (6, 0.0, 0, 0.0, 12, 0.0, 0, 0, 1), (3, 0.0, 40, 0.0, 0, 0.0, 0, 0, 1), (10, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1),
]


@dataclass
class Node:
    share: float
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def main(self, x: tuple[float, ...]) -> bool:
        node = self
        while node.low is not None:
            node = node.low if x[node.feature] <= node.cut else node.high
        return node.share >= 0.5


def train(rows: list[tuple[float, ...]], depth: int = 5, least: int = 1) -> Node:
    """A decision tree by Gini impurity; the last column is the label. Ties go to the feature listed last: where a block lay."""
    share = sum(r[-1] for r in rows) / len(rows)
    node = Node(share)
    if not depth or share in (0.0, 1.0):
        return node
    best = None
    for f in reversed(range(len(rows[0]) - 1)):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            cut = (a + b) / 2
            sides = [r[-1] for r in rows if r[f] <= cut], [r[-1] for r in rows if r[f] > cut]
            if min(map(len, sides)) < least:
                continue
            impurity = sum(len(s) * (p := sum(s) / len(s)) * (1 - p) for s in sides)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut)
    if best is None:
        return node
    _, node.feature, node.cut = best
    node.low = train([r for r in rows if r[node.feature] <= node.cut], depth - 1, least)
    node.high = train([r for r in rows if r[node.feature] > node.cut], depth - 1, least)
    return node


@lru_cache(maxsize=1)
def default_tree() -> Node:
    return train([tuple(map(float, r)) for r in LABELLED])


def main_text(page: str | None, tree: Node | None = None) -> str:
    """The main text of a page: its blocks that the tree takes for main text, one a line; empty if none or null."""
    tree = tree or default_tree()
    found = blocks(page or "")
    return "\n".join(b.text for b, x in zip(found, features(found), strict=True) if tree.main(x))


def extract(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages, whole html.

    Null and empty html give an empty text; null ids and urls are kept as they are. Repeated rows give repeated results, an empty
    table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_blocks(batches, "html"):
            found = [main_text(h, tree) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
