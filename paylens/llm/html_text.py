"""HTML extraction: pages become flat text blocks, and a decision tree tells main text from the rest.

A page is read once into blocks: the text between block-level tags, with its words, the share of them inside
links, and where the block stands: inside an article or main element, and inside elements whose tag, class,
id or role speaks of navigation, adverts, notices, forms, or comments. A block's features are
its own and its neighbours' word counts and link densities, and these places. Where an element announces main text the places decide, elsewhere
word counts and link densities. Names that tell a state (``has-sidebar``) and those of the body announce nothing. The tree is trained here, on
a small table of labelled pages below; nothing else is fitted.

Scripts, styles, templates and comments in the markup have no text. Character references are decoded,
white space inside a block becomes one space, blocks are trimmed and joined by an empty line. A null or empty page has
an empty text. Repeated pages are each extracted. Unclosed and stray tags are borne: a closing tag
closes what stands open inside its element; void elements never stay open. Only the three named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.blocks import columns, ids_of, texts_of

# Element names of the HTML standard, by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea title select option datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr img nobr".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split())

# Words in tags, classes, ids and roles, by what they announce.
PLACES = {
    "main": "article main content post entry story body",
    "navigation": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc skip tabs",
    "header": "header masthead banner topbar head",
    "footer": "footer bottom copyright contentinfo legal imprint",
    "aside": "aside sidebar related recommended widget complementary trending popular more share social tags rail",
    "advert": "ad ads advert advertisement adsense sponsored sponsor promo promotion commercial",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog newsletter subscribe banner toast paywall",
    "form": "form search login signup button input fieldset",
    "comment": "comment comments reply replies respond discussion disqus reviews",
}
PLACE_NAMES = tuple(PLACES)
_PLACE_OF: dict[str, list[int]] = {}
for _i, _name in enumerate(PLACE_NAMES):
    for _word in PLACES[_name].split():
        _PLACE_OF.setdefault(_word, []).append(_i)

# First and last words of class names that tell the state of a page, not what an element holds.
STATE_FIRST = frozenset("has is no not with without".split())
STATE_LAST = frozenset("open opened closed collapsed disabled enabled fixed sticky".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_WORD = re.compile(r"[a-z]+")


class Block:
    """One text block: its text, words, words inside links, and the places it stands in."""

    __slots__ = ("text", "words", "linked", "places", "tag")

    def __init__(self, text: str, words: int, linked: int, places: tuple[int, ...], tag: str):
        self.text, self.words, self.linked, self.places, self.tag = text, words, linked, places, tag


_MAIN = 1 << PLACE_NAMES.index("main")
_HIDE = 1 << len(PLACE_NAMES)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _places(tag: str, attributes: str) -> int:
    """Bits of the places that an element's tag, class, id and role announce, and whether it is hidden.

    The page's own elements announce nothing, nor do names of states (``has-sidebar``, ``comments-open``).
    """
    if tag in ("html", "body"):
        return 0
    bits, words = 0, [tag]
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = _WORD.findall(token)
                if len(parts) < 2 or not (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
                    words += parts
                if name == "class" and token == "hidden":
                    bits |= _HIDE
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _NOT_SHOWN.search(value)):
            bits |= _HIDE
    for w in words:
        for i in _PLACE_OF.get(w, ()):
            bits |= 1 << i
    return bits


class _Reader:
    """Collects blocks while the tags of a page go by."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int]] = []  # elements that are not inline, with all places they stand in
        self.link: int | None = None  # how many elements were open where the open link began
        self.parts: list[str] = []
        self.linked = 0
        self.main = False

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.link is not None:
                self.linked += len(unescape(raw).split())

    def flush(self) -> None:
        if self.parts:
            words = unescape("".join(self.parts)).split()
            if words:
                tag, bits = self.open[-1] if self.open else ("", 0)
                self.blocks.append(Block(" ".join(words), len(words), min(self.linked, len(words)), bits, tag))
            self.parts = []
        self.linked = 0

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.link = len(self.open)
        elif tag == "br":
            self.parts.append(" ")
        elif tag not in INLINE:
            self.flush()
            if tag in CLOSES_P:
                self.close("p")
            elif tag in _SIBLINGS:
                self.close(*_SIBLINGS[tag])
            if tag not in VOID:
                bits = _places(tag, attributes)
                self.main = self.main or bool(bits & _MAIN)
                self.open.append((tag, bits | (self.open[-1][1] if self.open else 0)))

    def close(self, *names: str) -> None:
        """Close the innermost of the named elements, if no other element holds it."""
        if self.open and self.open[-1][0] in names:
            self.pop(len(self.open) - 1)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = None
        elif tag not in INLINE and tag not in VOID:
            self.flush()
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    self.pop(i)
                    break

    def pop(self, to: int) -> None:
        self.flush()
        del self.open[to:]
        if self.link is not None and self.link > to:
            self.link = None


#: Elements whose start closes an open one of these kinds.
_SIBLINGS = {"li": ("li", "p"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}


def page_blocks(html: str | None) -> tuple[list[Block], bool]:
    """The blocks of a page in order, and whether any element announces main text."""
    reader = _Reader()
    if not html:
        return reader.blocks, False
    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            reader.text(html[at:])
            break
        reader.text(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            reader.end(tag)
        elif tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?![\w-])[^>]*(?:>|\Z)", re.I).search(html, at)
            if closing:
                at = closing.end()
            elif tag in ("script", "style"):
                at = n
            reader.parts.append(" ")
        else:
            reader.start(tag, m[3])
    reader.flush()
    return reader.blocks, reader.main


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "heading", "item",
            "page_has_main", *PLACE_NAMES, "hidden")


def features(blocks: list[Block], has_main: bool) -> np.ndarray:
    """A row per block: own and neighbours' word counts and link densities, its kind and places."""
    n = len(blocks)
    words = np.array([0, *[b.words for b in blocks], 0], np.float64)
    density = np.array([0, *[b.linked / b.words for b in blocks], 0], np.float64)
    places = np.array([b.places for b in blocks], np.int64)
    out = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:],
           [b.tag in _HEADINGS for b in blocks], [b.tag in ("li", "dt", "dd", "td", "th") for b in blocks], np.full(n, has_main)]
    out += [places >> i & 1 for i in range(len(PLACE_NAMES) + 1)]
    return np.array(out, np.float64).T


class DecisionTree:
    """Binary splits by Gini impurity; ties go to the earlier feature and the lower threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 20, least: int = 6):
        self.split: tuple[int, float] | None = None
        self.value = bool(y.mean() >= 0.5) if len(y) else False
        if depth and len(y) >= 2 * least and 0 < y.sum() < len(y) and (best := self._best(x, y, least)):
            left = x[:, best[0]] <= best[1]
            self.split = best
            self.low = DecisionTree(x[left], y[left], depth - 1, least)
            self.high = DecisionTree(x[~left], y[~left], depth - 1, least)

    @staticmethod
    def _best(x: np.ndarray, y: np.ndarray, least: int) -> tuple[int, float] | None:
        n, total = len(y), y.sum()
        found, lowest = None, total * (n - total) / n - 1e-9
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])[:-1]
            k = np.arange(1, n)
            impurity = ones * (k - ones) / k + (total - ones) * (n - k - total + ones) / (n - k)
            impurity[(v[1:] == v[:-1]) | (k < least) | (n - k < least)] = np.inf
            i = int(np.argmin(impurity)) if n > 1 else 0
            if n > 1 and impurity[i] < lowest:
                found, lowest = (f, float(v[i] + v[i + 1]) / 2), impurity[i]
        return found

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.value)
        if self.split and len(x):
            left = x[:, self.split[0]] <= self.split[1]
            out[left], out[~left] = self.low.predict(x[left]), self.high.predict(x[~left])
        return out

    def rules(self, indent: str = "") -> str:
        if not self.split:
            return f"{indent}{'main' if self.value else 'rest'}\n"
        name, at = FEATURES[self.split[0]], self.split[1]
        return f"{indent}{name} <= {at:g}\n{self.low.rules(indent + '  ')}{indent}{name} > {at:g}\n{self.high.rules(indent + '  ')}"


def train(pages: list[str] | None = None) -> DecisionTree:
    """A tree from pages in which every block of main text begins with ``MARK``."""
    from paylens.llm.labelled_pages import MARK, labelled_pages

    x, y = [], []
    for html in pages or labelled_pages():
        blocks, has_main = page_blocks(html)
        y += [b.text.startswith(MARK) for b in blocks]
        x.append(features(blocks, has_main))
    return DecisionTree(np.concatenate(x), np.array(y, np.int64))


def extract(html: str | None, tree: DecisionTree) -> str:
    """Main text of one page."""
    blocks, has_main = page_blocks(html)
    keep = tree.predict(features(blocks, has_main)) if blocks else []
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def main_text(pages: DataFrame, tree: DecisionTree | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = tree or train()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"page_id": pd.array(ids_of(batch, "page_id"), "Int64"), "url": batch["url"],
                                "text": [extract(h, tree) for h in texts_of(batch, "html")]})

    found = columns(pages, "page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
