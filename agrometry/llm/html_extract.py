"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read as markup, leniently: comments, scripts, styles and the like are no text, block elements bound the leaf
blocks, unclosed paragraphs and items end where the next begins.  A drawing (svg) is no text up to its own end; one that
closes itself or never ends is only its tag.  Formulas (math) and what stands in for an object are text like any other.  Every block has features of its ancestors (element
names, words of class, id and role) and of its text (length, share of links, signs, place on the page).  The field
scores a block's features and neighbouring labels; it is trained by maximum likelihood (forward-backward) on labelled
pages, and the best sequence of labels is found by the Viterbi algorithm.

Character references are decoded, white space inside a block becomes one space, blocks of main text are joined by line
ends in page order.  Null and empty pages give an empty text; a null url or
page_id stays null; pages of any length are read whole; equally good sequences of labels give a block to the side text;
repeated rows are extracted alike; other columns are ignored.
"""

from __future__ import annotations

import html as markup
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrometry.llm import arrays
from agrometry.llm.labelled_pages import KEEP, pages

EPOCHS = 12
RATE = 0.15

# Elements of HTML by kind.
_RAW = "script|style|title|template|textarea|iframe|noembed|noframes"
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements that end where one of the same kind begins.
_CHAIN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][^\s/>]*+)([^>]*+)>|<[!?][^>]*>",
    re.S | re.I,
)
_DRAWING = re.compile(r"<(/?)svg(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>", re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    above: frozenset[str]
    tag: str
    linked: int


def _drawings(page: str) -> dict[int, int]:
    """Begin and end of every svg element that has an end."""
    ends, begun = {}, []
    for match in _DRAWING.finditer(page):
        if not match[1] and page[match.end() - 2] != "/":
            begun.append(match.start())
        elif not match[1]:
            ends[match.start()] = match.end()
        elif begun:
            ends[begun.pop()] = match.end()
    return ends


def blocks(page: str) -> list[Block]:
    """Leaf blocks that have text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, frozenset[str], str]] = [("", frozenset(), "")]
    held: list[str] = []
    links = linked = at = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(markup.unescape("".join(held)).split())
            if text:
                found.append(Block(text, stack[-1][1], stack[-1][2], linked))
            held.clear()
        linked = 0

    def close(names: tuple[str, ...], bound: tuple[str, ...] = ()) -> None:
        nonlocal links
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                links -= sum(entry[0] == "a" for entry in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in bound:
                return

    drawings = _drawings(page)
    while match := _TOKEN.search(page, at):
        if match.start() > at:
            piece = page[at : match.start()]
            held.append(piece)
            if links > 0:
                linked += len(piece.strip())
        at = match.end()
        name = match[3] or match[6]
        if not name:
            if match[1]:
                held.append(" ")
            continue
        name = name.lower()
        if name == "svg":
            held.append(" ")
            at = drawings.get(match.start(), at)
            continue
        if name in _BLOCKS:
            flush()
        elif name == "br":
            held.append(" ")
        if match[2] or match[5]:
            close((name,))
        elif name not in _VOID:
            if name in _BLOCKS:
                close(("p",), ("article", "section", "div", "body", "td", "blockquote", "li", "button"))
            if name in _CHAIN:
                close(_CHAIN[name], ("ul", "ol", "table", "dl", "select"))
            own = {f"in:{name}"}
            attributes = match[4] or match[7]
            if attributes:
                for value in _NAMES.findall(attributes):
                    own.update(f"named:{word}" for word in _WORD.findall("".join(value).lower()))
            last = stack[-1]
            stack.append((name, last[1] | own if not own <= last[1] else last[1], name if name in _BLOCKS else last[2]))
            links += name == "a"
    held.append(page[at:])
    flush()
    return found


def features(page: list[Block]) -> list[list[str]]:
    rows = []
    for k, block in enumerate(page):
        n = block.text.count(" ") + 1
        share = block.linked / len(block.text)
        row = ["bias", f"tag:{block.tag}", *block.above]
        row.append(f"words:{min(5, int(math.log2(n)))}")
        row.append("links:none" if share == 0 else "links:some" if share < 0.6 else "links:most")
        row.append("ends:sentence" if block.text[-1] in ".!?…:\"”" else "ends:open")
        if "©" in block.text:
            row.append("copyright")
        if k == 0:
            row.append("first")
        if k == len(page) - 1:
            row.append("last")
        rows.append(row)
    return rows


@dataclass
class Field:
    """Weights of features for main text, and of neighbouring labels (from, to)."""

    weights: dict[str, float] = field(default_factory=dict)
    step: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def scores(self, rows: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(name, 0.0) for name in row) for row in rows]

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The best labels (Viterbi)."""
        (a, b), (c, d) = self.step
        back: list[tuple[int, int]] = []
        zero = one = 0.0
        for k, score in enumerate(self.scores(rows)):
            if k:
                from_zero = (0 if zero + a >= one + c else 1), (0 if zero + b >= one + d else 1)
                zero, one = max(zero + a, one + c), max(zero + b, one + d)
                back.append(from_zero)
            one += score
        labels = [int(one > zero)] if rows else []
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]

    def learn(self, rows: list[list[str]], labels: list[int], rate: float) -> None:
        """One step up the likelihood of a page's labels."""
        n, step, scores = len(rows), self.step, self.scores(rows)
        both = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y)))
        ahead = [[0.0, scores[0]]]
        for k in range(1, n):
            zero, one = ahead[-1]
            ahead.append([both(zero + step[0][0], one + step[1][0]), both(zero + step[0][1], one + step[1][1]) + scores[k]])
        after = [[0.0, 0.0] for _ in range(n)]
        for k in range(n - 2, -1, -1):
            zero, one = after[k + 1][0], after[k + 1][1] + scores[k + 1]
            after[k] = [both(step[i][0] + zero, step[i][1] + one) for i in (0, 1)]
        whole = both(*ahead[-1])
        for k in range(n):
            miss = labels[k] - math.exp(ahead[k][1] + after[k][1] - whole)
            for name in rows[k]:
                self.weights[name] = self.weights.get(name, 0.0) * (1 - 1e-4) + rate * miss
        change = [[0.0, 0.0], [0.0, 0.0]]
        for k in range(1, n):
            for i in (0, 1):
                for j in (0, 1):
                    seen = ahead[k - 1][i] + step[i][j] + (scores[k] if j else 0.0) + after[k][j] - whole
                    change[i][j] += (labels[k - 1] == i and labels[k] == j) - math.exp(seen)
        for i in (0, 1):
            for j in (0, 1):
                step[i][j] += rate * change[i][j] / n


def labelled(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a page whose main texts are marked."""
    found = blocks(page)
    labels = [int(KEEP in block.text) for block in found]
    for block in found:
        block.text = block.text.replace(KEEP, "").strip() or "-"
    return features(found), labels


def train(labelled_pages: list[str] | None = None, epochs: int = EPOCHS, rate: float = RATE) -> Field:
    """Fit the field on labelled pages (those that come with the library, unless others are given)."""
    known = [labelled(page) for page in (pages() if labelled_pages is None else labelled_pages)]
    known = [x for x in known if x[1]]
    fitted, draw = Field(), random.Random(3)
    for epoch in range(epochs):
        draw.shuffle(known)
        for rows, labels in known:
            fitted.learn(rows, labels, rate / (1 + 0.3 * epoch))
    return fitted


def main_text(page: str, fitted: Field) -> str:
    found = blocks(page)
    return "\n".join(block.text for block, label in zip(found, fitted.decode(features(found))) if label)


def extract(web: DataFrame, fitted: Field) -> DataFrame:
    """Rows (page_id, url, text) of all pages."""
    sent = web.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "html"):
                texts = [main_text(page or "", sent.value) for page in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), arrays.strings(texts)], ["page_id", "url", "text"])

    rows = web.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string")


def digest(found: DataFrame) -> DataFrame:
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
