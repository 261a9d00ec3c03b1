"""Find benchmark phrases in training texts with an FM-index per training shard.

Every task splits its part of the corpus into shards.  A shard's index holds its stretches of words whose neighbouring
pairs all occur in the phrases (no other stretch can hold a phrase); phrases are searched backwards through the
wavelet ranks, their places come from sampled positions, and covered words merge into spans to remove.  The corpus is
never shuffled: a task needs its own texts and the phrases.

Phrases travel to the executors in blocks of at most ``BLOCK_BYTES`` of item text, one pass over the rows for each
block (a single larger text is a block of its own), and the rows are written in between.

Null or empty texts have no words and no hits; items without words have no phrase; items with a null item_id
have phrases but no name (they count in ``n_hit`` and spans, not in ``item_ids``); repeated items count once; repeated
documents each give a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrometry.llm import arrays
from agrometry.llm.fm_index import FMIndex
from agrometry.llm.spans import carried
from agrometry.llm.staging import staged

WINDOW = 13
#: Bound of one broadcast block of item texts.
BLOCK_BYTES = 16_000_000
SHARD_BYTES = 4_000_000
_PAIR_BITS = 22

_ROW = ["doc_id", "text", "n_words", "n_hit", "item_ids", "marks", "spans", "carried"]
_DDL = (
    "doc_id bigint, text string, n_words bigint, n_hit bigint, item_ids array<string>, "
    "marks array<struct<begin:bigint,end:bigint>>, spans array<struct<begin:bigint,end:bigint>>"
)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """Fingerprints of neighbouring words, cut to an address."""
    return (arrays.mixed(hashes[:-1] * np.uint64(3) + hashes[1:]) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)


class Phrases:
    """Distinct windows of item words, by length, with the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        names = sorted({name for name, _ in items if name is not None})
        number = {name: i for i, name in enumerate(names)} | {None: -1}
        data, offsets = arrays.text_bytes(arrays.strings([text for _, text in items]))
        found = arrays.words(data, offsets, arrays.PLAIN_WORDS, arrays.LOWER)
        self.names = names
        self.vocabulary, symbols = np.unique(found.hashes, return_inverse=True)
        symbols = symbols.astype(np.int64) + 1
        rows: dict[int, list[tuple[np.ndarray, int]]] = {}
        self.pairs = np.zeros(1 << _PAIR_BITS, bool)
        for k, (name, _) in enumerate(items):
            a, b = found.first[k], found.first[k + 1]
            size = min(window, b - a)
            if size:
                views = np.lib.stride_tricks.sliding_window_view(symbols[a:b], size)
                rows.setdefault(int(size), []).append((views, number[name]))
            if b - a > 1:
                self.pairs[_pairs(found.hashes[a:b])] = True
        self.windows = []
        for size, parts in sorted(rows.items()):
            distinct, which = np.unique(np.concatenate([v for v, _ in parts]), axis=0, return_inverse=True)
            owners = np.concatenate([np.full(len(v), n) for v, n in parts])
            links = np.unique(np.stack([which.ravel(), owners], 1), axis=0)
            first = np.searchsorted(links[:, 0], np.arange(len(distinct) + 1))
            self.windows.append((size, distinct, links[:, 1], first))

    def least(self) -> int:
        return min((size for size, *_ in self.windows), default=0)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words from 1; words that are in no phrase get the number past the last."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, len(self.vocabulary) + 1)

    def stretches(self, found: arrays.Words) -> tuple[np.ndarray, np.ndarray]:
        """Runs of words of one text that may hold a phrase."""
        n = len(found.hashes)
        if not n or not self.windows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = self.least()
        if least == 1:
            begin, end = arrays.runs(self.symbols(found.hashes) <= len(self.vocabulary))
            inner = found.first[(found.first > 0) & (found.first < n)]
            cuts = np.unique(np.concatenate([begin, inner]))
            inside = np.searchsorted(begin, cuts, side="right") - 1
            keep = (inside >= 0) & (cuts < end[np.maximum(inside, 0)]) if len(begin) else np.zeros(len(cuts), bool)
            cuts, inside = cuts[keep], inside[keep]
            stop = np.minimum(end[inside], np.append(cuts[1:], n)) if len(cuts) else cuts
            return cuts, stop
        linked = self.pairs[_pairs(found.hashes)]
        linked[found.first[(found.first > 0) & (found.first < n)] - 1] = False
        begin, end = arrays.runs(linked)
        long = end + 1 - begin >= least
        return begin[long], end[long] + 1


def occurrences(found: arrays.Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All phrases in some texts: first word, number of words, and pairs (text, item) without repeats."""
    begin, end = phrases.stretches(found)
    sizes = end - begin
    starts, lengths, texts, items = [], [], [], []
    if len(begin):
        text_of = np.searchsorted(found.first, begin, side="right") - 1
        cut = np.searchsorted(np.cumsum(sizes + 1) // 1_500_000, np.arange(1 + int((sizes + 1).sum()) // 1_500_000))
        for a, b in zip(cut, [*cut[1:], len(begin)]):
            if a == b:
                continue
            size = sizes[a:b] + 1
            first = np.cumsum(size) - size
            place = np.arange(size.sum()) - np.repeat(first, size)
            source = np.repeat(begin[a:b], size) + place
            inside = place < np.repeat(sizes[a:b], size)
            symbols = np.zeros(len(place), np.int64)
            symbols[inside] = phrases.symbols(found.hashes[source[inside]])
            index = FMIndex(symbols)
            for length, windows, owners, owner_first in phrases.windows:
                low, high = index.search(windows)
                hit = np.flatnonzero(low < high)
                if not len(hit):
                    continue
                count = high[hit] - low[hit]
                which = np.repeat(hit, count)
                rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[which]
                at = source[index.locate(rows)]
                starts.append(at)
                lengths.append(np.full(len(at), length))
                text = text_of[a:b][np.searchsorted(begin[a:b], at, side="right") - 1]
                pair = np.unique(np.stack([which, text], 1), axis=0)
                held = owner_first[pair[:, 0] + 1] - owner_first[pair[:, 0]]
                texts.append(np.repeat(pair[:, 1], held))
                inner = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
                items.append(owners[np.repeat(owner_first[pair[:, 0]], held) + inner])
    none = np.zeros(0, np.int64)
    links = np.stack([np.concatenate(texts or [none]), np.concatenate(items or [none])], 1)
    links = np.unique(links, axis=0) if len(links) else links
    return np.concatenate(starts or [none]), np.concatenate(lengths or [none]), links[:, 0], links[:, 1]


def _pass(block, later: bool):
    """A pass of one block over batches of rows; ``later`` rows hold the marks of earlier passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = None
        for whole in batches:
            if phrases is None:
                phrases = Phrases(block.value)
            for batch in arrays.slices(whole, "text", SHARD_BYTES):
                yield _search(batch, phrases, later)

    return run


def _search(batch: pa.RecordBatch, phrases: Phrases, later: bool) -> pa.RecordBatch:
    column = batch.column(batch.schema.get_field_index("text"))
    parts, data, offsets = [], *arrays.text_bytes(column)
    at = 0
    while at < len(column):  # fingerprints in smaller steps, for memory
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + arrays.SLICE_BYTES, side="right")) - 1)
        step = slice(offsets[at], offsets[to])
        parts.append((arrays.words(data[step], offsets[at : to + 1] - offsets[at], arrays.PLAIN_WORDS, arrays.LOWER), offsets[at]))
        at = to
    base = np.cumsum([0, *(len(p.hashes) for p, _ in parts)])
    found = arrays.Words(
        np.concatenate([p.starts + o for p, o in parts]),
        np.concatenate([p.ends + o for p, o in parts]),
        np.concatenate([p.hashes for p, _ in parts]),
        np.concatenate([*(p.first[:-1] + b for (p, _), b in zip(parts, base)), base[-1:]]),
    )
    n = len(found.hashes)
    starts, lengths, texts, items = occurrences(found, phrases)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + lengths, -1)
    names: dict[int, set[str]] = {}
    for text, item in zip(texts.tolist(), items.tolist()):
        if item >= 0:
            names.setdefault(text, set()).add(phrases.names[item])
    if later:
        for text, (old_names, old_marks) in enumerate(zip(batch.column("item_ids").to_pylist(), batch.column("marks").to_pylist())):
            if old_names:
                names.setdefault(text, set()).update(old_names)
            for mark in old_marks:
                marks[found.first[text] + mark["begin"]] += 1
                marks[found.first[text] + mark["end"]] -= 1
    hit = arrays.sliding_any(marks)
    begin, end = arrays.runs(hit)
    # a run never joins the words of two texts into one span
    inner = found.first[(found.first > 0) & (found.first < n)]
    inner = inner[hit[inner] & hit[inner - 1]]
    begin, end = np.sort(np.concatenate([begin, inner])), np.sort(np.concatenate([end, inner]))
    text = np.searchsorted(found.first, begin, side="right") - 1
    whole = arrays.cumulative(hit)
    span_begin = arrays.character_places(data, found.starts[begin], offsets, text)
    span_end = arrays.character_places(data, found.ends[end - 1], offsets, text)
    first_word = found.first[text]
    list_offsets = pa.array(np.searchsorted(text, np.arange(len(column) + 1)).astype(np.int32))
    pair = lambda a, b: pa.ListArray.from_arrays(list_offsets, pa.StructArray.from_arrays([pa.array(a), pa.array(b)], ["begin", "end"]))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            column,
            pa.array(found.counts().astype(np.int64)),
            pa.array((whole[found.first[1:]] - whole[found.first[:-1]]).astype(np.int64)),
            pa.array([sorted(names.get(i, ())) for i in range(len(column))], pa.list_(pa.string())),
            pair((begin - first_word).astype(np.int64), (end - first_word).astype(np.int64)),
            pair(span_begin.astype(np.int64), span_end.astype(np.int64)),
            batch.column("carried"),
        ],
        _ROW,
    )


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """Item texts in blocks of about ``limit`` bytes at most, told apart by the item's name and text."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 if total <= limit else 2 * -(-total // limit)
    for k in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(r[0], r[1]) for r in part.distinct().collect()]


def find(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, text, n_words, n_hit, item_ids, marks, spans, carried) of all documents.

    ``marks`` are covered words by number, ``spans`` the same as characters of the text; both without overlap;
    ``carried`` is a struct of the columns in ``carry``.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), carried(carry))
    schema = f"{_DDL}, carried {rows.schema['carried'].dataType.simpleString()}"
    for k, block in enumerate(blocks(items, block_bytes)):
        rows = staged(rows, "searched") if k else rows
        rows = rows.mapInArrow(_pass(context.broadcast(block), k > 0), schema)
    return rows


def contaminated(n_hit="n_hit", n_words="n_words"):
    """At least one word in twenty is covered by phrases."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def digest(found: DataFrame) -> DataFrame:
    names = F.array_join(F.array_sort("item_ids"), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.encode(names, "UTF-8"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
