"""Find word windows that occur earlier in the corpus, with an FM-index per shard of repeated segments.

Windows are dealt to shards by what they say.  Of the runs of ``GRAM`` words in a window, the one with the smallest
fingerprint is its anchor; consecutive windows with one anchor form a segment.  Equal windows have equal anchors, so
only segments whose anchor occurs twice can hold a repeat:

1. Anchors are counted over all documents (fingerprints only); those that occur once are done.
2. Segments of repeated anchors are grouped by their words.  A later copy of a segment repeats all its windows: a document's
   copies are its segments less those that it is the first to hold.  An anchor with a single distinct segment is then
   done as well.
3. The first copies of the other segments go to shards by anchor.  Each shard is a compressed FM-index (wavelet
   matrix, sampled places) in the order of the corpus; its windows stream through backward search, with one step for
   all of them at a time, until they are found unique or the match is a whole window.  The earliest place of each
   matched row interval tells whether a window began before.
4. Anchors with more than ``HOT_SEGMENTS`` segments go to no shard.  Their windows are told apart by fingerprints:
   partial aggregates find the earliest place of each, and all later places are joined to it, so no task holds a
   frequent passage whole.
5. Reported windows merge into spans for each document.

Two filters of fixed size spare shuffling of segments and texts that have no part in this; results do not depend on
them.  Null texts have no words; documents under ``window`` words are never cut; a null doc_id counts as the smallest;
other columns are ignored.  Documents are told apart by doc_id and text: rows that share an id but not the text are
documents of their own, in the order of a fingerprint of their texts, and rows that share both are one document, with
the same spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrometry.llm import arrays, membership
from agrometry.llm.fm_index import FMIndex
from agrometry.llm.membership import BITS, bitmap, marked, may_hold
from agrometry.llm.spans import carried, kept_words
from agrometry.llm.staging import staged

WINDOW = 20
GRAM = 5
#: Words of a shard, about.
SHARD_WORDS = 300_000
HOT_SEGMENTS = 5_000
_SEGMENT = "anchor bigint, segment bigint, doc bigint, row bigint, start bigint, windows bigint"
#: A document: its id and a fingerprint of id and text.
_KEY = ["doc", "row"]
_NO_ID = -(1 << 63)
#: A segment's place in a document is its first word, shifted by so many bits, and its number of windows.
_WINDOW_BITS = 20


def _keyed(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    doc = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID))
    return [doc.alias("doc"), F.xxhash64(doc, F.col(text).cast("string")).alias("row")]


def _anchors(grams: np.ndarray, reach: int) -> np.ndarray:
    """Place of the leftmost smallest value of each ``reach`` neighbours."""
    value, place = grams, np.arange(len(grams))
    size = 1
    while size < reach:
        step = min(size, reach - size)
        smaller = value[step:] < value[:-step]
        value = np.where(smaller, value[step:], value[:-step])
        place = np.where(smaller, place[step:], place[:-step])
        size += step
    return place


def segments(found: arrays.Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor, fingerprint, text, first word and number of windows of all segments, and words' places of the first."""
    n = len(found.hashes)
    if n < window:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    at = np.arange(n - gram + 1)
    grams = arrays.span_hashes(found.hashes, at, at + gram)
    place = _anchors(grams, window - gram + 1)
    text = found.text_of()
    starts = np.arange(len(place))
    inside = starts + window <= found.first[1:][text[: len(place)]]
    fresh = np.ones(len(place), bool)
    fresh[1:] = ~inside[:-1] | (place[1:] != place[:-1])
    begin = np.flatnonzero(fresh & inside)
    stop = np.append(fresh[1:] | ~inside[1:], True)
    end = np.flatnonzero(stop & inside) + 1
    marks = arrays.span_hashes(found.hashes, begin, end + window - 1)
    owner = text[begin]
    return grams[place[begin]], marks, owner, begin - found.first[owner], end - begin, begin


def _counter(window: int, gram: int):
    """How often each anchor occurs in a slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                found = arrays.words(*arrays.text_bytes(batch.column(0)))
                anchor, count = np.unique(segments(found, window, gram)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(count.astype(np.int64))], ["anchor", "n"])

    return run


def _lister(window: int, gram: int, sent):
    """Segments whose anchor may be repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                found = arrays.words(*arrays.text_bytes(batch.column(2)))
                anchor, mark, owner, start, windows, _ = segments(found, window, gram)
                keep = marked(sent.value, (anchor & np.uint64(BITS - 1)).astype(np.int64))
                key = [batch.column(k).to_numpy(zero_copy_only=False)[owner] for k in (0, 1)]
                columns = (anchor.view(np.int64), mark.view(np.int64), *key, start, windows)
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["anchor", "segment", *_KEY, "start", "windows"])

    return run


def _reader(window: int):
    """The words (as fingerprints) of listed segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                found = arrays.words(*arrays.text_bytes(batch.column(2)))
                docs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                rows = []
                for k, listed in enumerate(batch.column(3).to_pylist()):
                    values = found.hashes[found.first[k] : found.first[k + 1]]
                    for x in listed:
                        a, n = x["start"], x["windows"]
                        rows.append((x["anchor"], *docs[k], a, values[a : a + n + window - 1].tobytes()))
                for at in range(0, len(rows), 20_000):
                    columns = list(zip(*rows[at : at + 20_000]))
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", *_KEY, "start", "words"])

    return run


def _window_reader(window: int):
    """Fingerprint and place of every window of listed segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                found = arrays.words(*arrays.text_bytes(batch.column(2)))
                docs = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
                for k, listed in enumerate(batch.column(3).to_pylist()):
                    values = found.hashes[found.first[k] : found.first[k + 1]]
                    at = np.concatenate([np.arange(x["start"], x["start"] + x["windows"]) for x in listed])
                    keys = arrays.span_hashes(values, at, at + window).view(np.int64)
                    columns = (keys, *(np.full(len(at), d[k]) for d in docs), at)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", *_KEY, "start"])

    return run


def repeated_windows(docs: np.ndarray, rows: np.ndarray, starts: np.ndarray, pieces: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Documents (doc, row) and starts of all windows in a shard that begin earlier in it.

    The index is built in the order of (doc, row, start), so a place tells which of two windows is earlier; windows of
    one document and start are the same window.
    """
    order = np.lexsort((starts, rows, docs))
    docs, rows, starts, pieces = docs[order], rows[order], starts[order], [pieces[k] for k in order]
    sizes = np.array([len(p) // 8 for p in pieces])
    hashes = np.frombuffer(b"".join(pieces), np.uint64)
    _, symbols = np.unique(hashes, return_inverse=True)
    first = np.cumsum(sizes + 1) - sizes - 1
    source = np.repeat(np.arange(len(pieces)), sizes)
    place = np.arange(len(hashes)) + source
    text = np.zeros(len(hashes) + len(pieces), np.int64)
    text[place] = symbols.astype(np.int64) + 1
    index = FMIndex(text, sample=4)
    windows = place[place - first[source] <= (sizes - window)[source]]
    last = text[windows + window - 1]
    low, high = index.smaller[last], index.smaller[last + 1]
    live = np.flatnonzero(high - low > 1)
    for back in range(window - 2, -1, -1):
        if not len(live):
            break
        low[live], high[live] = index.extend(text[windows[live] + back], low[live], high[live])
        live = live[high[live] - low[live] > 1]
    if not len(live):
        return (np.zeros(0, np.int64),) * 3
    bounds, which = np.unique(low[live], return_index=True)
    count = high[live][which] - bounds
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bounds, count)
    earliest = np.minimum.reduceat(index.locate(inside), np.cumsum(count) - count)
    before = earliest[np.searchsorted(bounds, low[live])]
    owner = lambda at: np.searchsorted(first, at, side="right") - 1
    mine, other = owner(windows[live]), owner(before)
    start = starts[mine] + windows[live] - first[mine]
    same = (docs[mine] == docs[other]) & (rows[mine] == rows[other]) & (start == starts[other] + before - first[other])
    later = (before < windows[live]) & ~same
    return docs[mine][later], rows[mine][later], start[later]


def _shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        *key, start, words = (table.column(c).combine_chunks() for c in (*_KEY, "start", "words"))
        doc, row, start = repeated_windows(*(c.to_numpy() for c in (*key, start)), words.to_pylist(), window)
        order = np.lexsort((start, row, doc))
        doc, row, start = doc[order], row[order], start[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(doc))[: len(begin)]
        last = start[end - 1] + window if len(begin) else start[begin]
        return pa.table({"doc": doc[begin], "row": row[begin], "begin": start[begin], "end": last})

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and spans of texts with the word spans to remove."""
    for whole in batches:
        for batch in arrays.slices(whole, "text"):
            data, offsets = arrays.text_bytes(batch.column(1))
            found = arrays.words(data, offsets)
            listed = batch.column(2)
            inner = listed.flatten()
            text = np.repeat(np.arange(len(listed)), listed.value_lengths().fill_null(0).to_numpy())
            marks = np.zeros(len(found.hashes) + 1, np.int64)
            np.add.at(marks, found.first[text] + inner.field("begin").to_numpy(), 1)
            np.add.at(marks, found.first[text] + inner.field("end").to_numpy(), -1)
            gone = arrays.sliding_any(marks)
            total = arrays.cumulative(gone)
            begin, end = arrays.runs(gone)
            cut = found.first[(found.first > 0) & (found.first < len(gone))]
            cut = cut[gone[cut] & gone[cut - 1]]
            begin, end = np.sort(np.concatenate([begin, cut])), np.sort(np.concatenate([end, cut]))
            owner = np.searchsorted(found.first, begin, side="right") - 1
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(arrays.character_places(data, found.starts[begin], offsets, owner)),
                    pa.array(arrays.character_places(data, found.ends[end - 1], offsets, owner)),
                ],
                ["begin", "end"],
            )
            places = pa.array(np.searchsorted(owner, np.arange(len(listed) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(found.counts().astype(np.int64)),
                    pa.array((total[found.first[1:]] - total[found.first[:-1]]).astype(np.int64)),
                    pa.ListArray.from_arrays(places, spans),
                    batch.column(3),
                ],
                ["doc_id", "text", "n_words", "n_removed", "spans", "carried"],
            )


def _finish_others(sent):
    """The same for texts without spans: those whose bit is not in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            other = ~marked(sent.value, batch.column(4).to_numpy(zero_copy_only=False))
            yield from _finish([batch.filter(pa.array(other))])

    return run


def _listed_texts(docs: DataFrame, unclear: DataFrame) -> DataFrame:
    """Rows (doc, row, text, listed) of the documents that hold some of the segments.

    A shuffle stands between the filter and what follows, so that no task keeps two Python workers.
    """
    wanted = unclear.groupBy(*_KEY).agg(F.collect_list(F.struct("anchor", "start", "windows")).alias("listed"))
    return may_hold(docs, "row", unclear.select("row").distinct()).join(wanted.hint("merge"), _KEY).select(*_KEY, "text", "listed")


def _later_windows(docs: DataFrame, hot: DataFrame, window: int) -> DataFrame:
    """Rows (doc, row, begin, end): neighbouring windows of the segments that begin earlier in another or the same segment."""
    windows = _listed_texts(docs, hot).mapInArrow(_window_reader(window), "key bigint, doc bigint, row bigint, start bigint")
    windows = staged(windows, "windows")
    place = F.struct(*_KEY, "start")
    several = windows.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    later = windows.join(several.select("key", "first"), "key").where(place > F.col("first")).select(*_KEY, "start")
    run = F.col("start") - F.dense_rank().over(Window.partitionBy(*_KEY).orderBy("start"))
    found = later.withColumn("run", run).groupBy(*_KEY, "run").agg(F.min("start").alias("begin"), (F.max("start") + window).alias("end"))
    return found.drop("run")


def _copies(listed: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """Rows (doc, row, listed): spans of each document's segments that are not the first of their words.

    Documents meet the list of segments that they are the first to hold, so no key is one of many rows.
    """
    code = (F.shiftleft("start", _WINDOW_BITS) + F.col("windows")).alias("code")
    held = listed.groupBy(*_KEY).agg(F.collect_set(code).alias("held"))
    own = distinct.groupBy(*_KEY).agg(F.collect_set(code).alias("own"))
    later = F.array_except("held", F.coalesce("own", F.array().cast("array<bigint>")))
    begin, windows = lambda c: F.shiftright(c, _WINDOW_BITS), lambda c: c.bitwiseAND(F.lit((1 << _WINDOW_BITS) - 1))
    span = lambda c: F.struct(begin(c).alias("begin"), (begin(c) + windows(c) + F.lit(window - 1)).alias("end"))
    rows = held.join(own, _KEY, "left").select(*_KEY, F.transform(later, span).alias("listed"))
    return rows.where(F.size("listed") > 0)


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows (doc, row, listed): spans of words, which may overlap, that an earlier window repeats."""
    docs = docs.select(*_keyed(), F.col("text").cast("string").alias("text"))
    gram = min(gram, window)
    counts = docs.select("text").mapInArrow(_counter(window, gram), "anchor bigint, n bigint")
    repeated = staged(counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors")
    sent = bitmap(repeated.select(F.col("anchor").bitwiseAND(F.lit(BITS - 1)).alias("bit")))
    listed = docs.mapInArrow(_lister(window, gram, sent), _SEGMENT)
    listed = staged(listed.join(repeated, "anchor", "left_semi"), "segments")

    place = F.struct(*_KEY, "start", "windows")
    distinct = listed.groupBy("anchor", "segment").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    distinct = staged(distinct.select("anchor", "segment", "first.*", "n"), "distinct")
    several = distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    unclear = distinct.join(several, "anchor").select("anchor", *_KEY, "start", "windows", (F.col("kinds") > HOT_SEGMENTS).alias("hot"))
    unclear = staged(unclear, "unclear")
    few, hot = unclear.where("not hot"), unclear.where("hot")
    words = _listed_texts(docs, few).mapInArrow(_reader(window), "key bigint, doc bigint, row bigint, start bigint, words binary")
    total = few.agg(F.sum(F.col("windows") + window)).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = words.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    searched = dealt.groupBy("shard").applyInArrow(_shard(window), "doc bigint, row bigint, begin bigint, end bigint")
    if not hot.isEmpty():
        searched = searched.union(_later_windows(docs, hot, window))

    span = F.struct("begin", "end")
    found = searched.groupBy(*_KEY).agg(F.collect_list(span).alias("listed")).union(_copies(listed, distinct, window))
    return staged(found.groupBy(*_KEY).agg(F.flatten(F.collect_list("listed")).alias("listed")), "removals")


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, carry: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, text, n_words, n_removed, spans, carried) of all documents.

    Spans are places of characters to cut out; ``carried`` is a struct of the columns in ``carry``.
    """
    found = removals(docs, window, gram)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), carried(carry), *_keyed())
    sent, test = membership.tester(found.select("row"))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    held = rows.where(test(membership.address("row")))
    held = held.join(found.hint("merge"), _KEY, "left").select("doc_id", "text", F.coalesce("listed", none).alias("listed"), "carried")
    free = rows.select("doc_id", "text", none.alias("listed"), "carried", membership.address("row").alias("bit"))
    schema = "doc_id bigint, text string, n_words bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>"
    schema = f"{schema}, carried {rows.schema['carried'].dataType.simpleString()}"
    return held.mapInArrow(_finish, schema).union(free.mapInArrow(_finish_others(sent), schema))


def digest(found: DataFrame) -> DataFrame:
    kept = F.sha2(F.encode(kept_words("text", "spans"), "UTF-8"), 256)
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))
