"""Document quality by pairwise ranking (Bradley-Terry).

A document's score is a weighted sum of features of its text.  The weights make the better document of each preference
pair (one labelled 1, one labelled 0) score higher: logistic loss on the difference of the pair's features, minimised
by Newton steps.  The score's threshold is a quantile of the labelled scores: the share of labelled documents that
have label 0.  A logistic curve around the threshold turns scores into values from 0 to 1.

Features count kinds of characters and neighbouring kinds, and measure words and lines; they are made where the text
is, from the whole text.  Training takes every labelled document that is not held out.  All pairs would grow with the
square of the labels, so documents are dealt by hash to groups of about ``GROUP``, and every pair inside a group counts;
documents of a rare label stand in as many groups as it takes to have ``RARE`` in each.  Each step is one scan of the
stored features that adds up slopes and curvature task by task; the driver gets sums of a fixed size.  Means, deviations,
label shares and the threshold are those of all labelled documents, each counted once.

Null and empty texts have features of their own (all counts zero) and a score.  Without labels of both kinds every
document scores 0.5, and is accepted.  Repeated rows score alike; null labels and other columns are
ignored; a label without a document is not learned from, but counts in the share of label 0 that sets the threshold; a document with labels 0 and 1 counts under both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrometry.llm import arrays, membership
from agrometry.llm.staging import staged

#: Labelled documents in a group, and how many of a rare label a group has at least, if there are so many.
GROUP, RARE = 256, 32
#: Scans of the groups at most; steps end before if they would change nothing.
ROUNDS = 12
#: Weight of the squared weights beside the mean loss of the pairs.
SHRINK = 1e-3
#: Bins of a scan for the threshold, and so many scores that the driver may sort.
BINS = 4_096
#: Tasks' sums are added in so many groups before the driver adds those.
_SUMMED = 16

_KINDS = 12
_KIND = np.full(256, 9, np.uint8)  # other signs
_KIND[0x61:0x7B] = 0
_KIND[0x41:0x5B] = 1
_KIND[0x30:0x3A] = 2
_KIND[0x20] = 3
_KIND[[0x0A, 0x0D]] = 4
_KIND[0x2E] = 5
_KIND[0x2C] = 6
_KIND[[0x21, 0x3F]] = 7
_KIND[0x80:] = 8
_KIND[0x7C] = 10
_KIND[[*range(0x00, 0x0A), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F]] = 11
_NEWLINE = np.ones(256, bool)
_NEWLINE[[0x0A, 0x0D]] = False
FEATURES = _KINDS * _KINDS + _KINDS + 10


def _distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Different values of each text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return np.bincount(text[fresh], minlength=len(first) - 1)


def features(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each text."""
    data, offsets = arrays.text_bytes(texts)
    n = len(texts)
    size = np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    kind = _KIND[data].astype(np.int64)
    single = np.bincount(text * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS)
    inner = text[1:] == text[:-1]
    code = (text[1:] * _KINDS + kind[1:]) * _KINDS + kind[:-1]
    double = np.bincount(code[inner], minlength=n * _KINDS * _KINDS).reshape(n, -1)
    found = arrays.words(data, offsets)
    lines = arrays.words(data, offsets, _NEWLINE)
    count, line_count = np.maximum(found.counts(), 1), np.maximum(lines.counts(), 1)
    length = np.maximum(size, 1)
    word_size = found.ends - found.starts
    text_of = found.text_of()
    mean = np.bincount(text_of, word_size, n) / count
    upper = arrays.cumulative(kind == 1)
    capital = (upper[found.ends] - upper[found.starts]) * 2 > word_size
    repeated = np.zeros(len(found.hashes))
    repeated[1:] = (found.hashes[1:] == found.hashes[:-1]) & (text_of[1:] == text_of[:-1])
    last = found.ends - 1
    signs = np.isin(kind[last], (7, 9, 10)) if len(last) else np.zeros(0, bool)
    more = [
        np.log1p(size),
        np.log1p(found.counts()),
        mean,
        np.sqrt(np.maximum(0, np.bincount(text_of, word_size.astype(float) ** 2, n) / count - mean**2)),
        _distinct(found.hashes, found.first) / count,
        _distinct(lines.hashes, lines.first) / line_count,
        np.bincount(text_of, capital, n) / count,
        np.bincount(text_of, repeated, n) / count,
        np.bincount(text_of, signs, n) / count,
        np.log1p(count / line_count),
    ]
    return np.concatenate([double / length[:, None], single / length[:, None], np.stack(more, 1)], 1)


@dataclass
class Ranking:
    """Weights of standardised features, and the score that divides accepted from rejected."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.scale, -8, 8) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.raw(rows) - self.threshold) / self.spread, -30, 30)))


Pairs = tuple[np.ndarray, np.ndarray]
#: Adds up what a function gives for the rows of label 1 and those of label 0 of every group.
Summed = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def _moments(good: np.ndarray, poor: np.ndarray) -> np.ndarray:
    rows = np.concatenate([good, poor])
    return np.concatenate([[len(rows)], rows.sum(0), (rows**2).sum(0)])


def _slopes(good: np.ndarray, poor: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pairs, loss, gradient and curvature of all pairs of two sets of standardised rows."""
    if not len(good) or not len(poor):
        return np.zeros(2 + len(weights) + len(weights) ** 2)
    ahead = np.clip((good @ weights)[:, None] - (poor @ weights)[None, :], -30, 30)
    miss = 1 / (1 + np.exp(ahead))
    bend = miss * (1 - miss)
    cross = good.T @ bend @ poor
    curve = (good.T * bend.sum(1)) @ good + (poor.T * bend.sum(0)) @ poor - cross - cross.T
    slope = poor.T @ miss.sum(0) - good.T @ miss.sum(1)
    return np.concatenate([[ahead.size, np.log1p(np.exp(-ahead)).sum()], slope, curve.ravel()])


def _weights(summed: Summed, once: Summed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights by Newton steps, halved where the loss would rise; ``once`` leaves copies out."""
    count, *sums = np.split(once(_moments), [1, 1 + FEATURES])
    centre, square = (x / max(1, count[0]) for x in sums)
    scale = np.sqrt(np.maximum(0, square - centre**2))
    scale[scale < 1e-9 + 1e-6 * np.abs(centre)] = 1e9
    plain = lambda x: np.clip((x - centre) / scale, -8, 8)
    at, step, least = np.zeros(FEATURES), np.zeros(FEATURES), np.inf
    for _ in range(ROUNDS):
        tried = at + step
        found = summed(lambda good, poor, w=tried: _slopes(plain(good), plain(poor), w))
        if not found[0]:
            break
        found = found / found[0]
        loss = found[1] + SHRINK / 2 * tried @ tried
        if loss > least:
            step = step / 2
            continue
        at, least = tried, loss
        slope = found[2 : 2 + FEATURES] + SHRINK * at
        step = -np.linalg.solve(found[2 + FEATURES :].reshape(FEATURES, -1) + SHRINK * np.eye(FEATURES), slope)
        if -step @ slope < 1e-7:
            break
    # sums of doubles differ in their last digits with the order of their terms
    return centre, scale, np.round(at, 9)


def _place(scores: np.ndarray, good: np.ndarray, poor: np.ndarray, rejected: float, below: float) -> tuple[int, bool]:
    """The first of ascending scores up to which lies the rejected share, and whether all rows of that score do.

    ``good`` and ``poor`` are the shares of all rows of each label at a score, ``below`` is what lies under the first.
    """
    mass = good * (1 - rejected) + poor * rejected
    reached = below + np.cumsum(mass)
    at = min(int(np.searchsorted(reached, rejected - 1e-12)), len(scores) - 1)
    return at, bool(reached[at] <= rejected + 1e-12)


def _between(value: float, following: float | None, whole: bool, alone: bool) -> float:
    """The threshold over the last rejected score; a score shared by rejected and accepted rows is accepted."""
    if not whole and not alone:
        return value - 1e-6 * max(1.0, abs(value))
    return value if following is None else (value + following) / 2


def fit(good: np.ndarray, poor: np.ndarray, rejected: float) -> Ranking:
    """Learn from feature rows of both labels; ``rejected`` is the share of label 0."""
    if not len(good) or not len(poor):
        return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 1.0)
    groups = ceil((len(good) + len(poor)) / GROUP)
    dealt = list(zip(np.array_split(good, groups), np.array_split(poor, groups)))
    summed = lambda work: sum(work(*pair) for pair in dealt)
    centre, scale, weights = _weights(summed, summed)
    plain = Ranking(centre, scale, weights, 0.0, 1.0)
    scores = np.concatenate([plain.raw(good), plain.raw(poor)])
    values, at = np.unique(scores, return_inverse=True)
    share = [np.bincount(part, minlength=len(values)) for part in np.split(at, [len(good)])]
    place, whole = _place(values, share[0] / len(good), share[1] / len(poor), rejected, 0.0)
    following = float(values[place + 1]) if place + 1 < len(values) else None
    threshold = _between(float(values[place]), following, whole, share[0][place] + share[1][place] == 1)
    return Ranking(centre, scale, weights, threshold, float(max(1e-9, scores.std() / 4)))


def held_out() -> Column:
    """The third of documents that nothing is learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def _featured(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Features, as four-byte numbers, of documents that may have a label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            some = membership.marked(sent.value, whole.column(2).to_numpy(zero_copy_only=False))
            for batch in arrays.slices(whole.filter(pa.array(some)), "text"):
                found = [row.tobytes() for row in features(batch.column(1)).astype(np.float32)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "features"])

    return run


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[Pairs]:
    """Rows of label 1 and of label 0 of each group; groups are runs of rows."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None
    for batch in batches:
        bucket, label = batch.column("bucket").to_numpy(), batch.column("label").to_numpy()
        rows = _rows(batch)
        cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        for some, values, number in zip(np.split(rows, cuts), np.split(label, cuts), bucket[[0, *cuts]] if len(bucket) else ()):
            if held and number != last:
                yield _divided(held)
                held = []
            held.append((some, values))
            last = number
    if held:
        yield _divided(held)


def _divided(held: list[tuple[np.ndarray, np.ndarray]]) -> Pairs:
    rows, label = (np.concatenate(part) for part in zip(*held))
    return rows[label == 1], rows[label == 0]


def _added(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("part").to_numpy())
    sums = table.column("sums").to_pylist()
    total = sum(np.frombuffer(sums[k], np.float64) for k in order)
    return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def _summed(rows: DataFrame) -> Summed:
    """Sums over all groups: by task, then in ``_SUMMED`` groups of tasks, then on the driver, always in order of tasks."""

    def sums(work: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for good, poor in _groups(batches):
                found = work(good, poor)
                total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

        parts = rows.mapInArrow(run, "part int, sums binary").groupBy(F.col("part") % _SUMMED)
        found = parts.applyInArrow(_added, "part int, sums binary").collect()
        return sum(np.frombuffer(r.sums, np.float64) for r in sorted(found, key=lambda r: r.part % _SUMMED))

    return sums


def _scored(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(sent.value.raw(_rows(batch)))], ["label", "raw"])

    return run


def _cut(scores: DataFrame, rejected: float) -> tuple[float, float]:
    """Threshold and spread of all labelled scores (label, raw): the bin that holds the quantile is cut into bins until
    it is a few scores, so the quantile is exact and no task sorts them all."""
    good, poor = (F.count_if(F.col("label") == k) for k in (1, 0))
    whole = scores.agg(good.alias("good"), poor.alias("poor"), F.min("raw").alias("low"), F.max("raw").alias("high"), F.stddev_pop("raw").alias("spread")).first()
    low, high, below, following = whole.low, whole.high, 0.0, None
    while True:
        width = (high - low) / BINS
        inside = scores.where(F.col("raw").between(low, high))
        few = inside.limit(BINS + 1).count() <= BINS or width <= 0
        at = F.col("raw") if few else F.least(F.floor((F.col("raw") - low) / width), F.lit(BINS - 1))
        bins = inside.groupBy(at.alias("bin")).agg(F.min("raw").alias("low"), F.max("raw").alias("high"), good.alias("good"), poor.alias("poor"))
        found = sorted(bins.collect(), key=lambda r: r.bin)
        shares = [np.array([r[k] for r in found]) / whole[k] for k in ("good", "poor")]
        place, all_in = _place(np.array([r.low for r in found]), *shares, rejected, below)
        here = found[place]
        if place + 1 < len(found):
            following = found[place + 1].low
        if few or here.low == here.high:
            alone = here.good + here.poor == 1
            return _between(here.low, following, all_in, alone), max(1e-9, whole.spread / 4)
        below += sum(shares[0][:place]) * (1 - rejected) + sum(shares[1][:place]) * rejected
        low, high = here.low, here.high


def _dealt(known: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Labelled documents (doc_id, label, features) by group: a rare label's documents are copied to several groups.

    The first copy is the document itself (``first``).
    """
    groups = max(1, round(sum(counts.values()) / GROUP))
    copies = {label: min(groups, max(1, ceil(groups * RARE / n))) for label, n in counts.items()}
    many = F.when(F.col("label") == 1, copies[1]).otherwise(copies[0])
    copied = known.withColumn("copy", F.explode(F.sequence(F.lit(0), many - 1)))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(groups)) + F.floor(F.col("copy") * groups / many)
    bucket = F.pmod(place, F.lit(groups)).cast("int")
    dealt = copied.select(bucket.alias("bucket"), "label", (F.col("copy") == 0).alias("first"), "features", "doc_id")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "label", "features").drop("doc_id")


def train(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Fit on all labelled documents that are not held out."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("label in (0, 1) and doc_id is not null").where(~held_out())
    counts = dict(known.groupBy("label").count().collect())
    both = sum(counts.values())
    present = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.distinct()
    usable = dict(known.join(present, "doc_id", "left_semi").groupBy("label").count().collect())
    if len(usable) < 2:
        return fit(np.zeros((0, FEATURES)), np.zeros((0, FEATURES)), 0.0)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where(~held_out())
    sent = membership.bitmap(known.select(membership.address("doc_id").alias("bit")))
    found = texts.withColumn("bit", membership.address("doc_id")).mapInArrow(_featured(sent), "doc_id bigint, features binary")
    rows = staged(_dealt(found.join(known, "doc_id"), usable), "labelled")
    centre, scale, weights = _weights(_summed(rows), _summed(rows.where("first")))
    plain = spark.sparkContext.broadcast(Ranking(centre, scale, weights, 0.0, 1.0))
    once = rows.where("first").select("label", "features")
    scores = staged(once.mapInArrow(_scored(plain), "label int, raw double"), "scores")
    return Ranking(centre, scale, weights, *_cut(scores, counts.get(0, 0) / both))


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                score = sent.value.score(features(batch.column(batch.schema.get_field_index("text"))))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """Rows (doc_id, score) of all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(ranking)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_scorer(sent), "doc_id bigint, score double")


def accepted(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows of documents that score 0.5 or more, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(ranking)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                good = sent.value.score(features(batch.column(batch.schema.get_field_index("text")))) >= 0.5
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
